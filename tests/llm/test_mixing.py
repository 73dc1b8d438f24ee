from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from campaign_engine.llm import mixing


def targets(sizes, cap=3.0, weights=(5, 2, 1)):
    names = sorted(sizes, key=lambda s: (s is None, s))
    w = {s: weights[i % 3] for i, s in enumerate(names)}
    total, capped = sum(sizes.values()), set()
    while True:
        free = [s for s in names if s not in capped]
        left = total - sum(cap * sizes[s] for s in capped)
        t = {s: left * w[s] / sum(w[x] for x in free) for s in free}
        over = {s for s in free if t[s] > cap * sizes[s]}
        if not over or len(over) == len(free):
            return {s: cap * sizes[s] if s in capped else t[s] for s in names}
        capped |= over


def test_targets_taken_and_positions(spark):
    rows = [(i, " ".join(["w"] * (i * 7 % 23 + 1)), "abcd"[i % 4] if i % 4 < 3 or i % 8 == 3 else None)
            for i in range(400)] + [(400 + i, "tiny words", "e") for i in range(3)] + [(500, None, "f"), (None, "", "a")]
    df = spark.createDataFrame(rows, "doc_id long, text string, source string")
    df = df.withColumn("target", F.lit("clash")).withColumn("copies", F.lit(1))
    got = mixing.mix(df).collect()
    assert len(got) == len(rows)
    sizes, taken, target = defaultdict(int), defaultdict(int), {}
    by_id = {d: (len((t or "").split()), s) for d, t, s in rows}
    for r in got:
        n, s = by_id[r.doc_id]
        assert r["size"] == n and 0 <= r.taken <= 3 * n
        sizes[s] += n
        taken[s] += r.taken
        target[s] = r.target
        assert (r.position is not None) == (r.copies > 0 and r.target > 0)
        assert r.position is None or 0 <= r.position <= 1
    want = targets(sizes)
    for s in sizes:
        assert target[s] == pytest.approx(want[s])
        assert abs(taken[s] - target[s]) <= 3, (s, taken[s], target[s])
    again = mixing.mix(df).collect()
    assert sorted(map(str, got)) == sorted(map(str, again))


def test_early_classes_come_early(spark):
    rows = [(i, "a b c d", "abc"[i % 3]) for i in range(3000)]
    df = spark.createDataFrame(rows, "doc_id long, text string, source string")
    mean = {r.weight: r.p for r in mixing.mix(df).groupBy("weight").agg(F.avg("position").alias("p")).collect()}
    assert mean[5] < mean[2] < mean[1]
    order = [r.position for r in mixing.training_order(df).select(F.col("__position").alias("position")).collect()]
    assert order == sorted(order) and abs(len(order) - 3000) < 5


def test_inverse_integrates_the_schedule(spark):
    knots = ((0.0, 0.0), (0.4, 2.0), (0.6, 2.0), (1.0, 0.5))
    area = 0.4 + 0.4 + 0.5

    def demand(t):
        out = 0.0
        for (t0, w0), (t1, w1) in zip(knots, knots[1:]):
            x = min(max(t - t0, 0), t1 - t0)
            out += w0 * x + (w1 - w0) / (t1 - t0) * x * x / 2
        return out / area

    for r in spark.range(0, 101).select((F.col("id") / 100).alias("u")).select(
            "u", F.expr(mixing.inverse_demand("u", knots)).alias("t")).collect():
        assert demand(r.t) == pytest.approx(r.u, abs=1e-9)


def test_copies_of_repeated_rows_and_empty_table(spark):
    rows = [(1, "a b", "x")] * 6 + [(2, "c d e", "y")] * 2
    df = spark.createDataFrame(rows, "doc_id long, text string, source string")
    plan, out = mixing.mix(df), mixing.training_order(df)
    assert out.count() == plan.agg(F.sum("copies")).first()[0]
    assert out.columns == ["doc_id", "text", "source", "__position"]
    assert mixing.mix(df.limit(0)).count() == 0


def test_a_long_document_does_not_shut_out_the_rest(spark):
    rows = [(i, " ".join(["w"] * (5000 if i % 40 == 0 else i * 7 % 90 + 1)), "abcd"[i % 4]) for i in range(800)]
    df = spark.createDataFrame(rows, "doc_id long, text string, source string")
    got = mixing.mix(df).collect()
    assert len(got) == len(rows)
    taken, size, target, least, by_id = defaultdict(int), defaultdict(int), {}, {}, {d: (len(t.split()), s) for d, t, s in rows}
    for r in got:
        n, s = by_id[r.doc_id]
        taken[s] += r.taken
        size[s] += n
        target[s] = r.target
        least[s] = min(least.get(s, r.copies), r.copies)
    for s, t in targets(size).items():
        assert target[s] == pytest.approx(t)
        untaken = [by_id[r.doc_id][0] for r in got if by_id[r.doc_id][1] == s and r.copies == int(t // size[s])]
        off = t - taken[s]
        assert all(abs(off - x) >= abs(off) - 1e-6 for x in untaken), (s, off)
        assert abs(off) <= 1, (s, t, taken[s])
    again = mixing.mix(df).collect()
    assert sorted(map(str, got)) == sorted(map(str, again))
