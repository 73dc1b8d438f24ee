import hashlib
import zlib
from collections import Counter, defaultdict

from pyspark.sql import functions as F

from campaign_engine.llm import sharding


def ref_jump(key, n):
    key %= 1 << 64
    b, j = -1, 0
    while j < n:
        b, key = j, (key * 2862933555777941757 + 1) % (1 << 64)
        j = int((b + 1) * (float(1 << 31) / float((key >> 33) + 1)))
    return b


def test_jump_matches_published_sequence(spark):
    for n in (1, 2, 8, 64, 65, 1000):
        for r in spark.range(-40, 400, 7).select("id", sharding.jump("id", n).alias("x")).collect():
            assert r.x.b == ref_jump(r.id, n)


def test_growing_moves_rows_only_into_the_new_shard(spark):
    rows = spark.range(5000).select("id", sharding.jump("id", 8).alias("a"), sharding.jump("id", 9).alias("b")).collect()
    assert all(r.a.b == r.b.b or r.b.b == 8 for r in rows)
    assert 5000 / 9 * 0.7 < sum(r.b.b == 8 for r in rows) < 5000 / 9 * 1.3


def test_slots_nulls_repeats_and_extra_columns(spark):
    rows = [(i, "t%d é" % i, 9) for i in range(60)] + [(7, "x", 1)] * 40 + [(None, None, 2)] * 3 + [(3, "", 4)]
    df = spark.createDataFrame(rows, "doc_id long, text string, shard int")
    got = sharding.assign(df, 8).collect()
    assert len(got) == len(rows)
    slots = defaultdict(list)
    for r in got:
        key = -1 if r.doc_id is None else r.doc_id
        assert (r.shard, r.grown_shard) == (ref_jump(key, 8), ref_jump(key, 9))
        slots[r.shard].append(r.slot)
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    md5 = lambda r: hashlib.md5(str(-1 if r.doc_id is None else r.doc_id).encode()).hexdigest()
    keys = {}
    for r in sorted(got, key=lambda r: (r.shard, r.slot)):  # the documented order
        k = (md5(r), -1 if r.doc_id is None else r.doc_id, r.text_crc32, r.size)
        assert keys.get(r.shard, k) <= k
        keys[r.shard] = k
    want = Counter((d, len((t or "").encode()) + 1, zlib.crc32((t or "").encode())) for d, t, _ in rows)
    assert Counter((r.doc_id, r.size, r.text_crc32) for r in got) == want
    assert sharding.assign(df.limit(0), 8).count() == 0


def test_a_hot_key_keeps_the_order_and_is_split(spark, monkeypatch):
    monkeypatch.setitem(sharding.__dict__, "BROADCAST_SHARDS", 1)
    rows = [(5, f"text {i * 7919 % 3000}") for i in range(3000)] + [(i, "x") for i in range(3000)] + [(5, "same")] * 2000
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(6)
    got = sorted((r for r in sharding.assign(df, 8, keep=["doc_id", "text"]).collect() if r.shard == ref_jump(5, 8)), key=lambda r: r.slot)
    hot = [r.text_crc32 for r in got if r.doc_id == 5]
    assert len(hot) == 5001 and hot == sorted(hot)
    ranked = sharding.global_rank(df.withColumn("r", F.monotonically_increasing_id()), [F.col("doc_id"), F.col("r")], "k")
    sizes = [r["count"] for r in ranked.groupBy((F.col("k") / 1000).cast("int").alias("g")).count().collect()]
    assert sorted(r.k for r in ranked.select("k").collect()) == list(range(8000)) and len(sizes) == 8


def test_write_shards_keeps_every_row(spark, tmp_path):
    df = spark.range(300).select(F.col("id").alias("doc_id"), F.concat(F.lit("t"), "id").alias("text"))
    out = sharding.write_shards(df, str(tmp_path / "s"), 4, max_rows_per_file=20)
    assert out.count() == 300 and out.select("doc_id", "text").distinct().count() == 300
