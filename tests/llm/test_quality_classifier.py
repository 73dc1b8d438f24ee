import numpy as np
import pytest
from pyspark.sql import functions as F

from campaign_engine.llm import quality_classifier as Q
from tests.conftest import SF001


def brute_sites(rows):
    """rows: (host, path, good) -> rates per (host, path) by the documented formulas."""
    import collections
    pn, pk, hn, hk = (collections.Counter() for _ in range(4))
    for h, p, g in rows:
        pn[h, p] += 1
        pk[h, p] += g
        hn[h] += 1
        hk[h] += g
    n, m = len(rows), sum(g for *_, g in rows) / len(rows)
    rho = lambda a, k: min(1 - 1e-6, max(1e-6, (a - k) / (n - k)))
    s = 1 / rho(sum(hn[h] * (hk[h] / hn[h] - m) ** 2 for h in hn) / (m * (1 - m)), len(hn)) - 1
    hr = {h: (hk[h] + s * m) / (hn[h] + s) for h in hn}
    a2 = sum(pn[x] * (pk[x] / pn[x] - hr[x[0]]) ** 2 / (hr[x[0]] * (1 - hr[x[0]])) for x in pn)
    s2 = 1 / rho(a2, len(pn)) - 1
    return {x: (hr[x[0]], (pk[x] + s2 * hr[x[0]]) / (pn[x] + s2)) for x in pn}


def test_site_posteriors_against_brute_force(spark):
    rng = np.random.default_rng(0)
    rows = []
    for h in range(12):
        rate = rng.uniform(0.1, 0.9)
        for p in range(3):
            for _ in range(int(rng.integers(1, 40))):
                rows.append((f"h{h}" if h else None, f"p{p}", float(rng.random() < rate)))
    df = spark.createDataFrame(rows, "host string, path string, good double")
    got = {(r.host, r.path): (r.host_rate, r.path_rate) for r in Q.site_posteriors(df).collect()}
    want = brute_sites(rows)
    assert set(got) == set(want)
    for k in want:
        assert got[k] == pytest.approx(want[k], rel=1e-6)


def test_sparse_sites_shrink_to_the_global_rate(spark):
    rows = [("big", "a", 0.0)] * 500 + [("good", "a", 1.0)] * 500 + [("tiny", "a", 1.0)]
    got = {r.host: r for r in Q.site_posteriors(
        spark.createDataFrame(rows, "host string, path string, good double")).collect()}
    assert got["big"].path_rate < 0.05 and got["good"].path_rate > 0.95
    assert got["tiny"].host_rate < got["good"].host_rate


def test_held_out_accuracy_and_odd_rows(spark):
    docs, labels = (spark.read.parquet(f"{SF001.replace('0.001', '0.01')}/{t}.parquet") for t in ("documents", "labels"))
    model = Q.train(docs, labels)
    assert model.metrics["accuracy"] > 0.85
    extra = docs.limit(3).select("doc_id", "text", "lang", "source", F.lit("x").alias("evidence"), F.lit(1).alias("host"))
    odd = spark.createDataFrame([(None, None, None, None, "x", 1), (5, "", "en", "s", "x", 1), (5, "", "en", "s", "x", 1),
                                 (6, "w " * 50_000, "en", None, "x", 1)], extra.schema)
    both = extra.union(odd)
    out = Q.classify(both, model)
    rows = out.collect()
    assert len(rows) == 7 and out.columns == [*both.columns, "__quality"]
    assert all(0 <= r["__quality"].posterior <= 1 for r in rows)
    assert Q.classify(both.limit(0), model).count() == 0
    none = Q.train(docs, labels.limit(0))
    assert Q.classify(both, none).count() == 7


def test_url_levels(spark):
    rows = [("http://A.example.com:80/x/y?q", "a.example.com", "/x"), ("https://b.org", "b.org", ""), (None, "", ""), ("junk", "", "")]
    got = spark.createDataFrame(rows, "u string, h string, p string").select(
        "h", "p", Q.url_host(F.col("u")).alias("a"), Q.url_path(F.col("u")).alias("b")).collect()
    assert all((r.h, r.p) == (r.a, r.b) for r in got)


def test_a_repeated_labelled_key_is_one_row(spark, monkeypatch):
    docs = [(i, ("good calm words here " if i % 2 else "BAD ### !! $$$ ") * (i % 7 + 1), "en", "s") for i in range(200)]
    labels = spark.createDataFrame([(i, i % 2, 0) for i in range(200)], "doc_id long, quality int, toxic int")
    rows, fit = [], Q._fit

    def counted(x, y, *a):
        rows.append(len(x))
        return fit(x, y, *a)

    monkeypatch.setattr(Q, "_fit", counted)
    schema = "doc_id long, text string, lang string, source string"
    one = Q.train(spark.createDataFrame(docs, schema), labels, max_rows=100)
    many = Q.train(spark.createDataFrame(docs + [d for d in docs if d[0] < 60] * 20, schema), labels, max_rows=100)
    other = Q.train(spark.createDataFrame(docs + [(i % 60, f"text {i}", "en", "s") for i in range(2000)], schema),
                    labels, max_rows=100)
    assert rows[0] == rows[1] == rows[2] <= 100
    assert one.terms == many.terms and np.allclose(one.weights, many.weights) and other.metrics["held_out"] <= 100
