"""Merged profiles stay within their stated error."""
import pytest
from pyspark.sql import functions as F

from campaign_engine.operators import sketches as S


def table(spark, n=60000):
    return spark.range(n).select(
        ((F.col("id") * 7919) % 10007).cast("double").alias("x"), F.concat(F.lit("v"), F.col("id") % 20000).alias("t"),
        F.when(F.col("id") % 10 == 0, float("nan")).when(F.col("id") % 10 == 1, None).otherwise(F.col("id").cast("double")).alias("gaps"),
        F.lit(None).cast("int").alias("none"))


def test_merged_halves(spark, tmp_path):
    df = table(spark)
    for uid, part in (("a", df.where("gaps IS NULL OR x < 3000")), ("b", df.where("NOT (gaps IS NULL OR x < 3000)"))):
        S.save_profile(part, str(tmp_path), uid)
    merged = S.merge(S.load_profiles(spark, str(tmp_path)))
    got = {r.column: r for r in S.estimates(merged, [0.0, 0.1, 0.5, 0.9, 1.0]).collect()}
    assert {c: (got[c].n, got[c].n_missing) for c in got} == {"x": (60000, 0), "t": (60000, 0), "gaps": (60000, 12000), "none": (60000, 60000)}
    for c, exact in (("x", 10007), ("t", 20000), ("gaps", 48000)):
        assert abs(got[c].n_unique - exact) <= 3 * S.distinct_error() * exact
    ranks = df.select("x").orderBy("x").toPandas()["x"].to_numpy()
    for p, v in zip([0.1, 0.5, 0.9], got["x"].quantiles[1:4]):
        assert abs((ranks <= v).mean() - p) <= 2 * S.rank_error()
    assert (got["x"].lo, got["x"].hi) == (0.0, 10006.0) and got["t"].quantiles is None and got["none"].quantiles is None
    assert got["gaps"].missing_pct == pytest.approx(20)
    assert S.load_profiles(spark, str(tmp_path), ["a"]).select("uid").distinct().count() == 1


def test_merging_in_any_grouping(spark):
    df = table(spark, 5000).withColumn("g", F.col("x") % 4)
    parts = [S.profile(df.where(F.col("g") == g), ["x"]) for g in range(4)]
    a = S.merge(S.merge(parts[0].unionByName(parts[1])).unionByName(S.merge(parts[2].unionByName(parts[3]))))
    b = S.merge(parts[3].unionByName(parts[0]).unionByName(parts[2]).unionByName(parts[1]))
    a, b = (S.estimates(m, [0.5]).first() for m in (a, b))
    assert a.n == b.n == 5000 and a.n_unique == b.n_unique and abs(a.quantiles[0] - b.quantiles[0]) <= 10007 * 2 * S.rank_error()
    assert S.profile(df.limit(0), ["x"]).first()["n"] == 0
