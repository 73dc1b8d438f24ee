"""Split and fold properties: sizes, disjointness, stratified proportions."""
import math

from pyspark.sql import functions as F

from campaign_engine.operators import splits


def _df(spark, n=1003):
    return spark.createDataFrame([(f"k{i}", i % 4 == 0) for i in range(n)], "key string, y boolean") \
                .withColumn("y", F.col("y").cast("int"))


def test_shuffled_split_sizes_and_determinism(spark):
    df = _df(spark)
    a = splits.split_shuffled(df, ["key"], 0.2, 2025)
    counts = {r["split_type"]: r["count"] for r in a.groupBy("split_type").count().collect()}
    assert counts["test"] == math.ceil(0.2 * 1003) and counts["train"] + counts["test"] == 1003
    b = splits.split_shuffled(df, ["key"], 0.2, 2025)
    assert sorted(a.collect()) == sorted(b.collect())


def test_stratified_split_keeps_proportions(spark):
    df = _df(spark)
    t = splits.split_stratified(df, ["key"], "y", 0.2, 2025)
    per = {(r["y"], r["split_type"]): r["count"] for r in t.groupBy("y", "split_type").count().collect()}
    n_test = math.ceil(0.2 * 1003)
    assert per[(0, "test")] + per[(1, "test")] == n_test
    for c in (0, 1):
        n_c = per[(c, "test")] + per[(c, "train")]
        assert abs(per[(c, "test")] - n_test * n_c / 1003) <= 1


def test_stratify_without_shuffle_is_an_error(spark):
    import pytest
    with pytest.raises(RuntimeError):
        splits.split_stratified(_df(spark), ["key"], "y", shuffle=False)


def test_ordered_split_takes_last_rows(spark):
    df = _df(spark, 200)
    t = splits.split_ordered(df, ["key"], 0.25)
    test_keys = sorted(r["key"] for r in t.where(F.col("split_type") == "test").collect())
    assert test_keys == sorted(f"k{i}" for i in range(200))[-50:]


def test_stratified_folds_balanced(spark):
    df = _df(spark)
    f = splits.cv_folds_stratified(df, ["key"], "y", 5, 2025)
    per = f.groupBy("y", "fold").count().collect()
    for c in (0, 1):
        sizes = [r["count"] for r in per if r["y"] == c]
        assert max(sizes) - min(sizes) <= 1 and len(sizes) == 5


def test_contiguous_folds_sizes(spark):
    f = splits.cv_folds_contiguous(_df(spark, 103), ["key"], 5, 2025)
    sizes = sorted(r["count"] for r in f.groupBy("fold").count().collect())
    assert sizes == [20, 20, 21, 21, 21]
