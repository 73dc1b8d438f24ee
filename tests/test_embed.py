"""Embeddings: each distinct value reaches the model once, models are loaded once per worker."""
import os
import uuid

import numpy as np
import pytest
from pyspark.sql import functions as F

from campaign_engine.operators import embed


def logged(folder):
    """A model that leaves a file per call naming what it saw."""
    folder = str(folder)

    def model(texts):
        with open(os.path.join(folder, uuid.uuid4().hex), "w") as f:
            f.write("\n".join(texts))
        return [[float(len(t)), 1.0] for t in texts]
    return model


def seen(folder):
    return sorted(x for name in os.listdir(folder) for x in (folder / name).read_text().split("\n"))


def rows(spark, n=500, distinct=50):
    return spark.createDataFrame([(i, f"text {i % distinct}") for i in range(n)], "id long, t string")


@pytest.mark.parametrize("strict", [True, False])
def test_a_callable_sees_each_distinct_value_once(spark, tmp_path, strict):
    out = embed.embed_distinct(rows(spark), "t", logged(tmp_path), strict=strict)
    assert out.where(F.col("t_embedding")[0] == F.length("t")).count() == 500
    out.count()
    assert seen(tmp_path) == sorted(f"text {i}" for i in range(50))


def test_the_memo_runs_the_model_for_unseen_values_only(spark, tmp_path):
    calls = tmp_path / "calls"
    calls.mkdir()
    memo = embed.EmbeddingMemo(str(tmp_path / "memo"), logged(calls))
    memo.add(spark.createDataFrame([(f"text {i}", [-1.0, float(i)]) for i in range(30)], embed.VECTORS))
    df = rows(spark).withColumn("t", F.when(F.col("id") == 7, F.lit(None)).otherwise(F.col("t")))
    out = {r.t: r.t_embedding for r in embed.embed_distinct(df, "t", memo).select("t", "t_embedding").collect()}
    assert out["text 3"] == [-1.0, 3.0] and out["text 40"] == [7.0, 1.0] and out[None] == [0.0, 1.0]
    assert seen(calls) == sorted(["", *(f"text {i}" for i in range(30, 50))])
    again = embed.EmbeddingMemo(memo.path, logged(calls))
    assert embed.embed_distinct(df, "t", again).count() == 500
    assert len(seen(calls)) == 21 and again.known(spark).count() == 51
    with pytest.raises(ValueError, match="no embedding for value 'new'"):
        embed.embed_distinct(spark.createDataFrame([("new",)], "t string"), "t", embed.EmbeddingMemo(memo.path))


def test_two_jobs_may_add_the_same_value(spark, tmp_path):
    memo = embed.EmbeddingMemo(str(tmp_path / "memo"))
    for x in (2.0, 1.0):
        memo.add(spark.createDataFrame([("a", [x])], embed.VECTORS))
    out = embed.embed_distinct(spark.createDataFrame([("a",)] * 3, "t string"), "t", memo)
    assert [r.t_embedding for r in out.collect()] == [[1.0]] * 3


def test_a_batch_model_is_loaded_once_per_worker(spark, tmp_path):
    folder = str(tmp_path)

    def load():
        with open(os.path.join(folder, uuid.uuid4().hex), "w") as f:
            f.write(str(os.getpid()))
        return lambda texts: np.array([[float(len(t))] for t in texts])

    out = embed.embed_distinct(rows(spark, 3000, 1000), "t", embed.BatchModel(load, batch_size=16))
    assert out.where(F.col("t_embedding")[0] == F.length("t")).count() == 3000
    loads = [p.read_text() for p in tmp_path.iterdir()]
    assert len(loads) == len(set(loads)) <= 8  # far fewer than the 63 batches


def test_hashing_model_equals_the_plain_function(spark):
    df = spark.createDataFrame([("Large Plated TIN",), ("",), (None,), ("a a b",)], "t string")
    a, b = (embed.embed_distinct(df, "t", e).orderBy("t").collect() for e in (embed.hashing_embedder(8), embed.hashing_model(8)))
    assert a == b


def test_a_small_map_is_planned_as_a_broadcast(spark):
    from pyspark.sql import functions as F

    from campaign_engine.operators.embed import embed_distinct

    rows = spark.range(100_000).select("id", F.concat(F.lit("k"), F.col("id") % 3).alias("text"))
    vectors = spark.createDataFrame([(f"k{i}", [float(i), 1.0]) for i in range(3)], "value string, embedding array<double>")
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "20000")
    try:
        out = embed_distinct(rows, "text", vectors)
        plan = out._jdf.queryExecution().sparkPlan().toString()
        assert "BroadcastHashJoin" in plan and "SortMergeJoin" not in plan  # before any stage has run
        assert out.where(F.col("text_embedding")[0] == F.col("id") % 3).count() == 100_000
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)
