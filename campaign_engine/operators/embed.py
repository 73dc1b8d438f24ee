"""Text -> vector embedding, computed once per *distinct* value.

The embedder is a plug point: a lookup DataFrame ``(value, embedding)``, a
Python function ``pandas.Series[str] -> list of vectors``, a ``BatchModel`` (loaded once
per Python worker, called with batches), or an ``EmbeddingMemo``: a written
table of known vectors plus a model for the values it lacks. The distinct values are
written first, and vectors are computed from that table into another, so a model never
sees a row twice, whatever the planner does with later filters. The result is joined back to the
rows; AQE broadcasts the distinct table when its measured size is under the
broadcast threshold, else it stays a sort-merge join.
"""

from __future__ import annotations

import os
from collections.abc import Callable
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.errors import AnalysisException
from pyspark.ml.functions import predict_batch_udf
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..schema import require_columns
from ..session import materialize, settle, ship_package
from .ranks import global_rank

VECTORS = T.StructType([T.StructField("value", T.StringType()),
                        T.StructField("embedding", T.ArrayType(T.DoubleType()))])


@dataclass
class BatchModel:
    """A model behind a loader: ``load()`` returns a function from an array of texts to a
    matrix (a row per text). It is called once per Python worker and kept there."""
    load: Callable[[], Callable[[np.ndarray], np.ndarray]]
    batch_size: int = 256


@dataclass
class EmbeddingMemo:
    """Known vectors of ``path`` (Parquet: value, embedding) and a model for the others. The model
    runs only on values that the table lacks; their vectors are appended to it, so the
    next job finds them. Without a model, a missing value is missing.

    Appends of two jobs at once may both add a value; readers take one vector per value (the
    smallest), so the result stays one row per value.
    """
    path: str
    model: Callable | BatchModel | None = None

    def known(self, spark: SparkSession) -> DataFrame:
        try:
            table = spark.read.schema(VECTORS).parquet(self.path)
        except AnalysisException as e:
            if e.getCondition() != "PATH_NOT_FOUND":
                raise
            return spark.createDataFrame([], VECTORS)
        return table.groupBy("value").agg(F.min("embedding").alias("embedding"))

    def add(self, vectors: DataFrame) -> None:
        """Add (value, embedding) rows, such as a map that exists already."""
        vectors.select(F.col("value").cast("string").alias("value"),
                       F.transform("embedding", lambda x: x.cast("double")).alias("embedding")) \
            .write.mode("append").parquet(self.path)

    def vectors(self, values: DataFrame) -> DataFrame:
        """(value, _e) of all ``values`` (written, distinct); unknown ones are embedded and kept."""
        spark = values.sparkSession
        if self.model is not None:
            unseen = values.join(self.known(spark), "value", "left_anti")
            if not unseen.isEmpty():
                new = _model_vectors(settle(unseen), self.model)
                self.add(new.select("value", F.col("_e").alias("embedding")))
        return values.join(self.known(spark).withColumnRenamed("embedding", "_e"), "value", "left")


def _distinct_text(df: DataFrame, column: str) -> DataFrame:
    # a missing text is embedded as the empty string
    return df.select(F.coalesce(F.col(column).cast("string"), F.lit("")).alias("value")).distinct()


def embed_distinct(df: DataFrame, column: str, embedder, out: str | None = None,
                   strict: bool = True) -> DataFrame:
    """Add ``out`` (default ``<column>_embedding``, ``array<double>``). A value
    without a vector raises ValueError, or gives null with ``strict=False``."""
    return with_vectors(df, column, distinct_vectors(df, column, embedder, strict), out)


def distinct_vectors(df: DataFrame, column: str, embedder, strict: bool = True) -> DataFrame:
    """(value, _e): the vectors of the distinct values of ``column``, written (see ``embed_distinct``)."""
    require_columns(df, [column], "embedding")
    values = _distinct_text(df, column)
    if isinstance(embedder, DataFrame):
        # written: else its size is not known when the rows are joined, and they are shuffled by the text
        table = settle(values.join(
            embedder.select(F.col("value").cast("string").alias("value"),
                            F.transform("embedding", lambda x: x.cast("double")).alias("_e")),
            "value", "left"))
    elif isinstance(embedder, EmbeddingMemo):
        table = settle(embedder.vectors(settle(values)))
    elif callable(embedder) or isinstance(embedder, BatchModel):
        table = _model_vectors(settle(values), embedder)
    else:
        raise ValueError("embedder must be a (value, embedding) DataFrame, a callable, a BatchModel or an EmbeddingMemo")
    if strict:
        missing = table.where(F.col("_e").isNull()).limit(1).collect()
        if missing:
            raise ValueError(f"no embedding for value {missing[0]['value']!r} and no model given")
    return table


def with_vectors(df: DataFrame, column: str, vectors: DataFrame, out: str | None = None) -> DataFrame:
    """Add ``out``, the vector of ``column``, from the table of ``distinct_vectors``."""
    table = vectors.select(F.col("value").alias("__ek"), F.col("_e").alias(out or f"{column}_embedding"))
    key = F.coalesce(F.col(column).cast("string"), F.lit(""))
    return df.join(table, key == F.col("__ek"), "left").drop("__ek")


def _model_vectors(values: DataFrame, model) -> DataFrame:
    """(value, _e) of a written table of distinct values, written in its turn."""
    spark = values.sparkSession
    ship_package(spark)
    n = max(1, min(values.count() // 64 + 1, 4 * spark.sparkContext.defaultParallelism))
    values = values.repartition(n, "value")  # a model is slow: its work is spread even if the values are few
    if isinstance(model, BatchModel):
        return materialize(values.withColumn("_e", predict_batch_udf(
            model.load, return_type=T.ArrayType(T.DoubleType()), batch_size=model.batch_size)(F.col("value"))), "vectors")

    @F.pandas_udf(T.ArrayType(T.DoubleType()))
    def run(s: pd.Series) -> pd.Series:
        return pd.Series([[float(x) for x in v] for v in model(s)])

    return materialize(values.withColumn("_e", run(F.col("value"))), "vectors")


def rank_map(df: DataFrame, column: str, vectors: DataFrame, id_col: str = "vec_id",
             include_missing: bool = True) -> DataFrame:
    """Fixture embedder: the i-th distinct value in alphabetical order gets the
    vector with ``id_col = i``; the empty string (missing text) comes after the
    known values."""
    vals = df.select(F.col(column).cast("string").alias("value")).where(F.col("value").isNotNull()).distinct()
    if include_missing:
        vals = vals.where(F.col("value") != "").unionByName(df.sparkSession.createDataFrame([("",)], "value string"))
    ranked = settle(global_rank(vals, [F.col("value") == "", F.col("value")], "_i"))
    return (ranked.join(vectors.select(F.col(id_col).cast("bigint").alias("_i"), "embedding"), "_i")
                  .select("value", "embedding"))


def hashing_embedder(dim: int = 64) -> Callable[[pd.Series], list]:
    """Deterministic model-free embedder: signed feature hashing of lower-case
    blank-separated tokens (place: the first 8 hex digits of the token's md5, sign: the ninth),
    L2-normalised (stands in for a pretrained text model)."""
    import hashlib

    def embed(s) -> list:
        out = []
        for text in s:
            v = np.zeros(dim)
            for tok in ("" if text is None else str(text)).lower().split():
                h = hashlib.md5(tok.encode()).hexdigest()
                v[int(h[:8], 16) % dim] += 1.0 if h[8] < "8" else -1.0
            nrm = np.linalg.norm(v)
            out.append(v / nrm if nrm else v)
        return out
    return embed


def hashing_model(dim: int = 64, batch_size: int = 256) -> BatchModel:
    """``hashing_embedder`` behind a loader, as a large model would be plugged in."""
    return BatchModel(lambda: lambda texts: np.array(hashing_embedder(dim)(texts)).reshape(len(texts), dim), batch_size)
