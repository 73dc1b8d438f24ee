"""Column profiles that merge: counts, distinct and quantile sketches stored per
dataset, so that a profile of many datasets needs no second scan of any.

The exact profiles (``profile``) stay the default; these trade a stated error for a
few kilobytes per column and dataset. Distinct counts come from HyperLogLog
sketches, quantiles from KLL sketches, both mergeable in any order and grouping.
"""

from __future__ import annotations

import math
import os
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..schema import require_columns

LOG_K, KLL_K = 12, 800


def distinct_error(log_k: int = LOG_K) -> float:
    """Relative standard error of a distinct count (three of them are practically never passed)."""
    return 1.04 / math.sqrt(1 << log_k)


def rank_error(k: int = KLL_K) -> float:
    """Error of a quantile's rank, as a share of all values, that 99 of 100 sketches keep."""
    return 2.296 / k ** 0.9021


def profile(df: DataFrame, columns: Sequence[str] | None = None, log_k: int = LOG_K, k: int = KLL_K) -> DataFrame:
    """One row per column: ``column``, ``n`` (rows), ``n_missing`` (null or NaN), ``lo``, ``hi`` (numbers), ``distinct``
    (HyperLogLog sketch of the values as text) and ``quantiles`` (KLL sketch of a number's values, else null).
    One aggregation over all columns; every sketch is of bounded size."""
    columns = list(columns or df.columns)
    require_columns(df, columns, "a profile")
    kinds = {f.name: f.dataType for f in df.schema.fields}
    parts = []
    for i, c in enumerate(columns):
        col = F.col(c)
        number = isinstance(kinds[c], T.NumericType)
        missing = col.isNull() | (F.isnan(col) if isinstance(kinds[c], (T.FloatType, T.DoubleType)) else F.lit(False))
        known = F.when(~missing, col)
        x = known.cast("double") if number else F.lit(None).cast("double")
        parts += [F.count(F.when(missing, 1)).alias(f"m{i}"), F.min(x).alias(f"lo{i}"), F.max(x).alias(f"hi{i}"),
                  F.hll_sketch_agg(known.cast("string"), log_k).alias(f"d{i}")]
        parts.append((F.kll_sketch_agg_double(x, k) if number else F.max(F.lit(None).cast("binary"))).alias(f"q{i}"))
    one = df.agg(F.count(F.lit(1)).alias("n"), *parts)
    rows = F.array(*[F.struct(F.lit(c).alias("column"), F.col("n"), F.col(f"m{i}").alias("n_missing"),
                              F.col(f"lo{i}").alias("lo"), F.col(f"hi{i}").alias("hi"), F.col(f"d{i}").alias("distinct"),
                              F.col(f"q{i}").alias("quantiles")) for i, c in enumerate(columns)])
    return one.select(F.explode(rows).alias("_r")).select("_r.*")


def merge(profiles: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """One profile out of many rows of ``profile`` (unioned, or read from several datasets), per
    column and the columns ``by``."""
    return profiles.groupBy(*by, "column").agg(
        F.sum("n").alias("n"), F.sum("n_missing").alias("n_missing"), F.min("lo").alias("lo"), F.max("hi").alias("hi"),
        F.hll_union_agg("distinct").alias("distinct"), F.kll_merge_agg_double("quantiles").alias("quantiles"))


def estimates(profiles: DataFrame, ranks: Sequence[float] = (0.25, 0.5, 0.75)) -> DataFrame:
    """What the sketches say: ``n_unique`` (estimate), ``missing_pct`` and ``quantiles`` (values at
    ``ranks``; null for text and for columns without a value)."""
    held = F.col("quantiles").isNotNull() & (F.col("n") > F.col("n_missing")) & F.col("lo").isNotNull()
    at = F.array(*[F.when(held, F.kll_sketch_get_quantile_double("quantiles", F.lit(float(p)))) for p in ranks])
    keep = [c for c in profiles.columns if c not in ("distinct", "quantiles")]
    return profiles.select(*keep, F.hll_sketch_estimate("distinct").alias("n_unique"),
                           (100 * F.try_divide("n_missing", "n")).alias("missing_pct"),
                           F.when(held, at).alias("quantiles"))


def save_profile(df: DataFrame, root: str, uid: str, columns: Sequence[str] | None = None) -> None:
    """Store the profile of dataset ``uid`` beside the registry (a few kilobytes a column)."""
    profile(df, columns).coalesce(1).write.mode("overwrite").parquet(
        os.path.join(root, "_profiles", f"uid={uid}"))


def load_profiles(spark: SparkSession, root: str, uids: Sequence[str] | None = None) -> DataFrame:
    """Stored profiles of all datasets, or of ``uids`` (a partition filter)."""
    out = spark.read.parquet(os.path.join(root, "_profiles"))
    return out.where(F.col("uid").isin(list(uids))) if uids else out
