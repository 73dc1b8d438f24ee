"""Column profiling: distinct counts, missing percentages, distinct values,
Freedman-Diaconis histograms, linear trends and seeded sample requests."""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.hashing import seeded_md5
from ..schema import require_columns
from .quantiles import global_quantiles


def n_unique(df: DataFrame, columns: Sequence[str] | None = None,
             approximate: bool = False, rsd: float = 0.01) -> DataFrame:
    """Distinct non-null count of each column, in one pass, long form
    ``(variable, n_unique)``. ``approximate`` switches to HyperLogLog++."""
    cols = list(columns or df.columns)
    require_columns(df, cols, "distinct counts")
    f = (lambda c: F.approx_count_distinct(c, rsd)) if approximate else F.count_distinct
    wide = df.agg(*[f(F.col(c)).cast("bigint").alias(c) for c in cols])
    return wide.unpivot([], cols, "variable", "n_unique")


def missing_pct(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """Percentage of missing values per column (2 decimals), one pass,
    long form ``(variable, missing_pct)``."""
    cols = list(columns or df.columns)
    require_columns(df, cols, "missing-data percentages")
    pct = [100.0 * F.avg(F.col(c).isNull().cast("double")) for c in cols]
    wide = df.agg(*[(F.floor(p * 100 + 0.5) / 100).alias(c) for c, p in zip(cols, pct)])
    return wide.unpivot([], cols, "variable", "missing_pct")


def distinct_values(df: DataFrame, column: str) -> DataFrame:
    """Unique values of a column (a missing value counts as one value)."""
    require_columns(df, [column], "unique values")
    return df.select(column).distinct()


def fd_bins(n: int, q1: float | None, q3: float | None, lo: float | None,
            hi: float | None, method: str = "freedman-diaconis") -> int:
    """Bin count: Freedman-Diaconis width h = 2 IQR / n^(1/3); h <= 0 (or any
    other method) gives 30; otherwise (max-min)/h rounded to one decimal and
    then up to a whole number of bins."""
    if method.lower() != "freedman-diaconis" or not n:
        return 30
    h = 2.0 * (q3 - q1) / (n ** (1.0 / 3.0))
    if h <= 0:
        return 30
    # one decimal, half up by IEEE arithmetic (engine-independent), then up
    return max(1, int(math.ceil(math.floor((hi - lo) / h * 10 + 0.5) / 10)))


def fd_histogram(df: DataFrame, column: str, method: str = "freedman-diaconis") -> DataFrame:
    """Equal-width histogram over [min, max] (last bin closed) of the non-null
    values, bin count by the Freedman-Diaconis rule. Returns
    ``(bin, bin_lo, bin_hi, n)`` for the non-empty bins."""
    require_columns(df, [column], "a histogram")
    vals = df.where(F.col(column).isNotNull()).select(F.col(column).cast("double").alias("_x"))
    summary = vals.agg(F.count("_x").alias("n"), F.min("_x").alias("lo"),
                       F.max("_x").alias("hi")).first()
    n, lo, hi = summary["n"], summary["lo"], summary["hi"]
    if not n:
        return vals.sparkSession.createDataFrame(
            [], "bin bigint, bin_lo double, bin_hi double, n bigint")
    q = global_quantiles(vals, "_x", {"q1": 0.25, "q3": 0.75})
    nb = fd_bins(n, q["q1"], q["q3"], lo, hi, method)
    width = (hi - lo) / nb if hi > lo else 1.0
    b = F.least(F.floor((F.col("_x") - F.lit(lo)) / F.lit(width)).cast("bigint"), F.lit(nb - 1))
    return (vals.groupBy(b.alias("bin")).agg(F.count(F.lit(1)).alias("n"))
                .select("bin", (F.lit(lo) + F.col("bin") * F.lit(width)).alias("bin_lo"),
                        (F.lit(lo) + (F.col("bin") + 1) * F.lit(width)).alias("bin_hi"), "n"))


def linear_trend(df: DataFrame, x: str, y: str, groupby: Sequence[str] = ()) -> DataFrame:
    """Least-squares line of y on x (the scatter smoother): slope, intercept,
    r2 and the number of complete pairs, optionally per group."""
    require_columns(df, [x, y, *groupby], "a linear trend")
    aggs = [F.regr_slope(F.col(y), F.col(x)).alias("slope"),
            F.regr_intercept(F.col(y), F.col(x)).alias("intercept"),
            F.regr_r2(F.col(y), F.col(x)).alias("r2"),
            F.regr_count(F.col(y), F.col(x)).alias("n")]
    if groupby:
        base = df
        for g in groupby:
            base = base.where(F.col(g).isNotNull())
        return base.groupBy(*groupby).agg(*aggs)
    return df.agg(*aggs)


def sample_request(df: DataFrame, columns: Sequence[str], seed: int = 2025) -> DataFrame:
    """One pseudo-random known value per column: among the distinct non-null
    values, the one with the smallest ``md5(seed|value)``. Deterministic, one
    pass (unpivot -> distinct -> min_by), nothing but the answer leaves Spark."""
    cols = list(columns)
    require_columns(df, cols, "a sample request")
    long = (df.select(*[F.col(c).cast("string").alias(c) for c in cols])
              .unpivot([], cols, "variable", "value")
              .where(F.col("value").isNotNull()).distinct())
    h = seeded_md5(["value"], seed)
    return long.groupBy("variable").agg(F.min_by("value", h).alias("value"))
