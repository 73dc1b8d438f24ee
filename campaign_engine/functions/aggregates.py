"""Aggregate-by-name registry (the pluggable statistic of group stats).

Each entry maps a pandas-style statistic name to a builder returning a Spark
aggregate Column. Exact order statistics (median, quantile) are not plain
aggregates here -- they go through the distributed k-th value operator, so a
hot group never has to be held by one task; they are flagged ``ORDER_STATS``.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F


def _skew(c: Column) -> Column:
    # pandas skew is the bias-corrected sample skewness; Spark's is population.
    n = F.count(c).cast("double")
    return F.when(n > 2, F.skewness(c) * F.sqrt(n * (n - 1)) / (n - 2))


def _sem(c: Column) -> Column:
    return F.stddev_samp(c) / F.sqrt(F.count(c).cast("double"))


AGGREGATES: dict[str, Callable[[Column], Column]] = {
    "mean": F.avg,
    "count": F.count,
    "sum": F.sum,
    "min": F.min,
    "max": F.max,
    "std": F.stddev_samp,
    "var": F.var_samp,
    "nunique": F.count_distinct,
    "first": F.first,
    "last": F.last,
    "size": lambda c: F.count(F.lit(1)),
    "sem": _sem,
    "prod": F.product,
    "skew": _skew,
}

ORDER_STATS = {"median": 0.5}


def resolve(stat) -> Callable[[Column], Column] | float:
    """Name -> aggregate builder, or the probability of an order statistic.

    A callable ``Column -> Column`` is accepted as-is. Unknown names raise.
    """
    if callable(stat):
        return stat
    if stat in AGGREGATES:
        return AGGREGATES[stat]
    if stat in ORDER_STATS:
        return ORDER_STATS[stat]
    if isinstance(stat, str) and stat.startswith("quantile"):
        # "quantile" (0.5) or "quantile:0.9"
        return float(stat.split(":", 1)[1]) if ":" in stat else 0.5
    raise ValueError(f"Unknown statistic {stat!r}; known: "
                     f"{sorted(AGGREGATES) + sorted(ORDER_STATS) + ['quantile[:p]']}")
