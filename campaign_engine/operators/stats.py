"""Grouped statistics: frequency tables, named statistic per group, mean and
median per variable (long form), configuration usage, CPC records."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.aggregates import resolve
from ..schema import require_columns
from .quantiles import group_quantiles


def _keys(groupby) -> list[str]:
    return [groupby] if isinstance(groupby, str) else list(groupby)


def _drop_null_keys(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    for k in keys:
        df = df.where(F.col(k).isNotNull())
    return df


def freq_table(df: DataFrame, variable: str, count_col: str = "count") -> DataFrame:
    """Count per non-null value (map-side combined), most frequent first."""
    require_columns(df, [variable], "its frequency")
    return (df.where(F.col(variable).isNotNull())
              .groupBy(variable).agg(F.count(F.lit(1)).alias(count_col))
              .orderBy(F.desc(count_col), F.asc(variable)))


def group_stat(df: DataFrame, target: str, groupby, stat="mean",
               out: str | None = None, order_by: str | None = None,
               approximate: bool = False) -> DataFrame:
    """One named statistic of ``target`` per group; null keys dropped, null
    targets skipped. Order statistics (median, quantile) are exact and
    distributed (see ``quantiles``) unless ``approximate``. ``first``/``last``
    follow ``order_by`` (Spark rows have no inherent order; without it they
    are whatever row comes first)."""
    keys = _keys(groupby)
    require_columns(df, keys + [target] + ([order_by] if order_by else []), "group statistics")
    out = out or target
    if stat in ("first", "last") and order_by:
        pick = F.min_by if stat == "first" else F.max_by
        base = _drop_null_keys(df, keys).where(F.col(target).isNotNull())
        return base.groupBy(*keys).agg(pick(F.col(target), F.col(order_by)).alias(out))
    agg = resolve(stat)
    if isinstance(agg, float):
        return group_quantiles(df, keys, target, {out: agg}, approximate=approximate)
    return (_drop_null_keys(df, keys).groupBy(*keys)
            .agg(agg(F.col(target)).alias(out)))


def group_stats(df: DataFrame, target: str, groupby, stats: Sequence[str]) -> DataFrame:
    """Several named statistics at once: plain aggregates share one pass, order
    statistics one refinement; result is one row per group."""
    keys = _keys(groupby)
    require_columns(df, keys + [target], "group statistics")
    plain = {s: resolve(s) for s in stats}
    aggs = [f(F.col(target)).alias(s) for s, f in plain.items() if not isinstance(f, float)]
    probs = {s: p for s, p in plain.items() if isinstance(p, float)}
    base = _drop_null_keys(df, keys)
    res = base.groupBy(*keys).agg(*aggs) if aggs else base.select(*keys).distinct()
    if probs:
        res = res.join(group_quantiles(df, keys, target, probs), keys, "left")
    return res.select(*keys, *stats)


def cpa_per_variable(df: DataFrame, variable: str, target: str = "CPA") -> DataFrame:
    """Mean and median of ``target`` per value of ``variable``, melted to
    ``(variable, CPA_Statistics_type, statistics_value)``, highest mean first."""
    require_columns(df, [variable, target], "CPA statistics")
    wide = group_stats(df, target, variable, ["mean", "median"]).withColumn("_order", F.col("mean"))
    long = wide.unpivot([variable, "_order"], ["mean", "median"], "CPA_Statistics_type", "statistics_value")
    return long.orderBy(F.desc_nulls_last("_order"), variable).drop("_order")


def config_usage(df: DataFrame, keys: Sequence[str] = ("market_id", "publisher"),
                 count_of: str = "campaign_id", out: str = "n_campaigns") -> DataFrame:
    """Number of campaigns per configuration, most used first."""
    keys = list(keys)
    require_columns(df, keys + [count_of], "configuration usage")
    return (_drop_null_keys(df, keys).groupBy(*keys)
              .agg(F.count(count_of).alias(out))
              .orderBy(F.desc(out), *keys))


def cpc_record(df: DataFrame, stat: str = "median", cpc_col: str = "CPC",
               keys: Sequence[str] = ("market_id", "publisher")) -> DataFrame:
    """CPC statistic per (market, publisher): the imputation lookup table."""
    return group_stat(df, cpc_col, list(keys), stat, out=cpc_col)
