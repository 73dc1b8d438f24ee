"""Derived cost metrics: CPA, CPC, conversion flag, log target and inverse."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.nulls import eq0, ne0, null_safe_div
from ..schema import CONVERSIONS, require_columns
from .quantiles import median


def cpa_provisional(cost: str = "cost", conversions: str = CONVERSIONS) -> Column:
    """CPA before the zero/zero rows are filled: cost when nothing converted,
    cost/conversions when both are non-zero, 0 otherwise (incl. zero/zero)."""
    c, v = F.col(cost), F.col(conversions)
    return (F.when(ne0(c) & eq0(v), c.cast("double"))
             .when(ne0(c) & ne0(v), null_safe_div(c, v))
             .otherwise(F.lit(0.0)))


def compute_cpa(df: DataFrame, cpa_col: str = "CPA", cost: str = "cost",
                conversions: str = CONVERSIONS, fill_value: float | None = None) -> DataFrame:
    """Cost per application.

    Rows with zero cost and zero conversions get the median of the
    provisional column taken over the whole input frame -- including the
    provisional zeros of those very rows. ``fill_value`` reuses a median from
    another frame (e.g. the train split's) instead of computing one.
    """
    require_columns(df, [cost, conversions], "CPA calculation")
    raw = df.withColumn(cpa_col, cpa_provisional(cost, conversions))
    if fill_value is None:
        fill_value = median(raw, cpa_col)
    both_zero = eq0(cost) & eq0(conversions)
    fill = F.lit(fill_value).cast("double")
    return raw.withColumn(cpa_col, F.when(both_zero, fill).otherwise(F.col(cpa_col)))


def cpc_expr(cost: str = "cost", clicks: str = "clicks") -> Column:
    c, k = F.col(cost), F.col(clicks)
    return (F.when(eq0(k) & eq0(c), F.lit(0.0))
             .when(eq0(k), c.cast("double"))
             .otherwise(null_safe_div(c, k)))


def compute_cpc(df: DataFrame, cost: str = "cost", clicks: str = "clicks",
                cpc_col: str = "CPC") -> DataFrame:
    """Cost per click: cost/clicks; no clicks -> cost; no clicks and no cost -> 0."""
    require_columns(df, [cost, clicks], "CPC calculation")
    return df.withColumn(cpc_col, cpc_expr(cost, clicks))


def convert_flag(df: DataFrame, conversions: str = CONVERSIONS, out: str = "convert") -> DataFrame:
    """0 when conversions are exactly zero, else 1 (a missing count is 1)."""
    require_columns(df, [conversions], "the binary conversion variable")
    return df.withColumn(out, F.when(eq0(conversions), F.lit(0)).otherwise(F.lit(1)))


def log_target(df: DataFrame, col: str = "CPA", out: str = "log_CPA") -> DataFrame:
    return df.withColumn(out, F.log1p(F.col(col)))


def inverse_log(df: DataFrame, col: str, out: str) -> DataFrame:
    return df.withColumn(out, F.expm1(F.col(col)))


def derive_all(df: DataFrame, cpa_fill: float | None = None) -> DataFrame:
    """CPA (+ its median fill), CPC and the conversion flag in one projection."""
    return convert_flag(compute_cpc(compute_cpa(df, fill_value=cpa_fill)))
