"""Registered queries: derived metrics, statistics, profiling, splits."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import metrics, profile, splits, stats
from . import oracle_sql as O
from .registry import SEED, TEST, base, derived, r, register

# --------------------------------------------------------------------------- metrics


@register("compute_cpa", O.with_base("SELECT campaign_id, round(CPA, 6) AS CPA FROM derived"))
def q_compute_cpa(spark, sf):
    return metrics.compute_cpa(base(spark, sf)).select("campaign_id", r("CPA").alias("CPA"))


@register("compute_cpc", O.with_base("SELECT campaign_id, round(CPC, 6) AS CPC FROM derived"))
def q_compute_cpc(spark, sf):
    return metrics.compute_cpc(base(spark, sf)).select("campaign_id", r("CPC").alias("CPC"))


@register("convert_flag", O.with_base("SELECT campaign_id, convert FROM derived"))
def q_convert_flag(spark, sf):
    return (metrics.convert_flag(base(spark, sf))
            .select("campaign_id", F.col("convert").cast("bigint").alias("convert")))


@register("log_cpa", O.with_base(
    "SELECT campaign_id, round(ln(1 + CPA), 6) AS log_CPA, "
    "round(exp(ln(1 + CPA)) - 1, 6) AS CPA_back FROM derived"))
def q_log_cpa(spark, sf):
    d = metrics.inverse_log(metrics.log_target(derived(spark, sf)), "log_CPA", "CPA_back")
    return d.select("campaign_id", r("log_CPA").alias("log_CPA"), r("CPA_back").alias("CPA_back"))


@register("cpa_per_variable", O.with_base("""
SELECT publisher, 'mean' AS CPA_Statistics_type, round(avg(CPA), 6) AS statistics_value
FROM derived WHERE publisher IS NOT NULL GROUP BY publisher
UNION ALL
SELECT publisher, 'median', round(median(CPA), 6)
FROM derived WHERE publisher IS NOT NULL GROUP BY publisher"""))
def q_cpa_per_variable(spark, sf):
    res = stats.cpa_per_variable(derived(spark, sf), "publisher")
    return res.select("publisher", "CPA_Statistics_type",
                      r("statistics_value").alias("statistics_value"))

# --------------------------------------------------------------------------- stats


@register("freq_table", O.with_base(
    'SELECT customer_id, count(*) AS "count" FROM ads WHERE customer_id IS NOT NULL '
    "GROUP BY customer_id"))
def q_freq_table(spark, sf):
    return stats.freq_table(base(spark, sf), "customer_id")


@register("group_stat_mean", O.with_base(
    "SELECT market_id, round(avg(CPA), 6) AS CPA FROM derived "
    "WHERE market_id IS NOT NULL GROUP BY market_id"))
def q_group_stat_mean(spark, sf):
    res = stats.group_stat(derived(spark, sf), "CPA", "market_id", "mean")
    return res.select("market_id", r("CPA").alias("CPA"))


@register("group_stat_median", O.with_base(
    "SELECT publisher, round(median(CPC), 6) AS CPC FROM derived "
    "WHERE publisher IS NOT NULL GROUP BY publisher"))
def q_group_stat_median(spark, sf):
    res = stats.group_stat(derived(spark, sf), "CPC", "publisher", "median")
    return res.select("publisher", r("CPC").alias("CPC"))


_MULTI = ["count", "sum", "min", "max", "std", "var", "nunique", "sem", "skew", "median"]


@register("group_stat_multi", O.with_base("""
SELECT market_id, publisher,
       count(CPA) AS "count", round(sum(CPA), 2) AS "sum",
       round(min(CPA), 6) AS "min", round(max(CPA), 6) AS "max",
       round(ln(stddev_samp(CPA)), 8) AS std, round(ln(var_samp(CPA)), 8) AS var,
       count(DISTINCT CPA) AS nunique,
       round(stddev_samp(CPA) / sqrt(count(CPA)), 6) AS sem,
       round(skewness(CPA), 6) AS skew, round(median(CPA), 6) AS median
FROM derived WHERE market_id IS NOT NULL AND publisher IS NOT NULL
GROUP BY market_id, publisher"""))
def q_group_stat_multi(spark, sf):
    res = stats.group_stats(derived(spark, sf), "CPA", ["market_id", "publisher"], _MULTI)
    digits = {"sum": 2, "std": 8, "var": 8}
    for c in ("std", "var"):  # compared by logarithm: the same relative precision at any magnitude
        res = res.withColumn(c, F.log(c))
    return res.select(
        "market_id", "publisher",
        F.col("count").cast("bigint").alias("count"), F.col("nunique").cast("bigint").alias("nunique"),
        *[r(c, digits.get(c, 6)).alias(c) for c in _MULTI if c not in ("count", "nunique")])


@register("group_stat_order", O.with_base("""
SELECT publisher, arg_min(cost, campaign_id) FILTER (cost IS NOT NULL) AS first_cost,
       arg_max(cost, campaign_id) FILTER (cost IS NOT NULL) AS last_cost,
       round(quantile_cont(cost, 0.9), 6) AS q90, count(*) AS size,
       round(ln(product(1 + clicks / 1000.0)), 6) AS log_prod
FROM ads WHERE publisher IS NOT NULL GROUP BY publisher"""))
def q_group_stat_order(spark, sf):
    """First and last by an order column, a named quantile, group size and product."""
    b = base(spark, sf).withColumn("growth", 1 + F.col("clicks") / 1000.0)
    parts = [stats.group_stat(b, "cost", "publisher", "first", out="first_cost", order_by="campaign_id"),
             stats.group_stat(b, "cost", "publisher", "last", out="last_cost", order_by="campaign_id"),
             stats.group_stat(b, "cost", "publisher", "quantile:0.9", out="q90"),
             stats.group_stat(b, "cost", "publisher", "size", out="size"),
             stats.group_stat(b, "growth", "publisher", "prod", out="log_prod")]
    out = parts[0]
    for p in parts[1:]:
        out = out.join(p, "publisher")
    return out.select("publisher", "first_cost", "last_cost", r("q90").alias("q90"), "size",
                      r(F.log("log_prod")).alias("log_prod"))


@register("config_usage", O.with_base(
    "SELECT market_id, publisher, count(campaign_id) AS n_campaigns FROM ads "
    "WHERE market_id IS NOT NULL AND publisher IS NOT NULL GROUP BY market_id, publisher"))
def q_config_usage(spark, sf):
    return stats.config_usage(base(spark, sf))


@register("cpc_record", O.with_base(
    "SELECT market_id, publisher, round(median(CPC), 6) AS CPC FROM derived "
    "WHERE market_id IS NOT NULL AND publisher IS NOT NULL GROUP BY market_id, publisher"))
def q_cpc_record(spark, sf):
    return stats.cpc_record(derived(spark, sf)).select("market_id", "publisher", r("CPC").alias("CPC"))

# --------------------------------------------------------------------------- profile

_ADS_COLS = ["campaign_id", "category_id", "market_id", "customer_id", "publisher",
             "industry", "cost", "clicks", "converions"]


@register("n_unique", O.with_base("\nUNION ALL\n".join(
    f"SELECT '{c}' AS variable, count(DISTINCT {c}) AS n_unique FROM ads" for c in _ADS_COLS)))
def q_n_unique(spark, sf):
    return profile.n_unique(base(spark, sf), _ADS_COLS)


@register("missing_pct", O.with_base("\nUNION ALL\n".join(
    f"SELECT '{c}' AS variable, round(100.0 * avg(CASE WHEN {c} IS NULL THEN 1.0 ELSE 0.0 END), 2) "
    f"AS missing_pct FROM ads" for c in _ADS_COLS)))
def q_missing_pct(spark, sf):
    return profile.missing_pct(base(spark, sf), _ADS_COLS)


@register("distinct_values", O.with_base("SELECT DISTINCT publisher FROM ads"))
def q_distinct_values(spark, sf):
    return profile.distinct_values(base(spark, sf), "publisher")


@register("fd_histogram", O.with_base("""
SELECT CAST(least(floor((x - lo) / width), nb - 1) AS BIGINT) AS bin,
       round(lo + CAST(least(floor((x - lo) / width), nb - 1) AS BIGINT) * width, 6) AS bin_lo,
       round(lo + (CAST(least(floor((x - lo) / width), nb - 1) AS BIGINT) + 1) * width, 6) AS bin_hi,
       count(*) AS n
FROM v, w GROUP BY 1, 2, 3""",
    "v AS (SELECT CPA AS x FROM derived WHERE CPA IS NOT NULL)",
    "s AS (SELECT count(*) AS n, min(x) AS lo, max(x) AS hi, quantile_cont(x, 0.25) AS q1, "
    "quantile_cont(x, 0.75) AS q3 FROM v)",
    "hb AS (SELECT *, CAST(2 AS DOUBLE) * (q3 - q1) / pow(n, CAST(1 AS DOUBLE) / 3) AS h FROM s)",
    "nbt AS (SELECT lo, hi, CASE WHEN h <= 0 THEN 30 ELSE greatest(1, CAST(ceil(round((hi - lo) / h, 1)) "
    "AS BIGINT)) END AS nb FROM hb)",
    "w AS (SELECT lo, nb, CASE WHEN hi > lo THEN (hi - lo) / nb ELSE CAST(1 AS DOUBLE) END AS width FROM nbt)"))
def q_fd_histogram(spark, sf):
    h = profile.fd_histogram(derived(spark, sf), "CPA")
    return h.select("bin", r("bin_lo").alias("bin_lo"), r("bin_hi").alias("bin_hi"), "n")


@register("linear_trend", O.with_base(
    "SELECT publisher, round(regr_slope(cost, clicks), 6) AS slope, "
    "round(regr_intercept(cost, clicks), 6) AS intercept, round(regr_r2(cost, clicks), 6) AS r2, "
    "CAST(regr_count(cost, clicks) AS BIGINT) AS n FROM ads WHERE publisher IS NOT NULL GROUP BY publisher"))
def q_linear_trend(spark, sf):
    t = profile.linear_trend(base(spark, sf), "clicks", "cost", ["publisher"])
    return t.select("publisher", r("slope").alias("slope"), r("intercept").alias("intercept"),
                    r("r2").alias("r2"), F.col("n").cast("bigint").alias("n"))


_REQ_COLS = ["category_id", "market_id", "customer_id", "publisher", "industry"]


@register("sample_request", O.with_base(
    f"SELECT variable, arg_min(value, {O.md5_key('value')}) AS value FROM longv "
    "WHERE value IS NOT NULL GROUP BY variable",
    "longv AS (" + " UNION ".join(
        f"SELECT '{c}' AS variable, {c} AS value FROM ads" for c in _REQ_COLS) + ")"))
def q_sample_request(spark, sf):
    return profile.sample_request(base(spark, sf), _REQ_COLS, SEED)

# --------------------------------------------------------------------------- splits


@register("split_shuffled", O.with_base(
    "SELECT campaign_id, CASE WHEN row_number() OVER (ORDER BY h) <= nt THEN 'test' "
    "ELSE 'train' END AS split_type FROM hs, nts",
    f"hs AS (SELECT campaign_id, {O.md5_key('campaign_id')} AS h FROM ads)",
    f"nts AS (SELECT CAST(ceil(CAST({TEST} AS DOUBLE) * count(*)) AS BIGINT) AS nt FROM ads)"))
def q_split_shuffled(spark, sf):
    return splits.split_shuffled(base(spark, sf).select("campaign_id"), ["campaign_id"], TEST, SEED)


@register("split_stratified", O.with_base(
    "SELECT campaign_id, convert, CASE WHEN row_number() OVER (PARTITION BY convert ORDER BY h) "
    "<= q THEN 'test' ELSE 'train' END AS split_type FROM hs JOIN quota USING (convert)",
    f"hs AS (SELECT campaign_id, convert, {O.md5_key('campaign_id')} AS h FROM derived)",
    *O.quota_ctes("hs", "convert")))
def q_split_stratified(spark, sf):
    d = derived(spark, sf).select("campaign_id", F.col("convert").cast("bigint").alias("convert"))
    return splits.split_stratified(d, ["campaign_id"], "convert", TEST, SEED)


@register("split_ordered", O.with_base(
    "SELECT campaign_id, CASE WHEN row_number() OVER (ORDER BY campaign_id) > n - nt "
    "THEN 'test' ELSE 'train' END AS split_type FROM ads, nts",
    f"nts AS (SELECT count(*) AS n, CAST(ceil(CAST({TEST} AS DOUBLE) * count(*)) AS BIGINT) AS nt FROM ads)"))
def q_split_ordered(spark, sf):
    return splits.split_ordered(base(spark, sf).select("campaign_id"), ["campaign_id"], TEST)


@register("cv_folds", O.with_base(
    f"SELECT campaign_id, {O.hex_long(O.md5_key('campaign_id'), 8)} % 5 AS fold FROM ads"))
def q_cv_folds(spark, sf):
    return splits.cv_folds(base(spark, sf).select("campaign_id"), ["campaign_id"], 5, SEED)


@register("cv_folds_stratified", O.with_base(
    "SELECT campaign_id, convert, (row_number() OVER (PARTITION BY convert ORDER BY h) - 1) % 5 "
    "AS fold FROM hs",
    f"hs AS (SELECT campaign_id, convert, {O.md5_key('campaign_id')} AS h FROM derived)"))
def q_cv_folds_stratified(spark, sf):
    d = derived(spark, sf).select("campaign_id", F.col("convert").cast("bigint").alias("convert"))
    return splits.cv_folds_stratified(d, ["campaign_id"], "convert", 5, SEED)


@register("cv_folds_contiguous", O.with_base(
    "SELECT campaign_id, CAST(CASE WHEN rk < (n // 7 + 1) * (n % 7) THEN rk // (n // 7 + 1) "
    "ELSE n % 7 + (rk - (n // 7 + 1) * (n % 7)) // (n // 7) END AS BIGINT) AS fold FROM hs",
    f"hs AS (SELECT campaign_id, row_number() OVER (ORDER BY {O.md5_key('campaign_id')}) - 1 AS rk, "
    "count(*) OVER () AS n FROM ads)"))
def q_cv_folds_contiguous(spark, sf):
    return splits.cv_folds_contiguous(base(spark, sf).select("campaign_id"), ["campaign_id"], 7, SEED)
