"""Registered queries: bundles, file order, lineage, JSON documents, merged profiles."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import configure as cfg
from ..operators import models as M
from ..operators import sketches, splits, stats
from ..session import scratch_path
from ..sources import datasets as ds
from ..sources import npz
from . import oracle_sql as O
from .q_features import _FEAT_SQL, _FEAT_SUM, _features, emb_sum
from .q_models import K, _cv_sql_ctes, cv_accuracy
from .registry import SEED, TEST, base, derived, r, register


@register("npz_bundle", O.with_base(
    f"SELECT campaign_id, round(CPA, 6) AS CPA, CAST(5 + len(emb) AS BIGINT) AS n_features, round({_FEAT_SUM}, 4) AS f_sum "
    "FROM feat JOIN (SELECT campaign_id, CPA FROM derived) USING (campaign_id)", *_FEAT_SQL))
def q_npz_bundle(spark, sf):
    """The feature table as array bundles: written, then read by row ranges."""
    path = scratch_path(spark, "bundles")
    npz.write_npz(_features(spark, sf).select("campaign_id", "CPA", "convert", "features"), path)
    back = npz.read_npz(spark, path, ["campaign_id", "CPA", "features"], rows_per_partition=1 << 14)
    cpa = F.when(~F.isnan("CPA"), F.col("CPA"))  # a bundle stores a missing number as NaN
    return back.select("campaign_id", r(cpa).alias("CPA"), F.size("features").cast("bigint").alias("n_features"),
                       r(emb_sum("features"), 4).alias("f_sum"))


_BIG = "(n // 5 + 1) * (n % 5)"


@register("file_order", O.with_base(
    "SELECT campaign_id, row_position, CASE WHEN row_position >= n - CAST(ceil(CAST(0.2 AS DOUBLE) * n) AS BIGINT) THEN 'test' "
    f"ELSE 'train' END AS split_type, CAST(CASE WHEN row_position < {_BIG} THEN row_position // (n // 5 + 1) "
    f"ELSE n % 5 + (row_position - {_BIG}) // (n // 5) END AS BIGINT) AS fold FROM (SELECT campaign_id, "
    "row_number() OVER (ORDER BY campaign_id) - 1 AS row_position, count(*) OVER () AS n FROM ads)"))
def q_file_order(spark, sf):
    """Unshuffled split and contiguous folds of CSV files, in the order of the files' rows."""
    path = scratch_path(spark, "ordered-csv")
    base(spark, sf).repartitionByRange("campaign_id").sortWithinPartitions("campaign_id") \
        .write.option("header", True).option("compression", "gzip").csv(path)
    rows = ds.scan_csv(spark, path, position="row_position").select("campaign_id", "row_position")
    tagged = splits.split_ordered(rows, ["row_position"], TEST)
    folds = splits.cv_folds_contiguous(tagged, ["campaign_id"], 5, order_cols=["row_position"])
    return folds.select("campaign_id", "row_position", "split_type", "fold")


@register("dataset_lineage", O.with_base(
    "SELECT 'augmented' AS uid, 'features' AS parent_uid, 0 AS depth, count(*) AS n_rows FROM ads UNION ALL "
    "SELECT 'features', 'raw', 1, count(*) FROM ads UNION ALL SELECT 'raw', NULL, 2, count(*) FROM ads"))
def q_dataset_lineage(spark, sf):
    """All ancestors of an augmented dataset; its first version had another parent."""
    root = scratch_path(spark, "lineage")
    rows = splits.split_shuffled(base(spark, sf).select("campaign_id", "cost"), ["campaign_id"], TEST, SEED)
    ds.write_dataset(rows, root, uid="raw")
    ds.write_dataset(rows, root, uid="augmented", parent_uid="raw")
    ds.write_dataset(rows, root, uid="features", parent_uid="raw", split_col=None)
    ds.write_dataset(rows, root, uid="augmented", parent_uid="features")
    return ds.lineage(spark, root, "augmented").select("uid", "parent_uid", "depth", "n_rows")


@register("cv_document", O.with_base(
    "SELECT fold, split, metric, round(value, 6) AS value FROM acc", *_cv_sql_ctes([K])))
def q_cv_document(spark, sf):
    """Cross-validation results as a JSON document, written as text and read back as rows."""
    path = scratch_path(spark, "cv-document")
    M.cv_document(cv_accuracy(spark, sf)).coalesce(1).write.text(path)
    back = M.cv_from_document(spark.read.text(path, wholetext=True), "value")
    return back.select("fold", "split", "metric", r("value").alias("value"))


@register("json_requests", O.with_base(
    "SELECT campaign_id, market_id, publisher, industry, round(cost, 6) AS cost, clicks, "
    "CAST(2 + (publisher IS NOT NULL)::INT + (cost IS NOT NULL)::INT AS INTEGER) AS n_fields FROM ads"))
def q_json_requests(spark, sf):
    """Requests as JSON lines: written as text, read as VARIANT and by a declared schema."""
    path = scratch_path(spark, "requests-json")
    rows = base(spark, sf).select("campaign_id", "market_id", "publisher", "industry", "cost", "clicks")
    rows.select(F.to_json(F.struct(F.struct("market_id", "publisher").alias("config"), "campaign_id", "industry", "cost",
                                   "clicks")).alias("value")).write.text(path)
    text = spark.read.text(path)
    typed = F.from_json("value", "campaign_id string, industry string, config struct<market_id: string, publisher: string>",
                        {"mode": "FAILFAST"})
    v = F.parse_json("value")
    got = text.select(typed.alias("t"), v.alias("v")).select(
        "t.campaign_id", "t.industry", F.variant_get("v", "$.config.market_id", "string").alias("market_id"),
        F.variant_get("v", "$.config.publisher", "string").alias("publisher"),
        r(F.variant_get("v", "$.cost", "double")).alias("cost"), F.variant_get("v", "$.clicks", "bigint").alias("clicks"),
        (F.lit(2) + F.expr("CAST(variant_get(v, '$.config.publisher') IS NOT NULL AS INT)")
         + F.expr("CAST(variant_get(v, '$.cost') IS NOT NULL AS INT)")).alias("n_fields"))
    return got.select("campaign_id", "market_id", "publisher", "industry", "cost", "clicks", "n_fields")


_PROFILED = ["cost", "CPA", "customer_id", "category_id"]


@register("profile_merged", O.with_base(" UNION ALL ".join(
    f"SELECT '{c}' AS \"column\", count(*) AS n, count(*) - count({c}) AS n_missing, count(DISTINCT {c}) AS n_exact, "
    f"true AS distinct_ok, {'true' if c in ('cost', 'CPA') else 'CAST(NULL AS BOOLEAN)'} AS median_ok FROM derived"
    for c in _PROFILED)))
def q_profile_merged(spark, sf):
    """Stored profiles of the train and test parts, merged without another scan, against the exact
    numbers of the whole: both sketches keep their stated error."""
    root = scratch_path(spark, "profiles")
    rows = splits.cv_folds(derived(spark, sf), ["campaign_id"], 2, SEED)
    for part in (0, 1):
        sketches.save_profile(rows.where(F.col("fold") == part), root, f"part{part}", _PROFILED)
    got = sketches.estimates(sketches.merge(sketches.load_profiles(spark, root)), [0.5])
    whole = derived(spark, sf)
    exact = whole.agg(*[F.count_distinct(c).alias(c) for c in _PROFILED]).unpivot([], _PROFILED, "column", "n_exact")
    middle = {x["column"]: x["quantiles"][0] for x in got.where("quantiles IS NOT NULL").collect()}
    below = whole.agg(*[(F.count(F.when(F.col(c) <= m, 1)) / F.count(c)).alias(c) for c, m in middle.items()]) \
        .unpivot([], list(middle), "column", "share")
    above = whole.agg(*[(F.count(F.when(F.col(c) < m, 1)) / F.count(c)).alias(c) for c, m in middle.items()]) \
        .unpivot([], list(middle), "column", "less")
    err = 2 * sketches.rank_error()
    out = got.join(exact, "column").join(below, "column", "left").join(above, "column", "left")
    return out.select("column", "n", "n_missing", "n_exact",
                      (F.abs(F.col("n_unique") - F.col("n_exact")) <= 4 * sketches.distinct_error() * F.col("n_exact"))
                      .alias("distinct_ok"),
                      ((F.col("share") >= 0.5 - err) & (F.col("less") <= 0.5 + err)).alias("median_ok"))


_USED = "coalesce(substr(md5(market_id || publisher), 1, 1) >= '4', true)"


@register("explore_unused", O.with_base(
    "SELECT m.market_id, p.publisher FROM (SELECT DISTINCT market_id FROM used WHERE market_id IS NOT NULL) m "
    "CROSS JOIN (SELECT DISTINCT publisher FROM used WHERE publisher IS NOT NULL) p "
    "WHERE NOT EXISTS (SELECT 1 FROM used a WHERE a.market_id = m.market_id AND a.publisher = p.publisher)",
    f"used AS (SELECT * FROM ads WHERE {_USED})"))
def q_explore_unused(spark, sf):
    """Pairs without any campaign, the default rule (on rows from which a quarter of the pairs is gone)."""
    return cfg.explore_configs(base(spark, sf).where(_USED))


@register("record_roundtrip", O.with_base(
    "SELECT market_id, publisher, round(median(CPC), 6) AS CPC FROM derived "
    "WHERE market_id IS NOT NULL AND publisher IS NOT NULL GROUP BY market_id, publisher"))
def q_record_roundtrip(spark, sf):
    """The CPC record as a stored dataset, read back by its registry row."""
    root = scratch_path(spark, "records")
    uid = ds.write_dataset(stats.cpc_record(derived(spark, sf)), root, split_col=None, metadata={"kind": "cpc_record"})
    return ds.read_dataset(spark, root, uid, "all").select("market_id", "publisher", r("CPC").alias("CPC"))
