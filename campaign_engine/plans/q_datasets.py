"""Registered queries: CSV scan, dataset write/read round trips, registry
lookups, metadata cleaning, column positions, encoder persistence."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import functions as F

from ..operators import encoders as enc
from ..operators import features as feat
from ..session import scratch_path
from ..sources import datasets as ds
from . import oracle_sql as O
from .q_features import _FEAT_SQL, _FEAT_SUM, _features, emb_sum, fit_rows
from .registry import SEED, TEST, base, r, register

CATS = O.CATS


@register("scan_csv", O.with_base(
    "SELECT count(*) AS n_rows, count(DISTINCT campaign_id) AS n_campaigns, round(sum(cost), 2) AS sum_cost, "
    "count(publisher) AS n_publisher, CAST(sum(converions) AS BIGINT) AS sum_converions FROM ads"))
def q_scan_csv(spark, sf):
    path = scratch_path(spark, "ads-csv")
    base(spark, sf).write.option("header", True).csv(path)
    df = ds.scan_csv(spark, path)
    return df.agg(F.count(F.lit(1)).alias("n_rows"), F.count_distinct("campaign_id").alias("n_campaigns"),
                  r(F.sum("cost"), 2).alias("sum_cost"), F.count("publisher").alias("n_publisher"),
                  F.sum("converions").alias("sum_converions"))


def _ingested(spark, sf):
    root = scratch_path(spark, "datasets")
    uid = ds.ingest(base(spark, sf), root, ["campaign_id"], TEST, SEED, shuffle=True, source=sf)
    return root, uid


_TEST_ROWS = [*O.split_ctes()]


@register("read_dataset", O.with_base(
    "SELECT campaign_id, market_id, publisher, round(cost, 6) AS cost, clicks, converions "
    "FROM ads JOIN splitv USING (campaign_id) WHERE split_type = 'test'", *_TEST_ROWS))
def q_read_dataset(spark, sf):
    root, uid = _ingested(spark, sf)
    df = ds.read_dataset(spark, root, uid, "test")
    return df.select("campaign_id", "market_id", "publisher", r("cost").alias("cost"), "clicks", "converions")


@register("roundtrip_split", O.with_base(
    "SELECT split_type, count(*) AS n_rows, round(sum(cost), 2) AS sum_cost FROM ads JOIN splitv "
    "USING (campaign_id) GROUP BY split_type", *_TEST_ROWS))
def q_roundtrip_split(spark, sf):
    root, uid = _ingested(spark, sf)
    parts = [ds.read_dataset(spark, root, uid, s).agg(F.count(F.lit(1)).alias("n_rows"),
                                                      r(F.sum("cost"), 2).alias("sum_cost"))
             .select(F.lit(s).alias("split_type"), "n_rows", "sum_cost") for s in ("train", "test")]
    return parts[0].unionByName(parts[1])


@register("registry_lookup", O.with_base(
    "SELECT split_type, count(*) AS n_rows, CAST(2025 AS BIGINT) AS random_state, CAST(0.2 AS DOUBLE) AS test_size, "
    "true AS shuffle, CAST(NULL AS VARCHAR) AS stratify_variable FROM splitv GROUP BY split_type", *_TEST_ROWS))
def q_registry_lookup(spark, sf):
    root, uid = _ingested(spark, sf)
    reg = ds.registry(spark, root).where(F.col("uid") == uid)
    ds.resolve(spark, root, uid, "test")  # raises when absent
    return reg.select("split_type", "n_rows", "random_state", "test_size", "shuffle", "stratify_variable")


def _features_dataset(spark, sf):
    root = scratch_path(spark, "features")
    f = _features(spark, sf).select("campaign_id", "CPA", "convert", "features")
    names = feat.feature_names(feat.PREDICTORS, feat.EMBEDDING, 64)
    uid = ds.write_dataset(f, root, split_col=None, column_order=names)
    return root, uid


@register("bundle_select", O.with_base("SELECT campaign_id, round(CPA, 6) AS CPA FROM derived"))
def q_bundle_select(spark, sf):
    root, uid = _features_dataset(spark, sf)
    return ds.read_dataset(spark, root, uid, "all", ["campaign_id", "CPA"]).select(
        "campaign_id", r("CPA").alias("CPA"))


@register("roundtrip_features", O.with_base(
    f"SELECT campaign_id, CAST(5 + len(emb) AS BIGINT) AS n_features, round({_FEAT_SUM}, 4) AS f_sum FROM feat",
    *_FEAT_SQL))
def q_roundtrip_features(spark, sf):
    root, uid = _features_dataset(spark, sf)
    df = ds.read_dataset(spark, root, uid, "all")
    return df.select("campaign_id", F.size("features").cast("bigint").alias("n_features"),
                     r(emb_sum("features"), 4).alias("f_sum"))


@register("column_positions", O.with_base(
    "SELECT campaign_id, 'CPC' AS name, round(CPC, 6) AS value FROM feat UNION ALL "
    "SELECT campaign_id, 'publisher_encoded', round(publisher_encoded, 6) FROM feat", *_FEAT_SQL))
def q_column_positions(spark, sf):
    root, uid = _features_dataset(spark, sf)
    wanted = ["CPC", "publisher_encoded"]
    pos = ds.registry_positions(spark, root, uid, "all", wanted)
    df = ds.read_dataset(spark, root, uid, "all", ["campaign_id", "features"])
    pairs = F.array(*[F.struct(F.lit(n).alias("name"), F.element_at("features", p + 1).alias("value"))
                      for n, p in zip(wanted, pos)])
    return (df.select("campaign_id", F.explode(pairs).alias("_p"))
              .select("campaign_id", "_p.name", r("_p.value").alias("value")))


@register("load_encoders", O.with_base("\nUNION ALL\n".join(
    f"SELECT '{v}' AS variable, value, enc FROM enc_{v}" for v in CATS),
    *[O.freq_cte(f"enc_{v}", v) for v in CATS]))
def q_load_encoders(spark, sf):
    root = scratch_path(spark, "encoders")
    euid = ds.save_encoders(enc.fit_encoders(fit_rows(spark, sf), CATS, "frequency"), root)
    loaded = ds.load_encoders(spark, root, euid)
    return reduce(lambda a, b: a.unionByName(b),
                  [t.select(F.lit(v).alias("variable"), "value", "enc") for v, t in loaded.items()])


@register("clean_metadata", O.with_base(
    "SELECT market_id, CASE WHEN starts_with(k, 'x-amz-meta-') THEN replace(k, 'x-amz-meta-', '') ELSE k END AS key, "
    "v AS value FROM (SELECT market_id, unnest(['x-amz-meta-market_id', 'x-amz-meta-rows', 'content-type']) AS k, "
    "unnest([market_id, CAST(count(*) AS VARCHAR), 'text/csv']) AS v FROM ads WHERE market_id IS NOT NULL "
    "GROUP BY market_id)"))
def q_clean_metadata(spark, sf):
    per = base(spark, sf).where(F.col("market_id").isNotNull()).groupBy("market_id").agg(
        F.count(F.lit(1)).alias("n"))
    meta = F.create_map(F.lit("x-amz-meta-market_id"), F.col("market_id"),
                        F.lit("x-amz-meta-rows"), F.col("n").cast("string"),
                        F.lit("content-type"), F.lit("text/csv"))
    cleaned = per.select("market_id", ds.clean_metadata(meta).alias("m"))
    return cleaned.select("market_id", F.explode("m").alias("key", "value"))


@register("flatten_column_order", O.with_base(
    "SELECT campaign_id, CAST(1 + CAST(category_id IS NOT NULL AS INT) + CAST(market_id IS NOT NULL AS INT) AS BIGINT) "
    "AS n_items, coalesce(category_id, market_id, industry, '') AS item_first, coalesce(industry, '') AS item_last FROM ads"))
def q_flatten_column_order(spark, sf):
    text = F.concat_ws(",", "category_id", "market_id",
                       F.concat(F.lit("['"), F.coalesce("industry", F.lit("")), F.lit("']")))
    parts = ds.parse_and_flatten(text)
    return base(spark, sf).select("campaign_id", parts.alias("p")).select(
        "campaign_id", F.size("p").cast("bigint").alias("n_items"),
        F.element_at("p", 1).alias("item_first"), F.element_at("p", -1).alias("item_last"))


@register("list_datasets", O.with_base(
    "SELECT split_type, count(*) AS n_rows, true AS has_files FROM splitv GROUP BY split_type "
    "UNION ALL SELECT 'all', count(*), true FROM ads", *_TEST_ROWS))
def q_list_datasets(spark, sf):
    """A split and an unsplit dataset, found by their files and joined to the registry."""
    root, _ = _ingested(spark, sf)
    ds.write_dataset(base(spark, sf).select("campaign_id"), root, split_col=None)
    files = ds.list_datasets(spark, root)
    return files.groupBy("uid", "split_type").agg(F.max("n_rows").alias("n_rows"), F.sum("length").alias("bytes")) \
        .select("split_type", "n_rows", (F.col("bytes") > 0).alias("has_files"))
