"""Registered queries: two-stage training and scoring on the campaign rows,
configuration search and recommendation."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions.hashing import seeded_md5
from ..session import materialize, scratch_path
from ..operators import configure as cfg
from ..operators import evaluate as ev
from ..operators import scoring, splits, stats
from . import oracle_sql as O
from .q_features import industry_map
from .registry import SEED, TEST, base, derived, once, r, register

TOP_K = 20


def split_derived(spark, sf):
    """(train, test) of the campaign rows; the tagged rows are written once per session."""
    tagged = once(spark, sf, "stratified", lambda: splits.split_stratified(
        derived(spark, sf), ["campaign_id"], "convert", TEST, SEED))
    return (tagged.where(F.col("split_type") == "train"), tagged.where(F.col("split_type") == "test"))


_MODELS: dict[tuple, str] = {}


def fitted(spark, sf):
    """The two-stage model of the train split: fitted and saved once per session, loaded by every query."""
    key = (spark.sparkContext.applicationId, sf)
    if key not in _MODELS:
        train, _ = split_derived(spark, sf)
        path = scratch_path(spark, "two-stage-model")
        scoring.save_two_stage(scoring.fit_two_stage(train, industry_map(spark, sf)), path)
        _MODELS[key] = path
    return scoring.load_two_stage(spark, _MODELS[key])


def _nearest_ctes(out: str, queries: str, refs: str, value: str, dims: int = 5) -> list[str]:
    """CTEs: ``out`` (campaign_id, value) = mean ``value`` of the 5 nearest ``refs`` (rid
    up to 2^20) of each of the ``queries``; both have a1 to a<dims>, with the CPC as a5, and ``ii`` (industry).
    The 5th smallest distance to the 100 references around the query's place in the order of a5
    bounds that of all references, and only those whose a5 alone lies within it are compared.
    Distance and rid are packed in one integer, so that the smallest five need no pair table."""
    square = " + ".join(f"(q.a{i} - r.a{i}) * (q.a{i} - r.a{i})" for i in range(1, dims + 1))
    dist = f"sqrt({square} + em.m[q.ii * em.n + r.ii + 1])"
    return [
        f"{out}_r AS (SELECT *, row_number() OVER (ORDER BY a5, rid) AS pos FROM {refs})",
        f"{out}_p AS (SELECT q.*, unnest(range(coalesce(r.pos, 0) - 50, coalesce(r.pos, 0) + 50)) AS pos "
        f"FROM {queries} q ASOF LEFT JOIN {out}_r r ON q.a5 >= r.a5)",
        f"{out}_b AS (SELECT q.campaign_id, list_max(min({dist}, 5)) + 1e-6 AS b "
        f"FROM {out}_p q JOIN {out}_r r USING (pos), em GROUP BY q.campaign_id HAVING count(*) >= 5)",
        f"{out}_q AS MATERIALIZED (SELECT q.*, q.a5 - coalesce(b.b, 1e18) AS lo, q.a5 + coalesce(b.b, 1e18) AS hi "
        f"FROM {queries} q LEFT JOIN {out}_b b USING (campaign_id))",
        f"{out}_nn AS (SELECT q.campaign_id, min(CAST(least(floor({dist} * 1e9 + 0.5), 8e12) AS BIGINT) * 1048576 + r.rid, 5) AS nn "
        f"FROM {out}_q q JOIN {out}_r r ON r.a5 >= q.lo AND r.a5 <= q.hi, em GROUP BY q.campaign_id)",
        f"{out} AS (SELECT n.campaign_id, avg(CAST(r.{value} AS DOUBLE)) AS value FROM (SELECT campaign_id, "
        f"unnest(nn) % 1048576 AS rid FROM {out}_nn) n JOIN {refs} r USING (rid) GROUP BY n.campaign_id)",
    ]


def _encoded_cols(enc: str) -> tuple[str, str]:
    """(a1 to a4, joins) of the four categories of rows ``a`` with the encoder tables ``<enc>_<variable>``."""
    return (", ".join(f"coalesce({O.encoded('a', v, f'e_{v}')}, 0) AS a{i + 1}" for i, v in enumerate(O.CATS)),
            " ".join(f"LEFT JOIN {enc}_{v} e_{v} ON a.{v} = e_{v}.value" for v in O.CATS))


def _stage1(name: str, rows: str, *extra: str) -> str:
    cols, joins = _encoded_cols("enc")
    more = "".join(f", a.{c}" for c in extra)
    return (f"{name} AS (SELECT a.campaign_id{more}, {cols}, coalesce(a.CPC, 0) AS a5, ei.ii, "
            f"row_number() OVER (ORDER BY a.campaign_id) - 1 AS rid FROM {rows} a {joins} "
            "JOIN ei ON coalesce(a.industry, '') = ei.value)")


def _stage2(name: str, rows: str, where: str, *extra: str) -> str:
    cols, joins = _encoded_cols("tenc")
    more = "".join(f", a.{c}" for c in extra)
    return (f"{name} AS (SELECT a.campaign_id{more}, {cols}, coalesce(a.CPC, 0) AS a5, coalesce(p.value, 0) AS a6, ei.ii, "
            f"row_number() OVER (ORDER BY a.campaign_id) - 1 AS rid FROM {rows} a {joins} "
            f"JOIN ei ON coalesce(a.industry, '') = ei.value LEFT JOIN proba p USING (campaign_id) WHERE {where})")


_SPLIT_CTES = [
    f"sh AS (SELECT campaign_id, convert, {O.md5_key('campaign_id')} AS h FROM derived)",
    *O.quota_ctes("sh", "convert"),
    "tagged AS (SELECT campaign_id, CASE WHEN row_number() OVER (PARTITION BY convert ORDER BY h) <= q "
    "THEN 'test' ELSE 'train' END AS split_type FROM sh JOIN quota USING (convert))",
]
_STAGE1_CTES = [
    *_SPLIT_CTES,
    "trd AS MATERIALIZED (SELECT d.* FROM derived d JOIN tagged USING (campaign_id) WHERE split_type = 'train')",
    "ted AS MATERIALIZED (SELECT d.* FROM derived d JOIN tagged USING (campaign_id) WHERE split_type = 'test')",
    *[O.freq_cte(f"enc_{v}", v, "trd", "TRUE") for v in O.CATS], *O.EMB_CTES,
    "ei AS (SELECT value, emb, row_number() OVER (ORDER BY value) - 1 AS ii FROM embmap)",
    "em AS MATERIALIZED (SELECT list(pow(list_distance(a.emb, b.emb), 2) ORDER BY a.ii, b.ii) AS m, "
    "(SELECT count(*) FROM ei) AS n FROM ei a, ei b)",
    _stage1("tr1", "trd", "convert"), _stage1("te1", "ted", "convert"),
]


def _two_stage_ctes(rows: str) -> list[str]:
    """CTEs ``proba`` and ``logcpa`` (campaign_id, value) of the table ``rows`` (campaign ids, categories, industry, CPC),
    from the model fitted on ``trd``. Stage 1 also runs on the train rows, whose probabilities train stage 2."""
    cols = "campaign_id, a1, a2, a3, a4, a5, ii"
    return [
        _stage1("rows1", rows),
        f"all1 AS MATERIALIZED (SELECT {cols} FROM tr1 UNION ALL SELECT {cols} FROM rows1)",
        *_nearest_ctes("proba", "all1", "tr1", "convert"),
        "logged AS (SELECT *, ln(1 + CPA) AS log_CPA FROM trd)",
        *[f"tenc_{v} AS (SELECT {v} AS value, median(log_CPA) AS enc FROM logged WHERE {v} IS NOT NULL GROUP BY {v})"
          for v in O.CATS],
        _stage2("tr2", "logged", "a.log_CPA IS NOT NULL", "log_CPA"), _stage2("rows2", rows, "true"),
        *_nearest_ctes("logcpa", "rows2", "tr2", "log_CPA", 6),
    ]


@register("augment_proba", O.with_base(
    "SELECT campaign_id, round(value, 6) AS proba_convert FROM proba", *_STAGE1_CTES,
    *_nearest_ctes("proba", "te1", "tr1", "convert")))
def q_augment_proba(spark, sf):
    """Stage 1 only: P(convert) for the test split from the train split."""
    train, test = split_derived(spark, sf)
    emb = industry_map(spark, sf)
    from ..operators import encoders as enc
    freq = enc.fit_encoders(train, scoring.CATEGORICAL_FEATURES, "frequency")
    ref = scoring.stage1_features(train, freq, emb).select("campaign_id", "features", "convert")
    out = scoring.augmented(test, freq, emb, ref, 5, "campaign_id")
    return out.select("campaign_id", r("proba_convert").alias("proba_convert"))


@register("predict_cpa", O.with_base(
    "SELECT p.campaign_id, round(p.value, 6) AS proba_convert, round(exp(l.value) - 1, 6) AS predicted_cpa "
    "FROM te1 JOIN proba p USING (campaign_id) LEFT JOIN logcpa l USING (campaign_id)",
    *_STAGE1_CTES, *_two_stage_ctes("ted")))
def q_predict_cpa(spark, sf):
    _, test = split_derived(spark, sf)
    model = fitted(spark, sf)
    out = scoring.predict(model, test, impute_cpc=False)
    return out.select("campaign_id", r("proba_convert").alias("proba_convert"),
                      r("predicted_cpa").alias("predicted_cpa"))


@register("augmented_bundle", O.with_base(
    "SELECT campaign_id, 70 AS n_features, round(proba.value, 6) AS last, round(a1 + a2 + a3 + a4 + a5 + list_sum(ei.emb) + proba.value, 4) AS f_sum "
    "FROM te1 JOIN proba USING (campaign_id) JOIN ei USING (ii)", *_STAGE1_CTES, *_nearest_ctes("proba", "te1", "tr1", "convert")))
def q_augmented_bundle(spark, sf):
    """The test split's features with the probability appended, stored as an augmented dataset and read by name."""
    from ..operators import encoders as enc
    from ..operators import features as feat
    from ..sources import datasets as ds
    train, test = split_derived(spark, sf)
    emb = industry_map(spark, sf)
    freq = enc.fit_encoders(train, scoring.CATEGORICAL_FEATURES, "frequency")
    ref = scoring.stage1_features(train, freq, emb).select("campaign_id", "features", "convert")
    out = scoring.augmented(test, freq, emb, ref, 5, "campaign_id")
    names = feat.feature_names(scoring.STAGE1, feat.EMBEDDING, 64) + ["proba_convert"]
    root = scratch_path(spark, "augmented")
    uid = ds.write_dataset(out.select("campaign_id", F.concat("features", F.array("proba_convert")).alias("features")), root,
                           split_col=None, column_order=names, metadata={"stage": "augment", "k": 5})
    at = ds.registry_positions(spark, root, uid, "all", "proba_convert")[0]
    back = ds.read_dataset(spark, root, uid, "all")
    return back.select("campaign_id", F.size("features").alias("n_features"), r(F.element_at("features", at + 1)).alias("last"),
                       r(F.aggregate("features", F.lit(0.0), lambda a, x: a + x), 4).alias("f_sum"))


_SCORED = ("scored AS (SELECT d.campaign_id, d.convert, CASE WHEN p.value > 0.5 THEN 1 ELSE 0 END AS pred, ln(1 + d.CPA) AS y, "
           "l.value AS f FROM ted d JOIN proba p USING (campaign_id) JOIN logcpa l USING (campaign_id))")
_COUNTS = ("counts AS (SELECT CAST(count(*) AS DOUBLE) AS n, CAST(sum(pred * convert) AS DOUBLE) AS tp, "
           "CAST(sum(pred) AS DOUBLE) AS pc, CAST(sum(convert) AS DOUBLE) AS tc, "
           "CAST(count(*) FILTER (pred = convert) AS DOUBLE) AS ok FROM scored)")


@register("two_stage", O.with_base("""
SELECT 'conversion_classifier' AS model, 'accuracy' AS metric, round(ok / n, 6) AS value FROM counts
UNION ALL SELECT 'conversion_classifier', 'precision', round(CASE WHEN pc = 0 THEN 0 ELSE tp / pc END, 6) FROM counts
UNION ALL SELECT 'conversion_classifier', 'recall', round(CASE WHEN tc = 0 THEN 0 ELSE tp / tc END, 6) FROM counts
UNION ALL SELECT 'conversion_classifier', 'f1', round(CASE WHEN pc + tc = 0 THEN 0 ELSE 2 * tp / (pc + tc) END, 6) FROM counts
UNION ALL SELECT 'cpa_regressor', 'rmse', round(sqrt(avg((f - y) * (f - y))), 6) FROM scored WHERE y IS NOT NULL
UNION ALL SELECT 'cpa_regressor', 'mae', round(avg(abs(f - y)), 6) FROM scored WHERE y IS NOT NULL
UNION ALL SELECT 'cpa_regressor', 'r2', round(1 - sum((f - y) * (f - y)) / (var_pop(y) * count(*)), 6) FROM scored WHERE y IS NOT NULL""",
    *_STAGE1_CTES, *_two_stage_ctes("ted"), _SCORED, _COUNTS))
def q_two_stage(spark, sf):
    """Train both stages on the train split, score the test split: accuracy of
    the classifier and RMSE of the log-CPA regressor on test."""
    _, test = split_derived(spark, sf)
    model = fitted(spark, sf)
    out = scoring.predict(model, test, impute_cpc=False).withColumn("log_CPA", F.log1p("CPA"))
    out = materialize(out.select("convert", "log_CPA", "proba_convert", "predicted_log_cpa"), "two-stage-scored")
    out = out.withColumn("pred_convert", (F.col("proba_convert") > 0.5).cast("int"))
    acc = ev.classification_metrics(out, "convert", "pred_convert", positive=1) \
            .withColumn("model", F.lit("conversion_classifier"))
    reg = ev.regression_metrics(out.where(F.col("log_CPA").isNotNull()), "log_CPA", "predicted_log_cpa") \
            .where(F.col("metric").isin("rmse", "mae", "r2")).withColumn("model", F.lit("cpa_regressor"))
    return acc.unionByName(reg).select("model", "metric", r("value").alias("value"))


# --------------------------------------------------------------------------- configurations

@register("top_k_configs", O.with_base(
    f"SELECT market_id, publisher, count(campaign_id) AS n_campaigns FROM ads "
    f"WHERE market_id IS NOT NULL AND publisher IS NOT NULL GROUP BY market_id, publisher "
    f"ORDER BY n_campaigns DESC, market_id, publisher LIMIT {TOP_K}"))
def q_top_k_configs(spark, sf):
    return cfg.top_k_configs(stats.config_usage(base(spark, sf)), TOP_K)


_EXPLORE_CTES = [
    "use AS (SELECT market_id, publisher, count(campaign_id) AS n FROM ads "
    "WHERE market_id IS NOT NULL AND publisher IS NOT NULL GROUP BY market_id, publisher)",
    "ex AS (SELECT market_id, publisher FROM use WHERE n >= (SELECT avg(n) FROM use))",
    "space AS (SELECT m.market_id, p.publisher FROM (SELECT DISTINCT market_id FROM ads WHERE market_id IS NOT NULL) m "
    "CROSS JOIN (SELECT DISTINCT publisher FROM ads WHERE publisher IS NOT NULL) p)",
    "explore AS (SELECT * FROM space s WHERE NOT EXISTS (SELECT 1 FROM ex WHERE ex.market_id = s.market_id "
    "AND ex.publisher = s.publisher))",
]


@register("explore_configs", O.with_base("SELECT market_id, publisher FROM explore", *_EXPLORE_CTES))
def q_explore_configs(spark, sf):
    return cfg.explore_configs(base(spark, sf), usage_ratio=1.0)


@register("hybrid_configs", O.with_base(
    "SELECT DISTINCT market_id, publisher FROM (SELECT market_id, publisher FROM topk UNION ALL "
    "SELECT market_id, publisher FROM explore)", *_EXPLORE_CTES,
    f"topk AS (SELECT market_id, publisher FROM use ORDER BY n DESC, market_id, publisher LIMIT {TOP_K})"))
def q_hybrid_configs(spark, sf):
    b = base(spark, sf)
    return cfg.hybrid_configs(cfg.top_k_configs(stats.config_usage(b), TOP_K), cfg.explore_configs(b, usage_ratio=1.0))


def requests(spark, sf):
    """One request per customer of the test split: the ids of the customer's
    campaign with the smallest seeded hash."""
    _, test = split_derived(spark, sf)
    pick = F.min_by(F.struct("category_id", "industry"), seeded_md5(["campaign_id"], SEED))
    return (test.groupBy("customer_id").agg(pick.alias("_r"))
                .select("customer_id", "_r.category_id", "_r.industry"))


_REQS = [
    f"reqp AS (SELECT customer_id, arg_min(struct_pack(c := category_id, i := industry), "
    f"{O.md5_key('campaign_id')}) AS p FROM derived JOIN tagged USING (campaign_id) "
    "WHERE split_type = 'test' GROUP BY customer_id)",
    "reqs AS (SELECT customer_id, p.c AS category_id, p.i AS industry FROM reqp)",
    f"topk AS (SELECT market_id, publisher FROM (SELECT market_id, publisher, count(campaign_id) AS n FROM ads "
    f"WHERE market_id IS NOT NULL AND publisher IS NOT NULL GROUP BY market_id, publisher) "
    f"ORDER BY n DESC, market_id, publisher LIMIT {TOP_K})",
]
_REQ_CTES = [*_SPLIT_CTES, *_REQS]
#: the CPC of a request: of the train split's record, else the record's median
_CPC_CTES = [
    "trec AS (SELECT market_id, publisher, median(CPC) AS CPC FROM trd "
    "WHERE market_id IS NOT NULL AND publisher IS NOT NULL GROUP BY market_id, publisher)",
    "tfb AS (SELECT median(CPC) AS m FROM trec)",
]


def _imputed(name: str, rows: str) -> str:
    return (f"{name} AS MATERIALIZED (SELECT a.*, CASE WHEN t.market_id IS NOT NULL THEN t.CPC ELSE tfb.m END AS CPC FROM {rows} a "
            "LEFT JOIN trec t ON a.market_id = t.market_id AND a.publisher = t.publisher, tfb)")


_CANDIDATE_CTES = [
    *_STAGE1_CTES, *_REQS, *_CPC_CTES,
    "cand AS (SELECT concat_ws('|', customer_id, market_id, publisher) AS campaign_id, customer_id, category_id, industry, "
    "market_id, publisher FROM reqs CROSS JOIN topk)",
    _imputed("cands", "cand"), *_two_stage_ctes("cands"),
    "found AS (SELECT customer_id, market_id, publisher, exp(l.value) - 1 AS predicted_cpa FROM cands LEFT JOIN logcpa l USING (campaign_id))",
]


@register("candidate_space", O.with_base(
    "SELECT customer_id, category_id, industry, market_id, publisher FROM reqs CROSS JOIN topk", *_REQ_CTES))
def q_candidate_space(spark, sf):
    top = cfg.top_k_configs(stats.config_usage(base(spark, sf)), TOP_K)
    return cfg.candidate_space(requests(spark, sf), top).select(
        "customer_id", "category_id", "industry", "market_id", "publisher")


def _scored(spark, sf):
    model = fitted(spark, sf)
    top = cfg.top_k_configs(stats.config_usage(base(spark, sf)), TOP_K)
    cands = cfg.candidate_space(requests(spark, sf), top)
    cands = cands.withColumn("campaign_id", F.concat_ws("|", "customer_id", "market_id", "publisher"))
    out = scoring.predict(model, cands, impute_cpc=True)
    return materialize(out.select("customer_id", "market_id", "publisher", "predicted_cpa"), "scored-configs")


@register("score_configs", O.with_base(
    "SELECT customer_id, market_id, publisher, round(predicted_cpa, 6) AS predicted_cpa FROM found", *_CANDIDATE_CTES))
def q_score_configs(spark, sf):
    s = _scored(spark, sf)
    return s.select("customer_id", "market_id", "publisher", r("predicted_cpa").alias("predicted_cpa"))


@register("recommend_config", O.with_base(
    "SELECT customer_id, p.m AS market_id, p.p AS publisher, p.s AS predicted_cpa FROM (SELECT customer_id, "
    "arg_min(struct_pack(m := market_id, p := publisher, s := s), struct_pack(s := s, m := market_id, p := publisher)) AS p "
    "FROM (SELECT *, round(predicted_cpa, 6) AS s FROM found) GROUP BY customer_id)", *_CANDIDATE_CTES))
def q_recommend_config(spark, sf):
    # rounded first: the mean of the same neighbours may differ in its last bit, and ties go by key
    rec = cfg.recommend(_scored(spark, sf).withColumn("predicted_cpa", r("predicted_cpa")), ["customer_id"])
    return rec.select("customer_id", "market_id", "publisher", r("predicted_cpa").alias("predicted_cpa"))


@register("stream_score", O.with_base(
    "SELECT campaign_id AS request_id, round(p.value, 6) AS proba_convert, round(exp(l.value) - 1, 6) AS predicted_cpa "
    "FROM streamed JOIN proba p USING (campaign_id) LEFT JOIN logcpa l USING (campaign_id)",
    *_STAGE1_CTES, *_CPC_CTES,
    f"spick AS (SELECT customer_id, arg_min(struct_pack(c := category_id, m := market_id, p := publisher, i := industry), "
    f"{O.md5_key('campaign_id')}) AS r FROM ted GROUP BY customer_id)",
    "sreq AS (SELECT customer_id AS campaign_id, r.c AS category_id, r.m AS market_id, customer_id, r.p AS publisher, "
    "r.i AS industry FROM spick)",
    _imputed("streamed", "sreq"), *_two_stage_ctes("streamed")))
def q_stream_score(spark, sf):
    """Streaming serving: one request per test-split customer arrives as files;
    a Structured Streaming job scores every micro-batch with the two-stage
    model trained on the train split."""
    from ..streaming.scoring import score_request_stream
    _, test = split_derived(spark, sf)
    model = fitted(spark, sf)
    pick = F.min_by(F.struct("category_id", "market_id", "publisher", "industry"),
                    seeded_md5(["campaign_id"], SEED))
    reqs = (test.groupBy("customer_id").agg(pick.alias("_r"))
                .select(F.col("customer_id").alias("request_id"), "_r.category_id", "_r.market_id",
                        "customer_id", "_r.publisher", "_r.industry"))
    src, out, ckpt = (scratch_path(spark, n) for n in ("stream-in", "stream-out", "stream-ckpt"))
    reqs.repartition(4).write.parquet(src)
    q = score_request_stream(spark, model, src, out, ckpt, max_files_per_trigger=2)
    q.awaitTermination()
    return spark.read.parquet(out).select("request_id", r("proba_convert").alias("proba_convert"),
                                          r("predicted_cpa").alias("predicted_cpa"))
