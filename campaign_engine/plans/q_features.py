"""Registered queries: encoders, CPC imputation, embeddings, feature assembly,
class/sample weights, request features."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import encoders as enc
from ..operators import features as feat
from ..operators import splits, stats
from ..operators.embed import EmbeddingMemo, embed_distinct, hashing_embedder, hashing_model, rank_map
from ..session import materialize, scratch_path
from ..sources.tables import read_table
from . import oracle_sql as O
from .registry import SEED, TEST, base, derived, r, register

CATS = O.CATS
ENCODED = enc.encoded_names(CATS)


def fit_rows(spark, sf):
    """The train part of the hash folds: fold 0 is held out."""
    return splits.cv_folds(derived(spark, sf), ["campaign_id"], 5, SEED).where("fold <> 0").drop("fold")


def industry_map(spark, sf):
    return rank_map(base(spark, sf), "industry", read_table(spark, sf, "embeddings"))


def emb_sum(c):
    return F.aggregate(F.col(c), F.lit(0.0), lambda a, x: a + x)


# --------------------------------------------------------------------------- encoders

@register("encode_freq", O.with_base(
    f"SELECT a.campaign_id, {O.encoded('a', 'publisher', 'e')} AS publisher_encoded "
    "FROM ads a LEFT JOIN encp e ON a.publisher = e.value",
    O.freq_cte("encp", "publisher")))
def q_encode_freq(spark, sf):
    e = enc.fit_encoders(fit_rows(spark, sf), ["publisher"], "frequency")
    return enc.apply_encoders(base(spark, sf), e, ["publisher"]).select(
        "campaign_id", "publisher_encoded")


@register("encode_target", O.with_base(
    f"SELECT d.campaign_id, round({O.encoded('d', 'market_id', 't')}, 6) AS market_id_encoded "
    "FROM derived d LEFT JOIN enct t ON d.market_id = t.value",
    f"enct AS (SELECT market_id AS value, median(ln(1 + CPA)) AS enc FROM derived "
    f"WHERE {O.FIT_WHERE} AND market_id IS NOT NULL GROUP BY market_id)"))
def q_encode_target(spark, sf):
    fit = fit_rows(spark, sf).withColumn("log_CPA", F.log1p("CPA"))
    e = enc.fit_encoders(fit, ["market_id"], "target", target="log_CPA", stat="median")
    out = enc.apply_encoders(derived(spark, sf), e, ["market_id"])
    return out.select("campaign_id", r("market_id_encoded").alias("market_id_encoded"))


def _multi_sql(src_alias_from: str, where: str = "") -> str:
    cols = ", ".join(f"{O.encoded('a', v, 'e_' + v)} AS {v}_encoded" for v in CATS)
    joins = " ".join(f"LEFT JOIN enc_{v} e_{v} ON a.{v} = e_{v}.value" for v in CATS)
    return f"SELECT a.campaign_id, {cols} FROM {src_alias_from} a {joins} {where}"


@register("encode_multi", O.with_base(
    _multi_sql("ads"), *[O.freq_cte(f"enc_{v}", v) for v in CATS]))
def q_encode_multi(spark, sf):
    e = enc.fit_encoders(fit_rows(spark, sf), CATS, "frequency")
    return enc.apply_encoders(base(spark, sf), e, CATS).select("campaign_id", *ENCODED)


@register("encoder_long", O.with_base("\nUNION ALL\n".join(
    f"SELECT '{v}' AS variable, value, enc FROM enc_{v}" for v in CATS),
    *[O.freq_cte(f"enc_{v}", v) for v in CATS]))
def q_encoder_long(spark, sf):
    return enc.fit_encoders(fit_rows(spark, sf), CATS, "frequency")


@register("encode_test_with_train", O.with_base(
    _multi_sql("(SELECT ads.* FROM ads JOIN splitv USING (campaign_id) WHERE split_type = 'test')"),
    *O.split_ctes(),
    "trainrows AS (SELECT ads.* FROM ads JOIN splitv USING (campaign_id) WHERE split_type = 'train')",
    *[O.freq_cte(f"enc_{v}", v, "trainrows", "TRUE") for v in CATS]))
def q_encode_test_with_train(spark, sf):
    tagged = splits.split_shuffled(base(spark, sf), ["campaign_id"], TEST, SEED)
    train = tagged.where(F.col("split_type") == "train")
    test = tagged.where(F.col("split_type") == "test")
    e = enc.fit_encoders(train, CATS, "frequency")
    return enc.apply_encoders(test, e, CATS).select("campaign_id", *ENCODED)

# --------------------------------------------------------------------------- CPC imputation


_REC_CTES = [
    f"rec AS (SELECT market_id, publisher, median(CPC) AS CPC FROM derived WHERE {O.FIT_WHERE} "
    "AND market_id IS NOT NULL AND publisher IS NOT NULL GROUP BY market_id, publisher)",
    "fb AS (SELECT median(CPC) AS m FROM rec)",
]


@register("cpc_impute", O.with_base(
    "SELECT d.campaign_id, round(CASE WHEN rec.market_id IS NOT NULL THEN rec.CPC ELSE fb.m END, 6) "
    "AS CPC_imputed FROM derived d LEFT JOIN rec ON d.market_id = rec.market_id "
    "AND d.publisher = rec.publisher CROSS JOIN fb", *_REC_CTES))
def q_cpc_impute(spark, sf):
    rec = stats.cpc_record(fit_rows(spark, sf))
    out = feat.impute_cpc(base(spark, sf), rec, out="CPC_imputed")
    return out.select("campaign_id", r("CPC_imputed").alias("CPC_imputed"))

# --------------------------------------------------------------------------- embeddings


@register("embed_join", O.with_base(
    "SELECT a.campaign_id, CAST(len(m.emb) AS BIGINT) AS emb_dim, round(list_sum(m.emb), 6) AS emb_sum "
    "FROM ads a LEFT JOIN embmap m ON coalesce(a.industry, '') = m.value", *O.EMB_CTES))
def q_embed_join(spark, sf):
    out = embed_distinct(base(spark, sf), "industry", industry_map(spark, sf))
    return out.select("campaign_id", F.size("industry_embedding").cast("bigint").alias("emb_dim"),
                      r(emb_sum("industry_embedding")).alias("emb_sum"))

# --------------------------------------------------------------------------- assembly

_FEAT_SQL = [
    *O.EMB_CTES, *_REC_CTES, *[O.freq_cte(f"enc_{v}", v) for v in CATS],
    "feat AS (SELECT a.campaign_id, a.convert, " + ", ".join(
        f"coalesce({O.encoded('a', v, 'e_' + v)}, 0) AS {v}_encoded" for v in CATS)
    + ", coalesce(a.CPC, 0) AS CPC, m.emb FROM derived a "
    + " ".join(f"LEFT JOIN enc_{v} e_{v} ON a.{v} = e_{v}.value" for v in CATS)
    + " LEFT JOIN embmap m ON coalesce(a.industry, '') = m.value)",
]
_FEAT_SUM = ("category_id_encoded + market_id_encoded + customer_id_encoded + publisher_encoded "
             "+ CPC + list_sum(emb)")


def _features(spark, sf, label=None):
    e = enc.fit_encoders(fit_rows(spark, sf), CATS, "frequency")
    return feat.preprocess(derived(spark, sf), e, industry_map(spark, sf), label=label)


@register("assemble_features", O.with_base(
    f"SELECT campaign_id, CAST(5 + len(emb) AS BIGINT) AS n_features, "
    f"round(category_id_encoded, 6) AS f_first, round(emb[len(emb)], 6) AS f_last, "
    f"round({_FEAT_SUM}, 4) AS f_sum FROM feat", *_FEAT_SQL))
def q_assemble_features(spark, sf):
    out = _features(spark, sf)
    return out.select("campaign_id", F.size("features").cast("bigint").alias("n_features"),
                      r(F.element_at("features", 1)).alias("f_first"),
                      r(F.element_at("features", -1)).alias("f_last"),
                      r(emb_sum("features"), 4).alias("f_sum"))


HASH_DIM = 16
_HASH_CTES = [
    "hv AS (SELECT DISTINCT coalesce(category_id, '') AS value FROM ads)",
    "ht AS (SELECT value, md5(t) AS h FROM (SELECT value, unnest(regexp_extract_all(lower(value), '[^ ]+')) AS t FROM hv))",
    f"hx AS (SELECT value, {O.hex_long('h', 8)} % {HASH_DIM} AS i, CASE WHEN substr(h, 9, 1) < '8' THEN 1.0 ELSE -1.0 END AS s FROM ht)",
    "hc AS (SELECT value, i, CAST(sum(s) AS DOUBLE) AS x FROM hx GROUP BY value, i)",
    "hn AS (SELECT value, sqrt(sum(x * x)) AS nrm FROM hc GROUP BY value)",
    "he AS (SELECT hc.value, sum(CASE WHEN nrm > 0 THEN (i + 1) * x / nrm ELSE 0 END) AS mark FROM hc JOIN hn USING (value) GROUP BY hc.value)",
]


def _mark(c):
    """Sum of place times value: tells vectors apart where a plain sum would not."""
    return F.aggregate(F.transform(F.col(c), lambda x, i: x * (i + 1)), F.lit(0.0), lambda a, x: a + x)


@register("embed_model", O.with_base(
    f"SELECT a.campaign_id, CAST({HASH_DIM} AS BIGINT) AS emb_dim, round(mark, 6) AS mark "
    "FROM ads a JOIN he ON coalesce(a.category_id, '') = he.value", *_HASH_CTES))
def q_embed_model(spark, sf):
    """Embeddings from a model (loaded once per worker) that sees each distinct value once."""
    out = embed_distinct(base(spark, sf), "category_id", hashing_model(HASH_DIM))
    return out.select("campaign_id", F.size("category_id_embedding").cast("bigint").alias("emb_dim"),
                      r(_mark("category_id_embedding")).alias("mark"))


@register("embed_memo", O.with_base(
    "SELECT hv.value, substr(md5(hv.value), 1, 1) < '8' AS was_known, "
    "round(CASE WHEN substr(md5(hv.value), 1, 1) < '8' THEN 2 ELSE 1 END * mark, 6) AS mark FROM hv JOIN he USING (value)",
    *_HASH_CTES))
def q_embed_memo(spark, sf):
    """A memo that knows part of the values (with vectors of its own, here twice the model's): the
    model runs for the others only, and the written memo holds every value once."""
    memo = EmbeddingMemo(scratch_path(spark, "memo"), hashing_embedder(HASH_DIM))
    rows = base(spark, sf)
    known = rows.select(F.coalesce("category_id", F.lit("")).alias("value")).distinct() \
        .where(F.substring(F.md5("value"), 1, 1) < "8")
    known = embed_distinct(known, "value", memo.model, "embedding")
    memo.add(known.select("value", F.transform("embedding", lambda x: 2 * x).alias("embedding")))
    embed_distinct(rows, "category_id", memo)
    out = spark.read.parquet(memo.path)  # as it was written, not as readers reduce it
    return out.select("value", (F.substring(F.md5("value"), 1, 1) < "8").alias("was_known"), r(_mark("embedding")).alias("mark"))


@register("assemble_two_embeddings", O.with_base(
    "SELECT f.campaign_id, CAST(5 + len(f.emb) + len(m.emb) AS BIGINT) AS n_features, round(m.emb[1], 6) AS second_first "
    "FROM feat f JOIN derived d USING (campaign_id) LEFT JOIN embmap2 m ON coalesce(d.category_id, '') = m.value", *_FEAT_SQL,
    "ind2 AS (SELECT value, CAST(row_number() OVER (ORDER BY value) - 1 AS BIGINT) AS i FROM "
    "(SELECT DISTINCT category_id AS value FROM ads WHERE category_id IS NOT NULL) "
    "UNION ALL SELECT '', (SELECT count(DISTINCT category_id) FROM ads))",
    "embmap2 AS (SELECT ind2.value, CAST(e.embedding AS DOUBLE[]) AS emb FROM ind2 JOIN embeddings e ON e.vec_id = ind2.i)"))
def q_assemble_two_embeddings(spark, sf):
    """Two text columns, each with its own embedding block."""
    e = enc.fit_encoders(fit_rows(spark, sf), CATS, "frequency")
    maps = {"industry": industry_map(spark, sf),
            "category_id": rank_map(base(spark, sf), "category_id", read_table(spark, sf, "embeddings"))}
    out = feat.preprocess(derived(spark, sf), e, maps, label=None, text=["industry", "category_id"])
    return out.select("campaign_id", F.size("features").cast("bigint").alias("n_features"),
                      r(F.element_at("features", 5 + 64 + 1)).alias("second_first"))


@register("disassemble_features", O.with_base(
    "SELECT campaign_id, round(CPC, 6) AS CPC, round(publisher_encoded, 6) AS publisher_encoded, "
    "CAST(len(emb) AS BIGINT) AS emb_len, round(emb[1], 6) AS emb_0 FROM feat", *_FEAT_SQL))
def q_disassemble_features(spark, sf):
    out = _features(spark, sf).select("campaign_id", "features")
    names = feat.feature_names(feat.PREDICTORS, feat.EMBEDDING, 64)
    back = feat.disassemble(out, names)
    return back.select("campaign_id", r("CPC").alias("CPC"), r("publisher_encoded").alias("publisher_encoded"),
                       F.size(feat.EMBEDDING).cast("bigint").alias("emb_len"),
                       r(F.element_at(feat.EMBEDDING, 1)).alias("emb_0"))


@register("select_predictors", O.with_base(
    "SELECT campaign_id, CAST(2 + len(emb) AS BIGINT) AS n_selected, round(CPC, 6) AS s_0, "
    "round(publisher_encoded, 6) AS s_1, round(emb[1], 6) AS s_2 FROM feat", *_FEAT_SQL))
def q_select_predictors(spark, sf):
    out = _features(spark, sf).select("campaign_id", "features")
    names = feat.feature_names(feat.PREDICTORS, feat.EMBEDDING, 64)
    sel = feat.select_by_name(out, ["CPC", "publisher_encoded", feat.EMBEDDING], names, out="sel")
    return sel.select("campaign_id", F.size("sel").cast("bigint").alias("n_selected"),
                      *[r(F.element_at("sel", i + 1)).alias(f"s_{i}") for i in range(3)])


_CW_CTE = ("cw AS (SELECT convert, CAST(sum(count(*)) OVER () AS DOUBLE) / "
           "(count(*) OVER () * count(*)) AS class_weight FROM derived GROUP BY convert)")


@register("feature_table", O.with_base(
    f"SELECT f.campaign_id, f.convert, round(cw.class_weight, 6) AS sample_weight, "
    f"CAST(5 + len(emb) AS BIGINT) AS n_features, round({_FEAT_SUM}, 4) AS f_sum "
    "FROM feat f JOIN cw USING (convert)", *_FEAT_SQL, _CW_CTE))
def q_feature_table(spark, sf):
    out = _features(spark, sf, label="convert")
    return out.select("campaign_id", F.col("convert").cast("bigint").alias("convert"),
                      r("sample_weight").alias("sample_weight"),
                      F.size("features").cast("bigint").alias("n_features"),
                      r(emb_sum("features"), 4).alias("f_sum"))


@register("class_weights", O.with_base(
    "SELECT convert, round(class_weight, 6) AS class_weight FROM cw", _CW_CTE))
def q_class_weights(spark, sf):
    w = feat.class_weights(derived(spark, sf), "convert")
    return w.select(F.col("convert").cast("bigint").alias("convert"), r("class_weight").alias("class_weight"))


@register("sample_weights", O.with_base(
    "SELECT campaign_id, round(class_weight, 6) AS sample_weight FROM derived JOIN cw USING (convert)",
    _CW_CTE))
def q_sample_weights(spark, sf):
    w = feat.sample_weights(derived(spark, sf), "convert")
    return w.select("campaign_id", r("sample_weight").alias("sample_weight"))


# --------------------------------------------------------------------------- requests

_REQ_SQL = [
    *O.EMB_CTES, *O.split_ctes("derived"),
    "trainrows AS (SELECT d.* FROM derived d JOIN splitv USING (campaign_id) WHERE split_type = 'train')",
    "testrows AS (SELECT d.* FROM derived d JOIN splitv USING (campaign_id) WHERE split_type = 'test')",
    *[O.freq_cte(f"enc_{v}", v, "trainrows", "TRUE") for v in CATS],
    "trec AS (SELECT market_id, publisher, median(CPC) AS CPC FROM trainrows "
    "WHERE market_id IS NOT NULL AND publisher IS NOT NULL GROUP BY market_id, publisher)",
    "tfb AS (SELECT median(CPC) AS m FROM trec)",
    "req AS (SELECT a.campaign_id, " + ", ".join(
        f"coalesce({O.encoded('a', v, 'e_' + v)}, 0) AS {v}_encoded" for v in CATS)
    + ", coalesce(CASE WHEN trec.market_id IS NOT NULL THEN trec.CPC ELSE tfb.m END, 0) AS CPC, m.emb "
    "FROM testrows a " + " ".join(f"LEFT JOIN enc_{v} e_{v} ON a.{v} = e_{v}.value" for v in CATS)
    + " LEFT JOIN trec ON a.market_id = trec.market_id AND a.publisher = trec.publisher "
    "CROSS JOIN tfb LEFT JOIN embmap m ON coalesce(a.industry, '') = m.value)",
]


def request_features(spark, sf):
    """Requests = the test split's ids; encoders and the CPC record come from
    the train split only (no leakage)."""
    d = derived(spark, sf)
    tagged = splits.split_shuffled(d, ["campaign_id"], TEST, SEED)
    # encoders, record and requests all read the split: hashed and compared once
    tagged = materialize(tagged.select("campaign_id", *CATS, "industry", "CPC", "split_type"), "requests-split")
    train = tagged.where(F.col("split_type") == "train")
    test = tagged.where(F.col("split_type") == "test")
    e = enc.fit_encoders(train, CATS, "frequency")
    rec = stats.cpc_record(train)
    reqs = test.select("campaign_id", *CATS, "industry")
    reqs = feat.impute_cpc(reqs, rec)
    reqs = enc.apply_encoders(reqs, e, CATS)
    reqs = embed_distinct(reqs, "industry", industry_map(spark, sf))
    return feat.assemble(reqs, feat.PREDICTORS, feat.EMBEDDING)


@register("request_features", O.with_base(
    f"SELECT campaign_id, CAST(5 + len(emb) AS BIGINT) AS n_features, round(CPC, 6) AS CPC, "
    f"round({_FEAT_SUM}, 4) AS f_sum FROM req", *_REQ_SQL))
def q_request_features(spark, sf):
    out = request_features(spark, sf)
    return out.select("campaign_id", F.size("features").cast("bigint").alias("n_features"),
                      r(F.element_at("features", 5)).alias("CPC"), r(emb_sum("features"), 4).alias("f_sum"))
