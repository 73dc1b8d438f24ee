"""Two-stage model: a kNN conversion classifier whose probability becomes a
predictor of a kNN log-CPA regressor; batch scoring of requests.

The fitted "model" is plain data: the encoder tables, the CPC record, the
embedding map and the two kNN reference tables (features + label). Training
rows and requests go through the same feature plans, assembled by name.
"""

from __future__ import annotations

import json
import os
from dataclasses import dataclass

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..schema import CATEGORICAL_FEATURES
from . import encoders as enc
from . import features as feat
from . import knn, stats
from .embed import distinct_vectors, embed_distinct, with_vectors
from .quantiles import median
from ..session import materialize, spread

STAGE1 = enc.encoded_names(CATEGORICAL_FEATURES) + ["CPC"]
STAGE2 = enc.encoded_names(CATEGORICAL_FEATURES) + ["CPC", "proba_convert"]


@dataclass
class TwoStageModel:
    freq_encoders: DataFrame
    target_encoders: DataFrame
    cpc_record: DataFrame
    cpc_fallback: float | None
    embedder: DataFrame
    clf_ref: DataFrame   # id, features, convert
    reg_ref: DataFrame   # id, features, log_CPA
    k: int = 5
    id_col: str = "campaign_id"


def stage1_features(df: DataFrame, freq: DataFrame, embedder) -> DataFrame:
    out = stage1_codes(df, freq)
    return feat.assemble(embed_distinct(out, "industry", embedder), STAGE1, feat.EMBEDDING)


def stage1_codes(df: DataFrame, freq: DataFrame) -> DataFrame:
    """Rows with their encoded categories: all of the features but the embedding. Rows are written and shuffled in
    this form; vectors are made from it where they are read (``_assembled``)."""
    return enc.apply_encoders(spread(df), freq, CATEGORICAL_FEATURES)


def stage2_codes(df: DataFrame, target_enc: DataFrame) -> DataFrame:
    """Expects stage-1 codes plus ``proba_convert``; re-encodes the categories
    with the target (median log-CPA) encoders."""
    return enc.apply_encoders(df.drop(*enc.encoded_names(CATEGORICAL_FEATURES)), target_enc, CATEGORICAL_FEATURES)


def _assembled(codes: DataFrame, vectors: DataFrame, predictors: list[str]) -> DataFrame:
    return feat.assemble(with_vectors(codes, "industry", vectors, feat.EMBEDDING), predictors, feat.EMBEDDING)


def augment_proba(rows: DataFrame, clf_ref: DataFrame, k: int, id_col: str,
                  out: str = "proba_convert", to: DataFrame | None = None) -> DataFrame:
    """Append P(convert = 1) from the kNN classifier (float column) to ``rows``, or to the narrower
    rows ``to`` of the same ids."""
    p = knn.knn_classify(rows, clf_ref, k, id_col, id_col, "convert", positive=1)
    p = p.select(F.col(id_col).alias("__pid"), F.col("probability").cast("double").alias(out))
    return (rows if to is None else to).join(p, F.col(id_col) == F.col("__pid"), "left").drop("__pid")


def augmented(rows: DataFrame, freq: DataFrame, embedder, clf_ref: DataFrame, k: int, id_col: str) -> DataFrame:
    """Stage 1 of ``rows``: their features and the probability."""
    codes = materialize(stage1_codes(rows, freq), "stage1-rows")
    vectors = distinct_vectors(codes, "industry", embedder)
    p = augment_proba(_assembled(codes, vectors, STAGE1), clf_ref, k, id_col, to=codes)
    return _assembled(p, vectors, STAGE1)


def fit_two_stage(train: DataFrame, embedder, k: int = 5, id_col: str = "campaign_id") -> TwoStageModel:
    """``train``: derived campaign rows (CPA, CPC, convert) of the train split."""
    freq = enc.fit_encoders(train, CATEGORICAL_FEATURES, "frequency")
    codes = materialize(stage1_codes(train, freq), "stage1-train")
    vectors = distinct_vectors(codes, "industry", embedder)
    s1 = _assembled(codes, vectors, STAGE1)
    clf_ref = s1.select(id_col, "features", "convert")
    # the augmented train rows feed both the target encoders and the regressor
    codes = materialize(augment_proba(clf_ref, clf_ref, k, id_col, to=codes), "stage1-augmented")
    logged = codes.withColumn("log_CPA", F.log1p("CPA"))
    tgt = enc.fit_encoders(logged, CATEGORICAL_FEATURES, "target", target="log_CPA", stat="median")
    s2 = _assembled(stage2_codes(logged.where(F.col("log_CPA").isNotNull()), tgt), vectors, STAGE2)
    reg_ref = s2.select(id_col, "features", "log_CPA")
    rec = stats.cpc_record(train)
    return TwoStageModel(freq, tgt, rec, median(rec, "CPC"), embedder, clf_ref, reg_ref, k, id_col)


def predict(model: TwoStageModel, rows: DataFrame, impute_cpc: bool = True) -> DataFrame:
    """Score rows carrying the categorical ids and industry (and CPC unless
    imputed): adds ``proba_convert``, ``predicted_log_cpa``, ``predicted_cpa``."""
    id_col = model.id_col
    if impute_cpc:
        rows = feat.impute_cpc(rows.drop("CPC") if "CPC" in rows.columns else rows,
                               model.cpc_record, fallback=model.cpc_fallback)
    encoded = enc.encoded_names(CATEGORICAL_FEATURES)
    given = [c for c in rows.columns if c not in encoded]
    codes = materialize(stage1_codes(rows, model.freq_encoders), "stage1-rows")
    vectors = distinct_vectors(codes, "industry", model.embedder)
    p = augment_proba(_assembled(codes, vectors, STAGE1), model.clf_ref, model.k, id_col, to=codes)
    codes = materialize(stage2_codes(p, model.target_encoders), "stage2-rows")
    reg = knn.knn_regress(_assembled(codes, vectors, STAGE2), model.reg_ref, model.k, id_col, id_col, "log_CPA")
    reg = reg.select(F.col(id_col).alias("__rid"), F.col("prediction").alias("predicted_log_cpa"))
    out = codes.join(reg, F.col(id_col) == F.col("__rid"), "left").drop("__rid")
    out = _assembled(out, vectors, STAGE2).withColumn("predicted_cpa", F.expm1("predicted_log_cpa"))
    return out.select(*given, feat.EMBEDDING, "proba_convert", *encoded, "features", "predicted_log_cpa", "predicted_cpa")


_TABLES = ["freq_encoders", "target_encoders", "cpc_record", "embedder", "clf_ref", "reg_ref"]


def save_two_stage(model: TwoStageModel, path: str) -> None:
    """Write the fitted tables (encoders, CPC record, embedding map, both reference
    tables) and the scalars under ``path``. The embedder must be a table."""
    if not isinstance(model.embedder, DataFrame):
        raise ValueError("only a model whose embedder is a (value, embedding) table can be saved")
    for name in _TABLES:
        getattr(model, name).write.mode("overwrite").parquet(os.path.join(path, name))
    meta = json.dumps({"cpc_fallback": model.cpc_fallback, "k": model.k, "id_col": model.id_col})
    spark = model.clf_ref.sparkSession
    spark.createDataFrame([(meta,)], "meta string").coalesce(1).write.mode("overwrite").text(os.path.join(path, "meta"))


def load_two_stage(spark: SparkSession, path: str) -> TwoStageModel:
    """A saved two-stage model; a missing path raises ValueError."""
    try:
        meta = json.loads(spark.read.text(os.path.join(path, "meta")).first()[0])
    except AnalysisException as e:
        raise ValueError(f"no two-stage model at {path}") from e
    return TwoStageModel(**{n: spark.read.parquet(os.path.join(path, n)) for n in _TABLES}, **meta)
