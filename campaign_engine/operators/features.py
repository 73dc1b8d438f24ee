"""Model-matrix assembly and helpers: assemble/disassemble feature arrays,
select predictors by name, class and sample weights, CPC imputation, and the
preprocess pipeline (weights -> encoders -> embedding -> assembly)."""

from __future__ import annotations

import re
from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..schema import CATEGORICAL_FEATURES, require_columns
from . import encoders as enc
from .embed import embed_distinct
from .quantiles import median
from ..session import settle

# Fixed predictor order shared by training and serving (assembled by name).
PREDICTORS = ["category_id_encoded", "market_id_encoded", "customer_id_encoded",
              "publisher_encoded", "CPC"]
EMBEDDING = "industry_embedding"


def _blocks(embedding) -> list[str]:
    """Names of the embedding columns: none, one or several."""
    return [] if not embedding else [embedding] if isinstance(embedding, str) else list(embedding)


def assemble(df: DataFrame, predictors: Sequence[str], embedding: str | Sequence[str] | None = EMBEDDING,
             target: str | None = None, out: str = "features",
             fill_missing: float | None = 0.0) -> DataFrame:
    """``out`` = [target] ++ scalars ++ embedding block(s), as ``array<double>``.

    The estimators reject missing values, so a missing scalar is filled with
    ``fill_missing`` (None keeps it null).
    """
    cols = list(predictors) + _blocks(embedding) + ([target] if target else [])
    require_columns(df, cols, "assembling features")

    def scalar(c):
        x = F.col(c).cast("double")
        return F.coalesce(x, F.lit(fill_missing)) if fill_missing is not None else x
    parts = ([F.array(scalar(target))] if target else []) + [F.array(*[scalar(c) for c in predictors])]
    for block in _blocks(embedding):
        doubles = df.schema[block].dataType == T.ArrayType(T.DoubleType())
        parts.append(F.col(block) if doubles else F.transform(F.col(block), lambda x: x.cast("double")))
    return df.withColumn(out, F.concat(*parts))


def feature_names(predictors: Sequence[str], embedding, dim: int | Mapping[str, int],
                  target: str | None = None) -> list[str]:
    """Names of the assembled entries; ``dim`` is one length or one per block."""
    names = ([target] if target else []) + list(predictors)
    for block in _blocks(embedding):
        names += [f"{block}_{i}" for i in range(dim[block] if isinstance(dim, Mapping) else dim)]
    return names


def positions(names: Sequence[str]) -> dict[str, int]:
    return {n: i for i, n in enumerate(names)}


def select_by_name(df: DataFrame, wanted: Sequence[str], all_names: Sequence[str],
                   col: str = "features", out: str | None = None) -> DataFrame:
    """Pick named entries of an assembled array (same call on train and test).
    A name may be that of an embedding block, whose entries ``<name>_0``,
    ``<name>_1``, ... are all there; they stay contiguous."""
    pos = positions(all_names)
    idx: list[int] = []
    missing = []
    for w in wanted:
        if w in pos:
            idx.append(pos[w])
        else:
            block = [i for n, i in pos.items() if re.fullmatch(re.escape(w) + r"_\d+", n)]
            if block and len(block) == 1 + max(int(all_names[i].rsplit("_", 1)[1]) for i in block):
                idx.extend(sorted(block))
            else:
                missing.append(w)
    if missing:
        raise ValueError(f"variables not in the feature matrix: {missing}")
    arr = F.array(*[F.element_at(F.col(col), i + 1) for i in idx])
    return df.withColumn(out or col, arr)


def disassemble(df: DataFrame, names: Sequence[str], embedding=EMBEDDING,
                col: str = "features") -> DataFrame:
    """Inverse of ``assemble``: scalar columns back by name and each embedding
    block as one array column."""
    blocks = {b: [i for i, n in enumerate(names) if re.fullmatch(re.escape(b) + r"_\d+", n)] for b in _blocks(embedding)}
    inside = {i for at in blocks.values() for i in at}
    cols = {n: F.element_at(F.col(col), i + 1) for i, n in enumerate(names) if i not in inside}
    cols |= {b: F.slice(F.col(col), at[0] + 1, len(at)) for b, at in blocks.items() if at}
    return df.withColumns(cols)


def class_weights(df: DataFrame, label: str) -> DataFrame:
    """Balanced weights ``n / (k * n_c)`` per class: ``(label, class_weight)``."""
    require_columns(df, [label], "class weights")
    counts = settle(df.groupBy(label).agg(F.count(F.lit(1)).alias("_nc")))
    tot = counts.agg(F.sum("_nc").alias("n"), F.count(F.lit(1)).alias("k")).first()
    n, k = tot["n"] or 0, tot["k"] or 0
    return counts.select(label, (F.lit(float(n)) / (F.lit(float(k)) * F.col("_nc"))).alias("class_weight"))


def sample_weights(df: DataFrame, label: str, out: str = "sample_weight",
                   weights: DataFrame | None = None) -> DataFrame:
    """Per-row weight of the row's class (weights from ``df`` unless given,
    e.g. the train split's). The class table is tiny; AQE broadcasts it from its
    measured size."""
    w = weights if weights is not None else class_weights(df, label)
    w = w.select(F.col(label).alias("__wl"), F.col("class_weight").alias(out))
    return df.join(w, F.col(label) == F.col("__wl"), "left").drop("__wl")


def impute_cpc(df: DataFrame, record: DataFrame, keys: Sequence[str] = ("market_id", "publisher"),
               cpc_col: str = "CPC", out: str = "CPC", fallback: float | None = None) -> DataFrame:
    """CPC from the (market, publisher) record table; a pair not in the table
    gets the median of the table's CPC column. A matched null stays null."""
    keys = list(keys)
    require_columns(df, keys, "CPC imputation")
    if fallback is None:
        fallback = median(record, cpc_col)
    side = record.select(*[F.col(k).cast("string").alias(f"__c_{k}") for k in keys],
                         F.col(cpc_col).cast("double").alias("__c_v"), F.lit(True).alias("__c_m"))
    cond = reduce(lambda a, b: a & b, [F.col(k).cast("string") == F.col(f"__c_{k}") for k in keys])
    j = df.join(side, cond, "left")
    val = F.when(F.col("__c_m"), F.col("__c_v")).otherwise(F.lit(fallback).cast("double"))
    drop = [f"__c_{k}" for k in keys] + ["__c_v", "__c_m"]
    return j.withColumn(out, val).drop(*[d for d in drop if d != out])


def preprocess(df: DataFrame, encoders: DataFrame, embedder, label: str | None = "convert",
               target: str | None = None, categorical: Sequence[str] = CATEGORICAL_FEATURES,
               numeric: Sequence[str] = ("CPC",), text: str | Sequence[str] = "industry",
               weights: DataFrame | None = None, assemble_out: bool = True) -> DataFrame:
    """Preprocess pipeline: sample weights (optional) -> apply the given
    encoders -> embed the text column(s) -> assemble ``features``. ``embedder`` is
    one for all text columns or a mapping from column to embedder."""
    out = df
    if label:
        out = sample_weights(out, label, weights=weights)
    out = enc.apply_encoders(out, encoders, categorical)
    texts = [text] if isinstance(text, str) else list(text)
    for t in texts:
        out = embed_distinct(out, t, embedder[t] if isinstance(embedder, Mapping) else embedder, f"{t}_embedding")
    if assemble_out:
        out = assemble(out, enc.encoded_names(categorical) + list(numeric),
                       [f"{t}_embedding" for t in texts], target=target)
    return out
