"""Categorical encoders as one long table ``(variable, value, enc)``.

Fitting is a single pass (unpivot the categorical columns, group by
``(variable, value)``); applying is one left join per variable with a match
flag, so an unseen category encodes to 0 while a null category stays null and
a matched-but-null statistic stays null. Encoder sides are broadcast only when
AQE measures it at run time (``spark.sql.adaptive.autoBroadcastJoinThreshold``);
larger ones stay sort-merge joins, with AQE splitting skewed keys.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.aggregates import resolve
from ..schema import require_columns
from ..session import settle
from .quantiles import group_quantiles

ENC_SCHEMA = "variable string, value string, enc double"
BROADCAST_BYTES = 1 << 18  # of one variable's rows


def fit_encoders(df: DataFrame, variables: Sequence[str], kind: str = "frequency",
                 target: str | None = None, stat="mean") -> DataFrame:
    """Long encoder table for all ``variables``: ``frequency`` = row count per
    non-null value; ``target`` = statistic of ``target`` per value (null
    targets skipped; order statistics exact and distributed)."""
    variables = list(variables)
    if kind not in ("frequency", "target"):
        raise NotImplementedError(f"encoder kind {kind!r} is unknown; use frequency or target")
    need = variables + ([target] if kind == "target" else [])
    require_columns(df, need, f"{kind} encoding")
    ids = ([] if kind == "frequency" else [F.col(target).cast("double").alias("_t")])
    long = (df.select(*[F.col(v).cast("string").alias(v) for v in variables], *ids)
              .unpivot(["_t"] if kind == "target" else [], variables, "variable", "value")
              .where(F.col("value").isNotNull()))
    if kind == "frequency":
        fitted = long.groupBy("variable", "value").agg(F.count(F.lit(1)).cast("double").alias("enc"))
    else:
        agg = resolve(stat)
        if isinstance(agg, float):
            fitted = group_quantiles(long, ["variable", "value"], "_t", {"enc": agg})
        else:
            fitted = long.groupBy("variable", "value").agg(agg(F.col("_t")).cast("double").alias("enc"))
    # fitted once: every per-variable lookup reads this one table
    return settle(fitted.select("variable", "value", F.col("enc").cast("double").alias("enc")))


def encoder_for(encoders: DataFrame, variable: str) -> DataFrame:
    """``(value, enc)`` rows of one variable (pruned by the partition filter)."""
    return encoders.where(F.col("variable") == variable).select("value", "enc")


def check_unique(encoder: DataFrame, key: str = "value") -> None:
    """External encoder tables must have one row per key ("first match" needs an
    order the table does not carry)."""
    dup = encoder.groupBy(key).count().where(F.col("count") > 1).limit(1).collect()
    if dup:
        raise ValueError(f"encoder has duplicate key {dup[0][key]!r}; de-duplicate it first")


def encode(df: DataFrame, column: str, encoder: DataFrame, out: str | None = None,
           key: str = "value", enc: str = "enc",
           validate: bool = False) -> DataFrame:
    """Add ``out`` (default ``<column>_encoded``): encoder value of ``column``;
    unseen -> 0.0, null -> null."""
    require_columns(df, [column], "encoding")
    out = out or f"{column}_encoded"
    if validate:
        check_unique(encoder, key)
    tag = f"__{out}"
    side = encoder.select(F.col(key).cast("string").alias(f"{tag}_k"),
                          F.col(enc).cast("double").alias(f"{tag}_v"),
                          F.lit(True).alias(f"{tag}_m"))
    j = df.join(side, F.col(column).cast("string") == F.col(f"{tag}_k"), "left")
    val = (F.when(F.col(column).isNull(), F.lit(None).cast("double"))
             .when(F.col(f"{tag}_m"), F.col(f"{tag}_v"))
             .otherwise(F.lit(0.0)))
    return j.withColumn(out, val).drop(f"{tag}_k", f"{tag}_v", f"{tag}_m")


def apply_encoders(df: DataFrame, encoders: DataFrame | Mapping[str, DataFrame],
                   variables: Sequence[str], suffix: str = "_encoded") -> DataFrame:
    """Encode several columns (a fold of ``encode``; encoder tables that
    the planner broadcasts by their size pipeline into one stage). ``encoders`` is the long table or ``{variable: (value, enc)}``."""
    small = set() if isinstance(encoders, Mapping) else _small(encoders)
    for v in variables:
        e = encoders[v] if isinstance(encoders, Mapping) else encoder_for(encoders, v)
        df = encode(df, v, F.broadcast(e) if v in small else e, f"{v}{suffix}")
    return df


def _small(encoders: DataFrame) -> set[str]:
    """The variables whose rows are few: the planner knows the size of the long table only, and would shuffle all rows
    for each of them beside one of many values."""
    size = F.sum(F.coalesce(F.octet_length("value"), F.lit(0)) + 32).alias("_b")
    return {x["variable"] for x in encoders.groupBy("variable").agg(size).where(F.col("_b") <= BROADCAST_BYTES).collect()}


def encoded_names(variables: Sequence[str], suffix: str = "_encoded") -> list[str]:
    return [f"{v}{suffix}" for v in variables]
