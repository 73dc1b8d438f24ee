"""Sharding by jump consistent hashing (native DataFrame functions only).

A stable key walks the published jump sequence: a 64-bit linear congruential
generator seeded by the key proposes ever larger shards, and the last one
below the shard count is taken. There is no ring table, the shard depends on
key and shard count alone, and appending a shard moves rows only into it.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import IntegralType

from .common import global_rank, materialize

#: fixed values of the published generator
LCG = 2862933555777941757
WORD = 1 << 64

BROADCAST_SHARDS = 1_000_000
FIRST_STEPS = 64  # jumps tried before the rest of the sequence is unrolled


def _fold(state: str, steps: int, n: int) -> str:
    return f"""aggregate(sequence(1, {steps}), {state}, (s, i) -> CASE WHEN s.j >= {n} THEN s ELSE
        transform(array(CAST(pmod(s.k * CAST({LCG} AS DECIMAL(19,0)) + CAST(1 AS DECIMAL(1,0)),
                                  CAST({WORD} AS DECIMAL(20,0))) AS DECIMAL(20,0))),
          k -> named_struct('k', k, 'b', s.j, 'j', CAST(floor(CAST(s.j + 1 AS DOUBLE)
              * (2147483648D / CAST((k div CAST(8589934592 AS DECIMAL(20,0))) + 1 AS DOUBLE))) AS BIGINT)))[0]
        END)"""


def jump(key: str, n: int) -> Column:
    """Struct (b, j): shard of the bigint expression ``key`` among ``n`` shards,
    and the first proposal not below ``n``."""
    start = f"""named_struct('k', CAST(CASE WHEN {key} < 0 THEN CAST({key} AS DECIMAL(20,0)) + CAST({WORD} AS DECIMAL(20,0))
        ELSE CAST({key} AS DECIMAL(20,0)) END AS DECIMAL(20,0)), 'b', -1L, 'j', 0L)"""
    first = _fold(start, min(n, FIRST_STEPS), n)
    if n <= FIRST_STEPS:  # every jump advances, so n steps always suffice
        return F.expr(first)
    rest = _fold("f", n, n)
    return F.expr(f"transform(array({first}), f -> CASE WHEN f.j < {n} THEN {rest} ELSE f END)[0]")


def assign(df: DataFrame, n_shards: int = 8, key: str = "doc_id", text: str = "text",
           keep: list[str] | None = None) -> DataFrame:
    """Shard, slot and grown shard of every row.

    Returns the columns ``keep`` (default: all but ``text``) plus ``size`` (UTF-8
    bytes of the text plus 1), ``text_crc32``, ``shard``, ``slot`` (gapless from
    0 inside each shard, in the order of md5(key), key, crc, size) and
    ``grown_shard`` (the shard with one more shard). Columns of ``keep`` that
    carry one of these names are replaced.

    Null text: no bytes (size 1, crc 0). Null key: hashed as -1. Keys that are
    not integers go through xxhash64. Repeated rows share the shard and get
    slots of their own; rows that agree in all four order columns take
    theirs in the order of the input. An empty table gives an empty result. Slots are
    ranks over range partitions, which split a shard and a hot key alike, so
    no task holds either and the order is the same at every size.
    """
    if n_shards < 1:
        raise ValueError("n_shards must be positive")
    made = ["size", "text_crc32", "shard", "slot", "grown_shard"]
    keep = [c for c in (keep if keep is not None else [c for c in df.columns if c != text])]
    k = F.col(key)
    if not isinstance(df.schema[key].dataType, IntegralType):
        k = F.xxhash64(k.cast("string"))
    k = F.coalesce(k.cast("long"), F.lit(-1).cast("long"))
    body = F.coalesce(F.col(text), F.lit(""))
    rows = df.select(F.struct(*[F.col(c) for c in keep]).alias("__keep"), k.alias("__key"),
                     (F.octet_length(body).cast("long") + 1).alias("__size"),
                     F.crc32(F.encode(body, "utf-8")).alias("__crc"))
    rows = rows.withColumn("__md5", F.md5(F.col("__key").cast("string"))) \
        .withColumn("__jump", jump("__key", n_shards)) \
        .withColumn("__shard", F.col("__jump.b").cast("int")) \
        .withColumn("__grown", F.when(F.col("__jump.j") == n_shards, F.lit(n_shards))
                    .otherwise(F.col("__jump.b")).cast("int")).drop("__jump")
    rows = rows.withColumn("__row", F.monotonically_increasing_id())
    order = [F.col(c) for c in ("__shard", "__md5", "__key", "__crc", "__size", "__row")]
    ranked = global_rank(rows, order, "__rank")
    first = materialize(ranked.groupBy("__shard").agg(F.min("__rank").alias("__first")), "shard_starts")
    first = F.broadcast(first) if n_shards <= BROADCAST_SHARDS else first  # a row per shard at most
    out = ranked.join(first, "__shard").withColumn("__slot", F.col("__rank") - F.col("__first"))
    return out.select(*[F.col("__keep")[c].alias(c) for c in keep if c not in made],
                      F.col("__size").alias("size"), F.col("__crc").alias("text_crc32"),
                      F.col("__shard").alias("shard"), F.col("__slot").cast("long").alias("slot"),
                      F.col("__grown").alias("grown_shard"))


def write_shards(df: DataFrame, path: str, n_shards: int = 8, key: str = "doc_id",
                 text: str = "text", max_rows_per_file: int = 1_000_000) -> DataFrame:
    """Write every row under ``path/shard=<n>/`` in slot order and return the
    written table. Each shard is cut into ranges of slots, so that a shard is
    written by many tasks."""
    out = assign(df, n_shards, key, text, keep=df.columns)
    (out.withColumn("__piece", F.floor(F.col("slot") / max_rows_per_file))
        .repartition("shard", "__piece").sortWithinPartitions("shard", "slot").drop("__piece")
        .write.mode("overwrite").partitionBy("shard").parquet(path))
    return df.sparkSession.read.parquet(path)
