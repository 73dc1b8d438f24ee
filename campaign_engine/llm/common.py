"""Helpers shared by the operators: word rules, materialised intermediates,
hot-safe ranks and running sums, and connected components over edge tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..operators.ranks import global_rank
from ..session import cut_lineage, materialize, scratch_path, ship_package

__all__ = ["cut_lineage", "global_rank", "materialize", "scratch_path", "ship_package"]

SPACES = "[\\x20\\x09-\\x0D]+"
SPACE_CHARS = " \t\n\x0b\x0c\r"
MAX_ID = (1 << 63) - 1


def words(text: Column) -> Column:
    """Array of maximal runs outside space and U+0009..U+000D (null text: empty)."""
    t = F.btrim(F.coalesce(text, F.lit("")), F.lit(SPACE_CHARS))
    return F.when(t == "", F.array().cast("array<string>")).otherwise(F.split(t, SPACES))


def n_words(text: Column) -> Column:
    return F.size(words(text)).cast("long")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


BATCH_BYTES = 2 << 20


def arrow_batches(spark: SparkSession) -> None:
    """Bound Arrow batches by bytes (a session setting), so that a batch of long
    texts fits a Python worker while rows of numbers still come in large
    batches. A smaller bound set by the user stays."""
    key = "spark.sql.execution.arrow.maxBytesPerBatch"
    now = spark.conf.get(key).lower().removesuffix("b")
    if not now.isdigit() or int(now) > BATCH_BYTES or int(now) == 0:
        spark.conf.set(key, str(BATCH_BYTES))


def hash_sample(df: DataFrame, key: Column, n: int) -> DataFrame:
    """The (at most) ``n`` rows whose md5 of ``key`` is smallest. The table is first
    cut down by a threshold on the hash, about 4 n rows, so that not every
    partition hands ``n`` rows on."""
    total = df.count()
    rows = df.withColumn("__h", F.md5(key.cast("string")))
    if total > 4 * n:
        low = F.conv(F.substring("__h", 1, 13), 16, 10).cast("long")
        rows = rows.filter(low < int(4 * n / total * (1 << 52)))
    return rows.orderBy("__h").limit(n).drop("__h")


def parts(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def running_sum(df: DataFrame, group: list[str], bucket: str, order: list, value: str,
                name: str, rank: str | None = None) -> DataFrame:
    """Sum of ``value`` before each row, in (``bucket``, ``order``) order inside
    each ``group``. Buckets cut a hot group into many tasks: bucket totals are
    pre-aggregated, their offsets are summed over the few buckets of a group,
    and only rows of one bucket meet in a task. ``df`` should be materialised.
    ``rank`` also numbers the rows of each bucket."""
    totals = df.groupBy(*group, bucket).agg(F.sum(value).alias("__t"))
    w = Window.partitionBy(*group).orderBy(bucket).rowsBetween(Window.unboundedPreceding, -1)
    offsets = totals.withColumn("__off", F.coalesce(F.sum("__t").over(w), F.lit(0))).drop("__t")
    inner = Window.partitionBy(*group, bucket).orderBy(*order)
    out = df.withColumn(name, F.coalesce(
        F.sum(value).over(inner.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)))
    if rank:
        out = out.withColumn(rank, F.row_number().over(inner))
    return (out.join(offsets, [*group, bucket])
            .withColumn(name, F.col(name) + F.col("__off")).drop("__off"))


def components(edges: DataFrame, max_rounds: int = 200) -> DataFrame:
    """Smallest reachable node of every node of an undirected edge table.

    ``edges``: (a, b) of one orderable type. Alternating large-star and
    small-star rounds; each round pre-aggregates minima by node and joins them
    back, so a node with very many links is never gathered in one task. Every
    round is written to the checkpoint folder. Returns (node, root); nodes
    without links are absent. Ends when a round changes nothing, and raises
    if that takes more than ``max_rounds`` rounds (a fault, not a cut-off:
    the rounds needed grow with the logarithm of the longest path).
    """
    def star(e: DataFrame, large: bool) -> DataFrame:
        # e: (u, v) with u > v; large-star looks at both directions
        both = e.select("u", "v").unionByName(e.select(F.col("v").alias("u"), F.col("u").alias("v"))) \
            if large else e
        low = both.groupBy("u").agg(F.min("v").alias("m")).withColumn("m", F.least("m", "u"))
        j = both.join(low, "u")
        if large:
            out = j.filter(F.col("v") > F.col("u")).select(F.col("v").alias("u"), F.col("m").alias("v"))
        else:
            out = (j.filter(F.col("v") != F.col("m")).select(F.col("v").alias("u"), F.col("m").alias("v"))
                   .unionByName(low.select("u", F.col("m").alias("v"))))
        return out.filter(F.col("u") != F.col("v")).distinct()

    cur = edges.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")) \
        .filter(F.col("u") != F.col("v")).distinct()
    cur = cut_lineage(cur)

    def mark(e: DataFrame):
        r = e.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        return r[0], r[1]

    before = mark(cur)
    for _ in range(max_rounds):
        if before[0] == 0:
            break
        cur = cut_lineage(star(star(cur, True), False))
        now = mark(cur)
        if now == before:
            break
        before = now
    else:
        raise RuntimeError("connected components did not settle")
    roots = cur.select(F.col("u").alias("node"), F.col("v").alias("root"))
    return roots.unionByName(roots.select(F.col("root").alias("node"), "root").distinct())


