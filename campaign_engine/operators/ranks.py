"""Gapless ranks over a whole table in any order, without a single-task sort.

Rows are range-partitioned by the order key and written once; the sizes of the
range partitions (one row each) give every partition its offset, and each
partition is numbered (or summed) on its own.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import materialize


def global_rank(df: DataFrame, order: list[Column], out: str = "_rank") -> DataFrame:
    """Add the 0-based rank of every row by ``order``, which should identify
    rows (equal keys share a partition and are numbered in any order). Rows are
    shuffled once: each range partition is sorted and numbered as it is written."""
    n = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    cut = df.repartitionByRange(n, *order).sortWithinPartitions(*order) \
            .withColumn("_mid", F.monotonically_increasing_id())  # partition number and place in it
    cut = materialize(cut, "ranked")
    pid, place = F.shiftrightunsigned("_mid", 33), F.col("_mid").bitwiseAND(F.lit((1 << 33) - 1))
    sizes = cut.groupBy(pid.alias("_pid")).agg(F.count(F.lit(1)).alias("_pn"))
    offsets = sizes.withColumn("_off", F.sum("_pn").over(Window.orderBy("_pid")) - F.col("_pn")).drop("_pn")
    # one small row per range partition: small enough to be sent to every task
    return (cut.withColumn("_pid", pid).join(F.broadcast(offsets), "_pid")
               .withColumn(out, (F.col("_off") + place).cast("bigint")).drop("_pid", "_off", "_mid"))


def running_total(df: DataFrame, order: list[Column], value: str, out: str) -> DataFrame:
    """Add the sum of ``value`` over all rows before each row in ``order``, by range
    partitions as in ``global_rank``."""
    n = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    cut = materialize(df.repartitionByRange(n, *order).withColumn("_pid", F.spark_partition_id()), "ranked")
    sizes = cut.groupBy("_pid").agg(F.sum(value).alias("_pn"))
    offsets = sizes.withColumn("_off", F.sum("_pn").over(Window.orderBy("_pid")) - F.col("_pn")).drop("_pn")
    w = Window.partitionBy("_pid").orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    return (cut.join(F.broadcast(offsets), "_pid").withColumn(out, F.col("_off") + F.coalesce(F.sum(value).over(w), F.lit(0)))
               .drop("_pid", "_off"))
