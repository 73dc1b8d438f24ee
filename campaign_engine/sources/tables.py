"""Driver tables and the ``ads`` campaign view derived from them.

The view text below is the single definition: Spark builds the same rows with
the DataFrame API, and the DuckDB oracle runs the text itself.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem",
          "events", "documents", "embeddings", "pages", "benchmark", "labels",
          "conversations"]

ADS_SQL = """
SELECT concat_ws('-', l_orderkey, l_partkey, l_suppkey, l_linenumber,
                 CAST(l_quantity AS BIGINT))                     AS campaign_id,
       p_type                                                    AS category_id,
       CAST(s_nationkey AS VARCHAR)                              AS market_id,
       CAST(o_custkey AS VARCHAR)                                AS customer_id,
       CASE WHEN l_quantity = 47 THEN NULL ELSE p_brand END      AS publisher,
       CASE WHEN l_quantity = 49 THEN NULL ELSE c_mktsegment END AS industry,
       CASE WHEN l_quantity = 50 THEN NULL
            WHEN l_discount = 0 THEN CAST(0 AS DOUBLE)
            ELSE l_extendedprice * l_discount END                AS cost,
       CAST(CAST(l_quantity AS BIGINT) % 5 AS BIGINT)            AS clicks,
       CAST(CASE WHEN l_quantity = 48 THEN NULL
            WHEN l_tax < 0.04 THEN 0
            ELSE l_linenumber END AS BIGINT)                     AS converions
FROM lineitem
JOIN orders   ON l_orderkey = o_orderkey
JOIN customer ON o_custkey  = c_custkey
JOIN part     ON l_partkey  = p_partkey
JOIN supplier ON l_suppkey  = s_suppkey
"""


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def ads(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Campaign rows: one per lineitem, ids as strings, nulls injected by rule.

    Only the needed columns are read from each table (ReadSchema pruning);
    the join strategy is left to AQE (dimension sides become broadcasts only
    when their runtime size is under the broadcast threshold).
    """
    li = read_table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity",
        "l_extendedprice", "l_discount", "l_tax")
    orders = read_table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey")
    customer = read_table(spark, sf_dir, "customer").select("c_custkey", "c_mktsegment")
    part = read_table(spark, sf_dir, "part").select("p_partkey", "p_type", "p_brand")
    supplier = read_table(spark, sf_dir, "supplier").select("s_suppkey", "s_nationkey")
    j = (li.join(orders, F.col("l_orderkey") == F.col("o_orderkey"))
           .join(customer, F.col("o_custkey") == F.col("c_custkey"))
           .join(part, F.col("l_partkey") == F.col("p_partkey"))
           .join(supplier, F.col("l_suppkey") == F.col("s_suppkey")))
    q = F.col("l_quantity")
    qi = q.cast("bigint")
    null_s = F.lit(None).cast("string")
    return j.select(
        F.concat_ws("-", *[F.col(c).cast("string") for c in
                           ("l_orderkey", "l_partkey", "l_suppkey", "l_linenumber")],
                    qi.cast("string")).alias("campaign_id"),
        F.col("p_type").alias("category_id"),
        F.col("s_nationkey").cast("string").alias("market_id"),
        F.col("o_custkey").cast("string").alias("customer_id"),
        F.when(q == 47, null_s).otherwise(F.col("p_brand")).alias("publisher"),
        F.when(q == 49, null_s).otherwise(F.col("c_mktsegment")).alias("industry"),
        F.when(q == 50, F.lit(None).cast("double"))
         .when(F.col("l_discount") == 0, F.lit(0.0))
         .otherwise(F.col("l_extendedprice") * F.col("l_discount")).alias("cost"),
        (qi % 5).cast("bigint").alias("clicks"),
        F.when(q == 48, F.lit(None).cast("bigint"))
         .when(F.col("l_tax") < 0.04, F.lit(0).cast("bigint"))
         .otherwise(F.col("l_linenumber").cast("bigint")).alias("converions"),
    )
