"""Configuration search: exploit (most-used market/publisher pairs), explore
(unused pairs), hybrid, candidate space per request, scoring and argmin.

No cross joins: the candidate list (top-k: its length is the caller's choice)
and the publisher dictionary are one array value from a scalar subquery, which
each row explodes; neither passes through the driver.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..schema import require_columns
from .stats import config_usage

KEYS = ["market_id", "publisher"]


def top_k_configs(usage: DataFrame, k: int = 5, by: str = "n_campaigns",
                  keys: Sequence[str] = KEYS) -> DataFrame:
    """The k most used configurations (ties: smaller key first)."""
    require_columns(usage, [by, *keys], "top configurations")
    return usage.orderBy(F.desc(by), *keys).limit(k)


def candidate_space(requests: DataFrame, configs: DataFrame, keys: Sequence[str] = KEYS) -> DataFrame:
    """Every request paired with every candidate configuration: the candidate
    list is one array that each request explodes, a narrow projection. An
    empty candidate list raises ValueError."""
    keys = list(keys)
    if configs.isEmpty():
        raise ValueError("the candidate list is empty")
    arr = configs.agg(F.array_sort(F.collect_list(F.struct(*[F.col(k).cast("string").alias(k) for k in keys])))).scalar()
    base = requests.drop(*[k for k in keys if k in requests.columns])
    return base.withColumn("_cfg", F.explode(arr)).select("*", *[F.col(f"_cfg.{k}").alias(k) for k in keys]).drop("_cfg")


def explore_configs(df: DataFrame, keys: Sequence[str] = KEYS, usage_ratio: float | None = None) -> DataFrame:
    """(market, publisher) pairs that are not in use. With ``usage_ratio`` a pair
    counts as in use only from that multiple of the average usage on. The
    publishers are exploded onto the distinct markets; the pairs in use are
    removed with an anti join."""
    m, p = keys
    existing = config_usage(df, keys)
    if usage_ratio is not None:
        avg_use = existing.agg(F.avg("n_campaigns")).first()[0] or 0.0
        existing = existing.where(F.col("n_campaigns") >= usage_ratio * avg_use)
    pubs = df.where(F.col(p).isNotNull()).agg(F.array_sort(F.collect_set(F.col(p).cast("string")))).scalar()
    markets = df.where(F.col(m).isNotNull()).select(m).distinct()
    return markets.withColumn(p, F.explode(pubs)).join(existing.select(m, p), [m, p], "left_anti")


def hybrid_configs(exploit: DataFrame, explore: DataFrame, keys: Sequence[str] = KEYS) -> DataFrame:
    """Exploit set united with the explore set, one row per configuration."""
    keys = list(keys)
    return exploit.select(*keys).unionByName(explore.select(*keys)).dropDuplicates(keys)


def recommend(scored: DataFrame, request_keys: Sequence[str], score: str = "predicted_cpa",
              keys: Sequence[str] = KEYS) -> DataFrame:
    """Per request, the configuration with the lowest score (ties: smaller key).
    Candidates without a score are passed over, and a request without any
    scored candidate gets null. An empty candidate set raises ValueError."""
    keys = list(keys)
    if scored.isEmpty():
        raise ValueError("there is no candidate to choose from")
    order = F.struct(F.col(score), *[F.col(k) for k in keys])
    pick = F.when(F.col(score).isNotNull(), F.struct(*keys, score))
    best = scored.groupBy(*request_keys).agg(
        F.min_by(pick, F.when(F.col(score).isNotNull(), order)).alias("_b"))
    return best.select(*request_keys, *[F.col(f"_b.{c}").alias(c) for c in keys + [score]])
