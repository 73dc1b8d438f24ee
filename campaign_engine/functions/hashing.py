"""Seeded, engine-independent row hashes used for splits, folds and picks.

``md5(seed || '|' || key...)`` is computed identically by Spark and by any SQL
engine with ``md5``, so membership decisions can be re-derived by an oracle.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F


def seeded_md5(keys: Sequence[str], seed: int) -> Column:
    """Hex md5 of ``seed|k1|k2...`` (keys cast to string)."""
    parts = [F.lit(str(seed))] + [F.col(k).cast("string") for k in keys]
    return F.md5(F.concat_ws("|", *parts))


def hex_prefix_to_long(h: Column, n_hex: int = 15) -> Column:
    """First ``n_hex`` hex digits as a non-negative BIGINT (max 15 -> 60 bits)."""
    if not 1 <= n_hex <= 15:
        raise ValueError("n_hex must be within 1..15")
    return F.conv(F.substring(h, 1, n_hex), 16, 10).cast("bigint")


def hash_fold(keys: Sequence[str], seed: int, k: int) -> Column:
    """Fold id in [0, k): first 8 hex digits of the seeded md5, modulo k."""
    return (hex_prefix_to_long(seeded_md5(keys, seed), 8) % F.lit(k)).cast("bigint")
