"""Deterministic train/test splits and cross-validation folds.

Membership is defined by a seeded md5 of the row key, so any engine can
re-derive it. The test set is the ``n_test = ceil(test_size * n)`` rows with
the smallest hash (per stratum when stratified). No global sort and no
unpartitioned window: the boundary is a k-th value (``quantiles``).
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark import StorageLevel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.hashing import hash_fold, hex_prefix_to_long, seeded_md5
from ..schema import require_columns
from ..session import settle
from .quantiles import apply_boundary, global_boundary, hash_ranks, smallest_boundary
from .ranks import global_rank

SPLIT_COL = "split_type"
# 13 hex digits = 52 bits: exactly representable as a double inside the k-th search
ORDER_HEX = 13


def _with_hash(df: DataFrame, key_cols: Sequence[str], seed: int) -> DataFrame:
    return (df.withColumn("_h", seeded_md5(key_cols, seed))
              .withColumn("_h60", hex_prefix_to_long(F.col("_h"), ORDER_HEX)))


def stratum_quota(counts: DataFrame, strata: Sequence[str], test_size: float) -> DataFrame:
    """Test rows per stratum, ``strata..., _q``: n_test = ceil(test_size * n) shared
    by largest remainder of n_test * n_s / n (integer arithmetic; ties: stratum
    order, null first). ``counts`` is the per-stratum count table ``strata...,
    _n``; only its total reaches the driver."""
    total = counts.agg(F.sum("_n")).first()[0] or 0
    n_test = int(math.ceil(float(test_size) * total))
    share = F.col("_n").cast("decimal(38,0)") * F.lit(n_test)
    base = F.floor(share / F.lit(max(total, 1)).cast("decimal(38,0)")).cast("bigint")
    q = counts.withColumn("_base", base)
    q = q.withColumn("_rem", (share - F.col("_base").cast("decimal(38,0)") * F.lit(total)).cast("decimal(38,0)"))
    left = n_test - (q.agg(F.sum("_base")).first()[0] or 0)
    q = global_rank(q, [F.col("_rem").desc(), *[F.col(s).asc_nulls_first() for s in strata]], "_o")
    return q.select(*strata, (F.col("_base") + (F.col("_o") < left).cast("bigint")).alias("_q"))


def split_shuffled(df: DataFrame, key_cols: Sequence[str], test_size: float = 0.2,
                   seed: int = 2025, stratify: str | None = None,
                   split_col: str = SPLIT_COL) -> DataFrame:
    """Tag every row ``train`` or ``test``. Data rows are only hashed, compared to
    a boundary and tagged. ``stratify`` keeps class proportions (largest
    remainder); a null class is a class. ``key_cols`` must identify rows: if
    the boundary falls among rows with equal keys, ValueError is raised."""
    if not 0.0 < test_size < 1.0:
        raise RuntimeError(f"test_size must be in (0, 1), got {test_size}")
    require_columns(df, list(key_cols) + ([stratify] if stratify else []), "a split")
    strata = [stratify] if stratify else []
    hashed = _with_hash(df, key_cols, seed)
    # the hash feeds every boundary job: computed once while they run
    keyed = hashed.select(*strata, "_h", "_h60").persist(StorageLevel.MEMORY_AND_DISK)
    try:
        if strata:
            counts = settle(keyed.groupBy(*strata).agg(F.count(F.lit(1)).alias("_n")))
            quota = settle(stratum_quota(counts, strata, test_size))
            bound = smallest_boundary(keyed, strata, "_h60", "_h", quota, counts=counts)
        else:
            n = keyed.count()
            bound = global_boundary(keyed, "_h60", "_h", n, int(math.ceil(float(test_size) * n)))
    finally:
        keyed.unpersist()
    taken = apply_boundary(hashed, strata, "_h60", "_h", bound, flag="_test")
    return (taken.withColumn(split_col, F.when(F.col("_test"), "test").otherwise("train"))
                 .drop("_h", "_h60", "_test"))


def split_stratified(df: DataFrame, key_cols: Sequence[str], stratify: str,
                     test_size: float = 0.2, seed: int = 2025, shuffle: bool = True,
                     split_col: str = SPLIT_COL) -> DataFrame:
    """Stratified split; stratifying without shuffling is an error."""
    if not shuffle:
        raise RuntimeError("Stratified train/test split is not implemented for shuffle=False")
    return split_shuffled(df, key_cols, test_size, seed, stratify, split_col)


def split_ordered(df: DataFrame, order_cols: Sequence[str], test_size: float = 0.2,
                  split_col: str = SPLIT_COL) -> DataFrame:
    """``shuffle=False``: the *last* ``ceil(test_size * n)`` rows in the order of
    ``order_cols`` (nulls first) are the test set. Rows with equal order keys
    are ordered by a hash of all their columns; when even equal rows straddle
    the boundary, the rows themselves are ranked and tagged."""
    if not 0.0 < test_size < 1.0:
        raise RuntimeError(f"test_size must be in (0, 1), got {test_size}")
    require_columns(df, order_cols, "an ordered split")
    n = df.count()
    n_train = n - int(math.ceil(float(test_size) * n))
    if n == 0 or n_train <= 0:
        return df.withColumn(split_col, F.lit("test"))
    names = [f"k{i}" for i in range(len(order_cols))] + ["h"]
    key = [F.col(c).alias(k) for c, k in zip(order_cols, names)] + [F.xxhash64(*df.columns).alias("h")]
    ranked = global_rank(df.select(*key), [F.col(k).asc_nulls_first() for k in names])
    edge = {r["_rank"]: r for r in ranked.where(F.col("_rank").isin(n_train - 1, n_train)).collect()}
    first = edge[n_train]
    types = dict(ranked.dtypes)
    if all(first[k] == edge[n_train - 1][k] for k in names):
        rows = df.withColumn("_oh", F.xxhash64(*df.columns))
        rows = global_rank(rows, [F.col(c).asc_nulls_first() for c in (*order_cols, "_oh")], "_or")
        return rows.withColumn(split_col, F.when(F.col("_or") >= n_train, "test").otherwise("train")).drop("_oh", "_or")
    # lexicographic comparison with the first test row, nulls first
    after = F.lit(True)
    for k, c in reversed(list(zip(names, key))):
        x, v = c, F.lit(first[k]).cast(types[k])
        if first[k] is None:
            after = F.when(x.isNull(), after).otherwise(F.lit(True))
        else:
            after = F.when(x.isNull() | (x < v), F.lit(False)).when(x == v, after).otherwise(F.lit(True))
    return df.withColumn(split_col, F.when(after, "test").otherwise("train"))


def cv_folds(df: DataFrame, key_cols: Sequence[str], k: int = 5, seed: int = 2025,
             fold_col: str = "fold") -> DataFrame:
    """Hash folds: fold = first 8 hex digits of md5(seed|key) mod k. A pure
    projection -- no shuffle at all."""
    if k < 1:
        raise ValueError("k must be at least 1")
    return df.withColumn(fold_col, hash_fold(key_cols, seed, k))


def cv_folds_stratified(df: DataFrame, key_cols: Sequence[str], label: str, k: int = 5,
                        seed: int = 2025, fold_col: str = "fold") -> DataFrame:
    """Stratified folds: within each class, rows in hash order are dealt
    round-robin, fold = rank mod k, so every fold holds floor/ceil(n_c/k) rows
    of each class (a null label is a class). Ranks come from bucketed hash ranking (``hash_ranks``)."""
    if k < 2:
        raise ValueError("k must be at least 2")
    hashed = _with_hash(df, key_cols, seed)
    ranked = hash_ranks(hashed, [label], "_h60", "_h", "_rk")
    return (ranked.withColumn(fold_col, (F.col("_rk") % k).cast("bigint"))
                  .drop("_h", "_h60", "_rk"))


def cv_folds_contiguous(df: DataFrame, key_cols: Sequence[str], k: int = 5,
                        seed: int = 2025, fold_col: str = "fold",
                        order_cols: Sequence[str] | None = None) -> DataFrame:
    """K-fold in contiguous blocks over the order of ``order_cols`` (nulls first, which should
    identify rows, such as a file position) or, without them, over hash order: the first n mod k folds
    hold floor(n/k)+1 rows, the rest floor(n/k)."""
    if k < 2:
        raise ValueError("k must be at least 2")
    n = df.count()
    base, extra = divmod(n, k)
    if order_cols:
        require_columns(df, order_cols, "contiguous folds")
        ranked = global_rank(df, [F.col(c).asc_nulls_first() for c in order_cols], "_rk")
    else:
        ranked = hash_ranks(_with_hash(df, key_cols, seed), [], "_h60", "_h", "_rk").drop("_h", "_h60")
    big = (base + 1) * extra
    fold = F.when(F.col("_rk") < big, F.floor(F.col("_rk") / (base + 1))) \
            .otherwise(F.lit(extra) + F.floor((F.col("_rk") - big) / max(base, 1)))
    return ranked.withColumn(fold_col, fold.cast("bigint")).drop("_rk")
