"""Exact order statistics without holding a group in one task.

Spark's ``percentile``/``median`` aggregate keeps a value -> count map per group
and merges it in a single task; for a hot group (a third of all rows) that map
is unbounded. Here the k-th value of every group is found by *histogram
refinement* instead:

1. per group: n, min, max (partial aggregation, skew-proof);
2. each pass buckets the values inside the current bracket ``[lo, hi]`` into
   ``buckets`` equal-width bins and counts them (``groupBy(key, bin)`` with
   map-side combine -- a hot key is spread over its bins);
3. a running sum over the (small) per-bin counts picks the bin holding the
   target rank, whose actual min/max become the next bracket;
4. once a bracket holds at most ``finish_rows`` values, a window over just
   those rows returns the exact value.

Every pass moves only per-bin counts to the shuffle, and only a few scalars to
the driver (the number of unresolved brackets). The bracket state (one row per
group and target) is written to the shared folder between passes, so plans stay
small and the planner broadcasts it by its true size. Without grouping columns
the brackets are scalars, and rows are filtered by literals: no join at all.
"""

from __future__ import annotations

import math
from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark import StorageLevel
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..session import settle


def same_keys(left: DataFrame, right: DataFrame, keys: Sequence[str], how: str = "inner") -> DataFrame:
    """Join on ``keys`` where null equals null; keeps the left side's keys."""
    side = right.withColumnsRenamed({k: f"_r_{k}" for k in keys})
    cond = reduce(lambda a, b: a & b, [F.col(k).eqNullSafe(F.col(f"_r_{k}")) for k in keys])
    return left.join(side, cond, how).drop(*[f"_r_{k}" for k in keys])


_MANT_BITS = 10
_EXP_OFFSET = 1100  # keeps positive-value bucket ids above zero


def log_bucket(x) -> F.Column:
    """Order-preserving, data-independent bucket of a double: binary exponent
    plus the top ``_MANT_BITS`` mantissa bits (relative width 2^-10), negated
    for negatives, 0 for zero. An off-by-one ``log2`` at a power of two lands in
    the same bucket either way, so the id is monotone in x."""
    a = F.abs(x)
    e = F.floor(F.log2(a))
    scale = F.lit(float(1 << _MANT_BITS))
    mant = F.floor(a * F.pow(F.lit(2.0), F.lit(_MANT_BITS) - e))
    pos = (e + _EXP_OFFSET) * scale + (mant - scale)
    big = F.lit(float((2 * _EXP_OFFSET + 2) << _MANT_BITS))
    pos = F.when(F.isnan(a) | (a == float("inf")), big).otherwise(pos)
    return (F.when(x == 0, F.lit(0.0)).when(x > 0, pos).otherwise(-pos)).cast("long")


def group_kth(values: DataFrame, keys: Sequence[str], value: str, targets,
              buckets: int = 1024, finish_rows: int = 100_000,
              counts_out: list | None = None,
              counts: DataFrame | None = None) -> DataFrame:
    """k-th smallest ``value`` per group for every target.

    ``values``: rows carrying ``keys`` and a numeric ``value`` (nulls are
    skipped but their groups still get a count of 0). ``targets``: a DataFrame
    ``keys..., _tid, _rank`` (0-based rank below the group's count), or a
    function of the per-group count table ``keys..., _n`` returning one (that
    settled count table is also appended to ``counts_out``). A caller that
    already has the per-group counts ``keys..., _n`` passes them as ``counts``
    and saves the count pass. Returns
    ``keys..., _tid, _value`` (materialised).

    Pass 0 counts each group. Groups of at most ``finish_rows`` values are
    ranked directly by a window over the group (bounded per partition) and
    equi-joined to their target ranks. Larger (hot) groups go through
    histogram refinement: one ``log_bucket`` histogram, then equal-width
    refinement of brackets still above ``finish_rows``, then a window over the
    small bracket.
    """
    if not keys:
        raise ValueError("group_kth needs at least one key (use global_kth)")
    keys = list(keys)
    vals = (values.select(*keys, F.col(value).cast("double").alias("_v"))
            .persist(StorageLevel.MEMORY_AND_DISK))
    held = [vals]
    try:
        if counts is None:
            counts = settle(vals.groupBy(*keys).agg(F.count("_v").alias("_n")))
        if counts_out is not None:
            counts_out.append(counts)
        if callable(targets):
            targets = targets(counts)
        tg = targets.select(*keys, "_tid", F.col("_rank").alias("_need"))
        small_groups = counts.where((F.col("_n") > 0) & (F.col("_n") <= finish_rows)).select(*keys)
        big_groups = counts.where(F.col("_n") > finish_rows).select(*keys)
        # small groups: rank every value once, pick the target ranks by equi-join
        rn = F.row_number().over(Window.partitionBy(*keys).orderBy("_v")) - 1
        ranked = (same_keys(vals.where(F.col("_v").isNotNull()), small_groups, keys)
                  .withColumn("_need", rn))
        done: list[DataFrame] = [same_keys(ranked, tg, keys + ["_need"])
                                 .select(*keys, "_tid", F.col("_v").alias("_value"))]
        if not big_groups.isEmpty():
            big_vals = same_keys(vals.where(F.col("_v").isNotNull()), big_groups, keys)
            hist = (big_vals.groupBy(*keys, log_bucket(F.col("_v")).alias("_b"))
                            .agg(F.count("_v").alias("_c"), F.min("_v").alias("_bmin"),
                                 F.max("_v").alias("_bmax"))
                            .persist(StorageLevel.MEMORY_AND_DISK))
            held.append(hist)
            state = _select_bucket(hist, same_keys(tg, big_groups, keys), keys, ["_tid", "_need"])
            while True:  # every pass narrows each bracket by the number of bins
                state, n_large = _settle_state(state, finish_rows)
                done.append(state.where(F.col("_lo") == F.col("_hi"))
                                 .select(*keys, "_tid", F.col("_lo").alias("_value")))
                small = state.where((F.col("_lo") < F.col("_hi")) & (F.col("_cnt") <= finish_rows))
                large = state.where((F.col("_lo") < F.col("_hi")) & (F.col("_cnt") > finish_rows))
                in_small = (same_keys(big_vals, small, keys)
                            .where(F.col("_v").between(F.col("_lo"), F.col("_hi"))))
                brn = F.row_number().over(Window.partitionBy(*keys, "_tid").orderBy("_v"))
                done.append(in_small.withColumn("_rn", brn)
                                    .where(F.col("_rn") - 1 == F.col("_need"))
                                    .select(*keys, "_tid", F.col("_v").alias("_value")))
                if n_large == 0:
                    break
                cand = (same_keys(big_vals, large, keys)
                        .where(F.col("_v").between(F.col("_lo"), F.col("_hi"))))
                # halves keep (v - lo) finite even when hi - lo would overflow
                span = F.col("_hi") / 2 - F.col("_lo") / 2
                pos = (F.col("_v") / 2 - F.col("_lo") / 2) / span * buckets
                cand = cand.withColumn("_b", F.least(F.floor(pos).cast("long"), F.lit(buckets - 1)))
                h2 = cand.groupBy(*keys, "_tid", "_need", "_b").agg(
                    F.count(F.lit(1)).alias("_c"), F.min("_v").alias("_bmin"),
                    F.max("_v").alias("_bmax"))
                state = _select_bucket(h2, None, keys, ["_tid", "_need"])
        out = done[0]
        for d in done[1:]:
            out = out.unionByName(d)
        return settle(out)  # materialised before the inputs are released
    finally:
        for h in held:
            h.unpersist()


def _settle_state(state: DataFrame, finish_rows: int) -> tuple[DataFrame, int]:
    """Settle the bracket table (one row per group and target) and count the
    brackets that still need a refinement pass."""
    state = settle(state)
    n_large = state.where((F.col("_lo") < F.col("_hi")) & (F.col("_cnt") > finish_rows)).count()
    return state, n_large


def _select_bucket(hist: DataFrame, targets: DataFrame | None, keys: list[str],
                   tkeys: list[str]) -> DataFrame:
    """Running count over the (small) per-bucket table; keep the bucket that
    holds each target rank as the next bracket."""
    if targets is not None:
        hist = same_keys(hist, targets, keys)
    w = (Window.partitionBy(*keys, *tkeys[:1]).orderBy("_b")
         .rowsBetween(Window.unboundedPreceding, Window.currentRow))
    hist = hist.withColumn("_cum", F.sum("_c").over(w))
    before = F.col("_cum") - F.col("_c")
    return (hist.where((before <= F.col("_need")) & (F.col("_need") < F.col("_cum")))
                .select(*keys, "_tid", (F.col("_need") - before).alias("_need"),
                        F.col("_bmin").alias("_lo"), F.col("_bmax").alias("_hi"),
                        F.col("_c").alias("_cnt")))


def group_quantiles(df: DataFrame, keys: Sequence[str], value: str,
                    probs: Mapping[str, float], approximate: bool = False,
                    accuracy: int = 10_000, **kw) -> DataFrame:
    """Exact linear-interpolated quantiles per group (same definition as SQL
    ``percentile``/``quantile_cont``): position h = (n-1)p between the
    floor/ceil order statistics.

    Rows with a null key are dropped (pandas groupby semantics); null values are
    skipped; a group whose values are all null yields NULL. Returns
    ``keys..., <alias>...`` one row per group.

    ``approximate=True`` opts into ``percentile_approx`` (one pass, rank error
    about 1/``accuracy`` of the group size) instead of the exact search.
    """
    for p in probs.values():
        if not 0.0 <= p <= 1.0:
            raise ValueError(f"quantile probability {p} outside [0, 1]")
    if not keys:
        return _quantile_row(df, value, probs, approximate, accuracy, **kw)
    ks = list(keys)
    keyed = df
    for k in ks:
        keyed = keyed.where(F.col(k).isNotNull())
    keyed = keyed.select(*ks, F.col(value).cast("double").alias("_x"))
    names = list(probs)
    if approximate:
        res = keyed.groupBy(*ks).agg(*[F.percentile_approx("_x", float(probs[n]), accuracy).alias(n)
                                       for n in names])
        return res

    def make_targets(counts: DataFrame) -> DataFrame:
        structs = []
        for i, name in enumerate(names):
            h = (F.col("_n") - 1) * F.lit(float(probs[name]))
            structs.append(F.struct(F.lit(2 * i).alias("_tid"), F.floor(h).cast("bigint").alias("_rank")))
            structs.append(F.struct(F.lit(2 * i + 1).alias("_tid"), F.ceil(h).cast("bigint").alias("_rank")))
        return (counts.where(F.col("_n") > 0)
                .select(*ks, F.explode(F.array(*structs)).alias("_t"))
                .select(*ks, "_t._tid", "_t._rank"))

    captured: list[DataFrame] = []
    kth = group_kth(keyed, ks, "_x", make_targets, counts_out=captured, **kw)
    counts = captured[0]
    piv = kth.groupBy(*ks).agg(*[
        F.max(F.when(F.col("_tid") == t, F.col("_value"))).alias(f"_v{t}")
        for t in range(2 * len(names))])
    res = counts.join(piv, ks, "left")
    outs = []
    for i, name in enumerate(names):
        h = (F.col("_n") - 1) * F.lit(float(probs[name]))
        lo, hi = F.col(f"_v{2 * i}"), F.col(f"_v{2 * i + 1}")
        outs.append(F.when(F.col("_n") > 0, lo + (h - F.floor(h)) * (hi - lo)).alias(name))
    return res.select(*ks, *outs)


def _quantile_row(df, value, probs, approximate, accuracy, **kw) -> DataFrame:
    if approximate:
        return df.agg(*[F.percentile_approx(F.col(value).cast("double"), float(p), accuracy).alias(n)
                        for n, p in probs.items()])
    got = global_quantiles(df, value, probs, **kw)
    return df.sparkSession.createDataFrame([tuple(got[n] for n in probs)],
                                           ", ".join(f"`{n}` double" for n in probs))


def global_kth(df: DataFrame, value: str, ranks: Sequence[int], n: int, buckets: int = 1024,
               finish_rows: int = 100_000) -> list[float]:
    """Values at the 0-based ``ranks`` of a column with ``n`` non-null values.

    Brackets are scalars on the driver; each pass filters the rows by literals
    and counts them per bin. The first pass bins by ``log_bucket`` (a bounded
    number of ids), later ones by equal widths; a bracket of at most
    ``finish_rows`` values is sorted as it stands.
    """
    ranks = list(ranks)
    vals = df.select(F.col(value).cast("double").alias("_v")).where(F.col("_v").isNotNull())
    vals = vals.persist(StorageLevel.MEMORY_AND_DISK)
    try:
        # rank -> (values below the bracket, bracket size, low, high)
        state = {r: (0, n, None, None) for r in ranks}
        while True:
            todo = {s for s in state.values() if s[1] > finish_rows and (s[2] is None or s[2] < s[3])}
            if not todo:
                break
            for s in todo:
                below, size, lo, hi = s
                rows = vals if lo is None else vals.where(F.col("_v").between(F.lit(lo), F.lit(hi)))
                if lo is None:
                    b = log_bucket(F.col("_v"))
                else:  # halves keep the differences finite
                    b = F.least(F.floor((F.col("_v") / 2 - lo / 2) / (hi / 2 - lo / 2) * buckets).cast("long"),
                                F.lit(buckets - 1))
                hist = rows.groupBy(b.alias("_b")).agg(F.count("_v").alias("_c"), F.min("_v").alias("_lo"),
                                                       F.max("_v").alias("_hi"))
                w = Window.orderBy("_b").rowsBetween(Window.unboundedPreceding, -1)  # over bins only
                hist = hist.withColumn("_below", F.lit(below) + F.coalesce(F.sum("_c").over(w), F.lit(0)))
                mine = [r for r in ranks if state[r] == s]
                hit = F.lit(False)
                for r in mine:
                    hit = hit | ((F.col("_below") <= r) & (F.lit(r) < F.col("_below") + F.col("_c")))
                found = hist.where(hit).collect()  # at most one row per rank
                for r in mine:
                    x = next(x for x in found if x["_below"] <= r < x["_below"] + x["_c"])
                    state[r] = (x["_below"], x["_c"], x["_lo"], x["_hi"])
        out = {}
        for s in set(state.values()):
            below, size, lo, hi = s
            mine = [r for r in ranks if state[r] == s]
            if lo is not None and lo == hi:
                out.update({r: lo for r in mine})
                continue
            rows = vals if lo is None else vals.where(F.col("_v").between(F.lit(lo), F.lit(hi)))
            rn = F.row_number().over(Window.orderBy("_v")) + (below - 1)  # at most finish_rows rows
            got = rows.select("_v", rn.alias("_rn")).where(F.col("_rn").isin(mine)).collect()
            out.update({x["_rn"]: x["_v"] for x in got})
        return [out[r] for r in ranks]
    finally:
        vals.unpersist()


def global_quantiles(df: DataFrame, value: str, probs: Mapping[str, float], **kw) -> dict:
    """Scalar quantiles of a whole column (None when it holds no value)."""
    n = df.agg(F.count(F.col(value).cast("double"))).first()[0]
    if not n:
        return dict.fromkeys(probs)
    at = {k: (n - 1) * float(p) for k, p in probs.items()}
    ranks = sorted({r for h in at.values() for r in (math.floor(h), math.ceil(h))})
    v = dict(zip(ranks, global_kth(df, value, ranks, n, **kw)))
    return {k: v[math.floor(h)] + (h - math.floor(h)) * (v[math.ceil(h)] - v[math.floor(h)]) for k, h in at.items()}


def median(df: DataFrame, value: str, **kw) -> float | None:
    return global_quantiles(df, value, {"median": 0.5}, **kw)["median"]


def _check_identified(ambiguous: bool) -> None:
    if ambiguous:
        raise ValueError("the split boundary falls among rows that share one key; "
                         "name key columns that identify rows")


def smallest_boundary(df: DataFrame, strata: Sequence[str], order_long: str, tie: str,
                      quota: DataFrame, counts: DataFrame | None = None, **kw) -> DataFrame:
    """Per stratum, the ``(order_long, tie)`` key of the ``quota``-th row in
    that order: ``strata..., _bv, _bt`` (settled; strata with quota 0 absent).

    The boundary value comes from ``group_kth``; rows sharing it (rare hash
    prefix collisions) are ordered by ``tie``. A null stratum is a stratum.
    Raises ValueError when the boundary falls among rows with equal keys.
    """
    ks = list(strata)
    targets = quota.where(F.col("_q") > 0).select(*ks, F.lit(0).alias("_tid"), (F.col("_q") - 1).alias("_rank"))
    kth = group_kth(df.select(*ks, order_long), ks, order_long, targets,
                    counts=counts.select(*ks, "_n") if counts is not None else None, **kw) \
        .select(*ks, F.col("_value").cast("bigint").alias("_bv"))
    marks = same_keys(df.select(*ks, order_long, tie), kth, ks)
    less = marks.groupBy(*ks).agg(F.sum((F.col(order_long) < F.col("_bv")).cast("long")).alias("_less"))
    w = Window.partitionBy(*ks).orderBy(tie)
    ties = (marks.where(F.col(order_long) == F.col("_bv"))
            .withColumn("_trn", F.row_number().over(w)).withColumn("_next", F.lead(tie).over(w)))
    bound = settle(same_keys(same_keys(ties, less, ks), quota.select(*ks, "_q"), ks)
                   .where(F.col("_trn") == F.col("_q") - F.col("_less"))
                   .select(*ks, "_bv", F.col(tie).alias("_bt"),
                           F.coalesce(F.col("_next") == F.col(tie), F.lit(False)).alias("_same")))
    _check_identified(not bound.where("_same").isEmpty())
    return bound.drop("_same")


def global_boundary(df: DataFrame, order_long: str, tie: str, n: int, quota: int) -> tuple | None:
    """The ``(order_long, tie)`` key of the ``quota``-th of ``n`` rows, as scalars."""
    if quota <= 0:
        return None
    bv = int(global_kth(df, order_long, [quota - 1], n)[0])
    less = df.where(F.col(order_long) < bv).count()
    rows = [r[0] for r in df.where(F.col(order_long) == bv).select(tie).orderBy(tie).limit(quota - less + 1).collect()]
    at = quota - less - 1
    _check_identified(at + 1 < len(rows) and rows[at + 1] == rows[at])
    return bv, rows[at]


def _before(order_long: str, tie: str, bv, bt):
    return F.coalesce((F.col(order_long) < bv) | ((F.col(order_long) == bv) & (F.col(tie) <= bt)), F.lit(False))


def apply_boundary(df: DataFrame, strata: Sequence[str], order_long: str, tie: str,
                   bound, flag: str = "_taken") -> DataFrame:
    """Flag rows at or before their stratum's boundary key; without strata
    ``bound`` is the pair of ``global_boundary``."""
    if not strata:
        if bound is None:
            return df.withColumn(flag, F.lit(False))
        return df.withColumn(flag, _before(order_long, tie, F.lit(bound[0]), F.lit(bound[1])))
    out = same_keys(df, bound, list(strata), "left")
    return out.withColumn(flag, _before(order_long, tie, F.col("_bv"), F.col("_bt"))).drop("_bv", "_bt")


def _pick_bits(n: int, rows_per_bucket: int) -> int:
    if n <= rows_per_bucket:
        return 0
    return min(30, int(math.ceil(math.log2(n / rows_per_bucket))))


def take_smallest(df: DataFrame, strata: Sequence[str], order_long: str, tie: str,
                  quota: DataFrame, flag: str = "_taken", **kw) -> DataFrame:
    """Flag, per stratum, the ``quota`` rows that come first in
    ``(order_long, tie)`` order; ``tie`` must be unique within a stratum.
    ``quota``: ``strata..., _q``. No global sort, no unpartitioned window."""
    bound = smallest_boundary(df, strata, order_long, tie, quota, **kw)
    return apply_boundary(df, strata, order_long, tie, bound, flag)


def hash_ranks(df: DataFrame, strata: Sequence[str], order_long: str, tie: str,
               rank_col: str = "_rank", rows_per_bucket: int = 200_000,
               order_bits: int = 52) -> DataFrame:
    """Exact 0-based rank of every row within its stratum by
    ``(order_long, tie)`` where ``order_long`` is a uniform ``order_bits``-bit hash.
    A null stratum is a stratum of its own.

    Rows are cut into hash buckets of ~``rows_per_bucket`` (top bits of the
    hash, so even a hot stratum spreads evenly); bucket offsets come from a
    running sum over the small per-bucket count table; the rank inside a bucket
    is a window over that bucket only.
    """
    ks = list(strata)
    n_max = (df.groupBy(*ks).count().agg(F.max("count")).first()[0] or 0) if ks else df.count()
    bits = _pick_bits(int(n_max), rows_per_bucket)
    bucket = F.shiftright(F.col(order_long), order_bits - bits) if bits else F.lit(0).cast("bigint")
    src = df.withColumn("_hb", bucket)
    counts = src.groupBy(*ks, "_hb").agg(F.count(F.lit(1)).alias("_bc"))
    w = (Window.partitionBy(*ks).orderBy("_hb")
         .rowsBetween(Window.unboundedPreceding, Window.currentRow))
    offsets = settle(counts.withColumn("_off", F.sum("_bc").over(w) - F.col("_bc")).drop("_bc"))
    inner = F.row_number().over(Window.partitionBy(*ks, "_hb").orderBy(order_long, tie))
    return (same_keys(src, offsets, [*ks, "_hb"])
            .withColumn(rank_col, (F.col("_off") + inner - 1).cast("bigint"))
            .drop("_hb", "_off"))
