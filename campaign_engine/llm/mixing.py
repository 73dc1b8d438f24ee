"""Mixing sources to target weights along a time-varying curriculum.

Source shares are water-filled under an epoch cap; each source owns a weight
schedule over training time. Integrating the schedule gives the cumulative
token demand, its inverse turns a document's token offset inside its source
into a training position, and documents are range-sorted by that position.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators.ranks import running_total
from .common import global_rank, materialize, n_words

WEIGHTS = (5, 2, 1)
#: weight over training time (0 to 1) of each weight class, as knots (time, weight)
SCHEDULES = {5: ((0.0, 1.5), (1.0, 0.5)), 2: ((0.0, 1.0), (1.0, 1.0)), 1: ((0.0, 0.5), (1.0, 1.5))}


def inverse_demand(u: str, knots) -> str:
    """SQL (Spark and DuckDB) of the training time at which a share ``u`` of the
    demand is met, for a piecewise-linear weight given by ``knots``."""
    area = [(t1 - t0) * (w0 + w1) / 2 for (t0, w0), (t1, w1) in zip(knots, knots[1:])]
    total, done, cases = sum(area), 0.0, []
    if total <= 0:
        raise ValueError("a schedule needs a positive integral")
    for (t0, w0), (t1, w1), a in zip(knots, knots[1:], area):
        if a <= 0:
            continue
        m, x = (w1 - w0) / (t1 - t0), f"greatest(0E0, {u} * {total!r}E0 - {done!r}E0)"
        t = f"{x} / {w0!r}E0" if m == 0 else \
            f"(sqrt(greatest(0E0, {w0 * w0!r}E0 + {2 * m!r}E0 * {x})) - {w0!r}E0) / {m!r}E0"
        done += a
        cases.append(f"WHEN {u} * {total!r}E0 <= {done!r}E0 THEN {t0!r}E0 + {t}")
    return f"CASE {' '.join(cases)} ELSE {knots[-1][0]!r}E0 END"


def position_sql(u: str, weight: str, schedules=None) -> str:
    schedules = schedules or SCHEDULES
    cases = " ".join(f"WHEN {w} THEN {inverse_demand(u, k)}" for w, k in schedules.items())
    return f"CASE {weight} {cases} END"


def source_targets(sources: DataFrame, cap: float = 3.0, weights=WEIGHTS) -> DataFrame:
    """Targets of a table (source_key, source_size), one row per source.

    Weights repeat over the sources in key order. Every source gets its weighted
    share of all sizes; a share above ``cap`` times the source's size stops
    there and the excess is shared again by weight. Each round brings three
    sums to the driver, never the sources.
    """
    ranked = global_rank(sources, [F.col("source_key")], "__r")
    w = F.element_at(F.array(*[F.lit(x).cast("long") for x in weights]),
                     (F.col("__r") % len(weights) + 1).cast("int"))
    ranked = materialize(ranked.withColumn("weight", w).drop("__r"), "source_weights")
    total = ranked.agg(F.sum("source_size")).first()[0] or 0
    all_weight = ranked.agg(F.sum("weight")).first()[0] or 1
    level, n_capped = total / all_weight, 0
    while True:  # the capped set only grows, so this ends
        over = F.col("weight") * F.lit(float(level)) > F.col("source_size") * F.lit(float(cap))
        n, capped, open_w = ranked.agg(F.count(F.when(over, 1)), F.sum(F.when(over, F.col("source_size"))),
                                       F.sum(F.when(~over, F.col("weight")))).first()
        if n == n_capped or not open_w:
            break
        n_capped, level = n, (total - cap * (capped or 0)) / open_w
    return ranked.withColumn("target", F.when(over, F.col("source_size") * F.lit(float(cap)))
                             .otherwise(F.col("weight") * F.lit(float(level))))


def _fill(left: DataFrame, missing: DataFrame) -> DataFrame:
    """(__row, __pick) of the untaken rows ``left`` that fill what is ``__miss``ing of their source: largest
    sizes first, of each as many as still fit, then one of the smallest size left, if
    that brings the source nearer. Afterwards no untaken row does. The choice is a fold over
    the counts per size (one row per size of a source); the rows of a size are numbered
    in the order of the source, by ranks over range partitions."""
    left = global_rank(left.select("source_key", "size", "__md5", "text_hash", "__row"),
                       [F.col(c) for c in ("source_key", "size", "__md5", "text_hash", "__row")], "__nth")
    left = materialize(left, "mix_left")
    sizes = left.groupBy("source_key", "size").agg(F.count("*").alias("n"), F.min("__nth").alias("__low"))
    fold = sizes.join(missing, "source_key").filter("__miss > 0").groupBy("source_key", "__miss") \
        .agg(F.reverse(F.array_sort(F.collect_list(F.struct("size", "n")))).alias("__sizes"))
    fold = fold.withColumn("__f", F.expr("""aggregate(__sizes,
        named_struct('m', __miss, 'took', cast(array() AS array<struct<size:bigint,n:bigint,k:bigint>>)),
        (a, x) -> CASE WHEN x.size <= a.m THEN named_struct(
            'm', a.m - x.size * least(x.n, floor(a.m / x.size)),
            'took', concat(a.took, array(named_struct('size', x.size, 'n', x.n, 'k', least(x.n, floor(a.m / x.size))))))
          ELSE a END)"""))
    near = """array_min(transform(filter(__sizes, x -> x.size > __f.m AND x.size < 2 * __f.m
        AND NOT exists(__f.took, t -> t.size = x.size AND t.k = t.n)), x -> x.size))"""
    took = fold.select("source_key", F.explode(F.expr(f"""concat(transform(__f.took, t -> struct(t.size AS size, t.k AS k)),
        filter(array(struct({near} AS size, 1L AS k)), t -> t.size IS NOT NULL))""")).alias("t"))
    took = took.groupBy("source_key", F.col("t.size").alias("size")).agg(F.sum("t.k").alias("__k")).filter("__k > 0")
    took = materialize(took.join(sizes.select("source_key", "size", "__low"), ["source_key", "size"]), "mix_fill")
    return left.join(took, ["source_key", "size"]).filter(F.col("__nth") - F.col("__low") < F.col("__k")).select(
        "__row", F.lit(1).alias("__pick"))


def _plan(rows: DataFrame, cap: float, weights, schedules) -> DataFrame:
    """The plan of ``mix`` from rows (doc_id, source_key, text_hash, size, __md5 and any others)."""
    rows = materialize(rows.withColumn("__row", F.monotonically_increasing_id()), "mix_rows")
    targets = source_targets(rows.groupBy("source_key").agg(F.sum("size").alias("source_size")), cap, weights)
    targets = targets.withColumn(
        "__full", F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(0)) \
        .withColumn("__part", F.col("target") - F.col("__full") * F.col("source_size"))
    order = [F.col(c) for c in ("source_key", "__md5", "text_hash", "__row")]
    placed = materialize(running_total(rows, order, "size", "__before"), "mix_ordered")
    lows = placed.groupBy("source_key").agg(F.min("__before").alias("__low"))
    targets = materialize(targets.join(lows, "source_key"), "source_targets")
    placed = placed.join(targets, "source_key").withColumn("__start", F.col("__before") - F.col("__low"))
    placed = materialize(placed.withColumn(
        "__extra", (F.col("__start") + F.col("size") <= F.col("__part")).cast("int")).drop("__before", "__low"), "mix_placed")
    missing = placed.groupBy("source_key").agg(
        (F.first("__part") - F.sum(F.col("size") * F.col("__extra"))).alias("__miss"))
    missing = materialize(missing, "mix_missing")  # a row per source: small enough to be sent to hot sources
    near = _fill(placed.filter((F.col("__extra") == 0) & (F.col("size") > 0)), missing)
    out = placed.join(near, "__row", "left").withColumn(
        "copies", (F.col("__full") + F.col("__extra") + F.coalesce("__pick", F.lit(0))).cast("long"))
    out = out.withColumn("__u", F.when((F.col("copies") > 0) & (F.col("target") > 0), F.least(
        F.lit(1.0), F.col("__start") / F.col("target")))) \
        .withColumn("position", F.when(F.col("__u").isNotNull(), F.expr(position_sql("__u", "weight", schedules))))
    return out.withColumn("taken", F.col("copies") * F.col("size")).withColumnRenamed("__start", "start")


def _rows(df: DataFrame, key: str, text: str, source: str) -> list:
    return [F.col(key).alias("doc_id"), F.coalesce(F.concat(F.lit("s"), F.col(source)), F.lit("z")).alias("source_key"),
            F.xxhash64(F.col(text)).alias("text_hash"), n_words(F.col(text)).alias("size"),
            F.md5(F.coalesce(F.col(key).cast("string"), F.lit("null"))).alias("__md5")]


def mix(df: DataFrame, key: str = "doc_id", text: str = "text", source: str = "source",
        cap: float = 3.0, weights=WEIGHTS, schedules=None) -> DataFrame:
    """Plan of the mix: one row per input row with ``doc_id`` (the key),
    ``text_hash``, ``size``, ``source_size``, ``target``, ``copies``, ``taken``
    (copies times size) and ``position`` (training time of the first copy, null
    when not taken), range-sorted by position.

    Inside a source, documents come in the order of md5(key). Whole passes over
    the source are taken first; of the last, partial pass every document that
    ends inside the target; then untaken documents, large to small, until none
    of those left would bring the source nearer to its target.

    Null text: size 0. Null source: a source of its own, last in order. Null
    key: ordered by md5 of 'null'. Ties: by text hash, then by place in the
    input; repeated rows are separate documents, as alike as the copies of one. An
    empty table gives an empty result. All orders are ranks over range
    partitions, which split hot sources, hot keys and repeated rows alike.
    """
    out = _plan(df.select(*_rows(df, key, text, source)), cap, weights, schedules or SCHEDULES)
    out = out.select("doc_id", "text_hash", "source_key", "weight", "size", "source_size", "target", "copies",
                     "taken", "position", "start")
    return out.repartitionByRange(F.col("position"), F.col("doc_id")).sortWithinPartitions("position", "doc_id")


def training_order(df: DataFrame, key: str = "doc_id", text: str = "text", source: str = "source", cap: float = 3.0,
                   weights=WEIGHTS, schedules=None) -> DataFrame:
    """The mixed corpus itself: every input column, one row per taken copy, with
    ``__position``, range-sorted into training order (see ``mix``, also for nulls, ties and empty
    tables). Input columns named like the plan's columns stay untouched. Rows that agree in all
    columns are collapsed before the shuffle that brings plan and texts together, so a
    group of repeated rows is no hot key there."""
    cols = df.columns
    whole = [F.col(c).cast("string") if "map<" in t or t == "variant" else F.col(c) for c, t in df.dtypes]
    same = [F.xxhash64(*whole).alias("__h1"), F.hash(*whole).alias("__h2")]
    schedules = schedules or SCHEDULES
    u = "least(1E0, (__c * __src + __start) / __target)"
    plan = _plan(df.select(*_rows(df, key, text, source), *same), cap, weights, schedules).filter("copies > 0").select(
        "__h1", "__h2", F.col("copies").alias("__n"), F.col("source_size").alias("__src"), F.col("start").alias("__start"),
        F.col("target").alias("__target"), F.col("weight").alias("__w"))
    rows = df.groupBy(*same).agg(F.first(F.struct(*cols)).alias("__doc"))  # rows of a group agree in all columns
    out = plan.join(rows, ["__h1", "__h2"])
    out = out.withColumn("__c", F.explode(F.sequence(F.lit(0).cast("long"), F.col("__n") - 1))) \
        .withColumn("__position", F.expr(position_sql(u, "__w", schedules)))
    return (out.select(*[F.col("__doc")[c].alias(c) for c in cols], F.col("__position"))
            .repartitionByRange(F.col("__position"), F.col(key)).sortWithinPartitions("__position", key))
