"""Ranked lexical search by MaxScore with bounds for pairs of terms.

``build_index`` makes shard-local posting lists of every term of every document
(a shard is a bounded run of documents of one task). ``add_bounds`` prepares
the lists of a workload's terms: integer impacts, their maximum per shard, and
for the pairs that the workload uses (neighbours in the order of weight) the
intersection list with its joint maximum impact. A joint maximum is at most,
and mostly well below, the sum of two term maxima, so the bounds that ``search`` combines
out of pairs let it skip whole shards, whole lists and single documents earlier
than the terms' own maxima would. Every document above the threshold is
scored exactly.
"""

from __future__ import annotations

from collections import defaultdict

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_type
from pyspark.sql.window import Window

from .common import arrow_batches, materialize, ship_package

K = 50
SHARD_BYTES, SHARD_DOCS = 8 << 20, 8192  # a shard ends at either
ITEMS_PER_BLOCK = 1000                   # items that one task holds beside a shard's lists
CHUNK = 1 << 20                          # bytes of a text split into words at a time
ROWS = 20_000                            # posting lists per Arrow batch
#: fixed values: characters that are no part of a term
SEPARATORS = r"\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
_FOLD = bytes(ord(c) + 32 if "A" <= (c := chr(i)) <= "Z" else i if i > 127 or chr(i).isalnum() else 32 for i in range(256))


def item_terms(text):
    """The distinct terms of a text column, as an array."""
    return F.array_distinct(F.regexp_extract_all(F.translate(F.coalesce(text, F.lit("")), UPPER, LOWER),
                                                 F.lit(f"[^{SEPARATORS}]+"), F.lit(0)))


class _Shard:
    """Posting lists of a run of documents, in memory."""

    def __init__(self):
        self.vocabulary = defaultdict()
        self.vocabulary.default_factory = self.vocabulary.__len__
        self.keys, self.lengths, self.codes, self.counts, self.bytes = [], [], [], [], 0

    def add(self, key, data: bytes) -> None:
        folded, found, at = data.translate(_FOLD), [], 0
        while at < len(folded):
            end = len(folded) if len(folded) - at <= CHUNK else folded.find(b" ", at + CHUNK)
            end = len(folded) if end < 0 else end
            words = folded[at:end].split()
            found.append(np.fromiter(map(self.vocabulary.__getitem__, words), np.int32, len(words)))
            at = end
        codes = np.concatenate(found) if found else np.empty(0, np.int32)
        if len(codes):
            distinct, counts = np.unique(codes, return_counts=True)
            self.keys.append(key)
            self.lengths.append(len(codes))
            self.codes.append(distinct)
            self.counts.append(counts)
        self.bytes += len(data) + 64

    def batches(self, shard: int, kind: pa.DataType, schema: pa.Schema):
        if not self.keys:
            return
        codes = np.concatenate(self.codes)
        slots = np.repeat(np.arange(len(self.keys), dtype=np.int32), [len(c) for c in self.codes])
        order = np.argsort(codes, kind="stable")
        slots, counts = slots[order], np.concatenate(self.counts)[order].astype(np.int64)
        ends = np.cumsum(np.bincount(codes, minlength=len(self.vocabulary)))
        starts = np.r_[0, ends]
        terms = list(self.vocabulary)
        for a in range(0, len(terms), ROWS):
            b = min(a + ROWS, len(terms))
            cut = pa.array((starts[a:b + 1] - starts[a]).astype(np.int32))
            part = slice(starts[a], starts[b])
            n = b - a
            yield pa.RecordBatch.from_arrays([
                pa.array(np.full(n, shard)), pa.array(terms[a:b], pa.binary()).cast(pa.string()),
                pa.ListArray.from_arrays(cut, pa.array(slots[part])), pa.ListArray.from_arrays(cut, pa.array(counts[part])),
                pa.nulls(n, pa.list_(kind))], schema=schema)
        yield pa.RecordBatch.from_arrays([
            pa.array([shard]), pa.nulls(1, pa.string()), pa.nulls(1, pa.list_(pa.int32())),
            pa.array([self.lengths], pa.list_(pa.int64())), pa.array([self.keys], pa.list_(kind))], schema=schema)


def build_index(docs: DataFrame, key: str = "doc_id", text: str = "text", shard_bytes: int = SHARD_BYTES,
                shard_docs: int = SHARD_DOCS) -> DataFrame:
    """The written index of all documents: per shard a row per term (``shard``, ``term``, ``slots``:
    the shard's documents that hold it, ``tfs``: how often), and one row without a term
    that lists the documents (``ids``) and their numbers of terms (``tfs``).

    Terms are maximal runs of ASCII letters and digits and of all other characters
    beyond ASCII, A-Z lower-cased. Documents without a term (null, empty,
    punctuation only) are in no list. A very long text is split in chunks and is at most one
    shard; null keys and repeated rows are documents like others; other columns are not
    read; an empty table gives an empty index. Nothing is shuffled.
    """
    spark = docs.sparkSession
    ship_package(spark)
    arrow_batches(spark)
    id_type = docs.schema[key].dataType
    schema = T.StructType([T.StructField("shard", T.LongType()), T.StructField("term", T.StringType()),
                           T.StructField("slots", T.ArrayType(T.IntegerType())),
                           T.StructField("tfs", T.ArrayType(T.LongType())), T.StructField("ids", T.ArrayType(id_type))])

    def run(batches):
        part, number, shard, kind, out = TaskContext.get().partitionId(), 0, _Shard(), None, None
        for b in batches:
            kind = b.schema.field("doc_id").type
            out = pa.schema([("shard", pa.int64()), ("term", pa.string()), ("slots", pa.list_(pa.int32())),
                             ("tfs", pa.list_(pa.int64())), ("ids", pa.list_(kind))])
            for k, t in zip(b.column(0), b.column(1)):
                t = t.as_py()
                if t:
                    shard.add(k.as_py(), t)
                if shard.bytes >= shard_bytes or len(shard.keys) >= shard_docs:
                    yield from shard.batches(part << 32 | number, kind, out)
                    shard, number = _Shard(), number + 1
        if kind is not None:
            yield from shard.batches(part << 32 | number, kind, out)

    rows = docs.select(F.col(key).alias("doc_id"), F.col(text).cast("binary").alias("body"))
    return materialize(rows.mapInArrow(run, schema), "search_index")


def _workload(index: DataFrame, items: DataFrame, item_key: str, item_text: str) -> tuple[DataFrame, DataFrame, tuple]:
    """(items with their numbered terms, pairs of neighbouring terms) of a workload and the
    corpus numbers (N, L). The weight of a term orders an item's terms."""
    sizes = index.filter("term IS NULL").agg(F.sum(F.size("ids")), F.sum(F.expr("aggregate(tfs, 0L, (a, x) -> a + x)"))).first()
    n, total = sizes[0] or 0, sizes[1] or 0
    rows = materialize(items.select(F.col(item_key).alias("item_id"), item_terms(F.col(item_text)).alias("terms"))
                       .withColumn("item", F.monotonically_increasing_id()), "search_items")
    rows = rows.select("item", "item_id", F.explode("terms").alias("term"))
    df = index.filter("term IS NOT NULL").join(rows.select("term").distinct(), "term", "left_semi") \
        .groupBy("term").agg(F.sum(F.size("slots")).alias("df"))
    weight = F.floor(1000 * F.log(F.lit(float(2 * n + 2)) / (2 * F.col("df") + 1)))
    rows = rows.join(df.select("term", weight.cast("long").alias("w")), "term")  # a term of no document scores nothing
    rows = rows.withColumn("ord", F.row_number().over(Window.partitionBy("item").orderBy(F.desc("w"), "term")) - 1)
    rows = materialize(rows, "search_terms")
    two = rows.groupBy("item", "item_id", F.floor(F.col("ord") / 2).alias("ord")).agg(
        F.min_by("term", "ord").alias("a"), F.when(F.count("*") > 1, F.max_by("term", "ord")).alias("b"))
    return rows, materialize(two, "search_pairs"), (n, total)


def add_bounds(index: DataFrame, terms: DataFrame, pairs: DataFrame, numbers: tuple) -> DataFrame:
    """Lists of a workload's terms and pairs, per shard: ``a``, ``b`` (null for a single term), ``top`` (highest
    impact of a document: of the term, or of both terms of the pair together), ``slots``
    and ``impacts`` (for pairs: of the documents that hold both). Written."""
    n, total = numbers
    weights = terms.select("term", "w").distinct()
    lists = index.filter("term IS NOT NULL").select("shard", "term", "slots", "tfs").join(weights, "term")
    docs = index.filter("term IS NULL").select("shard", F.lit(None).cast("string").alias("term"),
                                               F.lit(None).cast("array<int>").alias("slots"), "tfs",
                                               F.lit(0).cast("long").alias("w"))
    wanted = pairs.filter("b IS NOT NULL").select("a", "b").distinct()
    held = index.filter("term IS NOT NULL").select("shard", "term")
    both = held.join(wanted.withColumn("term", F.explode(F.array("a", "b"))), "term").select(F.col("shard").alias("in_shard"), "a", "b").distinct()
    schema = T.StructType([T.StructField("shard", T.LongType()), T.StructField("a", T.StringType()),
                           T.StructField("b", T.StringType()), T.StructField("top", T.LongType()),
                           T.StructField("slots", T.ArrayType(T.IntegerType())),
                           T.StructField("impacts", T.ArrayType(T.LongType()))])

    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        out, lengths = _Rows(), None
        names = left.column("term").to_pylist() if len(left) else []
        for i, t in enumerate(names):
            if t is None:
                lengths = _values(left.column("tfs")[i])
        got = {}
        m = 50 + (50 * lengths * n) // total if lengths is not None else None
        for i, t in enumerate(names):
            if t is not None:
                slots, tf = _values(left.column("slots")[i]), _values(left.column("tfs")[i])
                impact = left.column("w")[i].as_py() * ((1_000_000_000 * tf) // (1000 * tf + 20 * m[slots]))
                got[t] = slots, impact
                out.add(t, None, int(impact.max()), slots, impact)
        wanted = zip(right.column("a").to_pylist(), right.column("b").to_pylist()) if len(right) else ()
        for a, b in wanted:  # the table of an absent side has no columns
            one, two = got.get(a), got.get(b)
            top = max(int(x[1].max()) for x in (one, two) if x)
            slots, impact = np.empty(0, np.int32), np.empty(0, np.int64)
            if one and two:
                slots, i, j = np.intersect1d(one[0], two[0], assume_unique=True, return_indices=True)
                impact = one[1][i] + two[1][j]
                top = max(top, int(impact.max()) if len(impact) else 0)
            out.add(a, b, top, slots, impact)
        return out.table(left.column("shard")[0].as_py() if len(left) else 0)

    ship_package(index.sparkSession)
    rows = lists.select("shard", "term", "slots", "tfs", "w").unionByName(docs)
    return materialize(rows.groupBy("shard").cogroup(both.groupBy("in_shard")).applyInArrow(run, schema), "search_bounds")


def _values(x) -> np.ndarray:
    return x.values.to_numpy(zero_copy_only=False)


class _Rows:
    def __init__(self):
        self.a, self.b, self.top, self.slots, self.impacts, self.ends = [], [], [], [], [], [0]

    def add(self, a, b, top, slots, impacts):
        self.a.append(a)
        self.b.append(b)
        self.top.append(top)
        self.slots.append(slots.astype(np.int32))
        self.impacts.append(impacts.astype(np.int64))
        self.ends.append(self.ends[-1] + len(slots))

    def table(self, shard: int) -> pa.Table:
        ends = pa.array(np.array(self.ends, np.int32))
        flat = lambda xs, kind: pa.array(np.concatenate(xs) if xs else np.empty(0, kind))
        return pa.table({
            "shard": pa.array(np.full(len(self.a), shard, np.int64)), "a": pa.array(self.a, pa.string()),
            "b": pa.array(self.b, pa.string()), "top": pa.array(self.top, pa.int64()),
            "slots": pa.ListArray.from_arrays(ends, flat(self.slots, np.int32)),
            "impacts": pa.ListArray.from_arrays(ends, flat(self.impacts, np.int64))})


def best(lists: dict, parts: list[tuple], n_docs: int, theta: int, k: int) -> tuple[np.ndarray, np.ndarray, int]:
    """Documents (slots, exact scores) of a shard that may be among an item's ``k`` best, all
    that reach ``theta`` (at least 1). ``parts``: (top, a, b), highest bound first;
    ``lists``: term -> (slots, impacts). The third value counts postings that were read."""
    tops = np.array([p[0] for p in parts], np.int64)
    rest = np.r_[np.cumsum(tops[::-1])[::-1], 0]  # bound of what parts i and later can add
    score, seen, read = np.zeros(n_docs, np.int64), None, 0
    for i, (_, a, b) in enumerate(parts):
        if seen is None and rest[i] < theta:  # no document can reach theta by the remaining parts alone
            seen = np.flatnonzero(score)
        if seen is not None:
            seen = seen[score[seen] + rest[i] >= theta]
            if not len(seen):
                break
        for t in (a, b):
            if t is None or t not in lists:
                continue
            slots, impact = lists[t]
            if seen is None or len(slots) <= 4 * len(seen):
                score[slots] += impact
                read += len(slots)
            else:
                at = np.minimum(np.searchsorted(slots, seen), len(slots) - 1)
                hit = slots[at] == seen
                score[seen[hit]] += impact[at[hit]]
                read += len(seen)
        if seen is None and n_docs > k:  # scores only grow: the k-th best so far bounds the k-th best
            theta = max(theta, int(np.partition(score, n_docs - k)[n_docs - k]))
    if seen is None:
        seen = np.flatnonzero(score)
    value = score[seen]
    keep = value >= max(theta, 1)
    return seen[keep], value[keep], read


def _scan(lists: DataFrame, docs: DataFrame, work: DataFrame, id_type, k: int) -> DataFrame:
    """Evaluate ``work`` (shard, block, item, theta, parts) against the lists of its shards."""
    keys, kind = ["shard", "block"], to_arrow_type(id_type)
    schema = T.StructType([T.StructField("item", T.LongType()), T.StructField("shard", T.LongType()),
                           T.StructField("slot", T.LongType()), T.StructField("doc_id", id_type),
                           T.StructField("score", T.LongType()), T.StructField("read", T.LongType())])

    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        ids, found = None, {}
        for i, t in enumerate(left.column("a").to_pylist() if len(left) else []):
            if t is None:
                ids = left.column("ids")[i].values
            else:
                found[t] = _values(left.column("slots")[i]), _values(left.column("impacts")[i])
        cols = [[] for _ in range(6)]
        for r in right.to_pylist() if ids is not None else []:
            parts = sorted(((p["top"], p["a"], p["b"]) for p in r["parts"]), key=lambda p: (-p[0], p[1]))
            slots, value, read = best(found, parts, len(ids), r["theta"], k)
            order = np.argsort(-value, kind="stable")
            if len(order) > k:  # documents that tie with the k-th stay until ids decide
                order = order[value[order] >= value[order[k - 1]]]
            mine = [(-int(value[x]), ids[int(slots[x])].as_py(), int(slots[x])) for x in order]
            mine.sort(key=lambda x: (x[0], x[1] is None, x[1] if x[1] is not None else 0, x[2]))
            for v, d, s in mine[:k]:
                for c, x in zip(cols, (r["item"], r["in_shard"], s, d, -v, read)):
                    c.append(x)
        kinds = [pa.int64(), pa.int64(), pa.int64(), kind, pa.int64(), pa.int64()]
        return pa.table([pa.array(c, t) for c, t in zip(cols, kinds)], names=schema.names)

    rows = lists.unionByName(docs.join(work.select(*keys).distinct(), "shard"))
    asked = work.select("item", F.col("shard").alias("in_shard"), F.col("block").alias("in_block"), "theta", "parts")
    return rows.groupBy(*keys).cogroup(asked.groupBy("in_shard", "in_block")).applyInArrow(run, schema)


def search(index: DataFrame, items: DataFrame, item_key: str = "item_id", item_text: str = "text", k: int = K) -> DataFrame:
    """The ``k`` highest-scoring documents of each item with a score above 0: ``item_id``, ``rank``
    (from 1), ``doc_id``, ``score``; equal scores by ascending doc_id (nulls last, then
    by place in the index).

    A term's weight is floor(1000 ln((2N+2)/(2df+1))), its impact weight * (10^9 tf div (1000 tf + 20 m)) with
    m = 50 + (50 n N) div L. Each item row is ranked on its own, repeated item ids
    included; an item without terms (null, empty) or matches has no row; an empty index
    or table of items gives an empty result. Each item is first evaluated in the
    shard of its highest bound; its k-th score there is the threshold of all others.
    """
    id_type = index.schema["ids"].dataType.elementType
    terms, pairs, numbers = _workload(index, items, item_key, item_text)
    blocks = max(1, -(-pairs.agg(F.count_distinct("item")).first()[0] // ITEMS_PER_BLOCK))
    bounds = add_bounds(index, terms, pairs, numbers)
    parts = pairs.join(bounds.select("shard", "a", "b", "top"), (pairs["a"] == bounds["a"]) & pairs["b"].eqNullSafe(bounds["b"])) \
        .select("item", "shard", F.struct(pairs["a"], pairs["b"], "top").alias("part"))
    work = parts.groupBy("item", "shard").agg(F.collect_list("part").alias("parts"), F.sum("part.top").alias("bound")) \
        .withColumn("block", F.pmod(F.xxhash64("item"), F.lit(blocks)).cast("int"))
    work = materialize(work, "search_work")
    of = terms.select(F.col("term").alias("a"), F.pmod(F.xxhash64("item"), F.lit(blocks)).cast("int").alias("block")).distinct()
    ids = F.lit(None).cast(index.schema["ids"].dataType).alias("ids")
    lists = bounds.filter("b IS NULL").join(of, "a").select("shard", "block", "a", "slots", "impacts", ids)
    docs = index.filter("term IS NULL").select("shard", F.lit(None).cast("string").alias("a"),
                                               F.lit(None).cast("array<int>").alias("slots"),
                                               F.lit(None).cast("array<bigint>").alias("impacts"), "ids")
    top = work.groupBy("item").agg(F.max_by("shard", F.struct("bound", "shard")).alias("first"))
    work = work.join(top, "item")
    begun = materialize(_scan(lists, docs, work.filter("shard = first").withColumn("theta", F.lit(1).cast("long"))
                              .drop("first"), id_type, k), "search_first")
    nth = begun.groupBy("item").agg(F.count("*").alias("n"), F.min("score").alias("theta")).filter(F.col("n") >= k)
    others = work.filter("shard <> first").join(nth.select("item", "theta"), "item", "left") \
        .withColumn("theta", F.coalesce("theta", F.lit(1).cast("long"))).filter("bound >= theta").drop("first")
    found = begun.unionByName(_scan(lists, docs, others, id_type, k))
    best_first = Window.partitionBy("item").orderBy(F.desc("score"), F.asc_nulls_last("doc_id"), "shard", "slot")
    ranked = found.withColumn("rank", F.row_number().over(best_first)).filter(F.col("rank") <= k)
    names = pairs.select("item", "item_id").distinct()
    return ranked.join(names, "item").select("item_id", "rank", "doc_id", "score")
