"""Harmonic packing of tokenised documents into fixed-length sequences.

Lengths are partitioned into reciprocal-capacity classes: class j takes pieces
of length at most capacity / j that leave at most ``capacity // slack`` of a
sequence empty when j of them share it. A document is cut into full sequences
and a rest; the rest is cut into the fewest pieces that belong to classes. Every
bin of class j then holds exactly j pieces, whatever they are, so each task
fills the bins of its own documents without knowing of the others. Only the
pieces of bins that a task leaves open (fewer than j a class) meet: they
are numbered per class across tasks and fill bins by the same counts. What is
then left of every class (fewer than j pieces, a fixed bound whatever the size
of the table) is laid end to end, cut at the capacity and, in the last
sequence, at powers of two, which need no padding.
"""

from __future__ import annotations

import base64
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from .common import arrow_batches, materialize, ship_package

CAPACITY, SLACK, END = 1024, 64, 0
BROADCAST_TASKS = 1_000_000  # tasks (three numbers each) up to which their bases are broadcast to the pieces
PIECE_COLUMNS = ["doc_id", "start", "length", "doc_tokens", "ids"]


@lru_cache(maxsize=8)
def plan(capacity: int = CAPACITY, slack: int = SLACK) -> tuple[tuple[int, ...], tuple[int, ...]]:
    """(class of each length, first cut of each length), for lengths 0 to ``capacity``.
    Class 0: no class takes the length, so it is cut, first into the longer part of
    the split with the fewest pieces (ties: the largest smallest piece)."""
    spare = capacity // slack
    per = [0] + [capacity // r if capacity - r * (capacity // r) <= spare else 0 for r in range(1, capacity + 1)]
    best: list[tuple[int, int]] = [(0, -capacity)]  # (pieces, minus the smallest piece)
    cut = [0] * (capacity + 1)
    good = [r for r in range(capacity + 1) if per[r]]
    for r in range(1, capacity + 1):
        if per[r]:
            best.append((1, -r))
            continue
        options = [(best[r - g][0] + 1, max(best[r - g][1], -g), -g) for g in good if g < r]
        n, small, first = min(options)
        best.append((n, small))
        cut[r] = -first
    return tuple(per), tuple(cut)


def cuts(n: int, capacity: int = CAPACITY, slack: int = SLACK) -> list[int]:
    """Lengths of the pieces of a document of ``n`` ids, in order."""
    per, cut = plan(capacity, slack)
    out, rest = [capacity] * (n // capacity), n % capacity
    while rest:
        out.append(rest if per[rest] else cut[rest])
        rest -= out[-1]
    return out


def encoder(tokenizer: str, ranks: str | None = None):
    """Function from a text to its ids (uint32), of the ``tokenizers`` file ``tokenizer``
    without special tokens added. ``ranks`` may name the same vocabulary as a
    ``tiktoken`` file, which is read about five times faster; texts that hold the string of
    a special token always go to ``tokenizers``, which gives it its own id."""
    from tokenizers import Tokenizer

    full = Tokenizer.from_file(tokenizer)
    special = [t.content for t in full.get_added_tokens_decoder().values()]

    def slow(text: str) -> np.ndarray:
        return np.array(full.encode(text, add_special_tokens=False).ids, np.uint32)

    if ranks is None:
        return slow
    import public_tokenizers
    import tiktoken

    with open(ranks, "rb") as f:
        table = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
    fast = tiktoken.Encoding("packing", pat_str=public_tokenizers.PATTERN, mergeable_ranks=table, special_tokens={})

    def encode(text: str) -> np.ndarray:
        if any(s in text for s in special):
            return slow(text)
        return fast.encode_to_numpy(text, disallowed_special=()).astype(np.uint32)

    return encode


def _fill(batches, make_encoder, capacity: int, slack: int, columns: list[str]):
    """Pieces of one task's documents, in the bins that this task fills alone."""
    encode, task = make_encoder(), TaskContext.get().partitionId()
    per, _ = plan(capacity, slack)
    open_bins: dict[int, list] = {}
    n_bins = 0
    kind = None
    flush_at = 4 << 20

    def batch(rows):
        names = [*columns, "klass", "task", "bin", "nth", "offset"]
        cols = list(zip(*rows)) if rows else [[] for _ in names]
        types = [kind, pa.int64(), pa.int64(), pa.int64(), pa.binary(), pa.int32(), pa.int32(), pa.int64(), pa.int32(), pa.int32()]
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, types)], names=names)

    out, size = [], 0
    for b in batches:
        kind = b.schema.field("doc_id").type
        for key, text in zip(b.column(0), b.column(1)):
            key, text = key.as_py(), text.as_py()
            ids = np.append(encode(text) if text else np.empty(0, np.uint32), np.uint32(END)).astype("<u4")
            start = 0
            for length in cuts(len(ids), capacity, slack):
                j, piece = per[length], ids[start:start + length].tobytes()
                mine = open_bins.setdefault(j, [])
                mine.append((key, start, length, len(ids), piece))
                start += length
                if len(mine) == j:  # the class's fixed count: the bin is full
                    at = 0
                    for p in mine:
                        out.append((*p, j, task, n_bins, 0, at))
                        at, size = at + p[2], size + 4 * p[2]
                    open_bins[j] = []
                    n_bins += 1
                    if size > flush_at:
                        yield batch(out)
                        out, size = [], 0
    for j, mine in open_bins.items():
        out += [(*p, j, task, None, i, 0) for i, p in enumerate(mine)]
    if kind is not None:
        yield batch(out)


def pack(docs: DataFrame, tokenizer: str, ranks: str | None = None, key: str = "doc_id", text: str = "text",
         capacity: int = CAPACITY, slack: int = SLACK) -> DataFrame:
    """Every id of every document in exactly one piece: ``doc_id`` (the key), ``start`` (ids
    of the document before the piece), ``length``, ``doc_tokens``, ``ids`` (binary,
    little-endian unsigned 32-bit), ``sequence_id`` and ``offset`` (gapless from 0).

    A document's ids are those of ``tokenizer`` and a closing id 0. Null and empty texts
    are a single id 0; a very long text fills sequences of its own and its rest is cut
    like any other; null keys and repeated rows are documents like others, told apart
    only by their pieces' places; other columns are not read; an empty table gives no
    piece. The places follow the partitions of the input: the same files and split
    size give the same sequences, and the written pieces are what later steps read.
    """
    spark = docs.sparkSession
    ship_package(spark)
    arrow_batches(spark)
    kind = docs.schema[key].dataType
    rows = docs.select(F.col(key).alias("doc_id"), F.col(text).cast("string").alias("body"))
    schema = T.StructType([
        T.StructField("doc_id", kind), *[T.StructField(c, T.LongType()) for c in ("start", "length", "doc_tokens")],
        T.StructField("ids", T.BinaryType()), T.StructField("klass", T.IntegerType()),
        T.StructField("task", T.IntegerType()), T.StructField("bin", T.LongType()),
        T.StructField("nth", T.IntegerType()), T.StructField("offset", T.IntegerType())])

    def run(batches):
        yield from _fill(batches, lambda: encoder(tokenizer, ranks), capacity, slack, PIECE_COLUMNS)

    pieces = materialize(rows.mapInArrow(run, schema), "pack_pieces")
    # full bins of the tasks, numbered task after task (a row per task)
    full = pieces.filter("bin IS NOT NULL").groupBy("task").agg((F.max("bin") + 1).alias("__n"))
    base = full.withColumn("__base", F.sum("__n").over(Window.orderBy("task")) - F.col("__n"))
    base = materialize(base, "pack_tasks")
    if base.count() <= BROADCAST_TASKS:
        base = F.broadcast(base)
    done = pieces.filter("bin IS NOT NULL").join(base, "task").withColumn("sequence_id", F.col("__base") + F.col("bin"))
    n_full = full.agg(F.coalesce(F.sum("__n"), F.lit(0))).first()[0]
    columns = [*PIECE_COLUMNS, "sequence_id", F.col("offset").cast("long").alias("offset")]
    tails = _tails(pieces.filter("bin IS NULL"), n_full, capacity)
    return done.select(*columns).unionByName(tails.select(*columns))


def _tails(rows: DataFrame, first: int, capacity: int) -> DataFrame:
    """Sequences of the pieces that the tasks left over: numbered per class by the
    tasks' counts, j of them a bin; the last few of all classes are cut anew."""
    counts = rows.groupBy("klass", "task").agg(F.count("*").alias("__n"))
    before = counts.withColumn("__off", F.sum("__n").over(Window.partitionBy("klass").orderBy("task")) - F.col("__n"))
    classes = counts.groupBy("klass").agg(F.sum("__n").alias("__of")) \
        .withColumn("__bins", F.floor(F.col("__of") / F.col("klass")))
    # at most ``capacity`` rows: the window over all of them is bounded
    classes = classes.withColumn("__base", F.sum("__bins").over(Window.orderBy("klass")) - F.col("__bins"))
    rows = rows.join(before.drop("__n"), ["klass", "task"]).join(classes, "klass") \
        .withColumn("__rank", F.col("__off") + F.col("nth")).withColumn("__bin", F.floor(F.col("__rank") / F.col("klass")))
    rows = materialize(rows, "pack_tails")
    inner = Window.partitionBy("klass", "__bin").orderBy("__rank").rowsBetween(Window.unboundedPreceding, -1)
    whole = rows.filter("__bin < __bins").withColumn("offset", F.coalesce(F.sum("length").over(inner), F.lit(0))) \
        .withColumn("sequence_id", F.lit(first) + F.col("__base") + F.col("__bin"))
    last = first + classes.agg(F.coalesce(F.sum("__bins"), F.lit(0))).first()[0]
    kinds = rows.schema
    schema = T.StructType([kinds[c] for c in PIECE_COLUMNS] + [T.StructField("sequence_id", T.LongType()),
                                                               T.StructField("offset", T.LongType())])

    def recut(table: pa.Table) -> pa.Table:
        out, at, total = [], 0, sum(table.column("length").to_pylist())
        ends = _ends(total, capacity)
        number = 0
        for r in table.sort_by([("klass", "ascending"), ("__rank", "ascending")]).to_pylist():
            ids, start = r["ids"], r["start"]
            while ids:
                begin = ends[number - 1] if number else 0
                take = min(len(ids) // 4, ends[number] - at)
                out.append((r["doc_id"], start, take, r["doc_tokens"], ids[:4 * take], last + number, at - begin))
                ids, start, at = ids[4 * take:], start + take, at + take
                number += at == ends[number]
        cols = list(zip(*out)) if out else [[] for _ in schema]
        kinds_pa = [table.schema.field("doc_id").type, *[pa.int64()] * 3, pa.binary(), pa.int64(), pa.int64()]
        return pa.table([pa.array(c, t) for c, t in zip(cols, kinds_pa)], names=schema.names)

    # fewer than j pieces of each class j: at most ``capacity`` ids of each, whatever the table's size
    rest = rows.filter("__bin >= __bins").groupBy(F.lit(0).alias("__all")).applyInArrow(recut, schema)
    return whole.select(*schema.names).unionByName(rest)


def _ends(total: int, capacity: int) -> list[int]:
    """Ends of the sequences of ``total`` ids in a row: full ones, then powers of two."""
    ends = list(range(capacity, total + 1, capacity))
    rest, at = total % capacity, total - total % capacity
    for bit in range(rest.bit_length() - 1, -1, -1):
        if rest >> bit & 1:
            at += 1 << bit
            ends.append(at)
    return ends


def sequences(pieces: DataFrame) -> DataFrame:
    """The packed sequences: ``sequence_id``, ``ids`` (binary, as in ``pack``), ``length`` and
    ``bounds`` (offset of every piece, for attention masks). A sequence has at
    most the capacity's ids, so a group is bounded."""
    rows = F.array_sort(F.collect_list(F.struct("offset", "ids")))
    out = pieces.groupBy("sequence_id").agg(rows.alias("__rows"), F.sum("length").alias("length"))
    return out.select("sequence_id", F.expr("aggregate(__rows, cast('' AS binary), (a, x) -> concat(a, x.ids))").alias("ids"),
                      "length", F.transform("__rows", lambda x: x["offset"]).alias("bounds"))
