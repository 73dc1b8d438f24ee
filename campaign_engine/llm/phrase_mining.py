"""Collocations from an FM-index per shard over word ids.

A shard is a bounded run of one language's documents. Its index sorts all
positions by a bounded number of words read backwards; the interval of a phrase
in this index of the reversed text holds its occurrences, and the next words of
the interval's rows extend the phrase to the right. Intervals of two words come from
extending the intervals of single words to the left: the sorted symbols before a
word's occurrences are, in place and number, the intervals of the reversed index.
Counts of every level are summed across shards, and only phrases whose prefix and
suffix are frequent everywhere are extended further: rarer ones cannot become frequent,
so no count is lost.
"""

from __future__ import annotations

from collections import defaultdict

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from .common import arrow_batches, materialize, parts, ship_package

MIN_COUNT, MAX_WORDS, TOP, INSIDE_PCT = 10, 3, 2000, 50
SHARD_BYTES = 16 << 20
CHUNK = 1 << 20  # bytes of a text split into words at a time
NO_LANG = "und"
_CUT = b"\xff"   # never part of UTF-8: the end of a piece
#: fixed values: characters that end a piece
_ENDS = b".,;:!?\n\x0b\x0c\r"
_FOLD = bytes(255 if i in _ENDS else i + 32 if 65 <= i <= 90 else 32 if i == 9 else i for i in range(256))


def _pack(ids: np.ndarray) -> bytes:
    """Word ids, compressed byte plane by byte plane (most high bytes are zero)."""
    planes = np.ascontiguousarray(ids.astype("<i4").view(np.uint8).reshape(-1, 4).T)
    return zstandard.ZstdCompressor(level=3).compress(planes.tobytes())


def _unpack(data: bytes) -> np.ndarray:
    planes = np.frombuffer(zstandard.ZstdDecompressor().decompress(data), np.uint8).reshape(4, -1)
    return np.ascontiguousarray(planes.T).view("<i4").ravel()


class _Words:
    """Word ids of a shard's documents; 0 ends a piece."""

    def __init__(self):
        self.ids = defaultdict()
        self.ids.default_factory = self.ids.__len__
        self.ids[_CUT]
        self.parts, self.bytes = [], 0

    def add(self, data: bytes) -> None:
        data, at = data.translate(_FOLD), 0
        while at < len(data):
            end = len(data) if len(data) - at <= CHUNK else data.find(b" ", at + CHUNK)
            end = len(data) if end < 0 else end
            words = data[at:end].replace(_CUT, b" \xff ").split()
            self.parts.append(np.fromiter(map(self.ids.__getitem__, words), np.int32, len(words)))
            at = end
        self.parts.append(np.zeros(1, np.int32))
        self.bytes += len(data) + 16

    def batches(self, shard: int, lang: str, schema: pa.Schema):
        seq = np.concatenate(self.parts)
        counts, words = np.bincount(seq, minlength=len(self.ids)).astype(np.int64), list(self.ids)
        for a in range(1, len(words), 50_000):
            n = len(words[a:a + 50_000])
            yield pa.RecordBatch.from_arrays([
                pa.array(np.full(n, shard, np.int64)), pa.array([lang] * n), pa.array(words[a:a + n], pa.binary()).cast(pa.string()),
                pa.array(np.arange(a, a + n, dtype=np.int64)), pa.array(counts[a:a + n]), pa.nulls(n, pa.binary())], schema=schema)
        yield pa.RecordBatch.from_arrays([
            pa.array([shard], pa.int64()), pa.array([lang]), pa.nulls(1, pa.string()), pa.nulls(1, pa.int64()),
            pa.nulls(1, pa.int64()), pa.array([_pack(seq)], pa.binary())], schema=schema)


_WORDS = "shard long, lang string, word string, local long, n long, seq binary"
_LEVEL = "shard long, prefix long, last long, rest long, size long, at long"
_LEVEL_PA = pa.schema([(c.split()[0], pa.int64()) for c in _LEVEL.split(", ")])


def _shards(docs: DataFrame, text: str, lang: str, shard_bytes: int) -> DataFrame:
    """Word ids of all documents by shard: a row per shard and word (local id, count) and
    one with the whole sequence. Written; nothing is shuffled."""
    def run(batches):
        part, number, open_, schema = TaskContext.get().partitionId(), 0, {}, None
        schema = pa.schema([("shard", pa.int64()), ("lang", pa.string()), ("word", pa.string()), ("local", pa.int64()),
                            ("n", pa.int64()), ("seq", pa.binary())])
        for b in batches:
            for of, t in zip(b.column(0).to_pylist(), b.column(1)):
                t = t.as_py()
                if not t:
                    continue
                mine = open_.setdefault(of, _Words())
                mine.add(t)
                total = sum(x.bytes for x in open_.values())
                while mine.bytes >= shard_bytes or total >= 2 * shard_bytes:  # many languages: the largest goes
                    big = max(open_, key=lambda k: open_[k].bytes)
                    full = open_.pop(big)
                    yield from full.batches(part << 32 | number, big, schema)
                    number, total = number + 1, total - full.bytes
                    mine = open_.get(of) or _Words()
        for of, mine in open_.items():
            yield from mine.batches(part << 32 | number, of, schema)
            number += 1

    rows = docs.select(F.coalesce(F.col(lang).cast("string"), F.lit(NO_LANG)).alias("lang"),
                       F.col(text).cast("binary").alias("body"))
    return materialize(rows.mapInArrow(run, _WORDS), "phrase_words")


def _groups(key: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and sizes of the runs of equal values."""
    starts = np.r_[0, np.flatnonzero(key[1:] != key[:-1]) + 1] if len(key) else np.empty(0, np.int64)
    return starts, np.diff(np.r_[starts, len(key)])


def _index(seq: np.ndarray, depth: int) -> np.ndarray:
    """Positions of ``seq`` sorted by the word there and the ``depth`` - 1 words before it (an
    FM-index of the reversed text, its order cut off at the depth that is asked)."""
    back = [np.r_[np.zeros(d, seq.dtype), seq[:len(seq) - d]] if d else seq for d in range(depth)]
    if depth == 2:
        return np.argsort(back[0].astype(np.int64) * (int(seq.max()) + 1) + back[1], kind="stable")
    return np.lexsort(back[::-1])


def _sequence(seq: bytes, local: np.ndarray, gid: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(ids of a shard's text, sorted global ids): id i > 0 is the i-th frequent word, 0 an end or a word too
    rare for any phrase. The text starts and ends with 0, so every position follows another one."""
    ids, gids = _unpack(seq), np.sort(gid)
    dense = np.zeros(int(ids.max()) + 1, np.int32)
    dense[local] = np.searchsorted(gids, gid) + 1
    ids = dense[ids]
    return np.r_[np.int32(0), ids[(ids != 0) | np.r_[False, ids[:-1] != 0]]], gids


def _level(shard: int, prefix, last, rest, size, at) -> pa.Table:
    n = len(prefix)
    cols = [np.full(n, shard), prefix, last, rest, size, at]
    return pa.Table.from_arrays([pa.nulls(n, pa.int64()) if c is None else pa.array(c.astype(np.int64)) for c in cols],
                                schema=_LEVEL_PA)


def _pairs(left: pa.Table, right: pa.Table, depth: int) -> pa.Table:
    """Two-word phrases of one shard: every interval of a word, extended to the left."""
    if not len(left) or not len(right):
        return _LEVEL_PA.empty_table()
    seq, gids = _sequence(left.column("seq")[0].as_py(), right.column("local").to_numpy(), right.column("gid").to_numpy())
    order = _index(seq, depth)
    before = np.where(order > 0, seq[order - 1], 0)
    starts, sizes = _groups(seq[order].astype(np.int64) * (len(gids) + 1) + before)
    last, first = seq[order][starts], before[starts]
    keep = (last > 0) & (first > 0)
    return _level(left.column("shard")[0].as_py(), gids[first[keep] - 1], gids[last[keep] - 1], None, sizes[keep], None)


def _extend(left: pa.Table, right: pa.Table, depth: int, deeper: bool) -> pa.Table:
    """Phrases of one shard that are a word longer: the intervals of the frequent ones, extended
    to the right where the suffix is frequent as well. ``right`` holds the shard's dictionary (rows with a
    ``local`` id) and its frequent phrases (rows with an ``id``)."""
    if not len(left) or not len(right):  # the table of an absent side has no columns
        return _LEVEL_PA.empty_table()
    is_word = right.column("local").is_valid().to_numpy()
    names, held = right.filter(pa.array(is_word)), right.filter(pa.array(~is_word))
    if not len(held):
        return _LEVEL_PA.empty_table()
    seq, gids = _sequence(left.column("seq")[0].as_py(), names.column("local").to_numpy(), names.column("gid").to_numpy())
    wide = len(gids) + 1
    order = _index(seq, depth)
    follow = np.r_[seq, np.int32(0)][order + 1]
    prefix, last, size = (held.column(c).to_numpy() for c in ("prefix", "last", "size"))
    if "id" in held.column_names:
        ids, rest, at = (held.column(c).to_numpy() for c in ("id", "rest", "at"))
        last = np.searchsorted(gids, last) + 1
    else:  # two words: their interval is where both stand in the index
        ids, rest = (prefix << 31) | last, last
        last = np.searchsorted(gids, last) + 1
        key = seq[order].astype(np.int64) * wide + np.where(order > 0, seq[order - 1], 0)
        at = np.searchsorted(key, last.astype(np.int64) * wide + np.searchsorted(gids, prefix) + 1)
    known = np.unique(prefix)
    by_name = np.argsort(named := np.searchsorted(known, prefix) * wide + last)
    named = named[by_name]
    parent = np.repeat(np.arange(len(ids)), size)
    row = np.arange(len(parent)) - np.repeat(np.cumsum(size) - size, size) + at[parent]
    word = follow[row]
    suffix = np.minimum(np.searchsorted(known, rest), len(known) - 1)  # as a prefix: the phrase without its first word
    ok = (word > 0) & (known[suffix] == rest)[parent]
    parent, row, word = parent[ok], row[ok], word[ok]
    want = suffix[parent] * wide + word
    found = np.minimum(np.searchsorted(named, want), len(named) - 1)
    ok = named[found] == want
    parent, row, word, found = parent[ok], row[ok], word[ok], by_name[found[ok]]
    sort = np.argsort(parent.astype(np.int64) * wide + word, kind="stable")
    parent, row, word, found = parent[sort], row[sort], word[sort], found[sort]
    starts, sizes = _groups(parent.astype(np.int64) * wide + word)
    place = None
    if deeper:  # the longer phrase's interval starts where its first row's next position stands in the index
        place = np.empty(len(follow), np.int64)
        place[np.argsort(follow, kind="stable")] = np.arange(len(follow))
        place = place[row[starts]]
    return _level(left.column("shard")[0].as_py(), ids[parent[starts]], gids[word[starts] - 1], ids[found[starts]], sizes, place)


def _longer(depth: int, deeper: bool):
    return lambda left, right: _extend(left, right, depth, deeper)


def _summed(rows: DataFrame, min_count: int, words: int, name: str, deeper: bool) -> DataFrame:
    """Level rows of all shards with ``f``, the phrase's count over all shards, where that is frequent; ``id`` and
    ``one`` (set in one row of each phrase). One shuffle brings the shards' counts together. Written."""
    same = Window.partitionBy("prefix", "last")
    keep = ["shard", "prefix", "last", "size"]  # what goes through the shuffle
    keep += (["rest"] if words > 3 else []) + (["at", "_m"] if deeper and words > 2 else [])
    rows = rows.withColumn("_m", F.monotonically_increasing_id()).select(*keep)
    out = rows.withColumn("f", F.sum("size").over(same)).filter(F.col("f") >= min_count) \
        .withColumn("one", F.min("shard").over(same) == F.col("shard"))
    if words == 2:
        out = out.withColumns({"id": _pair_id("prefix"), "rest": F.col("last")})
    elif words == 3:  # the first word of two stands above bit 31 of their id
        out = out.withColumn("rest", _pair_id(F.col("prefix").bitwiseAND(F.lit((1 << 31) - 1))))
    if words > 2:
        out = out.withColumn("id", F.min("_m").over(same)).drop("_m") if deeper else out.withColumn("id", F.lit(None).cast("long"))
    return materialize(out, name)


def _pair_id(first) -> Column:
    """Id of two words (whose ids are below 2^31)."""
    return F.shiftleft(first, 31).bitwiseOR(F.col("last"))


def count_phrases(docs: DataFrame, text: str = "text", lang: str = "lang", min_count: int = MIN_COUNT,
                  max_words: int = MAX_WORDS, shard_bytes: int = SHARD_BYTES) -> tuple[DataFrame, DataFrame]:
    """(phrases, totals): all phrases of 1 to ``max_words`` words that occur at least
    ``min_count`` times in their language (``lang``, ``words``, ``id``, ``phrase``, ``f``; the ids of the phrase
    without its last and its first word, ``prefix`` and ``rest``, null for single words; the counts of its first
    1, 2, ... words, ``lf``, and of its last ones, ``rf``), and the number ``n`` of all words per language.

    Texts are lower-cased (A-Z), cut into pieces at ``.,;:!?`` and line ends, and
    pieces into words at spaces and tabs; phrases lie within a piece, and all their
    occurrences count. Null and empty texts hold nothing; a null language is ``und``; repeated
    rows count like others; other columns are not read; empty tables give empty
    results. A shard holds at most ``shard_bytes`` of text, but never less than one document.
    """
    if max_words < 2:
        raise ValueError("max_words must be at least 2")
    ship_package(docs.sparkSession)
    arrow_batches(docs.sparkSession)
    depth, n_parts = max(2, max_words - 1), parts(docs.sparkSession)
    words = _shards(docs, text, lang, shard_bytes)
    single = words.filter("word IS NOT NULL")
    totals = single.groupBy("lang").agg(F.sum("n").alias("n"))
    # counts over all shards and small ids, in one shuffle: the ids of a bucket are its ranks, dealt out in turn
    bucket = F.pmod(F.xxhash64("lang", "word"), F.lit(n_parts))
    same = Window.partitionBy("bucket", "lang", "word")
    known = single.select("shard", "lang", "word", "local", "n", bucket.alias("bucket")) \
        .withColumn("f", F.sum("n").over(same)).filter(F.col("f") >= min_count) \
        .withColumn("gid", F.dense_rank().over(Window.partitionBy("bucket").orderBy("lang", "word")) * n_parts + F.col("bucket")) \
        .withColumn("one", F.min("shard").over(same) == F.col("shard"))
    text_of = lambda c: F.when(F.col("one"), F.col(c)).alias(c)
    known = materialize(known.select("shard", "local", "gid", text_of("lang"), text_of("word"), text_of("f"), "one"), "phrase_known")
    seqs = words.filter("seq IS NOT NULL").select("shard", "seq")
    none, nothing = F.lit(None).cast("long"), F.array().cast("array<bigint>")
    levels = [known.filter("one").select("lang", F.lit(1).alias("words"), F.col("gid").alias("id"), F.col("word").alias("phrase"),
                                         "f", none.alias("prefix"), none.alias("rest"), nothing.alias("lf"), nothing.alias("rf"))]
    names = known.select(F.col("shard").alias("in_shard"), "local", "gid")
    rows = seqs.groupBy("shard").cogroup(names.groupBy("in_shard")).applyInArrow(lambda a, b: _pairs(a, b, depth), _LEVEL)
    for k in range(2, max_words + 1):
        level = _summed(rows, min_count, k, f"phrase_level_{k}", k < max_words)
        first = levels[-1].select("lang", F.col("id").alias("prefix"), F.col("phrase").alias("__p"),
                                  F.concat("lf", F.array("f")).alias("lf"))
        rest = levels[-1].select(F.col("id").alias("rest"), F.substring_index("phrase", " ", -1).alias("__w"),
                                 F.concat("rf", F.array("f")).alias("rf"))
        named = level.filter("one").select("id", "f", "prefix", "rest").join(first, "prefix").join(rest, "rest").select(
            "lang", F.lit(k).alias("words"), "id", F.concat_ws(" ", "__p", "__w").alias("phrase"), "f", "prefix", "rest", "lf", "rf")
        levels.append(materialize(named, f"phrase_names_{k}"))
        if k < max_words:
            held = ["prefix", "last", "size"] if k == 2 else ["id", "prefix", "last", "rest", "size", "at"]
            mine = names.select("*", *[none.alias(c) for c in held]).unionByName(
                level.select(F.col("shard").alias("in_shard"), none.alias("local"), none.alias("gid"), *held))
            rows = seqs.groupBy("shard").cogroup(mine.groupBy("in_shard")).applyInArrow(
                _longer(depth, k + 1 < max_words), _LEVEL)
    out = levels[0]
    for x in levels[1:]:
        out = out.unionByName(x)
    return out, totals


def collocations(docs: DataFrame, text: str = "text", lang: str = "lang", min_count: int = MIN_COUNT,
                 max_words: int = MAX_WORDS, top: int = TOP, inside_pct: int = INSIDE_PCT, **options) -> DataFrame:
    """The ``top`` collocations of every language: ``lang``, ``rank``, ``phrase``, ``a`` (its occurrences), ``l`` and ``r``
    (those of the parts at its weakest cut), ``n`` (words of the language), ``score``.

    The score of a cut is floor(10^6 a^2 / (l r)), in exact decimals; a phrase has that of its lowest cut
    (ties: the earliest). Phrases that lie inside a longer one with at least ``inside_pct``
    percent of their occurrences are dropped. Order: score, then a (both descending), then the
    phrase's bytes. See ``count_phrases`` for texts, nulls and empty tables.
    """
    phrases, totals = count_phrases(docs, text, lang, min_count, max_words, **options)
    cand = phrases.filter("words > 1")
    # one word longer is enough: a phrase inside any longer one is inside one of these, which is as frequent
    longer = cand.filter("words > 2").select((F.col("words") - 1).alias("words"), "f",
                                             F.explode(F.array("prefix", "rest")).alias("id"))
    longer = longer.groupBy("words", "id").agg(F.max("f").alias("__longer"))
    kept = cand.join(longer, ["words", "id"], "left").filter(
        F.col("__longer").isNull() | (100 * F.col("__longer") < inside_pct * F.col("f")))
    wide = lambda c: f"CAST({c} AS DECIMAL(15, 0))"
    score = f"(CAST(1000000 AS DECIMAL(7, 0)) * ({wide('f')} * {wide('f')})) div ({wide('lf[k - 1]')} * {wide('rf[words - k - 1]')})"
    cut = F.expr(f"array_min(transform(sequence(1, words - 1), k -> struct({score} AS score, k AS k, "
                 "lf[k - 1] AS l, rf[words - k - 1] AS r)))")
    best = kept.select("lang", "phrase", F.col("f").alias("a"), cut.alias("c"))
    best = best.select("lang", "phrase", "a", "c.l", "c.r", "c.score")
    order = Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), "phrase")
    ranked = best.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= top)
    return ranked.join(totals, "lang").select("lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", "n",
                                              "score")
