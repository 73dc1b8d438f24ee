"""Exact substring dedup by prefix-free parsing.

Rolling-hash triggers (the smallest hash of each ``n``-byte window) cut every
text into phrases. The dictionary holds what follows and precedes a trigger,
the parse says where; sorting the parse by dictionary entry brings equal
stretches of the corpus together in corpus order, as the suffixes of a suffix
array would stand, but only up to the ``n`` bytes that matter and collapsed by
phrase, so that repetitive text costs a row per phrase, not per byte.

1. Rows of all phrases are sorted by (trigger string, whole phrase). A phrase
   that stands after an equal one is a repeat with all its windows. A trigger
   string with several phrases leaves its phrases undecided.
2. Undecided phrases are cut into runs of a few suffixes, sorted the same way
   by the bytes that all suffixes of the run share, then by all their bytes.
3. What is still undecided is sorted suffix by suffix.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import arrow_batches, materialize, ship_package
from .windows import (BASES, TAGGED, Rolling, doc_order, mix, pack, per_text, pieces, rows_frame, sift, spans, squeeze,
                      text_tag, triggers, unpack, unsqueeze)

N, TRIGGER, RUN = 100, 28, 10  # bytes of a repeat and of a trigger string; suffixes of a run
#: a fixed pseudo-random code per byte
_CODE = mix(np.arange(1, 257, dtype=np.uint64) * np.uint64(BASES[0]))


def _codes(data: bytes) -> np.ndarray:
    return _CODE[np.frombuffer(data, np.uint8)]


def _phrases(n: int, k: int):
    def run(batches):
        for b in batches:
            doc, tag = b["doc"].to_numpy(), b["tag"].to_numpy()
            for p in pieces(((i, _codes(bytes(t))) for i, t in enumerate(b["body"])), n):
                row, a, off, count, k1, k2 = triggers(p, n, k)
                yield rows_frame(k1, k2, doc[row], tag[row], pack(a, off, count), False)

    return run


def _snippets(n: int):
    """Bytes of the undecided phrases of each text: (doc, tag, loc, bytes)."""
    def run(batches):
        restore = unsqueeze()
        for b in batches:
            docs, tags, locs_out, out = [], [], [], []
            for doc, tag, body, locs in zip(b["doc"], b["tag"], b["body"], b["locs"]):
                locs = np.asarray(locs, np.int64)
                locs = locs[locs >= 0]
                if len(locs):
                    data = restore(body)
                    a, _, count = unpack(locs)
                    out += [data[s:e] for s, e in zip(a.tolist(), (a + count - 1 + n).tolist())]
                    docs.append(np.full(len(locs), doc))
                    tags.append(np.full(len(locs), tag))
                    locs_out.append(locs)
            if out:
                yield pd.DataFrame({"doc": np.concatenate(docs), "tag": np.concatenate(tags),
                                    "loc": np.concatenate(locs_out), "bytes": out})

    return run


def _runs(n: int, size: int):
    """Rows of the runs of ``size`` suffixes of undecided phrases."""
    def run(batches):
        for b in batches:
            if not len(b):
                continue
            a, off, count = unpack(b["loc"].to_numpy())
            data = [bytes(x) for x in b["bytes"]]
            begin = np.cumsum([0, *map(len, data)])[:-1]
            codes = _codes(b"".join(data))
            low, high = off - count + 1, off  # trigger offsets of the last and the first suffix
            first, last = low // size, high // size
            n_runs = last - first + 1
            i = np.repeat(np.arange(len(b)), n_runs)
            c = np.arange(len(i)) - np.repeat(np.cumsum(n_runs) - n_runs, n_runs) + first[i]
            o1, o0 = np.minimum(c * size + size - 1, high[i]), np.maximum(c * size, low[i])
            s = a[i] + off[i] - o1  # first suffix of the run, in the text
            at = begin[i] - a[i]
            roll = Rolling(codes)
            core = roll(at + a[i] + off[i] - c * size, n - size + 1)
            k1 = mix(core + c.astype(np.uint64))
            k2 = mix(roll(at + s, o1 - o0 + n) + ((o1 << 8) + o0).astype(np.uint64))
            yield rows_frame(k1, k2, b["doc"].to_numpy()[i], b["tag"].to_numpy()[i], pack(s, o1, o1 - o0 + 1), False)

    return run


def _suffixes(n: int):
    """Rows of the single suffixes of undecided runs."""
    def run(batches):
        for b in batches:
            if not len(b):
                continue
            a, _, _ = unpack(b["loc"].to_numpy())
            lo, _, count = unpack(b["run"].to_numpy())
            data = [bytes(x) for x in b["bytes"]]
            size = np.array([len(x) for x in data])
            begin = np.cumsum(size) - size
            codes = _codes(b"".join(data))
            i = np.repeat(np.arange(len(b)), count)
            s = np.arange(len(i)) - np.repeat(np.cumsum(count) - count, count) + lo[i]
            ok = (s >= a[i]) & (s + n <= a[i] + size[i])  # a trigger whose phrase was cut has two snippets
            i, s = i[ok], s[ok]
            at = begin[i] - a[i] + s
            yield rows_frame(Rolling(codes)(at, n), Rolling(codes, BASES[1])(at, n), b["doc"].to_numpy()[i],
                             b["tag"].to_numpy()[i], pack(s, np.zeros(len(s)), np.ones(len(s))), False)

    return run


def _trigger_key(loc: str):
    """Trigger position of a packed row."""
    c = F.col(loc)
    return F.shiftright(c, 32) + F.shiftright(c, 25).bitwiseAND(F.lit(127))


def repeats(df: DataFrame, key: str = "doc_id", text: str = "text", n: int = N, trigger: int = TRIGGER,
            run: int = RUN) -> tuple[DataFrame, DataFrame]:
    """(texts, repeats): the squeezed texts (doc_id, doc, tag, body), and the list
    ``locs`` of repeated windows of each (doc, tag)."""
    body = F.coalesce(F.col(text), F.lit("")).cast("binary")
    rows = df.select(F.col(key).alias("doc_id"), doc_order(F.col(key)).alias("doc"), text_tag(F.col(text)).alias("tag"),
                     body.alias("body"))
    packed = rows.select("doc_id", "doc", "tag", squeeze(F.col("body")).alias("body"))
    long = rows.select("doc", "tag", "body").filter(F.length("body") >= n)
    found = materialize(per_text(sift(long.mapInPandas(_phrases(n, trigger), TAGGED), False, True), "locs"), "parse")
    open_ = packed.select("doc", "tag", "body").join(found.filter(F.exists("locs", lambda x: x >= 0)), ["doc", "tag"])
    snippets = materialize(open_.mapInPandas(_snippets(n), "doc long, tag long, loc long, bytes binary"), "dictionary")
    by_run = materialize(sift(snippets.mapInPandas(_runs(n, run), TAGGED), False, True), "runs")
    left = by_run.filter("loc >= 0").select("doc", "tag", F.col("loc").alias("run"), _trigger_key("loc").alias("t")).join(
        snippets.withColumn("t", _trigger_key("loc")), ["doc", "tag", "t"])
    single = sift(left.select("doc", "tag", "loc", "run", "bytes").mapInPandas(_suffixes(n), TAGGED), False, False)
    more = materialize(per_text(by_run.filter("loc < 0").unionByName(single), "more"), "suffixes")
    none = F.array().cast("array<bigint>")
    both = found.join(more, ["doc", "tag"], "left").select("doc", "tag", F.concat(
        F.filter("locs", lambda x: x < 0), F.coalesce("more", none)).alias("locs"))
    return packed, both


def dedup(df: DataFrame, key: str = "doc_id", text: str = "text", n: int = N, trigger: int = TRIGGER, run: int = RUN,
          texts: bool = False) -> DataFrame:
    """One row per input row: ``doc_id``, ``n_bytes``, ``n_removed``, ``n_spans`` (maximal
    removed runs), ``kept_sha256``, ``spans`` (removed ranges, start:end in bytes) and,
    with ``texts``, ``kept`` (the remaining bytes).

    A byte goes if a string of ``n`` bytes that covers it also starts earlier: in
    a document with a smaller id, or in the same one at an earlier byte. Null
    text: empty. Null id: compared as larger than any other. Rows with equal
    ids count as one document, each at its own bytes, so repeated rows do not
    remove each other. Ids must be integers. An empty table gives an empty
    result. One text at a time is held as a whole; longer phrase lists and hot
    strings stream through sorted partitions.
    """
    if not 0 < trigger < n < 128 or not 0 < run < n - trigger:
        raise ValueError("0 < trigger < n < 128 and 0 < run < n - trigger")
    ship_package(df.sparkSession)
    arrow_batches(df.sparkSession)
    packed, found = repeats(df, key, text, n, trigger, run)
    kind = df.schema[key].dataType.simpleString()

    def cut(batches):
        restore = unsqueeze()
        for b in batches:
            out = []
            for body, locs in zip(b["body"], b["locs"]):
                data = restore(body)
                gone = spans(locs, n, len(data)) if locs is not None and len(locs) else []
                ends = [0, *(e for _, e in gone)]
                kept = b"".join(data[e:s] for e, s in zip(ends, [*(s for s, _ in gone), len(data)]))
                out.append((len(data), len(data) - len(kept), len(gone), hashlib.sha256(kept).hexdigest(),
                            ",".join(f"{s}:{e}" for s, e in gone), kept if texts else None))
            frame = pd.DataFrame(out, columns=["n_bytes", "n_removed", "n_spans", "kept_sha256", "spans", "kept"])
            frame.insert(0, "doc_id", b["doc_id"].to_numpy())
            yield frame

    out = packed.join(found, ["doc", "tag"], "left").select("doc_id", "body", "locs").mapInPandas(
        cut, f"doc_id {kind}, n_bytes long, n_removed long, n_spans long, kept_sha256 string, spans string, kept binary")
    return out if texts else out.drop("kept")
