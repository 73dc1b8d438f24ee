"""Substring dedup by relative Lempel-Ziv factors.

Every document is a reference for all later ones. The index of the reference is
dealt into blocks by the hash of content-defined phrases; each document is
factored against all blocks at once: runs of windows whose phrase, with all
its surroundings, occurs in an earlier document are factors. Where a factor
may end inside a phrase - the phrase occurs with different surroundings - the
windows at this boundary are looked up one by one. Factors of at least ``n``
words are duplicate spans.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import arrow_batches, materialize, ship_package
from .windows import (BASES, TAGGED, Rolling, doc_order, pack, per_text, pieces, rows_frame, sift, spans, squeeze,
                      text_tag, triggers, unpack, unsqueeze)

N, PHRASE = 13, 6  # words of a window, and of a phrase
CACHE = 200_000  # distinct words whose hashes a task keeps


class _Codes(dict):
    """Hash of a word, remembered."""

    def __missing__(self, word):
        from xxhash import xxh64_intdigest

        if len(self) >= CACHE:
            self.clear()
        value = self[word] = xxh64_intdigest(word, 1)
        return value

    def of(self, words) -> np.ndarray:
        return np.fromiter(map(self.__getitem__, words), np.uint64, len(words))


def _phrases(n: int, k: int):
    def run(batches):
        codes = _Codes()
        for b in batches:
            doc, tag = b["doc"].to_numpy(), b["tag"].to_numpy()
            texts = ((i, codes.of(bytes(t).split())) for i, t in enumerate(b["body"]))
            for p in pieces(texts, n):
                row, a, off, count, k1, k2 = triggers(p, n, k)
                yield rows_frame(k1, k2, doc[row], tag[row], pack(a, off, count), True)

    return run


def _boundary_windows(n: int):
    """Single windows of the undecided phrases."""
    def run(batches):
        codes, restore = _Codes(), unsqueeze()
        for b in batches:
            out = []
            for doc, tag, body, locs in zip(b["doc"], b["tag"], b["body"], b["locs"]):
                locs = np.asarray(locs, np.int64)
                locs = locs[locs >= 0]
                if not len(locs):
                    continue
                a, _, count = unpack(locs)
                c = codes.of(restore(body).split())
                start = np.repeat(a - np.cumsum(count) + count, count) + np.arange(count.sum())
                out.append((Rolling(c)(start, n), Rolling(c, BASES[1])(start, n), np.full(len(start), doc),
                            np.full(len(start), tag), pack(start, np.zeros(len(start)), np.ones(len(start)))))
            if out:
                yield rows_frame(*(np.concatenate(x) for x in zip(*out)), True)

    return run


def dedup(df: DataFrame, key: str = "doc_id", text: str = "text", n: int = N, phrase: int = PHRASE) -> DataFrame:
    """One row per input row: ``doc_id``, ``n_words``, ``n_removed``, ``kept`` (the kept
    words joined by blanks), ``factors`` (removed ranges, start:end in words).

    A word goes if a window of ``n`` words that covers it also starts in a
    document with a smaller id. Words are runs outside space and
    U+0009..U+000D. Null text: no words. Null id: compared as larger than any
    other; documents with equal ids (so also repeated rows) are never earlier
    than one another. Ids must be integers. An empty table gives an empty
    result. A text is held as a whole by one task at a time; nothing else is.
    """
    spark = df.sparkSession
    ship_package(spark)
    arrow_batches(spark)
    if not 0 < phrase < n or n > 127:
        raise ValueError("0 < phrase < n < 128")
    body = F.coalesce(F.col(text), F.lit(""))
    rows = df.select(F.col(key).alias("doc_id"), doc_order(F.col(key)).alias("doc"), text_tag(F.col(text)).alias("tag"),
                     body.cast("binary").alias("body"))
    found = sift(rows.select("doc", "tag", "body").mapInPandas(_phrases(n, phrase), TAGGED), True, True)
    found = materialize(per_text(found, "locs"), "factors")
    packed = rows.select("doc_id", "doc", "tag", squeeze(F.col("body")).alias("body"))
    edges = packed.join(found.filter(F.exists("locs", lambda x: x >= 0)), ["doc", "tag"]) \
        .mapInPandas(_boundary_windows(n), TAGGED)
    more = materialize(per_text(sift(edges, True, False), "more"), "boundaries")
    removed = found.join(more, ["doc", "tag"], "left").select(
        "doc", "tag", F.concat(F.filter("locs", lambda x: x < 0), F.coalesce(
            "more", F.array().cast("array<bigint>"))).alias("locs"))
    kind = df.schema[key].dataType.simpleString()

    def cut(batches):
        restore = unsqueeze()
        for b in batches:
            out = []
            for body, locs in zip(b["body"], b["locs"]):
                words = restore(body).split()
                gone = spans(locs, n, len(words)) if locs is not None and len(locs) else []
                kept, at = [], 0
                for s, e in gone:
                    kept += words[at:s]
                    at = e
                kept += words[at:]
                out.append((len(words), len(words) - len(kept), b" ".join(kept).decode(),
                            ",".join(f"{s}:{e}" for s, e in gone)))
            frame = pd.DataFrame(out, columns=["n_words", "n_removed", "kept", "factors"])
            frame.insert(0, "doc_id", b["doc_id"].to_numpy())
            yield frame

    return packed.join(removed, ["doc", "tag"], "left").select("doc_id", "body", "locs").mapInPandas(
        cut, f"doc_id {kind}, n_words long, n_removed long, kept string, factors string")


