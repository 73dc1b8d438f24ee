"""First occurrences of fixed-length windows of symbols (bytes or words).

Shared parts of the two span-dedup operators: rolling hashes over many texts
at once, content-defined triggers (the smallest rolling hash of each window),
and a sorted pass that separates first from later occurrences. Each window of
``n`` symbols has exactly one trigger, which depends on its symbols alone, so
equal windows meet at equal triggers.

A row of the sorted pass is (k1, k2, doc, tag, loc): ``k1`` is what all windows
of the row hold in common, ``k2`` all their symbols, ``tag`` the text's 64-bit
hash (which tells apart texts that share a document id), ``loc`` packs the first
window start, the trigger's offset from it and the number of windows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import MAX_ID, parts

BASES = (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F)
PIECE = 1 << 18  # symbols hashed at a time
_pow: dict[tuple[int, int], np.ndarray] = {}


def _powers(base: int, n: int) -> np.ndarray:
    size = 1 << max(20, (n + 1).bit_length())
    if (base, 0) not in _pow or len(_pow[base, 0]) < size:
        out, m = np.ones(size, np.uint64), 1
        while m < size:
            out[m:2 * m] = out[:m] * np.uint64(pow(base, m, 1 << 64))
            m *= 2
        _pow[base, 0] = out
    return _pow[base, 0]


def mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    return x ^ (x >> np.uint64(29))


class Rolling:
    """Hashes of any ranges of a symbol array (uint64 codes)."""

    def __init__(self, codes: np.ndarray, base: int = BASES[0]):
        up = _powers(base, len(codes))
        self.down = _powers(pow(base, -1, 1 << 64), len(codes))
        self.sums = np.zeros(len(codes) + 1, np.uint64)
        np.cumsum(codes * up[:len(codes)], out=self.sums[1:])

    def __call__(self, start, length) -> np.ndarray:
        return mix((self.sums[start + length] - self.sums[start]) * self.down[start])


def _argmin(h: np.ndarray, w: int) -> np.ndarray:
    """Position of the first smallest hash (by its upper bits) in each run of ``w``."""
    n, low = len(h) - w + 1, np.uint64((1 << 21) - 1)
    key = (h & ~low) | np.arange(len(h), dtype=np.uint64)
    a = np.concatenate([key, np.full(-len(key) % w, ~np.uint64(0))]).reshape(-1, w)
    head = np.minimum.accumulate(a, 1).ravel()
    tail = np.minimum.accumulate(a[:, ::-1], 1)[:, ::-1].ravel()
    return (np.minimum(tail[:n], head[w - 1:w - 1 + n]) & low).astype(np.int64)


def pieces(texts, n: int):
    """Cut (row, codes) into lists of (row, offset, codes) of about PIECE symbols;
    a long text goes into overlapping pieces, so that no window is lost."""
    held, size = [], 0
    for row, codes in texts:
        for lo in range(0, max(0, len(codes) - n + 1), PIECE):
            part = codes[lo:lo + PIECE + n - 1]
            held.append((row, lo, part))
            size += len(part)
            if size >= PIECE:
                yield held
                held, size = [], 0
    if held:
        yield held


def triggers(piece, n: int, k: int):
    """Rows of all windows of a piece, one per run of windows with one trigger:
    (row, first start, trigger offset, windows, k1, k2)."""
    codes = np.concatenate([c for _, _, c in piece])
    size = np.array([len(c) for _, _, c in piece])
    begin = np.cumsum(size) - size
    roll = Rolling(codes)
    at = np.arange(len(codes) - k + 1)
    h = roll(at, k)
    pos = _argmin(h, n - k + 1)
    part = np.repeat(np.arange(len(piece)), size)[:len(pos)]
    ok = np.arange(len(pos)) + n <= (begin + size)[part]
    start = np.flatnonzero(ok)
    pos, part = pos[ok], part[ok]
    new = np.flatnonzero(np.r_[True, (pos[1:] != pos[:-1]) | (part[1:] != part[:-1])])
    count = np.diff(np.r_[new, len(pos)])
    a, t, part = start[new], pos[new], part[new]
    k2 = mix(roll(a, count - 1 + n) + (((t - a) << 8) + count).astype(np.uint64))
    row, off = np.array([r for r, _, _ in piece]), np.array([o for _, o, _ in piece])
    return row[part], off[part] + a - begin[part], t - a, count, h[t], k2


def pack(a, off, count):
    return (a.astype(np.int64) << 32) | (off.astype(np.int64) << 25) | (count.astype(np.int64) << 18)


def unpack(loc):
    return loc >> 32, (loc >> 25) & 127, (loc >> 18) & 127


def text_tag(text: Column) -> Column:
    """The 64-bit hash that names the text among those of its document id."""
    return F.xxhash64(F.coalesce(text, F.lit("")))


def doc_order(key: Column) -> Column:
    """Document ids as they are compared: null comes last."""
    return F.coalesce(key.cast("long"), F.lit(MAX_ID))


def rows_frame(k1, k2, doc, tag, loc, across: bool) -> pd.DataFrame:
    """Rows for ``sift``. Rows that come later than an equal row of this very
    batch are known duplicates already: they get a negative ``loc`` and a
    scattered ``k1``, so that a hot window does not send them all to one task."""
    k1, k2 = k1.view(np.int64), k2.view(np.int64)
    order = np.lexsort((tag, loc, doc, k2, k1))
    k1, k2, doc, tag, loc = k1[order], k2[order], doc[order], tag[order], loc[order]
    if len(k1):
        new = np.r_[True, (k1[1:] != k1[:-1]) | (k2[1:] != k2[:-1])]
        first = np.maximum.accumulate(np.where(new, np.arange(len(k1)), 0))
        later = doc > doc[first] if across else (doc > doc[first]) | (
            (doc == doc[first]) & (loc >> 32 > loc[first] >> 32))
        k1 = np.where(later, mix((doc * 31 + loc + tag).view(np.uint64)).view(np.int64), k1)
        loc = np.where(later, -1 - loc, loc)
    return pd.DataFrame({"k1": k1, "k2": k2, "doc": doc, "tag": tag, "loc": loc})


ROWS = "k1 long, k2 long, doc long, loc long"
TAGGED = "k1 long, k2 long, doc long, tag long, loc long"


def sift(rows: DataFrame, across: bool, undecided: bool) -> DataFrame:
    """(doc, tag, loc) of the rows that are not first occurrences, with ``loc`` turned
    into -1 - loc; without ``tag`` if the rows have none. ``across``: only earlier documents count, else also earlier
    starts of the same document. With ``undecided``, also (loc as it is) the
    first rows of every k2 whose k1 has more than one k2: some of their
    windows may occur in another of these rows.

    Rows are dealt by k1 and sorted; the pass keeps one row's keys, so groups
    of any size stream through; equal rows (of repeated texts) count once.
    """
    names = ["doc", "tag", "loc"] if "tag" in rows.columns else ["doc", "loc"]
    order = ["k1", "k2", "doc", "loc", *names[1:-1]]

    def run(batches):
        state = None  # k1, k2, first doc, first start, several k2?, undecided rows of a single k2
        empty, before = tuple(np.empty(0, np.int64) for _ in names), None
        for b in batches:
            if not len(b):
                continue
            table = b[order].to_numpy()
            # rows of repeated texts: equal rows stand together
            fresh = np.r_[before is None or (table[0] != before).any(), (table[1:] != table[:-1]).any(1)]
            before, table = table[-1].copy(), table[fresh]
            known = table[:, 3] < 0

            def rows_at(at, loc):  # the columns of ``names``
                return (table[at, 2], *table[at, 4:].T, loc)

            out = [rows_at(known, table[known, 3])]
            table = table[~known]
            k1, k2, doc, loc = table.T[:4]
            if len(k1):
                s = state or (None, None, 0, 0, False, empty)
                core = np.r_[s[0] is None or k1[0] != s[0], k1[1:] != k1[:-1]]
                kind = core | np.r_[s[1] is None or k2[0] != s[1], k2[1:] != k2[:-1]]
                head = np.maximum.accumulate(np.where(kind, np.arange(len(k1)), -1))
                start = loc >> 32
                doc0 = np.where(head >= 0, doc[head], s[2])
                start0 = np.where(head >= 0, start[head], s[3])
                later = doc > doc0 if across else (doc > doc0) | ((doc == doc0) & (start > start0))
                out.append(rows_at(later, -1 - loc[later]))
                several, held = False, empty
                if undecided:
                    group = np.cumsum(core)  # 0: goes on from the batch before
                    kinds = np.bincount(group, weights=kind)
                    several = kinds > 1
                    several[0] = s[4] or kinds[0] > 0
                    if group[0] == 0 and several[0] and not s[4]:
                        out.append(s[5])
                    show = ~later & several[group]
                    out.append(rows_at(show, loc[show]))
                    last = group[-1]
                    if not several[last]:
                        mine = ~later & (group == last)
                        held = rows_at(mine, loc[mine])
                        if last == 0:
                            held = tuple(np.concatenate(x) for x in zip(s[5], held))
                    several = bool(several[last])
                state = (k1[-1], k2[-1], doc0[-1], start0[-1], several, held)
            yield pd.DataFrame({c: np.concatenate(x) for c, x in zip(names, zip(*out))})

    return rows.repartition(parts(rows.sparkSession), "k1").sortWithinPartitions(*order) \
        .mapInPandas(run, ", ".join(f"{c} long" for c in names))


def squeeze(body: Column) -> Column:
    """Zstandard form of a binary column, for texts that go through a shuffle."""
    @F.pandas_udf("binary")
    def run(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        from zstandard import ZstdCompressor

        tool = ZstdCompressor(level=3)
        for b in batches:
            yield b.map(lambda x: tool.compress(bytes(x)))

    return run(body)


def unsqueeze():
    """Function that restores a squeezed value."""
    from zstandard import ZstdDecompressor

    tool = ZstdDecompressor()
    return lambda x: tool.decompress(bytes(x))


def per_text(found: DataFrame, name: str) -> DataFrame:
    """One row per text: doc, tag, and the list of its ``loc`` (bounded by the text)."""
    return found.groupBy("doc", "tag").agg(F.collect_list("loc").alias(name))


def spans(locs, n: int, size: int) -> list[tuple[int, int]]:
    """Merged [start, end) symbol ranges covered by the later windows among ``locs``."""
    locs = np.asarray(locs, np.int64)
    locs = -1 - locs[locs < 0]
    if not len(locs):
        return []
    a, _, count = unpack(locs)
    edge = np.zeros(size + 1, np.int64)
    np.add.at(edge, a, 1)
    np.add.at(edge, a + count - 1 + n, -1)
    on = np.r_[0, (np.cumsum(edge[:-1]) > 0).astype(np.int8), 0]
    turn = np.flatnonzero(np.diff(on))
    return list(zip(turn[::2].tolist(), turn[1::2].tolist()))
