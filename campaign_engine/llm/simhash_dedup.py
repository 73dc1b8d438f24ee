"""SimHash near-duplicates with pigeonring filtering.

Fingerprints (64 bits) are cut into a ring of segments. If two differ in at
most ``max_bits`` bits, some segment starts a chain whose first l segments
together differ in at most l * max_bits / segments bits, for every l. The first
two links of that chain become join keys (an equal segment, and one equal half
of the next, which may differ in one bit); the rest of the chain is tested
before the full Hamming distance.
"""

from __future__ import annotations

from itertools import accumulate

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import arrow_batches, components, cut_lineage, materialize, parts, ship_package

SHINGLE, MAX_BITS, SEED = 4, 4, 42
SEGMENTS = 5
BLOCK = 2048  # fingerprints compared at once; larger key groups are compared block by block
CHUNK = 1 << 16


def _layout(segments: int = SEGMENTS) -> list[tuple[int, int]]:
    """(shift, width) of each segment, widths as even as possible."""
    at, out = 0, []
    for i in range(segments):
        w = 64 // segments + (i < 64 % segments)
        out.append((at, w))
        at += w
    return out


def fingerprint(data: bytes, shingle: int = SHINGLE) -> int:
    """Unsigned SimHash of a UTF-8 text (see ``clusters`` for the words)."""
    from xxhash import xxh64_intdigest

    words = data.lower().split()  # bytes: lower-cases A-Z only, cuts at space and 0x09-0x0D only
    if not words:
        return 0
    norm = b" ".join(words)
    ends = list(accumulate(map(len, words), lambda a, b: a + b + 1))
    if len(words) <= shingle:
        return xxh64_intdigest(norm, SEED)
    starts, n, ones = [0, *(e + 1 for e in ends)], len(words) - shingle + 1, np.zeros(64, np.int64)
    for lo in range(0, n, CHUNK):
        hi = min(n, lo + CHUNK)
        h = np.fromiter((xxh64_intdigest(norm[a:b], SEED) for a, b in
                         zip(starts[lo:hi], ends[lo + shingle - 1: hi + shingle - 1])), np.uint64, hi - lo)
        ones += np.unpackbits(h.astype("<u8").view(np.uint8).reshape(-1, 8), axis=1,
                              bitorder="little").sum(0, dtype=np.int64)
    return int.from_bytes(np.packbits(2 * ones > n, bitorder="little").tobytes(), "little")


def fingerprints(df: DataFrame, key: str = "doc_id", text: str = "text", shingle: int = SHINGLE) -> DataFrame:
    """(doc_id, text_hash, fp): the key, xxhash64 of the text, the signed fingerprint."""
    ship_package(df.sparkSession)
    arrow_batches(df.sparkSession)

    def run(batches):
        for b in batches:
            fps = [fingerprint(bytes(t), shingle) if t is not None else 0 for t in b["body"]]
            yield pd.DataFrame({"doc_id": b["doc_id"], "text_hash": b["text_hash"],
                                "fp": np.array(fps, np.uint64).view(np.int64)})

    kind = df.schema[key].dataType.simpleString()
    rows = df.select(F.col(key).alias("doc_id"), F.xxhash64(F.col(text)).alias("text_hash"),
                     F.col(text).cast("binary").alias("body"))
    return rows.mapInPandas(run, f"doc_id {kind}, text_hash long, fp long")


def chain_budgets(max_bits: int, segments: int) -> list[int]:
    return [(i + 1) * max_bits // segments for i in range(segments)]


def _keys(max_bits: int, segments: int):
    """Join keys of a fingerprint: array of (ring start, half, key)."""
    seg = _layout(segments)

    def part(shift, width):
        return F.shiftrightunsigned(F.col("fp"), shift).bitwiseAND(F.lit((1 << width) - 1))

    out = []
    for i, (shift, width) in enumerate(seg):
        nshift, nwidth = seg[(i + 1) % segments]
        low = nwidth // 2
        for half, (s, w) in enumerate(((nshift, low), (nshift + low, nwidth - low))):
            tag = 2 * i + half
            out.append(F.lit(tag << 40).bitwiseOR(F.shiftleft(part(shift, width), 20)).bitwiseOR(part(s, w)))
    return F.array(*out)


def _linker(max_bits: int, segments: int):
    """mapInPandas body: rows sorted by (key, pair) -> spanning links per group."""
    seg = _layout(segments)
    budgets = chain_budgets(max_bits, segments)
    masks = np.zeros((segments, segments), np.uint64)  # [start][chain length - 1]
    for i in range(segments):
        m = 0
        for k in range(segments):
            s, w = seg[(i + k) % segments]
            m |= ((1 << w) - 1) << s
            masks[i, k] = m

    def spanning(key, pair, block, fp):
        n = len(key)
        label = np.arange(n)

        def root(x):
            while label[x] != x:
                label[x] = label[label[x]]
                x = label[x]
            return x

        group = np.cumsum(np.r_[0, (key[1:] != key[:-1]) | (pair[1:] != pair[:-1])])
        start = (key >> 41).astype(np.int64)  # the tag's ring start
        within = (pair >> 32) == (pair & 0xFFFFFFFF)
        ufp, at, s = fp.view(np.uint64), np.arange(n), 0
        while True:
            s += 1
            at = at[at + s < n]
            at = at[group[at + s] == group[at]]
            if not len(at):
                break
            hit = at[within[at] | (block[at] != block[at + s])]
            diff = ufp[hit] ^ ufp[hit + s]
            for k in range(1, segments):  # the chain, then (its whole ring) the full distance
                ok = np.bitwise_count(diff & masks[start[hit], k]) <= budgets[k]
                hit, diff = hit[ok], diff[ok]
            hit = hit[label[hit] != label[hit + s]]
            for a in hit:
                x, y = root(a), root(a + s)
                if x != y:
                    label[max(x, y)] = min(x, y)
            if len(hit):
                while True:  # flatten, so that equal labels mean equal roots
                    up = label[label]
                    if np.array_equal(up, label):
                        break
                    label = up
        linked = np.flatnonzero(label != np.arange(n))
        return pd.DataFrame({"a": fp[linked], "b": fp[label[linked]]}).drop_duplicates()

    def run(batches):
        held = None
        for b in batches:
            if held is not None:
                b = pd.concat([held, b], ignore_index=True)
            key, pair = b["key"].to_numpy(), b["pair"].to_numpy()
            last = int(np.flatnonzero((key != key[-1]) | (pair != pair[-1]))[-1] + 1) if len(b) and (
                (key != key[-1]) | (pair != pair[-1])).any() else 0
            held, done = b.iloc[last:], b.iloc[:last]
            if len(done):
                yield spanning(*(done[c].to_numpy() for c in ("key", "pair", "block", "fp")))
        if held is not None and len(held):
            yield spanning(*(held[c].to_numpy() for c in ("key", "pair", "block", "fp")))

    return run


def links(fps: DataFrame, max_bits: int = MAX_BITS, segments: int = SEGMENTS, block: int = BLOCK) -> DataFrame:
    """Links (a, b) that connect exactly the distinct fingerprints (column ``fp``)
    within ``max_bits`` bits of one another, directly or through others. Of
    each key group only a spanning forest of its links is returned, so a dense
    group gives fewer rows than fingerprints, never all its pairs. A key with
    more than ``block`` fingerprints is compared in pairs of blocks by as many
    tasks. Needs max_bits < segments < 2 * max_bits + 2, so that the chain
    starts with an equal segment and its second link differs in at most a bit.
    """
    budgets = chain_budgets(max_bits, segments)
    if budgets[0] != 0 or budgets[1] > 1:
        raise ValueError("segments must exceed max_bits, by less than twice")
    rows = fps.select("fp", F.explode(_keys(max_bits, segments)).alias("key"))
    # keys of one fingerprint only take no further part
    sizes = rows.groupBy("key").agg(F.count("*").alias("n")).filter("n > 1")
    rows = rows.join(sizes, "key").withColumn("nb", F.ceil(F.col("n") / block)) \
        .withColumn("block", F.pmod(F.xxhash64("fp"), F.col("nb")))
    rows = rows.withColumn("other", F.explode(F.sequence(F.lit(0).cast("long"), F.col("nb") - 1))) \
        .withColumn("pair", F.shiftleft(F.least("block", "other"), 32).bitwiseOR(F.greatest("block", "other")))
    rows = rows.select("key", "pair", "block", "fp").repartition(parts(fps.sparkSession), "key", "pair") \
        .sortWithinPartitions("key", "pair")
    ship_package(fps.sparkSession)
    return rows.mapInPandas(_linker(max_bits, segments), "a long, b long").distinct()


def clusters(df: DataFrame, key: str = "doc_id", text: str = "text", shingle: int = SHINGLE,
             max_bits: int = MAX_BITS) -> DataFrame:
    """One row per input row: ``doc_id``, ``text_hash``, ``fp``, ``fingerprint`` (16 hex
    digits), ``component`` (the smallest fingerprint of its component) and
    ``component_id`` (the smallest key reachable over links).

    Words are runs outside space and U+0009..U+000D after lower-casing A-Z;
    shingles of ``shingle`` words, repeats included (fewer words: the whole
    sequence); a fingerprint bit is set if more than half of the shingles'
    XXH64 (seed 42) have it. Null, empty and blank texts: fingerprint zero,
    linked like any other. Null keys: linked, never the smallest unless the
    whole component has none. Repeated rows share everything. An empty table
    gives an empty result. Equal fingerprints are collapsed before the search.
    """
    prints = materialize(fingerprints(df, key, text, shingle), "fingerprints")
    nodes = materialize(prints.groupBy("fp").agg(F.min("doc_id").alias("low")), "fp_nodes")
    found = components(cut_lineage(links(nodes, max_bits)))
    nodes = nodes.join(found.withColumnRenamed("node", "fp"), "fp", "left") \
        .withColumn("component", F.coalesce("root", "fp"))
    ids = nodes.groupBy("component").agg(F.min("low").alias("component_id"))
    nodes = materialize(nodes.join(ids, "component").select("fp", "component", "component_id"), "fp_components")
    return prints.join(nodes, "fp").select(
        "doc_id", "text_hash", "fp", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"),
        "component", "component_id")


def keep_one(df: DataFrame, key: str = "doc_id", text: str = "text", shingle: int = SHINGLE,
             max_bits: int = MAX_BITS) -> DataFrame:
    """The input with one row of each component: the one with the smallest key
    (null last), then text hash, then the other columns, so that reruns agree.
    All input columns are returned."""
    found = materialize(clusters(df, key, text, shingle, max_bits), "clusters")
    first = found.groupBy("component").agg(F.min(F.struct(
        F.isnull("doc_id").alias("none"), "doc_id", "text_hash")).alias("k")).select(
        F.col("k.doc_id").alias("__id"), F.col("k.text_hash").alias("__th"))
    rows = df.select(F.struct(*df.columns).alias("__row"), F.col(key).alias("__id0"),
                     F.xxhash64(F.col(text)).alias("__th0"))
    kept = rows.join(first, F.col("__id0").eqNullSafe(F.col("__id")) & (F.col("__th0") == F.col("__th")))
    # rows of equal key and text may differ elsewhere: the smallest in all columns (as text where a type has no order)
    loose = any("map<" in t or "variant" in t for _, t in df.dtypes)
    least = F.min_by("__row", F.to_json("__row")) if loose else F.min("__row")
    one = kept.groupBy("__id", "__th").agg(least.alias("__row"))
    return one.select("__row.*")


