"""Benchmark decontamination by size-partitioned MinHash containment (native).

Items are partitioned by the number of their distinct word shingles. Of each
item only its bottom MinHash sketch is indexed: the smallest shingle hashes,
as many as a document holding the wanted share of the item cannot all miss.
Documents probe with their shingles below the threshold of the size classes
they are long enough for; candidate pairs are verified by exact shingles.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .common import materialize, words

WIDTH, CONTAINMENT = 5, 0.8
BROADCAST_ROWS = 1_000_000     # index rows (about 24 bytes each beside their texts)
BROADCAST_BYTES = 64 << 20     # and bytes of their texts up to which an index is broadcast


def _shingle_hashes(width: int):
    """SQL over the array ``wh`` of word hashes: hashes of all ``width``-word shingles."""
    args = ", ".join(f"wh[i + {k}]" for k in range(width))
    return f"""CASE WHEN size(wh) >= {width} THEN
        transform(sequence(0, size(wh) - {width}), i -> xxhash64({width}, {args}))
        ELSE CAST(array() AS array<bigint>) END"""


def _shingle_texts(width: int):
    return f"""CASE WHEN size(ws) >= {width} THEN
        transform(sequence(1, size(ws) - {width - 1}), i -> array_join(slice(ws, i, {width}), ' '))
        ELSE CAST(array() AS array<string>) END"""


def _small(df: DataFrame, text: str | None = None) -> DataFrame:
    """Broadcast a materialised index only when its counted rows, and the bytes of its column ``text``, are few."""
    size = F.sum(F.octet_length(text)) if text else F.lit(0)
    rows, held = df.agg(F.count("*"), size).first()
    return F.broadcast(df) if rows <= BROADCAST_ROWS and (held or 0) <= BROADCAST_BYTES else df


def _items(bench: DataFrame, key: str, text: str, width: int) -> DataFrame:
    """Items with words: item, item_id, width (of its shingles), ws."""
    rows = bench.select(F.col(key).alias("item_id"), F.xxhash64(F.col(key), F.col(text)).alias("item"),
                        F.lower(F.col(text)).alias("__t"))
    rows = rows.withColumn("ws", words(F.col("__t"))).filter(F.size("ws") > 0)
    return rows.dropDuplicates(["item"]).withColumn("width", F.least(F.size("ws"), F.lit(width))).drop("__t")


def contaminated(docs: DataFrame, bench: DataFrame, key: str = "doc_id", text: str = "text",
                 item_key: str = "item_id", item_text: str = "text", width: int = WIDTH,
                 containment: float = CONTAINMENT) -> DataFrame:
    """Pairs of a document and an item of which at least ``containment`` of the
    distinct shingles occur in the document: ``doc_id``, ``item_id``,
    ``n_shingles`` (of the item), ``n_shared``, ``containment``.

    Shingles are ``width`` consecutive words of the lower-cased text; an item
    with fewer words is one shingle of all its words. Null, empty and blank
    texts hold no words and match nothing. Null keys are kept as they are.
    Repeated documents or items give one pair per distinct (key, text). Other
    columns are not read; empty tables give an empty result.

    No recall is lost: an item of n shingles with at most
    n - ceil(containment * n) of them missing shares one of any set of one
    more. Nothing groups all documents of an item: matches are counted per
    document and item, pre-aggregated.
    """
    return _pairs(docs, bench, key, text, item_key, item_text, width, containment).drop("doc")


def _pairs(docs: DataFrame, bench: DataFrame, key: str = "doc_id", text: str = "text", item_key: str = "item_id",
           item_text: str = "text", width: int = WIDTH, containment: float = CONTAINMENT) -> DataFrame:
    """The pairs of ``contaminated`` with ``doc``, the hash of the document's key and text."""
    items = materialize(_items(bench, item_key, item_text, width), "items")
    widths = sorted(r[0] for r in items.select("width").distinct().collect())  # at most ``width`` numbers
    texts = items.withColumn("shingle", F.explode(F.expr("CASE " + " ".join(
        f"WHEN width = {w} THEN {_shingle_texts(w)}" for w in range(1, width + 1)) + " END")))
    texts = texts.select("item", "item_id", "width", "shingle").distinct()
    sizes = texts.groupBy("item").agg(F.count("*").cast("long").alias("n"))
    texts = materialize(texts.join(sizes, "item"), "item_shingles")
    # hash of a shingle as the documents' side computes it
    hashed = texts.withColumn("wh", F.expr("transform(split(shingle, ' '), w -> xxhash64(w))")) \
        .withColumn("h", F.expr("CASE " + " ".join(f"WHEN width = {w} THEN ({_shingle_hashes(w)})[0]"
                                                   for w in range(1, width + 1)) + " END"))
    need = F.ceil(F.col("n") * F.lit(containment) - 1e-9).cast("long")
    sketch = hashed.withColumn("r", F.row_number().over(Window.partitionBy("item").orderBy("h"))) \
        .withColumn("need", need).filter(F.col("r") <= F.col("n") - F.col("need") + 1) \
        .select("item", "width", "n", "need", "h", F.floor(F.log2("n")).alias("class"))
    sketch = materialize(sketch, "item_sketch")
    # one row per shingle width and power of two of the size: a few dozen numbers
    classes = sketch.groupBy("width", "class").agg(F.max("h").alias("top"), F.min("need").alias("need")).collect()
    if not classes:
        return docs.limit(0).select(F.col(key).alias("doc_id"), F.xxhash64(F.col(key), F.col(text)).alias("doc")).join(
            texts.limit(0).select("item_id", F.col("n").alias("n_shingles")), F.lit(False)).select(
            "doc", "doc_id", "item_id", "n_shingles", F.lit(0).cast("long").alias("n_shared"),
            F.lit(0.0).alias("containment"))
    rows = docs.select(F.col(key).alias("doc_id"), F.xxhash64(F.col(key), F.col(text)).alias("doc"),
                       words(F.lower(F.col(text))).alias("ws"))
    probe = rows.filter(F.size("ws") >= min(widths)).select(
        "doc", F.transform("ws", lambda w: F.xxhash64(w)).alias("wh"))
    pieces = []
    for w in widths:
        tops = sorted(((r.need, r.top) for r in classes if r.width == w), reverse=True)
        cases = " ".join(  # size partitions: a document probes only the classes it is long enough for
            f"WHEN size(wh) - {w - 1} >= {need} THEN {max(t for n, t in tops if n <= need)}L" for need, _ in tops)
        pieces.append(f"filter({_shingle_hashes(w)}, h -> h <= coalesce(CASE {cases} END, {-(1 << 63) + 1}L))")
    probe = probe.select("doc", F.explode(F.array_distinct(F.concat(*[F.expr(p) for p in pieces]))).alias("h"))
    candidates = materialize(probe.join(_small(sketch.select("h", "item")), "h")
                             .select("doc", "item").distinct(), "candidates")
    held = rows.join(candidates.select("doc").distinct(), "doc", "left_semi")
    held = held.withColumn("shingle", F.explode(F.array_distinct(F.concat(
        *[F.expr(_shingle_texts(w)) for w in widths])))).select("doc", "doc_id", "shingle")
    shared = held.join(_small(texts, "shingle"), "shingle").join(candidates, ["doc", "item"], "left_semi")
    # repeated documents: distinct shingles of the same (key, text)
    shared = shared.groupBy("doc", "doc_id", "item", "item_id", "n").agg(
        F.count_distinct("shingle").alias("n_shared"))
    return shared.filter(F.col("n_shared") >= need).select(
        "doc", "doc_id", "item_id", F.col("n").alias("n_shingles"), F.col("n_shared").cast("long"),
        (F.col("n_shared") / F.col("n")).alias("containment"))


def remove_contaminated(docs: DataFrame, bench: DataFrame, key: str = "doc_id", text: str = "text",
                        **options) -> DataFrame:
    """The documents that hold no item; all columns are kept. A document is its key
    and text: clean documents of a null or repeated key stay, repeated rows stay or go together.
    Texts without words stay; an empty table of items removes nothing."""
    hit = materialize(_pairs(docs, bench, key, text, **options).select(
        F.col("doc_id").alias("__hit"), F.col("doc").alias("__doc")).distinct(), "contaminated")
    return docs.join(hit, F.col(key).eqNullSafe(F.col("__hit"))
                     & (F.xxhash64(F.col(key), F.col(text)) == F.col("__doc")), "left_anti")

