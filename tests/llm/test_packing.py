import zlib

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from campaign_engine.llm import packing

JSON = public_tokenizers.path("byte_bpe_50k.json")
RANKS = public_tokenizers.path("byte_bpe_50k.tiktoken")


def check(df, rows, **kw):
    """Every id in exactly one piece, sequences gapless and bounded; returns the pieces."""
    tok = Tokenizer.from_file(JSON)
    cap = kw.get("capacity", packing.CAPACITY)
    got = packing.pack(df, JSON, RANKS, **kw).collect()
    want = {}
    for d, t in rows:
        ids = (*tok.encode(t or "", add_special_tokens=False).ids, 0)
        want[d, ids] = want.get((d, ids), 0) + 1
    by_start = {}
    for r in got:
        ids = tuple(np.frombuffer(r.ids, "<u4").tolist())
        assert len(ids) == r.length > 0
        by_start.setdefault((r.doc_id, r.doc_tokens), []).append((r.start, ids))
    total = sum(len(k[1]) * n for k, n in want.items())
    assert sum(r.length for r in got) == total
    for (d, ids), n in want.items():  # each id of each start is held as often as documents have it
        mine = by_start[d, len(ids)]
        at = sorted(s for s, p in mine if p == ids[s:s + len(p)])
        assert sum(len(p) for s, p in mine if p == ids[s:s + len(p)]) >= n * len(ids)
        assert at[0] == 0
    seqs = {}
    for r in got:
        seqs.setdefault(r.sequence_id, []).append((r.offset, r.length))
    assert sorted(seqs) == list(range(len(seqs)))
    for parts in seqs.values():
        end = 0
        for o, n in sorted(parts):
            assert o == end
            end += n
        assert end <= cap
    fill = [sum(n for _, n in p) for p in seqs.values()]
    padded = sum(cap - f for f in fill if f & (f - 1))
    return got, padded, total


def texts(n):
    words = ["alpha", "Beta", "gamma,", "delta", "don't", "café", "\n", "12345", "ß"]
    return [(i, " ".join(words[(i * 7 + k * k) % 9] for k in range((i * 37) % 900))) for i in range(n)]


def test_every_id_once_with_little_padding(spark):
    rows = texts(150) + [(None, "null key"), (None, "null key"), (1, "again"), (900, None), (901, ""),
                         (902, "a <|endoftext|> b"), (903, "x" * 40000), (904, " " * 5000)]
    df = spark.createDataFrame([(*r, 1, "x") for r in rows], "doc_id long, text string, length int, bin string")
    got, padded, total = check(df.repartition(5), rows)
    assert padded <= total / 50
    one = {}
    for r in got:
        one.setdefault(r.doc_id, []).append(r)
    longest = sorted(one[903], key=lambda r: r.start)
    assert [r.start for r in longest] == list(np.cumsum([0] + [r.length for r in longest[:-1]]))


@pytest.mark.parametrize("capacity,slack", [(1024, 64), (64, 16), (16, 16), (8, 8)])
def test_small_capacities(spark, capacity, slack):
    rows = texts(40)
    df = spark.createDataFrame(rows, "doc_id long, text string")
    check(df, rows, capacity=capacity, slack=slack)


def test_plan():
    per, cut = packing.plan()
    for n in [*range(1, 3000), 123457]:
        parts = packing.cuts(n)
        assert sum(parts) == n and all(per[p] for p in parts)
        assert all(1024 - 16 <= p * per[p] <= 1024 for p in parts)
        assert sum(p < 1024 for p in parts) <= 4


def test_empty_and_one(spark):
    df = spark.createDataFrame([(1, "a b")], "doc_id long, text string")
    got, padded, _ = check(df, [(1, "a b")])
    assert padded == 0
    assert packing.pack(df.limit(0), JSON, RANKS).count() == 0


def test_sequences_and_digest(spark):
    rows = texts(30)
    pieces = packing.pack(spark.createDataFrame(rows, "doc_id long, text string"), JSON, RANKS)
    seqs = {r.sequence_id: r for r in packing.sequences(pieces).collect()}
    from pyspark.sql import functions as F
    for r in pieces.withColumn("crc", F.crc32("ids")).collect():
        whole = seqs[r.sequence_id].ids
        assert whole[4 * r.offset:4 * (r.offset + r.length)] == bytes(r.ids)
        assert r.crc == zlib.crc32(bytes(r.ids)) and r.offset in seqs[r.sequence_id].bounds


def test_encoders_agree(spark):
    slow, fast = packing.encoder(JSON), packing.encoder(JSON, RANKS)
    for r in spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("text").collect():
        assert slow(r.text).tolist() == fast(r.text).tolist()
    for t in ["", " ", "\r\n\t x", "a<|endoftext|>b", "\u0000�\U0001f600", "é" * 1000]:
        assert slow(t).tolist() == fast(t).tolist()
