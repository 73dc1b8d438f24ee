import hashlib
import random

import numpy as np
import pytest

from campaign_engine.llm import pfp_dedup, windows


def brute(rows, n=100):
    order = lambda d: (d is None, d or 0)
    seen = {}
    for d, t in rows:
        b = (t or "").encode()
        for i in range(len(b) - n + 1):
            key, here = b[i:i + n], (order(d), i)
            if key not in seen or here < seen[key]:
                seen[key] = here
    out = []
    for d, t in rows:
        b = (t or "").encode()
        gone = [False] * len(b)
        for i in range(len(b) - n + 1):
            if seen[b[i:i + n]] < (order(d), i):
                gone[i:i + n] = [True] * n
        kept = bytes(x for x, g in zip(b, gone) if not g)
        n_spans = sum(g and (i == 0 or not gone[i - 1]) for i, g in enumerate(gone))
        out.append((d, len(b), sum(gone), n_spans, hashlib.sha256(kept).hexdigest()))
    return sorted(out, key=str)


def corpus(rng, n_docs, alphabet):
    text = lambda k: "".join(rng.choice(alphabet) for _ in range(k))
    shared = [text(rng.randint(60, 500)) for _ in range(8)] + ["ab" * 150, "é" * 120]
    rows = []
    for i in range(n_docs):
        t = ""
        for _ in range(rng.randint(0, 5)):
            s = rng.choice(shared) if rng.random() < 0.6 else text(rng.randint(1, 300))
            if rng.random() < 0.4:
                s = s[rng.randint(0, 40):]
            if s and rng.random() < 0.3:
                at = rng.randrange(len(s))
                s = s[:at] + "#" + s[at + 1:]
            t += s
        rows.append((rng.choice([i, i, i, None, 3]), t))
    return rows + rows[:4] + [(1000, None), (1001, "x" * 99), (1002, "x" * 100), (None, rows[0][1])]


@pytest.mark.parametrize("seed,alphabet", [(1, "abcdefgh é"), (2, "ab"), (3, "a"), (4, "the of and in ")])
def test_against_all_windows(spark, seed, alphabet):
    rows = corpus(random.Random(seed), 30, alphabet)
    df = spark.createDataFrame([(*r, "x") for r in rows], "doc_id long, text string, doc string")
    got = sorted(((r.doc_id, r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in pfp_dedup.dedup(df).collect()), key=str)
    assert got == brute(rows)


def test_kept_bytes_and_empty_table(spark):
    df = spark.createDataFrame([(i, "0123456789" * 30 + str(i)) for i in range(20)], "doc_id long, text string")
    for r in pfp_dedup.dedup(df, texts=True).collect():
        assert hashlib.sha256(bytes(r.kept)).hexdigest() == r.kept_sha256 and len(r.kept) == r.n_bytes - r.n_removed
    assert pfp_dedup.dedup(df.limit(0)).count() == 0


def test_pieces_lose_no_window(monkeypatch):
    monkeypatch.setattr(windows, "PIECE", 37)
    rng = np.random.default_rng(5)
    texts = [rng.integers(0, 4, size).astype(np.uint64) for size in (0, 5, 12, 13, 40, 37, 200, 1)]
    seen = set()
    for p in windows.pieces(enumerate(texts), 13):
        row, a, off, count, k1, _ = windows.triggers(p, 13, 5)
        for r, s, o, c, k in zip(row, a, off, count, k1):
            for w in range(s, s + c):
                assert (r, w) not in seen and w <= s + o <= w + 13 - 5
                seen.add((r, w))
            assert k == windows.Rolling(texts[r])(np.array([s + o]), 5)[0]
    assert seen == {(r, w) for r, t in enumerate(texts) for w in range(len(t) - 12)}


def test_sift_streams_over_batches(spark):
    rng = random.Random(1)
    rows = [(rng.randrange(12), rng.randrange(4), rng.randrange(30), rng.randrange(3) << 32 | 5) for _ in range(500)]
    rows += rows[:50]
    df = spark.createDataFrame(rows, windows.ROWS)
    for across in (True, False):
        low, kinds = {}, {}
        for k1, k2, d, loc in rows:
            at = d if across else (d, loc >> 32)
            low[k1, k2] = min(low.get((k1, k2), at), at)
            kinds.setdefault(k1, set()).add(k2)
        later, open_ = [], []
        for k1, k2, d, loc in set(rows):
            if (d if across else (d, loc >> 32)) > low[k1, k2]:
                later.append((d, -1 - loc))
            elif len(kinds[k1]) > 1:
                open_.append((d, loc))
        got = [tuple(r) for r in windows.sift(df, across, True).collect()]
        assert sorted(got) == sorted(later + open_)
        got = [tuple(r) for r in windows.sift(df, across, False).collect()]
        assert sorted(got) == sorted(later)


def test_thousands_of_texts_under_one_id(spark):
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "10000")
    rng = random.Random(6)
    text = lambda k: "".join(rng.choice("abcdefgh") for _ in range(k))
    shared = [text(130) for _ in range(5)]
    rows = [(0, "".join(shared))]
    for i in range(6000):
        t = text(rng.randint(101, 140))
        rows.append((None if i % 2 else 7, rng.choice(shared) + t[:60] if i % 4 < 2 else t))
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = sorted(((r.doc_id, r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in pfp_dedup.dedup(df).collect()), key=str)
    assert got == brute(rows)
