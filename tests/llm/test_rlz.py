import random

import pytest

from campaign_engine.llm import rlz_dedup, windows


def brute(rows, n):
    order = lambda d: (d is None, d or 0)
    seen, words = {}, []
    for d, t in rows:
        ws = []
        for part in (t or "").replace("\t", " ").replace("\n", " ").split(" "):
            if part:
                ws.append(part)
        words.append(ws)
        for i in range(len(ws) - n + 1):
            w = tuple(ws[i:i + n])
            seen[w] = min(seen.get(w, order(d)), order(d))
    out = []
    for (d, _), ws in zip(rows, words):
        gone = set()
        for i in range(len(ws) - n + 1):
            if seen[tuple(ws[i:i + n])] < order(d):
                gone.update(range(i, i + n))
        out.append((d, len(ws), len(gone), " ".join(w for i, w in enumerate(ws) if i not in gone)))
    return sorted(out, key=str)


def corpus(rng, n_docs, vocab, passage):
    shared = [[rng.choice(vocab) for _ in range(rng.randint(3, passage))] for _ in range(6)]
    rows = []
    for i in range(n_docs):
        ws = []
        for _ in range(rng.randint(0, 5)):
            ws += rng.choice(shared) if rng.random() < 0.6 else [rng.choice(vocab) for _ in range(rng.randint(1, 30))]
            if ws and rng.random() < 0.3:
                ws[rng.randrange(len(ws))] = "Edit"
        rows.append((rng.choice([i, i, i, None, 3]), rng.choice([" ", "\n", "  "]).join(ws)))
    return rows + rows[:4] + [(1000, None), (1001, " "), (None, rows[0][1])]


@pytest.mark.parametrize("seed,vocab,piece", [(1, 40, None), (2, 2, None), (3, 40, 20), (4, 3, 17)])
def test_against_all_windows(spark, monkeypatch, seed, vocab, piece):
    if piece:
        monkeypatch.setattr(windows, "PIECE", piece)
    rng = random.Random(seed)
    rows = corpus(rng, 40, [f"w{i}" for i in range(vocab)], 40)
    df = spark.createDataFrame([(*r, "x") for r in rows], "doc_id long, text string, doc string")
    got = sorted(((r.doc_id, r.n_words, r.n_removed, r.kept) for r in rlz_dedup.dedup(df).collect()), key=str)
    assert got == brute(rows, 13)


def test_copies_and_empty_table(spark):
    text = " ".join(f"w{i}" for i in range(50))
    df = spark.createDataFrame([(i, text) for i in range(30)], "doc_id long, text string")
    got = {r.doc_id: r for r in rlz_dedup.dedup(df).collect()}
    assert got[0].n_removed == 0 and got[0].factors == ""
    assert all(got[i].n_removed == 50 and got[i].factors == "0:50" for i in range(1, 30))
    assert rlz_dedup.dedup(df.limit(0)).count() == 0


def test_thousands_of_texts_under_one_id(spark):
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "10000")
    rng = random.Random(6)
    text = lambda k: [f"w{rng.randrange(50)}" for _ in range(k)]
    shared = [text(20) for _ in range(5)]
    rows = [(0, " ".join(sum(shared, [])))]
    for i in range(6000):
        ws = text(rng.randint(13, 30))
        rows.append((None if i % 2 else 7, " ".join(rng.choice(shared) + ws[:8] if i % 4 < 2 else ws)))
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = sorted(((r.doc_id, r.n_words, r.n_removed, r.kept) for r in rlz_dedup.dedup(df).collect()), key=str)
    assert got == brute(rows, 13)
