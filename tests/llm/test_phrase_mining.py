import random
import re
from collections import Counter

import pytest

from campaign_engine.llm import phrase_mining as pm

FOLD = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def brute_counts(rows, most):
    f, n = Counter(), Counter()
    for lang, text in rows:
        lang = "und" if lang is None else lang
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", (text or "").translate(FOLD)):
            ws = re.findall(r"[^\x20\x09]+", piece)
            n[lang] += len(ws)
            for k in range(1, most + 1):
                for i in range(len(ws) - k + 1):
                    f[lang, tuple(ws[i:i + k])] += 1
    return f, n


def brute(rows, min_count, most, top, pct):
    f, n = brute_counts(rows, most)
    cand = {p: a for p, a in f.items() if len(p[1]) > 1 and a >= min_count}
    out = {}
    for (lang, ws), a in cand.items():
        if any(100 * b >= pct * a for (l2, w2), b in cand.items() if l2 == lang and len(w2) > len(ws)
               and any(w2[i:i + len(ws)] == ws for i in range(len(w2)))):
            continue
        score, k = min(((1000000 * a * a) // (f[lang, ws[:k]] * f[lang, ws[k:]]), k) for k in range(1, len(ws)))
        out.setdefault(lang, []).append((-score, -a, " ".join(ws).encode(), f[lang, ws[:k]], f[lang, ws[k:]]))
    res = []
    for lang, found in out.items():
        for rank, (s, a, p, l, r) in enumerate(sorted(found)[:top], 1):
            res.append((lang, rank, p.decode(), -a, l, r, n[lang], -s))
    return sorted(res)


def corpus(seed, n_docs=60, vocab=12):
    rng = random.Random(seed)
    words = [f"w{i}" for i in range(vocab)] + ["Été", "ABC", "x\x00y", "nb sp"]
    weight = [1 / (i + 1) for i in range(len(words))]
    rows = []
    for _ in range(n_docs):
        ws = rng.choices(words, weight, k=rng.randint(0, 80))
        rows.append((rng.choice(["en", "en", "de", None]), "".join(w + rng.choice([" ", " ", "  ", "\t", ". ", ",", "\n", "\r\n"]) for w in ws)))
    return rows + [("en", None), ("de", ""), ("fr", " .,;"), ("en", rows[0][1]), ("en", rows[0][1]), ("it", "a a a a a a a a a a a a a")]


@pytest.mark.parametrize("seed,shard_bytes,most,min_count", [(1, 500, 3, 10), (2, 1 << 24, 3, 2), (3, 1, 3, 5), (4, 300, 2, 3),
                                                             (5, 700, 4, 3), (6, 2000, 5, 2)])
def test_equals_brute_force(spark, monkeypatch, seed, shard_bytes, most, min_count):
    monkeypatch.setattr(pm, "CHUNK", 50)
    rows = corpus(seed)
    df = spark.createDataFrame([(*r, 1, "z") for r in rows], "lang string, text string, id long, phrase string").repartition(3)
    got = pm.collocations(df, min_count=min_count, max_words=most, top=40, shard_bytes=shard_bytes)
    assert sorted(map(tuple, got.collect())) == brute(rows, min_count, most, 40, pm.INSIDE_PCT)


@pytest.mark.parametrize("most", [2, 3, 4])
def test_all_counts(spark, most):
    rows = corpus(7, 30, 6)
    df = spark.createDataFrame(rows, "lang string, text string").repartition(4)
    phrases, totals = pm.count_phrases(df, min_count=3, max_words=most, shard_bytes=800)
    f, n = brute_counts(rows, most)
    assert {(r.lang, tuple(r.phrase.split(" "))): r.f for r in phrases.collect()} == {p: a for p, a in f.items() if a >= 3}
    assert {r.lang: r.n for r in totals.collect()} == {k: v for k, v in n.items() if v}


def test_large_counts_stay_exact(spark):
    rows = [("en", "aa bb " * 40000), ("en", "aa cc. " * 30000)]
    got = pm.collocations(spark.createDataFrame(rows, "lang string, text string"), shard_bytes=100_000).collect()
    assert sorted(map(tuple, got)) == brute(rows, 10, 3, pm.TOP, pm.INSIDE_PCT)


def test_empty(spark):
    df = spark.createDataFrame([("en", None), (None, " . ")], "lang string, text string")
    assert pm.collocations(df).count() == 0 and pm.collocations(df.limit(0)).count() == 0
