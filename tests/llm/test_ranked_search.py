import math
import random
import re

import numpy as np
import pytest

from campaign_engine.llm import ranked_search as rs

TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")
FOLD = str.maketrans(rs.UPPER, rs.LOWER)


def terms_of(t):
    return TERM.findall((t or "").translate(FOLD))


def brute(docs, items, k):
    held = [(d, terms_of(t)) for d, t in docs]
    held = [(d, ts) for d, ts in held if ts]
    n, total = len(held), sum(len(ts) for _, ts in held)
    df = {}
    for _, ts in held:
        for t in set(ts):
            df[t] = df.get(t, 0) + 1
    out = []
    for item, text in items:
        scored = []
        for d, ts in held:
            m = 50 + (50 * len(ts) * n) // total
            s = 0
            for t in set(terms_of(text)) & set(ts):
                w = math.floor(1000 * math.log((2 * n + 2) / (2 * df[t] + 1)))
                tf = ts.count(t)
                s += w * ((1000000000 * tf) // (1000 * tf + 20 * m))
            if s > 0:
                scored.append((-s, d is None, d or 0))
        for r, (s, null, d) in enumerate(sorted(scored)[:k], 1):
            out.append((item, r, None if null else d, -s))
    return sorted(out, key=str)


def corpus(seed, n=120, vocab=60):
    rng = random.Random(seed)
    words = [f"w{i}" for i in range(vocab)] + ["Édit", "x1", "ÄB", "the", "The"]
    weight = [1 / (i + 1) for i in range(len(words))]
    docs = []
    for i in range(n):
        ws = rng.choices(words, weight, k=rng.randint(0, 40))
        docs.append((i, rng.choice([" ", ", ", "_"]).join(ws)))
    docs += [(None, docs[3][1]), (None, docs[3][1]), (5, docs[5][1]), (900, None), (901, ""), (902, "?!"),
             (903, " ".join(rng.choices(words, weight, k=5000)))]
    items = [(j, " ".join(rng.choices(words, k=rng.randint(1, 12)))) for j in range(25)]
    return docs, items + [(0, items[1][1]), (None, items[2][1]), (50, None), (51, ""), (52, "absent"), (53, "-- ..")]


@pytest.mark.parametrize("seed,shard_docs,k,per_block", [(1, 7, 50, 1000), (2, 7, 3, 4), (3, 1000, 5, 1000), (4, 1, 2, 5)])
def test_equals_brute_force(spark, monkeypatch, seed, shard_docs, k, per_block):
    monkeypatch.setattr(rs, "ITEMS_PER_BLOCK", per_block)
    monkeypatch.setattr(rs, "CHUNK", 64)
    docs, items = corpus(seed)
    d = spark.createDataFrame([(*r, "x", 1) for r in docs], "doc_id long, text string, term string, shard int")
    i = spark.createDataFrame([(*r, "y") for r in items], "item_id long, text string, item string")
    got = rs.search(rs.build_index(d.repartition(3), shard_docs=shard_docs), i, k=k)
    assert sorted((tuple(r) for r in got.collect()), key=str) == brute(docs, items, k)


def test_empty_tables(spark):
    docs, items = corpus(5, 20)
    d = spark.createDataFrame(docs, "doc_id long, text string")
    i = spark.createDataFrame(items, "item_id long, text string")
    index = rs.build_index(d)
    assert rs.search(index, i.limit(0)).count() == 0
    assert rs.search(rs.build_index(d.limit(0)), i).count() == 0
    assert rs.search(rs.build_index(d.filter("doc_id >= 900 and doc_id < 903")), i).count() == 0


def test_string_keys(spark):
    docs, items = corpus(6, 40)
    d = spark.createDataFrame([(None if k is None else f"d{k:04d}", t) for k, t in docs], "id string, body string")
    got = rs.search(rs.build_index(d, "id", "body", shard_docs=9), spark.createDataFrame(items, "q long, text string"),
                    item_key="q").collect()
    want = [(i, r, None if k is None else f"d{k:04d}", s) for i, r, k, s in brute(docs, items, rs.K)]
    assert sorted(map(tuple, got), key=str) == sorted(want, key=str)


def test_pair_bounds_hold_and_are_tighter(spark):
    docs, items = corpus(7, 200)
    index = rs.build_index(spark.createDataFrame(docs, "doc_id long, text string"), shard_docs=25)
    terms, pairs, numbers = rs._workload(index, spark.createDataFrame(items, "item_id long, text string"), "item_id", "text")
    bounds = rs.add_bounds(index, terms, pairs, numbers)
    single = {(r.shard, r.a): r for r in bounds.filter("b IS NULL").collect()}
    tighter = 0
    for r in bounds.filter("b IS NOT NULL").collect():
        one, two = (dict(zip(x.slots, x.impacts)) if (x := single.get((r.shard, t))) else {} for t in (r.a, r.b))
        both = {s: one[s] + two[s] for s in one.keys() & two.keys()}
        assert dict(zip(r.slots, r.impacts)) == both
        assert r.top == max([*both.values(), *one.values(), *two.values()])
        tighter += r.top < max(one.values(), default=0) + max(two.values(), default=0)
    assert tighter > 0


def test_best_skips_but_stays_exact():
    rng = np.random.default_rng(1)
    n, k = 2000, 10
    lists, parts = {}, []
    for j in range(12):
        slots = np.sort(rng.choice(n, 20 if j < 4 else 1200, replace=False)).astype(np.int32)
        lists[f"t{j}"] = slots, rng.integers(1, 10_000 if j < 4 else 300, len(slots))
    for j in range(0, 12, 2):
        parts.append((int(lists[f"t{j}"][1].max() + lists[f"t{j + 1}"][1].max()), f"t{j}", f"t{j + 1}"))
    parts.sort(reverse=True)
    full = np.zeros(n, np.int64)
    for slots, impact in lists.values():
        full[slots] += impact
    theta = int(np.sort(full)[-k])
    slots, value, read = rs.best(lists, parts, n, theta, k)
    assert sorted(slots) == sorted(np.flatnonzero(full >= theta)) and all(full[slots] == value)
    assert read < sum(len(s) for s, _ in lists.values()) / 2
