import random

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from campaign_engine.llm import simhash_dedup as S

BLANK = " \t\n\x0b\x0c\r"


def brute_fp(text, k=4):
    low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    words, cur = [], ""
    for c in low + " ":
        if c in BLANK:
            if cur:
                words.append(cur)
            cur = ""
        else:
            cur += c
    if not words:
        return 0
    sh = [" ".join(words[i:i + k]) for i in range(max(1, len(words) - k + 1))]
    hs = [xxhash.xxh64_intdigest(s.encode(), 42) for s in sh]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hs) > len(hs))


def brute_components(fps, ids, bits=4):
    root = list(range(len(fps)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for i in range(len(fps)):
        for j in range(i):
            if (fps[i] ^ fps[j]).bit_count() <= bits:
                root[find(i)] = find(j)
    low = {}
    for i, d in enumerate(ids):
        r = find(i)
        low[r] = d if low.get(r) is None else (low[r] if d is None else min(low[r], d))
    return [low[find(i)] for i in range(len(fps))]


def signed(x):
    return x - (1 << 64) if x >> 63 else x


def test_fingerprints_against_brute_force():
    rng = random.Random(1)
    for _ in range(200):
        text = "".join(rng.choice(["Ab", "c", "É", " ", "\n", "\xa0", "\x0b", "Zé "]) for _ in range(rng.randint(0, 60)))
        assert S.fingerprint(text.encode()) == brute_fp(text), text


@pytest.mark.parametrize("block", [S.BLOCK, 7])
def test_links_against_all_pairs(spark, block):
    rng = random.Random(2)
    fps = {0, (1 << 64) - 1}
    for _ in range(60):
        base = rng.getrandbits(64)
        for _ in range(rng.choice([1, 2, 12])):
            x = base
            for b in rng.sample(range(64), rng.randint(0, 6)):
                x ^= 1 << b
            fps.add(x)
    fps = sorted(fps)
    df = spark.createDataFrame([(signed(x),) for x in fps], "fp long")
    got = S.links(df, block=block).collect()
    for r in got:  # no link that is not one
        assert r.a != r.b
    comp = {x: x for x in map(signed, fps)}

    def find(x):
        while comp[x] != x:
            x = comp[x]
        return x

    for r in got:
        comp[find(r.a)] = find(r.b)
    want = brute_components(fps, list(range(len(fps))))
    groups = {}
    for x, w in zip(map(signed, fps), want):
        groups.setdefault(w, set()).add(find(x))
    assert all(len(g) == 1 for g in groups.values())
    assert len({min(g) for g in groups.values()}) == len(groups)


def test_dense_group_gives_few_links(spark):
    rng = np.random.default_rng(3)
    fps = {0}
    while len(fps) < 600:
        fps.add(int(sum(1 << int(b) for b in rng.choice(64, 2, replace=False))))
    df = spark.createDataFrame([(signed(x),) for x in fps], "fp long")
    assert S.links(df).count() < 6 * len(fps)


def test_clusters_with_odd_rows(spark):
    base = "the quick brown fox jumps over the lazy dog and runs far away from here " * 3
    rows = [(5, base), (9, base.upper()), (2, base + "x"), (None, base), (7, None), (8, ""), (6, " \n"), (1, "one two"),
            (11, "One  two"), (11, "One  two"), (None, "alone here"), (12, "three")]
    df = spark.createDataFrame(rows, "doc_id long, text string").withColumn("fp", F.lit("clash"))
    got = S.clusters(df).collect()
    fps = [brute_fp(t) for _, t in rows]
    want = sorted(map(str, zip([d for d, _ in rows], [f"{f:016x}" for f in fps], brute_components(fps, [d for d, _ in rows]))))
    assert sorted(str((r.doc_id, r.fingerprint, r.component_id)) for r in got) == want
    kept = S.keep_one(df)
    assert kept.columns == df.columns
    assert kept.count() == len({r.component for r in got})
    assert S.clusters(df.limit(0)).count() == 0 and S.keep_one(df.limit(0)).count() == 0


def test_keep_one_does_not_depend_on_the_order_of_the_input(spark):
    text = "one two three four five six seven eight"
    rows = [(1, text, s, n) for s in ("x", "y", None) for n in (3, 1, None)] + [(2, text, "a", 0), (1, "other words here", "z", 5)]
    kept = set()
    for seed in range(4):
        random.Random(seed).shuffle(rows)
        df = spark.createDataFrame(rows, "doc_id long, text string, source string, n_chars long").repartition(1 + seed)
        kept.add(tuple(sorted(map(str, S.keep_one(df).collect()))))
    assert len(kept) == 1
    odd = spark.createDataFrame([(1, text, {"k": "b"}), (1, text, {"k": "a"})], "doc_id long, text string, m map<string,string>")
    assert S.keep_one(odd).first()["m"] == {"k": "a"}
