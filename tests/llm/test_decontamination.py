import math
import random

import pytest

from campaign_engine.llm import decontamination as D


def shingles(words, w):
    return {" ".join(words[i:i + w]) for i in range(len(words) - w + 1)}


def brute(docs, items, width=5, c=0.8):
    out = set()
    for item, t in set(items):
        ws = (t or "").lower().split()
        if not ws:
            continue
        w = min(width, len(ws))
        q = shingles(ws, w)
        for d, x in set(docs):
            n = len(q & shingles((x or "").lower().split(), w))
            if n >= math.ceil(c * len(q) - 1e-9):
                out.add((d, item, len(q), n))
    return out


@pytest.mark.parametrize("limit,held", [(D.BROADCAST_ROWS, D.BROADCAST_BYTES), (0, D.BROADCAST_BYTES), (D.BROADCAST_ROWS, 1)])
def test_pairs_against_brute_force(spark, monkeypatch, limit, held):
    monkeypatch.setattr(D, "BROADCAST_ROWS", limit)
    monkeypatch.setattr(D, "BROADCAST_BYTES", held)
    rng = random.Random(4)
    vocab = [f"w{i}" for i in range(30)]
    items = [(i, " ".join(rng.choice(vocab) for _ in range(rng.choice([1, 3, 5, 6, 14, 40])))) for i in range(25)]
    items += [(90, None), (91, " "), items[0], (None, "q r s t u v w"), (3, "other text of the same id here")]
    docs = []
    for i in range(80):
        ws = [rng.choice(vocab) for _ in range(rng.choice([0, 3, 30, 200]))]
        if i % 2:
            t = items[rng.randrange(25)][1].upper().split()
            for _ in range(rng.choice([0, 0, 1, 2])):
                t[rng.randrange(len(t))] = "edit"
            ws[len(ws) // 2:len(ws) // 2] = t
        docs.append((i, "\t".join(ws)))
    docs += [(200, None), (None, "x q r s t u v w y"), docs[1], docs[3]]
    df = spark.createDataFrame([(*d, 1) for d in docs], "doc_id long, text string, item_id int")
    bench = spark.createDataFrame([(*i, "z") for i in items], "item_id long, text string, doc_id string")
    got = [(r.doc_id, r.item_id, r.n_shingles, r.n_shared) for r in D.contaminated(df, bench).collect()]
    assert len(got) == len(set(got))
    assert set(got) == brute(docs, items)
    hit = {g[0] for g in got}
    left = D.remove_contaminated(df, bench).collect()
    assert sorted(map(str, (r.doc_id for r in left))) == sorted(str(d) for d, _ in docs if d not in hit)


def test_empty_tables(spark):
    docs = spark.createDataFrame([(1, "a b c d e f")], "doc_id long, text string")
    bench = spark.createDataFrame([(1, "a b c d e f")], "item_id long, text string")
    assert D.contaminated(docs.limit(0), bench).count() == 0
    assert D.contaminated(docs, bench.limit(0)).count() == 0
    assert D.contaminated(docs, bench).count() == 1
    assert D.remove_contaminated(docs, bench.limit(0)).count() == 1


def test_main_path_has_no_python(spark):
    docs = spark.createDataFrame([(1, "a b c d e f")], "doc_id long, text string")
    bench = spark.createDataFrame([(1, "a b c d e f")], "item_id long, text string")
    plan = D.contaminated(docs, bench)._jdf.queryExecution().toString()
    assert not any(x in plan for x in ("Python", "Pandas", "Arrow", "Cartesian", "NestedLoop"))


def test_clean_documents_of_a_contaminated_key_stay(spark):
    item = "q r s t u v w"
    docs = [(None, f"x {item} y"), (None, "a clean text without an id"), (None, None), (7, item), (7, "a clean namesake"),
            (7, "a clean namesake"), (8, f"{item} z")]
    df = spark.createDataFrame([(*d, i) for i, d in enumerate(docs)], "doc_id long, text string, doc int")
    bench = spark.createDataFrame([(1, item)], "item_id long, text string")
    assert sorted(r["doc"] for r in D.remove_contaminated(df, bench).collect()) == [1, 2, 4, 5]
    assert D.contaminated(df, bench).columns == ["doc_id", "item_id", "n_shingles", "n_shared", "containment"]
