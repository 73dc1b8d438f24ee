"""The pipeline against brute force, stage by stage, on a small corpus."""
import random
from collections import Counter

import pytest

import corpus_pipeline as C
from tests.llm.test_decontamination import brute as brute_pairs
from tests.llm.test_mixing import targets
from tests.llm.test_sharding import ref_jump
from tests.llm.test_simhash import brute_components, brute_fp


@pytest.fixture(scope="module")
def sf(spark, tmp_path_factory):
    rng = random.Random(8)
    vocab = [f"word{i}" for i in range(60)]
    items = [(i, " ".join(rng.choice(vocab) for _ in range(20))) for i in range(6)]
    docs, labels = [], []
    for i in range(240):
        ws = [rng.choice(vocab) for _ in range(rng.randint(8, 90))]
        bad = i % 6 == 0
        if bad:
            ws = [w + "### %%%" for w in ws]
        elif i % 11 == 0:
            ws[4:4] = rng.choice(items)[1].split()
        docs.append((i, " ".join(ws), "en", f"s{i % 4}", 0))
        if i % 2 == 0:
            labels.append((i, 0 if bad else 1, 0))
    for i in range(30):  # copies
        d = docs[rng.randrange(240)]
        docs.append((300 + i, d[1].upper() if i % 2 else d[1], *d[2:]))
    docs += [(None, docs[1][1], None, None, None), (400, None, "en", "s1", 0), (1, docs[1][1], "en", "s1", 0)]
    path = str(tmp_path_factory.mktemp("sf"))
    spark.createDataFrame(docs, "doc_id long, text string, lang string, source string, n_chars long").write.parquet(f"{path}/documents.parquet")
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{path}/labels.parquet")
    spark.createDataFrame(items, "item_id long, text string").write.parquet(f"{path}/benchmark.parquet")
    return path, docs, items


def test_stages_and_run(spark, sf):
    path, docs, items = sf
    frame = spark.read.parquet(f"{path}/documents.parquet")
    kept = C.quality(spark, frame, path)
    rows = [tuple(r) for r in kept.collect()]
    assert kept.columns == C.COLUMNS
    # the classifier's own verdicts: junk goes, everything else stays
    assert Counter(rows) == Counter(d for d in docs if "###" not in (d[1] or ""))
    one = [tuple(r) for r in C.near_duplicates(spark, kept, path).collect()]
    comps = brute_components([brute_fp(r[1]) for r in rows], [r[0] for r in rows])
    best = {}
    for r, c in zip(rows, comps):
        best.setdefault(c, set()).add(r)
    assert len(one) == len(best) and Counter(r[0] for r in one) == Counter(best.keys())
    frame = spark.createDataFrame(one, kept.schema)
    clean = [tuple(r) for r in C.decontaminate(spark, frame, path).collect()]
    hit = {d for d, *_ in brute_pairs([(r[0], r[1]) for r in one], items)}
    assert Counter(clean) == Counter(r for r in one if r[0] not in hit)
    mixed = [tuple(r) for r in C.mix(spark, spark.createDataFrame(clean, kept.schema), path).collect()]
    n = {r[0]: len((r[1] or "").split()) for r in clean}
    size, got, copies = Counter(), Counter(), Counter(r[0] for r in mixed)
    for r in clean:
        size[r[3]] += n[r[0]]
        got[r[3]] += n[r[0]] * copies[r[0]]
    assert set(mixed) <= set(clean) and max(copies.values()) <= 3
    for s, t in targets(size).items():
        assert abs(got[s] - t) <= 0.1 * t + 3
    out = C.run(spark, path)
    final = out.collect()
    assert set(C.COLUMNS) < set(out.columns)
    assert Counter(tuple(r[c] for c in C.COLUMNS) for r in final) == Counter(mixed)
    for s in {r.shard for r in final}:
        assert sorted(r.slot for r in final if r.shard == s) == list(range(sum(r.shard == s for r in final)))
    assert all(r.shard == ref_jump(r.doc_id if r.doc_id is not None else -1, 8) for r in final)


def test_empty_documents(spark, sf, tmp_path):
    path, _, _ = sf
    for t in ("documents", "labels", "benchmark"):
        df = spark.read.parquet(f"{path}/{t}.parquet")
        (df.limit(0) if t == "documents" else df).coalesce(1).write.parquet(f"{tmp_path}/{t}.parquet")
    assert C.run(spark, str(tmp_path)).count() == 0
