"""Blocked kNN join against brute force (ties broken by id)."""
import numpy as np
from pyspark.sql import functions as F

from campaign_engine.operators import knn


def _brute(Q, qid, R, rid, k):
    out = {}
    for i, q in enumerate(Q):
        d = np.floor(np.sqrt(((R - q) ** 2).sum(1)) * 1e9 + 0.5) / 1e9
        order = sorted(range(len(R)), key=lambda j: (d[j], rid[j]))[:k]
        out[qid[i]] = [rid[j] for j in order]
    return out


def test_knn_join_matches_brute_force_with_ties(spark):
    rng = np.random.default_rng(3)
    R = rng.integers(0, 3, size=(300, 4)).astype(float)      # many exact ties
    Q = rng.integers(0, 3, size=(40, 4)).astype(float)
    refs = spark.createDataFrame([(int(i), R[i].tolist(), int(i % 2)) for i in range(len(R))],
                                 "rid long, features array<double>, y int")
    qs = spark.createDataFrame([(int(1000 + i), Q[i].tolist()) for i in range(len(Q))],
                               "qid long, features array<double>")
    nn = knn.knn_join(qs, refs, 5, "qid", "rid", block_rows=64)   # forces several blocks
    got = {}
    for r in nn.orderBy("qid", "nn_rank").collect():
        got.setdefault(r["qid"], []).append(r["rid"])
    want = _brute(Q, [1000 + i for i in range(len(Q))], R, list(range(len(R))), 5)
    assert got == want


def test_knn_classify_and_regress(spark):
    refs = spark.createDataFrame([(1, [0.0], 1), (2, [0.1], 1), (3, [5.0], 0)], "rid long, features array<double>, y int")
    qs = spark.createDataFrame([(10, [0.05])], "qid long, features array<double>")
    c = knn.knn_classify(qs, refs, 3, "qid", "rid", "y", positive=1).first()
    assert c["prediction"] == 1 and abs(c["probability"] - 2 / 3) < 1e-12
    r = knn.knn_regress(qs, refs, 2, "qid", "rid", "y").first()
    assert r["prediction"] == 1.0


def test_nearest_centroid(spark):
    from campaign_engine.operators import models
    df = spark.createDataFrame([(1, [0.0, 0.0], 0), (2, [0.0, 2.0], 0), (3, [10.0, 10.0], 1), (4, [12.0, 10.0], 1)],
                               "id long, features array<double>, label int")
    m = models.fit("NearestCentroid", df, "label")
    assert m.centroids == [(0, [0.0, 1.0]), (1, [11.0, 10.0])]
    q = spark.createDataFrame([(9, [1.0, 1.0]), (8, [9.0, 9.0])], "id long, features array<double>")
    got = {r["id"]: r["prediction"] for r in m.predict(q).collect()}
    assert got == {9: 0, 8: 1}


def test_radius_neighbours_against_brute_force(spark):
    rng = np.random.default_rng(11)
    R = rng.normal(size=(150, 3)); Q = rng.normal(size=(30, 3)); y = rng.integers(0, 3, 150)
    refs = spark.createDataFrame([(int(i), R[i].tolist(), int(y[i])) for i in range(150)],
                                 "rid long, features array<double>, y int")
    qs = spark.createDataFrame([(int(500 + i), Q[i].tolist()) for i in range(30)], "qid long, features array<double>")
    reg = {r["qid"]: r["prediction"] for r in knn.radius_regress(qs, refs, 1.0, "qid", "rid", "y", block_rows=40).collect()}
    cls = {r["qid"]: r["prediction"] for r in knn.radius_classify(qs, refs, 1.0, "qid", "rid", "y", block_rows=40).collect()}
    for i in range(30):
        d = np.sqrt(((R - Q[i]) ** 2).sum(1))
        inside = y[d <= 1.0]
        if len(inside) == 0:
            assert 500 + i not in reg
            continue
        assert abs(reg[500 + i] - inside.mean()) < 1e-12
        counts = np.bincount(inside, minlength=3)
        assert cls[500 + i] == int(np.argmax(counts))


def test_partitions_of_unlike_types_meet(spark):
    from pyspark.sql import functions as F

    rng = np.random.default_rng(5)
    X = rng.normal(size=(200, 3))
    df = spark.createDataFrame([(int(i), X[i].tolist(), int(i % 5)) for i in range(200)], "id long, features array<double>, s long")
    nn = knn.knn_join(df, df.withColumn("s", F.col("s").cast("int")), 3, "id", "id", partition="s", block_rows=16)
    got = {}
    for r in nn.orderBy("id", "nn_rank").collect():
        got.setdefault(r["id"], []).append(r["nn_id"])
    for s in range(5):
        ids = list(range(s, 200, 5))
        want = _brute(X[ids], ids, X[ids], ids, 3)
        assert {i: got[i] for i in ids} == want


def _frame(spark, X, first, id_name, **cols):
    names = list(cols)
    rows = [(first + i, x.tolist(), *(cols[c][i] for c in names)) for i, x in enumerate(X)]
    return spark.createDataFrame(rows, f"{id_name} long, features array<double>" + "".join(f", {c} long" for c in names))


def test_few_exact_distances_at_64_dimensions(spark):
    rng = np.random.default_rng(1)
    R, Q = (X / np.linalg.norm(X, axis=1, keepdims=True) for X in (rng.normal(size=(3000, 64)), rng.normal(size=(200, 64))))
    refs, qs = _frame(spark, R, 0, "rid"), _frame(spark, Q, 10000, "qid")
    got = {}
    for r in knn.knn_join(qs, refs, 5, "qid", "rid", block_rows=700).orderBy("qid", "nn_rank").collect():
        got.setdefault(r["qid"], []).append(r["rid"])
    assert got == _brute(Q, [10000 + i for i in range(200)], R, list(range(3000)), 5)
    p = knn.pruning(qs, refs, 5, "qid", "rid", block_rows=700).first()
    assert (p.n_queries, p.n_refs, p.n_pairs) == (200, 3000, 600000) and 200 * 5 <= p.n_exact <= 0.05 * p.n_pairs


def test_outliers_beyond_the_grid_and_odd_values(spark, monkeypatch):
    monkeypatch.setattr(knn, "SAMPLE", 16)  # the grid knows a few vectors only: most others are clipped
    rng = np.random.default_rng(2)
    R = rng.normal(size=(400, 6)) * np.array([1, 1e-9, 1e6, 0, 1, 1]) + (rng.random((400, 1)) < 0.05) * 1e4
    Q = np.vstack([R[:30], rng.normal(size=(30, 6)) * 1e3])
    Q[3, 0] = -0.0
    R[7] = Q[3] + 0.0
    refs, qs = _frame(spark, R, 0, "rid"), _frame(spark, Q, 1000, "qid")
    got = {}
    for r in knn.knn_join(qs, refs, 4, "qid", "rid", block_rows=50).orderBy("qid", "nn_rank").collect():
        got.setdefault(r["qid"], []).append(r["rid"])
    assert got == _brute(Q, [1000 + i for i in range(60)], R, list(range(400)), 4)


def test_equal_vectors_and_few_references(spark):
    refs = _frame(spark, np.ones((50, 3)), 0, "rid")
    qs = _frame(spark, np.vstack([np.ones((3, 3)), np.zeros((2, 3))]), 100, "qid")
    rows = knn.knn_join(qs, refs, 4, "qid", "rid", block_rows=8).collect()
    assert {r.qid: sorted(x.rid for x in rows if x.qid == r.qid) for r in rows} == {100 + i: [0, 1, 2, 3] for i in range(5)}
    assert knn.knn_join(qs, refs.limit(2), 4, "qid", "rid").count() == 10
    assert knn.knn_join(qs, refs.limit(0), 4, "qid", "rid").count() == 0
    assert knn.knn_join(qs.limit(0), refs, 4, "qid", "rid").count() == 0
    assert knn.radius_aggregate(qs, refs.withColumn("y", refs.rid % 2).limit(0), 1.0, "qid", "rid", "y").count() == 0


def test_radius_counts_sure_and_open_pairs(spark):
    rng = np.random.default_rng(4)
    R, Q = rng.integers(0, 4, size=(500, 5)).astype(float), rng.integers(0, 4, size=(40, 5)).astype(float)
    refs = _frame(spark, R, 0, "rid", y=[int(i % 3) for i in range(500)])
    qs = _frame(spark, Q, 1000, "qid")
    got = {(r.qid, r.y): r.n for r in knn.radius_aggregate(qs, refs, 2.0, "qid", "rid", "y", block_rows=64).collect()}
    want = {}
    for i, q in enumerate(Q):
        for j, x in enumerate(R):
            if np.sqrt(((q - x) ** 2).sum()) <= 2.0:  # many pairs lie exactly on the edge
                want[1000 + i, j % 3] = want.get((1000 + i, j % 3), 0) + 1
    assert got == want


def test_cells_pass_over_far_blocks(spark, monkeypatch):
    rng = np.random.default_rng(6)
    R = np.column_stack([rng.uniform(0, 1000, 4000), rng.integers(0, 5, 4000), rng.normal(size=4000)])
    Q = np.vstack([R[:50] + 0.1, [[5000, 0, 0], [-5000, 9, 9], [500, 2, 0]]])
    refs, qs = _frame(spark, R, 0, "rid", y=[int(i % 3) for i in range(4000)]), _frame(spark, Q, 10000, "qid")
    asked = []
    visits = knn._visits
    monkeypatch.setattr(knn, "_visits", lambda *a, **kw: asked.append(visits(*a, **kw)) or asked[-1])
    got = {}
    for r in knn.knn_join(qs, refs, 5, "qid", "rid", block_rows=200).orderBy("qid", "nn_rank").collect():
        got.setdefault(r["qid"], []).append(r["rid"])
    assert got == _brute(Q, [10000 + i for i in range(53)], R, list(range(4000)), 5)
    assert asked[0].count() <= 2 * 53  # of 20 cells each, besides the own one
    agg = {(r.qid, r.y): r.n for r in knn.radius_aggregate(qs, refs, 3.0, "qid", "rid", "y", block_rows=200).collect()}
    want = {}
    for i, q in enumerate(Q):
        for j in np.flatnonzero(np.sqrt(((R - q) ** 2).sum(1)) <= 3.0):
            want[10000 + i, int(j % 3)] = want.get((10000 + i, int(j % 3)), 0) + 1
    assert agg == want and asked[1].count() <= 3 * 53


def test_cells_tile_the_space():
    rng = np.random.default_rng(8)
    for x in (rng.normal(size=(500, 4)), rng.integers(0, 2, size=(300, 3)).astype(float), np.ones((40, 2))):
        c = knn._Cells(x, 16)
        home = c.home(x)
        assert 1 <= len(c.lo) <= 16 and set(home) == set(range(len(c.lo)))
        y = rng.normal(size=(100, x.shape[1])) * 3
        near = c.near(y, np.zeros(100))
        assert all(near[i, h] for i, h in enumerate(c.home(y)))
        d = np.sqrt(((y[:, None] - x[None]) ** 2).sum(2))
        inside = c.near(y, d.min(1))
        assert all(inside[i, home[j]] for i, j in enumerate(d.argmin(1)))


def test_a_block_multiplies_near_leaves_only(monkeypatch):
    rng = np.random.default_rng(12)
    flat = np.column_stack([rng.uniform(0, 1000, 3000), rng.integers(0, 40, 3000) * 25.0, np.zeros((3000, 5))])
    for R, share in ((flat, 0.2), (rng.normal(size=(3000, 40)), 1.6)):  # few wide dimensions; many equal ones
        Q, done, bounds = R[:500] + 0.3, [], knn._bounds
        monkeypatch.setattr(knn, "_bounds", lambda q, r, eq, er: done.append(len(q) * len(r)) or bounds(q, r, eq, er))
        zeros = np.full(500, 1e-9), np.full(3000, 1e-9)
        qi, ri, low, up = knn._near_pairs(Q, R, *zeros, 5, np.full(500, np.inf))
        monkeypatch.undo()
        assert sum(done) <= share * 500 * 3000
        best = np.argsort(np.sqrt(((Q[:, None] - R[None]) ** 2).sum(2)), axis=1, kind="stable")[:, :5]
        got = set(zip(qi.tolist(), ri.tolist()))
        assert all((i, int(j)) in got for i in range(500) for j in best[i]) and len(got) <= 6 * 500 and (low <= up).all()


def test_blocks_grow_with_the_references(spark):
    rng = np.random.default_rng(13)
    refs, qs = (_frame(spark, rng.normal(size=(n, 8)), 0, name).withColumn("_f", F.col("features")).withColumn("_k", F.col(name))
                for n, name in ((2400, "rid"), (20, "qid")))
    *_, rows = knn._prepared(qs.select("_k", "_f"), refs.select("_k", "_f"), [], 20, "test")
    assert rows == 100
    *_, rows = knn._prepared(qs.select("_k", "_f"), refs.select("_k", "_f"), [], 200, "test")
    assert rows == 200


def test_fold_neighbours_equal_a_join_per_set(spark):
    rng = np.random.default_rng(14)
    X = rng.integers(0, 5, size=(160, 3)).astype(float)
    rows = [(i // 2 if i < 20 else i, None if i % 41 == 40 else i % 6, x.tolist(), i % 3) for i, x in enumerate(X)]
    rows += rows[30:40] + [(None, 1, [1.0, 2.0, 3.0], 1)]  # repeated rows, shared ids, an id or a fold missing, folds beyond the four
    df = spark.createDataFrame(rows, "id long, fold long, features array<double>, y long")
    one = knn.fold_neighbours(df, 4, "id", "fold", 4, ["y"])
    many = knn.knn_join(*(knn.fold_sets(df, "fold", 4, role) for role in ("both", "train")), 4, "id", "id", "features", ["y"], partition="_set")
    assert one.columns == many.columns and one.dtypes == many.dtypes
    key = lambda r: tuple((x is None, x or 0) for x in r)
    plain = lambda d: sorted(map(tuple, d.collect()), key=key)
    cols = [c for c in one.columns if c != "y"]  # rows of one id may be taken in either order
    assert plain(one.select(*cols)) == plain(many.select(*cols))
    assert plain(one.where("id > 40 AND nn_id > 40")) == plain(many.where("id > 40 AND nn_id > 40"))


def test_leaves_hand_on_few_pairs(monkeypatch):
    rng, n = np.random.default_rng(15), 12000
    R = np.column_stack([rng.choice([0, 800, 1500, 2100], n), rng.integers(0, 25, n) * 500.0, rng.integers(0, 25, n) * 60.0,
                         rng.integers(1, 60, n), rng.exponential(1500, n)])
    Q, seen, last = R[::6] + 0.1, [], knn._within_kth
    monkeypatch.setattr(knn, "_within_kth", lambda found, k, kth: seen.append(sum(len(f[0]) for f in found)) or last(found, k, kth))
    qi, ri, _, _ = knn._near_pairs(Q, R, np.full(2000, 1e-9), np.full(n, 1e-9), 5, np.full(2000, np.inf))
    assert seen[0] <= 20 * len(Q)  # each leaf is held to the nearest found so far
    got = set(zip(qi.tolist(), ri.tolist()))
    best = np.argsort(np.sqrt(((Q[:, None] - R[None]) ** 2).sum(2)), axis=1, kind="stable")[:, :5]
    assert len(got) == len(qi) and all((i, int(j)) in got for i in range(len(Q)) for j in best[i])


def test_exact_distance_adds_in_order(spark):
    rng = np.random.default_rng(16)
    rows = [((rng.normal(size=69) * 10.0 ** (i % 6)).tolist(), (rng.normal(size=69) * 10.0 ** (i % 5)).tolist()) for i in range(200)]
    df = spark.createDataFrame([*rows, (None, rows[0][0])], "a array<double>, b array<double>").where("a IS NOT NULL")
    plain = F.expr("floor(sqrt(aggregate(zip_with(a, b, (x, y) -> (x - y) * (x - y)), 0D, (s, v) -> s + v)) * 1e9D + 0.5D) / 1e9D")
    assert df.where(knn._exact("a", "b") != plain).count() == 0 and df.count() == 200


def test_cells_are_searched_by_whole_vectors(spark, monkeypatch):
    rng = np.random.default_rng(17)
    R = np.column_stack([rng.uniform(0, 1000, 3000), rng.integers(0, 5, 3000) * 100.0, rng.integers(0, 2, (3000, 6))])
    R[500:1700] = R[3]  # a vector of more rows than a cell
    Q = np.vstack([R[::40] + 0.25, R[500:800], R[2000:2010]])
    refs, qs = _frame(spark, R, 0, "rid", y=[int(i % 3) for i in range(3000)]), _frame(spark, Q, 10000, "qid")
    monkeypatch.setattr(knn, "_exact", None)  # pairs do not leave their task with their vectors
    searched, same = knn._searched, []
    monkeypatch.setattr(knn, "_searched", lambda *a: same.append(a[-2].home(R)) or searched(*a))
    nn = knn.knn_join(qs, refs, 5, "qid", "rid", ref_cols=["y"], block_rows=100)
    assert nn.columns == ["qid", "rid", "dist", "y", "nn_rank"] and dict(nn.dtypes)["nn_rank"] == "int"
    rows, got = nn.orderBy("qid", "nn_rank").collect(), {}
    for r in rows:
        got.setdefault(r["qid"], []).append(r["rid"])
    assert got == _brute(Q, [10000 + i for i in range(len(Q))], R, list(range(3000)), 5)
    assert all(r.y == r.rid % 3 for r in rows) and [r.nn_rank for r in rows[:5]] == [1, 2, 3, 4, 5]
    assert len(same) == 1 and len(set(same[0])) > 4


def test_cells_of_partitions_rows_against_themselves_and_missing_ids(spark):
    rng = np.random.default_rng(18)
    X = np.column_stack([rng.uniform(0, 1000, 1200), rng.integers(0, 4, 1200) * 50.0])
    df = spark.createDataFrame([(None if i == 7 else f"c{i:04d}", x.tolist(), i % 2) for i, x in enumerate(X)],
                               "id string, features array<double>, s long")
    assert knn._near_only(knn._asked(df, df, "id", "id", "features", [], ["s"])[1], 3, ["s"], 60)
    got = {}
    for r in knn.knn_join(df, df, 3, "id", "id", partition="s", block_rows=60).orderBy("id", "nn_rank").collect():
        got.setdefault(r["id"], []).append(r["nn_id"])
    ids = ["" if i == 7 else f"c{i:04d}" for i in range(1200)]  # a missing id comes first
    for s in (0, 1):
        for i, near in _brute(X[s::2], ids[s::2], X[s::2], ids[s::2], 3).items():
            assert [x or "" for x in got[i or None]] == near
