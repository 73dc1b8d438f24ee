"""Every public score name against values computed by hand."""
import math

import pytest

from campaign_engine.operators import evaluate as ev
from campaign_engine.operators import models as M

CLASSES = [(0, 0)] * 5 + [(0, 1)] * 2 + [(1, 1)] * 3 + [(1, 0)] * 1 + [(2, 2)] * 1 + [(2, 0)] * 3 + [(1, None)]
BINARY = [(1, 1, 0.9), (1, 1, 0.6), (1, 0, 0.4), (0, 0, 0.4), (0, 0, 0.1), (0, 1, 0.7), (0, 0, 0.0)]
ERRORS = [(1.0, 2.0), (2.0, 2.5), (4.0, 3.0), (0.5, 0.5)]


def per_class():
    out = {}
    for c in {y for y, _ in CLASSES} | {p for _, p in CLASSES if p is not None}:
        tp = sum(y == p == c for y, p in CLASSES)
        pc, tc = sum(p == c for _, p in CLASSES), sum(y == c for y, _ in CLASSES)
        pr, rc = tp / pc if pc else 0.0, tp / tc if tc else 0.0
        out[c] = (pr, rc, 2 * pr * rc / (pr + rc) if pr + rc else 0.0, tc, tp, pc)
    return out


def expected(positive):
    per, n = per_class(), len(CLASSES)
    tp, pc = sum(x[4] for x in per.values()), sum(x[5] for x in per.values())
    want = {"accuracy": tp / n, "precision_micro": tp / pc, "recall_micro": tp / n, "f1_micro": 2 * tp / (pc + n)}
    for i, m in enumerate(("precision", "recall", "f1")):
        want[f"{m}_macro"] = sum(x[i] for x in per.values()) / len(per)
        want[f"{m}_weighted"] = sum(x[i] * x[3] for x in per.values()) / n
        want[m] = want[f"{m}_macro"] if positive is None else per[positive][i]
    spread = math.sqrt(n * n - sum(x[5] ** 2 for x in per.values())) * math.sqrt(n * n - sum(x[3] ** 2 for x in per.values()))
    want["matthews_corrcoef"] = (tp * n - sum(x[5] * x[3] for x in per.values())) / spread
    want |= {f"{m}_score": want[m] for m in ("accuracy", "precision", "recall", "f1")}
    return want


@pytest.mark.parametrize("positive", [None, 1])
def test_class_scores(spark, positive):
    df = spark.createDataFrame(CLASSES, "y int, p int")
    want = expected(positive)
    got = {r.metric: r.value for r in ev.scores(df, "y", "p", list(want), positive).collect()}
    assert got == pytest.approx(want)
    for name in ("f1_macro", "f1"):
        assert ev.metric_by_name(df, "y", "p", name, positive).first()["value"] == pytest.approx(want[name])


def test_probability_scores(spark):
    loss = -sum(math.log(min(max(q if y else 1 - q, ev.EPS), 1 - ev.EPS)) for y, _, q in BINARY) / len(BINARY)
    pos, neg = [q for y, _, q in BINARY if y], [q for y, _, q in BINARY if not y]
    auc = sum((a > b) + (a == b) / 2 for a in pos for b in neg) / (len(pos) * len(neg))
    brier = sum((y - q) ** 2 for y, _, q in BINARY) / len(BINARY)
    want = {"log_loss": loss, "neg_log_loss": -loss, "roc_auc": auc, "roc_auc_score": auc, "balanced_accuracy": (2 / 3 + 3 / 4) / 2,
            "balanced_accuracy_score": (2 / 3 + 3 / 4) / 2, "brier_score_loss": brier, "neg_brier_score": -brier}
    df = spark.createDataFrame(BINARY, "y int, p int, probability double")
    for positive in (None, 1):
        got = {r.metric: r.value for r in ev.scores(df, "y", "p", list(want), positive).collect()}
        assert got == pytest.approx(want)


def test_error_scores(spark):
    e = [p - y for y, p in ERRORS]
    ys, n = [y for y, _ in ERRORS], len(ERRORS)
    mse, var = sum(x * x for x in e) / n, lambda xs: sum((x - sum(xs) / n) ** 2 for x in xs) / n
    msle = sum((math.log1p(p) - math.log1p(y)) ** 2 for y, p in ERRORS) / n
    base = {"mse": mse, "rmse": math.sqrt(mse), "mae": sum(map(abs, e)) / n, "max_error": 1.0,
            "median_absolute_error": 0.75, "mape": sum(abs(x) / y for x, y in zip(e, ys)) / n,
            "mean_squared_log_error": msle, "root_mean_squared_log_error": math.sqrt(msle)}
    long = {"mse": "mean_squared_error", "rmse": "root_mean_squared_error", "mae": "mean_absolute_error",
            "mape": "mean_absolute_percentage_error"}
    want = dict(base) | {long[k]: base[k] for k in long}
    want |= {f"neg_{k}": -v for k, v in want.items()}
    want |= {"r2": 1 - mse / var(ys), "r2_score": 1 - mse / var(ys), "explained_variance": 1 - var(e) / var(ys)}
    df = spark.createDataFrame(ERRORS, "y double, p double")
    got = {r.metric: r.value for r in ev.scores(df, "y", "p", list(want)).collect()}
    assert got == pytest.approx(want)
    negative = spark.createDataFrame([(1.0, -2.0)], "y double, p double")
    assert ev.metric_by_name(negative, "y", "p", "mean_squared_log_error").first()["value"] is None


def test_names_and_directions():
    for bad in ("nope", "neg_accuracy", "neg_neg_mse", "f1_binary"):
        with pytest.raises(ValueError):
            ev.meaning(bad)
    assert ev.larger_is_better("neg_mean_squared_error") and not ev.larger_is_better("mean_squared_error")
    assert ev.larger_is_better("f1_macro") and not ev.larger_is_better("log_loss")


@pytest.fixture(scope="module")
def points(spark):
    rows = [(i, [float(i % 7), float(i % 11)], (i % 7 > 2) + (i % 11 > 7), i % 3) for i in range(120)]
    return spark.createDataFrame(rows, "id long, features array<double>, label int, fold int").cache()


def test_one_meaning_of_a_score_in_a_search(spark, points):
    df = points.withColumn("label", (points.label > 0).cast("int"))
    for name, space in (("LogisticRegression", {"regParam": [0.1]}), ("KNeighborsClassifier", {"n_neighbors": [3]})):
        _, res = M.random_search(name, df, "label", space, n_iter=1, scoring="precision", positive=1)
        params = {k: v[0] for k, v in space.items()}
        _, cv = M.train_cv(name, df, "label", 3, scoring=["precision"], params=params, positive=1)
        mean = cv.where("split = 'test'").groupBy().avg("value").first()[0]
        assert res.first()["mean_metric"] == pytest.approx(mean)


def test_folds_run_side_by_side(spark, points, monkeypatch):
    import time
    spans, fit = [], M.fit

    def slow(*a, **kw):
        t = time.time()
        time.sleep(0.3)
        out = fit(*a, **kw)
        spans.append((t, time.time()))
        return out

    monkeypatch.setattr(M, "fit", slow)
    df = points.withColumn("label", (points.label > 0).cast("int"))
    M.train_cv("LogisticRegression", df, "label", 3, n_jobs=3)
    assert max(s for s, _ in spans) < min(e for _, e in spans)
    a = M.train_cv("LogisticRegression", df, "label", 3, n_jobs=1)[1].collect()
    assert sorted(a) == sorted(M.train_cv("LogisticRegression", df, "label", 3, n_jobs=3)[1].collect())


def test_boosting_for_three_classes(spark, points, tmp_path):
    m = M.fit("GradientBoostingClassifier", points, "label", params={"maxIter": 5}, positive=2, n_jobs=2)
    out = m.predict(points).select("id", "label", "prediction", "probability")
    rows = out.collect()
    assert sum(r.label == r.prediction for r in rows) > 100 and all(0 <= r.probability <= 1 for r in rows)
    assert min(r.probability for r in rows if r.label == 2) > max(r.probability for r in rows if r.label == 0 and r.prediction == 0)
    M.save_model(m, str(tmp_path / "m"))
    back = M.load_model(spark, str(tmp_path / "m"))
    assert sorted(back.predict(points).select("id", "label", "prediction", "probability").collect()) == sorted(rows)


def test_probability_of_the_named_class(spark, points):
    for c in (0, 1, 2):
        m = M.fit("RandomForestClassifier", points, "label", params={"numTrees": 5}, positive=c)
        rows = m.predict(points).collect()
        assert sum(r.probability for r in rows if r.label == c) / sum(r.label == c for r in rows) > 0.6


def test_nearest_neighbours_by_name(spark, points, tmp_path):
    m = M.fit("NearestNeighbors", points, "label", params={"n_neighbors": 3})
    M.save_model(m, str(tmp_path / "nn"))
    rows = M.load_model(spark, str(tmp_path / "nn")).kneighbors(points).collect()
    assert len(rows) == 360 and all(r.dist == 0 for r in rows if r.nn_rank == 1)
