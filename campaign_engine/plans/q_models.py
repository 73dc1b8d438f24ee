"""Registered queries: kNN classifier/regressor on the embeddings table,
scores, cross-validation and k tuning."""

from __future__ import annotations

import os
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators import evaluate as ev
from ..operators import knn
from ..operators import models as M
from ..operators.splits import cv_folds
from ..session import materialize, scratch_path
from ..sources.tables import read_table
from . import oracle_sql as O
from .registry import SEED, r, register

K = 5
FOLDS = 5
TUNE_KS = [1, 3, 5, 7, 9]


def emb_points(spark, sf):
    e = read_table(spark, sf, "embeddings")
    return e.select("vec_id", "label", F.transform("embedding", lambda x: x.cast("double")).alias("features"))


def emb_sets(spark, sf):
    """Queries (hash fold 0, a fifth of the rows) and references (the other folds)."""
    p = cv_folds(emb_points(spark, sf), ["vec_id"], FOLDS, SEED)
    return p.where("fold = 0").drop("fold"), p.where("fold <> 0").drop("fold")


_FOLD = f"{O.hex_long(O.md5_key('vec_id'), 8)} % {FOLDS}"
_NN_CTES = [
    f"eq AS (SELECT vec_id AS qid, label AS qlabel, CAST(embedding AS DOUBLE[]) AS e FROM embeddings WHERE {_FOLD} = 0)",
    f"er AS (SELECT vec_id AS rid, label, CAST(embedding AS DOUBLE[]) AS e FROM embeddings WHERE {_FOLD} <> 0)",
    "ed AS (SELECT qid, qlabel, rid, label, round(list_distance(eq.e, er.e), 9) AS dist FROM eq, er)",
    f"nn AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY qid ORDER BY dist, rid) AS rk FROM ed) WHERE rk <= {K})",
    "votes AS (SELECT qid, qlabel, label, count(*) AS c FROM nn GROUP BY qid, qlabel, label)",
    f"pred AS (SELECT qid, qlabel, label AS prediction, CAST(c AS DOUBLE) / {K} AS probability FROM "
    "(SELECT *, row_number() OVER (PARTITION BY qid ORDER BY c DESC, label) AS o FROM votes) WHERE o = 1)",
    "reg AS (SELECT qid, qlabel, avg(CAST(label AS DOUBLE)) AS prediction FROM nn GROUP BY qid, qlabel)",
]


def _classify(spark, sf):
    q, ref = emb_sets(spark, sf)
    pred = knn.knn_classify(q, ref, K, "vec_id", "vec_id", "label")
    return pred.join(q.select("vec_id", F.col("label").alias("true_label")), "vec_id")


def _regress(spark, sf):
    q, ref = emb_sets(spark, sf)
    pred = knn.knn_regress(q, ref, K, "vec_id", "vec_id", "label")
    return pred.join(q.select("vec_id", F.col("label").cast("double").alias("true_label")), "vec_id")


@register("knn_classify", O.with_base(
    "SELECT qid AS vec_id, CAST(prediction AS BIGINT) AS prediction, round(probability, 6) AS probability FROM pred",
    *_NN_CTES))
def q_knn_classify(spark, sf):
    return _classify(spark, sf).select("vec_id", F.col("prediction").cast("bigint").alias("prediction"),
                                       r("probability").alias("probability"))


@register("knn_regress", O.with_base(
    "SELECT qid AS vec_id, round(prediction, 6) AS prediction FROM reg", *_NN_CTES))
def q_knn_regress(spark, sf):
    return _regress(spark, sf).select("vec_id", r("prediction").alias("prediction"))


@register("knn_pruning", O.with_base(
    "SELECT (SELECT count(*) FROM eq) AS n_queries, (SELECT count(*) FROM er) AS n_refs, "
    "(SELECT count(*) FROM eq) * (SELECT count(*) FROM er) AS n_pairs, true AS few_exact", *_NN_CTES[:2]))
def q_knn_pruning(spark, sf):
    """Of all pairs, at most one in twenty needs its exact distance."""
    q, ref = emb_sets(spark, sf)
    p = knn.pruning(q, ref, K, "vec_id", "vec_id")
    return p.select("n_queries", "n_refs", "n_pairs", (20 * F.col("n_exact") <= F.col("n_pairs")).alias("few_exact"))


_CLS_SQL = [
    *_NN_CTES,
    "cls AS (SELECT c FROM (SELECT qlabel AS c FROM pred UNION SELECT prediction FROM pred))",
    "per AS (SELECT cls.c, (SELECT count(*) FROM pred WHERE qlabel = cls.c AND prediction = cls.c) AS tp, "
    "(SELECT count(*) FROM pred WHERE prediction = cls.c) AS pc, "
    "(SELECT count(*) FROM pred WHERE qlabel = cls.c) AS tc FROM cls)",
    "pr AS (SELECT CASE WHEN pc = 0 THEN 0.0 ELSE CAST(tp AS DOUBLE) / pc END AS p, "
    "CASE WHEN tc = 0 THEN 0.0 ELSE CAST(tp AS DOUBLE) / tc END AS rc FROM per)",
    "prf AS (SELECT p, rc, CASE WHEN p + rc = 0 THEN 0.0 ELSE 2 * p * rc / (p + rc) END AS f FROM pr)",
]


@register("classification_metrics", O.with_base(
    "SELECT 'accuracy' AS metric, round(avg(CASE WHEN qlabel = prediction THEN 1.0 ELSE 0.0 END), 6) AS value FROM pred "
    "UNION ALL SELECT 'precision', round(avg(p), 6) FROM prf "
    "UNION ALL SELECT 'recall', round(avg(rc), 6) FROM prf "
    "UNION ALL SELECT 'f1', round(avg(f), 6) FROM prf", *_CLS_SQL))
def q_classification_metrics(spark, sf):
    m = ev.classification_metrics(_classify(spark, sf), "true_label", "prediction")
    return m.select("metric", r("value").alias("value"))


@register("regression_metrics", O.with_base("""
SELECT 'mse' AS metric, round(avg((prediction - qlabel) * (prediction - qlabel)), 6) AS value FROM reg
UNION ALL SELECT 'rmse', round(sqrt(avg((prediction - qlabel) * (prediction - qlabel))), 6) FROM reg
UNION ALL SELECT 'neg_root_mean_squared_error', round(-sqrt(avg((prediction - qlabel) * (prediction - qlabel))), 6) FROM reg
UNION ALL SELECT 'mae', round(avg(abs(prediction - qlabel)), 6) FROM reg
UNION ALL SELECT 'r2', round(1 - sum((prediction - qlabel) * (prediction - qlabel)) / (var_pop(CAST(qlabel AS DOUBLE)) * count(*)), 6) FROM reg
UNION ALL SELECT 'max_error', round(max(abs(prediction - qlabel)), 6) FROM reg
UNION ALL SELECT 'median_absolute_error', round(median(abs(prediction - qlabel)), 6) FROM reg
UNION ALL SELECT 'mape', round(log10(avg(abs(prediction - qlabel) / greatest(abs(CAST(qlabel AS DOUBLE)), 2.220446049250313e-16))), 6) FROM reg""",
    *_NN_CTES))
def q_regression_metrics(spark, sf):
    m = ev.regression_metrics(_regress(spark, sf), "true_label", "prediction")
    # MAPE divides by max(|y|, eps): labels of 0 give about 1e15, hence its logarithm
    value = F.when(F.col("metric") == "mape", F.log10("value")).otherwise(F.col("value"))
    return m.select("metric", r(value).alias("value"))


def cv_accuracy(spark, sf, ks=(K,)):
    """Per fold and k: test accuracy (fold rows vs the other folds) and train
    accuracy (other-fold rows vs themselves, each row its own neighbour). One
    kNN join at max(ks) for both roles; smaller k reuse its ranks."""
    pts = cv_folds(emb_points(spark, sf), ["vec_id"], FOLDS, SEED)
    qs = knn.fold_sets(pts, "fold", FOLDS, "both")
    nn = materialize(knn.fold_neighbours(pts, max(ks), "vec_id", "fold", FOLDS, ["label"]), "cv-neighbours")
    role = F.when(F.col("fold") == F.col("_set"), "test").otherwise("train").alias("split")
    truth = qs.select("_set", "vec_id", role, F.col("label").alias("true_label"))
    out = None
    for k in ks:
        pred = knn.vote(nn.where(F.col("nn_rank") <= k), ["_set", "vec_id"], "label", k)
        acc = (pred.join(truth, ["_set", "vec_id"])
               .groupBy(F.col("_set").alias("fold"), "split")
               .agg(F.avg((F.col("prediction") == F.col("true_label")).cast("double")).alias("value"))
               .select(F.col("fold").cast("bigint").alias("fold"), "split",
                       F.lit("accuracy").alias("metric"), F.lit(k).cast("bigint").alias("k"), "value"))
        out = acc if out is None else out.unionByName(acc)
    return out


def _cv_sql_ctes(ks):
    kmax = max(ks)
    fold = f"{O.hex_long(O.md5_key('vec_id'), 8)} % {FOLDS}"
    return [
        f"pts AS (SELECT vec_id, label, CAST(embedding AS DOUBLE[]) AS e, {fold} AS fold FROM embeddings)",
        "sets AS (SELECT unnest(range(0, " + str(FOLDS) + ")) AS s)",
        # test role: query in fold s, refs outside s; train role: both outside s
        "qs AS (SELECT 'test' AS split, s, p.* FROM pts p JOIN sets ON p.fold = s "
        "UNION ALL SELECT 'train', s, p.* FROM pts p JOIN sets ON p.fold <> s)",
        "rs AS (SELECT s, p.* FROM pts p JOIN sets ON p.fold <> s)",
        "cd AS (SELECT qs.split, qs.s, qs.vec_id AS qid, qs.label AS qlabel, rs.vec_id AS rid, rs.label, "
        "round(list_distance(qs.e, rs.e), 9) AS dist FROM qs JOIN rs ON qs.s = rs.s)",
        f"cnn AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY split, s, qid ORDER BY dist, rid) AS rk "
        f"FROM cd) WHERE rk <= {kmax})",
        "ks AS (SELECT unnest([" + ", ".join(str(k) for k in ks) + "]) AS k)",
        "cv AS (SELECT split, s, qid, qlabel, k, label, count(*) AS c FROM cnn JOIN ks ON rk <= k "
        "GROUP BY split, s, qid, qlabel, k, label)",
        "cp AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY split, s, qid, k ORDER BY c DESC, label) AS o "
        "FROM cv) WHERE o = 1)",
        "acc AS (SELECT CAST(s AS BIGINT) AS fold, split, 'accuracy' AS metric, CAST(k AS BIGINT) AS k, "
        "avg(CASE WHEN label = qlabel THEN 1.0 ELSE 0.0 END) AS value FROM cp GROUP BY s, split, k)",
    ]


@register("cv_metrics", O.with_base(
    "SELECT fold, split, metric, round(value, 6) AS value FROM acc", *_cv_sql_ctes([K])))
def q_cv_metrics(spark, sf):
    return cv_accuracy(spark, sf).select("fold", "split", "metric", r("value").alias("value"))


@register("cv_metric_summary", O.with_base(
    "SELECT split, metric, round(avg(value), 6) AS mean, round(stddev_pop(value), 6) AS std FROM acc "
    "GROUP BY split, metric", *_cv_sql_ctes([K])))
def q_cv_metric_summary(spark, sf):
    s = ev.cv_summary(cv_accuracy(spark, sf))
    return s.select("split", "metric", r("mean").alias("mean"), r("std").alias("std"))


@register("tune_knn", O.with_base(
    "SELECT k, round(avg(value), 6) AS mean_test_accuracy FROM acc WHERE split = 'test' GROUP BY k",
    *_cv_sql_ctes(TUNE_KS)))
def q_tune_knn(spark, sf):
    cv = cv_accuracy(spark, sf, TUNE_KS).where(F.col("split") == "test")
    return cv.groupBy("k").agg(r(F.avg("value")).alias("mean_test_accuracy"))


# --------------------------------------------------------------------------- catalogue, persistence, runs

def _split_points(spark, sf):
    test, train = emb_sets(spark, sf)
    return train.withColumnRenamed("vec_id", "id"), test.withColumnRenamed("vec_id", "id")


@register("model_catalogue")
def q_model_catalogue(spark, sf):
    """Fit catalogue estimators by name on the embeddings table and score the
    held-out rows (accuracy for classifiers, RMSE for regressors)."""
    train, test = _split_points(spark, sf)
    out = []
    for name, metric, label in [("LogisticRegression", "accuracy", "label"),
                                ("RandomForestClassifier", "accuracy", "label"),
                                ("GradientBoostingClassifier", "accuracy", "high"),
                                ("LinearRegression", "rmse", "label"),
                                ("RandomForestRegressor", "rmse", "label"),
                                ("KNeighborsClassifier", "accuracy", "label"),
                                ("NearestCentroid", "accuracy", "label")]:
        tr = train.withColumn("high", (F.col("label") >= 5).cast("int"))
        te = test.withColumn("high", (F.col("label") >= 5).cast("int"))
        model = M.fit(name, tr, label, id_col="id")
        score = M.evaluate(model, te, label, metric)
        out.append((name, metric, score))
    return spark.createDataFrame(out, "model string, metric string, value double").select(
        "model", "metric", r("value").alias("value"))


_ROUNDTRIP = ["LogisticRegression", "KNeighborsClassifier", "RadiusNeighborsClassifier", "NearestCentroid"]


@register("model_roundtrip", " UNION ALL ".join(
    f"SELECT '{m}' AS model, count(*) AS n_rows, count(*) AS n_equal FROM embeddings WHERE {_FOLD} = 0" for m in _ROUNDTRIP))
def q_model_roundtrip(spark, sf):
    """Save and reload a model of every kind; predictions agree on every held-out row."""
    train, test = _split_points(spark, sf)
    rows = []
    for name in _ROUNDTRIP:
        m = M.fit(name, train, "label", id_col="id", params={"radius": RADIUS} if "Radius" in name else None)
        path = scratch_path(spark, f"model-{name}")
        M.save_model(m, path)
        back = M.load_model(spark, path)
        a = m.predict(test).select("id", F.col("prediction").alias("a"))
        b = back.predict(test).select("id", F.col("prediction").alias("b"))
        j = a.join(b, "id")
        rows.append(j.agg(F.lit(name).alias("model"), F.count(F.lit(1)).alias("n_rows"),
                          F.sum(F.col("a").eqNullSafe(F.col("b")).cast("long")).alias("n_equal")))
    return reduce(DataFrame.unionByName, rows)


def train_eval(spark, sf, root):
    """Full training run on the train rows: cross-validation over their folds, the
    first fold's estimator kept, its train and test scores, saved model, CV
    metrics and run record."""
    pts = cv_folds(emb_points(spark, sf).withColumnRenamed("vec_id", "id"), ["id"], FOLDS, SEED)
    train = pts.where("fold > 0").withColumn("fold", F.col("fold") - 1)
    test = pts.where("fold = 0").drop("fold")
    model, cv = M.train_cv("KNeighborsClassifier", train, "label", FOLDS - 1, params={"n_neighbors": K})
    cv = materialize(cv, "cv-metrics")
    tr = M.evaluate(model, train, "label", "accuracy_score")
    te = M.evaluate(model, test, "label", "accuracy_score")
    path = os.path.join(root, "models", "conversion_classifier")
    M.save_model(model, path)
    run_id = M.log_run(spark, root, "KNeighborsClassifier", {"n_neighbors": K, "cv": FOLDS - 1}, tr, te, path,
                       train.drop("fold").schema.simpleString())
    M.save_metrics(cv, root, run_id)
    return run_id, cv, tr, te


def _accuracy_cte(name: str, queries: str, refs: str) -> str:
    """CTE (s, split, value): accuracy of the kNN vote of ``queries`` (s, qid, qlabel, e,
    split) against ``refs`` (s, rid, label, e)."""
    return (f"{name} AS (SELECT s, split, avg(CASE WHEN label = qlabel THEN 1.0 ELSE 0.0 END) AS value FROM (SELECT *, "
            "row_number() OVER (PARTITION BY s, split, qid ORDER BY c DESC, label) AS o FROM (SELECT s, split, qid, qlabel, "
            "label, count(*) AS c FROM (SELECT *, row_number() OVER (PARTITION BY s, split, qid ORDER BY dist, rid) AS rk "
            "FROM (SELECT q.s, q.split, qid, qlabel, rid, label, round(list_distance(q.e, r.e), 9) AS dist "
            f"FROM {queries} q JOIN {refs} r ON q.s = r.s)) WHERE rk <= {K} GROUP BY ALL)) WHERE o = 1 GROUP BY s, split)")


_RUN_CTES = [
    f"tp AS (SELECT vec_id, label, CAST(embedding AS DOUBLE[]) AS e, {_FOLD} - 1 AS fold FROM embeddings)",
    f"ts AS (SELECT unnest(range(0, {FOLDS - 1})) AS s)",
    "tq AS (SELECT s, CASE WHEN fold = s THEN 'test' ELSE 'train' END AS split, vec_id AS qid, label AS qlabel, e "
    "FROM tp, ts WHERE fold >= 0)",
    "tr AS (SELECT s, vec_id AS rid, label, e FROM tp, ts WHERE fold >= 0 AND fold <> s)",
    _accuracy_cte("tacc", "tq", "tr"),
    "hq AS (SELECT 0 AS s, CASE WHEN fold < 0 THEN 'test' ELSE 'train' END AS split, vec_id AS qid, label AS qlabel, e FROM tp)",
    _accuracy_cte("hacc", "hq", "(SELECT * FROM tr WHERE s = 0)"),
]


@register("train_eval", O.with_base(
    "SELECT split || '_accuracy' AS metric, round(avg(value), 6) AS value FROM tacc GROUP BY split UNION ALL "
    "SELECT split || '_accuracy_score', round(value, 6) FROM hacc", *_RUN_CTES))
def q_train_eval(spark, sf):
    root = scratch_path(spark, "runs")
    run_id, _, tr, te = train_eval(spark, sf, root)
    saved = spark.read.parquet(os.path.join(root, "metrics")).where(F.col("run_id") == run_id)  # as K7 wrote it
    means = ev.cv_mean(saved, ["accuracy"]).select(F.concat_ws("_", "split", "metric").alias("metric"),
                                                   F.col("mean").alias("value"))
    scores = spark.createDataFrame([("train_accuracy_score", tr), ("test_accuracy_score", te)],
                                   "metric string, value double")
    return means.unionByName(scores).select("metric", r("value").alias("value"))


@register("run_log", O.with_base(
    "SELECT 'KNeighborsClassifier' AS model_type, round(max(value) FILTER (split = 'train'), 6) AS train_score, "
    f"round(max(value) FILTER (split = 'test'), 6) AS test_score, '{FOLDS - 1}' AS cv FROM hacc", *_RUN_CTES))
def q_run_log(spark, sf):
    root = scratch_path(spark, "runs")
    train_eval(spark, sf, root)
    return M.runs(spark, root).select("model_type", r("train_score").alias("train_score"),
                                      r("test_score").alias("test_score"),
                                      F.element_at("params", "cv").alias("cv"))


RADIUS = 7.0
_RADIUS_CTES = [
    *_NN_CTES[:3],
    f"rin AS (SELECT qid, label, count(*) AS c FROM ed WHERE dist <= {RADIUS} GROUP BY qid, label)",
]


@register("radius_classify", O.with_base(
    "SELECT qid AS vec_id, CAST(arg_min(label, (-c, label)) AS BIGINT) AS prediction FROM rin GROUP BY qid", *_RADIUS_CTES))
def q_radius_classify(spark, sf):
    q, ref = emb_sets(spark, sf)
    return knn.radius_classify(q, ref, RADIUS, "vec_id", "vec_id", "label").select(
        "vec_id", F.col("prediction").cast("bigint").alias("prediction"))


@register("radius_regress", O.with_base(
    "SELECT qid AS vec_id, round(CAST(sum(label * c) AS DOUBLE) / sum(c), 6) AS prediction FROM rin GROUP BY qid", *_RADIUS_CTES))
def q_radius_regress(spark, sf):
    q, ref = emb_sets(spark, sf)
    return knn.radius_regress(q, ref, RADIUS, "vec_id", "vec_id", "label").select("vec_id", r("prediction").alias("prediction"))


@register("nearest_centroid", O.with_base(
    "SELECT qid AS vec_id, CAST(arg_min(label, (floor(d * 1e9), label)) AS BIGINT) AS prediction FROM ("
    "SELECT qid, c.label, sum((q.x - c.m) * (q.x - c.m)) AS d FROM qx q JOIN cm c ON q.i = c.i GROUP BY qid, c.label) "
    "GROUP BY qid", *_NN_CTES[:2],
    "qx AS (SELECT qid, unnest(e) AS x, unnest(range(1, len(e) + 1)) AS i FROM eq)",
    "cm AS (SELECT label, i, avg(x) AS m FROM (SELECT label, unnest(e) AS x, unnest(range(1, len(e) + 1)) AS i FROM er) "
    "GROUP BY label, i)"))
def q_nearest_centroid(spark, sf):
    train, test = _split_points(spark, sf)
    m = M.fit("NearestCentroid", train, "label", id_col="id")
    return m.predict(test).select(F.col("id").alias("vec_id"), F.col("prediction").cast("bigint").alias("prediction"))


_LINEAR = [("LinearRegression", {}), ("Ridge", {"alpha": 0.0}), ("Lasso", {"alpha": 0.0}), ("ElasticNet", {"alpha": 0.0}),
           ("TweedieRegressor", {"power": 0.0})]


@register("linear_models", O.with_base(" UNION ALL ".join(
    f"SELECT '{name}' AS model, vec_id, round(a + b * x, 4) AS prediction FROM lq, lfit" for name, _ in _LINEAR),
    f"lr AS (SELECT CAST(label AS DOUBLE) AS y, CAST(embedding[1] AS DOUBLE) AS x FROM embeddings WHERE {_FOLD} <> 0)",
    f"lq AS (SELECT vec_id, CAST(embedding[1] AS DOUBLE) AS x FROM embeddings WHERE {_FOLD} = 0)",
    "lfit AS (SELECT regr_slope(y, x) AS b, regr_intercept(y, x) AS a FROM lr)"))
def q_linear_models(spark, sf):
    """The linear family without a penalty on one predictor: all give the least-squares line."""
    train, test = (df.withColumn("features", F.slice("features", 1, 1)) for df in _split_points(spark, sf))
    out = []
    for name, params in _LINEAR:
        m = M.fit(name, train, "label", id_col="id", params=params)
        out.append(m.predict(test).select(F.lit(name).alias("model"), F.col("id").alias("vec_id"),
                                          r("prediction", 4).alias("prediction")))
    return reduce(DataFrame.unionByName, out)


@register("boosting_classes", O.with_base(
    f"SELECT count(*) AS n_rows, true AS learns, true AS shares_ok FROM embeddings WHERE {_FOLD} = 0"))
def q_boosting_classes(spark, sf):
    """Boosting over the ten labels, one class against the rest: fits its train rows at least twice as well as
    chance (the labels do not follow from the vectors, so held-out rows cannot be told)."""
    train, test = _split_points(spark, sf)
    m = M.fit("GradientBoostingClassifier", train, "label", id_col="id", params={"maxIter": 3, "maxDepth": 3}, n_jobs=4)
    p = materialize(m.predict(test).select("label", "prediction", "probability"), "boosted")
    right = M.evaluate(m, train, "label", "accuracy")
    return p.agg(F.count(F.lit(1)).alias("n_rows"), F.lit(right >= 0.2).alias("learns"),
                 (F.min("probability").between(0, 1) & F.max("probability").between(0, 1)).alias("shares_ok"))


@register("train_cv_catalogue")
def q_train_cv_catalogue(spark, sf):
    """Cross-validated training of a catalogue model (first-fold estimator)."""
    pts = cv_folds(emb_points(spark, sf).withColumnRenamed("vec_id", "id"), ["id"], FOLDS, SEED)
    _, cv = M.train_cv("LogisticRegression", pts, "label", FOLDS, scoring=("accuracy", "f1"))
    return cv.select("fold", "split", "metric", r("value").alias("value"))


@register("tune_model")
def q_tune_model(spark, sf):
    """Seeded random hyper-parameter search with CrossValidator over hash folds."""
    pts = cv_folds(emb_points(spark, sf).withColumnRenamed("vec_id", "id"), ["id"], 3, SEED)
    _, res = M.random_search("RandomForestClassifier", pts, "label",
                             {"numTrees": [5, 10, 20], "maxDepth": [3, 5]}, n_iter=3, k_folds=3)
    return res.select("params", r("mean_metric").alias("mean_metric"))


_BIN_CTES = [
    f"bq AS (SELECT vec_id AS qid, CASE WHEN label >= 5 THEN 1 ELSE 0 END AS y, CAST(embedding AS DOUBLE[]) AS e "
    f"FROM embeddings WHERE {_FOLD} = 0)",
    f"br AS (SELECT vec_id AS rid, CASE WHEN label >= 5 THEN 1 ELSE 0 END AS y, CAST(embedding AS DOUBLE[]) AS e "
    f"FROM embeddings WHERE {_FOLD} <> 0)",
    "bd AS (SELECT qid, bq.y AS qy, rid, br.y, round(list_distance(bq.e, br.e), 9) AS dist FROM bq, br)",
    f"bnn AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY qid ORDER BY dist, rid) AS rk FROM bd) "
    f"WHERE rk <= {K})",
    f"bp AS (SELECT qid, qy, CAST(sum(y) AS DOUBLE) / {K} AS p, "
    f"CASE WHEN sum(y) > {K} - sum(y) THEN 1 ELSE 0 END AS pred FROM bnn GROUP BY qid, qy)",
    "bs AS (SELECT p, sum(qy) AS pos, count(*) - sum(qy) AS neg FROM bp GROUP BY p)",
    "brk AS (SELECT p, pos, neg, sum(pos + neg) OVER (ORDER BY p ROWS UNBOUNDED PRECEDING) - (pos + neg) AS before FROM bs)",
]


@register("binary_scores", O.with_base("""
SELECT 'balanced_accuracy' AS metric, round((avg(CASE WHEN pred = qy THEN 1.0 ELSE 0.0 END) FILTER (WHERE qy = 1)
  + avg(CASE WHEN pred = qy THEN 1.0 ELSE 0.0 END) FILTER (WHERE qy = 0)) / 2, 6) AS value FROM bp
UNION ALL SELECT 'log_loss', round(avg(-(qy * ln(least(greatest(p, 2.220446049250313e-16), 1 - 2.220446049250313e-16))
  + (1 - qy) * ln(1 - least(greatest(p, 2.220446049250313e-16), 1 - 2.220446049250313e-16)))), 6) FROM bp
UNION ALL SELECT 'roc_auc', round((sum(pos * (before + (pos + neg + 1) / 2.0)) - sum(pos) * (sum(pos) + 1) / 2.0)
  / (sum(pos) * sum(neg)), 6) FROM brk""", *_BIN_CTES))
def q_binary_scores(spark, sf):
    """kNN on the embeddings with the binary target label >= 5: balanced
    accuracy, log loss and exact ROC AUC of P(positive)."""
    q, ref = emb_sets(spark, sf)
    q = q.withColumn("y", (F.col("label") >= 5).cast("int"))
    ref = ref.withColumn("y", (F.col("label") >= 5).cast("int"))
    pred = knn.knn_classify(q, ref, K, "vec_id", "vec_id", "y", positive=1)
    scored = pred.join(q.select("vec_id", "y"), "vec_id")
    m = ev.binary_scores(scored, "y", "prediction", "probability")
    return m.select("metric", r("value").alias("value"))
