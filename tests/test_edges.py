"""Edge inputs: null labels and strata, repeated keys, reordered headers, typed
CSV datasets, null predictions, saved models, training flags."""
import numpy as np
import pytest
from pyspark.sql import functions as F

from campaign_engine.operators import embed, evaluate, features, models, scoring, splits
from campaign_engine.plans import jobs
from campaign_engine.session import scratch_path
from campaign_engine.sources import datasets as ds


def test_null_labels_keep_their_rows(spark):
    df = spark.createDataFrame([(i, None if i % 2 else 1) for i in range(100)], "id long, y int")
    folds = splits.cv_folds_stratified(df, ["id"], "y", 5)
    assert folds.count() == 100
    assert {(r["y"], r["fold"]): r["count"] for r in folds.groupBy("y", "fold").count().collect()} == {
        (y, f): 10 for y in (None, 1) for f in range(5)}
    t = splits.split_shuffled(df, ["id"], 0.2, stratify="y").where("split_type = 'test'")
    assert {r["y"]: r["count"] for r in t.groupBy("y").count().collect()} == {None: 10, 1: 10}


def test_repeated_and_null_keys(spark):
    same = spark.createDataFrame([("k", i) for i in range(100)], "key string, v int")
    with pytest.raises(ValueError):
        splits.split_shuffled(same, ["key"], 0.2)
    two = spark.createDataFrame([("a" if i < 50 else "b", i) for i in range(100)] + [(None, 1000)], "key string, v int")
    t = splits.split_ordered(two, ["key"], 0.2)
    assert t.where("split_type = 'test'").count() == 21
    assert t.where("key IS NULL AND split_type = 'test'").count() == 0
    equal = spark.createDataFrame([("k",)] * 10, "key string")
    assert splits.split_ordered(equal, ["key"], 0.2).where("split_type = 'test'").count() == 2


def test_csv_binds_by_header(spark):
    path = scratch_path(spark, "csv-order")
    spark.createDataFrame([("LinkedIn", "c1", "2.0", "1.5")], "publisher string, campaign_id string, clicks string, cost string") \
        .select("publisher", "clicks", "campaign_id", "cost", *[F.lit("x").alias(c) for c in (
            "category_id", "market_id", "customer_id", "industry")], F.lit(None).cast("string").alias("converions")) \
        .write.option("header", True).csv(path)
    r = ds.scan_csv(spark, path).first()
    assert (r["campaign_id"], r["publisher"], r["clicks"], r["cost"], r["converions"]) == ("c1", "LinkedIn", 2, 1.5, None)
    bad = scratch_path(spark, "csv-absent")
    spark.createDataFrame([("a",)], "campaign_id string").write.option("header", True).csv(bad)
    with pytest.raises(ValueError):
        ds.scan_csv(spark, bad)


def test_csv_datasets_keep_their_types_and_list(spark):
    root = scratch_path(spark, "csv-ds")
    df = spark.createDataFrame([(1, 2.5, "x")], "a long, b double, c string")
    uid = ds.write_dataset(df, root, fmt="csv", split_col=None)
    assert ds.read_dataset(spark, root, uid, "all").dtypes == df.dtypes
    assert ds.list_datasets(spark, root).where("n_rows = 1 AND split_type = 'all'").count() >= 1


def test_names_and_metadata(spark):
    got = spark.createDataFrame([("ad spend, it's,['x y']",)], "t string").select(ds.parse_and_flatten(F.col("t")).alias("p"))
    assert got.first()["p"] == ["ad spend", "it's", "x y"]
    m = F.create_map(F.lit("x-amz-meta-a"), F.lit("1"), F.lit("a"), F.lit("2"), F.lit("b"), F.lit("3"))
    assert spark.range(1).select(ds.clean_metadata(m).alias("m")).first()["m"] == {"a": "2", "b": "3"}
    df = spark.createDataFrame([([1.0, 2.0, 3.0],)], "features array<double>")
    names = ["market_id_encoded", "emb_0", "emb_1"]
    with pytest.raises(ValueError):
        features.select_by_name(df, ["market"], names)
    assert features.select_by_name(df, ["emb"], names).first()["features"] == [2.0, 3.0]


def test_scores_with_missing_predictions(spark):
    df = spark.createDataFrame([(1, 1), (1, None), (0, None), (1, None)], "y int, p int")
    got = {r["metric"]: r["value"] for r in evaluate.classification_metrics(df, "y", "p", positive=1).collect()}
    assert got["accuracy"] == 0.25 and got["precision"] == 1.0 and got["recall"] == pytest.approx(1 / 3)
    reg = spark.createDataFrame([(1.0, 2.0), (3.0, None), (9.0, None)], "y double, p double")
    r2 = {r["metric"]: r["value"] for r in evaluate.regression_metrics(reg, "y", "p").collect()}["r2"]
    assert r2 == 0.0
    one = spark.createDataFrame([(1, 1, 0.9), (1, 1, 0.2)], "y int, p int, pr double")
    got = {r["metric"]: r["value"] for r in evaluate.binary_scores(one, "y", "p", "pr").collect()}
    assert got["roc_auc"] is None and got["balanced_accuracy"] is None
    named = evaluate.metric_by_name(df, "y", "p", "accuracy_score").first()
    assert (named["metric"], named["value"]) == ("accuracy_score", 0.25)


def test_missing_vectors_raise(spark):
    df = spark.createDataFrame([("a",), ("b",)], "t string")
    table = spark.createDataFrame([("a", [1.0])], "value string, embedding array<double>")
    with pytest.raises(ValueError):
        embed.embed_distinct(df, "t", table)
    assert embed.embed_distinct(df, "t", table, strict=False).where("t_embedding IS NULL").count() == 1


def test_models_round_trip(spark):
    rng = np.random.default_rng(1)
    df = spark.createDataFrame([(i, rng.normal(size=3).tolist(), int(i % 3)) for i in range(60)],
                               "id long, features array<double>, y int")
    made = [models.fit(n, df, "y", params={"radius": 1.5} if "Radius" in n else None) for n in
            ("RadiusNeighborsClassifier", "RadiusNeighborsRegressor", "NearestCentroid", "KNeighborsRegressor")]
    made.append(models.PythonModel(lambda x: x.sum(1)))
    for i, m in enumerate(made):
        path = scratch_path(spark, f"m{i}")
        models.save_model(m, path)
        a = {r["id"]: r["prediction"] for r in m.predict(df).collect()}
        b = {r["id"]: r["prediction"] for r in models.load_model(spark, path).predict(df).collect()}
        assert a == b and len(a) == 60
    model, cv = models.train_cv("KNeighborsClassifier", df.withColumn("fold", F.col("id") % 2), "y", 1)
    assert cv.count() == 0 and model.predict(df).count() == 60
    best, res = models.random_search("KNeighborsClassifier", df.withColumn("fold", F.col("id") % 3), "y",
                                     {"n_neighbors": [1, 3, 5]}, n_iter=3, scoring="f1")
    assert res.count() == 3 and best.k in (1, 3, 5)


def brute_nn(q, r, k=5):
    d = np.floor(np.sqrt(((r[None] - q[:, None]) ** 2).sum(-1)) * 1e9 + 0.5)
    return np.lexsort((np.broadcast_to(np.arange(len(r)), d.shape), d), axis=1)[:, :k]


def test_two_stage_against_brute_force_and_saved(spark):
    rng = np.random.default_rng(2)
    rows = [(f"c{i:04d}", f"k{rng.integers(3)}", f"m{rng.integers(4)}", f"u{rng.integers(9)}", f"p{rng.integers(4)}",
             "it", float(rng.integers(1, 90)), float(rng.integers(1, 9)), int(rng.integers(2))) for i in range(160)]
    df = spark.createDataFrame(rows, "campaign_id string, category_id string, market_id string, customer_id string, "
                                     "publisher string, industry string, CPA double, CPC double, convert int")
    emb = spark.createDataFrame([("it", [0.5, 1.0])], "value string, embedding array<double>")
    train, test = df.where("campaign_id < 'c0120'"), df.where("campaign_id >= 'c0120'")
    model = scoring.fit_two_stage(train, emb)
    got = {r["campaign_id"]: r for r in scoring.predict(model, test, impute_cpc=False).collect()}
    tr, te = rows[:120], rows[120:]

    def freq(c):
        return {v: sum(r[c] == v for r in tr) for v in {r[c] for r in tr}}

    def med(c):
        return {v: float(np.median([np.log1p(r[6]) for r in tr if r[c] == v])) for v in {r[c] for r in tr}}

    f, t = [freq(c) for c in (1, 2, 3, 4)], [med(c) for c in (1, 2, 3, 4)]
    one = lambda rs: np.array([[*(f[j].get(r[j + 1], 0) for j in range(4)), r[7], 0.5, 1.0] for r in rs], float)
    y = np.array([r[8] for r in tr])
    p_tr, p_te = (y[brute_nn(one(rs), one(tr))].mean(1) for rs in (tr, te))
    two = lambda rs, p: np.array([[*(t[j].get(r[j + 1], 0.0) for j in range(4)), r[7], p[i], 0.5, 1.0]
                                  for i, r in enumerate(rs)], float)
    logs = np.array([np.log1p(r[6]) for r in tr])
    want = np.expm1(logs[brute_nn(two(te, p_te), two(tr, p_tr))].mean(1))
    for i, r in enumerate(te):
        assert got[r[0]]["proba_convert"] == pytest.approx(p_te[i])
        assert got[r[0]]["predicted_cpa"] == pytest.approx(want[i])
    path = scratch_path(spark, "two-stage")
    scoring.save_two_stage(model, path)
    back = {r["campaign_id"]: r["predicted_cpa"] for r in
            scoring.predict(scoring.load_two_stage(spark, path), test, impute_cpc=False).collect()}
    assert back == pytest.approx({k: r["predicted_cpa"] for k, r in got.items()})
    with pytest.raises(ValueError):
        scoring.load_two_stage(spark, path + "-none")


def test_training_flags_of_the_original_command(spark):
    args = jobs.parser().parse_args(
        ["train", "--store", "s", "--model_type", "KNeighborsClassifier", "--evaluation_metric", "accuracy_score",
         "--scoring", "accuracy", "precision", "recall", "f1", "--save_model_as", "conversion_classifier.model",
         "--target_variable", "convert", "--predictor_variables", "a_encoded", "CPC", "['industry_embedding']", "--cv", "2",
         "--model_result_metrics", "test_accuracy", "train_f1"])
    args.store = scratch_path(spark, "flags")
    rng = np.random.default_rng(3)
    df = spark.createDataFrame([(f"c{i}", i % 2, [float(i % 2), float(rng.normal()), 0.1, 0.2], "train" if i < 60 else "test")
                                for i in range(80)], "campaign_id string, convert int, features array<double>, split_type string")
    names = ["a_encoded", "CPC", "industry_embedding_0", "industry_embedding_1"]
    args.dataset_uid = ds.write_dataset(df, args.store, column_order=names)
    run = jobs.train(spark, args)
    row = models.runs(spark, args.store).where(F.col("run_id") == run).first()
    assert row["test_score"] > 0.8
    saved = spark.read.parquet(args.store + "/metrics").where(F.col("run_id") == run)
    assert {(r["split"], r["metric"]) for r in saved.collect()} == {
        (s, m) for s in ("train", "test") for m in ("accuracy", "precision", "recall", "f1")}
    args.cv = 1
    assert jobs.train(spark, args)


def test_features_of_one_partition_are_made_by_many_tasks(spark):
    from pyspark.sql import functions as F
    from campaign_engine.operators import scoring
    from campaign_engine.session import settle
    rows = [(f"c{i}", f"a{i % 3}", f"m{i % 2}", f"u{i % 5}", "p", "x" if i % 2 else None, float(i)) for i in range(64)]
    df = spark.createDataFrame(rows + rows[:2], "campaign_id string, category_id string, market_id string, customer_id string, "
                               "publisher string, industry string, CPC double").coalesce(1)
    enc = spark.createDataFrame([("category_id", "a0", 2.0), ("customer_id", "u1", 3.0)], "variable string, value string, enc double")
    emb = spark.createDataFrame([("x", [1.0, 2.0]), ("", [0.0, 0.0])], "value string, embedding array<double>")
    out = scoring.stage1_features(df, settle(enc), emb)  # as fitted: tables of known size
    assert out.count() == 66 and out.select(F.spark_partition_id()).distinct().count() > 4
