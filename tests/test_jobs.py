"""End-to-end job chain on the smallest scale: CSV -> ingest -> preprocess ->
train (CV, model, metrics, run record) -> augment."""
from pyspark.sql import functions as F

from campaign_engine.plans import jobs
from campaign_engine.plans.registry import base
from campaign_engine.session import scratch_path
from campaign_engine.sources import datasets as ds
from tests.conftest import SF001


class A:
    def __init__(self, **kw):
        self.__dict__.update(dict(
            test_size=0.2, random_state=2025, stratify_variable=None, shuffle=True,
            categorical_features=["category_id", "market_id", "customer_id", "publisher"],
            numeric_features=["CPC"], target_variable="convert", categorical_target="convert",
            encoder_type="frequency_encoding", stats_to_compute="mean", embedding_table=None,
            embedding_dim=16, model_type="KNeighborsClassifier", scoring=["accuracy", "f1"],
            evaluation_metric="accuracy", save_model_as="clf", cv=2, include_sample_weight=False,
            predictor_variables=None))
        self.__dict__.update(kw)


def test_job_chain(spark):
    store = scratch_path(spark, "store")
    csv = scratch_path(spark, "csv")
    base(spark, SF001).write.option("header", True).csv(csv)
    uid = jobs.ingest(spark, A(store=store, data_path=csv))
    assert ds.resolve(spark, store, uid, "test")["n_rows"] == 1200
    fuid = jobs.preprocess(spark, A(store=store, dataset_uid=uid))
    tr = ds.read_dataset(spark, store, fuid, "train")
    assert tr.count() == 4800 and tr.where(F.size("features") != 5 + 16).count() == 0
    w = ds.weights_from_registry(tr, store, fuid, "convert", out="w")
    assert w.where(F.abs(F.col("w") - F.col("sample_weight")) > 1e-12).count() == 0
    run_id = jobs.train(spark, A(store=store, dataset_uid=fuid))
    from campaign_engine.operators import models
    run = models.runs(spark, store).where(F.col("run_id") == run_id).first()
    assert 0.0 <= run["test_score"] <= 1.0
    auid = jobs.augment(spark, A(store=store, dataset_uid=fuid, model_uri=run["model_path"]))
    aug = ds.read_dataset(spark, store, auid, "test")
    assert aug.where(F.size("features") != 5 + 16 + 1).count() == 0
    assert ds.resolve(spark, store, auid, "test")["parent_uid"] == fuid


def test_unshuffled_ingest_and_regressor_folds_keep_the_file_order(spark, tmp_path):
    rows = base(spark, SF001).limit(400).withColumn("campaign_id", F.lpad(F.monotonically_increasing_id().cast("string"), 12, "0"))
    rows.repartitionByRange(4, "campaign_id").sortWithinPartitions("campaign_id").write.option("header", True).csv(str(tmp_path / "csv"))
    ordered = [r.campaign_id for r in spark.read.option("header", True).csv(str(tmp_path / "csv")).orderBy("campaign_id").collect()]
    store = str(tmp_path / "store")
    uid = jobs.ingest(spark, A(store=store, data_path=str(tmp_path / "csv"), shuffle=False))
    test = ds.read_dataset(spark, store, uid, "test")
    assert "_position" not in test.columns
    assert sorted(r.campaign_id for r in test.collect()) == ordered[-80:]


def test_memo_and_metrics_document_of_the_jobs(spark, tmp_path):
    from campaign_engine.operators import models
    from campaign_engine.operators.embed import EmbeddingMemo
    store, memo = str(tmp_path / "store"), str(tmp_path / "memo")
    base(spark, SF001).limit(600).write.option("header", True).csv(str(tmp_path / "csv"))
    uid = jobs.ingest(spark, A(store=store, data_path=str(tmp_path / "csv")))
    fuid = jobs.preprocess(spark, A(store=store, dataset_uid=uid, embedding_memo=memo))
    known = EmbeddingMemo(memo).known(spark)
    assert known.count() == spark.read.parquet(memo).count() > 3
    jobs.preprocess(spark, A(store=store, dataset_uid=uid, embedding_memo=memo))
    assert spark.read.parquet(memo).count() == known.count()  # nothing was embedded again
    run_id = jobs.train(spark, A(store=store, dataset_uid=fuid, target_variable="CPA", model_type="Ridge",
                                 scoring=["neg_mean_squared_error", "r2"], evaluation_metric="root_mean_squared_error", cv=3))
    run = models.runs(spark, store).where(F.col("run_id") == run_id).first()
    doc = models.cv_from_document(spark.read.text(f"{run['model_path']}_metrics", wholetext=True), "value")
    saved = spark.read.parquet(f"{store}/metrics").where(F.col("run_id") == run_id)
    assert sorted(map(tuple, doc.collect())) == sorted(map(tuple, saved.select("fold", "split", "metric", "value").collect()))
    assert doc.count() == 3 * 2 * 2 and doc.where("metric = 'neg_mean_squared_error' AND value > 0").count() == 0


def test_file_order_writes_as_many_files_as_the_rows_need(spark, tmp_path, monkeypatch):
    from campaign_engine.plans import q_store

    old = {k: spark.conf.get(k) for k in ("spark.sql.adaptive.enabled", "spark.sql.shuffle.partitions")}
    monkeypatch.setattr(q_store, "scratch_path", lambda spark, name: str(tmp_path / name))
    try:
        spark.conf.set("spark.sql.adaptive.enabled", "false")
        spark.conf.set("spark.sql.shuffle.partitions", "9")
        out = q_store.q_file_order(spark, "/root/testdata/sf0.001").collect()
    finally:
        for k, v in old.items():
            spark.conf.set(k, v)
    assert len(list((tmp_path / "ordered-csv").glob("*.csv"))) == 9
    ids = [r.campaign_id for r in sorted(out, key=lambda r: r.row_position)]
    assert ids == sorted(ids) and [r.row_position for r in sorted(out, key=lambda r: r.row_position)] == list(range(len(ids)))
