"""Commits of concurrent writers, lineage, JSON documents, file order, credentials."""
import os

import pytest
from pyspark.sql import functions as F

from campaign_engine.operators import models as M
from campaign_engine.operators import splits
from campaign_engine.sources import datasets as ds


def small(spark, n=10):
    return spark.range(n).select(F.col("id").cast("string").alias("campaign_id"), (F.col("id") * 1.5).alias("cost"))


def test_a_new_version_replaces_the_old_one(spark, tmp_path):
    root = str(tmp_path)
    ds.write_dataset(small(spark, 10), root, uid="a", split_col=None)
    old = ds.read_dataset(spark, root, "a", "all")
    ds.write_dataset(small(spark, 4), root, uid="a", split_col=None)
    assert ds.read_dataset(spark, root, "a", "all").count() == 4 and old.count() == 10
    row = ds.resolve(spark, root, "a", "all")
    assert (row["version"], row["n_rows"]) == (2, 4) and ds.registry_log(spark, root).count() == 2


def test_two_writers_of_one_version(spark, tmp_path, monkeypatch):
    root, real, inner = str(tmp_path), ds.registry_log, []

    def racing(spark_, root_):
        log = real(spark_, root_)
        if not inner:  # between the first writer's look and its append, another one commits
            inner.append(1)
            log = spark_.createDataFrame(log.collect(), ds.REGISTRY_SCHEMA)
            ds.write_dataset(small(spark, 7), root, uid="a", split_col=None)
        return log

    monkeypatch.setattr(ds, "registry_log", racing)
    with pytest.raises(ValueError, match="another writer"):
        ds.write_dataset(small(spark, 3), root, uid="a", split_col=None)
    monkeypatch.setattr(ds, "registry_log", real)
    assert ds.read_dataset(spark, root, "a", "all").count() == 7  # the loser's rows are marked, its files apart
    ds.write_dataset(small(spark, 5), root, uid="a", split_col=None)
    assert ds.resolve(spark, root, "a", "all")["n_rows"] == 5


def test_an_unsettled_conflict_is_reported(spark, tmp_path):
    root = str(tmp_path)
    ds.write_dataset(small(spark), root, uid="a", split_col=None)
    rival = ds.registry_log(spark, root).withColumn("commit", F.lit("crashed"))
    rival.coalesce(1).write.mode("append").parquet(ds.registry_path(root))
    with pytest.raises(ValueError, match="two writers"):
        ds.resolve(spark, root, "a", "all")


def test_lineage(spark, tmp_path):
    root = str(tmp_path)
    for uid, parent, n in (("raw", None, 10), ("features", "raw", 8), ("augmented", "features", 6), ("other", "raw", 3)):
        ds.write_dataset(small(spark, n), root, uid=uid, parent_uid=parent, split_col=None)
    got = [(r.uid, r.depth, r.n_rows) for r in ds.lineage(spark, root, "augmented").orderBy("depth").collect()]
    assert got == [("augmented", 0, 6), ("features", 1, 8), ("raw", 2, 10)]
    assert ds.lineage(spark, root, "raw").count() == 1
    ds.write_dataset(small(spark), root, uid="raw", parent_uid="augmented", split_col=None)
    with pytest.raises(Exception, match="cycle"):
        ds.lineage(spark, root, "augmented").collect()
    with pytest.raises(ValueError, match="no dataset"):
        ds.lineage(spark, root, "absent")


def test_registry_documents(spark, tmp_path):
    root = str(tmp_path)
    ds.write_dataset(small(spark), root, uid="a", split_col=None, column_order=["x", "y"], class_weight={"1": 2.0},
                     metadata={"k": "v \"q\""}, params={"random_state": 7, "shuffle": True})
    reg = ds.registry(spark, root)
    back = ds.registry_from_json(ds.registry_json(reg))
    assert back.columns == ds.REGISTRY_SCHEMA.names and back.collect() == reg.collect()
    with pytest.raises(Exception, match="(?i)malformed|parse"):
        ds.registry_from_json(spark.createDataFrame([("{oops",)], "document string")).collect()


def test_cv_document(spark):
    rows = [(f, s, m, f / 8 + len(m)) for f in range(3) for s in ("train", "test") for m in ("accuracy", "neg_mean_squared_error")]
    cv = spark.createDataFrame(rows, M.CV_SCHEMA)
    doc = M.cv_document(cv)
    assert '"test_accuracy":[8.0,8.125,8.25]' in doc.first()[0]
    assert sorted(map(tuple, M.cv_from_document(doc).collect())) == sorted(rows)


@pytest.mark.parametrize("fmt", ["csv", "parquet"])
def test_rows_keep_the_order_of_the_files(spark, tmp_path, fmt):
    path = str(tmp_path / "d")
    rows = small(spark, 4000).withColumn("n", F.col("campaign_id").cast("long"))
    w = rows.repartitionByRange(5, "n").sortWithinPartitions("n").select("campaign_id", "cost").write.option("header", True)
    w.csv(path) if fmt == "csv" else w.option("parquet.block.size", 2048).parquet(path)
    spark.conf.set("spark.sql.files.maxPartitionBytes", "6000")  # files are cut into blocks
    try:
        raw = spark.read.option("header", True).format(fmt).load(path)
        assert raw.rdd.getNumPartitions() > 5
        df = ds.file_position(raw)
        got = {r.campaign_id: r.row_position for r in df.collect()}
        tagged = splits.split_ordered(df, ["row_position"], 0.25)
        folds = splits.cv_folds_contiguous(df, ["campaign_id"], 3, order_cols=["row_position"])
        assert {r.campaign_id for r in tagged.where("split_type = 'test'").collect()} == {str(i) for i in range(3000, 4000)}
        assert {int(r.campaign_id): r.fold for r in folds.collect()} == {i: 0 if i < 1334 else 1 + (i - 1334) // 1333 for i in range(4000)}
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
    assert got == {str(i): i for i in range(4000)}


def test_scan_csv_with_positions(spark, tmp_path):
    from campaign_engine.schema import CAMPAIGN_SCHEMA
    names = CAMPAIGN_SCHEMA.names
    for part in range(3):
        with open(tmp_path / f"part-{part}.csv", "w") as f:
            f.write(",".join(names) + "\n" + "".join(",".join([f"c{part}{i}", *["1"] * (len(names) - 1)]) + "\n" for i in range(4)))
    df = ds.scan_csv(spark, str(tmp_path), position="pos")
    first = names[0]
    assert [r[first] for r in df.orderBy("pos").collect()] == [f"c{p}{i}" for p in range(3) for i in range(4)]


def test_store_settings_reach_the_connector_and_not_the_session(spark, tmp_path):
    from campaign_engine.schema import CAMPAIGN_SCHEMA
    names = CAMPAIGN_SCHEMA.names
    os.makedirs(tmp_path / "in")
    (tmp_path / "in" / "x.csv").write_text(",".join(names) + "\n" + ",".join(["1"] * len(names)) + "\n")
    # a mount table that only this reader knows: without its options the path cannot be opened
    options = {"fs.viewfs.mounttable.only.link./in": f"file://{tmp_path}/in"}
    df = ds.scan_csv_store(spark, "viewfs://only/in/x.csv", "key", "secret", "https://store.example", options=options)
    assert df.count() == 1
    assert not [k for k, v in spark.sparkContext.getConf().getAll() if v in ("key", "secret", "https://store.example")]
    assert spark.conf.get("spark.hadoop.fs.s3a.access.key", None) is None and spark.conf.get("fs.s3a.access.key", None) is None
    for args in (("s3a://b/x.csv", "key"), ("s3a://b/x.csv", None, "secret"), ("s3a://b/x.csv",)):
        with pytest.raises(ValueError):
            ds.scan_csv_store(spark, *args)


def test_bundle_datasets(spark, tmp_path):
    root = str(tmp_path)
    df = small(spark, 20).select(F.col("campaign_id"), "cost", F.array("cost", F.lit(1.0)).alias("features"),
                                 F.when(F.col("cost") > 20, "test").otherwise("train").alias("split_type"))
    uid = ds.write_dataset(df, root, fmt="npz")
    assert ds.resolve(spark, root, uid, "train")["n_rows"] == 14
    got = ds.read_dataset(spark, root, uid, "test", ["campaign_id", "features"])
    assert got.columns == ["campaign_id", "features"]
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, df.where("split_type = 'test'").select("campaign_id", "features").collect()))
    assert ds.list_datasets(spark, root).where("split_type = 'test'").count() >= 1
