"""Registry, metadata cleaning, positions, flattening and round trips."""
import pytest
from pyspark.sql import functions as F

from campaign_engine.session import scratch_path
from campaign_engine.sources import datasets as ds


def test_clean_metadata(spark):
    df = spark.createDataFrame([({"x-amz-meta-uid": "1", "content-type": "csv",
                                  "x-amz-meta-x-amz-meta-k": "v", "a-x-amz-meta-": "z"},)],
                               "m map<string,string>")
    got = df.select(ds.clean_metadata(F.col("m")).alias("m")).first()["m"]
    assert got == {"uid": "1", "content-type": "csv", "k": "v", "a-x-amz-meta-": "z"}


def test_parse_and_flatten(spark):
    df = spark.createDataFrame([("a,b,['c']",)], "s string")
    assert df.select(ds.parse_and_flatten(F.col("s")).alias("p")).first()["p"] == ["a", "b", "c"]


def test_positions(spark):
    m = ds.column_position_map(["t", "x", ["emb"]])
    assert m == {"t": 0, "x": 1, "emb": 2}
    assert ds.positions_of(m, "x") == [1]
    with pytest.raises(ValueError):
        ds.positions_of(m, ["x", "nope"])


def test_ingest_register_read(spark):
    root = scratch_path(spark, "t-ds")
    df = spark.createDataFrame([(f"k{i}", float(i)) for i in range(50)], "campaign_id string, cost double")
    uid = ds.ingest(df, root, ["campaign_id"], 0.2, 2025, shuffle=True)
    test = ds.read_dataset(spark, root, uid, "test")
    assert test.count() == 10
    assert ds.resolve(spark, root, uid, "train")["n_rows"] == 40
    with pytest.raises(ValueError):
        ds.resolve(spark, root, uid, "validation")
    listing = ds.list_datasets(spark, root).where(F.col("uid") == uid)
    assert listing.count() >= 2


def test_scan_csv_missing_path(spark):
    with pytest.raises(ValueError):
        ds.scan_csv(spark, "/nonexistent/path/none.csv")


def test_file_position_without_a_shuffle_of_the_rows(spark, tmp_path, monkeypatch):
    for f, first, n in (("b", 40, 35), ("a", 0, 40), ("c", 75, 0)):  # in the order of their names
        (tmp_path / f"{f}.csv").write_text("x\n" + "".join(f"{first + i}\n" for i in range(n)))
    keep = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "64b")  # several blocks a file
    try:
        rows = spark.read.option("header", True).csv(str(tmp_path))
        monkeypatch.setattr(type(rows), "repartitionByRange", None)
        out = ds.file_position(rows, "at")
        assert out.columns == ["x", "at"] and sorted((int(r.x), r.at) for r in out.collect()) == [(i, i) for i in range(75)]
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", keep)
