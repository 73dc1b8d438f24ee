"""Encoders, CPC imputation and weights on micro-tables."""
import pytest

from campaign_engine.operators import encoders as enc
from campaign_engine.operators import features as feat


def test_encode_seen_unseen_null(spark):
    train = spark.createDataFrame([("a",), ("a",), ("b",), (None,)], "c string")
    e = enc.fit_encoders(train, ["c"], "frequency")
    rows = spark.createDataFrame([(1, "a"), (2, "b"), (3, "z"), (4, None)], "id int, c string")
    out = {r["id"]: r["c_encoded"] for r in enc.apply_encoders(rows, e, ["c"]).collect()}
    assert out == {1: 2.0, 2: 1.0, 3: 0.0, 4: None}


def test_target_encoder_median_and_matched_null(spark):
    train = spark.createDataFrame([("a", 1.0), ("a", 3.0), ("a", 10.0), ("b", None)], "c string, t double")
    e = enc.fit_encoders(train, ["c"], "target", target="t", stat="median")
    got = {r["value"]: r["enc"] for r in e.collect()}
    assert got == {"a": 3.0, "b": None}
    rows = spark.createDataFrame([(1, "a"), (2, "b"), (3, "q")], "id int, c string")
    out = {r["id"]: r["c_encoded"] for r in enc.apply_encoders(rows, e, ["c"]).collect()}
    assert out == {1: 3.0, 2: None, 3: 0.0}


def test_duplicate_external_encoder_rejected(spark):
    e = spark.createDataFrame([("a", 1.0), ("a", 2.0)], "value string, enc double")
    rows = spark.createDataFrame([("a",)], "c string")
    with pytest.raises(ValueError):
        enc.encode(rows, "c", e, validate=True)


def test_unknown_encoder_kind(spark):
    with pytest.raises(NotImplementedError):
        enc.fit_encoders(spark.createDataFrame([("a",)], "c string"), ["c"], "onehot")


def test_cpc_imputation(spark):
    rec = spark.createDataFrame([("1", "p", 2.0), ("1", "q", None), ("2", "p", 6.0)],
                                "market_id string, publisher string, CPC double")
    rows = spark.createDataFrame([(1, "1", "p"), (2, "1", "q"), (3, "9", "p"), (4, "1", None)],
                                 "id int, market_id string, publisher string")
    out = {r["id"]: r["CPC"] for r in feat.impute_cpc(rows, rec).collect()}
    assert out == {1: 2.0, 2: None, 3: 4.0, 4: 4.0}   # unmatched -> median(2, 6)


def test_class_and_sample_weights(spark):
    df = spark.createDataFrame([(i, 1 if i < 3 else 0) for i in range(8)], "id int, y int")
    w = {r["y"]: r["class_weight"] for r in feat.class_weights(df, "y").collect()}
    assert w[1] == pytest.approx(8 / (2 * 3)) and w[0] == pytest.approx(8 / (2 * 5))
    sw = feat.sample_weights(df, "y").agg({"sample_weight": "sum"}).first()[0]
    assert sw == pytest.approx(8.0)


def test_assembly_golden_example(spark):
    df = spark.createDataFrame([(1, 4, [0.1, 0.2], 0), (2, 5, [0.3, 0.4], 1), (3, 6, [0.5, 0.6], 0)],
                               "feature1 int, feature2 int, industry_embedding array<double>, target int")
    out = feat.assemble(df, ["feature1", "feature2"], "industry_embedding", target="target")
    rows = [r["features"] for r in out.orderBy("feature1").collect()]
    assert rows[0] == [0.0, 1.0, 4.0, 0.1, 0.2]
    assert rows[1] == [1.0, 2.0, 5.0, 0.3, 0.4]
    names = feat.feature_names(["feature1", "feature2"], "industry_embedding", 2, target="target")
    back = feat.disassemble(out, names).orderBy("feature1").first()
    assert back["industry_embedding"] == [0.1, 0.2]
    sel = feat.select_by_name(out, ["feature2", "industry_embedding"], names, out="s").orderBy("feature1").first()
    assert sel["s"] == [4.0, 0.1, 0.2]
    with pytest.raises(ValueError):
        feat.select_by_name(out, ["nope"], names)


def test_only_variables_of_many_values_shuffle_the_rows(spark, monkeypatch):
    monkeypatch.setattr(enc, "BROADCAST_BYTES", 2000)
    df = spark.createDataFrame([(i, f"m{i % 3}", f"customer{i}") for i in range(300)], "id long, market string, customer string")
    threshold = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "1000b")  # the long table is larger
    try:
        table = enc.fit_encoders(df, ["market", "customer"])
        out = enc.apply_encoders(df, table, ["market", "customer"])
        plan = out._jdf.queryExecution().sparkPlan().toString()
        assert plan.count("BroadcastHashJoin") == 1 and plan.count("SortMergeJoin") == 1
        assert out.where("market_encoded = 100 AND customer_encoded = 1").count() == 300
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)
