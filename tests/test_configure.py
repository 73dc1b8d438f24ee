"""Top-k, candidate space, explore and argmin with ties."""
import pytest

from campaign_engine.operators import configure as cfg


def test_top_k_ties_break_on_key(spark):
    u = spark.createDataFrame([("2", "b", 5), ("1", "b", 5), ("1", "a", 7), ("3", "z", 1)],
                              "market_id string, publisher string, n_campaigns long")
    got = [(r["market_id"], r["publisher"]) for r in cfg.top_k_configs(u, 3).collect()]
    assert got == [("1", "a"), ("1", "b"), ("2", "b")]


def test_candidate_space_and_recommend(spark):
    reqs = spark.createDataFrame([("c1",), ("c2",)], "customer_id string")
    confs = spark.createDataFrame([("1", "a"), ("2", "b")], "market_id string, publisher string")
    cs = cfg.candidate_space(reqs, confs)
    assert cs.count() == 4
    scored = cs.withColumn("predicted_cpa", (cs.market_id == "2").cast("double"))
    best = {r["customer_id"]: (r["market_id"], r["publisher"]) for r in cfg.recommend(scored, ["customer_id"]).collect()}
    assert best == {"c1": ("1", "a"), "c2": ("1", "a")}
    tie = cs.withColumn("predicted_cpa", cs.customer_id.isNotNull().cast("double"))
    assert cfg.recommend(tie, ["customer_id"]).first()["market_id"] == "1"


def test_empty_candidates_raise(spark):
    reqs = spark.createDataFrame([("c1",)], "customer_id string")
    empty = spark.createDataFrame([], "market_id string, publisher string")
    with pytest.raises(ValueError):
        cfg.candidate_space(reqs, empty)
    with pytest.raises(ValueError):
        cfg.recommend(spark.createDataFrame([], "customer_id string, market_id string, publisher string, "
                                                 "predicted_cpa double"), ["customer_id"])


def test_explore_excludes_exploited(spark):
    rows = [("c%d" % i, "1", "a") for i in range(5)] + [("x", "2", "b")]
    df = spark.createDataFrame(rows, "campaign_id string, market_id string, publisher string")
    got = {(r["market_id"], r["publisher"]) for r in cfg.explore_configs(df, usage_ratio=1.0).collect()}
    assert got == {("1", "b"), ("2", "a"), ("2", "b")}
    unused = {(r["market_id"], r["publisher"]) for r in cfg.explore_configs(df).collect()}
    assert unused == {("1", "b"), ("2", "a")}


def test_null_scores_are_never_recommended(spark):
    rows = [("r1", "1", "a", None), ("r1", "2", "b", 5.0), ("r1", "3", "a", 5.0), ("r2", "1", "a", None)]
    df = spark.createDataFrame(rows, "request_id string, market_id string, publisher string, predicted_cpa double")
    got = {r["request_id"]: (r["market_id"], r["predicted_cpa"]) for r in cfg.recommend(df, ["request_id"]).collect()}
    assert got == {"r1": ("2", 5.0), "r2": (None, None)}
