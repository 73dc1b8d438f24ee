"""Micro-tables for the CPA / CPC / convert null and zero rules."""
import math

from pyspark.sql import functions as F

from campaign_engine.operators import metrics

VALS = [None, 0.0, 10.0]
CONV = [None, 0, 4]


def _grid(spark, second, name):
    rows = [(i * 3 + j, c, v) for i, c in enumerate(VALS) for j, v in enumerate(second)]
    return spark.createDataFrame(rows, f"id int, cost double, {name} bigint")


def test_cpa_rules_and_median_includes_provisional_zeros(spark):
    df = _grid(spark, CONV, "converions")
    out = {r["id"]: r["CPA"] for r in metrics.compute_cpa(df).collect()}
    # provisional: (null,*) -> null; (0,null)->0; (0,0)->0 (to be filled); (0,4)->0;
    # (10,null)->null; (10,0)->10; (10,4)->2.5 ; median over [0,0,0,10,2.5] = 0
    assert out[0] is None and out[1] is None and out[2] is None
    assert out[3] == 0.0 and out[5] == 0.0
    assert out[4] == 0.0                       # zero/zero gets the median (0)
    assert out[6] is None and out[7] == 10.0 and out[8] == 2.5


def test_cpa_fill_value_used_for_zero_zero(spark):
    df = _grid(spark, CONV, "converions")
    out = {r["id"]: r["CPA"] for r in metrics.compute_cpa(df, fill_value=7.5).collect()}
    assert out[4] == 7.5


def test_cpc_rules(spark):
    df = _grid(spark, CONV, "clicks")
    out = {r["id"]: r["CPC"] for r in metrics.compute_cpc(df).collect()}
    assert out[1] is None        # null cost, 0 clicks -> cost (null)
    assert out[4] == 0.0         # 0 cost, 0 clicks -> 0
    assert out[7] == 10.0        # cost, 0 clicks -> cost
    assert out[8] == 2.5
    assert out[5] == 0.0
    assert out[6] is None and out[3] is None


def test_convert_flag_missing_counts_as_converted(spark):
    df = spark.createDataFrame([(1, None), (2, 0), (3, 5)], "id int, converions bigint")
    out = {r["id"]: r["convert"] for r in metrics.convert_flag(df).collect()}
    assert out == {1: 1, 2: 0, 3: 1}


def test_log_target_roundtrip(spark):
    df = spark.createDataFrame([(0.0,), (3.0,)], "CPA double")
    out = metrics.inverse_log(metrics.log_target(df), "log_CPA", "back").collect()
    assert all(math.isclose(r["back"], r["CPA"], abs_tol=1e-12) for r in out)


def test_required_columns(spark):
    import pytest
    df = spark.createDataFrame([(1.0,)], "cost double")
    with pytest.raises(ValueError):
        metrics.compute_cpa(df)
    assert F is not None
