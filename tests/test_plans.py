"""Plan guards: no cartesian / nested-loop joins anywhere in the registered
plans checked here, and the campaign scan prunes columns and pushes filters."""
import pytest

from tests.conftest import SF001

NAMES = ["compute_cpa", "cpa_per_variable", "group_stat_multi", "cpc_record", "fd_histogram",
         "split_shuffled", "split_stratified", "cv_folds_stratified", "encode_multi",
         "encode_test_with_train", "cpc_impute", "assemble_features", "request_features",
         "knn_classify", "cv_metrics", "top_k_configs", "explore_configs", "candidate_space",
         "column_positions", "clean_metadata"]


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", NAMES)
def test_no_cross_products(spark, name):
    import __spark_entry__ as e
    plan = _plan(e.queries()[name](spark, SF001))
    assert "CartesianProduct" not in plan
    assert "BroadcastNestedLoopJoin" not in plan


def test_campaign_scan_prunes_and_pushes(spark):
    from campaign_engine.sources.tables import ads
    plan = _plan(ads(spark, SF001))
    assert "ReadSchema: struct<o_orderkey:bigint,o_custkey:bigint>" in plan
    assert "PushedFilters: [IsNotNull(c_custkey)]" in plan
