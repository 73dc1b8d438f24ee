"""Driver contract smoke checks."""
from tests.conftest import SF001


def test_entry_runs(spark):
    import __spark_entry__ as e
    df = e.entry(spark)
    rows = df.collect()
    assert rows and set(df.columns) == {"publisher", "CPA_Statistics_type", "statistics_value"}


def test_oracle_keys_subset_of_queries():
    import __spark_entry__ as e
    assert set(e.oracle_sql()) <= set(e.queries())
    assert len(e.queries()) >= 60


def test_small_queries_on_sf0001(spark):
    import __spark_entry__ as e
    q = e.queries()
    for name in ["compute_cpa", "freq_table", "split_shuffled", "encode_multi", "knn_classify"]:
        assert q[name](spark, SF001).count() > 0
