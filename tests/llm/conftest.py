import pytest


@pytest.fixture(autouse=True)
def small_batches(spark):
    """Tiny Arrow batches, so that state kept across batches is exercised."""
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    old = spark.conf.get(key, "10000")
    spark.conf.set(key, "3")
    yield
    spark.conf.set(key, old)
