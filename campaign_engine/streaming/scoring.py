"""Request scoring as a Structured Streaming job (the serving tier re-aimed).

Requests arrive as files (Parquet) in a directory; each micro-batch is scored
by the same two-stage plan as batch scoring (``foreachBatch``: the kNN join is
a cogroup, which is a batch operator) and appended to an output table. The
streaming checkpoint makes the job restartable: after a failure it resumes
from the last committed batch, and the per-batch write is idempotent because
each batch id writes its own directory with ``overwrite``.
"""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..operators import scoring

REQUEST_SCHEMA = T.StructType([
    T.StructField("request_id", T.StringType()),
    T.StructField("category_id", T.StringType()),
    T.StructField("market_id", T.StringType()),
    T.StructField("customer_id", T.StringType()),
    T.StructField("publisher", T.StringType()),
    T.StructField("industry", T.StringType()),
])


def score_request_stream(spark: SparkSession, model: scoring.TwoStageModel | str, source_dir: str,
                         out_dir: str, checkpoint_dir: str, max_files_per_trigger: int = 64,
                         available_now: bool = True):
    """Start the scoring stream with a fitted model, or the path of a saved one;
    returns the ``StreamingQuery``."""
    if isinstance(model, str):
        model = scoring.load_two_stage(spark, model)
    stream = (spark.readStream.schema(REQUEST_SCHEMA)
              .option("maxFilesPerTrigger", max_files_per_trigger).parquet(source_dir))

    def score_batch(batch: DataFrame, batch_id: int) -> None:
        rows = batch.withColumnRenamed("request_id", model.id_col)
        scored = scoring.predict(model, rows, impute_cpc=True)
        (scored.select(F.col(model.id_col).alias("request_id"), "proba_convert", "predicted_cpa")
               .withColumn("batch_id", F.lit(batch_id))
               .write.mode("overwrite").parquet(os.path.join(out_dir, f"batch={batch_id}")))

    w = stream.writeStream.foreachBatch(score_batch).option("checkpointLocation", checkpoint_dir)
    w = w.trigger(availableNow=True) if available_now else w.trigger(processingTime="10 seconds")
    return w.start()
