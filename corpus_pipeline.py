"""The corpus pipeline: five of the library's operators over ``documents``.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame, which is written
as Parquet and read again as the next stage's ``docs``. All but the last return
the columns of documents. Columns beyond these are not carried; whole texts are
read, however long; an empty table gives an empty table in every stage, and so do
empty ``labels`` or ``benchmark`` tables an untrained classifier that keeps by its priors and no
contaminated document. Reruns over the same files agree.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from campaign_engine.llm import decontamination, mixing, quality_classifier, sharding, simhash_dedup
from campaign_engine.llm.common import materialize, table

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]
N_SHARDS = 8


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose posterior of being good reaches one half stay. Null and empty texts are judged by
    their site alone; null sources and languages are sites of their own; repeated rows are judged alike."""
    model = quality_classifier.train(docs, table(spark, sf_dir, "labels"))
    scored = quality_classifier.classify(docs, model, keep=COLUMNS)
    return scored.filter("__quality.kept").select(*COLUMNS)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each SimHash component stays: the one of the smallest id (null last), then text hash,
    then the other columns. Null, empty and blank texts share the fingerprint zero, so one of them stays."""
    return simhash_dedup.keep_one(docs.select(*COLUMNS), shingle=simhash_dedup.SHINGLE,
                                  max_bits=simhash_dedup.MAX_BITS)


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a benchmark item go. A document is its id and text: clean documents of a null or
    repeated id stay; texts without words hold nothing."""
    return decontamination.remove_contaminated(docs.select(*COLUMNS), table(spark, sf_dir, "benchmark"))


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row per copy that the mix takes, in training order. Null and empty texts have no words, so only
    whole passes over their source take them; a null source is one of its own; ties go by text hash, then place."""
    return mixing.training_order(docs.select(*COLUMNS)).select(*COLUMNS)


def shard(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The mixed documents with their shard and slot; a null id is sharded as -1, copies get slots of their own."""
    return sharding.assign(docs.select(*COLUMNS), N_SHARDS, keep=COLUMNS)


STAGES = [("quality_classifier", quality), ("simhash_near_dedup", near_duplicates),
          ("benchmark_decontamination", decontaminate), ("mixing", mix), ("sharding", shard)]

#: the classifier's fit and XXH64 fingerprints are beyond SQL; tests hold run() against brute force
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents table, each on what its predecessor kept."""
    docs = table(spark, sf_dir, "documents").select(*COLUMNS)
    for name, stage in STAGES[:-1]:
        docs = materialize(stage(spark, docs, sf_dir), f"pipeline_{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
