"""Registered queries: each applies one operator to its whole table."""

from __future__ import annotations

from pyspark.sql import functions as F

import corpus_pipeline

from . import (chat_rotation, decontamination, mixing, oracle, packing, pfp_dedup, phrase_mining, pii_crf,
               quality_classifier, quality_rules, ranked_search, rlz_dedup, sharding, simhash_dedup)
from .common import table

QUERIES, ORACLE = {}, {}


def register(fn):
    QUERIES[fn.__name__] = fn
    if sql := getattr(oracle, fn.__name__, None):
        ORACLE[fn.__name__] = sql
    return fn


@register
def op1_simhash_dedup(spark, sf_dir):
    return simhash_dedup.clusters(table(spark, sf_dir, "documents")).select(
        "doc_id", "fingerprint", "component_id")


@register
def op2_pii_crf(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    out = pii_crf.detect(docs, pii_crf.train(docs))
    return out.select("doc_id", "n_email", "n_ip", "n_card", "n_phone",
                      F.sha2(F.col("base"), 256).alias("base_sha256"), "spans", "n_added")


@register
def op6_quality_classifier(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    model = quality_classifier.train(docs, table(spark, sf_dir, "labels"))
    return quality_classifier.classify(docs, model, keep=["doc_id", "source", "lang"]).select(
        "doc_id", "source", "lang", "__quality.*")


@register
def op4_decontamination(spark, sf_dir):
    return decontamination.contaminated(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


@register
def op3_chat_rotation(spark, sf_dir):
    return chat_rotation.rotate(table(spark, sf_dir, "conversations"))


@register
def op5_mixing(spark, sf_dir):
    out = mixing.mix(table(spark, sf_dir, "documents"))
    return out.select("doc_id", "size", "source_size", "target", "taken",
                      (F.floor(F.col("position") * 1e6 + 0.5) / 1e6).alias("position"))


@register
def op7_pfp_dedup(spark, sf_dir):
    out = pfp_dedup.dedup(table(spark, sf_dir, "documents"))
    return out.select("doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256")


@register
def op8_rlz_dedup(spark, sf_dir):
    out = rlz_dedup.dedup(table(spark, sf_dir, "documents"))
    return out.select("doc_id", "n_words", "n_removed", F.sha2(F.col("kept"), 256).alias("kept_sha256"), "factors")


@register
def op9_sharding(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    out = sharding.assign(docs, 8, keep=["doc_id"])
    return out.select("doc_id", "size", "text_crc32", F.lit("key").alias("law"), "shard", "slot", "grown_shard")


@register
def op10_quality_rules(spark, sf_dir):
    led = quality_rules.ledger(table(spark, sf_dir, "documents"))
    strict = quality_rules.POLICIES[-1]
    out = quality_rules.apply_policy(led, strict)
    return out.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
                      (F.col("fail_bits").bitwiseAND(F.lit(quality_rules.BASE_MASK)) != 0).alias("base_failed"),
                      "kept", "fail_bits", F.lit(strict.version).alias("policy"))


@register
def op11_harmonic_packing(spark, sf_dir):
    import public_tokenizers

    pieces = packing.pack(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"),
                          public_tokenizers.path("byte_bpe_50k.tiktoken"))
    return pieces.select("doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id",
                         "offset")


@register
def op12_pair_maxscore(spark, sf_dir):
    index = ranked_search.build_index(table(spark, sf_dir, "documents"))
    return ranked_search.search(index, table(spark, sf_dir, "benchmark"))


@register
def op13_fm_collocations(spark, sf_dir):
    return phrase_mining.collocations(table(spark, sf_dir, "documents"))


@register
def pipeline(spark, sf_dir):
    return corpus_pipeline.run(spark, sf_dir)


if corpus_pipeline.ORACLE_SQL:
    ORACLE["pipeline"] = corpus_pipeline.ORACLE_SQL
