"""The registered queries: each operator with production parameters over its whole table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

import public_tokenizers

from parlance.llm import (conversation_trie, decontamination, language, license_scan, mixing, neighbours, packing, quality, simhash, suffix_dedup,
                          toxicity, url_filter, whitening)
from parlance.llm.common import fold, labelled_sample, table

THRESHOLD = 0.7
URL_RULES = [("net", "/", "block"), ("example.net", "/en/", "allow"), ("example.com", "/de/", "block"), ("org", "/fr/", "allow")]
MIX_WEIGHTS, MIX_REPEATS, MIX_SEED = (5, 2, 1), 3, 7
TOKENIZER = "byte_bpe_50k.json"


def op1_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = license_scan.scan(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return found.select("doc_id", *[F.array_join(c, ",").alias(c) for c in ("licences", "sentence_ids", "unmatched")])


def op2_nearest_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    return neighbours.search(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 20 == 0, k=20)


def op3_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = decontamination.find(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"), shortest=1)
    return found.select("doc_id", "item_id", "start", "item_start", "length", "matches")


def quality_model(docs: DataFrame, labels: DataFrame) -> quality.Model:
    return quality.fit(labelled_sample(docs, labels, "quality", fold("doc_id", 4) != 2, quality.MOST))


def op4_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    model = quality_model(docs, table(spark, sf_dir, "labels"))
    keep = {"doc_id": F.col("doc_id"), "held_out": F.coalesce(fold("doc_id", 4) == 2, F.lit(False))}
    return _predicted(quality.score(docs, model, keep))


def op5_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix_dedup.report(table(spark, sf_dir, "documents"))


def op6_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    rules = spark.createDataFrame(URL_RULES, "host string, path string, verdict string")
    return url_filter.judge(table(spark, sf_dir, "pages"), rules)


def op7_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    langs, vectors = language.prototypes(docs.filter(fold("doc_id", 5) != 0))
    return language.identify(docs, langs, vectors, keep={"held_out": F.coalesce(fold("doc_id", 5) == 0, F.lit(False))})


def op8_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packed(table(spark, sf_dir, "documents"))


def packed(docs: DataFrame) -> DataFrame:
    return packing.pack(packing.pieces(docs, public_tokenizers.path(TOKENIZER)))


def op9_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_duplicates(table(spark, sf_dir, "documents"), words=3, max_bits=2)


def toxicity_model(docs: DataFrame, labels: DataFrame) -> toxicity.Model:
    return toxicity.fit(labelled_sample(docs, labels, "toxic", fold("doc_id", 3) != 1, toxicity.MOST))


def op10_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    model = toxicity_model(docs, table(spark, sf_dir, "labels"))
    keep = {"doc_id": F.col("doc_id"), "held_out": F.coalesce(fold("doc_id", 3) == 1, F.lit(False))}
    return _predicted(toxicity.score(docs, model, keep))


def op11_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whitening.whiten(table(spark, sf_dir, "embeddings"))


def op12_source_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    mixed = mixing.mix(docs, F.array("source"), MIX_WEIGHTS, most=MIX_REPEATS, seed=MIX_SEED)
    return mixed.select("doc_id", "size", F.col("sources")[0]["size"].alias("source_size"), F.col("sources")[0]["target"].alias("target"), "taken")


def op13_conversation_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns = table(spark, sf_dir, "conversations")
    return conversation_trie.nodes(conversation_trie.rebuilt(turns))


def _predicted(scored: DataFrame) -> DataFrame:
    return scored.withColumn("predicted", (F.col("score") >= THRESHOLD).cast("int"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {f.__name__: f for f in (
    op1_license_scan, op2_nearest_neighbours, op3_decontamination, op4_quality, op5_suffix_dedup, op6_url_filter,
    op7_language_id, op8_packing, op9_simhash, op10_toxicity, op11_whitening, op12_source_mixing, op13_conversation_trie)}
