"""A corpus pipeline of five stages over ``documents``; each stage calls one operator of ``parlance.llm``.

Each function takes (spark, docs, sf_dir), where docs is all that the stage before it kept, and returns the documents it
keeps, with the columns of ``documents``; the last returns the packed pieces.  ``run`` writes each result as
Parquet in the shared folder and rereads it, so a lost executor costs no more than the stage at hand.

Nulls, empty texts, ties, repeated rows, empty tables and further columns: as each operator's module says; a null or
empty text is scored like any other by the toxicity stage, kept at most once by the near-duplicate stage, and is
packed as its end-of-document id alone.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from parlance.llm import decontamination, simhash, suffix_dedup, toxicity
from parlance.llm.common import durable, table
from parlance.llm.queries import THRESHOLD, packed, toxicity_model
from parlance.session import ensure_checkpoint_dir


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the toxicity model scores under the threshold."""
    model = toxicity_model(docs, table(spark, sf_dir, "labels"))
    places = [f"c{i}" for i in range(len(docs.columns))]  # whatever the columns are called
    numbered = docs.toDF(*places).withColumn("text", F.col(places[docs.columns.index("text")]))
    scored = toxicity.score(numbered, model, {c: F.col(c) for c in places})
    return scored.filter(F.col("score") < THRESHOLD).select(*places).toDF(*docs.columns)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each SimHash group: that with the smallest id; of rows that share an id, the one with the smallest hash.

    A null id stands behind all others: such rows get a number from their text, beyond any id in use.
    """
    places = [f"c{i}" for i in range(len(docs.columns))]
    own = F.col(places[docs.columns.index("doc_id")]).cast("long")
    text = F.col(places[docs.columns.index("text")]).cast("string")
    stand_in = F.lit(2 ** 62) + F.xxhash64(F.coalesce(text, F.lit(""))).bitwiseAND(F.lit(2 ** 61 - 1))
    rows = docs.toDF(*places).withColumn("doc_id", F.coalesce(own, stand_in)).withColumn("text", text)
    rows = rows.withColumn("row", F.xxhash64(*places))  # equal for rows that are equal throughout
    groups = simhash.grouped(rows, words=3, max_bits=2, keep=("row",))
    first = durable(groups.groupBy("root").agg(F.min(F.struct("doc_id", "row")).alias("first")).select("first.*"))
    kept = rows.join(first, ["doc_id", "row"], "left_semi").dropDuplicates(["doc_id", "row"])
    return kept.select(*places).toDF(*docs.columns)


def cut_repeats(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without the passages that stand in an earlier document."""
    return suffix_dedup.cut(docs)


def drop_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a verified overlap with a benchmark item."""
    return decontamination.clean(docs, table(spark, sf_dir, "benchmark"), shortest=1)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The remaining documents' pieces, packed into sequences."""
    return packed(docs)


STAGES = [("toxicity", drop_toxic), ("simhash_near_dedup", drop_near_duplicates), ("suffix_dedup", cut_repeats),
          ("decontamination", drop_benchmark), ("packing", pack)]

#: SQL can't express the networks, the fingerprints or the packing; tests/llm compares the stages with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each written and read again in the shared folder."""
    base = f"{ensure_checkpoint_dir(spark)}/pipeline-{uuid.uuid4().hex}"
    docs = table(spark, sf_dir, "documents")
    for k, (name, stage) in enumerate(STAGES):
        stage(spark, docs, sf_dir).write.parquet(path := f"{base}/{k}_{name}")
        docs = spark.read.parquet(path)
    return docs
