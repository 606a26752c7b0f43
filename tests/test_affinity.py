"""Partitions of one language each."""

import random
from statistics import median

import pandas as pd
from pyspark.sql import functions as F

from parlance.operators import tally as T
from parlance.operators.affinity import by_language

UNIT = "file_id long, speaker_role string, line_index long, text string, lang string"


def _units(spark, lines):
    rng = random.Random(4)
    rows = [(k % 40, "Participant", k, " ".join(["w"] * rng.randint(1, 60)), lang) for k, lang in enumerate(lines)]
    return spark.createDataFrame(rows, UNIT)


def test_a_partition_has_one_language_and_its_share_of_the_words(spark):
    units = _units(spark, ["en"] * 6000 + ["de"] * 1500 + ["fr"] * 1200 + ["zh"] * 20 + [None] * 5)
    placed = by_language(units, 16)
    words = F.sum(F.size(F.split("text", " ")))
    got = placed.groupBy(F.spark_partition_id().alias("p")).agg(words.alias("n"), F.count_distinct(F.coalesce("lang", F.lit("-"))).alias("langs")).collect()
    assert all(r["langs"] == 1 for r in got)
    sizes = [r["n"] for r in got]
    assert 16 <= len(sizes) <= 16 + 5 and max(sizes) <= 2 * median(sizes)
    assert max(sizes) <= 1.25 * sum(sizes) / 16
    assert placed.columns == units.columns and placed.exceptAll(units).isEmpty() and units.exceptAll(placed).isEmpty()


def test_odd_tables(spark):
    empty = spark.createDataFrame([], UNIT)
    assert by_language(empty, 4).count() == 0
    blank = spark.createDataFrame([(1, "P", 0, None, None), (1, "P", 0, "", None), (None, None, None, "a b", "en")], UNIT)
    assert by_language(blank, 4).count() == 3
    many = _units(spark, [f"l{k % 50}" for k in range(400)])    # more languages than partitions
    got = by_language(many, 4).groupBy(F.spark_partition_id()).agg(F.count_distinct("lang").alias("n")).collect()
    assert len(got) == 50 and all(r["n"] == 1 for r in got)
    huge = spark.createDataFrame([(1, "P", 0, "w " * 50_000, "en")] + [(1, "P", k, "w w", "en") for k in range(1, 500)], UNIT)
    assert by_language(huge, 8).count() == 500


def test_a_tagger_meets_one_language_a_task(spark):
    units = _units(spark, ["en"] * 900 + ["es"] * 300)

    def tagger(batches):
        from pyspark import TaskContext
        for b in batches:
            task = str(TaskContext.get().partitionId())
            yield pd.DataFrame([(r.file_id, r.speaker_role, r.line_index, 1, 1, r.text, r.lang, "NOUN", task, None, None) for r in b.itertuples()],
                               columns=["file_id", "speaker_role", "line_index", "sent_id", "word_id", "word", "lemma", "upos", "xpos", "deprel", "feats"])

    tokens = T.annotate(units, tagger)
    tasks = tokens.groupBy("xpos").agg(F.count_distinct("lemma").alias("models"), F.count("*").alias("n")).collect()
    assert all(r["models"] == 1 for r in tasks) and sum(r["n"] for r in tasks) == 1200
    assert tokens.where("error IS NOT NULL").isEmpty()
