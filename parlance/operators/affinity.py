"""Partitions of one language each, cut by running sums of words (J3, K2): a task of a tagger loads one model.

A language gets as many partitions as its share of all words asks for, at least one.  Its rows fall into buckets by a hash
of their keys, the buckets' words are summed by a map-side aggregate, and the running sum over the
buckets says which slice of the language a bucket lies in.  What is gathered is a number a (language, bucket), and a total a
language in the driver; rows move once, straight to their partition.
"""

from __future__ import annotations

from math import ceil

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from parlance.functions.text import words
from parlance.session import persisted

#: Buckets of a language for each partition asked for: a slice is uneven by about one bucket.
BUCKETS_A_PART = 16


def by_language(rows: DataFrame, parts: int, lang: str = "lang", keys: tuple[str, ...] = ("file_id", "line_index"),
                weight: Column | None = None) -> DataFrame:
    """``rows`` in about ``parts`` partitions (at most one more a language), none with two languages.

    ``weight`` (default: the words of ``text``) is a row's share of the work.  No partition exceeds the mean by more than one
    bucket or one row, whichever is larger.  Rows without a language form a language of their own; those with equal ``keys`` stay together.
    """
    if rows.isEmpty():
        return rows
    buckets = parts * BUCKETS_A_PART
    own = (F.coalesce(F.col(lang).cast("string"), F.lit("")), F.pmod(F.xxhash64(*keys), F.lit(buckets)))
    weight = F.coalesce(F.size(words("text")), F.lit(0)) + 1 if weight is None else weight
    sums = persisted(rows.groupBy(own[0].alias("_l"), own[1].alias("_b")).agg(F.sum(weight.cast("double")).alias("_w")))
    totals = sums.groupBy("_l").agg(F.sum("_w").alias("_t")).orderBy("_l").collect()      # a number a language
    mean = sum(r["_t"] for r in totals) / parts
    plan, first = [], 0
    for r in totals:
        slices = max(1, ceil(r["_t"] / mean - 1e-9)) if mean > 0 else 1
        plan.append((r["_l"], first, slices, r["_t"]))
        first += slices
    languages = rows.sparkSession.createDataFrame(plan, "_l string, _first int, _slices int, _t double")
    middle = F.sum("_w").over(Window.partitionBy("_l").orderBy("_b")) - F.col("_w") / 2
    place = F.coalesce(F.floor(F.try_divide(F.col("_middle") * F.col("_slices"), F.col("_t"))).cast("int"), F.lit(0))
    slices = sums.withColumn("_middle", middle).join(languages, "_l").select(
        "_l", "_b", (F.col("_first") + F.least(F.col("_slices") - 1, place)).alias("_p"))
    placed = rows.withColumns({"_l": own[0], "_b": own[1]}).join(slices, ["_l", "_b"])
    return placed.repartitionById(first, F.col("_p")).select(*[F.col(f"`{c}`") for c in rows.columns])
