"""Exact top-n per group without a hot group in one task."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def top_n_per_group(df: DataFrame, group: list[str], order: list[Column], n: int,
                    salt_of: Column, buckets: int | None = None) -> DataFrame:
    """The first ``n`` rows of each group in ``order`` (ties broken by ``order``
    itself, which should be total).

    Phase 1 keeps the top ``n`` of every ``(group, salt bucket)``; phase 2 the
    top ``n`` of those, at most ``buckets * n`` rows per group.  The result is
    exact: a row in a group's top ``n`` is in its bucket's top ``n``.  ``buckets``
    defaults to the session's shuffle partitions, so a dominant group uses them all.
    """
    buckets = buckets or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    salted = df.withColumn("_salt", F.pmod(salt_of, F.lit(buckets)))
    w1 = Window.partitionBy(*group, "_salt").orderBy(*order)
    pre = salted.withColumn("_r", F.row_number().over(w1)).where(F.col("_r") <= n).drop("_r", "_salt")
    w2 = Window.partitionBy(*group).orderBy(*order)
    return pre.withColumn("_r", F.row_number().over(w2)).where(F.col("_r") <= n).drop("_r")
