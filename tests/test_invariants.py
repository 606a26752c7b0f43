"""Invariants over whole query results (sf0.001)."""

from pyspark.sql import functions as F

import __spark_entry__ as E
from parlance.operators import feature_table as FT
from parlance.plans import catalog as CAT

SF = "/root/testdata/sf0.001"
Q = E.queries()


def test_found_plus_missing_is_words(spark):
    df = Q["word_freq"](spark, SF)
    assert df.where(F.col("found") + F.col("missing") != F.col("n_words")).count() == 0


def test_splits_partition_the_routed_rows(spark):
    routed = Q["routed"](spark, SF)
    counts = {r["target"]: r["n_rows"] for r in Q["split_counts"](spark, SF).collect()}
    assert sum(counts.values()) == routed.count()
    assert routed.where(F.col("target_cli").isNotNull()).count() == sum(v for k, v in counts.items() if k != "unknown")


def test_tally_wide_matches_long(spark):
    long = Q["tag_tally"](spark, SF).groupBy("conv_id", "speaker_role").agg(F.sum("cnt").alias("s"))
    wide = Q["tally_wide"](spark, SF)
    tag_cols = [c for c in wide.columns if c not in ("conv_id", "speaker_role", "num_sent")]
    w = wide.select("conv_id", "speaker_role", sum(F.col(c) for c in tag_cols).alias("w"))
    assert long.join(w, ["conv_id", "speaker_role"]).where(F.col("s") != F.col("w")).count() == 0


def test_corrections_are_idempotent(spark):
    table = CAT.fx_table(spark, SF)
    fixes = CAT._fixes(spark, SF)
    once = FT.apply_corrections(table, fixes)
    twice = FT.apply_corrections(once, fixes)
    assert once.exceptAll(twice).count() == 0 and twice.exceptAll(once).count() == 0


def test_dry_run_plan_leaves_table_untouched(spark):
    before = CAT.fx_table(spark, SF)
    Q["fix_plan"](spark, SF).count()
    assert before.exceptAll(CAT.fx_table(spark, SF)).count() == 0


def test_mismatch_rows_cover_every_row_of_a_mismatched_file(spark):
    m = Q["mismatches"](spark, SF)
    table = CAT.fx_table(spark, SF)
    files = m.select(F.col("filename").alias("file_name")).distinct()
    assert table.join(files, "file_name").count() == m.count()
