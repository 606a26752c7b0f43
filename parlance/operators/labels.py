"""Speaker-label operators over raw lines.

Every rule of the original is a line-anchored regex applied to a whole file,
so each becomes a per-line expression over ``raw_lines`` plus, where a file-wide
fact is needed (the set of labels, the first label), an ordinary aggregate —
partial aggregation keeps a large file from landing on one task.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from parlance.functions.text import fix_missing_colon, leading_label, relabel_line, role_label_present

SIMPLE_LABELS = ["S1", "S2", "S3"]


def colon_fixes(raw: DataFrame) -> DataFrame:
    """``file_id, raw_index, raw, fixed, changed`` for every raw line."""
    fixed = fix_missing_colon("raw", F.col("is_last"))
    return raw.select("file_id", "raw_index", "raw", fixed.alias("fixed"),
                      (fixed != F.col("raw")).alias("changed"))


def colon_fix_counts(raw: DataFrame) -> DataFrame:
    """C11 per file: ``file_id, n_fixes``."""
    return (colon_fixes(raw).groupBy("file_id")
            .agg(F.count_if("changed").cast("bigint").alias("n_fixes")))


def cleaning_summary(raw: DataFrame) -> DataFrame:
    """files scanned, files needing a fix, total fixes (one row)."""
    per_file = colon_fix_counts(raw)
    return per_file.agg(F.count(F.lit(1)).alias("files_scanned"),
                        F.count_if(F.col("n_fixes") > 0).cast("bigint").alias("files_modified"),
                        F.coalesce(F.sum("n_fixes"), F.lit(0)).cast("bigint").alias("total_fixes"))


def line_labels(raw: DataFrame) -> DataFrame:
    """``file_id, raw_index, raw, is_last, label`` (``''`` when the line has none)."""
    return raw.select("file_id", "raw_index", "raw", "is_last", *_place(raw),
                      leading_label("raw", F.col("is_last")).alias("label"))


def _place(df: DataFrame) -> list[str]:
    return [c for c in ("char_offset",) if c in df.columns]


def distinct_labels(labelled: DataFrame) -> DataFrame:
    """distinct speaker labels per file (``file_id, label``)."""
    return labelled.where(F.col("label") != "").select("file_id", "label").distinct()


def label_mapping(labelled: DataFrame) -> DataFrame:
    """``file_id, original, normalized`` for files whose labels are not all
    in S1-S3; the three smallest labels (code-point order) become S1, S2, S3.

    Files needing no normalisation produce no rows (an empty mapping).  The
    ranking window runs over the *distinct* labels of one file only.
    """
    labs = distinct_labels(labelled)
    by_file = Window.partitionBy("file_id")
    ranked = labs.select(
        "file_id", "label", F.row_number().over(by_file.orderBy("label")).alias("rk"),
        F.max((~F.col("label").isin(*SIMPLE_LABELS)).cast("int")).over(by_file).alias("needs"))
    return ranked.where((F.col("needs") == 1) & (F.col("rk") <= 3)).select(
        "file_id", F.col("label").alias("original"),
        F.concat(F.lit("S"), F.col("rk").cast("string")).alias("normalized"))


def normalize_labels(labelled: DataFrame, mapping: DataFrame) -> DataFrame:
    """C12 rewrite: lines whose label is mapped become ``Sn:`` (simultaneous mapping).

    Output ``file_id, raw_index, raw, is_last, label, norm_label`` where ``raw`` is rewritten.
    """
    m = mapping.select("file_id", F.col("original").alias("label"), "normalized")
    j = labelled.join(m, ["file_id", "label"], "left")
    new_raw = F.when(F.col("normalized").isNotNull(), relabel_line("raw", "label", "normalized")) \
        .otherwise(F.col("raw"))
    return j.select("file_id", "raw_index", new_raw.alias("raw"), "is_last", *_place(labelled), "label",
                    F.coalesce("normalized", "label").alias("norm_label"))


def apply_roles(labelled: DataFrame, roles: DataFrame) -> DataFrame:
    """Per file, lines opening with an original label that has a role are
    rewritten to ``ROLE:``.  ``roles``: ``file_id, original, role`` (files to skip —
    diaries, unclassified — simply have no rows).

    Output ``file_id, raw_index, raw, changed``.
    """
    r = roles.select("file_id", F.col("original").alias("label"), "role")
    j = labelled.join(r, ["file_id", "label"], "left")
    new_raw = F.when(F.col("role").isNotNull(), relabel_line("raw", "label", "role")).otherwise(F.col("raw"))
    return j.select("file_id", "raw_index", new_raw.alias("raw"), F.col("role").isNotNull().alias("changed"))


def original_labels(raw: DataFrame) -> DataFrame:
    """C14: ``file_id, participant_label, interviewer_label``.

    PARTICIPANT / INTERVIEWER when such a line exists; if neither exists, the
    first ``S…`` label becomes the participant label.
    """
    lab = leading_label("raw", F.col("is_last"))
    agg = raw.groupBy("file_id").agg(
        F.max(role_label_present("raw", "PARTICIPANT", F.col("is_last")).cast("int")).alias("has_p"),
        F.max(role_label_present("raw", "INTERVIEWER", F.col("is_last")).cast("int")).alias("has_i"),
        F.min_by(F.when(lab != "", lab), F.when(lab != "", F.col("raw_index"))).alias("first_label"))
    neither = (F.col("has_p") == 0) & (F.col("has_i") == 0)
    return agg.select(
        "file_id",
        F.when(F.col("has_p") == 1, F.lit("PARTICIPANT")).when(neither, F.col("first_label"))
        .alias("participant_label"),
        F.when(F.col("has_i") == 1, F.lit("INTERVIEWER")).alias("interviewer_label"))
