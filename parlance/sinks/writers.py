"""Sinks (B4-B13): every output is a table written by Spark in parallel.

The original writes one file per transcript and whole TSV files from one
process.  Here each output is a directory of part files written by the
executors; text tables use the original's TSV/CSV conventions (``''`` for an
empty cell, ``"`` quoting only when needed).  Transcripts are written as line
tables (``file_name, raw_index, raw``) partitioned like the original folder
tree, so no transcript is ever gathered into one row.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from parlance.constants import META_COLUMNS
from parlance.functions.tags import rename_tag, safe_names


def _csv(df: DataFrame, path: str, sep: str, mode: str = "overwrite", partition_by: list[str] | None = None):
    # Python's csv module keeps surrounding spaces; Spark's writer trims them by default
    w = (df.write.mode(mode).option("header", "true").option("sep", sep).option("quote", '"')
         .option("escape", '"').option("emptyValue", "").option("nullValue", "")
         .option("ignoreLeadingWhiteSpace", "false").option("ignoreTrailingWhiteSpace", "false"))
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.csv(path)


def write_feature_table(df: DataFrame, path: str, raw_header: bool = True, mode: str = "overwrite",
                        vocabulary: list[str] | None = None) -> None:
    """The feature table as TSV in the original's column order: metadata, tag
    columns, ``num_sent``, ``word_freq``, ``file_name.txt``.  Feature columns that ``df`` lacks are empty.

    The header shows the original tag names (``1``, ``PART``/``Part``, ``acl:relcl``...);
    some differ only by case, which needs a case-sensitive analyzer for the duration of the write.
    ``raw_header=False`` writes the safe names.
    """
    have = set(df.columns)
    out = df.select(*[F.col(f"`{c}`") if c in have else F.lit("").alias(c) for c in feature_table_columns(vocabulary)])
    out = out.withColumnRenamed("file_name", "file_name.txt")
    if not raw_header:
        _csv(out, path, "\t", mode)
        return
    spark = df.sparkSession
    prev = spark.conf.get("spark.sql.caseSensitive")
    spark.conf.set("spark.sql.caseSensitive", "true")
    try:
        inv = {v: rename_tag(k) for k, v in safe_names(vocabulary).items()}
        renamed = out.select(*[F.col(f"`{c}`").alias(inv.get(c, c)) for c in out.columns])
        _csv(renamed, path, "\t", mode)
    finally:
        spark.conf.set("spark.sql.caseSensitive", prev)


def feature_table_columns(vocabulary: list[str] | None = None) -> list[str]:
    """Column order of a feature table with safe tag names."""
    return META_COLUMNS + list(safe_names(vocabulary).values()) + ["num_sent", "word_freq", "file_name"]


def write_failures(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    """``filename, filepath, language, reason, error_message`` as CSV."""
    _csv(df.select("filename", "filepath", "language", "reason", "error_message"), path, ",", mode)


def write_lexicon(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    """A lexicon as parquet partitioned by language."""
    df.write.mode(mode).partitionBy("lang").parquet(path)


def write_mismatches(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    """Mismatches and parse failures in one CSV table."""
    _csv(df.select("row_index", "filename", "expected", "predicted", "reason"), path, ",", mode)


def write_splits(routed: DataFrame, path: str, unrouted_path: str | None = None, mode: str = "overwrite") -> None:
    """One write partitioned by ``target`` (psychs / open / diary).  Rows without a
    target (unknown types) are failure rows: they go to ``unrouted_path`` with a ``reason``.
    Corrected splits go to a NEW path: a table is never overwritten while it is read."""
    _csv(routed.where(F.col("target").isNotNull()), path, "\t", mode, ["target"])
    if unrouted_path:
        lost = routed.where(F.col("target").isNull()).drop("target").withColumn("reason", F.lit("unknown_type"))
        _csv(lost, unrouted_path, "\t", mode)


def write_transcript_lines(lines: DataFrame, path: str, mode: str = "overwrite") -> None:
    """Transcripts as line tables partitioned like the original
    folder tree (``text_type/language/clinical_group`` or ``target``)."""
    keys = [c for c in ("text_type", "language", "clinical_group", "target") if c in lines.columns]
    lines.write.mode(mode).partitionBy(*keys).parquet(path)


def write_table(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    """Any intermediate as parquet (used to cut lineage between pipeline steps)."""
    df.write.mode(mode).parquet(path)
