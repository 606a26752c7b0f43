"""Transcript corpora as DataFrames (A1 and the conversation-derived corpus).

A corpus is two DataFrames:

* ``files``  — one row per transcript: ``file_id, file_name, dir, path``;
* ``chunks`` — contiguous runs of raw lines: ``file_id, chunk, lines ARRAY<STRING>``
  (see ``parlance.operators.lines``).

Two sources produce it:

* :func:`text_file_corpus` reads ``*.txt`` files recursively, by byte ranges
  (the original tool's input format);
* :func:`conversation_corpus` turns the ``conversations`` table into labelled
  transcripts without ever concatenating a conversation: every turn becomes
  one chunk whose first raw line carries the speaker label.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F


CHUNK_LINES = 256


@dataclass
class Corpus:
    files: DataFrame
    chunks: DataFrame


# --- conversation-derived transcripts -------------------------------------------------

def _conv_site(conv_id: Column) -> Column:
    return (F.when(conv_id % 6 == 0, "YA").when(conv_id % 6 == 1, "MU").when(conv_id % 6 == 2, "HK")
            .when(conv_id % 6 == 3, "MT").when(conv_id % 6 == 4, "SH").otherwise("ZZ"))


def conversation_file_name(conv_id: Column) -> Column:
    """Transcript file name of a conversation (naming grammar of the original tool:
    network+site, patient id, kind, interview type, day, session, rest)."""
    site = _conv_site(conv_id)
    diary = conv_id % 11 == 0
    return F.concat(
        F.when(conv_id % 2 == 0, "Northnet").otherwise("Southnet"), site, F.lit("_"),
        site, F.substring((F.lit(10000000) + conv_id).cast("string"), 2, 100), F.lit("_"),
        F.when(diary, "diary").otherwise("interviewAudioTranscript"), F.lit("_"),
        F.when(diary, "diary").when(conv_id % 3 == 0, "open").otherwise("psychs"),
        F.lit("_day"), F.substring((F.lit(10001) + conv_id % 90).cast("string"), 2, 100),
        F.lit("_session"), F.substring((F.lit(10001) + conv_id % 3).cast("string"), 2, 100),
        F.lit("_REDACTED.txt"))


def conversation_dir(conv_id: Column) -> Column:
    """Folder of a conversation's transcript: clinical group, then language."""
    group = (F.when(conv_id % 5 == 0, "CHR").when(conv_id % 5 == 1, "hc_group").otherwise("other"))
    lang = (F.when(conv_id % 4 == 3, F.lit("en"))
            .otherwise(F.concat(F.lit("Language."),
                                F.when(conv_id % 4 == 0, "en").when(conv_id % 4 == 1, "de")
                                .otherwise("cn"))))
    return F.concat(F.lit("/fx/"), group, F.lit("/"), lang)


def conversation_files(conversations: DataFrame) -> DataFrame:
    """One row per conversation: ``file_id, file_name, dir, path`` (a distinct on
    ``conv_id`` — partial aggregation, no skew exposure)."""
    ids = conversations.select(F.col("conv_id").alias("file_id")).distinct()
    fid = F.col("file_id")
    return ids.select("file_id", conversation_file_name(fid).alias("file_name"),
                      conversation_dir(fid).alias("dir")).select(
        "*", F.concat("dir", F.lit("/"), "file_name").alias("path"))


def labelled_turn_line(role: Column, turn: Column, text: Column) -> Column:
    """First line of a labelled turn: role label, colon/timestamp variants, text.

    Exercises missing colons (``turn % 3 == 1``) and missing timestamps
    (``turn % 3 == 2``)."""
    label = (F.when(role == "user", "PARTICIPANT").when(role == "assistant", "INTERVIEWER")
             .otherwise("S3"))
    sep = (F.when(turn % 3 == 0, ": 00:").when(turn % 3 == 1, " 00:").otherwise(": "))
    ts = F.when(turn % 3 < 2, F.concat(F.lit("0"), (turn % 10).cast("string"), F.lit(":00.000 "))
                ).otherwise(F.lit(""))
    return F.concat(label, sep, ts, text)


def raw_label_turn_line(conv_id: Column, role: Column, turn: Column, text: Column) -> Column:
    """First line of a turn with raw speaker labels (S1/S2/S3, SI/SP/S9, S0/S1/S2)."""
    g = conv_id % 3
    label = (F.when(g == 0, F.when(role == "user", "S2").when(role == "assistant", "S1").otherwise("S3"))
             .when(g == 1, F.when(role == "user", "SP").when(role == "assistant", "SI").otherwise("S9"))
             .otherwise(F.when(role == "user", "S1").when(role == "assistant", "S0").otherwise("S2")))
    return F.concat(label, F.when(turn % 2 == 0, ": ").otherwise(" "), text)


def conversation_chunks(conversations: DataFrame, style: str = "labelled") -> DataFrame:
    """One chunk per turn: ``file_id, chunk, lines`` (turn order = file order)."""
    c = conversations
    if style == "labelled":
        first = labelled_turn_line(F.col("role"), F.col("turn"), F.col("text"))
    elif style == "raw":
        first = raw_label_turn_line(F.col("conv_id"), F.col("role"), F.col("turn"), F.col("text"))
    else:
        raise ValueError(f"unknown style {style!r}")
    return c.select(F.col("conv_id").alias("file_id"), F.col("turn").alias("chunk"),
                    F.split(first, "\n", -1).alias("lines"))


def conversation_corpus(conversations: DataFrame, style: str = "labelled") -> Corpus:
    return Corpus(conversation_files(conversations), conversation_chunks(conversations, style))


# --- real transcript files (A1) --------------------------------------------------------

def text_file_corpus(spark: SparkSession, root: str, names: DataFrame | None = None, whole_files: bool = False) -> Corpus:
    """A1: every ``*.txt`` under ``root``, read by byte ranges, so that a transcript of any size is many tasks' work.

    A line belongs to the range it begins in; its number in the file is the number of lines in the ranges before (a running
    sum over one row a range) plus its place in its own.  As Python's text mode does, ``\\r\\n`` and ``\\r`` count as line ends:
    a single ``\\r`` within a line cuts it there, and a file that ends with a line end has an empty last line.  The file path is the file's key.

    ``names`` (``file_name``): only the files of these names are opened; they are found in a listing, so the bytes read are those
    of the named files.  ``whole_files`` reads one file a row instead (for many small files).  A file of no bytes (or of a mark alone) is none to Spark.
    """
    listing = _listing(spark, root)
    if names is not None:
        listing = listing.join(names.select("file_name").distinct(), "file_name", "left_semi")
        found = [r["uri"] for r in listing.select("uri").collect()]  # what Spark's own file index holds of them, too
        listing = listing.where(F.lit(bool(found)))
        source = found or None
    else:
        source = root
    path = _path(F.col("uri"))
    files = listing.select(path.alias("file_id"), "file_name", F.regexp_extract(path, "^(.*)/[^/]*$", 1).alias("dir"), path.alias("path"))
    if source is None:
        return Corpus(files, spark.createDataFrame([], "file_id string, chunk bigint, lines array<string>"))
    return Corpus(files, _whole_chunks(spark, source) if whole_files else _range_chunks(spark, source))


def _path(uri: Column) -> Column:
    return F.regexp_replace(uri, "^file:", "")


def _listing(spark: SparkSession, root: str) -> DataFrame:
    """``uri, file_name`` of every ``*.txt``: no content is read."""
    found = spark.read.format("binaryFile").option("recursiveFileLookup", True).option("pathGlobFilter", "*.txt").load(root)
    uri = F.col("_metadata.file_path")
    return found.select(uri.alias("uri"), F.element_at(F.split(uri, "/"), -1).alias("file_name"))


def _text(spark: SparkSession, source, **options) -> DataFrame:
    return spark.read.text(source, recursiveFileLookup=True, pathGlobFilter="*.txt", **options)


def _whole_chunks(spark: SparkSession, source) -> DataFrame:
    raw = _text(spark, source, wholetext=True).select(_path(F.col("_metadata.file_path")).alias("file_id"), "value")
    content = F.regexp_replace("value", "\r\n?", "\n")
    return split_chunks(raw.select("file_id", F.split(content, "\n", -1).alias("all")), "file_id", "all")


def _range_chunks(spark: SparkSession, source) -> DataFrame:
    """A chunk a line (``\\n`` to ``\\n``), numbered in file order."""
    m = F.col("_metadata")
    lines = _text(spark, source, lineSep="\n").select(
        m["file_path"].alias("uri"), m["file_block_start"].alias("block"), m["file_size"].alias("bytes"), F.monotonically_increasing_id().alias("id"), "value")
    ranges = lines.groupBy("uri", "block").agg(F.count(F.lit(1)).alias("n"), F.min("id").alias("first"), F.sum(F.octet_length("value") + 1).alias("held"), F.max("bytes").alias("bytes"))
    ordered = Window.partitionBy("uri").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    of_file = Window.partitionBy("uri")
    placed = ranges.select("uri", "block", "first", F.coalesce(F.sum("n").over(ordered), F.lit(0)).alias("before"),
                           F.sum("n").over(of_file).alias("total"), (F.max("bytes").over(of_file) - F.sum("held").over(of_file)).alias("over"))
    j = lines.join(placed, ["uri", "block"]).select("uri", "value", "over", (F.col("before") + F.col("id") - F.col("first")).alias("chunk"), "total")
    # What the file's size is beyond its lines and their ends tells the two things that a reader of lines drops: a
    # byte order mark (3 bytes) and whether the last line has an end (else the count is one too high).
    marked, ended = F.col("over") >= 2, ~F.col("over").isin(-1, 2)
    text = F.when(marked & (F.col("chunk") == 0), F.concat(F.lit("\ufeff"), F.col("value"))).otherwise(F.col("value"))
    last = F.col("chunk") == F.col("total") - 1
    cut = F.split(F.when(last & ~ended, text).otherwise(F.regexp_replace(text, "\r\\z", "")), "\r", -1)
    pieces = F.when(last & ended, F.concat(cut, F.array(F.lit("")))).otherwise(cut)
    return j.select(_path(F.col("uri")).alias("file_id"), F.col("chunk").cast("bigint").alias("chunk"), pieces.alias("lines"))


def split_chunks(df: DataFrame, key: str, lines_col: str, size: int = CHUNK_LINES) -> DataFrame:
    """Cut a whole file's line array into ``size``-line chunks (row-local, no
    shuffle), so line numbering spreads a very large file over many tasks."""
    n = F.size(lines_col)
    pieces = F.transform(F.sequence(F.lit(0), (F.greatest(n - 1, F.lit(0)) / size).cast("int")),
                         lambda b: F.slice(lines_col, b * size + 1, size))
    return df.select(F.col(key).alias("file_id"), F.posexplode(pieces).alias("chunk", "lines")) \
        .select("file_id", F.col("chunk").cast("bigint").alias("chunk"), "lines")
