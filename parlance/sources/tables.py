"""Driver-table and feature-table sources (A2-A10).

Reads use explicit schemas (no inference).  Parquet scans get column
pruning and filter pushdown from Catalyst.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StringType, StructField, StructType

from parlance.sources import delimited


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A driver table (parquet), dealt out over the cores where it comes in few splits (see :func:`dealt_out`)."""
    return dealt_out(spark.read.parquet(f"{sf_dir}/{name}.parquet"))


#: Splits up to which a table is dealt out by rows: that many splits hold little (1 GB at Spark's default size).
FEW_SPLITS = 8


def dealt_out(df: DataFrame) -> DataFrame:
    """``df`` as it is, or, if its scan has fewer than ``FEW_SPLITS`` splits and the session more cores, dealt out evenly by one exchange.

    A file of one row group is one task's work however many splits it is cut into, and what follows a scan here (cutting texts into words) costs
    far more than moving its rows; the columns are pruned below the exchange.
    """
    cores = df.sparkSession.sparkContext.defaultParallelism
    few = df.rdd.getNumPartitions() < min(FEW_SPLITS, cores)
    return df.repartition(cores) if few else df


def sep_for(path: str, sep: str | None = None) -> str:
    """A3: explicit separator, else tab for ``.tsv``, else comma."""
    if sep:
        return sep
    return "\t" if path.lower().endswith(".tsv") else ","


def read_feature_table(spark: SparkSession, path: str, columns: list[str], sep: str | None = None) -> DataFrame:
    """A2 + G7: a header-ed feature table, every cell text (``''`` for empty), plus ``row_index``, consecutive in table order
    (part files by name, then place).  Files are divided among tasks, also where cells hold line breaks
    (``parlance.sources.delimited``).

    ``columns`` are the header's names; Spark cannot hold two columns whose
    names differ only by case, so callers pass safe names (see
    ``parlance.functions.tags.safe_names``) and the header row is skipped.
    """
    return delimited.rows(spark, path, sep_for(path, sep), columns)


def _empty_as_null(df: DataFrame) -> DataFrame:
    return df.select("row_index", *[F.nullif(F.col(f"`{c}`"), F.lit("")).alias(c) for c in df.columns if c != "row_index"])


def read_status(spark: SparkSession, path: str) -> DataFrame:
    """A4: clinical-status CSV (``patient_id, clinical_status`` required) with
    its row position in table order, for last-row-wins deduplication (``status_table``)."""
    found = delimited.rows(spark, path, ",", wanted=["patient_id", "clinical_status"])
    return _empty_as_null(found).withColumnRenamed("row_index", "row_pos")


def read_vocab(spark: SparkSession, path: str) -> DataFrame:
    """A5: one tag per line -> ``pos, tag`` (blank lines dropped, repeats kept;
    ``dropDuplicates`` on ``tag`` keeping the smallest ``pos`` gives the tally vocabulary)."""
    df = spark.read.text(path)
    return (df.select(F.monotonically_increasing_id().alias("pos"), F.regexp_replace("value", "\n$", "").alias("tag"))
            .where(F.trim("tag") != ""))


def _by_name(spark: SparkSession, path: str, schema: StructType, wanted: list[str]) -> DataFrame:
    """A CSV with a header, its columns found by name in any order; a missing one fails, others are ignored.

    Every cell is read as text and then cast; ``row_index`` is the row's place in the table.
    """
    types = {f.name: f.dataType for f in schema.fields}
    found = delimited.rows(spark, path, ",", wanted=wanted)
    return found.select(*[F.nullif(F.col(f"`{c}`"), F.lit("")).try_cast(types[c]).alias(c) for c in wanted], "row_index")


def read_subtlex(spark: SparkSession, path: str) -> DataFrame:
    """SUBTLEX CSV; ``Word, FREQcount, Lg10WF`` by name, and the row's place ``row_index``."""
    from parlance.operators.frequency import SUBTLEX_SCHEMA
    return _by_name(spark, path, SUBTLEX_SCHEMA, ["Word", "FREQcount", "Lg10WF"])


def read_anc(spark: SparkSession, path: str) -> DataFrame:
    """Headerless ANC TSV ``word, lemma, pos, count``."""
    from parlance.operators.frequency import ANC_SCHEMA
    return spark.read.option("sep", "\t").schema(ANC_SCHEMA).csv(path)


def read_lexicon(spark: SparkSession, path: str) -> DataFrame:
    """Saved lexicon ``word, frequency, log_frequency`` (CSV or parquet)."""
    from parlance.operators.frequency import LEXICON_SCHEMA
    if path.endswith(".parquet"):
        return spark.read.parquet(path)
    return _by_name(spark, path, LEXICON_SCHEMA, ["word", "frequency", "log_frequency"]).drop("row_index")


def read_tag_lexicon(spark: SparkSession, path: str) -> DataFrame:
    """A tag lexicon (parquet): ``lang, word, frequency, lemma, upos, xpos, deprel, feats``, one row a word."""
    return spark.read.parquet(path).select("lang", "word", "frequency", "lemma", "upos", "xpos", "deprel", "feats")


def lexicon_paths(langs: list[str], corpus_dir: str) -> dict[str, str]:
    """Language code -> corpus file.  An unknown code stops the run here, a missing file when Spark
    reads it (from whatever store the path names)."""
    from parlance.constants import CORPUS_FILES
    unknown = [c for c in langs if c not in CORPUS_FILES]
    if unknown:
        raise ValueError(f"languages without a registered corpus: {', '.join(unknown)}")
    return {c: f"{corpus_dir.rstrip('/')}/{CORPUS_FILES[c]}" for c in langs}


def read_lexicons(spark: SparkSession, langs: list[str], corpus_dir: str) -> DataFrame:
    """A9 + A6 + F5: union of per-language SUBTLEX lexicons with a ``lang`` column."""
    from parlance.operators.frequency import subtlex_lexicon
    paths = lexicon_paths(langs, corpus_dir)
    out = None
    for code, p in paths.items():
        df = subtlex_lexicon(read_subtlex(spark, p), code)
        out = df if out is None else out.unionByName(df)
    return out


MISMATCH_SCHEMA = StructType([
    StructField("row_index", LongType()), StructField("filename", StringType()),
    StructField("expected", StringType()), StructField("predicted", StringType()),
    StructField("reason", StringType()),
])


def read_mismatches(spark: SparkSession, path: str) -> DataFrame:
    """A10 + D-9: the 5-column mismatch CSV without parse failures."""
    cells = delimited.rows(spark, path, ",", ["_place", *[f.name for f in MISMATCH_SCHEMA.fields[1:]]]).drop("row_index")
    df = cells.select(F.col("_place").cast("long").alias("row_index"), *[F.nullif(F.col(f.name), F.lit("")).alias(f.name) for f in MISMATCH_SCHEMA.fields[1:]])
    return df.where(F.col("predicted") != "PARSE_FAILURE")


def safe_header(names: list[str]) -> list[str]:
    """Map a feature-table header (the original's raw names) to column names
    Spark can hold: tag names to their safe names (``PART``/``Part``,
    ``acl:relcl``, ``PRP$``...), ``file_name.txt`` to ``file_name``, and any
    name repeated (case-insensitively) suffixed ``__2``, ``__3``."""
    from parlance.constants import TAG_RENAMES
    from parlance.functions.tags import safe_names
    tags = safe_names()
    by_header = {TAG_RENAMES.get(t, t): n for t, n in tags.items()}   # header shows renamed tags
    by_header.update({t: n for t, n in tags.items() if t not in by_header})
    out, seen = [], {}
    for h in names:
        n = "file_name" if h == "file_name.txt" else by_header.get(h, h)
        k = n.lower()
        seen[k] = seen.get(k, 0) + 1
        out.append(n if seen[k] == 1 else f"{n}__{seen[k]}")
    return out


def read_feature_table_auto(spark: SparkSession, path: str, sep: str | None = None) -> DataFrame:
    """A2 for a table written by the original tool or by ``write_feature_table``:
    the header line alone is read (one row from the first split) to name the
    columns, then the table is read with that schema, every cell as text."""
    s = sep_for(path, sep)
    return read_feature_table(spark, path, safe_header(delimited.header(spark, path, s)), sep=s)
