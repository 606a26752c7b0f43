"""Word-frequency lexicons and mean log frequency.

Scale notes
* Word streams are pre-aggregated to ``(file, role, word) -> n`` before the
  lexicon join, so the join sees distinct words per file, not occurrences.
* The lexicon join carries no broadcast hint: lexicons built from a corpus
  grow with it.  AQE turns it into a broadcast join at run time when the
  lexicon side is under ``spark.sql.adaptive.autoBroadcastJoinThreshold``
  (the size check) and keeps the shuffle join beyond it.
* Log frequencies are carried as integers scaled by 10^4 (``lg_e4``) so sums
  are exact and order-independent on any number of partitions.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, LongType, StringType, StructField, StructType

from parlance.functions.metadata import is_diary, language_from_path
from parlance.functions.text import pieces, words

LOG_SCALE = 10000

SUBTLEX_SCHEMA = StructType([
    StructField("Word", StringType()), StructField("FREQcount", LongType()),
    StructField("CDcount", LongType()), StructField("FREQlow", LongType()),
    StructField("Cdlow", LongType()), StructField("SUBTLWF", DoubleType()),
    StructField("Lg10WF", DoubleType()), StructField("SUBTLCD", DoubleType()),
    StructField("Lg10CD", DoubleType()),
])
ANC_SCHEMA = StructType([
    StructField("word", StringType()), StructField("lemma", StringType()),
    StructField("pos", StringType()), StructField("count", LongType()),
])
LEXICON_SCHEMA = StructType([
    StructField("word", StringType()), StructField("frequency", DoubleType()),
    StructField("log_frequency", DoubleType()),
])


def scaled_log10(cnt) -> F.Column:
    return F.round(F.log10(cnt) * LOG_SCALE).cast("bigint")


def corpus_word_counts(texts: DataFrame, text_col: str = "text", lang_col: str = "lang") -> DataFrame:
    """``lang, word, cnt`` over whole texts (partial aggregation absorbs hot words); empty pieces go after the explode, in generated code."""
    return (texts.select(F.col(lang_col).alias("lang"), F.explode(pieces(text_col)).alias("word")).where("word != ''")
            .groupBy("lang", "word").agg(F.count(F.lit(1)).alias("cnt")))


def corpus_lexicon(texts: DataFrame, text_col: str = "text", lang_col: str = "lang") -> DataFrame:
    """F5-style lexicon from a text corpus: ``lang, word, cnt, frequency, lg_e4``.

    ``frequency = cnt / total words of the language``; ``lg_e4 = round(log10(cnt) * 1e4)``.
    Every word of every text is in it.  The totals are one map (an entry a
    language) read as a scalar subquery: nothing is joined on the language.
    """
    counts = corpus_word_counts(texts, text_col, lang_col).where(F.col("lang").isNotNull())
    totals = (counts.groupBy("lang").agg(F.sum("cnt").alias("total"))
              .agg(F.map_from_entries(F.collect_list(F.struct("lang", "total")))).scalar())
    return counts.select(
        "lang", "word", "cnt",
        (F.col("cnt").cast("double") / F.element_at(totals, F.col("lang")).cast("double")).alias("frequency"),
        scaled_log10(F.col("cnt")).alias("lg_e4"))


def subtlex_lexicon(subtlex: DataFrame, lang: str | None = None, order_col: str | None = None) -> DataFrame:
    """``word = lower(Word)``, ``frequency = FREQcount / sum(FREQcount)``,
    ``log_frequency = Lg10WF``.  The total is a scalar subquery (partial sums,
    then one value inlined into the projection — no join).  ``order_col`` (the
    file order of the rows) is kept as ``_order`` for F7's last-row-wins."""
    total = subtlex.agg(F.sum("FREQcount")).scalar()
    keep = [F.col(order_col).alias("_order")] if order_col else []
    out = subtlex.select(
        F.lower("Word").alias("word"),
        (F.col("FREQcount").cast("double") / total.cast("double")).alias("frequency"),
        F.col("Lg10WF").alias("log_frequency"), *keep)
    return out.withColumn("lang", F.lit(lang)) if lang else out


def anc_lexicon(anc: DataFrame) -> DataFrame:
    """``frequency = count / sum(count)`` (the total as a scalar subquery)."""
    total = anc.agg(F.sum("count")).scalar()
    return anc.select("word", "lemma", "pos", "count",
                      (F.col("count").cast("double") / total.cast("double")).alias("frequency"))


def lexicon_dictionary(lexicon: DataFrame, order_col: str, use_log: bool = True,
                       keys: tuple[str, ...] = ("lang",)) -> DataFrame:
    """after lower-casing, the LAST row (by ``order_col``) per word wins.

    Output ``*keys, word, value``.  ``max_by`` is an ordinary aggregate, so it
    combines map-side and never gathers one word's rows in one place.
    """
    val = "log_frequency" if use_log else "frequency"
    k = [c for c in keys if c in lexicon.columns]
    return (lexicon.where(F.col(val).isNotNull())   # a NULL value would break the mean
            .groupBy(*k, F.lower("word").alias("word"))
            .agg(F.max_by(F.col(val), F.col(order_col)).alias("value")))


def role_word_counts(lines: DataFrame, files: DataFrame, diary_mode: str = "path",
                     languages: DataFrame | None = None) -> DataFrame:
    """``file_id, speaker_role, lang, word, n``.

    ``languages`` (``file_id, lang``) gives the language of each file, and only its files
    are counted; without it the language is that of the folder.

    For each of PARTICIPANT / INTERVIEWER, the words of that speaker's lines, or
    of all lines when the file has none for the role.  Diaries give only the
    participant unit (over all lines).  Word occurrences are counted per
    ``(file, speaker, word)`` before anything is joined.
    """
    per_speaker = (lines.select("file_id", "speaker", F.explode(words("text")).alias("word"))
                   .groupBy("file_id", "speaker", "word").agg(F.count(F.lit(1)).alias("n")))
    presence = lines.groupBy("file_id").agg(
        F.max((F.col("speaker") == "PARTICIPANT").cast("int")).alias("has_p"),
        F.max((F.col("speaker") == "INTERVIEWER").cast("int")).alias("has_i"))
    meta = files.select("file_id", language_from_path("path").alias("lang"),
                        is_diary("path", diary_mode).alias("diary")).join(presence, "file_id")
    if languages is not None:
        meta = meta.drop("lang").join(languages.select("file_id", "lang"), "file_id")
    joined = per_speaker.join(meta, "file_id")
    to_p = (F.col("speaker") == "PARTICIPANT") | (F.col("has_p") == 0) | F.col("diary")
    to_i = ((F.col("speaker") == "INTERVIEWER") | (F.col("has_i") == 0)) & ~F.col("diary")
    roles = F.filter(F.array(F.when(to_p, F.lit("Participant")), F.when(to_i, F.lit("Interviewer"))),
                     lambda r: r.isNotNull())
    return (joined.select("file_id", "lang", "word", "n", F.explode(roles).alias("speaker_role"))
            .groupBy("file_id", "speaker_role", "lang", "word").agg(F.sum("n").alias("n")))


def mean_log_frequency(units: DataFrame, lexicon: DataFrame) -> DataFrame:
    """E5 + F4: per ``(file_id, speaker_role, lang)``: words, found, missing, the
    mean log frequency over found occurrences (NULL if none found), coverage %.

    ``lexicon``: ``lang, word`` and either ``lg_e4`` (integer-scaled log10: exact,
    order-independent sums) or ``log_frequency`` (a double, e.g. SUBTLEX Lg10WF).
    """
    scaled = "lg_e4" in lexicon.columns
    val = "lg_e4" if scaled else "log_frequency"
    j = units.join(lexicon.select("lang", "word", F.col(val).alias("_v")), ["lang", "word"], "left")
    found = F.when(F.col("_v").isNotNull(), F.col("n")).otherwise(F.lit(0))
    agg = j.groupBy("file_id", "speaker_role", "lang").agg(
        F.sum("n").alias("n_words"), F.sum(found).alias("found"),
        F.sum(F.col("n") * F.col("_v")).alias("_s"))
    denom = (F.col("found") * LOG_SCALE) if scaled else F.col("found")
    return agg.select(
        "file_id", "speaker_role", "lang", "n_words", "found",
        (F.col("n_words") - F.col("found")).alias("missing"),
        F.when(F.col("found") > 0, F.col("_s").cast("double") / denom.cast("double")).alias("word_freq"),
        F.try_divide((F.col("found") * 100).cast("double"), F.col("n_words").cast("double"))
        .alias("coverage"))
