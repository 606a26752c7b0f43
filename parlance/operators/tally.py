"""Tagging units, annotation, tag tallies and sentence counts.

Scale notes
* Tallies stay **long** — ``(file, role, tag) -> cnt`` — so the shuffle carries
  only non-zero counts; the 14-slot explode is filtered to the vocabulary
  *before* the aggregate and combined map-side.
* The wide (pivoted) form is produced once, at the sink, from the long form,
  with the value list given (no extra job to discover pivot values).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StringType, StructField, StructType

from parlance.functions.metadata import is_diary, language_from_path, tagger_language
from parlance.functions.tags import safe_names, token_slots, vocab
from parlance.functions.text import is_blank, sentences, words
from parlance.operators.affinity import by_language
from parlance.operators.models import Predictor

TOKEN_FIELDS = StructType([   # of a plug-in's rows, after file_id (of the corpus's own key type) and speaker_role
    StructField("line_index", LongType()),
    StructField("sent_id", LongType()), StructField("word_id", LongType()),
    StructField("word", StringType()), StructField("lemma", StringType()),
    StructField("upos", StringType()), StructField("xpos", StringType()),
    StructField("deprel", StringType()), StructField("feats", StringType()),
])


def tagging_units(lines: DataFrame, files: DataFrame, diary_mode: str = "path") -> DataFrame:
    """J6 + D-4: non-blank lines with the role unit they belong to.

    Participant lines -> Participant, interviewer lines -> Interviewer; in a
    diary every line -> Participant (no interviewer unit).  Output
    ``file_id, speaker_role, line_index, text``.
    """
    meta = files.select("file_id", is_diary("path", diary_mode).alias("diary"))
    j = lines.where(~is_blank("text")).join(meta, "file_id")
    role = (F.when(F.col("diary"), F.lit("Participant"))
            .when(F.col("speaker") == "PARTICIPANT", F.lit("Participant"))
            .when(F.col("speaker") == "INTERVIEWER", F.lit("Interviewer")))
    return j.select("file_id", role.alias("speaker_role"), "line_index", "text") \
        .where(F.col("speaker_role").isNotNull())


def dictionary_annotate(units: DataFrame, tags: DataFrame) -> DataFrame:
    """K2 without a model: sentence pieces split on ``.!?``, words as in C21, their tags looked up in
    ``tags`` (``lang, word, lemma, upos, xpos, deprel, feats``, one row a word; see ``read_tag_lexicon``).  A word that is not listed is
    its own lemma with ``upos`` X and no other tag.  Where counts are all that is asked for, ``units.unit_stream`` needs no row a token.

    Output: the unit columns plus ``sent_id, word_id, word, lemma, upos, xpos, deprel, feats``.
    """
    s = units.select("*", F.posexplode(sentences("text")).alias("_sp", "_piece"))
    w = s.select("*", F.posexplode(words("_piece")).alias("_wp", "word")).drop("text", "_piece")
    j = w.join(tags.select("lang", "word", "lemma", "upos", "xpos", "deprel", "feats"), ["lang", "word"], "left")
    return j.select(
        *[c for c in units.columns if c not in ("text", "lang")],
        (F.col("_sp") + 1).cast("bigint").alias("sent_id"), (F.col("_wp") + 1).cast("bigint").alias("word_id"),
        "word", F.coalesce("lemma", "word").alias("lemma"),
        F.coalesce("upos", F.lit("X")).alias("upos"), "xpos", "deprel", "feats")


def annotate(units: DataFrame, predict: Predictor | None = None, tags: DataFrame | None = None) -> DataFrame:
    """One row per token, by the tagger plug-in ``predict`` or the tag lexicon ``tags``
    (:func:`dictionary_annotate`); units carry ``lang``.  ``predict`` receives pandas batches of
    ``file_id, speaker_role, line_index, text, lang`` and yields token rows
    (``file_id, speaker_role`` and ``TOKEN_FIELDS``).  A task has units of one language (``affinity.by_language``): it loads one model
    (which a plug-in keeps between its batches), while a dominant language, or a
    single huge transcript, gets tasks by its share of all words.

    An exception in the plug-in does not end the job: the batch is tried again file by file, and
    a file that fails gives one row a role with the message in ``error`` (see ``failures``).
    """
    if predict is None:
        if tags is None:
            raise ValueError("tagging needs a tagger plug-in or a tag lexicon")
        return dictionary_annotate(units, tags)
    parts = int(units.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    keyed = by_language(units, parts)
    schema = StructType([units.schema["file_id"], StructField("speaker_role", StringType()), *TOKEN_FIELDS.fields, StructField("error", StringType())])
    names = [f.name for f in schema.fields]

    def run(frames):
        import pandas as pd

        def tokens(frame):
            return [out.assign(error=None)[names].astype(object) for out in predict(iter([frame]))]

        for frame in frames:
            try:
                yield from tokens(frame)
            except Exception:
                for _, one in frame.groupby(["file_id", "speaker_role"], sort=False):
                    one = one.reset_index(drop=True)
                    try:
                        yield from tokens(one)
                    except Exception as e:
                        row = {"file_id": one["file_id"][0], "speaker_role": one["speaker_role"][0], "error": str(e)}
                        yield pd.DataFrame([[row.get(n) for n in names]], columns=names, dtype=object)

    return keyed.mapInPandas(run, schema)


def without_errors(tokens: DataFrame) -> DataFrame:
    """Tokens of the units the tagger got through whole."""
    if "error" not in tokens.columns:
        return tokens
    bad = tokens.where(F.col("error").isNotNull()).select("file_id", "speaker_role").distinct()
    return tokens.join(bad, ["file_id", "speaker_role"], "left_anti")


SENT, WORD = "#sent", "#word"    # pseudo-tags; '#' never occurs in the vocabulary


def unit_counts(tokens: DataFrame, vocabulary: list[str] | None = None) -> DataFrame:
    """One aggregation for F1 and F3: ``file_id, speaker_role, tag, cnt`` where
    ``tag`` is a vocabulary tag (F1 + E6: every vocabulary value in the 14
    non-lemma slots of every token; equal values in two slots count twice), or
    ``#sent`` (tokens opening a sentence, ``word_id = 1``: one per sentence) or
    ``#word`` (every token).  The 14-slot explode is filtered to the vocabulary
    before the shuffle and combined map-side.  ``vocabulary``: a caller's own
    tag list (see ``read_vocab``) in place of the built-in one."""
    keep = (vocabulary or vocab()) + [SENT, WORD]
    tags = F.concat(token_slots(), F.array(F.when(F.col("word_id") == 1, F.lit(SENT)), F.lit(WORD)))
    return (tokens.select("file_id", "speaker_role", F.explode(tags).alias("tag"))
            .where(F.col("tag").isin(*keep))                  # InSet: a hash lookup, before the shuffle
            .groupBy("file_id", "speaker_role", "tag").agg(F.count(F.lit(1)).alias("cnt")))


def tally_and_sentences(counts: DataFrame) -> tuple[DataFrame, DataFrame]:
    """``(tally, sentences)`` from :func:`unit_counts` — both read the same
    aggregate, so the token pipeline runs once."""
    tally = counts.where(~F.col("tag").startswith("#"))
    sent = counts.where(F.col("tag").startswith("#")).groupBy("file_id", "speaker_role").agg(
        F.sum(F.when(F.col("tag") == SENT, F.col("cnt")).otherwise(0)).alias("num_sent"),
        F.sum(F.when(F.col("tag") == WORD, F.col("cnt")).otherwise(0)).alias("num_words"))
    return tally, sent


def tag_tally(tokens: DataFrame) -> DataFrame:
    """F1 + E6: ``file_id, speaker_role, tag, cnt`` (vocabulary tags only)."""
    return tally_and_sentences(unit_counts(tokens))[0]


def sentence_counts(tokens: DataFrame) -> DataFrame:
    """``file_id, speaker_role, num_sent, num_words`` (a sentence is counted
    by its first token, ``word_id = 1``, as taggers number words per sentence)."""
    return tally_and_sentences(unit_counts(tokens))[1]


def tally_wide(tally: DataFrame, keys: tuple[str, ...] = ("file_id", "speaker_role"),
               vocabulary: list[str] | None = None) -> DataFrame:
    """one row per unit, one zero-filled column per vocabulary tag (safe names).

    Given ``unit_counts`` with their pseudo-tags, a unit without any vocabulary tag has a row of zeros.
    The long rows of a unit (at most one per vocabulary tag and two pseudo-tags) are
    gathered into a ``tag -> cnt`` map and the columns are map lookups: a small
    aggregate instead of a 102-way pivot aggregate (which outgrows the
    generated-code size limit and falls back to interpreted execution).
    """
    names = safe_names(vocabulary)
    per_unit = tally.groupBy(*keys).agg(
        F.map_from_entries(F.collect_list(F.struct("tag", "cnt"))).alias("_m"))
    # one selectExpr call instead of ~5 client calls per column
    cols = [f"CAST(coalesce(_m['{t}'], 0) AS BIGINT) AS `{n}`" for t, n in names.items()]
    return per_unit.selectExpr(*[f"`{k}`" for k in keys], *cols)


def tagging_languages(files: DataFrame) -> DataFrame:
    """Tagger language per file from its folder (C4 -> C25): ``file_id, language, tagger``."""
    lang = language_from_path("path")
    return files.select("file_id", lang.alias("language"), tagger_language(lang).alias("tagger"))


def failures(files: DataFrame, langs: DataFrame, produced: DataFrame, diary_mode: str = "path",
             roles: tuple[str, ...] = ("Participant", "Interviewer"), errors: DataFrame | None = None) -> DataFrame:
    """F13 + H4: ``filename, filepath, language, reason, error_message``.

    * ``unknown_language`` — no language at all (NULL);
    * ``unsupported_language`` — a language the tagger lacks (incl. UNKNOWN);
    * ``no_lines`` — a role unit without lines (interviews only for interviewers);
    * ``processing_error`` — the tagger plug-in failed on the unit;
    * ``empty_output`` — lines but no sentence / word produced.

    ``langs``: ``file_id, language, tagger`` (e.g. :func:`tagging_languages`); ``produced``: ``file_id, speaker_role, num_words``, a row
    for each unit with lines (see ``units.unit_lines``); ``errors``: ``file_id, speaker_role, error`` of units a plug-in failed on.
    """
    fl = files.join(langs.select("file_id", "language", "tagger"), "file_id")
    lang_fail = fl.where(F.col("tagger").isNull()).select(
        F.col("file_name").alias("filename"), F.col("path").alias("filepath"),
        F.coalesce("language", F.lit("UNKNOWN")).alias("language"),
        F.when(F.col("language").isNull(), "unknown_language").otherwise("unsupported_language").alias("reason"),
        F.when(F.col("language").isNull(), F.lit("Transcript language could not be determined"))
        .otherwise(F.concat(F.lit("Language '"), F.col("language"), F.lit("' is not supported by the tagger")))
        .alias("error_message"))
    ok = fl.where(F.col("tagger").isNotNull())
    unit_roles = F.when(is_diary("path", diary_mode), F.array(F.lit("Participant"))) \
        .otherwise(F.array(F.lit("Participant"), F.lit("Interviewer")))
    expected = ok.select("file_id", "file_name", "path", "tagger", F.explode(unit_roles).alias("speaker_role")) \
        .where(F.col("speaker_role").isin(*roles))
    st = expected.join(produced.select("file_id", "speaker_role", "num_words"), ["file_id", "speaker_role"], "left")
    st = st.withColumn("error", F.lit(None).cast("string")) if errors is None else st.join(errors, ["file_id", "speaker_role"], "left")
    reason = (F.when(F.col("num_words").isNull(), F.lit("no_lines"))
              .when(F.col("error").isNotNull(), F.lit("processing_error"))
              .when(F.col("num_words") == 0, F.lit("empty_output")))
    msg = (F.when(F.col("num_words").isNull(),
                  F.concat(F.lit("No "), F.lower("speaker_role"), F.lit(" lines found")))
           .when(F.col("error").isNotNull(), F.col("error"))
           .otherwise(F.lit("Extracted 0 sentences and 0 words")))
    unit_fail = st.where(reason.isNotNull()).select(
        F.col("file_name").alias("filename"), F.col("path").alias("filepath"),
        F.col("tagger").alias("language"), reason.alias("reason"), msg.alias("error_message"))
    return lang_fail.unionByName(unit_fail)
