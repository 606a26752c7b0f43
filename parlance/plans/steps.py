"""The original tool's four steps and its stand-alone helpers, as Spark jobs.

Each step composes operators, writes its sinks and returns the main
DataFrames.  Model output (predictor results) is checkpointed to the shared
folder named by ``spark.checkpoint.dir`` before it feeds several sinks, so a
model never runs twice and lineage is cut where it is expensive.
"""

from __future__ import annotations

import os
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from parlance.functions import metadata as M
from parlance.functions.tags import listed
from parlance.operators import feature_table as FT
from parlance.operators import frequency as FQ
from parlance.operators import labels as LB
from parlance.operators import lines as L
from parlance.operators import models as MD
from parlance.operators import tally as T
from parlance.operators import units as U
from parlance.operators import verify as V
from parlance.session import persisted as _persist
from parlance.sinks import versions as TV
from parlance.sinks import writers as W
from parlance.sources.corpus import Corpus


def corpus_from_lines(lines: DataFrame, key: str = "file_id") -> Corpus:
    """A corpus from a written line table (``file_id, file_name, path, raw_index, raw``):
    one chunk per line; ordinals are recomputed by the block prefix sum."""
    files = lines.select(key, "file_name", "path").distinct().select(
        F.col(key).alias("file_id"), "file_name", F.regexp_extract("path", "^(.*)/[^/]*$", 1).alias("dir"), "path")
    chunks = lines.select(F.col(key).alias("file_id"), F.col("raw_index").alias("chunk"),
                          F.array("raw").alias("lines"))
    return Corpus(files, chunks)


# --- L0: organize, label, initialise ----------------------------------------------------------

@dataclass
class Organized:
    lines: DataFrame        # relabelled raw lines with folder keys
    table: DataFrame        # preliminary feature table
    languages: DataFrame


def organize(spark: SparkSession, corpus: Corpus, out_dir: str, documents: DataFrame | None,
             text_type: str = "interviews", status: DataFrame | None = None,
             predict_roles=None, skip_labeling: bool = False, predict_language=None, role_answers=None) -> Organized:
    """L0: metadata (C1-C3, E1), language (K1 -> C23 -> C24), roles (K3 -> C16),
    relabelled transcripts (C13 -> B9) and the preliminary table (B3 -> B4).
    Interviews and diaries (D-1) flow through one plan: diaries keep their
    labels, are not sent to the role model and get one table row (H2 is a ``when``, not
    a union).  ``documents`` (``text, lang``) serves the built-in language detector; a
    plug-in goes into ``predict_language``.  ``role_answers`` is a table or ``Ledger`` of role answers."""
    raw = L.raw_lines(corpus.chunks)
    lines = L.parse_lines(raw)
    lexicon = None if predict_language else _persist(FQ.corpus_lexicon(documents))
    det = MD.detect_languages(lines, lexicon, predict_language)
    sites = corpus.files.select("file_id", M.site_code("file_name").alias("site"))
    langs = corpus.files.select("file_id").join(MD.resolve_languages(det, sites), "file_id", "left") \
        .select("file_id", F.coalesce("language", F.lit("UNKNOWN")).alias("language"))
    langs = _persist(langs)
    groups = FT.clinical_groups(corpus.files, status)
    interviews = corpus.files.where(~M.is_diary("path")).select("file_id")
    if skip_labeling:
        roles = spark.createDataFrame([], "file_id " + corpus.files.schema["file_id"].dataType.simpleString()
                                      + ", original string, role string")
    else:
        _, roles = MD.classify_roles(raw.join(interviews, "file_id", "left_semi"), predict_roles, answers=role_answers)
        roles = _persist(roles)
    relabelled = LB.apply_roles(LB.line_labels(raw), roles)
    keyed = (relabelled.join(corpus.files.select("file_id", "file_name", "path"), "file_id")
             .join(langs, "file_id").join(groups.select("file_id", "clinical_group"), "file_id")
             .select("file_id", "file_name", "path", "raw_index", "raw", F.lit(text_type).alias("text_type"),
                     "language", "clinical_group"))
    W.write_transcript_lines(keyed, os.path.join(out_dir, "transcripts"))
    meta = FT.file_metadata(corpus.files, langs)
    table = FT.init_table(meta, roles, LB.original_labels(raw))
    W.write_feature_table(FT.empty_features(table), os.path.join(out_dir, "preliminary_tsv"))
    return Organized(keyed, table, langs)


# --- L1: tag ------------------------------------------------------------------------------------

@dataclass
class Tagged:
    table: DataFrame
    failures: DataFrame


def tag(spark: SparkSession, corpus: Corpus, out_dir: str, lexicon: DataFrame | None = None,
        table: DataFrame | None = None, languages: DataFrame | None = None, predict_tokens=None,
        clean: bool = True, roles: tuple[str, ...] = ("Participant", "Interviewer"),
        first_per_language: int | None = None, language_lexicon: DataFrame | None = None,
        predict_language=None, vocabulary: list[str] | DataFrame | None = None, tags: DataFrame | None = None) -> Tagged:
    """Colon fix (C11), units (J6), tags (K2), tallies (F1-F3) and
    word frequency (J2 -> E5 -> F4), all from one stream (``parlance.operators.units``), then fill ``table`` (E7, update mode) or
    build a new table (E8); failure log (F13).  ``roles=("Participant",)`` is the
    participant-only tagger (L1c).  Tags come from the tagger plug-in ``predict_tokens`` (token by token) or
    the tag lexicon ``tags`` (word by word).

    ``languages`` (``file_id, language``) is the resolved language of each file; without it the
    folder's counts.  Files that are ``cn`` are detected first (``language_lexicon`` for the
    built-in detector, or the plug-in ``predict_language``; ``zh`` with neither), and both tagger and
    lexicon then use the detected language.  ``vocabulary`` is a caller's tag list or the table that ``read_vocab``
    gives (A5), in place of the built-in one.  ``first_per_language`` is ``--slice`` (G3).  Of
    several files with one base name the last (by path) is tagged, as its rows would be the ones kept.
    """
    if isinstance(vocabulary, DataFrame):
        vocabulary = listed(vocabulary)
    files = V.last_per_name(corpus.files)
    if table is not None:                                    # E4: only files named in the table
        files = files.join(table.select(F.col("file_name").alias("_n")).distinct(),
                           F.col("file_name") == F.col("_n"), "left_semi")
    langs = T.tagging_languages(files) if languages is None else \
        files.select("file_id").join(languages, "file_id", "left").select(
            "file_id", "language", M.tagger_language("language").alias("tagger"))
    if first_per_language:
        named = V.first_n_per_language(files.join(langs, "file_id").select("file_id", "file_name", "language"), first_per_language)
        files = files.join(named.select("file_id"), "file_id", "left_semi")
    files = _persist(files)
    raw = L.raw_lines(corpus.chunks.join(files.select("file_id"), "file_id", "left_semi"))
    lines = _persist(L.parse_lines(_fixed(raw) if clean else raw))   # every aggregate below reads this one table
    langs = _persist(resolve_tagger(files, langs, lines, language_lexicon, predict_language))
    ok = langs.where(F.col("tagger").isNotNull()).select("file_id", F.col("tagger").alias("lang"))
    names = files.select("file_id", "file_name")
    errors = None
    if predict_tokens is None:
        if tags is None:
            raise ValueError("tagging needs a tagger plug-in or a tag lexicon")
        known = U.entries(tags, lexicon)
        stream = _persist(U.unit_stream(lines, files, ok, known, vocabulary))
        produced = U.unit_lines(stream)
        found = U.wide(stream, known, vocabulary)
    else:
        units = T.tagging_units(lines, files).join(ok, "file_id")
        tokens = _persist(T.annotate(units.where(F.col("speaker_role").isin(*roles)), predict_tokens))
        errors = tokens.where(F.col("error").isNotNull()).groupBy("file_id", "speaker_role").agg(F.min("error").alias("error"))
        counts = _persist(T.unit_counts(T.without_errors(tokens), vocabulary))
        _, sent = T.tally_and_sentences(counts)
        present = lines.join(files.select("file_id", M.is_diary("path").alias("diary")), "file_id") \
            .select("file_id", U.role(F.col("diary"), F.col("speaker")).alias("speaker_role")).where("speaker_role is not null").distinct()
        produced = present.join(sent, ["file_id", "speaker_role"], "left").select("file_id", "speaker_role", F.coalesce("num_words", F.lit(0)).alias("num_words"))
        found = T.tally_wide(counts, vocabulary=vocabulary).join(sent.select("file_id", "speaker_role", "num_sent"), ["file_id", "speaker_role"])
        if lexicon is not None:
            freq = U.frequencies(lines, files, ok, lexicon).select("file_id", "speaker_role", "word_freq")
            found = found.join(freq, ["file_id", "speaker_role"], "left")
    if lexicon is None:
        found = found.drop("word_freq").withColumn("word_freq", F.lit(None).cast("double"))
    feats = found.where(F.col("speaker_role").isin(*roles)).join(names, "file_id").drop("file_id") \
        .withColumn("word_freq", FT.word_freq_text(F.col("word_freq")))
    if table is not None:
        base = table if "num_sent" in table.columns else FT.empty_features(table, vocabulary)
        out = FT.fill_table(base, feats, vocabulary)
    else:
        meta = FT.first_per_name(FT.file_metadata(files, langs.select("file_id", "language"))) \
            .drop("file_id", "path")
        out = FT.last_per_key(meta.join(feats, "file_name").select(
            *[c for c in ("network", "language", "src_subject_id", "interview_type", "day", "interview_number")],
            F.lit("").alias("transcript_speaker_label"), "speaker_role",
            *[c for c in feats.columns if c not in ("file_name", "speaker_role")], "file_name"))
    fails = T.failures(files, langs, produced, roles=roles, errors=errors)
    W.write_feature_table(out, os.path.join(out_dir, "features_tsv"), vocabulary=vocabulary)
    W.write_failures(fails, os.path.join(out_dir, "failures_csv"))
    return Tagged(out, fails)


def resolve_tagger(files: DataFrame, languages: DataFrame, lines: DataFrame, lexicon: DataFrame | None = None,
                   predict=None) -> DataFrame:
    """``languages`` (``file_id, language, tagger``) with ``detect`` replaced by the detected tagger
    language (C22b, K1, C23b over the files that ask for it); ``zh`` when there is nothing to detect with."""
    asks = languages.where(F.col("tagger") == "detect").select("file_id")
    if lexicon is None and predict is None:
        found = asks.withColumn("_t", F.lit("zh"))
    else:
        found = MD.detect_tagger_language(lines.join(asks, "file_id", "left_semi"), lexicon, predict) \
            .select("file_id", F.col("tagger").alias("_t"))
    known = files.select("file_id").join(languages, "file_id").join(found, "file_id", "left")
    return known.select("file_id", "language",
                        F.when(F.col("tagger") == "detect", F.coalesce("_t", F.lit("zh"))).otherwise(F.col("tagger")).alias("tagger"))


def _fixed(raw: DataFrame) -> DataFrame:
    """Raw lines with the colon fix applied: a projection (the fix never adds or
    removes a line, so ordinals are unchanged)."""
    from parlance.functions.text import fix_missing_colon
    return raw.withColumn("raw", fix_missing_colon("raw", F.col("is_last")))


# --- L2: verify ------------------------------------------------------------------------------------

@dataclass
class Verified:
    verdicts: DataFrame
    mismatches: DataFrame
    accuracy: DataFrame
    copies: DataFrame | None = None   # F11 of the flat copy
    splits: DataFrame | None = None   # F10 of the split tables


def verify(spark: SparkSession, table: DataFrame, corpus: Corpus, out_dir: str, predict_types=None,
           thinking: str | None = None, mode: str = "cli", type_answers=None) -> Verified:
    """L2: flat copy by type (B10), split tables (B8), units (F8/E9),
    predictions (K4, checkpointed), mismatches (E13/J5 -> B7), accuracy (F9).
    The summaries (F9-F11) are observed on the writes; the verdicts are written once and read from there.

    ``mode="misc"`` is the stand-alone variant (L2b): no flat copy or splits,
    participant rows with an OPEN / PSYCHS label only (D-5), file lookup by
    base name then normalised name, mismatch rows matched by base name.
    ``type_answers`` is a table or ``Ledger`` of type answers."""
    index = V.file_index(corpus.files)
    copies = splits = None
    if mode == "cli":
        copies = V.counted_copies(V.flat_by_type(table, index, mode="type_first", normalized=False))
        W.write_table(copies.df, os.path.join(out_dir, "flat_by_type"))
        splits = V.counted_splits(V.route(table, "type_first"))
        routed = splits.df.withColumn("target", F.expr("nullif(target, 'unknown')"))
        W.write_splits(routed, os.path.join(out_dir, "splits"), os.path.join(out_dir, "unrouted"))
    units = V.verification_units(table, index, mode=mode)
    raw = L.raw_lines(corpus.chunks.join(
        corpus.files.join(units.select(F.col("source_path").alias("path")), "path", "left_semi")
        .select("file_id"), "file_id", "left_semi"))
    preds = MD.predict_types(raw, predict_types, thinking=thinking, answers=type_answers)
    preds = _persist(preds.join(corpus.files.select("file_id", F.col("path").alias("source_path")), "file_id"))
    counted = V.counted_verdicts(V.verdicts(units, preds))
    W.write_table(counted.df, os.path.join(out_dir, "verdicts"))
    verdict = spark.read.parquet(os.path.join(out_dir, "verdicts"))
    mism = V.mismatch_rows(table, verdict, by_basename=(mode == "misc"))
    W.write_mismatches(mism, os.path.join(out_dir, "mismatches_csv"))
    return Verified(verdict, mism, V.observed_accuracy(counted), copies and copies.table(), splits and splits.table())


# --- L3: fix --------------------------------------------------------------------------------------

def fix(spark: SparkSession, mismatches: DataFrame, table: DataFrame | str, out_dir: str,
        dry_run: bool = False) -> DataFrame:
    """L3: the change plan (A10 -> G2 -> C28); unless ``dry_run``, the corrected
    main table (E10 -> B11) and corrected splits (H5 -> B12) written to new paths, the moved
    files (``moved``) and the rows without a known type (``unrouted``) as tables.

    ``table`` may be the path of a table with versions (``sinks.versions``): its latest version is read, and the corrected
    table becomes the next one, committed after all other outputs."""
    versioned = table if isinstance(table, str) else None
    if versioned:
        base = TV.current(spark, versioned)
        table = TV.read_version(spark, versioned, base and base.number)
    plan = FT.corrections(mismatches)
    if dry_run:
        return plan
    plan = _persist(plan)
    corrected = FT.apply_corrections(table, plan)
    if not versioned:
        W.write_table(corrected, os.path.join(out_dir, "corrected_table"))
    W.write_table(V.moves(plan), os.path.join(out_dir, "moved"))
    W.write_splits(V.corrected_splits(table, plan), os.path.join(out_dir, "corrected_splits"),
                   os.path.join(out_dir, "unrouted"))
    if versioned:
        TV.replace_table(corrected, versioned, after=base.number)
    return plan


# --- L4 / L5 / L6 ----------------------------------------------------------------------------------

def organize_flat(spark: SparkSession, table: DataFrame, corpus: Corpus, out_dir: str) -> DataFrame:
    """L4: each named transcript once into its type folder (diary first), with a summary."""
    counted = V.counted_copies(V.flat_by_type(table, V.file_index(corpus.files), mode="diary_first", normalized=True))
    W.write_table(counted.df, os.path.join(out_dir, "flat"))
    return counted.table()


def clean(spark: SparkSession, corpus: Corpus, out_dir: str | None = None, dry_run: bool = False) -> DataFrame:
    """Colon fix (C11); unless ``dry_run`` the cleaned corpus is written as a line table
    (B13) that ``corpus_from_lines`` reads.  Returns the summary (F12)."""
    raw = L.raw_lines(corpus.chunks)
    if not dry_run and out_dir:
        fixed = _fixed(raw).join(corpus.files.select("file_id", "file_name", "path"), "file_id")
        W.write_table(fixed.select("file_id", "file_name", "path", "raw_index", "raw"), os.path.join(out_dir, "cleaned"))
    return LB.cleaning_summary(raw)


def build_lexicon(spark: SparkSession, subtlex: DataFrame, lang: str, out_dir: str | None = None,
                  use_log: bool = True) -> DataFrame:
    """SUBTLEX -> relative frequency (F5) -> B6, and the lookup dictionary
    (F7: lower-cased words, last row wins, by ``row_index``: see ``read_subtlex``) as ``lang, word, log_frequency``."""
    lex = FQ.subtlex_lexicon(subtlex, lang, order_col="row_index")
    if out_dir:
        W.write_lexicon(lex.drop("_order"), os.path.join(out_dir, "lexicon"))
    d = FQ.lexicon_dictionary(lex, "_order", use_log=use_log, keys=("lang",))
    return d.withColumnRenamed("value", "log_frequency" if use_log else "frequency")
