"""Registered queries: one Spark plan per operator family.

Every query takes ``(spark, sf_dir)``, reads the driver tables under
``sf_dir`` (or data Spark derives from them) and returns a DataFrame whose
column names match the reference SQL in ``parlance.plans.oracle``.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from parlance.functions.tags import listed
from parlance.operators import frequency as FQ
from parlance.operators import lines as L
from parlance.operators import units as U
from parlance.sinks import versions as TV
from parlance.sources import corpus as C
from parlance.session import ensure_checkpoint_dir, persisted
from parlance.sources.tables import read_table, read_vocab

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}


def register(name: str):
    def deco(fn: Query) -> Query:
        QUERIES[name] = fn
        return fn
    return deco


def _conversations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read_table(spark, sf_dir, "conversations")


def fx_corpus(spark: SparkSession, sf_dir: str, style: str = "labelled") -> C.Corpus:
    return C.conversation_corpus(_conversations(spark, sf_dir), style)


@register("lines")
def q_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Parsed non-blank lines with their file ordinal."""
    corpus = fx_corpus(spark, sf_dir)
    parsed = L.parse_lines(L.raw_lines(corpus.chunks))
    return parsed.select(F.col("file_id").alias("conv_id"), "line_index", "raw_index",
                         "speaker", "ts", "text")


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return read_table(spark, sf_dir, name)


def fx_lines(spark: SparkSession, sf_dir: str, style: str = "labelled"):
    corpus = fx_corpus(spark, sf_dir, style)
    return corpus, L.parse_lines(L.raw_lines(corpus.chunks))


def document_lexicon(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The lexicon of all documents, computed once for the several uses a query makes of it."""
    return persisted(FQ.corpus_lexicon(_table(spark, sf_dir, "documents")))


@register("lexicon")
def q_lexicon(spark: SparkSession, sf_dir: str) -> DataFrame:
    """relative and scaled-log frequency per (lang, word) over all documents."""
    return FQ.corpus_lexicon(_table(spark, sf_dir, "documents"))


def subtlex_from_documents(spark, sf_dir):
    """A SUBTLEX-format table (``Word, FREQcount, Lg10WF``) from all documents,
    words kept in their original case (``May``, ``may``, ``MAY`` are rows of
    their own); ``Lg10WF`` is log10 of the count, 4 decimals."""
    from parlance.constants import NON_WORD, WS
    docs = _table(spark, sf_dir, "documents")
    toks = F.filter(F.split(F.regexp_replace("text", NON_WORD, ""), f"{WS}+"), lambda w: w != F.lit(""))
    c = docs.select(F.explode(toks).alias("Word")).groupBy("Word").agg(F.count(F.lit(1)).alias("FREQcount"))
    return c.select("Word", "FREQcount", (FQ.scaled_log10(F.col("FREQcount")) / 10000.0).alias("Lg10WF"))


@register("lexicon_dictionary")
def q_lexicon_dictionary(spark, sf_dir):
    """F5 + F7: SUBTLEX relative frequency, then lower-cased words where the last
    row wins (row order = ``Word`` order); one row per lower-cased word."""
    sub = subtlex_from_documents(spark, sf_dir)
    lex = FQ.subtlex_lexicon(sub, order_col="Word")
    d = FQ.lexicon_dictionary(lex, "_order", use_log=True, keys=())
    f = FQ.lexicon_dictionary(lex, "_order", use_log=False, keys=())
    return d.withColumnRenamed("value", "log_frequency").join(f.withColumnRenamed("value", "frequency"), "word")


def fx_spoken(spark: SparkSession, sf_dir: str):
    """The labelled corpus and its lines without ordinals."""
    corpus = fx_corpus(spark, sf_dir)
    return corpus, L.spoken_lines(corpus.chunks)


@register("word_freq")
def q_word_freq(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Flagship — C21 / J2 / E5 / F4: mean log word frequency per transcript and role."""
    corpus, lines = fx_spoken(spark, sf_dir)
    langs = corpus.files.select("file_id", M.language_from_path("path").alias("lang"))
    out = U.frequencies(lines, corpus.files, langs, FQ.corpus_lexicon(_table(spark, sf_dir, "documents")))
    return out.withColumnRenamed("file_id", "conv_id")


# --- metadata from names and paths (C1-C8, C20, C28, C29, E2) --------------------------

from parlance.functions import metadata as M  # noqa: E402


def fx_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    return C.conversation_files(_conversations(spark, sf_dir)).withColumnRenamed("file_id", "conv_id")


def _short_name(name, conv_id):
    """The first ``conv_id % 7 + 1`` name tokens: names with missing fields."""
    return F.array_join(F.slice(F.split(name, "_"), 1, (conv_id % 7 + 1).cast("int")), "_")


@register("filename_fields")
def q_filename_fields(spark, sf_dir):
    """Patient id, type, day, session tokens (NULL when absent)."""
    f = fx_files(spark, sf_dir).select("conv_id", _short_name(F.col("file_name"), F.col("conv_id")).alias("name"))
    return f.select("conv_id", "name", M.patient_id("name").alias("patient_id"),
                    M.transcript_type("name").alias("interview_type"), M.day("name").alias("day"),
                    M.session("name").alias("session"),
                    M.null_to_unknown(M.session("name")).alias("session_or_unknown"))


@register("site_code")
def q_site_code(spark, sf_dir):
    """C2 + C5 + C20: site of a name, its languages, primary language and its name."""
    f = fx_files(spark, sf_dir).select("conv_id", "file_name", M.site_code("file_name").alias("site"))
    langs = M.site_languages("site")
    return f.select("conv_id", "site", F.array_join(langs, ",").alias("site_languages"),
                    M.site_primary_language("site").alias("primary_language"),
                    M.language_name(M.site_primary_language("site")).alias("primary_language_name"))


@register("clinical_group")
def q_clinical_group(spark, sf_dir):
    """Clinical group from the nearest ancestor folder."""
    return fx_files(spark, sf_dir).select("conv_id", "path", M.clinical_group_from_path("path").alias("clinical_group"))


@register("path_language")
def q_path_language(spark, sf_dir):
    """C4 + C20: language code (and name) from a ``Language.<code>`` or bare code folder."""
    f = fx_files(spark, sf_dir).select("conv_id", M.language_from_path("path").alias("language"))
    return f.select("conv_id", "language", M.language_name("language").alias("language_name"))


@register("site_languages")
def q_site_languages(spark, sf_dir):
    """E2 + C24: is the folder language allowed at the site; resolved language."""
    f = fx_files(spark, sf_dir).select("conv_id", M.site_code("file_name").alias("site"),
                                       M.language_from_path("path").alias("language"))
    return f.select("conv_id", "site", "language",
                    F.array_contains(M.site_languages("site"), F.col("language")).alias("allowed"),
                    M.resolve_language("language", "site").alias("resolved"))


@register("diary_flags")
def q_diary_flags(spark, sf_dir):
    """C6a-c: diary by full path, by name, by path parts."""
    f = fx_files(spark, sf_dir)
    alt = F.when(F.col("conv_id") % 13 == 0, F.regexp_replace("path", "interviewAudioTranscript", "audioJournal")) \
        .otherwise(F.col("path"))
    f = f.select("conv_id", alt.alias("path"), M.basename(alt).alias("name"))
    return f.select("conv_id", M.is_diary("path", "path").alias("diary_path"),
                    M.is_diary("name", "name").alias("diary_name"),
                    M.is_diary("path", "parts").alias("diary_parts"))


def _type_label(conv_id, name):
    """Interview-type labels as people type them, varied per transcript."""
    t = M.transcript_type(name)
    k = conv_id % 8
    return (F.when(k == 0, F.concat(F.lit(" "), t, F.lit(" "))).when(k == 1, F.lit("Open-Ended"))
            .when(k == 2, F.lit("psych")).when(k == 3, F.lit("OPEN_ENDED")).when(k == 4, F.upper(t))
            .when(k == 5, F.lit(None).cast("string")).when(k == 6, F.lit("openend")).otherwise(t))


@register("interview_types")
def q_interview_types(spark, sf_dir):
    """Type normalisation, pass-through and strict."""
    f = fx_files(spark, sf_dir).select("conv_id", _type_label(F.col("conv_id"), F.col("file_name")).alias("label"))
    return f.select("conv_id", "label", M.normalize_interview_type("label").alias("normalized"),
                    M.normalize_interview_type("label", strict=True).alias("strict"))


def _submission_name(conv_id, name):
    """A name carrying ``submission<n>`` with 0-2 leading zeros and 1-5 digits."""
    num = F.concat(F.repeat(F.lit("0"), (conv_id % 3).cast("int")), ((conv_id * 37) % 100000).cast("string"))
    return F.regexp_replace(name, "_REDACTED", F.concat(F.lit("_submission"), num))


@register("submissions")
def q_submissions(spark, sf_dir):
    """``submission<n>`` zero-padded to at least four digits."""
    f = fx_files(spark, sf_dir).select("conv_id", _submission_name(F.col("conv_id"), F.col("file_name")).alias("name"))
    return f.select("conv_id", "name", M.normalize_submission("name").alias("normalized"))


@register("corrected_names")
def q_corrected_names(spark, sf_dir):
    """Swap the type token of a name (PSYCHS <-> OPEN)."""
    f = fx_files(spark, sf_dir).select("conv_id", "file_name",
                                       F.upper(M.transcript_type("file_name")).alias("old_type"))
    new = F.when(F.col("old_type") == "PSYCHS", F.lit("OPEN")).otherwise(F.lit("PSYCHS"))
    return f.select("conv_id", "old_type", new.alias("new_type"),
                    M.corrected_name("file_name", "old_type", new).alias("new_name"))


# --- speaker labels, roles, prompts, language (C10-C17, C22-C25, K1, K3) ------------------

from parlance.operators import answers as AN  # noqa: E402
from parlance.operators import labels as LB  # noqa: E402
from parlance.operators import models as MD  # noqa: E402


def fx_raw(spark, sf_dir, style="labelled"):
    corpus = fx_corpus(spark, sf_dir, style)
    return corpus, L.raw_lines(corpus.chunks)


@register("role_lines")
def q_role_lines(spark, sf_dir):
    """Participant and interviewer lines with their ordinal within the role."""
    _, lines = fx_lines(spark, sf_dir)
    r = L.role_line_ordinals(lines.where(F.col("speaker").isin("PARTICIPANT", "INTERVIEWER")))
    return r.select(F.col("file_id").alias("conv_id"), "speaker", "line_index", "role_ordinal", "n_role_lines")


@register("colon_fix")
def q_colon_fix(spark, sf_dir):
    """The raw lines the colon fix rewrites, and their new text."""
    _, raw = fx_raw(spark, sf_dir)
    return (LB.colon_fixes(raw).where("changed")
            .select(F.col("file_id").alias("conv_id"), "raw_index", "fixed"))


@register("cleaning_summary")
def q_cleaning_summary(spark, sf_dir):
    """files scanned / needing fixes / total fixes."""
    _, raw = fx_raw(spark, sf_dir)
    return LB.cleaning_summary(raw)


@register("speaker_normalize")
def q_speaker_normalize(spark, sf_dir):
    """Per transcript with non-S1..S3 labels, the label map (simultaneous)."""
    _, raw = fx_raw(spark, sf_dir, "raw")
    m = LB.label_mapping(LB.line_labels(raw))
    return m.select(F.col("file_id").alias("conv_id"), "original", "normalized")


@register("original_labels")
def q_original_labels(spark, sf_dir):
    """C14 on both corpora: PARTICIPANT/INTERVIEWER, else the first S-label."""
    outs = []
    for style in ("labelled", "raw"):
        _, raw = fx_raw(spark, sf_dir, style)
        outs.append(LB.original_labels(raw).select(
            F.col("file_id").alias("conv_id"), F.lit(style).alias("corpus"),
            "participant_label", "interviewer_label"))
    return outs[0].unionByName(outs[1])


def _roles(spark, sf_dir):
    corpus, raw = fx_raw(spark, sf_dir, "raw")
    answers, roles = MD.classify_roles(_interviews(corpus, raw))
    return corpus, raw, answers, roles


def _interviews(corpus, raw):
    """Raw lines of the files that are no diaries (roles are asked for interviews only)."""
    return raw.join(corpus.files.where(~M.is_diary("path")).select("file_id"), "file_id", "left_semi")


@register("roles_parsed")
def q_roles_parsed(spark, sf_dir):
    """K3 (built-in predictor) + C16: the answer and the original label of each role."""
    _, _, answers, roles = _roles(spark, sf_dir)
    wide = roles.groupBy("file_id").agg(
        F.max(F.when(F.col("role") == "INTERVIEWER", F.col("original"))).alias("interviewer"),
        F.max(F.when(F.col("role") == "PARTICIPANT", F.col("original"))).alias("participant"))
    return answers.join(wide, "file_id", "left").select(
        F.col("file_id").alias("conv_id"), "response", "interviewer", "participant")


def fx_answers(prompts: DataFrame, said: list[str | None]) -> DataFrame:
    """A ledger as runs of a model leave it: an answer of the list ``said`` for each prompt, by file and part; every fifth file was asked
    twice (the first answer is void), every thirteenth is unanswered, every seventeenth answered under an older prompt."""
    f, p = F.col("file_id"), F.col("part")
    answer = F.get(F.array(*[F.lit(a).cast("string") for a in said]), ((f * 3 + p) % len(said)).cast("int"))
    runs = F.when(f % 5 == 0, F.array(F.lit(1), F.lit(2))).otherwise(F.array(F.lit(2)))
    h = F.when(f % 17 == 3, F.sha2(F.concat(F.lit("old"), "prompt_hash").cast("binary"), 256)).otherwise(F.col("prompt_hash"))
    rows = AN.with_hash(prompts).where(f % 13 != 5).select("file_id", "part", h.alias("prompt_hash"), answer.alias("_a"), F.explode(runs).alias("asked"))
    return rows.select("file_id", "part", "prompt_hash", F.when(F.col("asked") == 2, F.col("_a")).otherwise("{OPEN} S1: PARTICIPANT").alias("response"), "asked")


#: Type answers as models give them: braced, bare, in any case, several at once, none.
TYPE_ANSWERS = ["{OPEN}", "{PSYCHS}", "The type is {psychs}.", "OPEN", "Not open but PSYCHS", "I cannot tell.", "{Open}, or else {PSYCHS}", "", "psychs", None, "reopened"]
#: Role answers: plain, lower case, incomplete, corrected by a later line, none, three speakers, two participants, on one line.
ROLE_ANSWERS = ["S1: INTERVIEWER\nS2: PARTICIPANT", "s2: interviewer\ns1: participant", "S1: INTERVIEWER", "S1: INTERVIEWER\nS1: PARTICIPANT\nS2: INTERVIEWER",
                "Nobody knows.", "S1: INTERVIEWER\nS2: PARTICIPANT\nS3: PARTICIPANT", "S1: PARTICIPANT\nS2: PARTICIPANT", "S2: PARTICIPANT, S1: INTERVIEWER"]
PART_CHARS = 1500  # a smaller request than the production one, so that most files have several parts and votes


@register("roles_answered")
def q_roles_answered(spark, sf_dir):
    """K3 by an answers table + C16: the parts' answers of every kind, and the original label of each role they agree on."""
    corpus, raw = fx_raw(spark, sf_dir, "raw")
    raw = persisted(_interviews(corpus, raw))
    prompts = persisted(AN.with_hash(MD.role_prompts(raw, PART_CHARS)))
    answers, roles = MD.classify_roles(raw, chars=PART_CHARS, answers=fx_answers(prompts, ROLE_ANSWERS))
    given = answers.groupBy("file_id").agg(F.count(F.lit(1)).alias("answers"))
    wide = roles.groupBy("file_id").agg(
        F.max(F.when(F.col("role") == "INTERVIEWER", F.col("original"))).alias("interviewer"),
        F.max(F.when(F.col("role") == "PARTICIPANT", F.col("original"))).alias("participant"))
    return given.join(wide, "file_id", "left").withColumnRenamed("file_id", "conv_id")


@register("types_voted")
def q_types_voted(spark, sf_dir):
    """K4 by an answers table + C17: the type that most parts of a file give."""
    _, raw = fx_raw(spark, sf_dir)
    raw = persisted(raw)
    ledger = fx_answers(MD.type_prompts(raw, PART_CHARS), TYPE_ANSWERS)
    return MD.predict_types(raw, chars=PART_CHARS, answers=ledger).withColumnRenamed("file_id", "conv_id")


@register("answers_pending")
def q_answers_pending(spark, sf_dir):
    """K3 / K4: the prompts still to be sent to a model (no answer, a NULL one, or one to an older prompt)."""
    corpus, raw = fx_raw(spark, sf_dir, "raw")
    out = []
    for kind, prompts, said in (("roles", MD.role_prompts(_interviews(corpus, raw)), ROLE_ANSWERS), ("type", MD.type_prompts(raw, thinking="low"), TYPE_ANSWERS)):
        prompts = AN.with_hash(prompts)
        out.append(AN.pending(prompts, fx_answers(prompts, said)).select(F.col("file_id").alias("conv_id"), F.lit(kind).alias("kind"), "part", "prompt_hash"))
    return out[0].unionByName(out[1])


@register("roles_applied")
def q_roles_applied(spark, sf_dir):
    """Lines rewritten to ``ROLE:`` (diaries and unclassified files untouched)."""
    corpus, raw, _, roles = _roles(spark, sf_dir)
    interviews = corpus.files.where(~M.is_diary("path")).select("file_id")
    roles = roles.join(interviews, "file_id", "left_semi")
    out = LB.apply_roles(LB.line_labels(raw), roles).where("changed")
    return out.select(F.col("file_id").alias("conv_id"), "raw_index", "raw")


@register("prompts")
def q_prompts(spark, sf_dir):
    """Model prompts that cover whole texts in consecutive parts (requests of 5,000
    normalised characters for roles, of 40,000 for types)."""
    _, raw = fx_raw(spark, sf_dir, "raw")
    rp = MD.role_prompts(raw).select("file_id", F.lit("roles").alias("kind"), "part", "system", "prompt")
    tp = MD.type_prompts(raw, thinking="low").select("file_id", F.lit("type").alias("kind"), "part", "system", "prompt")
    return rp.unionByName(tp).withColumnRenamed("file_id", "conv_id")


@register("tagger_language")
def q_tagger_language(spark, sf_dir):
    """K1 tagger variant + C22b + C23b: detected code for transcripts, ``zh`` fallback."""
    _, lines = fx_spoken(spark, sf_dir)
    return MD.detect_tagger_language(lines, document_lexicon(spark, sf_dir)).withColumnRenamed("file_id", "conv_id")


@register("language_resolved")
def q_language_resolved(spark, sf_dir):
    """K1 (built-in detector) + C22 + C23 + C24 + C25."""
    corpus, lines = fx_spoken(spark, sf_dir)
    det = MD.detect_languages(lines, document_lexicon(spark, sf_dir))
    sites = corpus.files.select("file_id", M.site_code("file_name").alias("site"))
    out = MD.resolve_languages(det, sites)
    return out.withColumnRenamed("file_id", "conv_id")


# --- tagging: tokens, tallies, sentences, failures (C18, C19, F1-F3, F13, J3, J6, K2) -----

from parlance.functions.tags import ud_feature  # noqa: E402
from parlance.constants import UD_FEATURE_KEYS  # noqa: E402
from parlance.operators import tally as T  # noqa: E402
from parlance.plans.steps import resolve_tagger  # noqa: E402


# Tags of the derived lexicon: part of speech, fine tag, relation, morphology.
TAG_ROWS = [
    ("NOUN", "NN", "nsubj", "Case=Nom|Gender=Fem|Number=Sing"),
    ("VERB", "VBD", "root", "Mood=Ind|Number=Plur|Person=3|Tense=Past|VerbForm=Fin"),
    ("PRON", "PRP$", "nmod:poss", "Case=Acc|Number=Sing|Person=1|Poss=Yes|PronType=Prs"),
    ("DET", "DT", "det", "Definite=Def|PronType=Art"),
    ("ADJ", "CD", "nummod", "NumType=Card"),
    ("SYM", "SYM", "dep", None),
    ("VERB", "VB", "xcomp", "Mood=Imp|Tense=Pres|VerbForm=Fin"),
    ("ADP", "IN", "case", "Case=Neut|Gender=Neut"),
]


def document_tags(spark, sf_dir):
    """A tag lexicon (with frequencies) over all words of ``documents``; a word's row of tags follows from its first letter and length."""
    lex = document_lexicon(spark, sf_dir)
    row = F.get(F.array(*[F.struct(*[F.lit(v).cast("string").alias(n) for n, v in zip(("upos", "xpos", "deprel", "feats"), r)]) for r in TAG_ROWS]),
                (F.ascii("word") + 3 * F.length("word")) % len(TAG_ROWS))
    return lex.select("lang", "word", "frequency", "lg_e4", F.col("word").alias("lemma"), row.alias("t")).select(
        "lang", "word", "frequency", "lg_e4", "lemma", "t.upos", "t.xpos", "t.deprel", "t.feats")


def tagger_languages(corpus, lines, lexicon):
    """C4 -> C25: the folder's language and the tagger's; in a ``cn`` folder the tagger's is detected."""
    return resolve_tagger(corpus.files, T.tagging_languages(corpus.files), lines, lexicon)


def _tagging_units(lines, files, langs):
    known = langs.where(F.col("tagger").isNotNull()).select("file_id", F.col("tagger").alias("lang"))
    return T.tagging_units(lines, files).join(known, "file_id")


def fx_tokens(spark, sf_dir):
    corpus, lines = fx_lines(spark, sf_dir)
    tags = document_tags(spark, sf_dir)
    langs = tagger_languages(corpus, L.spoken_lines(corpus.chunks), tags)
    return T.annotate(_tagging_units(lines, corpus.files, langs), tags=tags)


def fx_stream(spark, sf_dir, vocabulary=None, known=None):
    """Files, their tagger languages and the stream of all that is counted about them (``operators.units``)."""
    corpus, lines = fx_spoken(spark, sf_dir)
    known = known or document_tags(spark, sf_dir)
    langs = tagger_languages(corpus, lines, known)
    ok = langs.where(F.col("tagger").isNotNull()).select("file_id", F.col("tagger").alias("lang"))
    return corpus, langs, U.unit_stream(lines, corpus.files, ok, known, vocabulary), known


@register("tokens")
def q_tokens(spark, sf_dir):
    """J3 / K2 (built-in annotator): one row per token."""
    return fx_tokens(spark, sf_dir).withColumnRenamed("file_id", "conv_id")


@register("ud_features")
def q_ud_features(spark, sf_dir):
    """The 11 morphological slots of every token."""
    return fx_tokens(spark, sf_dir).select(F.col("file_id").alias("conv_id"), "line_index", "sent_id", "word_id", "feats",
                       *[ud_feature("feats", k).alias(f"f_{k.lower()}") for k in UD_FEATURE_KEYS])


@register("tagged_resolved")
def q_tagged_resolved(spark, sf_dir):
    """The language each file is tagged in; ``cn`` folders by detection over the participant's lines (``zh`` if nothing is known)."""
    corpus, lines = fx_spoken(spark, sf_dir)
    return tagger_languages(corpus, lines, document_lexicon(spark, sf_dir)).withColumnRenamed("file_id", "conv_id")


@register("duplicate_names")
def q_duplicate_names(spark, sf_dir):
    """Of several files with one base name, the one that is tagged (last path) and the one that gives the metadata (first path)."""
    files = C.conversation_files(_conversations(spark, sf_dir))
    shared = files.select("file_id", "dir", C.conversation_file_name(F.col("file_id") % 30).alias("file_name")).withColumn("path", F.concat("dir", F.lit("/"), "file_name"))
    meta = FT.first_per_name(shared.groupBy("file_name", "path").agg(F.min("file_id").alias("file_id")))
    last = V.last_per_name(shared.groupBy("file_name", "dir", "path").agg(F.max("file_id").alias("file_id")))
    return last.select("file_name", F.col("path").alias("tagged_path"), F.col("file_id").alias("tagged_id")).join(
        meta.select("file_name", F.col("path").alias("meta_path"), F.col("file_id").alias("meta_id")), "file_name")


@register("tag_tally")
def q_tag_tally(spark, sf_dir):
    """Long tag counts per transcript and role."""
    counts = U.unit_counts(fx_stream(spark, sf_dir)[2])
    return T.tally_and_sentences(counts)[0].withColumnRenamed("file_id", "conv_id")


@register("tally_vocabulary")
def q_tally_vocabulary(spark, sf_dir):
    """A5: long tag counts by a caller's own vocabulary, a file of one tag a line with repeats and blank lines (here the
    language-specific tags and relations of the tag lexicon)."""
    path = f"{ensure_checkpoint_dir(spark)}/vocabulary-{uuid.uuid4().hex}"
    known = document_tags(spark, sf_dir)
    used = known.select(F.explode(F.array("xpos", "deprel")).alias("value")).distinct()
    lines = used.unionByName(used).unionByName(spark.range(3).select(F.get(F.array(F.lit("X"), F.lit(""), F.lit("  ")), "id").alias("value")))
    lines.write.text(path)
    counts = U.unit_counts(fx_stream(spark, sf_dir, listed(read_vocab(spark, path)), known)[2])
    return T.tally_and_sentences(counts)[0].withColumnRenamed("file_id", "conv_id")


def fx_unit_lines(spark, sf_dir, langs, corpus, lines):
    """Lines, sentences and words of the role units: no lexicon is asked."""
    ok = langs.where(F.col("tagger").isNotNull()).select("file_id", F.col("tagger").alias("lang"))
    return U.line_counts(lines, corpus.files, ok)


@register("sentence_counts")
def q_sentence_counts(spark, sf_dir):
    """sentences and words per transcript and role."""
    corpus, lines = fx_spoken(spark, sf_dir)
    counts = fx_unit_lines(spark, sf_dir, T.tagging_languages(corpus.files), corpus, lines)
    return counts.where("num_words > 0").select(F.col("file_id").alias("conv_id"), "speaker_role", "num_sent", "num_words")


@register("tally_wide")
def q_tally_wide(spark, sf_dir):
    """F2 / B1 / B2: zero-filled wide tallies (102 tag columns, safe names) + num_sent."""
    _, _, stream, known = fx_stream(spark, sf_dir)
    return U.wide(stream, known).drop("word_freq").withColumnRenamed("file_id", "conv_id")


def resolved_languages(spark, sf_dir, corpus, lines, lexicon=None):
    """Step-0 language (K1 + C24) as the folder language the tagger sees."""
    det = MD.detect_languages(lines, lexicon or document_lexicon(spark, sf_dir))
    sites = corpus.files.select("file_id", M.site_code("file_name").alias("site"))
    res = MD.resolve_languages(det, sites)
    return corpus.files.select("file_id").join(res, "file_id", "left").select(
        "file_id", F.coalesce("language", F.lit("UNKNOWN")).alias("language"), "tagger")


@register("failures")
def q_failures(spark, sf_dir):
    """Failure log (language, no lines, empty output) for the tag step."""
    corpus, lines = fx_spoken(spark, sf_dir)
    lex = document_lexicon(spark, sf_dir)
    langs = persisted(resolve_tagger(corpus.files, resolved_languages(spark, sf_dir, corpus, lines, lex), lines, lex))
    return T.failures(corpus.files, langs, fx_unit_lines(spark, sf_dir, langs, corpus, lines))


# --- the feature table: status, init, fill, build (A4, B2, B3, E1, E4, E7, E8, G4, J4) -----

from parlance.operators import feature_table as FT  # noqa: E402
from parlance.functions.text import words  # noqa: E402
from parlance.operators import verify as V  # noqa: E402


def _status_rows(spark, sf_dir):
    """Clinical-status CSV rows derived from the ``labels`` table, which covers
    only some ids (so some transcripts fall back to their folder): the patient
    id of the transcript with that id, a status as people type it (`` chr ``,
    ``HC``, ``other``), and a later, overriding ``hc`` row where both labels are
    set (last row wins)."""
    lab = _table(spark, sf_dir, "labels")
    d = F.col("doc_id")
    pid = M.patient_id(C.conversation_file_name(d))
    status = F.when(F.col("quality") == 1, " chr ").when(F.col("toxic") == 1, "HC").otherwise("other")
    base = lab.select(pid.alias("patient_id"), status.alias("clinical_status"), (d * 2).alias("row_pos"))
    again = lab.where((F.col("quality") == 1) & (F.col("toxic") == 1)).select(
        pid.alias("patient_id"), F.lit("hc").alias("clinical_status"), (d * 2 + 1).alias("row_pos"))
    return base.unionByName(again)


@register("status_join")
def q_status_join(spark, sf_dir):
    """Status table (last row wins) joined to transcripts, folder fallback."""
    files = fx_files(spark, sf_dir)
    status = FT.status_table(_status_rows(spark, sf_dir))
    groups = FT.clinical_groups(files.withColumnRenamed("conv_id", "file_id"), status)
    return groups.withColumnRenamed("file_id", "conv_id")


@register("init_table")
def q_init_table(spark, sf_dir):
    """B3 / J4 (organize step): metadata + original speaker labels + role rows."""
    corpus, raw = fx_raw(spark, sf_dir, "raw")
    corpus, raw = C.Corpus(persisted(corpus.files), corpus.chunks), persisted(raw)   # K1, K3 and C14 read these
    lines = L.parse_lines(raw)
    langs = resolved_languages(spark, sf_dir, corpus, lines)
    meta = FT.file_metadata(corpus.files, langs)
    _, roles = MD.classify_roles(_interviews(corpus, raw))
    return FT.init_table(meta, roles, LB.original_labels(raw))


def _type_spelling(conv_id, name):
    """The interview type as typed in a table: the name's type token in varied spellings."""
    t = M.transcript_type(name)
    k = conv_id % 4
    return (F.when(k == 1, F.upper(t)).when(k == 2, F.concat(F.lit(" "), t, F.lit(" ")))
            .when((k == 3) & (t == "open"), F.lit("OPEN_ENDED")).when((k == 3) & (t == "psychs"), F.lit("psych"))
            .otherwise(t))


def fx_table(spark, sf_dir):
    """A feature table over the transcripts: two role rows per interview, one per diary."""
    files = fx_files(spark, sf_dir)
    cid = F.col("conv_id")
    roles = F.when(M.is_diary("path"), F.array(F.lit("Participant"))) \
        .otherwise(F.array(F.lit("Participant"), F.lit("Interviewer")))
    t = files.select("conv_id", "file_name", "path", F.posexplode(roles).alias("pos", "speaker_role"))
    return t.select((cid * 2 + F.col("pos")).cast("bigint").alias("row_index"), "file_name", "speaker_role",
                    _type_spelling(cid, F.col("file_name")).alias("interview_type"))


def fx_features(spark, sf_dir):
    """Per (file_name, speaker_role): wide tallies, ``num_sent`` and ``word_freq`` text."""
    corpus, _, stream, known = fx_stream(spark, sf_dir)
    feats = U.wide(stream, known).withColumn("word_freq", FT.word_freq_text(F.col("word_freq")))
    return corpus, feats.join(corpus.files.select("file_id", "file_name"), "file_id").drop("file_id")


@register("table_filled")
def q_table_filled(spark, sf_dir):
    """E7 (update mode): a preliminary table with its feature columns filled."""
    _, feats = fx_features(spark, sf_dir)
    return FT.fill_table(FT.empty_features(fx_table(spark, sf_dir)), feats)


@register("new_table")
def q_new_table(spark, sf_dir):
    """E8 / H3 / B2 (new-table mode): tallies of both roles with transcript metadata."""
    corpus, feats = fx_features(spark, sf_dir)
    langs = corpus.files.select("file_id", M.language_from_path("path").alias("language"))
    meta = FT.first_per_name(FT.file_metadata(corpus.files, langs)).drop("file_id", "path")
    table = meta.join(feats, "file_name").select(
        "network", "language", "src_subject_id", "interview_type", "day", "interview_number",
        F.lit("").alias("transcript_speaker_label"), "speaker_role",
        *[c for c in feats.columns if c not in ("file_name", "speaker_role")], "file_name")
    return FT.last_per_key(table)


# --- verify / fix (B8, B10-B12, D-5..D-9, E3, E9-E13, F8-F11, G2, G3, H1, H5, J5) ----------

def lookup_scenario(spark, sf_dir):
    """Transcript files whose names carry submission numbers, and a table that
    names them raw, normalised, or (``_copy``) not at all."""
    files = fx_files(spark, sf_dir)
    cid = F.col("conv_id")
    disk = files.select("conv_id", F.concat("dir", F.lit("/"), _submission_name(cid, F.col("file_name"))).alias("path"))
    base = M.basename("path")
    tname = (F.when(cid % 9 == 4, F.regexp_replace(base, "[.]txt$", "_copy.txt"))
             .when(cid % 2 == 0, M.normalize_submission(base)).otherwise(base))
    table = fx_table(spark, sf_dir).join(disk.select("conv_id", tname.alias("tname")),
                                         (F.col("row_index") / 2).cast("bigint") == F.col("conv_id")) \
        .select("row_index", F.col("tname").alias("file_name"), "speaker_role", "interview_type")
    return disk, table


@register("semi_filter")
def q_semi_filter(spark, sf_dir):
    """E4 / D-2: transcripts named in the table (update mode restriction)."""
    disk, table = lookup_scenario(spark, sf_dir)
    return disk.join(table, M.basename("path") == F.col("file_name"), "left_semi").select("conv_id", "path")


@register("file_lookup")
def q_file_lookup(spark, sf_dir):
    """E3 / G2 / B10 (flat copy, diary first): each named file once with its folder and source."""
    disk, table = lookup_scenario(spark, sf_dir)
    return V.flat_by_type(table, V.file_index(disk), mode="diary_first", normalized=True)


@register("copy_summary")
def q_copy_summary(spark, sf_dir):
    """files per outcome of the flat copy."""
    disk, table = lookup_scenario(spark, sf_dir)
    return V.copy_summary(V.flat_by_type(table, V.file_index(disk), mode="diary_first", normalized=True))


@register("missing_files")
def q_missing_files(spark, sf_dir):
    """Table names without a transcript file."""
    disk, table = lookup_scenario(spark, sf_dir)
    return V.missing_files(table, V.file_index(disk))


@register("routed")
def q_routed(spark, sf_dir):
    """D-7 / D-8 / B8: split target of every row, type-first and diary-first."""
    t = fx_table(spark, sf_dir)
    a = V.route(t, "type_first").withColumnRenamed("target", "target_cli")
    return V.route(a, "diary_first").withColumnRenamed("target", "target_flat") \
        .select("row_index", "file_name", "target_cli", "target_flat")


@register("split_counts")
def q_split_counts(spark, sf_dir):
    """rows per split."""
    return V.split_counts(V.route(fx_table(spark, sf_dir), "type_first"))


@register("flat_by_type")
def q_flat_by_type(spark, sf_dir):
    """B10 (verify step): each transcript once into its type folder (type first)."""
    files = fx_files(spark, sf_dir)
    return V.flat_by_type(fx_table(spark, sf_dir), V.file_index(files), mode="type_first", normalized=False)


def _units(spark, sf_dir, mode="cli"):
    files = fx_files(spark, sf_dir)
    return V.verification_units(fx_table(spark, sf_dir), V.file_index(files), mode=mode)


@register("units")
def q_units(spark, sf_dir):
    """F8 / E9 / D-6: one verification unit per interview file."""
    return _units(spark, sf_dir)


@register("units_misc")
def q_units_misc(spark, sf_dir):
    """D-5 variant: participant rows with an OPEN / PSYCHS label only."""
    return _units(spark, sf_dir, "misc")


def _answered_types(spark, sf_dir):
    """The types that a table of answers gives the transcripts."""
    corpus, raw = fx_raw(spark, sf_dir)
    prompts = persisted(AN.with_hash(MD.type_prompts(raw)).select("file_id", "part", "prompt_hash"))
    return corpus, MD.combine_types(AN.collected(prompts, answers=fx_answers(prompts, TYPE_ANSWERS)))


def _verdicts(spark, sf_dir, mode="cli"):
    corpus, preds = _answered_types(spark, sf_dir)
    preds = preds.join(corpus.files.select("file_id", F.col("path").alias("source_path")), "file_id")
    return V.verdicts(_units(spark, sf_dir, mode), preds)


@register("types_parsed")
def q_types_parsed(spark, sf_dir):
    """K4 by an answers table + C17: the type answer for every transcript that has one, and its parse."""
    return _answered_types(spark, sf_dir)[1].withColumnRenamed("file_id", "conv_id")


@register("types_builtin")
def q_types_builtin(spark, sf_dir):
    """K4 (built-in) + C17: the stand-in's answer for every transcript and its parse."""
    _, raw = fx_raw(spark, sf_dir)
    return MD.predict_types(raw).withColumnRenamed("file_id", "conv_id")


@register("verdicts")
def q_verdicts(spark, sf_dir):
    """K4 by an answers table + C17 + E13: expected vs predicted type per file (match, mismatch, parse failure)."""
    return _verdicts(spark, sf_dir)


@register("mismatches")
def q_mismatches(spark, sf_dir):
    """One mismatch row per table row of each mismatched file."""
    return V.mismatch_rows(fx_table(spark, sf_dir), _verdicts(spark, sf_dir))


@register("accuracy")
def q_accuracy(spark, sf_dir):
    """processed / matched / mismatched / parse failures / accuracy."""
    return V.accuracy(_verdicts(spark, sf_dir))


def _fixes(spark, sf_dir):
    return FT.corrections(V.mismatch_rows(fx_table(spark, sf_dir), _verdicts(spark, sf_dir)))


@register("fix_plan")
def q_fix_plan(spark, sf_dir):
    """A10 / D-9 / G2 / C28 (dry run): the change plan, one row per file."""
    return _fixes(spark, sf_dir)


@register("corrections")
def q_corrections(spark, sf_dir):
    """The main table with corrected names and types."""
    return FT.apply_corrections(fx_table(spark, sf_dir), _fixes(spark, sf_dir)) \
        .select("row_index", "file_name", "speaker_role", "interview_type")


@register("table_versions")
def q_table_versions(spark, sf_dir):
    """B4 / B11 with versions: the main table, read and replaced by its corrected rows; the rows of both versions."""
    path = f"{ensure_checkpoint_dir(spark)}/versions-{uuid.uuid4().hex}"
    TV.replace_table(fx_table(spark, sf_dir), path)
    before = TV.read_version(spark, path)
    TV.replace_table(FT.apply_corrections(before, _fixes(spark, sf_dir)), path)
    return reduce(DataFrame.unionByName, [
        TV.read_version(spark, path, v.number).select(F.lit(v.number).alias("version"), "row_index", "file_name", "speaker_role", "interview_type")
        for v in TV.versions(spark, path)])


@register("write_summaries")
def q_write_summaries(spark, sf_dir):
    """F9-F11 observed on the writes of the verdicts, the split rows and the flat copy; no second job counts them."""
    path = f"{ensure_checkpoint_dir(spark)}/summaries-{uuid.uuid4().hex}"
    disk, table = lookup_scenario(spark, sf_dir)
    copies = V.counted_copies(V.flat_by_type(table, V.file_index(disk), mode="diary_first", normalized=True))
    splits = V.counted_splits(V.route(fx_table(spark, sf_dir), "type_first"))
    verdicts = V.counted_verdicts(_verdicts(spark, sf_dir))
    for name, counted in (("copies", copies), ("splits", splits), ("verdicts", verdicts)):
        counted.df.write.parquet(f"{path}/{name}")
    none = F.lit(None).cast("bigint").alias("duplicate_rows")
    tried = V.observed_accuracy(verdicts)
    return reduce(DataFrame.unionByName, [
        copies.table().select(F.lit("copies").alias("summary"), F.col("outcome").alias("value"), F.col("n_files").alias("n"), "duplicate_rows"),
        splits.table().select(F.lit("splits").alias("summary"), F.col("target").alias("value"), F.col("n_rows").alias("n"), none),
        *[tried.select(F.lit("verdicts").alias("summary"), F.lit(c).alias("value"), F.col(c).alias("n"), none)
          for c in ("processed", "matched", "mismatched", "parse_failures")]])


@register("splits_corrected")
def q_splits_corrected(spark, sf_dir):
    """Split tables re-routed after correction (written to a new path by the sink)."""
    out = V.corrected_splits(fx_table(spark, sf_dir), _fixes(spark, sf_dir)).where(F.col("target").isNotNull())
    return out.select("row_index", "file_name", "interview_type", "target")


@register("fix_moves")
def q_fix_moves(spark, sf_dir):
    """Step 3's moved files as rows: old and new name and folder."""
    return V.moves(_fixes(spark, sf_dir))


@register("slice_per_language")
def q_slice_per_language(spark, sf_dir):
    """The first 5 transcripts per folder language (by name)."""
    files = fx_files(spark, sf_dir).select("conv_id", "file_name", M.language_from_path("path").alias("language"))
    return V.first_n_per_language(files, 5)


@register("lexicon_anc")
def q_lexicon_anc(spark, sf_dir):
    """relative frequency of an ANC-format table (word, lemma, pos, count) built
    from the benchmark texts with the built-in tagger's part of speech."""
    b = _table(spark, sf_dir, "benchmark")
    w = b.select(F.explode(words("text")).alias("word"))
    k5 = F.length("word") % 5
    pos = (F.when(k5 == 0, "NN").when(k5 == 1, "VBD").when(k5 == 2, "RP").when(k5 == 3, "DT").otherwise("SYM"))
    anc = w.groupBy("word").agg(F.count(F.lit(1)).alias("count")).select(
        "word", F.col("word").alias("lemma"), pos.alias("pos"), "count")
    return FQ.anc_lexicon(anc)
