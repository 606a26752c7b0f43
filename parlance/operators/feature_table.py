"""The feature table: initialise, fill, build, correct.

Rows of the table are ``(file, speaker role)`` units.  The table is kept with
an explicit ``row_index`` (G7): derived from the source when Spark builds the
table, from file position when it is read from a TSV.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from parlance.functions import metadata as M
from parlance.functions.tags import safe_names


def status_table(status: DataFrame, order_col: str = "row_pos") -> DataFrame:
    """A4 + G4: ``patient_id, clinical_group`` — trimmed, upper-cased, CHR / HC /
    UNKNOWN; a repeated patient id keeps its LAST row (``max_by`` on the order
    column: an ordinary aggregate, combined map-side)."""
    from parlance.functions.text import strip_ws
    grp = F.upper(strip_ws("clinical_status"))
    grp = F.when(grp == "CHR", "CHR").when(grp == "HC", "HC").otherwise("UNKNOWN")
    return (status.select(strip_ws("patient_id").alias("patient_id"), grp.alias("g"), order_col)
            .groupBy("patient_id").agg(F.max_by("g", order_col).alias("clinical_group")))


def clinical_groups(files: DataFrame, status: DataFrame | None) -> DataFrame:
    """``file_id, patient_id, clinical_group, group_source`` — the status
    table's group when the patient id is listed (UNKNOWN counts as listed),
    else the folder rule (C3)."""
    f = files.select("file_id", "path", M.patient_id("file_name").alias("patient_id"))
    if status is None:
        return f.select("file_id", "patient_id", M.clinical_group_from_path("path").alias("clinical_group"),
                        F.lit("path").alias("group_source"))
    j = f.join(status.withColumnRenamed("clinical_group", "_g"), "patient_id", "left")
    hit = F.col("_g").isNotNull()
    return j.select("file_id", "patient_id",
                    F.when(hit, F.col("_g")).otherwise(M.clinical_group_from_path("path")).alias("clinical_group"),
                    F.when(hit, F.lit("csv")).otherwise(F.lit("path")).alias("group_source"))


def file_metadata(files: DataFrame, languages: DataFrame) -> DataFrame:
    """The eight metadata fields of a transcript (NULL -> UNKNOWN), language as
    its display name.  ``languages``: ``file_id, language`` (a code)."""
    f = files.join(languages.select("file_id", "language"), "file_id", "left")
    name = F.col("file_name")
    return f.select(
        "file_id", "file_name", "path",
        M.null_to_unknown(M.site_code(name)).alias("network"),
        M.null_to_unknown(M.language_name(F.coalesce("language", F.lit("UNKNOWN")))).alias("language"),
        M.null_to_unknown(M.patient_id(name)).alias("src_subject_id"),
        M.null_to_unknown(M.transcript_type(name)).alias("interview_type"),
        M.null_to_unknown(M.day(name)).alias("day"),
        M.null_to_unknown(M.session(name)).alias("interview_number"))


def first_per_name(meta: DataFrame) -> DataFrame:
    """One metadata row per file name — the transcript with the smallest
    path wins when the same name sits in several folders (an aggregate, no sort)."""
    cols = [c for c in meta.columns if c != "file_name"]
    agg = meta.groupBy("file_name").agg(F.min_by(F.struct(*cols), F.col("path")).alias("_m"))
    return agg.select("file_name", *[F.col(f"_m.{c}").alias(c) for c in cols])


def last_per_key(table: DataFrame, order_col: str = "file_name") -> DataFrame:
    """G4 + C26 (new-table mode): one row per transcript key and role — the key
    is ``site_patient_language_type_day_session`` (NULL -> UNKNOWN) — the LAST
    transcript (by ``order_col``) wins.  ``max_by`` combines map-side."""
    key = M.transcript_key("network", "src_subject_id", "language", "interview_type", "day", "interview_number")
    cols = [c for c in table.columns if c != "speaker_role"]
    agg = table.groupBy(key.alias("_key"), "speaker_role").agg(
        F.max_by(F.struct(*[F.col(f"`{c}`") for c in cols]), F.col(order_col)).alias("_r"))
    return agg.select(*[F.col(f"_r.`{c}`").alias(c) if c != "speaker_role" else F.col("speaker_role")
                        for c in table.columns])


def init_table(meta: DataFrame, roles: DataFrame, original: DataFrame, diary_mode: str = "path") -> DataFrame:
    """B3 + J4: the preliminary table.

    * diary: one Participant row labelled with the original participant label (``S0`` if none);
    * classified interview: one row per role with its original label;
    * unclassified interview: Participant and Interviewer rows with label ``''``.

    ``roles``: ``file_id, original, role``; ``original``: C14 output.
    ``row_index = 2 * key + (0 participant | 1 interviewer)``.
    """
    r = roles.groupBy("file_id").agg(
        F.max(F.when(F.col("role") == "PARTICIPANT", F.col("original"))).alias("p_lab"),
        F.max(F.when(F.col("role") == "INTERVIEWER", F.col("original"))).alias("i_lab"))
    j = meta.join(r, "file_id", "left").join(original.select("file_id", "participant_label"), "file_id", "left")
    diary = M.is_diary("path", diary_mode)
    classified = F.col("p_lab").isNotNull()
    part = F.struct(F.lit("Participant").alias("speaker_role"), F.lit(0).alias("pos"),
                    F.when(diary, F.coalesce("participant_label", F.lit("S0")))
                    .when(classified, F.col("p_lab")).otherwise(F.lit("")).alias("label"))
    inter = F.struct(F.lit("Interviewer").alias("speaker_role"), F.lit(1).alias("pos"),
                     F.when(classified, F.col("i_lab")).otherwise(F.lit("")).alias("label"))
    rows = F.when(diary, F.array(part)).otherwise(F.array(part, inter))
    e = j.select("*", F.explode(rows).alias("u"))
    # numeric keys (a table of conversations) give 2 * id + role; path keys (text
    # files) a 62-bit hash of the path instead.  Only the order of one file's
    # rows matters downstream (first row wins per file name).
    numeric = meta.schema["file_id"].dataType.typeName() in ("long", "integer", "short", "byte")
    base = F.col("file_id") if numeric else F.xxhash64("file_id").bitwiseAND(F.lit(0x3FFFFFFFFFFFFFFF))
    return e.select(
        (base * 2 + F.col("u.pos")).cast("bigint").alias("row_index"),
        "network", "language", "src_subject_id", "interview_type", "day", "interview_number",
        F.col("u.label").alias("transcript_speaker_label"), F.col("u.speaker_role").alias("speaker_role"),
        "file_name")


def features_long_to_wide(tally: DataFrame, stats: DataFrame, keys=("file_name", "speaker_role"),
                          vocabulary: list[str] | None = None) -> DataFrame:
    """Wide feature values for filling: tag columns (safe names) + ``num_sent``, ``word_freq``."""
    from parlance.operators.tally import tally_wide
    wide = tally_wide(tally, keys, vocabulary)
    return wide.join(stats, list(keys), "left")


def fill_table(table: DataFrame, features: DataFrame, vocabulary: list[str] | None = None) -> DataFrame:
    """Fill the feature columns of matching ``(file_name, speaker_role)`` rows;
    rows without a result keep their values (``''`` in a fresh table).

    ``features`` must hold one row per key (tallies are per unit)."""
    names = list(safe_names(vocabulary).values()) + ["num_sent", "word_freq"]
    f = features.selectExpr("file_name", "speaker_role",
                            *[f"CAST(`{n}` AS STRING) AS `_new_{n}`" for n in names], "true AS _hit")
    j = table.join(f, ["file_name", "speaker_role"], "left")
    out = [f"CASE WHEN _hit THEN `_new_{c}` ELSE `{c}` END AS `{c}`" if c in names else f"`{c}`"
           for c in table.columns]
    return j.selectExpr(*out)


def empty_features(table: DataFrame, vocabulary: list[str] | None = None) -> DataFrame:
    """Add every feature column as ``''`` (a preliminary table)."""
    names = list(safe_names(vocabulary).values()) + ["num_sent", "word_freq"]
    return table.selectExpr("*", *[f"'' AS `{n}`" for n in names])


def word_freq_text(x) -> F.Column:
    """Python ``str(float)`` of a mean, ``nan`` when missing (TSV text)."""
    return F.when(x.isNull(), F.lit("nan")).otherwise(x.cast("string"))


def corrections(mismatches: DataFrame) -> DataFrame:
    """A10 + D-9 + G2 + C28: one correction per file from the mismatch rows.

    Parse failures are dropped; the first row (lowest ``row_index``) of each
    file wins; the new name swaps ``_<old>_`` for ``_<new>_`` (lower case) and
    the new type is the upper-case prediction.
    Output ``filename, old_type, new_type, new_filename``.
    """
    m = mismatches.where(F.col("predicted") != "PARSE_FAILURE")
    first = m.groupBy("filename").agg(
        F.min_by(F.struct(F.upper("expected").alias("old_type"), F.upper("predicted").alias("new_type")),
                 F.col("row_index")).alias("f"))
    return first.select("filename", "f.old_type", "f.new_type",
                        F.coalesce(M.corrected_name("filename", "f.old_type", "f.new_type"), F.col("filename")).alias("new_filename"))


def apply_corrections(table: DataFrame, fixes: DataFrame, name_col: str = "file_name",
                      type_col: str = "interview_type") -> DataFrame:
    """E10 + B11: rows of corrected files get the new file name and the new type
    (the lookup uses the OLD name).  Corrections are one row per mismatched
    file; no broadcast hint — AQE broadcasts them when they are small."""
    fx = fixes.select(F.col("filename").alias("_old"), "new_type", "new_filename")
    j = table.join(fx, F.col(name_col) == F.col("_old"), "left")
    out = []
    for c in table.columns:
        if c == name_col:
            out.append(F.coalesce("new_filename", F.col(c)).alias(c))
        elif c == type_col:
            out.append(F.coalesce("new_type", F.col(c)).alias(c))
        else:
            out.append(F.col(c))
    return j.select(*out)
