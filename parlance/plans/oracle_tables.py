"""Reference SQL for the feature-table, verify and fix queries."""

from __future__ import annotations

from parlance.functions.tags import safe_names
from parlance.plans.oracle import (
    label_map_ctes, DOC_LEXICON, FX_FILES, FX_NAME, FX_LINES, FX_META, FX_UNITS, FXR_LINES, FXR_ROLE_LINES, K3_CTES, LANG_RES, ORACLE,
    WORD_FREQ, group_from_path, is_diary, lab, lang_from_path, lang_name, norm_type, norm_type_strict,
    role_present, site_code, strip, tok, with_, words,
)
from parlance.plans.oracle_tags import PATH_LANG, units_cte

TAGS = safe_names()


def unknown(x: str) -> str:
    return f"coalesce(nullif({x}, ''), 'UNKNOWN')"


def basename(x: str) -> str:
    return f"string_split({x}, '/')[-1]"


def norm_sub(x: str) -> str:
    """Submission normalisation for names with at most one ``submission<digits>``."""
    d = f"regexp_extract({x}, 'submission([0-9]+)', 1)"
    num = f"CAST(CAST({d} AS HUGEINT) AS VARCHAR)"
    return (f"(CASE WHEN {d} = '' THEN {x} ELSE substr({x}, 1, strpos({x}, 'submission') - 1) || 'submission' || "
            f"(CASE WHEN length({num}) < 4 THEN lpad({num}, 4, '0') ELSE {num} END) || "
            f"substr({x}, strpos({x}, 'submission') + 10 + length({d})) END)")


TYPE_SPELLING = f"""
  CASE WHEN conv_id % 4 = 1 THEN upper({tok('file_name', 3)})
       WHEN conv_id % 4 = 2 THEN ' ' || {tok('file_name', 3)} || ' '
       WHEN conv_id % 4 = 3 AND {tok('file_name', 3)} = 'open' THEN 'OPEN_ENDED'
       WHEN conv_id % 4 = 3 AND {tok('file_name', 3)} = 'psychs' THEN 'psych'
       ELSE {tok('file_name', 3)} END"""

FX_TABLE = f"""
fx_table AS (
  SELECT CAST(conv_id * 2 + pos - 1 AS BIGINT) AS row_index, file_name, speaker_role, {TYPE_SPELLING} AS interview_type
  FROM (SELECT conv_id, file_name, unnest(roles) AS speaker_role, unnest(generate_series(1, len(roles))) AS pos
        FROM (SELECT *, CASE WHEN {is_diary('path')} THEN ['Participant'] ELSE ['Participant', 'Interviewer'] END AS roles
              FROM fx_paths)))"""

# --- status ------------------------------------------------------------------------------------

STATUS_NAME = """
  (CASE WHEN doc_id % 2 = 0 THEN 'Northnet' ELSE 'Southnet' END) ||
  (CASE doc_id % 6 WHEN 0 THEN 'YA' WHEN 1 THEN 'MU' WHEN 2 THEN 'HK' WHEN 3 THEN 'MT' WHEN 4 THEN 'SH' ELSE 'ZZ' END)
  || '_' ||
  (CASE doc_id % 6 WHEN 0 THEN 'YA' WHEN 1 THEN 'MU' WHEN 2 THEN 'HK' WHEN 3 THEN 'MT' WHEN 4 THEN 'SH' ELSE 'ZZ' END)
  || substr(CAST(10000000 + doc_id AS VARCHAR), 2) || '_x'"""

ORACLE["status_join"] = with_(FX_FILES) + f""",
st_rows AS (
  SELECT {tok(STATUS_NAME, 1)} AS patient_id,
         CASE WHEN quality = 1 THEN ' chr ' WHEN toxic = 1 THEN 'HC' ELSE 'other' END AS clinical_status,
         doc_id * 2 AS row_pos FROM labels
  UNION ALL
  SELECT {tok(STATUS_NAME, 1)}, 'hc', doc_id * 2 + 1 FROM labels WHERE quality = 1 AND toxic = 1),
st AS (
  SELECT {strip('patient_id')} AS patient_id,
    arg_max(CASE upper({strip('clinical_status')}) WHEN 'CHR' THEN 'CHR' WHEN 'HC' THEN 'HC' ELSE 'UNKNOWN' END,
            row_pos) AS clinical_group
  FROM st_rows GROUP BY 1)
SELECT f.conv_id, {tok('f.file_name', 1)} AS patient_id,
  CASE WHEN st.clinical_group IS NOT NULL THEN st.clinical_group ELSE {group_from_path('f.path')} END AS clinical_group,
  CASE WHEN st.clinical_group IS NOT NULL THEN 'csv' ELSE 'path' END AS group_source
FROM fx_paths f LEFT JOIN st ON st.patient_id = {tok('f.file_name', 1)}"""

# --- init table (organize step) ------------------------------------------------------------------

ORACLE["init_table"] = with_(FX_META, FXR_LINES, DOC_LEXICON, LANG_RES.replace("FROM fx_lines", "FROM fxr_lines"),
                             FXR_ROLE_LINES, K3_CTES) + f""",
meta AS (
  SELECT f.conv_id, f.file_name, f.path,
    {unknown(site_code('f.file_name'))} AS network,
    {unknown(lang_name("coalesce(r.language, 'UNKNOWN')"))} AS language,
    {unknown(tok('f.file_name', 1))} AS src_subject_id, {unknown(tok('f.file_name', 3))} AS interview_type,
    {unknown(tok('f.file_name', 4))} AS day, {unknown(tok('f.file_name', 5))} AS interview_number
  FROM fx_paths f LEFT JOIN res_t r USING (conv_id)),
rr AS (
  SELECT conv_id, max(CASE WHEN role = 'PARTICIPANT' THEN original END) AS p_lab,
         max(CASE WHEN role = 'INTERVIEWER' THEN original END) AS i_lab
  FROM roles GROUP BY conv_id),
orig AS (
  SELECT conv_id, CASE WHEN has_p = 1 THEN 'PARTICIPANT' WHEN has_p = 0 AND has_i = 0 THEN first_label END AS participant_label
  FROM (SELECT conv_id,
          max(CASE WHEN {role_present('raw', 'PARTICIPANT', 'is_last')} THEN 1 ELSE 0 END) AS has_p,
          max(CASE WHEN {role_present('raw', 'INTERVIEWER', 'is_last')} THEN 1 ELSE 0 END) AS has_i,
          arg_min(CASE WHEN lb <> '' THEN lb END, CASE WHEN lb <> '' THEN raw_index END) AS first_label
        FROM (SELECT *, {lab('raw', 'is_last')} AS lb FROM fxr_rawl) GROUP BY conv_id)),
j AS (SELECT m.*, rr.p_lab, rr.i_lab, o.participant_label, {is_diary('m.path')} AS diary
      FROM meta m LEFT JOIN rr USING (conv_id) LEFT JOIN orig o USING (conv_id)),
u AS (
  SELECT *, 'Participant' AS speaker_role, 0 AS pos,
    CASE WHEN diary THEN coalesce(participant_label, 'S0') WHEN p_lab IS NOT NULL THEN p_lab ELSE '' END AS label
  FROM j
  UNION ALL
  SELECT *, 'Interviewer', 1, CASE WHEN p_lab IS NOT NULL THEN i_lab ELSE '' END FROM j WHERE NOT diary)
SELECT CAST(conv_id * 2 + pos AS BIGINT) AS row_index, network, language, src_subject_id, interview_type, day,
       interview_number, label AS transcript_speaker_label, speaker_role, file_name
FROM u"""

# --- filled / new table ------------------------------------------------------------------------

#: Words count under the tagger's language, as tags do.
TAGGED_UNITS = FX_UNITS.replace(f"{lang_from_path('path')} AS lang,", "tagger AS lang,").replace(
    "FROM fx_paths JOIN fx_pres USING (conv_id))", "FROM fx_paths JOIN fx_pres USING (conv_id) JOIN fx_plang_t USING (conv_id) WHERE tagger IS NOT NULL)")

FEATURES = with_(FX_FILES, FX_LINES, DOC_LEXICON, PATH_LANG, units_cte("fx_plang_t"), TAGGED_UNITS, WORD_FREQ) + f""",
feat AS (
  SELECT p.file_name, s.speaker_role,
    {", ".join(f"CAST(sum(CASE WHEN tag = '{t}' THEN cnt ELSE 0 END) AS BIGINT) AS {n}" for t, n in TAGS.items())}
  FROM fx_sent s JOIN fx_paths p ON p.conv_id = s.conv_id
  LEFT JOIN fx_tally t ON t.conv_id = s.conv_id AND t.speaker_role = s.speaker_role GROUP BY p.file_name, s.speaker_role),
stats AS (
  SELECT p.file_name, s.speaker_role, s.num_sent,
    CASE WHEN w.word_freq IS NULL THEN 'nan' ELSE CAST(w.word_freq AS VARCHAR) END AS word_freq
  FROM fx_sent s JOIN fx_paths p USING (conv_id)
  LEFT JOIN fx_word_freq w ON w.conv_id = s.conv_id AND w.speaker_role = s.speaker_role),
feats AS (SELECT f.*, s.num_sent, s.word_freq FROM feat f
          LEFT JOIN stats s ON s.file_name = f.file_name AND s.speaker_role = f.speaker_role)"""

ORACLE["table_filled"] = FEATURES + "," + FX_TABLE + f"""
SELECT t.row_index, t.file_name, t.speaker_role, t.interview_type,
  {", ".join(f"CASE WHEN f.file_name IS NOT NULL THEN CAST(f.{n} AS VARCHAR) ELSE '' END AS {n}" for n in TAGS.values())},
  CASE WHEN f.file_name IS NOT NULL THEN CAST(f.num_sent AS VARCHAR) ELSE '' END AS num_sent,
  CASE WHEN f.file_name IS NOT NULL THEN f.word_freq ELSE '' END AS word_freq
FROM fx_table t LEFT JOIN feats f ON f.file_name = t.file_name AND f.speaker_role = t.speaker_role"""

ORACLE["new_table"] = FEATURES + f"""
SELECT {unknown(site_code('p.file_name'))} AS network,
  {unknown(lang_name(lang_from_path('p.path')))} AS language,
  {unknown(tok('p.file_name', 1))} AS src_subject_id, {unknown(tok('p.file_name', 3))} AS interview_type,
  {unknown(tok('p.file_name', 4))} AS day, {unknown(tok('p.file_name', 5))} AS interview_number,
  '' AS transcript_speaker_label, f.speaker_role,
  {", ".join(f"f.{n}" for n in TAGS.values())}, f.num_sent, f.word_freq, f.file_name
FROM feats f JOIN fx_paths p USING (file_name)
QUALIFY row_number() OVER (
  PARTITION BY concat_ws('_', network, src_subject_id, language, interview_type, day, interview_number), f.speaker_role
  ORDER BY f.file_name DESC) = 1"""

ORACLE["duplicate_names"] = with_(FX_FILES) + """
, shared AS (
  SELECT a.conv_id, b.file_name, a.dir || '/' || b.file_name AS path
  FROM fx_files a JOIN (SELECT DISTINCT conv_id % 30 AS k FROM fx_files) USING (k)""".replace("USING (k)", "ON k = a.conv_id % 30") + f"""
  JOIN (SELECT conv_id, {FX_NAME.strip()} AS file_name FROM (
          SELECT conv_id, CASE conv_id % 6 WHEN 0 THEN 'YA' WHEN 1 THEN 'MU' WHEN 2 THEN 'HK' WHEN 3 THEN 'MT' WHEN 4 THEN 'SH' ELSE 'ZZ' END AS site
          FROM (SELECT unnest(range(30)) AS conv_id))) b ON b.conv_id = k),
firsts AS (SELECT file_name, min(path) AS meta_path, max(path) AS tagged_path FROM shared GROUP BY file_name)
SELECT f.file_name, f.tagged_path, max(t.conv_id) AS tagged_id, f.meta_path, min(m.conv_id) AS meta_id
FROM firsts f JOIN shared t ON t.path = f.tagged_path JOIN shared m ON m.path = f.meta_path GROUP BY ALL"""

# --- lookup scenario -----------------------------------------------------------------------------

LOOKUP = with_(FX_FILES) + "," + FX_TABLE + f""",
disk AS (
  SELECT conv_id, dir || '/' || replace(file_name, '_REDACTED',
    '_submission' || repeat('0', CAST(conv_id % 3 AS INTEGER)) || CAST((conv_id * 37) % 100000 AS VARCHAR)) AS path
  FROM fx_paths),
ltable AS (
  SELECT t.row_index,
    CASE WHEN d.conv_id % 9 = 4 THEN regexp_replace({basename('d.path')}, '[.]txt$', '_copy.txt')
         WHEN d.conv_id % 2 = 0 THEN {norm_sub(basename('d.path'))} ELSE {basename('d.path')} END AS file_name,
    t.speaker_role, t.interview_type
  FROM fx_table t JOIN disk d ON d.conv_id = t.row_index // 2),
lindex AS (
  SELECT key, min(path) AS path FROM (
    SELECT path, {basename('path')} AS key FROM disk
    UNION SELECT path, {norm_sub(basename('path'))} FROM disk) GROUP BY key)"""


def flat_sql(table: str, index: str, mode: str, normalized: bool) -> str:
    route = (f"CASE WHEN {is_diary('name')} THEN 'diary' ELSE {norm_type_strict('label')} END"
             if mode == "diary_first" else
             f"CASE WHEN {norm_type('label')} = 'PSYCHS' THEN 'psychs' WHEN {norm_type('label')} = 'OPEN' THEN 'open' "
             f"WHEN {norm_type('label')} = 'DIARY' OR {is_diary("coalesce(name, '')")} THEN 'diary' END")
    probe2 = (f"LEFT JOIN {index} i2 ON i2.key = {norm_sub('name')}" if normalized else "")
    src = "coalesce(i1.path, i2.path)" if normalized else "i1.path"
    return f"""
, first_rows AS (
  SELECT {basename('file_name')} AS name, arg_min(interview_type, row_index) AS label, count(*) AS n_rows
  FROM {table} GROUP BY 1),
flat AS (
  SELECT name, {route} AS target, {src} AS source_path, n_rows
  FROM first_rows LEFT JOIN {index} i1 ON i1.key = name {probe2}),
flat_out AS (
  SELECT name, target, source_path,
    CASE WHEN source_path IS NULL THEN 'not_found' WHEN target IS NULL THEN 'unknown_type' ELSE target END AS outcome,
    n_rows - 1 AS duplicates
  FROM flat)"""


ORACLE["semi_filter"] = LOOKUP + f"""
SELECT conv_id, path FROM disk WHERE {basename('path')} IN (SELECT file_name FROM ltable)"""

ORACLE["file_lookup"] = LOOKUP + flat_sql("ltable", "lindex", "diary_first", True) + """
SELECT * FROM flat_out"""

ORACLE["copy_summary"] = LOOKUP + flat_sql("ltable", "lindex", "diary_first", True) + """
SELECT outcome, count(*) AS n_files, CAST(sum(duplicates) AS BIGINT) AS duplicate_rows FROM flat_out GROUP BY outcome"""

ORACLE["missing_files"] = LOOKUP + f"""
SELECT DISTINCT {basename('file_name')} AS name FROM ltable
WHERE {basename('file_name')} IS NOT NULL AND {basename('file_name')} NOT IN (SELECT key FROM lindex)"""

# --- routing / flat copy of the verify step -------------------------------------------------------

ROUTE_CLI = (f"CASE WHEN {norm_type('interview_type')} = 'PSYCHS' THEN 'psychs' "
             f"WHEN {norm_type('interview_type')} = 'OPEN' THEN 'open' "
             f"WHEN {norm_type('interview_type')} = 'DIARY' OR {is_diary("coalesce(file_name, '')")} THEN 'diary' END")
ROUTE_FLAT = (f"CASE WHEN {is_diary("coalesce(file_name, '')")} THEN 'diary' "
              f"ELSE {norm_type_strict('interview_type')} END")

TABLE_BASE = with_(FX_FILES) + "," + FX_TABLE

ORACLE["routed"] = TABLE_BASE + f"""
SELECT row_index, file_name, {ROUTE_CLI} AS target_cli, {ROUTE_FLAT} AS target_flat FROM fx_table"""

ORACLE["split_counts"] = TABLE_BASE + f"""
SELECT coalesce({ROUTE_CLI}, 'unknown') AS target, count(*) AS n_rows FROM fx_table GROUP BY 1"""

INDEX = f"""
findex AS (
  SELECT key, min(path) AS path FROM (
    SELECT path, {basename('path')} AS key FROM fx_paths
    UNION SELECT path, {norm_sub(basename('path'))} FROM fx_paths) GROUP BY key)"""

ORACLE["flat_by_type"] = TABLE_BASE + "," + INDEX + flat_sql("fx_table", "findex", "type_first", False) + """
SELECT * FROM flat_out"""

# --- verification -----------------------------------------------------------------------------------

UNITS = f"""
vrows AS (
  SELECT file_name AS filename, row_index, {norm_type('interview_type')} AS label, speaker_role AS role
  FROM fx_table WHERE file_name IS NOT NULL AND file_name <> '' AND NOT {is_diary('file_name')}),
units AS (
  SELECT u.*, i.path AS source_path FROM (
    SELECT filename, min(row_index) AS first_row_index, arg_min(label, row_index) AS expected, count(*) AS n_rows
    FROM vrows GROUP BY filename) u JOIN findex i ON i.key = u.filename)"""

UNITS_MISC = f"""
mrows AS (SELECT {basename('file_name')} AS filename, row_index, {norm_type('interview_type')} AS label, speaker_role AS role
          FROM fx_table),
mrows2 AS (SELECT * FROM mrows WHERE filename IS NOT NULL AND filename <> '' AND NOT {is_diary('filename')}),
mcounts AS (SELECT filename, count(*) AS n_rows FROM mrows2 GROUP BY filename),
units_misc AS (
  SELECT u.filename, u.first_row_index, u.expected, c.n_rows, coalesce(i1.path, i2.path) AS source_path FROM (
    SELECT filename, min(row_index) AS first_row_index, arg_min(label, row_index) AS expected FROM mrows2
    WHERE (role IS NULL OR upper(role) <> 'INTERVIEWER') AND label IN ('OPEN', 'PSYCHS') GROUP BY filename) u
  JOIN mcounts c USING (filename)
  LEFT JOIN findex i1 ON i1.key = u.filename LEFT JOIN findex i2 ON i2.key = {norm_sub('u.filename')}
  WHERE coalesce(i1.path, i2.path) IS NOT NULL)"""

CUES = r"(?i)\b(how often|how long|how much|last month|past month|frequency|duration|often)\b"

from parlance.plans.oracle_answers import TYPED  # noqa: E402

VERDICTS = f"""{TYPED},
preds AS (SELECT p.path AS source_path, t.predicted FROM typed t JOIN fx_paths p USING (conv_id)),
verdicts AS (
  SELECT u.filename, u.first_row_index, u.expected, p.predicted,
    CASE WHEN p.predicted IS NULL THEN 'parse_failure' WHEN p.predicted = u.expected THEN 'match' ELSE 'mismatch' END AS verdict
  FROM units u JOIN preds p USING (source_path)),
mism AS (
  SELECT t.row_index, v.filename, v.expected,
    CASE WHEN v.verdict = 'parse_failure' THEN 'PARSE_FAILURE' ELSE v.predicted END AS predicted,
    CASE WHEN v.verdict = 'parse_failure' THEN 'Failed to parse model response' ELSE 'Mismatch' END AS reason
  FROM fx_table t JOIN verdicts v ON v.filename = t.file_name WHERE v.verdict <> 'match'),
fixes AS (
  SELECT filename, upper(arg_min(expected, row_index)) AS old_type, upper(arg_min(predicted, row_index)) AS new_type
  FROM mism WHERE predicted <> 'PARSE_FAILURE' GROUP BY filename),
fixes2 AS (
  SELECT filename, old_type, new_type,
    replace(filename, '_' || lower(old_type) || '_', '_' || lower(new_type) || '_') AS new_filename FROM fixes)"""

VERIFY_BASE = with_(FX_FILES, FX_LINES) + "," + FX_TABLE + "," + INDEX + "," + UNITS + "," + VERDICTS

ORACLE["units"] = with_(FX_FILES) + "," + FX_TABLE + "," + INDEX + "," + UNITS + """
SELECT filename, first_row_index, expected, n_rows, source_path FROM units"""

ORACLE["units_misc"] = with_(FX_FILES) + "," + FX_TABLE + "," + INDEX + "," + UNITS_MISC + """
SELECT * FROM units_misc"""

ORACLE["verdicts"] = VERIFY_BASE + """
SELECT * FROM verdicts"""

ORACLE["mismatches"] = VERIFY_BASE + """
SELECT * FROM mism"""

ORACLE["accuracy"] = VERIFY_BASE + """
SELECT count(*) AS processed, CAST(count_if(verdict = 'match') AS BIGINT) AS matched,
  CAST(count_if(verdict = 'mismatch') AS BIGINT) AS mismatched,
  CAST(count_if(verdict = 'parse_failure') AS BIGINT) AS parse_failures,
  CASE WHEN count(*) > 0 THEN CAST(count_if(verdict = 'match') AS DOUBLE) / CAST(count(*) AS DOUBLE) END AS accuracy
FROM verdicts"""

ORACLE["fix_plan"] = VERIFY_BASE + """
SELECT * FROM fixes2"""

ORACLE["corrections"] = VERIFY_BASE + """
SELECT t.row_index, coalesce(f.new_filename, t.file_name) AS file_name, t.speaker_role,
       coalesce(f.new_type, t.interview_type) AS interview_type
FROM fx_table t LEFT JOIN fixes2 f ON f.filename = t.file_name"""

ORACLE["table_versions"] = VERIFY_BASE + """
SELECT 1 AS version, row_index, file_name, speaker_role, interview_type FROM fx_table
UNION ALL
SELECT 2, t.row_index, coalesce(f.new_filename, t.file_name), t.speaker_role, coalesce(f.new_type, t.interview_type)
FROM fx_table t LEFT JOIN fixes2 f ON f.filename = t.file_name"""

ORACLE["write_summaries"] = f"""
WITH a AS ({ORACLE["accuracy"]}), c AS ({ORACLE["copy_summary"]}), s AS ({ORACLE["split_counts"]})
SELECT 'copies' AS summary, outcome AS value, n_files AS n, CAST(duplicate_rows AS BIGINT) AS duplicate_rows FROM c
UNION ALL SELECT 'splits', target, n_rows, NULL FROM s
UNION ALL SELECT 'verdicts', 'processed', processed, NULL FROM a
UNION ALL SELECT 'verdicts', 'matched', matched, NULL FROM a
UNION ALL SELECT 'verdicts', 'mismatched', mismatched, NULL FROM a
UNION ALL SELECT 'verdicts', 'parse_failures', parse_failures, NULL FROM a"""

ORACLE["splits_corrected"] = VERIFY_BASE + f""",
splits AS (SELECT *, {ROUTE_CLI} AS target FROM fx_table)
SELECT s.row_index, coalesce(f.new_filename, s.file_name) AS file_name,
       coalesce(f.new_type, s.interview_type) AS interview_type, coalesce(lower(f.new_type), s.target) AS target
FROM splits s LEFT JOIN fixes2 f ON f.filename = s.file_name WHERE s.target IS NOT NULL"""

ORACLE["fix_moves"] = VERIFY_BASE + """
SELECT filename, lower(old_type) AS old_target, new_filename, lower(new_type) AS new_target FROM fixes2"""

ORACLE["slice_per_language"] = with_(FX_FILES) + f"""
, fl AS (SELECT conv_id, file_name, {lang_from_path('path')} AS language FROM fx_paths)
SELECT conv_id, file_name, language FROM (
  SELECT *, row_number() OVER (PARTITION BY language ORDER BY file_name) AS r FROM fl) WHERE r <= 5"""

ORACLE["lexicon_anc"] = f"""
WITH w AS (SELECT unnest({words('text')}) AS word FROM benchmark),
c AS (SELECT word, count(*) AS count FROM w GROUP BY word),
anc AS (
  SELECT word, word AS lemma,
    CASE length(word) % 5 WHEN 0 THEN 'NN' WHEN 1 THEN 'VBD' WHEN 2 THEN 'RP' WHEN 3 THEN 'DT' ELSE 'SYM' END AS pos,
    count FROM c)
SELECT word, lemma, pos, count, CAST(count AS DOUBLE) / CAST((SELECT sum(count) FROM anc) AS DOUBLE) AS frequency
FROM anc"""


NON_WORD_CASED = r"[^\p{L}\p{N}_\p{Z}\x09-\x0d\x1c-\x1f\x85]"

ORACLE["lexicon_dictionary"] = f"""
WITH toks AS (
  SELECT unnest(list_filter(regexp_split_to_array(regexp_replace(text, '{NON_WORD_CASED}', '', 'g'),
                                                   '[\\p{{Z}}\\x09-\\x0d\\x1c-\\x1f\\x85]+'), lambda w: w <> '')) AS Word
  FROM documents),
sub AS (SELECT Word, count(*) AS FREQcount FROM toks GROUP BY Word),
sub2 AS (SELECT Word, FREQcount, CAST(round(log10(FREQcount) * 10000) AS BIGINT) / 10000.0 AS Lg10WF FROM sub),
lex AS (
  SELECT lower(Word) AS word, Word AS ord, CAST(FREQcount AS DOUBLE) / CAST((SELECT sum(FREQcount) FROM sub2) AS DOUBLE) AS frequency,
         Lg10WF AS log_frequency FROM sub2)
SELECT word, arg_max(log_frequency, ord) AS log_frequency, arg_max(frequency, ord) AS frequency
FROM lex GROUP BY word"""


ORACLE["types_builtin"] = with_(FX_LINES) + f"""
SELECT conv_id, CASE WHEN hit = 1 THEN '{{PSYCHS}}' ELSE '{{OPEN}}' END AS response,
       CASE WHEN hit = 1 THEN 'PSYCHS' ELSE 'OPEN' END AS predicted
FROM (SELECT conv_id, max(CASE WHEN regexp_matches(raw, '{CUES}') THEN 1 ELSE 0 END) AS hit
      FROM fx_rawl GROUP BY conv_id)"""


# --- tokens and prompts ---------------------------------------------------------------------

from parlance.plans.oracle_answers import ROLE_PROMPT, SYSTEM, TYPE_PROMPT, parts_of, sql_lit  # noqa: E402
from parlance.plans.oracle_tags import TAG_BASE  # noqa: E402

ORACLE["tokens"] = TAG_BASE + """
SELECT conv_id, speaker_role, CAST(line_index AS BIGINT) AS line_index, sent_id, word_id, word, lemma,
       upos, xpos, deprel, feats FROM fx_tok"""

ORACLE["prompts"] = with_(FXR_LINES) + "," + label_map_ctes("fxt", "fxr_rawl")[1:] + f""",
norm_at AS (SELECT n.conv_id, n.raw_index, n.raw, r.char_offset FROM fxt_norm n JOIN fxr_rawl r USING (conv_id, raw_index)),
role_p AS (SELECT conv_id, part, string_agg(piece, chr(10) ORDER BY raw_index) AS text
           FROM ({parts_of('norm_at', 5000)}) GROUP BY conv_id, part),
type_p AS (SELECT conv_id, part, string_agg(piece, chr(10) ORDER BY raw_index) AS text
           FROM ({parts_of('fxr_rawl', 40000)}) GROUP BY conv_id, part)
SELECT conv_id, 'roles' AS kind, part, {sql_lit(SYSTEM)} AS system, {ROLE_PROMPT} AS prompt FROM role_p
UNION ALL
SELECT conv_id, 'type' AS kind, part, {sql_lit("Thinking: low" + chr(10) + SYSTEM)} AS system,
       {TYPE_PROMPT} AS prompt FROM type_p"""
