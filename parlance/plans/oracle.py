"""Reference SQL (DuckDB dialect) for the registered queries.

Each string is an independent statement over the driver's views
(``conversations``, ``documents``, ...).  The SQL is written for clarity, not
scale: it is the specification the Spark plans are checked against.

Shared building blocks are SQL text fragments (CTEs) composed below.
"""

from __future__ import annotations

# --- FIXED VALUES: patterns in DuckDB (RE2) syntax -------------------------------------
WS = r"[\p{Z}\x09-\x0d\x1c-\x1f\x85]"
TS = r"\p{Nd}{2}:\p{Nd}{2}:\p{Nd}{2}\.\p{Nd}{3}"


def strip(x: str) -> str:
    return f"regexp_replace({x}, '^{WS}+|{WS}+\\z', '', 'g')"


FX_NAME = """
  (CASE WHEN conv_id % 2 = 0 THEN 'Northnet' ELSE 'Southnet' END) || site || '_' || site ||
  substr(CAST(10000000 + conv_id AS VARCHAR), 2) || '_' ||
  (CASE WHEN conv_id % 11 = 0 THEN 'diary' ELSE 'interviewAudioTranscript' END) || '_' ||
  (CASE WHEN conv_id % 11 = 0 THEN 'diary' WHEN conv_id % 3 = 0 THEN 'open' ELSE 'psychs' END) ||
  '_day' || substr(CAST(10001 + conv_id % 90 AS VARCHAR), 2) ||
  '_session' || substr(CAST(10001 + conv_id % 3 AS VARCHAR), 2) || '_REDACTED.txt'"""

FX_DIR = """
  '/fx/' || (CASE WHEN conv_id % 5 = 0 THEN 'CHR' WHEN conv_id % 5 = 1 THEN 'hc_group' ELSE 'other' END)
  || '/' || (CASE WHEN conv_id % 4 = 3 THEN 'en'
                  ELSE 'Language.' || (CASE conv_id % 4 WHEN 0 THEN 'en' WHEN 1 THEN 'de' ELSE 'cn' END) END)"""

# files: conv_id, file_name, dir, path
FX_FILES = f"""
fx_ids AS (
  SELECT DISTINCT conv_id,
    CASE conv_id % 6 WHEN 0 THEN 'YA' WHEN 1 THEN 'MU' WHEN 2 THEN 'HK' WHEN 3 THEN 'MT'
                     WHEN 4 THEN 'SH' ELSE 'ZZ' END AS site
  FROM conversations),
fx_files AS (
  SELECT conv_id, {FX_NAME} AS file_name, {FX_DIR} AS dir FROM fx_ids),
fx_paths AS (
  SELECT conv_id, file_name, dir, dir || '/' || file_name AS path FROM fx_files)"""

FX_FIRST_LINE = """
  (CASE role WHEN 'user' THEN 'PARTICIPANT' WHEN 'assistant' THEN 'INTERVIEWER' ELSE 'S3' END) ||
  (CASE WHEN turn % 3 = 0 THEN ': 00:' WHEN turn % 3 = 1 THEN ' 00:' ELSE ': ' END) ||
  (CASE WHEN turn % 3 < 2 THEN '0' || CAST(turn % 10 AS VARCHAR) || ':00.000 ' ELSE '' END) || text"""

FXR_FIRST_LINE = """
  (CASE WHEN conv_id % 3 = 0 THEN (CASE role WHEN 'user' THEN 'S2' WHEN 'assistant' THEN 'S1' ELSE 'S3' END)
        WHEN conv_id % 3 = 1 THEN (CASE role WHEN 'user' THEN 'SP' WHEN 'assistant' THEN 'SI' ELSE 'S9' END)
        ELSE (CASE role WHEN 'user' THEN 'S1' WHEN 'assistant' THEN 'S0' ELSE 'S2' END) END) ||
  (CASE WHEN turn % 2 = 0 THEN ': ' ELSE ' ' END) || text"""


def raw_lines_cte(prefix: str = "fx", first_line: str = FX_FIRST_LINE) -> str:
    """CTEs ``{p}_rawi`` (all raw lines) and ``{p}_lines`` (parsed non-blank lines)."""
    p = prefix
    return f"""
{p}_turns AS (
  SELECT conv_id, turn, string_split({first_line}, chr(10)) AS ls FROM conversations),
{p}_raw AS (
  SELECT conv_id, turn, unnest(ls) AS raw, unnest(generate_series(1, len(ls))) AS pos FROM {p}_turns),
{p}_rawi AS (
  SELECT conv_id, raw,
    row_number() OVER (PARTITION BY conv_id ORDER BY turn, pos) AS raw_index,
    count(*) OVER (PARTITION BY conv_id) AS n_total,
    coalesce(sum(length(raw) + 1) OVER (PARTITION BY conv_id ORDER BY turn, pos
             ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS char_offset,
    {strip('raw')} AS s
  FROM {p}_raw),
{p}_rawl AS (
  SELECT *, raw_index = n_total AS is_last FROM {p}_rawi),
{p}_kept AS (
  SELECT conv_id, raw_index, s,
    row_number() OVER (PARTITION BY conv_id ORDER BY raw_index) AS line_index
  FROM {p}_rawi WHERE s <> ''),
{p}_lines AS (
  SELECT conv_id, line_index, raw_index,
    CASE WHEN starts_with(s, 'PARTICIPANT') THEN 'PARTICIPANT'
         WHEN starts_with(s, 'INTERVIEWER') THEN 'INTERVIEWER' ELSE 'UNKNOWN' END AS speaker,
    regexp_extract(s, '(?s)^.*?({TS})', 1) AS ts,
    CASE WHEN regexp_matches(s, '{TS}') THEN {strip(f"regexp_extract(s, '(?s)^.*?{TS}(.*)\\z', 1)")}
         WHEN strpos(s, ':') > 0 THEN {strip("substr(s, strpos(s, ':') + 1)")}
         ELSE s END AS text
  FROM {p}_kept)"""


FX_LINES = raw_lines_cte("fx", FX_FIRST_LINE)
FXR_LINES = raw_lines_cte("fxr", FXR_FIRST_LINE)


NON_WORD = r"[^\p{L}\p{N}_\p{Z}\x09-\x0d\x1c-\x1f\x85]"
LANG_CODES = "'UNKNOWN','zh','es','en','ko','it','ja','da','de','fr','yue','cn'"


def words(x: str) -> str:
    return (f"list_filter(regexp_split_to_array(regexp_replace(lower({x}), '{NON_WORD}', '', 'g'), "
            f"'{WS}+'), lambda w: w <> '')")


def dir_parts_nearest_first(path: str) -> str:
    return f"list_reverse(list_slice(string_split({path}, '/'), 1, len(string_split({path}, '/')) - 1))"


def lang_from_path(path: str) -> str:
    return (f"coalesce(list_filter(list_transform({dir_parts_nearest_first(path)}, lambda p: "
            f"CASE WHEN regexp_replace(p, '^Language[.]', '') IN ({LANG_CODES}) "
            f"THEN regexp_replace(p, '^Language[.]', '') END), lambda x: x IS NOT NULL)[1], 'UNKNOWN')")


def group_from_path(path: str) -> str:
    return (f"coalesce(list_filter(list_transform({dir_parts_nearest_first(path)}, lambda p: "
            f"CASE WHEN contains(upper(p), 'CHR') THEN 'CHR' WHEN contains(upper(p), 'HC') THEN 'HC' END),"
            f" lambda x: x IS NOT NULL)[1], 'UNKNOWN')")


def is_diary(x: str) -> str:
    return f"(contains({x}, 'audioJournal') OR contains(lower({x}), 'diary'))"


DOC_LEXICON = f"""
doc_words AS (SELECT lang, unnest({words('text')}) AS word FROM documents),
doc_counts AS (SELECT lang, word, count(*) AS cnt FROM doc_words GROUP BY lang, word),
doc_totals AS (SELECT lang, sum(cnt) AS total FROM doc_counts GROUP BY lang),
doc_lex AS (
  SELECT lang, word, cnt, CAST(cnt AS DOUBLE) / CAST(total AS DOUBLE) AS frequency,
         CAST(round(log10(cnt) * 10000) AS BIGINT) AS lg_e4
  FROM doc_counts JOIN doc_totals USING (lang))"""

FX_UNITS = f"""
fx_w AS (SELECT conv_id, speaker, unnest({words('text')}) AS word FROM fx_lines),
fx_pres AS (
  SELECT conv_id, max(CASE WHEN speaker = 'PARTICIPANT' THEN 1 ELSE 0 END) AS has_p,
         max(CASE WHEN speaker = 'INTERVIEWER' THEN 1 ELSE 0 END) AS has_i
  FROM fx_lines GROUP BY conv_id),
fx_meta AS (
  SELECT conv_id, {lang_from_path('path')} AS lang, {is_diary('path')} AS diary, has_p, has_i
  FROM fx_paths JOIN fx_pres USING (conv_id)),
fx_units AS (
  SELECT conv_id, 'Participant' AS speaker_role, lang, word FROM fx_w JOIN fx_meta USING (conv_id)
  WHERE speaker = 'PARTICIPANT' OR has_p = 0 OR diary
  UNION ALL
  SELECT conv_id, 'Interviewer' AS speaker_role, lang, word FROM fx_w JOIN fx_meta USING (conv_id)
  WHERE (speaker = 'INTERVIEWER' OR has_i = 0) AND NOT diary)"""

WORD_FREQ = """
fx_wf AS (
  SELECT conv_id, speaker_role, u.lang, count(*) AS n_words, count(lg_e4) AS found,
         sum(lg_e4) AS s
  FROM fx_units u LEFT JOIN doc_lex l ON u.lang = l.lang AND u.word = l.word
  GROUP BY conv_id, speaker_role, u.lang),
fx_word_freq AS (
  SELECT conv_id, speaker_role, lang, CAST(n_words AS BIGINT) AS n_words, CAST(found AS BIGINT) AS found,
         CAST(n_words - found AS BIGINT) AS missing,
         CASE WHEN found > 0 THEN CAST(s AS DOUBLE) / CAST(found * 10000 AS DOUBLE) END AS word_freq,
         CAST(found * 100 AS DOUBLE) / CAST(n_words AS DOUBLE) AS coverage
  FROM fx_wf)"""


def with_(*ctes: str) -> str:
    return "WITH " + ",".join(ctes)


ORACLE: dict[str, str] = {}

ORACLE["lines"] = with_(FX_LINES) + """
SELECT conv_id, CAST(line_index AS BIGINT) AS line_index, CAST(raw_index AS BIGINT) AS raw_index,
       speaker, ts, text FROM fx_lines"""

ORACLE["word_freq"] = with_(FX_FILES, FX_LINES, FX_UNITS, DOC_LEXICON, WORD_FREQ) + """
SELECT * FROM fx_word_freq"""

ORACLE["lexicon"] = with_(DOC_LEXICON) + """
SELECT lang, word, CAST(cnt AS BIGINT) AS cnt, frequency, lg_e4 FROM doc_lex"""


# --- metadata from names and paths -------------------------------------------------------

from parlance.constants import LANGUAGES, SITES  # noqa: E402  (shared fixed values)


def tok(x: str, i: int) -> str:
    return f"string_split({x}, '_')[{i + 1}]"


def site_code(name: str) -> str:
    arr = ", ".join(f"'{s}'" for s, _ in SITES)
    return f"list_filter([{arr}], lambda s: contains({tok(name, 0)}, s))[1]"


def site_langs(site: str) -> str:
    whens = " ".join(f"WHEN '{s}' THEN [{', '.join(repr(l) for l in langs)}]" for s, langs in SITES)
    return f"(CASE upper({site}) {whens} ELSE ['UNKNOWN'] END)"


def lang_name(code: str) -> str:
    whens = " ".join(f"WHEN '{c}' THEN '{n}'" for c, n in LANGUAGES)
    return f"(CASE {code} {whens} ELSE {code} END)"


def norm_type(x: str) -> str:
    u = f"upper({strip(x)})"
    return (f"(CASE WHEN {u} IN ('OPEN','OPENEND','OPEN-ENDED','OPEN_ENDED') THEN 'OPEN' "
            f"WHEN {u} IN ('PSYCHS','PSYCH') THEN 'PSYCHS' ELSE {u} END)")


def norm_type_strict(x: str) -> str:
    u = f"upper({strip(x)})"
    return (f"(CASE WHEN {u} IN ('OPEN','OPENEND','OPEN-ENDED','OPEN_ENDED') THEN 'open' "
            f"WHEN {u} IN ('PSYCHS','PSYCH') THEN 'psychs' END)")


def resolve_lang(lang: str, site: str) -> str:
    return (f"(CASE WHEN {site} IS NULL THEN {lang} WHEN list_contains({site_langs(site)}, {lang}) "
            f"THEN {lang} ELSE 'UNKNOWN' END)")


FX_META = FX_FILES + f""",
fx_meta0 AS (
  SELECT conv_id, file_name, path, {site_code('file_name')} AS site,
         {lang_from_path('path')} AS language, {group_from_path('path')} AS clinical_group
  FROM fx_paths)"""

ORACLE["filename_fields"] = with_(FX_FILES) + f"""
, s AS (SELECT conv_id, array_to_string(list_slice(string_split(file_name, '_'), 1, conv_id % 7 + 1), '_') AS name
        FROM fx_paths)
SELECT conv_id, name, {tok('name', 1)} AS patient_id, {tok('name', 3)} AS interview_type,
       {tok('name', 4)} AS day, {tok('name', 5)} AS session,
       coalesce(nullif({tok('name', 5)}, ''), 'UNKNOWN') AS session_or_unknown
FROM s"""

ORACLE["site_code"] = with_(FX_META) + f"""
SELECT conv_id, site, array_to_string({site_langs('site')}, ',') AS site_languages,
       {site_langs('site')}[1] AS primary_language, {lang_name(site_langs('site') + '[1]')} AS primary_language_name
FROM fx_meta0"""

ORACLE["clinical_group"] = with_(FX_META) + """
SELECT conv_id, path, clinical_group FROM fx_meta0"""

ORACLE["path_language"] = with_(FX_META) + f"""
SELECT conv_id, language, {lang_name('language')} AS language_name FROM fx_meta0"""

ORACLE["site_languages"] = with_(FX_META) + f"""
SELECT conv_id, site, language, list_contains({site_langs('site')}, language) AS allowed,
       {resolve_lang('language', 'site')} AS resolved
FROM fx_meta0"""

ORACLE["diary_flags"] = with_(FX_FILES) + f"""
, a AS (SELECT conv_id, CASE WHEN conv_id % 13 = 0
                   THEN regexp_replace(path, 'interviewAudioTranscript', 'audioJournal', 'g') ELSE path END AS path
        FROM fx_paths)
SELECT conv_id, {is_diary('path')} AS diary_path, {is_diary("string_split(path, '/')[-1]")} AS diary_name,
       len(list_filter(string_split(path, '/'), lambda p: contains(lower(p), 'diary'))) > 0 AS diary_parts
FROM a"""

TYPE_LABEL = f"""
  CASE conv_id % 8 WHEN 0 THEN ' ' || {tok('file_name', 3)} || ' ' WHEN 1 THEN 'Open-Ended'
    WHEN 2 THEN 'psych' WHEN 3 THEN 'OPEN_ENDED' WHEN 4 THEN upper({tok('file_name', 3)})
    WHEN 5 THEN NULL WHEN 6 THEN 'openend' ELSE {tok('file_name', 3)} END"""

ORACLE["interview_types"] = with_(FX_FILES) + f"""
, t AS (SELECT conv_id, {TYPE_LABEL} AS label FROM fx_paths)
SELECT conv_id, label, {norm_type('label')} AS normalized, {norm_type_strict('label')} AS strict FROM t"""

ORACLE["submissions"] = with_(FX_FILES) + """
, n AS (SELECT conv_id, replace(file_name, '_REDACTED',
          '_submission' || repeat('0', CAST(conv_id % 3 AS INTEGER)) || CAST((conv_id * 37) % 100000 AS VARCHAR)) AS name
        FROM fx_paths),
d AS (SELECT conv_id, name, regexp_extract(name, 'submission([0-9]+)', 1) AS digits FROM n),
v AS (SELECT *, CAST(CAST(digits AS HUGEINT) AS VARCHAR) AS num FROM d)
SELECT conv_id, name,
  CASE WHEN digits = '' THEN name ELSE
    substr(name, 1, strpos(name, 'submission') - 1) || 'submission' ||
    (CASE WHEN length(num) < 4 THEN lpad(num, 4, '0') ELSE num END) ||
    substr(name, strpos(name, 'submission') + 10 + length(digits)) END AS normalized
FROM v"""

ORACLE["corrected_names"] = with_(FX_FILES) + f"""
, t AS (SELECT conv_id, file_name, upper({tok('file_name', 3)}) AS old_type FROM fx_paths)
SELECT conv_id, old_type, CASE WHEN old_type = 'PSYCHS' THEN 'OPEN' ELSE 'PSYCHS' END AS new_type,
       replace(file_name, '_' || lower(old_type) || '_',
               '_' || lower(CASE WHEN old_type = 'PSYCHS' THEN 'OPEN' ELSE 'PSYCHS' END) || '_') AS new_name
FROM t"""


# --- speaker labels, roles, language -------------------------------------------------------

from parlance.constants import TAGGER_LANGUAGES  # noqa: E402

SL = r"S[IP\p{Nd}]+"


def lab(raw: str, is_last: str) -> str:
    return (f"(CASE WHEN regexp_extract({raw}, '^({SL})(:|{WS})', 1) <> '' "
            f"THEN regexp_extract({raw}, '^({SL})(:|{WS})', 1) "
            f"WHEN regexp_matches({raw}, '^{SL}\\z') AND NOT {is_last} THEN {raw} ELSE '' END)")


def role_present(raw: str, role: str, is_last: str) -> str:
    return f"(regexp_matches({raw}, '^{role}(:|{WS})') OR ({raw} = '{role}' AND NOT {is_last}))"


def label_tail(raw: str, label: str) -> str:
    t = f"substr({raw}, length({label}) + 1)"
    return f"(CASE WHEN starts_with({t}, ':') THEN substr({t}, 2) ELSE {t} END)"


def label_map_ctes(p: str, src: str) -> str:
    """``{p}_lab`` labels of ``src`` lines, ``{p}_map`` C12 mapping, ``{p}_norm`` rewritten lines."""
    return f"""
{p}_lab AS (SELECT conv_id, raw_index, raw, is_last, {lab('raw', 'is_last')} AS label FROM {src}),
{p}_dl AS (SELECT DISTINCT conv_id, label FROM {p}_lab WHERE label <> ''),
{p}_needs AS (SELECT conv_id FROM {p}_dl GROUP BY conv_id
              HAVING max(CASE WHEN label NOT IN ('S1', 'S2', 'S3') THEN 1 ELSE 0 END) = 1),
{p}_map AS (
  SELECT conv_id, label AS original, 'S' || CAST(rk AS VARCHAR) AS normalized FROM (
    SELECT conv_id, label, row_number() OVER (PARTITION BY conv_id ORDER BY label) AS rk
    FROM {p}_dl JOIN {p}_needs USING (conv_id)) WHERE rk <= 3),
{p}_norm AS (
  SELECT l.conv_id, raw_index, is_last, label,
    CASE WHEN m.normalized IS NOT NULL THEN m.normalized || ':' || {label_tail('raw', 'label')} ELSE raw END AS raw,
    coalesce(m.normalized, label) AS norm_label
  FROM {p}_lab l LEFT JOIN {p}_map m ON l.conv_id = m.conv_id AND l.label = m.original)"""


ORACLE["role_lines"] = with_(FX_LINES) + """
SELECT conv_id, speaker, CAST(line_index AS BIGINT) AS line_index,
  CAST(row_number() OVER (PARTITION BY conv_id, speaker ORDER BY line_index) AS BIGINT) AS role_ordinal,
  CAST(count(*) OVER (PARTITION BY conv_id, speaker) AS BIGINT) AS n_role_lines
FROM fx_lines WHERE speaker IN ('PARTICIPANT', 'INTERVIEWER')"""

COLON_FIX = f"""
fx_fix AS (
  SELECT conv_id, raw_index, raw,
    CASE WHEN regexp_matches(raw, '^(PARTICIPANT|INTERVIEWER){WS}')
           THEN regexp_replace(raw, '^(PARTICIPANT|INTERVIEWER)', '\\1:')
         WHEN raw IN ('PARTICIPANT', 'INTERVIEWER') AND NOT is_last THEN raw || ':'
         ELSE raw END AS fixed
  FROM fx_rawl)"""

ORACLE["colon_fix"] = with_(FX_LINES, COLON_FIX) + """
SELECT conv_id, CAST(raw_index AS BIGINT) AS raw_index, fixed FROM fx_fix WHERE fixed <> raw"""

ORACLE["cleaning_summary"] = with_(FX_LINES, COLON_FIX) + """
, per_file AS (SELECT conv_id, count_if(fixed <> raw) AS n FROM fx_fix GROUP BY conv_id)
SELECT CAST(count(*) AS BIGINT) AS files_scanned, CAST(count_if(n > 0) AS BIGINT) AS files_modified,
       CAST(coalesce(sum(n), 0) AS BIGINT) AS total_fixes FROM per_file"""

ORACLE["speaker_normalize"] = with_(FXR_LINES, label_map_ctes("fxr", "fxr_rawl")) + """
SELECT conv_id, original, normalized FROM fxr_map"""


def original_labels_sql(p: str, corpus: str) -> str:
    return f"""
SELECT conv_id, '{corpus}' AS corpus,
  CASE WHEN has_p = 1 THEN 'PARTICIPANT' WHEN has_p = 0 AND has_i = 0 THEN first_label END AS participant_label,
  CASE WHEN has_i = 1 THEN 'INTERVIEWER' END AS interviewer_label
FROM (SELECT conv_id,
        max(CASE WHEN {role_present('raw', 'PARTICIPANT', 'is_last')} THEN 1 ELSE 0 END) AS has_p,
        max(CASE WHEN {role_present('raw', 'INTERVIEWER', 'is_last')} THEN 1 ELSE 0 END) AS has_i,
        arg_min(CASE WHEN lb <> '' THEN lb END, CASE WHEN lb <> '' THEN raw_index END) AS first_label
      FROM (SELECT *, {lab('raw', 'is_last')} AS lb FROM {p}_rawl) GROUP BY conv_id)"""


ORACLE["original_labels"] = with_(FX_LINES, FXR_LINES) + original_labels_sql("fx", "labelled") + \
    " UNION ALL " + original_labels_sql("fxr", "raw")

ROLE_ANSWER = f"(?i)(S[123]):{WS}*(INTERVIEWER|PARTICIPANT)"

K3_CTES = label_map_ctes("fxt", "fxr_t") + f""",
fxt_stats AS (
  SELECT conv_id, norm_label, count(*) AS n, count_if(ends_with(t, '?')) AS q, sum(len({words('t')})) AS nw
  FROM (SELECT conv_id, norm_label, {strip(label_tail('raw', 'norm_label'))} AS t FROM fxt_norm
        WHERE norm_label IN ('S1', 'S2', 'S3'))
  GROUP BY conv_id, norm_label),
fxt_rank AS (
  SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY CAST(q AS DOUBLE) / CAST(n AS DOUBLE) DESC,
                               CAST(nw AS DOUBLE) / CAST(n AS DOUBLE) ASC, norm_label ASC) AS ri
  FROM fxt_stats),
fxt_part AS (
  SELECT conv_id, norm_label AS p_lab FROM (
    SELECT conv_id, norm_label, row_number() OVER (PARTITION BY conv_id ORDER BY nw DESC, norm_label ASC) AS rp
    FROM fxt_rank WHERE ri > 1) WHERE rp = 1),
answers AS (
  SELECT i.conv_id, CASE WHEN p_lab IS NULL THEN 'Unable to decide.'
                         ELSE norm_label || ': INTERVIEWER' || chr(10) || p_lab || ': PARTICIPANT' END AS response
  FROM fxt_rank i LEFT JOIN fxt_part p USING (conv_id) WHERE ri = 1),
ans_m AS (
  SELECT conv_id, unnest(regexp_extract_all(response, '{ROLE_ANSWER}', 1)) AS sp,
         unnest(regexp_extract_all(response, '{ROLE_ANSWER}', 2)) AS ro,
         unnest(generate_series(1, len(regexp_extract_all(response, '{ROLE_ANSWER}', 1)))) AS k
  FROM answers),
ans_last AS (SELECT conv_id, upper(sp) AS speaker, arg_max(upper(ro), k) AS role FROM ans_m GROUP BY conv_id, upper(sp)),
ans_valid AS (
  SELECT conv_id FROM ans_last GROUP BY conv_id
  HAVING count(*) = 2 AND count_if(role = 'INTERVIEWER') = 1 AND count_if(role = 'PARTICIPANT') = 1),
roles AS (
  SELECT a.conv_id, coalesce(m.original, a.speaker) AS original, a.role
  FROM ans_last a JOIN ans_valid USING (conv_id)
  LEFT JOIN fxt_map m ON m.conv_id = a.conv_id AND m.normalized = a.speaker)"""

FXR_ROLE_LINES = f"""
fxr_t AS (
  SELECT conv_id, raw_index, raw, is_last FROM fxr_rawl JOIN fx_paths f USING (conv_id) WHERE NOT {is_diary('f.path')})"""

ORACLE["roles_parsed"] = with_(FX_FILES, FXR_LINES, FXR_ROLE_LINES, K3_CTES) + """
SELECT a.conv_id, a.response,
  max(CASE WHEN r.role = 'INTERVIEWER' THEN r.original END) AS interviewer,
  max(CASE WHEN r.role = 'PARTICIPANT' THEN r.original END) AS participant
FROM answers a LEFT JOIN roles r USING (conv_id) GROUP BY a.conv_id, a.response"""

ORACLE["roles_applied"] = with_(FX_FILES, FXR_LINES, FXR_ROLE_LINES, K3_CTES) + f""",
full_lab AS (SELECT conv_id, raw_index, raw, {lab('raw', 'is_last')} AS label FROM fxr_rawl),
iv_roles AS (SELECT r.* FROM roles r JOIN fx_paths f USING (conv_id) WHERE NOT {is_diary('f.path')})
SELECT l.conv_id, CAST(raw_index AS BIGINT) AS raw_index, r.role || ':' || {label_tail('l.raw', 'l.label')} AS raw
FROM full_lab l JOIN iv_roles r ON l.conv_id = r.conv_id AND l.label = r.original"""

TAGGER_CODES = ", ".join(f"'{c}'" for c in TAGGER_LANGUAGES)

DETECT = f"""
hits AS (
  SELECT conv_id, lang, sum(n * CAST(round(frequency * 1e9) AS BIGINT)) AS score FROM (
    SELECT conv_id, word, count(*) AS n FROM (SELECT conv_id, unnest({words('text')}) AS word FROM samp)
    GROUP BY conv_id, word) JOIN doc_lex USING (word) GROUP BY conv_id, lang),
best AS (SELECT conv_id, lang FROM (
  SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY score DESC, lang ASC) AS r FROM hits) WHERE r = 1),
has AS (SELECT conv_id, max(CASE WHEN {strip('text')} <> '' THEN 1 ELSE 0 END) AS has_text FROM samp GROUP BY conv_id),
det AS (SELECT conv_id, coalesce(best.lang, '') AS detected, has_text = 0 AS no_text FROM has LEFT JOIN best USING (conv_id))"""

LANG_RES = f"""
samp AS (SELECT conv_id, text FROM fx_lines),
{DETECT.strip()},
mapped AS (
  SELECT d.conv_id, m.site, d.detected,
    CASE WHEN no_text THEN 'UNKNOWN' WHEN detected IN ('yue', 'zh', 'zh-hans', 'zh-hant') THEN 'cn'
         WHEN detected IN ({LANG_CODES}) THEN detected ELSE 'UNKNOWN' END AS mapped
  FROM det d JOIN fx_meta0 m USING (conv_id)),
res AS (SELECT conv_id, site, detected, {resolve_lang('mapped', 'site')} AS language FROM mapped),
res_t AS (
  SELECT conv_id, site, detected, language,
    CASE WHEN language = 'cn' THEN 'detect' WHEN language IN ({TAGGER_CODES}) THEN language END AS tagger
  FROM res)"""
ORACLE["language_resolved"] = with_(FX_META, FX_LINES, DOC_LEXICON, LANG_RES) + """
SELECT * FROM res_t"""

from parlance.plans import oracle_tags  # noqa: E402,F401  (registers the tagging SQL)
from parlance.plans import oracle_answers  # noqa: E402,F401  (registers the answers SQL)
from parlance.plans import oracle_tables  # noqa: E402,F401  (registers the table / verify SQL)
