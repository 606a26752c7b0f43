"""Reference SQL for prompts, the answers ledger and what is parsed from it."""

from __future__ import annotations

from parlance.plans.oracle import FX_FILES, FX_LINES, FXR_LINES, FXR_ROLE_LINES, ORACLE, WS, label_map_ctes, with_


def sql_lit(s: str | None) -> str:
    return "NULL" if s is None else "'" + s.replace("'", "''") + "'"


# --- FIXED VALUES: the prompts' wording, written out here a second time ------------------
SYSTEM = "You label interview transcripts. Answer in the requested format alone."
ROLE_PROMPT = sql_lit(
    "Below is one part of an interview transcript. Two of its speakers matter: the one who asks the questions "
    "(INTERVIEWER) and the one who answers them at length (PARTICIPANT). Speakers are named by the label that "
    "opens their lines.\n\n<transcript>\n") + " || text || " + sql_lit(
    "\n</transcript>\n\nName both, a line each, and write nothing else:\nS<number>: INTERVIEWER\nS<number>: PARTICIPANT")
TYPE_PROMPT = sql_lit(
    "Below is one part of an interview transcript. A PSYCHS interview works through set questions on symptoms, "
    "with how often they occur and how long they last; an OPEN interview lets the participant talk freely.\n\n<transcript>\n") + " || text || " + sql_lit(
    "\n</transcript>\n\nWrite the type in braces and nothing else: {OPEN} or {PSYCHS}")
TYPE_SAID = ["{OPEN}", "{PSYCHS}", "The type is {psychs}.", "OPEN", "Not open but PSYCHS", "I cannot tell.", "{Open}, or else {PSYCHS}", "", "psychs", None, "reopened"]
ROLE_SAID = ["S1: INTERVIEWER\nS2: PARTICIPANT", "s2: interviewer\ns1: participant", "S1: INTERVIEWER", "S1: INTERVIEWER\nS1: PARTICIPANT\nS2: INTERVIEWER",
             "Nobody knows.", "S1: INTERVIEWER\nS2: PARTICIPANT\nS3: PARTICIPANT", "S1: PARTICIPANT\nS2: PARTICIPANT", "S2: PARTICIPANT, S1: INTERVIEWER"]


def parts_of(src: str, chars: int) -> str:
    """Lines of ``src`` cut into consecutive parts of ``chars`` characters."""
    return (f"SELECT conv_id, part, raw_index, substr(raw, CAST(greatest(part * {chars} - char_offset, 0) + 1 AS BIGINT), "
            f"CAST((part + 1) * {chars} - greatest(char_offset, part * {chars}) AS BIGINT)) AS piece FROM ("
            f"SELECT *, unnest(generate_series(CAST(char_offset AS BIGINT) // {chars}, "
            f"(CAST(char_offset AS BIGINT) + greatest(length(raw), 1) - 1) // {chars})) AS part FROM {src})")


def answers_ctes(p: str, src: str, chars: int, prompt: str, said: list[str | None], system: str = SYSTEM) -> str:
    """``{p}_prompt`` the prompts' hashes, ``{p}_said`` the answers in force, by file and part."""
    return f"""
{p}_part AS (SELECT conv_id, part, string_agg(piece, chr(10) ORDER BY raw_index) AS text FROM ({parts_of(src, chars)}) GROUP BY conv_id, part),
{p}_prompt AS (SELECT conv_id, part, sha256({sql_lit(system)} || chr(31) || {prompt}) AS h FROM {p}_part),
{p}_ledger AS (
  SELECT conv_id, part, CASE WHEN conv_id % 17 = 3 THEN sha256('old' || h) ELSE h END AS h, asked,
    CASE WHEN asked = 1 THEN '{{OPEN}} S1: PARTICIPANT' ELSE ([{", ".join(map(sql_lit, said))}])[(conv_id * 3 + part) % {len(said)} + 1] END AS response
  FROM (SELECT *, unnest(CASE WHEN conv_id % 5 = 0 THEN [1, 2] ELSE [2] END) AS asked FROM {p}_prompt WHERE conv_id % 13 <> 5)),
{p}_said AS (
  SELECT l.conv_id, l.part, arg_max(l.response, l.asked) AS response FROM {p}_ledger l JOIN {p}_prompt USING (conv_id, part, h)
  WHERE l.response IS NOT NULL GROUP BY l.conv_id, l.part)"""


def typed_ctes(p: str) -> str:
    """``typed`` (conv_id, response, predicted) from the answers ``{p}_said``."""
    return f"""
{p}_parsed AS (
  SELECT *, upper(coalesce(nullif(regexp_extract(response, '(?i)\\{{(OPEN|PSYCHS)\\}}', 1), ''),
                           regexp_extract_all(response, '(?i)\\b(OPEN|PSYCHS)\\b', 1)[-1])) AS predicted FROM {p}_said),
{p}_best AS (
  SELECT conv_id, predicted FROM (
    SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY predicted IS NULL, n DESC, low) AS r
    FROM (SELECT conv_id, predicted, count(*) AS n, min(part) AS low FROM {p}_parsed GROUP BY conv_id, predicted)) WHERE r = 1),
typed AS (
  SELECT b.conv_id, arg_min(x.response, x.part) AS response, b.predicted
  FROM {p}_best b JOIN {p}_parsed x ON b.conv_id = x.conv_id AND b.predicted IS NOT DISTINCT FROM x.predicted GROUP BY b.conv_id, b.predicted)"""


#: ``typed`` over the labelled transcripts, in requests of 40,000 characters.
TYPED = answers_ctes("ta", "fx_rawl", 40000, TYPE_PROMPT, TYPE_SAID) + "," + typed_ctes("ta")

ORACLE["types_parsed"] = with_(FX_LINES, TYPED) + """
SELECT * FROM typed"""

ORACLE["types_voted"] = with_(FX_LINES, answers_ctes("tv", "fx_rawl", 1500, TYPE_PROMPT, TYPE_SAID), typed_ctes("tv")) + """
SELECT * FROM typed"""

NORMED = """
norm_at AS (SELECT n.conv_id, n.raw_index, n.raw, r.char_offset FROM fxt_norm n JOIN fxr_rawl r USING (conv_id, raw_index))"""

ROLE_TEXT = [FX_FILES, FXR_LINES, FXR_ROLE_LINES, label_map_ctes("fxt", "fxr_t"), NORMED]

ORACLE["roles_answered"] = with_(*ROLE_TEXT, answers_ctes("ra", "norm_at", 1500, ROLE_PROMPT, ROLE_SAID)) + f"""
, m AS (
  SELECT conv_id, part, unnest(regexp_extract_all(response, '(?i)(S[123]):{WS}*(INTERVIEWER|PARTICIPANT)', 1)) AS sp,
         unnest(regexp_extract_all(response, '(?i)(S[123]):{WS}*(INTERVIEWER|PARTICIPANT)', 2)) AS ro,
         unnest(generate_series(1, len(regexp_extract_all(response, '(?i)(S[123]):{WS}*(INTERVIEWER|PARTICIPANT)', 1)))) AS k
  FROM ra_said),
last_said AS (SELECT conv_id, part, upper(sp) AS speaker, arg_max(upper(ro), k) AS role FROM m GROUP BY conv_id, part, upper(sp)),
pairs AS (
  SELECT conv_id, part, string_agg(speaker || ':' || role, ',' ORDER BY speaker) AS pair FROM last_said GROUP BY conv_id, part
  HAVING count(*) = 2 AND count_if(role = 'INTERVIEWER') = 1 AND count_if(role = 'PARTICIPANT') = 1),
best AS (
  SELECT conv_id, pair FROM (
    SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY n DESC, low) AS r
    FROM (SELECT conv_id, pair, count(*) AS n, min(part) AS low FROM pairs GROUP BY conv_id, pair)) WHERE r = 1),
named AS (
  SELECT b.conv_id, e.role, coalesce(f.original, e.speaker) AS original
  FROM best b, LATERAL (SELECT split_part(x, ':', 1) AS speaker, split_part(x, ':', 2) AS role FROM (SELECT unnest(string_split(b.pair, ',')) AS x)) e
  LEFT JOIN fxt_map f ON f.conv_id = b.conv_id AND f.normalized = e.speaker)
SELECT g.conv_id, g.answers, max(CASE WHEN n.role = 'INTERVIEWER' THEN n.original END) AS interviewer,
       max(CASE WHEN n.role = 'PARTICIPANT' THEN n.original END) AS participant
FROM (SELECT conv_id, count(*) AS answers FROM ra_said GROUP BY conv_id) g LEFT JOIN named n USING (conv_id) GROUP BY g.conv_id, g.answers"""

ORACLE["answers_pending"] = with_(
    *ROLE_TEXT, answers_ctes("rp", "norm_at", 5000, ROLE_PROMPT, ROLE_SAID),
    answers_ctes("tp", "fxr_rawl", 40000, TYPE_PROMPT, TYPE_SAID, "Thinking: low\n" + SYSTEM)) + """
SELECT conv_id, 'roles' AS kind, part, h AS prompt_hash FROM rp_prompt ANTI JOIN rp_said USING (conv_id, part)
UNION ALL
SELECT conv_id, 'type' AS kind, part, h AS prompt_hash FROM tp_prompt ANTI JOIN tp_said USING (conv_id, part)"""
