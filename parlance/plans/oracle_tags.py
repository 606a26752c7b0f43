"""Reference SQL for the tagging queries (tokens, tallies, sentences, failures)."""

from __future__ import annotations

from parlance.constants import UD_FEATURE_KEYS
from parlance.functions.tags import safe_names, vocab
from parlance.plans.oracle import (
    DETECT, DOC_LEXICON, FX_FILES, FX_LINES, FX_META, LANG_RES, ORACLE, TAGGER_CODES, is_diary, lang_from_path,
    strip, with_, words,
)

VOCAB_SQL = ", ".join("'" + t + "'" for t in vocab())


def ud(feats: str, key: str) -> str:
    v = f"substr(list_filter(string_split({feats}, '|'), lambda x: contains(x, '{key}'))[-1], {len(key) + 2})"
    if key == "Mood":
        v = f"{v} || '_mood'"
    return f"coalesce({v}, '')"


def tagger_of(lang: str) -> str:
    return f"(CASE WHEN {lang} = 'cn' THEN 'detect' WHEN {lang} IN ({TAGGER_CODES}) THEN {lang} END)"


def role_of(path: str) -> str:
    return (f"(CASE WHEN {is_diary(path)} THEN 'Participant' WHEN speaker = 'PARTICIPANT' THEN 'Participant' "
            f"WHEN speaker = 'INTERVIEWER' THEN 'Interviewer' END)")


def units_cte(lang_src: str) -> str:
    """``fx_tok`` tokens, ``fx_tally`` long tallies, ``fx_sent`` sentence counts of
    the taggable files (language table ``lang_src``: conv_id, tagger)."""
    slots = ", ".join(ud("feats", k) for k in UD_FEATURE_KEYS)
    return f"""
doc_tags AS (
  SELECT lang, word, (['NOUN', 'VERB', 'PRON', 'DET', 'ADJ', 'SYM', 'VERB', 'ADP'])[k] AS upos,
    (['NN', 'VBD', 'PRP$', 'DT', 'CD', 'SYM', 'VB', 'IN'])[k] AS xpos,
    (['nsubj', 'root', 'nmod:poss', 'det', 'nummod', 'dep', 'xcomp', 'case'])[k] AS deprel,
    (['Case=Nom|Gender=Fem|Number=Sing', 'Mood=Ind|Number=Plur|Person=3|Tense=Past|VerbForm=Fin',
      'Case=Acc|Number=Sing|Person=1|Poss=Yes|PronType=Prs', 'Definite=Def|PronType=Art', 'NumType=Card', NULL,
      'Mood=Imp|Tense=Pres|VerbForm=Fin', 'Case=Neut|Gender=Neut'])[k] AS feats
  FROM (SELECT lang, word, (unicode(word) + 3 * length(word)) % 8 + 1 AS k FROM doc_lex)),
fx_units_t AS (
  SELECT l.conv_id, {role_of('p.path')} AS speaker_role, line_index, text, g.tagger AS lang
  FROM fx_lines l JOIN fx_paths p USING (conv_id) JOIN {lang_src} g USING (conv_id)
  WHERE {strip('text')} <> '' AND g.tagger IS NOT NULL),
fx_sp AS (
  SELECT conv_id, speaker_role, line_index, lang, unnest(ps) AS piece, unnest(generate_series(1, len(ps))) AS sent_id
  FROM (SELECT *, regexp_split_to_array(text, '[.!?]+') AS ps FROM fx_units_t WHERE speaker_role IS NOT NULL)),
fx_tw AS (
  SELECT conv_id, speaker_role, line_index, lang, sent_id, unnest(ws) AS word,
         unnest(generate_series(1, len(ws))) AS word_id
  FROM (SELECT *, {words('piece')} AS ws FROM fx_sp)),
fx_tok AS (
  SELECT conv_id, speaker_role, line_index, CAST(sent_id AS BIGINT) AS sent_id, CAST(word_id AS BIGINT) AS word_id,
    w.word, w.word AS lemma,
    CASE WHEN d.word IS NULL THEN 'X' ELSE d.upos END AS upos, d.xpos, d.deprel, d.feats
  FROM fx_tw w LEFT JOIN doc_tags d ON d.lang = w.lang AND d.word = w.word),
fx_tally AS (
  SELECT conv_id, speaker_role, tag, CAST(count(*) AS BIGINT) AS cnt FROM (
    SELECT conv_id, speaker_role, unnest([upos, xpos, deprel, {slots}]) AS tag FROM fx_tok)
  WHERE tag IN ({VOCAB_SQL}) GROUP BY conv_id, speaker_role, tag),
fx_sent AS (
  SELECT conv_id, speaker_role,
    CAST(count(DISTINCT CAST(line_index AS VARCHAR) || '.' || CAST(sent_id AS VARCHAR)) AS BIGINT) AS num_sent,
    CAST(count(*) AS BIGINT) AS num_words
  FROM fx_tok GROUP BY conv_id, speaker_role)"""


PATH_LANG = f"""
fx_plang AS (SELECT conv_id, {lang_from_path('path')} AS language FROM fx_paths),
fx_own AS (SELECT DISTINCT conv_id FROM fx_lines WHERE speaker = 'PARTICIPANT'),
fx_asked AS (
  SELECT conv_id, text FROM fx_lines JOIN fx_plang USING (conv_id)
  WHERE language = 'cn' AND (speaker = 'PARTICIPANT' OR conv_id NOT IN (SELECT conv_id FROM fx_own))),
fx_known AS (
  SELECT conv_id, lang, sum(CAST(round(frequency * 1e9) AS BIGINT)) AS score
  FROM (SELECT conv_id, unnest({words('text')}) AS word FROM fx_asked) JOIN doc_lex USING (word) GROUP BY conv_id, lang),
fx_heard AS (SELECT conv_id, arg_min(lang, (-score, lang)) AS lang FROM fx_known GROUP BY conv_id),
fx_plang_t AS (
  SELECT p.conv_id, p.language, CASE WHEN p.language = 'cn' THEN (CASE WHEN h.lang IN ({TAGGER_CODES}) THEN h.lang ELSE 'zh' END)
                                     ELSE {tagger_of('p.language')} END AS tagger
  FROM fx_plang p LEFT JOIN fx_heard h USING (conv_id))"""

TAG_BASE = with_(FX_FILES, FX_LINES, DOC_LEXICON, PATH_LANG, units_cte("fx_plang_t"))

ORACLE["tagged_resolved"] = with_(FX_FILES, FX_LINES, DOC_LEXICON, PATH_LANG) + """
SELECT * FROM fx_plang_t"""

ORACLE["ud_features"] = TAG_BASE + f"""
SELECT conv_id, CAST(line_index AS BIGINT) AS line_index, sent_id, word_id, feats,
  {", ".join(ud("feats", k) + " AS f_" + k.lower() for k in UD_FEATURE_KEYS)}
FROM fx_tok"""

ORACLE["tag_tally"] = TAG_BASE + """
SELECT * FROM fx_tally"""

ORACLE["tally_vocabulary"] = TAG_BASE.replace(
    f"WHERE tag IN ({VOCAB_SQL})", "WHERE tag IN (SELECT xpos FROM doc_tags UNION SELECT deprel FROM doc_tags UNION SELECT 'X')") + """
SELECT * FROM fx_tally"""

ORACLE["sentence_counts"] = TAG_BASE + """
SELECT * FROM fx_sent"""

WIDE_COLS = ", ".join(f"CAST(sum(CASE WHEN tag = '{t}' THEN cnt ELSE 0 END) AS BIGINT) AS {n}"
                      for t, n in safe_names().items())

ORACLE["tally_wide"] = TAG_BASE + f"""
SELECT s.conv_id, s.speaker_role, {WIDE_COLS}, any_value(s.num_sent) AS num_sent
FROM fx_sent s LEFT JOIN fx_tally t ON t.conv_id = s.conv_id AND t.speaker_role = s.speaker_role
GROUP BY s.conv_id, s.speaker_role"""

RESOLVED_LANG = """
fx_rlang AS (
  SELECT f.conv_id, coalesce(r.language, 'UNKNOWN') AS language, r.tagger
  FROM fx_paths f LEFT JOIN res_t r USING (conv_id))"""

ORACLE["failures"] = with_(FX_META, FX_LINES, DOC_LEXICON, LANG_RES, RESOLVED_LANG, units_cte("fx_rlang")) + f""",
expected AS (
  SELECT f.conv_id, f.file_name, f.path, g.tagger,
    unnest(CASE WHEN {is_diary('f.path')} THEN ['Participant'] ELSE ['Participant', 'Interviewer'] END) AS speaker_role
  FROM fx_paths f JOIN fx_rlang g USING (conv_id) WHERE g.tagger IS NOT NULL),
has_lines AS (
  SELECT DISTINCT l.conv_id, {role_of('p.path')} AS speaker_role FROM fx_lines l JOIN fx_paths p USING (conv_id)),
unit_fail AS (
  SELECT e.file_name AS filename, e.path AS filepath, e.tagger AS language,
    CASE WHEN h.conv_id IS NULL THEN 'no_lines' WHEN coalesce(s.num_words, 0) = 0 THEN 'empty_output' END AS reason,
    CASE WHEN h.conv_id IS NULL THEN 'No ' || lower(e.speaker_role) || ' lines found'
         ELSE 'Extracted 0 sentences and 0 words' END AS error_message
  FROM expected e
  LEFT JOIN has_lines h ON h.conv_id = e.conv_id AND h.speaker_role = e.speaker_role
  LEFT JOIN fx_sent s ON s.conv_id = e.conv_id AND s.speaker_role = e.speaker_role)
SELECT f.file_name AS filename, f.path AS filepath, coalesce(g.language, 'UNKNOWN') AS language,
  CASE WHEN g.language IS NULL THEN 'unknown_language' ELSE 'unsupported_language' END AS reason,
  CASE WHEN g.language IS NULL THEN 'Transcript language could not be determined'
       ELSE concat('Language ', chr(39), g.language, chr(39), ' is not supported by the tagger') END AS error_message
FROM fx_paths f JOIN fx_rlang g USING (conv_id) WHERE g.tagger IS NULL
UNION ALL
SELECT * FROM unit_fail WHERE reason IS NOT NULL"""


ORACLE["tagger_language"] = with_(FX_LINES, DOC_LEXICON) + f""",
has_p AS (SELECT DISTINCT conv_id FROM fx_lines WHERE speaker = 'PARTICIPANT'),
samp AS (
  SELECT conv_id, text FROM fx_lines
  WHERE speaker = 'PARTICIPANT' OR conv_id NOT IN (SELECT conv_id FROM has_p)),
{DETECT.strip()}
SELECT conv_id, detected,
  CASE WHEN no_text THEN 'zh' WHEN detected IN ({TAGGER_CODES}) THEN detected ELSE 'zh' END AS tagger
FROM det"""
