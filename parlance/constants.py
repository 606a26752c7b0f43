"""Fixed values.

FIXED VALUES — these must equal the values the transcript tooling this engine
re-implements uses, or results differ.  They are stated plainly, in their
natural order, and are small (< 200 entries each); every operator reads them
as literal Spark expressions (arrays / maps folded into the plan), so no
lookup table is shipped or joined.
"""

from __future__ import annotations

# --- FIXED VALUES: languages (code -> display name), in declaration order ---
LANGUAGES: list[tuple[str, str]] = [
    ("UNKNOWN", "UNKNOWN"),
    ("zh", "Mandarin"),
    ("es", "Spanish"),
    ("en", "English"),
    ("ko", "Korean"),
    ("it", "Italian"),
    ("ja", "Japanese"),
    ("da", "Danish"),
    ("de", "German"),
    ("fr", "French"),
    ("yue", "Cantonese"),
    ("cn", "Chinese"),
]

# --- FIXED VALUES: site code -> allowed languages (first = primary), in match order ---
SITES: list[tuple[str, list[str]]] = [
    ("CP", ["da"]),
    ("BI", ["en"]), ("CA", ["en"]), ("CM", ["en"]), ("GA", ["en"]), ("HA", ["en"]),
    ("NC", ["en"]), ("PA", ["en"]), ("SI", ["en"]), ("TE", ["en"]), ("WU", ["en"]),
    ("YA", ["en"]), ("IR", ["en"]), ("LA", ["en"]), ("KC", ["en"]), ("SF", ["en"]),
    ("SD", ["en"]), ("BM", ["en"]), ("SG", ["en"]), ("ME", ["en"]), ("CU", ["en"]),
    ("NL", ["en"]), ("NN", ["en"]), ("OH", ["en"]), ("OR", ["en"]), ("PI", ["en"]),
    ("UR", ["en"]),
    ("MU", ["de"]), ("JE", ["de"]),
    ("LS", ["fr"]),
    ("PV", ["it"]),
    ("GW", ["ko"]), ("SL", ["ko"]),
    ("SH", ["zh", "cn"]),
    ("MA", ["es"]), ("ST", ["es"]),
    ("MT", ["en", "fr"]),
    ("HK", ["yue", "zh", "en", "cn"]),
    ("CG", ["de", "en"]),
]

# --- FIXED VALUES: languages the grammatical tagger supports ---
TAGGER_LANGUAGES: list[str] = ["zh", "es", "en", "ko", "it", "ja", "da", "de", "fr", "yue"]

# --- FIXED VALUES: detected codes folded into the pseudo-code ``cn`` ---
CHINESE_CODES: list[str] = ["yue", "zh", "zh-hans", "zh-hant"]

# --- FIXED VALUES: tag vocabulary, file order (one tag an element; 105 lines, 102 distinct) ---
VOCAB_FILE_ORDER: list[str] = [
    "1",
    "2",
    "3",
    "Acc",
    "acl",
    "acl:relcl",
    "ADJ",
    "ADP",
    "ADV",
    "advcl",
    "advmod",
    "amod",
    "appos",
    "Art",
    "aux",
    "aux:pass",
    "Card",
    "case",
    "cc",
    "ccomp",
    "CCONJ",
    "compound",
    "compound:prt",
    "conj",
    "cop",
    "csubj",
    "Def",
    "Dem",
    "dep",
    "DET",
    "det",
    "discourse",
    "expl",
    "Fem",
    "Fin",
    "Fin",
    "fixed",
    "flat",
    "Ger",
    "Imp_mood",
    "Ind",
    "Ind_mood",
    "Inf",
    "Int",
    "INTJ",
    "iobj",
    "mark",
    "Masc",
    "Neg",
    "Neut",
    "Neut",
    "nmod",
    "nmod:poss",
    "Nom",
    "NOUN",
    "nsubj",
    "nsubj:outer",
    "nsubj:pass",
    "nummod",
    "obj",
    "obl",
    "obl",
    "Ord",
    "parataxis",
    "Part",
    "PART",
    "Past",
    "Plur",
    "Yes",
    "Pres",
    "PRON",
    "PROPN",
    "Prs",
    "PUNCT",
    "Rel",
    "reparandum",
    "Sing",
    "VERB",
    "vocative",
    "xcomp",
    "CD",
    "DT",
    "EX",
    "IN",
    "JJ",
    "MD",
    "NN",
    "NNP",
    "NNS",
    "PRP",
    "PRP$",
    "RB",
    "RP",
    "SYM",
    "TO",
    "UH",
    "VB",
    "VBD",
    "VBG",
    "VBN",
    "VBP",
    "VBZ",
    "WDT",
    "WP",
    "WRB",
]

# --- FIXED VALUES: tag renames used in table headers ---
TAG_RENAMES: dict[str, str] = {"1": "p1", "2": "p2", "3": "p3", "Yes": "pronoun_possession"}

# --- FIXED VALUES: the 11 morphological feature keys, slot order ---
UD_FEATURE_KEYS: list[str] = [
    "Case", "Number", "Person", "Gender", "PronType", "Definite",
    "Mood", "Tense", "VerbForm", "Poss", "NumType",
]

# --- FIXED VALUES: feature-table metadata header ---
META_COLUMNS: list[str] = [
    "network", "language", "src_subject_id", "interview_type",
    "day", "interview_number", "transcript_speaker_label", "speaker_role",
]
TRAILING_COLUMNS: list[str] = ["num_sent", "word_freq", "file_name.txt"]

# --- FIXED VALUES: interview-type spellings ---
OPEN_SPELLINGS: list[str] = ["OPEN", "OPENEND", "OPEN-ENDED", "OPEN_ENDED"]
PSYCHS_SPELLINGS: list[str] = ["PSYCHS", "PSYCH"]

# --- FIXED VALUES: frequency-corpus file per language ---
CORPUS_FILES: dict[str, str] = {
    "en": "subtlex_en.csv", "es": "subtlex_es.csv", "zh": "subtlex_zh.csv",
    "ko": "subtlex_ko.csv", "it": "subtlex_it.csv", "ja": "subtlex_ja.csv",
    "da": "subtlex_da.csv", "de": "subtlex_de.csv", "fr": "subtlex_fr.csv",
    "yue": "subtlex_yue.csv",
}

# --- FIXED VALUES: characters of one model request (a text is covered by as many as it takes) ---
ROLE_PROMPT_CHARS = 5000
TYPE_PROMPT_CHARS = 40000

# --- FIXED VALUES: patterns (Java regex syntax; equal in meaning to the originals) ---
# Python's ``str.isspace`` whitespace set, as a character class.
WS = r"[\p{Z}\x09-\x0d\x1c-\x1f\x85]"
TIMESTAMP = r"\p{Nd}{2}:\p{Nd}{2}:\p{Nd}{2}\.\p{Nd}{3}"
SPEAKER_LABEL = r"S[IP\p{Nd}]+"
ROLE_ANSWER = r"(?i)(S[123]):" + WS + r"*(INTERVIEWER|PARTICIPANT)"
TYPE_BRACED = r"(?i)\{(OPEN|PSYCHS)\}"
TYPE_BARE = r"(?i)\b(OPEN|PSYCHS)\b"
SUBMISSION = r"submission(\p{Nd}+)"
# Python ``\w`` for text: letters, digits, underscore (``[^\w\s]`` is deleted).
NON_WORD = r"[^\p{L}\p{N}_\p{Z}\x09-\x0d\x1c-\x1f\x85]"

# The system line of both model prompts.
SYSTEM_PROMPT = "You label interview transcripts. Answer in the requested format alone."
