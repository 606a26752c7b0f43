"""Model-backed operators with pluggable predictors.

The original calls a language-ID network, a tagger and a chat model.  Here
each call is a *predictor* slot:

* ``predict=None`` — a built-in stand-in written with Spark expressions only
  (documented per function; these are our rules, not the models);
* ``predict=fn`` — ``fn(Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]`` run
  with ``mapInPandas`` over Arrow batches; the model is loaded once per task.

Prompt building and answer parsing are Spark expressions in both cases.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from parlance.constants import ROLE_ANSWER, ROLE_PROMPT_CHARS, SYSTEM_PROMPT, TYPE_BARE, TYPE_BRACED, TYPE_PROMPT_CHARS
from parlance.functions.metadata import map_detected_language, resolve_language, tagger_language
from parlance.functions.text import is_blank, strip_ws, words
from parlance.operators import labels as LB
from parlance.operators.answers import Ledger, collected

Predictor = Callable[[Iterator["pd.DataFrame"]], Iterator["pd.DataFrame"]]  # noqa: F821

# --- FIXED VALUES: built-in stand-in parameters (ours) --------------------------------
DEFAULT_TYPE_CUES = r"(?i)\b(how often|how long|how much|last month|past month|frequency|duration|often)\b"


# --- prompt text ---------------------------------------------------------------------------

def prompt_parts(lines: DataFrame, chars: int) -> DataFrame:
    """Lines cut into consecutive parts of ``chars`` characters of each file.

    ``file_id, part, raw_index, raw``; a line goes to the part it begins in, one that reaches over a limit is cut there.
    ``chars`` is the size of one request; the parts together hold the whole text.
    """
    size, off, n = F.lit(chars), F.col("char_offset"), F.length("raw")
    first, last = F.floor(off / size), F.floor((off + F.greatest(n, F.lit(1)) - 1) / size)
    cut = lines.select("file_id", "raw_index", "raw", "char_offset", F.explode(F.sequence(first, last)).alias("part"))
    begin = F.greatest(F.col("part") * size - off, F.lit(0))
    return cut.select("file_id", "part", "raw_index",
                      F.substring("raw", (begin + 1).cast("int"), ((F.col("part") + 1) * size - off - begin).cast("int")).alias("raw"))


def join_lines(df: DataFrame, col: str = "raw") -> DataFrame:
    """Concatenate the *bounded* set of lines of each part of a file (a prompt) in ``raw_index`` order."""
    return df.groupBy("file_id", "part").agg(
        F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("raw_index", col))),
                                 lambda s: s[col]), "\n").alias("text"))


# --- prompt templates (only the answer formats are fixed) --------------------------------
ROLE_PROMPT_TEMPLATE = (
    "Below is one part of an interview transcript. Two of its speakers matter: the one who asks the questions "
    "(INTERVIEWER) and the one who answers them at length (PARTICIPANT). Speakers are named by the label that "
    "opens their lines.\n\n<transcript>\n{transcript}\n</transcript>\n\nName both, a line each, and write nothing else:\n"
    "S<number>: INTERVIEWER\nS<number>: PARTICIPANT")
TYPE_PROMPT_TEMPLATE = (
    "Below is one part of an interview transcript. A PSYCHS interview works through set questions on symptoms, "
    "with how often they occur and how long they last; an OPEN interview lets the participant talk freely.\n\n"
    "<transcript>\n{transcript}\n</transcript>\n\nWrite the type in braces and nothing else: {{OPEN}} or {{PSYCHS}}")


def _fill(template: str, text: Column) -> Column:
    before, after = template.split("{transcript}")
    return F.concat(F.lit(before.replace("{{", "{").replace("}}", "}")), text,
                    F.lit(after.replace("{{", "{").replace("}}", "}")))


def role_prompts(raw: DataFrame, chars: int = ROLE_PROMPT_CHARS,
                 template: str = ROLE_PROMPT_TEMPLATE) -> DataFrame:
    """``file_id, part, system, prompt`` over the whole text in parts of ``chars``
    characters, with speaker labels normalised over the whole file."""
    t = LB.line_labels(raw)
    norm = LB.normalize_labels(t, LB.label_mapping(t))
    return join_lines(prompt_parts(norm, chars)).select("file_id", "part", F.lit(SYSTEM_PROMPT).alias("system"),
                                                        _fill(template, F.col("text")).alias("prompt"))


def type_prompts(raw: DataFrame, chars: int = TYPE_PROMPT_CHARS, thinking: str | None = None,
                 template: str = TYPE_PROMPT_TEMPLATE) -> DataFrame:
    """``file_id, part, system, prompt`` over the whole text in parts of ``chars`` characters;
    optional ``Thinking: <level>`` line before the system text."""
    system = SYSTEM_PROMPT if thinking is None else f"Thinking: {thinking}\n{SYSTEM_PROMPT}"
    return join_lines(prompt_parts(raw, chars)).select(
        "file_id", "part", F.lit(system).alias("system"), _fill(template, F.col("text")).alias("prompt"))


def run_predictor(prompts: DataFrame, predict: Predictor, batch_rows: int = 16) -> DataFrame:
    """Run a plug-in model over ``file_id, part, system, prompt``; it yields ``file_id, response`` and may
    yield ``part`` (one answer a prompt, in order, where it does not).

    The worker gets frames of ``batch_rows`` prompts (the original batch size is 16), cut from the Arrow batches inside the
    task; no session setting is changed.  The caller should persist or write the result before using it
    twice, so the model runs once.
    """
    key_type = prompts.schema["file_id"].dataType.simpleString()

    def run(frames):
        for frame in frames:
            for at in range(0, len(frame), batch_rows):
                some = frame.iloc[at:at + batch_rows].reset_index(drop=True)
                for out in predict(iter([some])):
                    if "part" not in out:
                        out = out.assign(part=some["part"].to_numpy()[:len(out)])
                    yield out[["file_id", "part", "response"]]

    return prompts.mapInPandas(run, f"file_id {key_type}, part bigint, response string")


def most_frequent_answer(answers: DataFrame, parsed: Column) -> DataFrame:
    """One answer a file from those of its parts: ``file_id, answer``.

    The parsed answer that most parts give; of equally frequent ones that of the earliest part.  Parts
    without a valid answer do not vote; a file without any has a NULL answer.
    """
    votes = answers.select("file_id", "part", parsed.alias("answer"))
    counted = votes.groupBy("file_id", "answer").agg(F.count(F.lit(1)).alias("n"), F.min("part").alias("first"))
    rank = F.when(F.col("answer").isNotNull(), F.struct(F.col("n"), -F.col("first")))
    return counted.groupBy("file_id").agg(F.max_by("answer", rank).alias("answer"))


# --- answer parsing -------------------------------------------------------------------------

def parse_roles(response: Column | str) -> Column:
    """``ARRAY<STRUCT<speaker, role>>`` or NULL when the answer is not exactly
    one INTERVIEWER and one PARTICIPANT over two speakers.  Per speaker
    (upper-cased) the last mention wins."""
    r = F.col(response) if isinstance(response, str) else response
    sp = F.regexp_extract_all(r, F.lit(ROLE_ANSWER), 1)
    ro = F.regexp_extract_all(r, F.lit(ROLE_ANSWER), 2)
    z = F.zip_with(sp, ro, lambda s, x: F.struct(F.upper(s).alias("speaker"), F.upper(x).alias("role")))
    last = F.filter(z, lambda e, k: ~F.exists(F.slice(z, k + 2, F.greatest(F.size(z), F.lit(1))),
                                                lambda f: f["speaker"] == e["speaker"]))
    n_i = F.size(F.filter(last, lambda e: e["role"] == "INTERVIEWER"))
    n_p = F.size(F.filter(last, lambda e: e["role"] == "PARTICIPANT"))
    return F.when((F.size(last) == 2) & (n_i == 1) & (n_p == 1), last)


def parse_interview_type(response: Column | str) -> Column:
    """C17: first ``{OPEN}``/``{PSYCHS}`` (any case), else the LAST bare word; upper-cased."""
    r = F.col(response) if isinstance(response, str) else response
    braced = F.nullif(F.regexp_extract(r, TYPE_BRACED, 1), F.lit(""))
    bare = F.try_element_at(F.regexp_extract_all(r, F.lit(TYPE_BARE), 1), F.lit(-1))
    return F.upper(F.coalesce(braced, bare))


# --- K3: speaker roles -----------------------------------------------------------------------

def _label_text(raw: Column, label: Column) -> Column:
    tail = raw.substr(F.length(label) + 1, F.lit(2147483647))
    tail = F.when(tail.startswith(":"), tail.substr(F.lit(2), F.lit(2147483647))).otherwise(tail)
    return strip_ws(tail)


def builtin_role_answers(norm_lines: DataFrame) -> DataFrame:
    """K3 stand-in (ours): among speakers S1-S3 of the normalised text, the
    interviewer has the highest share of lines ending in ``?`` (ties: fewer
    words per line, then label); the participant is the other speaker with
    most words (ties: label).  Answers in the model's format.

    Input ``file_id, raw, norm_label``; output ``file_id, response``.
    """
    lines = norm_lines.where(F.col("norm_label").isin(*LB.SIMPLE_LABELS))
    text = _label_text(F.col("raw"), F.col("norm_label"))
    stats = (lines.select("file_id", "norm_label", text.alias("t"))
             .groupBy("file_id", "norm_label")
             .agg(F.count(F.lit(1)).alias("n"),
                  F.count_if(F.col("t").endswith("?")).alias("q"),
                  F.sum(F.size(words("t"))).alias("nw")))
    share = F.col("q").cast("double") / F.col("n").cast("double")
    wpl = F.col("nw").cast("double") / F.col("n").cast("double")
    # at most three speakers per file: rank inside a small array, no window
    per_file = stats.groupBy("file_id").agg(F.collect_list(F.struct(
        (-share).alias("k1"), wpl.alias("k2"), F.col("norm_label").alias("k3"),
        (-F.col("nw")).alias("p1"))).alias("s"))
    inter = F.sort_array("s")[0]["k3"]
    others = F.filter("s", lambda x: x["k3"] != inter)
    part = F.sort_array(F.transform(others, lambda x: F.struct(x["p1"].alias("a"), x["k3"].alias("b"))))
    p_lab = F.get(part, 0)["b"]
    return per_file.select(
        "file_id",
        F.when(p_lab.isNull(), F.lit("Unable to decide."))
        .otherwise(F.concat(inter, F.lit(": INTERVIEWER\n"), p_lab, F.lit(": PARTICIPANT")))
        .alias("response"))


def classify_roles(raw: DataFrame, predict: Predictor | None = None, chars: int = ROLE_PROMPT_CHARS,
                   answers: DataFrame | Ledger | None = None) -> tuple[DataFrame, DataFrame]:
    """K3 over whole texts: ``(answers, roles)``; pass the lines of interviews only (diaries have no roles).

    Answers come from the table or ledger ``answers`` (see ``parlance.operators.answers``), from the plug-in ``predict`` where that
    has none, and from the built-in stand-in if neither is given.
    The first result is ``file_id, response`` (by ``part`` but for the stand-in); ``roles``: ``file_id, original, role`` —
    the original label of each speaker the answer names (through the file's normalisation map), one row
    per role, nothing for an unparseable answer.  The parts' answers are combined by ``most_frequent_answer``.
    """
    t = LB.line_labels(raw)
    mapping = LB.label_mapping(t)
    if predict is None and answers is None:
        answers = builtin_role_answers(LB.normalize_labels(t, mapping))
        voted = answers.select("file_id", F.lit(0).cast("bigint").alias("part"), "response")
    else:
        answers = voted = collected(role_prompts(raw, chars), predict, answers)
    pairs = F.array_sort(parse_roles("response"))
    parsed = most_frequent_answer(voted, pairs).select("file_id", F.explode("answer").alias("e"))
    m = mapping.select("file_id", F.col("normalized").alias("speaker"), "original")
    roles = (parsed.select("file_id", F.col("e.speaker").alias("speaker"), F.col("e.role").alias("role"))
             .join(m, ["file_id", "speaker"], "left")
             .select("file_id", F.coalesce("original", "speaker").alias("original"), "role"))
    return answers, roles


# --- K4: interview type ------------------------------------------------------------------------

def builtin_type_answers(raw: DataFrame, cues: str = DEFAULT_TYPE_CUES) -> DataFrame:
    """K4 stand-in (ours): ``{PSYCHS}`` when any line of the text asks about
    duration or frequency (``cues``), else ``{OPEN}``."""
    return raw.groupBy("file_id").agg(
        F.when(F.max(F.col("raw").rlike(cues).cast("int")) == 1, F.lit("{PSYCHS}"))
        .otherwise(F.lit("{OPEN}")).alias("response"))


def predict_types(raw: DataFrame, predict: Predictor | None = None, chars: int = TYPE_PROMPT_CHARS,
                  thinking: str | None = None, cues: str = DEFAULT_TYPE_CUES,
                  answers: DataFrame | Ledger | None = None) -> DataFrame:
    """K4 model step over whole texts: ``file_id, response, predicted`` (NULL = parse failure).

    Answers come from ``answers`` and ``predict`` as in :func:`classify_roles`; a file without any answer has no row.
    They are given by part; ``response`` is then the earliest part's answer that gives ``predicted`` (any, if none
    does), and ``predicted`` the type that most parts give (``most_frequent_answer``).
    """
    if predict is None and answers is None:
        said = builtin_type_answers(raw, cues)
        return said.select("file_id", "response", parse_interview_type("response").alias("predicted"))
    return combine_types(collected(type_prompts(raw, chars, thinking), predict, answers))


def combine_types(answers: DataFrame) -> DataFrame:
    """``file_id, response, predicted`` from the answers ``file_id, part, response`` of a file's parts."""
    typed = answers.withColumn("predicted", parse_interview_type("response"))
    best = most_frequent_answer(answers, parse_interview_type("response"))
    said = (typed.join(best, "file_id").where(F.col("predicted").eqNullSafe(F.col("answer")))
            .groupBy("file_id").agg(F.min_by("response", "part").alias("response"), F.first("answer").alias("predicted")))
    return said.select("file_id", "response", "predicted")


# --- K1: language ---------------------------------------------------------------------------------

def detect_languages(lines: DataFrame, lexicon: DataFrame, predict: Predictor | None = None) -> DataFrame:
    """K1 + C22 over all lines of each file: ``file_id, detected, no_text``.

    ``predict=None``: the stand-in (ours), the language in which the file's words have the largest
    sum of relative frequencies (in units of 1e-9, whole numbers; ties by code), ``''`` if no word is known.
    ``lexicon``: ``lang, word, frequency`` (see ``corpus_lexicon``).  A plug-in gets pandas frames
    ``file_id, line_index, text`` and yields ``file_id, line_index, detected``; the language of most lines wins (ties by code).
    """
    files = lines.groupBy("file_id").agg((F.max((~is_blank("text")).cast("int")) == 0).alias("no_text"))
    if predict is None:
        counted = (lines.select("file_id", F.explode(words("text")).alias("word"))
                   .groupBy("file_id", "word").agg(F.count(F.lit(1)).alias("n")))
        share = F.round(F.col("frequency") * 1e9).cast("bigint")
        hits = (counted.join(lexicon.select("lang", "word", "frequency"), "word")
                .groupBy("file_id", "lang").agg(F.sum(F.col("n") * share).alias("score")))
    else:
        key_type = lines.schema["file_id"].dataType.simpleString()
        said = lines.where(~is_blank("text")).select("file_id", "line_index", "text").mapInPandas(
            predict, f"file_id {key_type}, line_index bigint, detected string")
        hits = said.groupBy("file_id", F.col("detected").alias("lang")).agg(F.count(F.lit(1)).alias("score"))
    low = F.transform(F.array_sort(F.collect_list(F.struct((-F.col("score")).alias("s"), "lang"))), lambda x: x["lang"])
    best = hits.groupBy("file_id").agg(F.get(low, 0).alias("_l"))  # an entry a language
    return files.join(best, "file_id", "left").select("file_id", F.coalesce("_l", F.lit("")).alias("detected"), "no_text")


def tagger_lines(lines: DataFrame) -> DataFrame:
    """The lines the tagger's language is told from — all participant lines, or all lines of a file without any."""
    has_p = lines.where(F.col("speaker") == "PARTICIPANT").select("file_id").distinct()
    own = lines.where(F.col("speaker") == "PARTICIPANT")
    return own.unionByName(lines.join(has_p, "file_id", "left_anti"))


def detect_tagger_language(lines: DataFrame, lexicon: DataFrame, predict: Predictor | None = None) -> DataFrame:
    """K1 (tagger variant) + C22b + C23b: ``file_id, detected, tagger``; unsupported or no text -> ``zh``."""
    from parlance.functions.metadata import map_detected_tagger_language
    det = detect_languages(tagger_lines(lines), lexicon, predict)
    return det.select("file_id", "detected",
                      map_detected_tagger_language("detected", F.col("no_text")).alias("tagger"))


def resolve_languages(detected: DataFrame, sites: DataFrame) -> DataFrame:
    """C23 -> C24 -> C25: ``file_id, site, detected, language, tagger``."""
    d = detected.join(sites, "file_id")
    lang = map_detected_language("detected", F.col("no_text"))
    return d.select("file_id", "site", "detected", lang.alias("mapped")).select(
        "file_id", "site", "detected", resolve_language("mapped", "site").alias("language")).select(
        "*", tagger_language("language").alias("tagger"))
