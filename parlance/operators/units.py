"""Everything counted about a file's role units, in one stream.

A line gives its words and one further row (itself, and its sentences).  These are counted by ``(file, speaker, word)`` before
anything is joined, so that the lexicon is met once for each distinct word of a speaker, not for each token; a word's tags and
its frequency then count as often as the word was said.  The joined words are summed up by speaker and row of tags, so that features are
read out of a row of tags once a speaker, not once a word.  Tags, sentences, words, presence and frequencies then become rows ``unit, tag,
cnt`` of one stream, which one aggregate by ``(file, unit, tag)`` sums up; the wide table is a lookup in each file's few sums.

Joins carry no hint and no salt: the word join is a plain shuffle join on ``(lang, word)`` with nothing between its exchange and the next, so
AQE may split the partitions of frequent words (``skewJoin``) or broadcast a lexicon that it has measured to be small.
Rows that are no words get a spread-out key, as they meet nothing.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from parlance.functions.metadata import is_diary
from parlance.functions.tags import safe_names, token_slots, vocab
from parlance.functions.text import is_blank, sentences, words
from parlance.operators.frequency import LOG_SCALE
from parlance.operators.tally import SENT, WORD

LINE, FOUND, VALUE = "#line", "#found", "#value"  # like SENT and WORD, no tags of any vocabulary
ALL = "*"  # the unit of a file's words whoever says them
SPREAD = 1024


def word_rows(lines: DataFrame) -> DataFrame:
    """``file_id, speaker, word, heard, tagged, lines, sents``: how often a speaker says a word, as words of whole lines (C21, for
    frequencies) and of sentence pieces (J3, for tags), and under a NULL word their lines and their sentences (pieces with a word)."""
    pieces = F.transform(sentences("text"), lambda p: words(p))
    said = lines.select("file_id", "speaker", words("text").alias("_w"), F.when(~is_blank("text"), pieces).otherwise(F.array()).alias("_p"))
    no, one = F.lit(0).cast("bigint"), F.lit(1).cast("bigint")

    def row(word: Column, heard: Column, tagged: Column, line: Column = no, sents: Column = no) -> Column:
        return F.struct(word.alias("word"), heard.alias("heard"), tagged.alias("tagged"), line.alias("lines"), sents.alias("sents"))

    full = F.size(F.filter("_p", lambda p: F.size(p) > 0)).cast("bigint")
    rows = F.concat(F.transform("_w", lambda w: row(w, one, no)), F.transform(F.flatten("_p"), lambda w: row(w, no, one)),
                    F.array(row(F.lit(None).cast("string"), no, no, one, full)))
    measures = ["heard", "tagged", "lines", "sents"]
    return (said.select("file_id", "speaker", F.explode(rows).alias("r")).groupBy("file_id", "speaker", F.col("r.word").alias("word"))
            .agg(*[F.sum(f"r.{m}").alias(m) for m in measures]))


def role(diary: Column, speaker: Column) -> Column:
    """The role unit of a line; a diary has one."""
    return (F.when(diary, F.lit("Participant")).when(speaker == "PARTICIPANT", F.lit("Participant"))
            .when(speaker == "INTERVIEWER", F.lit("Interviewer")))


def entries(tags: DataFrame | None, lexicon: DataFrame | None) -> DataFrame:
    """One table of what is known of a word: ``lang, word``, the tag columns of ``tags`` and the value of ``lexicon``
    (``lg_e4`` or ``log_frequency``), as far as they are given."""
    value = [c for c in ("lg_e4", "log_frequency") if lexicon is not None and c in lexicon.columns][:1]
    if tags is None:
        return lexicon.select("lang", "word", *value)
    tags = tags.select("lang", "word", "upos", "xpos", "deprel", "feats")
    return tags if lexicon is None else tags.join(lexicon.select("lang", "word", *value), ["lang", "word"], "full")


def _joined(lines: DataFrame, files: DataFrame, langs: DataFrame, known: DataFrame, diary_mode: str) -> DataFrame:
    """``word_rows`` of the files of ``langs`` with ``lang``, ``diary`` and what is known of the word."""
    meta = files.select("file_id", is_diary("path", diary_mode).alias("diary")).join(langs.select("file_id", "lang"), "file_id")
    spread = F.concat(F.lit("#"), F.pmod(F.xxhash64("file_id"), F.lit(SPREAD)).cast("string"))
    rows = word_rows(lines).join(meta, "file_id").withColumn("_key", F.coalesce("word", spread))
    return rows.join(known.withColumnRenamed("word", "_key"), ["lang", "_key"], "left")


def unit_stream(lines: DataFrame, files: DataFrame, langs: DataFrame, known: DataFrame, vocabulary: list[str] | None = None,
                diary_mode: str = "path") -> DataFrame:
    """``file_id, lang, diary, unit, tag, cnt, val`` over the files of ``langs`` (``file_id, lang``); ``known``: see :func:`entries`.

    Units are the roles (tags, ``#word``, ``#sent``, ``#line``) and, for frequencies, the speakers and ``*``, everybody (``#found``, ``#value``,
    ``#line``).  ``#value`` is in ``cnt`` for whole-number lexicons (``lg_e4``), else in ``val``.
    """
    j = _joined(lines, files, langs, known, diary_mode)
    values = [c for c in ("lg_e4", "log_frequency") if c in known.columns]
    tags = ["upos", "xpos", "deprel", "feats"] if "upos" in known.columns else []
    if tags:
        j = j.withColumn("upos", F.coalesce("upos", F.lit("X")))
    sums = [F.sum(m).alias(m) for m in ("lines", "sents", "tagged")]
    for value in values:
        found, total = F.when(F.col(value).isNotNull(), F.col("heard")), F.col("heard") * F.col(value)
        worth = F.sum(F.when(total.cast("bigint") > 0, total.cast("bigint"))) if value == "lg_e4" else F.sum(total.cast("double"))
        sums += [F.sum(found).alias(f"found_{value}"), worth.alias(f"worth_{value}")]
    j = j.groupBy("file_id", "lang", "diary", "speaker", *tags).agg(*sums)
    unit, no_value = role(F.col("diary"), F.col("speaker")), F.lit(None).cast("double")

    def entry(u: Column, tag: Column | str, cnt: Column, val: Column = no_value) -> Column:
        return F.struct(u.alias("unit"), (F.lit(tag) if isinstance(tag, str) else tag).alias("tag"), cnt.alias("cnt"), val.alias("val"))

    out = [F.array(entry(unit, LINE, F.col("lines")), entry(unit, SENT, F.col("sents")), entry(unit, WORD, F.col("tagged")), entry(F.col("speaker"), LINE, F.col("lines")))]
    if tags:
        out.append(F.transform(F.when(F.col("tagged") > 0, token_slots()).otherwise(F.array()), lambda t: entry(unit, t, F.col("tagged"))))
    for value in values:
        found, total = F.col(f"found_{value}"), F.col(f"worth_{value}")
        worth = entry(F.lit(ALL), VALUE, total) if value == "lg_e4" else entry(F.lit(ALL), VALUE, found, total)
        everybody = F.array(entry(F.lit(ALL), FOUND, found), worth)
        out += [everybody, F.transform(everybody, lambda e: entry(F.col("speaker"), e["tag"], e["cnt"], e["val"]))]
    keep = F.col("e.tag").isin(*(vocabulary or vocab()), SENT, WORD, LINE, FOUND, VALUE)  # InSet: a hash lookup, before the shuffle
    return (j.select("file_id", "lang", "diary", F.explode(F.concat(*out)).alias("e"))
            .where(F.col("e.unit").isNotNull() & keep & (F.col("e.cnt") > 0))
            .groupBy("file_id", "lang", "diary", F.col("e.unit").alias("unit"), F.col("e.tag").alias("tag"))
            .agg(F.sum("e.cnt").alias("cnt"), F.sum("e.val").alias("val")))


def unit_counts(stream: DataFrame) -> DataFrame:
    """``file_id, speaker_role, tag, cnt``: vocabulary tags, ``#sent`` and ``#word`` of each role unit, as ``tally.unit_counts`` gives them from tokens."""
    kept = F.col("unit").isin("Participant", "Interviewer") & ~F.col("tag").isin(LINE)
    return stream.where(kept).select("file_id", F.col("unit").alias("speaker_role"), "tag", "cnt")


def unit_lines(stream: DataFrame) -> DataFrame:
    """``file_id, speaker_role, num_lines, num_sent, num_words`` of the role units that have a line."""
    def total(tag: str) -> Column:
        return F.sum(F.when(F.col("tag") == tag, F.col("cnt")).otherwise(0))
    rows = stream.where(F.col("unit").isin("Participant", "Interviewer") & F.col("tag").isin(LINE, SENT, WORD))
    return rows.groupBy("file_id", F.col("unit").alias("speaker_role")).agg(total(LINE).alias("num_lines"), total(SENT).alias("num_sent"), total(WORD).alias("num_words"))


def line_counts(lines: DataFrame, files: DataFrame, langs: DataFrame, diary_mode: str = "path") -> DataFrame:
    """As :func:`unit_lines`, straight from the lines: one aggregate, no lexicon."""
    meta = files.select("file_id", is_diary("path", diary_mode).alias("diary")).join(langs.select("file_id"), "file_id")
    sizes = F.transform(F.when(~is_blank("text"), sentences("text")).otherwise(F.array()), lambda p: F.size(words(p)).cast("bigint"))
    full = F.size(F.filter("_s", lambda n: n > 0)).cast("bigint")
    said = lines.select("file_id", "speaker", sizes.alias("_s")).select(
        "file_id", "speaker", full.alias("sents"), F.aggregate("_s", F.lit(0).cast("bigint"), lambda a, n: a + n).alias("words"))
    by_speaker = said.groupBy("file_id", "speaker").agg(F.count(F.lit(1)).alias("lines"), F.sum("sents").alias("sents"), F.sum("words").alias("words"))
    unit = role(F.col("diary"), F.col("speaker"))
    return (by_speaker.join(meta, "file_id").select("file_id", unit.alias("speaker_role"), "lines", "sents", "words").where("speaker_role is not null")
            .groupBy("file_id", "speaker_role").agg(F.sum("lines").alias("num_lines"), F.sum("sents").alias("num_sent"), F.sum("words").alias("num_words")))


def _role_rows(per_file: DataFrame, fields: list[str], tags: bool = False) -> DataFrame:
    """A row for each role (one in a diary) of ``per_file``: of the sums ``p_<f>``, ``i_<f>`` and ``a_<f>`` (participant, interviewer, all
    lines) those that count for the role (its own, or all where it has no line, and in a diary), and its map of ``tags``."""
    def one(name: str, own: str) -> Column:
        everybody = F.col("diary") | (F.coalesce(F.col(f"{own}_l"), F.lit(0)) == 0)
        of_role = F.transform(F.filter("_e", lambda e: e["unit"] == name), lambda e: F.struct(e["tag"], e["cnt"])) if tags else None
        return F.struct(F.lit(name).alias("speaker_role"), *([F.map_from_entries(of_role).alias("_m")] if tags else []),
                        *[F.when(everybody, F.col(f"a_{f}")).otherwise(F.col(f"{own}_{f}")).alias(f) for f in fields])

    roles = F.when(F.col("diary"), F.array(one("Participant", "p"))).otherwise(F.array(one("Participant", "p"), one("Interviewer", "i")))
    return per_file.select("file_id", "lang", F.explode(roles).alias("u")).select("file_id", "lang", "u.*")


def _mean(value: Column, found: Column, whole: bool) -> Column:
    return F.when(found > 0, value.cast("double") / (found * (LOG_SCALE if whole else 1)).cast("double"))


def frequencies(lines: DataFrame, files: DataFrame, langs: DataFrame, lexicon: DataFrame, diary_mode: str = "path") -> DataFrame:
    """J2 + E5 + F4 alone: ``file_id, speaker_role, lang, n_words, found, missing, word_freq, coverage`` of every role unit with words.

    A unit's words are those of its speaker's lines, or of all lines if the file has none for the role; a diary gives the participant
    unit (over all lines).  Means are over the words found in ``lexicon`` (``lang, word`` and ``lg_e4`` or ``log_frequency``).
    """
    value = "lg_e4" if "lg_e4" in lexicon.columns else "log_frequency"
    j = _joined(lines, files, langs, entries(None, lexicon), diary_mode)
    found = F.when(F.col(value).isNotNull(), F.col("heard")).otherwise(0)

    def sums(unit: str, said: Column) -> list[Column]:
        return [F.sum(F.when(said, m)).alias(f"{unit}{k}") for k, m in (("_n", F.col("heard")), ("_f", found), ("_v", F.col("heard") * F.col(value)), ("_l", F.col("lines")))]

    p, i = F.col("speaker") == "PARTICIPANT", F.col("speaker") == "INTERVIEWER"
    per_file = j.groupBy("file_id", "lang", "diary").agg(*sums("p", p), *sums("i", i), *sums("a", F.lit(True)))

    rows = _role_rows(per_file, ["n", "f", "v"]).where("n > 0")
    return rows.select("file_id", "speaker_role", "lang", F.col("n").alias("n_words"), F.col("f").alias("found"), (F.col("n") - F.col("f")).alias("missing"),
                       _mean(F.col("v"), F.col("f"), value == "lg_e4").alias("word_freq"), F.try_divide((F.col("f") * 100).cast("double"), F.col("n").cast("double")).alias("coverage"))


def wide(stream: DataFrame, known: DataFrame, vocabulary: list[str] | None = None) -> DataFrame:
    """``file_id, speaker_role``, a zero-filled column for each tag, ``num_sent`` and ``word_freq`` (NULL if no word was found) of every role
    unit with a token."""
    whole = "log_frequency" not in known.columns
    value = F.col("cnt") if whole else F.col("val")

    def total(unit: str, tag: str, measure: Column) -> Column:
        return F.sum(F.when((F.col("unit") == unit) & (F.col("tag") == tag), measure))

    of_role = F.when(F.col("unit").isin("Participant", "Interviewer"), F.struct("unit", "tag", "cnt"))
    sums = [total(u, t, m).alias(f"{k}_{f}") for k, u in (("p", "PARTICIPANT"), ("i", "INTERVIEWER"), ("a", ALL)) for f, t, m in (("f", FOUND, F.col("cnt")), ("v", VALUE, value), ("l", LINE, F.col("cnt")))]
    per_file = stream.groupBy("file_id", "lang", "diary").agg(F.collect_list(of_role).alias("_e"), *sums)  # a role has at most the vocabulary and three more
    rows = _role_rows(per_file, ["f", "v"], tags=True).where(f"_m['{WORD}'] > 0").withColumn("word_freq", _mean(F.coalesce("v", F.lit(0)), F.col("f"), whole))
    cols = [f"CAST(coalesce(_m['{t}'], 0) AS BIGINT) AS `{n}`" for t, n in safe_names(vocabulary).items()]
    return rows.selectExpr("file_id", "speaker_role", *cols, f"_m['{SENT}'] AS num_sent", "word_freq")
