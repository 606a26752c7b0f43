"""Column functions over transcript text (one line or one short string).

All are built-in Spark expressions: they stay inside whole-stage codegen and
never leave the JVM.  Anything that spans several lines of a file lives in
``parlance.operators.lines`` as a DataFrame operator instead.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from parlance.constants import NON_WORD, SPEAKER_LABEL, TIMESTAMP, WS

NOT_WS = r"[^\p{Z}\x09-\x0d\x1c-\x1f\x85]"


def _c(x: Column | str) -> Column:
    return F.col(x) if isinstance(x, str) else x


def strip_ws(x: Column | str) -> Column:
    """Python ``str.strip()``: remove leading/trailing Unicode whitespace.

    Spark's ``trim`` removes only U+0020, so a regex over the full class.
    """
    return F.regexp_replace(_c(x), rf"^{WS}+|{WS}+\z", "")


def is_blank(x: Column | str) -> Column:
    """``x.strip() == ''``: no character outside the whitespace class (a regex
    find that stops at the first such character; cheaper than stripping)."""
    return ~_c(x).rlike(NOT_WS)


def line_speaker(stripped: Column | str) -> Column:
    """Speaker by line *prefix*: PARTICIPANT / INTERVIEWER, else UNKNOWN."""
    s = _c(stripped)
    return (F.when(s.startswith("PARTICIPANT"), F.lit("PARTICIPANT"))
            .when(s.startswith("INTERVIEWER"), F.lit("INTERVIEWER"))
            .otherwise(F.lit("UNKNOWN")))


def line_timestamp(stripped: Column | str) -> Column:
    """First ``HH:MM:SS.mmm`` in the line, else ``''``."""
    return F.regexp_extract(_c(stripped), rf"(?s)^.*?({TIMESTAMP})", 1)


def line_text(stripped: Column | str) -> Column:
    """Text after the first timestamp, else after the first ``:``, stripped."""
    s = _c(stripped)
    after_ts = F.regexp_extract(s, rf"(?s)^.*?{TIMESTAMP}(.*)\z", 1)
    colon = F.instr(s, ":")
    after_colon = F.when(colon > 0, s.substr(colon + 1, F.lit(2147483647))).otherwise(s)
    return F.when(s.rlike(TIMESTAMP), strip_ws(after_ts)).otherwise(strip_ws(after_colon))


def leading_label(raw: Column | str, is_last: Column | bool = False) -> Column:
    """Speaker label ``S[IP digits]+`` opening a raw line, followed by ``:`` or
    whitespace; ``''`` if none.

    The original applies a multi-line regex to the whole file, where the
    newline that ends a line also counts as the whitespace after a label.  So
    a line that is exactly a label still carries it, unless it is the file's
    last line (``is_last``).
    """
    r = _c(raw)
    last = F.lit(is_last) if isinstance(is_last, bool) else is_last
    lab = F.regexp_extract(r, rf"^({SPEAKER_LABEL})(?::|(?={WS}))", 1)
    bare = F.when(r.rlike(rf"^{SPEAKER_LABEL}\z") & ~last, r).otherwise(F.lit(""))
    return F.when(lab != "", lab).otherwise(bare)


def role_label_present(raw: Column | str, role: str, is_last: Column | bool = False) -> Column:
    """Does the raw line open with ``role`` followed by ``:`` or whitespace?"""
    r = _c(raw)
    last = F.lit(is_last) if isinstance(is_last, bool) else is_last
    return r.rlike(rf"^{role}(?::|(?={WS}))") | ((r == F.lit(role)) & ~last)


def fix_missing_colon(raw: Column | str, is_last: Column | bool = False) -> Column:
    """Line-start PARTICIPANT / INTERVIEWER followed by whitespace gains ``:``."""
    r = _c(raw)
    last = F.lit(is_last) if isinstance(is_last, bool) else is_last
    fixed = F.regexp_replace(r, rf"^(PARTICIPANT|INTERVIEWER)(?={WS})", "$1:")
    bare = r.isin("PARTICIPANT", "INTERVIEWER") & ~last
    return F.when(bare, F.concat(r, F.lit(":"))).otherwise(fixed)


def relabel_line(raw: Column | str, label: Column | str, new_label: Column | str) -> Column:
    """Replace the opening ``label`` (and a ``:`` right after it) by ``new_label:``.

    ``label`` must be what :func:`leading_label` found on this line.
    """
    r, lab, new = _c(raw), _c(label), _c(new_label)
    n = F.length(lab)
    tail = r.substr(n + 1, F.lit(2147483647))
    tail = F.when(tail.startswith(":"), tail.substr(F.lit(2), F.lit(2147483647))).otherwise(tail)
    return F.concat(new, F.lit(":"), tail)


def pieces(text: Column | str) -> Column:
    """Lower-case, delete non-word non-space characters, split on whitespace; the first and last piece may be empty."""
    return F.split(F.regexp_replace(F.lower(_c(text)), NON_WORD, ""), f"{WS}+")


def words(text: Column | str) -> Column:
    """The pieces that are not empty."""
    return F.filter(pieces(text), lambda w: w != F.lit(""))


def sentences(text: Column | str) -> Column:
    """Sentence pieces of a line for the built-in annotator: split on runs of
    ``.``, ``!`` or ``?``; pieces without a word are dropped later."""
    return F.split(_c(text), r"[.!?]+")
