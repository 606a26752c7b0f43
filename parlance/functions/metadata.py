"""Column functions that derive transcript metadata from names and paths.

Lookup tables from ``parlance.constants`` are folded into the plan as
literal arrays / maps, so no join (and no broadcast) is needed for them.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from parlance.functions.text import strip_ws
from parlance.constants import (
    CHINESE_CODES, LANGUAGES, OPEN_SPELLINGS, PSYCHS_SPELLINGS, SITES, TAGGER_LANGUAGES,
)


def _c(x: Column | str) -> Column:
    return F.col(x) if isinstance(x, str) else x


def _lit_array(values: list[str]) -> Column:
    return F.array(*[F.lit(v) for v in values])


def basename(path: Column | str) -> Column:
    """``Path(x).name``: the part after the last ``/``."""
    return F.element_at(F.split(_c(path), "/"), -1)


def null_to_unknown(x: Column | str) -> Column:
    """``x or 'UNKNOWN'`` (NULL and empty both become UNKNOWN)."""
    return F.coalesce(F.nullif(_c(x), F.lit("")), F.lit("UNKNOWN"))


def name_token(name: Column | str, i: int) -> Column:
    """Token ``i`` of the ``_``-split file name, NULL when absent."""
    return F.get(F.split(_c(name), "_"), i)


def patient_id(name: Column | str) -> Column:
    return name_token(name, 1)


def transcript_type(name: Column | str) -> Column:
    return name_token(name, 3)


def day(name: Column | str) -> Column:
    return name_token(name, 4)


def session(name: Column | str) -> Column:
    return name_token(name, 5)


def site_code(name: Column | str) -> Column:
    """First site (in match order) contained in name token 0; NULL if none."""
    tok0 = name_token(name, 0)
    return F.get(F.filter(_lit_array([s for s, _ in SITES]), lambda s: F.instr(tok0, s) > 0), 0)


def _dir_parts_nearest_first(path: Column | str) -> Column:
    parts = F.split(_c(path), "/")
    return F.reverse(F.slice(parts, 1, F.greatest(F.size(parts) - 1, F.lit(0))))


def clinical_group_from_path(path: Column | str) -> Column:
    """Nearest ancestor folder whose upper-cased name contains CHR, else HC."""
    tagged = F.transform(
        _dir_parts_nearest_first(path),
        lambda p: F.when(F.upper(p).contains("CHR"), F.lit("CHR"))
        .when(F.upper(p).contains("HC"), F.lit("HC")))
    return F.coalesce(F.get(F.filter(tagged, lambda x: x.isNotNull()), 0), F.lit("UNKNOWN"))


def language_from_path(path: Column | str) -> Column:
    """Nearest ancestor named ``Language.<code>`` or bare ``<code>``; else UNKNOWN."""
    codes = _lit_array([c for c, _ in LANGUAGES])
    tagged = F.transform(
        _dir_parts_nearest_first(path),
        lambda p: F.when(F.array_contains(codes, F.regexp_replace(p, r"^Language[.]", "")),
                         F.regexp_replace(p, r"^Language[.]", "")))
    return F.coalesce(F.get(F.filter(tagged, lambda x: x.isNotNull()), 0), F.lit("UNKNOWN"))


def _sites_map() -> Column:
    return F.create_map(*[x for s, langs in SITES for x in (F.lit(s), _lit_array(langs))])


def site_languages(site: Column | str) -> Column:
    """Allowed languages of a site (case-insensitive); ``['UNKNOWN']`` if unknown."""
    return F.coalesce(F.try_element_at(_sites_map(), F.upper(_c(site))), _lit_array(["UNKNOWN"]))


def site_primary_language(site: Column | str) -> Column:
    return F.get(site_languages(site), 0)


def language_name(code: Column | str) -> Column:
    """Display name of a language code; unknown codes pass through."""
    m = F.create_map(*[x for c, n in LANGUAGES for x in (F.lit(c), F.lit(n))])
    return F.coalesce(F.try_element_at(m, _c(code)), _c(code))


def is_diary(x: Column | str, mode: str = "path") -> Column:
    """C6 diary test.  ``path`` (C6a) / ``name`` (C6b): contains ``audioJournal``
    or lower-case contains ``diary``; ``parts`` (C6c): some path part lower-case
    contains ``diary`` (no ``audioJournal``)."""
    c = _c(x)
    if mode in ("path", "name"):
        return c.contains("audioJournal") | F.lower(c).contains("diary")
    if mode == "parts":
        return F.exists(F.split(c, "/"), lambda p: F.lower(p).contains("diary"))
    raise ValueError(f"unknown diary mode {mode!r}")


def normalize_interview_type(x: Column | str, strict: bool = False) -> Column:
    """Trim + upper; OPEN spellings -> OPEN, PSYCHS spellings -> PSYCHS.

    ``strict``: the same spellings give ``open`` / ``psychs`` and anything else NULL.
    """
    u = F.upper(strip_ws(_c(x)))  # Python strip(), not Spark's space-only trim
    if strict:
        return (F.when(u.isin(*OPEN_SPELLINGS), F.lit("open"))
                .when(u.isin(*PSYCHS_SPELLINGS), F.lit("psychs")))
    return (F.when(u.isin(*OPEN_SPELLINGS), F.lit("OPEN"))
            .when(u.isin(*PSYCHS_SPELLINGS), F.lit("PSYCHS"))
            .otherwise(u))


def normalize_submission(name: Column | str) -> Column:
    """Every ``submission<digits>`` becomes its integer value padded to >= 4 digits.

    Two regex passes: drop leading zeros, then left-pad 1-3 digit numbers.
    (``lpad`` is not used: it truncates longer numbers.)
    """
    s = F.regexp_replace(_c(name), r"submission0*([0-9]+)", "submission$1")
    s = F.regexp_replace(s, r"submission([0-9])(?![0-9])", "submission000$1")
    s = F.regexp_replace(s, r"submission([0-9]{2})(?![0-9])", "submission00$1")
    return F.regexp_replace(s, r"submission([0-9]{3})(?![0-9])", "submission0$1")


def map_detected_language(code: Column | str, text_empty: Column | None = None) -> Column:
    """Language-ID output -> language code: Chinese variants -> ``cn``; a known
    code stays; empty / unknown -> UNKNOWN; empty sample text -> UNKNOWN."""
    c = _c(code)
    known = _lit_array([k for k, _ in LANGUAGES])
    out = (F.when(c.isin(*CHINESE_CODES), F.lit("cn"))
           .when(F.array_contains(known, c), c)
           .otherwise(F.lit("UNKNOWN")))
    if text_empty is not None:
        out = F.when(text_empty, F.lit("UNKNOWN")).otherwise(out)
    return out


def map_detected_tagger_language(code: Column | str, text_empty: Column | None = None) -> Column:
    """Tagger variant: a supported code stays; anything else (or no text) -> ``zh``."""
    c = _c(code)
    out = F.when(c.isin(*TAGGER_LANGUAGES), c).otherwise(F.lit("zh"))
    if text_empty is not None:
        out = F.when(text_empty, F.lit("zh")).otherwise(out)
    return out


def resolve_language(detected: Column | str, site: Column | str) -> Column:
    """No site: the detected language; else detected if the site allows it, else UNKNOWN."""
    d, s = _c(detected), _c(site)
    return (F.when(s.isNull(), d)
            .when(F.array_contains(site_languages(s), d), d)
            .otherwise(F.lit("UNKNOWN")))


def tagger_language(lang: Column | str) -> Column:
    """C25 / D-3: ``cn`` -> ``detect``; a tagger-supported code -> itself; else
    NULL (an ``unsupported_language`` failure)."""
    c = _c(lang)
    return F.when(c == "cn", F.lit("detect")).when(c.isin(*TAGGER_LANGUAGES), c)


def speaker_role_display(role: Column | str) -> Column:
    c = _c(role)
    return (F.when(c == "participant", F.lit("Participant"))
            .when(c == "interviewer", F.lit("Interviewer")).otherwise(c))


def corrected_name(name: Column | str, old_type: Column | str, new_type: Column | str) -> Column:
    """Replace every ``_<old lower>_`` by ``_<new lower>_``."""
    return F.replace(_c(name), F.concat(F.lit("_"), F.lower(_c(old_type)), F.lit("_")),
                     F.concat(F.lit("_"), F.lower(_c(new_type)), F.lit("_")))


def transcript_key(site, patient, lang, ttype, day_, session_) -> Column:
    """Display key ``site_patient_lang_type_day_session`` (NULL -> UNKNOWN)."""
    return F.concat_ws("_", *[null_to_unknown(c) for c in (site, patient, lang, ttype, day_, session_)])
