"""Column functions for grammatical tags (C18, C19) and wide-table names."""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from parlance.constants import TAG_RENAMES, UD_FEATURE_KEYS, VOCAB_FILE_ORDER


def vocab() -> list[str]:
    """Distinct tags in file order (102 of the 105 lines; repeats dropped)."""
    seen: list[str] = []
    for t in VOCAB_FILE_ORDER:
        if t not in seen:
            seen.append(t)
    return seen


def listed(tags: DataFrame, most: int = 10_000) -> list[str]:
    """A caller's vocabulary (``pos, tag``: see ``read_vocab``) as a list: distinct tags in file order.

    Each tag is a column of the wide table, so the driver may hold them; a table of more than ``most`` distinct tags is no vocabulary and refused.
    """
    found = tags.groupBy("tag").agg(F.min("pos").alias("pos")).orderBy("pos").limit(most + 1).collect()
    if len(found) > most:
        raise ValueError(f"a vocabulary has at most {most} tags")
    if not found:
        raise ValueError("a vocabulary has at least one tag")
    return [r["tag"] for r in found]


def ud_feature(feats: Column | str, key: str) -> Column:
    """Value of ``key`` in a ``K=V|K=V`` string: the LAST item *containing*
    ``key``, minus ``len(key)+1`` leading chars; ``Mood`` values gain ``_mood``;
    absent / NULL -> ``''``."""
    f = F.col(feats) if isinstance(feats, str) else feats
    item = F.try_element_at(F.filter(F.split(f, "[|]"), lambda x: x.contains(key)), F.lit(-1))
    val = F.substring(item, len(key) + 2, 2147483647)
    if key == "Mood":
        val = F.concat(val, F.lit("_mood"))
    return F.coalesce(val, F.lit(""))


def token_slots(upos: str = "upos", xpos: str = "xpos", deprel: str = "deprel",
                feats: str = "feats") -> Column:
    """The 14 countable slots of a token: upos, xpos, deprel and 11 UD features."""
    return F.array(F.col(upos), F.col(xpos), F.col(deprel), *[ud_feature(feats, k) for k in UD_FEATURE_KEYS])


def rename_tag(tag: str) -> str:
    """C19 (header names): ``1 2 3 Yes`` -> ``p1 p2 p3 pronoun_possession``."""
    return TAG_RENAMES.get(tag, tag)


def safe_names(vocabulary: list[str] | None = None) -> dict[str, str]:
    """Tag -> column name legal in Parquet and case-insensitive SQL: renamed,
    ``:`` and ``$`` spelled out, and a tag whose lower-case form repeats an
    earlier one suffixed ``_2`` (``DET``/``det``, ``Part``/``PART``)."""
    out: dict[str, str] = {}
    used: set[str] = set()
    for t in dict.fromkeys(vocabulary or vocab()):
        n = rename_tag(t).replace(":", "_").replace("$", "_poss")
        n = re.sub(r"[^A-Za-z0-9_]", "_", n)
        if n.lower() in used:
            n = next(m for k in range(2, len(used) + 3) if (m := f"{n}_{k}").lower() not in used)
        used.add(n.lower())
        out[t] = n
    return out
