"""Licence scans by sentence rules, in DataFrame functions only.

A text is cut into stretches at full stops and the like and at lines without a letter or digit (blank lines, a lone ``*`` or
``#`` of a comment).  A stretch that is a known licence sentence, normalised (letters and digits in lower case, single spaces, so
comment leaders vanish), becomes its identifier; if it isn't known as a whole it is looked up line by line.  Known
wordings pass through the same cuts: one that falls into several pieces counts where all its pieces follow each other.

The ordered licence rules then rewrite the sequence of identifiers, most specific first: a rule that fits replaces its
identifiers by the licence, so that they cannot count for a later rule.  Identifiers that ``gap`` or more unknown words part are
no sequence.  Identifiers that no rule used are reported as they are.

Defined results: null and empty texts have no sentences and no licences (empty arrays); repeated rows and null ids
keep their rows; an empty table gives no rows; other columns are kept by ``scan`` unless they bear the name
of a result column, which then replaces them.  Identifiers and licences are names without brackets, braces, ``~`` and ``|``.
"""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Licence sentences in their public wording, as normalised by ``normalised``, and their identifiers.
SENTENCES: dict[str, str] = {
    "apache license": "ApacheTitle",
    "licensed under the apache license version 2 0": "ApacheRef",
    "licensed under the apache license version 2 0 the license": "ApacheRef",
    "licensed under the apache license version 2 0 the license you may not use this file except in compliance with the license": "ApacheHeader",
    "you may not use this file except in compliance with the license": "ApacheComply",
    "you may obtain a copy of the license at": "ApacheObtain",
    "you may obtain a copy of the license at http www apache org licenses license 2 0": "ApacheObtain",
    "unless required by applicable law or agreed to in writing software distributed under the license is distributed on an as is basis without warranties or conditions of any kind either express or implied": "ApacheAsIs",
    "see the license for the specific language governing permissions and limitations under the license": "ApacheSee",
    "mit license": "MITTitle",
    "the mit license": "MITTitle",
    "released under the mit license": "MITRef",
    "licensed under the mit license": "MITRef",
    "this project is licensed under the mit license": "MITRef",
    "permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files the software to deal in the software without restriction including without limitation the rights to use copy modify merge publish distribute sublicense and or sell copies of the software and to permit persons to whom the software is furnished to do so subject to the following conditions": "MITGrant",
    "the above copyright notice and this permission notice shall be included in all copies or substantial portions of the software": "MITNotice",
    "the software is provided as is without warranty of any kind express or implied including but not limited to the warranties of merchantability fitness for a particular purpose and noninfringement": "MITAsIs",
    "in no event shall the authors or copyright holders be liable for any claim damages or other liability whether in an action of contract tort or otherwise arising from out of or in connection with the software or the use or other dealings in the software": "MITLiability",
    "redistribution and use in source and binary forms with or without modification are permitted provided that the following conditions are met": "BSDGrant",
    "redistributions of source code must retain the above copyright notice this list of conditions and the following disclaimer": "BSDSource",
    "1 redistributions of source code must retain the above copyright notice this list of conditions and the following disclaimer": "BSDSource",
    "redistributions in binary form must reproduce the above copyright notice this list of conditions and the following disclaimer in the documentation and or other materials provided with the distribution": "BSDBinary",
    "2 redistributions in binary form must reproduce the above copyright notice this list of conditions and the following disclaimer in the documentation and or other materials provided with the distribution": "BSDBinary",
    "neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission": "BSDEndorse",
    "3 neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission": "BSDEndorse",
    "licensed under the bsd 3 clause license": "BSD3Ref",
    "licensed under the bsd 2 clause license": "BSD2Ref",
    "permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted provided that the above copyright notice and this permission notice appear in all copies": "ISCGrant",
    "see the gnu general public license for more details": "GPLSee",
    "see the gnu lesser general public license for more details": "LGPLSee",
    "see the gnu affero general public license for more details": "AGPLSee",
    "this work is licensed under the gnu general public license version 3": "GPL3Ref",
    "licensed under the gnu general public license version 3": "GPL3Ref",
    "this work is licensed under the gnu general public license version 2": "GPL2Ref",
    "licensed under the gnu lesser general public license version 3": "LGPL3Ref",
    "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0": "MPLSubject",
    "this source code form is subject to the terms of the mozilla public license version 2 0": "MPLSubject",
    "if a copy of the mpl was not distributed with this file you can obtain one at": "MPLObtain",
    "if a copy of the mpl was not distributed with this file you can obtain one at http mozilla org mpl 2 0": "MPLObtain",
    "if a copy of the mpl was not distributed with this file you can obtain one at https mozilla org mpl 2 0": "MPLObtain",
    "licensed under cc by 4 0": "CCBY4Ref",
    "licensed under cc by sa 4 0": "CCBYSA4Ref",
    "licensed under cc by nc 4 0": "CCBYNC4Ref",
    "this work is licensed under a creative commons attribution 4 0 international license": "CCBY4Ref",
    "this work is licensed under a creative commons attribution noncommercial 4 0 international license": "CCBYNC4Ref",
    "this work is licensed under a creative commons attribution sharealike 4 0 international license": "CCBYSA4Ref",
    "this is free and unencumbered software released into the public domain": "UnlicenseGrant",
    "all rights reserved": "AllRights",
}

# The notices of the GNU licences differ by name and version alone: (identifier, what is licensed, name, version).
GNU = [("GPL3Plus", "program", "GNU General Public License", "3"), ("GPL2Plus", "program", "GNU General Public License", "2"),
       ("LGPL3Plus", "library", "GNU Lesser General Public License", "3"), ("LGPL21Plus", "library", "GNU Lesser General Public License", "2.1"),
       ("AGPL3Plus", "program", "GNU Affero General Public License", "3")]
for _id, _what, _name, _version in GNU:
    for _after in ":;,":
        for _before in ",;":
            SENTENCES[f"This {_what} is free software{_after} you can redistribute it and/or modify it under the terms of the {_name} as published by the "
                      f"Free Software Foundation{_before} either version {_version} of the License, or (at your option) any later version"] = _id
    for _middle in ";,":
        SENTENCES[f"This {_what} is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY{_middle} without even the implied "
                  "warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE"] = "GPLNoWarranty"

# Licences that an ``SPDX-License-Identifier:`` line may name.
SPDX = ("Apache-2.0", "MIT", "BSD-3-Clause", "BSD-2-Clause", "ISC", "GPL-3.0-or-later", "GPL-2.0-or-later", "GPL-3.0-only", "GPL-2.0-only",
        "LGPL-3.0-or-later", "LGPL-2.1-or-later", "LGPL-3.0-only", "AGPL-3.0-or-later", "MPL-2.0", "CC-BY-4.0", "CC-BY-SA-4.0", "CC-BY-NC-4.0", "Unlicense")
SENTENCES |= {f"SPDX-License-Identifier: {name}": f"SPDX-{name}" for name in SPDX}

# Ordered rules: (licence, identifiers in sequence).
RULES: list[tuple[str, tuple[str, ...]]] = [
    ("Apache-2.0", ("ApacheHeader", "ApacheObtain", "ApacheAsIs", "ApacheSee")),
    ("Apache-2.0", ("ApacheRef", "ApacheComply", "ApacheObtain", "ApacheAsIs", "ApacheSee")),
    ("Apache-2.0", ("ApacheHeader",)),
    ("Apache-2.0", ("ApacheRef", "ApacheComply")),
    ("Apache-2.0", ("ApacheRef",)),
    ("MIT", ("MITTitle", "MITGrant", "MITNotice", "MITAsIs", "MITLiability")),
    ("MIT", ("MITGrant", "MITNotice", "MITAsIs", "MITLiability")),
    ("MIT-no-warranty-text", ("MITGrant", "MITNotice")),
    ("MIT", ("MITRef",)),
    ("BSD-3-Clause", ("BSDGrant", "BSDSource", "BSDBinary", "BSDEndorse")),
    ("BSD-2-Clause", ("BSDGrant", "BSDSource", "BSDBinary")),
    ("BSD-3-Clause", ("BSD3Ref",)),
    ("BSD-2-Clause", ("BSD2Ref",)),
    ("ISC", ("ISCGrant",)),
    ("AGPL-3.0-or-later", ("AGPL3Plus", "GPLNoWarranty", "AGPLSee")),
    ("LGPL-3.0-or-later", ("LGPL3Plus", "GPLNoWarranty", "LGPLSee")),
    ("LGPL-2.1-or-later", ("LGPL21Plus", "GPLNoWarranty", "LGPLSee")),
    ("GPL-3.0-or-later", ("GPL3Plus", "GPLNoWarranty", "GPLSee")),
    ("GPL-2.0-or-later", ("GPL2Plus", "GPLNoWarranty", "GPLSee")),
    ("AGPL-3.0-or-later", ("AGPL3Plus",)),
    ("LGPL-3.0-or-later", ("LGPL3Plus",)),
    ("LGPL-2.1-or-later", ("LGPL21Plus",)),
    ("GPL-3.0-or-later", ("GPL3Plus",)),
    ("GPL-2.0-or-later", ("GPL2Plus",)),
    ("GPL-3.0-only", ("GPL3Ref",)),
    ("GPL-2.0-only", ("GPL2Ref",)),
    ("LGPL-3.0-only", ("LGPL3Ref",)),
    ("MPL-2.0", ("MPLSubject", "MPLObtain")),
    ("MPL-2.0", ("MPLSubject",)),
    ("CC-BY-4.0", ("CCBY4Ref",)),
    ("CC-BY-SA-4.0", ("CCBYSA4Ref",)),
    ("CC-BY-NC-4.0", ("CCBYNC4Ref",)),
    ("Unlicense", ("UnlicenseGrant",)),
    ("All-rights-reserved", ("AllRights",)),
    *((name, (f"SPDX-{name}",)) for name in SPDX),
]

#: Ends of a stretch: a full stop and the like before white space, or a line without a letter or digit.
STRETCH = "[.!?;:][ \t]*\r?\n|[.!?;:][ \t]+|\r?\n[^A-Za-z0-9\n]*\n"
#: A comment leader that would be taken for the end of a stretch.
LEADER = "(^|\n)[ \t]*;+"
#: Unknown words that part two sequences.
GAP = 200


def normalised(sentence: Column) -> Column:
    return F.trim(F.translate(F.regexp_replace(sentence, "[^A-Za-z0-9]+", " "),
                              "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"))


def pieces(sentences: dict[str, str]) -> tuple[dict[str, str], list[tuple[str, str]]]:
    """The normalised pieces of the known wordings with their marks, and (marks in sequence, mark of the whole wording), longest first.

    A wording of one piece has its identifier as its mark, ``[id]``; a piece that is no wording by itself has a number, ``{n}``.
    """
    cut = {w: [n for n in (re.sub("[^a-z0-9]+", " ", p.lower()).strip() for p in re.split(STRETCH, w)) if n] for w in sentences}
    marks = {parts[0]: f"[{sentences[w]}]" for w, parts in cut.items() if len(parts) == 1}
    for parts in cut.values():
        for p in parts:
            marks.setdefault(p, f"{{{len(marks)}}}")
    wholes = {"".join(marks[p] for p in parts): f"[{sentences[w]}]" for w, parts in cut.items() if len(parts) > 1}
    return marks, sorted(wholes.items(), key=lambda x: (-x[0].count("{") - x[0].count("["), x[0]))


def sequence(text: Column, sentences: dict[str, str] = SENTENCES, gap: int = GAP) -> Column:
    """The identifiers of a text's known sentences in order, as ``[id]``, with ``|`` where ``gap`` or more unknown words stand between."""
    marks, wholes = pieces(sentences)
    known = F.create_map(*[F.lit(x) for pair in marks.items() for x in pair])
    words = list(marks)

    def mark(s: Column) -> Column:
        unknown = F.when(s == "", 0).otherwise(F.least(F.length(s) - F.length(F.replace(s, F.lit(" "), F.lit(""))) + 1, F.lit(gap)))
        return F.when(s.isin(words), F.element_at(known, s)).otherwise(F.repeat(F.lit("~"), unknown))

    def of(x: Column) -> Column:
        lines = F.transform(F.transform(F.split(x["raw"], "\n"), normalised), mark)
        return F.when(x["whole"].isin(words) | ~x["raw"].contains("\n"), mark(x["whole"])).otherwise(F.array_join(lines, ""))

    bare = F.regexp_replace(F.coalesce(text, F.lit("")), LEADER, "$1")
    parts = F.transform(F.split(bare, STRETCH), lambda s: F.struct(s.alias("raw"), normalised(s).alias("whole")))
    found = F.array_join(F.transform(parts, of), "")
    for several, one in wholes:
        found = F.replace(found, F.lit(several), F.lit(one))
    return F.replace(F.regexp_replace(F.regexp_replace(found, r"\{[0-9]+\}", ""), f"~{{{gap},}}", "|"), F.lit("~"), F.lit(""))


def scan(docs: DataFrame, sentences: dict[str, str] = SENTENCES, rules: list[tuple[str, tuple[str, ...]]] = RULES, gap: int = GAP) -> DataFrame:
    """``docs`` with ``sentence_ids``, ``licences`` (in order of place) and ``unmatched`` (identifiers no rule used)."""
    given = [F.col(f"`{c}`") for c in docs.columns if c.lower() not in ("sentence_ids", "licences", "unmatched")]
    found = docs.select(*given, sequence(F.col("text"), sentences, gap).alias("sentence_ids"))
    rewritten = marks = F.col("sentence_ids")
    for licence, ids in rules:
        rewritten = F.replace(rewritten, F.lit("".join(f"[{i}]" for i in ids)), F.lit(f"<{licence}>"))

    def all_of(where: Column, pattern: str) -> Column:
        return F.when(marks.contains("["), F.regexp_extract_all(where, F.lit(pattern), 1)).otherwise(F.array().cast("array<string>"))

    return found.select(*given, all_of(marks, r"\[([^\]]+)\]").alias("sentence_ids"), all_of(rewritten, "<([^>]*)>").alias("licences"),
                        all_of(rewritten, r"\[([^\]]+)\]").alias("unmatched"))
