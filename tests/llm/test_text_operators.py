"""License scan, URL filter, SimHash, repeats, decontamination against brute force, planted cases and odd rows."""

import random
import re
import time
from collections import defaultdict

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F
from xxhash import xxh64_intdigest

from parlance.llm import decontamination, license_scan, simhash, suffix_dedup, url_filter
from parlance.llm.common import components, split_on_space, word_hashes
from tests.llm.conftest import DOCS, words
from tests.oracle_check import compare, duck


def test_sql_queries(spark, mid):
    from parlance.llm.oracle import ORACLE
    from parlance.llm.queries import QUERIES
    con = duck(mid)
    assert all(compare(spark, con, n, QUERIES[n], sql, mid) for n, sql in ORACLE.items())


# --- licences ------------------------------------------------------------------------------------

def _scanned(spark, texts):
    rows = license_scan.scan(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")).orderBy("doc_id").collect()
    return [(r["licences"], r["unmatched"]) for r in rows]


def test_licence_rules_are_ordered_and_use_up_sentences(spark):
    grant, notice, as_is, liable = [k for k, v in license_scan.SENTENCES.items() if v in ("MITGrant", "MITNotice", "MITAsIs", "MITLiability")]
    full = f"MIT License\n\nCopyright (c) 2020 Someone\n\n{grant}:\n\n{notice}.\n\n{as_is.upper()}. {liable}."
    got = _scanned(spark, [full, f"{grant}.\n{notice}.", "x\nReleased under the MIT License.\ny", f"{notice}.", "Licensed under CC BY-NC 4.0. All rights reserved.",
                           "Unless required by\napplicable law nothing.\nThis work is licensed under\nthe GNU General Public License, version 3.", None, ""])
    assert got[0] == (["MIT"], ["MITTitle"]) or got[0] == (["MIT"], [])
    assert got[1][0] == ["MIT-no-warranty-text"]
    assert got[2] == (["MIT"], [])
    assert got[3] == ([], ["MITNotice"])
    assert got[4][0] == ["CC-BY-NC-4.0", "All-rights-reserved"]
    assert got[5][0] == ["GPL-3.0-only"]
    assert got[6] == got[7] == ([], [])


# Official notices, as their licences ask to be put into files.
_GNU = """{program} - does something
Copyright (C) 2021  Some One

This {what} is free software{a} you can redistribute it and/or modify
it under the terms of the {name} as published by
the Free Software Foundation{b} either version {version} of the License, or
(at your option) any later version.

This {what} is distributed in the hope that it will be useful,
but WITHOUT ANY WARRANTY; without even the implied warranty of
MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE.  See the
{name} for more details.

You should have received a copy of the {name}
along with this {what}.  If not, see <https://www.gnu.org/licenses/>.
"""
_WARRANTY = """THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR
IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY,
FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE
AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER
LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM,
OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE
SOFTWARE.
"""
_BSD = """Copyright (c) 2021, Some One

Redistribution and use in source and binary forms, with or without
modification, are permitted provided that the following conditions are met:

1. Redistributions of source code must retain the above copyright notice, this
   list of conditions and the following disclaimer.

2. Redistributions in binary form must reproduce the above copyright notice,
   this list of conditions and the following disclaimer in the documentation
   and/or other materials provided with the distribution.
"""
NOTICES = {
    "Apache-2.0": """Copyright 2021 Some One

Licensed under the Apache License, Version 2.0 (the "License");
you may not use this file except in compliance with the License.
You may obtain a copy of the License at

    http://www.apache.org/licenses/LICENSE-2.0

Unless required by applicable law or agreed to in writing, software
distributed under the License is distributed on an "AS IS" BASIS,
WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied.
See the License for the specific language governing permissions and
limitations under the License.
""",
    "MIT": """MIT License

Copyright (c) 2021 Some One

Permission is hereby granted, free of charge, to any person obtaining a copy
of this software and associated documentation files (the "Software"), to deal
in the Software without restriction, including without limitation the rights
to use, copy, modify, merge, publish, distribute, sublicense, and/or sell
copies of the Software, and to permit persons to whom the Software is
furnished to do so, subject to the following conditions:

The above copyright notice and this permission notice shall be included in all
copies or substantial portions of the Software.

""" + _WARRANTY,
    "BSD-2-Clause": _BSD,
    "BSD-3-Clause": _BSD + """
3. Neither the name of the copyright holder nor the names of its
   contributors may be used to endorse or promote products derived from
   this software without specific prior written permission.
""",
    "ISC": """Copyright (c) 2021 Some One

Permission to use, copy, modify, and/or distribute this software for any
purpose with or without fee is hereby granted, provided that the above
copyright notice and this permission notice appear in all copies.
""",
    "MPL-2.0": """This Source Code Form is subject to the terms of the Mozilla Public
License, v. 2.0. If a copy of the MPL was not distributed with this
file, You can obtain one at https://mozilla.org/MPL/2.0/.
""",
    "GPL-3.0-or-later": _GNU.format(program="Foo", what="program", a=":", b=",", name="GNU General Public License", version="3"),
    "GPL-2.0-or-later": _GNU.format(program="Foo", what="program", a=";", b=";", name="GNU General Public License", version="2"),
    "LGPL-2.1-or-later": _GNU.format(program="Foo", what="library", a=";", b=";", name="GNU Lesser General Public License", version="2.1"),
    "LGPL-3.0-or-later": _GNU.format(program="Foo", what="library", a=":", b=",", name="GNU Lesser General Public License", version="3"),
    "AGPL-3.0-or-later": _GNU.format(program="Foo", what="program", a=":", b=",", name="GNU Affero General Public License", version="3"),
    "CC-BY-4.0": "This work is licensed under a Creative Commons Attribution 4.0 International License.\n",
    "Unlicense": "This is free and unencumbered software released into the public domain.\n",
}


def test_licences_of_official_notices_plain_and_in_comments(spark):
    def comment(text, first, lead, last):
        return first + "".join(f"{lead}{' ' if line else ''}{line}\n" for line in text.splitlines()) + last

    forms = [("", "", ""), ("", "#", ""), ("", "//", ""), ("/*\n", " *", " */\n"), ("", ";;", ""), ("", "--", "")]
    cases = [(name, comment(text, *form) + "int main() { return 0; }\n") for name, text in NOTICES.items() for form in forms]
    cases += [(name, text.replace("\n", "\r\n")) for name, text in NOTICES.items()]
    cases += [(name, f"{lead} SPDX-License-Identifier: {name}\n{lead} Copyright 2021 Some One\n") for name in license_scan.SPDX for lead in ("#", "//", " *")]
    got = _scanned(spark, [text for _, text in cases])
    assert [(name, text, g) for (name, text), g in zip(cases, got) if g[0] != [name]] == []


def test_licence_sequences_end_at_a_gap(spark):
    grant, rest = NOTICES["MIT"].split("The above copyright", 1)
    far = grant + "\n" + "word " * license_scan.GAP + "\n\nThe above copyright" + rest
    near = grant + "\n" + "word " * (license_scan.GAP - 1) + "\n\nThe above copyright" + rest
    pieces_apart = "This program is free software:\n\nwith a remark.\n\nyou can redistribute it and/or modify it under the terms of the GNU General Public " \
        "License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version.\n"
    got = _scanned(spark, [near, far, pieces_apart, "mit\n", "# SPDX-License-Identifier: Nobody-1.0\n"])
    assert got[0][0] == ["MIT"] and got[1][0] == []
    assert got[1][1] == ["MITTitle", "MITGrant", "MITNotice", "MITAsIs", "MITLiability"]
    assert got[2] == got[3] == got[4] == ([], [])


def test_licence_rules_can_all_be_met(spark):
    """Each rule is met by its own wordings, one after another, unless an earlier rule takes them."""
    wording = {}
    for w, i in license_scan.SENTENCES.items():
        wording.setdefault(i, w)
    texts = ["".join(f"{wording[i]}.\n" for i in ids) for _, ids in license_scan.RULES]
    got = _scanned(spark, texts)
    assert [(rule, g) for (rule, _), g in zip(license_scan.RULES, got) if g != ([rule], [])] == []


def test_licence_very_long_text(spark):
    filler = "plain words of a long text and so on\n" * 100_000
    assert _scanned(spark, [filler + NOTICES["GPL-3.0-or-later"] + filler])[0][0] == ["GPL-3.0-or-later"]


def test_licence_odd_rows(spark, odd_docs, no_docs):
    assert license_scan.scan(odd_docs).count() == odd_docs.count()
    assert license_scan.scan(no_docs).count() == 0


# --- URLs ----------------------------------------------------------------------------------------

def test_url_rules(spark):
    rules = spark.createDataFrame([("net", "/", "block"), ("example.net", "/en/", "allow"), ("b.org", "/x", "block"), ("b.org", "/x", "allow")], "host string, path string, verdict string")
    urls = ["http://a.net", "http://a.net/", "HTTP://WWW.Example.NET/en/1?q", "http://example.net/en", "http://c.b.org/xyz#f", "http://b.org/y", None, "nothing", "http://", "http://x.net?a/", "", "s://q.net/a\nb"]
    pages = spark.createDataFrame([(i, u, "h", "r") for i, u in enumerate(urls)] + [(None, "http://a.net/", "h", "r")], "page_id long, url string, host string, rule string")
    got = {r["page_id"]: (r["host"], r["path"], r["rule"], r["verdict"]) for r in url_filter.judge(pages, rules).collect()}
    assert got[0] == ("a.net", "", None, "allow") and got[1] == ("a.net", "/", "net/", "block")
    assert got[2] == ("www.example.net", "/en/1", "example.net/en/", "allow") and got[3] == ("example.net", "/en", "net/", "block")
    assert got[4] == ("c.b.org", "/xyz", "b.org/x", "block") and got[5] == ("b.org", "/y", None, "allow")
    assert got[6] == got[7] == got[8] == got[10] == ("", "", None, "allow") and got[9] == ("x.net", "", None, "allow")
    assert got[11] == ("q.net", "/a\nb", "net/", "block") and got[None] == ("a.net", "/", "net/", "block")
    assert url_filter.judge(pages.limit(0), rules).count() == 0


def _judged(url, rules):
    head, sep, rest = (url or "").partition("://")
    rest = re.match(r"([^/?#]*)([^?#]*)", rest if sep else "")
    host, path = "".join(c.lower() if c.isascii() else c for c in rest[1]), rest[2]
    hits = [(len(h + p), len(h), v == "block", h + p, v) for h, p, v in rules
            if (host == h or host.endswith("." + h)) and path.startswith(p)]
    return (host, path, max(hits)[3], max(hits)[4]) if hits else (host, path, None, "allow")


def test_url_verdicts_equal_plain_matching_with_either_join(spark):
    rng = random.Random(5)
    labels, parts = ["a", "b", "com", "net", ""], ["", "x", "xy", "en"]

    def some(pool, sep, least, most):
        return sep.join(rng.choice(pool) for _ in range(rng.randint(least, most)))

    rules = sorted({(some(labels[:4], ".", 1, 3), rng.choice(["/", ""]) + some(parts, "/", 0, 3)) for _ in range(60)})
    rules = [(h, p, rng.choice(["block", "allow"])) for h, p in rules]
    urls = [f"{rng.choice(['http', 'HTTP', ''])}://{some(labels, '.', 0, 5)}{rng.choice(['', '/'])}{some(parts, '/', 0, 5)}{rng.choice(['', '?q/x', '#f'])}" for _ in range(600)]
    pages = spark.createDataFrame(list(enumerate(urls)), "page_id long, url string")
    table = spark.createDataFrame(rules + [(None, "/", "block"), ("a", None, "block")], "host string, path string, verdict string")
    want = {i: _judged(u, rules) for i, u in enumerate(urls)}
    for size in (url_filter.BROADCAST_BYTES, -1):
        got = url_filter.judge(pages, table, broadcast_bytes=size).collect()
        assert len(got) == len(urls) and {r["page_id"]: (r["host"], r["path"], r["rule"], r["verdict"]) for r in got} == want
    assert {r["verdict"] for r in url_filter.judge(pages, table.limit(0)).collect()} == {"allow"}


def test_very_long_urls_take_time_linear_in_their_length(spark):
    import time
    rules = spark.createDataFrame([("net", "/", "block"), ("example.net", "/en/", "allow"), ("b.org", "/x", "block")], "host string, path string, verdict string")
    urls = ["http://example.net/en/" + "a/" * 500_000, "http://" + "a." * 500_000 + "net/" + "b/" * 100_000, "http://b.org/" + "y/" * 300_000, "http://" + "x/" * 50_000]
    pages = spark.createDataFrame(list(enumerate(urls)), "page_id long, url string")
    url_filter.judge(pages.filter("page_id = 3"), rules).collect()
    begun = time.monotonic()
    got = {r["page_id"]: r["verdict"] for r in url_filter.judge(pages, rules).select("page_id", "verdict").collect()}
    assert got == {0: "allow", 1: "block", 2: "allow", 3: "allow"} and time.monotonic() - begun < 20


# --- SimHash -------------------------------------------------------------------------------------

def _print(text, k=3):
    ws = [w for w in (text or "").encode().lower().split()]
    sh = [b" ".join(ws[i:i + k]) for i in range(len(ws) - k + 1)] or ([b" ".join(ws)] if ws else [])
    hs = [xxh64_intdigest(s, 42) for s in sh]
    return sum((2 * sum(h >> b & 1 for h in hs) > len(hs)) << b for b in range(64)) if hs else 0


def _groups(ids, prints, bits):
    parent = list(range(len(ids)))

    def find(i):
        while parent[i] != i:
            i = parent[i]
        return i
    for i in range(len(ids)):
        for j in range(i):
            if bin(prints[i] ^ prints[j]).count("1") <= bits:
                parent[find(i)] = find(j)
    out = defaultdict(list)
    for i in range(len(ids)):
        out[find(i)].append(ids[i])
    return sorted((i, min(x for x in g if x is not None)) for g in out.values() for i in g if i is not None)


def test_simhash_against_all_pairs(spark, mid):
    docs = spark.read.parquet(f"{mid}/documents.parquet")
    rows = docs.select("doc_id", "text").collect()
    got = simhash.near_duplicates(docs).collect()
    prints = {r["doc_id"]: _print(r["text"]) for r in rows}
    assert {r["doc_id"]: r["fingerprint"] for r in got} == {i: f"{p:016x}" for i, p in prints.items()}
    ids = [r["doc_id"] for r in rows]
    assert sorted((r["doc_id"], r["component_id"]) for r in got) == _groups(ids, [prints[i] for i in ids], 2)


@pytest.mark.parametrize("limit", [128, 4])
def test_simhash_links_dense_cells(spark, limit):
    """Fingerprints around a few centres: the bounded cells and the way for full cells give the same components."""
    rng = random.Random(5)
    centres = [rng.getrandbits(64) for _ in range(4)]
    prints = {c ^ (1 << rng.randrange(64)) ^ (1 << rng.randrange(64)) for c in centres for _ in range(60)} | {0, 1, 3, 2 ** 64 - 1}
    signed = [p - 2 ** 64 if p >= 2 ** 63 else p for p in prints]
    fps = spark.createDataFrame([(p,) for p in signed], "fp long")
    roots = {r["node"]: r["root"] for r in components(simhash.links(fps, 2, limit)).collect()}
    got = sorted((p, roots.get(p, p)) for p in signed)
    mask = 2 ** 64 - 1
    assert got == _groups(signed, [p & mask for p in signed], 2)


def test_simhash_odd_rows(spark, odd_docs, no_docs):
    got = simhash.near_duplicates(odd_docs).collect()
    assert len(got) == odd_docs.count()
    assert {r["component_id"] for r in got if r["fingerprint"] == "0" * 16} == {1}  # empty, null and blank texts
    assert {r["component_id"] for r in got if r["doc_id"] in (3, 4)} == {3}
    assert simhash.near_duplicates(no_docs).count() == 0


def test_components_of_paths_and_stars(spark):
    edges = [(i, i + 1) for i in range(40)] + [(100, i) for i in range(101, 140)] + [(-5, -3), (7, 7)]
    got = {r["node"]: r["root"] for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {i: 0 for i in range(1, 41)} | {i: 100 for i in range(101, 140)} | {-3: -5}


def test_pipeline_keeps_one_document_of_each_group_where_ids_repeat(spark):
    """One id with two different texts, one of which is a near copy of a smaller id: the near copy goes, all else stays."""
    import corpus_pipeline
    rng = random.Random(6)
    a, b, c, d = (words(rng, 200) for _ in range(4))
    docs = spark.createDataFrame([(1, a), (2, a), (2, b), (3, c), (3, d), (3, d), (4, d), (None, b)], "doc_id long, text string")
    got = corpus_pipeline.drop_near_duplicates(spark, docs, "")
    assert sorted(tuple(r) for r in got.collect()) == sorted([(1, a), (2, b), (3, c), (3, d)])


# --- repeated passages ---------------------------------------------------------------------------

def _long_repeats(texts, n):
    """(text, word) pairs covered by an n-word passage that an earlier place holds, by brute force."""
    seen, out = {}, set()
    for i, t in enumerate(texts):
        ws = t.split()
        for p in range(len(ws) - n + 1):
            key = tuple(ws[p:p + n])
            if key in seen:
                out |= {(i, q) for q in range(p, p + n)}
            seen.setdefault(key, (i, p))
    return out


def test_repeats_against_brute_force(spark):
    rng = random.Random(11)
    passages = [words(rng, k) for k in (50, 51, 60, 75, 140, 400)]
    texts = [words(rng, 300)]
    for _ in range(60):
        parts = [words(rng, rng.randrange(5, 120))]
        for p in rng.sample(passages, rng.randrange(0, 3)):
            parts += [p, words(rng, rng.randrange(1, 80))]
        texts.append(" ".join(parts))
    short = words(rng, 49)
    texts += [f"a {short} b", f"c {short} d", f"e {passages[3]} f {words(rng, 60)} {passages[3]} g"]
    docs = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "doc_id long, text string")
    got = {(r["doc_id"], q) for r in suffix_dedup.report(docs).collect() for q in range(r["begin"], r["finish"])}
    assert got == _long_repeats(texts, 50)


def test_cut_keeps_the_first_copy_and_the_other_text(spark, odd_docs, no_docs):
    rng = random.Random(12)
    p, a, b = words(rng, 70), words(rng, 30), words(rng, 30)
    docs = spark.createDataFrame([(2, f"{a}  {p}\n{b}", "en", "s", 1), (1, f"{p} {a[:50]}", "en", "s", 1), (3, p, "en", "s", 1), (4, None, None, None, None)], DOCS)
    got = {r["doc_id"]: r for r in suffix_dedup.cut(docs).collect()}
    assert got[1]["text"].startswith(p) and got[2]["text"] == f"{a}  {b}" and got[2]["n_chars"] == len(f"{a}  {b}")
    assert 3 not in got and got[4]["text"] is None
    out = suffix_dedup.cut(odd_docs)
    assert out.columns == odd_docs.columns and out.count() == odd_docs.count()
    assert suffix_dedup.cut(no_docs).count() == 0 and suffix_dedup.report(no_docs).count() == 0


def test_a_hot_passage_over_many_partitions(spark):
    """A passage in most texts: sorted neighbours lie in many partitions, one copy stays."""
    rng = random.Random(13)
    p = words(rng, 55)
    docs = spark.createDataFrame([(i, f"{words(rng, 8)} {p} {words(rng, 8)}") for i in range(400)], "doc_id long, text string")
    got = {r["doc_id"] for r in suffix_dedup.report(docs).collect()}
    assert got == set(range(1, 400))


@pytest.mark.parametrize("block", [50_000, 40])
def test_frequent_phrases_under_different_lead_ins(spark, monkeypatch, block):
    """A phrase under 50 words in many texts, with lead-ins that make up 50 words with it and only two texts share."""
    monkeypatch.setattr(suffix_dedup, "BLOCK", block)
    rng = random.Random(14)
    texts = []
    for lead, size in ((10, 40), (15, 35), (28, 22), (30, 45)):
        phrase = words(rng, size)
        heads = [words(rng, lead) for _ in range(60)]
        texts += [f"{words(rng, 40)} {heads[i % 60] if i < 120 else words(rng, lead)} {phrase} {words(rng, 40)}" for i in range(200)]
    unit = words(rng, 7)
    texts += [" ".join([unit] * 30), f"{words(rng, 9)} {' '.join([unit] * 20)}"]
    rng.shuffle(texts)
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {(r["doc_id"], q) for r in suffix_dedup.report(docs).collect() for q in range(r["begin"], r["finish"])}
    assert got == {(i, q) for i, b, f, _, _ in _passages(dict(enumerate(texts)), 50) for q in range(b, f)}


def _passages(texts, n):
    """(id, begin, finish, kept_id, kept_begin) by brute force over ``texts`` (id: text), by the definition in the module's docstring."""
    first, seen, out = {}, {}, set()
    for i in sorted(texts):
        ws = texts[i].split()
        if (same := first.setdefault(texts[i], i)) != i:
            if len(ws) >= n:
                out.add((i, 0, len(ws), same, 0))
            continue
        now = None
        for p in range(len(ws) - n + 1):
            j, q = seen.setdefault(tuple(ws[p:p + n]), (i, p))
            if j == i and p - q < n:
                continue
            if now and p <= now[1]:
                now[1] = p + n
            else:
                out |= {(i, *now)} if now else set()
                now = [p, p + n, j, q]
        out |= {(i, *now)} if now else set()
    return out


def _merged(spans):
    """Spans by text, merged one by one."""
    out = []
    for key, begin, finish, *kept in sorted(spans, key=lambda s: (s[0], s[1], *s[3:])):
        if out and out[-1][0] == key and begin <= out[-1][2]:
            out[-1][2] = max(out[-1][2], finish)
        else:
            out.append([key, begin, finish, *kept])
    return out


@pytest.mark.parametrize("size", [1, 3, 10_000])
def test_spans_merge_as_they_go_by(size):
    """A text's spans need not fit a batch, and repeated ones change nothing."""
    rng = random.Random(16)
    spans = []
    for key in (bytes([k] * 15) + b"\0" for k in (0, 1, 9, 200)):
        for _ in range(rng.choice([1, 400])):
            begin = rng.randrange(9_000)
            spans += [(key, begin, begin + rng.randrange(50, 70), rng.randrange(4), bytes([rng.randrange(3)] * 16), rng.randrange(3))] * rng.choice([1, 1, 2])
    spans.append((b"z" * 16, 0, 2 ** 31 - 1, 2 ** 63 - 1, b"z" * 16, 0))
    names = ["text_key", "begin", "finish", "kept_id", "kept_key", "kept_begin"]
    rows = sorted(spans, key=lambda s: (s[0], s[1], *s[3:]))
    types = (pa.binary(), pa.int32(), pa.int32(), pa.int64(), pa.binary(), pa.int32())
    batches = [pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows[i:i + size]), types)], names) for i in range(0, len(rows), size)]
    got = [list(r.values()) for b in suffix_dedup._merge(iter([batches[0].slice(0, 0), *batches])) for r in b.to_pylist()]
    assert got == _merged(spans)
    assert list(suffix_dedup._merge(iter([]))) == []


def test_words_are_hashed_from_the_bytes():
    """One number a word, wherever it stands; the words are those between ASCII white space, also in slices with null and empty texts."""
    texts = ["", None, " a", "b ", "a\x0b\x0ca\x1c b\x85c\xa0d", "\u00e9\u3000x y\u00e9a ", "a\0", "abcdefgh abcdefghi abcdefgh\0", " ", "i" * 40, "b", ""]
    for lo, hi in ((0, 12), (1, 12), (3, 9), (0, 2), (1, 2), (5, 5), (0, 0)):
        tokens, offsets = suffix_dedup.hashed_words(*suffix_dedup._buffers(pa.array(texts, pa.string()).slice(lo, hi - lo)))
        lists = [re.findall(r"[^ \t\n\r\x0b\x0c]+", t or "") for t in texts[lo:hi]]
        flat = [w for ws in lists for w in ws]
        assert offsets.tolist() == [sum(map(len, lists[:i])) for i in range(hi - lo + 1)]
        assert len(tokens) == len(flat) and len(set(zip(flat, tokens.tolist()))) == len(set(flat)) == len(set(tokens.tolist()))


def test_words_cost_less_than_half_of_hashing_strings():
    """No word becomes a string: cutting and hashing a text took most of the operator's time."""
    rng = random.Random(17)
    texts = pa.array([" ".join("".join(rng.choices("abcdefghij", k=rng.randrange(2, 12))) for _ in range(400)) for _ in range(256)])

    def strings():
        split, codes, _ = split_on_space(texts)
        return word_hashes(split)[codes]

    def seconds(run):
        begin = time.process_time()
        run()
        return time.process_time() - begin

    plain = min(seconds(strings) for _ in range(5))
    assert min(seconds(lambda: suffix_dedup.hashed_words(*suffix_dedup._buffers(texts))) for _ in range(5)) < plain / 2


def test_selected_places_are_the_first_least_of_their_neighbours():
    rng = random.Random(18)
    sizes = [0, 5, 38, 39, 200, 37, 1, 120]
    tokens = suffix_dedup.scrambled(np.array([rng.randrange(40) for _ in range(sum(sizes))], np.uint64) // np.uint64(20))  # many equal grams
    offsets = np.cumsum([0, *sizes])
    want = set()
    for lo, hi in zip(offsets, offsets[1:]):
        grams = suffix_dedup.hashed_at(tokens, np.arange(lo, max(lo, hi - 7)), list(range(8)), 99).tolist()
        want |= {lo + min(range(i, i + 31), key=lambda k: grams[k]) for i in range(len(grams) - 30)}
    assert suffix_dedup.selected(tokens, offsets).tolist() == sorted(want)


@pytest.mark.parametrize("chunk", [1, 700, 1 << 20])
def test_contexts_stay_within_their_text(spark, monkeypatch, chunk):
    """Words to the right and left of a place, however many texts are taken at a time; zero beyond the text."""
    monkeypatch.setattr(suffix_dedup, "CHUNK", chunk)
    rng = random.Random(19)
    texts = [words(rng, k) for k in (20, 90, 1, 150, 60)]
    rows = [(i, bytes([i] * 16), t, sorted(rng.sample(range(len(t.split())), min(len(t.split()), 12)))) for i, t in enumerate(texts)]
    made = suffix_dedup.contexts(spark.createDataFrame(rows, "doc_id long, text_key binary, text string, places array<int>").coalesce(1)).collect()
    assert sorted((r["doc_id"], bytes(r["text_key"]), r["at"]) for r in made) == [(i, k, p) for i, k, _, at in rows for p in at]

    def number(word):
        return max(int(suffix_dedup.hashed_words(*suffix_dedup._buffers(pa.array([word])))[0][0] >> np.uint64(32)), 1)

    for r in made:
        ws = [number(w) for w in texts[r["doc_id"]].split()]
        right, left = ws[r["at"]:][:suffix_dedup.RIGHT], ws[:r["at"]][::-1][:suffix_dedup.LEFT]
        assert np.frombuffer(r["right"], ">u4").tolist() == right + [0] * (suffix_dedup.RIGHT - len(right))
        assert np.frombuffer(r["left"], ">u4").tolist() == left + [0] * (suffix_dedup.LEFT - len(left))


def test_no_spans_are_gathered_by_text_to_be_merged(spark, odd_docs):
    """The merge reads sorted rows; no list of a text's spans is made for it."""
    assert "collect_set(struct(begin" not in suffix_dedup.repeats(odd_docs)._jdf.queryExecution().optimizedPlan().toString()


@pytest.mark.parametrize("block, parts", [(50_000, 1), (50_000, 64), (40, 4), (7, 16)])
def test_one_result_at_any_number_of_blocks(spark, mid, monkeypatch, block, parts):
    """Passages and the places where they stay equal brute force, however the sorted suffixes are cut up; also in texts that repeat themselves."""
    monkeypatch.setattr(suffix_dedup, "BLOCK", block)
    rng = random.Random(15)
    texts = {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{mid}/documents.parquet").select("doc_id", "text").collect()}
    phrase, top = words(rng, 35), max(texts)
    for k, unit in enumerate(words(rng, size) for size in (1, 3, 7, 23, 49, 50, 51, 90)):
        texts[top + 2 * k + 1] = f"{words(rng, 10 * k)} {' '.join([unit] * 40)} {words(rng, 60)}"
        texts[top + 2 * k + 2] = f"{words(rng, 12)} {' '.join([unit] * 25)} {phrase} {' '.join([unit] * 9)}"
    spark.conf.set("spark.sql.shuffle.partitions", str(parts))
    try:
        docs = spark.createDataFrame(list(texts.items()), "doc_id long, text string")
        got = {tuple(r) for r in suffix_dedup.report(docs).collect()}
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", "8")
    assert got == _passages({i: t or "" for i, t in texts.items()}, 50)


# --- decontamination -----------------------------------------------------------------------------

def test_leaks_with_substitutions(spark, odd_docs, no_docs):
    rng = random.Random(21)
    items = [words(rng, n).split() for n in (14, 30, 59, 9, 5)]

    def noisy(ws, every):
        return [f"zz{rng.random()}".replace(".", "") if i % every == every - 2 else w for i, w in enumerate(ws)]

    clean = [words(rng, 200) for _ in range(20)]
    leaked = [f"{words(rng, 40)} {' '.join(part)} {words(rng, 40)}" for part in
              (items[0], items[1], items[2], noisy(items[1], 6), noisy(items[2], 7), items[2][20:40], items[3], [w.upper() + "," for w in items[1]])]
    kept = [f"{words(rng, 40)} {' '.join(part)} {words(rng, 40)}" for part in (items[2][:10], noisy(items[1], 3), items[4])]
    docs = spark.createDataFrame([(i, t) for i, t in enumerate(clean + leaked + kept)], "doc_id long, text string")
    bench = spark.createDataFrame([(str(i), " ".join(w)) for i, w in enumerate(items)] + [(None, None), ("e", "")], "item_id string, text string")
    found = decontamination.find(docs, bench).collect()
    assert {r["doc_id"] for r in found} == set(range(20, 28))
    exact = next(r for r in found if r["doc_id"] == 20)
    assert (exact["item_id"], exact["start"], exact["item_start"], exact["length"], exact["matches"]) == ("0", 40, 0, 14, 14)
    assert {r["doc_id"] for r in decontamination.clean(docs, bench).collect()} == set(range(20)) | {28, 29, 30}
    out = decontamination.clean(odd_docs, bench)
    assert out.columns == odd_docs.columns and out.count() == odd_docs.count()
    assert decontamination.find(no_docs, bench).count() == 0 and decontamination.clean(docs, bench.limit(0)).count() == docs.count()


def test_masks_meet_every_accepted_overlap():
    from itertools import combinations
    for n, differ in ((13, 2), (15, 3), (20, 4), (25, 5), *[(n, n // 5) for n in range(1, 13)]):
        masks = [m for m in decontamination.MASKS if len(m) <= n] if n >= 13 else decontamination.own_masks(n)
        placed = [sum(1 << o + i for i, c in enumerate(m) if c == "1") for m in masks for o in range(n - len(m) + 1)]
        spots = range(n) if n >= 13 else range(1, n - 1)
        for c in combinations(spots, differ):
            assert any(not p & sum(1 << i for i in c) for p in placed), (n, c)


def test_short_items_with_every_substitution(spark):
    from itertools import combinations
    rng = random.Random(22)
    items = {n: words(rng, n).split() for n in (1, 3, 5, 8, 9, 10, 11, 13)}
    texts = [" ".join([words(rng, 30, 900), *["zz" if i in c else w for i, w in enumerate(ws)], words(rng, 30, 900)])
             for n, ws in items.items() for c in combinations(range(1, n - 1), n // 5)]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    bench = spark.createDataFrame([(str(n), " ".join(ws)) for n, ws in items.items()], "item_id string, text string")
    assert {r["doc_id"] for r in decontamination.find(docs, bench, shortest=1).collect()} == set(range(len(texts)))


def test_clean_with_templates_of_many_items(spark):
    """A whole template in texts and items; a template too short to count, where an overlap is with one of its many items only."""
    rng = random.Random(23)
    long, short = words(rng, 14), words(rng, 8)
    tails = [words(rng, 20) for _ in range(60)]
    bench = spark.createDataFrame([(str(i), f"{(long, short)[i % 2]} {t}") for i, t in enumerate(tails)], "item_id string, text string")
    texts = [f"{words(rng, 30)} {long} {words(rng, 30)}" for _ in range(200)] + [f"{words(rng, 30)} {short} {words(rng, 30)}" for _ in range(200)]
    texts += [f"{words(rng, 30)} {short} {t} {words(rng, 30)}" for t in tails[1::2]]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    kept = {r["doc_id"] for r in decontamination.clean(docs, bench).collect()}
    assert kept == set(range(200, 400)) == set(range(len(texts))) - {r["doc_id"] for r in decontamination.find(docs, bench).select("doc_id").distinct().collect()}


def test_a_long_overlap_is_one_span(spark):
    rng = random.Random(23)
    item = words(rng, 1500).split()
    copy = ["zz" if i % 9 == 4 else w for i, w in enumerate(item)]
    docs = spark.createDataFrame([(1, f"{words(rng, 40, 900)} {' '.join(copy)} {words(rng, 40, 900)}")], "doc_id long, text string")
    bench = spark.createDataFrame([("long", " ".join(item))], "item_id string, text string")
    got = [tuple(r)[2:] for r in decontamination.find(docs, bench).collect()]
    assert got == [("long", 40, 0, 1500, 1500 - copy.count("zz"))]


def test_longest_stretch():
    rng = np.random.default_rng(1)
    for _ in range(300):
        same = rng.random(rng.integers(1, 40)) < 0.75
        best = max((j - i for i in range(len(same)) for j in range(i + 1, len(same) + 1)
                    if same[i] and same[j - 1] and same[i:j].mean() >= 0.8 - 1e-9), default=0)
        assert decontamination.longest(same, 0.8)[1] == best


def test_benchmark_items_in_the_table_are_found(spark, mid):
    docs, items = spark.read.parquet(f"{mid}/documents.parquet"), spark.read.parquet(f"{mid}/benchmark.parquet")
    def norm(c):
        return F.trim(F.regexp_replace(F.lower(c), r"[^\p{L}\p{N}]+", " "))
    held = docs.select("doc_id", norm("text").alias("t")).join(items.select("item_id", norm("text").alias("b")), F.col("t").contains(F.col("b"))).select("doc_id").distinct()
    want = {r[0] for r in held.collect()}
    assert want and want <= {r["doc_id"] for r in decontamination.find(docs, items).collect()}
