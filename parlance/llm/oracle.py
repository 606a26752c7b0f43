"""DuckDB SQL for the queries that SQL can express.  The others are tested against brute force."""

from __future__ import annotations

from parlance.llm.license_scan import GAP, RULES, SENTENCES, pieces


def _lit(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


def _license() -> str:
    marks, wholes = pieces(SENTENCES)
    known = "map {" + ", ".join(f"{_lit(k)}: {_lit(v)}" for k, v in marks.items()) + "}"
    norm = "trim(lower(regexp_replace({}, '[^A-Za-z0-9]+', ' ', 'g')))"
    ids = "string_agg(mark, '' ORDER BY i, j)"
    for several, one in wholes:
        ids = f"replace({ids}, {_lit(several)}, {_lit(one)})"
    rewritten = "ids"
    for licence, names in RULES:
        rewritten = f"replace({rewritten}, {_lit(''.join(f'[{i}]' for i in names))}, {_lit(f'<{licence}>')})"
    cut = "string_split_regex(d.text, '[.!?;:][ \\t]*\\r?\\n|[.!?;:][ \\t]+|\\r?\\n[^A-Za-z0-9\\n]*\\n')"
    return f"""
WITH known AS (SELECT {known} AS m),
stretches AS (
  SELECT d.rid, s.part, s.i
  FROM (SELECT row_number() OVER () AS rid, regexp_replace(coalesce(text, ''), '(^|\\n)[ \\t]*;+', '\\1', 'g') AS text FROM documents) d,
       LATERAL (SELECT unnest({cut}) AS part, generate_subscripts({cut}, 1) AS i) s),
lines AS (
  SELECT rid, i, 0 AS j, {norm.format('part')} AS s FROM stretches, known WHERE map_contains(m, {norm.format('part')}) OR NOT contains(part, chr(10))
  UNION ALL
  SELECT rid, i, generate_subscripts(string_split(part, chr(10)), 1) AS j, {norm.format("unnest(string_split(part, chr(10)))")} AS s
  FROM stretches, known WHERE contains(part, chr(10)) AND NOT map_contains(m, {norm.format('part')})),
marks AS (
  SELECT rid, i, j, CASE WHEN map_contains(m, s) THEN m[s] WHEN s = '' THEN ''
    ELSE repeat('~', least(len(s) - len(replace(s, ' ', '')) + 1, {GAP})) END AS mark FROM lines, known),
joined AS (SELECT rid, {ids} AS ids FROM marks GROUP BY rid),
sequences AS (SELECT rid, replace(regexp_replace(regexp_replace(ids, '\\{{[0-9]+\\}}', '', 'g'), '~{{{GAP},}}', '|', 'g'), '~', '') AS ids FROM joined),
rewritten AS (SELECT rid, ids, {rewritten} AS r FROM sequences)
SELECT d.doc_id, coalesce(array_to_string(regexp_extract_all(ids, '\\[([^\\]]+)\\]', 1), ','), '') AS sentence_ids,
       coalesce(array_to_string(regexp_extract_all(r, '<([^>]*)>', 1), ','), '') AS licences,
       coalesce(array_to_string(regexp_extract_all(r, '\\[([^\\]]+)\\]', 1), ','), '') AS unmatched
FROM (SELECT row_number() OVER () AS rid, doc_id FROM documents) d LEFT JOIN rewritten USING (rid)
"""


URL = r"""
WITH parts AS (
  SELECT page_id, regexp_extract(url, '(?s)^.*?://([^/?#]*)([^?#]*)', ['h', 'p']) AS x FROM pages),
split AS (
  SELECT page_id, translate(coalesce(x.h, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host, coalesce(x.p, '') AS path
  FROM parts)
SELECT page_id, host, path, rule, CASE WHEN rule IN ('net/', 'example.com/de/') THEN 'block' ELSE 'allow' END AS verdict
FROM (
  SELECT *, CASE
    WHEN (host = 'example.net' OR host LIKE '%.example.net') AND starts_with(path, '/en/') THEN 'example.net/en/'
    WHEN (host = 'example.com' OR host LIKE '%.example.com') AND starts_with(path, '/de/') THEN 'example.com/de/'
    WHEN (host = 'org' OR host LIKE '%.org') AND starts_with(path, '/fr/') THEN 'org/fr/'
    WHEN (host = 'net' OR host LIKE '%.net') AND starts_with(path, '/') THEN 'net/' END AS rule
  FROM split)
"""

MIX = r"""
WITH d AS (
  SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS size, md5('7:' || coalesce(doc_id::VARCHAR, '')) AS h
  FROM documents),
s AS (
  SELECT source, sum(size)::BIGINT AS source_size, [5, 2, 1][1 + (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3] AS w
  FROM d GROUP BY source),
-- A source is full while its cap by weight is under the share that a unit of weight gets once all fuller ones are taken out.
filled AS (
  SELECT *, row_number() OVER by_cap AS k, sum(3 * source_size) OVER by_cap AS words, sum(w) OVER by_cap AS weight,
         sum(source_size) OVER () AS total, sum(w) OVER () AS weights
  FROM s WINDOW by_cap AS (ORDER BY 3 * source_size / w, source NULLS LAST ROWS UNBOUNDED PRECEDING)),
level AS (
  SELECT coalesce(min(k), 0) AS k FROM (
    SELECT k - 1 AS k FROM filled WHERE 3 * source_size * (weights - weight + w) >= w * (total - words + 3 * source_size))),
goal AS (
  SELECT f.source, f.source_size, CASE WHEN f.k <= l.k THEN 3.0 * f.source_size
    ELSE ((f.total - coalesce(full_words, 0)) * f.w)::DOUBLE / (f.weights - coalesce(full_weight, 0))::DOUBLE END AS target
  FROM filled f, level l, (SELECT max(words) AS full_words, max(weight) AS full_weight FROM filled, level WHERE filled.k <= level.k)),
line AS (
  SELECT source, h, size, count(*) AS m, sum(sum(size)) OVER (PARTITION BY source ORDER BY h, size) - sum(size) AS before
  FROM d GROUP BY source, h, size),
quota AS (SELECT *, round_even(target, 0)::BIGINT AS words FROM goal)
SELECT d.doc_id, d.size, q.source_size, q.target::DOUBLE AS target,
       CASE WHEN d.size = 0 THEN 0 ELSE (q.words // q.source_size * d.size
         + greatest(0, least(q.words % q.source_size - l.before, l.m * l.size)) // l.m)::BIGINT END AS taken
FROM d JOIN quota q ON d.source IS NOT DISTINCT FROM q.source
JOIN line l ON d.source IS NOT DISTINCT FROM l.source AND d.h = l.h AND d.size = l.size
"""


TRIE = r"""
WITH ids AS (
  SELECT DISTINCT conv_id, xor(4294967295, list_reduce(list_prepend(4294967295::BIGINT, list_transform(string_split(conv_id::VARCHAR, ''), lambda x: ascii(x)::BIGINT)),
    lambda c, b: list_reduce(list_prepend(xor(c, b), [0, 0, 0, 0, 0, 0, 0, 0]::BIGINT[]),
      lambda v, z: CASE WHEN v % 2 = 1 THEN xor(v // 2, 3988292384) ELSE v // 2 END))) % 6 AS h
  FROM conversations WHERE conv_id IS NOT NULL),
turns AS (
  SELECT conv_id, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, coalesce(role, ''), coalesce(text, '')) - 1 AS k,
         md5(length(coalesce(role, '')) || ':' || coalesce(role, '') || coalesce(text, '')) AS key, length(coalesce(text, '')) AS size
  FROM conversations WHERE conv_id IS NOT NULL),
whole AS (
  SELECT i.conv_id, t.k, t.key, t.size FROM ids i JOIN turns t ON t.conv_id = i.conv_id - i.conv_id % 100 AND t.k < i.h
  UNION ALL SELECT i.conv_id, t.k, t.key, t.size FROM ids i JOIN turns t ON t.conv_id = i.conv_id AND t.k >= i.h),
paths AS (
  SELECT i.conv_id, coalesce(list(w.key ORDER BY w.k) FILTER (w.k IS NOT NULL), []) AS keys, coalesce(list(w.size ORDER BY w.k) FILTER (w.k IS NOT NULL), []) AS sizes
  FROM ids i LEFT JOIN whole w ON i.conv_id = w.conv_id GROUP BY i.conv_id),
steps AS (SELECT *, unnest(range(0, len(keys) + 1)) AS depth FROM paths),
nodes AS (
  SELECT depth, array_to_string(keys[:depth], '') AS path, min(array_to_string(keys[:greatest(depth - 1, 0)], '')) AS up, min(conv_id) AS conv_id, count(*) AS n_convs,
         (count(*) - 1) * coalesce(min(sizes[depth]), 0) AS saved,
         sha256(coalesce(string_agg(conv_id::VARCHAR, ',' ORDER BY conv_id) FILTER (len(keys) = depth), '')) AS ends_sha256
  FROM steps GROUP BY depth, path),
kids AS (SELECT *, (SELECT count(*) FROM nodes c WHERE c.depth = n.depth + 1 AND c.up = n.path) AS n_children FROM nodes n)
SELECT n.conv_id, n.depth::BIGINT AS depth, p.conv_id AS parent_conv_id, n.n_convs, n.n_children,
       (SELECT count(*) FROM kids u WHERE starts_with(u.path, n.path) AND u.n_children = 0) AS n_leaves,
       (SELECT sum(u.saved) FROM nodes u WHERE starts_with(u.path, n.path))::BIGINT AS saved_tokens, n.ends_sha256
FROM kids n LEFT JOIN nodes p ON n.depth = p.depth + 1 AND n.up = p.path
"""

ORACLE: dict[str, str] = {"op1_license_scan": _license(), "op6_url_filter": URL, "op12_source_mixing": MIX, "op13_conversation_trie": TRIE}
