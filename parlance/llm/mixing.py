"""Mixing sources to target weights, by minimum-cost flow.

1. Every document has a size in words and a set of sources (its membership pattern).  One pass keeps (pattern, size, hash); texts are read once.
2. ``targets``: the sources, in code point order with null last, share the size of all documents by weight; a target stops at ``most``
   times its source's size, and what is over is shared again.
3. ``flow``: a network of patterns and sources (not of documents).  A pattern gives its size up to ``most`` times, each further time at
   a higher cost, so no repetition is bought while a fresh word can fill a quota; words go to any source of the pattern.
4. ``mix``: a pattern's documents stand on a line in the order of a seeded hash, the whole line once for each repetition; each source
   takes its stretch of that line.  Where a stretch ends within a document, the document is split between the two at that word.  The line's places
   are found by sums over 12 and 24 bits of the hash and a running sum among documents that share these, never by a window over a pattern.

The driver holds a number for each distinct pattern and source (not for documents).

Defined results: a null text is an empty one (size 0); null sources are a source, the last one; a null pattern counts as one of a null
source; documents without words take nothing; documents of one id and size share a place on the line, and what they take
is dealt out evenly; an empty table gives no rows.  Other columns are carried if asked for.
"""

from __future__ import annotations

import json
from collections import defaultdict, deque
from collections.abc import Sequence
from fractions import Fraction

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from parlance.llm.common import durable

WORD = r"[^\x20\x09-\x0D]+"
STEPS = (3, 6)  # hex digits of the hash by which the line is searched
TOLD = 50_000  # rows of the driver that are broadcast at most; beyond, they are joined by a shuffle


def targets(sizes: dict[str | None, int], total: int, weights: Sequence[int], most: int = 3) -> dict[str | None, Fraction]:
    """Words that each source is to have of ``total``: shares by weight, none over ``most`` times the source's size."""
    names = sorted(sizes, key=lambda s: (s is None, s or ""))
    weigh = {s: weights[i % len(weights)] for i, s in enumerate(names)}
    out, left = {}, Fraction(total)
    while weigh:
        unit = left / sum(weigh.values())
        full = [s for s in weigh if unit * weigh[s] > most * sizes[s]]
        for s in full or list(weigh):
            out[s] = Fraction(most * sizes[s]) if full else unit * weigh[s]
            left -= out[s]
            del weigh[s]
    return out


def flow(patterns: dict[tuple, int], quota: dict[str | None, int], most: int = 3) -> dict[tuple, dict[str | None, int]]:
    """Words that each source gets of each pattern (a tuple of sources): as many as the quotas take, at the least cost.

    The k-th use of a pattern costs k a word, so costs are convex.  Augmenting paths are found at one cost after another, along breadth-first levels.
    """
    keys = [p for p, size in patterns.items() if size]
    sources = list(quota)
    at = {s: len(keys) + i for i, s in enumerate(sources)}
    first, last = len(keys) + len(sources), len(keys) + len(sources) + 1
    head: list[int] = []
    room: list[int] = []
    cost: list[int] = []
    arcs: list[list[int]] = [[] for _ in range(last + 1)]

    def arc(a: int, b: int, capacity: int, price: int = 0) -> None:
        for tail, to, c, w in ((a, b, capacity, price), (b, a, 0, -price)):
            arcs[tail].append(len(head))
            head.append(to), room.append(c), cost.append(w)

    for i, p in enumerate(keys):
        for k in range(most):
            arc(first, i, patterns[p], k)
        for s in p:
            arc(i, at[s], most * patterns[p])
    for s in sources:
        arc(at[s], last, quota[s])

    def distances() -> list[float]:
        """Cost of the cheapest way to the sink from every node, over arcs with room."""
        far = [float("inf")] * (last + 1)
        far[last], queue, waits = 0, deque([last]), {last}
        while queue:
            v = queue.popleft()
            waits.discard(v)
            for e in arcs[v]:  # its partner leads to v
                u = head[e]
                if room[e ^ 1] and far[v] + cost[e ^ 1] < far[u]:
                    far[u] = far[v] + cost[e ^ 1]
                    if u not in waits:
                        waits.add(u), queue.append(u)
        return far

    while (far := distances())[first] < float("inf"):
        def cheapest(e: int, v: int) -> bool:
            return room[e] > 0 and far[v] == cost[e] + far[head[e]]

        while True:  # all flow of this cost: level by level
            level, queue = {first: 0}, deque([first])
            while queue:
                v = queue.popleft()
                for e in arcs[v]:
                    if cheapest(e, v) and head[e] not in level:
                        level[head[e]] = level[v] + 1
                        queue.append(head[e])
            if last not in level:
                break
            turn, path, v = [0] * (last + 1), [], first
            while True:
                if v == last:
                    amount = min(room[e] for e in path)
                    for e in path:
                        room[e] -= amount
                        room[e ^ 1] += amount
                    path, v = [], first
                    continue
                step = None
                while turn[v] < len(arcs[v]):
                    e = arcs[v][turn[v]]
                    if cheapest(e, v) and level.get(head[e]) == level[v] + 1:
                        step = e
                        break
                    turn[v] += 1
                if step is not None:
                    path.append(step)
                    v = head[step]
                elif v == first:
                    break
                else:
                    e = path.pop()
                    v = head[e ^ 1]
                    turn[v] += 1
    out: dict[tuple, dict[str | None, int]] = defaultdict(dict)
    for i, p in enumerate(keys):
        for e in arcs[i]:
            if e % 2 == 0 and room[e ^ 1]:
                out[p][sources[head[e] - len(keys)]] = room[e ^ 1]
    return dict(out)


def plan(patterns: dict[tuple, int], weights: Sequence[int], most: int = 3) -> tuple[dict, dict, dict]:
    """(size of each source, its target, the words it gets of each pattern)."""
    sizes: dict[str | None, int] = defaultdict(int)
    for p, size in patterns.items():
        for s in p:
            sizes[s] += size
    goal = targets(sizes, sum(patterns.values()), weights, most)
    return dict(sizes), goal, flow(patterns, {s: round(g) for s, g in goal.items()}, most)


def mix(docs: DataFrame, sources: Column, weights: Sequence[int], most: int = 3, seed: int = 0, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """(id_column, size, sources array<struct<source, size, target, taken>>, taken): words that the mix takes of each document, in all and for
    each of its sources.  ``sources`` is an array of names."""
    nobody = F.array(F.lit(None).cast("string"))
    names = F.transform(F.when(F.size(sources) > 0, sources).otherwise(nobody), lambda s: s.cast("string"))
    own = F.col(id_column).cast("long")
    known = durable(docs.select(
        own.alias("id"), F.to_json(F.array_sort(F.array_distinct(names))).alias("pattern"),
        F.regexp_count(F.coalesce(F.col(text_column).cast("string"), F.lit("")), F.lit(WORD)).cast("long").alias("size"),
        F.md5(F.concat(F.lit(f"{seed}:"), F.coalesce(own.cast("string"), F.lit(""))).cast("binary")).alias("h")))
    totals = {r["pattern"]: r["size"] for r in known.groupBy("pattern").agg(F.sum("size").alias("size")).collect()}  # a row a pattern
    members = {p: tuple(json.loads(p)) for p in totals}
    sizes, goal, sent = plan({members[p]: n for p, n in totals.items()}, weights, most)
    lots, places = {}, []
    for p, total in totals.items():
        end, lots[p] = 0, []
        for s in members[p]:
            begin, end = end, end + sent.get(members[p], {}).get(s, 0)
            lots[p].append((s, sizes[s], float(goal[s]), begin, end))
        places += [(p, x) for x in sorted({e % total for *_, e in lots[p]} if total else ()) if x]
    cuts = defaultdict(list)
    for p, place, h, size, before, words in _cuts(known, places):
        cuts[p].append((place, h, size, before, words))
    lines = known.sparkSession.createDataFrame([(p, n, lots[p], cuts[p]) for p, n in totals.items()], LINE)
    return known.join(_told(lines, len(totals)), "pattern").select(F.col("id").alias(id_column), "size", _taken(most).alias("sources")).withColumn(
        "taken", F.aggregate("sources", F.lit(0).cast("long"), lambda a, s: a + s["taken"]))


LINE = ("pattern string, total long, lots array<struct<source: string, size: long, target: double, begin: long, end: long>>, "
        "cuts array<struct<place: long, h: string, size: long, before: long, words: long>>")


def _told(rows: DataFrame, n: int) -> DataFrame:
    """``rows`` made from ``n`` rows of the driver, broadcast where that is at most ``TOLD``."""
    return F.broadcast(rows) if n <= TOLD else rows


def _cuts(known: DataFrame, places: list[tuple[str, int]]) -> list[tuple]:
    """(pattern, place, h, size, before, words): the document, or the documents of one hash and size, within which each place of a pattern's
    line lies, the words before it and its own.  Of each line, only what shares the hash's first digits with a place is looked at again."""
    spark, at = known.sparkSession, [(p, "", x, 0) for p, x in places]
    w = Window.partitionBy("pattern", "prefix").orderBy("h", "size")
    for done, digits in zip((0, *STEPS), (*STEPS, None)):
        if not at:
            return []
        near = spark.createDataFrame(sorted({a[:2] for a in at}), "pattern string, prefix string")
        rows = known.withColumn("prefix", F.substring("h", 1, done)).join(_told(near, len(at)), ["pattern", "prefix"], "left_semi")
        if digits:
            rows = rows.select("pattern", "prefix", F.substring("h", 1, digits).alias("h"), F.lit(0).cast("long").alias("place_size"), "size")
        else:
            rows = rows.withColumn("place_size", F.col("size"))
        sums = rows.groupBy("pattern", "prefix", "h", F.col("place_size").alias("size")).agg(F.sum("size").alias("words")).withColumn("end", F.sum("words").over(w))
        asked = spark.createDataFrame(at, "pattern string, prefix string, place long, before long")
        hit = sums.join(_told(asked, len(at)), ["pattern", "prefix"]).withColumn("before", F.col("before") + F.col("end") - F.col("words"))
        found = hit.filter("before <= place and place < before + words").select("pattern", "place", "h", "size", "before", "words").collect()  # a row a place
        at = [(r["pattern"], r["h"], r["place"], r["before"]) for r in found]
    return sorted(map(tuple, found))


def _taken(most: int) -> Column:
    """By source, the words it takes of a document: of one that a cut lies in, the overlap of its places with the source's; of others, all of each repetition
    that the source has (the line is alike between cuts, so the last cut before the document tells)."""
    zero = F.lit(0).cast("long")
    here = F.get(F.filter("cuts", lambda c: (c["h"] == F.col("h")) & (c["size"] == F.col("size"))), F.lit(0))
    behind = F.filter("cuts", lambda c: (c["h"] < F.col("h")) | ((c["h"] == F.col("h")) & (c["size"] < F.col("size"))))
    begin = F.coalesce(F.array_max(F.transform(behind, lambda c: c["place"])), zero)
    copies = F.call_function("div", here["words"], F.col("size"))
    each = F.sequence(zero, F.lit(most - 1).cast("long"))

    def words(lot: Column) -> Column:
        def split(a: Column, k: Column) -> Column:
            start = k * F.col("total") + here["before"]
            return a + F.greatest(zero, F.least(lot["end"], start + here["words"]) - F.greatest(lot["begin"], start))

        def whole(a: Column, k: Column) -> Column:
            place = k * F.col("total") + begin
            return a + F.when((lot["begin"] <= place) & (place < lot["end"]), F.col("size")).otherwise(zero)

        return F.when(F.col("size") == 0, zero).when(here.isNull(), F.aggregate(each, zero, whole)).otherwise(
            F.call_function("div", F.aggregate(each, zero, split), copies))

    return F.transform("lots", lambda lot: F.struct(lot["source"].alias("source"), lot["size"].alias("size"), lot["target"].alias("target"), words(lot).alias("taken")))
