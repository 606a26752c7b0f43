"""Benchmark decontamination by spaced seeds.

Words (runs of letters and digits, lower case) are hashed at the positions that a fixed mask selects, so a substitution at
an ignored position leaves the seed as it is.  Seeds of documents and of benchmark items are joined; around
each hit the two are laid side by side and compared word by word.  The longest stretch in which at least
``identity`` of the words agree counts if it has ``min_words`` words, or is the whole item if that is shorter.

Documents' seeds pass a bit map of the benchmark's seeds first (fixed size, ``BITS``; it can only let too many through),
so few are shuffled.  Stretches of seeds that pass go with the words around them (``CONTEXT`` each side).

The five masks leave no gap: wherever ``identity`` (0.8) accepts 13 words or more, one of them meets agreeing words
only (an overlap of 26 words or more has a half that is accepted itself; below, ``tests/llm`` tries all
substitutions).  Items under 13 words must agree as a whole, so they get masks of their own length (``own_masks``).

Defined results: null and empty texts match nothing; items of fewer than ``shortest`` words take no part (9 by default, the
registered queries and the pipeline take all); repeated rows give one row each; null ids are kept in ``find``; an empty table of
either kind gives no matches, and ``clean`` then keeps all documents; other columns are kept by ``clean``.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from parlance.llm.common import durable, hashed_at, rows_of, split_words, word_hashes

MASKS = ("110101011", "1110010011", "11001010111", "1110111", "111111")
WHOLE = 13  # items of fewer words must agree as a whole
BITS, CONTEXT, STRETCH = 1 << 24, 64, 256
SHORTEST = 9


def own_masks(size: int) -> list[str]:
    """Masks of ``size`` words: whichever inner words ``identity`` lets differ (a fifth), one mask ignores them all."""
    differ = size // 5
    ignored = combinations(range(2 * differ), differ)
    return ["".join("0" if 0 < i < size - 1 and differ and i % (2 * differ) in part else "1" for i in range(size)) for part in map(set, ignored)]


def seeds(tokens: np.ndarray, offsets: np.ndarray, masks: tuple[str, ...]) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(mask number, positions, seed hashes) of all texts."""
    end = np.repeat(offsets[1:], np.diff(offsets))
    for k, mask in enumerate(masks):
        at = np.flatnonzero(np.arange(len(tokens)) + len(mask) <= end)
        yield k, at, hashed_at(tokens, at, [i for i, c in enumerate(mask) if c == "1"], k + 1)


def _bit(h: np.ndarray) -> np.ndarray:
    return (h >> np.uint64(20)) % np.uint64(BITS)


def longest(same: np.ndarray, identity: float) -> tuple[int, int]:
    """(start, length) of the longest stretch that begins and ends with agreement and has the identity."""
    best = (0, 0)
    total = np.concatenate([[0.0], np.cumsum(same - identity)])
    low = np.minimum.accumulate(total)
    for j in np.flatnonzero(same):
        i = int(np.searchsorted(-low, -(total[j + 1] + 1e-9)))
        while i <= j and not same[i]:
            i += 1
        if j + 1 - i > best[1] and total[j + 1] - total[i] >= -1e-9:
            best = (i, int(j + 1 - i))
    return best


def joined(parts: list[tuple[int, bytes]]) -> list[tuple[int, np.ndarray]]:
    """Stretches (begin, agreement by word), with those that touch or overlap as one."""
    out: list[tuple[int, bytes]] = []
    for begin, same in sorted(parts):
        if out and begin <= out[-1][0] + len(out[-1][1]):
            out[-1] = (out[-1][0], out[-1][1] + same[out[-1][0] + len(out[-1][1]) - begin:])
        else:
            out.append((begin, same))
    return [(begin, np.frombuffer(same, np.bool_)) for begin, same in out]


def benchmark_seeds(items: DataFrame, shortest: int) -> tuple[DataFrame, DataFrame, tuple[str, ...]]:
    """(seeds of the items, the items as numbered rows of word hashes, the masks)."""
    def words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            names, codes, offsets = split_words(b.column("text"))
            tokens = word_hashes(names)[codes].view(np.int64)
            yield pa.RecordBatch.from_arrays([b.column("item_id"), pa.ListArray.from_arrays(offsets.astype(np.int32), tokens)], ["item_id", "words"])

    def seeded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            lists = b.column("words")
            offsets = lists.offsets.to_numpy().astype(np.int64)
            tokens, offsets = lists.flatten().to_numpy().view(np.uint64), offsets - offsets[0]
            row = rows_of(offsets)
            for k, at, h in seeds(tokens, offsets, masks):
                if k >= len(MASKS):
                    own = np.diff(offsets)[row[at]] == len(masks[k])
                    at, h = at[own], h[own]
                yield pa.RecordBatch.from_arrays(
                    [b.column("item").take(pa.array(row[at])), pa.array((at - offsets[row[at]]).astype(np.int32)), pa.array(np.full(len(at), k, np.int32)), pa.array(h.view(np.int64))],
                    ["item", "item_at", "mask", "seed"])

    numbered = durable(items.select(F.col("item_id").cast("string"), F.col("text").cast("string"))
                       .mapInArrow(words, "item_id string, words array<long>").filter(F.size("words") >= max(shortest, 1))
                       .withColumn("item", F.monotonically_increasing_id()))
    sizes = numbered.select(F.size("words").alias("n")).filter(F.col("n") < WHOLE).distinct().collect()  # 12 at most
    masks = (*MASKS, *[m for n in sorted(r["n"] for r in sizes) for m in own_masks(n)])
    return durable(numbered.select("item", "words").mapInArrow(seeded, "item long, item_at int, mask int, seed long")), numbered, masks


def regions(docs: DataFrame, known: DataFrame, masks: tuple[str, ...]) -> DataFrame:
    """Stretches of documents whose seeds may be the benchmark's: (doc_id, text_key, region, first, words, hits)."""
    bits = known.select(F.expr(f"(shiftrightunsigned(seed, 20) % {BITS})").alias("bit")).distinct().toPandas()["bit"]  # BITS numbers at most
    marked = np.zeros(BITS, np.bool_)
    marked[bits.to_numpy(np.int64)] = True
    shared = docs.sparkSession.sparkContext.broadcast(np.packbits(marked))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen = np.unpackbits(shared.value).view(np.bool_)
        for b in batches:
            for lo in range(0, b.num_rows, 512):
                names, codes, offsets = split_words(b.column("text").slice(lo, 512))
                tokens = word_hashes(names)[codes]
                parts = [(k, at[ok], h[ok]) for k, at, h in seeds(tokens, offsets, masks) if (ok := seen[_bit(h)]).any()]
                if not parts:
                    continue
                at = np.concatenate([p[1] for p in parts])
                mask, h = np.concatenate([np.full(len(p[1]), p[0]) for p in parts]), np.concatenate([p[2] for p in parts])
                order = np.argsort(at, kind="stable")
                at, mask, h = at[order], mask[order], h[order]
                row = rows_of(offsets)[at]
                gap = np.concatenate([[True], (np.diff(at) > CONTEXT) | (np.diff(row) > 0)])
                begin = np.maximum.accumulate(np.where(gap, at, 0))
                cut = np.concatenate([[True], gap[1:] | (np.diff((at - begin) // STRETCH) > 0)])
                cuts = np.append(np.flatnonzero(cut), len(at))
                out = []
                for i, j in zip(cuts[:-1], cuts[1:]):
                    r = row[i]
                    first, last = max(offsets[r], at[i] - CONTEXT), min(offsets[r + 1], at[j - 1] + max(map(len, masks)) + CONTEXT)
                    out.append((int(lo + r), int(first - offsets[r]), tokens[first:last].view(np.int64),
                                [{"at": int(a - offsets[r]), "mask": int(m), "seed": int(x)} for a, m, x in zip(at[i:j], mask[i:j], h[i:j].view(np.int64))]))
                rows = pa.array([o[0] for o in out])
                yield pa.RecordBatch.from_arrays(
                    [b.column("doc_id").take(rows), b.column("text_key").take(rows), pa.array([o[1] for o in out], pa.int32()),
                     pa.array([o[2] for o in out], pa.list_(pa.int64())), pa.array([o[3] for o in out], hit)], ["doc_id", "text_key", "first", "words", "hits"])

    hit = pa.list_(pa.struct([("at", pa.int32()), ("mask", pa.int32()), ("seed", pa.int64())]))
    made = (docs.select(F.col("doc_id").cast("long"), F.md5(F.col("text").cast("string")).alias("text_key"), F.col("text").cast("string"))
            .mapInArrow(run, "doc_id long, text_key string, first int, words array<long>, hits array<struct<at int, mask int, seed long>>"))
    return durable(made.withColumn("region", F.monotonically_increasing_id()))


def agreeing(found: DataFrame, known: DataFrame, numbered: DataFrame, min_words: int, identity: float) -> DataFrame:
    """The regions laid beside the items whose seeds they hold, where they agree: (doc_id, text_key, item_id, shift, begin, same)."""
    hits = found.select("region", F.explode("hits").alias("h")).select("region", "h.at", "h.mask", "h.seed")
    lines = hits.join(known, ["mask", "seed"]).select("region", "item", (F.col("at") - F.col("item_at")).alias("shift")).distinct()

    def verify(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            rows = []
            for doc, key, first, words, item, at, mine, size in zip(*[b.column(n).to_pylist() if n not in ("words", "mine") else b.column(n) for n in ("doc_id", "text_key", "first", "words", "item_id", "item_first", "mine", "item_size")]):
                a, c = words.values.to_numpy(), mine.values.to_numpy()
                lead = max(0, -at)  # the region begins before the item does
                n = min(len(a) - lead, len(c))
                if n <= 0:
                    continue
                same = a[lead:lead + n] == c[:n]
                i, length = longest(same, identity)
                if length >= min(min_words, size):
                    rows.append((doc, key, item, first - at, first + lead, same.tobytes()))
            cols = list(zip(*rows)) if rows else [()] * 6
            types = [pa.int64(), pa.string(), pa.string(), pa.int32(), pa.int32(), pa.binary()]
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, types)], ["doc_id", "text_key", "item_id", "shift", "begin", "same"])

    beside = (lines.join(found.select("region", "doc_id", "text_key", "first", "words"), "region").join(numbered.withColumnRenamed("words", "all"), "item")
              .withColumn("item_first", F.col("first") - F.col("shift"))
              .select("doc_id", "text_key", "first", "words", "item_id", "item_first", F.size("all").alias("item_size"),
                      F.slice("all", F.greatest(F.col("item_first"), F.lit(0)) + 1, F.size("words")).alias("mine")))
    return beside.mapInArrow(verify, "doc_id long, text_key string, item_id string, shift int, begin int, same binary")


def find(docs: DataFrame, items: DataFrame, min_words: int = 13, identity: float = 0.8, shortest: int = SHORTEST) -> DataFrame:
    """Verified overlaps (doc_id, text_key, item_id, start, item_start, length, matches), in words."""
    known, numbered, masks = benchmark_seeds(items, shortest)

    def join(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            row, spans = [], []
            for k, parts in enumerate(b.column("parts").to_pylist()):
                shift = b.column("shift")[k].as_py()
                for begin, same in joined([(p["begin"], p["same"]) for p in parts]):
                    i, length = longest(same, identity)
                    row.append(k)
                    spans.append((begin + i, begin + i - shift, length, int(same[i:i + length].sum())))
            kept = [b.column(n).take(pa.array(row, pa.int32())) for n in ("doc_id", "text_key", "item_id")]
            yield pa.RecordBatch.from_arrays([*kept, *[pa.array([x[j] for x in spans], pa.int32()) for j in range(4)]],
                                             ["doc_id", "text_key", "item_id", "start", "item_start", "length", "matches"])

    out = agreeing(regions(docs, known, masks), known, numbered, min_words, identity)
    # Neighbouring regions overlap: those of a text and an item along one shift are one stretch.
    grouped = out.groupBy("doc_id", "text_key", "item_id", "shift").agg(F.collect_set(F.struct("begin", "same")).alias("parts"))
    return grouped.mapInArrow(join, "doc_id long, text_key string, item_id string, start int, item_start int, length int, matches int")


def clean(docs: DataFrame, items: DataFrame, min_words: int = 13, identity: float = 0.8, shortest: int = SHORTEST) -> DataFrame:
    """The rows of ``docs``, all columns, whose text has no verified overlap.

    One overlap is enough, so each seed first meets one of the items that hold it, and only texts without an overlap there meet them
    all: texts that share a whole template with many items cost one item each.
    """
    known, numbered, masks = benchmark_seeds(items, shortest)
    found = regions(docs, known, masks)
    one = known.groupBy("mask", "seed").agg(F.min(F.struct("item", "item_at")).alias("one")).select("mask", "seed", "one.*")
    first = durable(agreeing(found, one, numbered, min_words, identity).select("text_key").distinct())
    rest = agreeing(found.join(first, "text_key", "left_anti"), known, numbered, min_words, identity)
    bad = durable(first.union(rest.select("text_key").distinct()))
    return docs.join(bad, F.md5(F.coalesce(docs["text"].cast("string"), F.lit(""))) == bad["text_key"], "left_anti")
