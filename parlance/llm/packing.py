"""Best-fit packing of documents into sequences by linear grouping.

1. ``pieces``: token counts and checksums of each document's pieces (token ids are not kept: a piece is found again
   by document, start and length).
2. ``plan``: from the histogram of piece lengths (at most ``capacity`` numbers, however many documents there are):
   large lengths are cut into groups of equal cardinality and rounded up to the longest of their group; the
   few-size problem is optimised over configurations (column generation: a linear programme with a
   knapsack as the pricing step), rounded down, and actual lengths take the places of the rounded ones; what is
   left over and the small lengths are put where they fit best, longest first.
3. ``pack``: pieces get a rank among those of their length (counts by block of rows and a running sum over
   the blocks, so a length that a third of all pieces share is no group) and so a place in the plan.

Defined results: a null text is an empty one, which is the end-of-document id alone; repeated rows and null ids
are documents of their own; an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

import bisect
import os
import re
from collections import defaultdict
from collections.abc import Iterator
from itertools import chain
from zlib import crc32

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from parlance.llm.common import durable

CAPACITY, END_ID, GROUPS = 2048, 0, 64
SHARES = (2, 8)  # a length is large if it is over the capacity divided by this
BLOCK = 4096  # rows of a block when ranks are counted
_STRETCH = re.compile(r"[ \n]+[^ \n]*|[^ \n]+")
_OTHER_SPACE = "\t\r\x0b\x0c\x1c-\x1f\x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000"
_OTHER = re.compile(f"[{_OTHER_SPACE}]")
#: Texts in which some space does not part two non-spaces.
_UNEVEN = f"[{_OTHER_SPACE}]|  |\n | \n|^ | $"
STRETCHES, TEXT_BYTES = 20_000, 32 << 20  # held at once
TOGETHER = 200  # stretches that are encoded in one go


class Encoder:
    """Token ids of texts.  A byte-level vocabulary never merges across the step from a non-space to a space,
    so each distinct stretch between such steps is encoded once for a batch of texts; a text with any white space
    other than space and newline is one stretch.

    Stretches of a space and a word are encoded many at a time, as one text: each begins with the one token that begins with a space.
    """

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.opens = np.zeros(self.tokenizer.get_vocab_size(), bool)  # tokens that begin with a space (written as U+0120)
        self.opens[[i for t, i in self.tokenizer.get_vocab().items() if t.startswith("\u0120")]] = True

    def encode(self, texts: list[str] | pa.Array) -> list[np.ndarray]:
        texts = pc.fill_null(pa.array(texts, pa.string()) if isinstance(texts, list) else texts, "")
        size, out, at = np.cumsum(pc.binary_length(texts).to_numpy(zero_copy_only=False)), [], 0
        while at < len(texts):  # bounded memory for long texts
            end = max(at + 1, int(np.searchsorted(size, (size[at - 1] if at else 0) + TEXT_BYTES)))
            out += self._batch(texts.slice(at, end - at))
            at = end
        return out

    def _batch(self, texts: pa.Array) -> list[np.ndarray]:
        uneven = pc.match_substring_regex(texts, _UNEVEN).to_numpy(zero_copy_only=False)
        out: list = [None] * len(texts)
        even = np.flatnonzero(~uneven)
        lists = pc.split_pattern(texts.take(pa.array(even)), " ")
        offsets = lists.offsets.to_numpy().astype(np.int64)
        words = lists.flatten().dictionary_encode()
        known, n = words.dictionary.to_pylist(), len(words.dictionary)
        code = words.indices.to_numpy(zero_copy_only=False).astype(np.int64)  # a word with the space before it ...
        code[offsets[:-1]] += n  # ... or, from n on, without
        used = np.bincount(code, minlength=2 * n) > 0
        apart = pc.match_substring_regex(words.dictionary, r"^\n|\n$").to_numpy(zero_copy_only=False) | pc.equal(words.dictionary, "").to_numpy(zero_copy_only=False)
        spaced, single = np.flatnonzero(used[:n] & ~apart), np.append(np.flatnonzero(used[:n] & apart), n + np.flatnonzero(used[n:]))
        ids, sizes = self._together([known[c] for c in spaced.tolist()])
        more, other = self._each([known[c - n] if c >= n else " " + known[c] for c in single.tolist()])
        size, start = np.zeros(2 * n, np.int64), np.zeros(2 * n, np.int64)
        order = np.append(spaced, single)
        size[order] = np.append(sizes, other)
        start[order] = np.cumsum(size[order]) - size[order]
        self._put(out, even, offsets, code, np.append(ids, more), size, start)
        odd = np.flatnonzero(uneven)
        if len(odd):
            parts = [[t] if _OTHER.search(t) else _STRETCH.findall(t) for t in texts.take(pa.array(odd)).to_pylist()]
            flat = pa.array([u for us in parts for u in us], pa.string()).dictionary_encode()
            ids, sizes = self._each(flat.dictionary.to_pylist())
            self._put(out, odd, np.cumsum([0] + [len(us) for us in parts]), flat.indices.to_numpy(zero_copy_only=False).astype(np.int64), ids, sizes, np.cumsum(sizes) - sizes)
        return out

    def _each(self, stretches: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """The ids of the stretches, one after another, and their numbers."""
        ids, sizes = [], np.zeros(len(stretches), np.int64)
        for i in range(0, len(stretches), STRETCHES):
            part = [e.ids for e in self.tokenizer.encode_batch_fast(stretches[i:i + STRETCHES], add_special_tokens=False)]
            sizes[i:i + len(part)] = [len(x) for x in part]
            ids.append(np.fromiter(chain.from_iterable(part), "<u4"))
        return np.concatenate([*ids, np.zeros(0, "<u4")]), sizes

    def _together(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """As ``_each`` of the words with a space before them."""
        ids, sizes = [], []
        for i in range(0, len(words), STRETCHES):
            some = words[i:i + STRETCHES]
            texts = [" " + " ".join(some[k:k + TOGETHER]) for k in range(0, len(some), TOGETHER)]
            part = np.fromiter(chain.from_iterable(e.ids for e in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)), "<u4")
            begin = np.flatnonzero(self.opens[part])
            if len(begin) == len(some):
                size = np.diff(np.append(begin, len(part)))
            else:  # no vocabulary of this kind
                part, size = self._each([" " + w for w in some])
            ids.append(part), sizes.append(size)
        return np.concatenate([*ids, np.zeros(0, "<u4")]), np.concatenate([*sizes, np.zeros(0, np.int64)])

    def _put(self, out: list, rows: np.ndarray, offsets: np.ndarray, which: np.ndarray, pool: np.ndarray, sizes: np.ndarray, start: np.ndarray) -> None:
        for lo in range(0, len(rows), 512):
            bounds = offsets[lo:lo + 513]
            use = which[bounds[0]:bounds[-1]]
            n = sizes[use]
            ends = np.cumsum(n)
            flat = pool[np.repeat(start[use] - ends + n, n) + np.arange(n.sum())]
            cuts = np.append(0, ends)[bounds - bounds[0]]
            for r, a, b in zip(rows[lo:lo + 512], cuts[:-1], cuts[1:]):
                out[r] = flat[a:b].copy()


def pieces(docs: DataFrame, tokenizer_path: str, capacity: int = CAPACITY) -> DataFrame:
    """(doc_id, piece, start, length, ids_crc32), checkpointed with a row number ``rid`` and a block number ``block``."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = Encoder(tokenizer_path)
        for b in batches:
            rows = []
            for doc, got in zip(b.column("doc_id").to_pylist(), encoder.encode(b.column("text"))):
                got = np.append(got, np.uint32(END_ID)).astype("<u4")
                first = len(got) % capacity or capacity
                for k, start in enumerate([0, *range(first, len(got), capacity)]):
                    part = got[start:first if k == 0 else start + capacity]
                    rows.append((doc, k, start, len(part), crc32(part.tobytes())))
            cols = list(zip(*rows)) if rows else [()] * 5
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, [pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64()])],
                                             ["doc_id", "piece", "start", "length", "ids_crc32"])

    made = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).mapInArrow(
        run, "doc_id long, piece int, start long, length long, ids_crc32 long")
    numbered = made.withColumn("rid", F.monotonically_increasing_id())
    return durable(numbered.withColumn("block", F.expr(f"rid div {BLOCK}")))  # the number's high bits hold the partition


def _configurations(sizes: np.ndarray, demand: np.ndarray, capacity: int, rounds: int = 2000) -> list[tuple[np.ndarray, float]]:
    """Configurations (how many of each size) and how often to use each, by column generation."""
    m = len(sizes)
    columns = [np.where(np.arange(m) == i, capacity // s, 0) for i, s in enumerate(sizes)]
    basis, inverse = list(range(m)), np.diag([1.0 / c[i] for i, c in enumerate(columns)])
    x = inverse @ demand
    for _ in range(rounds):
        dual = inverse.sum(0)
        value, last = np.zeros(capacity + 1), np.full(capacity + 1, -1)
        for c in range(int(sizes.min()), capacity + 1):  # unbounded knapsack over sizes
            gain = np.where(sizes <= c, value[np.maximum(c - sizes, 0)] + dual, -1.0)
            i = int(gain.argmax())
            value[c], last[c] = (gain[i], i) if gain[i] > value[c - 1] + 1e-12 else (value[c - 1], -1)
        if value[capacity] <= 1 + 1e-6:
            break
        new, c = np.zeros(m, np.int64), capacity
        while c > 0:
            if last[c] >= 0:
                new[last[c]] += 1
                c -= int(sizes[last[c]])
            else:
                c -= 1
        d = inverse @ new
        ok = d > 1e-9
        if not ok.any():
            break
        ratio = np.where(ok, x / np.where(ok, d, 1), np.inf)
        r = int(ratio.argmin())
        step = max(ratio[r], 0.0)
        x = x - step * d
        x[r] = step
        columns.append(new)
        basis[r] = len(columns) - 1
        row = inverse[r] / d[r]
        inverse = inverse - np.outer(d, row)
        inverse[r] = row
    return [(columns[b], float(max(v, 0))) for b, v in zip(basis, x)]


def plan(histogram: dict[int, int], capacity: int = CAPACITY, groups: int = GROUPS, shares: tuple[int, ...] = SHARES) -> list[tuple[int, list[int]]]:
    """(how many sequences, the lengths in each) for all pieces of ``histogram`` (length: count).

    Where large lengths begin is tried in ``shares``; the plan with the fewest sequences is taken.  The number of
    entries depends on the number of distinct lengths, not on the counts.
    """
    return min((_grouped(histogram, capacity, groups, s) for s in shares), key=lambda p: sum(n for n, _ in p))


def _grouped(histogram: dict[int, int], capacity: int, groups: int, share: int) -> list[tuple[int, list[int]]]:
    left = {n: c for n, c in histogram.items() if c > 0}
    out: list[tuple[int, list[int]]] = []
    if left.get(capacity):
        out.append((left.pop(capacity), [capacity]))
    bins: dict[int, list[list]] = defaultdict(list)  # free room: [count, lengths]

    large = sorted((n for n in left if n > capacity // share), reverse=True)
    if large:
        total = sum(left[n] for n in large)
        per, sizes, members = -(-total // groups), [], []
        here, taken = [], 0
        for n in large:  # equal cardinality: a length may be shared by neighbouring groups
            c = left[n]
            while c:
                k = min(c, per - taken)
                here.append([n, k])
                c, taken = c - k, taken + k
                if taken == per:
                    sizes.append(here[0][0]), members.append(here)
                    here, taken = [], 0
        if here:
            sizes.append(here[0][0]), members.append(here)
        merged: dict[int, list] = {}  # groups that round to the same length are one size
        for s, ms in zip(sizes, members):
            merged.setdefault(s, []).extend(ms)
        sizes, members = np.array(list(merged)), [ms[::-1] for ms in merged.values()]
        demand = np.array([sum(k for _, k in ms) for ms in members], float)
        for config, times in _configurations(sizes, demand, capacity):
            times, wanted = int(times + 1e-9), [i for i, k in enumerate(config) for _ in range(k)]
            while times:  # as many sequences at once as the same actual lengths allow
                if any(sum(k for _, k in members[i]) < wanted.count(i) for i in set(wanted)):
                    break
                stock, lengths, use = {i: [list(m) for m in members[i]] for i in set(wanted)}, [], defaultdict(int)
                for i in wanted:
                    while not stock[i][-1][1]:
                        stock[i].pop()
                    stock[i][-1][1] -= 1
                    lengths.append(stock[i][-1][0])
                    use[i, len(stock[i]) - 1] += 1
                block = min(times, min(members[i][j][1] // k for (i, j), k in use.items()))
                for (i, j), k in use.items():
                    members[i][j][1] -= k * block
                for i in set(wanted):
                    while members[i] and not members[i][-1][1]:
                        members[i].pop()
                bins[capacity - sum(lengths)].append([block, lengths])
                times -= block
        rest: dict[int, int] = defaultdict(int)
        for ms in members:
            for n, k in ms:
                rest[n] += k
        left = {n: c for n, c in left.items() if n not in set(large)} | {n: k for n, k in rest.items() if k}

    rooms = sorted(bins)
    for n in sorted(left, reverse=True):
        c = left[n]
        while c:
            at = bisect.bisect_left(rooms, n)
            if at == len(rooms):  # open as many sequences as hold the rest, full of this length
                each = capacity // n
                for size, count in ((each, c // each), (c % each, 1)):
                    if size and count:
                        _put(bins, rooms, capacity - size * n, [count, [n] * size])
                break
            room = rooms[at]
            count, lengths = bins[room].pop()
            if not bins[room]:
                del bins[room]
                rooms.pop(at)
            use = min(c, count)
            if use < count:
                _put(bins, rooms, room, [count - use, lengths])
            _put(bins, rooms, room - n, [use, [*lengths, n]])
            c -= use
    return out + [(count, lengths) for room in sorted(bins) for count, lengths in bins[room]]


def _put(bins: dict, rooms: list[int], room: int, entry: list) -> None:
    if room not in bins:
        bisect.insort(rooms, room)
    bins[room].append(entry)


def _slots(entries: list[tuple[int, list[int]]]) -> np.ndarray:
    """Places by length: rows (length, first rank, first sequence, offset), sorted; ranks of a length follow one another."""
    rows, base, ranks = [], 0, defaultdict(int)
    for count, lengths in entries:
        offset = 0
        for n in lengths:
            rows.append((n, ranks[n], base, offset))
            ranks[n] += count
            offset += n
        base += count
    return np.array(sorted(rows), np.int64).reshape(-1, 4)


def pack(parts: DataFrame, capacity: int = CAPACITY, groups: int = GROUPS) -> DataFrame:
    """``parts`` (from ``pieces``) with sequence_id and offset."""
    counts = durable(parts.groupBy("length", "block").agg(F.count("*").alias("n")))
    histogram = {r["length"]: r["n"] for r in counts.groupBy("length").agg(F.sum("n").alias("n")).collect()}  # capacity rows at most
    slots = _slots(plan(histogram, capacity, groups))

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keys = slots[:, 0] << 44 | slots[:, 1]
        for b in batches:
            length, rank = b.column("length").to_numpy(), b.column("rank").to_numpy()
            at = np.searchsorted(keys, length << 44 | rank, side="right") - 1
            names = [n for n in b.schema.names if n != "rank"]
            yield pa.RecordBatch.from_arrays(
                [*[b.column(n) for n in names], pa.array(slots[at, 2] + rank - slots[at, 1]), pa.array(slots[at, 3])],
                [*names, "sequence_id", "offset"])

    # Blocks are gathered by thousands, so that no length's running sum is one group.
    wide = counts.withColumn("wide", F.expr("block div 1024"))
    outer = (wide.groupBy("length", "wide").agg(F.sum("n").alias("m"))
             .withColumn("before", F.sum("m").over(Window.partitionBy("length").orderBy("wide").rowsBetween(Window.unboundedPreceding, -1))))
    inner = wide.withColumn("within", F.sum("n").over(Window.partitionBy("length", "wide").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)))
    first = inner.join(outer.select("length", "wide", "before"), ["length", "wide"]).select(
        "length", "block", (F.coalesce("before", F.lit(0)) + F.coalesce("within", F.lit(0))).alias("first"))
    local = parts.withColumn("local", F.row_number().over(Window.partitionBy("length", "block").orderBy("rid")) - 1)
    ranked = local.join(first, ["length", "block"]).select(
        "doc_id", "piece", "start", "length", "ids_crc32", (F.col("first") + F.col("local")).alias("rank"))
    return ranked.mapInArrow(place, "doc_id long, piece int, start long, length long, ids_crc32 long, sequence_id long, offset long")
