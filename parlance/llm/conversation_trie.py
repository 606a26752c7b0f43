"""The trie of conversation prefixes, by double arrays.

1. ``rebuilt``: each conversation as its sequence of turn keys (128-bit hashes of role and text, so texts are read once and never
   shuffled), after its first turns were replaced by those of conversation ``c - c % 100``.
2. Equal sequences are one from here on; their members' ids are listed by blocks of ``IDS`` consecutive numbers and hashed block by block,
   so a sequence that a third of all conversations share is never gathered.
3. The distinct sequences are sorted over the cluster.  A sorted partition is taken in shards of ``BLOCK`` turns: in each, turns get
   dense ids, the trie is packed into BASE and CHECK arrays, and every sequence is walked through them
   to add up its nodes' members, children, leaves and tokens.
4. A prefix that goes on over a shard's border is a node of several shards: each has counted only what begins within it (the shared
   length with the row before and after is known), so such upper nodes' parts are added up by key, and all others are final.

Defined results: a null conversation id takes no part; turns are ordered by turn (null first), equal turns by role, then by
a hash of the text, and repeated rows are turns of their own; null roles and texts are empty ones; a conversation without turns is a
member of the root alone; no conversations, no nodes.  A conversation's turn keys (16 bytes a turn) are one row, its texts
are not.  Other columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from parlance.llm.common import durable

IDS, BLOCK, KEY = 1024, 200_000, 16
GROUP, HEADS = 100, 6
TRIES = 32  # free places that are tried for a node's children before they go behind the last one
NONE = hashlib.sha256(b"").hexdigest()
LOW, HIGH = -(2 ** 63), 2 ** 63 - 1
PART = "key binary, parent_key binary, depth long, conv_id long, parent_conv_id long, n_convs long, n_children long, n_leaves long, saved_tokens long, ends_sha256 string"
NODE = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]


def rebuilt(turns: DataFrame) -> DataFrame:
    """(conv_id, path, sizes) of ``turns(conv_id, turn, role, text)``: a conversation's turn keys one after another, and the code points of its texts."""
    role, text = (F.coalesce(F.col(c).cast("string"), F.lit("")) for c in ("role", "text"))
    key = F.substring(F.sha2(F.concat(F.length(role).cast("string"), F.lit(":"), role, text).cast("binary"), 256), 1, 2 * KEY)
    one = F.struct(F.col("turn").alias("turn"), role.alias("role"), key.alias("key"), F.length(text).alias("size"))
    own = (turns.filter("conv_id is not null").groupBy(F.col("conv_id").cast("long").alias("conv_id"))
           .agg(F.transform(F.sort_array(F.collect_list(one)), lambda t: F.struct(t["key"].alias("key"), t["size"].alias("size"))).alias("own")))
    own = durable(own)
    heads = own.filter(F.col("conv_id") % GROUP == 0).select(F.col("conv_id").alias("base"), F.slice("own", 1, HEADS - 1).alias("head"))
    h = (F.crc32(F.col("conv_id").cast("string").cast("binary")) % HEADS).cast("int")
    joined = own.withColumn("base", F.col("conv_id") - F.col("conv_id") % GROUP).join(heads, "base", "left").withColumn("h", h)
    head = F.coalesce("head", F.slice("own", 1, 0))
    whole = F.concat(F.slice(head, F.lit(1), F.col("h")), F.slice("own", F.col("h") + 1, F.size("own")))
    return (joined.select("conv_id", whole.alias("t"))
            .select("conv_id", F.unhex(F.array_join(F.col("t.key"), "")).alias("path"), F.col("t.size").alias("sizes")))


def members(paths: DataFrame) -> DataFrame:
    """(n, conv_id, ends) of each distinct path: number and smallest of its conversations, and the hash of their ids' list."""
    blocks = (paths.groupBy(F.sha2("path", 256).alias("p"), F.expr(f"conv_id div {IDS}").alias("block"))
              .agg(F.array_sort(F.collect_list("conv_id")).alias("ids"))
              .select("p", "block", F.size("ids").alias("n"), F.col("ids")[0].alias("conv_id"), F.array_join(F.col("ids").cast("array<string>"), ",").alias("listed")))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def rows(done: list) -> pa.RecordBatch:
            n, first, sha = zip(*done) if done else ((), (), ())
            return pa.RecordBatch.from_arrays([pa.array(n, pa.int64()), pa.array(first, pa.int64()), pa.array([s.hexdigest() for s in sha], pa.string())], ["n", "conv_id", "ends"])

        now, last = None, None
        for b in batches:
            done = []
            for p, n, first, listed in zip(*[b.column(c).to_pylist() for c in ("p", "n", "conv_id", "listed")]):
                if p == last:
                    now[0] += n
                    now[2].update(b",")
                else:
                    if now:
                        done.append(now)
                    now, last = [n, first, hashlib.sha256()], p
                now[2].update(listed.encode())
            yield rows(done)
        if now:
            yield rows([now])

    return blocks.repartition(F.col("p")).sortWithinPartitions("p", "block").mapInArrow(run, "n long, conv_id long, ends string")


def nodes(paths: DataFrame) -> DataFrame:
    """A row for each node of the trie of ``paths(conv_id, path, sizes)``: ``NODE``."""
    paths = durable(paths)
    parts = int(paths.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    distinct = paths.join(members(paths), "conv_id")
    ordered = durable(distinct.repartitionByRange(parts, "path").sortWithinPartitions("path").withColumn("part", F.spark_partition_id()))
    borders = _borders(ordered)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, part, before = [], None, -1
        for b in batches:
            for row in zip(*[b.column(c).to_pylist() for c in ("path", "sizes", "n", "conv_id", "ends", "part")]):
                if part != row[5]:
                    if held:
                        yield _shard(held, before, borders[part][1])
                    held, part, size, before = [], row[5], 0, borders[row[5]][0]
                elif size >= BLOCK:
                    shared = _common(held[-1][0], row[0])
                    yield _shard(held, before, shared)
                    held, size, before = [], 0, shared
                held.append(row)
                size += len(row[1]) + 1
        if held:
            yield _shard(held, before, borders[part][1])

    found = durable(ordered.select("path", "sizes", "n", "conv_id", "ends", "part").mapInArrow(run, PART))
    sums = [F.sum(c).alias(c) for c in ("n_convs", "n_children", "n_leaves", "saved_tokens")]
    upper = durable(found.filter("key is not null").groupBy("key").agg(
        F.first("parent_key").alias("parent_key"), F.first("depth").alias("depth"), F.min("conv_id").alias("conv_id"), *sums, F.max("ends_sha256").alias("ends_sha256")))
    upper = upper.withColumn("ends_sha256", F.coalesce("ends_sha256", F.lit(NONE)))
    columns = ["parent_key", *[c for c in NODE if c != "parent_conv_id"]]
    under = found.filter("key is null and parent_key is not null").select(*columns).union(upper.filter("parent_key is not null").select(*columns))
    tops = upper.select(F.col("key").alias("parent_key"), F.col("conv_id").alias("parent_conv_id"))
    roots = upper.filter("parent_key is null").withColumn("parent_conv_id", F.lit(None).cast("long"))
    inner = found.filter("key is null and parent_key is null")
    return inner.select(*NODE).union(under.join(tops, "parent_key", "left").select(*NODE)).union(roots.select(*NODE))


def _borders(ordered: DataFrame) -> dict[int, tuple[int, int]]:
    """For each sorted partition, the number of turns that its first path shares with the path before, and its last with the
    one after (-1: there is none).  The paths, two a partition, are compared in one task; the driver gets the numbers."""
    ends = ordered.groupBy("part").agg(F.min("path").alias("first"), F.max("path").alias("last"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, last, shared = None, None, -1
        for b in batches:
            for p, first, final in zip(*[b.column(c).to_pylist() for c in ("part", "first", "last")]):
                before = -1 if part is None else _common(last, first)
                if part is not None:
                    yield pa.RecordBatch.from_arrays([pa.array([x], pa.int32()) for x in (part, shared, before)], ["part", "before", "after"])
                part, last, shared = p, final, before
        if part is not None:
            yield pa.RecordBatch.from_arrays([pa.array([x], pa.int32()) for x in (part, shared, -1)], ["part", "before", "after"])

    rows = ends.repartition(1).sortWithinPartitions("part").mapInArrow(run, "part int, before int, after int").collect()
    return {r["part"]: (r["before"], r["after"]) for r in rows}


def _common(a: bytes, b: bytes) -> int:
    """Whole turns that two paths share from their start on."""
    n = min(len(a), len(b)) // KEY
    x, y = (np.frombuffer(p, np.uint64, 2 * n).reshape(n, 2) for p in (a, b))
    differ = (x != y).any(1)
    return int(differ.argmax()) if differ.any() else n


class DoubleArray:
    """A trie over dense codes, packed: the child of slot s by code c is slot BASE[s] + c, if CHECK of that is s.  Slot 0 is the root."""

    def __init__(self, parent: np.ndarray, code: np.ndarray):
        """Of nodes 1, 2, ... (node 0 is the root), each after its parent, by their parents and codes; siblings differ in code."""
        nodes, codes = len(parent) + 1, int(code.max(initial=-1)) + 1
        order = np.lexsort((code, parent))
        starts = np.flatnonzero(np.concatenate([[True], np.diff(parent[order]) != 0])[:len(order)])
        sizes = np.diff(np.append(starts, len(order)))
        base, slot = np.zeros(nodes, np.int64), np.zeros(nodes, np.int64)
        taken = np.zeros(2 * nodes + codes + 1, bool)
        taken[0], end, cursor = True, 1, 1
        for g in np.flatnonzero(sizes > 1)[np.argsort(-sizes[sizes > 1], kind="stable")].tolist():  # large families first
            group = order[starts[g]:starts[g] + sizes[g]]
            c = code[group]
            low, high = int(c[0]), int(c[-1])
            at = end
            for free in (np.flatnonzero(~taken[cursor:cursor + 4 * TRIES]) + cursor)[:TRIES].tolist():
                if free - low + high < len(taken) and not taken[free - low + c].any():
                    at = free
                    break
            if at - low + high >= len(taken):
                taken = np.concatenate([taken, np.zeros(at - low + high + 1, bool)])
            taken[at - low + c] = True
            end = max(end, at - low + high + 1)
            while cursor < end and taken[cursor]:
                cursor += 1
            base[parent[group[0]]] = at - low
            slot[group + 1] = at - low + c
        single = order[starts[sizes == 1]]  # an only child fits any free slot
        spare = np.flatnonzero(~taken[:end])[:len(single)]
        free = np.concatenate([spare, end + np.arange(len(single) - len(spare))])
        base[parent[single]] = free - code[single]
        slot[single + 1] = free
        size = int(slot.max(initial=0)) + 1
        self.base, self.check = np.zeros(size, np.int64), np.full(size, -1)
        self.base[slot] = base
        self.check[slot[1:]] = slot[parent]
        self.size = size

    def walk(self, codes: np.ndarray, offsets: np.ndarray) -> np.ndarray:
        """The slot after each code of the sequences that ``offsets`` cut ``codes`` into."""
        out, length = np.zeros(len(codes), np.int64), np.diff(offsets)
        row = np.argsort(-length, kind="stable")
        at, d = np.zeros(len(row), np.int64), 0
        while len(row := row[:np.searchsorted(-length[row], -d, side="left")]):  # those that go on
            place = offsets[row] + d
            went = self.base[at[:len(row)]] + codes[place]
            if (self.check[went] != at[:len(row)]).any():
                raise ValueError("a sequence left the trie")
            out[place], at, d = went, went, d + 1
        return out


def _edges(keys: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Of sorted sequences of keys (rows of two numbers): the parent and code of each node, dense codes by first sight breadth first,
    the code of each key, and by sequence how many keys it shares with the one before."""
    length = np.diff(offsets)
    row = np.repeat(np.arange(len(length)), length)
    depth = np.arange(len(keys)) - offsets[row]
    before = offsets[np.maximum(row - 1, 0)] + depth
    same = (row > 0) & (depth < length[np.maximum(row - 1, 0)])
    same[same] = (keys[same] == keys[before[same]]).all(1)
    stop = np.where(same, length[row], depth)
    shared = length.copy()
    np.minimum.at(shared, row, stop)
    shared[:1] = 0
    new = depth >= shared[row]
    by_depth = np.lexsort((row, depth))
    first = np.where(new[by_depth], np.arange(len(keys)), 0)
    seen = np.empty(len(keys), np.int64)
    seen[by_depth] = np.cumsum(new[by_depth])  # node numbers, breadth first
    node = np.empty(len(keys), np.int64)
    node[by_depth] = seen[by_depth][np.maximum.accumulate(first)] if len(keys) else first
    fresh = by_depth[new[by_depth]]
    parent = np.where(depth[fresh] > 0, node[fresh - 1], 0)
    order = np.lexsort((keys[fresh, 1], keys[fresh, 0]))
    ranked = keys[fresh][order]
    group = np.cumsum(np.concatenate([[False], (ranked[1:] != ranked[:-1]).any(1)])[:len(ranked)])
    sight = np.full(group[-1] + 1 if len(group) else 0, len(fresh))
    np.minimum.at(sight, group, order)
    dense = np.empty(len(sight), np.int64)
    dense[np.argsort(sight)] = np.arange(len(sight))
    code = np.empty(len(fresh), np.int64)
    code[order] = dense[group]
    return parent, code, np.append(-1, code)[node], shared


def _shard(rows: list[tuple], before: int, after: int) -> pa.RecordBatch:
    """The nodes of sorted distinct (path, sizes, n, conv_id, ends): ``before`` and ``after`` are the turns that the first and the last
    share with the path outside (-1: none).  Nodes that lie outside too have a key, nodes below them a parent's key."""
    paths, sizes, n, conv, ends = [list(c) for c in zip(*[r[:5] for r in rows])]
    length = np.fromiter(map(len, sizes), np.int64, len(sizes))
    offsets = np.append(0, np.cumsum(length))
    parent, code, codes, shared = _edges(np.frombuffer(b"".join(paths), np.uint64).reshape(-1, 2), offsets)
    trie = DoubleArray(parent, code)
    slot = trie.walk(codes, offsets)
    n, conv, size = np.array(n, np.int64), np.array(conv, np.int64), np.concatenate([np.array(s, np.int64) for s in sizes])
    shared[0] = max(before, 0)
    row = np.repeat(np.arange(len(rows)), length)
    depth = np.arange(len(slot)) - offsets[row]
    # Every place on a path, the root first, then the walked slots.
    all_slots, all_rows = np.concatenate([np.zeros(len(rows), np.int64), slot]), np.concatenate([np.arange(len(rows)), row])
    total = np.append(0, np.cumsum(size))
    rest = total[offsets[1:]]
    down = n[all_rows] * (rest[all_rows] - np.concatenate([total[offsets[:-1]], total[:-1]]))
    start = np.concatenate([shared, np.maximum(depth, shared[row])])  # what the sequence adds to the trie begins here
    down -= rest[all_rows] - total[offsets[all_rows] + start]

    def added(values: np.ndarray, at: np.ndarray = all_slots) -> np.ndarray:
        np.add.at(out := np.zeros(trie.size, np.int64), at, values)
        return out

    goes_on = np.append(shared[1:], after) == length  # the next path begins with this one
    n_convs, saved, leaves = added(n[all_rows]), added(down), added((~goes_on[all_rows]).astype(np.int64))
    fresh = depth >= shared[row]
    children = added(1, trie.check[slot[fresh]])
    np.minimum.at(least := np.full(trie.size, HIGH), all_slots, conv[all_rows])
    deep = np.zeros(trie.size, np.int64)
    deep[slot] = depth + 1
    last = np.where(length > 0, np.append(slot, 0)[offsets[1:] - 1], 0)
    listed = np.full(trie.size, None, object)
    listed[last] = ends
    keys = np.full(trie.size, None, object)
    for i, shares in ((0, before), (len(rows) - 1, after)):
        sha = hashlib.sha256()
        for d in range(shares + 1):
            if d:
                sha.update(paths[i][(d - 1) * KEY:d * KEY])
            keys[slot[offsets[i] + d - 1] if d else 0] = sha.copy().digest()[:KEY]
    used = np.append(0, np.flatnonzero(trie.check >= 0))
    up = trie.check[used]  # the root's is -1
    parent_key = [keys[u] if u >= 0 else None for u in up.tolist()]
    own_key = keys[used].tolist()
    known = [e if e is not None or k is not None else NONE for e, k in zip(listed[used].tolist(), own_key)]
    hidden = np.array([u < 0 or k is not None for u, k in zip(up.tolist(), parent_key)])
    return pa.RecordBatch.from_arrays(
        [pa.array(own_key, pa.binary()), pa.array(parent_key, pa.binary()), pa.array(deep[used]), pa.array(least[used]), pa.array(np.where(hidden, 0, least[np.maximum(up, 0)]), mask=hidden),
         pa.array(n_convs[used]), pa.array(children[used]), pa.array(leaves[used]), pa.array(saved[used]), pa.array(known, pa.string())],
        ["key", "parent_key", "depth", "conv_id", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"])
