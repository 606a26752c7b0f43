"""Whitening, source mixing and the conversation trie: brute force, hot groups, odd rows."""

import hashlib
import itertools
import random
from collections import Counter, defaultdict
from zlib import crc32

import numpy as np
import pytest
from pyspark.sql import functions as F

from parlance.llm import conversation_trie, mixing, queries, whitening

VECTORS = "vec_id long, embedding array<double>"


# --- whitening

def _check_whitened(rows, got, k=8):
    """``rows``: usable (id, vector) with distinct ids."""
    x = np.floor(1024 * np.array([v for _, v in rows], float)).astype(np.int64) + 100_000
    n, ids = len(x), [i for i, _ in rows]
    sums = x.astype(object).sum(0)
    apart = n * x.astype(object) - sums
    centred = apart.astype(float) / n
    v = centred.T @ centred / n
    e = np.linalg.eigvalsh(v)[::-1]
    by = defaultdict(dict)
    for r in got:
        assert r["component"] not in by[r["vec_id"]]
        by[r["vec_id"]][r["component"]] = r
    assert sorted(by) == sorted(ids) and all(sorted(c) == list(range(1, min(k, len(v)) + 1)) for c in by.values())
    w = np.array([[by[i][c]["whitened"] for c in sorted(by[i])] for i in ids], float)
    for i, a in zip(ids, apart):
        assert {(r["n"], r["deviation"]) for r in by[i].values()} == {(n, int((a * a).sum()))}
    k = w.shape[1]
    explained = [by[ids[0]][c]["explained"] for c in range(1, k + 1)]
    assert np.allclose(explained, e[:k] / np.trace(v), rtol=1e-9, atol=1e-15)
    solid = e[:k] > len(v) * 1e-15 * e.sum()
    assert (~np.isnan(w) == solid).all()
    w = w[:, solid]
    error = np.abs((w - w.mean(0)).T @ (w - w.mean(0)) / n - np.eye(w.shape[1]))
    assert not error.size or error.max() < 1e-10
    assert {r["identity_error"] for r in got} == {got[0]["identity_error"]} and (not error.size or got[0]["identity_error"] < 1e-9)
    # Each column is a projection on an eigenvector: w sqrt(e) = centred u gives u = V^-1 centred^T w sqrt(e) / n on V's range.
    u = centred.T @ w / n / np.sqrt(e[:k][solid])
    assert not u.size or (np.abs(v @ u - u * e[:k][solid]).max() <= 1e-9 * e[0] and np.abs(np.linalg.norm(u, axis=0) - 1).max() < 1e-9)


def test_whitening_on_the_table(spark, mid):
    rows = [(r["vec_id"], r["embedding"]) for r in spark.read.parquet(f"{mid}/embeddings.parquet").collect()]
    _check_whitened(rows, queries.op11_whitening(spark, mid).collect())


def test_eigen_of_clusters():
    r = np.random.default_rng(1)
    for values in (np.linspace(1, 9, 48), np.ones(48), np.r_[1 + 1e-9 * np.arange(24), np.linspace(2, 3, 24)], np.r_[np.ones(20), np.full(20, 1 + 1e-7), np.linspace(2, 3, 8)],
                   10.0 ** -np.linspace(0, 15, 48), np.r_[np.zeros(46), 1, 1]):
        q = np.linalg.qr(r.standard_normal((48, 48)))[0]
        a = (q * values) @ q.T
        a = (a + a.T) / 2
        e, x = whitening.eigen(a)
        assert (np.diff(e) <= 1e-14 * e[0]).all() and np.abs(np.sort(e) - np.linalg.eigvalsh(a)).max() < 1e-13 * np.abs(values).max()
        assert np.abs(a @ x - x * e).max() < 1e-14 * np.abs(values).max() and np.abs(x.T @ x - np.eye(48)).max() < 1e-14


def test_eigen_tells_a_cluster_apart_below_float32():
    """Values 1e-9 apart: float32 mixes their vectors, the sub-solve parts them."""
    r = np.random.default_rng(2)
    q = np.linalg.qr(r.standard_normal((16, 16)))[0]
    values = np.r_[5 + 1e-9 * np.arange(8)[::-1], 4 - 0.1 * np.arange(8)]
    a = (q * values) @ q.T
    x = whitening.eigen((a + a.T) / 2)[1]
    assert np.abs(np.abs((q * x).sum(0)) - 1).max() < 1e-9
    rough = np.linalg.eigh(a.astype(np.float32))[1][:, ::-1]
    assert np.abs(np.abs((q * rough).sum(0)) - 1).max() > 1e-2


def test_whitening_odd_vectors(spark):
    r = np.random.default_rng(3)
    good = [(i, v.tolist()) for i, v in enumerate(r.standard_normal((300, 5)) * [9, 3, 3, 1, 0] + [0, 5, 0, 0, 2])]  # one dimension without spread
    bad = [(900, None), (901, []), (902, [1.0, None, 1.0, 1.0, 1.0]), (903, [float("nan")] * 5), (904, [float("inf")] * 5), (905, [1.0, 2.0]), (906, [0.5] * 6)]
    df = spark.createDataFrame([x + (7, 0.5) for x in good + bad], VECTORS + ", component int, n double").repartition(7)
    _check_whitened(good, whitening.whiten(df).collect())
    twice = whitening.whiten(spark.createDataFrame([*good, (0, good[0][1]), (None, good[1][1])], VECTORS)).groupBy("vec_id").count()
    assert {r["vec_id"]: r["count"] for r in twice.filter("count > 5 or vec_id is null").collect()} == {0: 10, None: 5}
    one = whitening.whiten(spark.createDataFrame([(4, [1.0, 2.0, 3.0])], VECTORS)).collect()
    assert [(r["component"], r["n"], r["deviation"], r["whitened"], r["explained"], r["identity_error"]) for r in one] == [(c, 1, 0, None, 0.0, None) for c in (1, 2, 3)]
    assert whitening.whiten(spark.createDataFrame([], VECTORS)).collect() == [] == whitening.whiten(spark.createDataFrame(bad[:2], VECTORS)).collect()


def test_whitening_of_wide_entries(spark):
    rows = [(i, [float(10 ** (i % 13)), float(i)]) for i in range(40)]
    _check_whitened_wide = whitening.whiten(spark.createDataFrame(rows, VECTORS)).collect()
    x = [[1024 * 10 ** (i % 13) + 100_000, 1024 * i + 100_000] for i in range(40)]
    sums = [sum(c) for c in zip(*x)]
    want = {i: sum((40 * a - s) ** 2 for a, s in zip(row, sums)) for i, row in enumerate(x)}
    assert {r["vec_id"]: r["deviation"] for r in _check_whitened_wide} == {i: d if d < 2 ** 63 else None for i, d in want.items()}
    huge = whitening.whiten(spark.createDataFrame([(1, [1e300, 0.0]), (2, [-1e300, 1.0])], VECTORS)).collect()
    assert len(huge) == 4 and all(r["deviation"] is None for r in huge)


# --- mixing

def _cheapest(patterns, quota, most):
    """Brute force: most words, then least cost, one word after another along the cheapest augmenting path."""
    taken, rest, edges = Counter(), dict(quota), Counter()
    moved, cost = 0, 0
    while True:
        # Bellman-Ford over patterns and sources from every pattern with room, word by word.
        best = {("p", p): (taken[p] // patterns[p], [("p", p)]) for p in patterns if patterns[p] and taken[p] < most * patterns[p]}
        changed = True
        while changed:
            changed = False
            for p in patterns:
                for s in p:
                    for a, b, ok in ((("p", p), ("s", s), True), (("s", s), ("p", p), edges[p, s] > 0)):
                        if ok and a in best and (b not in best or best[a][0] < best[b][0]) and b not in best[a][1]:
                            best[b], changed = (best[a][0], best[a][1] + [b]), True
        ends = [(best["s", s][0], best["s", s][1]) for s in rest if rest[s] and ("s", s) in best]
        if not ends:
            return moved, cost
        c, path = min(ends, key=lambda e: e[0])
        taken[path[0][1]] += 1
        for a, b in zip(path, path[1:]):
            if a[0] == "p":
                edges[a[1], b[1]] += 1
            else:
                edges[b[1], a[1]] -= 1
        rest[path[-1][1]] -= 1
        moved, cost = moved + 1, cost + c


def test_flow_is_cheapest():
    r = random.Random(4)
    for _ in range(40):
        names = "abc"[:r.randint(1, 3)]
        patterns = {p: r.randint(0, 7) for k in range(1, len(names) + 1) for p in itertools.combinations(names, k) if r.random() < 0.8}
        quota = {s: r.randint(0, 16) for s in names}
        sent = mixing.flow(patterns, quota, 3)
        by_pattern, by_source = {p: sum(x.values()) for p, x in sent.items()}, Counter()
        for p, x in sent.items():
            assert set(x) <= set(p) and by_pattern[p] <= 3 * patterns[p]
            by_source.update(x)
        assert all(by_source[s] <= quota[s] for s in quota)
        cost = sum(k * min(patterns[p], max(0, n - k * patterns[p])) for p, n in by_pattern.items() for k in range(3))
        assert (sum(by_pattern.values()), cost) == _cheapest(patterns, quota, 3)


def test_targets():
    assert mixing.targets({"a": 100, "b": 100, None: 100}, 300, (5, 2, 1)) == {"a": 187.5, "b": 75, None: 37.5}
    got = mixing.targets({"a": 1, "b": 10, "c": 1000, "d": 0, "é": 5, None: 50}, 1066, (5, 2, 1))
    assert got["a"] == 3 and got["d"] == 0 and sum(got.values()) == 1066
    open_ = {s: got[s] / w for s, w in (("b", 2), ("c", 1), ("é", 2), (None, 1)) if got[s] < 3 * {"b": 10, "c": 1000, "é": 5, None: 50}[s]}
    assert len(set(open_.values())) == 1 and all(got[s] == 3 * n for s, n in (("b", 10), ("é", 5), (None, 50)) if s not in open_)
    assert mixing.targets({}, 0, (5, 2, 1)) == {}


def _line(rows, seed):
    """rows (id, size) of a pattern, in the line's order."""
    return sorted(rows, key=lambda x: (hashlib.md5(f"{seed}:{'' if x[0] is None else x[0]}".encode()).hexdigest(), x[1]))


def test_mixing_overlapping_sources(spark):
    r = random.Random(5)
    docs = []
    for i in range(600):
        sources = r.choice([["a"], ["a"], ["a"], ["b"], ["a", "b"], ["b", None], ["c", "b", "c"], None, []])
        n = r.choice([0, 1, 3, 10, 300 if r.random() < 0.05 else 5])
        docs.append((i, sources, " \t".join("é" + str(k) for k in range(n)) if n or r.random() < 0.5 else None))
    df = spark.createDataFrame(docs, "doc_id long, belongs array<string>, text string").repartition(5)
    got = {x["doc_id"]: x for x in mixing.mix(df, F.col("belongs"), (5, 2, 1), seed=9).collect()}
    size = {i: len((t or "").split()) for i, _, t in docs}
    key = {i: tuple(sorted(set(s or [None]), key=lambda v: (v is None, v or ""))) for i, s, _ in docs}
    patterns = Counter()
    for i in size:
        patterns[key[i]] += size[i]
    sizes, goal, sent = mixing.plan(patterns, (5, 2, 1))
    total = Counter()
    for p in patterns:  # the line written out word by word
        line = [i for i, n in _line([(i, size[i]) for i in size if key[i] == p], 9) for _ in range(n)] * 3
        at, want = 0, Counter()
        for s in p:
            for i in line[at:at + sent.get(p, {}).get(s, 0)]:
                want[i, s] += 1
            at += sent.get(p, {}).get(s, 0)
        for i in (i for i in size if key[i] == p):
            assert got[i]["size"] == size[i] and [x["source"] for x in got[i]["sources"]] == list(p)
            assert [x["taken"] for x in got[i]["sources"]] == [want[i, s] for s in p]
            assert got[i]["taken"] == sum(x["taken"] for x in got[i]["sources"]) <= 3 * size[i]
            for x in got[i]["sources"]:
                total[x["source"]] += x["taken"]
                assert (x["size"], x["target"]) == (sizes[x["source"]], float(goal[x["source"]]))
    assert all(abs(total[s] - goal[s]) <= 1 for s in sizes)


def test_mixing_odd_rows(spark, odd_docs, no_docs):
    a, b = ([tuple(r) for r in mixing.mix(d, F.array("source"), (5, 2, 1)).select("doc_id", "size", "taken").orderBy("doc_id", "size").collect()]
            for d in (odd_docs, odd_docs.repartition(3)))
    assert a == b and len(a) == 12
    assert all(t <= 3 * n for _, n, t in a)
    assert [x for x in a if x[0] in (1, 2)] == [(1, 0, 0), (2, 0, 0)]
    assert mixing.mix(no_docs, F.array("source"), (5, 2, 1)).collect() == []
    same = spark.createDataFrame([(7, "a b c", "s")] * 500 + [(8, "a b", "t")] * 10, "doc_id long, text string, source string")  # one row, many times
    got = mixing.mix(same, F.array("source"), (1, 3))
    assert {(r["doc_id"], r["taken"]) for r in got.select("doc_id", "taken").distinct().collect()} == {(7, 2), (8, 6)}  # 1460 words of 500 rows, 60 of 10


def test_mixing_on_the_table(spark, mid):
    rows = queries.op12_source_mixing(spark, mid).collect()
    names = {r["doc_id"]: r["source"] for r in spark.read.parquet(f"{mid}/documents.parquet").collect()}
    taken, target = Counter(), {}
    for r in rows:
        taken[names[r["doc_id"]]] += r["taken"]
        target[names[r["doc_id"]]] = r["target"]
    assert all(abs(taken[s] - target[s]) <= 0.5 for s in target) and len(rows) == len(names)


# --- conversation trie

def _whole(rows):
    own = defaultdict(list)
    for c, turn, role, text in rows:
        if c is not None:
            own[c].append((turn is not None, turn or 0, role or "", text or ""))
    order = lambda t: (*t[:3], hashlib.sha256(f"{len(t[2])}:{t[2]}{t[3]}".encode()).hexdigest()[:32])
    own = {c: [t[2:] for t in sorted(ts, key=order)] for c, ts in own.items()}
    h = {c: crc32(str(c).encode()) % 6 for c in own}
    return {c: own.get(int(c - np.fmod(c, 100)), [])[:h[c]] + ts[h[c]:] for c, ts in own.items()}


def _nodes(rows):
    whole = _whole(rows)
    members, ends = defaultdict(list), defaultdict(list)
    for c, ts in whole.items():
        for d in range(len(ts) + 1):
            members[tuple(ts[:d])].append(c)
        ends[tuple(ts)].append(c)
    kids = Counter(p[:-1] for p in members if p)
    leaves, saved = Counter(), Counter()
    for p, m in members.items():
        for d in range(len(p) + 1):
            leaves[p[:d]] += not kids[p]
            saved[p[:d]] += (len(m) - 1) * (len(p[-1][1]) if p else 0)
    return sorted((min(m), len(p), min(members[p[:-1]]) if p else -1, len(m), kids[p], leaves[p], saved[p],
                   hashlib.sha256(",".join(map(str, sorted(ends[p]))).encode()).hexdigest()) for p, m in members.items())


TURNS = "conv_id long, turn long, role string, text string"


def _got(spark, rows):
    df = spark.createDataFrame([r + (1, b"x", 2) for r in rows], TURNS + ", depth int, path binary, n_convs int").repartition(5)
    out = conversation_trie.nodes(conversation_trie.rebuilt(df))
    return sorted((r["conv_id"], r["depth"], -1 if r["parent_conv_id"] is None else r["parent_conv_id"], r["n_convs"], r["n_children"], r["n_leaves"], r["saved_tokens"],
                   r["ends_sha256"]) for r in out.collect())


def _conversations(r, n, depth=9, texts=3):
    return [(c, t, r.choice(["user", "assistant"]) if t < 2 else "user", r.choice(["ä", "bb", "c\U0001f600c", "", None][:texts]))
            for c in range(n) for t in range(r.randrange(depth))]


@pytest.mark.parametrize("block,parts", [(200_000, 8), (1, 3), (40, 1), (7, 16)])
def test_trie_against_brute_force(spark, monkeypatch, block, parts):
    """Any cut into shards gives the same nodes; few texts, so that many prefixes are shared and some conversations equal."""
    monkeypatch.setattr(conversation_trie, "BLOCK", block)
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", parts)
    try:
        rows = _conversations(random.Random(block), 350)
        assert _got(spark, rows) == _nodes(rows)
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)


def test_trie_of_hot_conversation_and_odd_rows(spark):
    r = random.Random(8)
    hot = [(c, t, "user", f"same {t}") for c in range(0, 6000, 3) for t in range(3)]  # ids in several blocks
    odd = [(None, 1, "user", "x"), (7001, None, None, None), (7001, 1, "user", ""), (7001, 1, "user", ""), (7001, 1, "user", "b"), (7001, 1, "assistant", "b"), (-205, 0, "user", "n"),
           (-200, 0, "user", "m"), (-200, 1, "user", "m2"), (7200, 0, "user", "x" * 50_000), *[(7300, t, "user", f"t{t}") for t in range(700)],
           *[(c, 0, "a", "only turn") for c in range(7301, 7330)]]  # some of these lose their only turn and get none
    rows = hot + odd + [(c + 8000, *t) for c, *t in _conversations(r, 120, texts=5)]
    assert _got(spark, rows) == _nodes(rows)


def test_trie_empty(spark):
    assert _got(spark, []) == [] == _got(spark, [(None, 0, "user", "x")])
    only = [(101, 0, "user", "x")]  # h of 101 is over 0 and conversation 100 is absent: the root alone
    assert crc32(b"101") % 6 > 0 and _got(spark, only) == _nodes(only) and len(_got(spark, only)) == 1


def test_double_array_walks_every_path():
    r = np.random.default_rng(6)
    for codes, n in ((2, 300), (50, 300), (5000, 300), (1, 40)):
        seqs = sorted({tuple(r.integers(0, codes, r.integers(0, 8)).tolist()) for _ in range(n)})
        edges = sorted({s[:d + 1] for s in seqs for d in range(len(s))}, key=len)
        number = {(): 0, **{p: i + 1 for i, p in enumerate(edges)}}
        trie = conversation_trie.DoubleArray(np.array([number[p[:-1]] for p in edges], np.int64), np.array([p[-1] for p in edges], np.int64))
        offsets = np.append(0, np.cumsum([len(s) for s in seqs]))
        slots = trie.walk(np.array([c for s in seqs for c in s], np.int64), offsets)
        by_node = defaultdict(set)
        for s, a in zip(seqs, offsets):
            for d in range(len(s)):
                by_node[s[:d + 1]].add(int(slots[a + d]))
        assert all(len(v) == 1 for v in by_node.values()) and len(set.union(set(), *by_node.values())) == len(edges) == (trie.check >= 0).sum()
        assert trie.size <= 4 * len(edges) + 2 * codes + 2
