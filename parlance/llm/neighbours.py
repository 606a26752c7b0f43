"""Approximate nearest neighbours: a forest of random-projection trees searched through one shared priority queue.

Trees are fitted on the driver on a bounded sample (``SAMPLE`` vectors, by hash of the id): each node splits its vectors
at the median of their projections on the difference of two of them.  Every vector is filed in one leaf of each tree.
A query walks all trees through a single priority queue, the least margin first, until the leaves it has met hold
``share`` of the vectors (counted once for each tree); their vectors are ranked by the exact measure.

For the largest inner product, vectors are given one more component that makes their lengths equal, which turns
the largest inner product into the smallest distance; scores are computed on the original vectors in double precision.

Leaves and the queries that visit them are dealt out in blocks of at most about ``BLOCK`` vectors by ``BLOCK`` queries, so a leaf
that holds a third of all vectors is many blocks.  The driver holds the sample, the trees and
the leaves' counts (leaves of ``LEAF`` vectors, at most about ``2 * MAX_LEAVES`` a tree, so that a query's visits do not grow with
the table; more leaves and a smaller ``share`` suit vectors with structure).

Defined results: vectors null, zero, empty or holding null or non-finite components take no part, nor do null ids or vectors of
another length than the most common one; a query never meets a row of its own id; rows equal in id and vector count
once, and queries equal in id are answered together; an empty table gives no rows.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from parlance.llm.common import durable

TREES, LEAF, MAX_LEAVES, SAMPLE, BLOCK = 8, 512, 32, 65_536, 4096


@dataclass
class Tree:
    normal: np.ndarray  # (nodes, dims)
    middle: np.ndarray
    child: np.ndarray  # (nodes, 2); a leaf n is written as -1 - n
    leaves: int

    @classmethod
    def grown(cls, x: np.ndarray, leaf: float, r: np.random.Generator) -> Tree:
        normal, middle, child, leaves = [], [], [], 0
        todo = [(np.arange(len(x)), None, 0)]
        while todo:
            rows, parent, side = todo.pop()
            a, b = x[r.choice(rows, 2, replace=len(rows) < 2)] if len(rows) else (x[:1].sum(0), x[:1].sum(0))
            w = a - b
            p = x[rows] @ w
            m = np.median(p) if len(rows) else 0.0
            low = p <= m
            if len(rows) <= leaf or low.all():  # equal vectors stay together
                me, leaves = -1 - leaves, leaves + 1
            else:
                me = len(normal)
                normal.append(w / np.linalg.norm(w)), middle.append(m / np.linalg.norm(w)), child.append([0, 0])
                todo += [(rows[low], me, 0), (rows[~low], me, 1)]
            if parent is not None:
                child[parent][side] = me
        dims = x.shape[1]
        return cls(np.array(normal).reshape(-1, dims), np.array(middle), np.array(child, np.int64).reshape(-1, 2), leaves)

    def leaf_of(self, x: np.ndarray) -> np.ndarray:
        node = np.zeros(len(x), np.int64) if len(self.normal) else np.full(len(x), -1)
        while (inner := np.flatnonzero(node >= 0)).size:
            n = node[inner]
            above = (x[inner] * self.normal[n]).sum(1) > self.middle[n]
            node[inner] = self.child[n, above.astype(int)]
        return -1 - node


def visited(trees: list[Tree], counts: list[np.ndarray], q: np.ndarray, want: float) -> list[tuple[int, int]]:
    """(tree, leaf) pairs that a query visits, through one priority queue over all trees."""
    side = [t.normal @ q - t.middle for t in trees]
    queue = [(-np.inf, k, 0 if len(t.normal) else -1) for k, t in enumerate(trees)]
    heapq.heapify(queue)
    out, held = [], 0
    while queue and held < want:
        worst, k, node = heapq.heappop(queue)
        if node < 0:
            if counts[k][-1 - node]:
                out.append((k, -1 - node))
                held += counts[k][-1 - node]
            continue
        margin = side[k][node]
        for child, m in zip(trees[k].child[node].tolist(), (margin, -margin)):  # m > 0: the query is on the other side
            heapq.heappush(queue, (max(worst, m), k, child))
    return out


def usable(vector: Column) -> Column:
    good = F.forall(vector, lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) < float("inf")))
    return vector.isNotNull() & good & F.exists(vector, lambda v: v != 0)


def search(rows: DataFrame, is_query: Column, k: int = 20, share: float = 1.2, id_column: str = "vec_id", vector_column: str = "embedding",
           trees: int = TREES, leaf: int = LEAF, sample: int = SAMPLE, max_leaves: int = MAX_LEAVES) -> DataFrame:
    """(query_id, rank, id_column, score): the ``k`` best found for each row where ``is_query``, by largest inner product."""
    empty = f"query_id long, rank int, {id_column} long, score double"
    spark = rows.sparkSession
    base = (rows.filter(F.col(id_column).isNotNull() & usable(F.col(vector_column)))
            .select(F.col(id_column).cast("long").alias("id"), F.col(vector_column).cast("array<double>").alias("v"), F.coalesce(is_query, F.lit(False)).alias("q")))
    dims = base.groupBy(F.size("v").alias("d")).count().orderBy(F.desc("count"), "d").first()
    if dims is None:
        return spark.createDataFrame([], empty)
    base, total = base.filter(F.size("v") == dims["d"]), dims["count"]
    longest = base.agg(F.max(F.aggregate("v", F.lit(0.0), lambda a, x: a + x * x))).first()[0]
    part = min(1.0, sample / total)
    taken = (base.withColumn("h", F.pmod(F.xxhash64("id", "v"), F.lit(1_000_000))).filter(F.col("h") < int(part * 1_000_000) + 1)
             .select("id", "v").limit(2 * sample).toPandas().sort_values("id"))
    fitted = _longer(np.array(taken["v"].tolist(), float).reshape(-1, dims["d"]), longest)
    r = np.random.default_rng(5)
    size = max(leaf, total / max_leaves) * len(fitted) / total
    grown = [Tree.grown(fitted, size, r) for _ in range(trees)]
    forest = spark.sparkContext.broadcast([(t.normal, t.middle, t.child, t.leaves) for t in grown])  # bounded by the sample

    def file(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        grown = [Tree(*t) for t in forest.value]
        for b in batches:
            x = _longer(np.array(b.column("v").to_pylist(), float).reshape(-1, dims["d"]), longest)
            for t, tree in enumerate(grown):
                yield pa.RecordBatch.from_arrays([pa.array(np.full(len(x), t, np.int32)), pa.array(tree.leaf_of(x).astype(np.int32)), b.column("id"), b.column("v")], ["tree", "leaf", "id", "v"])

    filed = durable(base.select("id", "v").mapInArrow(file, "tree int, leaf int, id long, v array<double>"))
    held = filed.groupBy("tree", "leaf").agg(F.count("*").alias("n")).toPandas()
    counts = [np.zeros(t.leaves, np.int64) for t in grown]
    for t, n, c in held.itertuples(index=False):
        counts[t][n] = c

    def probe(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        grown = [Tree(*t) for t in forest.value]
        for b in batches:
            for i, v in zip(b.column("id").to_pylist(), b.column("v").to_pylist()):
                met = visited(grown, counts, np.append(v, 0.0), share * total)
                yield pa.RecordBatch.from_arrays([pa.array([t for t, _ in met], pa.int32()), pa.array([n for _, n in met], pa.int32()), pa.array([i] * len(met), pa.int64()),
                                                  pa.array([v] * len(met), pa.list_(pa.float64()))], ["tree", "leaf", "query_id", "w"])

    queries = base.filter("q").select("id", "v").repartition(F.xxhash64("id"))
    visits = durable(queries.mapInArrow(probe, "tree int, leaf int, query_id long, w array<double>"))
    asked = visits.groupBy("tree", "leaf").agg(F.count("*").alias("m")).toPandas()
    both = held.merge(asked, on=["tree", "leaf"])
    blocks = spark.createDataFrame(pd.DataFrame({"tree": both["tree"].astype("int32"), "leaf": both["leaf"].astype("int32"), "rows": -(-both["n"] // BLOCK), "asks": -(-both["m"] // BLOCK)}),
                                   "tree int, leaf int, rows long, asks long")  # a row a leaf
    sizes = F.broadcast(blocks)
    stored = (filed.join(sizes, ["tree", "leaf"]).withColumn("r", F.pmod(F.xxhash64("id", "v"), "rows"))
              .withColumn("c", F.explode(F.sequence(F.lit(0).cast("long"), F.col("asks") - 1))).select("tree", "leaf", "r", "c", "id", "v"))
    asking = (visits.join(sizes, ["tree", "leaf"]).withColumn("c", F.pmod(F.xxhash64("query_id", F.lit(3)), "asks"))
              .withColumn("r", F.explode(F.sequence(F.lit(0).cast("long"), F.col("rows") - 1))).select("tree", "leaf", "r", "c", "query_id", "w"))

    def best(rows: pd.DataFrame, asks: pd.DataFrame) -> pd.DataFrame:
        if rows.empty or asks.empty:
            return pd.DataFrame({"query_id": [], "id": [], "score": []})
        rows = rows.sort_values("id", kind="stable")
        rows = rows[~pd.DataFrame({"id": rows["id"], "v": [x.tobytes() for x in rows["v"]]}).duplicated().to_numpy()]
        x, ids, out = np.array(rows["v"].tolist()), rows["id"].to_numpy(), []
        longest = np.sqrt((x * x).sum(1).max())
        for at in range(0, len(asks), 512):
            q, w = asks["query_id"].to_numpy()[at:at + 512], np.array(asks["w"].iloc[at:at + 512].tolist())
            near = w @ x.T
            near[q[:, None] == ids] = -np.inf
            slack = 1e-12 * x.shape[1] * longest * np.sqrt((w * w).sum(1))  # far over what the order of adding up can change
            low = np.partition(near, -k, axis=1)[:, -k] - slack if len(ids) > k else np.full(len(q), -np.inf)
            i, j = np.nonzero((near >= low[:, None]) & (near > -np.inf))
            exact = (x[j] * w[i]).sum(1)  # one way of adding up, whatever the block
            order = np.lexsort((ids[j], -exact, i))
            i, j, exact = i[order], j[order], exact[order]
            keep = np.arange(len(i)) - np.searchsorted(i, i) < k  # ties go to smaller ids
            out.append(pd.DataFrame({"query_id": q[i[keep]], "id": ids[j[keep]], "score": exact[keep]}))
        return pd.concat(out)

    keys = ["tree", "leaf", "r", "c"]
    found = stored.groupBy(*keys).cogroup(asking.groupBy(*keys)).applyInPandas(best, "query_id long, id long, score double")
    top = found.groupBy("query_id").agg(F.collect_set(F.struct((-F.col("score")).alias("s"), "id")).alias("all"))  # k for each block met
    return (top.select("query_id", F.posexplode(F.slice(F.array_sort("all"), 1, k)).alias("p", "b"))
            .select("query_id", (F.col("p") + 1).cast("int").alias("rank"), F.col("b.id").alias(id_column), (-F.col("b.s")).alias("score")))


def _longer(x: np.ndarray, longest: float) -> np.ndarray:
    return np.column_stack([x, np.sqrt(np.maximum(longest - (x * x).sum(1), 0))])
