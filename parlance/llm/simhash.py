"""SimHash near-duplicate detection by segment-popcount embedding.

1. ``fingerprints``: the 64-bit SimHash of each whole text.
2. ``links``: each distinct fingerprint becomes a point, the bit counts of its 16 four-bit segments.
   The Manhattan distance of two points is at most their Hamming distance, so the fingerprints within 2 bits
   lie within Manhattan distance 2: they share a grid cell at distance 1 or less from both.  Each point is
   entered in its own cell and the 32 next to it; equal cells are joined and the pairs verified bit by bit.
3. ``near_duplicates``: connected components of the links.

A cell that holds more than ``cell_limit`` distinct fingerprints is not paired up.  Its members take an
exact way of linear cost: each is entered under itself and its 64 one-bit changes, and all that share
such a key are within 2 bits of each other, so they are linked to the smallest of them (a key has 65 members
at most).  No link is lost, and the pairs that a cell makes are bounded.

Defined results: a null or empty text counts as a text without words, with fingerprint zero; repeated
rows and null ids keep their rows; ``component_id`` is the smallest non-null id of the component, null if
it has none; an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import accumulate

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from xxhash import xxh64_intdigest

from parlance.llm.common import components, durable

SEED = 42
SEGMENTS, SEGMENT_BITS = 16, 4


def fingerprint(text: str | None, words: int) -> int:
    """SimHash of one text, as a signed 64-bit number."""
    ws = (text or "").encode().lower().split()
    if not ws:
        return 0
    joined = b" ".join(ws)
    ends = list(accumulate(len(w) + 1 for w in ws))
    k = min(words, len(ws))
    starts = [0, *ends]
    h = np.array([xxh64_intdigest(joined[a:b - 1], SEED) for a, b in zip(starts, ends[k - 1:])], dtype="<u8")
    counts = np.zeros(64, dtype=np.int64)
    for part in np.array_split(h, len(h) // 65_536 + 1):  # bounded memory for very long texts
        counts += np.unpackbits(part.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(0, dtype=np.int64)
    bits = (2 * counts > len(h)).astype(np.uint8)
    return int(np.packbits(bits, bitorder="little").view("<i8")[0])


def fingerprints(docs: DataFrame, words: int = 3, keep: tuple[str, ...] = ()) -> DataFrame:
    """(doc_id, fp) and the long columns ``keep``: one row for each row of ``docs``."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            fps = [fingerprint(t.as_py(), words) for t in b.column("text")]
            yield pa.RecordBatch.from_arrays([b.column("doc_id"), pa.array(fps, pa.int64()), *[b.column(k) for k in keep]], ["doc_id", "fp", *keep])

    return docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string"), *keep).mapInArrow(run, ", ".join(f"{c} long" for c in ("doc_id", "fp", *keep)))


def _cells(fps: DataFrame) -> DataFrame:
    """(cell, fp): each fingerprint under the cells at Manhattan distance 1 or less."""
    own = " + ".join(
        f"shiftleft(cast(bit_count(shiftrightunsigned(fp, {SEGMENT_BITS * i}) & {2 ** SEGMENT_BITS - 1}) as bigint), {3 * i})"
        for i in range(SEGMENTS))
    near = ", ".join(["0L", *(f"{s}{8 ** i}L" for i in range(SEGMENTS) for s in ("", "-"))])
    return fps.selectExpr("fp", f"{own} as own").selectExpr("fp", "own", f"explode(array({near})) as step").selectExpr("own + step as cell", "fp")


def _verified(cells: DataFrame, bits: int) -> DataFrame:
    a, b = cells.select("cell", F.col("fp").alias("a")), cells.select("cell", F.col("fp").alias("b"))
    close = (F.col("a") < F.col("b")) & (F.bit_count(F.col("a").bitwiseXOR(F.col("b"))) <= bits)
    return a.join(b, (a["cell"] == b["cell"]) & close).select("a", "b")


def links(fps: DataFrame, max_bits: int = 2, cell_limit: int = 128) -> DataFrame:
    """Edges (a, b) that connect all distinct fingerprints ``fps(fp)`` within ``max_bits`` (at most 2)."""
    if not 0 <= max_bits <= 2:
        raise ValueError("the cells cover distances of up to 2 bits")
    cells = _cells(fps)
    full = cells.groupBy("cell").agg(F.count("*").alias("n")).filter("n > 1")
    shared = durable(cells.join(full, "cell"))
    pairs = _verified(shared.filter(F.col("n") <= cell_limit), max_bits)
    flipped = _flips(shared.filter(F.col("n") > cell_limit).select("fp").distinct())
    if max_bits == 2:  # all members of a key are within 2 bits of each other
        low = flipped.groupBy("cell").agg(F.min("fp").alias("a"))
        crowd = flipped.join(low, "cell").select("a", F.col("fp").alias("b"))
    else:  # a key has 65 members at most
        crowd = _verified(flipped, max_bits)
    return pairs.union(crowd.filter("a != b")).distinct()


def _flips(fps: DataFrame) -> DataFrame:
    ones = ", ".join(["0L", *(f"shiftleft(1L, {i})" for i in range(64))])
    return fps.selectExpr("fp", f"explode(array({ones})) as flip").selectExpr("fp ^ flip as cell", "fp")


def grouped(docs: DataFrame, words: int = 3, max_bits: int = 2, cell_limit: int = 128, keep: tuple[str, ...] = ()) -> DataFrame:
    """(fp, doc_id, *keep, component_id, root): one row for each row of ``docs``; ``root`` names the component also where ids repeat."""
    prints = durable(fingerprints(docs, words, keep))
    fps = durable(prints.groupBy("fp").agg(F.min("doc_id").alias("first_id")))
    roots = components(links(fps.select("fp"), max_bits, cell_limit))
    rooted = fps.join(roots, fps["fp"] == roots["node"], "left").select("fp", "first_id", F.coalesce("root", "fp").alias("root"))
    rooted = durable(rooted)
    lowest = rooted.groupBy("root").agg(F.min("first_id").alias("component_id"))
    named = rooted.join(lowest, "root").select("fp", "component_id", "root")
    return prints.join(named, "fp", "left")


def near_duplicates(docs: DataFrame, words: int = 3, max_bits: int = 2, cell_limit: int = 128) -> DataFrame:
    """(doc_id, fingerprint, component_id): one row for each row of ``docs``."""
    return (grouped(docs, words, max_bits, cell_limit)
            .select("doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id"))
