"""Helpers shared by the operators: table access, folds, durable intermediates, word batches, components."""

from __future__ import annotations

import io
from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from parlance.session import ensure_checkpoint_dir


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def fold(doc_id: str, mod: int) -> Column:
    """crc32 of the id's text modulo ``mod``; null for a null id (which is in no fold)."""
    return F.crc32(F.col(doc_id).cast("string")) % mod


def durable(df: DataFrame) -> DataFrame:
    """Cut the lineage with a reliable checkpoint in the shared folder."""
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def with_row_id(df: DataFrame, *columns: str) -> DataFrame:
    """The named columns plus ``rid``, a row number that survives repeated and null ids.

    The result is checkpointed, so every later use sees the same numbers even if an executor is lost.
    """
    return durable(df.select(*columns).withColumn("rid", F.monotonically_increasing_id()))


def labelled_sample(docs: DataFrame, labels: DataFrame, label: str, keep: Column, most: int) -> DataFrame:
    """(text, y) of about ``most`` labelled rows, picked by a hash of the id among those that ``keep`` allows.

    Only the ids and labels of the sample, at most ``2 * most`` rows, are broadcast, so the texts of
    ``docs`` are not shuffled.  Several labels of one id are averaged (1 from one half on), of several texts of one id
    the least takes part; null ids and null labels take no part.
    """
    known = (labels.filter(F.col("doc_id").isNotNull() & F.col(label).isNotNull() & keep)
             .groupBy("doc_id").agg((F.avg(label) >= 0.5).cast("int").alias("y")))
    n = known.count()
    share = int(1_000_000 * min(1.0, most / max(n, 1)))
    picked = (known.withColumn("h", F.pmod(F.xxhash64("doc_id"), F.lit(1_000_000)))
              .filter(F.col("h") < share).orderBy("h", "doc_id").limit(2 * most).select("doc_id", "y"))
    return (docs.select("doc_id", "text").join(F.broadcast(picked), "doc_id")
            .groupBy("doc_id", "y").agg(F.min("text").alias("text")).select("doc_id", "text", "y"))


def fitted(sample: DataFrame, train: Callable[[list[str], np.ndarray], dict[str, np.ndarray]]) -> dict[str, np.ndarray]:
    """``train(texts, labels)`` over a bounded ``sample(doc_id, text, y)``, run as one Spark task: a lost executor costs a
    retry, and the driver gets the named weight arrays alone."""
    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        rows = pd.concat([pd.DataFrame({"doc_id": [], "text": [], "y": []}), *frames]).sort_values(["doc_id", "text"])
        np.savez(out := io.BytesIO(), **train(rows["text"].tolist(), rows["y"].to_numpy(np.int64)))
        yield pd.DataFrame({"weights": [out.getvalue()]})

    row = sample.select("doc_id", "text", "y").repartition(1).mapInPandas(run, "weights binary").first()
    if row is None:  # no rows, no task
        return train([], np.zeros(0, np.int64))
    with np.load(io.BytesIO(row[0])) as made:
        return {k: made[k] for k in made.files}


def split_words(texts: pa.Array) -> tuple[list[str], np.ndarray, np.ndarray]:
    """Lower-cased runs of letters and digits of each text: distinct words, their codes, and offsets by text."""
    t = pc.replace_substring_regex(pc.utf8_lower(pc.fill_null(texts.cast(pa.large_string()), "")),
                                   r"[^\p{L}\p{N}]+", " ")
    return _coded(pc.split_pattern(pc.utf8_trim(t, " "), " "))


def split_on_space(texts: pa.Array) -> tuple[list[str], np.ndarray, np.ndarray]:
    """As ``split_words`` but for the raw runs between ASCII white space, in their own case."""
    return _coded(pc.ascii_split_whitespace(pc.fill_null(texts.cast(pa.large_string()), "")))


def _coded(lists: pa.Array) -> tuple[list[str], np.ndarray, np.ndarray]:
    offsets = lists.offsets.to_numpy().astype(np.int64)
    offsets = offsets - offsets[0]
    coded = lists.flatten().dictionary_encode()
    codes, words = coded.indices.to_numpy(zero_copy_only=False).astype(np.int64), coded.dictionary.to_pylist()
    if "" in words:
        keep = codes != words.index("")
        words[words.index("")] = " "  # no code refers to it any more
        offsets = np.concatenate([[0], np.cumsum(keep)])[offsets]
        codes = codes[keep]
    return words, codes, offsets


def letters(words: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Code points of all words, one after another, and the length of each word."""
    return np.frombuffer("".join(words).encode("utf-32-le", "surrogatepass"), "<u4"), np.fromiter(map(len, words), np.int64, len(words))


def mixed(h: np.ndarray, rows: int) -> np.ndarray:
    """64-bit numbers spread over ``rows`` table rows."""
    h = (h ^ (h >> np.uint64(31))) * np.uint64(0x9E3779B97F4A7C15)
    return ((h >> np.uint64(32)) % np.uint64(rows)).astype(np.int64)


def word_hashes(words: list[str]) -> np.ndarray:
    """A 64-bit number for each word, the same in every task."""
    if not words:
        return np.zeros(0, np.uint64)
    points, size = letters(words)
    start = np.cumsum(size) - size
    place = np.arange(len(points)) - np.repeat(start, size)
    power = np.multiply.accumulate(np.append(np.uint64(1), np.full(size.max(), 0x100000001B3, np.uint64)))
    return scrambled(np.add.reduceat((points.astype(np.uint64) + np.uint64(1)) * power[place], start))


def scrambled(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


def hashed_at(tokens: np.ndarray, at: np.ndarray, picks: list[int], salt: int = 0) -> np.ndarray:
    """Hash of the tokens at ``at + p`` for the picked offsets."""
    power, out = np.uint64(0x9E3779B97F4A7C15), np.full(len(at), salt, np.uint64)
    for p in picks:
        out = out * power + tokens[at + p]
    return scrambled(out)


def rows_of(offsets: np.ndarray) -> np.ndarray:
    """The text each word belongs to."""
    return np.repeat(np.arange(len(offsets) - 1), np.diff(offsets))


def components(edges: DataFrame) -> DataFrame:
    """Connected components of ``edges(a, b)``: rows (node, root), root the smallest node of its component.

    Alternating large-star and small-star steps; a step is a minimum by node and a join, so a hub is
    never gathered into one group, and the number of steps is logarithmic in the longest path.
    """
    def star(e: DataFrame, large: bool) -> DataFrame:
        if large:
            e = e.union(e.select(F.col("b").alias("a"), F.col("a").alias("b")))
        else:
            e = e.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
        low = e.groupBy("a").agg(F.min("b").alias("m")).withColumn("m", F.least("a", "m"))
        joined = e.join(low, "a")
        if large:
            out = joined.filter("b > a").select(F.col("b").alias("a"), F.col("m").alias("b"))
        else:
            out = joined.select(F.col("b").alias("a"), F.col("m").alias("b")).union(low.select("a", F.col("m").alias("b")))
        return out.filter("a != b").distinct()

    e, seen = durable(edges.select("a", "b").filter("a != b").distinct()), None
    while True:
        e = durable(star(star(e, True), False))
        now = tuple(e.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first())
        if now == seen:
            break
        seen = now
    return e.groupBy("a").agg(F.min("b").alias("root")).select(F.col("a").alias("node"), "root")
