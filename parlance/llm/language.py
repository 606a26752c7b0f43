"""Language identification with hyperdimensional profiles.

Every letter has a random vector of +1 and -1 (drawn from a seed and the letter).  A run of three letters
(a space stands for what parts words) is bound to one vector: the product of its letters' vectors, the first permuted
(rolled) twice and the second once.  A text is the bundle (sum) of the vectors of its runs, a language
the bundle of all its training texts; a text gets the language with the largest cosine.

The training bundles are sums over all training rows: each task adds up its own, Spark adds up the tasks',
and only the finished prototypes (languages x ``dims`` numbers) reach the driver.

Defined results: a null text or one without a letter is ``und`` with score 0; with no training rows every
text is ``und``; equal cosines go to the language that sorts first; repeated rows and null ids keep their
rows (a null id is in no fold: neither learnt from nor held out); other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

DIMS, SEED = 1024, 20_240_601
_SHIFT = 21  # bits of a code point


class Runs:
    """Vectors of letter runs, made when first met and kept for the task."""

    def __init__(self, dims: int, keep: int = 60_000):
        self.dims, self.keep, self.letters = dims, keep, {}
        self.codes, self.vectors = np.zeros(0, np.int64), np.zeros((0, dims), np.int8)

    def letter(self, point: int) -> np.ndarray:
        if point not in self.letters:
            self.letters[point] = np.random.default_rng([SEED, point]).integers(0, 2, self.dims, dtype=np.int8) * 2 - 1
        return self.letters[point]

    def of(self, codes: np.ndarray) -> np.ndarray:
        """Vectors of sorted distinct run codes."""
        new = np.setdiff1d(codes, self.codes, assume_unique=True)
        if len(new):
            if len(self.codes) + len(new) > self.keep:  # bounded memory: start again with what is asked for
                self.codes, self.vectors, new = np.zeros(0, np.int64), np.zeros((0, self.dims), np.int8), codes
            mask = (1 << _SHIFT) - 1
            made = np.empty((len(new), self.dims), np.int8)
            for i, c in enumerate(new.tolist()):
                a, b, z = c >> 2 * _SHIFT, c >> _SHIFT & mask, c & mask
                made[i] = np.roll(self.letter(a), 2) * np.roll(self.letter(b), 1) * self.letter(z)
            order = np.argsort(all_codes := np.concatenate([self.codes, new]))
            self.codes, self.vectors = all_codes[order], np.concatenate([self.vectors, made])[order]
        return self.vectors[np.searchsorted(self.codes, codes)]


def run_counts(texts: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(text number, run code, count), sorted by text, of the letter runs of each whole text."""
    clean = pc.replace_substring_regex(pc.utf8_lower(pc.fill_null(texts.cast(pa.large_string()), "")), r"\P{L}+", " ")
    framed = [f" {t} " for t in pc.utf8_trim(clean, " ").to_pylist()]
    points = np.frombuffer("".join(framed).encode("utf-32-le"), "<u4").astype(np.int64)
    ends = np.cumsum([len(t) for t in framed])
    text = np.repeat(np.arange(len(framed)), np.diff(ends, prepend=0))
    if len(points) < 3:
        return (np.zeros(0, np.int64),) * 3
    code = points[:-2] << 2 * _SHIFT | points[1:-1] << _SHIFT | points[2:]
    inside = (text[:-2] == text[2:]) & (points[1:-1] != 32)  # a run that has its middle in a word
    distinct, which = np.unique(code[inside], return_inverse=True)
    pair, count = np.unique(text[:-2][inside] * max(len(distinct), 1) + which, return_counts=True)
    return pair // max(len(distinct), 1), distinct[pair % max(len(distinct), 1)], count


def bundles(texts: pa.Array, runs: Runs, block: int = 128) -> Iterator[tuple[int, np.ndarray]]:
    """(first text, their bundled vectors) for blocks of texts."""
    for at in range(0, len(texts), block):
        part = texts.slice(at, block)
        text, code, count = run_counts(part)
        out = np.zeros((len(part), runs.dims), np.float32)
        distinct, which = np.unique(code, return_inverse=True)
        for lo in range(0, len(distinct), 4096):
            use = (which >= lo) & (which < lo + 4096)
            grid = np.zeros((len(part), min(4096, len(distinct) - lo)), np.float32)
            grid[text[use], which[use] - lo] = count[use]
            out += grid @ runs.of(distinct[lo:lo + 4096]).astype(np.float32)
        yield at, out


def prototypes(rows: DataFrame, dims: int = DIMS) -> tuple[list[str], np.ndarray]:
    """Bundle ``rows(text, lang)`` into one vector a language: (languages, vectors)."""
    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        runs, sums = Runs(dims), {}
        for b in batches:
            langs = b.column("lang").to_pylist()
            for at, vectors in bundles(b.column("text"), runs):
                names = np.array(langs[at:at + len(vectors)], dtype=object)
                for lang in set(names):
                    sums[lang] = sums.get(lang, 0) + vectors[names == lang].sum(0, dtype=np.float64)
        for lang, v in sums.items():
            yield pa.RecordBatch.from_arrays([pa.array([lang] * dims), pa.array(range(dims), pa.int32()), pa.array(v)], ["lang", "dim", "v"])

    summed = (rows.select("text", "lang").filter("lang is not null and text is not null")
              .mapInArrow(add, "lang string, dim int, v double").groupBy("lang", "dim").agg(F.sum("v").alias("v")).toPandas())
    if summed.empty:
        return [], np.zeros((0, dims))
    wide = summed.pivot(index="lang", columns="dim", values="v").sort_index()
    return [str(x) for x in wide.index], wide.to_numpy()


def identify(docs: DataFrame, langs: list[str], vectors: np.ndarray, id_column: str = "doc_id", keep: dict[str, Column] | None = None) -> DataFrame:
    """(id_column, *keep, lang_pred, score): one row for each row of ``docs``; score is the cosine, 0 at least."""
    dims = vectors.shape[1]
    unit = (vectors / np.maximum(np.linalg.norm(vectors, axis=1, keepdims=True), 1e-12)).astype(np.float32)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        runs = Runs(dims)
        for b in batches:
            best, score = np.full(b.num_rows, -1), np.zeros(b.num_rows)
            if langs:
                for at, v in bundles(b.column("__text"), runs):
                    size = np.linalg.norm(v, axis=1)
                    cos = v @ unit.T / np.maximum(size, 1e-12)[:, None]
                    best[at:at + len(v)] = np.where(size > 0, cos.argmax(1), -1)
                    score[at:at + len(v)] = np.where(size > 0, np.clip(cos.max(1), 0, 1), 0)
            names = pa.array([langs[i] if i >= 0 else "und" for i in best], pa.string())
            kept = [c for i, c in enumerate(b.columns) if b.schema.names[i] != "__text"]
            yield pa.RecordBatch.from_arrays([*kept, names, pa.array(score)], [*[n for n in b.schema.names if n != "__text"], "lang_pred", "score"])

    taken = docs.select(F.col(id_column), *[c.alias(n) for n, c in (keep or {}).items()], F.col("text").cast("string").alias("__text"))
    schema = ", ".join(f"`{n}` {t}" for n, t in taken.dtypes if n != "__text") + ", lang_pred string, score double"
    return taken.mapInArrow(run, schema)
