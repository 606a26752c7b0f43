"""Quality classifier by attention-based multiple-instance learning.

A text is a bag of passages of ``PASSAGE`` words that cover it whole.  Each passage is encoded (shares of letter
cases, digits, symbols and marks, word lengths, repetition; then a dense layer), gated attention
(``tanh(V h) * sigmoid(U h)``) learnt from the labels of whole texts weighs the passages, and a logistic unit scores
their weighted sum.  Trained in numpy on a bounded sample of labelled rows (``MOST`` by default, at most
``2 * MOST`` texts) in one task; the driver gets the weights.

Defined results: null and empty texts are one empty passage; with no labelled rows, or labels of one kind only,
every score is the smoothed share of label 1; repeated rows and null ids keep their rows (a null id is never
learnt from and not held out); other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from parlance.llm.common import fitted, letters, split_on_space

PASSAGE, HIDDEN, ATTENTION, MOST = 40, 16, 8, 6000
MARKS = "!?.,;:|*#$%&@<>{}[]()=/\\_-\"'"


LETTER_FEATURES = 5 + len(MARKS)
WORD_FEATURES = LETTER_FEATURES + 4
FEATURES = WORD_FEATURES + 5


def letter_features(c: str) -> list[bool]:
    return [c.isupper(), c.islower(), c.isdigit(), c.isalpha(), not c.isascii(), *(c == m for m in MARKS)]


def word_features(words: list[str]) -> np.ndarray:
    """Shares of kinds of characters in each word, its length, and whether it is in or begins with upper case."""
    if not words:
        return np.zeros((0, WORD_FEATURES), np.float32)
    if len(words) > 10_000:  # bounded memory for the letters of many words
        return np.concatenate([word_features(words[i:i + 10_000]) for i in range(0, len(words), 10_000)])
    points, size = letters(words)
    kinds, which = np.unique(points, return_inverse=True)
    each = np.array([letter_features(chr(p)) for p in kinds.tolist()], np.float32)[which]
    start = np.cumsum(size) - size
    share = np.add.reduceat(each, start) / size[:, None]
    extra = [np.minimum(size, 30) / 10, (share[:, 0] > 0) & (share[:, 1] == 0) & (size > 1), each[start, 0], size == 1]
    return np.column_stack([share, *extra]).astype(np.float32)


def passages(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(text of each passage, its features), over all passages of whole texts."""
    words, codes, offsets = split_on_space(texts)
    sizes = np.diff(offsets)
    count = np.maximum(1, -(-sizes // PASSAGE))
    text = np.repeat(np.arange(len(sizes)), count)
    start = offsets[text] + (np.arange(len(text)) - (np.cumsum(count) - count)[text]) * PASSAGE
    size = np.minimum(PASSAGE, offsets[text + 1] - start)
    own = word_features(words)
    word_of = np.repeat(np.arange(len(text)), size)  # passages follow one another and cover all words
    out = np.zeros((len(text), FEATURES), np.float32)
    full = np.flatnonzero(size > 0)
    if len(full):
        out[full, :WORD_FEATURES] = np.add.reduceat(own[codes], start[full]) / size[full, None]
        same = np.zeros(len(codes), np.float32)
        same[1:] = (codes[1:] == codes[:-1]) & (word_of[1:] == word_of[:-1])
        out[full, -5] = np.add.reduceat(same, start[full]) / size[full]
        pair = np.unique(word_of * max(len(words), 1) + codes)
        out[:, -4] = np.bincount(pair // max(len(words), 1), minlength=len(text)) / np.maximum(size, 1)
        two = np.zeros(len(codes), np.float32)
        two[2:] = (codes[2:] == codes[:-2]) & (word_of[2:] == word_of[:-2])
        out[full, -3] = np.add.reduceat(two, start[full]) / size[full]
    out[:, -2] = size / PASSAGE
    out[:, -1] = np.log1p(sizes[text]) / 8
    return text, out


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 0.5 * np.tanh(0.5 * x) + 0.5


@dataclass
class Model:
    w: dict[str, np.ndarray] | None
    base: float

    def arrays(self) -> dict[str, np.ndarray]:
        return (self.w or {}) | {"base": np.array(self.base)}

    def forward(self, text: np.ndarray, x: np.ndarray, n: int, keep: dict | None = None) -> np.ndarray:
        """Logits of ``n`` bags."""
        w = self.w
        h = np.tanh(((x - w["mean"]) / w["std"]) @ w["E"] + w["e"])
        v, u = np.tanh(h @ w["V"]), _sigmoid(h @ w["U"])
        s = (v * u) @ w["a"]
        top = np.full(n, -np.inf)
        np.maximum.at(top, text, s)
        e = np.exp(s - top[text])
        alpha = e / np.bincount(text, weights=e, minlength=n)[text]
        z = np.stack([np.bincount(text, weights=alpha * h[:, j], minlength=n) for j in range(h.shape[1])], axis=1)
        if keep is not None:
            keep |= {"h": h, "v": v, "u": u, "alpha": alpha, "z": z}
        return z @ w["o"] + w["b"][0]

    def gradients(self, text: np.ndarray, x: np.ndarray, y: np.ndarray, weight: np.ndarray) -> dict[str, np.ndarray]:
        w, k = self.w, {}
        p = _sigmoid(self.forward(text, x, len(y), k))
        d = weight * (p - y) / weight.sum()
        h, v, u, alpha = k["h"], k["v"], k["u"], k["alpha"]
        g = {"o": k["z"].T @ d, "b": np.array([d.sum()])}
        dz = d[:, None] * w["o"]
        dalpha = (h * dz[text]).sum(1)
        ds = alpha * (dalpha - np.bincount(text, weights=alpha * dalpha, minlength=len(y))[text])
        g["a"] = (v * u).T @ ds
        dv, du = ds[:, None] * w["a"] * u * (1 - v * v), ds[:, None] * w["a"] * v * u * (1 - u)
        g["V"], g["U"] = h.T @ dv, h.T @ du
        dh = (alpha[:, None] * dz[text] + dv @ w["V"].T + du @ w["U"].T) * (1 - h * h)
        g["E"], g["e"] = ((x - w["mean"]) / w["std"]).T @ dh, dh.sum(0)
        return g

    def scores(self, texts: pa.Array) -> np.ndarray:
        if self.w is None or not len(texts):
            return np.full(len(texts), self.base)
        text, x = passages(texts)
        return _sigmoid(self.forward(text, x, len(texts)))


def train(texts: list[str], y: np.ndarray, epochs: int = 25, seed: int = 11) -> Model:
    base = float((y.sum() + 0.5) / (len(y) + 1)) if len(y) else 0.5
    if len(set(y.tolist())) < 2:
        return Model(None, base)
    r = np.random.default_rng(seed)
    parts = [passages(pa.array(texts[i:i + 500], pa.string())) for i in range(0, len(texts), 500)]
    text, x = np.concatenate([t + 500 * i for i, (t, _) in enumerate(parts)]), np.concatenate([p for _, p in parts])
    g = lambda *s: r.standard_normal(s) / np.sqrt(s[0])
    w = {"E": g(FEATURES, HIDDEN), "e": np.zeros(HIDDEN), "V": g(HIDDEN, ATTENTION), "U": g(HIDDEN, ATTENTION), "a": g(ATTENTION),
         "o": g(HIDDEN), "b": np.zeros(1), "mean": x.mean(0), "std": np.maximum(x.std(0), 1e-3)}
    model, bag = Model(w, base), np.searchsorted(text, np.arange(len(y) + 1))
    state, step = {k: [np.zeros_like(v), np.zeros_like(v)] for k, v in w.items()}, 0
    weight = np.ones(len(y))
    for epoch in range(epochs):
        order, rate = r.permutation(len(y)), 0.01 * (1 - epoch / epochs) + 0.0005
        for at in range(0, len(y), 64):
            part, step = order[at:at + 64], step + 1
            sizes = bag[part + 1] - bag[part]
            rows = np.repeat(bag[part] - np.cumsum(sizes) + sizes, sizes) + np.arange(sizes.sum())
            for k, d in model.gradients(np.repeat(np.arange(len(part)), sizes), x[rows], y[part], weight[part]).items():
                m, v = state[k]
                m[:], v[:] = 0.9 * m + 0.1 * d, 0.99 * v + 0.01 * d * d
                w[k] -= rate * (m / (1 - 0.9 ** step)) / (np.sqrt(v / (1 - 0.99 ** step)) + 1e-7)
    return model


def fit(sample: DataFrame) -> Model:
    """Train on ``sample(doc_id, text, y)``, a bounded table (see ``labelled_sample``)."""
    made = fitted(sample, lambda texts, y: train(texts, y).arrays())
    base = float(made.pop("base"))
    return Model(made or None, base)


def score(docs: DataFrame, model: Model, keep: dict[str, Column]) -> DataFrame:
    """(*keep, score): one row for each row of ``docs``, its whole text scored."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            t = b.column("__text")
            s = np.concatenate([model.scores(t.slice(i, 512)) for i in range(0, len(t), 512)] or [np.zeros(0)])
            names = [n for n in b.schema.names if n != "__text"]
            yield pa.RecordBatch.from_arrays([*[b.column(n) for n in names], pa.array(s, pa.float64())], [*names, "score"])

    taken = docs.select(*[c.alias(n) for n, c in keep.items()], F.col("text").cast("string").alias("__text"))
    schema = ", ".join(f"`{n}` {t}" for n, t in taken.dtypes if n != "__text") + ", score double"
    return taken.mapInArrow(run, schema)
