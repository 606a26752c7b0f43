"""Toxicity: a bidirectional gated recurrent network with attention pooling over character and word inputs.

A word's input is the sum of a hashed word vector and the mean of its hashed character-run vectors (starts of 3 to
5 letters, and all runs of 3).  Windows of ``WINDOW`` words that overlap by half cover the whole text;
a network reads each window in both directions, attention pools its states and a logistic unit scores it.
A text's score combines its strongest window with the number of windows (more windows, more chances), by a small
logistic fit.  All of it is trained in numpy on a bounded sample of labelled rows (``MOST`` by default).

Training is one task over the sample (at most ``2 * MOST`` texts); the driver gets the trained weights.
Defined results: null and empty texts are one window without words and get that window's score; with no
labelled rows, or labels of one kind only, every score is the smoothed share of label 1; repeated rows and
null ids keep their rows (a null id is never learnt from and not held out); other columns are ignored.
"""

from __future__ import annotations

import copy
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from parlance.llm.common import fitted, letters, mixed, split_words

WINDOW, STRIDE = 24, 12
DIM, HIDDEN, ATTENTION = 16, 12, 8
WORD_ROWS, CHAR_ROWS = 1 << 14, 1 << 15
MOST = 4000
CHUNK = 20_000  # words whose character runs are held at once
BASE = np.uint64(0x100000001B3)  # of the hashes of words and character runs
PAD = 0  # input number of "no word"


def windows(offsets: np.ndarray, codes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(text of each window, word numbers of each window); number 0 pads, word code c has number c + 1."""
    sizes = np.diff(offsets)
    count = np.maximum(1, -(-(sizes - WINDOW) // STRIDE) + 1)
    text = np.repeat(np.arange(len(sizes)), count)
    first = np.cumsum(count) - count
    start = (np.arange(len(text)) - first[text]) * STRIDE
    padded, out = np.append(codes, -1).astype(np.int32), np.empty((len(text), WINDOW), np.int32)
    for k in range(WINDOW):
        there = start + k < sizes[text]
        out[:, k] = np.where(there, padded[np.where(there, offsets[text] + start + k, 0)], -1) + 1
    return text, out


@dataclass
class Inputs:
    """Word and character rows of a list of words, as flat arrays (word numbers start at 1)."""
    word: np.ndarray
    char: np.ndarray
    at: np.ndarray

    @property
    def owner(self) -> np.ndarray:
        return np.repeat(np.arange(len(self.word)), np.diff(self.at))

    @classmethod
    def of(cls, words: list[str]) -> Inputs:
        if not words:
            return cls(np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(1, np.int64))
        if len(words) > CHUNK:  # bounded memory for the character runs of many words
            parts = [cls.of(words[i:i + CHUNK]) for i in range(0, len(words), CHUNK)]
            shift = np.cumsum([0] + [len(p.char) for p in parts])
            return cls(np.concatenate([p.word for p in parts]), np.concatenate([p.char for p in parts]),
                       np.concatenate([np.zeros(1, np.int64)] + [p.at[1:] + s for p, s in zip(parts, shift)]))
        points, size = letters([f"^{w}$" for w in words])
        points, start = points.astype(np.uint64), np.cumsum(size) - size
        owner = np.repeat(np.arange(len(words)), size)
        place = np.arange(len(points)) - start[owner]
        power = np.multiply.accumulate(np.append(np.uint64(1), np.full(size.max(), BASE)))
        whole = np.add.reduceat(points * power[place], start)
        three = np.flatnonzero(place <= size[owner] - 3)
        rows, owners = [mixed(sum(points[three + i] * power[i] for i in range(3)), CHAR_ROWS)], [owner[three]]
        for n in (4, 5, 6):  # starts of words, each length by a hash of its own
            long = np.flatnonzero(size >= n)
            rows.append(mixed(sum(points[start[long] + i] * power[i] for i in range(n)) + np.uint64(n), CHAR_ROWS))
            owners.append(long)
        order = np.argsort(np.concatenate(owners), kind="stable")
        each = np.bincount(np.concatenate(owners), minlength=len(words))
        return cls(mixed(whole, WORD_ROWS), np.concatenate(rows)[order].astype(np.int32), np.append(0, np.cumsum(each)))


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 0.5 * np.tanh(0.5 * x) + 0.5


class Network:
    """Weights ``w`` and the passes over windows of word numbers."""

    def __init__(self, seed: int = 7):
        r = np.random.default_rng(seed)
        g = lambda *s: (r.standard_normal(s) / np.sqrt(s[0])).astype(np.float32)
        self.w = {"word": 0.1 * r.standard_normal((WORD_ROWS, DIM)).astype(np.float32),
                  "char": 0.1 * r.standard_normal((CHAR_ROWS, DIM)).astype(np.float32),
                  "A": g(2 * HIDDEN, ATTENTION), "a": g(ATTENTION), "o": g(2 * HIDDEN), "b": np.zeros(1, np.float32)}
        for d in "fb":
            self.w |= {f"W{d}": g(DIM, 3 * HIDDEN), f"U{d}": g(HIDDEN, 3 * HIDDEN), f"c{d}": np.zeros(3 * HIDDEN, np.float32)}

    def embed(self, x: Inputs) -> np.ndarray:
        """Input vectors by word number; row 0 is the padding."""
        out = np.zeros((len(x.word) + 1, DIM), np.float32)
        for i in range(0, len(x.word), CHUNK):
            at = x.at[i:i + CHUNK + 1]
            runs = np.add.reduceat(self.w["char"][x.char[at[0]:at[-1]]], at[:-1] - at[0])
            out[i + 1:i + len(at)] = self.w["word"][x.word[i:i + CHUNK]] + runs / np.diff(at)[:, None]
        return out

    def read(self, emb: np.ndarray, win: np.ndarray, d: str, keep: list | None = None) -> np.ndarray:
        """States (steps, windows, HIDDEN) of one direction."""
        H, proj, U = HIDDEN, emb @ self.w[f"W{d}"] + self.w[f"c{d}"], self.w[f"U{d}"]
        h, out = np.zeros((len(win), H), np.float32), np.zeros((WINDOW, len(win), H), np.float32)
        steps = np.ascontiguousarray(win.T)
        whole = steps.min(1) > PAD  # no window ends before this step
        for t in range(WINDOW) if d == "f" else range(WINDOW - 1, -1, -1):
            p = proj[steps[t]]
            zr = _sigmoid(p[:, :2 * H] + h @ U[:, :2 * H])
            z, r = zr[:, :H], zr[:, H:]
            rh = r * h
            n = np.tanh(p[:, 2 * H:] + rh @ U[:, 2 * H:])
            real = (steps[t] > PAD)[:, None]
            new = h + z * (n - h)
            if not whole[t]:
                new = np.where(real, new, h)
            if keep is not None:
                keep.append((t, h, z, r, rh, n, real))
            out[t], h = new, new
        return out

    def forward(self, emb: np.ndarray, win: np.ndarray, keep: dict | None = None) -> np.ndarray:
        """Logits of windows."""
        tapes = {d: [] for d in "fb"} if keep is not None else {"f": None, "b": None}
        s = np.concatenate([self.read(emb, win, d, tapes[d]) for d in "fb"], axis=2)
        m = np.tanh(s @ self.w["A"])
        e = np.where(win.T > PAD, m @ self.w["a"], -1e9)
        e = np.exp(e - e.max(0))
        alpha = e / e.sum(0)
        pooled = (alpha[:, :, None] * s).sum(0)
        if keep is not None:
            keep |= {"tapes": tapes, "s": s, "m": m, "alpha": alpha, "pooled": pooled}
        return pooled @ self.w["o"] + self.w["b"][0]

    def gradients(self, x: Inputs, win: np.ndarray, y: np.ndarray, weight: np.ndarray) -> dict[str, np.ndarray]:
        H, k = HIDDEN, {}
        emb = self.embed(x)
        p = _sigmoid(self.forward(emb, win, k))
        d = (weight * (p - y) / weight.sum()).astype(np.float32)
        g = {"o": k["pooled"].T @ d, "b": np.array([d.sum()], np.float32)}
        dpool = d[:, None] * self.w["o"]
        s, m, alpha = k["s"], k["m"], k["alpha"]
        dalpha = (s * dpool).sum(2)
        de = alpha * (dalpha - (alpha * dalpha).sum(0))
        da = de[:, :, None] * self.w["a"] * (1 - m * m)
        g["a"] = np.einsum("tnk,tn->k", m, de)
        g["A"] = s.reshape(-1, 2 * H).T @ da.reshape(-1, ATTENTION)
        ds = alpha[:, :, None] * dpool + da @ self.w["A"].T
        demb = np.zeros_like(emb)
        for j, dr in enumerate("fb"):
            U, W = self.w[f"U{dr}"], self.w[f"W{dr}"]
            dU, dproj, dh = np.zeros_like(U), np.zeros((len(emb), 3 * H), np.float32), np.zeros((len(win), H), np.float32)
            for t, h, z, r, rh, n, real in reversed(k["tapes"][dr]):
                dh = dh + ds[t, :, j * H:(j + 1) * H]
                dn = np.where(real, dh * z * (1 - n * n), 0)
                dz = np.where(real, dh * (n - h) * z * (1 - z), 0)
                drh = dn @ U[:, 2 * H:].T
                drr = drh * h * r * (1 - r)
                pre = np.concatenate([dz, drr, dn], axis=1)
                dU[:, :2 * H] += h.T @ pre[:, :2 * H]
                dU[:, 2 * H:] += rh.T @ dn
                np.add.at(dproj, win[:, t], pre)
                dh = np.where(real, dh * (1 - z), dh) + drh * r + pre[:, :2 * H] @ U[:, :2 * H].T
            dproj[PAD] = 0
            g |= {f"U{dr}": dU, f"W{dr}": emb.T @ dproj, f"c{dr}": dproj.sum(0)}
            demb += dproj @ W.T
        g["word"] = (x.word, demb[1:])
        g["char"] = (x.char, (demb[1:] / np.diff(x.at)[:, None])[x.owner])
        return g


@dataclass
class Model:
    network: Network | None
    base: float  # score where there is no network
    scale: tuple[float, float, float] = (1.0, 0.0, 0.0)  # of the strongest window, of log windows, constant

    def arrays(self) -> dict[str, np.ndarray]:
        return (self.network.w if self.network else {}) | {"base": np.array(self.base), "scale": np.array(self.scale)}

    def windows_of(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """(text of each window, its logit), over all windows of whole texts."""
        words, codes, offsets = split_words(texts)
        text, win = windows(offsets, codes)
        emb = self.network.embed(Inputs.of(words))
        return text, np.concatenate([self.network.forward(emb, win[i:i + 2048]) for i in range(0, len(win), 2048)] or [np.zeros(0)])

    def strongest(self, texts: pa.Array, block: int = 256) -> tuple[np.ndarray, np.ndarray]:
        """Logit of the strongest window and number of windows of each text."""
        best, count = np.full(len(texts), -np.inf), np.zeros(len(texts), np.int64)
        for i in range(0, len(texts), block):
            text, logit = self.windows_of(texts.slice(i, block))
            np.maximum.at(best, i + text, logit)
            np.add.at(count, i + text, 1)
        return best, count

    def scores(self, texts: pa.Array) -> np.ndarray:
        if self.network is None or not len(texts):
            return np.full(len(texts), self.base)
        best, count = self.strongest(texts)
        a, b, c = self.scale
        return _sigmoid(a * best + b * np.log(count) + c)


def train(texts: list[str], y: np.ndarray, epochs: int = 8, seed: int = 7) -> Model:
    """Fit on labelled texts: the network on five of six, the calibration on the sixth (on all, where a part lacks a label).

    The sixth also tells which epoch's weights to keep: those that rank its texts best.

    A label says that some window is toxic, not which.  Windows are first ranked by the smoothed
    log odds of their words and character runs, later by the network itself; a text trains its two
    strongest windows, and a clean one a random window besides.
    """
    base = float((y.sum() + 0.5) / (len(y) + 1)) if len(y) else 0.5
    if len(set(y.tolist())) < 2:
        return Model(None, base)
    aside = np.random.default_rng(seed).permutation(len(y)) % 6 == 5
    if len(set(y[aside].tolist())) < 2 or len(set(y[~aside].tolist())) < 2:
        own = kept = np.arange(len(y))
    else:
        own, kept = np.flatnonzero(~aside), np.flatnonzero(aside)
    held, model, top = pa.array([texts[i] for i in kept], pa.string()), None, -1.0
    for net in _epochs([texts[i] for i in own], y[own], epochs, seed):
        best, count = Model(net, base).strongest(held)
        if (area := _area(best, y[kept])) > top:
            top, model = area, Model(copy.deepcopy(net), base)
            model.scale = _calibrate(best, np.log(count), y[kept])
    return model


def _area(score: np.ndarray, y: np.ndarray) -> float:
    """Share of (toxic, clean) pairs in the right order."""
    rank = np.searchsorted(np.sort(score), score, side="left") + np.searchsorted(np.sort(score), score, side="right")
    return float((rank[y == 1].mean() / 2 - (y == 1).sum() / 2) / max((y == 0).sum(), 1))


def _epochs(texts: list[str], y: np.ndarray, epochs: int, seed: int) -> Iterator[Network]:
    """The network after each epoch."""
    base = y.mean()
    r, net = np.random.default_rng(seed), Network(seed)
    words, codes, offsets = split_words(pa.array(texts, pa.string()))
    x, (text, win) = Inputs.of(words), windows(offsets, codes)
    del words
    _start_from_odds(net, x, codes, offsets, y)
    adam = {k: [np.zeros_like(v), np.zeros_like(v)] for k, v in net.w.items()}
    rank, step = net.embed(x)[:, 0][win].max(1), 0
    weight = np.where(y == 1, 0.5 / max(base, 1e-3), 0.5 / max(1 - base, 1e-3)).astype(np.float32)
    for epoch in range(epochs):
        if epoch:
            emb = net.embed(x)
            rank = np.concatenate([net.forward(emb, win[i:i + 4096]) for i in range(0, len(win), 4096)])
        order = np.lexsort((-rank, text))
        place = np.arange(len(text)) - np.searchsorted(text[order], text[order])
        use = order[place < 2]
        use = np.concatenate([use, r.choice(len(text), len(y))])
        use = use[(y[text[use]] == 0) | np.isin(use, order[place < 2])]
        use = use[(y[text[use]] == 0) | (rank[use] >= np.quantile(rank[y[text] == 0], 0.9)) | np.isin(use, order[place < 1])]
        r.shuffle(use)
        size = int(np.clip(len(use) // 24, 16, 256))
        for at in range(0, len(use), size):
            part, step = use[at:at + size], step + 1
            used, local = np.unique(win[part], return_inverse=True)
            if used[0] != PAD:
                used, local = np.append(PAD, used), local + 1
            pick = used[1:] - 1
            sizes = np.diff(x.at)[pick]
            flat = np.repeat(x.at[pick] - np.cumsum(sizes) + sizes, sizes) + np.arange(sizes.sum())
            sub = Inputs(x.word[pick], x.char[flat], np.concatenate([[0], np.cumsum(sizes)]))
            grads = net.gradients(sub, local.reshape(len(part), WINDOW), y[text[part]], weight[text[part]])
            _adam(net.w, grads, adam, step, 0.004 * (1 - 0.8 * epoch / epochs))
        yield net


def _start_from_odds(net: Network, x: Inputs, codes: np.ndarray, offsets: np.ndarray, y: np.ndarray) -> None:
    """First component of each input row: the smoothed log odds of toxic texts that hold the word or character run."""
    owner = np.repeat(np.arange(len(y)), np.diff(offsets))
    pairs = np.unique(owner * len(x.word) + codes) if len(codes) else np.zeros(0, np.int64)
    text, word = pairs // max(len(x.word), 1), pairs % max(len(x.word), 1)
    total = np.array([(y == 0).sum(), (y == 1).sum()], float)

    def odds(n: np.ndarray) -> np.ndarray:  # towards 0 for what few texts hold
        prior = 4 * total / total.sum()
        return np.clip(np.log((n[1] + prior[1]) / (n[0] + prior[0])) - np.log(total[1] / total[0]), -4, 4) / 3

    held = [np.bincount(word[y[text] == k], minlength=len(x.word)) for k in (0, 1)]  # texts with the word
    net.w["word"][:, 0] = odds([np.bincount(x.word, weights=h, minlength=WORD_ROWS) for h in held])
    net.w["char"][:, 0] = odds([np.bincount(x.char, weights=h[x.owner], minlength=CHAR_ROWS) for h in held])


def _adam(w: dict, grads: dict, state: dict, step: int, rate: float) -> None:
    norm = np.sqrt(sum(float(((g[1] if isinstance(g, tuple) else g) ** 2).sum()) for g in grads.values()))
    shrink = np.float32(min(1.0, 1.0 / max(norm, 1e-9)))
    for k, g in grads.items():
        m, v = state[k]
        if isinstance(g, tuple):  # rows of a table: only those met now move
            rows, which = np.unique(g[0], return_inverse=True)
            full = np.zeros((len(rows), g[1].shape[1]), np.float32)
            np.add.at(full, which, g[1])
        else:
            rows, full = slice(None), g
        full = full * shrink
        m[rows] = 0.9 * m[rows] + 0.1 * full
        v[rows] = 0.99 * v[rows] + 0.01 * full * full
        w[k][rows] -= rate * (m[rows] / (1 - 0.9 ** step)) / (np.sqrt(v[rows] / (1 - 0.99 ** step)) + 1e-7)


def _calibrate(best: np.ndarray, size: np.ndarray, y: np.ndarray) -> tuple[float, float, float]:
    """Logistic fit of the label on the strongest logit and the log of the number of windows (Newton steps)."""
    X = np.column_stack([best, size, np.ones(len(y))])
    c = np.array([1.0, 0.0, 0.0])
    for _ in range(25):
        p = _sigmoid(np.clip(X @ c, -30, 30))
        H = X.T @ (X * (p * (1 - p))[:, None]) + np.diag([1e-2, 1e-2, 1e-3])
        c = c - np.clip(np.linalg.solve(H, X.T @ (p - y) + np.array([1e-2, 1e-2, 1e-3]) * (c - [1, 0, 0])), -2, 2)
    return float(max(c[0], 0.05)), float(c[1]), float(c[2])


def fit(sample: DataFrame) -> Model:
    """Train on ``sample(text, y)``, a bounded table (see ``labelled_sample``)."""
    made = fitted(sample, lambda texts, y: train(texts, y).arrays())
    base, scale = float(made.pop("base")), made.pop("scale")
    if not made:
        return Model(None, base)
    network = Network()
    network.w = made
    return Model(network, base, tuple(scale.tolist()))


def score(docs: DataFrame, model: Model, keep: dict[str, Column]) -> DataFrame:
    """(*keep, score): one row for each row of ``docs``, its whole text scored."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            t = b.column("__text")
            s = model.scores(t)
            names = [n for n in b.schema.names if n != "__text"]
            yield pa.RecordBatch.from_arrays([*[b.column(n) for n in names], pa.array(s, pa.float64())], [*names, "score"])

    taken = docs.select(*[c.alias(n) for n, c in keep.items()], F.col("text").cast("string").alias("__text"))
    schema = ", ".join(f"`{n}` {t}" for n, t in taken.dtypes if n != "__text") + ", score double"
    return taken.mapInArrow(run, schema)
