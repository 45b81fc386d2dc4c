"""Operator 6: toxicity by a bidirectional gated recurrent network with attention pooling.

A token's input is the embedding of its hashed word plus the mean embedding of its hashed
character n-grams (3 to 5, with word edges), so spelling variants of a known stem are seen.
Two gated recurrent layers, one in each direction, run over windows of ``WINDOW`` tokens
that overlap by half; attention pools the states of a window, a logistic output scores it,
and a document's score is its highest window, calibrated on the training rows. Training is
plain numpy back-propagation on the driver over a bounded sample of labelled rows
(``sample_per_class`` rows a class, none longer than ``sample_chars`` characters); windows
stand for their document by multiple-instance learning. Scoring runs over every window of
every text, a slice of windows at a time, inside Spark tasks.

Defined cases: null, empty and token-free texts count as one window of padding, scored by
the model. Rows are scored each for itself, so repeated rows and null ids need no rule.
Labels that are null, and labels of ids without a document, are not learnt from; a repeated
label row takes the highest mark. Without labels of both classes every score is 0 (nothing is
rejected). An empty table gives no rows. Inputs are the text alone; other columns
pass through ``scored`` untouched.
"""

from __future__ import annotations

import itertools
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

WINDOW, STRIDE = 32, 16
WORDS, GRAMS = 1 << 14, 1 << 15  # rows of the two hashed embedding tables
INPUT, HIDDEN = 12, 8
TOKEN_BYTES = 24  # a longer token is several tokens
#: ASCII characters other than letters and digits part tokens.
BREAKS = bytes(c if chr(c).isalnum() or c > 127 else 32 for c in range(256))
#: Tokens scored at a time, and distinct tokens whose inputs a task holds before it starts anew.
CHUNK_TOKENS, KNOWN_TOKENS = 150_000, 200_000


def tokens(text: str | None) -> list[bytes]:
    words = (text or "").lower().encode("utf-8", "replace").translate(BREAKS).split()
    if any(len(w) > TOKEN_BYTES for w in words):
        words = [w[i : i + TOKEN_BYTES] for w in words for i in range(0, len(w), TOKEN_BYTES)]
    return words


def features(words: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(hashed word, hashed n-grams padded with -1, number of n-grams) of distinct tokens."""
    width = TOKEN_BYTES + 2
    raw = np.zeros((len(words), width), dtype=np.uint8)
    raw[:, 1:-1] = np.array(words, dtype=f"S{TOKEN_BYTES}").view(np.uint8).reshape(len(words), TOKEN_BYTES)
    n = np.fromiter(map(len, words), np.int64, len(words))
    raw[:, 0] = 1
    raw[np.arange(len(words)), n + 1] = 2
    x = raw.astype(np.uint64) + np.uint64(1)
    mix = lambda h: (h ^ (h >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)
    word = np.zeros(len(words), dtype=np.uint64)
    for i in range(width):
        word = np.where(i < n + 2, word * np.uint64(0x100000001B3) + x[:, i], word)
    found = []
    for size in (3, 4, 5):
        h = np.zeros((len(words), width - size + 1), dtype=np.uint64)
        for i in range(size):
            h = h * np.uint64(0x9E3779B97F4A7C15) + x[:, i : width - size + 1 + i]
        inside = np.arange(width - size + 1)[None, :] <= (n + 2 - size)[:, None]
        found.append(np.where(inside, ((mix(h + np.uint64(size)) >> np.uint64(40)) % np.uint64(GRAMS)).astype(np.int32), np.int32(-1)))
    grams = np.concatenate(found, axis=1)
    return ((mix(word) >> np.uint64(40)) % np.uint64(WORDS)).astype(np.int64), grams, np.maximum(1, (grams >= 0).sum(axis=1))


def sigmoid(x: np.ndarray) -> np.ndarray:
    return np.float32(0.5) * np.tanh(np.float32(0.5) * x) + np.float32(0.5)


@dataclass
class Network:
    """Parameters by name; ``scale`` and ``shift`` calibrate a document's highest window."""

    p: dict[str, np.ndarray] = field(default_factory=dict)
    scale: float = 1.0
    shift: float = 0.0
    seen: Known | None = None

    @classmethod
    def new(cls, seed: int = 7) -> Network:
        rng = np.random.default_rng(seed)
        new = lambda *shape, s=0.3: rng.normal(0, s, shape).astype(np.float32)
        p = {"word": new(WORDS, INPUT, s=0.02), "gram": new(GRAMS, INPUT, s=0.02)}
        for d in "fb":
            p |= {f"W{d}": new(INPUT, 3 * HIDDEN, s=0.5), f"U{d}": new(HIDDEN, 3 * HIDDEN), f"c{d}": np.zeros(3 * HIDDEN, np.float32)}
        p |= {"A": new(2 * HIDDEN, HIDDEN), "v": new(HIDDEN), "o": new(2 * HIDDEN, s=0.5), "o0": np.zeros(1, np.float32)}
        return cls(p)

    def embed(self, word: np.ndarray, grams: np.ndarray, n: np.ndarray) -> np.ndarray:
        """Inputs of distinct tokens."""
        out = self.p["word"][word].copy()
        table = np.vstack([self.p["gram"], np.zeros((1, INPUT), np.float32)])
        for k in range(0, len(word), 20_000):  # bounded scratch
            out[k : k + 20_000] += table[grams[k : k + 20_000]].sum(axis=1) / n[k : k + 20_000, None].astype(np.float32)
        return out

    def layer(self, d: str, x: np.ndarray, ids: np.ndarray, keep: list | None = None) -> np.ndarray:
        """States (time, window, hidden) of one direction; ``x``: projected inputs of the distinct tokens."""
        length, b = ids.shape
        h = np.zeros((b, HIDDEN), np.float32)
        out = np.empty((length, b, HIDDEN), np.float32)
        U = self.p[f"U{d}"]
        for t in range(length) if d == "f" else range(length - 1, -1, -1):
            a = x[ids[t]]
            g = sigmoid(a[:, : 2 * HIDDEN] + h @ U[:, : 2 * HIDDEN])
            z, r = g[:, :HIDDEN], g[:, HIDDEN:]
            m = h @ U[:, 2 * HIDDEN :]
            c = np.tanh(a[:, 2 * HIDDEN :] + r * m)
            if keep is not None:
                keep.append((t, h, z, r, m, c))
            h = c + z * (h - c)
            h *= (ids[t] > 0)[:, None]  # token 0 is padding
            out[t] = h
        return out

    def project(self, inputs: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """What either direction takes from the inputs of distinct tokens."""
        return inputs @ self.p["Wf"] + self.p["cf"], inputs @ self.p["Wb"] + self.p["cb"]

    def forward(self, projected: tuple[np.ndarray, np.ndarray], ids: np.ndarray, keep: dict | None = None) -> np.ndarray:
        """Logits of windows; ``ids`` (time, window) index the rows of ``projected``."""
        hs = []
        for d, x in zip("fb", projected):
            hs.append(self.layer(d, x, ids, None if keep is None else keep.setdefault(f"steps{d}", [])))
        h = np.concatenate(hs, axis=2)
        u = np.tanh(h @ self.p["A"])
        e = u @ self.p["v"] + np.where(ids > 0, np.float32(0), np.float32(-30))
        e = np.exp(e - e.max(axis=0))
        w = e / e.sum(axis=0)
        s = (w[:, :, None] * h).sum(axis=0)
        if keep is not None:
            keep |= {"h": h, "u": u, "w": w, "s": s}
        return s @ self.p["o"] + self.p["o0"][0]

    def gradients(self, feats: tuple, inputs: np.ndarray, ids: np.ndarray, y: np.ndarray, weight: np.ndarray) -> tuple[float, dict]:
        keep: dict = {}
        p = self.p
        logit = self.forward(self.project(inputs), ids, keep)
        prob = sigmoid(logit)
        loss = float(-(weight * np.where(y > 0, np.log(prob + 1e-7), np.log(1 - prob + 1e-7))).sum() / weight.sum())
        dl = (weight * (prob - y) / weight.sum()).astype(np.float32)
        h, u, w, s = (keep[k] for k in ("h", "u", "w", "s"))
        g = {"o": s.T @ dl, "o0": np.array([dl.sum()], np.float32)}
        ds = dl[:, None] * p["o"]
        dh = w[:, :, None] * ds[None]
        dw = (h * ds[None]).sum(axis=2)
        de = w * (dw - (w * dw).sum(axis=0))
        g["v"] = np.tensordot(de, u, ((0, 1), (0, 1)))
        du = de[:, :, None] * p["v"] * (1 - u * u)
        g["A"] = np.tensordot(h, du, ((0, 1), (0, 1)))
        dh = dh + du @ p["A"].T
        dx = np.zeros_like(inputs)
        for d, part in (("f", slice(0, HIDDEN)), ("b", slice(HIDDEN, 2 * HIDDEN))):
            U = p[f"U{d}"]
            gU, da_all = np.zeros_like(U), np.zeros((*ids.shape, 3 * HIDDEN), np.float32)
            back = np.zeros((ids.shape[1], HIDDEN), np.float32)
            for t, before, z, r, m, c in reversed(keep[f"steps{d}"]):
                dt = (dh[t][:, part] + back) * (ids[t] > 0)[:, None]
                dc = dt * (1 - z) * (1 - c * c)
                dz = dt * (before - c) * z * (1 - z)
                dr = dc * m * r * (1 - r)
                dzr = np.concatenate([dz, dr], axis=1)
                gU[:, : 2 * HIDDEN] += before.T @ dzr
                gU[:, 2 * HIDDEN :] += before.T @ (dc * r)
                back = dt * z + dzr @ U[:, : 2 * HIDDEN].T + (dc * r) @ U[:, 2 * HIDDEN :].T
                da_all[t] = np.concatenate([dzr, dc], axis=1)
            flat = da_all.reshape(-1, 3 * HIDDEN)
            da = np.zeros((len(inputs), 3 * HIDDEN), np.float32)
            np.add.at(da, ids.reshape(-1), flat)
            g[f"U{d}"], g[f"c{d}"], g[f"W{d}"] = gU, da.sum(axis=0), inputs.T @ da
            dx += da @ p[f"W{d}"].T
        word, grams, n = feats
        g["word"] = (word, dx)
        rows, cols = np.nonzero(grams >= 0)
        g["gram"] = (grams[rows, cols], dx[rows] / n[rows, None].astype(np.float32))
        return loss, g

    def score(self, texts: list[str | None]) -> np.ndarray:
        """Probabilities of whole texts, from all their overlapping windows."""
        return sigmoid(np.float32(self.scale) * self.highest(texts) + np.float32(self.shift)).astype(np.float64)

    def highest(self, texts: list[str | None]) -> np.ndarray:
        """The logit of each text's highest window."""
        out = np.full(len(texts), -np.inf, np.float32)
        rows: list[int] = []
        held: list[list[bytes]] = []
        size = 0

        def flush() -> None:
            nonlocal size
            if held:
                ids, owner = windows(held, known := self.known())
                np.maximum.at(out, np.array(rows)[owner], self.logits(known.projected(self), ids))
            rows.clear(), held.clear()
            size = 0

        step = CHUNK_TOKENS - CHUNK_TOKENS % STRIDE
        for k, text in enumerate(texts):
            words = tokens(text)
            for i in range(0, max(1, len(words) - STRIDE), step):  # a very long text in slices that share a window's overlap
                rows.append(k)
                held.append(words[i : i + step + STRIDE])
                size += len(held[-1])
                if size >= CHUNK_TOKENS:
                    flush()
        flush()
        return out

    def known(self) -> Known:
        if self.seen is None or len(self.seen.index) > KNOWN_TOKENS:
            self.seen = Known()
        return self.seen

    def logits(self, projected: tuple[np.ndarray, np.ndarray], ids: np.ndarray) -> np.ndarray:
        return np.concatenate([self.forward(projected, ids[:, k : k + 4096]) for k in range(0, ids.shape[1], 4096)])


class Known:
    """Numbers of distinct tokens and what the layers take from them; row 0 is padding."""

    def __init__(self) -> None:
        self.index: dict[bytes, int] = {b"": 0}
        self.rows: tuple[np.ndarray, np.ndarray] | None = None

    def projected(self, net: Network) -> tuple[np.ndarray, np.ndarray]:
        done = 0 if self.rows is None else len(self.rows[0])
        if done < len(self.index):
            new = net.project(net.embed(*features(list(itertools.islice(self.index, done, None)))))
            self.rows = new if self.rows is None else tuple(np.concatenate(x) for x in zip(self.rows, new))
        return self.rows


def windows(docs: list[list[bytes]], known: Known) -> tuple[np.ndarray, np.ndarray]:
    """Token numbers (time, window) and each window's document."""
    index = known.index
    flat = np.fromiter((index.setdefault(w, len(index)) for d in docs for w in d), np.int32, sum(map(len, docs)))
    n = np.fromiter(map(len, docs), np.int64, len(docs))
    count = np.maximum(1, -(-(n - STRIDE) // STRIDE))
    owner = np.repeat(np.arange(len(docs)), count)
    nth = np.arange(len(owner)) - np.repeat(np.cumsum(count) - count, count)
    starts = np.repeat(np.cumsum(n) - n, count) + nth * STRIDE
    ends = np.repeat(np.cumsum(n), count)
    at = starts[None, :] + np.arange(WINDOW)[:, None]
    ids = np.where(at < ends[None, :], flat[np.minimum(at, max(0, len(flat) - 1))] if len(flat) else 0, 0).astype(np.int32)
    return ids, owner


def train(
    texts: list[str], marks: list[int], rounds: int = 6, steps: int = 40, batch: int = 384, seed: int = 7, shares: tuple[float, float] = (1.0, 1.0)
) -> Network | None:
    """Fit by multiple-instance learning: a marked text stands by its highest window, a clean one by all of them.

    The first channel of the inputs starts as the smoothed log-odds of the hashed words and n-grams
    between marked and clean training texts; the rest starts at random. Every round picks the
    windows anew by the current network. ``shares``: what a clean and a marked text weigh in the
    calibration, for samples that hold the classes in other proportions than the labels.
    """
    y = np.array(marks, dtype=np.float32)
    if len(y) == 0 or y.min() == y.max():
        return None
    rng = np.random.default_rng(seed)
    net = Network.new(seed)
    known = Known()
    ids, owner = windows([tokens(t) for t in texts], known)
    word, grams, n = feats = features(list(known.index))
    # In how many texts of either class a hashed feature occurs, some texts at a time.
    pairs = np.unique((np.broadcast_to(owner, ids.shape).astype(np.int64) * len(n) + ids)[ids > 0])
    seen = {"word": np.zeros((2, WORDS)), "gram": np.zeros((2, GRAMS))}
    for first in range(0, len(texts), 100):
        block = pairs[np.searchsorted(pairs, first * len(n)) : np.searchsorted(pairs, (first + 100) * len(n))]
        doc, token = block // len(n), block % len(n)
        for name, feature in (("word", word[token][:, None]), ("gram", grams[token])):
            rows, cols = np.nonzero(feature >= 0)
            hit = np.unique(doc[rows] * (1 << 20) + feature[rows, cols])
            np.add.at(seen[name], (y[hit >> 20].astype(int), hit & ((1 << 20) - 1)), 1)
    for name, counts in seen.items():
        odds = np.log((counts[1] + 0.5) / (y.sum() + 1)) - np.log((counts[0] + 0.5) / (len(y) - y.sum() + 1))
        net.p[name][:, 0] = (odds * np.minimum(1, counts.sum(axis=0) / 8) * 0.5).astype(np.float32)
    moments = {k: [np.zeros_like(v), np.zeros_like(v)] for k, v in net.p.items()}
    spread = net.p["word"][word, 0] + np.where(grams >= 0, net.p["gram"][grams, 0], -9).max(axis=1)
    logits = np.where(ids > 0, spread[ids], -9).max(axis=0)
    positive, negative = np.flatnonzero(y > 0), np.flatnonzero(y == 0)
    clean = np.flatnonzero(y[owner] == 0)
    step = 0
    for _ in range(rounds):
        order = np.lexsort((logits, owner))
        last = order[np.append(np.flatnonzero(np.diff(owner[order])), len(order) - 1)]  # the highest window of each text
        hard = last[negative]
        for _ in range(steps):
            pick = np.concatenate([rng.choice(last[positive], batch // 3), rng.choice(hard, batch // 3), rng.choice(clean, batch // 3)])
            used, local = np.unique(ids[:, pick], return_inverse=True)
            local = local.reshape(WINDOW, -1)
            if used[0] != 0:
                used, local = np.concatenate([[0], used]), local + 1
            sub = (word[used], grams[used], n[used])
            _, g = net.gradients(sub, net.embed(*sub), local.astype(np.int32), y[owner[pick]], np.ones(len(pick), np.float32))
            step += 1
            for k, grad in g.items():
                m, v = moments[k]
                if isinstance(grad, tuple):  # only the rows that were used move
                    at, inverse = np.unique(grad[0], return_inverse=True)
                    total = np.zeros((len(at), INPUT), np.float32)
                    np.add.at(total, inverse, grad[1])
                    v[at] += total * total
                    net.p[k][at] -= 0.03 * total / (np.sqrt(v[at]) + 1e-6)
                else:
                    m *= 0.9
                    m += 0.1 * grad
                    v *= 0.99
                    v += 0.01 * grad * grad
                    net.p[k] -= 0.01 * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.99**step)) + 1e-6)
        logits = net.logits(net.project(net.embed(*feats)), ids)
    top = np.full(len(texts), -np.inf)
    np.maximum.at(top, owner, logits)
    # Logistic calibration of the highest window on the training texts, by Newton steps.
    a, b = 1.0, 0.0
    weight = np.where(y > 0, shares[1], shares[0]) / np.mean(np.where(y > 0, shares[1], shares[0]))
    for _ in range(40):
        q = 1 / (1 + np.exp(-np.clip(a * top + b, -30, 30)))
        r, s = weight * (y - q), weight * q * (1 - q) + 1e-4
        H = np.array([[(s * top * top).sum() + 1, (s * top).sum()], [(s * top).sum(), s.sum() + 1]])
        da, db = np.linalg.solve(H, [(r * top).sum() - (a - 1), r.sum() - b])
        a, b = a + np.clip(da, -1, 1), b + np.clip(db, -1, 1)
    net.scale, net.shift = float(max(a, 0.05)), float(b)
    return net


def training_marks(labels: DataFrame, folds: int) -> DataFrame:
    """One row (doc_id, mark) per labelled id outside fold 0."""
    fold = F.crc32(F.col("doc_id").cast("string").cast("binary")) % folds
    marks = labels.where(F.col("toxic").isNotNull() & F.col("doc_id").isNotNull()).where(fold != 0)
    return marks.groupBy(F.col("doc_id").cast("long").alias("doc_id")).agg((F.max("toxic") > 0).cast("int").alias("mark"))


def training_rows(docs: DataFrame, marks: DataFrame, sample_per_class: int, sample_chars: int) -> list:
    """The bounded sample: of either class the ``sample_per_class`` first ids by hash."""
    order = F.xxhash64("doc_id")
    ids = marks.where("mark = 1").orderBy(order, "doc_id").limit(sample_per_class).union(marks.where("mark = 0").orderBy(order, "doc_id").limit(sample_per_class))
    # At most 2 * sample_per_class rows of two numbers, so the broadcast is bounded.
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").join(F.broadcast(ids), "doc_id")
    texts = texts.where(F.col("text").isNotNull() & (F.length("text") <= sample_chars))
    rows = texts.groupBy("doc_id", "mark").agg(F.max("text").alias("text")).collect()
    return sorted((r["doc_id"], r["mark"], r["text"]) for r in rows)


def fit(docs: DataFrame, labels: DataFrame, sample_per_class: int = 2000, sample_chars: int = 12_000, folds: int = 5) -> Network | None:
    """The network fitted on the bounded sample; None if the labels lack a class."""
    marks = training_marks(labels, folds)
    totals = {r["mark"]: r["n"] for r in marks.groupBy("mark").agg(F.count("*").alias("n")).collect()}
    rows = training_rows(docs, marks, sample_per_class, sample_chars)
    y = [m for _, m, _ in rows]
    shares = tuple(totals.get(m, 0) / max(1, y.count(m)) for m in (0, 1))
    return train([t for _, _, t in rows], y, shares=shares)


def score_column(spark: SparkSession, net: Network | None) -> Column:
    """The score of each whole ``text``."""
    if net is None:
        return F.lit(0.0)
    # Two fixed-size tables and a few small matrices: under 4 MB whatever the corpus.
    sent = spark.sparkContext.broadcast((net.p, net.scale, net.shift))

    @F.pandas_udf("double")
    def run(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        model = Network(*sent.value)
        for batch in batches:
            yield pd.Series(model.score([t if isinstance(t, str) else None for t in batch]))

    return run(F.col("text"))


def scored(docs: DataFrame, net: Network | None, column: str = "toxic_score") -> DataFrame:
    """``docs`` with the score in ``column``, replacing a column of that name."""
    return docs.withColumn(column, score_column(docs.sparkSession, net))


def clean(docs: DataFrame, net: Network | None, threshold: float = 0.5) -> DataFrame:
    """The rows of ``docs`` that score less than ``threshold``."""
    return docs.where(score_column(docs.sparkSession, net) < threshold)
