"""Toxicity of documents: a bidirectional gated recurrent network in numpy.

A text is read as overlapping windows of ``WINDOW`` words, ``STRIDE`` apart, over its
whole length. A word's input is the vector of its entry in a vocabulary (words of at
least ``SEEN`` training texts) plus the mean of the vectors of its hashed character
trigrams, so unknown spellings count too. Two gated recurrent layers read a window in
both directions, attention pools their states, and a logistic unit scores the window.
A text scores as its highest window, calibrated.

The network is fitted to at most ``SAMPLE`` toxic texts and ``CLEAN`` times as many
others (those with the least seeded hash).
Labels belong to texts, so the loss is that of "some window is toxic". A fifth of the
sample is kept aside to calibrate the score at the labels' true rate.

Results for the odd cases: NULL and blank texts are one window without words; labels
that are neither 0 nor 1, or without a text, teach nothing; repeated labels count
once; with no or one label left every score is its rate; rows that repeat an id are
scored each; an empty table gives an empty result; further columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from planefold.llm.language import Index
from planefold.llm.ship import ready
from planefold.llm.words import ALNUM, U64, Words, mix, pieces, ranges, split
from planefold.operators.ordering import top_per_group

WINDOW = 64
STRIDE = 32
SAMPLE = 1000
CLEAN = 3
SEEN = 3
INPUT = 12
HIDDEN = 10
TRIGRAMS = 1 << 12
UPDATES = 200
UPDATE_WINDOWS = 768
BATCH = 1024
RATE = 0.01
DECAY = 0.004
SEED = 5
THRESHOLD = 0.3
F32 = np.float32


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-x))


@dataclass
class Inputs:
    """Distinct words of a piece (vocabulary entry, trigrams) and its windows (distinct-word numbers, -1 padded)."""

    entry: np.ndarray
    trigram: np.ndarray
    of_word: np.ndarray
    windows: np.ndarray
    text: np.ndarray


def _trigrams(words: Words, which: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Trigram bucket and word number of the marked spelling of some words."""
    start, size = words.start[which], words.stop[which] - words.start[which]
    row = np.repeat(np.arange(len(which)), size + 2)
    place = ranges(np.zeros(len(which), dtype=np.int64), size + 2)
    inner = (place > 0) & (place <= np.repeat(size, size + 2))
    letters = np.zeros(len(row), dtype=U64)
    letters[inner] = words.data[ranges(start, size)]
    at = np.flatnonzero(place >= 2)
    bucket = mix(letters[at] | letters[at - 1] << U64(8) | letters[at - 2] << U64(16)) % U64(TRIGRAMS)
    return bucket.astype(np.int64), row[at]


def inputs(column: pa.Array, vocabulary: Index) -> Inputs:
    """What the network reads of the texts of a column."""
    words = split(column, ALNUM, lower=True)
    distinct, first, number = np.unique(words.hashes, return_index=True, return_inverse=True)
    trigram, of_word = _trigrams(words, first)
    counts = words.counts
    windows = np.maximum(-(-(counts - WINDOW) // STRIDE) + 1, 1)
    text = np.repeat(np.arange(len(counts)), windows)
    begin = ranges(np.zeros(len(counts), dtype=np.int64), windows) * STRIDE
    place = begin[:, None] + np.arange(WINDOW)
    inside = place < counts[text][:, None]
    at = np.where(inside, words.first[text][:, None] + place, 0)
    number = np.r_[number, -1] if not len(number) else number
    return Inputs(vocabulary.find(distinct) + 1, trigram, of_word, np.where(inside, number[at], -1), text)


@dataclass
class Network:
    """Weights, and the calibration of the score."""

    vocabulary: Index
    weights: dict[str, np.ndarray]
    scale: float = 1.0
    shift: float = 0.0
    rate: float | None = None
    first: dict[str, np.ndarray] = field(default_factory=dict)
    second: dict[str, np.ndarray] = field(default_factory=dict)
    updates: int = 0

    def vectors(self, given: Inputs) -> np.ndarray:
        """Input of each distinct word."""
        w = self.weights
        n = len(given.entry)
        count = np.maximum(np.bincount(given.of_word, minlength=n), 1)[:, None]
        begin = np.searchsorted(given.of_word, np.arange(n))
        chars = np.add.reduceat(w["trigram"][given.trigram], begin, axis=0) / count if n else np.zeros((0, INPUT), F32)
        return (w["word"][given.entry] + chars).astype(F32)

    def _read(self, side: str, projected: np.ndarray, windows: np.ndarray, keep: bool) -> tuple[np.ndarray, list]:
        """States of one direction, (step, window, unit), and what going back needs."""
        recur, h = self.weights["u" + side], np.zeros((len(windows), HIDDEN), dtype=F32)
        states = np.zeros((WINDOW, len(windows), HIDDEN), dtype=F32)
        saved = []
        for t in range(WINDOW) if side == "f" else range(WINDOW - 1, -1, -1):
            x, on = projected[windows[:, t]], windows[:, t] >= 0
            g = h @ recur
            gates = _sigmoid(x[:, : 2 * HIDDEN] + g[:, : 2 * HIDDEN])
            z, r = gates[:, :HIDDEN], gates[:, HIDDEN:]
            n = 2 * _sigmoid(2 * (x[:, 2 * HIDDEN :] + r * g[:, 2 * HIDDEN :])) - 1
            new = np.where(on[:, None], n + z * (h - n), h)
            if keep:
                saved.append((t, on, z, r, n, g[:, 2 * HIDDEN :], h))
            h = states[t] = new
        return states, saved

    def forward(self, vectors: np.ndarray, windows: np.ndarray, keep: bool = False) -> tuple[np.ndarray, dict]:
        """Logit of each window."""
        w = self.weights
        parts = {}
        for side in "fb":
            projected = np.r_[vectors @ w["w" + side] + w["b" + side], np.zeros((1, 3 * HIDDEN), dtype=F32)]
            parts[side] = self._read(side, projected, windows, keep)
        states = np.concatenate([parts["f"][0], parts["b"][0]], axis=2)
        on = (windows >= 0).T
        level = np.where(on, states @ w["attend"], -1e9)
        share = np.exp(level - level.max(axis=0)) * on
        share /= np.maximum(share.sum(axis=0), 1e-9)
        pooled = (share[:, :, None] * states).sum(axis=0)
        return pooled @ w["out"] + w["bias"][0], {"parts": parts, "states": states, "share": share, "pooled": pooled}

    def _back(self, side: str, saved: list, d_states: np.ndarray, windows: np.ndarray, words: int, grads: dict) -> np.ndarray:
        """Gradient of the projected inputs of each distinct word, in one direction."""
        recur = self.weights["u" + side]
        d_h = np.zeros((len(windows), HIDDEN), dtype=F32)
        d_recur = np.zeros_like(recur)
        d_x = np.zeros((WINDOW, len(windows), 3 * HIDDEN), dtype=F32)
        for t, on, z, r, n, g, h in reversed(saved):
            d = d_h + d_states[t]
            new = d * on[:, None]
            d_n = new * (1 - z) * (1 - n * n)
            d_z = new * (h - n) * z * (1 - z)
            d_r = d_n * g * r * (1 - r)
            d_g = np.concatenate([d_z, d_r, d_n * r], axis=1)
            d_x[t] = np.concatenate([d_z, d_r, d_n], axis=1)
            d_recur += h.T @ d_g
            d_h = d - new + new * z + d_g @ recur.T
        grads["u" + side] = d_recur
        flat = windows.T.ravel()
        order = np.argsort(flat, kind="stable")
        begin = np.searchsorted(flat[order], np.arange(words + 1))
        sums = np.zeros((words, 3 * HIDDEN), dtype=F32)
        used = np.flatnonzero(begin[1:] > begin[:-1])
        if len(used):
            sums[used] = np.add.reduceat(d_x.reshape(-1, 3 * HIDDEN)[order], begin[used], axis=0)
        return sums

    def step(self, given: Inputs, toxic: np.ndarray) -> float:
        """One update on whole texts; their mean loss."""
        w, words = self.weights, len(given.entry)
        vectors = self.vectors(given)
        logit, kept = self.forward(vectors, given.windows, keep=True)
        p = np.clip(_sigmoid(logit), 1e-6, 1 - 1e-6)
        begin = np.flatnonzero(np.r_[True, given.text[1:] != given.text[:-1]])
        none = np.exp(np.add.reduceat(np.log1p(-p), begin))
        some = np.clip(1 - none, 1e-6, 1)
        # d loss / d logit of a window: its p where the text is clean, else shared by what the others explain
        d_logit = np.where(toxic[given.text], -p * (none / some)[given.text], p) / len(begin)
        d_logit = d_logit.astype(F32)
        grads: dict[str, np.ndarray] = {"out": kept["pooled"].T @ d_logit, "bias": np.array([d_logit.sum()], dtype=F32)}
        d_pooled = d_logit[:, None] * w["out"]
        share, states = kept["share"], kept["states"]
        d_share = (states * d_pooled).sum(axis=2)
        d_level = share * (d_share - (share * d_share).sum(axis=0))
        grads["attend"] = np.tensordot(d_level, states, axes=([0, 1], [0, 1]))
        d_states = share[:, :, None] * d_pooled + d_level[:, :, None] * w["attend"]
        d_vectors = np.zeros_like(vectors)
        for side, part in (("f", slice(0, HIDDEN)), ("b", slice(HIDDEN, None))):
            d_projected = self._back(side, kept["parts"][side][1], d_states[:, :, part], given.windows, words, grads)
            grads["w" + side] = vectors.T @ d_projected
            grads["b" + side] = d_projected.sum(axis=0)
            d_vectors += d_projected @ w["w" + side].T
        grads["word"] = np.zeros_like(w["word"])
        np.add.at(grads["word"], given.entry, d_vectors)
        count = np.maximum(np.bincount(given.of_word, minlength=words), 1)[:, None]
        grads["trigram"] = np.zeros_like(w["trigram"])
        np.add.at(grads["trigram"], given.trigram, (d_vectors / count)[given.of_word])
        grads["word"][0] = 0
        self._adam(grads)
        return float(-np.mean(np.where(toxic, np.log(some), np.log(np.maximum(none, 1e-30)))))

    def _adam(self, grads: dict[str, np.ndarray]) -> None:
        self.updates += 1
        for name, grad in grads.items():
            m = self.first[name] = 0.9 * self.first.get(name, 0) + 0.1 * grad
            v = self.second[name] = 0.99 * self.second.get(name, 0) + 0.01 * grad * grad
            fix = np.sqrt(1 - 0.99**self.updates) / (1 - 0.9**self.updates)
            kept = 1 - DECAY if name in ("word", "trigram") else 1
            self.weights[name] = (kept * self.weights[name] - RATE * fix * m / (np.sqrt(v) + 1e-8)).astype(F32)

    def logits(self, column: pa.Array) -> np.ndarray:
        """Highest window logit of each text."""
        given = inputs(column, self.vocabulary)
        vectors = self.vectors(given)
        found = [self.forward(vectors, given.windows[i : i + BATCH])[0] for i in range(0, len(given.windows), BATCH)]
        begin = np.searchsorted(given.text, np.arange(len(column)))
        return np.maximum.reduceat(np.concatenate(found), begin).astype(np.float64)

    def score(self, column: pa.Array) -> np.ndarray:
        """Calibrated probability of label 1."""
        if self.rate is not None:
            return np.full(len(column), self.rate)
        return _sigmoid(np.clip(self.scale * self.logits(column) + self.shift, -50, 50))


def _start(vocabulary: Index) -> Network:
    random = np.random.default_rng(SEED)

    def normal(*shape: int, by: float) -> np.ndarray:
        return (random.standard_normal(shape) * by).astype(F32)

    weights = {"word": np.zeros((len(vocabulary.keys) + 1, INPUT), dtype=F32), "trigram": normal(TRIGRAMS, INPUT, by=0.05)}
    for side in "fb":
        weights["w" + side] = normal(INPUT, 3 * HIDDEN, by=INPUT**-0.5)
        weights["u" + side] = normal(HIDDEN, 3 * HIDDEN, by=HIDDEN**-0.5)
        weights["b" + side] = np.zeros(3 * HIDDEN, dtype=F32)
    weights |= {"attend": normal(2 * HIDDEN, by=0.1), "out": normal(2 * HIDDEN, by=0.3), "bias": np.array([-3.0], dtype=F32)}
    return Network(vocabulary, weights)


def _vocabulary(texts: list[str]) -> Index:
    """Words of at least ``SEEN`` texts."""
    seen = []
    for text in texts:
        seen.append(np.unique(split(pa.array([text], pa.string()), ALNUM, lower=True).hashes))
    keys, count = np.unique(np.concatenate(seen), return_counts=True)
    return Index(keys[count >= SEEN])


def _calibrate(network: Network, texts: list[str], toxic: np.ndarray, weight: np.ndarray) -> None:
    """Logistic fit of the labels to the logits, weighted to the labels' true rate."""
    x = np.concatenate([network.logits(pa.array(texts[i : i + 64], pa.string())) for i in range(0, len(texts), 64)])
    center, spread = float(x.mean()), float(x.std()) or 1.0
    x = (x - center) / spread
    a, b = 1.0, 0.0
    for _ in range(500):
        error = (_sigmoid(np.clip(a * x + b, -50, 50)) - np.clip(toxic, 0.01, 0.99)) * weight
        a -= 2.0 * float((error * x).sum() / weight.sum())
        b -= 2.0 * float(error.sum() / weight.sum())
    network.scale, network.shift = max(a, 0.01) / spread, b - max(a, 0.01) * center / spread


def fit(texts: list[str], toxic: list[int], aside: list[bool], rates: tuple[int, int]) -> Network:
    """Network for labelled texts; ``rates`` counts the clean and the toxic of all labels."""
    label, kept = np.array(toxic, dtype=bool), np.array(aside, dtype=bool)
    if not sum(rates) or not min(rates) or len(set(label[~kept].tolist())) < 2:
        return Network(Index(np.zeros(0, dtype=U64)), {}, rate=rates[1] / max(sum(rates), 1))
    rows = np.flatnonzero(~kept)
    network = _start(_vocabulary([texts[i] for i in rows]))
    random = np.random.default_rng(SEED)
    queue: list[int] = []
    for _ in range(UPDATES):
        batch, size = [], 0
        while size < UPDATE_WINDOWS and len(batch) < 64:
            queue = queue or random.permutation(rows).tolist()
            batch.append(queue.pop())
            size += max(len(texts[batch[-1]]) // (6 * STRIDE), 1)
        network.step(inputs(pa.array([texts[i] for i in batch], pa.string()), network.vocabulary), label[batch])
    test = np.flatnonzero(kept) if len(set(label[kept].tolist())) == 2 else np.arange(len(texts))
    share = np.array([rates[int(v)] / max(int((label[test] == v).sum()), 1) for v in (False, True)])
    _calibrate(network, [texts[i] for i in test], label[test].astype(float), share[label[test].astype(int)])
    network.first, network.second = {}, {}
    return network


def train(docs: DataFrame, labels: DataFrame, size: int = SAMPLE) -> Network:
    """Network learned from ``doc_id, text`` and ``doc_id, toxic`` rows."""
    ready(docs.sparkSession)
    marks = labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("toxic").cast("int").alias("toxic")).filter("toxic IN (0, 1)").distinct()
    marks = marks.withColumn("h", F.xxhash64(F.lit(SEED), "doc_id"))
    counts = {r["toxic"]: r["n"] for r in marks.groupBy("toxic").agg(F.count(F.lit(1)).alias("n")).collect()}
    least = top_per_group(marks, ["toxic"], ["h", "doc_id"], CLEAN * size, "rank").filter((F.col("toxic") == 0) | (F.col("rank") <= size))
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")).filter("text IS NOT NULL")
    sample = texts.join(F.broadcast(least), "doc_id").select("toxic", "h", "text").distinct()  # at most (1 + CLEAN) * size ids
    rows = sorted(sample.collect(), key=lambda r: (r["h"], r["toxic"], r["text"]))
    aside = [r["h"] % 5 == 0 for r in rows]
    return fit([r["text"] for r in rows], [r["toxic"] for r in rows], aside, (counts.get(0, 0), counts.get(1, 0)))


def _scores(network):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for piece in pieces(batches, limit=1 << 20):
            score = network.value.score(piece.column("text"))
            yield pa.RecordBatch.from_pydict({"doc_id": piece.column("doc_id"), "score": pa.array(score, pa.float64())})

    return run


def score_toxicity(docs: DataFrame, network: Network) -> DataFrame:
    """``doc_id, score`` for every row of ``doc_id, text``."""
    ready(docs.sparkSession)
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return docs.mapInArrow(_scores(docs.sparkSession.sparkContext.broadcast(network)), "doc_id long, score double")
