"""Language of documents by character models with interpolated Kneser-Ney smoothing.

Each language has a model of ``ORDER`` characters, learned from at most ``SAMPLE``
distinct texts of it (those with the least seeded hash). A text is reduced to
lower-case letters and single spaces. The model's probabilities and back-off weights
are kept in arrays sorted by the hash of the n-gram; the languages' arrays are united,
so that one look-up gives all of them, with what the others back off to filled in.

The language with the lowest cross-entropy per character wins. The score is a
logistic function of its lead over the second. A text is rejected if its
cross-entropy is nearer to that of shuffled letters than to that of the language
(``FAR`` of the way, more for short texts); both, and the score, are calibrated on a
fifth of the sample that counts nothing (all of a language with too few texts; one
whose texts all fall into that fifth is learned from them too). All other texts are
only read; the model, bounded by the sample, is broadcast.

Results for the odd cases: NULL texts and texts without a letter are ``und`` with
score 0 and rejected; so is everything when nothing can be learned; with one language
the score is 1; training rows without language are ignored; rows that repeat an id
are predicted each; an empty table gives an empty result; further columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from planefold.llm.ship import ready
from planefold.llm.words import U64, mix, pieces
from planefold.operators.ordering import top_per_group
from planefold.operators.sizing import small_side

ORDER = 4
SAMPLE = 2000
SEED = 7
ALPHABET = 2000
PART = 1 << 18
FAR = 0.8
SHORT = 3.0
UNKNOWN = "und"
_SPACE = 32
_letters: list[np.ndarray] = []


def _letter_table() -> np.ndarray:
    """Lower-case letter of every code point; a space for all that are no letters."""
    if not _letters:
        table = np.full(0x110000, _SPACE, dtype=np.uint32)
        for code in range(0x110000):
            if chr(code).isalpha():
                table[code] = ord(chr(code).lower()[0])
        _letters.append(table)
    return _letters[0]


def letters_of(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Letters and single spaces of all texts, each after ``ORDER - 1`` spaces and before one; and their bounds."""
    codes = _letter_table()[np.frombuffer("".join(texts).encode("utf-32-le", "surrogatepass"), dtype="<u4")]
    row = np.repeat(np.arange(len(texts)), [len(t) for t in texts])
    before = np.r_[_SPACE, codes[:-1]] if len(codes) else codes
    before[np.flatnonzero(np.r_[True, row[1:] != row[:-1]])[: len(codes)]] = _SPACE
    keep = (codes != _SPACE) | (before != _SPACE)
    codes, row = codes[keep], row[keep]
    count = np.bincount(row, minlength=len(texts))
    bounds = np.r_[0, np.cumsum(count + ORDER)]
    out = np.full(bounds[-1], _SPACE, dtype=U64)
    out[np.arange(len(codes)) + (row + 1) * ORDER - 1] = codes
    return out, bounds


def _grams(codes: np.ndarray, order: int) -> np.ndarray:
    """Hash of the last ``order`` characters at each position."""
    total = np.zeros(len(codes), dtype=U64)
    for back in range(order):
        part = codes[: len(codes) - back] if back else codes
        total[back:] += part * U64(pow(0x9E3779B97F4A7C15, back + 1, 1 << 64))
    return mix(total + U64(order))


def _grams_at(codes: np.ndarray, at: np.ndarray, order: int) -> np.ndarray:
    """The same at some positions only."""
    total = np.zeros(len(at), dtype=U64)
    for back in range(order):
        total += codes[at - back] * U64(pow(0x9E3779B97F4A7C15, back + 1, 1 << 64))
    return mix(total + U64(order))


def _predicted(bounds: np.ndarray) -> np.ndarray:
    """Positions of the characters to predict: all but the spaces before a text."""
    position = np.ones(bounds[-1], dtype=bool)
    for back in range(ORDER - 1):
        position[bounds[:-1] + back] = False
    return np.flatnonzero(position)


def _counted(texts: list[str]) -> dict:
    """Distinct n-grams of the highest order with their count, and the lower orders' hashes of each."""
    codes, bounds = letters_of(texts)
    at = _predicted(bounds)
    hashes = {k: _grams(codes, k) for k in range(1, ORDER + 1)}
    _, first, count = np.unique(hashes[ORDER][at], return_index=True, return_counts=True)
    at = at[first]
    before = {f"before {k}": hashes[k - 1][at - 1] for k in range(2, ORDER + 1)}
    return {**{k: h[at] for k, h in hashes.items()}, **before, "count": count}


def learn(texts: list[str]) -> list[dict]:
    """Kneser-Ney tables of one language, order 1 first.

    ``keys`` with ``suffix`` (next lower order), ``context`` and log-probability;
    ``contexts`` with log-weight of the lower order; ``rest`` for unseen characters.
    """
    parts, start, chars = [], 0, 0
    for i, text in enumerate(texts):
        chars += len(text)
        if chars >= PART or i + 1 == len(texts):
            parts.append(_counted(texts[start : i + 1]))
            start, chars = i + 1, 0
    found = {name: np.concatenate([p[name] for p in parts]) for name in parts[0]}
    _, first, group = np.unique(found[ORDER], return_index=True, return_inverse=True)
    count = np.bincount(group, weights=found["count"]).astype(np.int64)
    found = {name: values[first] for name, values in found.items()}
    at = np.arange(len(first))
    counted = [(at, count)]
    for k in range(ORDER - 1, 0, -1):
        _, first, count = np.unique(found[k][at], return_index=True, return_counts=True)
        at = at[first]
        counted.append((at, count))
    tables: list[dict] = []
    for k, (at, count) in enumerate(reversed(counted), 1):
        once, twice = int((count == 1).sum()), int((count == 2).sum())
        discount = once / (once + 2 * twice) if once and twice else 0.5
        keys = found[k][at]
        context = found[f"before {k}"][at] if k > 1 else np.zeros(len(at), dtype=U64)
        contexts, group = np.unique(context, return_inverse=True)
        total = np.bincount(group, weights=count)
        weight = discount * np.bincount(group) / total
        lower = np.full(len(at), 1 / ALPHABET)
        suffix = np.zeros(len(at), dtype=U64)
        if k > 1:
            suffix = found[k - 1][at]
            lower = np.exp(tables[-1]["logp"][np.searchsorted(tables[-1]["keys"], suffix)])
        logp = np.log((count - discount) / total[group] + weight[group] * lower)
        tables.append({"keys": keys, "suffix": suffix, "context": context, "logp": logp, "contexts": contexts, "weight": np.log(weight), "rest": float(np.log(weight[0] / ALPHABET))})
    return tables


class Index:
    """Sorted hashes with a table of where each leading part begins."""

    def __init__(self, keys: np.ndarray) -> None:
        self.keys = keys
        self.shift = U64(64 - max(1, len(keys).bit_length()))
        parts = 1 << (64 - int(self.shift))
        self.begin = np.searchsorted(keys, np.arange(parts, dtype=U64) << self.shift)

    def find(self, wanted: np.ndarray) -> np.ndarray:
        """Position of each hash, -1 where there is none."""
        found = np.full(len(wanted), -1)
        left = np.arange(len(wanted))
        at = self.begin[wanted >> self.shift]
        while len(left):
            inside = at < len(self.keys)
            left, at = left[inside], at[inside]
            key, want = self.keys[at], wanted[left]
            hit = key == want
            found[left[hit]] = at[hit]
            on = key < want
            left, at = left[on], at[on] + 1
        return found


class Model:
    """United tables of all languages."""

    def __init__(self, tables: dict[str, list[dict]]) -> None:
        self.names = sorted(tables)
        self.rest = np.array([tables[x][0]["rest"] for x in self.names], dtype=np.float32)
        self.grams: list[Index] = []
        self.logp: list[np.ndarray] = []
        self.contexts: list[Index] = []
        self.weight: list[np.ndarray] = []
        self.cut = np.full(len(self.names), np.inf)
        self.slope = 1.0
        for k in range(ORDER if self.names else 0):
            own = [tables[x][k] for x in self.names]
            keys, first = np.unique(np.concatenate([t["keys"] for t in own]), return_index=True)
            contexts = np.unique(np.concatenate([t["contexts"] for t in own]))
            weight = np.zeros((len(contexts), len(own)), dtype=np.float32)
            for i, t in enumerate(own):
                weight[np.searchsorted(contexts, t["contexts"]), i] = t["weight"]
            context = np.concatenate([t["context"] for t in own])[first]
            suffix = np.concatenate([t["suffix"] for t in own])[first]
            lower = self.rest - weight[0] if k == 0 else self.logp[-1][np.searchsorted(self.grams[-1].keys, suffix)]
            logp = (lower + weight[np.searchsorted(contexts, context)]).astype(np.float32)
            for i, t in enumerate(own):
                logp[np.searchsorted(keys, t["keys"]), i] = t["logp"]
            self.grams.append(Index(keys))
            self.logp.append(logp)
            self.contexts.append(Index(contexts))
            self.weight.append(weight)

    def _log(self, codes: np.ndarray, at: np.ndarray, k: int) -> np.ndarray:
        """Log-probabilities (position, language) of characters after ``k - 1`` others."""
        if not k:
            return np.broadcast_to(self.rest, (len(at), len(self.names)))
        found = self.grams[k - 1].find(_grams_at(codes, at, k) if len(at) < len(codes) // 2 else _grams(codes, k)[at])
        out = self.logp[k - 1][found]
        miss = np.flatnonzero(found < 0)
        if len(miss):
            out[miss] = self._log(codes, at[miss], k - 1)
            if k > 1:
                context = self.contexts[k - 1].find(_grams_at(codes, at[miss] - 1, k - 1))
                seen = context >= 0
                out[miss[seen]] += self.weight[k - 1][context[seen]]
        return out

    def entropies(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Cross-entropy per character (text, language), characters, and which texts have a letter."""
        parts, start, chars = [], 0, 0
        for i, text in enumerate(texts):
            chars += len(text)
            if chars >= PART or i + 1 == len(texts):
                parts.append(self._entropies(texts[start : i + 1]))
                start, chars = i + 1, 0
        return tuple(np.concatenate(x) for x in zip(*parts))

    def _entropies(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        codes, bounds = letters_of(texts)
        at = _predicted(bounds)
        size = np.diff(bounds) - ORDER + 1
        start = np.cumsum(size) - size
        total = np.add.reduceat(self._log(codes, at, ORDER), start, axis=0)
        return -total / size[:, None], size, np.add.reduceat(codes[at] != _SPACE, start) > 0

    def predict(self, texts: list[str]) -> dict[str, np.ndarray]:
        """Language, score, cross-entropy and rejection of each text."""
        if not self.names or not texts:
            n = len(texts)
            return {"lang_pred": np.full(n, UNKNOWN, dtype=object), "score": np.zeros(n), "entropy": np.zeros(n), "rejected": np.ones(n, dtype=bool)}
        entropy, size, some = self.entropies(texts)
        best = entropy.argmin(axis=1)
        least = entropy.min(axis=1)
        second = np.partition(entropy, 1, axis=1)[:, 1] if len(self.names) > 1 else np.full(len(texts), np.inf)
        score = 1 / (1 + np.exp(-np.minimum(self.slope * (second - least), 50)))
        names = np.array(self.names, dtype=object)
        return {
            "lang_pred": np.where(some, names[best], UNKNOWN),
            "score": np.where(some, score, 0.0),
            "entropy": np.where(some, least, 0.0),
            "rejected": ~some | (least > self.cut[best] + SHORT / np.sqrt(size)),
        }

    def calibrate(self, texts: list[str], names: list[str]) -> None:
        """Fit the score's slope and each language's rejection limit on texts that counted nothing."""
        kept = [(t, n) for t, n in zip(texts, names) if n in self.names]
        if not kept:
            return
        entropy, _, some = self.entropies([t for t, _ in kept])
        random = np.random.default_rng(SEED)
        shuffled, _, _ = self.entropies(["".join(random.permutation(list(t))) for t, _ in kept])
        true = np.array([self.names.index(n) for _, n in kept])
        for i in range(len(self.names)):
            own = (true == i) & some
            if own.any():
                self.cut[i] = (1 - FAR) * entropy[own, i].mean() + FAR * shuffled[own, i].mean()
        if len(self.names) > 1:
            right = entropy.argmin(axis=1) == true
            lead = np.partition(entropy, 1, axis=1)[:, 1] - entropy.min(axis=1)
            slopes = np.geomspace(0.5, 200, 60)
            chance = 1 / (1 + np.exp(-np.clip(slopes[:, None] * lead, 0, 50)))  # one row per slope
            share = np.where(right, chance, 1 - chance)
            self.slope = float(slopes[np.log(np.maximum(share, 1e-9)).mean(axis=1).argmax()])


_TABLE = "lang string, k int, keys binary, suffix binary, context binary, logp binary, contexts binary, weight binary, rest double"


def _learned(group: pd.DataFrame) -> pd.DataFrame:
    """Tables of the language of a group, bounded by the sample."""
    tables = learn(group.sort_values("h")["text"].tolist())
    rows = [{"lang": group["lang"].iloc[0], "k": k, **{x: t[x].tobytes() for x in ("keys", "suffix", "context", "logp", "contexts", "weight")}, "rest": t["rest"]} for k, t in enumerate(tables)]
    return pd.DataFrame(rows)


def _sample(train: DataFrame, size: int) -> DataFrame:
    """At most ``size`` distinct texts of each language, with their hash."""
    lang = F.col("lang").cast("string")
    rows = train.select(lang.alias("lang"), F.col("text").cast("string").alias("text")).filter(r"lang IS NOT NULL AND text RLIKE '\\p{L}'")
    rows = rows.withColumn("h", F.xxhash64(F.lit(SEED), "text"))
    least = top_per_group(rows.select("lang", "h").distinct(), ["lang"], ["h"], size, "rank")
    cut = least.groupBy("lang").agg(F.max("h").alias("cut"))
    return rows.join(small_side(cut), "lang").filter("h <= cut").dropDuplicates(["lang", "h"]).select("lang", "text", "h")


def _tables(sample: DataFrame) -> dict[str, list[dict]]:
    """Tables of each language of ``sample``."""
    tables: dict[str, list[dict]] = {}
    for row in sample.groupBy("lang").applyInPandas(_learned, _TABLE).orderBy("lang", "k").collect():
        kinds = {"keys": U64, "suffix": U64, "context": U64, "logp": np.float64, "contexts": U64, "weight": np.float64}
        tables.setdefault(row["lang"], []).append({**{x: np.frombuffer(row[x], dtype=kind) for x, kind in kinds.items()}, "rest": row["rest"]})
    return tables


def train_model(train: DataFrame, size: int = SAMPLE) -> Model:
    """Model of the languages of ``lang, text`` rows."""
    ready(train.sparkSession)
    sample = _sample(train, size).withColumn("aside", F.pmod(F.xxhash64(F.lit(SEED + 1), "text"), F.lit(5)) == 0)
    tables = _tables(sample.filter("NOT aside"))
    aside = sample.filter("aside").select("lang", "text").collect()
    unlearned = sorted({r["lang"] for r in aside} - tables.keys())
    if unlearned:
        tables |= _tables(sample.filter(F.col("lang").isin(unlearned)))
    model = Model(dict(sorted(tables.items())))
    bare = [name for name in model.names if name not in {r["lang"] for r in aside}]
    if bare:
        aside += sample.filter(F.col("lang").isin(bare)).select("lang", "text").collect()
    model.calibrate([r["text"] for r in aside], [r["lang"] for r in aside])
    return model


def _predictions(model):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for piece in pieces(batches, limit=1 << 20):
            found = model.value.predict([t or "" for t in piece.column("text").to_pylist()])
            yield pa.RecordBatch.from_pydict(
                {
                    "doc_id": piece.column("doc_id"),
                    "lang_pred": pa.array(found["lang_pred"], pa.string()),
                    "score": pa.array(found["score"], pa.float64()),
                    "entropy": pa.array(found["entropy"], pa.float64()),
                    "rejected": pa.array(found["rejected"], pa.bool_()),
                }
            )

    return run


def identify(docs: DataFrame, model: Model) -> DataFrame:
    """``doc_id, lang_pred, score, entropy, rejected`` for every row of ``doc_id, text``."""
    ready(docs.sparkSession)
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    sent = docs.sparkSession.sparkContext.broadcast(model)
    return docs.mapInArrow(_predictions(sent), "doc_id long, lang_pred string, score double, entropy double, rejected boolean")


def _known(model):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for piece in pieces(batches, limit=1 << 20):
            found = model.value.predict([t or "" for t in piece.column("text").to_pylist()])
            yield piece.filter(pa.array(~found["rejected"]))

    return run


def keep_known(docs: DataFrame, model: Model) -> DataFrame:
    """The rows of ``docs`` whose language is not rejected, with all their columns."""
    ready(docs.sparkSession)
    return docs.mapInArrow(_known(docs.sparkSession.sparkContext.broadcast(model)), docs.schema)
