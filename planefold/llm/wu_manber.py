"""Benchmark passages in documents, by a Wu-Manber search over words.

A pattern is a run of ``WINDOW`` words of an item, or all words of a shorter item.
For each pattern length m there are two tables over blocks of ``min(2, m)`` words:

* the shift table says how far a window may move when its last block is this one;
  a block that no pattern has lets it skip ``m - 1`` words or more unseen;
* where the shift is 0, the block selects a bucket of patterns that end with it.
  These are compared word by word (by the 64-bit hash of each word).

Blocks index the shift table by their hash; blocks that collide keep the smaller
shift, so nothing is missed. Many positions move at once, as numpy arrays, each
over a stretch of its own.

The patterns of up to ``BLOCK_WORDS`` benchmark words go to the executors at a time;
a larger benchmark takes several passes over the documents in one stage, each adding
to the spans found. No document is shuffled.

Results for the odd cases: NULL or blank text has no words; an item without words
or without id is not reported (without id it still marks words); rows that repeat an
item or a document are treated each on its own; an empty benchmark or table works;
further columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from planefold.llm.ship import ready
from planefold.llm.words import ALNUM, U64, Words, mix, pieces, ranges, split

WINDOW = 10
BLOCK_WORDS = 250_000
STRETCH = 256
TABLE_BITS = 20
FOUND = "doc_id long, {}n_words long, starts array<int>, stops array<int>, items array<string>"


def _block_hash(hashes: np.ndarray, last: np.ndarray, width: int) -> np.ndarray:
    """Hash of the ``width`` words up to position ``last``."""
    out = hashes[last]
    return out if width == 1 else mix(out ^ (hashes[last - 1] * U64(0x9E3779B97F4A7C15)))


class Patterns:
    """Shift table and suffix buckets of all patterns of ``m`` words."""

    def __init__(self, words: np.ndarray, items: np.ndarray) -> None:
        self.m = words.shape[1]
        self.width = min(2, self.m)
        flat = words.ravel()
        self.shift = np.full(1 << TABLE_BITS, self.m - self.width + 1, dtype=np.int32)
        base = np.arange(len(words)) * self.m
        for end in range(self.width - 1, self.m):
            block = _block_hash(flat, base + end, self.width)
            np.minimum.at(self.shift, self._slot(block), self.m - 1 - end)
        suffix = _block_hash(flat, base + self.m - 1, self.width)
        order = np.argsort(suffix, kind="stable")
        self.suffix, self.words, self.items = suffix[order], words[order], items[order]

    @staticmethod
    def _slot(block: np.ndarray) -> np.ndarray:
        return (block >> U64(64 - TABLE_BITS)).astype(np.int64)

    def find(self, words: Words) -> tuple[np.ndarray, np.ndarray]:
        """First word (of all words) and pattern number of every occurrence."""
        hashes, m = words.hashes, self.m
        fits = np.maximum(words.counts - m + 1, 0)
        lanes = -(-fits // STRETCH)
        step = ranges(np.zeros(len(lanes), dtype=np.int64), lanes) * STRETCH
        last = np.repeat(words.first[:-1] + m - 1, lanes) + step
        stop = np.minimum(last + STRETCH, np.repeat(words.first[1:], lanes))
        ends, suffixes = [], []
        while len(last):
            block = _block_hash(hashes, last, self.width)
            shift = self.shift[self._slot(block)]
            stay = shift == 0
            ends.append(last[stay])
            suffixes.append(block[stay])
            last = last + np.maximum(shift, 1)
            go = last < stop
            last, stop = last[go], stop[go]
        end, suffix = np.concatenate(ends or [np.zeros(0, np.int64)]), np.concatenate(suffixes or [np.zeros(0, U64)])
        low, high = np.searchsorted(self.suffix, suffix, "left"), np.searchsorted(self.suffix, suffix, "right")
        at = np.repeat(end - m + 1, high - low)
        pattern = ranges(low, high - low)
        for k in range(m):
            same = hashes[at + k] == self.words[pattern, k]
            at, pattern = at[same], pattern[same]
        return at, pattern


def patterns_of(texts: list[str | None], names: list[str | None]) -> list[Patterns]:
    """Tables of all windows of the items, one for each pattern length."""
    words = split(pa.array(texts, pa.string()), ALNUM, lower=True)
    name = np.array(["" if x is None else x for x in names], dtype=object)
    made = []
    for m in sorted({min(int(c), WINDOW) for c in words.counts if c}):
        fits = np.where((words.counts == m) | ((m == WINDOW) & (words.counts > m)), words.counts - m + 1, 0)
        begin = ranges(words.first[:-1], fits)
        made.append(Patterns(words.hashes[begin[:, None] + np.arange(m)], np.repeat(name, fits)))
    return made


def _union(first: np.ndarray, stop: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Disjoint spans that cover the same words of a text of ``n``."""
    cover = np.zeros(n + 1, dtype=np.int64)
    np.add.at(cover, first, 1)
    np.add.at(cover, stop, -1)
    hit = np.r_[False, np.cumsum(cover[:-1]) > 0, False]
    edge = np.flatnonzero(hit[1:] != hit[:-1])
    return edge[::2], edge[1::2]


def _scan(block, more: bool):
    """Add the spans and items of one block of patterns; hand the texts on if ``more`` follow."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tables = block.value
        for piece in pieces(batches):
            words = split(piece.column("text"), ALNUM, lower=True)
            row_of = words.text_of()
            found = [(at, np.full(len(at), t.m), t.items[p]) for t in tables for at, p in [t.find(words)]]
            at = np.concatenate([x[0] for x in found] or [np.zeros(0, np.int64)])
            width = np.concatenate([x[1] for x in found] or [np.zeros(0, np.int64)])
            item = np.concatenate([x[2] for x in found] or [np.zeros(0, object)])
            order = np.argsort(at, kind="stable")
            at, width, item = at[order], width[order], item[order]
            bounds = np.searchsorted(row_of[at] if len(at) else at, np.arange(piece.num_rows + 1))
            columns = {k: piece.column(k).to_pylist() for k in ("starts", "stops", "items")}
            for i in np.flatnonzero(np.diff(bounds)):
                own = slice(bounds[i], bounds[i + 1])
                first = np.r_[np.array(columns["starts"][i], dtype=np.int64), at[own] - words.first[i]]
                stop = np.r_[np.array(columns["stops"][i], dtype=np.int64), at[own] - words.first[i] + width[own]]
                first, stop = _union(first, stop, int(words.counts[i]))
                columns["starts"][i], columns["stops"][i] = first.tolist(), stop.tolist()
                columns["items"][i] = sorted({*columns["items"][i], *item[own].tolist()} - {""})
            yield pa.RecordBatch.from_pydict(
                {
                    "doc_id": piece.column("doc_id"),
                    **({"text": piece.column("text")} if more else {}),
                    "n_words": pa.array(words.counts, pa.int64()),
                    "starts": pa.array(columns["starts"], pa.list_(pa.int32())),
                    "stops": pa.array(columns["stops"], pa.list_(pa.int32())),
                    "items": pa.array(columns["items"], pa.list_(pa.string())),
                }
            )

    return run


def _blocks(benchmark: DataFrame, limit: int) -> Iterator[list[Patterns]]:
    """Tables of the items, at most about ``limit`` words (or one item) at a time."""
    texts: list = []
    names: list = []
    size = 0
    for row in benchmark.select(F.col("item_id").cast("string").alias("item"), F.col("text").cast("string").alias("text")).toLocalIterator():
        texts.append(row["text"])
        names.append(row["item"])
        size += len((row["text"] or "").split())
        if size >= limit:
            yield patterns_of(texts, names)
            texts, names, size = [], [], 0
    yield patterns_of(texts, names)


def benchmark_hits(docs: DataFrame, benchmark: DataFrame, block_words: int = BLOCK_WORDS) -> DataFrame:
    """``doc_id, n_words``, disjoint word spans ``starts, stops`` and ``items`` found, for every row."""
    spark = docs.sparkSession
    ready(spark)
    none = F.array().cast("array<int>")
    found = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")).withColumns(
        {"n_words": F.lit(0).cast("long"), "starts": none, "stops": none, "items": F.array().cast("array<string>")}
    )
    sent = [spark.sparkContext.broadcast(tables) for tables in _blocks(benchmark, block_words)]
    for i, tables in enumerate(sent):
        more = i + 1 < len(sent)
        found = found.mapInArrow(_scan(tables, more), FOUND.format("text string, " if more else ""))
    return found


def _without(block):
    """Leave rows out whose text has an occurrence."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tables = block.value
        for piece in pieces(batches):
            words = split(piece.column("text"), ALNUM, lower=True)
            hit = np.concatenate([t.find(words)[0] for t in tables] or [np.zeros(0, np.int64)])
            clean = np.ones(piece.num_rows, dtype=bool)
            clean[np.searchsorted(words.first, hit, "right") - 1] = False
            yield piece.filter(pa.array(clean))

    return run


def drop_contaminated(docs: DataFrame, benchmark: DataFrame, block_words: int = BLOCK_WORDS) -> DataFrame:
    """The rows of ``docs`` without any occurrence of a benchmark window, with all their columns."""
    spark = docs.sparkSession
    ready(spark)
    for tables in _blocks(benchmark, block_words):
        docs = docs.mapInArrow(_without(spark.sparkContext.broadcast(tables)), docs.schema)
    return docs


def contamination(found: DataFrame) -> DataFrame:
    """Per document: words, words hit, and the items with occurrences."""
    hit = F.aggregate(F.zip_with("stops", "starts", lambda b, a: (b - a).cast("long")), F.lit(0).cast("long"), lambda s, x: s + x)
    return found.select("doc_id", "n_words", hit.alias("n_hit"), F.size("items").cast("long").alias("n_items"), "items")
