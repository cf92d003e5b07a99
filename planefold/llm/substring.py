"""Removal of passages that an earlier document has, by difference-cover anchors.

A passage is repeated if a window of ``LENGTH`` words also starts in a document
with a smaller id. The positions ``p`` with ``p mod 7`` in {0, 1, 3} form a
difference cover: for any two positions there is a shift below 7 that brings both
into it. So two equal windows of 13 words, wherever they start, contain an equal
run of 13 - 6 = 7 words that begins at a covered position in both. Only these runs
(3 of 7 positions) are hashed and shuffled; windows around runs that two documents
share are then compared by 96-bit hashes. (Anchors only propose; half their hash will do.)

Hot passages: a piece of input sends each hash once, for its smallest document; the
others of the piece have their answer on the spot. No join or group has all rows
of a hash.

Results for the odd cases: NULL or empty text has no words and an empty kept text;
a NULL id neither takes words from others nor loses any; rows that repeat an id
never remove from each other; an empty table gives an empty result; further
columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import compress

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from planefold.llm import packed
from planefold.llm.ship import ready
from planefold.llm.words import GRAPH, U64, Words, longs, pieces, ranges, span_hashes, split

LENGTH = 13
PERIOD = 7
COVER = (0, 1, 3)
ANCHOR = LENGTH - PERIOD + 1


def _covered(words: Words) -> tuple[np.ndarray, np.ndarray]:
    """First word (of all words) and hash of each anchor, in texts that have a window."""
    counts = np.where(words.counts >= LENGTH, words.counts - ANCHOR + 1, 0)
    begin = ranges(words.first[:-1], counts)
    place = begin - np.repeat(words.first[:-1], counts)
    begin = begin[np.isin(place % PERIOD, COVER)]
    return begin, span_hashes(words.hashes, begin, begin + ANCHOR)


def _with_id(piece: pa.RecordBatch) -> tuple[pa.RecordBatch, np.ndarray]:
    ids, valid = longs(piece.column("doc_id"))
    return piece.filter(pa.array(valid)), ids[valid]


def _anchor_rows(n: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for piece in pieces(batches):
            piece, ids = _with_id(piece)
            words = split(piece.column("text"), GRAPH, lower=False)
            begin, hashes = _covered(words)
            doc, a = packed.sorted_unique(ids[words.text_of()[begin]], hashes)
            start = packed.starts(a)
            yield from packed.pack(packed.by_hash(a[start], n), doc[start], packed.high(a[start]))
            size = np.diff(np.r_[start, len(doc)])
            shared = np.repeat(size > 1, size)
            yield from packed.tell(doc[shared], packed.high(a[shared]), None, n)

    return run


def _shared(n: int):
    """Tell each document its anchors that another one has."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        through: list = []
        doc, a = packed.sorted_unique(*packed.unpack(batches, (packed.U32,), through))
        yield from through
        size = np.diff(np.r_[packed.starts(a), len(doc)])
        shared = np.repeat(size > 1, size)
        yield from packed.tell(doc[shared], a[shared], None, n)

    return run


def _told(piece: pa.RecordBatch, row: int, kind) -> np.ndarray:
    return np.frombuffer(piece.column("hashes")[row].as_py(), dtype=kind)


def _later(*keys: np.ndarray) -> np.ndarray:
    """Entries whose key a smaller document has too."""
    later = np.ones(len(keys[0]), dtype=bool)
    later[packed.starts(*keys)] = False
    return later


def _window_rows(n: int):
    """Windows around shared anchors, for the texts that have any."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for piece in pieces(batches):
            piece, ids = _with_id(piece.filter(piece.column("hashes").is_valid()))
            if not piece.num_rows:
                continue
            words = split(piece.column("text"), GRAPH, lower=False)
            begin, hashes = _covered(words)
            hashes = packed.high(hashes)
            row = words.text_of()
            bounds = np.searchsorted(row[begin], np.arange(piece.num_rows + 1))
            around = np.zeros(len(words.start) + PERIOD, dtype=np.int64)
            for i in range(piece.num_rows):
                own = slice(bounds[i], bounds[i + 1])
                hit = begin[own][np.isin(hashes[own], _told(piece, i, packed.U32))]
                np.add.at(around, np.maximum(hit - PERIOD + 1, words.first[i]), 1)
                np.add.at(around, hit + 1, -1)
            at, first = words.windows(LENGTH)
            near = np.cumsum(around)[at] > 0
            at, first = at[near], first[near]
            second = packed.high(words.windows(LENGTH, 1)[1][near])
            doc, a, b = packed.sorted_unique(ids[row[at]], first, second)
            later = _later(a, b)
            yield from packed.pack(packed.by_hash(a[~later], n), doc[~later], a[~later], b[~later])
            yield from packed.tell(doc[later], a[later], None, n)

    return run


def _repeated(n: int):
    """Tell each document its windows that a smaller id has."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        through: list = []
        doc, a, b = packed.sorted_unique(*packed.unpack(batches, (U64, packed.U32), through))
        yield from through
        later = _later(a, b)
        yield from packed.tell(doc[later], a[later], None, n)

    return run


def _cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for piece in pieces(batches):
        texts = [(x or "").encode().split() for x in piece.column("text").to_pylist()]
        told = np.asarray(piece.column("hashes").is_valid())
        keep: dict[int, np.ndarray] = {}
        noted = np.flatnonzero(told)
        if len(noted):
            part = piece.take(pa.array(noted))
            words = split(part.column("text"), GRAPH, lower=False)
            at, hashes = words.windows(LENGTH)
            bounds = np.searchsorted(at, words.first)
            for i, row in enumerate(noted):
                own = slice(bounds[i], bounds[i + 1])
                hit = at[own][np.isin(hashes[own], _told(part, i, U64))] - words.first[i]
                cover = np.zeros(len(texts[row]) + 1, dtype=np.int64)
                np.add.at(cover, hit, 1)
                np.add.at(cover, hit + LENGTH, -1)
                keep[int(row)] = np.cumsum(cover[:-1]) == 0
        removed = [int((~keep[i]).sum()) if i in keep else 0 for i in range(len(texts))]
        kept = [b" ".join(compress(t, keep[i]) if i in keep else t) for i, t in enumerate(texts)]
        yield pa.RecordBatch.from_pydict(
            {
                "doc_id": piece.column("doc_id"),
                "n_words": pa.array([len(t) for t in texts], pa.int64()),
                "n_removed": pa.array(removed, pa.int64()),
                "kept": pa.array(kept, pa.string()),
            }
        )


def remove_repeated(docs: DataFrame) -> DataFrame:
    """``doc_id, n_words, n_removed, kept`` for every row of ``doc_id, text``."""
    ready(docs.sparkSession)
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    n = packed.buckets(docs)
    anchors = packed.deal(docs.mapInArrow(_anchor_rows(n), packed.PACKED))
    shared = packed.by_document(anchors.mapInArrow(_shared(n), packed.PACKED), packed.U32)
    windows = packed.deal(docs.join(shared, "doc_id", "left").mapInArrow(_window_rows(n), packed.PACKED))
    repeated = packed.by_document(windows.mapInArrow(_repeated(n), packed.PACKED), U64)
    return docs.join(repeated, "doc_id", "left").mapInArrow(_cut, "doc_id long, n_words long, n_removed long, kept string")
