"""Words of Arrow text columns as flat numpy arrays, and hashes over them.

A hash is a polynomial modulo 2**64 over random byte values, taken from prefix
sums, so that any span costs the same. It does not depend on where the span lies
and is the same in every process.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa

PIECE_BYTES = 2 << 20
U64 = np.uint64
_MASK = (1 << 64) - 1
_BASES = (0x9E3779B97F4A7C15, 0xD6E8FEB86659FD93)
#: An exponent is split here, so that the tables of powers stay small for the longest texts.
STEP_BITS = 12
STEP = 1 << STEP_BITS
_powers: dict[int, list[np.ndarray]] = {}


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection on 64 bits that spreads every input bit."""
    x = (x ^ (x >> U64(30))) * U64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> U64(27))) * U64(0x94D049BB133111EB)
    return x ^ (x >> U64(31))


def seeded(n: int, seed: int) -> np.ndarray:
    """``n`` random 64-bit values from a rule."""
    return mix(np.arange(1, n + 1, dtype=U64) * U64(_BASES[0]) + U64(seed))


_BYTE_VALUES = seeded(256, 11)


def _chain(factor: int, n: int) -> np.ndarray:
    """Powers 0..n - 1 of a factor modulo 2**64."""
    steps = np.full(n, factor & _MASK, dtype=U64)
    steps[0] = 1
    return np.multiply.accumulate(steps)


def _power_tables(n: int, which: int) -> list[np.ndarray]:
    """Powers of a base, then of its inverse: of the lower ``STEP_BITS`` of an exponent up to ``n``, and of the rest."""
    size = (n >> STEP_BITS) + 1
    if which not in _powers or len(_powers[which][1]) < size:
        factors = _BASES[which], pow(_BASES[which], -1, 1 << 64)
        _powers[which] = [t for f in factors for t in (_chain(f, STEP), _chain(pow(f, STEP, 1 << 64), max(size, 256)))]
    return _powers[which]


def span_hashes(values: np.ndarray, start: np.ndarray, stop: np.ndarray, which: int = 0) -> np.ndarray:
    """Hash of ``values[start:stop]`` for each pair of bounds."""
    low, up, low_inverse, up_inverse = _power_tables(len(values), which)
    whole = len(values) >> STEP_BITS
    cut = whole << STEP_BITS
    sums = np.zeros(len(values) + 1, dtype=U64)
    terms = sums[1:]
    rows = terms[:cut].reshape(-1, STEP)
    np.multiply(values[:cut].reshape(-1, STEP), low, out=rows)
    rows *= up[:whole, np.newaxis]
    np.multiply(values[cut:], low[: len(values) - cut] * up[whole], out=terms[cut:])
    np.cumsum(terms, out=terms)
    inverse = low_inverse[start & (STEP - 1)] * up_inverse[start >> STEP_BITS]
    return mix((sums[stop] - sums[start]) * inverse + (stop - start).astype(U64))


def inside_table(pattern_bytes: str) -> np.ndarray:
    """Which bytes belong to a word: ``graph`` (all but white space) or ``alnum``."""
    table = np.zeros(256, dtype=bool)
    if pattern_bytes == "graph":
        table[:] = True
        table[[0x20, *range(0x09, 0x0E)]] = False
    else:
        table[[*range(0x30, 0x3A), *range(0x61, 0x7B), *range(0x80, 0x100)]] = True
    return table


_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[0x41:0x5B] += 32
GRAPH, ALNUM = inside_table("graph"), inside_table("alnum")


@dataclass
class Words:
    """Words of several texts: byte bounds, hashes, and the first word of each text."""

    data: np.ndarray
    start: np.ndarray
    stop: np.ndarray
    first: np.ndarray
    hashes: np.ndarray

    @property
    def counts(self) -> np.ndarray:
        return np.diff(self.first)

    def text_of(self) -> np.ndarray:
        """Row number of each word."""
        return np.repeat(np.arange(len(self.first) - 1), self.counts)

    def windows(self, n: int, which: int = 0) -> tuple[np.ndarray, np.ndarray]:
        """Start (word number) and hash of each run of ``n`` words of one text."""
        fits = np.maximum(self.counts - n + 1, 0)
        begin = ranges(self.first[:-1], fits)
        return begin, span_hashes(self.hashes, begin, begin + n, which)


def ranges(first: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """``first[i], first[i] + 1, …`` with ``counts[i]`` values for each ``i``."""
    total = int(counts.sum())
    before = np.cumsum(counts) - counts
    return np.arange(total) + np.repeat(first - before, counts)


def buffers(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """UTF-8 bytes and offsets of a text column; NULL counts as empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = column.cast(pa.large_string()).fill_null("")
    _, offsets, data = column.buffers()
    bounds = np.frombuffer(offsets, dtype=np.int64)[column.offset : column.offset + len(column) + 1] if len(column) else np.zeros(1, np.int64)
    raw = np.frombuffer(data, dtype=np.uint8) if data is not None else np.zeros(0, np.uint8)
    return raw[bounds[0] : bounds[-1]], bounds - bounds[0]


def split(column: pa.Array, inside: np.ndarray, lower: bool) -> Words:
    """Words of each text: longest runs of bytes for which ``inside`` holds."""
    data, offsets = buffers(column)
    if lower:
        data = _LOWER[data]
    ok = inside[data]
    begin, end = ok.copy(), ok.copy()
    begin[1:] &= ~ok[:-1]
    end[:-1] &= ~ok[1:]
    edges = offsets[(offsets > 0) & (offsets < len(data))]
    begin[edges] = ok[edges]
    end[edges - 1] = ok[edges - 1]
    start, stop = np.flatnonzero(begin), np.flatnonzero(end) + 1
    return Words(data, start, stop, np.searchsorted(start, offsets), span_hashes(_BYTE_VALUES[data], start, stop))


def pieces(batches: Iterator[pa.RecordBatch], text: str = "text", limit: int = PIECE_BYTES) -> Iterator[pa.RecordBatch]:
    """Batches cut so that the texts of one stay near ``limit`` bytes; a text is never cut."""
    for batch in batches:
        if not batch.num_rows:
            continue
        offsets = buffers(batch.column(batch.schema.get_field_index(text)))[1]
        row = 0
        while row < batch.num_rows:
            stop = max(int(np.searchsorted(offsets, offsets[row] + limit, side="right")) - 1, row + 1)
            yield batch.slice(row, stop - row)
            row = stop


def longs(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Values of an integer column and which of them are not NULL."""
    valid = np.asarray(column.is_valid())
    return np.asarray(column.fill_null(0).cast(pa.int64())), valid
