"""Alignment of two tokenizations of the same texts by pointer jumping.

Tokenizer A reads a space and the text, tokenizer B the text, to which it adds a space
itself. Both cut the same bytes; where tokens of both end at one byte, a group ends.

Over all chunks of a piece at once, every token points to the token of the other side
that overlaps it and reaches farthest to the right; a token of A that ends where that
one ends points to itself. Taking the pointer of the pointer until nothing changes
doubles the distance each time and leaves every token at the last token of its
group, which numbers the groups.

Between words both tokenizers cut: A before a space that a non-space follows, B (as its
vocabulary shows) before a space that stands after none. So texts are read as chunks,
and each distinct chunk of a piece is encoded and aligned once.

What links, pairs of an id of A and an id of B that share a group, is counted over the
corpus by documents: each task adds up its own documents before rows are shuffled, so
frequent pairs arrive once per task. The counted pairs are broadcast in sorted arrays if
they are measured to take at most ``LIMIT`` bytes; beyond, the pairs of the documents
are joined to the counts by shuffle, both sides being written tables, so that adaptive
execution splits frequent pairs.

Results for the odd cases: a text that is NULL or empty, or that either tokenizer does
not give back byte by byte (as when it has U+2581 itself), has no tokens: counts of 0
and empty ``groups``; rows that repeat an id are documents of their own, also in the
counts; NULL stays as id; an empty table gives an empty result; further columns are
ignored. Special strings in texts are plain text for A; B has none that match.
"""

from __future__ import annotations

import hashlib
import json
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from planefold.llm.encode import _MAYBE_SPACE, LONGEST, SPACE, _byte_letters, _flat, encoder, hashed
from planefold.llm.packed import starts
from planefold.llm.ship import ready
from planefold.llm.words import U64, buffers, pieces, ranges
from planefold.session import settle

LIMIT = 48 << 20
PAIR_BYTES = 17
#: Distinct pairs that a task holds before it passes their counts on.
HELD = 1 << 22
#: Links of groups that are paired at a time (a larger group alone).
LINKS = 1 << 21
U32 = np.dtype("<u4")
DOCUMENTS = (
    "row long, doc_id long, n_a long, n_b long, n_groups long, n_links long, groups string, pairs binary, times binary"
)
_DOCUMENTS = pa.schema(
    [("row", pa.int64()), ("doc_id", pa.int64())]
    + [(name, pa.int64()) for name in ("n_a", "n_b", "n_groups", "n_links")]
    + [("groups", pa.string()), ("pairs", pa.binary()), ("times", pa.binary())]
)


class Side:
    """Ids of texts under one tokenizer, and the bytes that each id stands for."""

    def __init__(self, path: str) -> None:
        if path.endswith(".model"):
            from sentencepiece import SentencePieceProcessor

            model = SentencePieceProcessor(model_file=path)
            self.flat = lambda texts: _flat(model.encode(texts, num_threads=1))
            pieces_ = [model.id_to_piece(i) for i in range(model.get_piece_size())]
            # no piece goes on over a space that follows something else
            self.cuts = not any("▁" in piece.lstrip("▁") for piece in pieces_)
            spelled = [self._piece(model.id_to_piece(i)) for i in range(model.get_piece_size())]
        else:
            own = encoder(path, plain=True)
            self.flat = lambda texts: own.flat(pa.array([" " + text for text in texts], pa.large_string()))
            self.cuts = own.chunks is not None
            letters = {letter: byte for byte, letter in _byte_letters().items()}
            with open(path, encoding="utf-8") as file:
                spec = json.load(file)
            vocabulary = spec["model"]["vocab"]
            spelled = [b""] * (max(vocabulary.values()) + 1)
            for entry, i in vocabulary.items():
                spelled[i] = bytes(letters[c] for c in entry) if set(entry) <= set(letters) else entry.encode()
        self.length = np.array([len(x) for x in spelled], dtype=np.int64)
        self.begin = np.cumsum(self.length) - self.length
        self.bytes = np.frombuffer(b"".join(spelled), dtype=np.uint8)

    @staticmethod
    def _piece(piece: str) -> bytes:
        if len(piece) == 6 and piece.startswith("<0x") and piece.endswith(">"):
            return bytes([int(piece[3:5], 16)])
        return piece.replace("▁", " ").encode()

    def joined(self, ids: np.ndarray) -> np.ndarray:
        """Bytes of the tokens, one after the other."""
        return self.bytes[ranges(self.begin[ids], self.length[ids])]


@lru_cache(None)
def side(path: str) -> Side:
    return Side(path)


def terminals(end_a: np.ndarray, end_b: np.ndarray, begin_a: np.ndarray, begin_b: np.ndarray) -> np.ndarray:
    """The last token of the group of each token, those of A first, then those of B."""
    n = len(end_a)
    over_a = np.searchsorted(begin_b, end_a, "left") - 1
    over_b = np.searchsorted(begin_a, end_b, "left") - 1
    pointer = np.r_[np.where(end_b[over_a] > end_a, n + over_a, np.arange(n)), over_b]
    while True:
        farther = pointer[pointer]
        if np.array_equal(farther, pointer):
            return pointer
        pointer = farther


def groups_of(length_a: np.ndarray, length_b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Group number of each token of A and of B, from the tokens' sizes in bytes; both sides have the same bytes."""
    if not len(length_a):
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    end_a, end_b = np.cumsum(length_a), np.cumsum(length_b)
    last = terminals(end_a, end_b, end_a - length_a, end_b - length_b)
    group = np.unique(last, return_inverse=True)[1]
    return group[: len(end_a)], group[len(end_a) :]


def _distinct(group: np.ndarray, ids: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct ids of each group: group, id, and how often."""
    key, count = np.unique(group * size + ids, return_counts=True)
    return key // size, key % size, count


def linked_pairs(doc: np.ndarray, group_a: np.ndarray, a: np.ndarray, group_b: np.ndarray, b: np.ndarray, sizes: tuple[int, int]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct id pairs linked in each document: document, pair, number of links. ``doc`` is that of each group."""
    ga, ia, ca = _distinct(group_a, a, sizes[0])
    gb, ib, cb = _distinct(group_b, b, sizes[1])
    n_groups = len(doc)
    first_b = np.searchsorted(gb, np.arange(n_groups + 1))
    many = first_b[ga + 1] - first_b[ga]  # partners of each distinct id of A
    cuts = np.flatnonzero(np.diff(np.r_[0, np.cumsum(many) // LINKS]) > 0)
    found = []
    for lo, hi in zip(np.r_[0, cuts], np.r_[cuts, len(ga)]):
        partner = ranges(first_b[ga[lo:hi]], many[lo:hi])
        own = np.repeat(np.arange(lo, hi), many[lo:hi])
        pair = ia[own].astype(U64) * U64(sizes[1]) + ib[partner].astype(U64)
        found.append(_summed(doc[ga[own]], pair, ca[own] * cb[partner]))
    whole = [np.concatenate(parts) for parts in zip(*found)]
    return _summed(*whole) if len(found) > 1 else tuple(whole)


def _summed(doc: np.ndarray, pair: np.ndarray, times: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    order = np.argsort(doc.astype(U64) << U64(40) | pair) if not len(pair) or pair.max() < U64(1 << 40) else np.lexsort((pair, doc))
    doc, pair, times = doc[order], pair[order], times[order]
    first = starts(doc, pair)
    return doc[first], pair[first], np.add.reduceat(times, first) if len(first) else times


def _texts(groups: np.ndarray, ids: np.ndarray, n: int) -> list[str]:
    """Comma-joined ids of each group."""
    shown = list(map(str, ids.tolist()))
    cuts = np.searchsorted(groups, np.arange(n + 1)).tolist()
    return [shown[i] if j - i == 1 else ",".join(shown[i:j]) for i, j in zip(cuts[:-1], cuts[1:])]


def _chunks(data: np.ndarray, offsets: np.ndarray, cut: bool) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Begin, end and text of each chunk of the texts; the space before a chunk is not in it."""
    spaces = np.flatnonzero(data == SPACE) if cut else np.zeros(0, dtype=np.int64)
    text = np.searchsorted(offsets, spaces, side="right") - 1
    inner = (spaces > offsets[text]) & (spaces + 1 < offsets[text + 1])
    spaces = spaces[inner]
    spaces = spaces[(data[spaces - 1] != SPACE) & ~_MAYBE_SPACE[data[spaces + 1]]]
    some = np.flatnonzero(np.diff(offsets) > 0)
    start = np.sort(np.r_[offsets[some], spaces + 1])
    of = np.searchsorted(offsets, start, side="right") - 1
    last = np.r_[of[1:] != of[:-1], True] if len(of) else np.zeros(0, dtype=bool)
    following = np.r_[start[1:], 0] if len(of) else start
    return start, np.where(last, offsets[of + 1], following - 1), of


def _distinct_chunks(data: np.ndarray, start: np.ndarray, stop: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """A place of each distinct chunk, and each chunk's number among them; long ones count as distinct."""
    short = np.flatnonzero(stop - start <= LONGEST)
    long = np.flatnonzero(stop - start > LONGEST)
    sample, own = hashed(data, start[short], stop[short])[2:]
    number = np.empty(len(start), dtype=np.int64)
    number[short], number[long] = own, len(sample) + np.arange(len(long))
    return np.r_[short[sample], long], number


def align(column: pa.Array, a: Side, b: Side) -> dict[str, list | np.ndarray]:
    """Groups and linked pairs of each text of a column."""
    data, offsets = buffers(column)
    rows = len(offsets) - 1
    start, stop, of = _chunks(data, offsets, a.cuts and b.cuts)
    sample, number = _distinct_chunks(data, start, stop)
    raw = data.tobytes()
    texts = [raw[i:j].decode() for i, j in zip(start[sample].tolist(), stop[sample].tolist())]
    own = np.frombuffer(b"".join([b" " + raw[i:j] for i, j in zip(start[sample].tolist(), stop[sample].tolist())]), dtype=np.uint8)
    size = stop[sample] - start[sample] + 1
    (all_a, n_a), (all_b, n_b) = (_checked(s, *s.flat(texts), own, size) for s in (a, b))
    good = (n_a > 0) & (n_b > 0)
    use_a, use_b = np.repeat(good, n_a), np.repeat(good, n_b)
    all_a, all_b, n_a, n_b = all_a[use_a], all_b[use_b], n_a * good, n_b * good
    group_a, group_b = groups_of(a.length[all_a], b.length[all_b])
    n = int(group_a[-1]) + 1 if len(group_a) else 0
    chunk = np.repeat(np.arange(len(good)), n_a)[np.searchsorted(group_a, np.arange(n))]
    links = np.bincount(group_a, minlength=n) * np.bincount(group_b, minlength=n)
    shown = [x + "|" + y for x, y in zip(_texts(group_a, all_a, n), _texts(group_b, all_b, n))]
    cuts = np.searchsorted(chunk, np.arange(len(good) + 1))
    bounds = cuts.tolist()
    written = [shown[i] if j - i == 1 else ";".join(shown[i:j]) for i, j in zip(bounds[:-1], bounds[1:])]
    in_chunk, pair, times = linked_pairs(chunk, group_a, all_a, group_b, all_b, (len(a.length), len(b.length)))
    # from distinct chunks to texts: a text counts if all its chunks do
    whole = np.bincount(of[~good[number]], minlength=rows) == 0
    number, of = number[whole[of]], of[whole[of]]

    def total(of_chunk: np.ndarray) -> np.ndarray:
        return np.bincount(of, weights=of_chunk[number], minlength=rows).astype(np.int64)

    first = np.searchsorted(in_chunk, np.arange(len(good) + 1))
    many = np.diff(first)[number]
    at = ranges(first[:-1][number], many)
    in_text, pair, times = _summed(np.repeat(of, many), pair[at], times[at])
    pair_cuts = np.searchsorted(in_text, np.arange(rows + 1)).tolist()
    chosen = [written[i] for i in number.tolist()]
    text_cuts = np.searchsorted(of, np.arange(rows + 1)).tolist()
    return {
        "n_a": total(n_a),
        "n_b": total(n_b),
        "n_groups": total(np.diff(cuts)),
        "n_links": total(np.bincount(chunk, weights=links, minlength=len(good))) if n else np.zeros(rows, np.int64),
        "groups": [";".join(chosen[i:j]) for i, j in zip(text_cuts[:-1], text_cuts[1:])],
        "pairs": [pair[i:j].tobytes() for i, j in zip(pair_cuts[:-1], pair_cuts[1:])],
        "times": [times[i:j].astype(U32).tobytes() for i, j in zip(pair_cuts[:-1], pair_cuts[1:])],
    }


def _checked(side_: Side, ids: np.ndarray, counts: np.ndarray, own: np.ndarray, size: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Ids and their counts, without those of chunks that the tokenizer does not give back byte by byte."""
    ids = ids.astype(np.int64)
    chunk = np.repeat(np.arange(len(counts)), counts)
    length = np.bincount(chunk, weights=side_.length[ids], minlength=len(counts)).astype(np.int64)
    same = length == size
    joined = side_.joined(ids[same[chunk]])
    differ = joined != own[np.repeat(same, size)]
    same[np.unique(np.repeat(np.arange(len(size)), size * same)[differ])] = False
    return ids[same[chunk]], counts * same


def _aligned(path_a: str, path_b: str, digest: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        a, b = side(path_a), side(path_b)
        row = TaskContext.get().partitionId() << 40
        for piece in pieces(batches, limit=1 << 20):
            found = align(piece.column("text"), a, b)
            if digest:
                found["groups"] = [hashlib.sha256(g.encode()).hexdigest() if g else "" for g in found["groups"]]
            numbers = pa.array(np.arange(row, row + piece.num_rows))
            row += piece.num_rows
            yield pa.RecordBatch.from_pydict({"row": numbers, "doc_id": piece.column("doc_id"), **found}, schema=_DOCUMENTS)

    return run


def aligned(docs: DataFrame, path_a: str, path_b: str, digest: bool = False) -> DataFrame:
    """``row, doc_id, n_a, n_b, n_groups, n_links, groups, pairs, times`` of every row of ``doc_id, text``.

    ``groups`` is written ``a1,a2|b1;a3|b2,b3`` (or its SHA-256 with ``digest``), ``pairs``
    are 64-bit integers (id of A times the size of B's vocabulary plus id of B), and ``row``
    tells rows apart once they are written.
    """
    ready(docs.sparkSession)
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return docs.mapInArrow(_aligned(path_a, path_b, digest), DOCUMENTS)


def _partial_counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    held, waiting, size = (np.zeros(0, np.int64), np.zeros(0, np.int64)), [], 0

    def merged() -> tuple[np.ndarray, np.ndarray]:
        new, count = np.unique(np.concatenate(waiting or [held[0][:0]]), return_counts=True)
        keys, number = np.unique(np.r_[held[0], new], return_inverse=True)
        total = np.bincount(number, weights=np.r_[held[1], count], minlength=len(keys)).astype(np.int64)
        waiting.clear()
        return keys, total

    for batch in batches:
        for pairs in batch.column("pairs").to_pylist():
            waiting.append(np.frombuffer(pairs, dtype=np.int64))
            size += len(waiting[-1])
            if size >= HELD:
                held, size = merged(), 0
                if len(held[0]) >= HELD:
                    yield pa.RecordBatch.from_pydict({"pair": held[0], "n": held[1]})
                    held = (held[0][:0], held[1][:0])
    held = merged()
    yield pa.RecordBatch.from_pydict({"pair": pa.array(held[0], pa.int64()), "n": pa.array(held[1], pa.int64())})


def pair_counts(documents: DataFrame, size_b: int) -> DataFrame:
    """``pair, a, n, best``: documents with each linked pair, and whether no pair of its id of A has more."""
    counts = settle(documents.select("pairs").mapInArrow(_partial_counts, "pair long, n long").groupBy("pair").agg(F.sum("n").alias("n")))
    counts = counts.withColumn("a", F.expr(f"cast(pair div {size_b} as int)"))
    most = counts.groupBy("a").agg(F.max("n").alias("most"))
    return counts.join(most, "a").select("pair", "a", "n", (F.col("n") == F.col("most")).alias("best"))


def _looked_up(table):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keys, n, best = table.value
        for batch in batches:
            pairs, times = batch.column("pairs").to_pylist(), batch.column("times").to_pylist()
            size = np.array([len(x) // 8 for x in pairs], dtype=np.int64)
            at = np.searchsorted(keys, np.frombuffer(b"".join(pairs), dtype=np.int64))
            often = np.frombuffer(b"".join(times), dtype=U32).astype(np.int64)
            text = np.repeat(np.arange(len(size)), size)
            sums = [np.zeros(len(size), np.int64) for _ in range(2)]
            np.add.at(sums[0], text, often * n[at])
            np.add.at(sums[1], text, often * best[at])
            yield pa.RecordBatch.from_pydict({"row": batch.column("row"), "count_sum": sums[0], "n_best": sums[1]})

    return run


def _entries(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        pairs = [np.frombuffer(x, dtype=np.int64) for x in batch.column("pairs").to_pylist()]
        row = np.repeat(np.asarray(batch.column("row")), [len(x) for x in pairs])
        often = np.frombuffer(b"".join(batch.column("times").to_pylist()), dtype=U32).astype(np.int64)
        yield pa.RecordBatch.from_pydict({"row": row, "pair": np.concatenate([*pairs, np.zeros(0, np.int64)]), "often": often})


def with_counts(documents: DataFrame, counts: DataFrame, limit: int = LIMIT) -> DataFrame:
    """Written ``documents`` with ``n_best`` and ``count_sum`` from written ``counts``."""
    shown = ["row", "doc_id", "n_a", "n_b", "n_groups", "n_links", "groups"]
    if counts.count() * PAIR_BYTES <= limit:
        rows = counts.select("pair", "n", "best").toArrow()
        keys, n, best = (np.asarray(rows.column(c).combine_chunks()) if c != "best" else np.asarray(rows.column(c)) for c in ("pair", "n", "best"))
        order = np.argsort(keys)
        table = documents.sparkSession.sparkContext.broadcast((keys[order], n[order], best[order].astype(bool)))
        schema = ", ".join([DOCUMENTS.split(", pairs")[0], "n_best long", "count_sum long"])

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            look = _looked_up(table)
            for batch in batches:
                (sums,) = look(iter([batch]))
                yield pa.RecordBatch.from_arrays(
                    [*(batch.column(c) for c in shown), sums.column("n_best"), sums.column("count_sum")],
                    names=[*shown, "n_best", "count_sum"],
                )

        return documents.mapInArrow(run, schema).drop("row")
    entries = documents.select("row", "pairs", "times").mapInArrow(_entries, "row long, pair long, often long")
    met = entries.join(counts.select("pair", "n", "best"), "pair")
    sums = met.groupBy("row").agg(
        F.sum(F.col("often") * F.col("n")).alias("count_sum"), F.sum(F.when(F.col("best"), F.col("often")).otherwise(0)).alias("n_best")
    )
    zero = F.lit(0).cast("long")
    return documents.select(*shown).join(sums, "row", "left").select(
        *shown[1:], F.coalesce("n_best", zero).alias("n_best"), F.coalesce("count_sum", zero).alias("count_sum")
    )


def alignment(docs: DataFrame, path_a: str, path_b: str, digest: bool = False, limit: int = LIMIT) -> DataFrame:
    """``doc_id, n_a, n_b, n_groups, n_links, groups, n_best, count_sum`` of every row of ``doc_id, text``."""
    documents = settle(aligned(docs, path_a, path_b, digest))
    counts = settle(pair_counts(documents, len(side(path_b).length)))
    return with_counts(documents, counts, limit)
