"""Token ids in files, compressed by a Re-Pair grammar per shard.

Documents are range-partitioned and sorted by id, encoded, and cut into shards of
about ``SHARD_TOKENS`` ids (whole documents). In a shard, frequent pairs of ids are
replaced by new symbols, round after round, until no pair occurs so often that its
rule (``RULE_BYTES``) takes less than it saves. The pairs of a round are taken from
the most frequent down such that no symbol is a left part of one and a right part of
another; occurrences then cannot overlap and all are replaced at once. A pair of
equal symbols is alone with its symbol in a round and counts at every other place of
a run. Pairs left out of a round (clashes, those after the first ``PAIRS``) come up
in the next.

The format is one Parquet row per shard. All numbers are little-endian 32-bit
integers unless said otherwise.

============  =============================================================
part, shard   order of the shards: partition, then number within it
n_tokens      ids in the shard, with the end id of each document
doc_ids       64-bit ids of the documents; ``doc_known`` has a byte 0 for NULL
doc_lengths   ids per document, with the end id
alphabet      the id of each plain symbol; symbol 0 is the end of a document
rules         pairs of symbols, one per new symbol, which count on from there
rounds        number of rules after each round
lengths       ids that each symbol, plain or new, stands for
symbols       the compressed ids, ``width`` bytes each
============  =============================================================

A document, or any range of ids, is decoded alone: the lengths say where it begins
(``decode_range``).

Results for the odd cases: NULL and empty text are the end id alone; documents with
NULL as id come first; rows that repeat an id are kept in order of their text; an
empty table makes no shard; further columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from uuid import uuid4

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from planefold.llm.encode import encoder
from planefold.llm.packed import buckets, starts
from planefold.llm.ship import ready
from planefold.llm.words import pieces, ranges
from planefold.operators.ordering import running_total
from planefold.operators.sizing import small_side
from planefold.session import shared_folder

SHARD_TOKENS = 1 << 18
END = 0
PAIRS = 4096
RULE_BYTES = 12
SLOT_BITS = 16
HEAD = 32
SHARDS = (
    "part int, shard int, n_tokens long, width int, doc_ids binary, doc_known binary, doc_lengths binary, "
    "alphabet binary, rules binary, rounds binary, lengths binary, symbols binary"
)
U32 = np.dtype("<u4")
U16 = np.dtype("<u2")


def _choose(keys: np.ndarray, bits: int, least: int) -> np.ndarray:
    """Frequent pairs that cannot overlap, most frequent first."""
    keys = np.sort(keys)
    start = starts(keys)
    count = np.diff(np.r_[start, len(keys)])
    often = count >= least
    pair, count = keys[start[often]], count[often]
    order = np.lexsort((pair, -count))[:PAIRS]
    pair = pair[order]
    left, right, both = 1, 2, 3
    lefts, rights = pair >> pair.dtype.type(bits), pair & pair.dtype.type((1 << bits) - 1)
    side = bytearray(int(max(lefts.max(initial=0), rights.max(initial=0))) + 1)
    chosen = []
    for i, (a, b) in enumerate(zip(lefts.tolist(), rights.tolist())):
        if a == b:
            if not side[a]:
                side[a] = both
                chosen.append(i)
        elif side[a] <= left and side[b] in (0, right):
            side[a], side[b] = left, right
            chosen.append(i)
    return pair[chosen]


def _slot(keys: np.ndarray) -> np.ndarray:
    bits = keys.dtype.itemsize * 8
    factor = keys.dtype.type(0x9E3779B97F4A7C15 >> (64 - bits) | 1)
    return (keys * factor) >> keys.dtype.type(bits - SLOT_BITS)


def _pairs(symbols: np.ndarray) -> np.ndarray:
    """Where a pair begins: not at ``END``, and at every other place of a run of one symbol."""
    pair = (symbols[:-1] != END) & (symbols[1:] != END)
    same = np.flatnonzero(pair & (symbols[:-1] == symbols[1:]))
    begin = starts(same - np.arange(len(same)))
    place = same - np.repeat(same[begin], np.diff(np.r_[begin, len(same)]))
    pair[same[place % 2 == 1]] = False
    return pair


def compress(symbols: np.ndarray, first: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Compressed symbols, rules (pairs) and number of rules after each round.

    Symbols are below ``first``; ``END`` is in no pair. New symbols count up from
    ``first``; 16-bit symbols become 32-bit ones where they need it.
    """
    rules, rounds, total = [np.zeros((0, 2), dtype=U32)], [], 0
    while True:
        kind, bits = symbols.dtype, symbols.dtype.itemsize * 8
        wide = np.dtype(f"<u{2 * kind.itemsize}")
        keys = (symbols[:-1].astype(wide) << wide.type(bits)) | symbols[1:]
        pair = _pairs(symbols)
        chosen = _choose(keys[pair], bits, RULE_BYTES // kind.itemsize + 1)
        if not len(chosen):
            break
        one = np.unique(_slot(chosen), return_index=True)[1]
        chosen = chosen[np.sort(one)]
        if kind == U16 and first + total + len(chosen) > 1 << 16:
            symbols = symbols.astype(U32)
            continue
        slot = _slot(chosen)
        table, number = np.zeros(1 << SLOT_BITS, dtype=wide), np.zeros(1 << SLOT_BITS, dtype=kind)
        table[slot] = chosen
        number[slot] = first + total + np.arange(len(chosen))
        at = _slot(keys)
        hit = np.flatnonzero((table[at] == keys) & pair)
        keep = np.ones(len(symbols), dtype=bool)
        keep[hit + 1] = False
        symbols = symbols.copy()
        symbols[hit] = number[at[hit]]
        symbols = symbols[keep]
        rules.append(np.stack([chosen >> wide.type(bits), chosen & wide.type((1 << bits) - 1)], axis=1).astype(U32))
        total += len(chosen)
        rounds.append(total)
    return symbols, np.concatenate(rules), np.array(rounds, dtype=U32)


def _expansions(alphabet: np.ndarray, rules: np.ndarray, rounds: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Where each symbol's ids begin, how many they are, and the ids."""
    first = len(alphabet)
    begin, length, ids = np.arange(first), np.ones(first, dtype=np.int64), alphabet
    done = 0
    for stop in rounds.tolist():
        both = rules[done:stop].ravel().astype(np.int64)
        added = ids[ranges(begin[both], length[both])]
        size = length[both].reshape(-1, 2).sum(axis=1)
        begin = np.r_[begin, len(ids) + np.cumsum(size) - size]
        length = np.r_[length, size]
        ids = np.r_[ids, added]
        done = stop
    return begin, length, ids


def _shard(docs: list[tuple[int | None, bytes]], part: int, shard: int, end_id: int) -> dict:
    """The row of a shard."""
    lengths = np.array([len(ids) // 4 + 1 for _, ids in docs], dtype=U32)
    ids = np.frombuffer(b"".join(x for _, x in docs), dtype=U32)
    seen = np.zeros(int(ids.max()) + 1 if len(ids) else 0, dtype=bool)
    seen[ids] = True
    known = np.flatnonzero(seen)
    kind = U16 if len(known) < 1 << 16 else U32
    code = np.zeros(len(seen), dtype=kind)
    code[known] = np.arange(1, len(known) + 1)
    symbols = np.full(int(lengths.sum(dtype=np.int64)), END, dtype=kind)
    inside = np.ones(len(symbols), dtype=bool)
    inside[np.cumsum(lengths, dtype=np.int64) - 1] = False
    symbols[inside] = code[ids]
    alphabet = np.r_[end_id, known].astype(U32)
    symbols, rules, rounds = compress(symbols, len(alphabet))
    return {
        "part": part,
        "shard": shard,
        "n_tokens": len(inside),
        "width": symbols.dtype.itemsize,
        "doc_ids": np.array([d or 0 for d, _ in docs], dtype="<i8").tobytes(),
        "doc_known": bytes(d is not None for d, _ in docs),
        "doc_lengths": lengths.tobytes(),
        "alphabet": alphabet.tobytes(),
        "rules": rules.tobytes(),
        "rounds": rounds.tobytes(),
        "lengths": _expansions(alphabet, rules, rounds)[1].astype(U32).tobytes(),
        "symbols": symbols.tobytes(),
    }


_ROW = pa.schema(
    [("part", pa.int32()), ("shard", pa.int32()), ("n_tokens", pa.int64()), ("width", pa.int32())]
    + [(k, pa.binary()) for k in ("doc_ids", "doc_known", "doc_lengths", "alphabet", "rules", "rounds", "lengths", "symbols")]
)


def _shards(tokenizer: str, end_id: int, limit: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode, part, shard = encoder(tokenizer).batch, TaskContext.get().partitionId(), 0
        docs: list[tuple[int | None, bytes]] = []
        size = 0
        for batch in pieces(batches):
            for doc_id, ids in zip(batch.column("doc_id").to_pylist(), encode(batch.column("text"))):
                docs.append((doc_id, ids))
                size += len(docs[-1][1]) // 4 + 1
                if size >= limit:
                    yield pa.RecordBatch.from_pylist([_shard(docs, part, shard, end_id)], schema=_ROW)
                    docs, size, shard = [], 0, shard + 1
        if docs:
            yield pa.RecordBatch.from_pylist([_shard(docs, part, shard, end_id)], schema=_ROW)

    return run


def fresh_folder(spark: SparkSession) -> str:
    """Path for new files in the shared folder."""
    return f"{shared_folder(spark).rstrip('/')}/token-files-{uuid4().hex}"


def write_tokens(docs: DataFrame, tokenizer: str, path: str, end_id: int = 2, shard_tokens: int = SHARD_TOKENS) -> None:
    """Write the ids of all rows of ``doc_id, text``, in ascending order of ``doc_id``."""
    ready(docs.sparkSession)
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    # the head of the text cuts a repeated (or NULL) id into ranges, in the order of the texts
    placed = docs.repartitionByRange(buckets(docs), F.col("doc_id"), F.substring("text", 1, HEAD)).sortWithinPartitions("doc_id", "text")
    placed.mapInArrow(_shards(tokenizer, end_id, shard_tokens), SHARDS).write.parquet(path)


def _arrays(row: dict) -> tuple[np.ndarray, ...]:
    alphabet, rules, rounds = (np.frombuffer(row[k], dtype=U32) for k in ("alphabet", "rules", "rounds"))
    return np.frombuffer(row["symbols"], dtype=f"<u{row['width']}"), alphabet, rules.reshape(-1, 2), rounds


def decode(row: dict) -> np.ndarray:
    """All ids of a shard, with the end ids."""
    symbols, alphabet, rules, rounds = _arrays(row)
    begin, length, ids = _expansions(alphabet, rules, rounds)
    return ids[ranges(begin[symbols], length[symbols])]


def decode_range(row: dict, start: int, stop: int) -> np.ndarray:
    """The ids ``[start, stop)`` of a shard, expanding only the symbols that cover them."""
    symbols, alphabet, rules, _ = _arrays(row)
    ends = np.cumsum(np.frombuffer(row["lengths"], dtype=U32)[symbols], dtype=np.int64)
    low, high = np.searchsorted(ends, start, "right"), np.searchsorted(ends, stop, "left") + 1
    out: list[int] = []
    stack = symbols[low:high][::-1].tolist()
    while stack:
        top = stack.pop()
        if top < len(alphabet):
            out.append(int(alphabet[top]))
        else:
            stack += rules[top - len(alphabet)][::-1].tolist()
    before = start - (int(ends[low - 1]) if low else 0)
    return np.array(out[before : before + stop - start], dtype=U32)


def _documents(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for i in range(batch.num_rows):
            row = {name: batch.column(name)[i].as_py() for name in batch.schema.names}
            ids = decode(row)
            lengths = np.frombuffer(row["doc_lengths"], dtype=U32).astype(np.int64)
            bounds = np.r_[0, np.cumsum(lengths)]
            known = np.frombuffer(row["doc_known"], dtype=np.uint8) == 1
            yield pa.RecordBatch.from_pydict(
                {
                    "doc_id": pa.array(np.frombuffer(row["doc_ids"], dtype="<i8"), mask=~known),
                    "start": pa.array(row["start"] + bounds[:-1]),
                    "n_tokens": pa.array(lengths),
                    "ids": pa.array([ids[a:b].tobytes() for a, b in zip(bounds[:-1], bounds[1:])], pa.binary()),
                }
            )


def read_tokens(spark: SparkSession, path: str) -> DataFrame:
    """``doc_id, start, n_tokens, ids`` of every document in the files of ``path``."""
    ready(spark)
    shards = spark.read.schema(SHARDS).parquet(path)
    order = running_total(shards.select("part", "shard", "n_tokens"), [], ["part", "shard"], "n_tokens", "start")
    placed = shards.join(small_side(order.drop("n_tokens")), ["part", "shard"])
    return placed.mapInArrow(_documents, "doc_id long, start long, n_tokens long, ids binary")
