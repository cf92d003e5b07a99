"""Hash entries of documents, packed into a few binary rows per bucket.

An entry is (document, hash). One row holds the entries that a piece of input has
for one bucket, so that a shuffle moves a few bytes a hash and not a row a hash. The
bucket follows from the hash, which makes each reducer see all of a hash. What a
reducer has to tell the documents goes the same way, by buckets of documents.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from planefold.llm.words import U64, mix

U32 = np.uint32
PACKED = "bucket int, docs binary, counts binary, a binary, b binary, told boolean"
NOTES = "doc_id long, hashes binary, more binary"
_ARROW = pa.schema([("bucket", pa.int32()), ("docs", pa.binary()), ("counts", pa.binary()), ("a", pa.binary()), ("b", pa.binary()), ("told", pa.bool_())])


def buckets(df: DataFrame) -> int:
    """Buckets of a shuffle: the session's number of shuffle partitions."""
    return int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))


def by_hash(a: np.ndarray, n: int) -> np.ndarray:
    """Bucket of each hash; from other bits than ``high``."""
    return ((a & U64(0xFFFFFFFF)) % U64(n)).astype(np.int32)


def high(a: np.ndarray) -> np.ndarray:
    """The upper half of each hash."""
    return (a >> U64(32)).astype(U32)


def pack(bucket: np.ndarray, doc: np.ndarray, a: np.ndarray, b: np.ndarray | None = None, told: bool = False) -> Iterator[pa.RecordBatch]:
    """Rows of the entries by bucket."""
    if not len(doc):
        return
    order = np.lexsort((doc, bucket))
    doc, a, bucket = doc[order], a[order], bucket[order]
    b = b[order] if b is not None else None
    runs = np.flatnonzero(np.r_[True, (doc[1:] != doc[:-1]) | (bucket[1:] != bucket[:-1])])
    counts = np.diff(np.r_[runs, len(doc)]).astype(U32)
    cuts = np.flatnonzero(np.r_[True, bucket[1:] != bucket[:-1], True])
    run_cuts = np.searchsorted(runs, cuts)
    rows: dict[str, list] = {name: [] for name in _ARROW.names}
    for i, (lo, hi) in enumerate(zip(cuts[:-1], cuts[1:])):
        of = slice(run_cuts[i], run_cuts[i + 1])
        rows["bucket"].append(int(bucket[lo]))
        rows["docs"].append(doc[runs[of]].tobytes())
        rows["counts"].append(counts[of].tobytes())
        rows["a"].append(a[lo:hi].tobytes())
        rows["b"].append(b[lo:hi].tobytes() if b is not None else b"")
        rows["told"].append(told)
    yield pa.RecordBatch.from_pydict(rows, schema=_ARROW)


def tell(doc: np.ndarray, a: np.ndarray, b: np.ndarray | None, n: int) -> Iterator[pa.RecordBatch]:
    """Rows by bucket of the document they are for."""
    yield from pack((mix(doc.astype(U64)) % U64(n)).astype(np.int32), doc, a, b, told=True)


def deal(packed: DataFrame) -> DataFrame:
    """Every bucket into a partition of its own."""
    return packed.repartitionById(buckets(packed), F.col("bucket"))


def unpack(batches: Iterator[pa.RecordBatch], kinds: tuple, through: list | None) -> tuple[np.ndarray, ...]:
    """Documents and values of all entries of a partition; rows already told go to ``through``."""
    parts: dict[str, list[bytes]] = {"docs": [], "counts": [], "a": [], "b": []}
    for batch in batches:
        if through is not None:
            told = batch.column("told")
            handed = batch.filter(told)
            if handed.num_rows:
                through.append(handed)
            batch = batch.filter(pa.array(~np.asarray(told)))
        for name, kept in parts.items():
            kept += batch.column(name).to_pylist()
    joined = {name: b"".join(kept) for name, kept in parts.items()}
    doc = np.repeat(np.frombuffer(joined["docs"], np.int64), np.frombuffer(joined["counts"], U32))
    return doc, *(np.frombuffer(joined[name], kind) for name, kind in zip("ab", kinds))


def _merged(kinds: tuple) -> Callable:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        doc, *values = unpack(batches, kinds, None)
        if not len(doc):
            return
        order = np.argsort(doc, kind="stable")
        doc, values = doc[order], [v[order] if len(v) else v for v in values]
        cuts = np.flatnonzero(np.r_[True, doc[1:] != doc[:-1], True])
        spans = list(zip(cuts[:-1].tolist(), cuts[1:].tolist()))
        columns = [pa.array([v[lo:hi].tobytes() for lo, hi in spans], pa.binary()) for v in values]
        columns += [pa.array([b""] * len(spans), pa.binary())] * (2 - len(columns))
        yield pa.RecordBatch.from_arrays([pa.array(doc[cuts[:-1]]), *columns], names=["doc_id", "hashes", "more"])

    return run


def by_document(told: DataFrame, *kinds) -> DataFrame:
    """``doc_id, hashes, more``: one row with all that a document was told."""
    return deal(told).mapInArrow(_merged(kinds), NOTES)


def starts(*keys: np.ndarray) -> np.ndarray:
    """Where a new value begins in sorted keys."""
    if not len(keys[0]):
        return np.zeros(0, dtype=np.int64)
    new = np.zeros(len(keys[0]) - 1, dtype=bool)
    for key in keys:
        new |= key[1:] != key[:-1]
    return np.flatnonzero(np.r_[True, new])


def sorted_unique(doc: np.ndarray, *keys: np.ndarray) -> tuple[np.ndarray, ...]:
    """Distinct entries ordered by key, then document."""
    order = np.lexsort((doc, *reversed(keys)))
    doc, keys = doc[order], [k[order] for k in keys]
    keep = starts(*keys, doc)
    return doc[keep], *(k[keep] for k in keys)
