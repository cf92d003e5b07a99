"""Groups of documents with similar word shingles: a T-occurrence search by DivideSkip.

Two documents link when the Jaccard similarity of their sets of 5-word shingles is
at least 0.75. All links within reach make a component.

* **Copies first.** Documents with equal sets form a class (a 128-bit digest and one
  aggregation); the search sees one document of each.
* **Who can have a partner.** A partner shares at least T = ceil(0.75 n) of the n
  shingles, so one of any ``n - T + 1`` of them. Taking the rarest, a document whose
  ``n - T + 1`` rarest shingles occur nowhere else has none and drops out. How often
  a shingle occurs is counted over all documents, up to ``HOT``: a piece of input
  that has it that often already sends it once.
* **Who must meet.** Documents with a common shingle among those rarest are joined
  to loose groups (components); a batch of input joins its own and sends one of them
  for each shingle. Each set travels once, to its group.
* **The search** in a group: for a query set, the L longest inverted lists are put
  aside, the short ones are merged by a heap, documents that occur T - L times are
  looked up in the long lists by binary search, and those that reach the overlap
  their size asks for are linked. Documents of one component need not find each
  other again, so those of the largest component are put off; where another one ends
  as the largest, they are queries after all.
* **Hot groups.** A loose group above ``BLOCK`` shingles is cut into salted blocks,
  cut anew twice, so that a dense group soon is one component. What is then left,
  lists whose documents are in several components, is grouped again and, where still
  too large, searched in pairs of blocks. All ways give the same components.

Results for the odd cases: NULL, empty or blank text has no shingles and is its own
component; fewer than five words are one shingle; rows that repeat an id are one
node (each row keeps its own ``n_shingles``); a row without id has no component; an
empty table gives an empty result; further columns are ignored.
"""

from __future__ import annotations

import heapq
import math
from bisect import bisect_left
from collections.abc import Iterator
from itertools import groupby

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from planefold.llm import packed
from planefold.llm.components import components
from planefold.llm.ship import ready
from planefold.llm.words import GRAPH, U64, Words, longs, mix, pieces, span_hashes, split
from planefold.session import settle

SHINGLE = 5
PERCENT = 75
HOT = 128
BLOCK = 1 << 20
ROUNDS = 3
MU = 0.01


def shingle_sets(words: Words) -> tuple[np.ndarray, np.ndarray]:
    """Row and hash of every distinct shingle, ordered by row."""
    begin, hashes = words.windows(SHINGLE)
    row = words.text_of()[begin] if len(begin) else begin
    short = np.flatnonzero((words.counts > 0) & (words.counts < SHINGLE))
    whole = span_hashes(words.hashes, words.first[short], words.first[short + 1])
    row, hashes = np.r_[row, short], np.r_[hashes, whole]
    order = np.lexsort((hashes, row))
    row, hashes = row[order], hashes[order]
    keep = np.ones(len(row), dtype=bool)
    keep[1:] = (row[1:] != row[:-1]) | (hashes[1:] != hashes[:-1])
    return row[keep], hashes[keep]


def _digests(row: np.ndarray, hashes: np.ndarray, rows: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Size and two 64-bit sums of each row's set."""
    n = np.bincount(row, minlength=rows).astype(np.int64)
    bounds = np.r_[0, np.cumsum(n)]
    sums = []
    for seed in (0, 0x5851F42D4C957F2D):
        total = np.zeros(len(hashes) + 1, dtype=U64)
        np.cumsum(mix(hashes ^ U64(seed)), out=total[1:])
        sums.append((total[bounds[1:]] - total[bounds[:-1]]).view(np.int64))
    return n, sums[0], sums[1]


def _sizes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for piece in pieces(batches):
        n, d1, d2 = _digests(*shingle_sets(split(piece.column("text"), GRAPH, lower=True)), piece.num_rows)
        yield pa.RecordBatch.from_pydict({"doc_id": piece.column("doc_id"), "n_shingles": n, "d1": d1, "d2": d2})


def _representatives(piece: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray, np.ndarray, pa.RecordBatch]:
    """Ids and sets of the rows that stand for their class."""
    piece = piece.filter(piece.column("d1").is_valid())
    row, hashes = shingle_sets(split(piece.column("text"), GRAPH, lower=True))
    _, d1, d2 = _digests(row, hashes, piece.num_rows)
    same = (d1 == longs(piece.column("d1"))[0]) & (d2 == longs(piece.column("d2"))[0])
    keep = same[row]
    return longs(piece.column("doc_id"))[0], row[keep], hashes[keep], piece


def _key(a: np.ndarray, n: int) -> np.ndarray:
    """A shingle's class: its bucket and the upper half of its hash. Counts are per class."""
    return (packed.by_hash(a, n).astype(U64) << U64(32)) | packed.high(a)


def _shingle_rows(n: int, hot: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for piece in pieces(batches):
            ids, row, hashes, _ = _representatives(piece)
            doc, a = packed.sorted_unique(ids[row], _key(hashes, n))
            start = packed.starts(a)
            size = np.diff(np.r_[start, len(doc)])
            often = np.repeat(size >= hot, size)
            send = ~often
            send[start[size >= hot]] = True
            count = np.where(often, hot, 1).astype(np.uint8)
            bucket = (a >> U64(32)).astype(np.int32)
            yield from packed.pack(bucket[send], doc[send], a[send].astype(packed.U32), count[send])
            yield from packed.tell(doc[often], a[often], count[often], n)

    return run


def _frequencies(n: int, hot: int):
    """Tell documents how often their shingles occur, where that is more than once."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        through: list = []
        bucket = U64(TaskContext.get().partitionId())
        doc, a, b = packed.unpack(batches, (packed.U32, np.uint8), through)
        yield from through
        order = np.argsort(a, kind="stable")
        doc, a, b = doc[order], a[order], b[order]
        start = packed.starts(a)
        if not len(start):
            return
        total = np.minimum(np.add.reduceat(b.astype(np.int64), start), hot)
        total = np.repeat(total, np.diff(np.r_[start, len(a)]))
        share = (total > 1) & (b == 1)
        yield from packed.tell(doc[share], (bucket << U64(32)) | a[share], total[share].astype(np.uint8), n)

    return run


def _prefix(n: np.ndarray | int):
    """How many of the rarest shingles any partner must share one of."""
    return n - -(-PERCENT * n // 100) + 1


def _candidate_sets(buckets: int):
    """Sets, rarest shingle first, of documents that may have a partner."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for piece in pieces(batches):
            piece = piece.filter(piece.column("hashes").is_valid())
            if piece.num_rows:
                yield _candidates(piece, buckets)

    return run


def _candidates(piece: pa.RecordBatch, buckets: int) -> pa.RecordBatch:
    ids, row, hashes, piece = _representatives(piece)
    keys = _key(hashes, buckets)
    bounds = np.searchsorted(row, np.arange(piece.num_rows + 1))
    out: dict[str, list] = {"doc_id": [], "n": [], "n_own": [], "shingles": []}
    for i in range(piece.num_rows):
        own = hashes[bounds[i] : bounds[i + 1]]
        n = len(own)
        if not n:
            continue
        known = np.frombuffer(piece.column("hashes")[i].as_py(), dtype=U64)
        often = np.frombuffer(piece.column("more")[i].as_py(), dtype=np.uint8)
        order = np.argsort(known, kind="stable")
        known, often = known[order], often[order]
        key = keys[bounds[i] : bounds[i + 1]]
        at = np.minimum(np.searchsorted(known, key), len(known) - 1)
        count = np.where(known[at] == key, often[at], 1)
        alone = int((count == 1).sum())
        if alone >= _prefix(n):
            continue
        out["doc_id"].append(int(ids[i]))
        out["n"].append(n)
        out["n_own"].append(alone)
        out["shingles"].append(own[np.lexsort((own, count))].tobytes())
    kinds = {"doc_id": pa.int64(), "n": pa.int64(), "n_own": pa.int64(), "shingles": pa.binary()}
    return pa.RecordBatch.from_pydict({k: pa.array(out[k], kind) for k, kind in kinds.items()})


def _prefix_entries(batch: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray]:
    """Row and hash of the rare shingles that occur more than once."""
    rows, parts = [], []
    n, own = longs(batch.column("n"))[0], longs(batch.column("n_own"))[0]
    for i in range(batch.num_rows):
        part = np.frombuffer(batch.column("shingles")[i].as_py(), dtype=U64)[own[i] : _prefix(int(n[i]))]
        rows.append(np.full(len(part), i))
        parts.append(part)
    return np.concatenate(rows or [np.zeros(0, np.int64)]), np.concatenate(parts or [np.zeros(0, U64)])


class Sets:
    """Union-find over hashable members, least member on top."""

    def __init__(self) -> None:
        self.up: dict = {}

    def top(self, x):
        up = self.up
        while up.setdefault(x, x) != x:
            up[x] = up[up[x]]
            x = up[x]
        return x

    def join(self, x, y) -> None:
        x, y = self.top(x), self.top(y)
        if x != y:
            self.up[max(x, y)] = min(x, y)

    def edges(self) -> Iterator[pa.RecordBatch]:
        pairs = [(x, self.top(x)) for x in list(self.up)]
        pairs = [(x, y) for x, y in pairs if x != y]
        if pairs:
            u, v = zip(*pairs)
            yield pa.RecordBatch.from_pydict({"u": pa.array(u, pa.int64()), "v": pa.array(v, pa.int64())})


def _lists(doc: np.ndarray, a: np.ndarray, label: np.ndarray) -> tuple[Sets, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """A forest over documents of lists with several labels, and of each entry's list: first document, label range, whether several."""
    order = np.lexsort((doc, a))
    start = packed.starts(a[order])
    met = Sets()
    if not len(start):
        return met, doc, label, label, np.zeros(0, dtype=bool)
    size = np.diff(np.r_[start, len(a)])
    back = np.empty(len(a), dtype=np.int64)
    back[order] = np.repeat(np.arange(len(start)), size)
    first = doc[order][start][back]
    low, high = np.minimum.reduceat(label[order], start)[back], np.maximum.reduceat(label[order], start)[back]
    mixed = low != high
    for x, y in set(zip(doc[mixed].tolist(), first[mixed].tolist())):
        met.join(x, y)
    return met, first, low, high, mixed


def _prefix_rows(n: int):
    """Entries of prefix hashes; of a batch's list with several labels one document, the others being told of it."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            row, hashes = _prefix_entries(batch)
            ids, label = longs(batch.column("doc_id"))[0], longs(batch.column("label"))[0]
            met, first, low, high, mixed = _lists(ids[row], hashes, label[row])
            for edges in met.edges():
                yield from packed.tell(longs(edges.column("u"))[0], longs(edges.column("v"))[0].astype(U64), np.zeros(edges.num_rows, dtype=U64), n)
            doc = np.r_[ids[row][~mixed], first[mixed], first[mixed]]
            hashes = np.r_[hashes[~mixed], hashes[mixed], hashes[mixed]]
            label = np.r_[label[row][~mixed], low[mixed], high[mixed]]
            doc, hashes, label = packed.sorted_unique(doc, hashes, label.astype(U64))
            yield from packed.pack(packed.by_hash(hashes, n), doc, hashes, label)

    return run


def _meetings(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """A forest over documents of common lists; lists within one label don't count."""
    through: list = []
    entries = packed.unpack(batches, (U64, U64), through)
    u, v, _ = packed.unpack(iter(through), (U64, U64), None)
    if len(u):
        yield pa.RecordBatch.from_pydict({"u": pa.array(u), "v": pa.array(v.view(np.int64))})
    yield from _lists(*entries)[0].edges()


def _inverted(sets: list[np.ndarray]) -> tuple[list[list[int]], list[list[int]]]:
    """Lists of the shingles that several sets have, and the lists of each set."""
    hashes = np.concatenate(sets)
    member = np.repeat(np.arange(len(sets)), [len(s) for s in sets])
    order = np.lexsort((member, hashes))
    hashes, member = hashes[order], member[order]
    start = np.flatnonzero(np.r_[True, hashes[1:] != hashes[:-1]])
    size = np.diff(np.r_[start, len(hashes)])
    members = member.tolist()
    lists: list[list[int]] = []
    of: list[list[int]] = [[] for _ in sets]
    for lo, n in zip(start[size > 1].tolist(), size[size > 1].tolist()):
        part = members[lo : lo + n]
        for m in part:
            of[m].append(len(lists))
        lists.append(part)
    return lists, of


def _needed(n: int, m: int) -> int:
    """Common shingles that sets of ``n`` and ``m`` need."""
    return -(-PERCENT * (n + m) // (100 + PERCENT))


def divide_skip(lists: list[list[int]], n: int, sizes: list[int]) -> list[int]:
    """Members that occur in enough of a query's inverted lists.

    ``lists`` are the sorted inverted lists of a query of ``n`` shingles.
    """
    least = -(-PERCENT * n // 100)
    if len(lists) < least:
        return []
    lists = sorted(lists, key=len)
    aside = min(int(least / (MU * math.log2(len(lists[-1]) + 1) + 1)), least - 1)
    cut = len(lists) - aside
    found = []
    for member, times in groupby(heapq.merge(*lists[:cut])):
        count = sum(1 for _ in times)
        if count < least - aside:
            continue
        need = _needed(n, sizes[member])
        left = aside
        for probed in lists[cut:]:
            if count >= need or count + left < need:
                break
            at = bisect_left(probed, member)
            count += at < len(probed) and probed[at] == member
            left -= 1
        if count >= need:
            found.append(member)
    return found


def link(ids: list[int], labels: list[int], sets: list[np.ndarray]) -> Sets:
    """Union of all documents of a block that link, labels being united before.

    The largest component may change, so documents put off while theirs was it are
    searched at the end, but for those of one component, ``exempt``: of any two
    documents that are never searched, both are in it.
    """
    tree = Sets()
    for x, y in zip(ids, labels):
        tree.join(x, y)
    sizes = [len(s) for s in sets]
    lists, of = _inverted(sets)
    weight: dict[int, int] = {}
    for x in ids:
        weight[tree.top(x)] = weight.get(tree.top(x), 0) + 1
    largest = max(weight, key=weight.get)

    def search(q: int) -> None:
        nonlocal largest
        for r in divide_skip([lists[i] for i in of[q]], sizes[q], sizes):
            other, top = tree.top(ids[r]), tree.top(ids[q])
            if other != top:
                tree.join(other, top)
                both = weight.pop(other) + weight.pop(top)
                weight[min(other, top)] = both
                if largest in (other, top) or both > weight[largest]:
                    largest = min(other, top)

    skipped = []
    for q in sorted(range(len(ids)), key=lambda i: (sizes[i] - len(of[i]), ids[i])):
        if tree.top(ids[q]) == largest and weight[largest] > 1:
            skipped.append(q)
        else:
            search(q)
    exempt = ids[max(skipped, key=lambda q: weight[tree.top(ids[q])])] if skipped else None
    for q in skipped:
        if tree.top(ids[q]) != tree.top(exempt):
            search(q)
    return tree


def _search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Search block after block of a partition that is sorted by block."""
    rows = (row for batch in batches for row in batch.to_pylist())
    for _, block in groupby(rows, key=lambda r: (r["loose"], r["x"], r["y"])):
        block = list(block)
        if len(block) > 1:
            sets = [np.frombuffer(r["shingles"], dtype=U64) for r in block]
            yield from link([r["doc_id"] for r in block], [r["label"] for r in block], sets).edges()


def _links(sets: DataFrame, n: int) -> DataFrame:
    """Links within the blocks (loose, x, y)."""
    columns = ["loose", "x", "y", "doc_id", "label", "shingles"]
    return sets.select(*columns).repartition(n, "loose", "x", "y").sortWithinPartitions("loose", "x", "y", "doc_id").mapInArrow(_search, "u long, v long")


def _loose(sets: DataFrame, n: int) -> DataFrame:
    """Sets with their loose group and the number of blocks it takes."""
    met = packed.deal(sets.mapInArrow(_prefix_rows(n), packed.PACKED)).mapInArrow(_meetings, "u long, v long")
    groups = components(met).select(F.col("node").alias("doc_id"), F.col("label").alias("loose"))
    grouped = sets.drop("loose", "blocks").join(groups, "doc_id")
    blocks = grouped.groupBy("loose").agg(F.sum("n").alias("total"))
    return grouped.join(blocks, "loose").withColumn("blocks", F.ceil(F.col("total") / F.lit(BLOCK)).cast("long")).drop("total")


def _relabel(sets: DataFrame, links: DataFrame) -> DataFrame:
    labels = components(links).select(F.col("node").alias("doc_id"), F.col("label").alias("new"))
    return sets.join(labels, "doc_id", "left").withColumn("label", F.coalesce("new", "doc_id")).drop("new")


def _salt(seed: int):
    return F.pmod(F.xxhash64(F.lit(seed), "doc_id"), F.col("blocks"))


def _all_links(sets: DataFrame, n: int) -> DataFrame:
    """Edges that connect all linked documents of ``sets``."""
    loose = settle(_loose(sets, n))
    zero = F.lit(0).cast("long")
    links = settle(_links(loose.withColumns({"x": _salt(0), "y": zero}), n))
    large = loose.filter("blocks > 1")
    if large.isEmpty():
        return links
    for seed in range(1, ROUNDS):
        now = _relabel(large, links).withColumns({"x": _salt(seed), "y": zero})
        links = settle(links.unionByName(_links(now, n)))
    left = settle(_loose(_relabel(large, links), n))
    other = F.explode(F.sequence(zero, F.col("blocks") - 1))
    pairs = left.withColumn("own", _salt(0)).withColumn("other", other)
    pairs = pairs.withColumns({"x": F.least("own", "other"), "y": F.greatest("own", "other")})
    return settle(links.unionByName(_links(pairs, n)))


def similar_groups(docs: DataFrame) -> DataFrame:
    """``doc_id, n_shingles, component_id`` for every row of ``doc_id, text``."""
    ready(docs.sparkSession)
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    n = packed.buckets(docs)
    sizes = settle(docs.mapInArrow(_sizes, "doc_id long, n_shingles long, d1 long, d2 long"))
    real = sizes.filter("n_shingles > 0 AND doc_id IS NOT NULL")
    classes = settle(real.groupBy("d1", "d2").agg(F.min("doc_id").alias("rep")))
    stand_ins = docs.join(classes.withColumnRenamed("rep", "doc_id"), "doc_id", "left")
    entries = packed.deal(stand_ins.mapInArrow(_shingle_rows(n, HOT), packed.PACKED))
    told = packed.by_document(entries.mapInArrow(_frequencies(n, HOT), packed.PACKED), U64, np.uint8)
    sets = stand_ins.join(told, "doc_id", "left").mapInArrow(_candidate_sets(n), "doc_id long, n long, n_own long, shingles binary")
    sets = settle(sets.withColumn("label", F.col("doc_id")))
    of_class = real.join(classes, ["d1", "d2"]).select("doc_id", "rep")
    least = of_class.groupBy("doc_id").agg(F.min("rep").alias("low"), F.max("rep").alias("high")).filter("low <> high")
    repeated = of_class.join(least, "doc_id").select(F.col("rep").alias("u"), F.col("low").alias("v"))
    labels = components(_all_links(sets, n).unionByName(repeated))
    named = sizes.join(classes, ["d1", "d2"], "left").withColumn("node", F.when(F.col("n_shingles") > 0, F.coalesce("rep", "doc_id")).otherwise(F.col("doc_id")))
    return named.join(labels, "node", "left").select(
        "doc_id", "n_shingles", F.when(F.col("doc_id").isNotNull(), F.coalesce("label", "node")).alias("component_id")
    )


def one_of_each(docs: DataFrame) -> DataFrame:
    """The row of ``docs`` with the smallest id of each component, with all its columns.

    Of rows that repeat that id the one with the least text stays; rows without id stay.
    """
    first = similar_groups(docs).filter("doc_id = component_id").select("doc_id").distinct()
    # the row travels as one value: no column of it can clash with a helper's name
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").alias("text"), F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"))
    order = Window.partitionBy("doc_id").orderBy(F.col("text").asc_nulls_first())
    kept = rows.join(first, "doc_id").withColumn("place", F.row_number().over(order)).filter("place = 1").select("row.*")
    return kept.unionByName(docs.filter("doc_id IS NULL"))
