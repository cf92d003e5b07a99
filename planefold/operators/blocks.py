"""Movies as blocks, and traces extracted from them block by block.

A block row holds the values of ``FRAMES`` frames on a band of ``BAND`` picture rows:

=========  ====================================================================
plane
block      frame number divided by ``FRAMES``
band       picture row divided by ``BAND``
at         where each value lies: frame, row and x within the block, one number
value      the values
=========  ====================================================================

Values are packed where they are read, without a shuffle, so a block may come in several
rows, absent pixels take no room, and a pixel may have several values in a frame.

What weighs on a band is a few rows as well: the masks and rings of the ROIs on it as
runs. Extraction multiplies each block by the weights of its band inside the task; only
sums per ROI and frame are shuffled, never pixels. The weights are broadcast if they are
measured small; else blocks and weights meet by (plane, band), whole arrays at a time. For
that the rows of a block are brought together first: each row meets all weights of its band,
and where planes lie mixed in the input a block would come in as many rows as there are packs.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from planefold.functions import arrays
from planefold.operators.masks import ring_rows
from planefold.operators.sizing import BROADCAST_BYTES
from planefold.session import send_code, settle

FRAMES = 64
BAND = 16
_ROW_BITS, _FRAME_BITS = 21, 25
WIDEST = 1 << _ROW_BITS
PACK_ROWS = 1 << 19
#: ROIs whose weights share a row, and weights multiplied at a time.
PART_ROIS, AT_ONCE = 1024, 1 << 15
BLOCKS = "plane int, block long, band int, at array<int>, value array<double>"
#: A run with its row, both ends and weight, and its share of the item it is in.
ENTRY_BYTES = 96
_SUMS = "plane int, roi int, ring boolean, frame long, top double, bottom double"


def _lists(flat: np.ndarray, cuts: np.ndarray) -> pa.ListArray:
    return pa.ListArray.from_arrays(pa.array(cuts.astype(np.int32)), pa.array(flat))


def _packed(rows: list[pa.RecordBatch]) -> pa.RecordBatch:
    table = pa.Table.from_batches(rows)
    plane, frame, y, x, value = (table.column(c).to_numpy() for c in ("plane", "frame", "y", "x", "value"))
    block, band = frame // FRAMES, y // BAND
    at = (frame % FRAMES << _FRAME_BITS | (y % BAND).astype(np.int64) << _ROW_BITS | x).astype(np.int32)
    order = np.lexsort((at, band, block, plane))
    plane, block, band = plane[order], block[order], band[order]
    new = (plane[1:] != plane[:-1]) | (block[1:] != block[:-1]) | (band[1:] != band[:-1])
    cuts = np.flatnonzero(np.r_[True, new, True])
    first = cuts[:-1]
    return pa.RecordBatch.from_pydict(
        {
            "plane": pa.array(plane[first], pa.int32()),
            "block": pa.array(block[first], pa.int64()),
            "band": pa.array(band[first], pa.int32()),
            "at": _lists(at[order], cuts),
            "value": _lists(value[order], cuts),
        }
    )


def _pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    held, size = [], 0
    for batch in batches:
        held.append(batch)
        size += batch.num_rows
        if size >= PACK_ROWS:
            yield _packed(held)
            held, size = [], 0
    if size:
        yield _packed(held)


def to_blocks(movie: DataFrame) -> DataFrame:
    """Blocks of a movie in long form; rows without a place or a value are left out."""
    send_code(movie.sparkSession)
    rows = movie.select(
        "plane", F.col("frame").cast("long").alias("frame"), "y", "x", F.col("value").cast("double").alias("value")
    ).dropna()
    outside = F.raise_error(F.concat(F.lit(f"y or x is not within 0 and {WIDEST} in plane "), F.col("plane"))).cast("int")
    inside = (F.col("y") >= 0) & (F.col("x") >= 0) & (F.col("x") < WIDEST)
    return rows.withColumn("x", F.when(inside, F.col("x")).otherwise(outside)).mapInArrow(_pack, BLOCKS)


def _gather(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        if not batch.num_rows:
            continue
        plane, block, band = (batch.column(c).to_numpy() for c in ("plane", "block", "band"))
        new = (plane[1:] != plane[:-1]) | (block[1:] != block[:-1]) | (band[1:] != band[:-1])
        cuts = np.flatnonzero(np.r_[True, new, True])
        lists = [batch.column(c) for c in ("at", "value")]
        # the lists of consecutive rows follow each other already
        joined = [_lists(of.flatten().to_numpy(), (of.offsets.to_numpy() - of.offsets[0].as_py())[cuts]) for of in lists]
        first = cuts[:-1]
        yield pa.RecordBatch.from_arrays([pa.array(plane[first]), pa.array(block[first]), pa.array(band[first]), *joined], batch.schema.names)


def gathered(blocks: DataFrame) -> DataFrame:
    """The same values with the rows of a block made one, or few where they pass the size of an Arrow batch."""
    keys = ["plane", "block", "band"]
    send_code(blocks.sparkSession)
    dealt = blocks.hint("rebalance", *[F.col(key) for key in keys])  # a hot block is split
    return dealt.sortWithinPartitions(*keys).mapInArrow(_gather, BLOCKS)


def _band(y: Column) -> Column:
    return F.floor(y / BAND).cast("int")


def _entry(y: Column, x0: Column, x1: Column, weight: Column) -> Column:
    return F.struct(y.alias("y"), x0.alias("x0"), x1.alias("x1"), weight.alias("weight"))


def _mask_items(rois: DataFrame) -> DataFrame:
    """The mask of each ROI, one row for each band it touches."""
    touched = F.explode(F.array_distinct(F.transform("pixels", lambda p: _band(p["y"])))).alias("band")
    cut = rois.select("plane", "roi", "pixels", touched)
    own = F.filter("pixels", lambda p: _band(p["y"]) == F.col("band"))
    entries = F.transform(own, lambda p: _entry(p["y"], p["x"], p["x"], p["lam"].cast("double")))
    return cut.select("plane", "band", "roi", F.lit(False).alias("ring"), entries.alias("entries"))


def _ring_items(runs: DataFrame) -> DataFrame:
    """The runs of rings, each by itself."""
    entry = F.array(_entry(F.col("y"), F.col("x0"), F.col("x1"), F.lit(1.0)))
    return runs.select("plane", _band(F.col("y")).alias("band"), "roi", F.lit(True).alias("ring"), entry.alias("entries"))


def band_weights(rois: DataFrame, ring: tuple[float, float] | None = None, planes: DataFrame | None = None, masks: bool = True) -> DataFrame:
    """``plane, band, items, n_entries``: what the ROIs, and the rings around them, weigh on each band.

    Mask pixels weigh ``lam``, ring pixels 1. The items of ``PART_ROIS`` ROIs make a row,
    so that a crowded band is several rows.
    """
    rois = settle(rois.select("plane", "roi", "pixels"))  # read for masks, rings and what they must leave out
    sides = ([_mask_items(rois)] if masks else []) + ([_ring_items(ring_rows(rois, *ring, planes))] if ring else [])
    items = sides[0] if len(sides) == 1 else sides[0].unionByName(sides[1])
    part = F.expr(f"roi div {PART_ROIS}").alias("part")
    grouped = items.groupBy("plane", "band", part).agg(F.collect_list(F.struct("roi", "ring", "entries")).alias("items"))
    return grouped.select("plane", "band", "items", F.aggregate("items", F.lit(0), lambda n, i: n + F.size(i["entries"])).alias("n_entries"))


class _Weights:
    """The weights of a band by pixel, ordered by ROI."""

    def __init__(self, items: pa.Array) -> None:
        from_items = items.field("entries")
        flat, size = from_items.flatten(), np.asarray(from_items.value_lengths(), dtype=np.int64)
        y, x0, x1 = (flat.field(c).to_numpy(zero_copy_only=False).astype(np.int64) for c in ("y", "x0", "x1"))
        owner = np.repeat(items.field("roi").to_numpy(zero_copy_only=False).astype(np.int64) * 2 + np.asarray(items.field("ring")), size)
        width = x1 - x0 + 1
        step = np.arange(int(width.sum())) - np.repeat(np.cumsum(width) - width, width)
        pixel = np.repeat(y % BAND << _ROW_BITS | x0, width) + step
        owner, weight = np.repeat(owner, width), np.repeat(flat.field("weight").to_numpy(zero_copy_only=False), width)
        order = np.argsort(owner, kind="stable")
        owner, self.weight = owner[order], weight[order]
        self.pixels, self.column = np.unique(pixel[order], return_inverse=True)
        self.first = np.flatnonzero(np.r_[True, owner[1:] != owner[:-1]]) if len(owner) else np.zeros(0, np.int64)
        number = np.cumsum(np.r_[True, owner[1:] != owner[:-1]]) - 1 if len(owner) else self.first
        self.by_pixel = np.argsort(self.column, kind="stable")
        self.of_pixel = np.bincount(self.column, minlength=len(self.pixels))
        self.number = number[self.by_pixel]
        self.roi, self.ring = owner[self.first] >> 1, (owner[self.first] & 1).astype(bool)

    def sums(self, at: np.ndarray, value: np.ndarray) -> Iterator[tuple[np.ndarray, ...]]:
        """Frame, ROI number, Σ weight·value and Σ weight where a ROI has values."""
        pixel, frame = at & ((1 << _FRAME_BITS) - 1), at >> _FRAME_BITS
        place = np.minimum(np.searchsorted(self.pixels, pixel), len(self.pixels) - 1)
        met = self.pixels[place] == pixel
        if not met.any():
            return  # and bincount of nothing has whole numbers
        if self.of_pixel[place[met]].sum() * 8 < FRAMES * len(self.weight):
            yield self._sparse_sums(frame[met], place[met], value[met])
            return
        cell, shape = frame[met] * len(self.pixels) + place[met], (FRAMES, len(self.pixels))
        values = np.bincount(cell, value[met], FRAMES * len(self.pixels)).reshape(shape)
        times = np.bincount(cell, minlength=FRAMES * len(self.pixels)).reshape(shape)
        stop = np.r_[self.first[1:], len(self.weight)]
        lo = 0
        while lo < len(self.first):
            hi = max(int(np.searchsorted(stop, self.first[lo] + AT_ONCE, "right")), lo + 1)
            of = slice(self.first[lo], stop[hi - 1])
            cuts, column, weight = self.first[lo:hi] - self.first[lo], self.column[of], self.weight[of]
            present = np.add.reduceat(times[:, column], cuts, axis=1) > 0
            at_frame, number = np.nonzero(present)
            top = np.add.reduceat(values[:, column] * weight, cuts, axis=1)[present]
            bottom = np.add.reduceat(times[:, column] * weight, cuts, axis=1)[present]
            yield at_frame, number + lo, top, bottom
            lo = hi


    def _sparse_sums(self, frame: np.ndarray, place: np.ndarray, value: np.ndarray) -> tuple[np.ndarray, ...]:
        """The same where few of the pixels have values: each value with the weights of its pixel."""
        many = self.of_pixel[place]
        first = (np.cumsum(self.of_pixel) - self.of_pixel)[place]
        step = np.arange(int(many.sum())) - np.repeat(np.cumsum(many) - many, many)
        at = np.repeat(first, many) + step
        key, own = np.unique(self.number[at] * FRAMES + np.repeat(frame, many), return_inverse=True)
        weight = self.weight[self.by_pixel[at]]
        top = np.bincount(own, weight * np.repeat(value, many), len(key))
        return key % FRAMES, key // FRAMES, top, np.bincount(own, weight, len(key))


def _fold(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    last, weights = None, None
    for batch in batches:
        for i in range(batch.num_rows):
            row = {name: batch.column(name)[i] for name in batch.schema.names}
            key = (row["plane"].as_py(), row["band"].as_py(), row["items"].values.field("roi")[0].as_py())
            if key != last:
                last, weights = key, _Weights(row["items"].values)
            if not len(weights.pixels):
                continue
            at = row["at"].values.to_numpy().astype(np.int64)
            start = row["block"].as_py() * FRAMES
            for frame, number, top, bottom in weights.sums(at, row["value"].values.to_numpy()):
                yield pa.RecordBatch.from_pydict(
                    {
                        "plane": pa.array(np.full(len(frame), key[0]), pa.int32()),
                        "roi": pa.array(weights.roi[number], pa.int32()),
                        "ring": pa.array(weights.ring[number]),
                        "frame": pa.array(frame + start, pa.int64()),
                        "top": top,
                        "bottom": bottom,
                    }
                )


def _small(weights: DataFrame, limit: int) -> bool:
    size = weights.agg(F.coalesce(F.sum(F.col("n_entries") * ENTRY_BYTES + 64), F.lit(0))).first()[0]
    return size <= limit


def _met_sums(blocks: DataFrame, weights: DataFrame) -> DataFrame:
    send_code(blocks.sparkSession)
    met = blocks.join(weights, ["plane", "band"])
    return met.select("plane", "band", "block", "at", "value", "items").mapInArrow(_fold, _SUMS)


def block_sums(blocks: DataFrame, weights: DataFrame, limit: int = BROADCAST_BYTES) -> DataFrame:
    """``plane, roi, ring, frame, top, bottom``: sums of each block row, several for a ROI on several bands.

    ``weights`` are read twice, measured and joined: pass a written table.
    """
    return _met_sums(blocks, F.broadcast(weights) if _small(weights, limit) else weights)


def extract(blocks: DataFrame, weights: DataFrame, limit: int = BROADCAST_BYTES) -> DataFrame:
    """``plane, roi, frame, f, fneu``: Σ weight·value / Σ weight over masks and over rings.

    A trace without a value in a frame is NULL there, a frame without either has no
    row, and so has a ROI without any value.
    """
    weights = settle(weights)
    if _small(weights, limit):
        sums = _met_sums(blocks, F.broadcast(weights))
    else:
        sums = _met_sums(gathered(blocks), weights)

    def side(kind: Column, name: str) -> list[Column]:
        return [F.sum(F.when(kind, F.col(c))).alias(f"{name}_{c}") for c in ("top", "bottom")]

    both = sums.groupBy("plane", "roi", "frame").agg(*side(~F.col("ring"), "f"), *side(F.col("ring"), "fneu"))
    ratio = [
        F.when(F.col(f"{n}_bottom").isNotNull(), arrays.divide(F.col(f"{n}_top"), F.col(f"{n}_bottom"))).alias(n)
        for n in ("f", "fneu")
    ]
    return both.select("plane", "roi", "frame", *ratio)
