"""Masks as runs of pixels per picture row, and rings around them as differences of intervals.

A run is ``(x0, x1)``, both ends in it. Runs of an array are apart and ascend. Of a ring,
the at most two runs in a picture row meet the runs that masks leave free there; what
both have in common stays. No ring pixel is listed, shuffled or joined.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from planefold.functions import arrays
from planefold.operators.sizing import small_side
from planefold.session import settle

RUNS = "array<struct<x0:int,x1:int>>"
WIDEST = (1 << 31) - 1


def run(x0: Column, x1: Column) -> Column:
    return F.struct(x0.cast("int").alias("x0"), x1.cast("int").alias("x1"))


def runs_of(positions: Column) -> Column:
    """Runs of sorted, distinct positions."""

    def both(xs: Column) -> Column:
        first = F.filter(xs, lambda x, i: (i == 0) | (F.get(xs, i - 1) != x - 1))
        last = F.filter(xs, lambda x, i: (i == F.size(xs) - 1) | (F.get(xs, i + 1) != x + 1))
        return F.zip_with(first, last, run)

    return arrays.bind(positions, both)


def mask_rows(rois: DataFrame) -> DataFrame:
    """Each ROI's mask as ``plane, roi, y, runs``; a pixel listed twice counts once."""
    pixel = rois.select("plane", "roi", F.explode("pixels").alias("p")).select("plane", "roi", "p.y", "p.x")
    return pixel.groupBy("plane", "roi", "y").agg(runs_of(F.sort_array(F.collect_set("x"))).alias("runs"))


def taken_rows(rois: DataFrame) -> DataFrame:
    """What all masks together cover, as ``plane, y, runs``.

    A picture row has no more positions than the picture is wide, however many ROIs
    crowd on it, and each task sends each position once.
    """
    pixel = rois.select("plane", F.explode("pixels").alias("p")).select("plane", "p.y", "p.x")
    return pixel.groupBy("plane", "y").agg(runs_of(F.sort_array(F.collect_set("x"))).alias("runs"))


def free_rows(taken: DataFrame) -> DataFrame:
    """What ``taken`` rows leave, as runs ``plane, y, x0, x1``; the last of a row is open to the right."""
    starts = F.concat(F.array(F.lit(0)), F.transform("runs", lambda r: r["x1"] + 1))
    ends = F.concat(F.transform("runs", lambda r: r["x0"] - 1), F.array(F.lit(WIDEST)))
    return taken.select("plane", "y", F.inline(F.zip_with(starts, ends, run))).filter("x0 <= x1")


def _ring_sides(inner: float, outer: float, width: Column) -> Column:
    """``struct(l0, l1, r0, r1)``: the runs of a ring left and right of its hole in a picture row, clipped to ``width``.

    Ends are rounded outwards and then tested as pixels are. Each step is bound, so that
    it is computed once and the generated code stays small enough to be compiled.
    """
    cx, wide = F.col("cx"), float(outer) ** 2
    hole = float(inner) ** 2
    dy = F.col("y") - F.col("cy")

    def rounded(dy2: Column) -> Column:
        def half(square: float) -> Column:
            return F.sqrt(F.greatest(F.lit(square) - dy2, F.lit(0.0))) + F.lit(1e-6)

        ends = {"o0": F.ceil(cx - half(wide)), "o1": F.floor(cx + half(wide)), "i0": F.ceil(cx - half(hole)), "i1": F.floor(cx + half(hole))}
        return F.struct(dy2.alias("dy2"), *[end.cast("int").alias(name) for name, end in ends.items()])

    def tested(e: Column) -> Column:
        def outside(x: Column, square: float) -> Column:
            return (e["dy2"] + (x - cx) * (x - cx) > F.lit(square)).cast("int")

        return F.struct(
            F.greatest(e["o0"] + outside(e["o0"], wide), F.lit(0)).alias("o0"),
            F.least(e["o1"] - outside(e["o1"], wide), width).alias("o1"),
            (e["i0"] + outside(e["i0"], hole)).alias("i0"),
            (e["i1"] - outside(e["i1"], hole)).alias("i1"),
        )

    def sides(t: Column) -> Column:
        solid = t["i0"] > t["i1"]
        return F.struct(
            t["o0"].alias("l0"),
            F.when(solid, t["o1"]).otherwise(F.least(t["o1"], t["i0"] - 1)).alias("l1"),
            F.when(solid, t["o1"] + 1).otherwise(F.greatest(t["o0"], t["i1"] + 1)).alias("r0"),
            t["o1"].alias("r1"),
        )

    return arrays.bind(arrays.bind(arrays.bind(dy * dy, rounded), tested), sides)


def centroids(rois: DataFrame) -> DataFrame:
    """Mean pixel position of each ROI."""

    def mean(values: Column) -> Column:
        total = F.aggregate(values, F.lit(0).cast("long"), lambda acc, v: acc + v.cast("long"))
        return total / F.size(values)

    return rois.filter(F.size("pixels") > 0).select(
        "plane", "roi", mean(F.col("pixels.y")).alias("cy"), mean(F.col("pixels.x")).alias("cx")
    )


def ring_rows(rois: DataFrame, inner: float, outer: float, planes: DataFrame | None = None) -> DataFrame:
    """Pixels at distance (inner, outer] from each ROI's centroid, outside all masks, as runs ``plane, roi, y, x0, x1``.

    ``planes`` (plane, ly, lx) clips the ring to the picture where it names one.
    """
    if not 0 <= inner < outer:
        raise ValueError("ring needs 0 <= inner < outer")
    first = F.greatest(F.ceil(F.col("cy") - F.lit(float(outer))).cast("int"), F.lit(0))
    last = F.floor(F.col("cy") + F.lit(float(outer))).cast("int")
    if planes is not None:
        sized = small_side(planes.select("plane", "ly", "lx"))
        placed = centroids(rois).join(sized, "plane", "left")
        last, width = F.least(last, F.coalesce(F.col("ly") - 1, last)), F.col("lx")
    else:
        placed, width = centroids(rois), F.lit(None).cast("int")
    none = F.array().cast("array<int>")
    y = F.explode(F.when(first <= last, F.sequence(first, last, F.lit(1))).otherwise(none)).alias("y")
    rows = placed.select("plane", "roi", "cy", "cx", width.alias("lx"), y)
    limit = F.coalesce(F.col("lx") - 1, F.lit(WIDEST))
    sides = rows.select("plane", "roi", "y", _ring_sides(inner, outer, limit).alias("s"))
    sides = sides.select("plane", "roi", "y", "s.*")
    taken = settle(taken_rows(rois))  # read for its gaps and for the rows it has
    gaps = small_side(free_rows(taken).withColumnsRenamed({"plane": "of_plane", "y": "of_y"}))
    touch = (F.col("x1") >= F.col("l0")) & (F.col("x0") <= F.col("r1"))
    masked = small_side(taken.select("plane", "y", F.lit(True).alias("masked")))
    of_row = (F.col("plane") == F.col("of_plane")) & (F.col("y") == F.col("of_y")) & touch
    met = sides.join(masked, ["plane", "y"], "left").join(gaps, of_row, "left")
    # a picture row without masks is free throughout
    free = {c: F.when(F.col("masked"), F.col(c)).otherwise(F.lit(end)) for c, end in (("x0", 0), ("x1", WIDEST))}
    met = met.select("plane", "roi", "y", "l0", "l1", "r0", "r1", *[value.alias(c) for c, value in free.items()])
    met = met.filter("x0 IS NOT NULL")

    def common(first: str, last: str) -> Column:
        return run(F.greatest("x0", first), F.least("x1", last))

    parts = met.select("plane", "roi", "y", F.inline(F.array(common("l0", "l1"), common("r0", "r1"))))
    return parts.filter("x0 <= x1")


def listed(rows: DataFrame) -> DataFrame:
    """Runs as pixels ``plane, roi, y, x``."""
    return rows.select("plane", "roi", "y", F.explode(F.sequence("x0", "x1")).alias("x"))
