"""Pixel maps and features of ROIs, from sparse pixel lists.

ROI masks are never made dense. A map is one aggregation over exploded pixels:
its buffers are plain numbers, so Spark hash-aggregates and combines before the
shuffle, and a crowded pixel or plane does not land in one task.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from planefold.functions import arrays
from planefold.functions.color import hsv_to_rgb, roi_hue
from planefold.operators.sizing import small_side

PIXEL_KEYS = ["plane", "y", "x"]


def with_flags(rois: DataFrame, flags: DataFrame) -> DataFrame:
    """ROI masks with their cell flag (and class, if given), matched by ROI index.

    A ROI without a flag is an error when its flag is used.
    """
    own = ["iscell", *[c for c in ("class_",) if c in flags.columns]]
    missing = F.raise_error(F.concat_ws(" ", F.lit("no cell flag for plane"), "plane", F.lit("ROI"), "roi"))
    joined = rois.join(small_side(flags.select("plane", "roi", *own)), ["plane", "roi"], "left")
    return joined.withColumn("iscell", F.coalesce("iscell", missing.cast("boolean")))


def cells(rois: DataFrame) -> DataFrame:
    return rois.filter("iscell")


def non_cells(rois: DataFrame) -> DataFrame:
    return rois.filter(~F.coalesce("iscell", F.lit(False)))


def pixels(rois: DataFrame) -> DataFrame:
    """One row per ROI pixel; ``pos`` is its place in the list."""
    flag = ["iscell"] if "iscell" in rois.columns else []
    return rois.select("plane", "roi", *flag, F.posexplode("pixels").alias("pos", "p")).select(
        "plane", "roi", *flag, "pos", "p.y", "p.x", "p.lam"
    )


def raster_rows(sparse: DataFrame, planes: DataFrame, empty: dict[str, Column], by: dict[str, Column] | None = None) -> DataFrame:
    """A sparse map as picture rows: ``pixels`` holds every position of a row of a plane once, in no order.

    ``empty`` has the map's columns and what they are where the map has no pixel. ``by``
    names further keys of the map and an array of the values that each plane's picture
    is drawn for. Pixels outside of the picture, or of a plane without one, stay. An
    array is as long as a picture row; what is shuffled are the map's pixels and one
    entry per picture row, never an empty pixel.
    """
    by = by or {}
    keys = ["plane", *by, "y"]
    entry = F.struct("x", *empty)
    drawn = sparse.select(*keys, entry.alias("entry"), F.lit(None).cast("int").alias("lx"))
    picture = planes.select("plane", "lx", F.explode(arrays.positions(F.col("ly"), F.lit(1))).alias("y"))
    for name, values in by.items():
        picture = picture.withColumn(name, F.explode(values))
    picture = picture.select(*keys, F.lit(None).cast(drawn.schema["entry"].dataType).alias("entry"), "lx")
    rows = drawn.unionByName(picture).groupBy(*keys).agg(F.collect_list("entry").alias("drawn"), F.max("lx").alias("lx"))
    free = F.array_except(arrays.positions(F.col("lx"), F.lit(1)), F.col("drawn.x"))
    blank = F.transform(free, lambda x: F.struct(x.alias("x"), *[value.alias(name) for name, value in empty.items()]))
    return rows.select(*keys, F.concat("drawn", blank).alias("pixels"))


def raster(sparse: DataFrame, planes: DataFrame, empty: dict[str, Column], by: dict[str, Column] | None = None) -> DataFrame:
    """``raster_rows`` with a row per pixel, in the columns of the map."""
    rows = raster_rows(sparse, planes, empty, by)
    return rows.select(*rows.columns[:-1], F.inline("pixels")).select(*sparse.columns)


def label_map(rois: DataFrame, planes: DataFrame | None = None) -> DataFrame:
    """Largest label (ROI index + 1) per pixel: all ROIs, non-cells, cells.

    With ``planes`` the map is dense: pixels without a ROI appear with NULL.
    """
    labels = pixels(rois).select(*PIXEL_KEYS, "iscell", (F.col("roi") + 1).alias("label"))
    sparse = labels.groupBy(*PIXEL_KEYS).agg(
        F.max("label").alias("label_all"),
        F.max(F.when(~F.col("iscell"), F.col("label"))).alias("label_noncell"),
        F.max(F.when(F.col("iscell"), F.col("label"))).alias("label_cell"),
    )
    if planes is None:
        return sparse
    none = {name: F.lit(None).cast("int") for name in sparse.columns if name not in PIXEL_KEYS}
    return raster(sparse, planes, none)


def as_nan(raster: DataFrame, *columns: str) -> DataFrame:
    """Absent labels as NaN, the dense convention."""
    return raster.withColumns(
        {c: F.coalesce(F.col(c).cast("double"), F.lit(arrays.NAN)) for c in columns}
    )


def weighted_pixels(rois: DataFrame) -> DataFrame:
    """Pixels with their weight relative to the ROI's largest (NaN if that is 0)."""
    own = ["iscell", *[c for c in ("class_",) if c in rois.columns]]
    peak = rois.withColumn("peak", F.array_max(F.col("pixels.lam")).cast("double"))
    long = peak.select("plane", "roi", *own, "peak", F.posexplode("pixels").alias("pos", "p"))
    lam = F.col("p.lam").cast("double")
    return long.select(
        "plane", "roi", *own, "pos", "p.y", "p.x", arrays.divide(lam, F.col("peak")).alias("weight")
    )


def paint_map(rois: DataFrame, planes: DataFrame | None = None) -> DataFrame:
    """RGB per class and pixel; of overlapping ROIs the last one paints.

    The class is ``class_`` (``volume.cell_class``) where the ROIs have it, else their
    flag; ``iscell`` tells whether it is 1.
    "Last" is the highest ROI index, then the last listed pixel, packed into one
    number so that the aggregation keeps primitive buffers. With ``planes`` the
    map is dense and unpainted pixels are black.
    """
    painted = weighted_pixels(rois)
    painted = painted.select(
        "plane",
        (F.col("class_") == 1 if "class_" in painted.columns else F.col("iscell")).alias("iscell"),
        "y",
        "x",
        "weight",
        F.shiftleft(F.col("roi").cast("long"), 32).bitwiseOR(F.col("pos").cast("long")).alias("turn"),
    )
    top = painted.groupBy("plane", "iscell", "y", "x").agg(
        F.max_by("weight", "turn").alias("weight"), F.max("turn").alias("turn")
    )
    rgb = hsv_to_rgb(roi_hue(F.shiftright("turn", 32)), F.lit(1.0), F.col("weight"))
    sparse = top.select("plane", "iscell", "y", "x", rgb.alias("rgb")).select(
        "plane", "iscell", "y", "x", "rgb.r", "rgb.g", "rgb.b"
    )
    if planes is None:
        return sparse
    return raster(sparse, planes, {c: F.lit(0.0) for c in "rgb"}, {"iscell": F.array(F.lit(False), F.lit(True))})


def signal_features(traces: DataFrame) -> DataFrame:
    """Skewness, variance and neuropil correlation of each trace (population).

    Array folds over the one row of a ROI: nothing is exploded or shuffled. An empty
    trace has no variance (NULL), and NaN for the others.
    """
    zero = F.lit(0.0)

    def mean(name: str) -> Column:
        total = F.aggregate(name, zero, lambda s, v: s + v.cast("double"))
        return F.when(F.size(name) > 0, total / F.size(name))

    def sums(m: Column) -> Column:
        start = F.struct(*[zero.alias(k) for k in ("d2", "d3", "de", "e2")])

        def add(s: Column, v: Column) -> Column:
            d, e = v["f"].cast("double") - m["f"], v["fneu"].cast("double") - m["fneu"]
            return F.struct(
                (s["d2"] + d * d).alias("d2"), (s["d3"] + d * d * d).alias("d3"),
                (s["de"] + d * e).alias("de"), (s["e2"] + e * e).alias("e2"),
            )

        return F.aggregate(F.arrays_zip("f", "fneu"), start, add)

    means = F.struct(mean("f").alias("f"), mean("fneu").alias("fneu"))
    found = traces.select("plane", "roi", F.size("f").alias("n"), arrays.bind(means, sums).alias("s"))
    d2, e2, n = F.col("s.d2"), F.col("s.e2"), F.greatest("n", F.lit(1))
    return found.select(
        "plane",
        "roi",
        arrays.divide(F.col("s.d3") / n, F.pow(d2 / n, 1.5)).alias("skewness"),
        F.when(F.col("n") > 0, d2 / n).alias("variance"),
        arrays.divide(F.col("s.de"), F.sqrt(d2) * F.sqrt(e2)).alias("corr"),
    )


def shape_features(rois: DataFrame) -> DataFrame:
    """Pixel count and aspect ratio (longer over shorter side of the bounding box)."""
    ys, xs = F.col("pixels.y"), F.col("pixels.x")
    height = F.array_max(ys) - F.array_min(ys) + 1
    width = F.array_max(xs) - F.array_min(xs) + 1
    return rois.select(
        "plane",
        "roi",
        F.size("pixels").alias("area"),
        (F.greatest(height, width) / F.least(height, width)).alias("aspect"),
    )


def roi_features(traces: DataFrame, rois: DataFrame) -> DataFrame:
    """Activity and shape features side by side, for every ROI that has a trace or a mask; what it lacks is NULL."""
    return beside_shape(signal_features(traces), rois)


def beside_shape(features: DataFrame, rois: DataFrame) -> DataFrame:
    """Features of traces and of masks by ROI; what a ROI lacks is NULL."""
    return features.join(shape_features(rois), ["plane", "roi"], "full_outer")
