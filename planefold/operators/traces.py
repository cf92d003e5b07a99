"""Per-ROI trace operators.

Traces keep one row per ROI with arrays over frames: everything that concerns a
single ROI is an array expression and needs no shuffle. Rows are exploded last,
and frames are sliced before that, because a filter on an exploded position
cannot reach back into the array.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from planefold.constants import SAMPLE_SIZE, STRIDE_TARGET
from planefold.functions import arrays
from planefold.operators.ordering import numbered, top_per_group
from planefold.operators.sizing import small_side
from planefold.session import settle

Bounds = tuple[int, int | None]
KEYS = ["plane", "roi"]


def trace_window(
    traces: DataFrame,
    rois: Bounds | None = None,
    frames: Bounds | None = None,
    column: str = "f",
) -> DataFrame:
    """ROIs and frames inside half-open windows; ``None`` keeps the whole axis.

    Adds ``frame0``, the frame number of the first kept element.
    """
    kept, values, start = traces, F.col(column), 0
    if rois is not None:
        kept = kept.filter(F.col("roi") >= rois[0])
        if rois[1] is not None:
            kept = kept.filter(F.col("roi") < rois[1])
    if frames is not None:
        start = frames[0]
        values = arrays.window_slice(values, start, frames[1])
    return kept.select(*KEYS, F.lit(start).alias("frame0"), values.alias("f"))


def windowed_long(window: DataFrame) -> DataFrame:
    """One row per ROI and frame of a trace window."""
    return window.select(*KEYS, "frame0", F.posexplode("f").alias("pos", "f")).select(
        *KEYS, (F.col("frame0") + F.col("pos")).alias("frame"), "f"
    )


def zscored(window: DataFrame) -> DataFrame:
    """Z-score of each trace, as an array ``z``."""
    return window.withColumn("z", arrays.zscore(F.col("f")))


def zscored_long(window: DataFrame, *keep: str) -> DataFrame:
    """Z-score in long form, with the columns ``keep``.

    Mean and spread come from the array once per ROI; the division happens after
    the explode, inside generated code.
    """
    scaled = window.withColumn("m", arrays.moments(F.col("f")))
    long = scaled.select(*KEYS, *keep, "frame0", "m.mean", "m.sd", F.posexplode("f").alias("pos", "v"))
    z = (F.col("v").cast("double") - F.col("mean")) / F.col("sd")
    return long.select(*KEYS, *keep, (F.col("frame0") + F.col("pos")).alias("frame"), z.alias("z"))


def roi_activity(window: DataFrame) -> DataFrame:
    """Mean absolute z-score of each ROI."""
    return window.select(*KEYS, arrays.activity(F.col("f")).alias("activity"))


def long_activity(long: DataFrame, column: str = "f") -> DataFrame:
    """``roi_activity`` of traces in long form (plane, roi, frame), by two aggregations.

    No ROI's frames are gathered. An absent or NaN value makes the activity NaN.
    """
    value = F.coalesce(F.col(column).cast("double"), F.lit(arrays.NAN))
    scale = long.groupBy(*KEYS).agg(F.avg(value).alias("mean"), F.stddev_pop(value).alias("sd"))
    # a written table: adaptive execution splits a long trace only if no aggregate stands between join and shuffle
    met = long.select(*KEYS, value.alias("v")).join(small_side(settle(scale)), KEYS)
    z = arrays.divide(F.col("v") - F.col("mean"), F.col("sd"))
    return met.groupBy(*KEYS).agg(F.avg(F.abs(z)).alias("activity"))


def most_active_first() -> list[Column]:
    """Descending activity, NaN first, ties by ROI index."""
    return [F.col("activity").desc(), F.col("roi").asc()]


def activity_rank(
    traces: DataFrame, rois: Bounds | None = None, frames: Bounds | None = None
) -> DataFrame:
    """1-based rank of each ROI by activity within its plane.

    The window is applied before ranking, and the ranking is distributed: no plane
    is sorted in one task, whatever its size.
    """
    return ranked(roi_activity(trace_window(traces, rois, frames)))


def ranked(active: DataFrame) -> DataFrame:
    """1-based rank of each ROI of ``plane, roi, activity`` within its plane."""
    # Sampling the range bounds reads the input once more; written first, that
    # costs a narrow table instead of a second pass over the traces.
    placed = numbered(settle(active), ["plane"], most_active_first(), "position")
    return placed.select(*KEYS, "activity", (F.col("position") + 1).cast("int").alias("rank"))


def activity_top_k(
    traces: DataFrame, k: int, rois: Bounds | None = None, frames: Bounds | None = None
) -> DataFrame:
    """The ``k`` most active ROIs of each plane."""
    active = roi_activity(trace_window(traces, rois, frames))
    return top_per_group(active, ["plane"], most_active_first(), k, "rank")


def trace_heatmap(
    traces: DataFrame,
    rois: Bounds | None = None,
    frames: Bounds | None = None,
    by_activity: bool = True,
) -> DataFrame:
    """Z-scored traces with their row in the heatmap of their plane.

    Only the narrow ranking is sorted; the traces join it by ROI.
    """
    window, order = _heatmap_rows(traces, rois, frames, by_activity)
    return zscored(window.join(order, KEYS)).select("plane", "row", "roi", "z")


def trace_heatmap_long(
    traces: DataFrame, rois: Bounds | None = None, frames: Bounds | None = None, by_activity: bool = True
) -> DataFrame:
    """The heatmap with a row per frame; each trace's moments are computed once."""
    window, order = _heatmap_rows(traces, rois, frames, by_activity)
    return zscored_long(window.join(order, KEYS), "row").select("plane", "row", "roi", "frame", "z")


def _heatmap_rows(
    traces: DataFrame, rois: Bounds | None, frames: Bounds | None, by_activity: bool
) -> tuple[DataFrame, DataFrame]:
    """Trace window, and the heatmap row of each ROI (broadcast if measured small)."""
    window = trace_window(traces, rois, frames)
    if by_activity:
        order = activity_rank(traces, rois, frames).select(*KEYS, (F.col("rank") - 1).alias("row"))
    else:
        order = numbered(window.select(*KEYS), ["plane"], ["roi"], "row")
        order = order.select(*KEYS, F.col("row").cast("int").alias("row"))
    return window, small_side(order)


def grid_layout(traces: DataFrame) -> DataFrame:
    """Panel position of each plane in a near-square grid, planes in order.

    The label names the planes of a grid row and sits on its first panel.
    """
    planes = numbered(traces.select("plane").distinct(), [], ["plane"], "idx", total="n")
    side = F.ceil(F.sqrt("n"))
    planes = planes.withColumn("cols", F.when(F.col("n") > side * (side - 1), side).otherwise(side - 1))
    first = F.col("idx") % F.col("cols") == 0
    last = F.least(F.col("idx") + F.col("cols"), F.col("n"))
    label = F.concat(F.lit("Planes "), F.col("idx") + 1, F.lit("-"), last)
    return planes.select(
        "plane",
        F.floor(F.col("idx") / F.col("cols")).cast("int").alias("row"),
        (F.col("idx") % F.col("cols")).cast("int").alias("col"),
        F.when(first, label).alias("row_label"),
        side.cast("int").alias("grid_rows"),
        F.col("cols").cast("int").alias("grid_cols"),
    )


def trace_sample(traces: DataFrame, n: int = SAMPLE_SIZE, seed: int = 0) -> DataFrame:
    """Up to ``n`` ROIs per plane, uniformly and repeatably for one seed."""
    drawn = traces.select(*KEYS).withColumn("key", F.md5(F.concat_ws(":", F.lit(seed), *KEYS)))
    return top_per_group(drawn, ["plane"], ["key", "roi"], n, "sample_rank").select(*KEYS, "sample_rank")


def thinned(
    traces: DataFrame,
    columns: Sequence[str] = ("f",),
    nframes: int | None = None,
    target: int | None = STRIDE_TARGET,
) -> DataFrame:
    """First ``nframes`` frames, thinned to about ``target`` points (``None``: all).

    Adds ``step``, the distance between kept frames.
    """
    frames = F.size(columns[0]) if nframes is None else F.least(F.lit(nframes), F.size(columns[0]))
    step = F.lit(1) if target is None else arrays.stride_of(frames, target)
    stepped = traces.select(*KEYS, *columns, step.alias("step"))
    return stepped.select(
        *KEYS,
        "step",
        *[
            arrays.every(F.col(c) if nframes is None else F.slice(c, 1, nframes), F.col("step")).alias(c)
            for c in columns
        ],
    )


def trace_stride(
    traces: DataFrame, nframes: int | None = None, target: int | None = STRIDE_TARGET
) -> DataFrame:
    """Thinned traces in long form; ``timepoint`` is the original frame."""
    points = thinned(traces, ["f"], nframes, target)
    points = exploded(points, "step")
    return points.select(*KEYS, (F.col("pos") * F.col("step")).alias("timepoint"), "f")


def exploded(traces: DataFrame, *keep: str) -> DataFrame:
    """A computed array ``f`` by position.

    The outer form, whose row of an empty array goes again: for the inner form the
    optimizer would compute the array once more to see whether it is empty.
    """
    long = traces.select(*KEYS, *keep, F.posexplode_outer("f").alias("pos", "f"))
    return long.filter("pos IS NOT NULL")


def _ranges(points: DataFrame) -> DataFrame:
    """Thinned traces with the display range of each ROI, one row each."""
    lows = [arrays.nan_min(F.col(c)) for c in ("f", "fneu")]
    fmin = F.when(F.isnan(lows[0]) | F.isnan(lows[1]), F.lit(arrays.NAN)).otherwise(F.least(*lows))
    fmax = F.greatest(F.array_max("f"), F.array_max("fneu"))
    return points.withColumns({"fmin": fmin.cast("double"), "fmax": fmax.cast("double")})


def trace_display(
    traces: DataFrame, nframes: int | None = None, target: int | None = STRIDE_TARGET
) -> DataFrame:
    """Cell, neuropil and spike traces of each ROI on one display range.

    The range spans both fluorescence traces after thinning. Spikes are scaled to
    that range (unless they are all zero) and lifted to its lower end.
    """
    points = _ranges(thinned(traces, ["f", "fneu", "spks"], nframes, target))
    ranged = points.select(
        *KEYS,
        "step",
        "fmin",
        "fmax",
        F.array_max("spks").cast("double").alias("smax"),
        F.posexplode(F.arrays_zip("f", "fneu", "spks")).alias("pos", "v"),
    )
    spike = F.col("v.spks").cast("double")
    range_ = F.col("fmax") - F.col("fmin")
    spiking = (F.col("smax") > 0) & ~F.isnan("smax")
    scaled = F.when(spiking, spike / F.col("smax") * range_).otherwise(spike)
    return ranged.select(
        *KEYS,
        "fmin",
        "fmax",
        (F.col("pos") * F.col("step")).alias("timepoint"),
        F.col("v.f").alias("f"),
        F.col("v.fneu").alias("fneu"),
        (scaled + F.col("fmin")).alias("spk_scaled"),
    )


def _labels(ranged: DataFrame) -> DataFrame:
    return ranged.select(
        *KEYS,
        F.format_string("%.1f", "fmin").alias("low_label"),
        F.format_string("%.1f", "fmax").alias("high_label"),
        F.concat(F.lit("ROI "), F.col("roi")).alias("axis_label"),
    )


def trace_labels(traces: DataFrame, nframes: int | None = None, target: int | None = STRIDE_TARGET) -> DataFrame:
    """Tick texts of the display range and the axis name of each ROI, from its one row."""
    return _labels(_ranges(thinned(traces, ["f", "fneu"], nframes, target)))


def display_labels(display: DataFrame) -> DataFrame:
    """The labels of a display that is at hand already; ``trace_labels`` needs no row per frame."""
    return _labels(display.select(*KEYS, "fmin", "fmax").distinct())


def interval_caption(rois: Bounds, frames: Bounds) -> Column:
    """Caption of a heatmap grid."""
    return F.format_string(
        "Frame Interval: %s-%s, ROI Interval: %s-%s", *[F.lit(str(b)) for b in (*frames, *rois)]
    )


def align_traces(f: DataFrame, fneu: DataFrame, spks: DataFrame) -> DataFrame:
    """One row per ROI of any of three (plane, roi, values) tables; an absent trace is NULL."""
    sides = [t.select(*KEYS, F.col("values").alias(c)) for c, t in (("f", f), ("fneu", fneu), ("spks", spks))]
    return sides[0].join(sides[1], KEYS, "full_outer").join(sides[2], KEYS, "full_outer")


def collect_traces(traces: DataFrame | Sequence[DataFrame], sources: DataFrame | None = None) -> DataFrame:
    """All planes' traces in one table, ``plane`` = 1-based position.

    Either a list of per-plane tables, positioned as listed, or one table with a
    ``plane`` key and ``sources`` (plane, path), positioned by path.
    """
    if isinstance(traces, DataFrame):
        if sources is None:
            raise ValueError("a single table needs `sources` to order its planes")
        placed = numbered(sources.select("plane", "path"), [], ["path", "plane"], "position")
        placed = placed.select("plane", (F.col("position") + 1).cast("int").alias("position"))
        missing = F.raise_error(F.concat_ws(" ", F.lit("no source for plane"), "plane")).cast("int")
        joined = traces.join(small_side(placed), "plane", "left").withColumn("position", F.coalesce("position", missing))
        return joined.drop("plane").withColumnRenamed("position", "plane").select(traces.columns)
    if not isinstance(traces, (list, tuple)):
        raise ValueError("`traces` must be a list of DataFrames")
    if not traces:
        raise ValueError("`traces` must contain at least one element")
    numbered_ = [t.drop("plane").withColumn("plane", F.lit(i + 1)) for i, t in enumerate(traces)]
    whole = numbered_[0]
    for table in numbered_[1:]:
        whole = whole.unionByName(table)
    return whole


def trace_shape(traces: DataFrame) -> DataFrame:
    """ROIs and frames of each plane."""
    return traces.groupBy("plane").agg(
        F.count(F.lit(1)).cast("int").alias("n_rois"), F.max(F.size("f")).alias("n_frames")
    )


def neuropil_corrected(traces: DataFrame, coefficient: float) -> DataFrame:
    """Trace minus ``coefficient`` times its neuropil trace."""
    factor = F.lit(float(coefficient))
    corrected = F.zip_with("f", "fneu", lambda f, n: f.cast("double") - factor * n.cast("double"))
    return traces.withColumn("f", corrected)
