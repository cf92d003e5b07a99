"""Per-plane statistics and the tables behind the volume figures."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from planefold.constants import LABEL_GAP, LABEL_MIN_SECONDS, PARAM_FILE, STACKED_STEPS, STEPS, TIMING_FIELDS
from planefold.constants import TOTAL_RUNTIME
from planefold.operators.sizing import small_side
from planefold.schemas import VOLUME_STATS


def cell_flag(raw: Column) -> Column:
    """Truth of a raw flag row: its first column is not zero (NaN counts)."""
    return F.get(raw, F.lit(0)) != 0


def cell_class(raw: Column) -> Column:
    """Class that a raw flag row is painted as: its first column without fraction (0.5 is 0)."""
    return F.get(raw, F.lit(0)).cast("int")


def cell_counts(rois: DataFrame) -> DataFrame:
    """Accepted and rejected ROIs of each plane."""
    return rois.groupBy("plane").agg(
        F.count_if("iscell").cast("int").alias("accepted"),
        F.count_if(~F.col("iscell")).cast("int").alias("rejected"),
    )


def volume_signal(traces: DataFrame, cells: DataFrame | None = None) -> DataFrame:
    """Mean and population sd over all ROIs and frames of each plane.

    ``cells`` (plane, roi, iscell) restricts it to accepted ROIs. Each task
    reduces its rows to one partial per plane before the shuffle.
    """
    if cells is not None:
        accepted = small_side(cells.filter("iscell").select("plane", "roi"))
        traces = traces.join(accepted, ["plane", "roi"], "left_semi")
    value = F.col("v").cast("double")
    return traces.select("plane", F.explode("f").alias("v")).groupBy("plane").agg(
        F.avg(value).alias("mean_trace"), F.stddev_pop(value).alias("std_trace")
    )


def long_signal(long: DataFrame, column: str = "f") -> DataFrame:
    """``volume_signal`` of traces in long form (plane, roi, frame); absent values don't count."""
    value = F.col(column).cast("double")
    return long.groupBy("plane").agg(F.avg(value).alias("mean_trace"), F.stddev_pop(value).alias("std_trace"))


def flat_timing(planes: DataFrame) -> DataFrame:
    """Nested step timings as columns."""
    return planes.select("plane", *[F.col(f"timing.{name}").alias(name) for name in TIMING_FIELDS])


def volume_stats(
    rois: DataFrame, traces: DataFrame, planes: DataFrame, cells_only: bool = False
) -> DataFrame:
    """The statistics table: one row per plane that any of the tables has.

    A plane without ROIs counts 0; what else it lacks (traces, accepted cells with
    ``cells_only``, times) is NaN. ``filepath`` is that of the plane's parameter file.
    """
    flags = rois.select("plane", "roi", "iscell")
    signal = volume_signal(traces, flags if cells_only else None)
    times = planes.select(
        "plane",
        *[F.col(f"timing.{name}").alias(name) for name in TIMING_FIELDS],
        F.concat(F.regexp_replace("save_path", "/+$", ""), F.lit(f"/{PARAM_FILE}")).alias("filepath"),
    )
    joined = cell_counts(flags).join(volume_planes(traces), "plane", "full_outer").join(times, "plane", "full_outer")
    joined = joined.join(signal, "plane", "left")
    absent = {"int": F.lit(0), "double": F.lit(float("nan"))}
    return joined.select(
        *[
            (F.coalesce(F.col(f.name), absent[kind]) if (kind := f.dataType.simpleString()) in absent and f.name != "plane" else F.col(f.name))
            .cast(f.dataType)
            .alias(f.name)
            for f in VOLUME_STATS.fields
        ]
    )


def volume_planes(table: DataFrame) -> DataFrame:
    """Planes that a table has."""
    return table.select("plane").distinct()


def signal_bounds(stats: DataFrame) -> DataFrame:
    """Error bars: mean plus and minus one sd."""
    return stats.select(
        "plane",
        "mean_trace",
        "std_trace",
        (F.col("mean_trace") - F.col("std_trace")).alias("lower"),
        (F.col("mean_trace") + F.col("std_trace")).alias("upper"),
    )


def count_bars(stats: DataFrame) -> DataFrame:
    """Stacked bars of accepted and rejected ROIs with label places."""
    accepted, rejected = F.col("accepted"), F.col("rejected")
    return stats.select(
        "plane",
        "accepted",
        "rejected",
        accepted.alias("rejected_bottom"),
        F.when(accepted > 0, accepted / 2).alias("accepted_mid"),
        F.when(rejected > 0, accepted + rejected / 2).alias("rejected_mid"),
        F.when(accepted > 0, accepted.cast("string")).alias("accepted_label"),
        F.when(rejected > 0, rejected.cast("string")).alias("rejected_label"),
    )


def time_stack(stats: DataFrame, all_steps: bool = False) -> DataFrame:
    """Stacked step times; the last bar carries the total runtime as label.

    By default only the three steps that are drawn.
    """
    steps = STEPS if all_steps else STACKED_STEPS
    bars, bottom = [], F.lit(0.0)
    for number, step in enumerate(steps):
        top = bottom + F.col(step)
        bars.append(
            F.struct(
                F.lit(number).alias("position"),
                F.lit(step).alias("step"),
                bottom.alias("bottom"),
                top.alias("top"),
            )
        )
        bottom = top
    long = stats.select("plane", TOTAL_RUNTIME, F.inline(F.array(*bars)))
    shown = (F.col("position") == len(steps) - 1) & (F.col(TOTAL_RUNTIME) > LABEL_MIN_SECONDS)
    return long.select(
        "plane",
        "step",
        "bottom",
        "top",
        F.when(shown, F.col(TOTAL_RUNTIME).cast("long").cast("string")).alias("label"),
        F.when(shown, F.col("top") + LABEL_GAP).alias("label_y"),
    )
