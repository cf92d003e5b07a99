"""The volume job: every output table of a recording."""

from __future__ import annotations

from collections.abc import Callable, Mapping
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass
from functools import partial, reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from planefold.constants import PARAM_FILE, STATS_TABLE
from planefold.operators import movie, rois, traces, volume
from planefold.operators.files import common_root, pending_planes, resolved_params, with_plane_names
from planefold.operators.sizing import small_side
from planefold.session import settle
from planefold.sources import manifest
from planefold.sources.sinks import without_written, write_by_key, write_stats, write_table
from planefold.sources.tables import load_stats


#: Outputs of a run that are written at the same time.
SIDE_BY_SIDE = 4


@dataclass
class Recording:
    """Input tables of a volume."""

    planes: DataFrame
    rois: DataFrame
    traces: DataFrame
    images: DataFrame

    def only(self, planes: DataFrame) -> Recording:
        """The recording reduced to the given planes, in every table; NULL is a plane."""
        kept = small_side(planes.select(F.col("plane").alias("_kept")).distinct())
        same = F.col("plane").eqNullSafe(F.col("_kept"))
        return Recording(*[table.join(kept, same, "left_semi") for table in vars(self).values()])

    def spread(self) -> Recording:
        """The recording with masks and traces written once, in pieces dealt out by ROI.

        For the start of a job whose outputs read them again and again: a file of one row
        group is read by one task, however many cores there are.
        """
        dealt = [settle(table.repartition("plane", "roi")) for table in (self.rois, self.traces)]
        return Recording(self.planes, *dealt, self.images)

    def check(self) -> None:
        if self.planes.isEmpty():
            raise ValueError("the recording has no planes")


@dataclass(frozen=True)
class Extent:
    """What the trace outputs show: everything, unless told otherwise.

    ``rois`` and ``frames`` are half-open windows of the heatmap, ``sample`` the
    number of ROIs drawn per plane, ``points`` about how many points a drawn trace
    keeps.
    """

    rois: traces.Bounds | None = None
    frames: traces.Bounds | None = None
    sample: int | None = None
    points: int | None = None


def _drawn(recording: Recording, extent: Extent) -> DataFrame:
    shown = recording.traces
    if extent.sample is not None:
        drawn = small_side(traces.trace_sample(shown, extent.sample))
        shown = shown.join(drawn, ["plane", "roi"], "left_semi")
    return traces.trace_display(shown, target=extent.points)


def max_projection(images: DataFrame) -> DataFrame:
    """The panel that the ROI maps are shown beside."""
    return images.filter(F.col("kind") == "max_proj").select("plane", "y", "x", "value")


# What each plane yields on its own.
PLANE_OUTPUTS: dict[str, Callable[[Recording, Extent], DataFrame]] = {
    "registration": lambda r, e: movie.registration_panels(r.images),
    "max_projection": lambda r, e: max_projection(r.images),
    "segmentation": lambda r, e: rois.label_map(r.rois),
    "traces": _drawn,
}

# What is drawn from the statistics table.
STATS_OUTPUTS: dict[str, Callable[[DataFrame], DataFrame]] = {
    "acc_rej_bar": volume.count_bars,
    "mean_volume_signal": volume.signal_bounds,
    "execution_time": volume.time_stack,
}

# What is drawn from all planes at once.
VOLUME_OUTPUTS: dict[str, Callable[[Recording, Extent], DataFrame]] = {
    "max_cell_noncell": lambda r, e: rois.paint_map(r.rois),
    "fluorescence": lambda r, e: traces.trace_heatmap(r.traces, e.rois, e.frames),
    "fluorescence_grid": lambda r, e: traces.grid_layout(r.traces),
}


def post_process(recording: Recording, out: str, overwrite: bool = True, extent: Extent = Extent()) -> dict[str, str]:
    """Write the per-plane outputs.

    Without ``overwrite`` a plane that has an output keeps it, and its rows are
    left out where the tables are read.
    """
    written = {}
    for name, build in PLANE_OUTPUTS.items():
        path = f"{out}/{name}"
        todo = recording if overwrite else recording.only(without_written(recording.planes, path))
        written[name] = write_by_key(build(todo, extent), path, ["plane"])
    return written


def run_volume(
    spark: SparkSession, recording: Recording, out: str, overwrite: bool = False, extent: Extent = Extent()
) -> dict[str, str]:
    """Write every output of a volume and return the paths by name.

    Each output is one Spark job over all planes. ``overwrite`` concerns the
    per-plane outputs; volume outputs are always renewed.
    """
    recording.check()
    written = post_process(recording, out, overwrite, extent)
    stats = volume.volume_stats(recording.rois, recording.traces, recording.planes)
    written[STATS_TABLE] = write_stats(stats, out)
    saved = load_stats(spark, written[STATS_TABLE])
    for name, build in STATS_OUTPUTS.items():
        written[name] = write_table(build(saved), f"{out}/{name}")
    for name, build in VOLUME_OUTPUTS.items():
        written[name] = write_table(build(recording, extent), f"{out}/{name}")
    return written


def planned_inputs(
    files: DataFrame, artifacts: DataFrame, params: Mapping[str, str], save_root: str, **options: str
) -> DataFrame:
    """Files to process: those whose plane lacks an artifact, each with its parameters."""
    named = with_plane_names(files)
    return resolved_params(pending_planes(named, artifacts), params, save_root, **options)


def stats_root(planes: DataFrame) -> str:
    """Folder of the statistics: the common folder of the planes' parameter files."""
    files = planes.select(F.concat(F.regexp_replace("save_path", "/+$", ""), F.lit(f"/{PARAM_FILE}")).alias("path"))
    root = common_root(files.filter("path IS NOT NULL")).first()
    if root is None or root["root"] is None:
        raise ValueError("no plane has a folder for its parameters")
    return root["root"].rstrip("/") or "/"


def _run_key(digests: DataFrame) -> DataFrame:
    """One digest for what all planes together were made with."""
    each = F.xxhash64(F.coalesce("plane", F.lit(-1)), "digest")
    return digests.agg(F.count(F.lit(1)).alias("n"), F.bit_xor(each).alias("x")).select(
        F.lit(None).cast("int").alias("plane"), F.concat_ws(":", "n", "x").alias("digest")
    )


def run_recording(
    spark: SparkSession,
    files: DataFrame,
    recording: Recording,
    params: Mapping[str, str],
    save_path: str,
    save_folder: str | None = None,
    metadata: str | None = None,
    extent: Extent = Extent(),
) -> dict[str, int]:
    """From the files of a recording to all outputs below ``save_path``; how many planes each output was made for.

    ``files`` (plane, path and, if named, a ``metadata`` map) give each plane its
    parameters. A plane's output is made if the manifest has none that was made with the
    same parameters; the outputs of the volume are made if any plane's parameters
    differ or planes came or went. Everything comes into force at once, at the end: a
    run that fails leaves the outputs that were there. ``read_output`` reads them. The
    statistics are written to the common folder of the planes as well.
    """
    recording.check()
    root, run = save_path.rstrip("/"), manifest.new_run()
    resolved = resolved_params(files, params, save_path, save_folder, metadata)
    digests = settle(resolved.select("plane", manifest.digest(F.col("params")).alias("digest")))
    of_volume = [STATS_TABLE, *STATS_OUTPUTS, *VOLUME_OUTPUTS]
    wanted = _each(digests, list(PLANE_OUTPUTS)).unionByName(_each(_run_key(digests), of_volume))
    todo = settle(manifest.pending(wanted, root))
    # one row per output
    counts = {row["output"]: row["n"] for row in todo.groupBy("output").agg(F.count(F.lit(1)).alias("n")).collect()}
    if not counts:
        return {}
    n_planes = digests.count()
    builds: dict[str, Callable[[], DataFrame]] = {}
    # the tables may hold planes that no file names: the manifest never names their rows, so they are not written
    named = recording.only(digests) if n_planes in [counts.get(name) for name in PLANE_OUTPUTS] else None
    for name, build in PLANE_OUTPUTS.items():
        if name in counts:
            own = named if counts[name] == n_planes else recording.only(todo.filter(F.col("output") == name))
            builds[name] = partial(build, own, extent)
    if any(name in counts for name in of_volume):
        # what several outputs read is computed once
        stats = settle(volume.volume_stats(recording.rois, recording.traces, recording.planes))
        builds[STATS_TABLE] = lambda: stats
        builds |= {name: partial(build, stats) for name, build in STATS_OUTPUTS.items()}
        builds |= {name: partial(build, recording, extent) for name, build in VOLUME_OUTPUTS.items()}

    def write(name: str) -> DataFrame:
        return manifest.write_rows(builds[name](), root, name, run, todo.filter(F.col("output") == name))

    # the outputs are independent: their jobs share the cluster
    with ThreadPoolExecutor(SIDE_BY_SIDE) as pool:
        made = list(pool.map(write, [name for name in builds if name in counts]))
    manifest.commit(reduce(DataFrame.unionByName, made), root)
    if STATS_TABLE in counts:
        write_stats(stats, stats_root(recording.planes))
    return counts


def _each(digests: DataFrame, outputs: list[str]) -> DataFrame:
    return digests.select("plane", F.explode(F.array(*[F.lit(name) for name in outputs])).alias("output"), "digest")


def read_output(spark: SparkSession, save_path: str, name: str) -> DataFrame:
    """The rows in force of an output of ``run_recording``."""
    return manifest.read_rows(spark, save_path.rstrip("/"), name, whole=name not in PLANE_OUTPUTS)


def run_plane(
    recording: Recording, plane: int, out: str, overwrite: bool = True, extent: Extent = Extent()
) -> dict[str, str]:
    """The per-plane outputs of one plane."""
    one = Recording(*[table.filter(F.col("plane") == plane) for table in vars(recording).values()])
    one.check()
    return post_process(one, out, overwrite, extent)
