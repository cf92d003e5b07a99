"""One query per operator, over whole test tables."""

from __future__ import annotations

from collections.abc import Callable
from uuid import uuid4

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from planefold.functions import params
from planefold.functions.arrays import NAN
from planefold.operators import chunks, files, images, movie, rois, traces, volume
from planefold.plans import volume as volume_job
from planefold.session import settle, shared_folder
from planefold.sources.sinks import load_by_plane_name, write_bucketed, write_by_key, write_by_plane_name, write_stats
from planefold.sources.tables import load_movie, load_planes, load_rois, load_stats
from workload import tables

Query = Callable[[SparkSession, str], DataFrame]

STRIDE_TARGET = 10
CHUNK = 16
FRAMES = (8, 56)
FIRST_ROI = 5
TOP_K = 10
NEUROPIL_COEFFICIENT = 0.7
BASE_PARAMS = {"tau": "1.3", "fs": "10", "nchannels": "1", "save_folder": "unset"}


def r6(column: Column | str, name: str | None = None) -> Column:
    """Six digits for comparison; adding zero turns -0.0 into 0.0."""
    column = F.col(column) if isinstance(column, str) else column
    rounded = F.rint(column.cast("double") * 1e6) / 1e6 + F.lit(0.0)
    return rounded.alias(name) if name else rounded


def _fresh_folder(spark: SparkSession) -> str:
    return f"{shared_folder(spark).rstrip('/')}/written-{uuid4().hex}"


def _stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    return volume.volume_stats(
        tables.trace_flags(spark, sf_dir), tables.traces(spark, sf_dir), tables.planes(spark, sf_dir)
    )


def _rounded_stats(stats: DataFrame) -> DataFrame:
    return stats.select(
        *[r6(f.name, f.name) if f.dataType.typeName() == "double" else F.col(f.name) for f in stats.schema]
    )


def volume_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _rounded_stats(_stats(spark, sf_dir))


def volume_stats_cells_only(spark: SparkSession, sf_dir: str) -> DataFrame:
    signal = volume.volume_signal(tables.traces(spark, sf_dir), tables.trace_flags(spark, sf_dir))
    return signal.select("plane", r6("mean_trace", "mean_trace"), r6("std_trace", "std_trace"))


def volume_stats_accepted(spark: SparkSession, sf_dir: str) -> DataFrame:
    flags = tables.trace_flags_without_cells(spark, sf_dir)
    stats = volume.volume_stats(flags, tables.traces(spark, sf_dir), tables.planes(spark, sf_dir), cells_only=True)
    signal = [F.nanvl(F.col(c), F.lit(-1.0)) for c in ("mean_trace", "std_trace")]
    return stats.select("plane", "accepted", "rejected", r6(signal[0], "mean_trace"), r6(signal[1], "std_trace"), "filepath")


def volume_stats_saved(spark: SparkSession, sf_dir: str) -> DataFrame:
    saved = write_stats(_stats(spark, sf_dir), _fresh_folder(spark))
    return _rounded_stats(load_stats(spark, saved))


def accepted_rejected_bars(spark: SparkSession, sf_dir: str) -> DataFrame:
    return volume.count_bars(volume.cell_counts(tables.trace_flags(spark, sf_dir)))


def execution_time_stack(spark: SparkSession, sf_dir: str) -> DataFrame:
    stack = volume.time_stack(volume.flat_timing(tables.planes(spark, sf_dir)))
    return stack.select(
        "plane", "step", r6("bottom", "bottom"), r6("top", "top"), "label", r6("label_y", "label_y")
    )


def volume_signal(spark: SparkSession, sf_dir: str) -> DataFrame:
    bounds = volume.signal_bounds(volume.volume_signal(tables.traces(spark, sf_dir)))
    return bounds.select("plane", *[r6(c, c) for c in bounds.columns[1:]])


def trace_shape(spark: SparkSession, sf_dir: str) -> DataFrame:
    return traces.trace_shape(tables.traces(spark, sf_dir))


def trace_window(spark: SparkSession, sf_dir: str) -> DataFrame:
    window = traces.trace_window(tables.traces(spark, sf_dir), (FIRST_ROI, None), FRAMES)
    return traces.windowed_long(window).select("plane", "roi", "frame", r6("f", "f"))


def trace_zscore(spark: SparkSession, sf_dir: str) -> DataFrame:
    z = traces.zscored_long(traces.trace_window(tables.traces(spark, sf_dir), None, None))
    return z.select("plane", "roi", "frame", r6("z", "z"))


def activity_rank(spark: SparkSession, sf_dir: str) -> DataFrame:
    ranked = traces.activity_rank(tables.traces(spark, sf_dir), None, None)
    return ranked.select("plane", "roi", r6("activity", "activity"), "rank")


def activity_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    top = traces.activity_top_k(tables.traces(spark, sf_dir), TOP_K, None, None)
    return top.select("plane", "roi", r6("activity", "activity"), "rank")


def trace_heatmap(spark: SparkSession, sf_dir: str) -> DataFrame:
    heat = traces.trace_heatmap_long(tables.traces(spark, sf_dir))
    return heat.select("plane", "row", "roi", "frame", r6("z", "z"))


def trace_heatmap_window(spark: SparkSession, sf_dir: str) -> DataFrame:
    heat = traces.trace_heatmap_long(tables.traces(spark, sf_dir), (FIRST_ROI, 10**9), FRAMES)
    return heat.select("plane", "row", "roi", "frame", r6("z", "z"))


def activity_top_many(spark: SparkSession, sf_dir: str) -> DataFrame:
    top = traces.activity_top_k(tables.traces(spark, sf_dir), 2 * 10**3, (FIRST_ROI, None), FRAMES)
    return top.select("plane", "roi", r6("activity", "activity"), "rank")


def trace_grid_layout(spark: SparkSession, sf_dir: str) -> DataFrame:
    return traces.grid_layout(tables.traces(spark, sf_dir))


def trace_sample(spark: SparkSession, sf_dir: str) -> DataFrame:
    return traces.trace_sample(tables.traces(spark, sf_dir), seed=42)


def trace_sample_all(spark: SparkSession, sf_dir: str) -> DataFrame:
    """More ROIs wanted than there are: all of them."""
    return traces.trace_sample(tables.traces(spark, sf_dir), n=10**6, seed=42)


def trace_stride_frames(spark: SparkSession, sf_dir: str) -> DataFrame:
    points = traces.trace_stride(tables.traces(spark, sf_dir), nframes=40, target=STRIDE_TARGET)
    return points.select("plane", "roi", "timepoint", r6("f", "f"))


def display_labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    labels = traces.trace_labels(tables.traces(spark, sf_dir), target=None)
    caption = traces.interval_caption((FIRST_ROI, None), FRAMES)
    return labels.select("plane", "roi", "axis_label", "low_label", "high_label", caption.alias("caption"))


def trace_stride(spark: SparkSession, sf_dir: str) -> DataFrame:
    points = traces.trace_stride(tables.traces(spark, sf_dir), target=STRIDE_TARGET)
    return points.select("plane", "roi", "timepoint", r6("f", "f"))


def trace_display(spark: SparkSession, sf_dir: str) -> DataFrame:
    shown = traces.trace_display(tables.traces(spark, sf_dir), target=STRIDE_TARGET)
    return shown.select(
        "plane", "roi", "timepoint", *[r6(c, c) for c in ("fmin", "fmax", "f", "fneu", "spk_scaled")]
    )


def aligned_traces(spark: SparkSession, sf_dir: str) -> DataFrame:
    all_ = tables.traces(spark, sf_dir)
    sides = [all_.select("plane", "roi", F.col(c).alias("values")) for c in ("f", "fneu", "spks")]
    long = traces.align_traces(*sides).select(
        "plane", "roi", F.posexplode(F.arrays_zip("f", "fneu", "spks")).alias("frame", "v")
    )
    return long.select("plane", "roi", "frame", *[r6(F.col(f"v.{c}"), c) for c in ("f", "fneu", "spks")])


def _bucketed(df: DataFrame, folder: str, name: str) -> DataFrame:
    return write_bucketed(df, f"{name}_{uuid4().hex}", f"{folder}/{name}", 8)


def bucketed_features(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The features of traces and masks from tables that share their buckets."""
    folder = _fresh_folder(spark)
    sides = [_bucketed(tables.traces(spark, sf_dir), folder, "traces"), _bucketed(tables.some_masks(spark, sf_dir), folder, "masks")]
    return _features(rois.roi_features(*sides))


def collect_traces(spark: SparkSession, sf_dir: str) -> DataFrame:
    all_ = tables.traces(spark, sf_dir)
    path = F.concat(F.lit("/volume/"), 9 - F.col("plane"))
    sources = all_.select("plane").distinct().withColumn("path", path)
    whole = traces.collect_traces(all_, sources)
    return whole.select("plane", "roi", F.posexplode("f").alias("frame", "f")).select("plane", "roi", "frame", r6("f", "f"))


def neuropil_corrected(spark: SparkSession, sf_dir: str) -> DataFrame:
    corrected = traces.neuropil_corrected(tables.traces(spark, sf_dir), NEUROPIL_COEFFICIENT)
    return traces.exploded(corrected).select("plane", "roi", F.col("pos").alias("frame"), r6("f", "f"))


def roi_features(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _features(rois.roi_features(tables.traces(spark, sf_dir), tables.some_masks(spark, sf_dir)))


def _features(features: DataFrame) -> DataFrame:
    return features.select(
        "plane", "roi", *[r6(c, c) for c in ("skewness", "variance", "corr")], "area", r6("aspect", "aspect")
    )


def chunked_features(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The features from chunks of 16 frames."""
    parts = chunks.to_chunks(tables.traces(spark, sf_dir), CHUNK, ["f", "fneu"])
    return _features(rois.beside_shape(chunks.signal_features(parts), tables.some_masks(spark, sf_dir)))


def chunked_zscore(spark: SparkSession, sf_dir: str) -> DataFrame:
    z = chunks.zscored(chunks.to_chunks(tables.traces(spark, sf_dir), CHUNK))
    long = z.select("plane", "roi", "chunk", F.posexplode("z").alias("pos", "z"))
    return long.select("plane", "roi", (F.col("chunk") * CHUNK + F.col("pos")).cast("int").alias("frame"), r6("z", "z"))


def chunked_activity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Activity ranks from chunks of 16 frames."""
    active = chunks.roi_activity(chunks.to_chunks(tables.traces(spark, sf_dir), CHUNK))
    return traces.ranked(active).select("plane", "roi", r6("activity", "activity"), "rank")


def chunked_signal(spark: SparkSession, sf_dir: str) -> DataFrame:
    bounds = volume.signal_bounds(chunks.volume_signal(chunks.to_chunks(tables.traces(spark, sf_dir), CHUNK)))
    return bounds.select("plane", *[r6(c, c) for c in bounds.columns[1:]])


def movie_activity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """From the movie to the activity ranks of the extracted traces, in long form throughout."""
    extracted = settle(movie.roi_traces(tables.movie(spark, sf_dir), tables.rois(spark, sf_dir)))
    ranked = traces.ranked(traces.long_activity(extracted))
    # ties to the last digit are told apart by ROI, so ranks of equal activities may differ from those of another sum
    return ranked.select("plane", "roi", r6(F.nanvl(F.col("activity"), F.lit(-1.0)), "activity"))


def _rois(spark: SparkSession, sf_dir: str) -> DataFrame:
    flags = tables.raw_flags(spark, sf_dir)
    raw = F.col("iscell_raw")
    flags = flags.select("plane", "roi", volume.cell_flag(raw).alias("iscell"), volume.cell_class(raw).alias("class_"))
    return rois.with_flags(tables.rois(spark, sf_dir), flags)


def cell_split(spark: SparkSession, sf_dir: str) -> DataFrame:
    all_ = _rois(spark, sf_dir)
    sides = [rois.cells(all_).withColumn("kind", F.lit("cell")), rois.non_cells(all_).withColumn("kind", F.lit("non_cell"))]
    return sides[0].unionByName(sides[1]).select("plane", "roi", "kind", F.size("pixels").alias("n_pixels"))


def roi_label_map(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rois.label_map(_rois(spark, sf_dir))


def roi_paint_map(spark: SparkSession, sf_dir: str) -> DataFrame:
    painted = rois.paint_map(_rois(spark, sf_dir))
    return painted.select("plane", "iscell", "y", "x", *[r6(c, c) for c in "rgb"])


def roi_raster(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rois.label_map(_rois(spark, sf_dir), tables.pictures(spark, sf_dir))


def roi_paint_raster(spark: SparkSession, sf_dir: str) -> DataFrame:
    painted = rois.paint_map(_rois(spark, sf_dir), tables.pictures(spark, sf_dir))
    return painted.select("plane", "iscell", "y", "x", *[r6(c, c) for c in "rgb"])


def roi_raster_nan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The dense map with NaN for absent labels, counted and summed by plane."""
    dense = rois.as_nan(roi_raster(spark, sf_dir), "label_all", "label_cell")
    present = {c: F.when(~F.isnan(c), F.col(c)) for c in ("label_all", "label_cell")}
    return dense.groupBy("plane").agg(
        F.count_if(F.isnan("label_all")).alias("absent"),
        F.count_if(F.isnan("label_cell")).alias("no_cell"),
        F.sum(present["label_all"]).alias("labels"),
        F.max(present["label_cell"]).alias("last_cell"),
    )


def roi_weights(spark: SparkSession, sf_dir: str) -> DataFrame:
    weighted = rois.weighted_pixels(_rois(spark, sf_dir))
    return weighted.select("plane", "roi", "iscell", "pos", "y", "x", r6("weight", "weight"))


def plane_name(spark: SparkSession, sf_dir: str) -> DataFrame:
    return files.with_plane_names(tables.plane_files(spark, sf_dir)).select("page_id", "path", "stem", "plane_name")


def files_by_plane_name(spark: SparkSession, sf_dir: str) -> DataFrame:
    listed = tables.plane_files(spark, sf_dir).select("page_id", "path")
    laid_out = write_by_plane_name(listed, _fresh_folder(spark))
    return load_by_plane_name(spark, laid_out, "page_id long, path string").select("page_id", "plane_name")


def planes_kept_or_replaced(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two runs over text keys: the second adds what is missing and keeps the rest."""
    listed = files.with_plane_names(tables.plane_files(spark, sf_dir)).select("page_id", "host", "plane_name")
    path = _fresh_folder(spark)
    write_by_key(listed.filter("page_id % 3 = 0").withColumn("run", F.lit(1)), path, ["host"])
    write_by_key(listed.withColumn("run", F.lit(2)), path, ["host"], overwrite=False)
    return spark.read.schema("page_id long, plane_name string, run int, host string").parquet(path)


def common_root(spark: SparkSession, sf_dir: str) -> DataFrame:
    return files.common_root(tables.plane_files(spark, sf_dir), ["host"])


def pending_planes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return files.pending_planes(tables.inputs(spark, sf_dir), tables.artifacts(spark, sf_dir))


def param_resolution(spark: SparkSession, sf_dir: str) -> DataFrame:
    measured = F.create_map(
        F.lit("fs"), (F.col("page_id") % 30).cast("string"), F.lit("bytes"), F.col("n_bytes").cast("string")
    )
    listed = tables.plane_files(spark, sf_dir).withColumn("metadata", measured)
    resolved = files.resolved_params(listed, BASE_PARAMS, "/results", metadata="metadata")
    return files.param_rows(resolved, "page_id")


def param_lookup(spark: SparkSession, sf_dir: str) -> DataFrame:
    bytes_ = F.create_map(F.lit("bytes"), F.col("n_bytes").cast("string"), F.lit("tau"), (F.col("page_id") % 9 / 10).cast("string"))
    known = F.when(F.col("page_id") % 3 == 0, bytes_).otherwise(F.create_map().cast("map<string,string>"))
    listed = tables.plane_files(spark, sf_dir).withColumn("metadata", known)
    resolved = files.resolved_params(listed, BASE_PARAMS, "/results", "all", metadata="metadata")
    found = F.col("params")
    return resolved.select(
        "page_id",
        params.required(found, "tau").cast("double").alias("tau"),
        params.required(found, "save_folder").alias("save_folder"),
        params.optional(found, "bytes").alias("bytes"),
    )


def planned_inputs(spark: SparkSession, sf_dir: str) -> DataFrame:
    plan = volume_job.planned_inputs(tables.plane_files(spark, sf_dir), tables.artifacts(spark, sf_dir), BASE_PARAMS, "/results")
    return plan.select("page_id", "plane_name", F.col("params")["save_folder"].alias("save_folder"))


def _recording(spark: SparkSession, sf_dir: str) -> volume_job.Recording:
    return volume_job.Recording(
        tables.planes(spark, sf_dir),
        tables.trace_masks(spark, sf_dir).join(tables.trace_flags(spark, sf_dir), ["plane", "roi"]),
        tables.traces(spark, sf_dir),
        tables.written_images(spark, sf_dir),
    )


def _job_folder(spark: SparkSession, sf_dir: str) -> str:
    """The whole volume job over derived tables, twice with a change between; where its outputs are.

    In the second run plane 1 has other parameters and is the only one made again.
    """
    folder = _fresh_folder(spark)
    recording = _recording(spark, sf_dir)
    planes = recording.planes.withColumn("save_path", F.regexp_replace("save_path", "^/volume", f"{folder}/volume"))
    recording = volume_job.Recording(settle(planes), recording.rois, recording.traces, recording.images).spread()
    listed = recording.planes.select("plane", F.concat(F.lit(f"{folder}/plane_"), "plane", F.lit(".tif")).alias("path"))
    listed = listed.withColumn("metadata", F.create_map().cast("map<string,string>"))
    changed = F.when(F.col("plane") == 1, F.create_map(F.lit("tau"), F.lit("0.7"))).otherwise(F.col("metadata"))
    for files_ in (listed, listed.withColumn("metadata", changed)):
        volume_job.run_recording(spark, files_, recording, BASE_PARAMS, f"{folder}/results", metadata="metadata")
    return f"{folder}/results"


def job_bars(spark: SparkSession, sf_dir: str) -> DataFrame:
    return volume_job.read_output(spark, _job_folder(spark, sf_dir), "acc_rej_bar")


def job_outputs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All outputs of the job: rows and sums of each, by plane where it has planes of its own."""
    folder = _job_folder(spark, sf_dir)
    sums = {
        "registration": F.col("value") * F.col("panel"),
        "max_projection": F.col("value"),
        "segmentation": F.col("label_all") * 3 + F.coalesce("label_cell", F.lit(0)) * (F.col("y") + 1) + F.coalesce("label_noncell", F.lit(0)) * (F.col("x") + 1),
        "traces": F.col("spk_scaled") + F.col("f") * F.col("timepoint") - F.col("fneu") + F.col("fmax") * F.col("roi"),
        "volume_stats": F.col("accepted") - F.col("rejected") + F.col("mean_trace") + F.col("std_trace") + F.col("total_plane_runtime"),
        "acc_rej_bar": F.coalesce("accepted_mid", F.lit(0)) - F.coalesce("rejected_mid", F.lit(0)) + F.col("rejected_bottom"),
        "mean_volume_signal": F.col("lower") + 2 * F.col("upper"),
        "execution_time": F.col("top") - F.col("bottom") / 3,
        "max_cell_noncell": (F.col("r") + 2 * F.col("g") + 3 * F.col("b")) * F.when(F.col("iscell"), 1).otherwise(5),
        "fluorescence": F.aggregate("z", F.lit(0.0), lambda sum_, z: sum_ + F.abs(z)) * (F.col("row") + 1),
        "fluorescence_grid": F.col("row") * 10 + F.col("col"),
    }
    lines = []
    for name, value in sums.items():
        rows = volume_job.read_output(spark, folder, name)
        lines.append(rows.select("plane", F.lit(name).alias("output"), value.cast("double").alias("v")))
    whole = lines[0]
    for more in lines[1:]:
        whole = whole.unionByName(more)
    return whole.groupBy("output", "plane").agg(F.count("v").alias("n"), F.round(F.sum("v"), 3).alias("total"))


def images_merged(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Half of the movie stored as a state, the rest merged into it, and both once more, which changes nothing."""
    folder = _fresh_folder(spark)
    halves = [h.withColumn("file", F.lit(name)) for h, name in zip(tables.movie_halves(spark, sf_dir), "ab")]
    for half in (*halves, *halves):
        images.add_files(half, folder)
    return images.projections(images.stored_state(spark, folder)).select("plane", "kind", "y", "x", r6("value", "value"))


def superres_merged(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Super-resolution means from the states of two halves."""
    keys, offsets = movie.SHIFTED_KEYS, tables.offsets(spark, sf_dir)
    states = [images.image_state(movie.shifted(half, offsets, 0.5), keys) for half in tables.movie_halves(spark, sf_dir)]
    merged = images.mean_image(images.merge_states(*states, by=keys), keys)
    return merged.select(*keys, r6("value", "value"))


def tables_reread(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Planes, masks and movie written and read with their readers, one line per plane and table."""
    folder = _fresh_folder(spark)
    planes = tables.planes(spark, sf_dir).withColumns({"plane_name": F.concat(F.lit("plane_"), "plane"), "params": F.create_map(F.lit("tau"), F.lit("1.3"))})
    planes.write.json(f"{folder}/planes.json")
    tables.trace_masks(spark, sf_dir).join(tables.trace_flags(spark, sf_dir), ["plane", "roi"]).write.parquet(f"{folder}/rois")
    tables.movie(spark, sf_dir).withColumn("file", F.lit("movie")).write.parquet(f"{folder}/movie")
    total = F.aggregate("pixels", F.lit(0.0), lambda s, p: s + p["lam"].cast("double"))
    sides = [
        load_planes(spark, f"{folder}/planes.json").select("plane", F.lit("planes").alias("of"), F.col("timing.total_plane_runtime").alias("v")),
        load_rois(spark, f"{folder}/rois").select("plane", F.lit("rois").alias("of"), F.when(F.col("iscell"), total).otherwise(-total).alias("v")),
        load_movie(spark, f"{folder}/movie").select("plane", F.lit("movie").alias("of"), (F.col("value") + F.col("frame") * F.col("x")).alias("v")),
    ]
    whole = sides[0].unionByName(sides[1]).unionByName(sides[2])
    return whole.groupBy("plane", "of").agg(F.count("v").alias("n"), F.round(F.sum("v"), 3).alias("total"))


def movie_union(spark: SparkSession, sf_dir: str) -> DataFrame:
    whole = movie.union_movies(tables.movie_halves(spark, sf_dir))
    return whole.groupBy("plane", "frame").agg(F.count("value").alias("n"), F.sum("value").alias("total"))


def movie_signal(spark: SparkSession, sf_dir: str) -> DataFrame:
    """From the movie to the statistics of each plane's extracted traces."""
    extracted = movie.roi_traces(tables.movie(spark, sf_dir), tables.rois(spark, sf_dir))
    signal = volume.long_signal(extracted)
    return signal.select("plane", r6("mean_trace", "mean_trace"), r6("std_trace", "std_trace"))


def movie_concat(spark: SparkSession, sf_dir: str) -> DataFrame:
    joined = movie.concat_movies(tables.movie_frames(spark, sf_dir))
    return joined.select("file", "o_orderkey", "frame", "global_frame")


def movie_shape(spark: SparkSession, sf_dir: str) -> DataFrame:
    frames = tables.movie(spark, sf_dir).withColumn("file", F.lit("movie"))
    return movie.file_lengths(frames)


def registration_images(spark: SparkSession, sf_dir: str) -> DataFrame:
    made = movie.projections(tables.movie(spark, sf_dir))
    panels = movie.registration_panels(made.unionByName(tables.given_images(spark, sf_dir)))
    return panels.select("plane", "panel", "kind", "y", "x", r6("value", "value"))


def roi_trace_extract(spark: SparkSession, sf_dir: str) -> DataFrame:
    extracted = movie.roi_traces(tables.movie(spark, sf_dir), tables.rois(spark, sf_dir))
    return extracted.select("plane", "roi", "frame", r6("f", "f"))


def _neuropil(operator: Callable, spark: SparkSession, sf_dir: str) -> DataFrame:
    return operator(
        tables.movie(spark, sf_dir), tables.rois(spark, sf_dir), *tables.RING, tables.pictures(spark, sf_dir)
    )


def neuropil_trace(spark: SparkSession, sf_dir: str) -> DataFrame:
    around = _neuropil(movie.neuropil_traces, spark, sf_dir)
    return around.select("plane", "roi", "frame", r6("fneu", "fneu"))


def extracted_traces(spark: SparkSession, sf_dir: str) -> DataFrame:
    both = _neuropil(movie.extracted_traces, spark, sf_dir)
    return both.select("plane", "roi", "frame", r6("f", "f"), r6("fneu", "fneu"))


def extracted_traces_shuffled(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same with the broadcast forbidden."""
    both = movie.extracted_traces(
        tables.movie(spark, sf_dir), tables.rois(spark, sf_dir), *tables.RING, tables.pictures(spark, sf_dir), limit=0
    )
    return both.select("plane", "roi", "frame", r6("f", "f"), r6("fneu", "fneu"))


def superres_mean(spark: SparkSession, sf_dir: str) -> DataFrame:
    binned = movie.superres_mean(tables.movie(spark, sf_dir), tables.offsets(spark, sf_dir), 0.5)
    return binned.select("plane", "dy_bin", "dx_bin", "y", "x", r6("value", "value"))


QUERIES: dict[str, Query] = {
    query.__name__: query
    for query in [
        volume_stats,
        volume_stats_cells_only,
        volume_stats_saved,
        volume_stats_accepted,
        accepted_rejected_bars,
        execution_time_stack,
        volume_signal,
        trace_shape,
        trace_window,
        trace_zscore,
        activity_rank,
        activity_top_k,
        activity_top_many,
        trace_heatmap,
        trace_heatmap_window,
        trace_grid_layout,
        trace_sample,
        trace_sample_all,
        trace_stride,
        trace_stride_frames,
        trace_display,
        display_labels,
        aligned_traces,
        collect_traces,
        neuropil_corrected,
        roi_features,
        bucketed_features,
        chunked_features,
        chunked_zscore,
        chunked_activity,
        chunked_signal,
        movie_activity,
        cell_split,
        roi_label_map,
        roi_paint_map,
        roi_raster,
        roi_paint_raster,
        roi_raster_nan,
        roi_weights,
        plane_name,
        files_by_plane_name,
        planes_kept_or_replaced,
        common_root,
        pending_planes,
        param_resolution,
        param_lookup,
        planned_inputs,
        job_bars,
        job_outputs,
        images_merged,
        superres_merged,
        tables_reread,
        movie_concat,
        movie_union,
        movie_shape,
        registration_images,
        roi_trace_extract,
        neuropil_trace,
        extracted_traces,
        extracted_traces_shuffled,
        superres_mean,
        movie_signal,
    ]
}
