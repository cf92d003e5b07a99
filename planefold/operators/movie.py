"""Operators over movies in long form, one row per frame and pixel; traces come from blocks of them."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from planefold.constants import PANELS
from planefold.operators import blocks, images
from planefold.operators.masks import listed, ring_rows
from planefold.operators.ordering import running_total
from planefold.operators.rois import PIXEL_KEYS
from planefold.operators.sizing import BROADCAST_BYTES, small_side
from planefold.session import settle

FILE_KEYS = ["plane", "file"]

def file_lengths(movie: DataFrame) -> DataFrame:
    """Frames of each file; height and width too if the movie has pixels."""
    sizes = {"n_frames": "frame", "height": "y", "width": "x"}
    return movie.groupBy(*FILE_KEYS).agg(
        *[(F.max(c) + 1).cast("long").alias(n) for n, c in sizes.items() if c in movie.columns]
    )


def same_size(lengths: DataFrame) -> DataFrame:
    """Pass file lengths through, failing if a plane mixes picture sizes."""
    limits = lengths.groupBy("plane").agg(
        F.min("height").alias("h0"), F.max("height").alias("h1"),
        F.min("width").alias("w0"), F.max("width").alias("w1"),
    )
    fits = (F.col("h0") == F.col("h1")) & (F.col("w0") == F.col("w1"))
    refuse = F.raise_error(F.concat(F.lit("files differ in height or width in plane "), F.col("plane")))
    checked = lengths.join(limits, "plane").withColumn(
        "n_frames", F.when(fits, F.col("n_frames")).otherwise(refuse.cast("long"))
    )
    return checked.select(lengths.columns)


def file_starts(lengths: DataFrame, order: str = "file") -> DataFrame:
    """First global frame of each file: total length of the files before it."""
    return running_total(lengths, ["plane"], [order], "n_frames", "first_frame")


def concat_movies(
    movie: DataFrame,
    order: DataFrame | None = None,
    lengths: DataFrame | None = None,
    check_size: bool = True,
) -> DataFrame:
    """Join a plane's files on the time axis: adds ``global_frame``.

    Files follow each other by name, or by ``order`` (plane, file, position).
    ``lengths`` (plane, file, n_frames) spares a pass over the movie; without it
    a file is as long as its last frame. Files must agree in picture size. A file of
    the movie that ``order`` or ``lengths`` does not name is an error.
    """
    if lengths is None:
        lengths = settle(file_lengths(movie))
        if check_size and {"y", "x"} <= set(movie.columns):
            lengths = same_size(lengths)
    lengths = lengths.select(*FILE_KEYS, "n_frames")
    if order is None:
        starts = file_starts(lengths)
    else:
        starts = file_starts(lengths.join(order.select(*FILE_KEYS, "position"), FILE_KEYS), "position")
    starts = small_side(starts.select(*FILE_KEYS, "first_frame"))
    missing = F.raise_error(F.concat_ws(" ", F.lit("no place for file"), "file", F.lit("of plane"), "plane")).cast("long")
    first = F.coalesce("first_frame", missing)
    return movie.join(starts, FILE_KEYS, "left").select(
        *movie.columns, (first + F.col("frame")).cast("long").alias("global_frame")
    )


def cast_to_first(movie: DataFrame, first: DataFrame) -> DataFrame:
    """Values in the type of the first file."""
    return movie.withColumn("value", F.col("value").cast(first.schema["value"].dataType))


def union_movies(files: list[DataFrame]) -> DataFrame:
    """One movie from per-file tables, values in the type of the first."""
    if not files:
        raise ValueError("`files` must contain at least one element")
    whole = files[0]
    for table in files[1:]:
        whole = whole.unionByName(cast_to_first(table, files[0]))
    return whole


def projections(movie: DataFrame) -> DataFrame:
    """Mean and max image of each plane, one aggregation, as image rows."""
    return images.projections(images.image_state(movie))


def registration_panels(images: DataFrame) -> DataFrame:
    """The registration images of each plane with their panel number (from 1)."""
    panel = F.array_position(F.array(*[F.lit(kind) for kind in PANELS]), F.col("kind"))
    return images.filter(F.col("kind").isin(PANELS)).select(
        "plane", panel.cast("int").alias("panel"), "kind", "y", "x", "value"
    )


def neuropil_ring(
    rois: DataFrame, inner: float, outer: float, planes: DataFrame | None = None
) -> DataFrame:
    """Pixels of ``masks.ring_rows``: ``plane, roi, y, x``."""
    return listed(ring_rows(rois, inner, outer, planes))


def roi_traces(movie: DataFrame, rois: DataFrame, limit: int = BROADCAST_BYTES) -> DataFrame:
    """Trace of each ROI, pixels weighted by ``lam``.

    A ROI none of whose pixels has a value in a frame has no row for it, and so has a
    ROI that the movie does not show at all; ``with_silent`` keeps such ROIs.
    """
    return blocks.extract(blocks.to_blocks(movie), blocks.band_weights(rois), limit).drop("fneu")


def neuropil_traces(
    movie: DataFrame, rois: DataFrame, inner: float, outer: float, planes: DataFrame | None = None, limit: int = BROADCAST_BYTES
) -> DataFrame:
    """Mean over the neuropil ring of each ROI; rows are absent as in ``roi_traces``."""
    weights = blocks.band_weights(rois, (inner, outer), planes, masks=False)
    return blocks.extract(blocks.to_blocks(movie), weights, limit).drop("f")


def extracted_traces(
    movie: DataFrame,
    rois: DataFrame,
    inner: float,
    outer: float,
    planes: DataFrame | None = None,
    limit: int = BROADCAST_BYTES,
) -> DataFrame:
    """Cell and neuropil trace of each ROI in one pass over the movie."""
    return blocks.extract(blocks.to_blocks(movie), blocks.band_weights(rois, (inner, outer), planes), limit)


def with_silent(traces: DataFrame, rois: DataFrame) -> DataFrame:
    """Extracted traces, and one row of NULL for each ROI of ``rois`` that has none."""
    silent = rois.select("plane", "roi").join(traces.select("plane", "roi").distinct(), ["plane", "roi"], "left_anti")
    return traces.unionByName(silent, allowMissingColumns=True)


SHIFTED_KEYS = ["plane", "dy_bin", "dx_bin", "y", "x"]


def shifted(movie: DataFrame, offsets: DataFrame, step: float) -> DataFrame:
    """Movie values with the sub-pixel offset bin of width ``step`` of their frame; frames without offset share the NULL bin."""
    if step <= 0:
        raise ValueError("`step` must be positive")
    binned = offsets.select(
        "plane",
        "frame",
        F.floor(F.col("dy") / F.lit(float(step))).cast("int").alias("dy_bin"),
        F.floor(F.col("dx") / F.lit(float(step))).cast("int").alias("dx_bin"),
    )
    binned = small_side(settle(binned))
    return movie.select(*PIXEL_KEYS, "frame", "value").join(binned, ["plane", "frame"], "left")


def superres_mean(movie: DataFrame, offsets: DataFrame, step: float) -> DataFrame:
    """Mean image per sub-pixel offset bin; states of parts of the movie merge (``images.merge_states``)."""
    return images.mean_image(images.image_state(shifted(movie, offsets, step), SHIFTED_KEYS), SHIFTED_KEYS)
