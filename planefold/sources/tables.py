"""Readers of the model's tables."""

from __future__ import annotations

from pathlib import Path

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from planefold import schemas
from planefold.operators.files import within_depth


def _read(spark: SparkSession, source: DataFrame | str | Path, schema: T.StructType) -> DataFrame:
    if isinstance(source, DataFrame):
        return source
    if isinstance(source, (str, Path)):
        name = str(source)
        reader = spark.read.schema(schema)
        return reader.json(name) if name.endswith((".json", ".jsonl")) else reader.parquet(name)
    raise TypeError(f"expected a path or a DataFrame, got {type(source).__name__}")


def load_planes(spark: SparkSession, source: DataFrame | str | Path) -> DataFrame:
    """Plane parameters from parquet or JSON; a DataFrame passes through."""
    return _read(spark, source, schemas.PLANES)


def load_rois(spark: SparkSession, source: DataFrame | str | Path) -> DataFrame:
    """ROI masks with their cell flag."""
    return _read(spark, source, schemas.ROIS)


def load_traces(spark: SparkSession, source: DataFrame | str | Path) -> DataFrame:
    """Cell, neuropil and spike traces, one row per ROI."""
    return _read(spark, source, schemas.TRACES)


def load_images(spark: SparkSession, source: DataFrame | str | Path) -> DataFrame:
    return _read(spark, source, schemas.IMAGES)


def load_movie(spark: SparkSession, source: DataFrame | str | Path) -> DataFrame:
    return _read(spark, source, schemas.MOVIE)


def load_stats(spark: SparkSession, source: DataFrame | str | Path, *columns: str) -> DataFrame:
    """The statistics table, or the named fields of it."""
    stats = _read(spark, source, schemas.VOLUME_STATS)
    return stats.select(*columns) if columns else stats


def discover_files(
    spark: SparkSession, root: str | Path, pattern: str = "*.tif*", max_depth: int | None = None
) -> DataFrame:
    """Files below ``root`` without reading their content, ordered by path.

    ``root`` may be a single file.
    """
    files = (
        spark.read.format("binaryFile")
        .option("recursiveFileLookup", "true")
        .option("pathGlobFilter", pattern)
        .load(str(root))
        .select(F.regexp_replace("path", "^file:/+", "/").alias("path"), "length", "modificationTime")
    )
    if str(root).endswith(tuple(f".{s}" for s in ("tif", "tiff"))):
        return files.orderBy("path")
    return within_depth(files, str(root), max_depth).orderBy("path")
