"""Operators over file lists, parameters and finished work."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from planefold.constants import ARTIFACTS
from planefold.functions import paths
from planefold.functions.params import layered


def with_plane_names(files: DataFrame, path: str = "path") -> DataFrame:
    """Stem and plane name of each file."""
    return files.withColumns({"stem": paths.stem(F.col(path)), "plane_name": paths.plane_name(F.col(path))})


def within_depth(files: DataFrame, root: str, max_depth: int | None) -> DataFrame:
    """Files at most ``max_depth`` path steps below ``root`` (1: directly in it)."""
    if max_depth is None:
        return files
    base = len(root.rstrip("/").split("/"))
    return files.filter(F.size(F.split("path", "/")) - base <= max_depth)


def common_root(files: DataFrame, by: Sequence[str] = (), path: str = "path") -> DataFrame:
    """Longest folder that contains every path, per group.

    All paths between the smallest and the largest share what those two share, so
    one min/max aggregation suffices. A trailing '/' keeps the order by segment.
    """
    folder = F.concat(paths.parent(F.col(path)), F.lit("/"))
    ends = files.groupBy(*by).agg(F.min(folder).alias("low"), F.max(folder).alias("high"))
    low, high = F.split("low", "/"), F.split("high", "/")
    pairs = F.arrays_zip(low.alias("a"), high.alias("b"))
    apart = F.filter(
        F.transform(pairs, lambda p, i: F.when(~p["a"].eqNullSafe(p["b"]), i)), lambda i: i.isNotNull()
    )
    shared = ends.select(*by, low.alias("a"), F.array_min(apart).alias("n"))
    count = F.coalesce(F.col("n"), F.size("a") - 1)
    root = F.array_join(F.slice("a", F.lit(1), count), "/")
    # Absolute paths with nothing else in common share the root folder.
    return shared.select(*by, F.when((root == "") & (F.get("a", F.lit(0)) == ""), F.lit("/")).otherwise(root).alias("root"))


def finished_planes(artifacts: DataFrame) -> DataFrame:
    """Names of planes that have every artifact."""
    have = [F.max(F.col("artifact") == name).alias(name) for name in ARTIFACTS]
    found = artifacts.groupBy("plane_name").agg(*have)
    return found.filter(" AND ".join(ARTIFACTS)).select("plane_name")


def pending_planes(inputs: DataFrame, artifacts: DataFrame) -> DataFrame:
    """Inputs whose plane still lacks an artifact."""
    return inputs.join(finished_planes(artifacts), "plane_name", "left_anti")


def _string_map(values: Mapping[str, str]) -> Column:
    parts = [F.lit(str(part)) for pair in values.items() for part in pair]
    return F.create_map(*parts).cast("map<string,string>")


def resolved_params(
    files: DataFrame,
    base: Mapping[str, str],
    save_root: str,
    save_folder: str | None = None,
    metadata: str | None = None,
) -> DataFrame:
    """Parameters of each file as a map column ``params``.

    ``base`` holds the user's parameters or the defaults, not a mixture. A file's
    ``metadata`` column overrides it, and the path keys override both. The folder
    is ``save_folder`` or the file's stem. Each row gets its own map.
    """
    if save_folder is not None and not isinstance(save_folder, str):
        raise TypeError(f"cannot use {type(save_folder).__name__} as a folder name")
    folder = F.lit(save_folder) if save_folder is not None else paths.stem(F.col("path"))
    own = F.create_map(
        F.lit("tiff_list"), paths.file_name(F.col("path")),
        F.lit("save_path0"), F.lit(save_root),
        F.lit("save_folder"), folder,
    )
    layers = [_string_map(base)] + ([F.col(metadata)] if metadata else []) + [own]
    return files.withColumn("params", layered(*layers))


def param_rows(files: DataFrame, *keys: str) -> DataFrame:
    """One row per file and parameter."""
    return files.select(*keys, F.explode("params").alias("key", "value"))
