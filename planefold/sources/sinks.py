"""Writers that keep finished work."""

from __future__ import annotations

from collections.abc import Sequence
from pathlib import Path

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.utils import AnalysisException

from planefold.constants import STATS_TABLE
from planefold.operators.files import with_plane_names
from planefold.operators.sizing import small_side
from planefold.session import settle

#: Folders that a task makes where there are many, and rows of a folder that a task writes then.
FOLDERS, FOLDER_ROWS = 100, 1 << 20


def write_table(table: DataFrame, path: str | Path, overwrite: bool = True) -> str:
    """Write ``table``; an existing one is replaced or, without ``overwrite``, kept."""
    table.write.mode("overwrite" if overwrite else "ignore").parquet(str(path))
    return str(path)


def write_stats(stats: DataFrame, root: str | Path, overwrite: bool = True) -> str:
    """Write the statistics table below ``root`` and return its path."""
    return write_table(stats, f"{str(root).rstrip('/')}/{STATS_TABLE}", overwrite)


def _exists(spark: SparkSession, path: str) -> bool:
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    return place.getFileSystem(spark._jsc.hadoopConfiguration()).exists(place)


def without_written(table: DataFrame, path: str | Path, keys: Sequence[str] = ("plane",)) -> DataFrame:
    """Rows of ``table`` whose key has no folder at ``path`` yet.

    Folder names are read with the types of the table's own keys. NULL and the empty
    string share Spark's default folder, so they count as one key.
    """
    kinds = T.StructType([table.schema[key] for key in keys])
    try:
        done = table.sparkSession.read.schema(kinds).parquet(str(path)).select(*keys).distinct()
    except AnalysisException as error:
        if error.getCondition() in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
            return table
        raise
    done = done.select(*[F.col(key).alias(f"_done_{key}") for key in keys])

    def folder(key: str) -> Column:
        return F.nullif(F.col(key), F.lit("")) if isinstance(table.schema[key].dataType, T.StringType) else F.col(key)

    return table.join(done, [folder(key).eqNullSafe(F.col(f"_done_{key}")) for key in keys], "left_anti")


def _spread(table: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows placed for one folder per key.

    One task per key would stall on a hot key, all keys in every task would scatter small
    files: rebalancing merges small keys and splits large ones, by bytes alone. Where keys
    are many a task would make its folders one after the other, however little is in
    them, so then each task gets about ``FOLDERS`` keys, or a piece of a key with more than
    ``FOLDER_ROWS`` rows.
    """
    columns = [F.col(key) for key in keys]
    sizes = settle(table.groupBy(*columns).agg(F.count(F.lit(1)).alias("_rows")))
    pieces = F.ceil(F.col("_rows") / FOLDER_ROWS)
    total = sizes.agg(F.count(F.lit(1)).alias("keys"), F.coalesce(F.sum(pieces - 1), F.lit(0)).alias("more")).first()
    if total["keys"] <= FOLDERS:
        return table.hint("rebalance", *columns)
    hot = sizes.filter(pieces > 1).select(*[F.col(key).alias(f"_hot_{key}") for key in keys], pieces.alias("_pieces"))
    same = [F.col(key).eqNullSafe(F.col(f"_hot_{key}")) for key in keys]
    # rows of a hot key are told apart by what is in them; maps have no hash, so they stay with their like
    hashed = [F.col(f.name) for f in table.schema.fields if "map<" not in f.dataType.simpleString()]
    salt = F.coalesce(F.pmod(F.xxhash64(*hashed), F.col("_pieces")), F.lit(0))
    placed = table.join(small_side(hot), same, "left").withColumn("_salt", salt)
    return placed.repartition(total["keys"] // FOLDERS + 1 + total["more"], *columns, "_salt").select(table.columns)


def write_by_key(
    table: DataFrame, path: str | Path, keys: Sequence[str] = ("plane",), overwrite: bool = True
) -> str:
    """Write one folder per key; other keys' folders stay.

    Without ``overwrite`` rows of keys that already have a folder are dropped.
    """
    if not overwrite:
        table = without_written(table, path, keys)
    writer = _spread(table, keys).write
    if _exists(table.sparkSession, str(path)):
        # replaces the folders that have new rows, each by a rename on the driver
        writer = writer.option("partitionOverwriteMode", "dynamic").mode("overwrite")
    writer.partitionBy(*keys).parquet(str(path))
    return str(path)


def write_bucketed(
    table: DataFrame, name: str, path: str | Path, buckets: int, keys: Sequence[str] = ("plane", "roi"), overwrite: bool = True
) -> DataFrame:
    """Write ``table`` in buckets by ``keys``, sorted inside, and read it from the catalog.

    Tables with the same keys and number of buckets join by them without a shuffle; a hot
    plane is spread by its ROIs. Of a full outer join Spark forgets the buckets: its
    result is shuffled if it is joined again. An existing table of that name is replaced or, without
    ``overwrite``, kept. Rows come to their bucket by one shuffle, so each bucket is one
    file. Choose ``buckets`` such that a bucket fits a task, and alike for all tables.
    """
    if buckets < 1:
        raise ValueError("a table needs at least one bucket")
    placed = table.repartition(buckets, *[F.col(key) for key in keys])
    writer = placed.write.mode("overwrite" if overwrite else "ignore").bucketBy(buckets, *keys).sortBy(*keys)
    writer.option("path", str(path)).saveAsTable(name, format="parquet")
    return table.sparkSession.table(name)


def write_by_plane_name(files: DataFrame, path: str | Path, column: str = "path") -> str:
    """Lay a file list out in one folder per derived plane name.

    Files without a plane name share Spark's default partition folder;
    ``load_by_plane_name`` gives them their empty name again.
    """
    return write_by_key(with_plane_names(files, column).drop("stem"), path, ["plane_name"])


def load_by_plane_name(spark: SparkSession, path: str | Path, schema: str) -> DataFrame:
    """Files laid out by plane name; ``schema`` has their other columns."""
    laid_out = spark.read.schema(f"{schema}, plane_name string").parquet(str(path))
    return laid_out.withColumn("plane_name", F.coalesce("plane_name", F.lit("")))
