"""Finished outputs of a run folder, committed as a whole.

Each run writes its rows of an output to a folder of its own, ``<output>/run=<id>``, whose
files hold ascending planes: as many as the rows need, however many planes there are. The
manifest is a table (plane, output, digest, run) that names, for each plane and
output, the run whose rows count, a digest of the parameters they were made with, and
their schema, so that an output without rows can be read as well. It is written beside and comes into force by one rename, after all data of the run. What a
run leaves before that, when it fails, is never read.

Versions are numbered; the highest counts. Two runs that commit the same number cannot
both succeed: the rename of the second fails, and its rows are merged into the next.
"""

from __future__ import annotations

import json
from uuid import uuid4

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from planefold.operators.sizing import small_side
from planefold.session import settle

ENTRIES = "plane int, output string, digest string, run string, schema string"
FOLDER = "_manifest"
ATTEMPTS = 20


def digest(params: Column) -> Column:
    """Digest of a parameter map, whatever the order of its keys."""
    return F.sha2(F.to_json(F.array_sort(F.map_entries(params))), 256)


def new_run() -> str:
    return uuid4().hex


def _files(spark: SparkSession, path: str):
    jvm = spark._jvm
    place = jvm.org.apache.hadoop.fs.Path(path)
    return place.getFileSystem(spark._jsc.hadoopConfiguration()), place


def _version(spark: SparkSession, root: str) -> int:
    """Highest version in force, 0 if there is none."""
    files, place = _files(spark, f"{root}/{FOLDER}")
    if not files.exists(place):
        return 0
    names = [status.getPath().getName() for status in files.listStatus(place)]
    return max([int(name) for name in names if name.isdigit()], default=0)


def entries(spark: SparkSession, root: str) -> DataFrame:
    """The manifest in force."""
    version = _version(spark, root)
    if not version:
        return spark.createDataFrame([], ENTRIES)
    return spark.read.schema(ENTRIES).parquet(f"{root}/{FOLDER}/{version}")


def pending(wanted: DataFrame, root: str) -> DataFrame:
    """Rows of ``plane, output, digest`` whose output is missing or was made with other parameters."""
    done = entries(wanted.sparkSession, root).select("plane", "output", "digest")
    same = [F.col(f"w.{c}").eqNullSafe(F.col(f"d.{c}")) for c in done.columns]
    return wanted.alias("w").join(done.alias("d"), same, "left_anti")


def write_rows(rows: DataFrame, root: str, output: str, run: str, planes: DataFrame) -> DataFrame:
    """Write a run's rows of an output, sorted by plane; they do not count yet.

    ``planes`` has ``plane, digest`` of what the rows were made for, planes without a row
    too. Returns their manifest entries.
    """
    # small planes share tasks and files, a hot one is split; readers of a plane skip the other row groups
    rows.hint("rebalance", F.col("plane")).sortWithinPartitions("plane").write.parquet(f"{root}/{output}/run={run}")
    return planes.select("plane", F.lit(output).alias("output"), "digest", F.lit(run).alias("run"), F.lit(rows.schema.json()).alias("schema"))


def commit(made: DataFrame, root: str) -> int:
    """Put manifest entries in force in place of those it had for their planes and outputs."""
    spark = made.sparkSession
    made = settle(made)
    own = made.select(F.col("plane").alias("plane_"), F.col("output").alias("output_"))
    same = F.col("plane").eqNullSafe(F.col("plane_")) & F.col("output").eqNullSafe(F.col("output_"))
    for _ in range(ATTEMPTS):
        version = _version(spark, root)
        kept = entries(spark, root).join(small_side(own), same, "left_anti")
        draft = f"{root}/{FOLDER}/.draft-{uuid4().hex}"
        kept.unionByName(made).write.parquet(draft)
        files, source = _files(spark, draft)
        target = _files(spark, f"{root}/{FOLDER}/{version + 1}")[1]
        if not files.exists(target) and files.rename(source, target):
            return version + 1
        files.delete(source, True)
    raise RuntimeError(f"{root}: other runs kept committing first")


def read_rows(spark: SparkSession, root: str, output: str, whole: bool = False) -> DataFrame:
    """The rows of an output that count; only folders that the manifest names are read.

    An output that is ``whole`` has one entry, without a plane, for the rows of all planes.
    """
    current = entries(spark, root).filter(F.col("output") == output)
    # a run is one folder and one schema, however many planes it made
    runs = current.groupBy("run", "schema").count().collect()
    if not runs:
        raise FileNotFoundError(f"{root} has no finished output {output}")
    fields: dict[str, T.StructField] = {}
    for row in runs:
        for field in T.StructType.fromJson(json.loads(row["schema"])).fields:
            fields.setdefault(field.name, field)
    kind = T.StructType([*fields.values(), T.StructField("run", T.StringType())])
    paths = [f"{root}/{output}/run={row['run']}" for row in runs]
    rows = spark.read.option("basePath", f"{root}/{output}").schema(kind).parquet(*paths)
    if whole:
        return rows.select(*fields)
    named = small_side(current.select(F.col("plane").alias("plane_"), F.col("run").alias("run_")))
    same = F.col("plane").eqNullSafe(F.col("plane_")) & (F.col("run") == F.col("run_"))
    return rows.join(named, same, "left_semi").select(*fields)
