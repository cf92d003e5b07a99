"""Images of a movie that later files are merged into.

The state of a pixel is its number of values, their sum and their maximum, for each
sub-pixel bin if frames are shifted. States of parts of a movie add up, so a new file is
read once and the earlier ones never again. A stored state also lists the files it has;
a file that is listed is not counted twice, also if a run was repeated after a failure.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from planefold.operators.rois import PIXEL_KEYS
from planefold.operators.sizing import small_side
from planefold.session import settle
from planefold.sources import manifest

STATE = ["n", "total", "top"]
#: Rows of states that a task merges.
MERGE_ROWS = 1 << 20
OUTPUT, FILES = "image_state", "image_files"


def image_state(movie: DataFrame, by: Sequence[str] = PIXEL_KEYS) -> DataFrame:
    """State of each pixel, one aggregation combined before the shuffle; pixels without a value have none."""
    value = F.col("value").cast("double")
    return movie.groupBy(*by).agg(F.count("value").alias("n"), F.sum(value).alias("total"), F.max(value).alias("top"))


def merge_states(first: DataFrame, *others: DataFrame, by: Sequence[str] = PIXEL_KEYS) -> DataFrame:
    """State of several parts together.

    The parts are written first, so that a task holds the groups of the merge alone and not
    those of all parts as well, and dealt to as many tasks as their rows need.
    """
    parts = [settle(part.select(*by, *STATE)) for part in (first, *others)]
    whole = reduce(DataFrame.unionByName, parts)
    whole = whole.repartition(whole.count() // MERGE_ROWS + 1, *by)
    return whole.groupBy(*by).agg(F.sum("n").alias("n"), F.sum("total").alias("total"), F.max("top").alias("top"))


def mean_image(state: DataFrame, by: Sequence[str] = PIXEL_KEYS) -> DataFrame:
    """Mean of each pixel as ``value``; NULL without a value."""
    return state.select(*by, F.when(F.col("n") > 0, F.col("total") / F.col("n")).alias("value"))


def projections(state: DataFrame) -> DataFrame:
    """Mean and max image of each plane as image rows."""
    both = mean_image(state, [*PIXEL_KEYS, "top"]).withColumnRenamed("value", "mean")
    rows = F.inline(
        F.array(
            F.struct(F.lit("max_proj").alias("kind"), F.col("top").alias("value")),
            F.struct(F.lit("meanImg").alias("kind"), F.col("mean").alias("value")),
        )
    )
    return both.select(*PIXEL_KEYS, rows).select("plane", "kind", "y", "x", "value")


def add_files(movie: DataFrame, root: str) -> int:
    """Merge the files of ``movie`` that the state at ``root`` has not got; the number of files added.

    Only planes with new files are written again, and both tables, states and files,
    come into force together.
    """
    spark, run = movie.sparkSession, manifest.new_run()
    try:
        known = manifest.read_rows(spark, root, FILES)
        state = manifest.read_rows(spark, root, OUTPUT)
    except FileNotFoundError:
        known = state = None
    listed = movie.select("plane", "file").distinct()
    same = [F.col(f"new.{c}").eqNullSafe(F.col(f"old.{c}")) for c in ("plane", "file")]
    fresh = settle(listed if known is None else listed.alias("new").join(known.alias("old"), same, "left_anti"))
    added = fresh.count()
    if not added:
        return 0
    new = image_state(movie.alias("new").join(small_side(fresh).alias("old"), same, "left_semi"))
    files = fresh
    if known is not None:
        touched = small_side(fresh.select("plane").distinct())
        new = merge_states(new, state.join(touched, "plane", "left_semi"))
        files = fresh.unionByName(known.join(touched, "plane", "left_semi").select("plane", "file"))
    planes = fresh.select("plane", F.lit("").alias("digest")).distinct()
    made = [manifest.write_rows(rows, root, output, run, planes) for rows, output in ((new, OUTPUT), (files, FILES))]
    manifest.commit(made[0].unionByName(made[1]), root)
    return added


def stored_state(spark: SparkSession, root: str) -> DataFrame:
    """The state at ``root``."""
    return manifest.read_rows(spark, root, OUTPUT)
