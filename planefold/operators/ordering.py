"""Positions and running totals inside groups of any size.

A plain ``row_number() OVER (PARTITION BY g ORDER BY k)`` sorts a whole group in
one task. Here rows are range-partitioned by (group, order key), so a hot group
spreads over many tasks; each task numbers its own rows and a table with one row
per (group, partition) supplies where it starts.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from planefold.operators.sizing import small_side
from planefold.session import settle

_PART, _LOCAL, _BEFORE = "_part", "_local", "_before"
_ROW_BITS = (1 << 33) - 1


def _ranged(df: DataFrame, by: Sequence[str], order: Sequence[str | Column]) -> DataFrame:
    """Sorted, range-partitioned rows with partition number and row position.

    Written once: the range bounds come from a sample, so two evaluations could
    cut the rows differently.
    """
    keys = [*by, *order]
    partitions = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return settle(
        df.repartitionByRange(partitions, *keys)
        .sortWithinPartitions(*keys)
        .withColumn(_PART, F.spark_partition_id())
        .withColumn(_LOCAL, F.monotonically_increasing_id().bitwiseAND(_ROW_BITS))
    )


def _starts(pieces: DataFrame, by: Sequence[str], size: str) -> DataFrame:
    """Total of ``size`` in the earlier pieces of the same group."""
    earlier = (
        Window.partitionBy(*(by or [F.lit(0)]))
        .orderBy(_PART)
        .rowsBetween(Window.unboundedPreceding, -1)
    )
    return pieces.withColumn(_BEFORE, F.coalesce(F.sum(size).over(earlier), F.lit(0)))


def _beside(rows: DataFrame, pieces: DataFrame, by: Sequence[str], values: Sequence[str]) -> DataFrame:
    """``values`` of each row's piece, groups compared null-safely."""
    keys = [*by, _PART]
    renamed = small_side(pieces.select(*[F.col(k).alias(f"_of_{k}") for k in keys], *values))
    return rows.join(renamed, [F.col(k).eqNullSafe(F.col(f"_of_{k}")) for k in keys])


def numbered(
    df: DataFrame, by: Sequence[str], order: Sequence[str | Column], name: str, total: str | None = None
) -> DataFrame:
    """Add ``name``: 0-based position in the group ``by`` along ``order``.

    ``order`` must be unique within a group. ``total`` adds the group size.
    NULL is a group of its own.
    """
    rows = _ranged(df, by, order)
    pieces = rows.groupBy(*by, _PART).agg(
        F.count(F.lit(1)).alias("_n"), F.min(_LOCAL).alias("_first")
    )
    pieces = _starts(pieces, by, "_n")
    extra = []
    if total:
        pieces = pieces.withColumn(total, F.sum("_n").over(Window.partitionBy(*(by or [F.lit(0)]))))
        extra = [total]
    position = (F.col(_LOCAL) - F.col("_first") + F.col(_BEFORE)).alias(name)
    return _beside(rows, pieces, by, [_BEFORE, "_first", *extra]).select(*df.columns, position, *extra)


def running_total(
    df: DataFrame, by: Sequence[str], order: Sequence[str | Column], value: str, name: str
) -> DataFrame:
    """Add ``name``: sum of ``value`` over the earlier rows of the group ``by``.

    ``order`` must be unique within a group. NULL is a group of its own.
    """
    rows = _ranged(df, by, order)
    pieces = _starts(rows.groupBy(*by, _PART).agg(F.sum(value).alias("_n")), by, "_n")
    earlier = (
        Window.partitionBy(*by, _PART).orderBy(_LOCAL).rowsBetween(Window.unboundedPreceding, -1)
    )
    within = rows.withColumn("_within", F.coalesce(F.sum(value).over(earlier), F.lit(0)))
    return _beside(within, pieces, by, [_BEFORE]).select(
        *df.columns, (F.col("_within") + F.col(_BEFORE)).alias(name)
    )


def top_per_group(
    df: DataFrame, by: Sequence[str], order: Sequence[str | Column], n: int, name: str
) -> DataFrame:
    """The first ``n`` rows of each group, with their 1-based rank.

    Spark limits each input partition to ``n`` rows per group before it shuffles
    (WindowGroupLimit), so no task receives a whole group. It does so up to a
    threshold; beyond, the positions are found by ``numbered``. ``order`` must be
    unique within a group.
    """
    if n > int(df.sparkSession.conf.get("spark.sql.optimizer.windowGroupLimitThreshold")):
        ranked = numbered(settle(df), by, order, name)
        return ranked.withColumn(name, (F.col(name) + 1).cast("int")).filter(F.col(name) <= n)
    window = Window.partitionBy(*by).orderBy(*order)
    return df.withColumn(name, F.row_number().over(window)).filter(F.col(name) <= n)
