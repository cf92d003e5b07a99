"""Measured broadcasts."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

BROADCAST_BYTES = 64 << 20

_FIXED_WIDTH = {
    T.BooleanType: 1,
    T.ByteType: 1,
    T.ShortType: 2,
    T.IntegerType: 4,
    T.FloatType: 4,
    T.LongType: 8,
    T.DoubleType: 8,
}
_ROW_OVERHEAD = 32


def _width(value: Column, kind: T.DataType) -> Column | None:
    """In-memory size of a value; None if its type is not known."""
    if isinstance(kind, T.StringType):
        return F.coalesce(F.octet_length(value), F.lit(0)).cast("long") + 8
    if isinstance(kind, T.StructType):
        parts = [_width(value[f.name], f.dataType) for f in kind.fields]
        return None if any(part is None for part in parts) else sum(parts, F.lit(16).cast("long"))
    if isinstance(kind, T.ArrayType):
        if _width(value, kind.elementType) is None:
            return None
        fixed = _fixed(kind.elementType)
        if fixed is not None:
            inside = F.size(value) * fixed
        else:
            inside = F.aggregate(value, F.lit(0).cast("long"), lambda sum_, x: sum_ + _width(x, kind.elementType))
        return F.coalesce(inside, F.lit(0)).cast("long") + 24
    return F.lit(_FIXED_WIDTH[type(kind)]).cast("long") if type(kind) in _FIXED_WIDTH else None


def _fixed(kind: T.DataType) -> int | None:
    """Size of a value of a type whose values all take the same."""
    if isinstance(kind, T.StructType):
        parts = [_fixed(f.dataType) for f in kind.fields]
        return None if None in parts else sum(parts, 16)
    return _FIXED_WIDTH.get(type(kind))


def measured_bytes(df: DataFrame, nested: bool = False) -> int | None:
    """In-memory size by a distributed sum; None if a column has a type without known size.

    Arrays and structs count as unknown unless ``nested``: their items are added up row by row.
    """
    if not nested and any(isinstance(field.dataType, (T.ArrayType, T.StructType)) for field in df.schema.fields):
        return None
    widths = [_width(F.col(field.name), field.dataType) for field in df.schema.fields]
    if any(width is None for width in widths):
        return None
    width = sum(widths, F.lit(_ROW_OVERHEAD).cast("long"))
    return df.agg(F.coalesce(F.sum(width), F.lit(0)).alias("bytes")).first()["bytes"]


def fits(df: DataFrame, limit: int = BROADCAST_BYTES) -> bool:
    """Whether ``df`` is proven to be at most ``limit`` bytes."""
    size = measured_bytes(df, nested=True)
    return size is not None and size <= limit


def small_side(df: DataFrame, limit: int = BROADCAST_BYTES) -> DataFrame:
    """``df`` with a broadcast hint if its measured size stays below ``limit``.

    Beyond the limit the join shuffles both sides by key, where adaptive
    execution splits hot partitions. The measurement is one aggregation over the
    side that is hoped to be small; it spares the shuffle of the large side.
    """
    return F.broadcast(df) if fits(df, limit) else df
