"""Parameter maps (string to string)."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

_EMPTY = "map<string,string>"


def over(base: Column, top: Column) -> Column:
    """``base`` with every key of ``top`` taken from ``top``."""
    base = F.coalesce(base, F.create_map().cast(_EMPTY))
    top = F.coalesce(top, F.create_map().cast(_EMPTY))
    kept = F.map_filter(base, lambda key, _: ~F.map_contains_key(top, key))
    return F.map_concat(kept, top)


def layered(*layers: Column) -> Column:
    """Maps from lowest to highest precedence merged into one."""
    return reduce(over, layers)


def required(params: Column, key: str) -> Column:
    """Value of ``key``; the query fails if the plane lacks it."""
    missing = F.raise_error(F.lit(f"parameter '{key}' is missing"))
    return F.when(F.map_contains_key(params, key), F.element_at(params, key)).otherwise(missing)


def optional(params: Column, key: str) -> Column:
    """Value of ``key`` or NULL."""
    return F.try_element_at(params, F.lit(key))
