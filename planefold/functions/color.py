"""Colour arithmetic on columns."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from planefold.constants import HUE_STEP


def roi_hue(roi: Column) -> Column:
    """A repeatable hue in [0, 1) for a ROI index."""
    return F.pmod(roi * F.lit(HUE_STEP), F.lit(1.0))


def hsv_to_rgb(h: Column, s: Column, v: Column) -> Column:
    """``struct(r, g, b)`` of a hue, saturation and value, each in [0, 1].

    Every channel follows the same trapezoid over the hue circle, turned by a
    third of it; no branching per sector.
    """

    def channel(turn: int) -> Column:
        at = (h * 6 + turn) % 6
        dip = F.greatest(F.lit(0.0), F.least(at, 4 - at, F.lit(1.0)))
        return v - v * s * dip

    return F.struct(channel(5).alias("r"), channel(3).alias("g"), channel(1).alias("b"))
