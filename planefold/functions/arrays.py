"""Expressions over one trace array; none of them shuffles.

A lambda that mentions a column computed from another array function is a trap:
the optimizer may inline that function into the lambda and evaluate it once per
element, which makes the cost quadratic in the trace length. ``bind`` avoids it
by handing the value to the lambda as a variable that is evaluated once per row.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

NAN = float("nan")


def bind(value: Column, body: Callable[[Column], Column]) -> Column:
    """Evaluate ``value`` once and use it in ``body``, also inside lambdas."""
    return F.element_at(F.transform(F.array(value), body), 1)


def window_slice(values: Column, start: int, stop: int | None) -> Column:
    """Half-open, zero-based ``[start, stop)``, clamped to the array."""
    if start < 0 or (stop is not None and stop < 0):
        raise ValueError("window bounds must not be negative")
    length = F.greatest(F.size(values) - start, F.lit(0)) if stop is None else F.lit(max(stop - start, 0))
    return F.slice(values, F.lit(start + 1), length)


def stride_of(n: Column, target: int) -> Column:
    """Step that leaves about ``target`` points of ``n``; at least 1."""
    return F.greatest(F.lit(1), F.floor(n / F.lit(target))).cast("int")


def positions(n: Column, step: Column) -> Column:
    """``0, step, 2*step, …`` below ``n``."""
    return F.when(n > 0, F.sequence(F.lit(0), n - 1, step)).otherwise(F.array().cast("array<int>"))


def every(values: Column, step: Column) -> Column:
    """Every ``step``-th element, starting with the first."""
    thin = bind(values, lambda v: F.transform(positions(F.size(v), step), lambda i: F.get(v, i)))
    return F.when(step == 1, values).otherwise(thin)


def has_nan(values: Column) -> Column:
    """NaN sorts above every number, so it shows up as the maximum."""
    return F.isnan(F.array_max(values))


def nan_max(values: Column) -> Column:
    """Maximum; NaN if any element is NaN."""
    return F.array_max(values)


def nan_min(values: Column) -> Column:
    """Minimum; NaN if any element is NaN."""
    return F.when(has_nan(values), F.lit(NAN)).otherwise(F.array_min(values))


def divide(top: Column, bottom: Column) -> Column:
    """Quotient, NaN where the divisor is zero."""
    return F.when(bottom != 0, top / bottom).otherwise(F.lit(NAN))


def _drop_nan(values: Column) -> Column:
    return F.when(has_nan(values), F.filter(values, lambda x: ~F.isnan(x))).otherwise(values)


def _total(values: Column, term: Callable[[Column], Column]) -> Column:
    return F.aggregate(values, F.lit(0.0), lambda acc, x: acc + term(x.cast("double")))


def moments(values: Column) -> Column:
    """``struct(mean, sd)`` over the elements that are not NaN; population sd.

    A constant or empty trace has no spread: its ``sd`` is NaN.
    """

    def spread(kept: Column, mean: Column) -> Column:
        flat = (F.size(kept) == 0) | (F.array_min(kept) == F.array_max(kept))
        sd = F.sqrt(_total(kept, lambda x: (x - mean) * (x - mean)) / F.size(kept))
        return F.when(flat, F.lit(NAN)).otherwise(bind(sd, lambda s: F.when(s != 0, s).otherwise(F.lit(NAN))))

    def both(kept: Column) -> Column:
        mean = F.when(F.size(kept) > 0, _total(kept, lambda x: x) / F.size(kept)).otherwise(F.lit(NAN))
        return bind(mean, lambda m: F.struct(m.alias("mean"), spread(kept, m).alias("sd")))

    return bind(_drop_nan(values), both)


def zscore(values: Column) -> Column:
    """Z-score per element: NaN elements stay NaN, flat traces become NaN."""
    return bind(
        moments(values),
        lambda m: F.transform(values, lambda x: (x.cast("double") - m["mean"]) / m["sd"]),
    )


def activity(values: Column) -> Column:
    """Mean absolute z-score; NaN if any element of the trace is NaN."""

    def mean_abs(m: Column) -> Column:
        return _total(values, lambda x: F.abs(x - m["mean"]) / m["sd"]) / F.size(values)

    empty = (F.size(values) == 0) | has_nan(values)
    return F.when(empty, F.lit(NAN)).otherwise(bind(moments(values), mean_abs))
