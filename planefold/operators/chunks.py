"""Traces in chunks of frames, and statistics from states of chunks that merge.

A chunk row holds ``size`` frames of one ROI (the last one fewer), so a trace of any
length is many rows. What a chunk contributes to mean, spread, skewness and correlation
is a state of a few numbers; two states merge into that of both chunks without loss of
digits (the differences of their means enter, never sums of squares).

States merge in a tree over chunk numbers, ``FAN`` at a time in order. The tree is set
by the numbers alone, so results are equal to the last bit however the rows are
partitioned, and no task holds more than ``FAN`` states of a group.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from planefold.functions import arrays
from planefold.operators.sizing import small_side
from planefold.session import settle

KEYS = ["plane", "roi"]
SIZE = 4096
FAN = 256


def to_chunks(traces: DataFrame, size: int = SIZE, columns: Sequence[str] = ("f",)) -> DataFrame:
    """``plane, roi, chunk`` and slices of the ``columns`` of traces with one row per ROI; nothing is shuffled."""
    if size < 1:
        raise ValueError("`size` must be positive")
    last = F.floor((F.size(columns[0]) - 1) / size).cast("int")
    number = F.when(F.size(columns[0]) > 0, F.sequence(F.lit(0), last, F.lit(1))).otherwise(F.array(F.lit(0)))
    long = traces.select(*KEYS, *columns, F.explode(number).alias("chunk"))
    sliced = [F.slice(c, F.col("chunk") * size + 1, F.lit(size)).alias(c) for c in columns]
    return long.select(*KEYS, F.col("chunk").cast("long").alias("chunk"), *sliced)


def long_to_chunks(long: DataFrame, size: int = SIZE, columns: Sequence[str] = ("f",)) -> DataFrame:
    """Chunks of traces in long form (plane, roi, frame); frames without a row are left out, NULL becomes NaN."""
    values = [F.coalesce(F.col(c).cast("double"), F.lit(arrays.NAN)).alias(c) for c in columns]
    chunk = F.expr(f"frame div {size}").alias("chunk")
    grouped = long.groupBy(*KEYS, chunk).agg(F.array_sort(F.collect_list(F.struct("frame", *values))).alias("v"))
    return grouped.select(*KEYS, "chunk", F.col("v.frame").alias("frames"), *[F.col(f"v.{c}").alias(c) for c in columns])


def _fold(values: Column, terms: Callable[[Column], dict[str, Column]]) -> Column:
    """Sums of several terms over an array, in its order."""

    def add(sums: Column, v: Column) -> Column:
        return F.struct(*[(sums[name] + term).alias(name) for name, term in terms(v).items()])

    start = F.struct(*[F.lit(0.0).alias(name) for name in terms(F.struct(F.lit(0.0).alias("a"), F.lit(0.0).alias("b")))])
    return F.aggregate(values, start, add)


def state(f: Column, other: Column | None = None) -> Column:
    """State of a chunk: ``n`` values, ``bad`` NaN ones, ``mean``, central sums ``m2`` and ``m3``.

    With ``other``, a trace beside it, also its mean and sum of squares and the sum of
    products, over the places where both have a value.
    """
    both = F.zip_with(f, f if other is None else other, lambda a, b: F.struct(a.cast("double").alias("a"), b.cast("double").alias("b")))

    def central(kept: Column) -> Column:
        n = F.size(kept)

        def about(m: Column) -> Column:
            def terms(v: Column) -> dict[str, Column]:
                d, e = v["a"] - m["a"], v["b"] - m["b"]
                own = {"m2": d * d, "m3": d * d * d}
                return own if other is None else own | {"o2": e * e, "co": d * e}

            def whole(s: Column) -> Column:
                names = ["m2", "m3"] + ([] if other is None else ["o2", "co"])
                means = [m["a"].alias("mean")] + ([] if other is None else [m["b"].alias("other")])
                return F.struct(n.cast("long").alias("n"), (F.size(f) - n).cast("long").alias("bad"), *means, *[s[x].alias(x) for x in names])

            return arrays.bind(_fold(kept, terms), whole)

        total = _fold(kept, lambda v: {"a": v["a"], "b": v["b"]})
        scale = F.greatest(n, F.lit(1))
        means = arrays.bind(total, lambda s: F.struct((s["a"] / scale).alias("a"), (s["b"] / scale).alias("b")))
        return arrays.bind(means, about)

    return arrays.bind(F.filter(both, lambda v: ~(F.isnan(v["a"]) | F.isnan(v["b"]))), central)


def merged(a: Column, b: Column, paired: bool = False) -> Column:
    """State of two chunks together."""
    n = a["n"] + b["n"]
    safe = F.greatest(n, F.lit(1)).cast("double")
    na, nb, d = a["n"].cast("double"), b["n"].cast("double"), b["mean"] - a["mean"]
    cross = na * nb / safe
    m2 = a["m2"] + b["m2"] + d * d * cross
    m3 = a["m3"] + b["m3"] + d * d * d * cross * (na - nb) / safe + 3 * d * (na * b["m2"] - nb * a["m2"]) / safe
    parts = {"n": n, "bad": a["bad"] + b["bad"], "mean": a["mean"] + d * nb / safe}
    if paired:
        e = b["other"] - a["other"]
        parts |= {"other": a["other"] + e * nb / safe, "m2": m2, "m3": m3, "o2": a["o2"] + b["o2"] + e * e * cross, "co": a["co"] + b["co"] + d * e * cross}
    else:
        parts |= {"m2": m2, "m3": m3}
    # an empty state has no mean to enter
    whole = F.struct(*[value.alias(name) for name, value in parts.items()])
    alone = F.struct(*[(parts["bad"] if name == "bad" else b[name]).alias(name) for name in parts])
    return F.when(a["n"] == 0, alone).otherwise(whole)


def merge_tree(states: DataFrame, keys: Sequence[str], order: str, merge: Callable[[Column, Column], Column]) -> DataFrame:
    """One ``state`` for each group of ``keys``, merged along the numbers ``order``, ``FAN`` by ``FAN``."""
    now = settle(states.select(*keys, F.col(order).cast("long").alias("order"), "state"))
    most = now.agg(F.max("order")).first()[0] or 0
    while most > 0:
        above = F.expr(f"order div {FAN}").alias("above")
        grouped = now.groupBy(*keys, above).agg(F.array_sort(F.collect_list(F.struct("order", "state"))).alias("all"))
        folded = F.aggregate(F.slice("all.state", 2, FAN), F.get("all.state", F.lit(0)), merge)
        now = grouped.select(*keys, F.col("above").alias("order"), folded.alias("state"))
        most //= FAN
    return now.select(*keys, "state")


def roi_states(chunks: DataFrame, column: str = "f", other: str | None = None) -> DataFrame:
    """State of each ROI's whole trace."""
    each = chunks.select(*KEYS, "chunk", state(F.col(column), F.col(other) if other else None).alias("state"))
    return merge_tree(each, KEYS, "chunk", lambda a, b: merged(a, b, paired=other is not None))


def _spread(s: str = "state") -> Column:
    """Population sd; NaN for a flat or empty trace."""
    sd = F.sqrt(F.col(f"{s}.m2") / F.greatest(F.col(f"{s}.n"), F.lit(1)))
    return F.when(sd > 0, sd).otherwise(F.lit(arrays.NAN))


def _scaled(chunks: DataFrame, column: str) -> DataFrame:
    """Chunks beside mean and sd of their trace; the states are a few numbers per ROI, broadcast if measured small."""
    whole = settle(roi_states(chunks, column).select(*KEYS, F.col("state.mean").alias("mean"), _spread().alias("sd"), "state.n", "state.bad"))
    return chunks.join(small_side(whole), KEYS)


def zscored(chunks: DataFrame, column: str = "f") -> DataFrame:
    """Chunks with the z-score ``z`` of their trace; NaN stays, a flat trace becomes NaN."""
    z = F.transform(column, lambda x: (x.cast("double") - F.col("mean")) / F.col("sd"))
    return _scaled(chunks, column).withColumn("z", z).select(*chunks.columns, "z")


def roi_activity(chunks: DataFrame, column: str = "f") -> DataFrame:
    """Mean absolute z-score of each ROI; NaN if any value is NaN or the trace is flat."""
    far = F.aggregate(column, F.lit(0.0), lambda s, x: s + F.abs(x.cast("double") - F.col("mean")))
    each = _scaled(chunks, column).select(*KEYS, "chunk", F.struct(far.alias("far"), "n", "bad", "sd").alias("state"))

    def add(a: Column, b: Column) -> Column:
        return F.struct((a["far"] + b["far"]).alias("far"), a["n"].alias("n"), a["bad"].alias("bad"), a["sd"].alias("sd"))

    whole = merge_tree(each, KEYS, "chunk", add)
    bad = (F.col("state.bad") > 0) | (F.col("state.n") == 0)
    value = F.col("state.far") / F.col("state.sd") / F.greatest(F.col("state.n"), F.lit(1))
    return whole.select(*KEYS, F.when(bad, F.lit(arrays.NAN)).otherwise(value).alias("activity"))


def signal_features(chunks: DataFrame, column: str = "f", other: str = "fneu") -> DataFrame:
    """Skewness, variance and correlation with the trace beside it (population); NaN with any NaN."""
    s = {name: F.when(F.col("state.bad") == 0, F.col(f"state.{name}")).otherwise(F.lit(arrays.NAN)) for name in ("m2", "m3", "o2", "co")}
    n = F.greatest(F.col("state.n"), F.lit(1))
    return roi_states(chunks, column, other).select(
        *KEYS,
        arrays.divide(s["m3"] / n, F.pow(s["m2"] / n, 1.5)).alias("skewness"),
        F.when(F.col("state.n") > 0, s["m2"] / n).alias("variance"),
        arrays.divide(s["co"], F.sqrt(s["m2"]) * F.sqrt(s["o2"])).alias("corr"),
    )


def volume_signal(chunks: DataFrame, column: str = "f") -> DataFrame:
    """Mean and population sd over all ROIs and frames of each plane; NaN if any value is NaN."""
    plane = merge_tree(roi_states(chunks, column), ["plane"], "roi", lambda a, b: merged(a, b))
    bad = F.col("state.bad") > 0
    mean = F.when(bad, F.lit(arrays.NAN)).when(F.col("state.n") > 0, F.col("state.mean"))
    sd = F.when(bad, F.lit(arrays.NAN)).when(F.col("state.n") > 0, F.sqrt(F.col("state.m2") / F.greatest(F.col("state.n"), F.lit(1))))
    return plane.select("plane", mean.alias("mean_trace"), sd.alias("std_trace"))
