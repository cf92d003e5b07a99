import math

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from planefold import schemas
from planefold.functions import arrays
from planefold.operators import traces

NAN = float("nan")
TRACE = "plane int, roi int, f array<double>"


def frame(spark, rows):
    return spark.createDataFrame(rows, TRACE)


def same(a, b):
    return (math.isnan(a) and math.isnan(b)) or a == pytest.approx(b)


def zscores(spark, values):
    row = frame(spark, [(0, 0, values)]).select(
        arrays.zscore(F.col("f")).alias("z"), arrays.activity(F.col("f")).alias("a")
    )
    return row.first()


@pytest.mark.parametrize(
    "values, expected",
    [
        ([2.0, 2.0, 2.0], [NAN] * 3),
        ([0.1] * 7, [NAN] * 7),
        ([1.0, NAN, 3.0], [-1.0, NAN, 1.0]),
        ([NAN, NAN], [NAN, NAN]),
        ([], []),
        ([1e-200, 2e-200], [NAN, NAN]),
        ([1.0, 2.0, 3.0], [-1.224744871, 0.0, 1.224744871]),
    ],
)
def test_zscore_edges(spark, values, expected):
    z, activity = zscores(spark, values)
    assert len(z) == len(expected) and all(same(a, b) for a, b in zip(z, expected))
    assert same(activity, float(np.mean(np.abs(expected))) if expected else NAN)


@settings(max_examples=15, deadline=None)
@given(st.lists(st.integers(-1000, 1000).map(float), min_size=2, max_size=30).filter(lambda v: len(set(v)) > 1))
def test_zscore_is_standard(spark, values):
    z = np.array(zscores(spark, values)["z"])
    assert abs(z.mean()) < 1e-9 and abs(z.std() - 1) < 1e-9


def test_moments_are_not_inlined_per_element(spark):
    """A trace of 100,000 frames finishes only if the mean is computed once."""
    long = spark.range(1).select(
        F.lit(0).alias("plane"), F.lit(0).alias("roi"),
        F.expr("transform(sequence(1, 100000), i -> cast(i as double))").alias("f"),
    )
    window = traces.trace_window(long, None, None)
    z = traces.zscored(window).select(F.element_at("z", -1)).first()[0]
    assert z == pytest.approx(math.sqrt(3), abs=1e-3)
    assert traces.zscored_long(window).count() == 100000
    assert traces.roi_activity(window).first()["activity"] == pytest.approx(math.sqrt(3) / 2, abs=1e-3)


def test_window_is_half_open_and_clamped(spark):
    table = frame(spark, [(0, roi, [0.0, 1.0, 2.0, 3.0]) for roi in range(6)])
    got = traces.windowed_long(traces.trace_window(table, (1, 3), (2, 9)))
    assert sorted(map(tuple, got.collect())) == [(0, r, t, float(t)) for r in (1, 2) for t in (2, 3)]
    assert traces.windowed_long(traces.trace_window(table, (0, 9), (3, 2))).count() == 0
    assert traces.windowed_long(traces.trace_window(table, None, (3, None))).count() == 6
    with pytest.raises(ValueError):
        traces.trace_window(table, None, (-1, 2))


def rank_cases(spark):
    flat, nan, calm, wild = [2.0] * 4, [1.0, NAN, 3.0, 1.0], [0.0, 0.0, 0.0, 9.0], [1.0, -1.0, 1.0, -1.0]
    rows = [(0, 0, calm), (0, 1, flat), (0, 2, wild), (0, 3, nan), (0, 4, wild), (1, 0, calm)]
    return frame(spark, rows), {(0, 1): 1, (0, 3): 2, (0, 2): 3, (0, 4): 4, (0, 0): 5, (1, 0): 1}


@pytest.mark.parametrize("rois", [(0, 500), None])
def test_rank_puts_nan_first_and_breaks_ties_by_roi(spark, rois):
    table, expected = rank_cases(spark)
    ranked = traces.activity_rank(table, rois)
    assert {(r.plane, r.roi): r["rank"] for r in ranked.collect()} == expected
    top = traces.activity_top_k(table, 2, rois)
    assert {(r.plane, r.roi): r["rank"] for r in top.collect()} == {k: v for k, v in expected.items() if v <= 2}


def test_window_comes_before_ranking(spark):
    table, _ = rank_cases(spark)
    ranked = traces.activity_rank(table, (2, 4)).filter("plane = 0").orderBy("rank").collect()
    assert [r.roi for r in ranked] == [3, 2]


@pytest.mark.parametrize("rois", [(0, 500), None])
@pytest.mark.parametrize("by_activity", [True, False])
def test_heatmap_rows(spark, rois, by_activity):
    table, expected = rank_cases(spark)
    got = {(r.plane, r.roi): r.row for r in traces.trace_heatmap(table, rois, None, by_activity).collect()}
    assert got == {k: (v - 1 if by_activity else k[1]) for k, v in expected.items()}


@pytest.mark.parametrize(
    "n, rows, cols", [(1, 1, 1), (2, 2, 1), (3, 2, 2), (5, 3, 2), (7, 3, 3), (10, 4, 3), (17, 5, 4)]
)
def test_grid_layout(spark, n, rows, cols):
    got = traces.grid_layout(frame(spark, [(p, 0, []) for p in range(n)])).orderBy("plane").collect()
    assert {(r.grid_rows, r.grid_cols) for r in got} == {(rows, cols)}
    assert [(r.row, r.col) for r in got] == [(i // cols, i % cols) for i in range(n)]
    labels = [f"Planes {i + 1}-{min(i + cols, n)}" if i % cols == 0 else None for i in range(n)]
    assert [r.row_label for r in got] == labels


def test_sample_is_a_repeatable_subset(spark):
    table = frame(spark, [(p, r, []) for p, size in ((0, 50), (1, 7)) for r in range(size)])
    one, two, other = (
        {tuple(r) for r in traces.trace_sample(table, 20, seed).collect()} for seed in (1, 1, 2)
    )
    assert one == two != other
    assert [sum(r[0] == p for r in one) for p in (0, 1)] == [20, 7]
    assert len({r[:2] for r in one}) == 27


@pytest.mark.parametrize("frames, points, step", [(600, 300, 2), (599, 599, 1), (1, 1, 1), (3000, 300, 10)])
def test_stride(spark, frames, points, step):
    table = frame(spark, [(0, 0, [float(i) for i in range(frames)])])
    got = traces.trace_stride(table).orderBy("timepoint").collect()
    assert len(got) == points and all(r.timepoint == i * step == r.f for i, r in enumerate(got))


def test_first_frames_are_clamped(spark):
    table = frame(spark, [(0, 0, [5.0, 6.0, 7.0])])
    assert [r.f for r in traces.trace_stride(table, 2).collect()] == [5.0, 6.0]
    assert traces.trace_stride(table, 99).count() == 3


def test_display(spark):
    rows = [
        (0, 0, [1.0, 5.0], [2.0, 3.0], [0.0, 0.0]),
        (0, 1, [1.0, 5.0], [0.0, 3.0], [1.0, 2.0]),
        (0, 2, [1.0, NAN], [0.0, 3.0], [1.0, 2.0]),
    ]
    table = spark.createDataFrame(rows, schemas.TRACES)
    display = traces.trace_display(table)
    got = {(r.roi, r.timepoint): r for r in display.collect()}
    assert [got[0, t].spk_scaled for t in (0, 1)] == [1.0, 1.0]
    assert [got[1, t].spk_scaled for t in (0, 1)] == [2.5, 5.0]
    assert math.isnan(got[2, 0].fmin) and math.isnan(got[2, 0].fmax)
    labels = {r.roi: r for r in traces.display_labels(display).collect()}
    assert (labels[1].low_label, labels[1].high_label, labels[1].axis_label) == ("0.0", "5.0", "ROI 1")


def test_caption(spark):
    text = spark.range(1).select(traces.interval_caption((0, 500), (0, 1000))).first()[0]
    assert text == "Frame Interval: 0-1000, ROI Interval: 0-500"


def test_collect_traces(spark):
    planes = [frame(spark, [(9, 0, [1.0])]), frame(spark, [(9, 0, [2.0]), (9, 1, [3.0])])]
    got = traces.collect_traces(planes)
    assert sorted((r.plane, r.f[0]) for r in got.collect()) == [(1, 1.0), (2, 2.0), (2, 3.0)]
    for wrong in ("no list", []):
        with pytest.raises(ValueError):
            traces.collect_traces(wrong)


def test_neuropil_corrected(spark):
    table = spark.createDataFrame([(0, 0, [1.0, 2.0], [2.0, 4.0], [])], schemas.TRACES)
    assert traces.neuropil_corrected(table, 0.5).first().f == [0.0, 0.0]
