import colorsys
import math

import pytest
from pyspark.sql import functions as F

from planefold import schemas
from planefold.constants import HUE_STEP
from planefold.functions.color import hsv_to_rgb
from planefold.operators import rois, volume


def masks(spark, rows):
    return spark.createDataFrame(rows, schemas.ROIS)


@pytest.fixture(scope="module")
def overlap(spark):
    return masks(
        spark,
        [
            (0, 0, True, [(1, 1, 1.0), (1, 2, 2.0)]),
            (0, 1, False, [(1, 1, 1.0)]),
            (0, 2, True, [(1, 2, 4.0)]),
            (1, 0, False, []),
        ],
    )


def test_label_map(overlap):
    got = {(r.y, r.x): (r.label_all, r.label_noncell, r.label_cell) for r in rois.label_map(overlap).collect()}
    assert got == {(1, 1): (2, 2, 1), (1, 2): (3, None, 3)}


def test_dense_label_map(spark, overlap):
    planes = spark.createDataFrame([(0, 2, 3), (1, 1, 1)], "plane int, ly int, lx int")
    dense = rois.as_nan(rois.label_map(overlap, planes), "label_cell")
    got = {(r.plane, r.y, r.x): r.label_cell for r in dense.collect()}
    assert len(got) == 7
    assert {k: v for k, v in got.items() if not math.isnan(v)} == {(0, 1, 1): 1.0, (0, 1, 2): 3.0}


def rgb_of(roi, value):
    return pytest.approx(colorsys.hsv_to_rgb(roi * HUE_STEP % 1, 1, value))


def test_last_roi_and_last_listed_pixel_paint(spark):
    table = masks(
        spark,
        [
            (0, 3, True, [(0, 0, 1.0), (0, 0, 2.0), (0, 1, 4.0)]),
            (0, 0, True, [(0, 0, 5.0)]),
            (0, 4, False, [(0, 0, 0.0)]),
        ],
    )
    got = {(r.iscell, r.y, r.x): (r.r, r.g, r.b) for r in rois.paint_map(table).collect()}
    assert got[True, 0, 0] == rgb_of(3, 0.5) and got[True, 0, 1] == rgb_of(3, 1.0)
    assert any(math.isnan(v) for v in got[False, 0, 0])


def test_dense_paint_is_black_elsewhere(spark, overlap):
    planes = spark.createDataFrame([(0, 2, 3)], "plane int, ly int, lx int")
    got = {(r.iscell, r.y, r.x): (r.r, r.g, r.b) for r in rois.paint_map(overlap, planes).collect()}
    assert len(got) == 12 and got[False, 0, 0] == (0.0, 0.0, 0.0) and got[True, 1, 2] == rgb_of(2, 1.0)


def test_colours_match_the_standard_library(spark):
    steps = [(h / 24, s / 3, v / 3) for h in range(25) for s in range(4) for v in range(4)]
    table = spark.createDataFrame(steps, "h double, s double, v double")
    for row in table.withColumn("rgb", hsv_to_rgb(F.col("h"), F.col("s"), F.col("v"))).collect():
        assert tuple(row.rgb) == pytest.approx(colorsys.hsv_to_rgb(row.h, row.s, row.v), abs=1e-12)


def test_raw_flags(spark):
    rows = [([1.0, 0.2],), ([0.0, 0.9],), ([float("nan"), 0.0],), ([0.5, 0.0],)]
    flags = spark.createDataFrame(rows, "raw array<double>").select(volume.cell_flag(F.col("raw")).alias("c"))
    assert [r.c for r in flags.collect()] == [True, False, True, True]


def test_shape_features(spark):
    table = masks(spark, [(0, 0, True, [(0, 0, 1.0), (0, 3, 1.0), (1, 1, 1.0)])])
    row = rois.shape_features(table).first()
    assert (row.area, row.aspect) == (3, 2.0)


def test_class_maps_cover_the_whole(spark, overlap):
    for row in rois.label_map(overlap).collect():
        assert row.label_all == max(v for v in (row.label_noncell, row.label_cell) if v is not None)
    assert rois.cells(overlap).count() + rois.non_cells(overlap).count() == overlap.count()


def test_raster_keeps_what_lies_outside(spark, overlap):
    """A pixel beyond the picture, a plane without a picture and a plane without a number stay; no pixel comes twice."""
    odd = masks(spark, [(0, 5, True, [(0, 9, 1.0), (7, 0, 1.0)]), (8, 0, True, [(2, 2, 1.0)]), (None, 0, True, [(0, 1, 1.0)])])
    planes = spark.createDataFrame([(0, 2, 3), (None, 1, 2), (3, 0, 5), (4, 2, 0), (5, None, 2)], "plane int, ly int, lx int")
    every = overlap.unionByName(odd)
    rows = rois.label_map(every, planes).collect()
    got = {(r.plane, r.y, r.x): r.label_all for r in rows}
    sparse = {(r.plane, r.y, r.x): r.label_all for r in rois.label_map(every).collect()}
    picture = {(0, y, x) for y in range(2) for x in range(3)} | {(None, 0, 0), (None, 0, 1)}
    assert len(got) == len(rows) and set(got) == picture | set(sparse)
    assert got == {**dict.fromkeys(picture), **sparse}


def test_no_empty_pixel_is_shuffled(spark, overlap):
    planes = spark.createDataFrame([(0, 300, 400)], "plane int, ly int, lx int")
    for dense in (rois.label_map(overlap, planes), rois.paint_map(overlap, planes)):
        plan = dense._jdf.queryExecution().executedPlan().toString()
        # read from the result down: pixels are spread last, after every exchange
        assert plan.index("Generate inline") < plan.index("Exchange") and plan.count("inline") == 1
    assert rois.label_map(overlap, planes).count() == 300 * 400
