import random

import pytest

from planefold import schemas
from planefold.operators import blocks, masks, movie
from planefold.session import settle

SIDE, FRAMES = 9, 4


@pytest.fixture(scope="module")
def scene(spark):
    rng = random.Random(1)
    values = {
        (p, t, y, x): float(rng.randrange(100))
        for p in (0, 1) for t in range(FRAMES) for y in range(SIDE) for x in range(SIDE)
    }
    masks = {
        (p, r): {(rng.randrange(SIDE), rng.randrange(SIDE)): float(rng.randrange(1, 5)) for _ in range(3)}
        for p in (0, 1) for r in range(3)
    }
    frames = spark.createDataFrame([(p, "a", t, y, x, v) for (p, t, y, x), v in values.items()], schemas.MOVIE)
    rois = spark.createDataFrame(
        [(p, r, True, [(y, x, w) for (y, x), w in m.items()]) for (p, r), m in masks.items()], schemas.ROIS
    )
    planes = spark.createDataFrame([(0, SIDE, SIDE), (1, SIDE, SIDE)], "plane int, ly int, lx int")
    return values, masks, frames, rois, planes


def ring_of(masks, plane, roi, inner, outer):
    taken = {pixel for (p, _), m in masks.items() if p == plane for pixel in m}
    mask = masks[plane, roi]
    cy, cx = (sum(pixel[i] for pixel in mask) / len(mask) for i in (0, 1))
    return {
        (y, x)
        for y in range(SIDE) for x in range(SIDE)
        if inner**2 < (y - cy) ** 2 + (x - cx) ** 2 <= outer**2 and (y, x) not in taken
    }


def test_ring(scene):
    _, masks, _, rois, planes = scene
    got = {tuple(r) for r in movie.neuropil_ring(rois, 1.5, 3, planes).select("plane", "roi", "y", "x").collect()}
    assert got == {(p, r, y, x) for p, r in masks for y, x in ring_of(masks, p, r, 1.5, 3)}
    assert movie.neuropil_ring(rois, 0, 0.01, planes).count() == 0
    with pytest.raises(ValueError):
        movie.neuropil_ring(rois, 3, 1)


@pytest.mark.parametrize("way", ["broadcast", "shuffle"])
def test_extraction(scene, way):
    values, masks, frames, rois, planes = scene
    got = movie.extracted_traces(frames, rois, 1.5, 3, planes, 1 << 20 if way == "broadcast" else 0).collect()
    assert len(got) == len(masks) * FRAMES
    for row in got:
        mask, ring = masks[row.plane, row.roi], ring_of(masks, row.plane, row.roi, 1.5, 3)
        f = sum(w * values[row.plane, row.frame, y, x] for (y, x), w in mask.items()) / sum(mask.values())
        fneu = sum(values[row.plane, row.frame, y, x] for y, x in ring) / len(ring)
        assert (row.f, row.fneu) == (pytest.approx(f), pytest.approx(fneu))


@pytest.mark.parametrize("limit", [1 << 20, 0])
def test_sparse_frames(spark, limit):
    rows = [(0, "a", t, y, 0, float(y + 1)) for t in (5, 10**8) for y in (0, 1)]
    rois = spark.createDataFrame([(0, 0, True, [(0, 0, 1.0), (1, 0, 3.0)])], schemas.ROIS)
    got = movie.roi_traces(spark.createDataFrame(rows, schemas.MOVIE), rois, limit).collect()
    assert sorted((r.frame, r.f) for r in got) == [(5, 1.75), (10**8, 1.75)]


def test_random_rings_and_rows(spark):
    rng = random.Random(7)
    side = 40
    spots = {(p, r): (rng.randrange(side), rng.randrange(side)) for p in (0, 1) for r in range(30)}
    masks_ = {
        k: {(min(max(cy + rng.randint(-4, 4), 0), side - 1), min(max(cx + rng.randint(-4, 4), 0), side - 1)): 1.0 for _ in range(rng.randint(1, 30))}
        for k, (cy, cx) in spots.items()
    }
    rois = spark.createDataFrame([(p, r, True, [(y, x, w) for (y, x), w in m.items()]) for (p, r), m in masks_.items()], schemas.ROIS)
    planes = spark.createDataFrame([(0, side, side - 3)], "plane int, ly int, lx int")  # plane 1 has no size: unbounded below and right
    for inner, outer in ((0.0, 3.0), (1.5, 3.0), (2.0, 7.25), (3.0, 3.5)):
        want = set()
        for (p, r), mask in masks_.items():
            taken = {pixel for (q, _), m in masks_.items() if q == p for pixel in m}
            cy, cx = (sum(pixel[i] for pixel in mask) / len(mask) for i in (0, 1))
            ly, lx = (side, side - 3) if p == 0 else (10**6, 10**6)
            want |= {
                (p, r, y, x)
                for y in range(max(0, int(cy) - 9), int(cy) + 10) for x in range(max(0, int(cx) - 9), int(cx) + 10)
                if y < ly and x < lx and inner**2 < (y - cy) ** 2 + (x - cx) ** 2 <= outer**2 and (y, x) not in taken
            }
        got = [tuple(r) for r in movie.neuropil_ring(rois, inner, outer, planes).select("plane", "roi", "y", "x").collect()]
        assert len(got) == len(set(got)) and set(got) == want
    rows = masks.mask_rows(rois).collect()
    assert {(r.plane, r.roi, r.y, x) for r in rows for a, b in r.runs for x in range(a, b + 1)} == {(p, r, y, x) for (p, r), m in masks_.items() for y, x in m}
    assert all(b + 1 < c for r in rows for (_, b), (c, _) in zip(r.runs, r.runs[1:]))


def test_blocks_keep_every_value(spark, monkeypatch):
    rng = random.Random(5)
    rows = [(rng.randrange(2), "a", rng.randrange(300), rng.randrange(40), rng.randrange(70), float(rng.randrange(9))) for _ in range(5000)]
    rows += [(0, "a", 5, 3, 3, None), (None, "a", 5, 3, 3, 1.0)]
    got = []
    for b in blocks.to_blocks(spark.createDataFrame(rows, schemas.MOVIE)).collect():
        for at, value in zip(b["at"], b["value"]):
            frame, y, x = at >> 25, at >> 21 & 15, at & (1 << 21) - 1
            got.append((b.plane, b.block * blocks.FRAMES + frame, b.band * blocks.BAND + y, x, value))
    assert sorted(got) == sorted((p, t, y, x, v) for p, _, t, y, x, v in rows if p is not None and v is not None)
    with pytest.raises(Exception, match="is not within"):
        blocks.to_blocks(spark.createDataFrame([(0, "a", 0, -1, 0, 1.0)], schemas.MOVIE)).collect()


@pytest.mark.parametrize("limit", [1 << 20, 0])
def test_no_pixel_rows_are_shuffled(scene, limit):
    _, _, frames, rois, planes = scene
    weights = settle(blocks.band_weights(rois, (1.5, 3), planes))
    plan = blocks.block_sums(blocks.to_blocks(frames), weights, limit)._jdf.queryExecution().executedPlan().toString()
    for line in plan.splitlines():
        if "Exchange" in line and "Broadcast" not in line:
            assert "plane" in line and " y#" not in line and " x#" not in line and " frame#" not in line
    assert plan.count("MapInArrow") == 2


def test_crowded_band_in_parts(spark, monkeypatch):
    monkeypatch.setattr(blocks, "PART_ROIS", 2)
    monkeypatch.setattr(blocks, "AT_ONCE", 3)
    rng = random.Random(8)
    values = [(0, "a", t, y, x, float(rng.randrange(50))) for t in range(70) for y in range(3) for x in range(5)]
    masks_ = [(0, r, True, [(rng.randrange(3), rng.randrange(5), float(rng.randrange(1, 4))) for _ in range(4)]) for r in range(9)]
    got = movie.roi_traces(spark.createDataFrame(values, schemas.MOVIE), spark.createDataFrame(masks_, schemas.ROIS)).collect()
    at = {(t, y, x): v for _, _, t, y, x, v in values}
    want = {(r, t): sum(w * at[t, y, x] for y, x, w in m) / sum(w for *_, w in m) for _, r, _, m in masks_ for t in range(70)}
    assert {(r.roi, r.frame): r.f for r in got} == pytest.approx(want)


def test_silent_rois_are_kept(spark):
    frames = spark.createDataFrame([(0, "a", 0, 0, 0, 2.0)], schemas.MOVIE)
    rois = spark.createDataFrame([(0, 0, True, [(0, 0, 1.0)]), (0, 1, True, [(5, 5, 1.0)]), (0, 2, True, [])], schemas.ROIS)
    got = movie.with_silent(movie.roi_traces(frames, rois), rois).collect()
    assert sorted((r.roi, r.frame, r.f) for r in got if r.roi == 0) == [(0, 0, 2.0)]
    assert {r.roi for r in got if r.frame is None and r.f is None} == {1, 2}


def test_partial_order_is_refused(spark):
    frames = spark.createDataFrame([(0, f, t) for f in "ab" for t in range(2)], "plane int, file string, frame long")
    order = spark.createDataFrame([(0, "b", 0)], "plane int, file string, position int")
    with pytest.raises(Exception, match="no place for file a"):
        movie.concat_movies(frames, order).collect()


def test_projections_and_panels(scene, spark):
    values, _, frames, _, _ = scene
    given = spark.createDataFrame([(0, "refImg", 0, 0, 7.0), (0, "other", 0, 0, 1.0)], schemas.IMAGES)
    got = movie.registration_panels(movie.projections(frames).unionByName(given)).collect()
    series = [values[0, t, 2, 3] for t in range(FRAMES)]
    at = {(r.kind, r.panel): r.value for r in got if (r.plane, r.y, r.x) == (0, 2, 3)}
    assert at == {("max_proj", 2): max(series), ("meanImg", 3): pytest.approx(sum(series) / FRAMES)}
    assert {r.kind for r in got} == {"refImg", "max_proj", "meanImg"}


def clip(spark, name, frames, side=1, plane=0):
    rows = [(plane, name, t, y, 0, float(t)) for t in range(frames) for y in range(side)]
    return spark.createDataFrame(rows, schemas.MOVIE)


def test_concat_keeps_unequal_lengths(spark):
    whole = movie.union_movies([clip(spark, "b", 2), clip(spark, "a", 3), clip(spark, "c", 1), clip(spark, "b", 2, plane=1)])
    got = {(r.plane, r.file, r.frame): r.global_frame for r in movie.concat_movies(whole).collect()}
    assert got == {
        (0, "a", 0): 0, (0, "a", 1): 1, (0, "a", 2): 2, (0, "b", 0): 3, (0, "b", 1): 4, (0, "c", 0): 5,
        (1, "b", 0): 0, (1, "b", 1): 1,
    }


def test_concat_in_given_order(spark):
    whole = movie.union_movies([clip(spark, "a", 2), clip(spark, "b", 3)])
    order = spark.createDataFrame([(0, "b", 0), (0, "a", 1)], "plane int, file string, position int")
    starts = movie.concat_movies(whole, order).filter("frame = 0").collect()
    assert {r.file: r.global_frame for r in starts} == {"b": 0, "a": 3}


def test_concat_refuses_mixed_sizes(spark):
    whole = movie.union_movies([clip(spark, "a", 2, side=2), clip(spark, "b", 2, side=3)])
    with pytest.raises(Exception, match="differ in height or width"):
        movie.concat_movies(whole).collect()
    assert movie.concat_movies(whole, check_size=False).count() == 10


def test_union_takes_the_first_type(spark):
    small = clip(spark, "a", 1).selectExpr("plane", "file", "frame", "y", "x", "cast(value as smallint) value")
    assert dict(movie.union_movies([small, clip(spark, "b", 1)]).dtypes)["value"] == "smallint"
    with pytest.raises(ValueError):
        movie.union_movies([])


def test_superres(scene, spark):
    values, _, frames, _, _ = scene
    shifts = [(p, t, 0.25 * t, -0.3) for p in (0, 1) for t in range(FRAMES)]
    offsets = spark.createDataFrame(shifts, schemas.OFFSETS)
    got = {(r.dy_bin, r.dx_bin): r.value for r in movie.superres_mean(frames, offsets, 0.5).collect() if (r.plane, r.y, r.x) == (1, 0, 0)}
    means = [(values[1, t, 0, 0] + values[1, t + 1, 0, 0]) / 2 for t in (0, 2)]
    assert got == {(0, -1): pytest.approx(means[0]), (1, -1): pytest.approx(means[1])}
    with pytest.raises(ValueError):
        movie.superres_mean(frames, offsets, 0)


@pytest.mark.parametrize("limit", [1 << 20, 0])
def test_blocks_that_meet_no_mask(spark, limit):
    """A block row none of whose values lies on a mask, beside one that meets it."""
    rows = [(0, "a", 3, 0, 0, 7.0), (0, "a", 100, 5, 5, 1.0), (0, "a", 200, 9, 9, 2.0), (0, "a", 300, 0, 0, 8.0)]
    rois = spark.createDataFrame([(0, 0, True, [(0, 0, 2.0)])], schemas.ROIS)
    got = movie.roi_traces(spark.createDataFrame(rows, schemas.MOVIE).coalesce(1), rois, limit).collect()
    assert sorted((r.frame, r.f) for r in got) == [(3, 7.0), (300, 8.0)]


def test_blocks_of_mixed_rows_come_together(spark, monkeypatch):
    # four planes in turn, packed by 8 tasks: each task has a few values of every block
    rows = [(i % 4, "a", i % 3, i % 40, i % 7, float(i)) for i in range(4000)]
    scattered = settle(blocks.to_blocks(spark.createDataFrame(rows, schemas.MOVIE).repartition(8)))
    distinct = scattered.select("plane", "block", "band").distinct().count()
    assert scattered.count() > 4 * distinct
    whole = blocks.gathered(scattered).collect()
    assert len(whole) == distinct

    def values(of):
        return sorted((b.plane, b.block, b.band, at, value) for b in of for at, value in zip(b["at"], b["value"]))

    assert values(whole) == values(scattered.collect()) and len(values(whole)) == len(rows)
    rois = spark.createDataFrame([(p, 0, True, [(0, 0, 1.0), (20, 3, 2.0)]) for p in range(4)], schemas.ROIS)
    met, fold = [], blocks._fold
    frame_type = type(scattered)
    plain = frame_type.mapInArrow

    def counted(self, function, *args, **kwargs):
        if function is fold:
            met.append(self.count())
        return plain(self, function, *args, **kwargs)

    monkeypatch.setattr(frame_type, "mapInArrow", counted)
    got = blocks.extract(scattered, blocks.band_weights(rois), 0)
    assert met == [8]  # a row for each plane and band with weights, not for each task
    everywhere = blocks.extract(scattered, blocks.band_weights(rois)).collect()
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, everywhere)) and everywhere
