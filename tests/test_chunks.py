"""Chunked traces, merged images and the run manifest."""

import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from planefold import schemas
from planefold.operators import chunks, images, rois, traces
from planefold.plans import volume as job
from planefold.session import settle
from planefold.sources import manifest


def rows_of(df, *columns):
    return sorted((tuple(r[c] for c in columns) for r in df.collect()), key=repr)


@pytest.fixture(scope="module")
def sample(spark):
    pick = random.Random(4)
    rows = []
    for roi, n in enumerate([0, 1, 15, 16, 17, 64, 1000]):
        f = [pick.uniform(-3, 900) for _ in range(n)]
        rows.append((0, roi, f, [v * 0.5 + pick.random() for v in f], f))
    rows.append((1, 0, [2.0] * 40, [1.0] * 40, [0.0] * 40))
    rows.append((1, 1, [1.0, float("nan"), 3.0] * 9, [1.0, 5.0, 2.0] * 9, [0.0] * 27))
    return spark.createDataFrame(rows, schemas.TRACES)


def close(a, b):
    return a == b or (a is None) == (b is None) and (math.isnan(a) and math.isnan(b) or a == pytest.approx(b, rel=1e-6, abs=1e-9))


@pytest.mark.parametrize("size", [1, 16, 4096])
def test_chunks_equal_whole_rows(sample, size, monkeypatch):
    monkeypatch.setattr(chunks, "FAN", 3)
    parts = chunks.to_chunks(sample, size, ["f", "fneu"])
    for mine, theirs, columns in (
        (chunks.roi_activity(parts), traces.roi_activity(sample), ["activity"]),
        (chunks.signal_features(parts), rois.signal_features(sample), ["skewness", "variance", "corr"]),
    ):
        got, want = (rows_of(x, "plane", "roi", *columns) for x in (mine, theirs))
        assert [r[:2] for r in got] == [r[:2] for r in want]
        for a, b in zip(got, want):
            assert all(close(x, y) for x, y in zip(a[2:], b[2:])), (a, b)
    z = {(r.plane, r.roi): r.z for r in traces.zscored(traces.trace_window(sample)).collect()}
    for row in chunks.zscored(parts).collect():
        own = z[row.plane, row.roi][row.chunk * size : (row.chunk + 1) * size]
        assert len(own) == len(row.z) and all(close(a, b) for a, b in zip(row.z, own))


def test_volume_signal_of_chunks(sample):
    values = {p: [v for r in sample.collect() if r.plane == p for v in r.f] for p in (0, 1)}
    got = {r.plane: r for r in chunks.volume_signal(chunks.to_chunks(sample, 16)).collect()}
    assert got[0].mean_trace == pytest.approx(np.mean(values[0])) and got[0].std_trace == pytest.approx(np.std(values[0]))
    assert math.isnan(got[1].mean_trace) and math.isnan(got[1].std_trace)


def test_results_do_not_depend_on_partitions(spark, sample):
    parts = settle(chunks.to_chunks(sample, 7, ["f", "fneu"]))
    seen = set()
    for n in (1, 8, 64):
        dealt = parts.repartition(n)
        states = rows_of(chunks.roi_states(dealt, "f", "fneu"), "plane", "roi", "state")
        seen.add(repr((states, rows_of(chunks.volume_signal(dealt), "plane", "mean_trace", "std_trace"))))
    assert len(seen) == 1


def test_a_very_long_trace(spark):
    n, size = 10**7, 1 << 16
    ids = spark.range(0, n // size + 1).select(F.lit(0).alias("plane"), F.lit(0).alias("roi"), F.col("id").alias("chunk"))
    first = F.col("chunk") * size
    values = F.transform(F.sequence(first, F.least(first + size, F.lit(n)) - 1), lambda i: (i % 1000).cast("double") + 1e6)
    (row,) = chunks.roi_states(ids.select("plane", "roi", "chunk", values.alias("f"))).collect()
    assert row.state["n"] == n and row.state["mean"] == pytest.approx(1e6 + 499.5, rel=1e-12)
    assert row.state["m2"] / n == pytest.approx((1000**2 - 1) / 12, rel=1e-9)


def test_chunks_of_long_traces(spark):
    long = spark.createDataFrame([(0, 0, t, float(t), None if t == 3 else 1.0) for t in (0, 1, 3, 5, 9)], "plane int, roi int, frame long, f double, fneu double")
    got = rows_of(chunks.long_to_chunks(long, 4, ["f", "fneu"]), "chunk", "frames", "f", "fneu")
    assert got[:1] == [(0, [0, 1, 3], [0.0, 1.0, 3.0], got[0][3])] and math.isnan(got[0][3][2])
    assert got[1:] == [(1, [5], [5.0], [1.0]), (2, [9], [9.0], [1.0])]



def movie_of(spark, rows):
    return spark.createDataFrame(rows, schemas.MOVIE)


def test_images_merged_file_by_file(spark, tmp_path):
    pick = random.Random(2)
    rows = [(p, f, t, y, x, float(pick.randrange(50))) for p in (0, 1) for f in "abc" for t in range(3) for y in range(3) for x in range(2) if (p, f) != (1, "c")]
    root = str(tmp_path)
    first = movie_of(spark, [r for r in rows if r[1] == "a"])
    assert images.add_files(first, root) == 2 and images.add_files(first, root) == 0
    assert images.add_files(movie_of(spark, rows), root) == 3  # b of both planes, c of one; a is there
    whole = images.image_state(movie_of(spark, rows))
    columns = ("plane", "y", "x", "n", "total", "top")
    assert rows_of(images.stored_state(spark, root), *columns) == rows_of(whole, *columns)
    empty = images.image_state(movie_of(spark, [(0, "a", 0, 0, 0, None)]))
    assert [r.value for r in images.mean_image(empty).collect()] == [None]


def made(spark, root, run, planes, value, digest):
    rows = spark.createDataFrame([(p, value) for p in planes if p != 9], "plane int, v int")
    names = spark.createDataFrame([(p, digest) for p in planes], "plane int, digest string")
    return manifest.write_rows(rows, root, "out", run, names)


def test_manifest_keeps_what_it_names(spark, tmp_path):
    root = str(tmp_path)
    with pytest.raises(FileNotFoundError):
        manifest.read_rows(spark, root, "out")
    assert manifest.commit(made(spark, root, "r1", [1, 2, 9], 10, "d"), root) == 1
    assert rows_of(manifest.read_rows(spark, root, "out"), "plane", "v") == [(1, 10), (2, 10)]
    wanted = spark.createDataFrame([(1, "out", "d"), (2, "out", "e"), (9, "out", "d"), (3, "out", "d")], "plane int, output string, digest string")
    assert rows_of(manifest.pending(wanted, root), "plane") == [(2,), (3,)]
    made(spark, root, "r2", [2, 3], 20, "e")  # a run that fails before it commits
    assert rows_of(manifest.read_rows(spark, root, "out"), "plane", "v") == [(1, 10), (2, 10)]
    assert manifest.commit(made(spark, root, "r3", [2], 30, "e"), root) == 2
    assert rows_of(manifest.read_rows(spark, root, "out"), "plane", "v") == [(1, 10), (2, 30)]


def test_manifest_gives_way_to_another_commit(spark, tmp_path, monkeypatch):
    root = str(tmp_path)
    manifest.commit(made(spark, root, "r1", [1], 10, "d"), root)
    real, calls = manifest._version, []

    def late(spark_, root_):
        version = real(spark_, root_)
        calls.append(version)
        return 0 if len(calls) == 1 else version

    monkeypatch.setattr(manifest, "_version", late)
    manifest.commit(made(spark, root, "r2", [2], 20, "d"), root)
    monkeypatch.setattr(manifest, "_version", real)
    assert rows_of(manifest.read_rows(spark, root, "out"), "plane", "v") == [(1, 10), (2, 20)]


@pytest.fixture(scope="module")
def recording(spark, sample):
    timing = tuple(float(i) for i in range(6))
    planes = [(p, f"p{p}", f"/in/p{p}_x.tif", f"{{}}/plane{p}", 4, 4, timing, {}) for p in (0, 1)]
    masks = [(r.plane, r.roi, r.roi % 2 == 0, [(0, r.roi % 4, 1.0), (1, 1, 2.0)]) for r in sample.collect()]
    images_ = [(p, kind, 0, 0, 1.0) for p in (0, 1) for kind in ("refImg", "max_proj")]
    return planes, spark.createDataFrame(masks, schemas.ROIS), sample.filter("size(f) > 0"), spark.createDataFrame(images_, schemas.IMAGES)


def test_job_redoes_only_what_changed(spark, recording, tmp_path, monkeypatch):
    planes, masks, sample, images_ = recording
    planes = spark.createDataFrame([(*p[:3], p[3].format(tmp_path), *p[4:]) for p in planes], schemas.PLANES)
    whole = job.Recording(planes, masks, sample, images_)
    files = spark.createDataFrame([(0, "/in/p0_x.tif", {"fs": "7"}), (1, "/in/p1_x.tif", {"fs": "7"})], "plane int, path string, metadata map<string,string>")
    out = f"{tmp_path}/results"

    def run(files_):
        return job.run_recording(spark, files_, whole, {"tau": "1"}, out, metadata="metadata")

    first = run(files)
    names = {*job.PLANE_OUTPUTS, *job.STATS_OUTPUTS, *job.VOLUME_OUTPUTS, "volume_stats"}
    assert first == {name: 2 if name in job.PLANE_OUTPUTS else 1 for name in names}
    before = rows_of(job.read_output(spark, out, "segmentation"), "plane", "y", "x", "label_all")
    assert (tmp_path / "volume_stats").is_dir()
    assert run(files) == {}
    changed = files.withColumn("metadata", F.when(F.col("plane") == 1, F.create_map(F.lit("fs"), F.lit("8"))).otherwise(F.col("metadata")))
    monkeypatch.setattr(manifest, "commit", lambda *_: (_ for _ in ()).throw(RuntimeError("lost")))
    with pytest.raises(RuntimeError):
        run(changed)
    monkeypatch.undo()
    assert rows_of(job.read_output(spark, out, "segmentation"), "plane", "y", "x", "label_all") == before
    assert run(changed) == {name: 1 for name in names}
    assert rows_of(job.read_output(spark, out, "segmentation"), "plane", "y", "x", "label_all") == before
    assert run(changed) == {}


def test_job_writes_no_plane_without_a_file(spark, recording, tmp_path):
    planes, masks, sample, images_ = recording
    planes = spark.createDataFrame([(*p[:3], p[3].format(tmp_path), *p[4:]) for p in planes], schemas.PLANES)
    others = spark.range(2, 500).selectExpr("cast(id as int) plane", "'refImg' kind", "0 y", "0 x", "1.0D value")
    more = images_.unionByName(others).unionByName(images_.filter("plane = 1").withColumn("plane", F.lit(None).cast("int")))
    whole = job.Recording(planes, masks, sample, more)
    files = spark.createDataFrame([(p, f"/in/p{p}.tif", {"fs": "7"}) for p in (0, 1, None)], "plane int, path string, metadata map<string,string>")
    out = f"{tmp_path}/results"
    refs = [(0, 1.0), (1, 1.0), (None, 1.0)]
    # each of them again with other parameters, the one without a number too
    for redone in ("plane is not null", "plane = 1", "plane is null"):
        listed = files.withColumn("metadata", F.when(F.expr(redone), F.create_map(F.lit("fs"), F.lit(redone))).otherwise(F.col("metadata")))
        job.run_recording(spark, listed, whole, {"tau": "1"}, out, metadata="metadata")
        made = job.read_output(spark, out, "registration").filter("kind = 'refImg'")
        assert rows_of(made, "plane", "value") == sorted(refs, key=repr)
    written = spark.read.parquet(f"{out}/registration")
    assert {r.plane for r in written.collect()} == {0, 1, None}


def test_spread_deals_one_file_to_many_tasks(spark, tmp_path):
    ids = spark.range(20000).selectExpr("cast(nullif(id % 3, 2) as int) plane", "cast(id as int) roi", "id % 2 = 0 iscell")
    pixels = ids.withColumn("pixels", F.expr("transform(sequence(1, 64), i -> (0 as y, i as x, cast(hash(roi, i) as float) as lam))"))
    values = ids.select("plane", "roi", *[F.expr(f"transform(sequence(1, 64), i -> cast(hash(roi, i) as float)) {c}") for c in ("f", "fneu", "spks")])
    tables = []
    for name, table in (("rois", pixels), ("traces", values)):
        table.coalesce(1).write.parquet(f"{tmp_path}/{name}")
        tables.append(spark.read.parquet(f"{tmp_path}/{name}"))
    spread = job.Recording(ids, *tables, ids).spread()
    for before, after in zip(tables, (spread.rois, spread.traces)):
        assert before.select(F.spark_partition_id()).distinct().count() == 1
        assert after.select(F.spark_partition_id()).distinct().count() > 3
        assert after.exceptAll(before).isEmpty() and before.exceptAll(after).isEmpty()


def test_files_do_not_grow_with_planes(spark, tmp_path):
    root = str(tmp_path)
    rows = spark.range(400).selectExpr("cast(nullif(id, 7) as int) plane", "id * 2 v")
    planes = rows.selectExpr("plane", "'' digest")
    manifest.commit(manifest.write_rows(rows, root, "out", manifest.new_run(), planes), root)
    again = rows.filter("plane < 3").selectExpr("plane", "v + 1 v")
    manifest.commit(manifest.write_rows(again, root, "out", manifest.new_run(), planes.filter("plane < 3")), root)
    assert len(list((tmp_path / "out").rglob("*.parquet"))) < 20
    got = {(r.plane, r.v) for r in manifest.read_rows(spark, root, "out").collect()}
    assert got == {(None if i == 7 else i, 2 * i + (i < 3)) for i in range(400)}


def test_merge_tasks_grow_with_states(spark, monkeypatch):
    monkeypatch.setattr(images, "MERGE_ROWS", 50)
    rows = spark.range(600).selectExpr("0 plane", "cast(id % 300 as int) y", "0 x", "cast(id as double) value")
    parts = [images.image_state(rows.filter("id < 450")), images.image_state(rows.filter("id >= 450"))]
    merged = images.merge_states(*parts)
    assert merged.rdd.getNumPartitions() == 450 // 50 + 1
    assert sorted((r.y, r.n, r.total, r.top) for r in merged.collect()) == [(y, 2, 2.0 * y + 300, y + 300.0) for y in range(300)]
