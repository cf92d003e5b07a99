import json
import os

import numpy as np
import pytest
from pyspark.sql import functions as F

from planefold import schemas
from planefold.sources import npy, sinks, tables


@pytest.fixture(scope="module")
def reader(spark):
    npy.register(spark)
    return lambda path, **options: spark.read.format("npy").options(path=str(path), **options).load()


@pytest.mark.parametrize("dtype", ["float32", "float64", "int16", "bool"])
@pytest.mark.parametrize("order", ["C", "F"])
def test_npy(reader, tmp_path, dtype, order):
    array = np.asarray(np.arange(35).reshape(7, 5) % 3, dtype=dtype, order=order)
    np.save(tmp_path / "F.npy", array)
    table = reader(tmp_path / "F.npy", partitionBytes=str(2 * 5 * array.itemsize))
    assert table.rdd.getNumPartitions() == 4
    rows = sorted(table.collect(), key=lambda r: r.roi)
    assert [r.roi for r in rows] == list(range(7))
    assert np.array_equal([r["values"] for r in rows], array.astype(float))


def test_npy_folder_and_shapes(reader, tmp_path):
    np.save(tmp_path / "a.npy", np.array([1.0, np.nan]))
    np.save(tmp_path / "b.npy", np.zeros((3, 0)))
    np.save(tmp_path / "c.npy", np.zeros((0, 4)))
    rows = reader(tmp_path).collect()
    assert sum(r.path.endswith("a.npy") for r in rows) == 2 and sum(r.path.endswith("b.npy") for r in rows) == 3
    assert all(r["values"] == [] for r in rows if r.path.endswith("b.npy")) and len(rows) == 5


def test_npy_refuses(reader, tmp_path):
    np.save(tmp_path / "o.npy", np.array([{"a": 1}], dtype=object), allow_pickle=True)
    np.save(tmp_path / "d.npy", np.zeros((2, 2, 2)))
    for name in ("o.npy", "d.npy", "none.npy"):
        with pytest.raises(Exception):
            reader(tmp_path / name).collect()


@pytest.mark.parametrize("dtype", ["float32", ">i2", "bool"])
@pytest.mark.parametrize("order", ["C", "F"])
def test_arrays_are_read_in_tasks(spark, tmp_path, monkeypatch, dtype, order):
    array = np.asarray(np.arange(35).reshape(7, 5) % 3, dtype=dtype, order=order)
    (tmp_path / "plane 1").mkdir()
    np.save(tmp_path / "plane 1" / "F.npy", array)
    np.save(tmp_path / "b.npy", np.zeros((3, 0)))
    np.save(tmp_path / "c.npy", np.zeros((0, 4)))
    np.save(tmp_path / "d.npy", np.array([1.0, np.nan]))

    driver = os.getpid()

    def in_tasks(real):
        def call(*args):
            assert os.getpid() != driver, "the driver opens a file"
            return real(*args)

        return call

    for name in ("_stream", "_head", "_open"):
        monkeypatch.setattr(npy, name, in_tasks(getattr(npy, name)))
    with pytest.raises(AssertionError):
        npy._stream(str(tmp_path / "b.npy"))
    table = npy.load_arrays(spark, tmp_path, partition_bytes=2 * 5 * array.itemsize)
    assert table.schema.simpleString() == "struct<path:string,roi:int,values:array<double>>"
    rows = sorted(table.collect(), key=lambda r: (r.path, r.roi))
    assert [(r.path.split("/")[-1], r.roi) for r in rows] == [("b.npy", i) for i in range(3)] + [("d.npy", 0), ("d.npy", 1)] + [("F.npy", i) for i in range(7)]
    assert np.array_equal([r["values"] for r in rows[5:]], array.astype(float)) and rows[0]["values"] == []
    some = npy.load_arrays(spark, tmp_path / "plane 1", rois=(2, 5), partition_bytes=2 * 5 * array.itemsize)
    assert sorted((r.roi, r["values"]) for r in some.collect()) == [(i, array[i].astype(float).tolist()) for i in (2, 3, 4)]
    assert npy.load_arrays(spark, tmp_path, rois=(9, None)).count() == 0


def test_row_windows_read_fewer_ranges(tmp_path):
    import pyarrow as pa

    np.save(tmp_path / "F.npy", np.zeros((100, 4)))
    names = pa.RecordBatch.from_pydict({"path": [str(tmp_path / "F.npy")]})

    def parts(*window):
        return [(r["start"], r["stop"]) for b in npy._row_ranges(10 * 4 * 8, *window)([names]) for r in b.to_pylist()]

    assert parts(0, None) == [(i, i + 10) for i in range(0, 100, 10)]
    assert parts(35, 50) == [(35, 45), (45, 50)] and parts(100, None) == [] and parts(95, 500) == [(95, 100)]


def test_arrays_refused(spark, tmp_path):
    np.save(tmp_path / "o.npy", np.array([{"a": 1}], dtype=object), allow_pickle=True)
    np.save(tmp_path / "d.npy", np.zeros((2, 2, 2)))
    for name in ("o.npy", "d.npy", "none.npy"):
        with pytest.raises(Exception):
            npy.load_arrays(spark, tmp_path / name).collect()
    for window in ((-1, 2), (3, 2)):
        with pytest.raises(ValueError):
            npy.load_arrays(spark, tmp_path, rois=window)


def plane_row(number):
    timing = {name: float(i) for i, name in enumerate(schemas.TIMING.fieldNames())}
    return {"plane": number, "ly": 4, "lx": 5, "timing": timing, "params": {"fs": "10"}, "save_path": f"/v/{number}"}


def test_load_planes(spark, tmp_path):
    text = "\n".join(json.dumps(plane_row(n)) for n in (1, 2))
    (tmp_path / "planes.json").write_text(text)
    planes = tables.load_planes(spark, tmp_path / "planes.json")
    assert planes.schema == schemas.PLANES and planes.count() == 2
    assert planes.first().timing.total_plane_runtime == 5.0
    planes.write.parquet(str(tmp_path / "planes"))
    assert tables.load_planes(spark, str(tmp_path / "planes")).count() == 2
    assert tables.load_planes(spark, planes) is planes
    for wrong in (None, ["a"], 3):
        with pytest.raises(TypeError):
            tables.load_planes(spark, wrong)


def test_tables_round_trip(spark, tmp_path):
    cases = [
        (tables.load_rois, schemas.ROIS, (0, 1, True, [(1, 2, 0.5)])),
        (tables.load_traces, schemas.TRACES, (0, 1, [1.0], [2.0], [3.0])),
        (tables.load_images, schemas.IMAGES, (0, "refImg", 1, 2, 3.0)),
        (tables.load_movie, schemas.MOVIE, (0, "a", 1, 2, 3, 4.0)),
    ]
    for number, (load, schema, row) in enumerate(cases):
        path = str(tmp_path / str(number))
        spark.createDataFrame([row], schema).write.parquet(path)
        table = load(spark, path)
        assert table.schema == schema and table.count() == 1


def test_discover(spark, tmp_path):
    (tmp_path / "s" / "t").mkdir(parents=True)
    for name in ("b.tif", "s/a.tiff", "s/t/c.tif", "s/note.txt"):
        (tmp_path / name).write_bytes(b"123")
    found = tables.discover_files(spark, tmp_path)
    assert [r.path for r in found.collect()] == [f"{tmp_path}/{n}" for n in ("b.tif", "s/a.tiff", "s/t/c.tif")]
    assert found.first().length == 3
    assert tables.discover_files(spark, tmp_path, max_depth=2).count() == 2
    assert tables.discover_files(spark, tmp_path / "b.tif", max_depth=1).count() == 1


def stats(spark, mean):
    return spark.createDataFrame([(1, 2, 3, mean, *[0.0] * 7, "x")], schemas.VOLUME_STATS)


def test_stats_are_kept_or_replaced(spark, tmp_path):
    path = sinks.write_stats(stats(spark, 1.0), tmp_path, overwrite=False)
    assert path == f"{tmp_path}/volume_stats"
    sinks.write_stats(stats(spark, 2.0), tmp_path, overwrite=False)
    assert tables.load_stats(spark, path, "mean_trace").first() == (1.0,)
    sinks.write_stats(stats(spark, 2.0), tmp_path)
    assert tables.load_stats(spark, path, "mean_trace").first() == (2.0,)
    assert tables.load_stats(spark, path).schema == schemas.VOLUME_STATS


def by_plane(spark, *rows):
    return spark.createDataFrame(rows, "plane int, v int")


def test_write_by_key(spark, tmp_path):
    out = str(tmp_path / "t")

    def now():
        return sorted(map(tuple, spark.read.parquet(out).select("plane", "v").collect()))

    sinks.write_by_key(by_plane(spark, (1, 1), (2, 2)), out, overwrite=False)
    sinks.write_by_key(by_plane(spark, (2, 9), (3, 3)), out, overwrite=False)
    assert now() == [(1, 1), (2, 2), (3, 3)]
    sinks.write_by_key(by_plane(spark, (2, 9)), out)
    assert now() == [(1, 1), (2, 9), (3, 3)]
    before = sorted((p, p.stat().st_mtime_ns) for p in (tmp_path / "t").rglob("*.parquet"))
    sinks.write_by_key(by_plane(spark, (1, 7), (2, 7), (3, 7)), out, overwrite=False)
    assert before == sorted((p, p.stat().st_mtime_ns) for p in (tmp_path / "t").rglob("*.parquet"))


def test_text_keys_are_kept(spark, tmp_path):
    out = str(tmp_path / "t")
    sinks.write_by_key(spark.createDataFrame([("7", 1), ("", 2)], "name string, v int"), out, ["name"])
    sinks.write_by_key(spark.createDataFrame([("7", 8), ("abc", 3), ("", 9), (None, 9)], "name string, v int"), out, ["name"], overwrite=False)
    assert sorted(r.v for r in spark.read.parquet(out).collect()) == [1, 2, 3]


def test_empty_plane_name_is_kept(spark, tmp_path):
    files = spark.createDataFrame([("/d/plane.tif",), ("/d/plane_02_reg.tif",)], "path string")
    path = sinks.write_by_plane_name(files, tmp_path / "out")
    assert {r.plane_name for r in sinks.load_by_plane_name(spark, path, "path string").collect()} == {"", "plane_02"}


def test_write_by_plane_name(spark, tmp_path):
    files = spark.createDataFrame([("/d/plane_01_reg.tif",), ("/d/plane_02_reg.tif",)], "path string")
    sinks.write_by_plane_name(files, tmp_path / "out")
    assert {p.name for p in (tmp_path / "out").glob("plane_name=*")} == {"plane_name=plane_01", "plane_name=plane_02"}


def test_bucketed_tables_join_without_a_shuffle(spark, tmp_path):
    from planefold.operators import rois
    from workload import tables as model

    sources = [model.traces(spark, "/root/testdata/sf0.001"), model.some_masks(spark, "/root/testdata/sf0.001")]
    sources.append(sources[0].select("plane", "roi", (F.col("roi") % 2 == 0).alias("iscell")))
    names = [f"bucketed_{c}_{tmp_path.name}" for c in ("traces", "masks", "flags")]

    def joined(traces, masks, flags):
        left = [t.hint("merge") for t in (masks, flags)]
        return rois.roi_features(traces, masks), traces.join(left[0], ["plane", "roi"], "left").join(left[1], ["plane", "roi"], "left")

    try:
        sides = [sinks.write_bucketed(t, n, tmp_path / n, 8) for t, n in zip(sources, names)]
        for bucketed, plain in zip(joined(*sides), joined(*sources)):
            rows = bucketed.collect()
            assert "Exchange" not in bucketed._jdf.queryExecution().executedPlan().toString()
            assert "Exchange" in plain._jdf.queryExecution().executedPlan().toString()
            assert sorted(map(repr, rows)) == sorted(map(repr, plain.collect()))
        kept = sinks.write_bucketed(sources[0].limit(1), names[0], tmp_path / names[0], 8, overwrite=False)
        assert kept.count() == sources[0].count()
        with pytest.raises(ValueError):
            sinks.write_bucketed(sources[0], names[0], tmp_path / names[0], 0)
    finally:
        for name in names:
            spark.sql(f"DROP TABLE IF EXISTS {name}")


def test_many_folders_are_made_by_many_tasks(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(sinks, "FOLDERS", 5)
    monkeypatch.setattr(sinks, "FOLDER_ROWS", 20)
    keys = [None if i == 7 else f"k{i}" for i in range(60)] + ["hot"] * 200
    rows = list(enumerate(keys))
    sinks.write_by_key(spark.createDataFrame(rows, "v long, name string"), tmp_path / "out", ["name"])
    files = list((tmp_path / "out").rglob("*.parquet"))
    assert len({f.name.split("-")[1] for f in files}) > 5
    assert len({f.parent for f in files}) == 61 and len([f for f in files if f.parent.name == "name=hot"]) > 1
    assert sorted(map(str, spark.read.parquet(str(tmp_path / "out")).select("v", "name").collect())) == sorted(
        str(r) for r in spark.createDataFrame(rows, "v long, name string").collect()
    )
