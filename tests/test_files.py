import pathlib

import pytest
from pyspark.sql import functions as F

from planefold.functions import params, paths
from planefold.operators import files


def paths_of(spark, *names):
    return spark.createDataFrame([(n,) for n in names], "path string")


NAMES = {
    "plane_01_reg.tif": "plane_01",
    "plane_01.ome.tif": "plane",
    "a_b.c.tif": "a",
    "a.b_c.tif": "",
    "nounder.tif": "",
    "_x.tif": "",
    ".hidden_name": ".hidden",
    "x_y": "x",
}


def test_plane_names(spark):
    table = files.with_plane_names(paths_of(spark, *[f"/d.d/e_e/{n}" for n in NAMES], *NAMES))
    for row in table.collect():
        name = row.path.rsplit("/", 1)[-1]
        assert row.plane_name == NAMES[name]
        assert row.stem == pathlib.PurePosixPath(row.path).stem


def test_path_parts(spark):
    table = paths_of(spark, "/a/b/c.npy", "c", "/c")
    got = table.select(paths.file_name(F.col("path")), paths.parent(F.col("path"))).collect()
    assert [tuple(r) for r in got] == [("c.npy", "/a/b"), ("c", ""), ("c", "")]
    where = paths.artifact_path(F.lit("/out"), F.lit("p1"), "stat")
    assert table.select(where).first()[0] == "/out/p1/plane0/stat.npy"


@pytest.mark.parametrize(
    "names, root",
    [
        (["/a/b/ops.npy"], "/a/b"),
        (["/a/b/ops.npy", "/a/b/ops.npy"], "/a/b"),
        (["/a/b/x/ops.npy", "/a/b/y/ops.npy"], "/a/b"),
        (["/a/b/ops.npy", "/a/b-x/ops.npy", "/a/b/c/ops.npy"], "/a"),
        (["/a/bc/1", "/a/bd/1"], "/a"),
        (["/a/1", "/b/1"], "/"),
        (["a/1", "b/1"], ""),
        (["a/b/1", "a/1"], "a"),
    ],
)
def test_common_root(spark, names, root):
    assert [r.root for r in files.common_root(paths_of(spark, *names)).collect()] == [root]


def test_depth(spark):
    table = paths_of(spark, "/d/a.tif", "/d/s/b.tif", "/d/s/t/c.tif")
    assert [files.within_depth(table, "/d/", n).count() for n in (0, 1, 2, 3, None)] == [0, 1, 2, 3, 3]


def test_pending(spark):
    inputs = spark.createDataFrame([("p1",), ("p2",), ("p3",), ("p4",)], "plane_name string")
    found = [("p1", a) for a in ("ops", "stat", "iscell")] + [("p2", "ops"), ("p2", "stat"), ("p2", "stat")]
    found += [("p3", "ops"), ("p3", "stat"), ("p3", "F")]
    artifacts = spark.createDataFrame(found, "plane_name string, artifact string")
    assert {r[0] for r in files.pending_planes(inputs, artifacts).collect()} == {"p2", "p3", "p4"}


def test_params_precedence(spark):
    table = spark.createDataFrame(
        [("/d/m_1.tif", {"fs": "17", "save_folder": "meta"}), ("/d/m_2.tif", None)],
        "path string, metadata map<string,string>",
    )
    got = files.resolved_params(table, {"fs": "10", "tau": "1"}, "/out", metadata="metadata")
    rows = {r.path: r.params for r in got.collect()}
    shared = {"tau": "1", "save_path0": "/out"}
    assert rows["/d/m_1.tif"] == {**shared, "fs": "17", "save_folder": "m_1", "tiff_list": "m_1.tif"}
    assert rows["/d/m_2.tif"] == {**shared, "fs": "10", "save_folder": "m_2", "tiff_list": "m_2.tif"}
    named = files.resolved_params(table, {}, "/out", save_folder="all").first().params
    assert named["save_folder"] == "all"
    with pytest.raises(TypeError):
        files.resolved_params(table, {}, "/out", save_folder=3)


def test_missing_parameter_fails(spark):
    table = spark.createDataFrame([({"a": "1"},)], "params map<string,string>")
    assert table.select(params.optional(F.col("params"), "b")).first()[0] is None
    assert table.select(params.required(F.col("params"), "a")).first()[0] == "1"
    with pytest.raises(Exception, match="parameter 'b' is missing"):
        table.select(params.required(F.col("params"), "b")).collect()
