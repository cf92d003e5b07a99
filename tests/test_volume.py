import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from planefold import schemas
from planefold.constants import STATS_TABLE
from planefold.operators import volume
from planefold.plans.volume import PLANE_OUTPUTS, Recording, post_process, run_plane, run_volume

NAN = float("nan")


@pytest.fixture(scope="module")
def recording(spark):
    timing = (1.5, 2.0, 3.0, 4.0, 5.0, 15.5)
    planes = [(p, f"plane_{p}", "", "x" * 300, 3, 3, timing if p == 1 else (0.1,) * 6, {}) for p in (1, 2)]
    rois = [(p, r, p == 1 and r != 1, [(r, r, 1.0 + r)]) for p in (1, 2) for r in range(3)]
    traces = [(p, r, [1.0 * r, 2.0, NAN if p == 2 else 4.0], [0.0, 1.0, 2.0], [0.0, 1.0, 0.0]) for p in (1, 2) for r in range(3)]
    images = [(p, k, 0, 0, 1.0) for p in (1, 2) for k in ("refImg", "max_proj", "meanImg", "meanImgE")]
    return Recording(
        spark.createDataFrame(planes, schemas.PLANES),
        spark.createDataFrame(rois, schemas.ROIS),
        spark.createDataFrame(traces, schemas.TRACES),
        spark.createDataFrame(images, schemas.IMAGES),
    )


@pytest.fixture(scope="module")
def stats(recording):
    return volume.volume_stats(recording.rois, recording.traces, recording.planes)


def test_stats(stats):
    assert stats.schema.fieldNames() == schemas.VOLUME_STATS.fieldNames()
    assert [f.dataType for f in stats.schema] == [f.dataType for f in schemas.VOLUME_STATS]
    one, two = stats.orderBy("plane").collect()
    values = [v for r in range(3) for v in (r, 2, 4)]
    assert (one.accepted, one.rejected) == (2, 1)
    assert (one.mean_trace, one.std_trace) == (pytest.approx(np.mean(values)), pytest.approx(np.std(values)))
    assert (two.accepted, two.rejected) == (0, 3)
    assert math.isnan(two.mean_trace) and math.isnan(two.std_trace)
    assert len(one.filepath) > 255 and one.filepath.endswith("/ops.npy") and one.total_plane_runtime == 15.5


def test_stats_of_cells_only(recording):
    row = volume.volume_stats(recording.rois, recording.traces, recording.planes, cells_only=True).collect()
    row = {r.plane: r for r in row}
    assert set(row) == {1, 2}
    assert row[1].mean_trace == pytest.approx(np.mean([0, 2, 4, 2, 2, 4]))
    assert math.isnan(row[2].mean_trace) and (row[2].accepted, row[2].rejected) == (0, 3)


def test_planes_without_rois_or_times_stay(recording):
    more = recording.planes.limit(1).withColumn("plane", F.lit(7))
    rows = volume.volume_stats(recording.rois, recording.traces, recording.planes.filter("plane = 1").unionByName(more)).collect()
    row = {r.plane: r for r in rows}
    assert set(row) == {1, 2, 7}
    assert (row[7].accepted, row[7].rejected) == (0, 0) and math.isnan(row[7].mean_trace)
    assert row[2].rejected == 3 and math.isnan(row[2].total_plane_runtime) and row[2].filepath is None


def test_count_bars(stats):
    one, two = volume.count_bars(stats).orderBy("plane").collect()
    assert tuple(one)[1:] == (2, 1, 2, 1.0, 2.5, "2", "1")
    assert tuple(two)[1:] == (0, 3, 0, None, 1.5, None, "3")


def test_time_stack(stats):
    rows = volume.time_stack(stats).collect()
    one = [tuple(r)[1:] for r in rows if r.plane == 1]
    assert one == [
        ("registration", 0.0, 1.5, None, None),
        ("detection", 1.5, 3.5, None, None),
        ("extraction", 3.5, 6.5, "15", 8.5),
    ]
    assert all(r.label is None for r in rows if r.plane == 2)
    assert volume.time_stack(stats, all_steps=True).count() == 10


def test_signal_bounds(stats):
    row = volume.signal_bounds(stats).filter("plane = 1").first()
    assert (row.lower, row.upper) == (row.mean_trace - row.std_trace, row.mean_trace + row.std_trace)


def written(path):
    return sorted((p, p.stat().st_mtime_ns) for p in path.rglob("*.parquet"))


def test_run_volume(spark, recording, tmp_path):
    paths = run_volume(spark, recording, str(tmp_path))
    assert len(paths) == 11
    counts = {name: spark.read.parquet(path).count() for name, path in paths.items()}
    assert counts == {
        "registration": 8, "max_projection": 2, "segmentation": 6, "traces": 18, STATS_TABLE: 2, "acc_rej_bar": 2,
        "mean_volume_signal": 2, "execution_time": 6, "max_cell_noncell": 6, "fluorescence": 6, "fluorescence_grid": 2,
    }
    before = [written(tmp_path / name) for name in PLANE_OUTPUTS]
    run_volume(spark, recording, str(tmp_path))
    assert before == [written(tmp_path / name) for name in PLANE_OUTPUTS]
    post_process(recording, str(tmp_path))
    assert all(a != b for a, b in zip(before, [written(tmp_path / name) for name in PLANE_OUTPUTS]))


def test_planes_are_added(spark, recording, tmp_path):
    run_plane(recording, 1, str(tmp_path))
    first = written(tmp_path / "traces" / "plane=1")
    post_process(recording, str(tmp_path), overwrite=False)
    assert written(tmp_path / "traces" / "plane=1") == first
    assert spark.read.parquet(str(tmp_path / "traces")).select("plane").distinct().count() == 2


def test_empty_recording_is_refused(spark, recording, tmp_path):
    with pytest.raises(ValueError):
        run_plane(recording, 99, str(tmp_path))


def test_unset_checkpoint_folder_needs_a_local_master(spark):
    from planefold.session import shared_folder

    class Context:
        master = "yarn"
        def getConf(self): return {}
        def getCheckpointDir(self): return None

    class Session:
        sparkContext = Context()
        conf = type("Conf", (), {"get": staticmethod(lambda key, default: default)})

    with pytest.raises(RuntimeError):
        shared_folder(Session())
    assert shared_folder(spark)
