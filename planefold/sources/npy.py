"""Data source for numeric array files (``spark.read.format("npy")``).

Each file is split into row ranges, one input partition each, so a large array
is read by many tasks; a task maps only its own rows. Files must be readable
under the same path on every executor. Object arrays are refused: nothing is
unpickled.

``load_arrays`` gives the same rows for many files or a shared store: Spark lists the
files, tasks read their headers, and further tasks read the row ranges.
"""

from __future__ import annotations

import glob
import os
import re
from collections.abc import Iterator
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

from planefold.session import send_code

PARTITION_BYTES = 64 << 20
BATCH_BYTES = 8 << 20


@dataclass
class RowRange(InputPartition):
    path: str
    start: int
    stop: int


def _open(path: str):
    import numpy as np

    array = np.load(path, mmap_mode="r", allow_pickle=False)
    if array.dtype.kind not in "biuf":
        raise ValueError(f"{path}: only numeric arrays are supported, not {array.dtype}")
    if array.ndim not in (1, 2):
        raise ValueError(f"{path}: expected one or two dimensions, not {array.ndim}")
    return array if array.ndim == 2 else array[:, np.newaxis]


class NpyReader(DataSourceReader):
    def __init__(self, options: dict[str, str]):
        path = options.get("path")
        if not path:
            raise ValueError("option 'path' is missing")
        found = [os.path.join(path, "*.npy")] if os.path.isdir(path) else [path]
        self.files = sorted(name for pattern in found for name in glob.glob(pattern))
        if not self.files:
            raise FileNotFoundError(f"no array file matches {path}")
        self.partition_bytes = int(options.get("partitionbytes", PARTITION_BYTES))

    def partitions(self) -> list[RowRange]:
        ranges = []
        for path in self.files:
            array = _open(path)
            rows, width = array.shape
            step = max(1, self.partition_bytes // max(1, width * array.dtype.itemsize))
            ranges += [RowRange(path, at, min(at + step, rows)) for at in range(0, rows, step)]
        return ranges or [RowRange(self.files[0], 0, 0)]

    def read(self, partition: RowRange):
        import numpy as np
        import pyarrow as pa

        array = _open(partition.path)
        width = array.shape[1]
        step = max(1, BATCH_BYTES // max(1, width * 8))
        for at in range(partition.start, partition.stop, step):
            block = np.ascontiguousarray(array[at : min(at + step, partition.stop)], dtype="float64")
            n = len(block)
            offsets = pa.array(np.arange(n + 1, dtype="int32") * np.int32(width))
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array([partition.path] * n, pa.string()),
                    pa.array(np.arange(at, at + n, dtype="int32")),
                    pa.ListArray.from_arrays(offsets, pa.array(block.reshape(-1))),
                ],
                names=["path", "roi", "values"],
            )


class NpySource(DataSource):
    """Rows ``(path, roi, values)``; ``path`` may be a file, a folder or a glob."""

    @classmethod
    def name(cls) -> str:
        return "npy"

    def schema(self) -> str:
        return "path string, roi int, values array<double>"

    def reader(self, schema) -> NpyReader:
        return NpyReader(self.options)


def register(spark: SparkSession) -> None:
    spark.dataSource.register(NpySource)


def _stream(path: str):
    """A file of a local or shared store, open for reading at any place."""
    from pyarrow import fs

    store, name = fs.FileSystem.from_uri(re.sub("^s3[an]:", "s3:", re.sub("^file:/+", "/", path)))
    return store.open_input_file(name)


def _head(file, path: str) -> tuple:
    """Rows, width, type and order of an array, and where its values begin."""
    from numpy.lib import format as npy_format

    version = npy_format.read_magic(file)
    read = npy_format.read_array_header_1_0 if version == (1, 0) else npy_format.read_array_header_2_0
    shape, by_column, dtype = read(file)
    if dtype.kind not in "biuf":
        raise ValueError(f"{path}: only numeric arrays are supported, not {dtype}")
    if len(shape) not in (1, 2):
        raise ValueError(f"{path}: expected one or two dimensions, not {len(shape)}")
    return shape[0], shape[1] if len(shape) == 2 else 1, dtype, by_column, file.tell()


def _row_ranges(partition_bytes: int, first: int, last: int | None):
    """The parts of each file's rows ``[first, last)`` that one task reads."""

    def run(batches: Iterator) -> Iterator:
        import pyarrow as pa

        for batch in batches:
            for path in batch.column("path").to_pylist():
                with _stream(path) as file:
                    rows, width, dtype, _, _ = _head(file, path)
                step = max(1, partition_bytes // max(1, width * dtype.itemsize))
                starts = list(range(first, rows if last is None else min(rows, last), step))
                stops = [min(at + step, rows, rows if last is None else last) for at in starts]
                yield pa.RecordBatch.from_pydict(
                    {"path": pa.array([path] * len(starts), pa.string()), "start": pa.array(starts, pa.int64()), "stop": pa.array(stops, pa.int64())}
                )

    return run


def _rows_of(batches: Iterator) -> Iterator:
    """``path, roi, values`` of row ranges; only their bytes are read."""
    import numpy as np
    import pyarrow as pa

    for batch in batches:
        for part in batch.to_pylist():
            with _stream(part["path"]) as file:
                rows, width, dtype, by_column, begin = _head(file, part["path"])
                step = max(1, BATCH_BYTES // max(1, width * 8))
                for at in range(part["start"], part["stop"], step):
                    n = min(at + step, part["stop"]) - at
                    if by_column:
                        block = np.empty((n, width))
                        for column in range(width):
                            file.seek(begin + (column * rows + at) * dtype.itemsize)
                            block[:, column] = np.frombuffer(file.read(n * dtype.itemsize), dtype)
                    else:
                        file.seek(begin + at * width * dtype.itemsize)
                        block = np.frombuffer(file.read(n * width * dtype.itemsize), dtype).astype("float64")
                    offsets = pa.array(np.arange(n + 1, dtype="int32") * np.int32(width))
                    values = pa.ListArray.from_arrays(offsets, pa.array(block.reshape(-1)))
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([part["path"]] * n, pa.string()), pa.array(np.arange(at, at + n, dtype="int32")), values],
                        names=["path", "roi", "values"],
                    )


def load_arrays(
    spark: SparkSession, path: str, pattern: str = "*.npy", rois: tuple[int, int | None] = (0, None), partition_bytes: int = PARTITION_BYTES
) -> DataFrame:
    """``path, roi, values`` of all arrays below ``path``, of the rows ``rois`` only (end exclusive).

    The driver opens no file: listing is Spark's, of any store it knows, and headers
    and values are read in tasks from stores that pyarrow knows. A row window reads only
    the bytes of its rows. An array without rows has no row here; one of no width has empty arrays.
    """
    first, last = rois
    if first < 0 or (last is not None and last < first):
        raise ValueError(f"rows from {first} to {last}")
    send_code(spark)
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", pattern).load(str(path))
    files = files.select(F.regexp_replace("path", "^file:/+", "/").alias("path"))
    parts = files.mapInArrow(_row_ranges(partition_bytes, first, last), "path string, start long, stop long")
    # a number of partitions is kept as it is: the ranges are few bytes, what they stand for is not
    spread = parts.repartition(int(spark.conf.get("spark.sql.shuffle.partitions")), "path", "start")
    return spread.mapInArrow(_rows_of, "path string, roi int, values array<double>")
