"""Table schemas. Positions (plane, ROI, frame, pixel) are explicit key columns."""

from pyspark.sql import types as T

from planefold.constants import TIMING_FIELDS

TIMING = T.StructType([T.StructField(name, T.DoubleType()) for name in TIMING_FIELDS])

PLANES = T.StructType(
    [
        T.StructField("plane", T.IntegerType()),
        T.StructField("plane_name", T.StringType()),
        T.StructField("source_path", T.StringType()),
        T.StructField("save_path", T.StringType()),
        T.StructField("ly", T.IntegerType()),
        T.StructField("lx", T.IntegerType()),
        T.StructField("timing", TIMING),
        T.StructField("params", T.MapType(T.StringType(), T.StringType())),
    ]
)

PIXEL = T.StructType(
    [
        T.StructField("y", T.IntegerType()),
        T.StructField("x", T.IntegerType()),
        T.StructField("lam", T.FloatType()),
    ]
)

ROIS = T.StructType(
    [
        T.StructField("plane", T.IntegerType()),
        T.StructField("roi", T.IntegerType()),
        T.StructField("iscell", T.BooleanType()),
        T.StructField("pixels", T.ArrayType(PIXEL)),
    ]
)

TRACES = T.StructType(
    [
        T.StructField("plane", T.IntegerType()),
        T.StructField("roi", T.IntegerType()),
        T.StructField("f", T.ArrayType(T.FloatType())),
        T.StructField("fneu", T.ArrayType(T.FloatType())),
        T.StructField("spks", T.ArrayType(T.FloatType())),
    ]
)

IMAGES = T.StructType(
    [
        T.StructField("plane", T.IntegerType()),
        T.StructField("kind", T.StringType()),
        T.StructField("y", T.IntegerType()),
        T.StructField("x", T.IntegerType()),
        T.StructField("value", T.DoubleType()),
    ]
)

MOVIE = T.StructType(
    [
        T.StructField("plane", T.IntegerType()),
        T.StructField("file", T.StringType()),
        T.StructField("frame", T.LongType()),
        T.StructField("y", T.IntegerType()),
        T.StructField("x", T.IntegerType()),
        T.StructField("value", T.DoubleType()),
    ]
)

OFFSETS = T.StructType(
    [
        T.StructField("plane", T.IntegerType()),
        T.StructField("frame", T.LongType()),
        T.StructField("dy", T.DoubleType()),
        T.StructField("dx", T.DoubleType()),
    ]
)

ARTIFACT_LIST = T.StructType(
    [
        T.StructField("plane_name", T.StringType()),
        T.StructField("artifact", T.StringType()),
    ]
)

VOLUME_STATS = T.StructType(
    [
        T.StructField("plane", T.IntegerType()),
        T.StructField("accepted", T.IntegerType()),
        T.StructField("rejected", T.IntegerType()),
        T.StructField("mean_trace", T.DoubleType()),
        T.StructField("std_trace", T.DoubleType()),
    ]
    + [T.StructField(name, T.DoubleType()) for name in TIMING_FIELDS]
    + [T.StructField("filepath", T.StringType())]
)
