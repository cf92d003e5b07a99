"""Model tables derived from the test tables, always from every row.

Planes of the pixel tables hold 500 orders each, so their number grows with the
data while the crowd on one pixel does not.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from planefold.operators.ordering import numbered
from planefold.session import settle

ORDERS_PER_PLANE = 500
SIDE = 64
RING = (1.5, 3.0)
IMAGE_KINDS = {"refImg": "ref", "meanImgE": "enh", "other": "enh"}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def traces(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Embeddings as traces: 64 frames per ROI, plane = label."""
    f = F.col("embedding")
    return table(spark, sf_dir, "embeddings").select(
        F.col("label").alias("plane"),
        F.col("vec_id").cast("int").alias("roi"),
        f.alias("f"),
        F.reverse(f).alias("fneu"),
        F.transform(f, lambda v: F.greatest(v, F.lit(0.0).cast("float"))).alias("spks"),
    )


def trace_flags(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Cell flags of the trace ROIs: labelled of good quality."""
    quality = table(spark, sf_dir, "labels").select(F.col("doc_id").alias("vec_id"), "quality")
    return (
        table(spark, sf_dir, "embeddings")
        .select("vec_id", "label")
        .join(quality, "vec_id", "left")
        .select(
            F.col("label").alias("plane"),
            F.col("vec_id").cast("int").alias("roi"),
            (F.coalesce("quality", F.lit(0)) == 1).alias("iscell"),
        )
    )


def trace_masks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Masks of the trace ROIs: positive embedding entries on an 8 × 8 picture."""
    entry = F.transform(
        "embedding",
        lambda v, i: F.struct(F.floor(i / 8).cast("int").alias("y"), (i % 8).alias("x"), v.alias("lam")),
    )
    pixel = F.filter(entry, lambda p: p["lam"] > 0)
    return table(spark, sf_dir, "embeddings").select(
        F.col("label").alias("plane"), F.col("vec_id").cast("int").alias("roi"), pixel.alias("pixels")
    )


def some_masks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Masks of the even trace ROIs, and of a ROI without a trace for each of them."""
    even = trace_masks(spark, sf_dir).filter("roi % 2 = 0")
    return even.unionByName(even.withColumn("roi", -1 - F.col("roi")))


def planes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Step times of ten planes from the event stream."""

    def total(event_type: str | None, name: str):
        value = F.col("value") if event_type is None else F.when(F.col("event_type") == event_type, F.col("value"))
        return F.sum(value).alias(name)

    plane = (F.col("user_id") % 10).cast("int").alias("plane")
    sums = table(spark, sf_dir, "events").groupBy(plane).agg(
        total("view", "registration"),
        total("click", "detection"),
        total("signup", "extraction"),
        total("purchase", "classification"),
        total("error", "deconvolution"),
        total(None, "total_plane_runtime"),
    )
    return sums.select(
        "plane",
        F.concat(F.lit("/volume/plane_"), F.col("plane"), F.lit("/plane0")).alias("save_path"),
        F.struct(*sums.columns[1:]).alias("timing"),
    )


def order_keys(key: str) -> list:
    order = F.col(key)
    return [
        F.expr(f"cast({key} div {ORDERS_PER_PLANE} as int)").alias("plane"),
        (order % ORDERS_PER_PLANE).cast("int").alias("roi"),
    ]


def rois(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Masks of the orders: a 4 × 4 footprint at a place set by the order number.

    One maximum per footprint cell keeps plain-number buffers, so lines of a
    crowded order combine before the shuffle.
    """
    cell = F.col("l_partkey") % 4 * 4 + F.col("l_suppkey") % 4
    lam = F.col("l_quantity").cast("float")
    weights = [F.max(F.when(cell == k, lam)).alias(f"lam{k}") for k in range(16)]
    orders = table(spark, sf_dir, "lineitem").groupBy("l_orderkey").agg(*weights)
    placed = orders.select(*order_keys("l_orderkey"), *[f"lam{k}" for k in range(16)])
    top, left = F.col("roi") * 37 % 60, F.col("roi") * 23 % 59
    pixels = [
        F.struct((top + k // 4).alias("y"), (left + k % 4).alias("x"), F.col(f"lam{k}").alias("lam"))
        for k in range(16)
    ]
    kept = F.filter(F.array(*pixels), lambda p: p["lam"].isNotNull())
    return placed.select("plane", "roi", kept.alias("pixels"))


def raw_flags(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw flag rows of the orders: flag, probability."""
    flag = F.when(F.col("o_orderstatus") == "F", 1.0).when(F.col("o_orderstatus") == "P", 0.5).otherwise(0.0)
    return table(spark, sf_dir, "orders").select(
        *order_keys("o_orderkey"), F.array(flag, F.lit(0.9)).alias("iscell_raw")
    )


def pictures(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Picture size of each order plane."""
    keys = table(spark, sf_dir, "lineitem").select(order_keys("l_orderkey")[0]).distinct()
    return keys.withColumns({"ly": F.lit(SIDE), "lx": F.lit(SIDE)})


def movie(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Line items as pixels: frame = quantity, value = price in cents."""
    return table(spark, sf_dir, "lineitem").select(
        order_keys("l_orderkey")[0],
        (F.col("l_quantity").cast("long") - 1).alias("frame"),
        (F.col("l_partkey") % SIDE).cast("int").alias("y"),
        (F.col("l_suppkey") % SIDE).cast("int").alias("x"),
        F.round(F.col("l_extendedprice") * 100).alias("value"),
    )


def offsets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sub-pixel shifts of each movie frame."""
    frames = movie(spark, sf_dir).select("plane", "frame").distinct()
    return frames.withColumns({"dy": F.col("frame") % 4 * 0.25, "dx": F.col("frame") % 2 * 0.5})


def image_values(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Reference and filtered value of each pixel of a plane, side by side."""
    lines = table(spark, sf_dir, "lineitem").select(
        order_keys("l_orderkey")[0],
        (F.col("l_partkey") % SIDE).cast("int").alias("y"),
        (F.col("l_suppkey") % SIDE).cast("int").alias("x"),
        "l_extendedprice",
        "l_quantity",
    )
    # rounding keeps the order, so it can wait until one price per pixel is left
    return lines.groupBy("plane", "y", "x").agg(
        F.round(F.min("l_extendedprice") * 100).alias("ref"), F.max("l_quantity").alias("enh")
    )


def given_images(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Reference and filtered image of each plane, taken as given."""
    rows = F.inline(F.array(*[F.struct(F.lit(kind).alias("kind"), F.col(c).alias("value")) for kind, c in IMAGE_KINDS.items()]))
    return image_values(spark, sf_dir).select("plane", "y", "x", rows).select("plane", "kind", "y", "x", "value")


def written_images(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``given_images`` from values that are written once; who wants some kinds reads only their values."""
    values = settle(image_values(spark, sf_dir))
    rows = [values.select("plane", F.lit(kind).alias("kind"), "y", "x", F.col(c).alias("value")) for kind, c in IMAGE_KINDS.items()]
    return reduce(DataFrame.unionByName, rows)


def movie_frames(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders as movie frames: file = priority, frame = place within the file."""
    frames = table(spark, sf_dir, "orders").select(
        F.lit(0).alias("plane"), F.col("o_orderpriority").alias("file"), "o_orderkey"
    )
    return numbered(frames, ["file"], ["o_orderkey"], "frame")


def plane_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One movie file per page, in the folder its address names."""
    folder = F.regexp_replace(F.regexp_replace("url", r"[?#].*$", ""), r"^[a-z]+://", "/")
    name = F.concat(
        F.when(F.col("page_id") % 7 == 0, F.lit("_")).otherwise(F.lit("")),
        F.when(F.col("page_id") % 5 == 0, F.lit("plane")).otherwise(F.lit("plane_")),
        F.col("page_id"),
        F.when(F.col("page_id") % 4 == 0, F.lit("_reg.tif"))
        .when(F.col("page_id") % 4 == 1, F.lit(".ome.tif"))
        .when(F.col("page_id") % 4 == 2, F.lit(".b_c.tif"))
        .otherwise(F.lit(".tif")),
    )
    return table(spark, sf_dir, "pages").select(
        "page_id",
        F.regexp_extract("url", "^[a-z]+://([^/?#]+)", 1).alias("host"),
        F.concat_ws("/", F.regexp_replace(folder, "/+$", ""), name).alias("path"),
        F.octet_length("html").alias("n_bytes"),
    )


def trace_flags_without_cells(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Flags of which plane 0 has no accepted one."""
    return trace_flags(spark, sf_dir).withColumn("iscell", F.col("iscell") & (F.col("plane") != 0))


def movie_halves(spark: SparkSession, sf_dir: str) -> list[DataFrame]:
    """The movie in two files whose values differ in type."""
    whole = movie(spark, sf_dir)
    first, second = whole.filter("frame < 25"), whole.filter("frame >= 25")
    return [first.withColumn("value", F.col("value").cast("int")), second]


def artifacts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Artifacts found per document plane, as its labels tell."""
    labels = table(spark, sf_dir, "labels")
    have = F.array_compact(
        F.array(
            F.lit("ops"),
            F.when(F.col("quality") == 1, F.lit("stat")),
            F.when(F.col("toxic") == 0, F.lit("iscell")),
        )
    )
    return labels.select(
        F.concat(F.lit("plane_"), F.col("doc_id")).alias("plane_name"), F.explode(have).alias("artifact")
    )


def inputs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "documents").select(
        F.concat(F.lit("plane_"), F.col("doc_id")).alias("plane_name"), "source"
    )
