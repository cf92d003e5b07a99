"""Session defaults and the shared folder for cut lineage."""

from __future__ import annotations

import tempfile
import zipfile
from pathlib import Path
from uuid import uuid4

from pyspark.sql import DataFrame, SparkSession


def local_session(cores: int | str = "*", name: str = "planefold", **conf: str) -> SparkSession:
    """A session for tests and benchmarks; a cluster brings its own."""
    builder = SparkSession.builder.master(f"local[{cores}]").appName(name)
    defaults = {
        "spark.sql.shuffle.partitions": "8",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.session.timeZone": "UTC",
        "spark.driver.memory": "8g",
        "spark.ui.enabled": "false",
        "spark.ui.showConsoleProgress": "false",
    }
    for key, value in {**defaults, **conf}.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def shared_folder(spark: SparkSession) -> str:
    """The checkpoint folder of the session.

    The cluster names it in ``spark.checkpoint.dir``. Only a local master, where
    the driver is the one machine, falls back to a temporary folder.
    """
    context = spark.sparkContext
    named = context.getConf().get("spark.checkpoint.dir") or spark.conf.get("spark.checkpoint.dir", None)
    current = context.getCheckpointDir()
    if current:
        return named or current
    if not named:
        if not context.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
        named = tempfile.mkdtemp(prefix="spark-")
    context.setCheckpointDir(named)
    return named


_settled: list[str] = []


def clear_settled(spark: SparkSession) -> int:
    """Remove the tables that ``settle`` wrote in this process; their number.

    For the end of a job: DataFrames that read them can't be evaluated any more.
    """
    jvm, conf = spark._jvm, spark._jsc.hadoopConfiguration()
    count = len(_settled)
    while _settled:
        path = jvm.org.apache.hadoop.fs.Path(_settled.pop())
        path.getFileSystem(conf).delete(path, True)
    return count


def settle(df: DataFrame) -> DataFrame:
    """Write ``df`` once to the shared folder and go on from the written table.

    Needed where two readers of one intermediate must see the very same rows,
    also after an executor is lost (for example sampled range bounds). A table is
    smaller than a checkpoint, and its readers fetch only the columns they use.
    """
    spark = df.sparkSession
    path = f"{shared_folder(spark).rstrip('/')}/settled-{uuid4().hex}"
    df.write.parquet(path)
    _settled.append(path)
    return spark.read.schema(df.schema).parquet(path)


_sent: set[str] = set()


def send_code(spark: SparkSession) -> None:
    """Send this package to Python workers that cannot import it, once per application, as one zip file."""
    context = spark.sparkContext
    if context.applicationId in _sent:
        return
    root = Path(__file__).resolve().parent
    target = Path(tempfile.mkdtemp(prefix="spark-")) / f"{root.name}_code.zip"
    with zipfile.ZipFile(target, "w") as archive:
        for path in sorted(root.rglob("*.py")):
            archive.write(path, path.relative_to(root.parent).as_posix())
    context.addPyFile(str(target))
    _sent.add(context.applicationId)
