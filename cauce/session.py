"""Session defaults and the one way lineage is cut."""

from __future__ import annotations

import atexit
import shutil
import tempfile
import uuid
import zipfile
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession


def _own_folder() -> str:
    own = tempfile.mkdtemp(prefix="cauce_")
    atexit.register(shutil.rmtree, own, ignore_errors=True)
    return "file://" + own


def local_session(cores: str = "8", partitions: int = 8) -> SparkSession:
    """A session for tests and the bench, with a work folder of its own; clusters bring their own session."""
    return (
        SparkSession.builder.master(f"local[{cores}]")
        .appName("cauce")
        .config("spark.sql.shuffle.partitions", str(partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", "8g")
        .config("spark.checkpoint.dir", _own_folder())
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )


def ship(spark: SparkSession) -> None:
    """Send this package to the Python workers, once per context, wherever the driver was started."""
    context = spark.sparkContext
    if getattr(context, "_cauce_shipped", False):
        return
    home = Path(__file__).resolve().parent
    target = Path(tempfile.mkdtemp(prefix="cauce_pkg_")) / "cauce.zip"
    with zipfile.ZipFile(target, "w", zipfile.ZIP_DEFLATED) as z:
        for p in sorted(home.rglob("*.py")):
            z.write(p, f"cauce/{p.relative_to(home)}")
    context.addPyFile(str(target))
    context._cauce_shipped = True


def work_folder(spark: SparkSession) -> str:
    """The folder all executors share: ``spark.checkpoint.dir``.

    Where it is unset a session on one machine gets a temporary folder; on a cluster, whose machines would not share
    one, that is an error.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None) or getattr(spark, "_cauce_work", None)
    if not folder:
        master = spark.sparkContext.master
        if master != "local" and not master.startswith("local["):
            raise RuntimeError("spark.checkpoint.dir must name a folder that all executors share")
        folder = spark._cauce_work = _own_folder()
    return folder.rstrip("/")


_written: list[str] = []


def clear_work(spark: SparkSession) -> int:
    """Delete the tables that ``cut`` wrote in this process, once no result reads them any more; how many there were."""
    jvm, conf = spark._jvm, spark._jsc.hadoopConfiguration()
    for path in _written:
        target = jvm.org.apache.hadoop.fs.Path(path)
        target.getFileSystem(conf).delete(target, True)
    count = len(_written)
    _written.clear()
    return count


def cut(df: DataFrame, *by: str) -> DataFrame:
    """Write ``df`` as a Parquet table in the shared folder and return a scan of it.

    Later stages survive the loss of any executor and nothing upstream is computed twice. With ``by`` the table is
    partitioned by these columns, so that a filter on them reads its part only.
    """
    spark = df.sparkSession
    path = f"{work_folder(spark)}/cauce_{uuid.uuid4().hex}"
    (df.write.partitionBy(*by) if by else df.write).parquet(path)
    _written.append(path)
    return spark.read.schema(df.schema).parquet(path)


def size_bytes(df: DataFrame) -> int:
    """Catalyst's size estimate of the optimised plan (file sizes for a scan)."""
    return int(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes().toString())
