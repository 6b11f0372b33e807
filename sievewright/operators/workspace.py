"""Shared folders for the tables between the steps of an operator.

A step that is read more than once, or whose lineage should end, is written as Parquet below the folder that the
cluster names in ``spark.checkpoint.dir``. Only a local master, where the driver and its executors are one machine, may
fall back to a temporary folder.
"""

from __future__ import annotations

import atexit
import tempfile
import uuid
import zipfile
from collections.abc import Iterator
from contextlib import contextmanager
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession


#: What a batch for Python may hold, in place of Spark's defaults, which whole texts would make too large for a worker: rows
#: and bytes (a single longer text is a batch). Settings of the session that differ from the defaults stay.
_BATCHES = {"spark.sql.execution.arrow.maxRecordsPerBatch": ("10000", "512"), "spark.sql.execution.arrow.maxBytesPerBatch": ("67108864b", "16m")}
_FREED = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def shared_root(spark: SparkSession) -> str:
    """The folder named in spark.checkpoint.dir; a temporary one is set where it is unset and the master is local."""
    root = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir")
    if not root:
        master = spark.sparkContext.master
        if not master.startswith("local") or master.startswith("local-cluster"):
            raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
        root = "file://" + tempfile.mkdtemp(prefix="sievewright-")
        spark.conf.set("spark.checkpoint.dir", root)
    return root if "://" in root or root.startswith("file:") else "file://" + root if root.startswith("/") else root


def ship(spark: SparkSession) -> None:
    """Sends this package to the executors, once for each Spark context, and has texts sent to Python in small batches."""
    context = spark.sparkContext
    for name, (default, ours) in _BATCHES.items():
        if spark.conf.get(name, None) == default:
            spark.conf.set(name, ours)
    if getattr(context, "_sievewright_shipped", False):
        return
    package = Path(__file__).resolve().parent.parent
    target = Path(tempfile.mkdtemp(prefix="sievewright-code-")) / "sievewright.zip"
    with zipfile.ZipFile(target, "w") as out:
        for path in sorted(package.rglob("*.py")):
            out.write(path, path.relative_to(package.parent))
    context.addPyFile(str(target))
    context._sievewright_shipped = True


class Workspace:
    """A folder of one operator call. Dropped tables go at once, the rest when the driver's process ends."""

    def __init__(self, spark: SparkSession, name: str):
        self.spark = spark
        ship(spark)
        self.path = f"{shared_root(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"
        atexit.register(self._quietly_remove)

    def _remove(self, path: str) -> None:
        jvm = self.spark.sparkContext._jvm
        at = jvm.org.apache.hadoop.fs.Path(path)
        at.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration()).delete(at, True)

    def _quietly_remove(self) -> None:
        try:
            self._remove(self.path)
        except Exception:  # noqa: BLE001  the session may have ended already
            pass

    def save(self, df: DataFrame, name: str) -> DataFrame:
        """Writes df and returns the written table."""
        path = f"{self.path}/{name}"
        with shuffles_freed(self.spark):
            df.write.mode("overwrite").option("compression", "zstd").parquet(path)
        return self.spark.read.schema(df.schema).parquet(path)

    def drop(self, *names: str) -> None:
        for name in names:
            self._remove(f"{self.path}/{name}")


@contextmanager
def shuffles_freed(spark: SparkSession) -> Iterator[None]:
    """Shuffle files of what is written in this block go as soon as it is written; the session's setting is restored."""
    before = spark.conf.get(_FREED)
    spark.conf.set(_FREED, "true")
    try:
        yield
    finally:
        spark.conf.set(_FREED, before)


def partitions(spark: SparkSession, least: int = 1) -> int:
    """Shuffle partitions as the session sets them."""
    return max(least, int(spark.conf.get("spark.sql.shuffle.partitions")))
