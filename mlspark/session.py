"""Session helpers: configuration used by every job, and the shared scratch folder."""

from __future__ import annotations

import os
import tempfile
import threading
import uuid
import zipfile
from collections.abc import Callable, Iterator
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

_LOCAL_BASE: dict[str, str] = {}
_SHIPPED: set[str] = set()
_LOCK, _FREEING = threading.Lock(), {}
FREED = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
WAVE = 4 << 30  # bytes that one wave may shuffle


def build_session(cpus: int | str = "*", app: str = "mlspark", **conf: str) -> SparkSession:
    """A local session for tests and the bench; on a cluster use the session you are given."""
    n = 8 if cpus == "*" else int(cpus)
    builder = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName(app)
        .config("spark.sql.shuffle.partitions", str(n))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.driver.memory", "12g")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
    )
    for key, value in conf.items():
        builder = builder.config(key.replace("__", "."), value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ship(spark)
    return spark


def shared_dir(spark: SparkSession) -> str:
    """Base folder for cut points and written tables.

    The cluster names it in ``spark.checkpoint.dir``.  Only a local session, where driver and
    executors are one machine, falls back to a temporary folder.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if base:
        return base.rstrip("/")
    app = spark.sparkContext.applicationId
    if app not in _LOCAL_BASE:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
        _LOCAL_BASE[app] = tempfile.mkdtemp(prefix="mlspark-")
        spark.sparkContext.setCheckpointDir(_LOCAL_BASE[app])
    return _LOCAL_BASE[app]


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh path below the shared folder."""
    return f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"


@contextmanager
def freed(spark: SparkSession) -> Iterator[None]:
    """Shuffle files of a query that runs in here are deleted when it ends, not when the driver collects its garbage."""
    with _LOCK:
        if not _FREEING.get(id(spark)):
            _FREEING[id(spark)] = [0, spark.conf.get(FREED, "false")]
            spark.conf.set(FREED, "true")
        _FREEING[id(spark)][0] += 1
    try:
        yield
    finally:
        with _LOCK:
            _FREEING[id(spark)][0] -= 1
            if not _FREEING[id(spark)][0]:
                spark.conf.set(FREED, _FREEING.pop(id(spark))[1])


def written(df: DataFrame, name: str = "stage") -> DataFrame:
    """Cut the lineage: write ``df`` to the shared folder and read it back.

    Used where a result feeds several later branches.  The copy survives lost executors and its
    file statistics let the planner choose join strategies from real sizes.
    """
    return _put(df, scratch_path(df.sparkSession, name))


def _put(df: DataFrame, path: str) -> DataFrame:
    with freed(df.sparkSession):
        df.write.mode("overwrite").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def waves_for(size: float) -> int:
    """Number of waves, for bytes shuffled in all."""
    return max(1, -(-int(size) // WAVE))


class Wave:
    """One of several parts of all keys."""

    def __init__(self, spark: SparkSession, at: int = 0, waves: int = 1) -> None:
        self.spark, self.at, self.waves = spark, at, waves
        self.kept: list[str] = []

    def holds(self, key: str) -> Column:
        """Whether the key in a column belongs to this part."""
        return F.pmod(F.xxhash64(key, F.lit("wave")), F.lit(self.waves)) == self.at if self.waves > 1 else F.lit(True)

    def keep(self, df: DataFrame, name: str) -> DataFrame:
        """As ``written``, but of several waves only until the end of this one."""
        path = scratch_path(self.spark, name)
        if self.waves > 1:
            self.kept.append(path)
        return _put(df, path)

    def drop(self) -> None:
        for path in map(self.spark._jvm.org.apache.hadoop.fs.Path, self.kept):
            path.getFileSystem(self.spark._jsc.hadoopConfiguration()).delete(path, True)


def in_waves(spark: SparkSession, waves: int, step: Callable[[Wave], DataFrame], name: str = "wave") -> DataFrame:
    """What ``step`` makes of all keys, made of one part of the keys after the other.

    ``step`` must treat keys apart from each other.  A wave's result is written, and its shuffle files and what it
    kept are deleted before the next one begins, so that disks hold those of one wave at a time.  A single wave is not written.
    """
    if waves <= 1:
        return step(Wave(spark))
    path = scratch_path(spark, name)
    for at in range(waves):
        wave = Wave(spark, at, waves)
        part = step(wave)
        with freed(spark):
            part.write.mode("append").parquet(path)
        wave.drop()
    return spark.read.schema(part.schema).parquet(path)


def ship(spark: SparkSession) -> None:
    """Send this package to the executors once per application, so that they need not have it installed."""
    context = spark.sparkContext
    if context.applicationId in _SHIPPED:
        return
    root = os.path.dirname(os.path.abspath(__file__))
    package = os.path.basename(root)
    # the driver's own file server hands the archive out; executors never open this path
    archive = os.path.join(tempfile.mkdtemp(prefix=f"{package}-"), f"{package}.zip")
    with zipfile.ZipFile(archive, "w", zipfile.ZIP_DEFLATED) as out:
        for folder, _, names in os.walk(root):
            for name in sorted(n for n in names if n.endswith(".py")):
                path = os.path.join(folder, name)
                out.write(path, os.path.join(package, os.path.relpath(path, root)))
    context.addPyFile(archive)
    _SHIPPED.add(context.applicationId)


def partitions(spark: SparkSession) -> int:
    return max(2, int(spark.conf.get("spark.sql.shuffle.partitions", "200")))


def utc(spark: SparkSession) -> SparkSession:
    """Pin the session time zone, so that casting zone-less timestamps keeps their clock time."""
    if spark.conf.get("spark.sql.session.timeZone") != "UTC":
        spark.conf.set("spark.sql.session.timeZone", "UTC")
    return spark
