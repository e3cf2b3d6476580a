"""Session construction and lineage-cutting helpers."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

# Defaults chosen for the scan-aggregate-window shape of this library:
# AQE re-plans joins/partition counts at runtime and splits skewed joins.
DEFAULT_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


def get_session(master: str = "local[*]", app: str = "custlens",
                shuffle_partitions: int | None = None,
                extra: dict | None = None) -> SparkSession:
    b = SparkSession.builder.master(master).appName(app)
    for k, v in DEFAULT_CONF.items():
        b = b.config(k, v)
    if shuffle_partitions is not None:
        b = b.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    for k, v in (extra or {}).items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder named by ``spark.checkpoint.dir``.

    On a cluster the folder must be set by the operator (a shared
    filesystem path).  Only a local-mode session (tests, laptops) may
    fall back to a fresh temporary folder.
    """
    conf_dir = spark.conf.get("spark.checkpoint.dir", None)
    sc = spark.sparkContext
    if not conf_dir:
        if sc.getCheckpointDir() is not None:
            return sc.getCheckpointDir()
        if not sc.master.startswith("local"):
            raise RuntimeError(
                "spark.checkpoint.dir is not set; point it at a shared folder")
        conf_dir = tempfile.mkdtemp(prefix="custlens-ckpt-")
    if sc.getCheckpointDir() is None:
        sc.setCheckpointDir(conf_dir)
    return conf_dir


def cut_lineage(df: DataFrame) -> DataFrame:
    """Reliable checkpoint into the shared checkpoint folder (survives
    executor loss, unlike a local checkpoint)."""
    checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


class Versions:
    """Parquet versions of a table that an iteration rewrites, in the shared
    checkpoint folder; a version is deleted when the next one is written."""

    def __init__(self, spark: SparkSession, stem: str):
        self.spark, self.folder, self.n = spark, f"{checkpoint_dir(spark)}/{stem}-{uuid.uuid4().hex}", 0

    def write(self, df: DataFrame) -> DataFrame:
        self.n += 1
        df.write.parquet(f"{self.folder}/{self.n}")
        if self.n > 1:
            self.drop(f"/{self.n - 1}")
        return self.spark.read.schema(df.schema).parquet(f"{self.folder}/{self.n}")

    def drop(self, name: str = "") -> None:
        path = self.spark._jvm.org.apache.hadoop.fs.Path(self.folder + name)
        path.getFileSystem(self.spark._jsc.hadoopConfiguration()).delete(path, True)


def drop_checkpoint(spark: SparkSession, kept: str | None, rdd) -> str | None:
    """The checkpoint of ``rdd`` if it is written, else ``kept``, the one before it; with a
    newer one, or without ``rdd``, ``kept`` is deleted."""
    now = rdd.getCheckpointFile() if rdd is not None else None
    if kept and now != kept and (now or rdd is None):
        path = spark._jvm.org.apache.hadoop.fs.Path(kept)
        path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)
        return now
    return now or kept


_SHIPPED: set = set()


def ship_package(spark: SparkSession) -> None:
    """Make ``custlens`` importable on executors (needed by the few grouped
    pandas functions): zip the package into a file of the driver and hand it
    to ``addPyFile``, which serves it to the executors."""
    import os
    import zipfile

    sc = spark.sparkContext
    key = sc.applicationId
    if key in _SHIPPED:
        return
    pkg = os.path.dirname(os.path.abspath(__file__))
    path = os.path.join(tempfile.mkdtemp(prefix="custlens-ship-"), "custlens.zip")
    with zipfile.ZipFile(path, "w", zipfile.ZIP_DEFLATED) as z:
        for folder, _, names in os.walk(pkg):
            for f in names:
                if f.endswith(".py"):
                    full = os.path.join(folder, f)
                    z.write(full, os.path.join("custlens", os.path.relpath(full, pkg)))
    sc.addPyFile(path)
    _SHIPPED.add(key)
