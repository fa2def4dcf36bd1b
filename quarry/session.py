"""Session helpers: defaults for local runs and the shared checkpoint folder."""

from __future__ import annotations

import os
import re
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

# Defaults for local and test sessions.  On a cluster the cluster's own settings win:
# ``get_session`` only fills in keys that are unset.
LOCAL_DEFAULTS = {
    "spark.sql.shuffle.partitions": "8",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    "spark.driver.memory": "16g",
}


def get_session(master: str | None = None, app: str = "quarry", **conf: str) -> SparkSession:
    """Return the active session, or build a local one with ``LOCAL_DEFAULTS``."""
    active = SparkSession.getActiveSession()
    if active is not None:
        ensure_checkpoint_dir(active)
        return active
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for k, v in {**LOCAL_DEFAULTS, **conf}.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """The shared folder that the cluster names in ``spark.checkpoint.dir``.

    Only a plain local session without the setting gets a private folder of its own (tests); on
    a cluster its absence is an error, because a folder of the driver is invisible to executors."""
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get(
        "spark.checkpoint.dir", None
    )
    if not configured:
        if not re.fullmatch(r"local(\[(\*|\d+)(,\s*\d+)?\])?", sc.master):
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
        configured = tempfile.mkdtemp(prefix="quarry-ckpt-")
    sc.setCheckpointDir(configured)
    return sc.getCheckpointDir() or configured


def shared_folder(spark: SparkSession, name: str) -> str:
    """A fresh path in the shared folder, deleted when the driver ends (frames read from it
    are lazy until then)."""
    path = f"{ensure_checkpoint_dir(spark)}/{name}-{uuid.uuid4().hex[:12]}"
    hpath = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    hpath.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).deleteOnExit(hpath)
    return path


def drop_folder(spark: SparkSession, path: str | None) -> None:
    """Delete a folder that this driver made and no frame reads any more."""
    if path:
        hpath = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
        hpath.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(hpath, True)


def cut_lineage(df: DataFrame, name: str = "cut") -> DataFrame:
    """Write ``df`` as Parquet in the shared folder and read it back.

    The copy survives the loss of the executors that computed it, unlike a cache, is compressed
    and read by column, and goes when the driver ends."""
    path = shared_folder(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def ship_package(spark: SparkSession) -> None:
    """Send this package to the executors, for sessions whose workers cannot import it."""
    import zipfile
    root = os.path.dirname(os.path.abspath(__file__))
    path = os.path.join(tempfile.mkdtemp(prefix="quarry-zip-"), "quarry.zip")
    with zipfile.ZipFile(path, "w") as z:
        for folder, _, files in os.walk(root):
            for f in files:
                if f.endswith(".py"):
                    full = os.path.join(folder, f)
                    z.write(full, os.path.join("quarry", os.path.relpath(full, root)))
    spark.sparkContext.addPyFile(path)


def spread(df: DataFrame) -> DataFrame:
    """``df`` over at least as many partitions as there are cores: a table of one small file is
    otherwise one task, however costly its expressions.  A table of many splits is left alone."""
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(cores) if df.rdd.getNumPartitions() < cores else df


def table_path(sf_dir: str, name: str) -> str:
    return os.path.join(sf_dir, f"{name}.parquet")


def is_folder(spark: SparkSession, path: str) -> bool:
    hpath = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return hpath.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).getFileStatus(hpath).isDirectory()


def read_table(spark: SparkSession, sf_dir: str, name: str, *columns) -> DataFrame:
    """Read one driver table; naming ``columns`` prunes the parquet scan to them."""
    df = spark.read.parquet(table_path(sf_dir, name))
    return df.select(*columns) if columns else df
