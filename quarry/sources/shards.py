"""Parquet shards: scan, split pruning, listing, writing."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quarry.constants import DOCS_PER_SHARD

SPLITS = ("train", "val")


def scan_text_parquet(spark: SparkSession, path: str, *extra: str) -> DataFrame:
    """A1: only ``text`` (and the named columns) is read from the shards."""
    return spark.read.parquet(path).select(*extra, "text")


def scan_split(spark: SparkSession, root: str, split: str) -> DataFrame:
    """One split of a ``split=…/shard=…`` layout; the filter prunes partitions and only
    ``*.parquet`` files are read (never a half-written ``*.tmp``).  An unknown split name, or a
    folder without shards, stops the job."""
    if split not in SPLITS:
        raise ValueError(f"split must be one of {SPLITS}, not {split!r}")
    if list_shards(spark, root).limit(1).count() == 0:
        raise FileNotFoundError(f"no shards in {root}; prepare the corpus first")
    return spark.read.option("pathGlobFilter", "*.parquet").parquet(root).where(F.col("split") == F.lit(split))


def list_shards(spark: SparkSession, root: str) -> DataFrame:
    """The ``*.parquet`` files (never ``*.tmp``) with their size, in name order, those without
    rows too: the folder is listed and no file is opened."""
    files = (spark.read.format("binaryFile").option("pathGlobFilter", "*.parquet")
             .option("recursiveFileLookup", True).load(root))
    return (files.select(F.col("path").alias("file_path"), F.element_at(F.split("path", "/"), -1).alias("file_name"),
                         F.col("length").alias("file_size")).orderBy("file_path"))


def write_shards(assigned: DataFrame, root: str, mode: str = "errorifexists",
                 columns: tuple[str, ...] = ("text",), observe: tuple = (), docs_per_file: int = DOCS_PER_SHARD) -> None:
    """One directory per (split, shard).  A train shard is one file: its rows go to one task,
    which holds one shard after the other.  The validation shard may be of any size, so it is cut by
    its index into files of ``docs_per_file`` rows, which are dealt to all tasks.  ``observe`` (an
    Observation and its aggregates) counts the rows as they are written."""
    rows = assigned.select(*columns, "split", "shard", "idx")
    tasks = max(1, int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions", "200")))
    part = F.when(F.col("split") == "val", F.floor(F.col("idx") / F.lit(docs_per_file))).otherwise(F.col("shard"))
    rows = rows.repartitionById(tasks, F.pmod(part, F.lit(tasks)).cast("int")).sortWithinPartitions("split", "shard", "idx")
    rows = rows.observe(*observe) if observe else rows
    (rows.drop("idx").write.mode(mode).partitionBy("split", "shard").parquet(root))


def materialize_once(df: DataFrame, path: str) -> DataFrame:
    """Write unless the output exists (``mode('ignore')``), then read it back.  Spark's
    commit protocol publishes the files atomically (the ``.tmp`` + rename of the reference)."""
    df.write.mode("ignore").parquet(path)
    return df.sparkSession.read.parquet(path)
