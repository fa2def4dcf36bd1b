"""Helpers of the operators: shared scratch tables, Arrow columns, words."""

from __future__ import annotations

import re
import uuid
from collections.abc import Iterable

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quarry.session import ensure_checkpoint_dir

# A word is a run of anything but ASCII white space.
WORD = re.compile("[^\x20\x09-\x0d]+")


def shared_path(spark: SparkSession, name: str) -> str:
    """A new path in the shared folder of ``spark.checkpoint.dir``; it is deleted when the
    driver ends, since the frames made from it are read lazily until then."""
    path = f"{ensure_checkpoint_dir(spark)}/{name}-{uuid.uuid4().hex[:12]}"
    jvm = spark.sparkContext._jvm
    hpath = jvm.org.apache.hadoop.fs.Path(path)
    hpath.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).deleteOnExit(hpath)
    return path


def delete(spark: SparkSession, path: str) -> None:
    """Delete a table that no frame will read again."""
    hpath = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    hpath.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(hpath, True)


def written(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` as Parquet in the shared folder and read it back: lineage is cut and a
    lost executor costs nothing that was written."""
    path = shared_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def texts(column: pa.Array | pa.ChunkedArray) -> list[str]:
    """The strings of an Arrow column; null is the empty string."""
    return [t or "" for t in column.to_pylist()]


def list_array(lengths: Iterable[int], values: pa.Array) -> pa.ListArray:
    """A list column from row lengths and the concatenated values."""
    import numpy as np
    offsets = np.zeros(len(lengths) + 1, "int32")
    np.cumsum(lengths, out=offsets[1:])
    return pa.ListArray.from_arrays(pa.array(offsets), values)


def slices(batches: Iterable[pa.RecordBatch], text: str, chars: int = 2_000_000) -> Iterable[pa.RecordBatch]:
    """Arrow batches cut so that a slice holds about ``chars`` characters (at least a row),
    which bounds a task's memory however long the texts are.  No row is lost."""
    import pyarrow.compute as pc
    for batch in batches:
        if not batch.num_rows:
            continue
        size = pc.fill_null(pc.binary_length(batch.column(text)), 0).to_numpy(zero_copy_only=False)
        start = total = 0
        for i, n in enumerate(size):
            if total and total + n > chars:
                yield batch.slice(start, i - start)
                start, total = i, 0
            total += int(n)
        yield batch.slice(start)


def fresh(df: DataFrame, name: str) -> str:
    """A column name that ``df`` does not have."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name = f"_{name}"
    return name


def packed(df: DataFrame, name: str = "row") -> DataFrame:
    """All columns of ``df`` in one struct, so that no helper column can clash with them."""
    return df.select(F.struct(*[F.col(f"`{c}`") for c in df.columns]).alias(name))


ARROW_BYTES = 4 << 20        # of a batch that goes to Python


def map_arrow(df: DataFrame, run, schema) -> DataFrame:
    """``mapInArrow`` with batches bounded by bytes as well as by rows: ten thousand texts may be a
    gigabyte.  The setting is the session's, since it is read when the frame runs; a smaller one
    is left alone.  A worker serves one task after another, so each gives back what it freed."""
    spark = df.sparkSession
    name = "spark.sql.execution.arrow.maxBytesPerBatch"
    if spark._jvm.org.apache.spark.network.util.JavaUtils.byteStringAsBytes(spark.conf.get(name)) > ARROW_BYTES:
        spark.conf.set(name, str(ARROW_BYTES))

    def task(batches):
        try:
            yield from run(batches)
        finally:
            give_back()

    return df.mapInArrow(task, schema)


def give_back() -> None:
    """Return freed memory to the system, where the allocators can (glibc for the strings)."""
    import ctypes
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim is not None:
        trim(0)
