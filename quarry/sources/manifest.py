"""Deposit records and cached-file checks."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quarry.constants import DEPOSIT_TEXT_FILES, SUSPECT_CONTENT_TYPES, SUSPECT_FILE_BYTES

LINKS = T.StructType([T.StructField(k, T.StringType()) for k in ("download", "content", "self")])
FILE_ENTRY = T.StructType([
    T.StructField("filename", T.StringType()), T.StructField("key", T.StringType()),
    T.StructField("filesize", T.LongType()), T.StructField("size", T.LongType()),
    T.StructField("links", LINKS), T.StructField("download_url", T.StringType())])
DEPOSIT = T.StructType([T.StructField("files", T.ArrayType(FILE_ENTRY)),
                        T.StructField("entries", T.ArrayType(FILE_ENTRY))])


def _first_truthy(*cols: Column) -> Column:
    """Python's ``a or b or …``: null and empty strings are skipped."""
    return F.coalesce(*[F.nullif(c, F.lit("")) for c in cols])


def parse_deposit_manifest(records: DataFrame, json_col: str = "record", keys: Sequence[str] = (),
                           wanted: Sequence[str] = DEPOSIT_TEXT_FILES) -> DataFrame:
    """A10: the files of deposit records in either naming (``files``/``filename``/``filesize``
    or ``entries``/``key``/``size``); only the wanted file names (a semi-join on a fixed list),
    and the first usable link of download → content → self → download_url."""
    rec = records.select(*keys, F.from_json(F.col(json_col), DEPOSIT).alias("_r"))
    files = F.when(F.size("_r.files") > 0, F.col("_r.files")).otherwise(F.col("_r.entries"))
    ex = rec.select(*keys, F.explode_outer(files).alias("f")).where(F.col("f").isNotNull())
    out = ex.select(*keys,
                    F.coalesce(_first_truthy(F.col("f.filename"), F.col("f.key")), F.lit("")).alias("file_name"),
                    F.coalesce(F.nullif(F.col("f.filesize"), F.lit(0)), F.col("f.size"), F.lit(0))
                     .cast("long").alias("size_bytes"),
                    F.coalesce(_first_truthy(F.col("f.links.download"), F.col("f.links.content"),
                                             F.col("f.links.self"), F.col("f.download_url")),
                               F.lit("")).alias("url"))
    return out.where(F.col("file_name").isin(list(wanted)) & (F.col("url") != ""))


def flag_suspect_files(files: DataFrame, size_col: str = "size_bytes", type_col: str = "content_type",
                       min_bytes: int = SUSPECT_FILE_BYTES,
                       bad_types: Sequence[str] = SUSPECT_CONTENT_TYPES) -> DataFrame:
    """A cached file below ``min_bytes`` is suspect (likely an error page), and so is a
    response whose content type names json or html."""
    ctype = F.lower(F.coalesce(F.col(type_col), F.lit("")))
    bad = F.lit(False)
    for t in bad_types:
        bad = bad | F.contains(ctype, F.lit(t))
    return (files.withColumn("too_small", F.col(size_col) < F.lit(min_bytes))
                 .withColumn("bad_type", bad)
                 .withColumn("keep", ~F.col("too_small") & ~F.col("bad_type")))
