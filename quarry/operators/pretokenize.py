"""H1 pre-tokenisation and C8 piece counts, fully native (``regexp_extract_all``).

The counts are the first, and the only data-sized, step of tokenizer training: partial
aggregation on each map task folds frequent pieces before the shuffle, so a piece that
makes up a third of the corpus costs one row per task, not a hot reducer."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quarry.constants import SPLIT_PATTERN
from quarry.functions.regex import java_pattern


def pieces_expr(text: str | Column, pattern: str = SPLIT_PATTERN) -> Column:
    c = F.col(text) if isinstance(text, str) else text
    return F.regexp_extract_all(c, F.lit(java_pattern(pattern)), F.lit(0))


def pretokenize(df: DataFrame, text: str = "text", out: str = "pieces",
                pattern: str = SPLIT_PATTERN) -> DataFrame:
    """Add ``out`` = the pieces of ``text`` in order (ARRAY<STRING>)."""
    return df.withColumn(out, pieces_expr(text, pattern))


def explode_pieces(df: DataFrame, keys: list[str], text: str = "text",
                   pattern: str = SPLIT_PATTERN) -> DataFrame:
    """One row per piece: keys, ``pos`` (0-based), ``piece``."""
    return df.select(*keys, F.posexplode(pieces_expr(text, pattern)).alias("pos", "piece"))


def pretoken_counts(docs: DataFrame, text: str = "text", pattern: str = SPLIT_PATTERN,
                    weight: str | None = None) -> DataFrame:
    """``piece, n``: how often each piece occurs (optionally weighted by a count column)."""
    ex = docs.select(F.explode(pieces_expr(text, pattern)).alias("piece"),
                     (F.col(weight) if weight else F.lit(1)).cast("long").alias("_w"))
    return ex.groupBy("piece").agg(F.sum("_w").cast("long").alias("n"))
