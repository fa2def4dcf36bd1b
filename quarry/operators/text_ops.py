"""Choosing, combining and filtering text.

Column choice happens at plan time from ``df.schema`` (a list comprehension over names, or
one aggregate row of average lengths); the per-row work is native column expressions."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from quarry.constants import (CASE_FIELD_KEYS, IBD_KEYWORDS, MIN_CASE_FIELD_CHARS, MIN_DOC_CHARS,
                              MIN_REPORT_CHARS, REPORT_COLUMN_CANDIDATES, TEXT_COLUMN_WORDS)
from quarry.functions.text import cap_text, combine_texts, contains_any, py_strip


def pick_columns_by_keyword(df: DataFrame, words: Sequence[str] = TEXT_COLUMN_WORDS) -> list[str]:
    """B1: columns whose lower-cased name contains one of ``words``."""
    return [c for c in df.columns if any(w in c.lower() for w in words)]


def fallback_string_columns(df: DataFrame) -> list[str]:
    """B2: all string columns."""
    return [f.name for f in df.schema.fields if isinstance(f.dataType, StringType)]


def object_columns(df: DataFrame, cols: Sequence[str] | None = None) -> list[str]:
    """B2 for untyped sources (CSV): pandas would type a column numeric when every non-null
    value parses as a number (and an all-missing column as float), so only columns with at
    least one non-numeric value are text.  One aggregate pass over the string columns."""
    cols = list(cols) if cols is not None else fallback_string_columns(df)
    if not cols:
        return []
    row = df.agg(*[F.count_if(F.col(f"`{c}`").isNotNull() &
                              F.col(f"`{c}`").try_cast("double").isNull()).alias(f"_{i}")
                   for i, c in enumerate(cols)]).first()
    return [c for i, c in enumerate(cols) if row[f"_{i}"] > 0]


def text_columns(df: DataFrame, words: Sequence[str] = TEXT_COLUMN_WORDS,
                 untyped: bool = False) -> list[str]:
    """B1, else B2 (for an untyped source, the columns pandas would read as text)."""
    picked = pick_columns_by_keyword(df, words)
    if picked:
        return picked
    return object_columns(df) if untyped else fallback_string_columns(df)


def combine_text_columns(df: DataFrame, keys: Sequence[str], cols: Sequence[str] | None = None,
                         min_chars: int = MIN_DOC_CHARS, out: str = "text",
                         untyped: bool = False) -> DataFrame:
    """B5 + B8: strip each text column, drop null / ``nan`` / empty, join with a blank line,
    keep documents longer than ``min_chars``."""
    cols = list(cols) if cols is not None else text_columns(df.drop(*keys), untyped=untyped)
    if not cols:
        return df.select(*keys, F.lit(None).cast("string").alias(out)).where(F.lit(False))
    return (df.select(*keys, combine_texts(cols).alias(out))
              .where(F.length(out) > min_chars))


def combine_case_fields(item: str, keys: Sequence[str] = CASE_FIELD_KEYS,
                        min_field: int = MIN_CASE_FIELD_CHARS, present: Sequence[str] | None = None):
    """The listed fields of a case struct, in order, each stripped and kept when longer
    than ``min_field`` characters, joined with a blank line."""
    fields = [k for k in keys if present is None or k in present]
    return combine_texts([F.col(f"{item}.{k}") for k in fields], min_len=min_field)


def explode_cases(df: DataFrame, keys: Sequence[str], cases: str = "cases",
                  min_chars: int = MIN_DOC_CHARS) -> DataFrame:
    """One document per element of a ``cases`` array (null and empty arrays give none);
    the nested ``case_text`` is not stripped before the length test."""
    ex = df.select(*keys, F.explode(cases).alias("_case"))
    return (ex.select(*keys, F.col("_case.case_text").alias("text"))
              .where(F.col("text").isNotNull() & (F.length("text") > min_chars)))


def filter_min_length(df: DataFrame, n: int = MIN_DOC_CHARS, col: str = "text") -> DataFrame:
    """Keep ``length(text) > n`` (code points, as Python ``len``)."""
    return df.where(F.length(col) > n)


def filter_keywords_any(df: DataFrame, phrases: Sequence[str] = IBD_KEYWORDS,
                        col: str = "text") -> DataFrame:
    """Lower-cased text contains any phrase (phrases containing a shorter listed phrase
    are dropped first: they cannot change the answer)."""
    return df.where(contains_any(col, phrases))


def pick_first_candidate(df: DataFrame, candidates: Sequence[str] = REPORT_COLUMN_CANDIDATES) -> str | None:
    """The first candidate name present, compared with exact case."""
    names = set(df.columns)
    return next((c for c in candidates if c in names), None)


def pick_longest_text_column(df: DataFrame) -> str | None:
    """The string column with the greatest mean non-null length (first on a tie);
    one aggregate pass over all string columns."""
    cols = fallback_string_columns(df)
    if not cols:
        return None
    row = df.agg(*[F.avg(F.length(F.col(c))).alias(f"_{i}") for i, c in enumerate(cols)]).first()
    best, best_len = None, None
    for i, c in enumerate(cols):
        v = row[f"_{i}"]
        if v is not None and (best_len is None or v > best_len):
            best, best_len = c, v
    return best if best is not None else cols[0]


def report_column(df: DataFrame, candidates: Sequence[str] = REPORT_COLUMN_CANDIDATES) -> str | None:
    return pick_first_candidate(df, candidates) or pick_longest_text_column(df)


def drop_null_text(df: DataFrame, col: str, keys: Sequence[str] = (), out: str = "text") -> DataFrame:
    """Non-null values as strings, stripped."""
    return df.where(F.col(col).isNotNull()).select(*keys, py_strip(F.col(col).cast("string")).alias(out))


def report_texts(df: DataFrame, keys: Sequence[str] = (), min_chars: int = MIN_REPORT_CHARS,
                 candidates: Sequence[str] = REPORT_COLUMN_CANDIDATES) -> DataFrame:
    """B3/B4 + B10 + B8: the report column, stripped, longer than ``min_chars``."""
    col = report_column(df.drop(*keys), candidates)
    if col is None:
        return df.select(*keys, F.lit(None).cast("string").alias("text")).where(F.lit(False))
    return filter_min_length(drop_null_text(df, col, keys), min_chars)


def cap_documents(df: DataFrame, n: int, col: str = "text") -> DataFrame:
    """The first ``n`` characters of each document (tokenizer training input)."""
    return df.withColumn(col, cap_text(col, n))
