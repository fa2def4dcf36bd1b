"""Scalar column functions with Python/pandas semantics, expressed natively.

Spark's ``trim`` only removes U+0020; Python's ``str.strip`` removes every Unicode
whitespace character.  The class below is written so that Java's regex engine and RE2
(DuckDB, used by the oracle SQL) read it the same way."""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from quarry.constants import LABEL_KEEP, LABEL_MAX, NA_WORDS

# Python ``str.isspace`` characters: ASCII blanks, U+000B, U+001C..U+001F, U+0085 and
# the Unicode separators.  ``\x{..}`` is understood by Java and RE2 alike.
WS_CLASS = r"[\s\x{0B}\x{1C}-\x{1F}\x{85}\p{Z}]"
STRIP_PATTERN = r"\A" + WS_CLASS + r"+|" + WS_CLASS + r"+\z"


def _col(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def py_strip(c: str | Column) -> Column:
    """``str.strip()``: remove leading and trailing Unicode whitespace."""
    return F.regexp_replace(_col(c), F.lit(STRIP_PATTERN), F.lit(""))


def normalize_ws(c: str | Column) -> Column:
    """Collapse every whitespace run to one blank and strip the ends."""
    return py_strip(F.regexp_replace(_col(c), F.lit(WS_CLASS + "+"), F.lit(" ")))


def na_to_null(c: str | Column, words: Sequence[str] = NA_WORDS) -> Column:
    """pandas ``read_csv`` missing-value words become null (Spark has one ``nullValue``)."""
    c = _col(c)
    return F.when(c.isin(list(words)), F.lit(None).cast("string")).otherwise(c)


def combine_texts(cols: Iterable[str | Column], min_len: int | None = None,
                  drop_words: Sequence[str] = ("nan", ""), sep: str = "\n\n") -> Column:
    """Strip each value, drop null / ``nan`` / empty (and, given ``min_len``, values whose
    stripped length is not above it), join the rest with a blank line."""
    parts = F.array(*[py_strip(_col(c).cast("string")) for c in cols])

    def keep(x: Column) -> Column:
        ok = x.isNotNull() & ~x.isin(list(drop_words))
        if min_len is not None:
            ok = ok & (F.length(x) > F.lit(min_len))
        return ok

    return F.array_join(F.filter(parts, keep), sep)


def minimal_phrases(phrases: Sequence[str]) -> list[str]:
    """Drop phrases that contain another listed phrase: the shorter one already matches."""
    uniq = list(dict.fromkeys(phrases))
    return [p for p in uniq if not any(q != p and q in p for q in uniq)]


def contains_any(c: str | Column, phrases: Sequence[str], lower: bool = True) -> Column:
    """True when the (lower-cased) text contains any phrase; redundant phrases are dropped."""
    text = F.lower(_col(c)) if lower else _col(c)
    cond = F.lit(False)
    for p in minimal_phrases(phrases):
        cond = cond | F.contains(text, F.lit(p))
    return cond


def cap_text(c: str | Column, n: int) -> Column:
    """First ``n`` characters (code points)."""
    return F.substring(_col(c), 1, n)


def shorten_label(c: str | Column, max_len: int = LABEL_MAX, keep: int = LABEL_KEEP) -> Column:
    """Strip; longer than ``max_len`` → first ``keep`` characters plus ``...``."""
    s = py_strip(_col(c).cast("string"))
    return F.when(F.length(s) > max_len, F.concat(F.substring(s, 1, keep), F.lit("..."))).otherwise(s)


def nan_to_null(c: str | Column) -> Column:
    """pandas skips NaN in min/cummin and fails every comparison: make it null."""
    c = _col(c)
    return F.when(F.isnan(c), F.lit(None).cast("double")).otherwise(c)


def to_double(c: str | Column) -> Column:
    """``to_numeric(errors='coerce')``: bad numbers become null (``try_cast``)."""
    return nan_to_null(_col(c).cast("string").try_cast("double"))


def normalize_status(c: str | Column) -> Column:
    return F.upper(py_strip(_col(c)))


def memory_gb(peak_mb: str | Column) -> Column:
    """``round(peak_vram_mb / 1024, 1)``; a crashed run (no value) logs 0.0."""
    return F.round(F.coalesce(_col(peak_mb), F.lit(0.0)) / F.lit(1024.0), 1)


def commit_short(c: str | Column) -> Column:
    return F.substring(_col(c), 1, 7)
