"""The pre-tokenizer pattern for the two regex engines we meet.

Java (Spark) runs the original pattern once ``(?U)`` makes ``\\s``, ``\\p{L}`` and case
folding Unicode-aware.  RE2 (DuckDB, oracle only) has no possessive quantifiers and no
look-ahead; on text whose whitespace runs are single blanks (``normalize_ws``) dropping
``\\s+(?!\\S)`` and the possessive marks yields the same pieces."""

from quarry.constants import SPLIT_PATTERN


def java_pattern(pattern: str = SPLIT_PATTERN) -> str:
    return "(?U)" + pattern


def re2_pattern(pattern: str = SPLIT_PATTERN) -> str:
    p = pattern.replace(r"|\s+(?!\S)", "")
    return p.replace("?+", "?").replace("++", "+")
