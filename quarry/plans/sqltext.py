"""SQL fragments for the DuckDB oracles that mirror our column functions."""

from quarry.functions.regex import re2_pattern
from quarry.functions.text import STRIP_PATTERN, WS_CLASS


def lit(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


def strip(expr: str) -> str:
    return f"regexp_replace({expr}, {lit(STRIP_PATTERN)}, '', 'g')"


def normalize_ws(expr: str) -> str:
    return strip(f"regexp_replace({expr}, {lit(WS_CLASS + '+')}, ' ', 'g')")


def pieces(expr: str) -> str:
    return f"regexp_extract_all({expr}, {lit(re2_pattern())})"
