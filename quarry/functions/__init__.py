"""Column expressions shared by the operators (all JVM-side, no Python UDFs)."""

from quarry.functions.text import (  # noqa: F401
    WS_CLASS, py_strip, na_to_null, combine_texts, contains_any, minimal_phrases,
    shorten_label, cap_text, nan_to_null, to_double, normalize_status, memory_gb,
    commit_short, normalize_ws,
)
from quarry.functions.regex import java_pattern, re2_pattern  # noqa: F401
