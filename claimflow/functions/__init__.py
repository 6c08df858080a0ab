"""Column-level helpers (all built-in Spark SQL expressions, no UDFs)."""

from claimflow.functions.keys import hash_key
from claimflow.functions.text import (
    PY_WHITESPACE,
    delimiter_regex,
    el,
    py_strip,
    safe_double,
    yyyymmdd_to_date,
)

__all__ = [
    "PY_WHITESPACE",
    "delimiter_regex",
    "el",
    "hash_key",
    "py_strip",
    "safe_double",
    "yyyymmdd_to_date",
]
