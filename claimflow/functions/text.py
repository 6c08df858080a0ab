"""Text helpers for X12 segments, as Spark SQL expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The characters Python's ``str.strip()`` removes (its whitespace
# set), so segment trimming matches a plain ``strip()`` exactly.
PY_WHITESPACE = (
    "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0\u1680"
    "\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a"
    "\u2028\u2029\u202f\u205f\u3000"
)

# A number as Python's float() reads it, minus underscores and nan/inf words.
_NUMBER_RE = r"^\s*[+-]?(\d+\.?\d*|\.\d+)([eE][+-]?\d+)?\s*$"


def py_strip(c: Column) -> Column:
    """Trim Python-whitespace from both ends (literal char set, no regex).

    Text that begins and ends with a visible ASCII character has nothing to trim and is taken as it is.
    """
    bare = F.ascii(c).between(33, 126) & F.ascii(F.substring(c, -1, 1)).between(33, 126)
    return F.when(bare, c).otherwise(F.btrim(c, F.lit(PY_WHITESPACE)))


def delimiter_regex(d: Column) -> Column:
    """A per-row regex that matches the delimiter text literally.

    Single characters are escaped with a backslash unless alphanumeric (a
    backslash before a non-alphanumeric char is always literal in Java
    regex, and keeps ``String.split`` on its no-compile fast path); longer
    delimiters are quoted.
    """
    return (
        F.when(F.length(d) != 1, F.concat(F.lit("\\Q"), d, F.lit("\\E")))
        .when(d.rlike("^[A-Za-z0-9]$"), d)
        .otherwise(F.concat(F.lit("\\"), d))
    )


def el(arr: Column | str, i: int) -> Column:
    """Element ``i`` (0-based) or NULL when the segment is shorter."""
    a = F.col(arr) if isinstance(arr, str) else arr
    return F.get(a, F.lit(i))


def safe_double(c: Column) -> Column:
    """Decimal text -> double; anything else (incl. nan/inf/'1d') -> NULL."""
    return F.when(c.rlike(_NUMBER_RE), F.trim(c).try_cast("double"))


def yyyymmdd_to_date(c: Column) -> Column:
    """8-character ``yyyyMMdd`` text -> DATE, anything else (or a bad calendar date) -> NULL."""
    return F.try_to_date(F.when(F.length(c) == 8, c), "yyyyMMdd")
