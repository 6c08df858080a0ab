"""Stable hash keys: sha256 hex of ``||``-joined parts.

The leading parts (vendor, file hash) are passed raw, so ``concat_ws`` skips
them when NULL; the remaining parts are coalesced to ``''`` — the same rule
the normalized tables use for their merge keys.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def hash_key(*parts: Column | str, raw: int = 0) -> Column:
    """sha256(concat_ws('||', p1, ..., pn)); parts after the first ``raw`` ones become ``''`` when NULL."""
    cols = []
    for i, p in enumerate(parts):
        c = F.col(p) if isinstance(p, str) else p
        cols.append(c if i < raw else F.coalesce(c.cast("string"), F.lit("")))
    return F.sha2(F.concat_ws("||", *cols), 256)
