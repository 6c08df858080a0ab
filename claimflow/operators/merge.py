"""Idempotent merges as DataFrame plans (SNK2-SNK7, JN8).

``merge_frames`` is ``MERGE INTO`` for any Spark table format: a full outer
join of target and source on the merge keys (null-safe by default), then a
per-column choice between the target value, the source value or an update
expression. The source is first reduced to one row per key — several source
rows for one key would otherwise update or insert ambiguously.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

UpdateSpec = Sequence[str] | Mapping[str, "str | Callable[[Callable[[str], Column], Callable[[str], Column]], Column]"]


def dedupe_source(source: DataFrame, keys: Sequence[str], order: Column | str | None = None) -> DataFrame:
    """One row per key: the row with the largest ``order``; without one, the largest by its other columns in turn.

    So the row that stays doesn't depend on how the rows are partitioned. A
    ``max_by`` aggregate, so it pre-aggregates map-side: a key held by a third
    of the rows is collapsed before the shuffle.
    """
    others = [c for c in source.columns if c not in keys]
    if not others:
        return source.dropDuplicates(list(keys))
    o = F.col(order) if isinstance(order, str) else (order if order is not None else F.struct(*others))
    return (
        source.groupBy(*keys)
        .agg(F.max_by(F.struct(*others), o).alias("_r"))
        .select(*keys, "_r.*")
        .select(*source.columns)
    )


def _key_cond(t: DataFrame, s: DataFrame, keys: Sequence[str], null_safe: bool) -> Column:
    cond = None
    for k in keys:
        c = t[f"__t_{k}"].eqNullSafe(s[f"__s_{k}"]) if null_safe else (t[f"__t_{k}"] == s[f"__s_{k}"])
        cond = c if cond is None else cond & c
    return cond


def merge_frames(
    target: DataFrame,
    source: DataFrame,
    keys: Sequence[str],
    update: UpdateSpec | None = None,
    insert: bool = True,
    null_safe: bool = True,
    source_order: Column | str | None = None,
    insert_values: Mapping[str, Column] | None = None,
) -> DataFrame:
    """The merged target.

    * ``update``: ``None`` = insert-only merge (matched rows untouched); a
      list of column names = ``SET t.c = s.c``; a mapping column -> callable
      ``(t, s) -> Column`` for computed updates (e.g. a status that stays
      QUARANTINED once set); ``"*"`` in the list updates every column.
    * ``insert``: ``False`` = update-only merge.
    * ``insert_values``: column -> expression over source columns for
      inserted rows (columns missing in the source are NULL).
    * ``null_safe``: keys match with ``<=>`` (NULL keys match each other).
    """
    cols = target.columns
    src_cols = set(source.columns)
    source = dedupe_source(source, keys, source_order)
    t = target.select(*[F.col(c).alias(f"__t_{c}") for c in cols]).withColumn("__t_present", F.lit(True))
    s = source.select(*[F.col(c).alias(f"__s_{c}") for c in source.columns]).withColumn("__s_present", F.lit(True))
    j = t.join(s, _key_cond(t, s, keys, null_safe), "full_outer")

    in_t = F.coalesce(F.col("__t_present"), F.lit(False))
    in_s = F.coalesce(F.col("__s_present"), F.lit(False))

    def tcol(c: str) -> Column:
        return F.col(f"__t_{c}")

    def scol(c: str) -> Column:
        return F.col(f"__s_{c}") if c in src_cols else F.lit(None)

    if update is None:
        updates: dict = {}
    elif isinstance(update, Mapping):
        updates = dict(update)
    else:
        names = [c for c in cols if c not in keys] if "*" in update else list(update)
        updates = {c: (lambda tt, ss, c=c: ss(c)) for c in names}

    out = []
    for c in cols:
        inserted = (insert_values or {}).get(c, scol(c))
        if c in keys:
            value = F.when(in_t, tcol(c)).otherwise(scol(c))
        else:
            matched = updates[c](tcol, scol) if c in updates else tcol(c)
            value = F.when(in_t & in_s, matched).when(in_t, tcol(c)).otherwise(inserted)
        out.append(value.cast(target.schema[c].dataType).alias(c))
    keep = in_t | (in_s & F.lit(insert))
    return j.filter(keep).select(*out)


def insert_only(target: DataFrame, source: DataFrame, keys: Sequence[str], null_safe: bool = True) -> DataFrame:
    """``WHEN NOT MATCHED THEN INSERT *``: target plus source rows with new keys."""
    return merge_frames(target, source, keys, update=None, insert=True, null_safe=null_safe)


def replace_rows(target: DataFrame, seed: DataFrame, where: Column) -> DataFrame:
    """Delete-then-insert: drop target rows matching ``where`` and append ``seed``."""
    return target.filter(~F.coalesce(where, F.lit(False))).unionByName(seed.select(*target.columns))


def append_missing(target_columns: Sequence[str], df: DataFrame, types: Mapping[str, str] | None = None) -> DataFrame:
    """Give ``df`` the target column list, missing columns as typed NULLs (INSERT with NULL defaults)."""
    types = types or {}
    return df.select(*[
        F.col(c) if c in df.columns else F.lit(None).cast(types.get(c, "string")).alias(c) for c in target_columns
    ])
