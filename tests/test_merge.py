"""Merge algebra on small frames: insert-only, upsert, update-only, guarded, null-safe, replace."""

from pyspark.sql import functions as F

from claimflow.operators import merge as M

T = [(1, "a", 10.0), (2, "b", 20.0), (None, "n", 30.0)]
S = [(2, "B", 21.0), (3, "C", 31.0), (None, "N", 32.0), (3, "C2", 33.0)]
SCHEMA = "k int, s string, v double"


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=lambda t: (t[0] is None, t[0] or 0))


def test_insert_only_null_safe(spark):
    t, s = spark.createDataFrame(T, SCHEMA), spark.createDataFrame(S, SCHEMA)
    out = rows(M.insert_only(t, s, ["k"]))
    assert [r[0] for r in out] == [1, 2, 3, None]
    assert out[1] == (2, "b", 20.0) and out[3] == (None, "n", 30.0)


def test_plain_keys_reinsert_null_key(spark):
    t, s = spark.createDataFrame(T, SCHEMA), spark.createDataFrame(S, SCHEMA)
    out = rows(M.merge_frames(t, s, ["k"], null_safe=False))
    assert [r[0] for r in out].count(None) == 2


def test_upsert_with_source_tie_break(spark):
    t, s = spark.createDataFrame(T, SCHEMA), spark.createDataFrame(S, SCHEMA)
    out = rows(M.merge_frames(t, s, ["k"], update=["s", "v"], source_order="v"))
    assert out == [(1, "a", 10.0), (2, "B", 21.0), (3, "C2", 33.0), (None, "N", 32.0)]


def test_update_only_and_guarded(spark):
    t, s = spark.createDataFrame(T, SCHEMA), spark.createDataFrame(S, SCHEMA)
    out = rows(M.merge_frames(t, s, ["k"], update=["v"], insert=False))
    assert out == [(1, "a", 10.0), (2, "b", 21.0), (None, "n", 32.0)]
    guarded = {"s": lambda tt, ss: F.when(tt("s") == "b", tt("s")).otherwise(ss("s"))}
    out = rows(M.merge_frames(t, s, ["k"], update=guarded, insert=False))
    assert out == [(1, "a", 10.0), (2, "b", 20.0), (None, "N", 30.0)]


def test_merge_is_idempotent(spark):
    t, s = spark.createDataFrame(T, SCHEMA), spark.createDataFrame(S, SCHEMA)
    once = M.merge_frames(t, s, ["k"], update=["s", "v"], source_order="v")
    twice = M.merge_frames(once, s, ["k"], update=["s", "v"], source_order="v")
    assert rows(once) == rows(twice)


def test_replace_rows_and_append_missing(spark):
    t = spark.createDataFrame(T, SCHEMA)
    seed = spark.createDataFrame([(9, "z", 1.0)], SCHEMA)
    out = rows(M.replace_rows(t, seed, F.col("k").isNull()))
    assert out == [(1, "a", 10.0), (2, "b", 20.0), (9, "z", 1.0)]
    filled = M.append_missing(["k", "extra"], t.select("k"), {"extra": "bigint"})
    assert filled.schema["extra"].dataType.simpleString() == "bigint"
