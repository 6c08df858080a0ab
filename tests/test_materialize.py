"""Rows stored once: compressed, whole, and read by column."""

import os

from pyspark.sql import functions as F

from claimflow.session import ensure_checkpoint_dir, materialize


def _bytes_below(folder: str) -> int:
    folder = folder.removeprefix("file:")
    return sum(os.path.getsize(os.path.join(d, f)) for d, _, files in os.walk(folder) for f in files)


def test_stored_rows_are_whole_compressed_and_read_by_column(spark):
    df = spark.range(20000).select(
        F.when(F.col("id") % 7 != 0, F.col("id")).alias("id"), F.repeat(F.lit("SV1*HC:P1*10.00*UN*1.00~"), 40).alias("text"),
        F.array(F.struct(F.col("id").cast("string").alias("a"), F.lit(None).cast("double").alias("b"))).alias("nested"))
    before = _bytes_below(ensure_checkpoint_dir(spark))
    kept = materialize(df)
    size = _bytes_below(ensure_checkpoint_dir(spark)) - before
    assert 0 < size < 20000 * 24 * 40 / 4  # a checkpoint takes more than the text itself
    assert kept.columns == df.columns and kept.count() == 20000
    assert kept.exceptAll(df).isEmpty() and df.exceptAll(kept).isEmpty()
    plan = kept.select("id")._jdf.queryExecution().executedPlan().toString()
    assert "text" not in plan.split("ReadSchema")[-1]


def test_stored_without_rows(spark):
    none = spark.range(3).filter("id > 5")
    assert materialize(none).count() == 0 and materialize(none).columns == ["id"]
