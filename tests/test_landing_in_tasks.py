"""Landing folders listed and read in tasks: what Spark's own source gives, without a row a file on the driver."""

import os

import pytest
from pyspark.sql import functions as F

from claimflow.sources import config as cfg
from claimflow.sources.landing import list_landing, read_discovered, scan_landing


@pytest.fixture
def root(tmp_path):
    names = ["landing/x12/837/vendorA/a.x12", "landing/x12/837/vendorA/deep/er/b.x12", "landing/x12/837/vendorB/c d%41.x12", "top.x12",
             "landing/x12/837/vendorB/_hidden.x12", "landing/.dot/e.x12", "_tmp/f.x12", "landing/x12/837/vendorC/empty.x12", "g.x12._COPYING_"]
    for n, name in enumerate(names):
        path = tmp_path / name
        path.parent.mkdir(parents=True, exist_ok=True)
        path.write_bytes(b"" if "empty" in name else b"ISA*" * (n + 1))
        os.utime(path, (1_700_000_000 + n, 1_700_000_000.25 + n))
    (tmp_path / "nothing").mkdir()
    return str(tmp_path)


@pytest.mark.parametrize("form", ["{}", "file:{}", "file://{}"])
def test_listing_is_that_of_the_source(spark, root, form):
    cols = ["path", "length", "modificationTime"]
    got, want = list_landing(spark, form.format(root)), scan_landing(spark, root).select(cols)
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, want.collect())) and want.count() == 4
    # the files that the driver knows are the stored listing's
    assert not any(x.endswith(".x12") for x in got.inputFiles())
    assert list_landing(spark, root, newer_than="2023-11-14 22:13:22").count() == scan_landing(spark, root, newer_than="2023-11-14 22:13:22").count()
    assert list_landing(spark, root, glob="a*").count() == 1


def test_discovered_files_are_read_in_tasks(spark, root):
    found = list_landing(spark, root).select(F.col("path").alias("file_path"), F.when(~F.col("path").contains("top"), "PROCESS").alias("action"))
    there = found.unionByName(found.limit(1)).unionByName(spark.createDataFrame([(f"file:{root}/gone.x12", "PROCESS"), ("file:/a", "PROCESS")], found.schema))
    registry = cfg.vendor_registry(spark)
    rows = read_discovered(spark, root, there, registry)
    want = scan_landing(spark, root).filter(~F.col("path").contains("top"))
    key = lambda r: (r.path, r.modificationTime, r.length, bytes(r.content))
    assert rows.schema == want.schema and sorted(map(key, rows.collect())) == sorted(map(key, want.collect()))
    assert not any(x.endswith(".x12") for x in rows.inputFiles())


def test_oversize_files_are_not_read(spark, tmp_path):
    for name, n in (("a.x12", 10), ("big.x12", 1024 * 1024 + 1)):
        (tmp_path / name).write_bytes(b"x" * n)
    registry = cfg.vendor_registry(spark).withColumn("max_file_size_mb", F.lit(1))
    found = list_landing(spark, str(tmp_path)).select(F.col("path").alias("file_path"), F.lit("PROCESS").alias("action"))
    assert [r.length for r in read_discovered(spark, str(tmp_path), found, registry).collect()] == [10]
