"""Landing folder scans (SRC1-SRC3).

``scan_landing`` reads files as rows (``path, modificationTime, length,
content``) with Spark's ``binaryFile`` source, which holds the status of every
file on the driver. ``list_landing`` gives the files without their contents (the
listing used for discovery and size checks), and ``read_discovered`` the
contents of the files to process; both work in tasks where the folder's file system can be
read there, so that the driver holds no row a file.
"""

from __future__ import annotations

import os
import re
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from claimflow.session import materialize

LANDING_SCHEMA = "path string, modificationTime timestamp, length bigint, content binary"


def scan_landing(spark: SparkSession, root: str | Sequence[str], glob: str | None = None, max_bytes: int | None = None,
                 newer_than: str | None = None) -> DataFrame:
    """All files under ``root`` (recursively; ``glob`` narrows them), or exactly the listed paths when ``root`` is a list.

    ``max_bytes`` and ``newer_than`` (a timestamp) are filters on the file's
    status that the source takes itself (``PushedFilters``): files that are
    larger or not newer are listed, never opened.
    """
    r = spark.read.format("binaryFile").schema(LANDING_SCHEMA)
    if glob:
        r = r.option("pathGlobFilter", glob)
    files = r.option("recursiveFileLookup", "true").load(root) if isinstance(root, str) else r.load(list(root))
    if max_bytes is not None:
        files = files.filter(F.col("length") <= max_bytes)
    if newer_than is not None:
        files = files.filter(F.col("modificationTime") > F.lit(newer_than).cast("timestamp"))
    return files


def list_landing(spark: SparkSession, root: str | Sequence[str], glob: str | None = None, newer_than: str | None = None) -> DataFrame:
    """``path, length, modificationTime`` of the files; the file bytes are never read."""
    columns = ["path", "length", "modificationTime"]
    if glob or not isinstance(root, str) or file_system(root) is None:
        return scan_landing(spark, root, glob, newer_than=newer_than).select(*columns)
    files = _listed_in_tasks(spark, root)
    if newer_than is not None:
        files = files.filter(F.col("modificationTime") > F.lit(newer_than).cast("timestamp"))
    return files.select(*columns)


def file_system(root: str):
    """pyarrow's file system of ``root`` and the path in it; None when there is none."""
    import pyarrow
    import pyarrow.fs

    if root.startswith("/"):
        return pyarrow.fs.LocalFileSystem(), root
    try:
        return pyarrow.fs.FileSystem.from_uri(re.sub("^file:/*", "file:///", root))
    except (pyarrow.ArrowInvalid, pyarrow.ArrowNotImplementedError, OSError):
        return None


def _written(root: str, base: str) -> str:
    """What stands before a path of ``root``'s file system when Spark writes it."""
    return "file:" if root.startswith(("/", "file:")) else root[: root.rindex(base.rstrip("/"))]


def _listed_in_tasks(spark: SparkSession, root: str) -> DataFrame:
    """The files below ``root``, a level of folders after the other; a folder is listed by one task, its entries are stored."""
    fs, base = file_system(root)
    before = _written(root, base)

    def entries(folder):
        """(path, is a folder, bytes, time in ms) of what lies in a folder; a local one is read entry by entry."""
        import pyarrow.fs

        if isinstance(fs, pyarrow.fs.LocalFileSystem):
            with os.scandir(folder) as found:
                for x in found:
                    try:
                        st = x.stat()
                    except FileNotFoundError:  # gone since the folder was opened
                        continue
                    yield x.name, f"{folder.rstrip('/')}/{x.name}", x.is_dir(), st.st_size, st.st_mtime_ns // 1_000_000
            return
        for x in fs.get_file_info(pyarrow.fs.FileSelector(folder)):
            yield x.base_name, x.path, x.type == pyarrow.fs.FileType.Directory, x.size or 0, (x.mtime_ns or 0) // 1_000_000

    def listed(batches):
        import pyarrow as pa

        def batch(rows):
            path, folder, length, ms = (list(x) for x in zip(*rows))
            return pa.RecordBatch.from_arrays(
                [pa.array(path, pa.string()), pa.array(folder, pa.bool_()), pa.array(length, pa.int64()),
                 pa.array([x * 1000 for x in ms], pa.timestamp("us", tz="UTC"))], names=["path", "folder", "length", "modificationTime"])

        for b in batches:
            for f in b.column("path").to_pylist():
                rows = []
                for name, p, is_dir, size, ms in entries(f):
                    hidden = name.startswith(".") or (name.startswith("_") and "=" not in name) or name.endswith("._COPYING_")
                    if hidden or not (is_dir or size):
                        continue  # Spark's file sources leave these out, and empty files
                    rows.append((p if is_dir else before + p, is_dir, size, ms))
                    if len(rows) == 10_000:
                        yield batch(rows)
                        rows = []
                if rows:
                    yield batch(rows)

    folders, files = spark.createDataFrame([(base,)], "path string"), None
    while not folders.isEmpty():
        level = materialize(folders.mapInArrow(listed, "path string, folder boolean, length bigint, modificationTime timestamp"))
        own = level.filter(~F.col("folder")).drop("folder")
        files = own if files is None else files.unionByName(own)
        folders = level.filter("folder").select("path").repartition("path")
    return files


#: Bytes of contents that a task hands over at once.
BATCH_BYTES = 8 << 20


def _read_in_tasks(paths: DataFrame, root: str, max_bytes: int | None) -> DataFrame:
    """The landing rows of the listed files below ``root`` that are there and not larger than ``max_bytes``; others are not opened."""
    fs, base = file_system(root)
    below = f"{_written(root, base)}{base.rstrip('/')}/"
    skip = len(_written(root, base))

    def read(batches):
        import pyarrow as pa
        import pyarrow.fs

        def batch(rows):
            path, ms, length, content = (list(x) for x in zip(*rows))
            return pa.RecordBatch.from_arrays(
                [pa.array(path, pa.string()), pa.array([x * 1000 for x in ms], pa.timestamp("us", tz="UTC")), pa.array(length, pa.int64()),
                 pa.array(content, pa.binary())], names=["path", "modificationTime", "length", "content"])

        rows, size = [], 0
        for b in batches:
            for p in b.column("path").to_pylist():
                info = fs.get_file_info(p[skip:])
                if info.type != pyarrow.fs.FileType.File or not info.size or (max_bytes is not None and info.size > max_bytes):
                    continue
                with fs.open_input_stream(p[skip:], compression=None) as f:
                    rows.append((p, (info.mtime_ns or 0) // 1_000_000, info.size, f.read()))
                size += info.size
                if size >= BATCH_BYTES:
                    yield batch(rows)
                    rows, size = [], 0
        if rows:
            yield batch(rows)

    return paths.filter(F.col("path").startswith(below)).distinct().mapInArrow(read, LANDING_SCHEMA)


def read_discovered(spark: SparkSession, root: str, found: DataFrame, registry: DataFrame) -> DataFrame:
    """The landing rows of the files to process (``found`` of ``discover_files``).

    Files over the largest limit of any vendor that has limits everywhere are
    never opened. Each file is read by the task that holds its path.
    """
    limits = registry.filter(F.col("active_flag")).agg(
        F.max("max_file_size_mb").alias("most"),
        F.bool_or((F.coalesce("max_file_size_mb", F.lit(0)) == 0) | ~F.coalesce("quarantine_on_oversize", F.lit(False))).alias("free"),
    ).first()
    most = None if limits["free"] or limits["most"] is None else limits["most"] * 1024 * 1024
    todo = found.filter(F.col("action") == "PROCESS").select(F.col("file_path").alias("path"))
    if file_system(root) is not None:
        return _read_in_tasks(todo, root, most)
    return scan_landing(spark, root, max_bytes=most).join(todo, "path", "left_semi")
