"""Build landing rows from literal X12 text for tests."""

import datetime as dt

from claimflow.operators import bronze as B
from claimflow.operators import claims as C
from claimflow.sources.fixtures import fixture_profiles

ISA_TMPL = ("ISA{e}00{e}          {e}00{e}          {e}ZZ{e}SENDER         {e}ZZ{e}RECEIVER       {e}240101{e}1200"
            "{e}^{e}00501{e}000000001{e}0{e}P{e}{c}{s}")


def isa(e="*", c=":", s="~"):
    return ISA_TMPL.format(e=e, c=c, s=s)


def landing(spark, files):
    """files: list of (vendor, name, text_or_bytes)."""
    rows = []
    for vendor, name, body in files:
        data = body if isinstance(body, (bytes, bytearray)) else body.encode("utf-8")
        rows.append((f"/landing/x12/837/{vendor}/{name}", dt.datetime(2024, 1, 1), len(data), bytearray(data)))
    return spark.createDataFrame(rows, "path string, modificationTime timestamp, length bigint, content binary")


def parse_texts(spark, files, profiles=True):
    good, bad = B.split_rejects(B.ingest(landing(spark, files), "r", "2024-01-01 00:00:00"))
    res = C.parse(B.dedupe_by_hash(good), fixture_profiles(spark) if profiles else None)
    return res, bad


def claims_of(spark, files, **kw):
    res, _ = parse_texts(spark, files, **kw)
    return sorted([r.asDict(recursive=True) for r in res["claims"].collect()], key=lambda r: (r["file_path"], r["k"]))


def errors_of(spark, files, **kw):
    res, _ = parse_texts(spark, files, **kw)
    return sorted((r.file_path.rsplit("/", 1)[1], r.error_stage) for r in res["errors"].collect())
