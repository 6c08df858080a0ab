"""Declared tables: pruning, replacement by file, failed loads, marks, partial sums, the gate's parts."""

import contextlib
import io
import pathlib
import tempfile

import pytest
from helpers import isa, landing
from pyspark.sql import functions as F

from claimflow.operators import audit as A
from claimflow.operators import quality as Q
from claimflow.plans import pipeline as P
from claimflow.plans.tables import TABLES, ClaimTables
from claimflow.sources import config as cfg
from claimflow.sources.fixtures import fixture_profiles

TS = "2024-06-01 00:00:00"


def tables(spark):
    return ClaimTables(spark, tempfile.mkdtemp(prefix="run-", dir="/tmp") + "/wh", buckets=4)


def partial(spark, files, source="claim_header", n=1):
    rows = [(source, "v", f, "1", "V", "r", n, 0, None) for f in files]
    return spark.createDataFrame(rows, A.PARTIAL_SCHEMA)


def plan_of(df):
    out = io.StringIO()
    with contextlib.redirect_stdout(out):
        df.explain("formatted")
    return out.getvalue()


def load(st, name, df, **kw):
    n = st.begin([name])
    st.append(name, df, n, **kw)
    st.commit(n, [name], f"run-{n}")
    return n


def test_every_table_is_declared_and_readable(spark):
    st = tables(spark)
    st.declare_all()
    assert all(st.read(t).isEmpty() for t in TABLES if t != "load_batch")
    st.declare_all()  # again: nothing happens


def test_rows_are_stored_compressed(spark):
    st = tables(spark)
    load(st, "file_partial", partial(spark, ["f1", "f2"]))
    files = [p.name for p in pathlib.Path(st.root).rglob("*.parquet")]
    assert len(files) > 1 and all(".zstd." in f for f in files)


def test_a_delta_and_a_lookup_read_their_partitions_only(spark):
    st = tables(spark)
    for k in range(3):
        load(st, "file_partial", partial(spark, [f"f{i}" for i in range(k * 20, k * 20 + 20)]))
    ctx = P.RunContext(spark, st, "r", TS)
    ctx.advance("c", "file_partial", 2)
    delta = ctx.delta("c", "file_partial")
    plan = plan_of(delta)
    assert "(batch" in plan.split("PartitionFilters:")[1].split("\n")[0]
    assert all(f"batch={b}" not in plan for b in (1, 2)) and "batch=3" in plan
    assert {r.file_hash for r in delta.collect()} == {f"f{i}" for i in range(40, 60)}
    one = spark.createDataFrame([("f3",)], "file_hash string")
    found = st.of_files("file_partial", one)
    filters = plan_of(found).split("PartitionFilters:")[1].split("\n")[0]
    assert "bucket" in filters and found.count() == 1


def test_rows_of_files_are_deleted_in_their_partitions(spark):
    st = tables(spark)
    names = [f"f{i}" for i in range(40)]
    load(st, "file_partial", partial(spark, names))
    load(st, "file_partial", partial(spark, ["alone"]))
    gone = spark.createDataFrame([(n,) for n in [*names[:7], "alone", "unknown"]], "file_hash string")
    before = {r.partition for r in spark.sql(f"SHOW PARTITIONS {st.declare('file_partial')}").collect()}
    st.delete_files("file_partial", gone)
    assert {r.file_hash for r in st.read("file_partial").collect()} == set(names[7:])
    after = {r.partition for r in spark.sql(f"SHOW PARTITIONS {st.declare('file_partial')}").collect()}
    assert {p for p in before - after if p.startswith("batch=2")} and not {p for p in after if p.startswith("batch=2")}
    assert st.delete_files("file_partial", gone) == 0


def test_rows_are_updated_in_place_and_new_ones_added(spark):
    st = tables(spark)
    rows = [("v", f"f{i}", "p", "r", "SILVER", "S", "old", None) for i in range(10)]
    ddl = TABLES["quarantine_files"].columns
    load(st, "quarantine_files", spark.createDataFrame(rows, ddl))
    new = spark.createDataFrame([("v", f"f{i}", "p", "r", "SILVER", "S", "new", None) for i in (3, 99)], ddl)
    ctx = P.RunContext(spark, st, "r", TS)
    n = st.begin(["quarantine_files"])
    P._quarantine(ctx, new, n)
    got = {r.file_hash: (r.reason, r.batch) for r in st.table("quarantine_files").collect()}
    assert got == {**{f"f{i}": ("old", 1) for i in range(10)}, "f3": ("new", 1), "f99": ("new", 2)}


def test_a_failed_load_leaves_nothing(spark):
    st = tables(spark)
    load(st, "file_partial", partial(spark, ["a"]))
    n = st.begin(["file_partial"])
    st.append("file_partial", partial(spark, ["b", "c"]), n)  # fails before it is counted in
    ctx = P.RunContext(spark, st, "r", TS)
    assert {r.file_hash for r in ctx.delta("c", "file_partial").collect()} == {"a"}
    assert load(st, "file_partial", partial(spark, ["b"])) == n
    assert sorted(r.file_hash for r in st.read("file_partial").collect()) == ["a", "b"]


def test_a_catalog_without_the_tables_finds_them_again(spark):
    st = tables(spark)
    st.write("dq_rules_837", cfg.dq_rules(spark))
    n = load(st, "file_partial", partial(spark, ["a", "b"]))
    again = ClaimTables(spark, st.root, buckets=4, database="claims_found_again")  # no table is known under that name
    assert again.committed == n and again.read("file_partial").count() == 2 and again.read("dq_rules_837").count() == 9


def test_compacted_loads_keep_their_rows(spark):
    st = tables(spark)
    for k in range(4):
        load(st, "file_partial", partial(spark, [f"f{k}", "g"]))
    before = sorted(tuple(r) for r in st.read("file_partial").collect())
    st.compact("file_partial", 3)
    assert sorted(tuple(r) for r in st.read("file_partial").collect()) == before
    assert {r.batch for r in st.table("file_partial").select("batch").collect()} == {3, 4}


class Loads:
    """Stands in for the tables where only the loads count."""

    def __init__(self, loads):
        self.loads = loads

    def newer(self, name, since):
        return [(n, v) for n, v in self.loads if n > since]


def test_marks_follow_the_vendors_that_have_rows():
    loads = []
    ctx = P.RunContext(None, Loads(loads), "r", TS, _marks={})
    mark = lambda v: ctx._marks["c", "s"].get(v, ctx._marks["c", "s"][None])
    loads.append((1, ["A", "B"]))
    ctx.vendor_ids = ["A"]
    ctx.advance("c", "s", 1)
    assert mark("A") == 1 and mark("B") == 0 and mark("idle") == 0  # B's rows are still to be read
    ctx.vendor_ids = ["B"]
    ctx.advance("c", "s", 1)
    assert mark("A") == mark("B") == mark("idle") == 1 and len(ctx._marks["c", "s"]) == 1
    loads.append((2, ["A"]))
    ctx.vendor_ids = ["A"]
    ctx.advance("c", "s", 2)
    assert mark("A") == mark("B") == mark("idle") == 2  # nobody else has rows in load 2
    loads.append((3, None))  # of any vendor
    ctx.advance("c", "s", 3)
    assert mark("A") == 3 and mark("B") == mark("idle") == 2
    ctx.vendor_ids = None
    ctx.advance("c", "s", 4)
    assert ctx._marks["c", "s"] == {None: 4}


CLAIMS = "".join(f"CLM*A{i}*{i}.50~HI*ABK:D{i}~LX*1~SV1*HC:P{i}*1*UN*1~" for i in range(5))
TEXT = isa() + f"ST*837*1*V~{CLAIMS}SE*9*1~"


def pipeline(spark):
    st = tables(spark)
    P.seed_config(spark, st)
    st.write("vendor_837_profile", fixture_profiles(spark))
    return st


def run(spark, st, files, run_id, steps=None):
    P.run_pipeline(P.RunContext(spark, st, run_id, TS), landing(spark, files), steps)


def test_ops_read_no_row_of_an_earlier_load(spark):
    st = pipeline(spark)
    files = [("vendorA", f"f{i}.x12", TEXT.replace("000000001", f"{i:09d}")) for i in range(1, 9)]
    run(spark, st, files[:6], "r1")
    first = {tuple(r) for r in st.read("file_audit").drop("last_updated_ts").collect()}
    for t in ["silver_837_claim", *P.G.NORMALIZERS]:  # whatever reads these rows again will miss them
        for n, _ in st.newer(t, 0):
            for part in st._parts_of(t, n):
                st._drop(t, part)
    run(spark, st, files, "r2")
    audit = st.read("file_audit").drop("last_updated_ts").collect()
    assert first <= {tuple(r) for r in audit} and len(audit) == 8
    assert {(r.status, r.silver_claim_count, r.gold_service_line_count) for r in audit} == {("GOLD_BUILT", 5, 5)}
    assert {(r.bronze_run_id, r.silver_run_id, r.gold_run_id) for r in audit} == {("r1",) * 3, ("r2",) * 3}
    assert st.read("recon_summary").filter("header_match AND lines_match AND amount_match").count() == 8


def test_a_file_parsed_again_to_less_leaves_no_row_behind(spark):
    st = pipeline(spark)
    other = TEXT.replace("000000001", "000000007")
    run(spark, st, [("vendorA", "a.x12", TEXT), ("vendorA", "b.x12", other)], "r1")
    hash_a = st.read("bronze_837_raw").filter("file_path LIKE '%/a.x12'").select("file_hash")
    profile = st.read("vendor_837_profile").withColumns({"use_isa_delimiters": F.lit(False), "segment_delim": F.lit("SE")})
    st.write("vendor_837_profile", profile)  # the whole file is one segment now
    ctx = P.RunContext(spark, st, "r2", TS)
    P.silver_step(ctx, reprocess=hash_a)
    P.run_pipeline(ctx, landing(spark, []), ["GOLD_HEADER", "GOLD_LINES", "GOLD_DX", "GOLD_PROVIDER", "GOLD_SUB_PAT", "GOLD_OTHER_PAYER", "OPS_AUDIT"])
    for t, n in (("silver_837_claim", 5), ("claim_header", 5), ("claim_service_line", 5), ("claim_diagnosis", 5), ("recon_summary", 1)):
        assert st.read(t).count() == n, t
    audit = {r.file_path.rsplit("/", 1)[1]: (r.status, r.silver_claim_count) for r in st.read("file_audit").collect()}
    assert audit == {"a.x12": ("BRONZE_LOADED", None), "b.x12": ("GOLD_BUILT", 5)}
    assert [r.error_stage for r in st.read("silver_837_parse_error").collect()] == ["no_st_837"]


def test_held_files_stay_out_until_they_are_released(spark):
    st = pipeline(spark)
    on = F.col("enabled_flag") | (F.col("step_name") == "QUARANTINE_GATE")
    st.write("pipeline_steps", st.read("pipeline_steps").withColumn("enabled_flag", on))
    st.write("vendor_registry", st.read("vendor_registry").withColumn("expected_version", F.lit("V")))
    wrong = TEXT.replace("000000001", "000000002").replace("ST*837*1*V", "ST*837*1*W")
    run(spark, st, [("vendorA", "a.x12", TEXT), ("vendorA", "w.x12", wrong)], "r1")
    q = st.read("quarantine_files").collect()
    assert [(r.stage, r.reason) for r in q] == [("VERSION", "Version W, expected V")]
    assert st.read("claim_header").select("file_hash").distinct().count() == 1
    status = lambda: {r.file_path.rsplit("/", 1)[1]: r.status for r in st.read("file_audit").collect()}
    assert status() == {"a.x12": "GOLD_BUILT", "w.x12": "QUARANTINED"}
    ctx = P.RunContext(spark, st, "r2", TS)
    P.silver_step(ctx, reprocess=spark.createDataFrame([(q[0].file_hash,)], "file_hash string"))
    steps = ["GOLD_HEADER", "GOLD_LINES", "OPS_AUDIT"]
    P.run_pipeline(ctx, landing(spark, []), steps)
    assert st.read("claim_header").count() == 5 and status()["w.x12"] == "QUARANTINED"  # parsed again, still held
    ctx = P.RunContext(spark, st, "r3", TS)
    P.release_files(ctx, spark.createDataFrame([(q[0].file_hash,)], "file_hash string"))
    P.run_pipeline(ctx, landing(spark, []), steps)
    assert st.read("claim_header").count() == 10 and status()["w.x12"] == "GOLD_BUILT"


def test_audit_changes_meet_in_one_row(spark):
    cols = A.FILE_AUDIT_COLUMNS
    old = spark.createDataFrame([tuple({"file_hash": h, "vendor_id": "v", "status": s, "file_path": "p", "gold_dx_count": 4}.get(c) for c in cols)
                                 for h, s in (("kept", "GOLD_BUILT"), ("held", "QUARANTINED"), ("back", "QUARANTINED"), ("lost", "GOLD_BUILT"))],
                                ", ".join(f"{c} {t}" for c, t in A.FILE_AUDIT_TYPES.items()))
    files = lambda *names: spark.createDataFrame([(n,) for n in names], "file_hash string")
    sums = partial(spark, ["held", "back", "nowhere"], A.SILVER, 2).unionByName(partial(spark, ["held", "back", "nowhere"], n=2))
    got = A.merge_file_audit(old, recon=A.reconcile_files(sums, TS), quarantined=files("kept"), replaced=files("back", "lost"))
    assert {r.file_hash: (r.status, r.silver_claim_count, r.gold_dx_count) for r in got.collect()} == {
        "kept": ("QUARANTINED", None, 4), "held": ("QUARANTINED", 2, 0), "back": ("GOLD_BUILT", 2, 0), "lost": ("BRONZE_LOADED", None, None)}


def test_a_manifest_tells_rows_that_pairwise_cancel(spark):
    ddl = "vendor_id string, claim_key string, claim_amount double"
    base = [("v", "a", 1.0), ("v", "z", 2.0)]
    one = spark.createDataFrame([*base, ("v", "b", 1.0), ("v", "b", 1.0)], ddl)
    two = spark.createDataFrame([*base, ("v", "c", 1.0), ("v", "c", 1.0)], ddl)
    h = [Q.partner_manifest(df).first() for df in (one, two, one.repartition(3))]
    assert h[0].rows_hash != h[1].rows_hash and h[0].rows_hash == h[2].rows_hash
    assert tuple(h[0])[1:5] == tuple(h[1])[1:5]


def test_extract_files_follow_the_order_of_their_rows(spark):
    ddl = "vendor_id string, claim_key string, claim_amount double"
    df = spark.createDataFrame([("big" if i % 3 else "small", f"{(i * 7919) % 5000:05d}", 1.0) for i in range(5000)], ddl)
    out = tempfile.mkdtemp(prefix="run-", dir="/tmp") + "/extract"
    Q.write_partner_extract(df, out, files=6)
    back = spark.read.parquet(out).withColumn("file", F.regexp_extract(F.input_file_name(), r"part-(\d+)", 1))
    per = back.groupBy("vendor_id", "file").agg(F.min("claim_key").alias("lo"), F.max("claim_key").alias("hi")).collect()
    assert back.count() == 5000
    for v in ("big", "small"):
        ranges = [(r.lo, r.hi) for r in sorted((r for r in per if r.vendor_id == v), key=lambda r: r.file)]
        assert all(a[1] < b[0] for a, b in zip(ranges, ranges[1:]))
    assert len([r for r in per if r.vendor_id == "big"]) > 2  # not one task


def test_only_errors_of_the_data_are_rule_errors(spark):
    frame = spark.createDataFrame([("x",)], "t string")
    with pytest.raises(Exception) as bad:
        frame.selectExpr("cast(t as int)").collect()
    assert Q.is_data_error(bad.value)
    with pytest.raises(Exception) as missing:
        spark.read.parquet("/tmp/no-such-folder-here").collect()
    assert not Q.is_data_error(missing.value) and not Q.is_data_error(RuntimeError("lost"))


def test_samples_keep_the_rows_that_fill_the_budget(spark):
    rows = [("v", "f", i, "t" * (i % 5) * 300) for i in range(40)]
    df = spark.createDataFrame(rows, "vendor_id string, file_hash string, i int, t string")
    rules = spark.createDataFrame([("R", "all", "E", "WARN", None, True, "i >= 0", cfg.SEED_TS, cfg.SEED_TS)], cfg.DQ_RULES_SCHEMA)
    for least in (3, 20):
        got = Q.run_dq_rules({"E": df}, rules, "p", "r", TS, sample_order=["i"], least_row_chars=least).first()
        whole = "[" + ",".join(f'{{"vendor_id":"v","file_hash":"f","i":{i},"t":"{t}"}}' for _, _, i, t in rows) + "]"
        assert got.sample_values == whole[: Q.SAMPLE_CHARS] and got.failed_count == 40


def test_pushed_down_discovery_never_opens_large_or_old_files(spark, tmp_path):
    from claimflow.sources.landing import scan_landing

    for name, n in (("a.x12", 10), ("big.x12", 5000)):
        (tmp_path / name).write_bytes(b"I" * n)
    files = scan_landing(spark, str(tmp_path), max_bytes=100, newer_than="2000-01-01 00:00:00")
    plan = plan_of(files)
    assert "LessThanOrEqual(length,100)" in plan and "GreaterThan(modificationTime" in plan
    assert [r.length for r in files.collect()] == [10]
    assert scan_landing(spark, str(tmp_path), newer_than="2999-01-01 00:00:00").count() == 0
