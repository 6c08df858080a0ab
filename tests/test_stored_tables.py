"""The stored tables: no row lost on load, seeds kept, rules applied once, vendors apart."""

import tempfile

import pytest
from helpers import isa, landing

from claimflow.operators import merge as M
from claimflow.plans import pipeline as P
from claimflow.sources import config as cfg
from claimflow.sources.fixtures import fixture_profiles

# service lines without LX and with one code, revenue-only lines, one rendering provider named twice, a repeated claim id
TEXT = (isa() + "ST*837*1*V~CLM*A*10***11:B:1~SV1*HC:99213*5*UN*1~SV1*HC:99213*5*UN*1~SV2*0450**2*UN*1~SV2*0300**3*UN*1~"
        "NM1*82*1*DOE*J****XX*111~NM1*82*1*DOE*J****XX*111~CLM*B*1~SV1*HC:1*1*UN*1~CLM* B2 *7~SV1*HC:2*7*UN*1~"
        "CLM*B*2~SV1*HC:3*2*UN*1~SE*14*1~")


def make(spark, steps=None):
    store = P.ClaimTables(spark, tempfile.mkdtemp(prefix="run-", dir="/tmp") + "/wh")
    P.seed_config(spark, store)
    store.write("vendor_837_profile", fixture_profiles(spark))
    return store


def run(spark, store, files, run_id, steps=None):
    P.run_pipeline(P.RunContext(spark, store, run_id, "2024-06-01 00:00:00"), landing(spark, files), steps)


def enable(store, step):
    from pyspark.sql import functions as F

    t = store.read("pipeline_steps")
    store.write("pipeline_steps", t.withColumn("enabled_flag", F.col("enabled_flag") | (F.col("step_name") == step)))


def test_every_child_row_is_stored_and_replaced_claims_are_kept_aside(spark):
    store = make(spark)
    for run_id in ("r1", "r2"):
        run(spark, store, [("vendorA", "a.x12", TEXT)], run_id)
        lines = store.read("claim_service_line").collect()
        got = sorted([(r.procedure_code, r.rev_code) for r in lines if r.claim_id == "A"], key=str)
        assert got == sorted([("99213", None), ("99213", None), (None, "0450"), (None, "0300")], key=str)
        assert store.read("claim_provider").filter("claim_id = 'A' AND npi = '111'").count() == 2
        old = store.read("silver_837_claim_superseded").collect()
        assert [(r.claim_id, r.claim_amount, r.claims_with_id) for r in old] == [("B", 1.0, 2)]
        assert store.read("silver_837_claim").filter("claim_id = 'B'").first().claim_amount == 2.0
        fa = store.read("file_audit").first()
        assert fa.status == "GOLD_BUILT" and fa.silver_service_line_count == fa.gold_service_line_count == 6


def test_the_row_that_stays_does_not_depend_on_partitioning(spark):
    rows = [("k", i, f"v{i % 7}") for i in range(50)]
    df = spark.createDataFrame(rows, "k string, a int, v string")
    got = {tuple(M.dedupe_source(df.repartition(n), ["k"]).first()) for n in (1, 2, 3, 5, 8)}
    assert got == {("k", 49, "v0")}


def test_seeding_again_keeps_what_users_added(spark):
    store = make(spark)
    role = spark.createDataFrame([("vA", None, "82", "OWN", 1, True, cfg.SEED_TS, cfg.SEED_TS)], cfg.NM1_ROLE_SCHEMA)
    rule = spark.createDataFrame([("U1", "own", "SILVER_CLAIM", "WARN", None, True, "claim_amount > 5", cfg.SEED_TS, cfg.SEED_TS)], cfg.DQ_RULES_SCHEMA)
    store.append("nm1_role_map", role)
    store.append("dq_rules_837", rule)
    store.write("vendor_step_overrides", cfg.step_overrides(spark, [("vendorA", "GOLD_DX", False, None)]))
    before = {t: store.read(t).count() for t in ("nm1_role_map", "dq_rules_837", "vendor_step_overrides", "vendor_registry", "pipeline_steps")}
    P.seed_config(spark, store)
    assert {t: store.read(t).count() for t in before} == before
    assert store.read("nm1_role_map").filter("role_name = 'OWN'").count() == 1
    assert store.read("dq_rules_837").filter("rule_id = 'U1'").count() == 1


def test_standardization_meets_every_claim_once(spark):
    store = make(spark)
    enable(store, "SILVER_STD")
    rule = spark.createDataFrame([("S9", "prefix", None, "silver_837_claim", "claim_id", "REGEX_REPLACE", '{"pattern":"^","replacement":"X-"}',
                                   True, cfg.SEED_TS, cfg.SEED_TS)], cfg.STD_RULES_SCHEMA)
    store.append("silver_standardization_rules", rule)
    run(spark, store, [("vendorA", "a.x12", TEXT)], "r1")
    more = TEXT.replace("CLM*A*", "CLM*N*").replace("000000001", "000000002")
    run(spark, store, [("vendorA", "a.x12", TEXT), ("vendorA", "b.x12", more)], "r2")
    want = ["X-A", "X-B", "X-B2", "X-B", "X-B2", "X-N"]
    assert sorted(r.claim_id for r in store.read("silver_837_claim").collect()) == sorted(want)
    assert sorted(r.claim_id for r in store.read("claim_header").collect()) == sorted(want)


def test_ops_runs_without_a_gold_table_and_with_a_failing_rule(spark):
    store = make(spark)
    bad = spark.createDataFrame([("BAD", "cast", "SILVER_CLAIM", "ERROR", None, True, "cast(claim_id as int) > 1", cfg.SEED_TS, cfg.SEED_TS),
                                 ("POS", "positive", "SILVER_CLAIM", "WARN", None, True, "claim_amount > 5", cfg.SEED_TS, cfg.SEED_TS)], cfg.DQ_RULES_SCHEMA)
    store.append("dq_rules_837", bad)
    names = ["BRONZE", "SILVER", "GOLD_HEADER", "GOLD_LINES", "GOLD_DX", "GOLD_PROVIDER", "GOLD_SUB_PAT", "OPS_AUDIT"]
    run(spark, store, [("vendorA", "a.x12", TEXT)], "r1", names)
    assert store.read("claim_other_payer").isEmpty()
    assert store.read("file_audit").first().status == "GOLD_BUILT"
    dq = {r.rule_id: (r.severity, r.failed_count) for r in store.read("dq_results").collect()}
    assert dq["BAD"][0] == "RULE_ERROR" and dq["POS"] == ("WARN", 2)


def test_one_vendor_fails_one_skips_bronze_and_the_third_goes_on(spark, monkeypatch):
    store = make(spark)
    store.write("vendor_step_overrides", cfg.step_overrides(spark, [("vendorC", "BRONZE", False, None)]))
    files = [(v, "a.x12", TEXT.replace("000000001", f"00000000{i}")) for i, v in enumerate(("vendorA", "vendorB", "vendorC"), 1)]
    land = landing(spark, files).cache()
    real = P.gold_header_step

    def header(ctx):
        if "vendorB" in ctx.vendor_ids:
            raise RuntimeError("vendorB is broken")
        real(ctx)

    monkeypatch.setitem(P.STEP_FUNCTIONS, "GOLD_HEADER", header)
    P.orchestrate(P.RunContext(spark, store, "o1", "2024-06-01 00:00:00"), land.select("path", "length"), land)
    state = {r.vendor_id: (r.last_status, r.notes) for r in store.read("vendor_state").collect()}
    assert state["vendorA"][0] == "SUCCESS" and state["vendorB"][0] == "FAILED" and "GOLD_HEADER" in state["vendorB"][1]
    stored = lambda t: {r.vendor_id for r in store.read(t).select("vendor_id").distinct().collect()}
    assert stored("bronze_837_raw") == {"vendorA", "vendorB"}  # vendorC's bronze is off
    assert stored("claim_header") == stored("claim_service_line") == {"vendorA"}  # vendorB stopped at its failing step
    assert {r.vendor_id: r.status for r in store.read("file_audit").collect()}["vendorA"] == "GOLD_BUILT"
    # mended, the next run takes up vendorB where it stopped
    monkeypatch.setitem(P.STEP_FUNCTIONS, "GOLD_HEADER", real)
    P.orchestrate(P.RunContext(spark, store, "o2", "2024-06-02 00:00:00"), land.select("path", "length"), land)
    assert stored("claim_header") == stored("claim_service_line") == {"vendorA", "vendorB"}


@pytest.mark.parametrize("body", [b"not a claim", "é".encode("latin-1")])
def test_files_of_any_name_reach_the_quarantine(spark, tmp_path, body):
    from claimflow.sources.landing import scan_landing

    folder = tmp_path / "landing/x12/837/vendorA"
    folder.mkdir(parents=True)
    (folder / "odd.csv").write_bytes(body)
    store = make(spark)
    P.bronze_step(P.RunContext(spark, store, "r", "2024-06-01 00:00:00"), scan_landing(spark, str(tmp_path)))
    assert store.read("bronze_837_quarantine").count() == 1


def test_the_gate_shuffles_no_claims(spark):
    """Held files are broadcast, so that the rows that pass are not sent by file."""
    from claimflow.operators import quality as Q
    from claimflow.plans.tables import QUARANTINE_SCHEMA

    held = spark.createDataFrame([("vendorA", "h1", "p", "r", Q.GATE_STAGES[0], "x", "y", None), ("vendorA", "h2", "p", "r", "SILVER", "x", "y", None)],
                                 QUARANTINE_SCHEMA)
    rows = spark.createDataFrame([("h1", 1), ("h2", 2), ("h3", 3), (None, 4)], "file_hash string, n int")
    got = Q.pass_gate(rows, held)
    assert sorted(r.n for r in got.collect()) == [2, 3, 4]
    assert "strategy=broadcast" in got._jdf.queryExecution().optimizedPlan().toString()


def test_the_parse_does_not_send_contents_by_vendor(spark):
    """The size of a catalog table is not known to Spark: its rows are counted, and the profiles broadcast."""
    from claimflow.operators import segments as S

    store = make(spark)
    files = spark.createDataFrame([("vendorA", TEXT)], "vendor_id string, content_str string")
    got = S.resolve_delimiters(files, store.read("vendor_837_profile"))
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan and "SortMergeJoin" not in plan
