"""DQ engine, samples, standardization, discovery (oversize), effective steps, vendor state."""

from pyspark.sql import functions as F

from claimflow.operators import orchestration as O
from claimflow.operators import quality as Q
from claimflow.sources import config as cfg


def _rules(spark, rows):
    return spark.createDataFrame([(*r[:5], True, r[5], cfg.SEED_TS, cfg.SEED_TS) for r in rows], cfg.DQ_RULES_SCHEMA)


def test_dq_counts_scope_nulls_and_rule_errors(spark):
    df = spark.createDataFrame(
        [("vA", "f1", 5.0), ("vA", "f1", -1.0), ("vB", "f2", -2.0), ("vB", "f2", None)] + [("vA", "f3", -3.0)] * 50,
        "vendor_id string, file_hash string, amt double")
    rules = _rules(spark, [("N1", "neg", "E", "ERROR", None, "amt < 0"), ("N2", "neg B", "E", "WARN", "vB", "amt < 0"),
                           ("BAD", "bad", "E", "ERROR", None, "nope = 1"), ("SUB", "sub", "E", "ERROR", None,
                                                                            "amt IN (SELECT 1)"),
                           ("NB", "not bool", "E", "ERROR", None, "amt + 1")])
    out = Q.run_dq_rules({"E": df}, rules, "p", "r", "2024-01-01 00:00:00")
    got = sorted((r.rule_id, r.file_hash, r.failed_count, r.severity) for r in out.collect())
    assert got == [("BAD", None, None, "RULE_ERROR"), ("N1", "f1", 1, "ERROR"), ("N1", "f2", 1, "ERROR"),
                   ("N1", "f3", 50, "ERROR"), ("N2", "f2", 1, "WARN"), ("NB", None, None, "RULE_ERROR"),
                   ("SUB", None, None, "RULE_ERROR")]
    f3 = out.filter("file_hash = 'f3' AND rule_id = 'N1'").first().sample_values
    whole = "[" + ",".join(['{"vendor_id":"vA","file_hash":"f3","amt":-3.0}'] * 50) + "]"
    assert f3 == whole[:Q.SAMPLE_CHARS]  # cut at the characters, not at a number of rows


def test_dq_rules_that_are_hard_to_run(spark):
    df = spark.createDataFrame([("vA", "f1", "SELECT", 5.0), (None, None, "x", -1.0), ("vA", "f1", "7", 2.0)],
                               "vendor_id string, file_hash string, nm string, amt double")
    rules = _rules(spark, [("O'B", "apostrophe", "E", "ERROR", None, "amt < 0"), ("SEL", "literal", "E", "WARN", None, "nm = 'SELECT'"),
                           ("AGG", "aggregate", "E", "ERROR", None, "sum(amt) > 1"),
                           ("WIN", "window", "E", "ERROR", None, "row_number() over (order by amt) > 1"),
                           ("LAM", "lambda", "E", "WARN", None, "exists(array(amt), a -> a > 4)"),
                           ("SUB", "subquery", "E", "ERROR", None, "exists (select 1)"),
                           ("CAST", "cast", "E", "ERROR", None, "cast(nm as int) > 1")])
    out = Q.run_dq_rules({"E": df}, rules, "p", "r", "2024-01-01 00:00:00", probe=True)
    got = {r.rule_id: (r.file_hash, r.failed_count, r.severity, r.sample_values) for r in out.collect()}
    assert {k for k, v in got.items() if v[2] == "RULE_ERROR"} == {"AGG", "WIN", "SUB", "CAST"}
    assert got["SEL"][:2] == ("f1", 1) and got["LAM"][:2] == ("f1", 1)
    assert got["O'B"][:2] == (None, 1) and '"nm":"x"' in got["O'B"][3]  # null vendor and file keep their sample


def test_standardization_scopes_and_defaults(spark):
    df = spark.createDataFrame([("vA", " x ", None), ("vB", " y ", 2.0)], "vendor_id string, claim_id string, claim_amount double")
    rules = cfg.standardization_rules(spark)
    out = sorted(tuple(r) for r in Q.apply_standardization(df, rules, "silver_837_claim").collect())
    assert out == [("vA", "x", 0.0), ("vB", "y", 2.0)]


def test_discover_oversize_regex_and_folder(spark):
    listing = spark.createDataFrame([
        ("/landing/x12/837/vendorA/a.x12", 10), ("/landing/x12/837/vendorA/big.x12", 300 * 1024 * 1024),
        ("/landing/x12/837/vendorA/note.txt", 5), ("/landing/x12/837/vendorA/sub/deep.x12", 5),
        ("/landing/x12/837/vendorQ/q.x12", 5),
    ], "path string, length bigint")
    found = O.discover_files(listing, cfg.vendor_registry(spark))
    got = sorted((r.file_path.rsplit("/", 1)[1], r.action) for r in found.collect())
    assert got == [("a.x12", "PROCESS"), ("big.x12", "OVERSIZE")]
    q = O.oversize_quarantine(found, "r", "2024-01-01 00:00:00").collect()
    assert len(q) == 1 and q[0].rule_id == "OVERSIZE"


def test_effective_steps_overrides_and_params(spark):
    vendors = O.active_vendors(cfg.vendor_registry(spark))
    ov = cfg.step_overrides(spark, [("vendorA", "GOLD_DX", False, '{"x": "1"}'), ("vendorB", "BRONZE", None, '{"vendor_id": "other"}')])
    plan = O.effective_steps(vendors, cfg.pipeline_steps(spark), ov, master_run_id="m")
    rows = {(r.vendor_id, r.step_name): r for r in plan.collect()}
    assert len(rows) == 27 and ("vendorA", "SILVER_STD") not in rows
    assert rows[("vendorA", "GOLD_DX")].enabled is False and rows[("vendorA", "GOLD_DX")].params["x"] == "1"
    assert rows[("vendorB", "BRONZE")].params["vendor_id"] == "other"  # override params win
    assert rows[("vendorC", "SILVER")].timeout_seconds == 7200 and rows[("vendorC", "SILVER")].params["master_run_id"] == "m"


def test_vendor_state_failure_keeps_last_success(spark):
    st = cfg.empty_vendor_state(spark)
    ok = spark.createDataFrame([("vendorA", True, None)], "vendor_id string, ok boolean, notes string")
    s1 = O.update_vendor_state(st, O.vendor_outcomes(ok, "r1", "2024-01-01 00:00:00"))
    bad = spark.createDataFrame([("vendorA", False, "boom")], "vendor_id string, ok boolean, notes string")
    s2 = O.update_vendor_state(s1, O.vendor_outcomes(bad, "r2", "2024-01-02 00:00:00")).first()
    assert s2.last_status == "FAILED" and s2.last_run_id == "r2" and s2.notes == "boom"
    assert str(s2.last_success_ts) == "2024-01-01 00:00:00"


def test_scoped_lookup_precedence(spark):
    data = spark.createDataFrame([("vA", "82"), ("vB", "82"), ("vB", "99")], "vendor_id string, nm1_code string")
    m = cfg.nm1_role_map(spark).unionByName(spark.createDataFrame(
        [("vA", None, "82", "VA_LOW", 1, True, cfg.SEED_TS, cfg.SEED_TS),
         ("vA", None, "82", "VA_HIGH", 9, True, cfg.SEED_TS, cfg.SEED_TS)], cfg.NM1_ROLE_SCHEMA))
    got = sorted(tuple(r) for r in Q.map_roles(data, m).select("vendor_id", "nm1_code", "mapped_role").collect())
    assert got == [("vA", "82", "VA_LOW"), ("vB", "82", "RENDERING"), ("vB", "99", None)]


def test_claim_references_classified_by_ref_map(spark):
    from claimflow.operators import gold as G
    from helpers import isa, parse_texts

    text = isa() + "ST*837*1*V~REF*EI*999~CLM*A*1~REF*F8*ORIG1~REF*ZZ*X~CLM*B*2~REF*1K*PCN~SE*7*1~"
    res, _ = parse_texts(spark, [("vendorA", "ref.x12", text)])
    vend = spark.createDataFrame([("vendorA", "ZZ", "VENDOR_SPECIFIC", True, cfg.SEED_TS, cfg.SEED_TS)], cfg.REF_MAP_SCHEMA)
    refs = G.claim_reference(res["claims"], cfg.ref_qualifier_map(spark).unionByName(vend))
    got = sorted((r.claim_id, r.ref_qualifier, r.ref_value, r.ref_type) for r in refs.collect())
    # the REF before the first CLM belongs to no claim
    assert got == [("A", "F8", "ORIG1", "ORIGINAL_REFERENCE"), ("A", "ZZ", "X", "VENDOR_SPECIFIC"),
                   ("B", "1K", "PCN", "PAYER_CLAIM_CONTROL")]


def test_money_sums_survive_absurd_amounts(spark):
    from claimflow.operators import audit as A

    df = spark.createDataFrame([("v", "f", 1.25, "[]"), ("v", "f", 1e40, "[{}]"), ("v", "f", None, None)],
                               "vendor_id string, file_hash string, claim_amount double, service_lines_json string")
    r = A.silver_metrics(df).first()
    assert (r.silver_claim_count, r.silver_total_claim_amount, r.silver_service_line_count) == (3, 1.25, 1)


def test_partner_extract_written_per_partner_with_manifest(spark):
    import os
    import tempfile

    ex = spark.createDataFrame([("vA", "k2", 10.0), ("vA", "k1", 5.5), ("vB", "k3", 1.0)],
                               "vendor_id string, claim_key string, claim_amount double")
    out = tempfile.mkdtemp(prefix="run-", dir="/tmp") + "/extract"
    Q.write_partner_extract(ex, out, order_by=["claim_key"])
    assert sorted(d for d in os.listdir(out) if d.startswith("vendor_id=")) == ["vendor_id=vA", "vendor_id=vB"]
    back = spark.read.parquet(out)
    assert back.filter("vendor_id = 'vA'").count() == 2
    m = {r.vendor_id: (r.row_count, r.total_amount, r.first_claim_key, r.last_claim_key)
         for r in Q.partner_manifest(ex).collect()}
    assert m == {"vA": (2, 15.5, "k1", "k2"), "vB": (1, 1.0, "k3", "k3")}
    hashes = {r.vendor_id: r.rows_hash for r in Q.partner_manifest(ex).collect()}
    assert hashes == {r.vendor_id: r.rows_hash for r in Q.partner_manifest(back.select(*ex.columns)).collect()}
    changed = ex.withColumn("claim_amount", F.col("claim_amount") + 1)
    assert hashes["vA"] != {r.vendor_id: r.rows_hash for r in Q.partner_manifest(changed).collect()}["vA"]
