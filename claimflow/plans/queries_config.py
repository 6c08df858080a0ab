"""Registered queries for data quality, standardization, code maps,
quarantine, orchestration and partner extracts."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from claimflow.operators import audit as A
from claimflow.operators import gold as G
from claimflow.operators import orchestration as O
from claimflow.operators import quality as Q
from claimflow.plans.oracle_sql import BASE_CTES, PARSE_CTES, TEXT_CTES, with_ctes
from claimflow.plans.queries import EARLIER_RUN_CUTOFF, RUN_ID, TS, Stages, _paths, register
from claimflow.sources import config as cfg
from claimflow.sources.fixtures import fixture_profiles
from claimflow.sources.star import read_table

_ALL = with_ctes(BASE_CTES, TEXT_CTES, PARSE_CTES)

# ====================================================================== data quality
# Extra rules next to the seeded ones: a global rule per gold entity and two
# rules that must not run (unknown column, subquery) and become RULE_ERROR rows.
EXTRA_DQ_RULES = [
    ("R900", "Line charge above 50000", "GOLD_SERVICE_LINE", "WARN", None, "charge_amount > 50000"),
    ("R901", "Diagnosis in D1 range", "GOLD_DIAGNOSIS", "INFO", None, "diag_code LIKE 'D1%'"),
    ("R902", "Header without from date", "GOLD_HEADER", "WARN", None, "claim_from_date IS NULL"),
    ("R903", "vendorA urgent-looking amount", "SILVER_CLAIM", "INFO", "vendorA", "claim_amount > 400000"),
    ("R998", "Broken rule", "SILVER_CLAIM", "ERROR", None, "no_such_column > 1"),
    ("R999", "Subquery rule", "GOLD_HEADER", "ERROR", None, "claim_id IN (SELECT 1)"),
]


def _dq_rules(spark: SparkSession) -> DataFrame:
    extra = spark.createDataFrame(
        [(*r[:5], True, r[5], cfg.SEED_TS, cfg.SEED_TS) for r in EXTRA_DQ_RULES], cfg.DQ_RULES_SCHEMA)
    return cfg.dq_rules(spark).unionByName(extra)


def _dq(st: Stages) -> DataFrame:
    c = st.shared_claims
    entities = {
        "SILVER_CLAIM": st.shared_silver,
        "GOLD_HEADER": G.claim_header(c, RUN_ID, TS),
        "GOLD_SERVICE_LINE": G.claim_service_line(c, RUN_ID, TS),
        "GOLD_DIAGNOSIS": G.claim_diagnosis(c, RUN_ID, TS),
        "GOLD_PROVIDER": G.claim_provider(c, RUN_ID, TS),
    }
    return Q.run_dq_rules(entities, _dq_rules(st.spark), cfg.PIPELINE_NAME, RUN_ID, TS)


_DQ_SQL = _ALL + """
, dq AS (
  SELECT vendor_id, file_path, 'VC02' AS rule_id, 'SILVER_CLAIM' AS entity, 'ERROR' AS severity, count(*) AS failed_count
  FROM all_claims WHERE vendor_id = 'vendorC' AND (claim_amount IS NULL OR claim_amount <= 0) GROUP BY 1, 2
  UNION ALL SELECT vendor_id, file_path, 'VC03', 'SILVER_CLAIM', 'ERROR', count(*)
  FROM all_claims WHERE vendor_id = 'vendorC' AND n_service_lines = 0 GROUP BY 1, 2
  UNION ALL SELECT vendor_id, file_path, 'VC04', 'SILVER_CLAIM', 'WARN', count(*)
  FROM all_claims WHERE vendor_id = 'vendorC' AND n_diagnoses = 0 GROUP BY 1, 2
  UNION ALL SELECT vendor_id, file_path, 'R002', 'SILVER_CLAIM', 'ERROR', count(*) FROM all_claims WHERE claim_amount < 0 GROUP BY 1, 2
  UNION ALL SELECT vendor_id, file_path, 'R903', 'SILVER_CLAIM', 'INFO', count(*)
  FROM all_claims WHERE vendor_id = 'vendorA' AND claim_amount > 400000 GROUP BY 1, 2
  UNION ALL SELECT vendor_id, base || '.x12', 'R900', 'GOLD_SERVICE_LINE', 'WARN', count(*)
  FROM oline WHERE kind NOT IN (19, 23) AND CAST(CAST(l_extendedprice AS DECIMAL(18,2)) AS DOUBLE) > 50000 GROUP BY 1, 2
  UNION ALL SELECT vendor_id, file_path, 'R901', 'GOLD_DIAGNOSIS', 'INFO', count(*)
  FROM claims_exp WHERE o_orderkey % 5 <> 0 AND ('D' || CAST(o_orderkey % 1000 AS VARCHAR)) LIKE 'D1%' GROUP BY 1, 2
  UNION ALL SELECT vendor_id, file_path, 'R902', 'GOLD_HEADER', 'WARN', count(*)
  FROM all_claims WHERE try_strptime(CASE WHEN length(claim_from_dt) = 8 THEN claim_from_dt END, '%Y%m%d') IS NULL GROUP BY 1, 2
)"""


@register("dq_results", _DQ_SQL + """
SELECT vendor_id, file_path, rule_id, entity, severity, failed_count FROM dq
UNION ALL SELECT NULL, NULL, 'R998', 'SILVER_CLAIM', 'RULE_ERROR', NULL
UNION ALL SELECT NULL, NULL, 'R999', 'GOLD_HEADER', 'RULE_ERROR', NULL""")
def dq_results(spark: SparkSession, sf_dir: str) -> DataFrame:
    """OPS6: SQL-predicate DQ rules (global + vendor-scoped), one scan per entity; bad rules -> RULE_ERROR rows."""
    st = Stages(spark, sf_dir)
    dq = _dq(st)
    paths = st.bronze.select("file_hash", "file_path")
    return dq.join(paths, "file_hash", "left").select("vendor_id", "file_path", "rule_id", "entity", "severity",
                                                       "failed_count")


@register("dq_generic_events", """
SELECT event_type AS vendor_id, CAST(user_id AS VARCHAR) AS file_hash, rule_id, failed_count FROM (
  SELECT event_type, user_id, 'E001' AS rule_id, count(*) AS failed_count FROM events WHERE value < 0 GROUP BY 1, 2
  UNION ALL SELECT event_type, user_id, 'E002', count(*) FROM events WHERE value > 100 GROUP BY 1, 2
  UNION ALL SELECT event_type, user_id, 'E003', count(*) FROM events WHERE props IS NULL OR props NOT LIKE '{%' GROUP BY 1, 2
)""")
def dq_generic_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """OPS6 on any table: the DQ engine over the events table (groups: event_type, user)."""
    ev = read_table(spark, sf_dir, "events").select(
        F.col("event_type").alias("vendor_id"), F.col("user_id").cast("string").alias("file_hash"), "value", "props")
    rules = spark.createDataFrame([
        ("E001", "negative value", "EVENTS", "WARN", None, True, "value < 0", cfg.SEED_TS, cfg.SEED_TS),
        ("E002", "value above 100", "EVENTS", "INFO", None, True, "value > 100", cfg.SEED_TS, cfg.SEED_TS),
        ("E003", "props not a JSON object", "EVENTS", "ERROR", None, True, "props IS NULL OR props NOT LIKE '{%'",
         cfg.SEED_TS, cfg.SEED_TS),
    ], cfg.DQ_RULES_SCHEMA)
    dq = Q.run_dq_rules({"EVENTS": ev}, rules, "events_dq", RUN_ID, TS, with_samples=False)
    return dq.select("vendor_id", "file_hash", "rule_id", "failed_count")


@register("auto_quarantine", _DQ_SQL + """
SELECT vendor_id, file_path, 'DQ' AS stage, rule_id FROM dq WHERE severity = 'ERROR'""")
def auto_quarantine(spark: SparkSession, sf_dir: str) -> DataFrame:
    """OPS14: files with ERROR-severity DQ failures become quarantine rows (stage DQ)."""
    st = Stages(spark, sf_dir)
    q = Q.auto_quarantine(_dq(st), st.bronze, RUN_ID, TS)
    return q.select("vendor_id", "file_path", "stage", "rule_id")


# ====================================================================== standardization
EXTRA_STD_RULES = [
    ("S010", "vendorB claim ids get a prefix", "vendorB", "silver_x12.silver_837_claim", "claim_id", "REGEX_REPLACE",
     '{"pattern": "^", "replacement": "B-"}'),
    ("S011", "lower-case versions for vendorC", "vendorC", "silver_x12.silver_837_claim", "transaction_version", "LOWER", "{}"),
    ("S012", "unknown action is skipped", None, "silver_x12.silver_837_claim", "claim_id", "REVERSE", "{}"),
    ("S013", "other table is skipped", None, "gold_claims.claim_header", "claim_id", "UPPER", "{}"),
]


@register("standardize_claims", _ALL + """
SELECT file_path,
  CASE WHEN vendor_id = 'vendorB' THEN 'B-' || trim(claim_id) ELSE trim(claim_id) END AS claim_id,
  CASE WHEN vendor_id = 'vendorC' THEN lower(upper(transaction_version)) ELSE upper(transaction_version) END AS transaction_version,
  coalesce(claim_amount, 0.0) AS claim_amount
FROM all_claims""")
def standardize_claims(spark: SparkSession, sf_dir: str) -> DataFrame:
    """OPS8/FN19: config-driven TRIM / UPPER / LOWER / REGEX_REPLACE / DEFAULT_IF_NULL on silver claims."""
    st = Stages(spark, sf_dir)
    extra = spark.createDataFrame([(*r, True, cfg.SEED_TS, cfg.SEED_TS) for r in EXTRA_STD_RULES], cfg.STD_RULES_SCHEMA)
    rules = cfg.standardization_rules(spark).unionByName(extra)
    out = Q.apply_standardization(st.silver, rules, "silver_837_claim")
    return out.select("file_path", "claim_id", "transaction_version", "claim_amount")


# ====================================================================== code maps
@register("map_roles", _ALL + """
SELECT c.file_path, c.claim_id, 'BILLING' AS provider_role, '85' AS nm1_code, 'BILLING' AS mapped_role FROM claims_exp c
UNION ALL
SELECT c.file_path, c.claim_id, 'RENDERING', '82', CASE WHEN c.vendor_id = 'vendorC' THEN 'ATTENDING_PHYSICIAN' ELSE 'RENDERING' END
FROM claims_exp c WHERE c.rend_supp IS NOT NULL""")
def map_roles(spark: SparkSession, sf_dir: str) -> DataFrame:
    """OPS9/JN9: NM1 role map — a vendor row wins over the global row; lowest precedence wins within a scope."""
    st = Stages(spark, sf_dir)
    extra = spark.createDataFrame([
        ("vendorC", None, "82", "ATTENDING_PHYSICIAN", 5, True, cfg.SEED_TS, cfg.SEED_TS),
        ("vendorC", None, "82", "IGNORED_HIGHER_PRECEDENCE", 50, True, cfg.SEED_TS, cfg.SEED_TS),
        (None, None, "85", "INACTIVE_ROW", 1, False, cfg.SEED_TS, cfg.SEED_TS),
    ], cfg.NM1_ROLE_SCHEMA)
    m = Q.map_roles(st.gold("claim_provider"), cfg.nm1_role_map(spark).unionByName(extra))
    return m.select("file_path", "claim_id", "provider_role", "nm1_code", "mapped_role")


@register("map_hi", _ALL + """
SELECT c.file_path, c.claim_id, 1 AS diag_seq, 'ABK' AS diag_qualifier, 'PRINCIPAL' AS diag_type FROM claims_exp c
WHERE c.o_orderkey % 5 <> 0
UNION ALL
SELECT c.file_path, c.claim_id, 2, 'ABF', CASE WHEN c.vendor_id = 'vendorA' THEN 'ADMITTING_A' ELSE 'ADMITTING' END
FROM claims_exp c WHERE c.o_orderkey % 5 <> 0""")
def map_hi(spark: SparkSession, sf_dir: str) -> DataFrame:
    """OPS9: HI qualifier map on gold diagnoses (global defaults + a vendor override)."""
    st = Stages(spark, sf_dir)
    extra = spark.createDataFrame([("vendorA", "ABF", "ADMITTING_A", True, cfg.SEED_TS, cfg.SEED_TS)], cfg.HI_MAP_SCHEMA)
    m = Q.map_hi(st.gold("claim_diagnosis"), cfg.hi_qualifier_map(spark).unionByName(extra))
    return m.select("file_path", "claim_id", "diag_seq", "diag_qualifier", "diag_type")


# ====================================================================== versions and extracts
@register("version_check", _ALL + """
SELECT DISTINCT vendor_id, file_path, st_control, transaction_version,
  CASE vendor_id WHEN 'vendorB' THEN '005010X222A2' WHEN 'vendorC' THEN '005010X223A2' ELSE '005010X222A1' END AS expected_version
FROM all_claims WHERE vendor_id = 'vendorB'""")
def version_check(spark: SparkSession, sf_dir: str) -> DataFrame:
    """OPS14: transactions whose version differs from the registry (vendorB moved to a newer guide)."""
    st = Stages(spark, sf_dir)
    reg = cfg.vendor_registry(spark).withColumn(
        "expected_version",
        F.when(F.col("vendor_id") == "vendorB", F.lit("005010X222A2")).otherwise(F.col("expected_version")))
    v = Q.version_check(st.claims, reg)
    return v.select("vendor_id", "file_path", "st_control", "transaction_version", "expected_version")


@register("partner_extract", _ALL + """
, keyed AS (
  SELECT a.vendor_id, a.claim_amount,
    sha256(concat_ws('||', a.vendor_id, b.file_hash, coalesce(a.st_control, ''), coalesce(a.claim_id, ''))) AS claim_key
  FROM all_claims a JOIN bronze b ON b.file_path = a.file_path WHERE a.claim_amount > 1000
)
SELECT vendor_id, count(*) AS row_count, CAST(sum(CAST(claim_amount AS DECIMAL(18,2))) AS DOUBLE) AS total_amount,
       min(claim_key) AS first_claim_key, max(claim_key) AS last_claim_key
FROM keyed GROUP BY vendor_id""")
def partner_extract(spark: SparkSession, sf_dir: str) -> DataFrame:
    """OPS15: per-partner extract of gold headers (amount > 1000) and its manifest (count, total, key range).

    The manifest is built from mergeable aggregates, so no partner's rows are
    ever gathered into one row or task.
    """
    from claimflow.operators.quality import partner_manifest
    st = Stages(spark, sf_dir)
    hdr = st.gold("claim_header").filter(F.col("claim_amount") > 1000)
    return partner_manifest(hdr).drop("rows_hash")  # a hash of Spark's own, unknown to SQL


# ====================================================================== orchestration
def _earlier_audit(st: Stages) -> DataFrame:
    """file_audit as the earlier run left it: files modified before the cutoff, reconciled."""
    ts_ok = st.bronze.filter(F.col("modification_time") < F.lit(EARLIER_RUN_CUTOFF).cast("timestamp"))
    from claimflow.operators import claims as C
    gold = {t: normalize(st.earlier_claims, RUN_ID, TS) for t, normalize in G.NORMALIZERS.items()}
    recon = A.reconcile_files(A.partial_sums({A.SILVER: C.to_silver(st.earlier_claims, TS), **gold}), ts=TS)
    return A.merge_file_audit(A.empty_file_audit(st.spark), A.file_audit_base(ts_ok, TS), recon)


def _earlier_quarantine(st: Stages) -> DataFrame:
    from claimflow.operators import claims as C
    ts_ok = st.bronze.filter(F.col("modification_time") < F.lit(EARLIER_RUN_CUTOFF).cast("timestamp"))
    return C.quarantine_rows(C.parse(ts_ok, fixture_profiles(st.spark))["errors"], RUN_ID, TS)


_DISCOVER_SQL = _ALL + f"""
, done AS (
  SELECT DISTINCT b.file_path FROM bronze b JOIN all_claims a ON a.file_path = b.file_path
  WHERE b.modification_time < '{EARLIER_RUN_CUTOFF}'
  UNION SELECT file_path FROM errors_exp e WHERE e.error_stage = 'quarantine_delimiters'
    AND e.file_path IN (SELECT file_path FROM bronze WHERE modification_time < '{EARLIER_RUN_CUTOFF}')
), found AS (
  SELECT l.vendor_id, l.file_path, strlen(l.text) AS size_bytes, 'PROCESS' AS action
  FROM landing l WHERE l.file_path NOT IN (SELECT file_path FROM done)
)"""


@register("discover_files", _DISCOVER_SQL + """
SELECT vendor_id, file_path, size_bytes, action FROM found""")
def discover_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """OPS10/SRC3/FLT7: new landing files per active vendor (regex, folder), minus GOLD_BUILT and quarantined files."""
    st = Stages(spark, sf_dir)
    listing = st.landing.select("path", "length")
    found = O.discover_files(listing, cfg.vendor_registry(spark), _earlier_audit(st), _earlier_quarantine(st))
    return found.select("vendor_id", "file_path", "size_bytes", "action")


OVERRIDES = [
    ("vendorC", "GOLD_OTHER_PAYER", False, None),
    ("vendorB", "SILVER", None, '{"strict": "false", "timeout_hint": "long"}'),
]


@register("effective_steps", _DISCOVER_SQL + """
, vendors AS (SELECT vendor_id, count(*) AS n FROM found GROUP BY 1),
steps AS (
  SELECT * FROM (VALUES (10, 'BRONZE', 3600), (20, 'SILVER', 7200), (30, 'GOLD_HEADER', 3600), (40, 'GOLD_LINES', 3600),
    (50, 'GOLD_DX', 3600), (60, 'GOLD_PROVIDER', 3600), (70, 'GOLD_SUB_PAT', 3600), (80, 'GOLD_OTHER_PAYER', 3600),
    (90, 'OPS_AUDIT', 3600)) t(step_order, step_name, timeout_seconds)
)
SELECT v.vendor_id, s.step_order, s.step_name, s.timeout_seconds,
  NOT (v.vendor_id = 'vendorC' AND s.step_name = 'GOLD_OTHER_PAYER') AS enabled,
  CAST(v.n AS VARCHAR) AS file_count,
  CASE WHEN v.vendor_id = 'vendorB' AND s.step_name = 'SILVER' THEN 'false' END AS strict,
  CASE WHEN v.vendor_id = 'vendorB' AND s.step_name = 'SILVER' THEN 7 ELSE 5 END AS n_params
FROM vendors v CROSS JOIN steps s""")
def effective_steps(spark: SparkSession, sf_dir: str) -> DataFrame:
    """OPS11/JN7: vendors with new files x enabled steps, overrides applied, parameters merged (later wins)."""
    st = Stages(spark, sf_dir)
    found = O.discover_files(st.landing.select("path", "length"), cfg.vendor_registry(spark), _earlier_audit(st),
                             _earlier_quarantine(st))
    todo = found.filter(F.col("action") == "PROCESS")
    vendors = O.active_vendors(cfg.vendor_registry(spark)).join(todo.select("vendor_id").distinct(), "vendor_id", "left_semi")
    plan = O.effective_steps(vendors, cfg.pipeline_steps(spark), cfg.step_overrides(spark, OVERRIDES),
                             file_paths=todo)
    return plan.select(
        "vendor_id", "step_order", "step_name", "timeout_seconds", "enabled",
        F.col("params")["file_count"].alias("file_count"), F.col("params")["strict"].alias("strict"),
        F.size("params").alias("n_params"),
    )


@register("vendor_state", _ALL + """
, sil AS (SELECT vendor_id, file_path FROM all_claims GROUP BY 1, 2),
bad AS (SELECT DISTINCT s.vendor_id FROM sil s JOIN bronze b ON b.file_path = s.file_path
        WHERE b.modification_time >= '""" + EARLIER_RUN_CUTOFF + """')
SELECT v.vendor_id, CASE WHEN b.vendor_id IS NULL THEN 'SUCCESS' ELSE 'FAILED' END AS last_status,
  'run-0002' AS last_run_id, true AS has_last_success
FROM (SELECT DISTINCT vendor_id FROM sil) v LEFT JOIN bad b ON b.vendor_id = v.vendor_id""")
def vendor_state(spark: SparkSession, sf_dir: str) -> DataFrame:
    """OPS12: vendor_state after a successful earlier run and a run whose reconciliation failed for some files."""
    st = Stages(spark, sf_dir)
    from claimflow.plans.queries_ops import _recon
    rec = _paths(_recon(st), st.bronze)
    vendors = rec.select("vendor_id").distinct()
    first = O.update_vendor_state(cfg.empty_vendor_state(spark),
                                  O.vendor_outcomes(vendors.select("vendor_id", F.lit(True).alias("ok"),
                                                                   F.lit(None).cast("string").alias("notes")),
                                                    "run-0001", "2024-05-01 00:00:00"))
    outcome = rec.groupBy("vendor_id").agg(
        (F.count_if(F.col("status") == A.STATUS_FAILED) == 0).alias("ok"),
        F.concat(F.count_if(F.col("status") == A.STATUS_FAILED).cast("string"), F.lit(" file(s) failed")).alias("notes"))
    second = O.update_vendor_state(first.select(*cfg.empty_vendor_state(spark).columns),
                                   O.vendor_outcomes(outcome, "run-0002", TS))
    return second.select("vendor_id", "last_status", "last_run_id",
                         F.col("last_success_ts").isNotNull().alias("has_last_success"))
