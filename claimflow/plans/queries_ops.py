"""Registered queries for merges, audit / reconciliation, data quality,
standardization, code maps and orchestration."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from claimflow.operators import audit as A
from claimflow.operators import merge as M
from claimflow.plans.oracle_sql import BASE_CTES, PARSE_CTES, TEXT_CTES, with_ctes
from claimflow.plans.queries import EARLIER_RUN_CUTOFF, RUN_ID, TS, Stages, _paths, register
from claimflow.sources.star import read_table

# ====================================================================== merges on order snapshots
# Two snapshots of ``orders``: the table as loaded before 1997 (target) and a
# later extract from 1996 on with re-priced totals and new statuses (source).
# They overlap in 1996, so merges see matched, target-only and source-only keys.
_SNAP_T = "o_orderdate < TIMESTAMP '1997-01-01 00:00:00'"
_SNAP_S = "o_orderdate >= TIMESTAMP '1996-01-01 00:00:00'"
_SRC_PRICE = "o_totalprice + 100.0"
_SRC_STATUS = "CASE WHEN o_orderstatus = 'O' THEN 'F' ELSE o_orderstatus END"
_SNAP_SQL = f"""
WITH t AS (SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice, NULLIF(o_orderpriority, '5-LOW') AS prio
           FROM orders WHERE {_SNAP_T}),
     s AS (SELECT o_orderkey, o_custkey, {_SRC_STATUS} AS o_orderstatus, {_SRC_PRICE} AS o_totalprice,
                  NULLIF(o_orderpriority, '5-LOW') AS prio FROM orders WHERE {_SNAP_S})
"""


def _snapshots(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    o = read_table(spark, sf_dir, "orders")
    base = [F.col("o_orderkey"), F.col("o_custkey")]
    prio = F.nullif(F.col("o_orderpriority"), F.lit("5-LOW")).alias("prio")
    t = o.filter(F.expr(_SNAP_T)).select(*base, "o_orderstatus", "o_totalprice", prio)
    s = o.filter(F.expr(_SNAP_S)).select(*base, F.expr(_SRC_STATUS).alias("o_orderstatus"),
                                          F.expr(_SRC_PRICE).alias("o_totalprice"), prio)
    return t, s


_OUT = ["o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice"]


@register("merge_insert_only", _SNAP_SQL + """
SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice FROM t
UNION ALL SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice FROM s
WHERE NOT EXISTS (SELECT 1 FROM t WHERE t.o_orderkey = s.o_orderkey)""")
def merge_insert_only(spark: SparkSession, sf_dir: str) -> DataFrame:
    """SNK2: WHEN NOT MATCHED THEN INSERT * — matched keys keep the target row."""
    t, s = _snapshots(spark, sf_dir)
    return M.insert_only(t, s, ["o_orderkey"]).select(*_OUT)


@register("merge_upsert", _SNAP_SQL + """
SELECT t.o_orderkey, t.o_custkey, coalesce(s.o_orderstatus, t.o_orderstatus) AS o_orderstatus,
       CASE WHEN s.o_orderkey IS NOT NULL THEN s.o_totalprice ELSE t.o_totalprice END AS o_totalprice
FROM t LEFT JOIN s ON s.o_orderkey = t.o_orderkey
UNION ALL SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice FROM s
WHERE NOT EXISTS (SELECT 1 FROM t WHERE t.o_orderkey = s.o_orderkey)""")
def merge_upsert(spark: SparkSession, sf_dir: str) -> DataFrame:
    """SNK3: matched rows take the source status and price; new keys are inserted."""
    t, s = _snapshots(spark, sf_dir)
    return M.merge_frames(t, s, ["o_orderkey"], update=["o_orderstatus", "o_totalprice"]).select(*_OUT)


@register("merge_update_only", _SNAP_SQL + """
SELECT t.o_orderkey, t.o_custkey, coalesce(s.o_orderstatus, t.o_orderstatus) AS o_orderstatus,
       CASE WHEN s.o_orderkey IS NOT NULL THEN s.o_totalprice ELSE t.o_totalprice END AS o_totalprice
FROM t LEFT JOIN s ON s.o_orderkey = t.o_orderkey""")
def merge_update_only(spark: SparkSession, sf_dir: str) -> DataFrame:
    """SNK4: matched rows updated, no inserts."""
    t, s = _snapshots(spark, sf_dir)
    return M.merge_frames(t, s, ["o_orderkey"], update=["o_orderstatus", "o_totalprice"], insert=False).select(*_OUT)


@register("merge_guarded", _SNAP_SQL + """
SELECT t.o_orderkey, t.o_custkey,
       CASE WHEN s.o_orderkey IS NULL OR t.o_orderstatus = 'F' THEN t.o_orderstatus ELSE s.o_orderstatus END AS o_orderstatus,
       CASE WHEN s.o_orderkey IS NOT NULL THEN s.o_totalprice ELSE t.o_totalprice END AS o_totalprice
FROM t LEFT JOIN s ON s.o_orderkey = t.o_orderkey""")
def merge_guarded(spark: SparkSession, sf_dir: str) -> DataFrame:
    """SNK5: guarded update — a final status ('F') is never overwritten (as QUARANTINED in file_audit)."""
    t, s = _snapshots(spark, sf_dir)
    upd = {
        "o_orderstatus": lambda tt, ss: F.when(tt("o_orderstatus").isin("F"), tt("o_orderstatus")).otherwise(ss("o_orderstatus")),
        "o_totalprice": lambda tt, ss: ss("o_totalprice"),
    }
    return M.merge_frames(t, s, ["o_orderkey"], update=upd, insert=False).select(*_OUT)


@register("merge_null_safe", _SNAP_SQL + """
SELECT t.o_orderkey, t.prio, coalesce(s.o_totalprice, t.o_totalprice) AS o_totalprice
FROM t LEFT JOIN s ON s.o_custkey = t.o_custkey AND s.o_orderkey = t.o_orderkey AND s.prio IS NOT DISTINCT FROM t.prio
UNION ALL SELECT s.o_orderkey, s.prio, s.o_totalprice FROM s
WHERE NOT EXISTS (SELECT 1 FROM t WHERE t.o_custkey = s.o_custkey AND t.o_orderkey = s.o_orderkey
                  AND t.prio IS NOT DISTINCT FROM s.prio)""")
def merge_null_safe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """SNK6/JN8: upsert on a key with NULLs (priority '5-LOW' as NULL) — NULL keys match with <=>."""
    t, s = _snapshots(spark, sf_dir)
    out = M.merge_frames(t, s, ["o_custkey", "o_orderkey", "prio"], update=["o_totalprice"])
    return out.select("o_orderkey", "prio", "o_totalprice")


@register("replace_defaults", _SNAP_SQL + """
SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice FROM t WHERE o_orderstatus <> 'P'
UNION ALL SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice FROM s WHERE o_orderstatus = 'P'""")
def replace_defaults(spark: SparkSession, sf_dir: str) -> DataFrame:
    """SNK7: delete-then-insert of a row class (status 'P') from a new seed."""
    t, s = _snapshots(spark, sf_dir)
    return M.replace_rows(t, s.filter(F.col("o_orderstatus") == "P"), F.col("o_orderstatus") == "P").select(*_OUT)


# ====================================================================== audit and reconciliation
_GOLD_TABLES = ["claim_header", "claim_service_line", "claim_diagnosis", "claim_provider", "claim_subscriber",
                "claim_patient", "claim_other_payer"]


def _gold_all(st: Stages, claims: DataFrame | None = None) -> list[DataFrame]:
    from claimflow.operators import gold as G
    c = st.shared_claims if claims is None else claims
    return [G.NORMALIZERS[t](c, RUN_ID, TS) for t in _GOLD_TABLES]


def _partials(silver: DataFrame, gold: list[DataFrame]) -> DataFrame:
    return A.partial_sums({A.SILVER: silver, **dict(zip(_GOLD_TABLES, gold))})


_METRIC_CTES = """
, sil AS (
  SELECT vendor_id, file_path, count(*) AS silver_claim_count,
         CAST(sum(CAST(claim_amount AS DECIMAL(18,2))) AS DOUBLE) AS silver_total_claim_amount,
         CAST(sum(n_service_lines) AS BIGINT) AS silver_service_line_count,
         CAST(sum(n_diagnoses) AS BIGINT) AS dx, CAST(sum(n_providers) AS BIGINT) AS prov,
         CAST(count(subscriber_id) AS BIGINT) AS sub, CAST(count(patient_id) AS BIGINT) AS pat,
         CAST(sum(n_other_payers) AS BIGINT) AS op
  FROM all_claims GROUP BY 1, 2
)"""


@register("silver_metrics", with_ctes(BASE_CTES, TEXT_CTES, PARSE_CTES) + _METRIC_CTES + """
SELECT file_path, silver_claim_count, silver_total_claim_amount, silver_service_line_count FROM sil""")
def silver_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    """OPS3: per-file silver claim count, amount total (decimal sum) and service-line count."""
    st = Stages(spark, sf_dir)
    m = A.silver_metrics(st.silver)
    return _paths(m, st.bronze).select("file_path", "silver_claim_count", "silver_total_claim_amount",
                                       "silver_service_line_count")


@register("gold_metrics", with_ctes(BASE_CTES, TEXT_CTES, PARSE_CTES) + _METRIC_CTES + """
SELECT file_path, silver_claim_count AS gold_header_count, silver_total_claim_amount AS gold_total_claim_amount,
  silver_service_line_count AS gold_service_line_count, dx AS gold_dx_count, prov AS gold_provider_count,
  sub AS gold_subscriber_count, pat AS gold_patient_count, op AS gold_other_payer_count FROM sil""")
def gold_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    """OPS3: per-file counts of all seven gold tables in one stacked aggregation."""
    st = Stages(spark, sf_dir)
    m = A.gold_metrics(*_gold_all(st))
    return _paths(m, st.bronze).select(
        "file_path", "gold_header_count", "gold_total_claim_amount", *A.GOLD_COUNT_COLUMNS)


_RECON_SQL = f"""
, gold AS (SELECT * FROM sil WHERE file_path IN (SELECT file_path FROM bronze WHERE modification_time < '{EARLIER_RUN_CUTOFF}'))
SELECT s.file_path, s.silver_claim_count, coalesce(g.silver_claim_count, 0) AS gold_header_count,
  s.silver_service_line_count, coalesce(g.silver_service_line_count, 0) AS gold_service_line_count,
  s.silver_claim_count = coalesce(g.silver_claim_count, 0) AS recon_header_match,
  s.silver_service_line_count = coalesce(g.silver_service_line_count, 0) AS recon_service_line_match,
  abs(s.silver_total_claim_amount - coalesce(g.silver_total_claim_amount, 0)) < 0.01 AS recon_amount_match,
  CASE WHEN g.file_path IS NOT NULL THEN '' ELSE
    concat_ws('; ', CASE WHEN s.silver_claim_count <> 0 THEN 'Header count mismatch' END,
                    CASE WHEN s.silver_service_line_count <> 0 THEN 'Service line count mismatch' END,
                    CASE WHEN abs(s.silver_total_claim_amount) >= 0.01 THEN 'Claim amount mismatch' END) END AS recon_notes,
  CASE WHEN g.file_path IS NOT NULL
         OR (s.silver_claim_count = 0 AND s.silver_service_line_count = 0 AND abs(s.silver_total_claim_amount) < 0.01)
       THEN 'GOLD_BUILT' ELSE 'FAILED' END AS status
FROM sil s LEFT JOIN gold g ON g.file_path = s.file_path"""


def _recon(st: Stages) -> DataFrame:
    # Gold lags silver: it was built by the earlier run, from files modified before the cutoff.
    return A.reconcile_files(_partials(st.shared_silver, _gold_all(st, st.earlier_claims)), ts=TS)


@register("recon_files", with_ctes(BASE_CTES, TEXT_CTES, PARSE_CTES) + _METRIC_CTES + _RECON_SQL)
def recon_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """OPS4: silver vs gold per file when gold lags silver — match flags, notes, GOLD_BUILT / FAILED."""
    st = Stages(spark, sf_dir)
    r = _paths(_recon(st), st.bronze)
    return r.select("file_path", "silver_claim_count", "gold_header_count", "silver_service_line_count",
                    "gold_service_line_count", "recon_header_match", "recon_service_line_match", "recon_amount_match",
                    "recon_notes", "status")


@register("file_audit", with_ctes(BASE_CTES, TEXT_CTES, PARSE_CTES) + _METRIC_CTES + _RECON_SQL.replace(
    "SELECT s.file_path, s.silver_claim_count,", ", rec AS (SELECT s.file_path, s.silver_claim_count,") + """)
SELECT b.vendor_id, b.file_path, b.file_size_bytes,
  CASE WHEN q.file_path IS NOT NULL THEN 'QUARANTINED' ELSE coalesce(r.status, 'BRONZE_LOADED') END AS status,
  r.silver_claim_count, r.gold_header_count, r.recon_header_match, r.recon_notes
FROM bronze b LEFT JOIN rec r ON r.file_path = b.file_path
LEFT JOIN (SELECT file_path FROM errors_exp WHERE error_stage = 'quarantine_delimiters') q ON q.file_path = b.file_path""")
def file_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    """OPS2/OPS4: file_audit after base upsert, quarantine marks and a reconciliation update (QUARANTINED sticks)."""
    st = Stages(spark, sf_dir)
    quarantined = st.parsed["errors"].filter(F.col("error_stage") == "quarantine_delimiters").select("file_hash")
    fa = A.merge_file_audit(A.empty_file_audit(spark), A.file_audit_base(st.bronze, TS), _recon(st), quarantined)
    return fa.select("vendor_id", "file_path", "file_size_bytes", "status", "silver_claim_count", "gold_header_count",
                     "recon_header_match", "recon_notes")


@register("recon_transactions", with_ctes(BASE_CTES, TEXT_CTES, PARSE_CTES) + """
SELECT vendor_id, file_path, st_control, transaction_version, CAST(NULL AS BIGINT) AS expected_claims,
  count(*) AS parsed_claims, count(*) AS gold_headers,
  CAST(CASE WHEN sum(n_service_lines) > 0 THEN sum(n_service_lines) END AS BIGINT) AS gold_lines,
  CAST(sum(CAST(claim_amount AS DECIMAL(18,2))) AS DOUBLE) AS parsed_claim_amt,
  CAST(sum(CAST(claim_amount AS DECIMAL(18,2))) AS DOUBLE) AS header_claim_amt,
  true AS header_match, sum(n_service_lines) > 0 AS lines_match, true AS amount_match
FROM all_claims GROUP BY vendor_id, file_path, st_control, transaction_version""")
def recon_transactions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """OPS5: per (file, ST, version) parsed vs gold headers, amounts, and whether gold has lines."""
    st = Stages(spark, sf_dir)
    r = A.reconcile_transactions(_partials(st.shared_silver, _gold_all(st)), TS)
    return _paths(r, st.bronze).select(
        "vendor_id", "file_path", "st_control", "transaction_version", "expected_claims", "parsed_claims",
        "gold_headers", "gold_lines", "parsed_claim_amt", "header_claim_amt", "header_match", "lines_match",
        "amount_match")


@register("run_status", with_ctes(BASE_CTES, TEXT_CTES, PARSE_CTES) + _METRIC_CTES + _RECON_SQL.replace(
    "SELECT s.file_path, s.silver_claim_count,", ", rec AS (SELECT s.file_path, s.silver_claim_count,") + """)
SELECT CASE WHEN bool_or(status = 'FAILED') THEN 'FAILED' ELSE 'SUCCESS' END AS status,
       CASE WHEN bool_or(status = 'FAILED') THEN 'One or more files failed reconciliation.' ELSE 'All files reconciled.' END AS notes,
       count(*) FILTER (WHERE status = 'FAILED') AS failed_files
FROM rec""")
def run_status(spark: SparkSession, sf_dir: str) -> DataFrame:
    """OPS1: final run status from the reconciled file_audit rows of this run."""
    st = Stages(spark, sf_dir)
    rec = _recon(st)
    return A.run_status(rec, touched=rec.select("file_hash"), end_ts=TS).select("status", "notes", "failed_files")


# The configuration / quality / orchestration family registers itself on import.
from claimflow.plans import queries_config as _cfg  # noqa: E402,F401
