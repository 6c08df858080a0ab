"""Independent SQL oracles (DuckDB dialect) for the registered queries.

The oracle never parses X12. It re-states, over the star tables, what the
fixture files contain (one file per customer and order-key range, one claim
per order, one line per lineitem) and derives every expected result from
that directly. Shared building blocks are CTEs; each query's SQL is
``WITH <the CTEs it needs> SELECT ...``.
"""

from __future__ import annotations

SPAN = 1048576  # order-key range per landing file (fixture definition)


def _ws(sep: str, *parts: str) -> str:
    return f"concat_ws({sep}, " + ", ".join(parts) + ")"


_ISA = (
    "'ISA' || e || '00' || e || repeat(' ', 10) || e || '00' || e || repeat(' ', 10) || e || 'ZZ' || e || "
    "'SENDER' || repeat(' ', 9) || e || 'ZZ' || e || 'RECEIVER' || repeat(' ', 7) || e || '240101' || e || '1200' || e "
    "|| '^' || e || '00501' || e || k9 || e || '0' || e || 'P' || e || c"
)

BASE_CTES = f"""
cv AS (
  SELECT c.c_custkey AS k, c.c_name, c.c_nationkey, n.n_name, c.c_custkey % 50 AS kind,
         ['vendorA', 'vendorB', 'vendorC'][c.c_custkey % 3 + 1] AS vendor_id,
         ['*', '|', '*'][c.c_custkey % 3 + 1] AS e,
         [':', '>', ':'][c.c_custkey % 3 + 1] AS c,
         ['~', '~', chr(10)][c.c_custkey % 3 + 1] AS sd,
         CASE WHEN c.c_custkey % 3 = 2 THEN '005010X223A2' ELSE '005010X222A1' END AS ver,
         lpad(CAST(c.c_custkey AS VARCHAR), 9, '0') AS k9
  FROM customer c LEFT JOIN nation n ON c.c_nationkey = n.n_nationkey
),
oparts AS (
  SELECT o_custkey AS k, o_orderkey // {SPAN} AS part, max(o_orderdate) AS last_order_ts FROM orders GROUP BY 1, 2
),
files AS (
  SELECT cv.*, p.part, p.last_order_ts FROM cv JOIN oparts p ON p.k = cv.k WHERE cv.kind NOT IN (7, 13, 23)
  UNION ALL
  SELECT cv.*, 0 AS part, CAST(NULL AS TIMESTAMP) AS last_order_ts FROM cv
  WHERE cv.kind IN (7, 13, 23) OR NOT EXISTS (SELECT 1 FROM oparts p WHERE p.k = cv.k)
),
fpath AS (
  SELECT f.*, '/landing/x12/837/' || vendor_id || '/c' || k9
           || CASE WHEN part = 0 THEN '' ELSE '_' || CAST(part AS VARCHAR) END AS base
  FROM files f
),
ord AS (
  SELECT o.*, f.k, f.part, f.e, f.c, f.sd, f.vendor_id, f.kind, f.base
  FROM orders o JOIN fpath f ON f.k = o.o_custkey AND f.part = o.o_orderkey // {SPAN}
  WHERE f.kind NOT IN (7, 13, 23)
),
lines AS (
  SELECT l.*, row_number() OVER (PARTITION BY l_orderkey ORDER BY l_linenumber, l_partkey, l_suppkey,
           l_extendedprice, l_quantity, l_shipdate, l_discount, l_tax, l_returnflag, l_linestatus) AS n
  FROM lineitem l
),
oline AS (
  SELECT l.*, o.k, o.part, o.e, o.c, o.sd, o.vendor_id, o.kind, o.base, o.o_custkey
  FROM lines l JOIN ord o ON o.o_orderkey = l.l_orderkey
),
first_line AS (
  SELECT l.l_orderkey, l.l_suppkey AS rend_supp, s.s_name
  FROM lines l LEFT JOIN supplier s ON s.s_suppkey = l.l_suppkey WHERE l.n = 1
)"""

TEXT_CTES = f"""
bf AS (SELECT * FROM fpath WHERE kind NOT IN (7, 13)),
segs AS (
  SELECT k, part, 0 AS sec, CAST(0 AS BIGINT) AS okey, CAST(0 AS BIGINT) AS n, 0 AS sub, {_ISA} AS text FROM bf
  UNION ALL SELECT k, part, 0, 0, 0, 1, {_ws('e', "'GS'", "'HC'", "'S'", "'R'", "'20240101'", "'1200'", 'CAST(k AS VARCHAR)', "'X'", 'ver')} FROM bf
  UNION ALL SELECT k, part, 0, 0, 0, 2, {_ws('e', "'ST'", "CASE WHEN kind = 19 THEN '835' ELSE '837' END", 'CAST(k AS VARCHAR)', 'ver')} FROM bf
  UNION ALL SELECT k, part, 0, 0, 0, 3, {_ws('e', "'NM1'", "'85'", "'2'", "'CLINIC ' || n_name", "''", "''", "''", "''", "'XX'", 'CAST(k + 1000000000 AS VARCHAR)')} FROM bf
  UNION ALL SELECT k, part, 0, 0, 0, 4, {_ws('e', "'N3'", "CAST(k AS VARCHAR) || ' MAIN ST'")} FROM bf
  UNION ALL SELECT k, part, 0, 0, 0, 5, {_ws('e', "'N4'", "'CITY' || CAST(c_nationkey AS VARCHAR)", "'ST'", 'CAST(k % 90000 + 10000 AS VARCHAR)')} FROM bf
  UNION ALL SELECT k, part, 0, 0, 0, 6, {_ws('e', "'NM1'", "'IL'", "'1'", 'c_name', "'SUB'", "''", "''", "''", "'MI'", "'M' || CAST(k AS VARCHAR)")} FROM bf
  UNION ALL SELECT k, part, 0, 0, 0, 7, {_ws('e', "'DMG'", "'D8'", 'CAST(k % 28 + 19500101 AS VARCHAR)', "CASE WHEN k % 2 = 0 THEN 'F' ELSE 'M' END")} FROM bf
  UNION ALL SELECT k, part, 0, 0, 0, 8, {_ws('e', "'NM1'", "'QC'", "'1'", "'DEP' || CAST(k AS VARCHAR)", "'KID'", "''", "''", "''", "'MI'", "'P' || CAST(k AS VARCHAR)")} FROM bf WHERE k % 4 = 0
  UNION ALL SELECT k, part, 0, 0, 0, 9, {_ws('e', "'DMG'", "'D8'", "'20100101'", "'F'")} FROM bf WHERE k % 4 = 0
  UNION ALL SELECT k, part, 2, 0, 0, 0, {_ws('e', "'SE'", "'1'", 'CAST(k AS VARCHAR)')} FROM bf
  UNION ALL SELECT k, part, 2, 0, 0, 1, {_ws('e', "'GE'", "'1'", 'CAST(k AS VARCHAR)')} FROM bf
  UNION ALL SELECT k, part, 2, 0, 0, 2, {_ws('e', "'IEA'", "'1'", 'k9')} FROM bf
  UNION ALL SELECT k, part, 1, o_orderkey, 0, 0, {_ws('e', "'CLM'", 'CAST(o_orderkey AS VARCHAR)', 'CAST(CAST(o_totalprice AS DECIMAL(18,2)) AS VARCHAR)', "''", "''", "CASE o_orderstatus WHEN 'F' THEN '11' WHEN 'O' THEN '21' ELSE '22' END || c || 'B' || c || '1'")} FROM ord
  UNION ALL SELECT k, part, 1, o_orderkey, 0, 1, {_ws('e', "'DTP'", "'434'", "'D8'", "strftime(o_orderdate, '%Y%m%d')")} FROM ord WHERE o_orderpriority = '1-URGENT'
  UNION ALL SELECT k, part, 1, o_orderkey, 0, 2, {_ws('e', "'HI'", "'ABK' || c || 'D' || CAST(o_orderkey % 1000 AS VARCHAR)", "'ABF' || c || 'Z' || CAST(o_orderkey % 77 AS VARCHAR)")} FROM ord WHERE o_orderkey % 5 <> 0
  UNION ALL SELECT o.k, o.part, 1, o.o_orderkey, 0, 3, {_ws('o.e', "'NM1'", "'82'", "'1'", 'fl.s_name', "'DOC'", "''", "''", "''", "'XX'", 'CAST(fl.rend_supp + 2000000000 AS VARCHAR)')} FROM ord o JOIN first_line fl ON fl.l_orderkey = o.o_orderkey
  UNION ALL SELECT k, part, 1, o_orderkey, 0, 4, {_ws('e', "'NM1'", "'PR'", "'2'", "'PAYER' || CAST(k % 7 AS VARCHAR)", "''", "''", "''", "''", "'PI'", "'PY' || CAST(k % 7 AS VARCHAR)")} FROM ord WHERE o_orderkey % 6 = 0
  UNION ALL SELECT k, part, 1, l_orderkey, n, 0, {_ws('e', "'LX'", 'CAST(n AS VARCHAR)')} FROM oline
  UNION ALL SELECT k, part, 1, l_orderkey, n, 1,
    CASE WHEN vendor_id <> 'vendorC' THEN {_ws('e', "'SV1'", "'HC' || c || 'P' || CAST(l_partkey AS VARCHAR) || c || l_returnflag || c || l_linestatus", 'CAST(CAST(l_extendedprice AS DECIMAL(18,2)) AS VARCHAR)', "'UN'", 'CAST(CAST(l_quantity AS DECIMAL(18,2)) AS VARCHAR)')}
         WHEN l_orderkey % 2 = 0 THEN {_ws('e', "'SV2'", "CAST(l_partkey % 900 + 100 AS VARCHAR) || c || 'HC' || c || 'P' || CAST(l_partkey AS VARCHAR) || c || l_returnflag", 'CAST(CAST(l_extendedprice AS DECIMAL(18,2)) AS VARCHAR)', "'UN'", 'CAST(CAST(l_quantity AS DECIMAL(18,2)) AS VARCHAR)')}
         ELSE {_ws('e', "'SV2'", 'CAST(l_partkey % 900 + 100 AS VARCHAR)', "'HC' || c || 'P' || CAST(l_partkey AS VARCHAR) || c || l_returnflag", 'CAST(CAST(l_extendedprice AS DECIMAL(18,2)) AS VARCHAR)', "'UN'", 'CAST(CAST(l_quantity AS DECIMAL(18,2)) AS VARCHAR)')} END
    FROM oline
  UNION ALL SELECT k, part, 1, l_orderkey, n, 2, {_ws('e', "'DTP'", "'472'", "'D8'", "strftime(l_shipdate, '%Y%m%d')")} FROM oline
),
bodies AS (
  SELECT s.k, s.part, replace(string_agg(s.text, chr(1) ORDER BY s.sec, s.okey, s.n, s.sub), chr(1), max(f.sd)) || max(f.sd) AS body,
         count(*) AS n_segments
  FROM segs s JOIN bf f ON f.k = s.k AND f.part = s.part GROUP BY s.k, s.part
),
contents AS (
  SELECT f.*,
    CASE WHEN f.kind = 7 THEN 'BAD*' || CAST(f.k AS VARCHAR) || '~'
         WHEN f.kind = 13 THEN {_ws('f.e', "'ISA'", "'00'")} || f.sd || {_ws('f.e', "'ST'", "'837'", 'CAST(f.k AS VARCHAR)', 'f.ver')} || f.sd
              || {_ws('f.e', "'CLM'", 'CAST(f.k AS VARCHAR)', "'1.00'")} || f.sd || {_ws('f.e', "'SE'", "'1'", 'CAST(f.k AS VARCHAR)')} || f.sd
         ELSE b.body END AS text,
    b.n_segments
  FROM fpath f LEFT JOIN bodies b ON b.k = f.k AND b.part = f.part
),
landing AS (
  SELECT *, base || '.x12' AS file_path FROM contents
  UNION ALL SELECT *, base || '_copy.x12' AS file_path FROM contents WHERE kind = 31
),
bronze_all AS (
  SELECT vendor_id, file_path, strlen(text) AS file_size_bytes, sha256(text) AS file_hash, text AS content_str,
         starts_with(text, 'ISA') AS is_x12_like,
         CAST(coalesce(last_order_ts, TIMESTAMP '1992-01-01 00:00:00') AS VARCHAR) AS modification_time,
         k, part, kind, e, c, sd, ver, k9, n_segments
  FROM landing
),
bronze AS (
  SELECT * FROM (
    SELECT *, row_number() OVER (PARTITION BY file_hash ORDER BY file_path) AS rn FROM bronze_all WHERE is_x12_like
  ) WHERE rn = 1
)"""

# Expected per-file parse facts (the oracle knows the layout; it does not parse).
PARSE_CTES = """
pfiles AS (
  -- files that reach the segment stage, with their delimiter source
  SELECT b.*,
    CASE WHEN kind = 13 AND vendor_id <> 'vendorB' THEN 'FAILED'
         WHEN kind = 13 THEN 'PROFILE' ELSE 'ISA' END AS delim_source
  FROM bronze b
),
claims_exp AS (
  SELECT o.vendor_id, o.base || '.x12' AS file_path, o.k, o.part, o.kind, o.o_orderkey,
    lpad(CAST(o.k AS VARCHAR), 9, '0') AS isa_control, CAST(o.k AS VARCHAR) AS gs_control,
    CAST(o.k AS VARCHAR) AS st_control,
    CASE WHEN o.vendor_id = 'vendorC' THEN '005010X223A2' ELSE '005010X222A1' END AS transaction_version,
    CAST(o.o_orderkey AS VARCHAR) AS claim_id,
    CAST(CAST(o.o_totalprice AS DECIMAL(18,2)) AS DOUBLE) AS claim_amount,
    CASE o.o_orderstatus WHEN 'F' THEN '11' WHEN 'O' THEN '21' ELSE '22' END AS place_of_service,
    'M' || CAST(o.k AS VARCHAR) AS subscriber_id,
    CASE WHEN o.k % 4 = 0 THEN 'P' || CAST(o.k AS VARCHAR) ELSE 'M' || CAST(o.k AS VARCHAR) END AS patient_id,
    CAST(o.k + 1000000000 AS VARCHAR) AS billing_npi,
    CAST(fl.rend_supp + 2000000000 AS VARCHAR) AS rendering_npi,
    CASE WHEN o.o_orderpriority = '1-URGENT' THEN strftime(o.o_orderdate, '%Y%m%d') ELSE ls.min_ship END AS claim_from_dt,
    ls.max_ship AS claim_to_dt,
    CAST(coalesce(ls.n_lines, 0) AS BIGINT) AS n_service_lines,
    CAST(CASE WHEN o.o_orderkey % 5 <> 0 THEN 2 ELSE 0 END AS BIGINT) AS n_diagnoses,
    CAST(1 + CASE WHEN fl.l_orderkey IS NOT NULL THEN 1 ELSE 0 END AS BIGINT) AS n_providers,
    CAST(CASE WHEN o.o_orderkey % 6 = 0 THEN 1 ELSE 0 END AS BIGINT) AS n_other_payers,
    o.o_orderpriority, o.o_orderdate, o.o_totalprice, o.o_orderstatus, fl.s_name, fl.rend_supp
  FROM ord o
  LEFT JOIN first_line fl ON fl.l_orderkey = o.o_orderkey
  LEFT JOIN (SELECT l_orderkey, count(*) AS n_lines, min(strftime(l_shipdate, '%Y%m%d')) AS min_ship,
                    max(strftime(l_shipdate, '%Y%m%d')) AS max_ship FROM lines GROUP BY 1) ls ON ls.l_orderkey = o.o_orderkey
  WHERE o.kind NOT IN (19, 23)
    AND EXISTS (SELECT 1 FROM bronze b WHERE b.file_path = o.base || '.x12')
),
short_claims AS (
  SELECT vendor_id, file_path, k, part, kind, NULL AS o_orderkey, CAST(NULL AS VARCHAR) AS isa_control,
    CAST(NULL AS VARCHAR) AS gs_control, CAST(k AS VARCHAR) AS st_control, ver AS transaction_version,
    CAST(k AS VARCHAR) AS claim_id, 1.0 AS claim_amount, CAST(NULL AS VARCHAR) AS place_of_service,
    CAST(NULL AS VARCHAR) AS subscriber_id, CAST(NULL AS VARCHAR) AS patient_id, CAST(NULL AS VARCHAR) AS billing_npi,
    CAST(NULL AS VARCHAR) AS rendering_npi, CAST(NULL AS VARCHAR) AS claim_from_dt, CAST(NULL AS VARCHAR) AS claim_to_dt,
    CAST(0 AS BIGINT) AS n_service_lines, CAST(0 AS BIGINT) AS n_diagnoses, CAST(0 AS BIGINT) AS n_providers,
    CAST(0 AS BIGINT) AS n_other_payers
  FROM pfiles WHERE delim_source = 'PROFILE'
),
all_claims AS (
  SELECT vendor_id, file_path, isa_control, gs_control, st_control, transaction_version, claim_id, claim_amount,
         place_of_service, subscriber_id, patient_id, billing_npi, rendering_npi, claim_from_dt, claim_to_dt,
         n_service_lines, n_diagnoses, n_providers, n_other_payers
  FROM claims_exp
  UNION ALL
  SELECT vendor_id, file_path, isa_control, gs_control, st_control, transaction_version, claim_id, claim_amount,
         place_of_service, subscriber_id, patient_id, billing_npi, rendering_npi, claim_from_dt, claim_to_dt,
         n_service_lines, n_diagnoses, n_providers, n_other_payers
  FROM short_claims
),
errors_exp AS (
  SELECT vendor_id, file_path, 'quarantine_delimiters' AS error_stage,
         'ISA delimiter detection failed (strict_mode=true)' AS error_message, left(content_str, 300) AS sample_text, file_hash
  FROM pfiles WHERE delim_source = 'FAILED'
  UNION ALL
  SELECT vendor_id, file_path, 'no_st_837', 'No ST*837 transaction found in file', left(content_str, 300), file_hash
  FROM pfiles WHERE kind = 19
  UNION ALL
  SELECT p.vendor_id, p.file_path, 'no_clm', 'Found ST*837 but no CLM segments', left(p.content_str, 300), p.file_hash
  FROM pfiles p WHERE p.kind NOT IN (13, 19)
    AND NOT EXISTS (SELECT 1 FROM ord o WHERE o.k = p.k AND o.part = p.part)
)"""


def with_ctes(*blocks: str) -> str:
    return "WITH " + ",".join(b.strip().rstrip(",") for b in blocks)
