"""Registered queries: each runs the library's operators over the star tables.

Input is always the landing frame rendered from the star tables
(:mod:`claimflow.sources.fixtures`), so every query's work grows with the
tables. Each query is registered with its independent DuckDB oracle SQL
(:mod:`claimflow.plans.oracle_sql`). Outputs carry no run ids or load
times; dates are ``yyyy-MM-dd`` text and money is a double from a decimal.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import cached_property

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from claimflow.operators import bronze as B
from claimflow.operators import claims as C
from claimflow.operators import gold as G
from claimflow.operators import segments as S
from claimflow.plans.oracle_sql import BASE_CTES, PARSE_CTES, TEXT_CTES, with_ctes
from claimflow.sources import config as cfg
from claimflow.session import materialize
from claimflow.sources.fixtures import fixture_profiles, render_landing

RUN_ID = "run-0001"
TS = "2024-06-01 00:00:00"
# The incremental-run cutoff: files modified before it were landed and built by an earlier run.
EARLIER_RUN_CUTOFF = "1998-01-01 00:00:00"

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def register(name: str, sql: str | None):
    def deco(fn):
        QUERIES[name] = fn
        if sql is not None:
            ORACLES[name] = sql
        return fn
    return deco


class Stages:
    """Lazily built frames of one pipeline run over the star tables."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark = spark
        self.sf_dir = sf_dir

    @cached_property
    def landing(self) -> DataFrame:
        # The rendered files are stored once, like files in a landing folder:
        # every plan below starts from that stored copy, not from the renderer.
        return materialize(render_landing(self.spark, self.sf_dir))

    @cached_property
    def ingested(self) -> DataFrame:
        return B.ingest(self.landing, RUN_ID, TS)

    @cached_property
    def split(self) -> tuple[DataFrame, DataFrame]:
        return B.split_rejects(self.ingested)

    @cached_property
    def bronze(self) -> DataFrame:
        return B.dedupe_by_hash(self.split[0])

    @cached_property
    def parsed(self) -> dict[str, DataFrame]:
        # bronze comes out of the hash dedupe: a row a content, and nothing below needs the rows of a hash together
        return C.parse(self.bronze, fixture_profiles(self.spark), repartition=False, keep=["modification_time"])

    @cached_property
    def claims(self) -> DataFrame:
        return C.latest_claims(self.parsed["ranked"])

    @cached_property
    def shared_claims(self) -> DataFrame:
        """Claims checkpointed once, for queries that derive several tables from them.

        All gold tables, silver and gold metrics then read the stored claims:
        the parse runs once per query instead of once per branch.
        """
        return materialize(self.claims)

    @cached_property
    def earlier_claims(self) -> DataFrame:
        """The shared claims of the files modified before the cutoff, which an earlier run has built gold from."""
        return self.shared_claims.filter(F.col("modification_time") < F.lit(EARLIER_RUN_CUTOFF).cast("timestamp"))

    @cached_property
    def silver(self) -> DataFrame:
        return C.to_silver(self.claims, TS)

    @cached_property
    def shared_silver(self) -> DataFrame:
        return C.to_silver(self.shared_claims, TS)

    @cached_property
    def errors(self) -> DataFrame:
        return C.errors_table(self.parsed["errors"], TS)

    def gold(self, table: str) -> DataFrame:
        return G.NORMALIZERS[table](self.claims, RUN_ID, TS)


def _paths(df: DataFrame, bronze: DataFrame) -> DataFrame:
    return df.join(bronze.select("file_hash", "file_path"), "file_hash", "inner")


def _d(c: str) -> F.Column:
    return F.col(c).cast("string").alias(c)


# ====================================================================== bronze
@register("bronze_files", with_ctes(BASE_CTES, TEXT_CTES) + """
SELECT vendor_id, file_path, file_size_bytes, file_hash, is_x12_like, modification_time FROM bronze_all""")
def bronze_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every landing file as a bronze row (hash, size, UTF-8 text check, X12 test)."""
    return Stages(spark, sf_dir).ingested.select(
        "vendor_id", "file_path", "file_size_bytes", "file_hash", "is_x12_like", _d("modification_time"))


@register("bronze_quarantine", with_ctes(BASE_CTES, TEXT_CTES) + """
SELECT vendor_id, file_path, 'Not X12-like (ISA not at position 1)' AS reject_reason, file_hash
FROM bronze_all WHERE NOT is_x12_like""")
def bronze_quarantine(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rejected landing files with their reason."""
    return Stages(spark, sf_dir).split[1].select("vendor_id", "file_path", "reject_reason", "file_hash")


@register("bronze_dedupe", with_ctes(BASE_CTES, TEXT_CTES) + """
SELECT vendor_id, file_path, file_hash, file_size_bytes FROM bronze""")
def bronze_dedupe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One bronze row per content hash (the smallest path wins)."""
    return Stages(spark, sf_dir).bronze.select("vendor_id", "file_path", "file_hash", "file_size_bytes")


@register("unprocessed_files", with_ctes(BASE_CTES, TEXT_CTES, PARSE_CTES) + f"""
SELECT b.vendor_id, b.file_path FROM bronze b
WHERE NOT EXISTS (
  SELECT 1 FROM (SELECT file_path FROM all_claims UNION SELECT file_path FROM errors_exp) p
  JOIN bronze e ON e.file_path = p.file_path
  WHERE e.file_hash = b.file_hash AND e.modification_time < '{EARLIER_RUN_CUTOFF}')""")
def unprocessed_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bronze files with neither claims nor errors from the earlier run (files modified before the cutoff)."""
    st = Stages(spark, sf_dir)
    earlier = st.bronze.filter(F.col("modification_time") < F.lit(EARLIER_RUN_CUTOFF).cast("timestamp"))
    prev = C.parse(earlier, fixture_profiles(spark))
    return B.unprocessed(st.bronze, prev["claims"], prev["errors"]).select("vendor_id", "file_path")


# ====================================================================== structure
@register("delimiters_by_file", with_ctes(BASE_CTES, TEXT_CTES, PARSE_CTES) + """
SELECT vendor_id, file_path, delim_source,
  CASE delim_source WHEN 'ISA' THEN sd WHEN 'PROFILE' THEN '~' END AS segment_delim,
  CASE delim_source WHEN 'ISA' THEN e WHEN 'PROFILE' THEN '|' END AS element_delim,
  CASE delim_source WHEN 'ISA' THEN c WHEN 'PROFILE' THEN '>' END AS component_delim,
  CASE delim_source WHEN 'ISA' THEN '^' WHEN 'PROFILE' THEN '^' END AS repetition_delim,
  CASE delim_source WHEN 'FAILED' THEN 'quarantine_delimiters' END AS gate_error
FROM pfiles""")
def delimiters_by_file(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Delimiters per file from the ISA, else the vendor profile, else quarantine."""
    st = Stages(spark, sf_dir)
    g = S.resolve_delimiters(st.bronze, fixture_profiles(spark))
    return g.select("vendor_id", "file_path", "delim_source", *S.DELIM_COLUMNS, "gate_error")


@register("segment_counts", with_ctes(BASE_CTES, TEXT_CTES, PARSE_CTES) + """
SELECT p.file_path,
  CASE WHEN p.delim_source = 'PROFILE' THEN 4 ELSE p.n_segments END AS n_segments,
  CASE WHEN p.delim_source = 'PROFILE' THEN 1 ELSE (SELECT count(*) FROM ord o WHERE o.k = p.k AND o.part = p.part) END AS n_clm,
  CASE WHEN p.delim_source = 'PROFILE' THEN 0 ELSE (SELECT count(*) FROM oline l WHERE l.k = p.k AND l.part = p.part) END AS n_lx
FROM pfiles p WHERE p.delim_source <> 'FAILED'""")
def segment_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The segment table — segments, CLM and LX segments per parsed file."""
    st = Stages(spark, sf_dir)
    seg = st.parsed["segments"]
    agg = seg.groupBy("file_hash").agg(
        F.count(F.lit(1)).alias("n_segments"),
        F.count_if(F.col("tag") == "CLM").alias("n_clm"),
        F.count_if(F.col("tag") == "LX").alias("n_lx"),
    )
    return _paths(agg, st.bronze).select("file_path", "n_segments", "n_clm", "n_lx")


@register("envelope", with_ctes(BASE_CTES, TEXT_CTES, PARSE_CTES) + """
SELECT file_path, CASE WHEN delim_source = 'ISA' THEN k9 END AS isa_control,
       CASE WHEN delim_source = 'ISA' THEN CAST(k AS VARCHAR) END AS gs_control,
       kind <> 19 AS found_837
FROM pfiles WHERE delim_source <> 'FAILED'""")
def envelope(spark: SparkSession, sf_dir: str) -> DataFrame:
    """First ISA13 and GS06 of each parsed file, and whether it has an ST*837."""
    st = Stages(spark, sf_dir)
    p = st.parsed["parties"]
    return _paths(p, st.bronze).select("file_path", "isa_control", "gs_control", "found_837")


@register("transactions", with_ctes(BASE_CTES, TEXT_CTES, PARSE_CTES) + """
SELECT p.file_path, CAST(p.k AS VARCHAR) AS st_control, p.ver AS transaction_version,
  CASE WHEN p.delim_source = 'PROFILE' THEN 1 ELSE (SELECT count(*) FROM ord o WHERE o.k = p.k AND o.part = p.part) END AS n_claims,
  CASE WHEN p.delim_source = 'PROFILE' THEN 3 ELSE p.n_segments - 4 END AS n_segments
FROM pfiles p WHERE p.delim_source <> 'FAILED' AND p.kind <> 19""")
def transactions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """ST*837 spans (ST to SE inclusive) with their claim and segment counts."""
    st = Stages(spark, sf_dir)
    t = st.parsed["transactions"]
    return _paths(t, st.bronze).select("file_path", "st_control", "transaction_version", "n_claims", "n_segments")


@register("claim_blocks", with_ctes(BASE_CTES, TEXT_CTES, PARSE_CTES) + """
, blk AS (
  SELECT s.k, s.part, s.okey, count(*) AS n_seg,
         replace(string_agg(s.text, chr(1) ORDER BY s.sec, s.okey, s.n, s.sub), chr(1), max(f.sd)) AS txt,
         max(f.sd) AS sd, max(f.e) AS e
  FROM segs s JOIN bf f ON f.k = s.k AND f.part = s.part WHERE s.sec = 1 GROUP BY 1, 2, 3
), lastclm AS (SELECT k, part, max(okey) AS okey FROM blk GROUP BY 1, 2)
SELECT c.file_path, c.claim_id,
  b.n_seg + CASE WHEN l.okey IS NOT NULL THEN 1 ELSE 0 END AS n_block_segments,
  left(b.txt || CASE WHEN l.okey IS NOT NULL THEN b.sd || concat_ws(b.e, 'SE', '1', CAST(b.k AS VARCHAR)) ELSE '' END, 4000) AS claim_block_text
FROM claims_exp c JOIN blk b ON b.k = c.k AND b.part = c.part AND b.okey = c.o_orderkey
LEFT JOIN lastclm l ON l.k = b.k AND l.part = b.part AND l.okey = b.okey
UNION ALL
SELECT file_path, claim_id, 2, 'CLM|' || claim_id || '|1.00~SE|1|' || claim_id FROM short_claims""")
def claim_blocks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Claim blocks (CLM up to the next CLM or the span end) and their first 4 000 characters."""
    st = Stages(spark, sf_dir)
    return st.claims.select("file_path", "claim_id", "n_block_segments", "claim_block_text")


# ====================================================================== silver
_CLAIM_COLS = ("vendor_id, file_path, isa_control, gs_control, st_control, transaction_version, claim_id, claim_amount, "
               "place_of_service, subscriber_id, patient_id, billing_npi, rendering_npi, claim_from_dt, claim_to_dt")


@register("silver_claims", with_ctes(BASE_CTES, TEXT_CTES, PARSE_CTES) + f"""
SELECT {_CLAIM_COLS}, n_service_lines, n_diagnoses, n_providers, n_other_payers FROM all_claims""")
def silver_claims(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One silver row per claim (JSON children counted back from the JSON text)."""
    st = Stages(spark, sf_dir)
    s = st.silver

    def n(c: str, ddl: str) -> F.Column:
        return F.coalesce(F.size(F.from_json(F.col(c), ddl)), F.lit(0)).cast("long")

    return s.select(
        *[c.strip() for c in _CLAIM_COLS.split(",")],
        n("service_lines_json", C.LINE_TYPE).alias("n_service_lines"),
        F.when(F.col("diagnosis_json").isNull(), F.lit(0).cast("long")).otherwise(n("diagnosis_json", C.DX_TYPE)).alias("n_diagnoses"),
        F.when(F.col("providers_json").isNull(), F.lit(0).cast("long")).otherwise(n("providers_json", C.PROVIDER_TYPE)).alias("n_providers"),
        F.when(F.col("other_payer_json").isNull(), F.lit(0).cast("long")).otherwise(n("other_payer_json", C.PAYER_TYPE)).alias("n_other_payers"),
    )


@register("claim_dates", with_ctes(BASE_CTES, TEXT_CTES, PARSE_CTES) + """
SELECT file_path, claim_id, claim_from_dt, claim_to_dt FROM all_claims""")
def claim_dates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """First DTP*434, else the earliest DTP*472; latest DTP*472 as the end."""
    return Stages(spark, sf_dir).claims.select("file_path", "claim_id", "claim_from_dt", "claim_to_dt")


@register("rendering_npi", with_ctes(BASE_CTES, TEXT_CTES, PARSE_CTES) + """
SELECT file_path, claim_id, billing_npi, rendering_npi FROM all_claims""")
def rendering_npi(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Billing NPI (file) and the last RENDERING NPI of the claim."""
    return Stages(spark, sf_dir).claims.select("file_path", "claim_id", "billing_npi", "rendering_npi")


@register("parse_errors", with_ctes(BASE_CTES, TEXT_CTES, PARSE_CTES) + """
SELECT vendor_id, file_path, error_stage, error_message, sample_text FROM errors_exp""")
def parse_errors(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Parse errors by stage with a 300-character sample."""
    return Stages(spark, sf_dir).errors.select("vendor_id", "file_path", "error_stage", "error_message", "sample_text")


@register("quarantine_files", with_ctes(BASE_CTES, TEXT_CTES, PARSE_CTES) + """
SELECT vendor_id, file_path, 'SILVER' AS stage, 'SISA' AS rule_id, error_message AS reason
FROM errors_exp WHERE error_stage = 'quarantine_delimiters'""")
def quarantine_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Files whose delimiters could not be determined, quarantined at SILVER."""
    q = C.quarantine_rows(Stages(spark, sf_dir).parsed["errors"], RUN_ID, TS)
    return q.select("vendor_id", "file_path", "stage", "rule_id", "reason")


# ====================================================================== gold
@register("claim_header", with_ctes(BASE_CTES, TEXT_CTES, PARSE_CTES) + """
SELECT file_path, claim_id, claim_amount, place_of_service, subscriber_id AS subscriber_member_id,
  patient_id AS patient_member_id, billing_npi, rendering_npi,
  CAST(try_strptime(CASE WHEN length(claim_from_dt) = 8 THEN claim_from_dt END, '%Y%m%d') AS DATE)::VARCHAR AS claim_from_date,
  CAST(try_strptime(CASE WHEN length(claim_to_dt) = 8 THEN claim_to_dt END, '%Y%m%d') AS DATE)::VARCHAR AS claim_to_date
FROM all_claims""")
def claim_header(spark: SparkSession, sf_dir: str) -> DataFrame:
    """G1: claim header with typed dates."""
    h = Stages(spark, sf_dir).gold("claim_header")
    return h.select("file_path", "claim_id", "claim_amount", "place_of_service", "subscriber_member_id",
                    "patient_member_id", "billing_npi", "rendering_npi", _d("claim_from_date"), _d("claim_to_date"))


@register("claim_keys", with_ctes(BASE_CTES, TEXT_CTES, PARSE_CTES) + """
SELECT a.file_path, a.claim_id,
  sha256(concat_ws('||', a.vendor_id, b.file_hash, coalesce(a.st_control, ''), coalesce(a.claim_id, ''))) AS claim_key
FROM all_claims a JOIN bronze b ON b.file_path = a.file_path""")
def claim_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    """FN6: claim_key = sha256(vendor || file_hash || st_control || claim_id)."""
    return Stages(spark, sf_dir).gold("claim_header").select("file_path", "claim_id", "claim_key")


_LINES_SQL = """
SELECT l.vendor_id, l.base || '.x12' AS file_path, CAST(l.l_orderkey AS VARCHAR) AS claim_id, CAST(l.n AS INTEGER) AS line_seq,
  CAST(l.n AS VARCHAR) AS lx,
  CASE WHEN l.vendor_id = 'vendorC' THEN CAST(l.l_partkey % 900 + 100 AS VARCHAR) END AS rev_code,
  'HC' AS procedure_qualifier, 'P' || CAST(l.l_partkey AS VARCHAR) AS procedure_code,
  CASE WHEN l.vendor_id = 'vendorC' THEN l.l_returnflag ELSE l.l_returnflag || ',' || l.l_linestatus END AS modifiers_str,
  CAST(CAST(l.l_extendedprice AS DECIMAL(18,2)) AS DOUBLE) AS charge_amount,
  CAST(CAST(l.l_quantity AS DECIMAL(18,2)) AS DOUBLE) AS units
FROM oline l WHERE l.kind NOT IN (19, 23) AND l.vendor_id {op} 'vendorC'"""


def _lines_query(vendor_c: bool):
    def q(spark: SparkSession, sf_dir: str) -> DataFrame:
        sl = Stages(spark, sf_dir).gold("claim_service_line")
        sl = sl.filter((F.col("vendor_id") == "vendorC") if vendor_c else (F.col("vendor_id") != "vendorC"))
        return sl.select("vendor_id", "file_path", "claim_id", "line_seq", "lx", "rev_code", "procedure_qualifier",
                         "procedure_code", "modifiers_str", "charge_amount", "units")
    return q


register("service_lines_sv1", with_ctes(BASE_CTES, TEXT_CTES, PARSE_CTES) + _LINES_SQL.format(op="<>"))(_lines_query(False))
register("service_lines_sv2", with_ctes(BASE_CTES, TEXT_CTES, PARSE_CTES) + _LINES_SQL.format(op="="))(_lines_query(True))
QUERIES["service_lines_sv1"].__doc__ = "X14/G2: SV1 professional lines (837P vendors) in the gold line table."
QUERIES["service_lines_sv2"].__doc__ = "X15/G2: SV2 institutional lines, both SV2 layouts, with revenue codes."


@register("service_line_keys", with_ctes(BASE_CTES, TEXT_CTES, PARSE_CTES) + """
SELECT l.base || '.x12' AS file_path, CAST(l.l_orderkey AS VARCHAR) AS claim_id, CAST(l.n AS INTEGER) AS line_seq,
  sha256(concat_ws('||', l.vendor_id, b.file_hash, CAST(l.k AS VARCHAR), CAST(l.l_orderkey AS VARCHAR), CAST(l.n AS VARCHAR),
    'P' || CAST(l.l_partkey AS VARCHAR),
    CASE WHEN l.vendor_id = 'vendorC' THEN l.l_returnflag ELSE l.l_returnflag || ',' || l.l_linestatus END)) AS service_line_key
FROM oline l JOIN bronze b ON b.file_path = l.base || '.x12' WHERE l.kind NOT IN (19, 23)""")
def service_line_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    """FN6/G2: service_line_key = sha256(vendor, file, ST, claim, LX, procedure, modifiers)."""
    return Stages(spark, sf_dir).gold("claim_service_line").select("file_path", "claim_id", "line_seq", "service_line_key")


@register("diagnoses", with_ctes(BASE_CTES, TEXT_CTES, PARSE_CTES) + """
SELECT c.file_path, c.claim_id, 1 AS diag_seq, 'ABK' AS diag_qualifier, 'D' || CAST(c.o_orderkey % 1000 AS VARCHAR) AS diag_code,
  'ABK' || cv.c || 'D' || CAST(c.o_orderkey % 1000 AS VARCHAR) AS diag_raw
FROM claims_exp c JOIN cv ON cv.k = c.k WHERE c.o_orderkey % 5 <> 0
UNION ALL
SELECT c.file_path, c.claim_id, 2, 'ABF', 'Z' || CAST(c.o_orderkey % 77 AS VARCHAR), 'ABF' || cv.c || 'Z' || CAST(c.o_orderkey % 77 AS VARCHAR)
FROM claims_exp c JOIN cv ON cv.k = c.k WHERE c.o_orderkey % 5 <> 0""")
def diagnoses(spark: SparkSession, sf_dir: str) -> DataFrame:
    """HI composites -> diagnosis rows numbered from 1."""
    dx = Stages(spark, sf_dir).gold("claim_diagnosis")
    return dx.select("file_path", "claim_id", "diag_seq", "diag_qualifier", "diag_code", "diag_raw")


@register("providers", with_ctes(BASE_CTES, TEXT_CTES, PARSE_CTES) + """
SELECT c.file_path, c.claim_id, 'BILLING' AS provider_role, '85' AS nm1_code, '2' AS entity_type,
  'CLINIC ' || cv.n_name AS last_name_or_org, '' AS first_name, 'XX' AS id_qualifier,
  CAST(c.k + 1000000000 AS VARCHAR) AS id_value, CAST(c.k + 1000000000 AS VARCHAR) AS npi,
  CAST(c.k AS VARCHAR) || ' MAIN ST' AS addr1, 'CITY' || CAST(cv.c_nationkey AS VARCHAR) AS city, 'ST' AS state,
  CAST(c.k % 90000 + 10000 AS VARCHAR) AS zip
FROM claims_exp c JOIN cv ON cv.k = c.k
UNION ALL
SELECT c.file_path, c.claim_id, 'RENDERING', '82', '1', coalesce(c.s_name, ''), 'DOC', 'XX', CAST(c.rend_supp + 2000000000 AS VARCHAR),
  CAST(c.rend_supp + 2000000000 AS VARCHAR), NULL, NULL, NULL, NULL
FROM claims_exp c WHERE c.rend_supp IS NOT NULL""")
def providers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Billing provider (file level, with address) plus claim-level providers by role."""
    p = Stages(spark, sf_dir).gold("claim_provider")
    return p.select("file_path", "claim_id", "provider_role", "nm1_code", "entity_type", "last_name_or_org", "first_name",
                    "id_qualifier", "id_value", "npi", "addr1", "city", "state", "zip")


@register("other_payers", with_ctes(BASE_CTES, TEXT_CTES, PARSE_CTES) + """
SELECT file_path, claim_id, 1 AS payer_seq, 'PAYER' || CAST(k % 7 AS VARCHAR) AS payer_name, 'PY' || CAST(k % 7 AS VARCHAR) AS payer_id
FROM claims_exp WHERE o_orderkey % 6 = 0""")
def other_payers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """NM1*PR other payers numbered from 1."""
    op = Stages(spark, sf_dir).gold("claim_other_payer")
    return op.select("file_path", "claim_id", "payer_seq", "payer_name", "payer_id")


_PARTY_SQL = """
SELECT c.file_path, c.claim_id, {member} AS member_id, {first} AS first_name, {last} AS last_name,
  {dob} AS dob, {gender} AS gender, CAST(NULL AS VARCHAR) AS addr1, CAST(NULL AS VARCHAR) AS city,
  CAST(NULL AS VARCHAR) AS state, CAST(NULL AS VARCHAR) AS zip
FROM claims_exp c JOIN cv ON cv.k = c.k"""
_SUB = dict(member="'M' || CAST(c.k AS VARCHAR)", first="'SUB'", last="cv.c_name",
            dob="CAST(CAST(try_strptime(CAST(c.k % 28 + 19500101 AS VARCHAR), '%Y%m%d') AS DATE) AS VARCHAR)",
            gender="CASE WHEN c.k % 2 = 0 THEN 'F' ELSE 'M' END")
_PAT = dict(member="CASE WHEN c.k % 4 = 0 THEN 'P' || CAST(c.k AS VARCHAR) ELSE 'M' || CAST(c.k AS VARCHAR) END",
            first="CASE WHEN c.k % 4 = 0 THEN 'KID' ELSE 'SUB' END",
            last="CASE WHEN c.k % 4 = 0 THEN 'DEP' || CAST(c.k AS VARCHAR) ELSE cv.c_name END",
            dob="CASE WHEN c.k % 4 = 0 THEN '2010-01-01' ELSE CAST(CAST(try_strptime(CAST(c.k % 28 + 19500101 AS VARCHAR), '%Y%m%d') AS DATE) AS VARCHAR) END",
            gender="CASE WHEN c.k % 4 = 0 OR c.k % 2 = 0 THEN 'F' ELSE 'M' END")


def _party_query(table: str):
    def q(spark: SparkSession, sf_dir: str) -> DataFrame:
        p = Stages(spark, sf_dir).gold(table)
        return p.select("file_path", "claim_id", "member_id", "first_name", "last_name", _d("dob"), "gender",
                        "addr1", "city", "state", "zip")
    return q


register("subscribers", with_ctes(BASE_CTES, TEXT_CTES, PARSE_CTES) + _PARTY_SQL.format(**_SUB))(_party_query("claim_subscriber"))
register("patients", with_ctes(BASE_CTES, TEXT_CTES, PARSE_CTES) + _PARTY_SQL.format(**_PAT))(_party_query("claim_patient"))
QUERIES["subscribers"].__doc__ = "X9/G5: file-level subscriber (last NM1*IL overlay) per claim."
QUERIES["patients"].__doc__ = "X9/G6: patient (NM1*QC overlay, else the subscriber) per claim."


@register("party_scope_preceding", with_ctes(BASE_CTES, TEXT_CTES, PARSE_CTES) + _PARTY_SQL.format(**_PAT))
def party_scope_preceding(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Q3 option: parties in force at each CLM (``party_scope="preceding"``) -> gold patients."""
    st = Stages(spark, sf_dir)
    pre = C.latest_claims(C.parse(st.bronze, fixture_profiles(spark), party_scope="preceding")["ranked"])
    p = G.claim_patient(pre, RUN_ID, TS)
    return p.select("file_path", "claim_id", "member_id", "first_name", "last_name", _d("dob"), "gender",
                    "addr1", "city", "state", "zip")


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return dict(QUERIES)


def oracle_sql() -> dict[str, str]:
    return dict(ORACLES)


# The remaining families register themselves on import.
from claimflow.plans import queries_ops as _ops  # noqa: E402,F401
from claimflow.plans import queries_stored as _stored  # noqa: E402,F401
