"""Configuration tables as DataFrame literals, and lookups over them.

Partner differences live in rows, not code: vendor registry, parsing
profiles, pipeline steps, per-vendor step overrides, code maps,
standardization rules and data-quality rules. Seeds are created through
DataFrame literals (so the regex ``.*\\.x12$`` keeps its backslash).
"""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

SEED_TS = _dt.datetime(2024, 1, 1, 0, 0, 0)
PIPELINE_NAME = "x12_837_onboarding"
LANDING_ROOT = "/landing/x12/837"

# ---------------------------------------------------------------- schemas
VENDOR_REGISTRY_SCHEMA = (
    "vendor_id string, vendor_name string, active_flag boolean, transaction_type string, landing_path string, "
    "file_name_regex string, expected_version string, max_file_size_mb int, quarantine_on_oversize boolean, "
    "created_ts timestamp, updated_ts timestamp"
)
PROFILE_SCHEMA = (
    "vendor_id string, transaction_type string, use_isa_delimiters boolean, segment_delim string, "
    "element_delim string, component_delim string, repetition_delim string, strict_mode boolean, encoding string, "
    "newline_normalization string, expected_version string, created_ts timestamp, updated_ts timestamp"
)
STEPS_SCHEMA = (
    "pipeline_name string, step_order int, step_name string, notebook_path string, timeout_seconds int, "
    "enabled_flag boolean, default_params_json string, created_ts timestamp, updated_ts timestamp"
)
OVERRIDES_SCHEMA = (
    "vendor_id string, pipeline_name string, step_name string, enabled_override boolean, "
    "params_override_json string, created_ts timestamp, updated_ts timestamp"
)
VENDOR_STATE_SCHEMA = (
    "vendor_id string, pipeline_name string, last_discovery_ts timestamp, last_success_ts timestamp, "
    "last_status string, last_run_id string, notes string, updated_ts timestamp"
)
NM1_ROLE_SCHEMA = (
    "vendor_id string, loop_id string, nm101_entity_id string, role_name string, precedence int, "
    "active_flag boolean, created_ts timestamp, updated_ts timestamp"
)
HI_MAP_SCHEMA = "vendor_id string, hi_qualifier string, diag_type string, active_flag boolean, created_ts timestamp, updated_ts timestamp"
REF_MAP_SCHEMA = "vendor_id string, ref_qualifier string, ref_type string, active_flag boolean, created_ts timestamp, updated_ts timestamp"
STD_RULES_SCHEMA = (
    "rule_id string, rule_name string, vendor_id string, target_table string, target_column string, action string, "
    "action_params_json string, active_flag boolean, created_ts timestamp, updated_ts timestamp"
)
DQ_RULES_SCHEMA = (
    "rule_id string, rule_name string, entity string, severity string, vendor_id string, active_flag boolean, "
    "sql_predicate string, created_ts timestamp, updated_ts timestamp"
)

# ---------------------------------------------------------------- fixed seed values
# Vendor registry: (vendor_id, vendor_name, transaction_type, expected_version).
REGISTRY_SEED = [
    ("vendorA", "Vendor A (837P Professional)", "837P", "005010X222A1"),
    ("vendorB", "Vendor B (837P Professional)", "837P", "005010X222A1"),
    ("vendorC", "Vendor C (837I Institutional)", "837I", "005010X223A2"),
]
FILE_NAME_REGEX = r".*\.x12$"
MAX_FILE_SIZE_MB = 200

# Parsing profiles: (vendor_id, type, use_isa, segment, element, component, repetition, strict, version).
PROFILE_SEED = [
    ("vendorA", "837P", True, "~", "*", ":", "^", True, "005010X222A1"),
    ("vendorB", "837P", True, "~", "*", ":", "^", True, "005010X222A1"),
    ("vendorC", "837I", True, "~", "*", ":", "^", True, "005010X223A2"),
]
DEFAULT_PROFILE = {"use_isa_delimiters": True, "segment_delim": "~", "element_delim": "*",
                   "component_delim": ":", "repetition_delim": "^", "strict_mode": True}

# Pipeline steps: (step_order, step_name, step reference, timeout_seconds, enabled).
STEPS_SEED = [
    (10, "BRONZE", "claimflow.plans.pipeline:bronze_step", 3600, True),
    (20, "SILVER", "claimflow.plans.pipeline:silver_step", 7200, True),
    (25, "SILVER_STD", "claimflow.plans.pipeline:standardize_step", 3600, False),
    (30, "GOLD_HEADER", "claimflow.plans.pipeline:gold_header_step", 3600, True),
    (40, "GOLD_LINES", "claimflow.plans.pipeline:gold_lines_step", 3600, True),
    (50, "GOLD_DX", "claimflow.plans.pipeline:gold_dx_step", 3600, True),
    (60, "GOLD_PROVIDER", "claimflow.plans.pipeline:gold_provider_step", 3600, True),
    (70, "GOLD_SUB_PAT", "claimflow.plans.pipeline:gold_sub_pat_step", 3600, True),
    (80, "GOLD_OTHER_PAYER", "claimflow.plans.pipeline:gold_other_payer_step", 3600, True),
    (90, "OPS_AUDIT", "claimflow.plans.pipeline:ops_step", 3600, True),
    (95, "QUARANTINE_GATE", "claimflow.plans.pipeline:gate_step", 3600, False),
    (97, "PARTNER_EXTRACT", "claimflow.plans.pipeline:extract_step", 3600, False),
]
DEFAULT_TIMEOUT_SECONDS = 3600

# NM1 role map defaults: (nm101_entity_id, role_name, precedence).
NM1_ROLE_SEED = [("85", "BILLING", 10), ("82", "RENDERING", 10), ("77", "SERVICE_FACILITY", 10), ("DN", "REFERRING", 10)]
# REF qualifier map defaults: (ref_qualifier, ref_type).
REF_MAP_SEED = [("F8", "ORIGINAL_REFERENCE"), ("1K", "PAYER_CLAIM_CONTROL"), ("EI", "EMPLOYER_ID")]
# HI qualifier map defaults: (hi_qualifier, diag_type).
HI_MAP_SEED = [("ABK", "PRINCIPAL"), ("ABF", "ADMITTING"), ("APR", "OTHER")]
# Standardization rules: (rule_id, rule_name, target_table, target_column, action, action_params_json).
STD_RULES_SEED = [
    ("S001", "Trim claim_id", "silver_x12.silver_837_claim", "claim_id", "TRIM", "{}"),
    ("S002", "Uppercase transaction_version", "silver_x12.silver_837_claim", "transaction_version", "UPPER", "{}"),
    ("S003", "Default claim_amount to 0 if null", "silver_x12.silver_837_claim", "claim_amount", "DEFAULT_IF_NULL",
     '{"default":0}'),
]
# Data-quality rules: (rule_id, rule_name, entity, severity, vendor_id, sql_predicate). Predicates select FAILING rows.
DQ_RULES_SEED = [
    ("R001", "Silver claim must have claim_id", "SILVER_CLAIM", "ERROR", None, "claim_id IS NULL"),
    ("R002", "Silver claim amount cannot be negative", "SILVER_CLAIM", "ERROR", None, "claim_amount < 0"),
    ("R003", "Gold header must have claim_id", "GOLD_HEADER", "ERROR", None, "claim_id IS NULL"),
    ("R004", "Gold service line must have procedure_code", "GOLD_SERVICE_LINE", "WARN", None, "procedure_code IS NULL"),
    ("R005", "Gold provider should have role", "GOLD_PROVIDER", "WARN", None, "provider_role IS NULL"),
    ("VC01", "vendorC: subscriber_id is required", "SILVER_CLAIM", "ERROR", "vendorC", "subscriber_id IS NULL"),
    ("VC02", "vendorC: claim_amount must be > 0", "SILVER_CLAIM", "ERROR", "vendorC", "claim_amount IS NULL OR claim_amount <= 0"),
    ("VC03", "vendorC: at least one service line required", "SILVER_CLAIM", "ERROR", "vendorC",
     "service_lines_json IS NULL OR service_lines_json = '[]'"),
    ("VC04", "vendorC: diagnosis should exist", "SILVER_CLAIM", "WARN", "vendorC",
     "diagnosis_json IS NULL OR diagnosis_json = '[]'"),
]


# ---------------------------------------------------------------- seed frames
def vendor_registry(spark: SparkSession, landing_root: str = LANDING_ROOT) -> DataFrame:
    rows = [
        (vid, name, True, ttype, f"{landing_root}/{vid}", FILE_NAME_REGEX, ver, MAX_FILE_SIZE_MB, True, SEED_TS, SEED_TS)
        for vid, name, ttype, ver in REGISTRY_SEED
    ]
    return spark.createDataFrame(rows, VENDOR_REGISTRY_SCHEMA)


def vendor_profiles(spark: SparkSession) -> DataFrame:
    rows = [(*r[:8], "UTF-8", "NONE", r[8], SEED_TS, SEED_TS) for r in PROFILE_SEED]
    return spark.createDataFrame(rows, PROFILE_SCHEMA)


def pipeline_steps(spark: SparkSession) -> DataFrame:
    rows = [(PIPELINE_NAME, o, n, ref, t, en, "{}", SEED_TS, SEED_TS) for o, n, ref, t, en in STEPS_SEED]
    return spark.createDataFrame(rows, STEPS_SCHEMA)


def step_overrides(spark: SparkSession, rows: list[tuple] | None = None) -> DataFrame:
    """Per-vendor step overrides; none are seeded (rows: vendor, step, enabled, params_json)."""
    data = [(v, PIPELINE_NAME, s, en, p, SEED_TS, SEED_TS) for v, s, en, p in (rows or [])]
    return spark.createDataFrame(data, OVERRIDES_SCHEMA)


def empty_vendor_state(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame([], VENDOR_STATE_SCHEMA)


def nm1_role_map(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame([(None, None, c, r, p, True, SEED_TS, SEED_TS) for c, r, p in NM1_ROLE_SEED], NM1_ROLE_SCHEMA)


def hi_qualifier_map(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame([(None, q, t, True, SEED_TS, SEED_TS) for q, t in HI_MAP_SEED], HI_MAP_SCHEMA)


def ref_qualifier_map(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame([(None, q, t, True, SEED_TS, SEED_TS) for q, t in REF_MAP_SEED], REF_MAP_SCHEMA)


def standardization_rules(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame([(*r[:2], None, *r[2:], True, SEED_TS, SEED_TS) for r in STD_RULES_SEED], STD_RULES_SCHEMA)


def dq_rules(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame([(*r[:5], True, r[5], SEED_TS, SEED_TS) for r in DQ_RULES_SEED], DQ_RULES_SCHEMA)


# ---------------------------------------------------------------- lookups
def latest_profiles(profiles: DataFrame) -> DataFrame:
    """One profile per vendor: the row with the latest ``updated_ts``; NULL fields take the defaults."""
    cols = ["use_isa_delimiters", "segment_delim", "element_delim", "component_delim", "repetition_delim", "strict_mode"]
    latest = (
        profiles.filter(F.col("vendor_id").isNotNull())
        .groupBy("vendor_id")
        .agg(F.max_by(F.struct(*cols), F.col("updated_ts")).alias("p"))
    )

    def pick(c: str):
        v = F.col(f"p.{c}")
        if c not in ("use_isa_delimiters", "strict_mode"):
            v = F.nullif(v, F.lit(""))  # an empty delimiter falls back like a missing one
        return F.coalesce(v, F.lit(DEFAULT_PROFILE[c])).alias(c)

    return latest.select("vendor_id", *[pick(c) for c in cols])


def effective_profiles(profiles: DataFrame, params: DataFrame | None = None) -> DataFrame:
    """The latest profiles with the fields that a vendor's step parameters name put over them.

    ``params`` has ``vendor_id, params`` (map of text). A vendor with
    parameters but no profile starts from the defaults. Text that is no
    boolean leaves a boolean field as it is.
    """
    base = latest_profiles(profiles)
    if params is None:
        return base
    own = params.select(F.col("vendor_id").alias("_pv"), "params")
    j = base.join(own, base["vendor_id"] == own["_pv"], "full_outer")

    def field(name: str):
        value = F.try_element_at("params", F.lit(name))
        default = F.lit(DEFAULT_PROFILE[name])
        if name in ("use_isa_delimiters", "strict_mode"):
            value = value.try_cast("boolean")
        else:
            value = F.nullif(value, F.lit(""))
        return F.coalesce(value, F.col(name), default).alias(name)

    return j.select(F.coalesce("vendor_id", "_pv").alias("vendor_id"), *[field(c) for c in base.columns[1:]])


# In-memory config sides are broadcast only behind this row-count check; larger ones take a shuffle join.
MAX_BROADCAST_ROWS = 100_000
# Estimates from here on are Spark's default for relations of unknown size.
UNKNOWN_BYTES = 1 << 60


def broadcast_if_small(df: DataFrame, max_rows: int = MAX_BROADCAST_ROWS, files: bool = True) -> DataFrame:
    """Hint a broadcast for a config frame whose size was checked.

    Planning the broadcast up front (rather than leaving it to AQE at
    runtime) keeps the data side from being shuffled on the config key —
    e.g. file content by vendor — before the join is re-planned. A frame read
    from files alone needs no hint: Spark knows the files' bytes and compares
    them with its own threshold, without a job. It does not know those of a partitioned catalog
    table, which is counted. ``files=False`` counts in any
    case (a frame whose plan joins, so that its estimate says little).
    """
    if files and df.inputFiles() and int(str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes())) < UNKNOWN_BYTES:
        return df
    n = df.limit(max_rows + 1).count()
    return F.broadcast(df) if n <= max_rows else df


def active(df: DataFrame, flag: str = "active_flag") -> DataFrame:
    return df.filter(F.col(flag) == F.lit(True))


def scoped_lookup(
    data: DataFrame,
    mapping: DataFrame,
    data_key: str,
    map_key: str,
    value_cols: list[str],
    precedence: str | None = None,
) -> DataFrame:
    """Config lookup: a vendor-specific row wins over the global (NULL vendor) row.

    The map is reduced to one row per (vendor, key) first — the lowest
    ``precedence`` wins when several rows exist — then joined twice (vendor
    row, global row) and coalesced. Config maps are small; the joins are
    plain equi-joins that AQE turns into broadcasts from runtime sizes.
    """
    m = active(mapping)
    order = F.col(precedence) if precedence else F.lit(0)
    best = m.groupBy("vendor_id", map_key).agg(F.min_by(F.struct(*value_cols), order).alias("v"))
    vend = broadcast_if_small(best.filter(F.col("vendor_id").isNotNull()).select(
        F.col("vendor_id").alias("_mv"), F.col(map_key).alias("_mk"), F.col("v").alias("_vv")
    ))
    glob = broadcast_if_small(
        best.filter(F.col("vendor_id").isNull()).select(F.col(map_key).alias("_gk"), F.col("v").alias("_gv")))
    out = (
        data.join(vend, (data["vendor_id"] == vend["_mv"]) & (data[data_key] == vend["_mk"]), "left")
        .join(glob, data[data_key] == glob["_gk"], "left")
    )
    for c in value_cols:
        out = out.withColumn(c, F.when(F.col("_mv").isNotNull(), F.col(f"_vv.{c}")).otherwise(F.col(f"_gv.{c}")))
    return out.drop("_mv", "_mk", "_vv", "_gk", "_gv")
