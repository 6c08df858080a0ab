"""Gold normalizers (G1-G7): silver claims -> seven claim tables with hash keys.

Each normalizer accepts either the silver table (nested values as JSON
text, read with ``from_json``) or the typed claims frame of the parse (the
nested columns are used directly — no JSON round trip).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from claimflow.functions.keys import hash_key
from claimflow.functions.text import yyyymmdd_to_date
from claimflow.operators.claims import DX_TYPE, LINE_TYPE, PARTY_TYPE, PAYER_TYPE, PROVIDER_TYPE, REFERENCE_TYPE
from claimflow.operators.quality import map_ref

BASE = ["vendor_id", "file_hash", "file_path", "run_id", "parse_ts", "load_ts", "isa_control", "gs_control",
        "st_control", "transaction_version", "claim_id"]


def _nested(df: DataFrame, typed: str, json_col: str, ddl: str) -> Column:
    if typed in df.columns:
        return F.col(typed)
    return F.from_json(F.col(json_col), ddl)


def _with_base(df: DataFrame, run_id: str | None, load_ts: str | None) -> DataFrame:
    out = df
    if run_id is not None:
        out = out.withColumn("run_id", F.lit(run_id))
    if "parse_ts" not in out.columns:
        out = out.withColumn("parse_ts", F.lit(None).cast("timestamp"))
    ts = F.lit(load_ts).cast("timestamp") if load_ts else F.current_timestamp()
    return out.withColumn("load_ts", ts).withColumn("claim_key", claim_key())


def claim_key() -> Column:
    """sha256(vendor || file_hash || st_control || claim_id); NULL vendor/hash skipped, NULL ids as ''."""
    return hash_key("vendor_id", "file_hash", "st_control", "claim_id", raw=2)


def claim_header(claims: DataFrame, run_id: str | None = None, load_ts: str | None = None) -> DataFrame:
    df = _with_base(claims, run_id, load_ts)
    return df.select(
        *BASE[:10], "claim_id",
        F.col("claim_amount").cast("double").alias("claim_amount"),
        "place_of_service",
        F.col("subscriber_id").alias("subscriber_member_id"),
        F.col("patient_id").alias("patient_member_id"),
        "billing_npi", "rendering_npi",
        yyyymmdd_to_date(F.col("claim_from_dt")).alias("claim_from_date"),
        yyyymmdd_to_date(F.col("claim_to_dt")).alias("claim_to_date"),
        "claim_key",
    )


def claim_service_line(claims: DataFrame, run_id: str | None = None, load_ts: str | None = None) -> DataFrame:
    """One row per service line with a procedure code or a revenue code."""
    df = _with_base(claims, run_id, load_ts).withColumn("_lines", _nested(claims, "service_lines", "service_lines_json", LINE_TYPE))
    # explode (not explode_outer): the not-null filter below drops line-less claims anyway,
    # and the generator lets Catalyst push size(_lines) > 0 below it.
    x = df.select(*BASE, "claim_key", F.posexplode("_lines").alias("_pos", "sl"))
    x = x.filter(F.col("sl.procedure_code").isNotNull() | F.col("sl.revenue_code").isNotNull())
    mods = F.col("sl.modifiers")
    out = x.select(
        *BASE, "claim_key",
        (F.col("_pos") + 1).cast("int").alias("line_seq"),
        F.col("sl.lx").alias("lx"),
        F.col("sl.revenue_code").alias("rev_code"),
        F.col("sl.qualifier").alias("procedure_qualifier"),
        F.col("sl.procedure_code").alias("procedure_code"),
        F.concat_ws(",", mods).alias("modifiers_str"),
        *[F.get(mods, F.lit(i)).alias(f"modifier{i + 1}") for i in range(4)],
        F.col("sl.charge_amount").cast("double").alias("charge_amount"),
        F.col("sl.units").cast("double").alias("units"),
    )
    return out.withColumn(
        "service_line_key",
        hash_key("vendor_id", "file_hash", "st_control", "claim_id", "lx", "procedure_code", "modifiers_str", raw=2),
    )


def claim_diagnosis(claims: DataFrame, run_id: str | None = None, load_ts: str | None = None) -> DataFrame:
    df = _with_base(claims, run_id, load_ts).withColumn("_dx", _nested(claims, "diagnoses", "diagnosis_json", DX_TYPE))
    x = df.select(*BASE, "claim_key", F.posexplode("_dx").alias("_pos", "d"))
    out = x.select(
        *BASE, "claim_key",
        (F.col("_pos") + 1).cast("int").alias("diag_seq"),
        F.col("d.diag_qualifier").alias("diag_qualifier"),
        F.col("d.diag_code").alias("diag_code"),
        F.col("d.raw").alias("diag_raw"),
    ).filter(F.col("diag_code").isNotNull())
    return out.withColumn("diagnosis_key", hash_key("claim_key", "diag_seq", "diag_qualifier", "diag_code", raw=1))


def claim_provider(claims: DataFrame, run_id: str | None = None, load_ts: str | None = None) -> DataFrame:
    df = _with_base(claims, run_id, load_ts).withColumn("_p", _nested(claims, "providers", "providers_json", PROVIDER_TYPE))
    x = df.select(*BASE, "claim_key", F.posexplode("_p").alias("_pos", "p"))
    out = x.select(
        *BASE, "claim_key",
        (F.col("_pos") + 1).cast("int").alias("provider_seq"),
        F.col("p.role").alias("provider_role"),
        *[F.col(f"p.{c}").alias(c) for c in ["nm1_code", "entity_type", "last_name_or_org", "first_name",
                                             "id_qualifier", "id_value", "npi", "addr1", "city", "state", "zip"]],
    ).filter(F.col("provider_role").isNotNull())
    return out.withColumn(
        "provider_key", hash_key("claim_key", "provider_role", "npi", "id_value", "last_name_or_org", raw=1)
    )


def _party(claims: DataFrame, typed: str, json_col: str, tag: str, key_name: str,
           run_id: str | None, load_ts: str | None) -> DataFrame:
    df = _with_base(claims, run_id, load_ts).withColumn("p", _nested(claims, typed, json_col, PARTY_TYPE))
    out = df.select(
        *BASE, "claim_key",
        F.col("p.member_id").alias("member_id"),
        F.col("p.first_name").alias("first_name"),
        F.col("p.last_name").alias("last_name"),
        yyyymmdd_to_date(F.col("p.dob")).alias("dob"),
        *[F.col(f"p.{c}").alias(c) for c in ["gender", "addr1", "city", "state", "zip"]],
    ).filter(F.col("member_id").isNotNull())
    return out.withColumn(key_name, hash_key("claim_key", "member_id", F.lit(tag), raw=1))


def claim_subscriber(claims: DataFrame, run_id: str | None = None, load_ts: str | None = None) -> DataFrame:
    return _party(claims, "subscriber", "subscriber_json", "SUB", "subscriber_key", run_id, load_ts)


def claim_patient(claims: DataFrame, run_id: str | None = None, load_ts: str | None = None) -> DataFrame:
    return _party(claims, "patient", "patient_json", "PAT", "patient_key", run_id, load_ts)


def claim_other_payer(claims: DataFrame, run_id: str | None = None, load_ts: str | None = None) -> DataFrame:
    df = _with_base(claims, run_id, load_ts).withColumn("_op", _nested(claims, "other_payers", "other_payer_json", PAYER_TYPE))
    x = df.select(*BASE, "claim_key", F.posexplode("_op").alias("_pos", "op"))
    out = x.select(
        *BASE, "claim_key",
        (F.col("_pos") + 1).cast("int").alias("payer_seq"),
        F.col("op.payer_name").alias("payer_name"),
        F.col("op.payer_id").alias("payer_id"),
    ).filter(F.col("payer_name").isNotNull() | F.col("payer_id").isNotNull())
    return out.withColumn("other_payer_key", hash_key("claim_key", "payer_seq", "payer_id", "payer_name", raw=1))


def claim_reference(claims: DataFrame, ref_map: DataFrame) -> DataFrame:
    """REF segments of the claims, numbered from 1, with the type of the REF qualifier map."""
    refs = _nested(claims, "references", "references_json", REFERENCE_TYPE)
    x = claims.select("vendor_id", "file_hash", "file_path", "st_control", "claim_id", F.posexplode(refs).alias("_pos", "r"))
    rows = x.select(
        "vendor_id", "file_hash", "file_path", "st_control", "claim_id", (F.col("_pos") + 1).cast("int").alias("ref_seq"),
        "r.ref_qualifier", "r.ref_value",
    )
    return map_ref(rows, ref_map)


# Merge keys of each gold table (null-safe). Child rows have their position in the key, so that rows with
# equal codes (lines without LX, revenue-only lines, one provider in two roles or twice) are all kept.
GOLD_KEYS = {
    "claim_header": ["file_hash", "st_control", "claim_id"],
    "claim_service_line": ["file_hash", "st_control", "claim_id", "line_seq", "lx", "procedure_code", "modifiers_str"],
    "claim_diagnosis": ["diagnosis_key"],
    "claim_provider": ["provider_key", "provider_seq"],
    "claim_subscriber": ["subscriber_key"],
    "claim_patient": ["patient_key"],
    "claim_other_payer": ["other_payer_key"],
}

NORMALIZERS = {
    "claim_header": claim_header,
    "claim_service_line": claim_service_line,
    "claim_diagnosis": claim_diagnosis,
    "claim_provider": claim_provider,
    "claim_subscriber": claim_subscriber,
    "claim_patient": claim_patient,
    "claim_other_payer": claim_other_payer,
}
