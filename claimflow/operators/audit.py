"""Ops: pipeline runs, file audit, silver/gold metrics, reconciliation (OPS1-OPS5, OPS7).

Amounts are summed as decimals, so totals do not depend on row order.

Reconciliation works on partial sums: silver and the seven gold tables are
stacked and aggregated once to a row per (table, file, transaction). Partial
sums of later rows are added beside the earlier ones, so a run that adds rows
never reads the old ones again, and a file's figures are the sum of its few
partial rows.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import Window

from claimflow.operators.merge import append_missing, merge_frames

AMOUNT_TOLERANCE = 0.01
RUN_SCHEMA = ("pipeline_name string, run_id string, triggered_by string, start_ts timestamp, end_ts timestamp, "
              "status string, notes string")
FILE_AUDIT_TYPES = {
    "vendor_id": "string", "file_hash": "string", "file_path": "string", "first_seen_ts": "timestamp",
    "last_updated_ts": "timestamp", "file_size_bytes": "bigint", "bronze_run_id": "string", "silver_run_id": "string",
    "gold_run_id": "string", "status": "string", "error_stage": "string", "error_message": "string",
    "silver_claim_count": "bigint", "silver_service_line_count": "bigint", "silver_total_claim_amount": "double",
    "gold_header_count": "bigint", "gold_service_line_count": "bigint", "gold_dx_count": "bigint",
    "gold_provider_count": "bigint", "gold_subscriber_count": "bigint", "gold_patient_count": "bigint",
    "gold_other_payer_count": "bigint", "recon_header_match": "boolean", "recon_service_line_match": "boolean",
    "recon_amount_match": "boolean", "recon_notes": "string",
}
FILE_AUDIT_COLUMNS = list(FILE_AUDIT_TYPES)
SILVER = "silver_837_claim"
# Gold table -> its count in the file audit.
GOLD_COUNTS = {
    "claim_header": "gold_header_count", "claim_service_line": "gold_service_line_count", "claim_diagnosis": "gold_dx_count",
    "claim_provider": "gold_provider_count", "claim_subscriber": "gold_subscriber_count",
    "claim_patient": "gold_patient_count", "claim_other_payer": "gold_other_payer_count",
}
PARTIAL_SCHEMA = ("source string, vendor_id string, file_hash string, st_control string, transaction_version string, "
                  "run_id string, n_rows bigint, n_lines bigint, amount decimal(38,2)")
RECON_SCHEMA = ("vendor_id string, file_hash string, st_control string, transaction_version string, expected_claims bigint, "
                "parsed_claims bigint, gold_headers bigint, gold_lines bigint, parsed_claim_amt double, header_claim_amt double, "
                "header_match boolean, lines_match boolean, amount_match boolean, load_ts timestamp")
GOLD_COUNT_COLUMNS = ["gold_service_line_count", "gold_dx_count", "gold_provider_count", "gold_subscriber_count",
                      "gold_patient_count", "gold_other_payer_count"]

# Reconciliation notes and statuses.
NOTE_HEADER = "Header count mismatch"
NOTE_LINES = "Service line count mismatch"
NOTE_AMOUNT = "Claim amount mismatch"
STATUS_BRONZE = "BRONZE_LOADED"
STATUS_GOLD = "GOLD_BUILT"
STATUS_FAILED = "FAILED"
STATUS_QUARANTINED = "QUARANTINED"


def money_sum(c: Column) -> Column:
    """NULL-as-zero sum through decimal(38,2), returned as double.

    ``try_cast``: under ANSI mode a plain cast of an absurd amount (say 1e40
    from a malformed file) would fail the whole job; such an amount counts
    as NULL instead.
    """
    return F.coalesce(F.sum(F.coalesce(c, F.lit(0)).try_cast("decimal(38,2)")),
                      F.lit(0).cast("decimal(38,2)")).cast("double")


def _now(ts: str | None) -> Column:
    return F.lit(ts).cast("timestamp") if ts else F.current_timestamp()


# ---------------------------------------------------------------- runs
def run_row(spark: SparkSession, pipeline_name: str, run_id: str, triggered_by: str | None, start_ts) -> DataFrame:
    return spark.createDataFrame([(pipeline_name, run_id, triggered_by, start_ts, None, "RUNNING", None)], RUN_SCHEMA)


def start_run(runs: DataFrame, new_run: DataFrame) -> DataFrame:
    """Register a RUNNING row (insert-only on pipeline_name, run_id)."""
    return merge_frames(runs, new_run, ["pipeline_name", "run_id"])


def finish_run(runs: DataFrame, pipeline_name: str, run_id: str, status_row: DataFrame) -> DataFrame:
    """Update-only merge of end_ts / status / notes (``status_row`` from :func:`run_status`)."""
    src = status_row.select(
        F.lit(pipeline_name).alias("pipeline_name"), F.lit(run_id).alias("run_id"), "end_ts", "status", "notes"
    )
    return merge_frames(runs, src, ["pipeline_name", "run_id"], update=["end_ts", "status", "notes"], insert=False)


def run_status(file_audit: DataFrame, touched: DataFrame | None = None, end_ts=None) -> DataFrame:
    """One row: FAILED if any (touched) file_audit row is FAILED, else SUCCESS.

    ``touched`` (a frame of ``file_hash``) limits the test to the files of
    this run; without it every row counts, as the audit table's history.
    """
    fa = file_audit if touched is None else file_audit.join(touched.select("file_hash").distinct(), "file_hash", "left_semi")
    agg = fa.agg(
        F.coalesce(F.bool_or(F.col("status") == STATUS_FAILED), F.lit(False)).alias("has_fail"),
        F.count_if(F.col("status") == STATUS_FAILED).alias("failed_files"),
    )
    ts = F.lit(end_ts).cast("timestamp") if end_ts is not None else F.current_timestamp()
    return agg.select(
        ts.alias("end_ts"),
        F.when(F.col("has_fail"), F.lit("FAILED")).otherwise(F.lit("SUCCESS")).alias("status"),
        F.when(F.col("has_fail"), F.lit("One or more files failed reconciliation."))
        .otherwise(F.lit("All files reconciled.")).alias("notes"),
        "failed_files",
    )


# ---------------------------------------------------------------- metrics
def _line_count(silver: DataFrame) -> Column:
    """Service lines of a silver claim, 0 when there is no array."""
    if "service_lines" in silver.columns:
        n = F.size("service_lines")
    else:
        # counts the array's elements without materialising them (NULL for NULL / non-array text)
        n = F.json_array_length("service_lines_json")
    return F.coalesce(F.when(n >= 0, n), F.lit(0))


def silver_metrics(silver: DataFrame) -> DataFrame:
    """Per (vendor_id, file_hash): claim count, amount total, service-line count."""
    return silver.groupBy("vendor_id", "file_hash").agg(
        F.count(F.lit(1)).alias("silver_claim_count"),
        money_sum(F.col("claim_amount")).alias("silver_total_claim_amount"),
        F.sum(_line_count(silver)).cast("long").alias("silver_service_line_count"),
    )


def gold_metrics(header: DataFrame, lines: DataFrame, dx: DataFrame, providers: DataFrame,
                 subscribers: DataFrame, patients: DataFrame, payers: DataFrame) -> DataFrame:
    """Per file_hash: header count and amount, and the row count of each child table.

    The seven tables are stacked as ``(file_hash, table, amount)`` rows and
    aggregated once; partial aggregation happens before the single shuffle.
    """
    parts = [
        header.select("file_hash", F.lit("H").alias("t"), F.col("claim_amount").alias("amt")),
        lines.select("file_hash", F.lit("L").alias("t"), F.lit(None).cast("double").alias("amt")),
        dx.select("file_hash", F.lit("D").alias("t"), F.lit(None).cast("double").alias("amt")),
        providers.select("file_hash", F.lit("P").alias("t"), F.lit(None).cast("double").alias("amt")),
        subscribers.select("file_hash", F.lit("S").alias("t"), F.lit(None).cast("double").alias("amt")),
        patients.select("file_hash", F.lit("T").alias("t"), F.lit(None).cast("double").alias("amt")),
        payers.select("file_hash", F.lit("O").alias("t"), F.lit(None).cast("double").alias("amt")),
    ]
    stacked = parts[0]
    for p in parts[1:]:
        stacked = stacked.unionByName(p)

    def n(tag: str) -> Column:
        return F.count_if(F.col("t") == tag).cast("long")

    agg = stacked.groupBy("file_hash").agg(
        n("H").alias("gold_header_count"),
        money_sum(F.when(F.col("t") == "H", F.col("amt"))).alias("gold_total_claim_amount"),
        n("L").alias("gold_service_line_count"),
        n("D").alias("gold_dx_count"),
        n("P").alias("gold_provider_count"),
        n("S").alias("gold_subscriber_count"),
        n("T").alias("gold_patient_count"),
        n("O").alias("gold_other_payer_count"),
    )
    return agg


def partial_sums(frames: Mapping[str, DataFrame]) -> DataFrame:
    """``PARTIAL_SCHEMA``: rows, service lines and amount per table, file and transaction.

    ``frames``: new rows of silver (``SILVER``) and of gold tables by name;
    absent ones have no new rows. One stacked aggregation, combined before its
    only shuffle. The sums add up: those of several loads may stand side by side.
    """
    stacked = None
    for source, df in frames.items():
        amount = F.col("claim_amount") if source in (SILVER, "claim_header") else F.lit(0)
        part = df.select(
            F.lit(source).alias("source"), "vendor_id", "file_hash", "st_control", "transaction_version", "run_id",
            (_line_count(df) if source == SILVER else F.lit(0)).cast("long").alias("lines"),
            F.coalesce(amount.try_cast("decimal(38,2)"), F.lit(0)).cast("decimal(38,2)").alias("amt"),
        )
        stacked = part if stacked is None else stacked.unionByName(part)
    return stacked.groupBy("source", "vendor_id", "file_hash", "st_control", "transaction_version").agg(
        F.max("run_id").alias("run_id"), F.count(F.lit(1)).alias("n_rows"), F.sum("lines").alias("n_lines"),
        F.sum("amt").cast("decimal(38,2)").alias("amount"),
    )


def _of(source: str, column: str) -> Column:
    """The column where the partial row belongs to the table."""
    return F.when(F.col("source") == source, F.col(column))


def _total(source: str, column: str) -> Column:
    zero = F.lit(0).cast("decimal(38,2)" if column == "amount" else "bigint")
    out = F.coalesce(F.sum(_of(source, column)), zero)
    return out.cast("double" if column == "amount" else "bigint")


def reconcile_files(partials: DataFrame, ts: str | None = None, tolerance: DataFrame | None = None) -> DataFrame:
    """Silver vs gold per file from partial sums: counts, three match flags, notes, GOLD_BUILT / FAILED.

    Files that exist only in gold surface as well; missing counts are 0. Run
    ids are those of the rows (the latest). ``tolerance`` (``vendor_id,
    amount_tolerance``) overrides the amount tolerance of its vendors.
    """
    counts = [_total(t, "n_rows").alias(c) for t, c in GOLD_COUNTS.items()]
    sums = partials.groupBy("file_hash").agg(
        F.max("vendor_id").alias("vendor_id"),
        _total(SILVER, "n_rows").alias("silver_claim_count"),
        _total(SILVER, "n_lines").alias("silver_service_line_count"),
        _total(SILVER, "amount").alias("silver_total_claim_amount"),
        *counts,
        _total("claim_header", "amount").alias("gold_total_claim_amount"),
        F.max(_of(SILVER, "run_id")).alias("silver_run_id"),
        F.max(_of("claim_header", "run_id")).alias("gold_run_id"),
    )
    allowed: Column = F.lit(AMOUNT_TOLERANCE)
    if tolerance is not None:
        sums = sums.join(tolerance, "vendor_id", "left")
        allowed = F.coalesce(F.col("amount_tolerance"), allowed)
    off = F.abs(F.col("silver_total_claim_amount") - F.col("gold_total_claim_amount"))
    tests = {
        "recon_header_match": (F.col("silver_claim_count") == F.col("gold_header_count"), NOTE_HEADER),
        "recon_service_line_match": (F.col("silver_service_line_count") == F.col("gold_service_line_count"), NOTE_LINES),
        "recon_amount_match": (off < allowed, NOTE_AMOUNT),
    }
    flagged = sums.withColumns({name: test for name, (test, _) in tests.items()})
    all_match = F.forall(F.array(*tests), lambda m: m)
    return flagged.withColumns({
        "recon_notes": F.concat_ws("; ", *[F.when(~F.col(name), F.lit(note)) for name, (_, note) in tests.items()]),
        "status": F.when(all_match, F.lit(STATUS_GOLD)).otherwise(F.lit(STATUS_FAILED)),
        "last_updated_ts": _now(ts),
    }).drop("amount_tolerance")


def reconcile_transactions(partials: DataFrame, ts: str | None = None) -> DataFrame:
    """Per (vendor, file, ST control, version) with silver claims: parsed vs gold headers and amounts; lines present.

    Service lines count per ST control, whatever their version. What gold has not got is NULL.
    """
    header, lines = "claim_header", "claim_service_line"
    per = partials.groupBy("file_hash", "st_control", "transaction_version").agg(
        F.max("vendor_id").alias("vendor_id"),
        F.sum(_of(SILVER, "n_rows")).alias("parsed_claims"),
        F.sum(_of(SILVER, "amount")).cast("double").alias("parsed_claim_amt"),
        F.sum(_of(header, "n_rows")).alias("gold_headers"),
        F.sum(_of(header, "amount")).cast("double").alias("header_claim_amt"),
        F.sum(_of(lines, "n_rows")).alias("_lines"),
    )
    # a few rows an ST control; the window reuses no row of the claims themselves
    per = per.withColumn("gold_lines", F.sum("_lines").over(Window.partitionBy("file_hash", "st_control")))
    off = F.abs(F.col("parsed_claim_amt") - F.col("header_claim_amt"))
    derived = {
        "expected_claims": F.lit(None).cast("long"),
        "header_match": F.col("parsed_claims") == F.col("gold_headers"),
        "lines_match": F.col("gold_lines").isNotNull(),
        "amount_match": off < F.lit(AMOUNT_TOLERANCE),
        "load_ts": _now(ts),
    }
    return per.filter("parsed_claims > 0").withColumns(derived).select(*[c.split()[0] for c in RECON_SCHEMA.split(", ")])


# ---------------------------------------------------------------- file audit
def file_audit_base(bronze: DataFrame, ts: str | None = None) -> DataFrame:
    """Bronze rows as file_audit rows (status BRONZE_LOADED, metrics NULL)."""
    base = bronze.select(
        "vendor_id", "file_hash", "file_path", "file_size_bytes",
        F.col("run_id").alias("bronze_run_id"),
        F.col("modification_time").alias("first_seen_ts"),
        _now(ts).alias("last_updated_ts"),
        F.lit(STATUS_BRONZE).alias("status"),
    )
    return append_missing(FILE_AUDIT_COLUMNS, base, FILE_AUDIT_TYPES)


def empty_file_audit(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame([], ", ".join(f"{c} {t}" for c, t in FILE_AUDIT_TYPES.items()))


BASE_COLUMNS = ["vendor_id", "file_path", "file_size_bytes", "bronze_run_id"]
RECON_COLUMNS = ["silver_run_id", "gold_run_id", "silver_claim_count", "silver_service_line_count", "silver_total_claim_amount",
                 *GOLD_COUNTS.values(), "recon_header_match", "recon_service_line_match", "recon_amount_match", "recon_notes"]


def merge_file_audit(old: DataFrame, base: DataFrame | None = None, recon: DataFrame | None = None,
                     quarantined: DataFrame | None = None, replaced: DataFrame | None = None) -> DataFrame:
    """The audit rows after all changes of a run, in one aggregation by ``file_hash``.

    * ``base`` (bronze rows): upsert of vendor, path, size, bronze run and time;
    * ``recon``: update of run ids, counts, flags and notes of files already there;
    * ``quarantined`` (``file_hash``): those files have status QUARANTINED, which is never overwritten;
    * ``replaced`` (``file_hash``): files whose earlier rows are gone; what they had counts for nothing.

    Each frame has a row a file at most. Further columns of ``old`` (a
    partition) are kept, NULL for new files.
    """
    extra = [c for c in old.columns if c not in FILE_AUDIT_COLUMNS]
    marks = {"quarantined": quarantined, "replaced": replaced}
    parts = [old.select("file_hash", F.struct(*[c for c in old.columns if c != "file_hash"]).alias("old"))]
    for name, df, cols in (("base", base, [*BASE_COLUMNS, "first_seen_ts", "last_updated_ts"]),
                           ("recon", recon, [*RECON_COLUMNS, "status", "last_updated_ts"])):
        if df is None:
            df = old.limit(0)
        parts.append(df.select("file_hash", F.struct(*cols).alias(name)))
    for name, df in marks.items():
        df = old.limit(0) if df is None else df
        parts.append(df.select("file_hash").distinct().withColumn(name, F.lit(True)))
    stacked = parts[0]
    for p in parts[1:]:
        stacked = stacked.unionByName(p, allowMissingColumns=True)
    per = stacked.groupBy("file_hash").agg(
        *[F.first(c, ignorenulls=True).alias(c) for c in ("old", "base", "recon")],
        *[F.coalesce(F.bool_or(c), F.lit(False)).alias(c) for c in marks],
    )
    has = lambda c: F.col(c).isNotNull()
    gone = F.col("replaced")
    was_held = F.coalesce(F.col("old.status") == STATUS_QUARANTINED, F.lit(False)) & ~gone
    values = {
        "file_hash": F.col("file_hash"),
        "first_seen_ts": F.when(has("old"), F.col("old.first_seen_ts")).otherwise(F.col("base.first_seen_ts")),
        "last_updated_ts": F.coalesce("recon.last_updated_ts", "base.last_updated_ts", "old.last_updated_ts"),
        "status": F.when(F.col("quarantined") | was_held, F.lit(STATUS_QUARANTINED))
        .when(has("recon"), F.col("recon.status"))
        .when(gone | ~has("old"), F.lit(STATUS_BRONZE))
        .otherwise(F.col("old.status")),
    }
    for c in BASE_COLUMNS:
        values[c] = F.when(has("base"), F.col(f"base.{c}")).otherwise(F.col(f"old.{c}"))
    for c in RECON_COLUMNS:
        values[c] = F.when(has("recon"), F.col(f"recon.{c}")).when(~gone, F.col(f"old.{c}"))
    for c in [c for c in FILE_AUDIT_COLUMNS if c not in values] + extra:
        values[c] = F.col(f"old.{c}")
    # files of which only a later step knows are no audit rows
    return per.filter(has("old") | has("base")).select(*[values[c].alias(c) for c in [*FILE_AUDIT_COLUMNS, *extra]])
