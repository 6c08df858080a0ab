"""Data quality, standardization, code-map lookups and quarantine (OPS6, OPS8, OPS9, OPS14, X23-X24).

DQ rules are rows holding a SQL predicate that selects *failing* rows. The
rule definitions (a handful of config rows) are read on the driver to build
one plan per entity: every rule of an entity is one ``count_if`` column of a
single aggregation over the entity, so R rules cost one scan, not R.
"""

from __future__ import annotations

import json
import re

from py4j.java_gateway import is_instance_of
from py4j.protocol import Py4JJavaError
from pyspark import SparkContext
from pyspark.errors import PySparkException
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window
from pyspark.sql.types import BooleanType, StringType

from claimflow.sources.config import active, broadcast_if_small, scoped_lookup

SAMPLE_CHARS = 2000
HASH_CHARS = 64  # of a sha256 in hexadecimal, which every stored row holds as its file_hash
DQ_SCHEMA = ("pipeline_name string, run_id string, vendor_id string, file_hash string, rule_id string, entity string, "
             "severity string, failed_count bigint, sample_values string, load_ts timestamp")
ENTITIES = ["SILVER_CLAIM", "GOLD_HEADER", "GOLD_SERVICE_LINE", "GOLD_DIAGNOSIS", "GOLD_PROVIDER"]
# A subquery opens with a bracket and one of these words; text inside quotes doesn't count.
_QUOTED = re.compile(r"'(?:[^'\\]|\\.|'')*'|\"(?:[^\"\\]|\\.|\"\")*\"|`[^`]*`", re.DOTALL)
_SUBQUERY = re.compile(r"\(\s*(select|with|from|values|table)\b", re.IGNORECASE)


def validate_predicate(df: DataFrame, predicate: str) -> str | None:
    """None when ``predicate`` is a boolean expression over ``df``'s columns, else the reason.

    A rule must stay a row filter: subqueries, aggregates and window functions
    are refused. Analysis runs on the driver and starts no job.
    """
    if predicate is None or not predicate.strip():
        return "empty predicate"
    if _SUBQUERY.search(_QUOTED.sub("''", predicate)):
        return "subqueries are not allowed in DQ predicates"
    try:
        dtype = df.select(F.expr(predicate).alias("_p")).schema["_p"].dataType
        if isinstance(dtype, BooleanType):
            df.filter(F.expr(predicate)).schema  # an aggregate or window function can't stand in a filter
    except Exception as e:  # analysis error: unknown column, bad syntax
        return f"invalid predicate: {str(e).splitlines()[0][:200]}"
    if not isinstance(dtype, BooleanType):
        return f"predicate is {dtype.simpleString()}, not boolean"
    return None


def run_dq_rules(
    entities: dict[str, DataFrame],
    rules: DataFrame,
    pipeline_name: str,
    run_id: str,
    load_ts: str | None = None,
    with_samples: bool = True,
    probe: bool = False,
    sample_order: list[str] | None = None,
    least_row_chars: int = 3,
) -> DataFrame:
    """``dq_results`` rows: one per (rule, vendor, file) with at least one failing row.

    Vendor-scoped rules only count rows of their vendor. A NULL predicate
    result is not a failure (SQL WHERE semantics). A rule that does not
    analyse gives one ``RULE_ERROR`` row with the reason as sample. With
    ``probe`` every rule is first run over its entity alone (a job each); one
    that fails on the data, such as a cast of unfit text, gives a
    ``RULE_ERROR`` row too and the others are counted as usual. Samples list
    failing rows by ``sample_order``, or by a hash of the row;
    ``least_row_chars`` says how long the JSON of any row is at least.
    """
    spark = rules.sparkSession
    defs = active(rules).select("rule_id", "entity", "severity", "vendor_id", "sql_predicate").orderBy("rule_id").collect()
    ts = F.lit(load_ts).cast("timestamp") if load_ts else F.current_timestamp()
    outputs = []
    errors = []
    for entity in sorted({r["entity"] for r in defs}):
        frame = entities.get(entity)
        if frame is None:
            continue
        good = []
        for r in (x for x in defs if x["entity"] == entity):
            reason = validate_predicate(frame, r["sql_predicate"])
            if reason is None and probe:
                reason = _fails(frame, r)
            if reason:
                errors.append((pipeline_name, run_id, r["vendor_id"], None, r["rule_id"], entity, "RULE_ERROR", None,
                               reason[:SAMPLE_CHARS]))
            else:
                good.append(r)
        if not good:
            continue
        flags = [_failing(r).alias(f"_f{i}") for i, r in enumerate(good)]
        scored = frame.select("*", *flags)
        counts = scored.groupBy("vendor_id", "file_hash").agg(
            *[F.count_if(F.col(f"_f{i}")).alias(f"_n{i}") for i in range(len(good))]
        )
        items = F.array(*[
            F.struct(F.lit(r["rule_id"]).alias("rule_id"), F.lit(r["severity"]).cast("string").alias("severity"),
                     F.col(f"_n{i}").alias("failed_count"))
            for i, r in enumerate(good)
        ])
        long = counts.select("vendor_id", "file_hash", F.explode(items).alias("_r")).select(
            "vendor_id", "file_hash", "_r.*").filter(F.col("failed_count") > 0)
        long = long.withColumn("entity", F.lit(entity))
        if with_samples:
            smp = _samples(scored, good, frame.columns, sample_order, least_row_chars)
            same = [long[k].eqNullSafe(smp[k]) for k in ("vendor_id", "file_hash", "rule_id")]
            long = long.join(smp, same[0] & same[1] & same[2], "left").select(
                *[long[c] for c in long.columns], smp["sample_values"])
        else:
            long = long.withColumn("sample_values", F.lit(None).cast("string"))
        outputs.append(long)
    out = None
    for o in outputs:
        o = o.select(
            F.lit(pipeline_name).alias("pipeline_name"), F.lit(run_id).alias("run_id"), "vendor_id", "file_hash",
            "rule_id", "entity", "severity", F.col("failed_count").cast("long"), "sample_values", ts.alias("load_ts"),
        )
        out = o if out is None else out.unionByName(o)
    if errors:
        err = spark.createDataFrame(
            errors, "pipeline_name string, run_id string, vendor_id string, file_hash string, rule_id string, "
                    "entity string, severity string, failed_count bigint, sample_values string"
        ).withColumn("load_ts", ts)
        out = err if out is None else out.unionByName(err)
    if out is None:
        out = spark.createDataFrame([], DQ_SCHEMA)
    return out


def _failing(rule) -> Column:
    """True for the rows that fail the rule."""
    cond = F.coalesce(F.expr(rule["sql_predicate"]), F.lit(False))
    if rule["vendor_id"]:
        cond = cond & F.coalesce(F.col("vendor_id") == F.lit(rule["vendor_id"]), F.lit(False))
    return cond


def is_data_error(e: BaseException) -> bool:
    """Whether rows caused the error (SQLSTATE class 22: casts, arithmetic, dates), and not the cluster or the plan.

    When several stages fail at once, Spark raises an exception of its own that has their errors as causes.
    """
    while e is not None:
        state = e.getSqlState() if isinstance(e, PySparkException) else None
        if (state and state.startswith("22")) or (isinstance(e, Py4JJavaError) and _java_data_error(e.java_exception)):
            return True
        e = e.__cause__
    return False


def _java_data_error(e) -> bool:
    while e is not None:
        if is_instance_of(SparkContext._gateway, e, "org.apache.spark.SparkThrowable") and (e.getSqlState() or "").startswith("22"):
            return True
        e = e.getCause()
    return False


def _fails(frame: DataFrame, rule) -> str | None:
    """The reason why the rule can't be evaluated over the rows, if it can't (runs a job)."""
    try:
        frame.agg(F.count_if(_failing(rule))).collect()
    except (PySparkException, Py4JJavaError) as e:
        if not is_data_error(e):
            raise
        return f"rule failed on the data: {str(e).splitlines()[0][:200]}"
    return None


def _samples(scored: DataFrame, good: list, cols: list[str], order: list[str] | None = None, least: int = 3) -> DataFrame:
    """Failing rows per (vendor, file, rule) as JSON, cut to SAMPLE_CHARS, the only cut that shows.

    A row takes part when the rows before it have not filled the budget of
    SAMPLE_CHARS. Long values are cut to the budget first, as what lies behind
    can't show. Before the shuffle a bound on the rows a group can need stands
    in for their lengths: when no row is shorter than ``least`` characters (64
    where it holds a sha256 in hexadecimal), ``SAMPLE_CHARS / least`` rows fill
    the budget whatever they hold. ``row_number() <= k`` is planned as a group
    limit on both sides of the shuffle. After it the running length cuts the
    rows that are beyond the budget.
    """
    rid = F.element_at(F.array(*[F.lit(r["rule_id"]) for r in good]), F.col("_i") + 1)
    fail_idx = F.filter(
        F.array(*[F.when(F.col(f"_f{i}"), F.lit(i)) for i in range(len(good))]), lambda x: x.isNotNull()
    )
    texts = {f.name for f in scored.schema.fields if isinstance(f.dataType, StringType)}
    row = F.struct(*[F.substring(c, 1, SAMPLE_CHARS).alias(c) if c in texts else F.col(c) for c in cols])
    by = F.struct(*order) if order else F.xxhash64(*[F.col(c) for c in cols])
    # only failing rows are hashed and kept as structs
    failing = scored.withColumn("_fi", fail_idx).filter(F.size("_fi") > 0)
    rows = failing.select("vendor_id", "file_hash", row.alias("_row"), by.alias("_o"), F.explode("_fi").alias("_i"))
    rows = rows.withColumn("rule_id", rid)
    keys = ["vendor_id", "file_hash", "rule_id"]
    ranked = Window.partitionBy(*keys).orderBy("_o")
    top = rows.withColumn("_rn", F.row_number().over(ranked)).filter(F.col("_rn") <= SAMPLE_CHARS // least + 1)
    top = top.select(*keys, "_rn", F.substring(F.to_json(F.col("_row")), 1, SAMPLE_CHARS).alias("_j"))
    before = Window.partitionBy(*keys).orderBy("_rn").rowsBetween(Window.unboundedPreceding, -1)
    used = F.coalesce(F.sum(F.char_length("_j") + 1).over(before), F.lit(0))
    top = top.withColumn("_used", used).filter(F.col("_used") < SAMPLE_CHARS)
    joined = F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("_rn", "_j"))), lambda x: x["_j"]), ",")
    text = F.substring(F.concat(F.lit("["), joined, F.lit("]")), 1, SAMPLE_CHARS)
    return top.groupBy(*keys).agg(text.alias("sample_values"))


# ---------------------------------------------------------------- standardization
def _action(col: Column, action: str, params: dict, dtype: str) -> Column | None:
    a = (action or "").upper()
    if a == "TRIM":
        return F.trim(col)
    if a == "UPPER":
        return F.upper(col)
    if a == "LOWER":
        return F.lower(col)
    if a == "REGEX_REPLACE":
        return F.regexp_replace(col, F.lit(params.get("pattern", "")), F.lit(params.get("replacement", "")))
    if a == "DEFAULT_IF_NULL":
        return F.coalesce(col, F.lit(params.get("default")).cast(dtype))
    return None


def apply_standardization(df: DataFrame, rules: DataFrame, table: str) -> DataFrame:
    """Apply active rules targeting ``table`` (matched by name suffix) in ``rule_id`` order.

    A vendor-scoped rule only touches rows of its vendor; unknown actions and
    columns the frame lacks are skipped.
    """
    defs = active(rules).orderBy("rule_id").collect()
    out = df
    for r in defs:
        tgt = (r["target_table"] or "").lower()
        if not (tgt == table.lower() or tgt.endswith("." + table.lower())):
            continue
        c = r["target_column"]
        if c not in out.columns:
            continue
        try:
            params = json.loads(r["action_params_json"] or "{}")
        except ValueError:
            params = {}
        dtype = out.schema[c].dataType.simpleString()
        new = _action(F.col(c), r["action"], params, dtype)
        if new is None:
            continue
        if r["vendor_id"]:
            new = F.when(F.col("vendor_id") == F.lit(r["vendor_id"]), new).otherwise(F.col(c))
        out = out.withColumn(c, new.cast(dtype))
    return out


# ---------------------------------------------------------------- code maps
def map_roles(providers: DataFrame, nm1_role_map: DataFrame) -> DataFrame:
    """Gold providers + ``mapped_role`` from the NM1 role map (vendor row over global, precedence)."""
    m = nm1_role_map.withColumnRenamed("role_name", "mapped_role")
    return scoped_lookup(providers, m, "nm1_code", "nm101_entity_id", ["mapped_role"], precedence="precedence")


def map_hi(diagnoses: DataFrame, hi_map: DataFrame) -> DataFrame:
    """Gold diagnoses + ``diag_type`` from the HI qualifier map."""
    return scoped_lookup(diagnoses, hi_map, "diag_qualifier", "hi_qualifier", ["diag_type"])


def map_ref(references: DataFrame, ref_map: DataFrame) -> DataFrame:
    """Claim references + ``ref_type`` from the REF qualifier map."""
    return scoped_lookup(references, ref_map, "ref_qualifier", "ref_qualifier", ["ref_type"])


# ---------------------------------------------------------------- quarantine
def auto_quarantine(dq_results: DataFrame, file_paths: DataFrame, run_id: str | None = None, ts: str | None = None) -> DataFrame:
    """Files with ERROR-severity DQ failures -> quarantine rows (stage DQ, rule = the DQ rule)."""
    now = F.lit(ts).cast("timestamp") if ts else F.current_timestamp()
    err = dq_results.filter((F.col("severity") == "ERROR") & (F.col("failed_count") > 0) & F.col("file_hash").isNotNull())
    return (
        err.join(file_paths.select("file_hash", "file_path").dropDuplicates(["file_hash"]), "file_hash", "left")
        .select(
            "vendor_id", "file_hash", "file_path", F.lit(run_id).cast("string").alias("run_id"),
            F.lit("DQ").alias("stage"), "rule_id",
            F.concat(F.lit("DQ rule "), F.col("rule_id"), F.lit(" failed for "), F.col("failed_count").cast("string"),
                     F.lit(" row(s)")).alias("reason"),
            now.alias("created_ts"),
        )
        .dropDuplicates(["vendor_id", "file_hash", "stage", "rule_id"])
    )


#: Stages of quarantine rows that keep a file out of gold and extracts until it is released.
GATE_STAGES = ["DQ", "VERSION"]


def gated_files(quarantine: DataFrame) -> DataFrame:
    """``file_hash`` of the files that the gate holds back."""
    held = F.col("stage").isin(GATE_STAGES) & F.col("file_hash").isNotNull()
    return quarantine.filter(held).select("file_hash")


def pass_gate(rows: DataFrame, quarantine: DataFrame) -> DataFrame:
    """The rows of files that the gate does not hold back (JN1: left anti join; held files are few, so the rows are not shuffled)."""
    return rows.join(broadcast_if_small(gated_files(quarantine), files=False), "file_hash", "left_anti")


def version_quarantine(claims: DataFrame, registry: DataFrame, run_id: str | None = None, ts: str | None = None) -> DataFrame:
    """Files with a transaction of an unexpected version -> quarantine rows (stage VERSION), one a file."""
    now = F.lit(ts).cast("timestamp") if ts else F.current_timestamp()
    wrong = version_check(claims, registry).filter(F.col("expected_version").isNotNull()).groupBy("vendor_id", "file_hash").agg(
        F.min("file_path").alias("file_path"), F.min("transaction_version").alias("v"), F.max("expected_version").alias("e"))
    reason = F.concat(F.lit("Version "), F.coalesce("v", F.lit("missing")), F.lit(", expected "), F.col("e"))
    return wrong.select(
        "vendor_id", "file_hash", "file_path", F.lit(run_id).cast("string").alias("run_id"), F.lit("VERSION").alias("stage"),
        F.lit("VERSION").alias("rule_id"), reason.alias("reason"), now.alias("created_ts"),
    )


def version_check(claims: DataFrame, registry: DataFrame) -> DataFrame:
    """Transactions whose version differs from the vendor's expected version."""
    t = claims.select("vendor_id", "file_hash", "file_path", "st_control", "transaction_version").dropDuplicates(
        ["file_hash", "st_control", "transaction_version"])
    r = broadcast_if_small(registry.select(F.col("vendor_id").alias("_rv"), "expected_version"))
    j = t.join(r, t.vendor_id == r._rv, "left").drop("_rv")
    return j.filter(~F.coalesce(F.col("transaction_version") == F.col("expected_version"), F.lit(False)))


# ---------------------------------------------------------------- partner extracts
def partner_manifest(extract: DataFrame, key: str = "claim_key", amount: str = "claim_amount") -> DataFrame:
    """Manifest per partner: row count, decimal total, first / last key, and a hash of the rows.

    ``rows_hash`` holds the sums of two 64-bit hashes of the rows: it depends
    neither on order nor on partitioning, and equal rows add up, where an
    exclusive or would cancel pairs of them. Built from mergeable aggregates
    only, so a partner holding most of the rows is pre-aggregated map-side and
    never gathered into one task.
    """
    h = [F.sum(F.xxhash64(F.lit(seed), *extract.columns).cast("decimal(20,0)")).cast("string") for seed in (1, 2)]
    return extract.groupBy("vendor_id").agg(
        F.count(F.lit(1)).alias("row_count"),
        F.coalesce(F.sum(F.coalesce(F.col(amount), F.lit(0)).try_cast("decimal(38,2)")), F.lit(0).cast("decimal(38,2)"))
        .cast("double").alias("total_amount"),
        F.min(key).alias("first_claim_key"),
        F.max(key).alias("last_claim_key"),
        F.concat_ws(":", *h).alias("rows_hash"),
    )


def write_partner_extract(extract: DataFrame, path: str, order_by: list[str] | None = None, files: int = 32) -> None:
    """Write the extract one folder per partner, its rows in order over the folder's files.

    The rows are range-partitioned on partner and ``order_by`` (``claim_key``
    by default) into about ``files`` parts, so a partner with a third of all
    rows has a third of the tasks, and the names of its files follow the order
    of the rows in them. Partners are few rows of configuration; a partner
    without rows has no folder.
    """
    order = order_by or ["claim_key"]
    ranged = extract.repartitionByRange(files, "vendor_id", *order).sortWithinPartitions("vendor_id", *order)
    ranged.write.mode("overwrite").partitionBy("vendor_id").parquet(path)
