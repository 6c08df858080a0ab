"""The medallion pipeline: steps that read tables, run operators and write tables.

Tables are catalog tables (:mod:`claimflow.plans.tables`). A step reads the
loads that its sources have gained since its mark, adds its rows as a load of
its own and counts it in; a step that fails leaves no counted load and is run
again from the same mark. A file that is parsed again has its rows replaced in
every table: silver deletes and inserts them, and records the file as replaced,
which the gold steps and the sums over files follow.

Steps are plain functions (the pipeline_steps table names them); vendors are
rows, so a step runs once for all vendors that have work.
"""

from __future__ import annotations

import time
from dataclasses import dataclass, field

from py4j.protocol import Py4JJavaError
from pyspark.errors import PySparkException
from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from claimflow.operators import audit as A
from claimflow.operators import bronze as B
from claimflow.operators import claims as C
from claimflow.operators import gold as G
from claimflow.operators import merge as M
from claimflow.operators import orchestration as O
from claimflow.operators import quality as Q
from claimflow.plans.tables import ClaimTables
from claimflow.session import materialize
from claimflow.sources import config as cfg

PIPELINE = cfg.PIPELINE_NAME
SILVER = "silver_837_claim"


@dataclass
class RunContext:
    """What a run needs: tables, run id and time, and the vendors it is for (None: all).

    ``params`` (``vendor_id, step_name, params``) are the effective step
    parameters. Marks say up to which load a consumer has read a source: one
    for all vendors, and one for each vendor that is elsewhere.
    """

    spark: SparkSession
    store: ClaimTables
    run_id: str
    ts: str
    vendor_ids: list[str] | None = None
    standardize: bool = False
    params: DataFrame | None = None
    extract_root: str | None = None
    timings: dict[str, float] = field(default_factory=dict)
    observations: dict[str, Observation] = field(default_factory=dict)
    _marks: dict[tuple[str, str], dict[str | None, int]] | None = None
    _dirty: bool = False

    def _mark(self, consumer: str, source: str) -> dict[str | None, int]:
        if self._marks is None:
            self._marks = {}
            for r in self.store.read("consumer_mark").collect():
                self._marks.setdefault((r["consumer"], r["source"]), {})[r["vendor_id"]] = r["batch_done"]
        return self._marks.setdefault((consumer, source), {None: 0})

    def _pending(self, consumer: str, source: str) -> tuple[int, Column]:
        """The lowest mark of the run's vendors, and the rows after their marks."""
        marks = self._mark(consumer, source)
        vendor, batch = F.col("vendor_id"), F.col("batch")
        rest, own = marks.get(None, 0), {v: m for v, m in marks.items() if v is not None}
        if self.vendor_ids is not None:
            by_mark: dict[int, list[str]] = {}
            for v in self.vendor_ids:
                by_mark.setdefault(own.get(v, rest), []).append(v)
            cond = F.lit(False)
            for m, vs in by_mark.items():
                cond = cond | (vendor.isin(vs) & (batch > m))
            return min(by_mark, default=rest), cond
        others = ~F.coalesce(vendor.isin(list(own)), F.lit(False)) if own else F.lit(True)
        cond = others & (batch > rest)
        for v, m in own.items():
            cond = cond | ((vendor == v) & (batch > m))
        return min([rest, *own.values()]), cond

    def delta(self, consumer: str, source: str) -> DataFrame | None:
        """The run's vendors' rows of the loads after the consumer's mark; None when there is no such load (no job)."""
        low, cond = self._pending(consumer, source)
        loads = self.store.newer(source, low)
        if self.vendor_ids is not None:
            loads = [x for x in loads if x[1] is None or set(x[1]) & set(self.vendor_ids)]
        if not loads:
            return None
        # the partition filters come first: loads before the lowest mark are never listed
        return self.store.table(source).where((F.col("batch") > low) & (F.col("batch") <= self.store.committed)).where(cond)

    def advance(self, consumer: str, source: str, upto: int) -> None:
        """The run's vendors have read ``source`` up to ``upto``; so has whoever has no rows in the loads up to there."""
        marks = self._mark(consumer, source)
        self._dirty = True
        if self.vendor_ids is None:
            marks.clear()
            marks[None] = upto
            return
        marks.setdefault(None, 0)
        marks.update({v: upto for v in self.vendor_ids})
        for v, m in list(marks.items()):
            between = [vs for n, vs in self.store.newer(source, m) if n <= upto]
            mine = (lambda vs: v in vs) if v is not None else (lambda vs: bool(set(vs) - set(marks)))
            if not any(vs is None or mine(vs) for vs in between):
                marks[v] = max(m, upto)
        rest = marks[None]
        for v in [v for v, m in marks.items() if v is not None and m == rest]:
            del marks[v]

    def flush(self) -> None:
        """Write the marks; a crash before only means that loads are read again."""
        if self._dirty:
            rows = [(c, s, v, n) for (c, s), marks in self._marks.items() for v, n in marks.items()]
            schema = "consumer string, source string, vendor_id string, batch_done bigint"
            self.store.write("consumer_mark", self.spark.createDataFrame(rows, schema).coalesce(1))
            self._dirty = False

    def step_params(self, step: str) -> DataFrame | None:
        """``vendor_id, params`` of a step."""
        return None if self.params is None else self.params.filter(F.col("step_name") == step).select("vendor_id", "params")

    def observe(self, name: str, df: DataFrame, rows: Column | None = None) -> DataFrame:
        """Count ``df``'s rows as a side effect of whatever job consumes it (no extra pass)."""
        obs = Observation(name)
        self.observations[name] = obs
        return df.observe(obs, (F.count(F.lit(1)) if rows is None else F.count_if(rows)).alias("rows"))

    def metrics(self) -> dict[str, int]:
        return {k: v.get.get("rows", 0) for k, v in self.observations.items()}

    def vendor_filter(self, df: DataFrame) -> DataFrame:
        return df if self.vendor_ids is None else df.filter(F.col("vendor_id").isin(self.vendor_ids))


def _timed(ctx: RunContext, name: str, fn):
    t0 = time.time()
    out = fn()
    ctx.timings[name] = round(time.time() - t0, 3)
    return out


# ---------------------------------------------------------------- steps
def bronze_step(ctx: RunContext, landing: DataFrame) -> None:
    """Landing rows -> bronze_837_raw (insert-only on file_hash) + bronze_837_quarantine (insert-only on hash and path).

    The rows are read three times (copies, contents, rejects) rather than kept with their texts in memory and on local disk.
    A run for some vendors loads their files only (rejects without a vendor folder included).
    """
    st = ctx.store
    ing = B.ingest(landing, ctx.run_id, ctx.ts)
    if ctx.vendor_ids is not None:
        ing = ing.filter(F.col("vendor_id").isNull() | F.col("vendor_id").isin(ctx.vendor_ids))
    good, bad = B.split_rejects(ing)
    tables = ["bronze_837_raw", "bronze_837_quarantine"]
    n = st.begin(tables)
    # one row per hash by construction, and no null hash: no second pass over the text
    new = ctx.observe("bronze_candidates", B.dedupe_by_hash(good)).withColumn("bucket", st.bucket())
    if st.newer("bronze_837_raw", 0):  # a first load has nothing to be compared with, and no content is shuffled for it
        known = st.table("bronze_837_raw").select("bucket", "file_hash")
        new = new.join(known, ["bucket", "file_hash"], "left_anti")
    rows = [st.append("bronze_837_raw", new, n)]
    bad = ctx.observe("bronze_rejected", bad)
    seen = st.table("bronze_837_quarantine").select(F.col("file_hash").alias("_h"), F.col("file_path").alias("_p"))
    same = bad["file_hash"].eqNullSafe(seen["_h"]) & (bad["file_path"] == seen["_p"])
    rows.append(st.append("bronze_837_quarantine", bad.join(seen, same, "left_anti"), n))
    _commit(ctx, n, tables, rows)


def _commit(ctx: RunContext, number: int, tables: list[str], rows: list[int]) -> None:
    """Count in the tables that the load has written to."""
    written = [t for t, n in zip(tables, rows) if n]
    if written:
        ctx.store.commit(number, written, ctx.run_id, ctx.vendor_ids)


SILVER_TABLES = ["file_loads", SILVER, "silver_837_parse_error", "replaced_files", "quarantine_files"]


def silver_step(ctx: RunContext, reprocess: DataFrame | None = None) -> None:
    """Unparsed bronze files -> silver claims, parse errors and SILVER quarantine.

    Only bronze loads newer than the silver mark are read, so a run touches the
    content of new files only; the anti join with the files parsed before stays
    as the idempotency guard. ``reprocess`` (``file_hash``) parses those files
    again instead: whatever their earlier parse left in silver is deleted, and
    the file is recorded as replaced for the tables built from silver.
    """
    st = ctx.store
    upto = st.committed
    if reprocess is None:
        bronze = ctx.delta("silver", "bronze_837_raw")
        if bronze is None:
            return  # no bronze load since the last silver run
        done = st.table("file_loads").select("file_hash")
        files = B.unprocessed(bronze.select("vendor_id", "file_hash"), done, done.limit(0))
        files = files.withColumn("replaced", F.lit(False))
    else:
        bronze = st.of_files("bronze_837_raw", reprocess)
        earlier = st.of_files("file_loads", reprocess).select("file_hash").distinct().withColumn("_e", F.lit(True))
        files = bronze.select("vendor_id", "file_hash").join(earlier, "file_hash", "left")
        files = files.withColumn("replaced", F.coalesce("_e", F.lit(False)))
    n = st.begin(SILVER_TABLES)
    n_files = st.append("file_loads", files.withColumn("run_id", F.lit(ctx.run_id)), n)
    if n_files == 0:
        if reprocess is None:
            ctx.advance("silver", "bronze_837_raw", upto)
        return
    loads = st.batch("file_loads", n)
    again = loads.filter("replaced")
    n_replaced = 0
    if reprocess is not None:
        for t in (SILVER, "silver_837_parse_error"):
            st.delete_files(t, again)
        st.delete_files("quarantine_files", again.withColumn("stage", F.lit("SILVER")), ("file_hash", "stage"))
        n_replaced = st.append("replaced_files", again.withColumn("table_name", F.lit(SILVER)), n)
    todo = bronze
    if n_files < bronze.select("file_hash").count():  # else every file is to be parsed, and no content is shuffled to find that out
        todo = bronze.join(loads.select("file_hash"), "file_hash", "left_semi")
    res = C.parse(todo, st.read("vendor_837_profile"), params=ctx.step_params("SILVER"), role_map=st.read("nm1_role_map"))
    ranked = res["ranked"]
    if ctx.standardize:
        std = C.to_silver(ranked, ctx.ts, ["references_json", "claim_ordinal"])
        silver = C.rank_silver(Q.apply_standardization(std, st.read("silver_standardization_rules"), SILVER))  # a rule may make ids equal
    else:
        silver = C.to_silver(ranked, ctx.ts, ["references_json", "claim_ordinal", "claims_with_id", "newer_claims"])
    # one write: claims that a later claim of the same id in the transaction replaces go to partitions of their own
    latest = F.col("newer_claims") == 0
    n_claims = st.append(SILVER, ctx.observe("silver_claims_parsed", silver, latest), n, superseded=~latest)
    errs = ctx.observe("silver_parse_errors", C.errors_table(res["errors"], ctx.ts))
    n_errors = st.append("silver_837_parse_error", errs, n)
    # from the rows just written: the parse's plan ends there
    held = C.quarantine_rows(st.batch("silver_837_parse_error", n), ctx.run_id, ctx.ts)
    n_held = 0 if n_errors == 0 or held.isEmpty() else 1
    if n_held:
        _quarantine(ctx, held, n)
    _commit(ctx, n, SILVER_TABLES, [1, n_claims, n_errors, n_replaced, n_held])
    if reprocess is None:
        ctx.advance("silver", "bronze_837_raw", upto)


def _quarantine(ctx: RunContext, rows: DataFrame, number: int) -> None:
    """Upsert quarantine rows on (vendor, file, stage, rule), into the partitions that hold their files.

    ``rows`` is read more than once; the caller keeps it cheap.
    """
    keys = ["vendor_id", "file_hash", "stage", "rule_id"]
    update = ["file_path", "run_id", "reason", "created_ts"]
    ctx.store.update_files("quarantine_files", rows, lambda old: M.merge_frames(old, rows, keys, update=update), number)


def standardize_step(ctx: RunContext) -> None:
    """SILVER_STD: nothing is left to do here.

    When the step is enabled, the silver step applies the standardization
    rules to new claims before they are stored, so a rule meets every claim
    exactly once and stored rows are never rewritten.
    """


def _gold_step(ctx: RunContext, table: str) -> None:
    """Normalize the silver rows added since this table's mark; files parsed again lose their earlier rows first.

    A file's rows come whole from one silver load, so no key of the table needs
    to be looked up: what is new is added, what is replaced is deleted by file.
    Files that the quarantine gate holds are left out.
    """
    st = ctx.store
    upto = st.committed
    again, silver = ctx.delta(table, "replaced_files"), ctx.delta(table, SILVER)
    if again is None and silver is None:
        return
    n = st.begin([table, "replaced_files"])
    rows = [0, 0]
    if again is not None:
        again = again.filter(F.col("table_name") == SILVER).select("vendor_id", "file_hash").distinct()
        if st.delete_files(table, again):
            rows[1] = st.append("replaced_files", again.withColumn("table_name", F.lit(table)), n)
    if silver is not None:
        passed = Q.pass_gate(silver, st.read("quarantine_files"))
        if table == "claim_reference":
            new = G.claim_reference(passed, st.read("ref_qualifier_map"))
        else:
            # the keys hold each row's position in its claim, so every child row has a key of its own
            new = G.NORMALIZERS[table](passed, ctx.run_id, ctx.ts)
        rows[0] = st.append(table, new, n)
    _commit(ctx, n, [table, "replaced_files"], rows)
    for source in ("replaced_files", SILVER):
        ctx.advance(table, source, upto)


def gold_header_step(ctx: RunContext) -> None:
    _gold_step(ctx, "claim_header")
    _gold_step(ctx, "claim_reference")


def gold_lines_step(ctx: RunContext) -> None:
    _gold_step(ctx, "claim_service_line")


def gold_dx_step(ctx: RunContext) -> None:
    _gold_step(ctx, "claim_diagnosis")


def gold_provider_step(ctx: RunContext) -> None:
    _gold_step(ctx, "claim_provider")


def gold_sub_pat_step(ctx: RunContext) -> None:
    _gold_step(ctx, "claim_subscriber")
    _gold_step(ctx, "claim_patient")


def gold_other_payer_step(ctx: RunContext) -> None:
    _gold_step(ctx, "claim_other_payer")


COUNTED = [SILVER, *G.NORMALIZERS]
OPS_SOURCES = ["bronze_837_raw", "replaced_files", "quarantine_files", *COUNTED]


def ops_step(ctx: RunContext) -> None:
    """Run row, file audit, silver/gold reconciliation, per-ST recon, DQ results, run status.

    Incremental: the rows added since the last ops run are reduced to partial
    sums per table, file and transaction, which are stored beside the earlier
    ones; those of replaced rows are deleted. Files that gained or lost rows
    are reconciled from their partial sums, so no silver or gold row is read
    twice. DQ rules run over the added rows. When no source has a newer load,
    only the run row is recorded.
    """
    st = ctx.store
    runs = A.start_run(st.read("pipeline_run"), A.run_row(ctx.spark, PIPELINE, ctx.run_id, "claimflow", None))
    fresh = {t: ctx.delta("ops", t) for t in OPS_SOURCES}
    if all(df is None for df in fresh.values()):
        nothing = A.run_status(st.read("file_audit").limit(0), end_ts=ctx.ts)
        st.write("pipeline_run", A.finish_run(runs, PIPELINE, ctx.run_id, nothing.drop("failed_files")))
        return
    upto = st.committed
    tables = ["file_partial", "file_audit", "recon_summary", "dq_results"]
    n = st.begin(tables)
    replaced = None
    if fresh["replaced_files"] is not None:
        replaced = fresh["replaced_files"].select(F.col("table_name").alias("source"), "file_hash").distinct()
        st.delete_files("file_partial", replaced, ("file_hash", "source"))
    added = {t: fresh[t] for t in COUNTED if fresh[t] is not None}
    rows = dict.fromkeys(tables, 0)
    if added:
        rows["file_partial"] = st.append("file_partial", A.partial_sums(added), n)
    touched = st.batch("file_partial", n).select("file_hash")
    if replaced is not None:
        touched = touched.union(replaced.select("file_hash"))
    touched = touched.distinct()
    sums = st.of_files("file_partial", touched)

    recon = A.reconcile_files(sums, ctx.ts, _tolerance(ctx))
    base = fresh["bronze_837_raw"]
    held = fresh["quarantine_files"]
    if replaced is not None:  # whether a replaced file is held is read anew
        kept = st.of_files("quarantine_files", replaced)
        held = kept if held is None else held.unionByName(kept)
    held = None if held is None else held.select("file_hash").filter("file_hash IS NOT NULL").distinct()
    changed = touched
    for df in (base, held):
        changed = changed if df is None else changed.union(df.select("file_hash"))

    def audit(old: DataFrame) -> DataFrame:
        return A.merge_file_audit(old, None if base is None else A.file_audit_base(base, ctx.ts), recon, held, replaced)

    rows["file_audit"] = 1
    st.update_files("file_audit", changed.distinct(), audit, n)
    st.delete_files("recon_summary", touched)
    rows["recon_summary"] = st.append("recon_summary", A.reconcile_transactions(sums, ctx.ts), n)

    names = {"SILVER_CLAIM": SILVER, "GOLD_HEADER": "claim_header", "GOLD_SERVICE_LINE": "claim_service_line",
             "GOLD_DIAGNOSIS": "claim_diagnosis", "GOLD_PROVIDER": "claim_provider"}
    entities = {e: added[t].select(*st.read(t).columns) for e, t in names.items() if t in added}

    def store_dq(probe: bool) -> int:
        dq = Q.run_dq_rules(entities, st.read("dq_rules_837"), PIPELINE, ctx.run_id, ctx.ts, probe=probe,
                             least_row_chars=Q.HASH_CHARS)
        return st.append("dq_results", dq, n)  # one row per (run, rule, vendor, file) by construction

    try:
        rows["dq_results"] = store_dq(False)
    except (PySparkException, Py4JJavaError) as e:
        if not Q.is_data_error(e):
            raise
        st.begin(["dq_results"])
        rows["dq_results"] = store_dq(True)  # find out which rule fails on the data, record it, run the others
    status = A.run_status(st.of_files("file_audit", touched), end_ts=ctx.ts)
    st.write("pipeline_run", A.finish_run(runs, PIPELINE, ctx.run_id, status.drop("failed_files")))
    _commit(ctx, n, tables, list(rows.values()))
    for t in OPS_SOURCES:
        ctx.advance("ops", t, upto)


def _tolerance(ctx: RunContext) -> DataFrame | None:
    """Vendors whose OPS_AUDIT parameters set ``amount_tolerance``."""
    params = ctx.step_params("OPS_AUDIT")
    if params is None:
        return None
    value = F.try_element_at("params", F.lit("amount_tolerance")).try_cast("double")
    return params.select("vendor_id", value.alias("amount_tolerance")).filter("amount_tolerance IS NOT NULL")


# ---------------------------------------------------------------- quarantine gate and extracts
def gate_step(ctx: RunContext) -> None:
    """Quarantine the files that the last DQ run or the version check found, and take their rows out of gold.

    The gate holds their later rows back too, until :func:`release_files`.
    """
    st = ctx.store
    upto = st.committed
    dq, silver = ctx.delta("gate", "dq_results"), ctx.delta("gate", SILVER)
    found = []
    if dq is not None:
        paths = st.of_files("bronze_837_raw", dq.filter("file_hash IS NOT NULL")).select("file_hash", "file_path")
        found.append(Q.auto_quarantine(dq, paths, ctx.run_id, ctx.ts))
    if silver is not None:
        found.append(Q.version_quarantine(silver, st.read("vendor_registry"), ctx.run_id, ctx.ts))
    if not found:
        return
    held = found[0] if len(found) == 1 else found[0].unionByName(found[1])
    n = st.begin(["quarantine_files", "replaced_files", "file_audit"])
    held = held.persist()
    n_replaced = 0
    n_held = held.count()
    if n_held:
        _quarantine(ctx, held, n)
        files = held.select("vendor_id", "file_hash").distinct()
        gone = None
        for t in [*G.NORMALIZERS, "claim_reference"]:
            if st.delete_files(t, files):
                rows = files.withColumn("table_name", F.lit(t))
                gone = rows if gone is None else gone.unionByName(rows)
        if gone is not None:
            n_replaced = st.append("replaced_files", gone, n)
        st.update_files("file_audit", files, lambda old: A.merge_file_audit(old, quarantined=files), n)
    held.unpersist()
    _commit(ctx, n, ["quarantine_files", "replaced_files"], [n_held, n_replaced])
    for source in ("dq_results", SILVER):
        ctx.advance("gate", source, upto)


def release_files(ctx: RunContext, files: DataFrame) -> None:
    """Release held files (``file_hash``): their gate rows go, and the files are parsed again into silver.

    The next gold steps build their rows, as for any file that was parsed again.
    """
    stages = F.explode(F.array(*[F.lit(s) for s in Q.GATE_STAGES]))
    ctx.store.delete_files("quarantine_files", files.select("file_hash").withColumn("stage", stages), ("file_hash", "stage"))
    silver_step(ctx, reprocess=files)


def extract_step(ctx: RunContext) -> None:
    """Partner extracts of the gold headers that pass the gate, ordered by claim key, and their manifest.

    Written under ``ctx.extract_root`` (default: beside the tables), a folder a run.
    """
    st = ctx.store
    root = f"{(ctx.extract_root or st.root + '/partner_extracts').rstrip('/')}/{ctx.run_id}"
    rows = ctx.vendor_filter(Q.pass_gate(st.read("claim_header"), st.read("quarantine_files")))
    Q.write_partner_extract(rows, f"{root}/claims")
    written = ctx.spark.read.schema(rows.schema).parquet(f"{root}/claims")
    Q.partner_manifest(written).write.mode("overwrite").parquet(f"{root}/manifest")


STEP_FUNCTIONS = {
    "BRONZE": bronze_step, "SILVER": silver_step, "SILVER_STD": standardize_step,
    "GOLD_HEADER": gold_header_step, "GOLD_LINES": gold_lines_step, "GOLD_DX": gold_dx_step,
    "GOLD_PROVIDER": gold_provider_step, "GOLD_SUB_PAT": gold_sub_pat_step,
    "GOLD_OTHER_PAYER": gold_other_payer_step, "OPS_AUDIT": ops_step,
    "QUARANTINE_GATE": gate_step, "PARTNER_EXTRACT": extract_step,
}


def seed_config(spark: SparkSession, store: ClaimTables, landing_root: str = cfg.LANDING_ROOT) -> None:
    """Seed the config tables; seeding again keeps every row that users have added.

    Vendors, profiles, steps and DQ rules are merged on their keys; the
    global (NULL vendor) rows of the code maps and standardization rules are
    replaced; step overrides are only created.
    """

    def merge(name: str, seed: DataFrame, keys: list[str]) -> None:
        upd = [c for c in seed.columns if c not in (*keys, "created_ts")]
        store.write(name, M.merge_frames(store.read(name), seed, keys, update=upd))

    def defaults(name: str, seed: DataFrame) -> None:
        store.write(name, M.replace_rows(store.read(name), seed, F.col("vendor_id").isNull()))

    merge("vendor_registry", cfg.vendor_registry(spark, landing_root), ["vendor_id"])
    merge("vendor_837_profile", cfg.vendor_profiles(spark), ["vendor_id"])
    merge("pipeline_steps", cfg.pipeline_steps(spark), ["pipeline_name", "step_name"])
    store.declare("vendor_step_overrides")
    defaults("nm1_role_map", cfg.nm1_role_map(spark))
    defaults("hi_qualifier_map", cfg.hi_qualifier_map(spark))
    defaults("ref_qualifier_map", cfg.ref_qualifier_map(spark))
    defaults("silver_standardization_rules", cfg.standardization_rules(spark))
    merge("dq_rules_837", cfg.dq_rules(spark), ["rule_id", "vendor_id"])


def run_pipeline(ctx: RunContext, landing: DataFrame, steps: list[str] | None = None) -> dict[str, float]:
    """Run the enabled steps in order (from ``pipeline_steps``); returns step timings in seconds."""
    step_rows = (
        ctx.store.read("pipeline_steps")
        .filter((F.col("pipeline_name") == PIPELINE) & F.col("enabled_flag"))
        .select("step_order", "step_name").orderBy("step_order").collect()
    )
    names = [r["step_name"] for r in step_rows if steps is None or r["step_name"] in steps]
    ctx.standardize = "SILVER_STD" in names
    for name in names:
        fn = STEP_FUNCTIONS[name]
        _timed(ctx, name, (lambda: fn(ctx, landing)) if name == "BRONZE" else (lambda: fn(ctx)))
    ctx.flush()
    return ctx.timings


def orchestrate(ctx: RunContext, listing: DataFrame, landing: DataFrame) -> DataFrame:
    """Discover new files per vendor, run the steps for vendors with work, record vendor state.

    ``listing`` has ``path, length``; ``landing`` the file rows (``binaryFile`` schema).
    Returns the effective step plan that was executed.
    """
    st = ctx.store
    registry = st.read("vendor_registry")
    found = O.discover_files(listing, registry, st.read("file_audit"), st.read("quarantine_files")).persist()
    over = O.oversize_quarantine(found, ctx.run_id, ctx.ts)
    n = st.begin(["quarantine_files"])
    known = st.read("quarantine_files").filter("rule_id = 'OVERSIZE'").select("vendor_id", "file_path")
    _commit(ctx, n, ["quarantine_files"], [st.append("quarantine_files", over.join(known, ["vendor_id", "file_path"], "left_anti"), n)])
    todo = found.filter(F.col("action") == "PROCESS").select("vendor_id", "file_path")
    vendors = O.active_vendors(registry).join(todo.select("vendor_id").distinct(), "vendor_id", "left_semi")
    plan = O.effective_steps(vendors, st.read("pipeline_steps"), st.read("vendor_step_overrides"), PIPELINE, ctx.run_id,
                             "orchestrator", todo).persist()
    ctx.params = plan.select("vendor_id", "step_name", "params")  # a row a vendor and step
    # A step runs once for every vendor that has it enabled (vendors are rows, not loop iterations).
    enabled = plan.filter("enabled").groupBy("step_order", "step_name").agg(
        F.sort_array(F.collect_set("vendor_id")).alias("vendors")).orderBy("step_order").collect()
    paths = todo.select(F.col("file_path").alias("path"))
    landing_todo = landing
    if not landing.select("path").join(paths, "path", "left_anti").isEmpty():  # found by paths alone; contents are joined once
        landing_todo = materialize(landing.join(paths, "path", "left_semi"))
    std = {v for r in enabled if r["step_name"] == "SILVER_STD" for v in r["vendors"]}
    failed: dict[str, str] = {}

    def run_step(name: str, vendor_ids: list[str]) -> None:
        ctx.vendor_ids = vendor_ids
        if name == "BRONZE":
            bronze_step(ctx, landing_todo)
        else:
            STEP_FUNCTIONS[name](ctx)

    def attempt(name: str, vendor_ids: list[str]) -> None:
        """Run a step for these vendors; when it fails, again for each alone, to part the failing ones."""
        try:
            run_step(name, vendor_ids)
        except Exception as e:
            if len(vendor_ids) == 1:
                failed[vendor_ids[0]] = f"{name}: {e}"[:500]
            else:
                for v in vendor_ids:
                    attempt(name, [v])

    for r in enabled:
        going = [v for v in r["vendors"] if v not in failed]  # a vendor stops after its failing step
        if r["step_name"] == "SILVER":  # vendors with and without standardization take turns
            groups = [(True, [v for v in going if v in std]), (False, [v for v in going if v not in std])]
        else:
            groups = [(False, going)]
        for ctx.standardize, vendor_ids in groups:
            if vendor_ids:
                _timed(ctx, r["step_name"], lambda: attempt(r["step_name"], vendor_ids))
    ctx.vendor_ids = None
    ctx.flush()
    ran = sorted({v for r in enabled for v in r["vendors"]})
    rows = [(v, v not in failed, failed.get(v)) for v in ran]
    res = ctx.spark.createDataFrame(rows, "vendor_id string, ok boolean, notes string")
    state = st.read("vendor_state")
    new_state = O.update_vendor_state(state, O.vendor_outcomes(res, ctx.run_id, ctx.ts))
    st.write("vendor_state", new_state.select(*state.columns))
    found.unpersist()
    return plan
