"""The pipeline's tables: declared Spark catalog tables with partitions.

``ClaimTables`` declares each table once (``CREATE TABLE IF NOT EXISTS`` with
an explicit schema) in a database of its own, and reads and writes them through
the catalog. Partitions do the work that a rewrite of whole tables would:

* tables that grow are partitioned by ``batch`` (the number of the load that
  added the rows) and ``bucket`` (a hash of ``file_hash``). A consumer reads
  the batches after its mark, a lookup of some files reads their buckets;
* a table's old rows change by dynamic partition overwrite (a table option),
  so that only the partitions that hold them are written again;
* small tables (configuration, runs) are one partition, replaced whole.

A batch counts once it is in ``load_batch``. What a failed load has left behind
has a higher number; the next load drops those partitions before it uses the
number again, so a load that is run again adds its rows once. One pipeline run
writes at a time.
"""

from __future__ import annotations

import hashlib
import uuid
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from claimflow.operators import audit as A
from claimflow.operators import claims as C
from claimflow.operators import quality as Q
from claimflow.sources import config as cfg

#: Buckets of file hashes. With shuffle partitions in a multiple of it a task writes one bucket's file.
BUCKETS = 16

LOADED = ("batch", "bucket")
SMALL = ("bucket",)
_PARTITION_TYPES = {"batch": "bigint", "bucket": "int", "superseded": "boolean"}

BRONZE_SCHEMA = (
    "vendor_id string, run_id string, file_path string, modification_time timestamp, file_size_bytes bigint, "
    "file_hash string, content_str string, is_x12_like boolean, ingest_ts timestamp"
)
REJECT_SCHEMA = (
    "vendor_id string, run_id string, file_path string, modification_time timestamp, file_size_bytes bigint, "
    "file_hash string, content_str string, reject_reason string, ingest_ts timestamp"
)
SILVER_SCHEMA = ", ".join(
    f"{c} {'timestamp' if c == 'parse_ts' else 'double' if c == 'claim_amount' else 'string'}" for c in C.SILVER_COLUMNS
)
ERROR_SCHEMA = ", ".join(f"{c} {'timestamp' if c == 'parse_ts' else 'string'}" for c in C.ERROR_COLUMNS)
QUARANTINE_SCHEMA = (
    "vendor_id string, file_hash string, file_path string, run_id string, stage string, rule_id string, "
    "reason string, created_ts timestamp"
)
_GOLD_BASE = (
    "vendor_id string, file_hash string, file_path string, run_id string, parse_ts timestamp, load_ts timestamp, "
    "isa_control string, gs_control string, st_control string, transaction_version string, claim_id string, "
)
_PARTY = (
    "claim_key string, member_id string, first_name string, last_name string, dob date, gender string, addr1 string, "
    "city string, state string, zip string, "
)
GOLD_SCHEMAS = {
    "claim_header": _GOLD_BASE
    + "claim_amount double, place_of_service string, subscriber_member_id string, patient_member_id string, "
    "billing_npi string, rendering_npi string, claim_from_date date, claim_to_date date, claim_key string",
    "claim_service_line": _GOLD_BASE
    + "claim_key string, line_seq int, lx string, rev_code string, procedure_qualifier string, procedure_code string, "
    "modifiers_str string, modifier1 string, modifier2 string, modifier3 string, modifier4 string, "
    "charge_amount double, units double, service_line_key string",
    "claim_diagnosis": _GOLD_BASE
    + "claim_key string, diag_seq int, diag_qualifier string, diag_code string, diag_raw string, diagnosis_key string",
    "claim_provider": _GOLD_BASE
    + "claim_key string, provider_seq int, provider_role string, nm1_code string, entity_type string, "
    "last_name_or_org string, first_name string, id_qualifier string, id_value string, npi string, addr1 string, "
    "city string, state string, zip string, provider_key string",
    "claim_subscriber": _GOLD_BASE + _PARTY + "subscriber_key string",
    "claim_patient": _GOLD_BASE + _PARTY + "patient_key string",
    "claim_other_payer": _GOLD_BASE
    + "claim_key string, payer_seq int, payer_name string, payer_id string, other_payer_key string",
}
REFERENCE_SCHEMA = (
    "vendor_id string, file_hash string, file_path string, st_control string, claim_id string, ref_seq int, "
    "ref_qualifier string, ref_value string, ref_type string"
)


@dataclass(frozen=True)
class Declared:
    """A table's columns (DDL) and partition columns."""

    columns: str
    by: tuple[str, ...] = LOADED


TABLES = {
    "load_batch": Declared("table_name string, vendors array<string>, run_id string", ("batch",)),
    "bronze_837_raw": Declared(BRONZE_SCHEMA),
    "bronze_837_quarantine": Declared(REJECT_SCHEMA),
    # every file that the silver step has parsed, and whether it had been parsed before
    "file_loads": Declared("vendor_id string, file_hash string, run_id string, replaced boolean"),
    # claims that a later claim of the same id replaces are kept in the partitions superseded=true
    "silver_837_claim": Declared(
        f"{SILVER_SCHEMA}, references_json string, claim_ordinal int, claims_with_id bigint", (*LOADED, "superseded")
    ),
    "silver_837_parse_error": Declared(ERROR_SCHEMA),
    "claim_reference": Declared(REFERENCE_SCHEMA),
    **{t: Declared(s) for t, s in GOLD_SCHEMAS.items()},
    # files whose rows were deleted from a table, so that sums over it can follow
    "replaced_files": Declared("table_name string, vendor_id string, file_hash string"),
    "file_partial": Declared(A.PARTIAL_SCHEMA),
    "file_audit": Declared(", ".join(f"{c} {t}" for c, t in A.FILE_AUDIT_TYPES.items())),
    "recon_summary": Declared(A.RECON_SCHEMA),
    "quarantine_files": Declared(QUARANTINE_SCHEMA),
    "dq_results": Declared(Q.DQ_SCHEMA),
    "pipeline_run": Declared(A.RUN_SCHEMA, SMALL),
    "consumer_mark": Declared("consumer string, source string, vendor_id string, batch_done bigint", SMALL),
    "vendor_state": Declared(cfg.VENDOR_STATE_SCHEMA, SMALL),
    "vendor_registry": Declared(cfg.VENDOR_REGISTRY_SCHEMA, SMALL),
    "vendor_837_profile": Declared(cfg.PROFILE_SCHEMA, SMALL),
    "pipeline_steps": Declared(cfg.STEPS_SCHEMA, SMALL),
    "vendor_step_overrides": Declared(cfg.OVERRIDES_SCHEMA, SMALL),
    "nm1_role_map": Declared(cfg.NM1_ROLE_SCHEMA, SMALL),
    "hi_qualifier_map": Declared(cfg.HI_MAP_SCHEMA, SMALL),
    "ref_qualifier_map": Declared(cfg.REF_MAP_SCHEMA, SMALL),
    "silver_standardization_rules": Declared(cfg.STD_RULES_SCHEMA, SMALL),
    "dq_rules_837": Declared(cfg.DQ_RULES_SCHEMA, SMALL),
}
#: Names that read a part of another table: (table, partition value, columns).
PARTS = {
    "silver_837_claim": ("silver_837_claim", False, C.SILVER_COLUMNS),
    "silver_837_claim_superseded": ("silver_837_claim", True, [*C.SILVER_COLUMNS, "claim_ordinal", "claims_with_id"]),
}


class ClaimTables:
    """The declared tables under ``root`` (shared storage on a cluster), in a catalog database named after it."""

    def __init__(self, spark: SparkSession, root: str, buckets: int = BUCKETS, database: str | None = None):
        self.spark = spark
        self.root = root.rstrip("/")
        self.buckets = buckets
        self.database = database or "claims_" + hashlib.sha256(self.root.encode()).hexdigest()[:16]
        spark.sql(f"CREATE DATABASE IF NOT EXISTS {self.database} LOCATION '{self.root}'")
        self._declared: set[str] = set()
        self._recover = True
        loads = self._rows("load_batch").orderBy("batch").collect()
        self._batches = [(r["batch"], r["table_name"], r["vendors"], r["run_id"]) for r in loads]
        # a catalog that has forgotten the tables (a new session without a metastore) finds their partitions again
        self._recover = bool(self._batches)
        if not self._batches:
            self.commit(0, ["load_batch"], None)

    # ------------------------------------------------------------ declaring
    def declare(self, name: str) -> str:
        """The table's catalog name; the table is created on first use."""
        full = f"{self.database}.{name}"
        if name in self._declared:
            return full
        if not self.spark.catalog.tableExists(full):
            t = TABLES[name]
            parts = ", ".join(f"{c} {_PARTITION_TYPES[c]}" for c in t.by)
            self.spark.sql(
                f"CREATE TABLE IF NOT EXISTS {full} ({t.columns}, {parts}) USING parquet "
                f"OPTIONS ('partitionOverwriteMode' = 'dynamic', 'compression' = 'zstd') PARTITIONED BY ({', '.join(t.by)}) "
                f"LOCATION '{self.root}/{name}'"
            )
            if self._recover:
                self.spark.table(full).limit(0).write.insertInto(full)  # the folder has to be there
                self.spark.sql(f"ALTER TABLE {full} RECOVER PARTITIONS")
        self._declared.add(name)
        return full

    def _parts_of(self, name: str, number: int) -> list[dict[str, str]]:
        """The partitions of a load, from the catalog alone."""
        found = self.spark.sql(f"SHOW PARTITIONS {self.declare(name)} PARTITION (batch = {number})").collect()
        return [dict(x.split("=", 1) for x in r["partition"].split("/")) for r in found]

    def _drop(self, name: str, part: dict[str, str]) -> None:
        """Drop a partition with its files (an overwrite without rows; a dropped partition alone would leave them)."""
        full = self.declare(name)
        spec = ", ".join(f"{c} = {v}" for c, v in part.items())
        nothing = ", ".join(f"NULL AS {c}" for c in self._rows(name).columns if c not in part)
        self.spark.sql(f"INSERT OVERWRITE {full} PARTITION ({spec}) SELECT {nothing} FROM VALUES (0) WHERE false")
        self.spark.sql(f"ALTER TABLE {full} DROP IF EXISTS PARTITION ({spec})")

    def declare_all(self) -> None:
        for name in TABLES:
            self.declare(name)

    # ------------------------------------------------------------ reading
    def _rows(self, name: str) -> DataFrame:
        return self.spark.table(self.declare(name))

    def table(self, name: str) -> DataFrame:
        """A table (or named part) with its partition columns."""
        if name in PARTS:
            base, part, _ = PARTS[name]
            return self._rows(base).where(F.col("superseded") == part)
        return self._rows(name)

    def read(self, name: str) -> DataFrame:
        """A table's declared columns."""
        t = self.table(name)
        return t.select(*(PARTS[name][2] if name in PARTS else [c for c in t.columns if c not in TABLES[name].by]))

    def batch(self, name: str, number: int) -> DataFrame:
        """The rows of one load."""
        return self.table(name).where(F.col("batch") == number)

    def newer(self, name: str, since: int) -> list[tuple[int, list[str] | None]]:
        """(number, vendors or None for any) of the loads of a table after ``since``; known without a job."""
        base = PARTS[name][0] if name in PARTS else name
        return [(n, vendors) for n, t, vendors, _ in self._batches if t == base and n > since]

    @property
    def committed(self) -> int:
        return max((n for n, *_ in self._batches), default=0)

    def has_run(self, run_id: str) -> bool:
        """Whether a load of that run has been counted in."""
        return any(run == run_id for *_, run in self._batches)

    def last_load_not_of(self, name: str, run_prefix: str) -> int:
        """The number of the table's last load by other runs than those named ``<prefix>-...`` (0: none)."""
        own = f"{run_prefix}-"
        return max((n for n, t, _, run in self._batches if t == name and not (run or "").startswith(own)), default=0)

    def bucket(self, file_hash: str = "file_hash") -> Column:
        return F.pmod(F.hash(file_hash), F.lit(self.buckets))

    def buckets_of(self, files: DataFrame) -> list[int]:
        """The buckets that hold the files; ``BUCKETS`` numbers at most."""
        return sorted(r[0] for r in files.select(self.bucket().alias("b")).distinct().collect())

    def of_files(self, name: str, files: DataFrame) -> DataFrame:
        """The rows of the files, from their buckets alone."""
        rows = self.table(name).where(F.col("bucket").isin(self.buckets_of(files)))
        return rows.join(files.select("file_hash").distinct(), "file_hash", "left_semi")

    # ------------------------------------------------------------ loads
    def begin(self, names: list[str]) -> int:
        """The number of a new load of the tables; leftovers of a failed load under that number are dropped."""
        n = self.committed + 1
        for name in names:
            for part in self._parts_of(name, n):
                self._drop(name, part)
        return n

    def commit(self, number: int, names: list[str], run_id: str | None, vendors: list[str] | None = None) -> None:
        """Count the load's rows in."""
        args = {f"name{i}": name for i, name in enumerate(names)}
        args |= {} if run_id is None else {"run": run_id}
        args |= {} if vendors is None else {"vendors": F.array(*[F.lit(v) for v in vendors])}
        whose = "CAST(NULL AS ARRAY<STRING>)" if vendors is None else ":vendors"
        run = "CAST(NULL AS STRING)" if run_id is None else ":run"
        values = ", ".join(f"(:{name}, {whose}, {run})" for name in args if name.startswith("name"))
        table = self.declare("load_batch")
        self.spark.sql(f"INSERT OVERWRITE {table} PARTITION (batch = {number}) VALUES {values}", args=args)
        self._batches += [(number, name, vendors, run_id) for name in names]

    def append(self, name: str, df: DataFrame, number: int = 0, **partition: Column) -> int:
        """Add rows (to load ``number``, once a load, where the table has loads); how many were written."""
        t = TABLES[name]
        parts = {"batch": F.lit(number).cast("bigint"), "bucket": F.lit(0) if t.by == SMALL else self.bucket()} | partition
        # a load's partitions are its own: overwriting them leaves nothing of an earlier attempt
        return self._write(name, df.withColumns({c: parts[c] for c in t.by}), "append" if t.by == SMALL else "overwrite")

    def _write(self, name: str, df: DataFrame, mode: str) -> int:
        """Insert in the declared column order, counting the rows on the way (no extra job)."""
        full = self.declare(name)
        seen = Observation(f"rows-{uuid.uuid4().hex}")
        rows = df.select(*self.spark.table(full).columns).observe(seen, F.count(F.lit(1)).alias("n"))
        rows.write.mode(mode).insertInto(full)
        return seen.get.get("n") or 0

    # ------------------------------------------------------------ changing old rows
    def write(self, name: str, df: DataFrame) -> None:
        """Replace a small table whole (``df`` may read it: files are staged, then swapped)."""
        if self._write(name, df.withColumn("bucket", F.lit(0)), "overwrite") == 0:
            self._drop(name, {"bucket": "0"})

    def _partitions(self, name: str, files: DataFrame, keys: list[str]) -> tuple[DataFrame, list, list]:
        """The table's partitions with rows of the files: their rows, those that keep others, those that keep none."""
        by = list(TABLES[name].by)
        if not self.newer(name, 0):  # nothing has been loaded
            return self._rows(name).limit(0), [], []
        wanted = files.select(*keys).distinct().withColumn("_hit", F.lit(True))
        rows = self._rows(name).where(F.col("bucket").isin(self.buckets_of(files)))
        hit = F.count_if(F.col("_hit"))
        found = rows.select(*by, *keys).join(wanted, keys, "left").groupBy(*by)
        found = found.agg(hit.alias("hit"), F.count_if(F.col("_hit").isNull()).alias("rest")).where("hit > 0")
        parts = [(tuple(r[c] for c in by), r["rest"]) for r in found.collect()]  # a row a partition
        mixed, whole = [p for p, rest in parts if rest], [p for p, rest in parts if not rest]
        return rows, mixed, whole

    @staticmethod
    def _in(by: list[str], parts: list[tuple]) -> Column:
        """The rows of the partitions: one IN list of the last column for each combination of those before."""
        grouped: dict[tuple, list] = {}
        for *head, last in parts:
            grouped.setdefault(tuple(head), []).append(last)
        out = F.lit(False)
        for head, lasts in grouped.items():
            c = F.col(by[-1]).isin(lasts)
            for name, value in zip(by, head):
                c = c & (F.col(name) == value)
            out = out | c
        return out

    def delete_files(self, name: str, files: DataFrame, keys: tuple[str, ...] = ("file_hash",)) -> int:
        """Delete the rows of the files (matched on ``keys``); how many partitions were written again or dropped.

        Only partitions that hold such rows are touched: mixed ones are
        overwritten with what stays, the others dropped.
        """
        keys, by = list(keys), list(TABLES[name].by)
        rows, mixed, whole = self._partitions(name, files, keys)
        if mixed:
            rest = rows.where(self._in(by, mixed)).join(files.select(*keys).distinct(), keys, "left_anti")
            self._write(name, rest, "overwrite")
        for p in whole:
            self._drop(name, {c: str(v).lower() for c, v in zip(by, p)})
        return len(mixed) + len(whole)

    def update_files(self, name: str, files: DataFrame, merge: Callable[[DataFrame], DataFrame], number: int) -> None:
        """Rewrite the partitions that hold the files, and add rows of new files to load ``number``, in one job.

        ``merge`` gets the rows of those partitions (declared columns and
        ``batch``, ``bucket``) and returns all rows that are to stand there,
        none of them dropped; rows without a ``batch`` are new. Updated rows
        keep their partition.
        """
        by = list(TABLES[name].by)
        rows, mixed, whole = self._partitions(name, files, ["file_hash"])
        old = rows.where(self._in(by, mixed + whole))
        new = merge(old).withColumns({"batch": F.coalesce("batch", F.lit(number).cast("bigint")), "bucket": self.bucket()})
        self._write(name, new, "overwrite")

    def compact(self, name: str, upto: int) -> None:
        """Move the rows of all loads up to ``upto`` into that load, a file a bucket: fewer, larger files.

        Run it between pipeline runs, with ``upto`` no higher than the lowest
        mark of the table's consumers (they wouldn't see the moved rows as new).
        """
        by = TABLES[name].by
        old = self._rows(name).where(F.col("batch") <= upto)
        numbers = sorted(r[0] for r in old.select("batch").distinct().collect())
        if len(numbers) < 2:
            return
        moved = old.withColumn("batch", F.lit(upto).cast("bigint")).repartition(*by)
        self._write(name, moved, "overwrite")
        for n in numbers:
            for part in self._parts_of(name, n) if n < upto else []:
                self._drop(name, part)
