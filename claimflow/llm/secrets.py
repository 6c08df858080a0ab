"""Secret scan with corpus-wide ownership frequency.

1. One Arrow pass over the texts finds candidates: assignments, access keys
   and long hexadecimal runs (the base kinds), and other dense tokens.
   Cheap byte searches decide first whether a pattern can match at all.
2. Candidate values are reduced to 128-bit hashes. For each hash Spark counts
   distinct owners and repositories and all uses over the whole corpus
   (two-step distinct aggregates, combined before the shuffle, so a value in a
   third of all rows is no hot task).
3. A value held by one owner only is ``live``; one found at
   ``example_owners`` or more is an ``example`` (a widely copied sample);
   between the two it is ``shared``. Dense tokens become spans only when
   they are live; base spans always stay.
"""

from __future__ import annotations

import hashlib
import math
import re
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from claimflow.llm.common import stored

#: Kinds in their order; the first three are the base kinds.
KINDS = ("assign", "access", "hex", "dense")
ASSIGN = re.compile(
    r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I | re.A
)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]+")
#: Any other token that may be a credential: 20 characters or more of a key alphabet.
DENSE = re.compile(r"[A-Za-z0-9+/_-]{20,}")
WORDS = (b"password", b"passwd", b"secret", b"token", b"api")
_HEX_RUN = bytes(1 if chr(i) in "0123456789abcdef" else 0 for i in range(256))
_KEY_RUN = bytes(1 if chr(i).isascii() and (chr(i).isalnum() or chr(i) in "+/_-") else 0 for i in range(256))

_SPAN = T.StructType(
    [
        T.StructField("kind", T.IntegerType()),
        T.StructField("start", T.IntegerType()),
        T.StructField("end", T.IntegerType()),
        T.StructField("value", T.BinaryType()),
    ]
)


def entropy(s: str) -> float:
    """Shannon entropy of the characters, in bits."""
    n = len(s)
    return -sum(c / n * math.log2(c / n) for c in Counter(s).values())


def _dense(s: str) -> bool:
    """Mixed letters and digits of high entropy: not a long word, path or separator line."""
    digits = sum(ch.isdigit() for ch in s)
    return digits >= 3 and len(s) - digits >= 3 and entropy(s) >= 3.5


def find_spans(text: str) -> list[tuple[int, int, int, str]]:
    """(kind, start, end, value) by start, then kind; offsets in code points, end exclusive.

    Base kinds are leftmost non-overlapping per kind, short ones dropped after
    matching. Dense tokens that touch a base span are left out.
    """
    raw = text.encode("utf-8", "surrogatepass")
    low = raw.lower()
    out: list[tuple[int, int, int, str]] = []
    if any(w in low for w in WORDS):
        out += [(0, m.start(), m.end(), m[2]) for m in ASSIGN.finditer(text) if len(m[2]) >= 12]
    if b"AKIA" in raw:
        out += [(1, m.start(), m.end(), m[0]) for m in ACCESS.finditer(text) if len(m[0]) >= 18]
    if b"\x01" * 16 in raw.translate(_HEX_RUN):
        out += [(2, m.start(), m.end(), m[0]) for m in HEX.finditer(text) if m.end() - m.start() >= 16]
    if b"\x01" * 20 in raw.translate(_KEY_RUN):
        base = sorted((a, b) for _, a, b, _ in out)
        for m in DENSE.finditer(text):
            if _dense(m[0]) and not any(a < m.end() and m.start() < b for a, b in base):
                out.append((3, m.start(), m.end(), m[0]))
    return sorted(out, key=lambda s: (s[1], s[0]))


def _scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    kind = pa.list_(
        pa.struct([("kind", pa.int32()), ("start", pa.int32()), ("end", pa.int32()), ("value", pa.binary())])
    )
    for batch in batches:
        spans = [
            [
                {"kind": k, "start": a, "end": b, "value": hashlib.sha256(v.encode()).digest()[:16]}
                for k, a, b, v in find_spans(text or "")
            ]
            for text in batch.column("text").to_pylist()
        ]
        yield pa.RecordBatch.from_arrays(
            [batch.column("id"), batch.column("repo"), batch.column("owner"), pa.array(spans, kind)],
            ["id", "repo", "owner", "spans"],
        )


def _joined(spans: str) -> str:
    names = "array(" + ", ".join(f"'{k}'" for k in KINDS) + ")"
    return f"array_join(transform({spans}, s -> concat_ws(':', element_at({names}, s.kind + 1), s.start, s.end)), ',')"


def scan_secrets(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    repo_col: str = "source",
    owner_col: str = "source",
    example_owners: int = 3,
) -> DataFrame:
    """One row per input row: id, counts by kind, ``base`` and ``spans`` (joined), and verdict counts.

    Null texts are empty. A null owner or repository counts as one owner or
    repository of its own. Repeated rows are scanned and counted each. An
    empty table gives an empty result. Only the named columns are read.
    """
    id_type = docs.schema[id_col].dataType
    schema = T.StructType(
        [
            T.StructField("id", id_type),
            T.StructField("repo", T.StringType()),
            T.StructField("owner", T.StringType()),
            T.StructField("spans", T.ArrayType(_SPAN)),
        ]
    )
    rows = docs.select(
        F.col(id_col).alias("id"),
        F.coalesce(F.col(repo_col).cast("string"), F.lit("\x00null")).alias("repo"),
        F.coalesce(F.col(owner_col).cast("string"), F.lit("\x00null")).alias("owner"),
        F.col(text_col).alias("text"),
    )
    found = stored(
        rows.mapInArrow(_scan, schema).withColumn("rid", F.monotonically_increasing_id()), "secret-candidates"
    )
    uses = found.select("rid", "id", "repo", "owner", F.explode("spans").alias("span")).withColumn(
        "value", F.col("span.value")
    )
    ownership = (
        uses.groupBy("value", "owner", "repo")
        .agg(F.count(F.lit(1)).alias("n"))
        .groupBy("value")
        .agg(
            F.count_distinct("owner").alias("n_owners"),
            F.count_distinct("repo").alias("n_repos"),
            F.sum("n").alias("n_uses"),
        )
    )
    verdict = (
        F.when(F.col("n_owners") >= example_owners, "example").when(F.col("n_owners") == 1, "live").otherwise("shared")
    )
    judged = (
        uses.select("rid", "value", "span")
        .join(ownership, "value")
        .withColumn("verdict", verdict)
        .where((F.col("span.kind") < 3) | (F.col("verdict") == "live"))
        .groupBy("rid")
        .agg(
            F.array_sort(F.collect_list(F.struct("span.start", "span.kind", "span.end"))).alias("s"),
            F.count_if(F.col("verdict") == "live").alias("n_live"),
            F.count_if(F.col("verdict") == "shared").alias("n_shared"),
            F.count_if(F.col("verdict") == "example").alias("n_example"),
            F.max("n_owners").alias("max_owners"),
            F.max("n_repos").alias("max_repos"),
            F.max("n_uses").alias("max_uses"),
        )
    )
    count = [F.expr(f"cast(size(filter(spans, s -> s.kind = {k})) as bigint)").alias(f"n_{KINDS[k]}") for k in range(3)]
    base = F.expr(_joined("filter(spans, s -> s.kind < 3)")).alias("base")
    narrow = found.select("rid", F.col("id").alias(id_col), *count, base)
    zero = [F.coalesce(F.col(c), F.lit(0)).alias(c) for c in ("n_live", "n_shared", "n_example", "max_owners", "max_repos", "max_uses")]
    return narrow.join(judged, "rid", "left").select(
        id_col,
        "n_assign",
        "n_access",
        "n_hex",
        "base",
        F.coalesce(F.expr(_joined("s")), F.lit("")).alias("spans"),
        *zero,
    )
