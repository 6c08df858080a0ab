"""Exact dedup by skew-safe combining (DataFrame functions only).

Three combining stages, each comparing the full normalised content and not
only its digest:

1. every input partition deduplicates its own rows (Spark's map-side partial
   aggregation on digest and content);
2. what is left is merged per (digest, salt, content), where the salt is the
   input partition modulo ``salts``: a group of copies holding a third of all
   rows arrives as one row per partition, spread over ``salts`` tasks;
3. the salt winners, at most ``salts`` rows a text, are combined globally.

The winners are joined back to the rows on a narrow name of the content
(digest, a second 64-bit hash, length). Should two different contents ever
share that name, the job fails with an error instead of merging them.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Runs of ASCII white space that count as one space.
SPACES = r"[\x20\x09-\x0D]+"


def normalised(text: Column) -> Column:
    """Null as empty text; every run of ASCII white space as one space."""
    return F.regexp_replace(F.coalesce(text, F.lit("")), SPACES, " ")


def sha256_hex(content: Column) -> Column:
    return F.sha2(content, 256)


def exact_dedup(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    salts: int = 16,
    digest: Callable[[Column], Column] = sha256_hex,
) -> DataFrame:
    """One row per input row: id, ``digest``, ``keep_id``, ``group_size``, ``kept``.

    Rows are equal when their normalised texts are identical; the smallest id
    of a group stays. Null texts equal the empty text. Null ids are never
    chosen while the group has another id (a group of null ids has a null
    ``keep_id`` and keeps its rows). Rows that repeat the kept row's id are
    all marked kept. Other columns of the input are ignored, whatever their
    names. An empty table gives an empty result.
    """
    rows = docs.select(F.col(id_col).alias("id"), normalised(F.col(text_col)).alias("content"))
    rows = rows.select("id", "content", digest(F.col("content")).alias("digest"))
    salted = (
        rows.withColumn("salt", F.spark_partition_id() % F.lit(salts))
        .groupBy("digest", "salt", "content")
        .agg(F.min("id").alias("keep_id"), F.count(F.lit(1)).alias("n"))
    )
    winners = salted.groupBy("digest", "content").agg(F.min("keep_id").alias("keep_id"), F.sum("n").alias("group_size"))

    def named(df: DataFrame) -> DataFrame:
        return df.withColumns({"h": F.xxhash64("content"), "len": F.octet_length("content")}).drop("content")

    contents = F.count(F.lit(1))
    by_name = (
        named(winners)
        .groupBy("digest", "h", "len")
        .agg(
            F.when(contents > 1, F.raise_error(F.lit("two contents share digest, hash and length")).cast("long"))
            .otherwise(F.sum("group_size"))
            .alias("group_size"),
            F.min("keep_id").alias("keep_id"),
        )
    )
    return (
        named(rows)
        .join(by_name, ["digest", "h", "len"])
        .select(
            F.col("id").alias(id_col),
            "digest",
            "keep_id",
            "group_size",
            F.col("id").eqNullSafe(F.col("keep_id")).alias("kept"),
        )
    )
