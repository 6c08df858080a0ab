"""The corpus pipeline: stages over ``documents``, each written as Parquet and reread by the next.

Every stage takes (spark, docs, sf_dir) and returns a DataFrame; all but the
last return the columns of ``documents``. Each works on all its predecessor
kept:

1. toxicity: documents whose score reaches the threshold go;
2. near duplicates: one document of each group stays (five-word shingles,
   similarity 0.8);
3. decontamination: documents holding a benchmark window go;
4. mixing: documents are taken as often as the fitted rates say, so that the
   expected shares of the domains meet the targets;
5. sharding: every row gets its shard and a slot inside it.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from claimflow.llm import decontaminate, minhash, mixing, sharding, toxicity
from claimflow.llm.common import stored, table

SHARDS = 8
#: Targets of the mixing stage: those of the domains that the toxicity stage leaves, in the same proportion.
MIX_TARGETS = {d: mixing.TARGETS[d] for d in ("high", "low")}


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents whose toxicity score is under the threshold; texts are scored whole."""
    model = toxicity.fit(docs, table(spark, sf_dir, "labels"))
    found = toxicity.score(docs, model, docs.columns)
    return found.where(F.col("score") < toxicity.THRESHOLD).select("row.*")


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates, that of the smallest id."""
    return minhash.near_dedup(docs, size=5, percent=80)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents without any window of 10 benchmark words (or a whole shorter item)."""
    return decontaminate.decontaminate(docs, table(spark, sf_dir, "benchmark"), window=10, max_coverage=0.0)


def mix_domains(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents, each as often as the rates for the target shares of high and low quality say.

    Toxic documents are the first stage's to drop; the few it missed are no
    domain to aim for, and their labels teach nothing here.
    """
    domain = mixing.label_domain(F.col("quality"), F.col("toxic")).alias("domain")
    labelled = table(spark, sf_dir, "labels").select("doc_id", domain)
    return mixing.mixed(docs, labelled, MIX_TARGETS)


def shard(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All rows with ``shard`` (0 to SHARDS - 1) and ``slot`` (gapless from 0 in a shard).

    Slots follow the id, then a 128-bit hash of the text. Columns of those
    names that the documents have already are kept as ``<name>_in``.
    """
    hashes = [F.xxhash64(F.lit(i), "text").alias(f"h{i}") for i in (1, 2)]
    shard_of = sharding.shard_of("doc_id", sharding.default_tree(SHARDS)).alias("shard")
    rows = docs.select(F.struct(*docs.columns).alias("row"), F.col("doc_id").alias("id"), *hashes, shard_of)
    placed = sharding.with_slots(rows, ["id", "h1", "h2"])
    own = [F.col("row")[c].alias(f"{c}_in" if c in ("shard", "slot") else c) for c in docs.columns]
    return placed.select(*own, "shard", "slot")


STAGES = [
    ("toxicity", drop_toxic),
    ("near_duplicates", drop_near_duplicates),
    ("decontamination", drop_contaminated),
    ("mixing", mix_domains),
    ("sharding", shard),
]

#: SQL can express neither the network nor the fitted rates; the tests compare with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Apply the stages in order to the whole ``documents`` table."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
