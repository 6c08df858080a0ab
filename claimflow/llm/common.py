"""Helpers shared by the operators: reading tables, the shared scratch folder, ASCII lower-casing."""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from claimflow.session import ensure_checkpoint_dir

_UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One of the given parquet tables."""
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def shared_path(spark: SparkSession, label: str) -> str:
    """A new folder name under the shared checkpoint folder of the session.

    ``spark.checkpoint.dir`` is read from the session; only a local-mode
    session without it gets a scratch folder of its own.
    """
    return f"{ensure_checkpoint_dir(spark).rstrip('/')}/{label}-{uuid.uuid4().hex}"


def stored(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` as Parquet into the shared folder and read it back.

    Cuts the lineage: a lost executor re-reads the files instead of running
    the upstream plan again, and rows that depend on task order stay fixed.
    """
    path = shared_path(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def ascii_lower(c: Column) -> Column:
    """Lower-case A-Z only."""
    return F.translate(c, _UPPER, _UPPER.lower())
