"""Cutting lineage through a folder that all executors share."""

from __future__ import annotations

import re
import tempfile
import uuid

from pyspark.sql import DataFrame
from pyspark.sql.functions import broadcast


def shared_folder(spark) -> str:
    """The folder that the cluster names in spark.checkpoint.dir.

    Where none is named, a local master gets a temporary one; on a cluster that would be another disk on every machine, so
    there it is an error.
    """
    sc = spark.sparkContext
    if named := sc.getConf().get("spark.checkpoint.dir", ""):
        return named.rstrip("/")
    if sc.getCheckpointDir() is None:
        if not re.match(r"local(\[|$)", sc.master):
            raise ValueError("spark.checkpoint.dir names no folder that the cluster shares")
        sc.setCheckpointDir(tempfile.mkdtemp(prefix="lectern-"))
    return sc.getCheckpointDir().rstrip("/")


def saved(df: DataFrame) -> DataFrame:
    """The rows, written to the checkpoint folder, so that a lost executor costs no recomputation."""
    shared_folder(df.sparkSession)
    return df.checkpoint()


def saved_table(df: DataFrame) -> DataFrame:
    """The rows, written as a Parquet table to the checkpoint folder: smaller than a checkpoint where values repeat. Neither order nor partitions stay."""
    at = f"{shared_folder(df.sparkSession)}/table-{uuid.uuid4().hex}"
    df.write.parquet(at)
    return df.sparkSession.read.schema(df.schema).parquet(at)


#: Rows of a side that is broadcast, at most.
FEW = 200_000


def few_joined(rows: DataFrame, facts: DataFrame, on: list[str], how: str = "inner", few: int = FEW) -> DataFrame:
    """rows joined with a table that is small as a rule: broadcast where it is, by a count, and by a shuffle where it isn't."""
    return rows.join(broadcast(facts) if facts.count() <= few else facts, on, how)
