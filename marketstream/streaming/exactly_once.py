"""A topic of files that holds every record once, whatever fails (ST10, S6-S8).

A batch is written to a folder of its own, under a name that no other attempt has, and counts
only when its commit record names that folder.  The record is the last thing written, in one
move that does not replace an earlier one: an attempt that dies leaves a folder nobody reads,
and a batch that is run again after its commit writes nothing.  Readers take the folders that
the records name, so they see whole batches only.

``key`` and ``value`` are as the topic sinks make them (streaming/sinks.py).
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

from marketstream import files


def _record(path: str, batch_id: int) -> str:
    return f"{path}/_commits/{batch_id:010d}"


def committed(spark: SparkSession, path: str) -> dict[int, str]:
    """Batch number -> folder of every committed batch."""
    return {int(n): files.read_text(spark, f"{path}/_commits/{n}")
            for n in files.names(spark, f"{path}/_commits") if n.isdigit()}


def stage(records: DataFrame, path: str, batch_id: int) -> str:
    """Write a batch's records where nobody reads them yet; the folder."""
    folder = f"batch-{batch_id}-{uuid.uuid4().hex[:12]}"
    records.select("key", "value").write.parquet(f"{path}/{folder}")
    return folder


def commit(spark: SparkSession, path: str, batch_id: int, folder: str) -> bool:
    """Make ``folder`` the batch's records; False if the batch has been committed before."""
    return files.write_new(spark, _record(path, batch_id), folder)


def write_once(records: DataFrame, batch_id: int, path: str) -> bool:
    """A ``foreachBatch`` sink: stage and commit, unless the batch is there already."""
    spark = records.sparkSession
    if files.exists(spark, _record(path, batch_id)):
        return False
    return commit(spark, path, batch_id, stage(records, path, batch_id))


def read(spark: SparkSession, path: str) -> DataFrame:
    """The records of all committed batches: (key, value)."""
    folders = [f"{path}/{f}" for f in committed(spark, path).values()]
    if not folders:
        return spark.createDataFrame([], "key string, value string")
    return spark.read.schema("key string, value string").parquet(*folders)


def abandoned(spark: SparkSession, path: str) -> list[str]:
    """Staged folders that no commit names: attempts that died, or that came second.  They may
    be deleted once no writer is at work."""
    named = set(committed(spark, path).values())
    return [f for f in files.names(spark, path) if f.startswith("batch-") and f not in named]
