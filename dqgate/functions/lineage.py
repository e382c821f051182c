"""Shared working folder, lineage cuts, and joins against per-batch tables."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

from dqgate.functions.files import delete


def work_dir(spark: SparkSession) -> str:
    """A new folder under ``spark.checkpoint.dir``, the folder all executors share.

    Only a local session may do without that setting and use a temporary folder.
    """
    shared = spark.conf.get("spark.checkpoint.dir", None)
    if not shared:
        if not spark.conf.get("spark.master", "").startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder all executors can reach")
        return tempfile.mkdtemp(prefix="dqgate-")
    return f"{shared.rstrip('/')}/dqgate-{uuid.uuid4().hex}"


def written(df: DataFrame, path: str | None = None) -> DataFrame:
    """``df`` written as Parquet and read back: a lineage cut that outlives executors."""
    spark = df.sparkSession
    path = path or work_dir(spark) + "/table"
    df.write.mode("overwrite").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def release(spark: SparkSession, path: str) -> None:
    """Free the space of a table made by ``written``, or of a whole working folder."""
    delete(spark, path)


def join_small_keys(rows: DataFrame, keys: DataFrame, on: str, how: str, path: str | None = None) -> DataFrame:
    """Semi- or anti-join many ``rows`` with a per-batch table of ``keys``.

    The keys are written first (to ``path``, if given), so the planner knows their size: it broadcasts a small
    table (and a scan partitioned by the key skips the other partitions) and joins a
    large one by shuffle, with adaptive skew splitting for a hot key.
    """
    return rows.join(written(keys.select(on).distinct(), path), on, how)
