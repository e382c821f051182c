"""Curated and quarantine tables: Parquet partitioned by batch, replaced per batch."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.types import StructType

from dqgate.schema import CURATED, QUARANTINE

MAX_RECORDS_PER_FILE = 20_000_000


def _write_by_batch(rows: DataFrame, path: str) -> None:
    """Replace the batches found in ``rows`` and leave all others alone.

    The rebalance hint gathers a small batch into one file, and lets adaptive
    execution split a large one over many tasks; a plain repartition by date would
    send a batch of any size to a single task.
    """
    (
        rows.hint("rebalance", F.col("dt"))
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .option("maxRecordsPerFile", MAX_RECORDS_PER_FILE)
        .partitionBy("dt")
        .parquet(path)
    )


def write_curated(curated: DataFrame, path: str) -> None:
    _write_by_batch(curated, path)


def write_quarantine(quarantine: DataFrame, path: str) -> None:
    _write_by_batch(quarantine, path)


def clear_batches(spark: SparkSession, path: str, dates: list[str], schema: StructType) -> None:
    """Empty the partitions of ``dates``.

    A dynamic overwrite keeps a partition that gets no rows, so a batch that was
    repaired and now has no invalid row would keep its old ones.  Writing no rows
    over the one partition folder replaces its files.
    """
    columns = [field for field in schema.fields if field.name != "dt"]
    nothing = spark.createDataFrame([], StructType(columns))
    for date in dates:
        nothing.write.mode("overwrite").parquet(f"{path}/dt={date}")


def _read(spark: SparkSession, path: str, schema: StructType) -> DataFrame:
    # Naming dt in the schema keeps it text instead of an inferred date.
    return spark.read.schema(schema).parquet(path).select(*schema.names)


def read_curated(spark: SparkSession, path: str) -> DataFrame:
    return _read(spark, path, CURATED)


def read_quarantine(spark: SparkSession, path: str) -> DataFrame:
    return _read(spark, path, QUARANTINE)
