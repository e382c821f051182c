"""Quality reports as JSON, one folder per batch, as other systems write and read them.

The job's own reports are those of ``dqgate/sources/manifest.py``.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.types import StructType

from dqgate.schema import REPORT


def read_reports(
    spark: SparkSession,
    path: str,
    dates: Sequence[str] | None = None,
    schema: StructType = REPORT,
) -> DataFrame:
    """Reports under ``path``, one-line or pretty-printed.  Absent fields are NULL.

    ``dates`` reads only the folders of these batches.
    """
    rows = spark.read.schema(schema).option("multiLine", True).json(path)
    if dates is not None:
        folder = "dt" if "dt" in rows.columns else "source_date"
        rows = rows.where(F.col(folder).cast("string").isin(*dates))
    return rows.select(*schema.names)


def write_reports(reports: DataFrame, path: str) -> None:
    """One JSON object per batch under ``dt=<source_date>``; NULL fields are kept.

    Only the folders of the batches at hand are replaced.
    """
    (
        reports.withColumn("dt", F.col("source_date"))
        .repartition("dt")
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .option("ignoreNullFields", False)
        # Read back as whole files, pretty-printed or not: one object in each.
        .option("maxRecordsPerFile", 1)
        .partitionBy("dt")
        .json(path)
    )
