"""Landing files: scan, batch date, completeness checks, minimum-row guard."""

from __future__ import annotations

import re
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql.types import StringType, StructField, StructType

from dqgate.functions.lineage import join_small_keys
from dqgate.schema import DEFAULTS, LANDING_FILE, RAW, RAW_COLUMNS

# Fixed value: the batch date inside a path.
_DATE = r"dt=(\d{4}-\d{2}-\d{2})"
_DATE_ONLY = r"^\d{4}-\d{2}-\d{2}$"


class TooFewRows(Exception):
    """A batch below the minimum row count: a technical failure, not a verdict."""


def batch_date(path: str) -> str:
    """The batch date of one path; an error when it names none."""
    found = re.search(_DATE, path)
    if found is None:
        raise ValueError(f"no dt=YYYY-MM-DD in path: {path}")
    return found.group(1)


def path_date(path: Column) -> Column:
    """The batch date of a path column; the query fails when a path names none."""
    found = F.regexp_extract(path, _DATE, 1)
    problem = F.concat(F.lit("no dt=YYYY-MM-DD in path: "), path)
    return F.when(found == "", F.raise_error(problem)).otherwise(found)


def _any_of(dates: Sequence[str]) -> str:
    """A glob for the batch dates given."""
    for date in dates:
        if not re.fullmatch(_DATE_ONLY, date):
            raise ValueError(f"not a date: {date!r}")
    found = sorted({*dates}) or ["none"]
    return f"dt={found[0] if len(found) == 1 else '{' + ','.join(found) + '}'}"


def _found(read):
    """What ``read`` returns, or None when nothing is there to be read."""
    try:
        return read()
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return None


@dataclass(frozen=True)
class Listing:
    """Landing files of some dates: what the scan reads, and the guard, the missing check and the pickup look at.

    ``files`` has ``path, dt, length, modified``; ``by_date`` one :class:`Landed` per date.
    """

    root: str
    files: DataFrame
    by_date: dict[str, Landed]

    @property
    def in_folders(self) -> bool:
        """Whether every file is below a folder of its date directly below the root."""
        return all(b.in_folder for b in self.by_date.values())

    def batches(self) -> DataFrame:
        """``dt, files, bytes, s3_key``; ``s3_key`` names all files of the batch."""
        rows = [(d, b.files, b.bytes, b.s3_key) for d, b in sorted(self.by_date.items())]
        return self.files.sparkSession.createDataFrame(rows, "dt string, files bigint, bytes bigint, s3_key string")


@dataclass(frozen=True)
class Landed:
    """The files of one batch; ``data_id`` changes with any of their paths, lengths and modification times."""

    files: int
    bytes: int
    data_id: int
    s3_key: str
    in_folder: bool


#: Of a batch of more files than this, the report names their number and folder.
NAMED_FILES = 1000


def list_landing(spark: SparkSession, path: str, dates: Sequence[str] | None = None) -> Listing:
    """Files below ``path`` (those Spark hides apart), whatever their names and however deep.

    With ``dates``, only entries of ``path`` with one of the dates in their name are listed, be they folders or
    files; only if a date is not found so, everything below ``path`` is.  The date comes from the path of the
    file, so it may also be in the file's name or in ``path`` itself.  Contents are never loaded.
    """
    path = path.rstrip("/")
    reader = spark.read.format("binaryFile").option("recursiveFileLookup", True)

    def listed(where: str) -> DataFrame | None:
        found = _found(lambda: reader.load(where))
        if found is None:
            return None
        named = found.select("path", path_date(F.col("path")).alias("dt"), "length", F.col("modificationTime").alias("modified"))
        return named if dates is None else named.where(F.col("dt").isin(*dates))

    whole = dates is None or re.search(_DATE, path) is not None
    files = listed(path if whole else f"{path}/*{_any_of(dates)}*")
    by_date = _by_date(files, path)
    if not whole and not {*dates} <= {*by_date}:
        files = listed(path)
        by_date = _by_date(files, path)
    if files is None:
        files = spark.createDataFrame([], "path string, dt string, length bigint, modified timestamp")
    return Listing(path, files, by_date)


def _by_date(files: DataFrame | None, root: str) -> dict[str, Landed]:
    if files is None:
        return {}
    below = F.element_at(F.split("path", F.lit(re.escape(root.split(":", 1)[-1].lstrip("/")) + "/"), 2), -1)
    folder = F.regexp_replace("path", r"[^/]*\z", "")
    rows = (
        files.groupBy("dt")
        .agg(
            F.count("*").alias("files"),
            F.sum("length").alias("bytes"),
            # Combines in any order; no two files are alike in all three.
            F.bit_xor(F.xxhash64("path", "length", "modified")).alias("data_id"),
            F.array_sort(F.collect_list("path")).alias("paths"),
            F.min(folder).alias("folder"),
            F.bool_and(F.startswith(below, F.concat(F.lit("dt="), F.col("dt"), F.lit("/")))).alias("in_folder"),
        )
        .withColumn(
            "s3_key",
            F.when(F.col("files") <= NAMED_FILES, F.array_join("paths", ",")).otherwise(
                F.format_string("%d files from %s on", "files", "folder")
            ),
        )
        .drop("paths", "folder")
        .collect()
    )
    return {r["dt"]: Landed(r["files"], r["bytes"], r["data_id"], r["s3_key"], r["in_folder"]) for r in rows}


def read_landing(
    spark: SparkSession,
    path: str,
    dates: Sequence[str] | None = None,
    with_file: bool = False,
    listing: Listing | None = None,
) -> DataFrame:
    """Landing CSV (header line, six text columns) plus ``dt`` as text.

    The files are those of ``listing``, by default of :func:`list_landing`.  ``with_file``
    adds the path of each row's file.

    Where all files are in date folders, only the folders of these dates are read, the date
    comes from the folder, and a filter on it skips whole folders; else it comes from the path of
    each row's file.
    """
    listing = list_landing(spark, path, dates) if listing is None else listing
    reader = spark.read.option("header", True).schema(RAW)
    root, found = listing.root, sorted(listing.by_date)
    if not found and dates is None:
        reader.csv(root)  # an error if there is no such folder
    if not found:
        rows = spark.createDataFrame([], RAW).withColumn("dt", F.lit(None).cast("string"))
        return rows.withColumn(LANDING_FILE, F.lit(None).cast("string")) if with_file else rows
    if re.search(_DATE, root):
        rows = reader.option("recursiveFileLookup", True).csv(root).withColumn("dt", F.lit(batch_date(root)))
    elif listing.in_folders:
        # Naming dt keeps it text instead of an inferred date.
        dated = reader.schema(StructType([*RAW.fields, StructField("dt", StringType())])).option("basePath", root)
        rows = dated.csv(root if dates is None else f"{root}/{_any_of(found)}")
    else:
        rows = reader.option("recursiveFileLookup", True).csv(root)
        rows = rows.withColumn("dt", path_date(F.col("_metadata.file_path")))
        rows = rows if dates is None else rows.where(F.col("dt").isin(*found))
    more = [F.col("_metadata.file_path").alias(LANDING_FILE)] if with_file else []
    return rows.select(*RAW_COLUMNS, "dt", *more)


def landed_batches(
    spark: SparkSession, path: str, dates: Sequence[str] | None = None
) -> DataFrame:
    """Batches with files under ``path``, the same files as are read: ``dt, files, bytes``."""
    return list_landing(spark, path, dates).batches().drop("s3_key")


def expected_batches(spark: SparkSession, first: str, last: str) -> DataFrame:
    """One ``dt`` per calendar day from ``first`` to ``last``."""
    days = F.sequence(F.lit(first).cast("date"), F.lit(last).cast("date"))
    return spark.range(1).select(F.explode(days.cast("array<string>")).alias("dt"))


def missing_batches(expected: DataFrame, landed: DataFrame) -> DataFrame:
    """Expected dates nothing has landed for."""
    return expected.select("dt").distinct().join(landed.select("dt"), "dt", "left_anti")


def undersized_batches(
    rows: DataFrame, min_rows: int = DEFAULTS.min_rows, expected: DataFrame | None = None
) -> DataFrame:
    """Batches below ``min_rows``: ``dt, raw_count, min_rows``.

    A file without any data row leaves no trace in ``rows``; pass the ``expected``
    (or landed) dates to have such a batch counted as zero rows.  Batches with rows
    count whether they are among those dates or not.
    """
    return undersized_counts(rows.groupBy("dt").agg(F.count("*").alias("raw_count")), min_rows, expected)


def undersized_counts(counted: DataFrame, min_rows: int = DEFAULTS.min_rows, expected: DataFrame | None = None) -> DataFrame:
    """The same, from ``dt, raw_count`` of each batch."""
    if expected is not None:
        counted = (
            expected.select("dt")
            .distinct()
            .join(counted, "dt", "full")
            .select("dt", F.coalesce("raw_count", F.lit(0)).alias("raw_count"))
        )
    return counted.where(F.col("raw_count") < min_rows).withColumn(
        "min_rows", F.lit(min_rows).cast("bigint")
    )


def require_min_rows(undersized: DataFrame) -> None:
    """Strict mode of the guard: an error with the number of undersized batches and the first of them.

    All of them are in ``undersized``; the job has stored them as failures by then.
    """
    number, first = undersized.agg(F.count("*"), F.min(F.struct("dt", "raw_count", "min_rows"))).first()
    if number:
        raise TooFewRows(
            f"{number} undersized; first {first['dt']}: "
            f"row count {first['raw_count']} below minimum {first['min_rows']}"
        )


def without_batches(rows: DataFrame, batches: DataFrame, path: str | None = None) -> DataFrame:
    """Backfill mode of the guard: the rows of all other batches."""
    return join_small_keys(rows, batches, "dt", "left_anti", path)
