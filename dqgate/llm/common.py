"""Shared pieces of the text operators: words, plan barriers, distributed ranks."""

from __future__ import annotations

import tempfile
import zipfile
from collections.abc import Sequence
from pathlib import Path
from urllib.parse import unquote

from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from dqgate.functions.lineage import release, work_dir, written

#: A word is a maximal run of characters other than space, tab, LF, VT, FF and CR.
SPACE = r"[\x20\x09-\x0D]+"
HAS_WORD = r"[^\x20\x09-\x0D]"
WORD = r"[^\x20\x09-\x0D]+"


_shipped: set[str] = set()


def ship_package(spark: SparkSession) -> None:
    """Have Spark send this package to its Python workers, which need not have it installed.

    Once per application; Spark serves the archive to the executors itself.
    """
    context = spark.sparkContext
    if context.applicationId in _shipped:
        return
    package = Path(__file__).resolve().parents[1]
    archive = Path(tempfile.mkdtemp(prefix="dqgate-")) / "dqgate.zip"
    with zipfile.ZipFile(archive, "w") as out:
        for file in sorted(package.rglob("*.py")):
            out.write(file, file.relative_to(package.parent))
    context.addPyFile(str(archive))
    _shipped.add(context.applicationId)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


#: Spark's setting that removes the shuffle files of a query when it has ended.
_SHUFFLES_GO = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def written_once(df: DataFrame) -> DataFrame:
    """``written``, whose shuffle files go when the table stands.

    Else they stay until the driver happens to collect its garbage, and those of many steps add up.
    """
    conf = df.sparkSession.conf
    before = conf.get(_SHUFFLES_GO, "false")
    conf.set(_SHUFFLES_GO, "true")
    try:
        return written(df)
    finally:
        conf.set(_SHUFFLES_GO, before)


def spent(*tables: DataFrame) -> None:
    """Free the space of tables made by ``written`` that nothing reads any more."""
    for df in tables:
        for file in df.inputFiles()[:1]:
            release(df.sparkSession, unquote(file).rpartition("/")[0])


def words(text: Column) -> Column:
    """The words of ``text`` in order; no words for NULL."""
    return F.array_remove(F.split(F.coalesce(text, F.lit("")), SPACE), "")


def lower_ascii(text: Column) -> Column:
    """A-Z to a-z; other letters stay as they are."""
    return F.translate(text, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def computed(df: DataFrame, **columns: Column) -> DataFrame:
    """``df`` with columns that are evaluated once per row, however often they are used.

    A projection may be merged into a later one, which copies its expressions into every
    use (also into lambdas, once per array element).  A one-row generator is not merged.
    """
    row = F.struct(*[value.alias(name) for name, value in columns.items()])
    return df.select("*", F.inline(F.array(row)))


def numbered(docs: DataFrame) -> tuple[DataFrame, dict[str, Column]]:
    """``docs`` with its columns named by number, out of the way of other names, and each by its old name."""
    names = docs.columns
    own = [f"_c{i}" for i in range(len(names))]
    return docs.toDF(*own), {name: F.col(c) for name, c in reversed(list(zip(names, own)))}


def restored(rows: DataFrame, docs: DataFrame, text: Column) -> DataFrame:
    """The columns of ``docs`` out of ``rows`` (from :func:`numbered`), with another text.

    ``n_chars``, where there is such a column, is counted again.
    """
    columns = []
    for i, field in enumerate(docs.schema.fields):
        value = F.col(f"_c{i}")
        if field.name == "text":
            value = text
        elif field.name == "n_chars":
            value = F.length(text).cast(field.dataType)
        columns.append(value.alias(field.name))
    return rows.select(*columns)


def ranked(df: DataFrame, order: Sequence[str], name: str = "rank") -> DataFrame:
    """``df`` with the 0-based global position of each row in ``order``, without a single task.

    Rows are range-partitioned and written, so that their partition is fixed; positions
    are those within a partition plus the sizes of the partitions before it.  Only the
    partition sizes (one row per partition) are ordered in one task.  Rows with equal
    ``order`` get adjacent positions in no particular order, so pass a total order.
    """
    keys = [F.col(c) for c in order]
    parts = written(df.repartitionByRange(*keys).withColumn("_part", F.spark_partition_id()))
    sizes = parts.groupBy("_part").agg(F.count("*").alias("_rows"))
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    starts = sizes.select(
        "_part", F.coalesce(F.sum("_rows").over(before), F.lit(0)).alias("_start")
    )
    inside = Window.partitionBy("_part").orderBy(*keys)
    return (
        parts.withColumn("_at", F.row_number().over(inside) - 1)
        .join(starts, "_part")
        .select(*df.columns, (F.col("_start") + F.col("_at")).alias(name))
    )


__all__ = [
    "HAS_WORD", "SPACE", "WORD", "computed", "lower_ascii", "numbered", "ranked", "restored",
    "ship_package", "spent", "table", "words", "work_dir", "written", "written_once",
]
