"""Incremental pickup of new, changed and removed landing files."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.streaming import StreamingQuery

from dqgate.functions.files import names
from dqgate.functions.lineage import release, work_dir, written
from dqgate.operators.rules import Rule
from dqgate.plans.batch import BatchRun, run_batches
from dqgate.schema import DEFAULTS, Thresholds
from dqgate.sources.landing import Listing, list_landing
from dqgate.sources.zones import Zones

_LISTING = "path string, modificationTime timestamp, length bigint, content binary"
_LEDGER = "path string, dt string, length bigint, modified timestamp, gone boolean, round bigint"


def known_files(spark: SparkSession, checkpoint: str) -> DataFrame:
    """``path, dt, length, modified`` of the files as of the last call, from the ledger below ``checkpoint``.

    The ledger has a row for every change seen; the latest of a path counts.
    """
    folder = f"{checkpoint}/ledger"
    if names(spark, folder):
        rows = spark.read.schema(_LEDGER).parquet(folder)
    else:
        rows = spark.createDataFrame([], _LEDGER)
    last = rows.groupBy("path").agg(F.max_by(F.struct("dt", "length", "modified", "gone"), "round").alias("_last"))
    return last.select("path", "_last.*").where("NOT gone").drop("gone")


def file_changes(listed: DataFrame, known: DataFrame) -> DataFrame:
    """``path, dt, length, modified, gone, kind``: files that are ``new``, ``changed`` or ``gone``.

    Both sides have ``path, dt, length, modified``.  A file is changed if its length or its
    modification time is another one.
    """
    a, b = listed.alias("a"), known.alias("b")
    same = (F.col("a.length") == F.col("b.length")) & (F.col("a.modified") == F.col("b.modified"))
    gone = F.col("a.path").isNull()
    kind = F.when(gone, "gone").when(F.col("b.path").isNull(), "new").otherwise("changed")
    return (
        a.join(b, F.col("a.path") == F.col("b.path"), "full")
        .where(gone | F.col("b.path").isNull() | ~same)
        .select(*[F.coalesce(f"a.{c}", f"b.{c}").alias(c) for c in ("path", "dt", "length", "modified")], gone.alias("gone"), kind.alias("kind"))
    )


def run_available_now(
    spark: SparkSession,
    landing: str,
    zones: Zones,
    checkpoint: str,
    *,
    expected: DataFrame | None = None,
    history: DataFrame | None = None,
    verdicts: DataFrame | None = None,
    rules: Sequence[Rule] | None = None,
    limits: Thresholds = DEFAULTS,
    strict: bool = False,
    gate: bool = False,
    baseline: str = "previous",
    on_batch: Callable[[BatchRun], None] | None = None,
) -> None:
    """Process every batch whose files are not those of the last call, then stop.

    The files are listed, whatever their names and without reading them, and compared with
    the ledger of path, length and modification time below ``checkpoint``: a file dropped again under
    its name is noticed, and so is one taken away.  All changes of a call are one round, so each
    date is processed once, as a whole, from the landing folder; a date without files any more
    stays as it was.  The ledger is written after the round, so a call that fails is repeated by
    the next one.  The other parameters are those of ``run_batches``, which also stores
    alerts, failures and reviews.
    """
    listing, work = list_landing(spark, landing), work_dir(spark)
    try:
        now = F.unix_micros(F.current_timestamp()).alias("round")
        changes = file_changes(listing.files, known_files(spark, checkpoint))
        # Written, so that the ledger gets the changes that were looked at.
        seen = written(changes.select("path", "dt", "length", "modified", "gone", now), work)
        dates = sorted(r["dt"] for r in seen.select("dt").distinct().collect())
        here = [d for d in dates if d in listing.by_date]
        if here:
            run = run_batches(
                spark,
                landing,
                zones,
                dates=here,
                expected=expected,
                history=history,
                verdicts=verdicts,
                rules=rules,
                limits=limits,
                strict=strict,
                gate=gate,
                baseline=baseline,
                listing=_only(listing, here),
            )
            if on_batch is not None:
                on_batch(run)
        if dates:
            seen.write.mode("append").parquet(f"{checkpoint}/ledger")
    finally:
        release(spark, work)


def _only(listing: Listing, dates: Sequence[str]) -> Listing:
    by_date = {d: listing.by_date[d] for d in dates}
    return Listing(listing.root, listing.files.where(F.col("dt").isin(*dates)), by_date)


def follow(
    spark: SparkSession, landing: str, zones: Zones, checkpoint: str, *, every: str = "5 minutes", **options: object
) -> StreamingQuery:
    """Pick up as files land: a stream of new files wakes :func:`run_available_now`, whose parameters ``options`` are.

    The stream only says that something has landed; the ledger decides what is processed, so a micro-batch that is
    repeated does nothing twice.  Changed files are picked up when the next new file lands.
    """

    def process(_rows: DataFrame, _round: int) -> None:
        run_available_now(spark, landing, zones, checkpoint, **options)

    return (
        spark.readStream.format("binaryFile")
        .schema(_LISTING)
        .option("recursiveFileLookup", True)
        .load(landing)
        .select("path")
        .writeStream.foreachBatch(process)
        .option("checkpointLocation", f"{checkpoint}/stream")
        .trigger(processingTime=every)
        .start()
    )
