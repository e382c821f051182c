"""The whole job: landing files to curated, quarantine, reports, decisions, alerts."""

from __future__ import annotations

import uuid
from collections.abc import Iterable, Sequence
from dataclasses import dataclass
from datetime import datetime, timezone

from pyspark.sql import DataFrame, Row, SparkSession, functions as F

from dqgate.functions.jobs import together
from dqgate.functions.lineage import release, work_dir, written
from dqgate.operators.classify import classify, curated, quarantine
from dqgate.operators.decide import (
    decide,
    evaluated,
    merge_verdicts,
    review_queue,
    with_baseline,
    without_review,
)
from dqgate.operators.metrics import quality_report
from dqgate.operators.route import alerts, failure_alerts, route
from dqgate.operators.rules import Rule, retail_rules
from dqgate.schema import DEFAULTS, LANDING_FILE, REPORT, Thresholds
from dqgate.sources.landing import (
    Listing,
    list_landing,
    missing_batches,
    read_landing,
    require_min_rows,
    undersized_counts,
    without_batches,
)
from dqgate.sources.manifest import Committed, Entry, commit, committed, replace, write_run
from dqgate.sources.tables import MAX_RECORDS_PER_FILE
from dqgate.sources.zones import Zones


@dataclass(frozen=True)
class BatchRun:
    """``final`` has one row per batch with its decision and end state, also of those decided again."""

    final: DataFrame
    alerts: DataFrame
    failures: DataFrame


def new_run() -> str:
    """A name for the outputs of one run; later runs sort after earlier ones."""
    return f"{datetime.now(timezone.utc):%Y%m%dT%H%M%S}-{uuid.uuid4().hex[:8]}"


def run_batches(
    spark: SparkSession,
    landing: str,
    zones: Zones,
    *,
    dates: Sequence[str] | None = None,
    expected: DataFrame | None = None,
    history: DataFrame | None = None,
    verdicts: DataFrame | None = None,
    rules: Sequence[Rule] | None = None,
    limits: Thresholds = DEFAULTS,
    strict: bool = True,
    gate: bool = False,
    baseline: str = "previous",
    listing: Listing | None = None,
) -> BatchRun:
    """Process the batches under ``landing``, or only those of ``dates``.

    One listing of the landing files picks what is read and feeds the guard, the missing check
    and the reports.  The text is parsed once: the classified rows go to a Parquet table in
    the shared working folder, and the report and both outputs read from it only the columns
    they need.  The table also means that a lost executor costs a re-read of some files, not
    a re-run of the job.

    All outputs go to folders of this run and count from the commit of the manifest on, which is
    the last step; a run that ends before it changes nothing for readers.

    ``strict`` raises on an undersized batch before any rows are written; otherwise
    such batches are left out.  Either way they are stored as failures, as are
    ``expected`` dates nothing has landed for.  Previous rates come from ``history``,
    by default the stored reports next to the batches; the stored batch that follows a processed
    one is decided again.  Reviews are kept, and count as long as the files they are about
    have not changed.  With ``gate``, only batches that are let out are published; rows of the others
    are pending, and a later decision publishes or withdraws them without moving any.
    """
    run, work = new_run(), work_dir(spark)
    rules = retail_rules(limits) if rules is None else list(rules)
    listing = list_landing(spark, landing, None if dates is None else list(dates)) if listing is None else listing
    landed = listing.batches()
    before = committed(spark, zones)
    try:
        rows = read_landing(spark, landing, dates, listing=listing)
        staged = written(classify(rows, rules).drop(LANDING_FILE), f"{work}/classified")
        counted = written(quality_report(staged, limits, rules, landed), f"{work}/counted")

        counts = counted.select(F.col("source_date").alias("dt"), "raw_count")
        small = undersized_counts(counts, limits.min_rows, landed).collect()
        missing = [] if expected is None else missing_batches(expected, landed).collect()
        undersized = spark.createDataFrame(small, "dt string, raw_count bigint, min_rows bigint")
        failures = failure_alerts(spark.createDataFrame(missing, "dt string"), undersized)
        failing = [replace(before.get(r["dt"], Entry(r["dt"])), failure_run=run) for r in (*missing, *small)]
        if failing:
            write_run(failures.withColumn("dt", F.col("source_date")), zones.failures, run, "json")
        if strict and small:
            commit(spark, zones, failing)
            require_min_rows(undersized)

        good, reports = staged, counted
        if small:
            good = without_batches(staged, undersized, f"{work}/small")
            reports = counted.where(~F.col("source_date").isin(*[r["dt"] for r in small]))
        processed = sorted({*listing.by_date} - {r["dt"] for r in small})
        around = _around(processed, [d for d, e in before.items() if e.report_run])
        if history is None and baseline == "previous":
            history = Committed(spark, zones, before).reports(around)
        reports = with_baseline(reports, history, baseline, refresh=True)
        delivered = {
            d: replace(before.get(d, Entry(d)), data_id=listing.by_date[d].data_id, data_run=run, failure_run=None, gated=gate)
            for d in processed
        }
        entries = before | delivered

        def store(rows: DataFrame, zone: str) -> None:
            # Adaptive execution splits a large batch over many tasks and merges small ones.
            rows = rows.hint("rebalance", F.col("dt"))
            write_run(rows, zone, run, "parquet", maxRecordsPerFile=MAX_RECORDS_PER_FILE)

        _, _, (final, decided) = together(
            spark,
            lambda: store(curated(good), zones.curated),
            lambda: store(quarantine(good), zones.quarantine),
            lambda: _evaluate(reports, zones, entries, [*processed, *around], verdicts, limits, run, work),
        )
        commit(spark, zones, [*failing, *decided])
    finally:
        release(spark, work)
    return BatchRun(final, alerts(final), failures)


def evaluate_batches(
    spark: SparkSession,
    zones: Zones,
    *,
    dates: Sequence[str] | None = None,
    verdicts: DataFrame | None = None,
    limits: Thresholds = DEFAULTS,
    reports: DataFrame | None = None,
) -> DataFrame:
    """Decide on stored reports alone, all of them or those of ``dates``, or on the ``reports`` given.

    Batches are published or withdrawn by what comes out.
    """
    run, work = new_run(), work_dir(spark)
    before = committed(spark, zones)
    try:
        rows = Committed(spark, zones, before).reports(dates) if reports is None else reports
        if reports is not None and dates is not None:
            rows = rows.where(F.col("source_date").isin(*dates))
        final, decided = _evaluate(rows, zones, before, dates, verdicts, limits, run, work)
        commit(spark, zones, decided)
        return final
    finally:
        release(spark, work)


def _around(dates: Sequence[str], stored: Sequence[str]) -> list[str]:
    """Of each of ``dates`` the stored date before and the one after it, where they are not among ``dates``."""
    from bisect import bisect_left, bisect_right

    others = sorted({*stored} - {*dates})
    found = set()
    for date in dates:
        at = bisect_left(others, date)
        found |= {*others[max(at - 1, 0) : at], *others[bisect_right(others, date) :][:1]}
    return sorted(found)


def _evaluate(
    reports: DataFrame,
    zones: Zones,
    entries: dict[str, Entry],
    dates: Sequence[str] | None,
    verdicts: DataFrame | None,
    limits: Thresholds,
    run: str,
    work: str,
) -> tuple[DataFrame, list[Entry]]:
    """Decisions on ``reports`` (of ``dates``), stored for ``run`` but not committed, and the entries they make.

    The decisions are written once; reports, messages and entries are made from that.
    """
    spark = reports.sparkSession
    some = any(e.reviewed for d, e in entries.items() if dates is None or d in dates)
    reviews = Committed(spark, zones, entries).verdicts(dates) if some else None
    reviewed = set()
    if verdicts is not None:
        verdicts = written(verdicts.select("dt", "verdict_text"), f"{work}/verdicts")
        reviewed = _store_verdicts(verdicts, reviews, zones, entries)
        reviews = verdicts if reviews is None else reviews.unionByName(verdicts)
    decisions = decide(reports, limits)
    final = without_review(decisions) if reviews is None else merge_verdicts(decisions, reviews)
    final = written(route(final), f"{work}/final")
    keys = ("source_date", "decision", "final_decision", "valid_count", "invalid_count")
    rows = final.select(*keys).collect()  # one per date
    dated = final.withColumn("dt", F.col("source_date")).repartition(min(64, 1 + len(rows) // 8), "dt")
    # Read back as whole files, pretty-printed or not: one object in each.
    one = {"ignoreNullFields": False, "maxRecordsPerFile": 1}
    with_date = {"dt": F.col("source_date")}
    jobs = [
        lambda: write_run(dated.select(*REPORT.names, "dt"), zones.reports, run, "json", **one),
        lambda: write_run(evaluated(dated).withColumns(with_date), zones.evaluated, run, "json", **one),
    ]
    if any(r["final_decision"] != "ALLOW" for r in rows):
        jobs.append(lambda: write_run(alerts(final).withColumns(with_date), zones.alerts, run, "json"))
    if any(r["decision"] != "ALLOW" for r in rows):
        queue = review_queue(final).drop("metrics_summary").withColumns(with_date)
        jobs.append(lambda: write_run(queue, zones.reviews, run, "json"))
    if rows:
        together(spark, *jobs)
    return _kept(final), _entries(rows, entries, reviewed, run)


def _entries(rows: Iterable[Row], entries: dict[str, Entry], reviewed: set[str], run: str) -> list[Entry]:
    return [
        replace(
            entries.get(r["source_date"], Entry(r["source_date"])),
            report_run=run,
            decision_run=run,
            valid_count=r["valid_count"] or 0,
            invalid_count=r["invalid_count"] or 0,
            decision=r["decision"],
            final_decision=r["final_decision"],
            reviewed=r["source_date"] in reviewed or entries.get(r["source_date"], Entry("")).reviewed,
        )
        for r in rows
    ]


def _store_verdicts(verdicts: DataFrame, stored: DataFrame | None, zones: Zones, entries: dict[str, Entry]) -> set[str]:
    """Add the verdicts that are not stored yet, for the data the batches have now; the dates that got any."""
    spark = verdicts.sparkSession
    now = spark.createDataFrame([(e.source_date, e.data_id) for e in entries.values()], "dt string, data_id bigint")
    new = verdicts.where(F.col("verdict_text").isNotNull()).distinct()
    if stored is not None:
        new = new.join(stored, ["dt", "verdict_text"], "left_anti")
    new = new.join(now, "dt")
    dates = {r["dt"] for r in new.select("dt").distinct().collect()}
    if dates:
        new.repartition("dt").write.mode("append").partitionBy("dt").parquet(zones.verdicts)
    return dates


def _kept(rows: DataFrame) -> DataFrame:
    """A table of one row per date at most, apart from the working folder."""
    return rows.sparkSession.createDataFrame(rows.collect(), rows.schema)
