"""Which run's outputs count for each batch: written last, joined by every reader.

A run writes its outputs below folders of its own (``dt=<date>/run=<run>``), which nobody
reads yet, and then one commit: the whole manifest of the feed, one row per date, as one
file.  So a run that ends early leaves readers with what was there before; a batch that has
no rows for a zone any more, or that is published or withdrawn by another decision, is a
changed row and no data is rewritten or moved.

There is at most one row per calendar date of a feed, so the driver holds them all.
"""

from __future__ import annotations

import time
from collections.abc import Iterable, Sequence
from dataclasses import asdict, dataclass, replace

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.types import StructType

from dqgate.functions.files import delete, names
from dqgate.operators.route import PUBLISHABLE
from dqgate.schema import CURATED, EVALUATED, MANIFEST, QUARANTINE, REPORT
from dqgate.sources.zones import Zones

#: Commits that are kept for readers that began before the last one.
COMMITS_KEPT = 5


@dataclass(frozen=True)
class Entry:
    """What counts for one batch.  ``data_id`` tells deliveries of its files apart."""

    source_date: str
    data_id: int | None = None
    data_run: str | None = None
    report_run: str | None = None
    decision_run: str | None = None
    failure_run: str | None = None
    valid_count: int = 0
    invalid_count: int = 0
    decision: str | None = None
    final_decision: str | None = None
    gated: bool = False
    reviewed: bool = False

    @property
    def published(self) -> bool:
        return not self.gated or self.final_decision in PUBLISHABLE


def _commits(spark: SparkSession, zones: Zones) -> list[tuple[int, str]]:
    """Complete commits, newest first.  A commit is one file, so it is there as a whole or not at all."""
    found = [(int(n.name.split("=")[1]), n.path) for n in names(spark, zones.manifest) if n.name.startswith("commit=")]
    return [(k, path) for k, path in sorted(found, reverse=True) if any(f.name.startswith("part-") for f in names(spark, path))]


def committed(spark: SparkSession, zones: Zones) -> dict[str, Entry]:
    """The newest manifest, by date."""
    commits = _commits(spark, zones)
    if not commits:
        return {}
    rows = spark.read.schema(MANIFEST).parquet(commits[0][1]).collect()
    return {row["source_date"]: Entry(**row.asDict()) for row in rows}


def commit(spark: SparkSession, zones: Zones, changed: Iterable[Entry]) -> dict[str, Entry]:
    """Put ``changed`` into the newest manifest, as a new commit; an error when another run has just done so."""
    entries = committed(spark, zones) | {e.source_date: e for e in changed}
    number = max((int(n.name.split("=")[1]) for n in names(spark, zones.manifest) if n.name.startswith("commit=")), default=0) + 1
    rows = spark.createDataFrame([tuple(asdict(entries[d]).values()) for d in sorted(entries)], MANIFEST)
    rows.coalesce(1).write.mode("error").parquet(f"{zones.manifest}/commit={number:012d}")
    for _, path in _commits(spark, zones)[COMMITS_KEPT:]:
        delete(spark, path)
    return entries


def vacuum(spark: SparkSession, zones: Zones, older_than_hours: float = 24.0) -> int:
    """Remove outputs of runs that no kept commit has any use for; the number of folders removed.

    Younger folders stay, as a run may be about to commit them.
    """
    used = set()
    for _, path in _commits(spark, zones):
        for row in spark.read.schema(MANIFEST).parquet(path).collect():
            runs = (row["data_run"], row["report_run"], row["decision_run"], row["failure_run"])
            used |= {(row["source_date"], run) for run in runs if run}
    before, removed = time.time() * 1000 - older_than_hours * 3_600_000, 0
    for zone in zones.outputs:
        for day in names(spark, zone):
            for run in names(spark, day.path) if day.name.startswith("dt=") else ():
                key = (day.name[3:], run.name.removeprefix("run="))
                if run.name.startswith("run=") and key not in used and run.modified_ms < before:
                    delete(spark, run.path)
                    removed += 1
    return removed


# -- outputs of runs ----------------------------------------------------------


def write_run(rows: DataFrame, path: str, run: str, fmt: str, **options: object) -> None:
    """``rows`` (with ``dt``) below ``dt=<date>/run=<run>``.

    Nobody reads them before the commit, so tasks may move their files into place themselves.
    """
    out = rows.withColumn("run", F.lit(run))
    options["mapreduce.fileoutputcommitter.algorithm.version"] = 2
    out.write.mode("append").options(**options).partitionBy("dt", "run").format(fmt).save(path)


def _folders(path: str, wanted: Iterable[tuple[str, str | None]]) -> list[str]:
    return [f"{path}/dt={date}/run={run}" for date, run in sorted(w for w in wanted if w[1])]


def _read(spark: SparkSession, fmt: str, schema: StructType, base: str, folders: list[str], **options: object) -> DataFrame:
    """The rows of ``folders``, and of nothing else."""
    if not folders:
        return spark.createDataFrame([], schema)
    # Naming dt in the schema keeps it text instead of an inferred date.
    return spark.read.schema(schema).options(basePath=base, **options).format(fmt).load(folders).select(*schema.names)


def _of(entries: dict[str, Entry], dates: Sequence[str] | None) -> list[Entry]:
    return [e for d, e in entries.items() if dates is None or d in dates]


class Committed:
    """The tables of a feed as of its newest commit, or of the ``entries`` given."""

    def __init__(self, spark: SparkSession, zones: Zones, entries: dict[str, Entry] | None = None) -> None:
        self.spark, self.zones = spark, zones
        self.entries = committed(spark, zones) if entries is None else entries

    def curated(self, dates: Sequence[str] | None = None) -> DataFrame:
        """Rows of the published batches."""
        wanted = [(e.source_date, e.data_run) for e in _of(self.entries, dates) if e.published and e.valid_count]
        return _read(self.spark, "parquet", CURATED, self.zones.curated, _folders(self.zones.curated, wanted))

    def pending(self, dates: Sequence[str] | None = None) -> DataFrame:
        """Valid rows of the batches that the gate holds back."""
        wanted = [(e.source_date, e.data_run) for e in _of(self.entries, dates) if not e.published and e.valid_count]
        return _read(self.spark, "parquet", CURATED, self.zones.curated, _folders(self.zones.curated, wanted))

    def quarantine(self, dates: Sequence[str] | None = None) -> DataFrame:
        wanted = [(e.source_date, e.data_run) for e in _of(self.entries, dates) if e.invalid_count]
        return _read(self.spark, "parquet", QUARANTINE, self.zones.quarantine, _folders(self.zones.quarantine, wanted))

    def reports(self, dates: Sequence[str] | None = None) -> DataFrame:
        wanted = [(e.source_date, e.report_run) for e in _of(self.entries, dates)]
        return _read(self.spark, "json", REPORT, self.zones.reports, _folders(self.zones.reports, wanted), multiLine=True)

    def evaluated(self, dates: Sequence[str] | None = None) -> DataFrame:
        wanted = [(e.source_date, e.decision_run) for e in _of(self.entries, dates)]
        folders = _folders(self.zones.evaluated, wanted)
        return _read(self.spark, "json", EVALUATED, self.zones.evaluated, folders, multiLine=True)

    def alerts(self, dates: Sequence[str] | None = None) -> DataFrame:
        """``source_date, subject, message`` of the batches that did not simply pass."""
        chosen = [e for e in _of(self.entries, dates) if e.final_decision not in (None, "ALLOW")]
        return self._messages(self.zones.alerts, ((e.source_date, e.decision_run) for e in chosen), "subject", "message")

    def failures(self, dates: Sequence[str] | None = None) -> DataFrame:
        """``source_date, subject, message`` of the dates whose last run did not get to a decision."""
        wanted = ((e.source_date, e.failure_run) for e in _of(self.entries, dates))
        return self._messages(self.zones.failures, wanted, "subject", "message")

    def reviews(self, dates: Sequence[str] | None = None) -> DataFrame:
        """The stored review queue: batches whose rule decision is worth a review."""
        chosen = [e for e in _of(self.entries, dates) if e.decision not in (None, "ALLOW")]
        texts = ("decision", "reasons_text", "metrics_json", "request_text")
        return self._messages(self.zones.reviews, ((e.source_date, e.decision_run) for e in chosen), *texts)

    def _messages(self, path: str, wanted: Iterable[tuple[str, str | None]], *columns: str) -> DataFrame:
        schema = StructType.fromDDL(", ".join(f"{c} string" for c in ("source_date", *columns)))
        return _read(self.spark, "json", schema, path, _folders(path, wanted))

    def verdicts(self, dates: Sequence[str] | None = None) -> DataFrame:
        """``dt, verdict_text``: reviews of the data that the batches have now."""
        chosen = [e for e in _of(self.entries, dates) if e.reviewed]
        schema = StructType.fromDDL("dt string, data_id bigint, verdict_text string")
        folders = [f"{self.zones.verdicts}/dt={e.source_date}" for e in chosen]
        stored = _read(self.spark, "parquet", schema, self.zones.verdicts, folders)
        now = self.spark.createDataFrame([(e.source_date, e.data_id) for e in chosen], "now string, _id bigint")
        same = (F.col("dt") == F.col("now")) & F.col("data_id").eqNullSafe(F.col("_id"))
        return stored.join(now, same, "left_semi").select("dt", "verdict_text").distinct()


__all__ = ["Committed", "Entry", "commit", "committed", "replace", "vacuum", "write_run"]
