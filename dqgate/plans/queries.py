"""The registered queries: every operator over the given tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from dqgate.functions.lineage import work_dir
from dqgate.operators import classify as cl, decide as de, metrics as me, route as ro
from dqgate.operators.rules import CRITICAL, WARNING, Rule
from dqgate.plans.batch import evaluate_batches, run_batches
from dqgate.schema import RAW_COLUMNS, Thresholds
from dqgate.sources import landing as la
from dqgate.sources.manifest import Committed
from dqgate.sources.reports import read_reports, write_reports
from dqgate.sources.tables import read_curated, write_curated
from dqgate.sources.zones import Zones
from dqgate.streaming.pickup import run_available_now

# Landing rows from the events table, with faults added by key arithmetic.  The text
# runs unchanged in Spark and DuckDB.
LANDING_SQL = """
WITH b AS (SELECT event_id AS k, user_id AS u, value AS v, CAST(ts AS STRING) AS t,
                  CAST(substr(CAST(ts AS STRING), 9, 2) AS INT) % 8 AS sc FROM {events})
SELECT
  CASE WHEN sc IN (3,0) AND k % 23 = 0 THEN NULL
       WHEN sc IN (3,0) AND k % 29 = 0 THEN '  '
       WHEN sc = 2 AND k % 33 = 0 THEN 'TXN' || CAST(k - 1 AS STRING)
       ELSE 'TXN' || CAST(k AS STRING) END AS transactionid,
  CASE WHEN sc IN (3,0) AND k % 47 = 0 THEN 'not-a-timestamp'
       WHEN sc = 6 AND k % 28 = 0 THEN NULL
       ELSE replace(substr(t, 1, 19), ' ', 'T') END AS transactionts,
  CASE WHEN sc = 1 AND k % 13 = 0 THEN NULL
       WHEN k % 331 = 0 THEN '  ' ELSE 'STORE_' || CAST(u % 50 + 1 AS STRING) END AS storeid,
  CASE WHEN sc = 1 AND k % 13 IN (5, 9) THEN NULL ELSE 'PROD_' || CAST(k % 200 + 1 AS STRING) END AS productid,
  CASE WHEN sc IN (3,0) AND k % 25 = 0 THEN 'NOT_A_NUMBER'
       WHEN sc IN (3,0) AND k % 41 = 0 THEN '-1.5'
       WHEN sc = 4 AND k % 15 = 0 THEN '9999.5'
       ELSE CAST(v AS STRING) END AS amount,
  CASE WHEN sc IN (3,0) AND k % 37 = 0 THEN '0'
       WHEN sc IN (3,0) AND k % 43 = 0 THEN NULL
       WHEN k % 101 = 0 THEN '75'
       WHEN k % 7 = 0 THEN '5.0'
       ELSE CAST(k % 9 + 1 AS STRING) END AS quantity,
  substr(t, 1, 10) AS dt
FROM b
"""

# A verdict text per batch, by day of month modulo 7: severe, fenced, milder than the
# rules, not JSON, unknown decision, followed by other text, and none at all.
VERDICT_SQL = """
SELECT dt, CASE CAST(substr(dt, 9, 2) AS INT) % 7
  WHEN 0 THEN '{{"final_decision":"QUARANTINE","reasoning":"severe","recommended_actions":["stop","call"]}}'
  WHEN 1 THEN 'Here it is:' || chr(10) || '```json' || chr(10)
              || '{{"final_decision":"ESCALATE","reasoning":"fenced"}}' || chr(10) || '```' || chr(10) || 'Done.'
  WHEN 2 THEN '{{"final_decision":"ALLOW","reasoning":"milder"}}'
  WHEN 3 THEN 'not json'
  WHEN 4 THEN '{{"final_decision":"MAYBE","reasoning":"unknown"}}'
  WHEN 5 THEN '{{"final_decision":"QUARANTINE","reasoning":"r"}} and more'
  END AS verdict_text
FROM {batches} GROUP BY dt
"""

# A part of the rows, the same in both engines.
_LATE = "coalesce(length(transactionid) % 2, 0) = 0"

# Batches at the test scale factors are far below the default minimum.
NO_GUARD = Thresholds(min_rows=0)
# Limits that split the test rows differently from the defaults.
OTHER_LIMITS = Thresholds(min_rows=0, amount_min=20.0, quantity_min=3, max_invalid_rate=0.4, max_warning_rate=0.02)


def mean_rows(rows: DataFrame) -> int:
    """Rows of an average batch: a minimum that some batches of any table are below."""
    number, batches = rows.agg(F.count("*"), F.countDistinct("dt")).first()
    return number // max(1, batches)


def landing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.sql(LANDING_SQL, events=spark.read.parquet(f"{sf_dir}/events.parquet"))


def classified(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cl.classify(landing(spark, sf_dir))


def report(spark: SparkSession, sf_dir: str) -> DataFrame:
    return me.quality_report(classified(spark, sf_dir))


def decided(spark: SparkSession, sf_dir: str) -> DataFrame:
    return de.decide(de.with_baseline(report(spark, sf_dir)))


def reviewed(spark: SparkSession, sf_dir: str) -> DataFrame:
    batches = landing(spark, sf_dir).select("dt")
    return de.merge_verdicts(decided(spark, sf_dir), spark.sql(VERDICT_SQL, batches=batches))


def _zoneless(rows: DataFrame, *names: str) -> DataFrame:
    """Timestamps as wall-clock values, the form the SQL side has."""
    return rows.withColumns({name: F.col(name).cast("timestamp_ntz") for name in names})


def _joined(name: str) -> Column:
    return F.array_join(name, ",").alias(name.lstrip("_"))


# -- rows ---------------------------------------------------------------------


def typed_rows(spark, sf_dir):
    return _zoneless(cl.typed(landing(spark, sf_dir)), "transactionts_parsed")


def reason_codes(spark, sf_dir):
    rows = classified(spark, sf_dir)
    return rows.select(*RAW_COLUMNS, "dt", _joined("_reasons"), _joined("_warn_reasons"))


def _split(pick: Callable[[DataFrame], DataFrame]):
    def query(spark, sf_dir):
        rows = pick(classified(spark, sf_dir))
        return rows.select(*RAW_COLUMNS, "dt", _joined("_reasons"), _joined("_warn_reasons"))

    return query


def curated(spark, sf_dir):
    return _zoneless(cl.curated(classified(spark, sf_dir)), "transactionts")


def quarantine(spark, sf_dir):
    return _zoneless(cl.quarantine(classified(spark, sf_dir)), "transactionts_parsed")


LINEITEM_RULES = {
    "missing_order": (CRITICAL, "l_orderkey IS NULL"),
    "returned": (CRITICAL, "l_returnflag = 'R'"),
    "low_price": (CRITICAL, "l_extendedprice < 5000"),
    "high_discount": (WARNING, "l_discount > 0.08"),
    "untaxed": (WARNING, "l_tax = 0"),
}


def _lineitem(spark, sf_dir):
    rules = [Rule(code, severity, sql) for code, (severity, sql) in LINEITEM_RULES.items()]
    return cl.tag(spark.read.parquet(f"{sf_dir}/lineitem.parquet"), rules)


def lineitem_rules(spark, sf_dir):
    return _lineitem(spark, sf_dir).select(
        "l_orderkey", "l_linenumber", "l_partkey", _joined("_reasons"), _joined("_warn_reasons")
    )


def lineitem_duplicates(spark, sf_dir):
    return me.duplicate_ids(
        spark.read.parquet(f"{sf_dir}/lineitem.parquet"), "l_orderkey", "l_linenumber"
    )


# -- metrics ------------------------------------------------------------------


def base_metrics(spark, sf_dir):
    return me.base_metrics(classified(spark, sf_dir))


def duplicate_ids(spark, sf_dir):
    return me.duplicate_ids(cl.valid(classified(spark, sf_dir)), "dt", "transactionid")


def duplicate_rows(spark, sf_dir):
    return me.duplicate_rows(cl.valid(classified(spark, sf_dir)))


def anomaly_rows(spark, sf_dir):
    rows = classified(spark, sf_dir).withColumns(
        {"high_amount": F.coalesce(me.high_amount(), F.lit(False)),
         "high_quantity": F.coalesce(me.high_quantity(), F.lit(False))}
    )
    return rows.where("high_amount OR high_quantity").select(
        *RAW_COLUMNS, "dt", "high_amount", "high_quantity"
    )


def invalid_breakdown(spark, sf_dir):
    return me.reason_breakdown(cl.invalid(classified(spark, sf_dir)), "_reasons")


def warning_breakdown(spark, sf_dir):
    return me.reason_breakdown(cl.warned(classified(spark, sf_dir)), "_warn_reasons")


def dominant_reason(spark, sf_dir):
    return me.dominant_reason(invalid_breakdown(spark, sf_dir))


# Everything in a report but its maps, structs and processing time.
SCALARS = (
    "source_date",
    "batch_status",
    "raw_count",
    "valid_count",
    "invalid_count",
    "warning_count",
    "invalid_rate",
    "warning_rate",
    "dominant_invalid_reason",
    "duplicate_transactionid_rows_total",
    "anomaly_high_amount_count",
    "anomaly_high_amount_rate",
    "anomaly_high_quantity_count",
    "anomaly_high_quantity_rate",
    "amount_min",
    "amount_max",
    "amount_avg",
    "quantity_min",
    "quantity_max",
    "quantity_avg",
)


def quality_report(spark, sf_dir):
    return report(spark, sf_dir).select(*SCALARS, "thresholds.*")


def report_breakdowns(spark, sf_dir):
    maps = F.map_concat("invalid_reason_breakdown", "warning_reason_breakdown")
    return report(spark, sf_dir).select("source_date", F.explode(maps).alias("reason", "n"))


# -- decisions ----------------------------------------------------------------


def report_baseline(spark, sf_dir):
    return de.with_baseline(report(spark, sf_dir)).select(
        "source_date", "invalid_rate", "warning_rate", "previous_invalid_rate", "previous_warning_rate"
    )


def decisions(spark, sf_dir):
    return decided(spark, sf_dir).select(
        "source_date",
        "decision",
        "decision_rank",
        F.col("metrics_summary.duplicate_rate").alias("duplicate_rate"),
        F.col("metrics_summary.anomaly_amount_rate").alias("anomaly_amount_rate"),
    )


def decision_reasons(spark, sf_dir):
    return decided(spark, sf_dir).select(
        "source_date", F.array_join("decision_reasons", " | ").alias("reasons")
    )


def missing_metrics(spark, sf_dir):
    """Decisions on reports that lack metrics: what a report does not have counts as 0."""
    lacking = F.substring("source_date", 9, 2).cast("int") % 3
    names = (("invalid_rate", "previous_invalid_rate"), ("warning_rate", "duplicate_transactionid_rows_total"),
             ("anomaly_high_amount_rate", "valid_count"))
    reports = de.with_baseline(report(spark, sf_dir)).withColumns(
        {name: F.when(lacking != i, F.col(name)) for i, pair in enumerate(names) for name in pair}
    )
    return de.decide(reports).select(
        "source_date", "decision", "metrics_summary.*", F.array_join("decision_reasons", " | ").alias("reasons")
    )


def fired_rules(spark, sf_dir):
    return de.fired_rules(decided(spark, sf_dir))


def review_queue(spark, sf_dir):
    queue = de.review_queue(decided(spark, sf_dir))
    counts = "map<string,bigint>"
    sent = F.from_json(
        "metrics_json", "source_date string, invalid_rate double, warning_rate double,"
        " duplicate_transactionid_rows_total bigint, anomaly_high_amount_rate double, previous_invalid_rate double,"
        f" dominant_invalid_reason string, invalid_reason_breakdown {counts}, warning_reason_breakdown {counts},"
        " raw_count bigint, valid_count bigint"
    )

    def text(name: str) -> Column:
        entries = F.array_sort(F.map_entries(F.col(f"_sent.{name}")))
        return F.array_join(
            F.transform(entries, lambda e: F.concat(e["key"], F.lit("="), e["value"].cast("string"))), ","
        ).alias(name)

    return queue.withColumn("_sent", sent).select(
        "source_date",
        "decision",
        "reasons_text",
        F.col("_sent.source_date").alias("sent_date"),
        *[f"_sent.{name}" for name in (
            "invalid_rate", "warning_rate", "duplicate_transactionid_rows_total", "anomaly_high_amount_rate",
            "previous_invalid_rate", "dominant_invalid_reason", "raw_count", "valid_count",
        )],
        text("invalid_reason_breakdown"),
        text("warning_reason_breakdown"),
        # The request around the metrics, which are checked by field above.
        F.substring_index("request_text", "Metrics: ", 1).alias("request"),
        F.endswith("request_text", "metrics_json").alias("request_has_metrics"),
    )


def verdict_merge(spark, sf_dir):
    return reviewed(spark, sf_dir).select(
        "source_date",
        "decision",
        "final_decision",
        "agent_reasoning",
        F.array_join("agent_actions", ",").alias("agent_actions"),
    )


# -- routing and guards -------------------------------------------------------


def routes(spark, sf_dir):
    final = ro.route(de.without_review(decided(spark, sf_dir)))
    return final.select("source_date", "final_decision", "terminal_state")


def alerts(spark, sf_dir):
    final = de.without_review(decided(spark, sf_dir))
    return ro.alerts(final)


def _missing(spark, sf_dir):
    """Landed dates against the full calendar months they fall in."""
    landed = landing(spark, sf_dir).select("dt").distinct()
    span = landed.agg(
        F.trunc(F.min("dt"), "month").alias("first"), F.last_day(F.max("dt")).alias("last")
    )
    days = F.sequence("first", "last").cast("array<string>")
    expected = span.select(F.explode(days).alias("dt"))
    return la.missing_batches(expected, landed)


def missing_batches(spark, sf_dir):
    return _missing(spark, sf_dir)


def undersized_batches(spark, sf_dir):
    rows = landing(spark, sf_dir)
    return la.undersized_batches(rows, mean_rows(rows))


def guarded_rows(spark, sf_dir):
    rows = landing(spark, sf_dir)
    return la.without_batches(rows, la.undersized_batches(rows, mean_rows(rows)))


def failure_alerts(spark, sf_dir):
    rows = landing(spark, sf_dir)
    undersized = la.undersized_batches(rows, mean_rows(rows))
    return ro.failure_alerts(_missing(spark, sf_dir), undersized)


def publish_gate(spark, sf_dir):
    rows = cl.curated(classified(spark, sf_dir))
    final = de.without_review(decided(spark, sf_dir))
    return _zoneless(ro.publish_gate(rows, final), "transactionts")


# -- sources and sinks --------------------------------------------------------


def _land(spark, sf_dir, base: str) -> str:
    """The landing rows as CSV files, spaces and NULLs intact."""
    path = f"{base}/landing/transactions"
    _write_landing(landing(spark, sf_dir), path)
    return path


def _write_landing(rows: DataFrame, path: str, mode: str = "error") -> None:
    (
        rows.hint("rebalance", F.col("dt"))
        .write.mode(mode).partitionBy("dt")
        .option("header", True)
        .option("ignoreLeadingWhiteSpace", False)
        .option("ignoreTrailingWhiteSpace", False)
        .csv(path)
    )


def csv_roundtrip(spark, sf_dir):
    return la.read_landing(spark, _land(spark, sf_dir, work_dir(spark)))


def landed_batches(spark, sf_dir):
    path = _land(spark, sf_dir, work_dir(spark))
    return la.landed_batches(spark, path).select("dt")


def report_roundtrip(spark, sf_dir):
    path = work_dir(spark) + "/quality-reports"
    write_reports(report(spark, sf_dir), path)
    return read_reports(spark, path).select(*SCALARS)


def curated_overwrite(spark, sf_dir):
    """Write all batches, then again those of the first ten days: nothing is lost or doubled."""
    path = work_dir(spark) + "/curated"
    rows = cl.curated(classified(spark, sf_dir))
    write_curated(rows, path)
    write_curated(rows.where(F.substring("dt", 9, 2) <= "10"), path)
    return _zoneless(read_curated(spark, path), "transactionts")


def _run(spark, sf_dir) -> Zones:
    base = work_dir(spark)
    zones = Zones(base)
    run_batches(spark, _land(spark, sf_dir, base), zones, limits=NO_GUARD)
    return zones


def batch_run(spark, sf_dir):
    """The whole job from CSV files; its decisions as stored."""
    return _stored(spark, _run(spark, sf_dir))


def _stored(spark, zones):
    return Committed(spark, zones).evaluated().select(
        "source_date", "batch_status", "raw_count", "invalid_count", "previous_invalid_rate",
        F.array_join("decision_reasons", " | ").alias("reasons"),
    )


def batch_run_guarded(spark, sf_dir):
    """The whole job, leaving out batches below the mean: stored decisions and stored failures."""
    base = work_dir(spark)
    zones, rows = Zones(base), landing(spark, sf_dir)
    limits = Thresholds(min_rows=mean_rows(rows))
    run_batches(spark, _land(spark, sf_dir, base), zones, limits=limits, strict=False)
    failed = Committed(spark, zones).failures()
    return _stored(spark, zones).select("source_date", F.lit("decision").alias("kind"), F.col("batch_status").alias("text")).unionByName(
        failed.select("source_date", F.lit("failure").alias("kind"), F.col("message").alias("text"))
    )


def batch_run_limits(spark, sf_dir):
    """The whole job with other limits for rows and batches: counts and decisions as stored."""
    base = work_dir(spark)
    zones = Zones(base)
    run_batches(spark, _land(spark, sf_dir, base), zones, limits=OTHER_LIMITS)
    return Committed(spark, zones).evaluated().select(
        "source_date", "batch_status", "invalid_count", "valid_count", "warning_count"
    )


def batch_run_gated(spark, sf_dir):
    """All batches published, then the whole job again with the gate: no row of a blocked batch is left."""
    base = work_dir(spark)
    zones, path = Zones(base), _land(spark, sf_dir, base)
    run_batches(spark, path, zones, limits=NO_GUARD)
    run_batches(spark, path, zones, limits=NO_GUARD, gate=True)
    return _zoneless(Committed(spark, zones).curated(), "transactionts")


def gate_refresh(spark, sf_dir):
    """The gate with batches in reverse pairs of days: a later first day changes what the second one is compared with.

    All even days run first, each compared with the even day before it, then all odd days: a batch that is
    blocked or let out by its new baseline is withdrawn or published without being run again.
    """
    base = work_dir(spark)
    zones, path = Zones(base), _land(spark, sf_dir, base)
    dates = sorted(r["dt"] for r in la.landed_batches(spark, path).select("dt").collect())
    for part in (dates[1::2], dates[::2]):
        run_batches(spark, path, zones, dates=part, limits=NO_GUARD, gate=True)
    return _zoneless(Committed(spark, zones).curated(), "transactionts")


def verdict_rerun(spark, sf_dir):
    """Reviews are given once; then every other day is run again, and all days are decided again: none is lowered."""
    base = work_dir(spark)
    zones, path = Zones(base), _land(spark, sf_dir, base)
    verdicts = spark.sql(VERDICT_SQL, batches=landing(spark, sf_dir).select("dt"))
    run_batches(spark, path, zones, limits=NO_GUARD, verdicts=verdicts)
    dates = sorted(r["dt"] for r in la.landed_batches(spark, path).select("dt").collect())
    run_batches(spark, path, zones, dates=dates[::2], limits=NO_GUARD)
    evaluate_batches(spark, zones)
    return Committed(spark, zones).evaluated().select(
        "source_date", "batch_status", "agent_reasoning", F.array_join("agent_actions", ",").alias("agent_actions")
    )


def flat_landing(spark, sf_dir):
    """Files with the date in their names, no date folders: with dates and expected dates given, day after day.

    No failure is stored, and the batch before is known: decisions as stored, with the failures.
    """
    base = work_dir(spark)
    zones = Zones(base)
    _write_flat(spark, landing(spark, sf_dir), zones.landing)
    dates = sorted(r["dt"] for r in la.landed_batches(spark, zones.landing).select("dt").collect())
    half = len(dates) // 2
    for part in (dates[:half], dates[half:]):
        expected = spark.createDataFrame([(d,) for d in part], "dt string")
        run_batches(spark, zones.landing, zones, dates=part, expected=expected, limits=NO_GUARD)
    done = Committed(spark, zones)
    failed = done.failures().select("source_date", F.lit("failure").alias("batch_status"))
    return _stored(spark, zones).unionByName(failed, allowMissingColumns=True)


def _write_flat(spark, rows: DataFrame, path: str) -> None:
    """Landing files named after their date, side by side in one folder."""
    folders = path + "-folders"
    _write_landing(rows, folders)
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(folders).select("path").collect()
    hadoop, conf = spark._jvm.org.apache.hadoop.fs, spark._jsc.hadoopConfiguration()
    target = hadoop.Path(path)
    system = target.getFileSystem(conf)
    system.mkdirs(target)
    for i, row in enumerate(files):
        source = hadoop.Path(row["path"])
        system.rename(source, hadoop.Path(target, f"{source.getParent().getName()}-{i}.csv"))


def batch_run_alerts(spark, sf_dir):
    """The alerts that the whole job has stored, after a second run over the same batches."""
    base = work_dir(spark)
    zones, path = Zones(base), _land(spark, sf_dir, base)
    run_batches(spark, path, zones, limits=NO_GUARD)
    run_batches(spark, path, zones, limits=NO_GUARD)
    return Committed(spark, zones).alerts()


def daily_runs(spark, sf_dir):
    """The job called three times, for the first, middle and last days; earlier reports are found by themselves."""
    base = work_dir(spark)
    zones, path = Zones(base), _land(spark, sf_dir, base)
    dates = sorted(r["dt"] for r in la.landed_batches(spark, path).select("dt").toLocalIterator())
    third = -(-len(dates) // 3)
    # The middle days come last: the day after them is decided again.
    for part in (dates[:third], dates[2 * third :], dates[third : 2 * third]):
        run_batches(spark, path, zones, dates=part, limits=NO_GUARD)
    return _stored(spark, zones)


def two_feeds(spark, sf_dir):
    """The default feed and another one, with some of its rows and the same dates, below one folder; both run twice."""
    base = work_dir(spark)
    parts = []
    for feed, rows in (("first", landing(spark, sf_dir)), ("second", landing(spark, sf_dir).where(_LATE))):
        zones = Zones(base) if feed == "first" else Zones(base, "refunds")
        _write_landing(rows, zones.landing)
        parts.append((feed, zones))
    for _, zones in (*parts, *parts):
        run_batches(spark, zones.landing, zones, limits=NO_GUARD)
    found = [_stored(spark, zones).withColumn("feed", F.lit(feed)) for feed, zones in parts]
    return found[0].unionByName(found[1]).select("feed", "source_date", "batch_status", "raw_count", "invalid_count", "previous_invalid_rate")


def stream_two_calls(spark, sf_dir):
    """Most rows first, then a second call for late files of the same dates."""
    base = work_dir(spark)
    zones, rows = Zones(base), landing(spark, sf_dir)
    for part in (rows.where(f"NOT ({_LATE})"), rows.where(_LATE)):
        _write_landing(part, zones.landing, "append")
        run_available_now(spark, zones.landing, zones, f"{base}/checkpoint", limits=NO_GUARD)
    return _stored(spark, zones)


def stream_changed_file(spark, sf_dir):
    """Three calls: some rows of each day, the same files dropped again with all rows, and nothing new."""
    base = work_dir(spark)
    zones, rows = Zones(base), landing(spark, sf_dir)
    for part in (rows.where(_LATE), rows, None):
        if part is not None:
            _write_named(spark, part, zones.landing, f"{base}/drop")
        run_available_now(spark, zones.landing, zones, f"{base}/checkpoint", limits=NO_GUARD)
    return _stored(spark, zones)


def _write_named(spark, rows: DataFrame, path: str, drop: str) -> None:
    """One file per day, under the same name each time."""
    _write_landing(rows, drop, "overwrite")
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(drop).select("path").collect()
    hadoop, conf = spark._jvm.org.apache.hadoop.fs, spark._jsc.hadoopConfiguration()
    system = hadoop.Path(path).getFileSystem(conf)
    number: dict[str, int] = {}
    for row in sorted(files, key=lambda r: r["path"]):
        source = hadoop.Path(row["path"])
        day = source.getParent().getName()
        number[day] = number.get(day, -1) + 1
        target = hadoop.Path(f"{path}/{day}/transactions-{number[day]}.csv")
        system.mkdirs(target.getParent())
        system.delete(target, False)
        system.rename(source, target)


def batch_run_quarantine(spark, sf_dir):
    """The whole job from CSV files; its quarantine table as stored."""
    return _zoneless(Committed(spark, _run(spark, sf_dir)).quarantine(), "transactionts_parsed")


def stream_available_now(spark, sf_dir):
    base = work_dir(spark)
    zones = Zones(base)
    run_available_now(
        spark, _land(spark, sf_dir, base), zones, f"{base}/checkpoint", limits=NO_GUARD
    )
    return _stored(spark, zones)


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "typed_rows": typed_rows,
    "reason_codes": reason_codes,
    "invalid_rows": _split(cl.invalid),
    "valid_rows": _split(cl.valid),
    "warning_rows": _split(cl.warned),
    "curated": curated,
    "quarantine": quarantine,
    "lineitem_rules": lineitem_rules,
    "lineitem_duplicates": lineitem_duplicates,
    "base_metrics": base_metrics,
    "duplicate_ids": duplicate_ids,
    "duplicate_rows": duplicate_rows,
    "anomaly_rows": anomaly_rows,
    "invalid_breakdown": invalid_breakdown,
    "warning_breakdown": warning_breakdown,
    "dominant_reason": dominant_reason,
    "quality_report": quality_report,
    "report_breakdowns": report_breakdowns,
    "report_baseline": report_baseline,
    "decisions": decisions,
    "decision_reasons": decision_reasons,
    "missing_metrics": missing_metrics,
    "fired_rules": fired_rules,
    "review_queue": review_queue,
    "verdict_merge": verdict_merge,
    "routes": routes,
    "alerts": alerts,
    "missing_batches": missing_batches,
    "undersized_batches": undersized_batches,
    "guarded_rows": guarded_rows,
    "failure_alerts": failure_alerts,
    "publish_gate": publish_gate,
    "csv_roundtrip": csv_roundtrip,
    "landed_batches": landed_batches,
    "report_roundtrip": report_roundtrip,
    "curated_overwrite": curated_overwrite,
    "batch_run": batch_run,
    "batch_run_quarantine": batch_run_quarantine,
    "batch_run_guarded": batch_run_guarded,
    "batch_run_limits": batch_run_limits,
    "batch_run_gated": batch_run_gated,
    "batch_run_alerts": batch_run_alerts,
    "daily_runs": daily_runs,
    "two_feeds": two_feeds,
    "gate_refresh": gate_refresh,
    "verdict_rerun": verdict_rerun,
    "flat_landing": flat_landing,
    "stream_changed_file": stream_changed_file,
    "stream_available_now": stream_available_now,
    "stream_two_calls": stream_two_calls,
}
