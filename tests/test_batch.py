"""Sinks, re-runs, the whole job, and incremental pickup."""

import json
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from dqgate.functions.lineage import work_dir
from dqgate.operators.classify import classify, curated, quarantine
from dqgate.plans.batch import evaluate_batches, run_batches
from dqgate.schema import QUARANTINE, Thresholds
from dqgate.sources.landing import TooFewRows, expected_batches, landed_batches, read_landing
from dqgate.sources import manifest
from dqgate.sources.manifest import Committed, committed, vacuum
from dqgate.sources.reports import read_reports, write_reports
from dqgate.sources.tables import (
    clear_batches, read_curated, read_quarantine, write_curated, write_quarantine,
)
from dqgate.sources.zones import Zones
from dqgate.streaming.pickup import follow, run_available_now
from test_decide import GOLDEN, reports
from test_rows import land, raw, row

LOOSE = Thresholds(min_rows=0)


def lines(n, date, bad=0, start=0):
    """``n`` landing lines, of which the first ``bad`` have an unreadable amount."""
    return [
        f"T{start + i},{date}T01:02:03,S,P,{'x' if i < bad else '1.5'},2" for i in range(n)
    ]


def counts(df):
    return {r.dt: r["count"] for r in df.groupBy("dt").count().collect()}


def test_curated_keeps_other_batches(spark, tmp_path):
    path = str(tmp_path / "curated")
    write_curated(curated(classify(raw(spark, row("a"), row("b"), row("c", dt="2026-03-21")))), path)
    write_curated(curated(classify(raw(spark, row("d")))), path)
    got = {(r.dt, r.transactionid) for r in read_curated(spark, path).collect()}
    assert got == {("2026-03-20", "d"), ("2026-03-21", "c")}
    # A small batch is one file.
    assert len(list((Path(path) / "dt=2026-03-20").glob("*.parquet"))) == 1


def test_large_batch_is_split_over_tasks(spark, tmp_path):
    """Adaptive execution splits a batch that is large against the advisory size."""
    path = str(tmp_path / "curated")
    spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", "256kb")
    try:
        many = spark.range(0, 200000, 1, 8).selectExpr(
            "concat('T', id) AS transactionid", "timestamp'2026-03-20 01:02:03' AS transactionts",
            "'S' AS storeid", "'P' AS productid", "CAST(id AS DOUBLE) AS amount", "1 AS quantity",
            "IF(id < 100, '2026-03-21', '2026-03-20') AS dt",
        )
        write_curated(many, path)
    finally:
        spark.conf.unset("spark.sql.adaptive.advisoryPartitionSizeInBytes")
    assert len(list((Path(path) / "dt=2026-03-20").glob("*.parquet"))) > 1
    assert counts(read_curated(spark, path)) == {"2026-03-20": 199900, "2026-03-21": 100}


def test_quarantine_repair(spark, tmp_path):
    path = str(tmp_path / "quarantine")
    rows = classify(raw(spark, row(None), row(None, dt="2026-03-21"), row("ok", dt="2026-03-21")))
    write_quarantine(quarantine(rows), path)
    assert counts(read_quarantine(spark, path)) == {"2026-03-20": 1, "2026-03-21": 1}
    clear_batches(spark, path, ["2026-03-20"], QUARANTINE)
    assert counts(read_quarantine(spark, path)) == {"2026-03-21": 1}
    assert read_quarantine(spark, path).schema.simpleString() == QUARANTINE.simpleString()


def test_reports_roundtrip_and_replace(spark, tmp_path):
    path = str(tmp_path / "reports")
    write_reports(reports(spark, *[g[0] for g in GOLDEN]), path)
    write_reports(reports(spark, {**GOLDEN[0][0], "raw_count": 7}), path)
    got = {r.source_date: r for r in read_reports(spark, path).collect()}
    assert len(got) == 5 and got["2026-06-01"].raw_count == 7 and got["2026-06-02"].raw_count == 100000
    text = next((Path(path) / "dt=2026-06-02").glob("*.json")).read_text()
    stored = json.loads(text)
    assert stored["source_date"] == "2026-06-02" and stored["previous_invalid_rate"] is None


def test_reads_pretty_printed_report(spark, tmp_path):
    folder = tmp_path / "r" / "dt=2026-03-25"
    folder.mkdir(parents=True)
    stored = {
        "source_date": "2026-03-25", "processed_at": "2026-03-25T12:00:00+00:00", "raw_count": 10,
        "invalid_rate": 0.015, "invalid_reason_breakdown": {"invalid_timestamp": 9},
        "thresholds": {"max_invalid_rate": 0.05, "quantity_anomaly_threshold": 50}, "other": 1,
    }
    (folder / "report.json").write_text(json.dumps(stored, indent=2))
    got = read_reports(spark, str(tmp_path / "r")).first()
    assert (got.raw_count, got.invalid_rate, got.invalid_reason_breakdown) == (10, 0.015, {"invalid_timestamp": 9})
    assert got.valid_count is None and got.thresholds.quantity_anomaly_threshold == 50
    assert got.processed_at.isoformat() == "2026-03-25T12:00:00"


def test_whole_job_and_repaired_rerun(spark, tmp_path):
    landing = land(tmp_path / "landing", "2026-03-20", *lines(100, "2026-03-20"))
    land(tmp_path / "landing", "2026-03-21", *lines(100, "2026-03-21", bad=4))
    land(tmp_path / "landing", "2026-03-22", *lines(100, "2026-03-22", bad=8))
    zones = Zones(str(tmp_path / "out"))
    run = run_batches(
        spark, landing, zones, limits=LOOSE, expected=expected_batches(spark, "2026-03-20", "2026-03-23")
    )
    assert {r.source_date: r.terminal_state for r in run.final.collect()} == {
        "2026-03-20": "SUCCEEDED", "2026-03-21": "ESCALATED", "2026-03-22": "FAILED",
    }
    assert {r.source_date for r in run.alerts.collect()} == {"2026-03-21", "2026-03-22"}
    assert {r.source_date for r in run.failures.collect()} == {"2026-03-23"}
    assert counts(Committed(spark, zones).curated()) == {"2026-03-20": 100, "2026-03-21": 96, "2026-03-22": 92}
    assert counts(Committed(spark, zones).quarantine()) == {"2026-03-21": 4, "2026-03-22": 8}

    # The first day is delivered again with nothing valid: its old curated rows go away.
    land(tmp_path / "landing", "2026-03-20", *lines(10, "2026-03-20", bad=10))
    run_batches(spark, landing, zones, dates=["2026-03-20"], limits=LOOSE)
    assert counts(Committed(spark, zones).curated()) == {"2026-03-21": 96, "2026-03-22": 92}
    land(tmp_path / "landing", "2026-03-20", *lines(100, "2026-03-20"))
    run_batches(spark, landing, zones, dates=["2026-03-20"], limits=LOOSE)

    # The last day is delivered again, clean: its old bad rows and verdict go away.
    land(tmp_path / "landing", "2026-03-22", *lines(100, "2026-03-22"))
    run_batches(
        spark, landing, zones, dates=["2026-03-22"], history=Committed(spark, zones).reports(), limits=LOOSE
    )
    assert counts(Committed(spark, zones).curated()) == {"2026-03-20": 100, "2026-03-21": 96, "2026-03-22": 100}
    assert counts(Committed(spark, zones).quarantine()) == {"2026-03-21": 4}
    final = {r.source_date: r for r in Committed(spark, zones).evaluated().collect()}
    assert {d: r.batch_status for d, r in final.items()} == {
        "2026-03-20": "ALLOW", "2026-03-21": "ESCALATE", "2026-03-22": "ALLOW",
    }
    assert final["2026-03-22"].previous_invalid_rate == 0.04
    stored = {r.source_date: r.batch_status for r in Committed(spark, zones).reports().collect()}
    assert set(stored.values()) == {"PENDING_EVALUATION"}


# Four days of 60,000 rows, each with one kind of fault, as SQL over the row number.
SCENARIOS = {
    "2026-03-20": ({}, "ALLOW"),
    "2026-03-21": (
        {
            "storeid": "IF(id % 40 < 3, NULL, 'STORE_001')",
            "productid": "IF(id % 40 BETWEEN 3 AND 5, NULL, 'PROD_0001')",
        },
        "ALLOW_WITH_WARNING",
    ),
    "2026-03-22": ({"transactionid": "concat('TXN', IF(id >= 58200, id - 58200, id))"}, "ESCALATE"),
    "2026-03-23": (
        {
            "transactionid": "IF(id % 25 = 0, NULL, concat('TXN', id))",
            "amount": "IF(id % 25 = 1, 'NOT_A_NUMBER', '10.5')",
        },
        "QUARANTINE",
    ),
}


def test_four_scenarios_with_default_limits(spark, tmp_path):
    zones = Zones(str(tmp_path))
    for date, (faults, _) in SCENARIOS.items():
        clean = {
            "transactionid": "concat('TXN', id)", "transactionts": f"'{date}T10:20:30'",
            "storeid": "'STORE_001'", "productid": "'PROD_0001'", "amount": "'10.5'",
            "quantity": "CAST(id % 9 + 1 AS STRING)",
        }
        columns = [f"{sql} AS {name}" for name, sql in {**clean, **faults}.items()]
        spark.range(0, 60000, 1, 2).selectExpr(*columns).write.option("header", True).csv(
            f"{zones.landing}/dt={date}"
        )
    run = run_batches(spark, zones.landing, zones)
    final = {r.source_date: r for r in run.final.collect()}
    assert {d: r.final_decision for d, r in final.items()} == {d: s[1] for d, s in SCENARIOS.items()}
    assert final["2026-03-21"].warning_rate == 0.15
    assert final["2026-03-22"].duplicate_transactionid_rows_total == 3600
    assert final["2026-03-23"].invalid_reason_breakdown == {"missing_transactionid": 2400, "missing_amount": 2400}
    assert run.failures.count() == 0


def test_evaluation_alone_from_stored_reports(spark, tmp_path):
    zones, path = Zones(str(tmp_path / "out")), str(tmp_path / "reports")
    write_reports(reports(spark, *[g[0] for g in GOLDEN]), path)
    given = read_reports(spark, path)
    final = evaluate_batches(spark, zones, dates=["2026-06-03", "2026-06-04"], reports=given)
    want = {"2026-06-03": "ESCALATE", "2026-06-04": "QUARANTINE"}
    assert {r.source_date: r.final_decision for r in final.collect()} == want
    stored = Committed(spark, zones).evaluated().collect()
    assert {r.source_date: r.batch_status for r in stored} == want
    assert {r.source_date: list(r.decision_reasons) for r in stored} == {
        g[0]["source_date"]: g[2] for g in GOLDEN if g[0]["source_date"] in want
    }
    # From then on they are stored reports.
    again = evaluate_batches(spark, zones, limits=Thresholds(max_invalid_rate=0.01))
    assert {r.source_date: r.final_decision for r in again.collect()} == dict.fromkeys(want, "QUARANTINE")


def test_guard_strict_and_backfill(spark, tmp_path):
    landing = land(tmp_path / "landing", "2026-03-20", *lines(50, "2026-03-20"))
    land(tmp_path / "landing", "2026-03-21", *lines(5, "2026-03-21"))
    land(tmp_path / "landing", "2026-03-22")
    limits = Thresholds(min_rows=50)
    zones = Zones(str(tmp_path / "out"))
    with pytest.raises(TooFewRows):
        run_batches(spark, landing, zones, limits=limits)
    assert not Path(zones.curated).exists()
    assert Committed(spark, zones).failures().count() == 2
    run = run_batches(spark, landing, zones, limits=limits, strict=False)
    assert [r.source_date for r in run.final.collect()] == ["2026-03-20"]
    assert {r.source_date: r.message.split("Error: ")[1] for r in run.failures.collect()} == {
        "2026-03-21": "Row count 5 below minimum 50. Aborting.",
        "2026-03-22": "Row count 0 below minimum 50. Aborting.",
    }
    assert counts(Committed(spark, zones).curated()) == {"2026-03-20": 50}


def test_staging_is_emptied(spark, tmp_path, monkeypatch):
    made = []
    monkeypatch.setattr(
        "dqgate.plans.batch.work_dir", lambda session: made.append(str(tmp_path / "work")) or made[-1]
    )
    landing = land(tmp_path / "landing", "2026-03-20", *lines(50, "2026-03-20"))
    run = run_batches(spark, landing, Zones(str(tmp_path / "out")), limits=LOOSE)
    assert not Path(made[0]).exists()
    # What a run returns does not depend on it.
    assert (run.final.count(), run.alerts.count(), run.failures.count()) == (1, 0, 0)


def test_gate_and_verdicts(spark, tmp_path):
    landing = land(tmp_path / "landing", "2026-03-20", *lines(100, "2026-03-20"))
    land(tmp_path / "landing", "2026-03-21", *lines(100, "2026-03-21", bad=50))
    zones = Zones(str(tmp_path / "out"))
    verdicts = spark.createDataFrame(
        [("2026-03-21", '{"final_decision":"ALLOW","reasoning":"why"}')], "dt string, verdict_text string"
    )
    run_batches(spark, landing, zones, limits=LOOSE, gate=True, verdicts=verdicts)
    assert counts(Committed(spark, zones).curated()) == {"2026-03-20": 100}
    final = {r.source_date: r for r in Committed(spark, zones).evaluated().collect()}
    assert final["2026-03-21"].batch_status == "QUARANTINE" and final["2026-03-21"].agent_reasoning == "why"


def test_pickup_in_rounds(spark, tmp_path):
    landing = land(tmp_path / "landing", "2026-03-20", *lines(100, "2026-03-20"))
    zones, checkpoint = Zones(str(tmp_path / "out")), str(tmp_path / "checkpoint")
    rounds = []

    def pick_up():
        run_available_now(
            spark, landing, zones, checkpoint, limits=LOOSE,
            on_batch=lambda run: rounds.append({r.source_date for r in run.final.collect()}),
        )

    pick_up()
    pick_up()
    assert rounds == [{"2026-03-20"}]
    # A second file for the same day, and a new day: both days come out complete.
    land(tmp_path / "landing", "2026-03-20", *lines(10, "2026-03-20", start=500), name="late.csv")
    land(tmp_path / "landing", "2026-03-21", *lines(100, "2026-03-21", bad=4))
    pick_up()
    assert rounds[1:] == [{"2026-03-20", "2026-03-21"}]
    assert counts(Committed(spark, zones).curated()) == {"2026-03-20": 110, "2026-03-21": 96}
    final = {r.source_date: (r.batch_status, r.raw_count) for r in Committed(spark, zones).evaluated().collect()}
    assert final == {"2026-03-20": ("ALLOW", 110), "2026-03-21": ("ESCALATE", 100)}


def test_work_dir_is_new_and_in_the_shared_folder(spark):
    shared = spark.conf.get("spark.checkpoint.dir", None)
    first, second = work_dir(spark), work_dir(spark)
    assert first != second
    if shared:
        assert first.startswith(shared)


def test_publish_gate_prunes_partitions(spark, tmp_path):
    """On a stored curated table the gate does not read blocked batches at all."""
    from dqgate.operators.decide import decide, without_review
    from dqgate.operators.route import publish_gate

    path = str(tmp_path / "curated")
    write_curated(curated(classify(raw(spark, *[row(f"t{g[0]['source_date']}", dt=g[0]["source_date"]) for g in GOLDEN]))), path)
    final = without_review(decide(reports(spark, *[g[0] for g in GOLDEN])))
    out = publish_gate(read_curated(spark, path), final)
    assert {r.dt for r in out.select("dt").collect()} == {"2026-06-01", "2026-06-02", "2026-03-25"}
    assert "BroadcastHashJoin" in out._jdf.queryExecution().executedPlan().toString()


def test_files_of_any_name_are_one_file_set(spark, tmp_path):
    """Compressed or oddly named files are guarded, listed, read and picked up like others."""
    import gzip

    header = "transactionid,transactionts,storeid,productid,amount,quantity"
    for date, name, n in (("2026-03-20", "transactions.csv.gz", 3), ("2026-03-21", "part.txt", 60)):
        folder = tmp_path / "landing" / f"dt={date}"
        folder.mkdir(parents=True)
        text = "\n".join([header, *lines(n, date)]) + "\n"
        (folder / name).write_bytes(gzip.compress(text.encode()) if name.endswith(".gz") else text.encode())
    landing, zones = str(tmp_path / "landing"), Zones(str(tmp_path / "out"))
    assert {r.dt: r.files for r in landed_batches(spark, landing).collect()} == {"2026-03-20": 1, "2026-03-21": 1}
    seen = []
    run_available_now(
        spark, landing, zones, str(tmp_path / "checkpoint"), limits=Thresholds(min_rows=50),
        expected=expected_batches(spark, "2026-03-20", "2026-03-21"), on_batch=seen.append,
    )
    (run,) = seen
    assert [r.source_date for r in run.final.collect()] == ["2026-03-21"]
    stored = Committed(spark, zones).failures().collect()
    assert [r.message for r in stored] == [
        "Pipeline failed for date 2026-03-20. Error: Row count 3 below minimum 50. Aborting."
    ]
    report = Committed(spark, zones).reports().first()
    assert report.s3_key.endswith("/landing/dt=2026-03-21/part.txt")


def test_many_files_are_one_round(spark, tmp_path):
    landing, zones, seen = str(tmp_path / "landing"), Zones(str(tmp_path / "out")), []
    for i in range(6):
        land(tmp_path / "landing", f"2026-03-2{i % 2}", *lines(10, f"2026-03-2{i % 2}", start=10 * i), name=f"f{i}.csv")
    run_available_now(
        spark, landing, zones, str(tmp_path / "checkpoint"), limits=LOOSE,
        on_batch=lambda run: seen.append(sorted((r.source_date, r.raw_count) for r in run.final.collect())),
    )
    assert seen == [[("2026-03-20", 30), ("2026-03-21", 30)]]


def test_one_date_lists_its_own_folder_only(spark, tmp_path):
    landing = land(tmp_path / "landing", "2026-03-20", *lines(5, "2026-03-20"))
    land(tmp_path / "landing", "2026-03-21", *lines(5, "2026-03-21"))
    one = read_landing(spark, landing, ["2026-03-21"])
    assert all("dt=2026-03-21" in f for f in one.inputFiles()) and one.count() == 5
    listed = landed_batches(spark, landing, ["2026-03-21"])
    assert [r.dt for r in listed.collect()] == ["2026-03-21"]
    assert landed_batches(spark, landing, ["2026-03-25"]).count() == 0
    assert read_landing(spark, landing, ["2026-03-20", "2026-03-21"]).count() == 10


def test_gate_takes_back_what_a_blocked_batch_had_published(spark, tmp_path):
    landing = land(tmp_path / "landing", "2026-03-20", *lines(10, "2026-03-20"))
    zones = Zones(str(tmp_path / "out"))
    run_batches(spark, landing, zones, limits=LOOSE, gate=True)
    assert counts(Committed(spark, zones).curated()) == {"2026-03-20": 10}
    land(tmp_path / "landing", "2026-03-20", *lines(10, "2026-03-20", bad=5))
    run_batches(spark, landing, zones, limits=LOOSE, gate=True)
    assert counts(Committed(spark, zones).curated()) == {}
    assert [r.source_date for r in Committed(spark, zones).alerts().collect()] == ["2026-03-20"]
    # Repaired: the alert goes away again.
    land(tmp_path / "landing", "2026-03-20", *lines(10, "2026-03-20"))
    run_batches(spark, landing, zones, limits=LOOSE, gate=True)
    assert counts(Committed(spark, zones).curated()) == {"2026-03-20": 10}
    assert Committed(spark, zones).alerts().count() == 0


def test_daily_use_needs_no_history(spark, tmp_path):
    """The baseline is found in the stored reports, and a late day refreshes the day after it."""
    landing, zones = str(tmp_path / "landing"), Zones(str(tmp_path / "out"))
    for date, bad in (("2026-03-20", 0), ("2026-03-22", 4), ("2026-03-21", 3)):
        land(tmp_path / "landing", date, *lines(100, date, bad=bad))
        run_batches(spark, landing, zones, dates=[date], limits=LOOSE)
        if date == "2026-03-22":
            assert Committed(spark, zones).evaluated().where("source_date = '2026-03-22'").first().batch_status == "ESCALATE"
    final = {r.source_date: (r.batch_status, r.previous_invalid_rate) for r in Committed(spark, zones).evaluated().collect()}
    assert final == {"2026-03-20": ("ALLOW", None), "2026-03-21": ("ESCALATE", 0.0), "2026-03-22": ("ALLOW", 0.03)}


def test_two_reports_of_a_date_are_two_reports(spark, tmp_path):
    path = str(tmp_path / "reports")
    first = GOLDEN[0][0]
    write_reports(reports(spark, {**first, "s3_key": "a/dt=2026-06-01/f"}, {**first, "s3_key": "b/dt=2026-06-01/f"}), path)
    assert sorted(r.s3_key for r in read_reports(spark, path).collect()) == ["a/dt=2026-06-01/f", "b/dt=2026-06-01/f"]


# -- commits --------------------------------------------------------------------


def day(tmp_path, date, bad=0, n=100, name="transactions.csv"):
    return land(tmp_path / "landing", date, *lines(n, date, bad=bad), name=name)


def stored(spark, zones):
    return {r.source_date: (r.batch_status, r.previous_invalid_rate) for r in Committed(spark, zones).evaluated().collect()}


@pytest.mark.parametrize("step", ["write_run:2", "decide:1", "commit:1"])
def test_a_run_that_ends_early_changes_nothing_for_readers(spark, tmp_path, monkeypatch, step):
    from dqgate.plans import batch

    landing, zones = day(tmp_path, "2026-03-20"), Zones(str(tmp_path / "out"))
    run_batches(spark, landing, zones, limits=LOOSE)
    day(tmp_path, "2026-03-20", bad=40)
    day(tmp_path, "2026-03-21", bad=3)
    name, calls = step.split(":")
    real, seen = getattr(batch, name), []

    def failing(*args, **options):
        seen.append(1)
        if len(seen) == int(calls):
            raise RuntimeError("lost")
        return real(*args, **options)

    with monkeypatch.context() as patched:
        patched.setattr(batch, name, failing)
        with pytest.raises(RuntimeError):
            run_batches(spark, landing, zones, limits=LOOSE)
    now = Committed(spark, zones)
    assert counts(now.curated()) == {"2026-03-20": 100} and now.quarantine().count() == 0
    assert stored(spark, zones) == {"2026-03-20": ("ALLOW", None)}
    assert now.reports().first().invalid_count == 0 and now.alerts().count() == 0
    if step != "commit:1":
        return
    # The next run is not hindered by what the lost one has left, and that can be removed.
    monkeypatch.setattr(manifest, "COMMITS_KEPT", 1)
    run_batches(spark, landing, zones, limits=LOOSE)
    assert counts(Committed(spark, zones).curated()) == {"2026-03-20": 60, "2026-03-21": 97}
    assert vacuum(spark, zones) == 0 and vacuum(spark, zones, older_than_hours=0) > 0
    assert counts(Committed(spark, zones).curated()) == {"2026-03-20": 60, "2026-03-21": 97}
    assert counts(Committed(spark, zones).quarantine()) == {"2026-03-20": 40, "2026-03-21": 3}
    assert Committed(spark, zones).alerts().count() == 1


def test_many_emptied_batches_are_one_commit(spark, tmp_path):
    """Batches without invalid rows any more cost no write of their own."""
    dates = [f"2026-01-{d:02d}" for d in range(1, 21)]
    for date in dates:
        day(tmp_path, date, bad=1, n=4)
    landing, zones = str(tmp_path / "landing"), Zones(str(tmp_path / "out"))
    run_batches(spark, landing, zones, limits=LOOSE)
    assert Committed(spark, zones).quarantine().count() == 20
    for date in dates:
        day(tmp_path, date, n=4)
    before = set(Path(zones.quarantine).rglob("*.parquet"))
    run_batches(spark, landing, zones, limits=LOOSE)
    assert Committed(spark, zones).quarantine().count() == 0
    assert set(Path(zones.quarantine).rglob("*.parquet")) == before


def test_feeds_share_a_base(spark, tmp_path):
    """The default feed and another one, in turns; outside readers see both as partitions."""
    first, second = Zones(str(tmp_path / "out")), Zones(str(tmp_path / "out"), "refunds")
    day(tmp_path / "a", "2026-03-20")
    for date, bad in (("2026-03-20", 1), ("2026-03-21", 4)):
        day(tmp_path / "b", date, bad=bad)
    for zones, part in ((first, "a"), (second, "b")) * 2:
        run_batches(spark, str(tmp_path / part / "landing"), zones, limits=LOOSE)
    assert stored(spark, first) == {"2026-03-20": ("ALLOW", None)}
    assert stored(spark, second) == {"2026-03-20": ("ALLOW", None), "2026-03-21": ("ESCALATE", 0.01)}
    both = spark.read.schema("source_date string, feed string, dt string, run string").json(f"{tmp_path}/out/evaluated-reports")
    assert {(r.feed, r.dt) for r in both.collect()} == {
        ("transactions", "2026-03-20"), ("refunds", "2026-03-20"), ("refunds", "2026-03-21"),
    }
    with pytest.raises(ValueError):
        Zones("x", "a/b")


def test_reviews_outlive_runs_of_other_batches(spark, tmp_path):
    zones = Zones(str(tmp_path / "out"))
    landing = day(tmp_path, "2026-03-20")
    day(tmp_path, "2026-03-21", bad=4)
    verdicts = spark.createDataFrame(
        [("2026-03-21", '{"final_decision":"QUARANTINE","reasoning":"bad feed"}')], "dt string, verdict_text string"
    )
    run_batches(spark, landing, zones, limits=LOOSE, verdicts=verdicts, gate=True)
    assert counts(Committed(spark, zones).curated()) == {"2026-03-20": 100}
    run_batches(spark, landing, zones, limits=LOOSE, dates=["2026-03-20"], gate=True)
    run_batches(spark, landing, zones, limits=LOOSE, verdicts=verdicts, dates=["2026-03-21"], gate=True)
    evaluate_batches(spark, zones)
    final = Committed(spark, zones).evaluated(["2026-03-21"]).first()
    assert (final.batch_status, final.agent_reasoning) == ("QUARANTINE", "bad feed")
    assert counts(Committed(spark, zones).curated()) == {"2026-03-20": 100}
    assert counts(Committed(spark, zones).pending()) == {"2026-03-21": 96}
    assert Committed(spark, zones).verdicts().count() == 1
    # By a pickup of the day before, too.
    day(tmp_path, "2026-03-20", bad=1)
    run_available_now(spark, landing, zones, str(tmp_path / "checkpoint"), limits=LOOSE, gate=True)
    assert stored(spark, zones)["2026-03-21"] == ("QUARANTINE", 0.01)
    # Delivered anew, the batch has not been reviewed.
    day(tmp_path, "2026-03-21", bad=4, n=101)
    run_batches(spark, landing, zones, limits=LOOSE, dates=["2026-03-21"], gate=True)
    assert stored(spark, zones)["2026-03-21"][0] == "ESCALATE" or stored(spark, zones)["2026-03-21"][0] == "ALLOW_WITH_WARNING"


def test_a_new_baseline_publishes_and_withdraws(spark, tmp_path):
    """Nothing of the batch itself is read or written again."""
    zones, landing = Zones(str(tmp_path / "out")), str(tmp_path / "landing")
    files = lambda: set(Path(zones.curated).rglob("*.parquet"))
    for date, bad in (("2026-03-18", 0), ("2026-03-20", 4)):
        day(tmp_path, date, bad=bad)
        run_batches(spark, landing, zones, dates=[date], limits=LOOSE, gate=True)
    assert counts(Committed(spark, zones).curated()) == {"2026-03-18": 100}
    day(tmp_path, "2026-03-19", bad=3)
    run_batches(spark, landing, zones, dates=["2026-03-19"], limits=LOOSE, gate=True)
    # The 19th has drifted itself, and is what the 20th is compared with now.
    assert counts(Committed(spark, zones).curated()) == {"2026-03-18": 100, "2026-03-20": 96}
    day(tmp_path, "2026-03-19", bad=0)
    before = files()
    run_batches(spark, landing, zones, dates=["2026-03-19"], limits=LOOSE, gate=True)
    assert counts(Committed(spark, zones).curated()) == {"2026-03-18": 100, "2026-03-19": 100}
    assert all("dt=2026-03-19" in str(f) for f in files() - before)


def test_a_run_reads_the_reports_next_to_it_only(spark, tmp_path, monkeypatch):
    from dqgate.plans import batch

    zones, landing, asked = Zones(str(tmp_path / "out")), str(tmp_path / "landing"), []
    for date in ("2026-03-16", "2026-03-17", "2026-03-18", "2026-03-20", "2026-03-21", "2026-03-22"):
        day(tmp_path, date)
    run_batches(spark, landing, zones, limits=LOOSE)
    day(tmp_path, "2026-03-19", bad=3)
    real = batch.with_baseline
    monkeypatch.setattr(
        batch, "with_baseline", lambda reports, history, *a, **o: asked.extend(history.inputFiles()) or real(reports, history, *a, **o)
    )
    run_batches(spark, landing, zones, dates=["2026-03-19"], limits=LOOSE)
    assert sorted(f.split("dt=")[1][:10] for f in asked) == ["2026-03-18", "2026-03-20"]
    assert stored(spark, zones)["2026-03-20"] == ("ALLOW", 0.03) and stored(spark, zones)["2026-03-19"] == ("ESCALATE", 0.0)


# -- landing layouts ------------------------------------------------------------


def _layout(tmp_path, kind):
    """Two days; the landing path of ``kind``."""
    root = tmp_path / "landing"
    for date, bad in (("2026-03-20", 0), ("2026-03-21", 4)):
        made = Path(land(tmp_path / "made", date, *lines(100, date, bad=bad), name="f.csv")) / f"dt={date}" / "f.csv"
        place = {
            "flat": root / f"transactions_dt={date}.csv", "nested": root / "eu" / f"dt={date}" / "f.csv",
            "mixed": root / (f"dt={date}/f.csv" if bad else f"x-dt={date}.csv"),
        }[kind]
        place.parent.mkdir(parents=True, exist_ok=True)
        made.rename(place)
    return str(root)


@pytest.mark.parametrize("kind, dated", [("flat", True), ("nested", True), ("mixed", True), ("mixed", False)])
def test_every_layout_is_found(spark, tmp_path, kind, dated):
    """No failure for a batch that is there, and the batch before is known."""
    landing, zones = _layout(tmp_path, kind), Zones(str(tmp_path / "out"))
    dates = ["2026-03-20", "2026-03-21"]
    for date in dates if dated else [None]:
        expected = spark.createDataFrame([(d,) for d in ([date] if date else dates)], "dt string")
        run_batches(spark, landing, zones, dates=date and [date], expected=expected, limits=LOOSE)
    assert Committed(spark, zones).failures().count() == 0
    assert stored(spark, zones) == {"2026-03-20": ("ALLOW", None), "2026-03-21": ("ESCALATE", 0.0)}


@pytest.mark.parametrize("dates", [["2026-03-20"], None])
def test_a_date_folder_as_landing_path(spark, tmp_path, dates):
    landing, zones = day(tmp_path, "2026-03-20") + "/dt=2026-03-20", Zones(str(tmp_path / "out"))
    day(tmp_path, "2026-03-21")
    expected = spark.createDataFrame([("2026-03-20",)], "dt string")
    run_batches(spark, landing, zones, dates=dates, expected=expected, limits=LOOSE)
    assert stored(spark, zones) == {"2026-03-20": ("ALLOW", None)} and Committed(spark, zones).failures().count() == 0


def test_a_missing_date_is_a_failure_until_it_lands(spark, tmp_path):
    landing, zones = day(tmp_path, "2026-03-20"), Zones(str(tmp_path / "out"))
    expected = spark.createDataFrame([("2026-03-21",)], "dt string")
    run_batches(spark, landing, zones, dates=["2026-03-21"], expected=expected, limits=LOOSE)
    assert [r.source_date for r in Committed(spark, zones).failures().collect()] == ["2026-03-21"]
    assert Committed(spark, zones).evaluated().count() == 0
    day(tmp_path, "2026-03-21")
    run_batches(spark, landing, zones, dates=["2026-03-21"], expected=expected, limits=LOOSE)
    assert Committed(spark, zones).failures().count() == 0 and committed(spark, zones)["2026-03-21"].valid_count == 100


def test_a_report_names_all_files(spark, tmp_path):
    landing, zones = day(tmp_path, "2026-03-20", name="b.csv"), Zones(str(tmp_path / "out"))
    day(tmp_path, "2026-03-20", name="a.csv")
    run_batches(spark, landing, zones, limits=LOOSE)
    named = Committed(spark, zones).reports().first().s3_key.split(",")
    assert [n.rsplit("/", 2)[1:] for n in named] == [["dt=2026-03-20", "a.csv"], ["dt=2026-03-20", "b.csv"]]


# -- changed files ----------------------------------------------------------------


def test_changed_and_removed_files_are_picked_up(spark, tmp_path):
    landing, zones, rounds = day(tmp_path, "2026-03-20", n=10), Zones(str(tmp_path / "out")), []

    def pick_up():
        run_available_now(
            spark, landing, zones, str(tmp_path / "checkpoint"), limits=LOOSE,
            on_batch=lambda run: rounds.append(sorted((r.source_date, r.raw_count) for r in run.final.collect())),
        )

    day(tmp_path, "2026-03-21", n=10, name="more.csv")
    day(tmp_path, "2026-03-21", n=10)
    pick_up()
    day(tmp_path, "2026-03-20", n=12)
    pick_up()
    pick_up()
    (tmp_path / "landing" / "dt=2026-03-21" / "more.csv").unlink()
    pick_up()
    (tmp_path / "landing" / "dt=2026-03-21" / "transactions.csv").unlink()
    pick_up()
    pick_up()
    assert rounds == [
        [("2026-03-20", 10), ("2026-03-21", 20)], [("2026-03-20", 12), ("2026-03-21", 20)], [("2026-03-21", 10)],
    ]
    # The last file of a day is gone: the day stays as it was.
    assert counts(Committed(spark, zones).curated()) == {"2026-03-20": 12, "2026-03-21": 10}


def test_following_a_folder(spark, tmp_path):
    landing, zones = day(tmp_path, "2026-03-20", n=10), Zones(str(tmp_path / "out"))
    query = follow(spark, landing, zones, str(tmp_path / "checkpoint"), every="1 second", limits=LOOSE)
    try:
        query.processAllAvailable()
        day(tmp_path, "2026-03-21", n=10)
        query.processAllAvailable()
    finally:
        query.stop()
    assert counts(Committed(spark, zones).curated()) == {"2026-03-20": 10, "2026-03-21": 10}
