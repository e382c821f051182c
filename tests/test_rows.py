"""Landing files, row rules and metrics on small hand-made inputs."""

import re
from collections import Counter

import pytest

from dqgate.operators.classify import classify, curated, invalid, quarantine, tag, valid, warned
from dqgate.operators.metrics import (
    base_metrics, dominant_reason, duplicate_rows, quality_report, reason_breakdown,
)
from dqgate.operators.rules import CRITICAL, Rule
from dqgate.schema import CURATED, QUARANTINE, RAW_COLUMNS, REPORT, Thresholds
from dqgate.sources.landing import (
    TooFewRows, batch_date, expected_batches, landed_batches, missing_batches, read_landing,
    require_min_rows, undersized_batches, without_batches,
)

HEADER = ",".join(RAW_COLUMNS)
SCHEMA = ", ".join(f"{c} string" for c in RAW_COLUMNS) + ", dt string"


def land(folder, date, *lines, name="transactions.csv"):
    target = folder / f"dt={date}"
    target.mkdir(parents=True, exist_ok=True)
    (target / name).write_text("\n".join((HEADER, *lines)) + "\n")
    return str(folder)


def raw(spark, *rows):
    return spark.createDataFrame([tuple(r) for r in rows], SCHEMA)


def row(i="T1", ts="2026-03-20T01:02:03", store="S", product="P", amount="1.0", quantity="2", dt="2026-03-20"):
    return (i, ts, store, product, amount, quantity, dt)


def test_csv_edges(spark, tmp_path):
    path = land(
        tmp_path / "landing",
        "2026-03-20",
        ',2026-03-20T01:02:03,"",P,1.0,2',
        "  ,x,S",
        "T4,2026-03-20T01:02:03,S,P,1.0,2,EXTRA",
        "",
        "T5,,NA,NULL,nan,2",
    )
    rows = classify(read_landing(spark, path)).collect()
    got = {r.transactionid: (list(r._reasons), list(r._warn_reasons)) for r in rows}
    assert got == {
        None: (["missing_transactionid"], ["missing_storeid"]),
        "  ": (
            ["missing_transactionid", "invalid_timestamp", "missing_amount", "missing_quantity"],
            ["missing_productid"],
        ),
        "T4": ([], []),
        "T5": (["invalid_timestamp"], []),
    }
    assert {r.dt for r in rows} == {"2026-03-20"}


def test_batch_date_from_folder_path_or_file(spark, tmp_path):
    line = "T1,2026-03-20T01:02:03,S,P,1.0,2"
    base = land(tmp_path / "a", "2026-03-20", line)
    land(tmp_path / "a", "2026-03-21", line)
    assert sorted(r.dt for r in read_landing(spark, base).collect()) == ["2026-03-20", "2026-03-21"]
    assert [r.dt for r in read_landing(spark, base, ["2026-03-21"]).collect()] == ["2026-03-21"]
    for path in (f"{base}/dt=2026-03-20", f"{base}/dt=2026-03-20/transactions.csv"):
        assert [r.dt for r in read_landing(spark, path).collect()] == ["2026-03-20"]
    flat = tmp_path / "b"
    flat.mkdir()
    (flat / "dt=2026-03-22.csv").write_text(f"{HEADER}\n{line}\n")
    assert [r.dt for r in read_landing(spark, str(flat)).collect()] == ["2026-03-22"]


def test_dates_filter_skips_folders(spark, tmp_path):
    base = land(tmp_path / "a", "2026-03-20", "T1,2026-03-20T01:02:03,S,P,1.0,2")
    land(tmp_path / "a", "2026-03-21", "T1,2026-03-21T01:02:03,S,P,1.0,2")
    (only,) = read_landing(spark, base, ["2026-03-20"]).inputFiles()
    assert "/dt=2026-03-20/" in only
    # Dates come from the folders, so a filter on them skips folders as well.
    rows = read_landing(spark, base).where("dt = '2026-03-21'")
    plan = rows._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [" in plan and "PartitionFilters: []" not in plan and rows.count() == 1


def test_batch_date_missing(spark, tmp_path):
    with pytest.raises(ValueError):
        batch_date("landing/transactions.csv")
    for name in ("plain", "dt=soon"):
        folder = tmp_path / name
        folder.mkdir()
        (folder / "x.csv").write_text(f"{HEADER}\nT1,,,,,\n")
    with pytest.raises(Exception, match="no dt="):
        read_landing(spark, str(tmp_path / "plain")).collect()
    (tmp_path / "c" / "dt=soon").mkdir(parents=True)
    (tmp_path / "c" / "dt=soon" / "x.csv").write_text(f"{HEADER}\nT1,,,,,\n")
    with pytest.raises(Exception, match="no dt="):
        read_landing(spark, str(tmp_path / "c")).collect()


def test_missing_landed_and_undersized(spark, tmp_path):
    line = "T1,2026-03-20T01:02:03,S,P,1.0,2"
    base = land(tmp_path / "l", "2026-03-20", line, line)
    land(tmp_path / "l", "2026-03-20", line, name="more.csv")
    land(tmp_path / "l", "2026-03-22", line)
    land(tmp_path / "l", "2026-03-23")
    landed = landed_batches(spark, base)
    assert {(r.dt, r.files) for r in landed.collect()} == {
        ("2026-03-20", 2), ("2026-03-22", 1), ("2026-03-23", 1),
    }
    missing = missing_batches(expected_batches(spark, "2026-03-19", "2026-03-23"), landed)
    assert {r.dt for r in missing.collect()} == {"2026-03-19", "2026-03-21"}

    rows = read_landing(spark, base)
    small = undersized_batches(rows, 3, landed)
    assert {tuple(r) for r in small.collect()} == {("2026-03-22", 1, 3), ("2026-03-23", 0, 3)}
    assert {r.dt for r in undersized_batches(rows, 3).collect()} == {"2026-03-22"}
    assert {r.dt for r in without_batches(rows, small).collect()} == {"2026-03-20"}
    with pytest.raises(TooFewRows, match="2026-03-22: row count 1 below minimum 3"):
        require_min_rows(small)
    require_min_rows(undersized_batches(rows, 1))


def test_boundaries(spark):
    cases = {
        "0.005": ["invalid_amount"], "0.01": [], "-1": ["invalid_amount"], "x": ["missing_amount"],
        "NaN": [], "inf": [], "5000": [], "5000.01": [],
    }
    rows = classify(raw(spark, *[row(i=a, amount=a) for a in cases])).collect()
    assert {r.transactionid: list(r._reasons) for r in rows} == cases
    cases = {
        "0": ["invalid_quantity"], "1": [], "0.9": ["invalid_quantity"], "5.0": [], "1e3": ["missing_quantity"],
        "9999999999": ["missing_quantity"], ".5": ["invalid_quantity"], "": ["missing_quantity"],
    }
    rows = classify(raw(spark, *[row(i="q" + q, quantity=q) for q in cases])).collect()
    assert {r.transactionid[1:]: list(r._reasons) for r in rows} == cases


def test_tab_is_not_blank(spark):
    rows = classify(raw(spark, row(i="\t"), row(store=" "), row(product=None))).collect()
    assert [list(r._reasons) for r in rows] == [[], [], []]
    assert [list(r._warn_reasons) for r in rows] == [[], ["missing_storeid"], ["missing_productid"]]


def test_splits_and_projections(spark):
    rows = classify(raw(spark, row("a"), row("b", store=None), row("c", amount="x", store=None), row(None, "bad")))
    assert {r.transactionid for r in valid(rows).collect()} == {"a", "b"}
    assert {r.transactionid for r in invalid(rows).collect()} == {"c", None}
    assert {r.transactionid for r in warned(rows).collect()} == {"b"}
    assert curated(rows).schema.simpleString() == CURATED.simpleString()
    assert quarantine(rows).schema.simpleString() == QUARANTINE.simpleString()
    assert {r._invalid_reasons for r in quarantine(rows).collect()} == {
        "missing_amount", "missing_transactionid,invalid_timestamp",
    }


def test_rules_for_another_table(spark):
    rules = [Rule("negative", CRITICAL, "x < 0"), Rule("unknown", CRITICAL, "x IS NULL")]
    rows = tag(spark.createDataFrame([(1,), (-1,), (None,)], "x int"), rules).collect()
    assert [(list(r._reasons), list(r._warn_reasons)) for r in rows] == [([], []), (["negative"], []), (["unknown"], [])]


def test_duplicates(spark):
    rows = classify(
        raw(
            spark,
            row("a"), row("a"), row("a"), row("b"), row("A"), row("c"), row("c "),
            row("a", dt="2026-03-21"), row("x", amount="bad"), row("x", amount="bad"), row("x"),
        )
    )
    got = {r.dt: r.duplicate_transactionid_rows_total for r in duplicate_rows(valid(rows)).collect()}
    assert got == {"2026-03-20": 3, "2026-03-21": 0}
    report = {r.source_date: r.duplicate_transactionid_rows_total for r in quality_report(rows).collect()}
    assert report == got


def test_dominant_tie_is_alphabetical(spark):
    rows = classify(raw(spark, row("a", amount="x"), row("b", ts="x"), row("c", dt="2026-03-21")))
    assert [r.dominant_invalid_reason for r in dominant_reason(reason_breakdown(rows, "_reasons")).collect()] == [
        "invalid_timestamp"
    ]
    report = {r.source_date: r.dominant_invalid_reason for r in quality_report(rows).collect()}
    assert report == {"2026-03-20": "invalid_timestamp", "2026-03-21": None}


def test_report_of_only_invalid_rows(spark):
    report = quality_report(classify(raw(spark, row(None), row(None, amount="x")))).first()
    assert (report.raw_count, report.valid_count, report.invalid_rate) == (2, 0, 1.0)
    assert (report.anomaly_high_amount_rate, report.duplicate_transactionid_rows_total) == (0.0, 0)
    assert (report.amount_min, report.amount_avg, report.quantity_avg) == (None, None, None)
    assert report.invalid_reason_breakdown == {"missing_transactionid": 2, "missing_amount": 1}
    assert report.warning_reason_breakdown == {}
    assert report.thresholds.asDict() == {
        "max_invalid_rate": 0.05, "max_warning_rate": 0.10,
        "amount_anomaly_threshold": 5000.0, "quantity_anomaly_threshold": 50,
    }


def test_report_schema_and_limits(spark):
    rows = classify(raw(spark, row("a", amount="30"), row("b", quantity="8")))
    report = quality_report(rows, limits=Thresholds(amount_anomaly=20.0, quantity_anomaly=5))
    assert report.schema.simpleString() == REPORT.simpleString()
    assert tuple(report.select("anomaly_high_amount_count", "anomaly_high_quantity_count").first()) == (1, 1)


def test_nan_is_an_anomaly(spark):
    report = quality_report(classify(raw(spark, row("a", amount="NaN"), row("b")))).first()
    assert report.anomaly_high_amount_count == 1
    assert str(report.amount_max) == "nan" and report.amount_min == 1.0 and str(report.amount_avg) == "nan"


def test_one_hot_batch_and_one_hot_id(spark):
    """A third of all rows under one id of one batch, against a plain Python count."""
    rows = [("hot" if i % 3 == 0 else f"id{i % 500}", "d1" if i % 3 < 2 else f"d{i % 7}") for i in range(30000)]
    df = spark.createDataFrame(rows, "transactionid string, dt string").selectExpr(
        "transactionid", "'2026-03-20T01:02:03' AS transactionts", "'S' AS storeid", "'P' AS productid",
        "'1.5' AS amount", "'2' AS quantity", "dt",
    )
    per_key = Counter((dt, i) for i, dt in rows)
    want = Counter()
    for (dt, _), n in per_key.items():
        want[dt] += n if n > 1 else 0
    report = quality_report(classify(df)).collect()
    assert {r.source_date: r.duplicate_transactionid_rows_total for r in report} == dict(want)
    assert sum(r.raw_count for r in report) == 30000


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_plans(spark, tmp_path):
    path = str(tmp_path / "t")
    raw(spark, row()).write.parquet(path)
    rows = classify(spark.read.parquet(path))
    # Splitting: no shuffle, each field parsed once.
    for part in (curated(rows), quarantine(rows)):
        plan = _plan(part)
        assert "Exchange" not in plan
        assert plan.count("gettimestamp(") == 1 and plan.count("try_cast(amount") == 1
    # The report: only the duplicate branch shuffles ids; all else is one row per task and batch (and code).
    plan = _plan(quality_report(rows))
    assert len(re.findall(r"Exchange hashpartitioning\(dt#\d+, transactionid#\d+", plan)) == 1
    assert "Python" not in plan and "CartesianProduct" not in plan
    assert _plan(base_metrics(rows)).count("Exchange") == 1


def test_rules_of_one_code_count_once(spark):
    rules = [Rule("bad", CRITICAL, "i > 1"), Rule("other", CRITICAL, "i > 2"), Rule("bad", CRITICAL, "i > 3")]
    rows = tag(spark.range(6).selectExpr("id AS i"), rules).orderBy("i").collect()
    assert [list(r._reasons) for r in rows] == [[], [], ["bad"], ["bad", "other"], ["bad", "other"], ["bad", "other"]]
    for code in ("it's", "a`b", "a,b", ""):
        with pytest.raises(ValueError):
            Rule(code, CRITICAL, "true")
