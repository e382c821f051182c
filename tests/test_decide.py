"""Golden reports, threshold edges, baseline, review merge, routing."""

import json

import pytest
from pyspark.sql import functions as F

from dqgate.operators.decide import (
    decide, evaluated, fired_rules, merge_verdicts, review_queue, with_baseline, without_review,
)
from dqgate.operators.route import alerts, failure_alerts, publish_gate, route
from dqgate.schema import EVALUATED, REPORT, Thresholds

PASSED = "All quality checks passed within thresholds."


def reports(spark, *rows):
    """Reports with the given fields; all others NULL."""
    return spark.createDataFrame([tuple(row.get(n) for n in REPORT.names) for row in rows], REPORT)


def report(date, invalid=0.0, warning=0.0, dup=0, anomaly=0.0, previous=None, dominant=None, valid=1000, **more):
    return dict(
        source_date=date, raw_count=100000, valid_count=valid, invalid_rate=invalid, warning_rate=warning,
        duplicate_transactionid_rows_total=dup, anomaly_high_amount_rate=anomaly,
        previous_invalid_rate=previous, dominant_invalid_reason=dominant, **more,
    )


def outcome(df):
    return {r["source_date"]: (r["decision"], list(r["decision_reasons"])) for r in df.collect()}


GOLDEN = [
    (report("2026-06-01", 0.01, 0.005, 50, 0.001, valid=99000), "ALLOW", [PASSED]),
    (
        report("2026-06-02", 0.01, 0.12, 50, 0.001, valid=88000),
        "ALLOW_WITH_WARNING",
        ["Warning rate 12.00% exceeds threshold 10.00%."],
    ),
    (
        report("2026-06-03", 0.04, 0.005, 1500, 0.001, 0.01, "invalid_timestamp", valid=98000),
        "ESCALATE",
        [
            "Duplicate row rate 1.53% exceeds threshold 1.00%. Possible replay or upstream dedup issue.",
            "Invalid rate increased by 3.00% vs previous run (1.00% -> 4.00%). Possible upstream schema change.",
            "Dominant failure reason: invalid_timestamp. Investigate upstream source for this field.",
        ],
    ),
    (
        report("2026-06-04", 0.08, 0.005, 50, 0.001, None, "null_transactionid", valid=92000),
        "QUARANTINE",
        [
            "Invalid rate 8.00% exceeds threshold 5.00%.",
            "Dominant failure reason: null_transactionid. Investigate upstream source for this field.",
        ],
    ),
    (report("2026-03-25", 0.015, 0.008, 200, 0.001218, None, "invalid_timestamp", valid=98500), "ALLOW", [PASSED]),
]


def test_golden_decisions(spark):
    got = outcome(decide(reports(spark, *[g[0] for g in GOLDEN])))
    assert got == {g[0]["source_date"]: (g[1], g[2]) for g in GOLDEN}


def test_summary(spark):
    row = decide(reports(spark, GOLDEN[2][0])).first()["metrics_summary"].asDict()
    assert row == {
        "invalid_rate": 0.04, "warning_rate": 0.005, "duplicate_rate": round(1500 / 98000, 6),
        "anomaly_amount_rate": 0.001, "raw_count": 100000, "valid_count": 98000,
    }


EDGES = [
    (report("at-invalid", 0.05), "ALLOW"),
    (report("over-invalid", 0.050001), "QUARANTINE"),
    (report("at-warning", warning=0.10), "ALLOW"),
    (report("at-duplicates", dup=10), "ALLOW"),
    # 0.0100004 is 0.01 at six places, yet above the limit: compared unrounded.
    (report("over-duplicates", dup=100004, valid=10_000_000), "ESCALATE"),
    (report("at-anomaly", anomaly=0.05), "ALLOW"),
    (report("over-anomaly", anomaly=0.050001), "ALLOW_WITH_WARNING"),
    (report("drift-from-zero", 0.03, previous=0.0), "ESCALATE"),
    (report("drift-unknown", 0.03), "ALLOW"),
    (report("falling", 0.01, previous=0.04), "ALLOW"),
    (report("empty-dominant", 0.08, dominant=""), "QUARANTINE"),
    (report("no-valid-rows", dup=5, valid=0), "ALLOW"),
    (dict(source_date="empty-report"), "ALLOW"),
]


def test_threshold_edges(spark):
    got = outcome(decide(reports(spark, *[e[0] for e in EDGES])))
    assert {k: v[0] for k, v in got.items()} == {e[0]["source_date"]: e[1] for e in EDGES}
    assert len(got["empty-dominant"][1]) == 1


def test_drift_compares_like_python(spark):
    pairs = [(0.03, 0.01), (0.04, 0.02), (0.025, 0.005), (0.021, 0.001), (0.0201, 0.0001), (0.05, 0.03)]
    df = reports(spark, *[report(f"d{i}", a, previous=b) for i, (a, b) in enumerate(pairs)])
    fired = {r.source_date for r in fired_rules(decide(df)).where("rule = 5").collect()}
    assert fired == {f"d{i}" for i, (a, b) in enumerate(pairs) if a - b > 0.02}


def test_limits_are_parameters(spark):
    df = reports(spark, report("a", 0.03))
    assert decide(df, Thresholds(max_invalid_rate=0.02)).first()["decision"] == "QUARANTINE"


# -- baseline


def previous(df):
    return {(r.s3_key, r.source_date): r.previous_invalid_rate for r in df.collect()}


def test_baseline_is_the_batch_before_of_the_same_feed(spark):
    rows = [
        report("2026-01-01", 0.01, s3_key="a"),
        report("2026-01-05", 0.02, s3_key="a"),
        report("2026-01-03", 0.09, s3_key="b"),
    ]
    by_feed = reports(spark, *rows).withColumn("feed", F.col("s3_key"))
    got = previous(with_baseline(by_feed, feed="feed"))
    assert got == {("a", "2026-01-01"): None, ("a", "2026-01-05"): 0.01, ("b", "2026-01-03"): None}
    # Without a feed they are all of one, wherever the files were.
    got = previous(with_baseline(reports(spark, *rows)))
    assert got == {("a", "2026-01-01"): None, ("b", "2026-01-03"): 0.01, ("a", "2026-01-05"): 0.09}


def test_baseline_from_history_and_rerun(spark):
    history = reports(
        spark, report("2026-01-01", 0.01), report("2026-01-02", 0.5), report("2026-01-04", 0.9)
    )
    new = reports(spark, report("2026-01-02", 0.02), report("2026-01-03", 0.03))
    got = previous(with_baseline(new, history))
    # The stale report of 01-02 gives way to the new one; later ones do not count.
    assert got == {(None, "2026-01-02"): 0.01, (None, "2026-01-03"): 0.02}


def test_baseline_off(spark):
    new = reports(spark, report("2026-01-02", 0.02), report("2026-01-03", 0.03))
    assert set(previous(with_baseline(new, baseline="none")).values()) == {None}
    with pytest.raises(ValueError):
        with_baseline(new, baseline="other")


# -- review

SEVERE = '{"final_decision":"QUARANTINE","reasoning":"r","recommended_actions":["a"]}'
VERDICTS = {
    "plain": (SEVERE, "QUARANTINE", "r", ["a"]),
    "fenced": (f"Here:\n```json\n{SEVERE}\n```\nbye", "QUARANTINE", "r", ["a"]),
    "fenced-plain": (f"```\n{SEVERE}\n```", "QUARANTINE", "r", ["a"]),
    "spaced": (f"\n  {SEVERE} \n", "QUARANTINE", "r", ["a"]),
    "same": ('{"final_decision":"ESCALATE","reasoning":"s"}', "ESCALATE", "s", None),
    "downgrade": ('{"final_decision":"ALLOW","reasoning":"d"}', "ESCALATE", "d", None),
    "no-reasoning": ('{"final_decision":"QUARANTINE"}', "QUARANTINE", None, None),
    "not-json": ("QUARANTINE please", "ESCALATE", None, None),
    "empty": ("", "ESCALATE", None, None),
    "null": (None, "ESCALATE", None, None),
    "unknown": ('{"final_decision":"BLOCK","reasoning":"u"}', "ESCALATE", None, None),
    "key-missing": ('{"reasoning":"k"}', "ESCALATE", None, None),
    "list": (f"[{SEVERE}]", "ESCALATE", None, None),
    "trailing": (SEVERE + " and more", "ESCALATE", None, None),
    "two": (SEVERE + "," + SEVERE, "ESCALATE", None, None),
    "truncated": (SEVERE[:-3], "ESCALATE", None, None),
    "single-quotes": ("{'final_decision':'QUARANTINE'}", "ESCALATE", None, None),
}


def test_verdicts_raise_but_never_lower(spark):
    df = decide(reports(spark, *[report(n, dup=500) for n in VERDICTS], report("absent", dup=500), report("fine")))
    texts = [(n, v[0]) for n, v in VERDICTS.items()] + [("fine", SEVERE)]
    final = merge_verdicts(df, spark.createDataFrame(texts, "dt string, verdict_text string"))
    got = {r.source_date: (r.final_decision, r.agent_reasoning, r.agent_actions) for r in final.collect()}
    want = {n: tuple(v[1:]) for n, v in VERDICTS.items()}
    want["absent"] = ("ESCALATE", None, None)
    want["fine"] = ("ALLOW", None, None)
    assert got == want


def test_most_severe_of_several_verdicts(spark):
    df = decide(reports(spark, report("a", warning=0.5)))
    texts = [("a", '{"final_decision":"ESCALATE"}'), ("a", "junk"), ("a", SEVERE), ("a", None)]
    final = merge_verdicts(df, spark.createDataFrame(texts, "dt string, verdict_text string")).collect()
    assert [r.final_decision for r in final] == ["QUARANTINE"]


def test_review_queue_skips_clean_batches(spark):
    queue = review_queue(decide(reports(spark, *[g[0] for g in GOLDEN]))).collect()
    assert {r.source_date for r in queue} == {"2026-06-02", "2026-06-03", "2026-06-04"}
    sent = {r.source_date: json.loads(r.metrics_json) for r in queue}
    assert len(sent["2026-06-03"]) == 11
    assert sent["2026-06-03"]["previous_invalid_rate"] == 0.01
    assert sent["2026-06-02"]["previous_invalid_rate"] is None
    text = next(r.request_text for r in queue if r.source_date == "2026-06-02")
    assert text.startswith(
        "Batch date: 2026-06-02\nDeterministic decision: ALLOW_WITH_WARNING\n"
        "Reasons: Warning rate 12.00% exceeds threshold 10.00%.\nMetrics: {"
    )


def test_final_record(spark):
    final = without_review(decide(reports(spark, GOLDEN[3][0])))
    record = evaluated(final)
    assert record.columns == EVALUATED.names
    assert record.first()["batch_status"] == "QUARANTINE"


# -- routing


def test_routes_and_alerts(spark):
    final = route(without_review(decide(reports(spark, *[g[0] for g in GOLDEN]))))
    states = {r.source_date: r.terminal_state for r in final.collect()}
    assert states == {
        "2026-06-01": "SUCCEEDED", "2026-06-02": "SUCCEEDED", "2026-06-03": "ESCALATED",
        "2026-06-04": "FAILED", "2026-03-25": "SUCCEEDED",
    }
    sent = {r.source_date: (r.subject, r.message) for r in alerts(final).collect()}
    assert set(sent) == {"2026-06-02", "2026-06-03", "2026-06-04"}
    assert sent["2026-06-02"] == (
        "Batch Allowed With Warnings",
        'Batch for 2026-06-02 passed with warnings. Reasons: ["Warning rate 12.00% exceeds threshold 10.00%."]',
    )


def test_failure_alerts(spark):
    missing = spark.createDataFrame([("2026-01-02",)], "dt string")
    small = spark.createDataFrame([("2026-01-03", 12, 50000)], "dt string, raw_count bigint, min_rows bigint")
    got = {r.source_date: r.message for r in failure_alerts(missing, small).collect()}
    assert got == {
        "2026-01-02": "Pipeline failed for date 2026-01-02. Error: Landing file not found.",
        "2026-01-03": "Pipeline failed for date 2026-01-03. Error: Row count 12 below minimum 50000. Aborting.",
    }


def test_publish_gate(spark):
    final = without_review(decide(reports(spark, *[g[0] for g in GOLDEN])))
    rows = spark.createDataFrame([(g[0]["source_date"], i) for g in GOLDEN for i in range(3)], "dt string, i int")
    want = {("2026-06-01", 3), ("2026-06-02", 3), ("2026-03-25", 3)}

    def counts():
        out = publish_gate(rows, final)
        return out, {tuple(r) for r in out.groupBy("dt").agg(F.count("*")).collect()}

    small, got = counts()
    assert got == want
    assert "BroadcastHashJoin" in small._jdf.queryExecution().executedPlan().toString()
    # Nothing asks for a broadcast: a key table above the planner's bound is shuffled, with the same result.
    assert "broadcast" not in small._jdf.queryExecution().logical().toString().lower()
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        large, got = counts()
        assert got == want
        assert "SortMergeJoin" in large._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
