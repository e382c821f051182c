"""The registered queries as plain SQL over the same tables, written independently."""

from __future__ import annotations

from dqgate.plans.queries import LANDING_SQL

_CTES: dict[str, str] = {
    "landing": LANDING_SQL.format(events="events"),
    "typed": r"""
        SELECT transactionid, transactionts, storeid, productid, amount, quantity,
          CASE WHEN regexp_full_match(transactionts, '\d{4}-\d{2}-\d{2}T\d{2}:\d{2}:\d{2}')
               THEN try_strptime(transactionts, '%Y-%m-%dT%H:%M:%S') END AS transactionts_parsed,
          TRY_CAST(amount AS DOUBLE) AS amount_parsed,
          CASE WHEN regexp_full_match(quantity, '[+-]?\d+(\.\d*)?')
               THEN TRY_CAST(regexp_replace(quantity, '\.\d*$', '') AS INTEGER) END AS quantity_parsed,
          dt
        FROM landing""",
    "classified": """
        SELECT *, concat_ws(',',
            CASE WHEN transactionid IS NULL OR trim(transactionid) = '' THEN 'missing_transactionid' END,
            CASE WHEN transactionts_parsed IS NULL THEN 'invalid_timestamp' END,
            CASE WHEN amount_parsed IS NULL THEN 'missing_amount'
                 WHEN amount_parsed < 0.01 THEN 'invalid_amount' END,
            CASE WHEN quantity_parsed IS NULL THEN 'missing_quantity'
                 WHEN quantity_parsed < 1 THEN 'invalid_quantity' END) AS reasons,
          concat_ws(',',
            CASE WHEN storeid IS NULL OR trim(storeid) = '' THEN 'missing_storeid' END,
            CASE WHEN productid IS NULL OR trim(productid) = '' THEN 'missing_productid' END) AS warn_reasons
        FROM typed""",
    "valid": "SELECT * FROM classified WHERE reasons = ''",
    "base": """
        SELECT dt,
          count(*) AS raw_count,
          count(*) FILTER (reasons = '') AS valid_count,
          count(*) FILTER (reasons <> '') AS invalid_count,
          count(*) FILTER (reasons = '' AND warn_reasons <> '') AS warning_count,
          count(*) FILTER (reasons = '' AND amount_parsed > 5000) AS anomaly_high_amount_count,
          count(*) FILTER (reasons = '' AND quantity_parsed > 50) AS anomaly_high_quantity_count,
          min(amount_parsed) FILTER (reasons = '') AS amount_min,
          max(amount_parsed) FILTER (reasons = '') AS amount_max,
          round(avg(amount_parsed) FILTER (reasons = ''), 2) AS amount_avg,
          min(quantity_parsed) FILTER (reasons = '') AS quantity_min,
          max(quantity_parsed) FILTER (reasons = '') AS quantity_max,
          round(avg(quantity_parsed) FILTER (reasons = ''), 2) AS quantity_avg
        FROM classified GROUP BY dt""",
    "dup_ids": """
        SELECT dt, transactionid, count(*) AS n FROM valid
        GROUP BY dt, transactionid HAVING count(*) > 1""",
    "dup": """
        SELECT b.dt, b.valid_count,
               CAST(coalesce(sum(d.n), 0) AS BIGINT) AS duplicate_transactionid_rows_total
        FROM base b LEFT JOIN dup_ids d ON b.dt = d.dt GROUP BY b.dt, b.valid_count""",
    "invalid_counts": """
        SELECT dt, reason, count(*) AS n
        FROM (SELECT dt, unnest(string_split(reasons, ',')) AS reason FROM classified WHERE reasons <> '')
        GROUP BY dt, reason""",
    "warning_counts": """
        SELECT dt, reason, count(*) AS n
        FROM (SELECT dt, unnest(string_split(warn_reasons, ',')) AS reason FROM valid WHERE warn_reasons <> '')
        GROUP BY dt, reason""",
    "dominant": """
        SELECT dt, reason AS dominant_invalid_reason
        FROM (SELECT *, row_number() OVER (PARTITION BY dt ORDER BY n DESC, reason) AS r FROM invalid_counts)
        WHERE r = 1""",
    "report": """
        SELECT b.dt AS source_date,
          'PENDING_EVALUATION' AS batch_status,
          b.raw_count, b.valid_count, b.invalid_count, b.warning_count,
          round_even(b.invalid_count / b.raw_count, 6) AS invalid_rate,
          round_even(b.warning_count / b.raw_count, 6) AS warning_rate,
          m.dominant_invalid_reason,
          d.duplicate_transactionid_rows_total,
          b.anomaly_high_amount_count,
          CASE WHEN b.valid_count > 0 THEN round_even(b.anomaly_high_amount_count / b.valid_count, 6)
               ELSE 0 END AS anomaly_high_amount_rate,
          b.anomaly_high_quantity_count,
          CASE WHEN b.valid_count > 0 THEN round_even(b.anomaly_high_quantity_count / b.valid_count, 6)
               ELSE 0 END AS anomaly_high_quantity_rate,
          b.amount_min, b.amount_max, b.amount_avg, b.quantity_min, b.quantity_max, b.quantity_avg
        FROM base b JOIN dup d ON b.dt = d.dt LEFT JOIN dominant m ON b.dt = m.dt""",
    "baseline": """
        SELECT *, lag(invalid_rate) OVER (ORDER BY source_date) AS previous_invalid_rate,
                  lag(warning_rate) OVER (ORDER BY source_date) AS previous_warning_rate
        FROM report""",
    "measured": """
        SELECT *, CASE WHEN valid_count > 0 THEN duplicate_transactionid_rows_total / valid_count
                       ELSE 0 END AS dup_ratio,
                  invalid_rate - previous_invalid_rate AS drift
        FROM baseline""",
    "fired": """
        SELECT source_date, 1 AS rule, 3 AS rank, invalid_rate AS value, 0.05::DOUBLE AS threshold,
          printf('Invalid rate %.2f%% exceeds threshold 5.00%%.', invalid_rate * 100) AS text
        FROM measured WHERE invalid_rate > 0.05::DOUBLE
        UNION ALL
        SELECT source_date, 2, 1, warning_rate, 0.10::DOUBLE,
          printf('Warning rate %.2f%% exceeds threshold 10.00%%.', warning_rate * 100)
        FROM measured WHERE warning_rate > 0.10::DOUBLE
        UNION ALL
        SELECT source_date, 3, 2, dup_ratio, 0.01::DOUBLE,
          printf('Duplicate row rate %.2f%% exceeds threshold 1.00%%. Possible replay or upstream dedup issue.', dup_ratio * 100)
        FROM measured WHERE dup_ratio > 0.01::DOUBLE
        UNION ALL
        SELECT source_date, 4, 1, anomaly_high_amount_rate, 0.05::DOUBLE,
          printf('High-amount anomaly rate %.2f%% exceeds threshold 5.00%%.', anomaly_high_amount_rate * 100)
        FROM measured WHERE anomaly_high_amount_rate > 0.05::DOUBLE
        UNION ALL
        SELECT source_date, 5, 2, drift, 0.02::DOUBLE,
          printf('Invalid rate increased by %.2f%% vs previous run (%.2f%% -> %.2f%%). Possible upstream schema change.',
                 drift * 100, previous_invalid_rate * 100, invalid_rate * 100)
        FROM measured WHERE drift > 0.02::DOUBLE""",
    "ranked": """
        SELECT m.*, coalesce(f.rank, 0) AS decision_rank,
          CASE coalesce(f.rank, 0) WHEN 3 THEN 'QUARANTINE' WHEN 2 THEN 'ESCALATE'
               WHEN 1 THEN 'ALLOW_WITH_WARNING' ELSE 'ALLOW' END AS decision
        FROM measured m
        LEFT JOIN (SELECT source_date, max(rank) AS rank FROM fired GROUP BY source_date) f
          ON m.source_date = f.source_date""",
    "all_reasons": """
        SELECT source_date, rule, text FROM fired
        UNION ALL
        SELECT source_date, 6, 'Dominant failure reason: ' || dominant_invalid_reason
               || '. Investigate upstream source for this field.'
        FROM ranked WHERE decision_rank >= 2 AND dominant_invalid_reason <> ''
        UNION ALL
        SELECT source_date, 7, 'All quality checks passed within thresholds.'
        FROM ranked r WHERE NOT EXISTS (SELECT 1 FROM fired f WHERE f.source_date = r.source_date)
          AND NOT (decision_rank >= 2 AND coalesce(dominant_invalid_reason, '') <> '')""",
    "final": """
        SELECT r.*, CAST(substr(r.source_date, 9, 2) AS INTEGER) % 7 AS v,
          CASE WHEN decision_rank = 0 THEN 'ALLOW'
               WHEN v = 0 THEN 'QUARANTINE'
               WHEN v = 1 AND decision_rank < 2 THEN 'ESCALATE'
               ELSE decision END AS final_decision
        FROM ranked r""",
}

_ORDER = list(_CTES)


def _with(last: str, query: str) -> str:
    """``query`` after every step up to ``last``."""
    steps = _ORDER[: _ORDER.index(last) + 1]
    return "WITH " + ",\n".join(f"{name} AS ({_CTES[name]})" for name in steps) + "\n" + query


_TAGGED = (
    "SELECT transactionid, transactionts, storeid, productid, amount, quantity, dt, reasons, warn_reasons "
    "FROM classified WHERE "
)
_CURATED = (
    "SELECT transactionid, transactionts_parsed AS transactionts, storeid, productid, "
    "amount_parsed AS amount, quantity_parsed AS quantity, dt FROM valid"
)
_QUARANTINE = (
    "SELECT transactionid, transactionts, storeid, productid, amount, quantity, transactionts_parsed, "
    "amount_parsed, quantity_parsed, dt, reasons AS _invalid_reasons FROM classified WHERE reasons <> ''"
)
_MEAN = "(SELECT count(*) // count(DISTINCT dt) FROM landing)"
_UNDERSIZED = (
    f"SELECT dt, count(*) AS raw_count, CAST({_MEAN} AS BIGINT) AS min_rows FROM landing "
    f"GROUP BY dt HAVING count(*) < {_MEAN}"
)
_MISSING = (
    "SELECT strftime(d, '%Y-%m-%d') AS dt FROM (SELECT unnest(generate_series("
    "date_trunc('month', min(dt)::DATE)::TIMESTAMP, last_day(max(dt)::DATE)::TIMESTAMP, INTERVAL 1 DAY)) AS d "
    "FROM landing) WHERE strftime(d, '%Y-%m-%d') NOT IN (SELECT dt FROM landing)"
)
_STORED = _with(
    "all_reasons",
    "SELECT r.source_date, r.decision AS batch_status, r.raw_count, r.invalid_count, r.previous_invalid_rate, "
    "(SELECT string_agg(a.text, ' | ' ORDER BY a.rule) FROM all_reasons a "
    "WHERE a.source_date = r.source_date) AS reasons FROM ranked r",
)

ORACLES: dict[str, str] = {
    "typed_rows": _with("typed", "SELECT * FROM typed"),
    "reason_codes": _with("classified", _TAGGED + "true"),
    "invalid_rows": _with("classified", _TAGGED + "reasons <> ''"),
    "valid_rows": _with("classified", _TAGGED + "reasons = ''"),
    "warning_rows": _with("classified", _TAGGED + "reasons = '' AND warn_reasons <> ''"),
    "curated": _with("valid", _CURATED),
    "quarantine": _with("classified", _QUARANTINE),
    "lineitem_rules": (
        "SELECT l_orderkey, l_linenumber, l_partkey, concat_ws(',', "
        "CASE WHEN l_orderkey IS NULL THEN 'missing_order' END, CASE WHEN l_returnflag = 'R' THEN 'returned' END, "
        "CASE WHEN l_extendedprice < 5000 THEN 'low_price' END) AS reasons, concat_ws(',', "
        "CASE WHEN l_discount > 0.08 THEN 'high_discount' END, CASE WHEN l_tax = 0 THEN 'untaxed' END) AS warn_reasons "
        "FROM lineitem"
    ),
    "lineitem_duplicates": (
        "SELECT l_orderkey, l_linenumber, count(*) AS n FROM lineitem "
        "GROUP BY l_orderkey, l_linenumber HAVING count(*) > 1"
    ),
    "base_metrics": _with("base", "SELECT * FROM base"),
    "duplicate_ids": _with("dup_ids", "SELECT * FROM dup_ids"),
    "duplicate_rows": _with(
        "dup",
        "SELECT *, round_even(duplicate_transactionid_rows_total / valid_count, 6) AS duplicate_rate FROM dup",
    ),
    "anomaly_rows": _with(
        "valid",
        "SELECT transactionid, transactionts, storeid, productid, amount, quantity, dt, "
        "amount_parsed > 5000 AS high_amount, quantity_parsed > 50 AS high_quantity "
        "FROM valid WHERE amount_parsed > 5000 OR quantity_parsed > 50",
    ),
    "invalid_breakdown": _with("invalid_counts", "SELECT * FROM invalid_counts"),
    "warning_breakdown": _with("warning_counts", "SELECT * FROM warning_counts"),
    "dominant_reason": _with("dominant", "SELECT * FROM dominant"),
    "quality_report": _with(
        "report",
        "SELECT *, 0.05::DOUBLE AS max_invalid_rate, 0.10::DOUBLE AS max_warning_rate, "
        "5000::DOUBLE AS amount_anomaly_threshold, 50 AS quantity_anomaly_threshold FROM report",
    ),
    "report_breakdowns": _with(
        "warning_counts",
        "SELECT dt AS source_date, reason, n FROM invalid_counts "
        "UNION ALL SELECT dt, reason, n FROM warning_counts",
    ),
    "report_baseline": _with(
        "baseline",
        "SELECT source_date, invalid_rate, warning_rate, previous_invalid_rate, previous_warning_rate "
        "FROM baseline",
    ),
    "decisions": _with(
        "ranked",
        "SELECT source_date, decision, decision_rank, round_even(dup_ratio, 6) AS duplicate_rate, "
        "anomaly_high_amount_rate AS anomaly_amount_rate FROM ranked",
    ),
    "decision_reasons": _with(
        "all_reasons",
        "SELECT source_date, string_agg(text, ' | ' ORDER BY rule) AS reasons FROM all_reasons "
        "GROUP BY source_date",
    ),
    "fired_rules": _with("fired", "SELECT source_date, rule, value, threshold FROM fired"),
    "review_queue": _with(
        "all_reasons",
        "SELECT r.source_date, r.decision, (SELECT string_agg(a.text, '; ' ORDER BY a.rule) "
        "FROM all_reasons a WHERE a.source_date = r.source_date) AS reasons_text, r.source_date AS sent_date, "
        "r.invalid_rate, r.warning_rate, r.duplicate_transactionid_rows_total, r.anomaly_high_amount_rate, "
        "r.previous_invalid_rate, r.dominant_invalid_reason, r.raw_count, r.valid_count, "
        "coalesce((SELECT string_agg(c.reason || '=' || c.n, ',' ORDER BY c.reason) FROM invalid_counts c "
        "WHERE c.dt = r.source_date), '') AS invalid_reason_breakdown, "
        "coalesce((SELECT string_agg(c.reason || '=' || c.n, ',' ORDER BY c.reason) FROM warning_counts c "
        "WHERE c.dt = r.source_date), '') AS warning_reason_breakdown, "
        "'Batch date: ' || r.source_date || chr(10) || 'Deterministic decision: ' || r.decision || chr(10) || "
        "'Reasons: ' || (SELECT string_agg(a.text, '; ' ORDER BY a.rule) FROM all_reasons a "
        "WHERE a.source_date = r.source_date) || chr(10) AS request, true AS request_has_metrics "
        "FROM ranked r WHERE r.decision <> 'ALLOW'",
    ),
    "verdict_merge": _with(
        "final",
        "SELECT source_date, decision, final_decision, "
        "CASE WHEN decision_rank > 0 THEN CASE v WHEN 0 THEN 'severe' WHEN 1 THEN 'fenced' "
        "WHEN 2 THEN 'milder' END END AS agent_reasoning, "
        "CASE WHEN decision_rank > 0 AND v = 0 THEN 'stop,call' END AS agent_actions FROM final",
    ),
    "routes": _with(
        "ranked",
        "SELECT source_date, decision AS final_decision, CASE decision WHEN 'QUARANTINE' THEN 'FAILED' "
        "WHEN 'ESCALATE' THEN 'ESCALATED' ELSE 'SUCCEEDED' END AS terminal_state FROM ranked",
    ),
    "alerts": _with(
        "all_reasons",
        "SELECT source_date, CASE decision WHEN 'QUARANTINE' THEN 'Batch Quarantined - Quality Too Poor' "
        "WHEN 'ESCALATE' THEN 'Batch Escalated - Human Review Required' "
        "ELSE 'Batch Allowed With Warnings' END AS subject, "
        "'Batch for ' || source_date || CASE decision WHEN 'QUARANTINE' THEN ' has been quarantined.' "
        "WHEN 'ESCALATE' THEN ' requires human review.' ELSE ' passed with warnings.' END || ' Reasons: [\"' || "
        "(SELECT string_agg(a.text, '\",\"' ORDER BY a.rule) FROM all_reasons a WHERE a.source_date = ranked.source_date) "
        "|| '\"]' AS message FROM ranked WHERE decision <> 'ALLOW'",
    ),
    "missing_batches": _with("landing", _MISSING),
    "undersized_batches": _with("landing", _UNDERSIZED),
    "guarded_rows": _with(
        "landing",
        "SELECT * FROM landing WHERE dt IN (SELECT dt FROM landing GROUP BY dt "
        f"HAVING count(*) >= {_MEAN})",
    ),
    "failure_alerts": _with(
        "landing",
        "SELECT dt AS source_date, 'Pipeline Failed' AS subject, 'Pipeline failed for date ' || dt "
        "|| '. Error: ' || cause AS message FROM ("
        f"SELECT dt, 'Landing file not found.' AS cause FROM ({_MISSING}) UNION ALL "
        "SELECT dt, 'Row count ' || raw_count || ' below minimum ' || min_rows || '. Aborting.' "
        f"FROM ({_UNDERSIZED}))",
    ),
    "publish_gate": _with(
        "ranked",
        _CURATED + " WHERE dt IN (SELECT source_date FROM ranked WHERE decision_rank <= 1)",
    ),
    "csv_roundtrip": _with("landing", "SELECT * FROM landing"),
    "landed_batches": _with("landing", "SELECT DISTINCT dt FROM landing"),
    "report_roundtrip": _with("report", "SELECT * FROM report"),
    "curated_overwrite": _with("valid", _CURATED),
    "batch_run": _STORED,
    "batch_run_quarantine": _with("classified", _QUARANTINE),
    "stream_available_now": _STORED,
    "stream_two_calls": _STORED,
    "daily_runs": _STORED,
    "batch_run_gated": _with(
        "ranked",
        _CURATED + " WHERE dt IN (SELECT source_date FROM ranked WHERE decision_rank <= 1)",
    ),
    "batch_run_guarded": (
        # The baseline skips the batches left out, so the landing rows are cut first.
        _with(
            "ranked",
            f"SELECT source_date, 'decision' AS kind, decision AS text FROM ranked UNION ALL "
            "SELECT dt, 'failure', 'Pipeline failed for date ' || dt || '. Error: Row count ' || n || ' below minimum ' "
            "|| least || '. Aborting.' FROM (SELECT dt, count(*) AS n, any_value(mean) AS least FROM everything "
            "GROUP BY dt) WHERE n < least",
        ).replace(
            f"landing AS ({_CTES['landing']})",
            f"everything AS (SELECT *, count(*) OVER () // (SELECT count(DISTINCT dt) FROM ({_CTES['landing']})) AS mean, "
            f"count(*) OVER (PARTITION BY dt) AS own FROM ({_CTES['landing']})), "
            "landing AS (SELECT * EXCLUDE (mean, own) FROM everything WHERE own >= mean)",
        )
    ),
    "batch_run_limits": _with(
        "typed",
        "SELECT dt AS source_date, CASE WHEN invalid > 0.4 * n THEN 'QUARANTINE' "
        "WHEN dups > 0.01 * (n - invalid) OR rate - lag(rate) OVER (ORDER BY dt) > 0.02::DOUBLE THEN 'ESCALATE' "
        "WHEN warned > 0.02 * n OR round_even(high / (n - invalid), 6) > 0.05::DOUBLE THEN 'ALLOW_WITH_WARNING' "
        "ELSE 'ALLOW' END AS batch_status, invalid AS invalid_count, n - invalid AS valid_count, "
        "warned AS warning_count FROM (SELECT *, round_even(invalid / n, 6) AS rate FROM ("
        "SELECT dt, count(*) AS n, count(*) FILTER (bad) AS invalid, count(*) FILTER (NOT bad AND warn) AS warned, "
        "count(*) FILTER (NOT bad AND amount_parsed > 5000) AS high, count(*) FILTER (NOT bad AND twice > 1) AS dups "
        "FROM (SELECT *, count(*) FILTER (NOT bad) OVER (PARTITION BY dt, transactionid) AS twice FROM ("
        "SELECT *, transactionid IS NULL OR trim(transactionid) = '' OR transactionts_parsed IS NULL "
        "OR amount_parsed IS NULL OR amount_parsed < 20 OR quantity_parsed IS NULL OR quantity_parsed < 3 AS bad, "
        "storeid IS NULL OR trim(storeid) = '' OR productid IS NULL OR trim(productid) = '' AS warn FROM typed)) "
        "GROUP BY dt))",
    ),
    "missing_metrics": _with(
        "measured",
        "SELECT source_date, CASE WHEN i > 0.05::DOUBLE THEN 'QUARANTINE' WHEN d > 0.01::DOUBLE OR i - p > 0.02::DOUBLE "
        "THEN 'ESCALATE' WHEN w > 0.10::DOUBLE OR a > 0.05::DOUBLE THEN 'ALLOW_WITH_WARNING' ELSE 'ALLOW' END AS decision, "
        "i AS invalid_rate, w AS warning_rate, round_even(d, 6) AS duplicate_rate, a AS anomaly_amount_rate, "
        "raw_count, v AS valid_count, coalesce(nullif(concat_ws(' | ', "
        "CASE WHEN i > 0.05::DOUBLE THEN printf('Invalid rate %.2f%% exceeds threshold 5.00%%.', i * 100) END, "
        "CASE WHEN w > 0.10::DOUBLE THEN printf('Warning rate %.2f%% exceeds threshold 10.00%%.', w * 100) END, "
        "CASE WHEN d > 0.01::DOUBLE THEN printf('Duplicate row rate %.2f%% exceeds threshold 1.00%%. "
        "Possible replay or upstream dedup issue.', d * 100) END, "
        "CASE WHEN a > 0.05::DOUBLE THEN printf('High-amount anomaly rate %.2f%% exceeds threshold 5.00%%.', a * 100) END, "
        "CASE WHEN i - p > 0.02::DOUBLE THEN printf('Invalid rate increased by %.2f%% vs previous run "
        "(%.2f%% -> %.2f%%). Possible upstream schema change.', (i - p) * 100, p * 100, i * 100) END, "
        "CASE WHEN decision IN ('QUARANTINE', 'ESCALATE') AND dominant_invalid_reason <> '' THEN 'Dominant failure reason: ' "
        "|| dominant_invalid_reason || '. Investigate upstream source for this field.' END), ''), "
        "'All quality checks passed within thresholds.') AS reasons FROM (SELECT *, "
        "CASE WHEN k = 0 THEN 0 ELSE invalid_rate END AS i, CASE WHEN k <> 0 THEN previous_invalid_rate END AS p, "
        "CASE WHEN k = 1 THEN 0 ELSE warning_rate END AS w, CASE WHEN k = 2 THEN 0 ELSE anomaly_high_amount_rate END AS a, "
        "CASE WHEN k = 2 THEN 0 ELSE valid_count END AS v, CASE WHEN k IN (1, 2) OR valid_count = 0 THEN 0 "
        "ELSE duplicate_transactionid_rows_total / valid_count END AS d "
        "FROM (SELECT *, CAST(substr(source_date, 9, 2) AS INTEGER) % 3 AS k FROM measured))",
    ),
}

# The same alerts, stored by the job.
ORACLES["batch_run_alerts"] = ORACLES["alerts"]
# The same rows and decisions, whatever the order and the number of runs.
ORACLES["gate_refresh"] = ORACLES["batch_run_gated"]
ORACLES["flat_landing"] = ORACLES["stream_changed_file"] = _STORED
ORACLES["verdict_rerun"] = (
    "SELECT source_date, final_decision AS batch_status, agent_reasoning, agent_actions "
    f"FROM ({ORACLES['verdict_merge']})"
)

_FEED = "SELECT '{0}' AS feed, source_date, decision AS batch_status, raw_count, invalid_count, previous_invalid_rate FROM ({1})"
_DECIDED = _with("ranked", "SELECT * FROM ranked")
ORACLES["two_feeds"] = (
    _FEED.format("first", _DECIDED)
    + " UNION ALL "
    + _FEED.format("second", _DECIDED.replace(f"landing AS ({_CTES['landing']})", (
        f"landing AS (SELECT * FROM ({_CTES['landing']}) WHERE coalesce(length(transactionid) % 2, 0) = 0)"
    )))
)

