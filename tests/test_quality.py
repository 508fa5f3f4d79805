import datetime as dt

import pytest
from pyspark.sql import functions as F

from docmeld.config import DEMO_LIMITS, QualityLimits, parse_bytes
from docmeld.operators.gates import QualityBreach, refresh_views, run_gates
from docmeld.operators.metrics import (
    dq_gate, dq_metrics, dq_metrics_pairweighted, dq_threshold_report, latest_run, recent_runs,
)
from docmeld.operators.validation import (
    ValidationFailed, assert_valid, duplicate_doc_ids, missing_structured, orphans, table_counts, validation_report,
)
from docmeld.sources.logs import DQ_RESULTS_SCHEMA, LogTable, RunLog

PARSED = "doc_id string, unreadable_flag boolean, parse_error_status string"
STRUCTURED = "doc_id string, missing_dob boolean, missing_ssn4 boolean"
MATCHES = "doc_id string, match_class string"


def tables(spark, parsed, structured, matches=(), pairs=None):
    p = spark.createDataFrame(list(parsed), PARSED)
    s = spark.createDataFrame(list(structured), STRUCTURED)
    m = spark.createDataFrame(list(matches), MATCHES)
    member_pairs = m if pairs is None else spark.createDataFrame(list(pairs), MATCHES)
    none = spark.createDataFrame([], MATCHES)
    return {
        "parsed": p, "structured": s, "member_pairs": member_pairs, "auth_pairs": none,
        "member_matches": m, "auth_matches": none, "match_events": m,
    }


GOOD = dict(
    parsed=[("a", False, None), ("b", False, None), ("c", True, "CORRUPT")],
    structured=[("a", True, False), ("b", False, False)],
    matches=[("a", "match"), ("a", "non_match"), ("b", "possible_match")],
)


def report(spark, **kwargs):
    return {r.check: (r.passed, r.detail) for r in validation_report(tables(spark, **kwargs)).collect()}


def test_good_tables_pass(spark):
    checks = report(spark, **GOOD)
    assert all(passed is not False for passed, _ in checks.values())
    assert checks["extraction_complete"] == (True, "rate=100.0, missing=0, readable=2")
    assert checks["auth_matches_populated"][0] is None
    assert_valid(validation_report(tables(spark, **GOOD)))


def test_each_check_can_fail(spark):
    checks = report(
        spark,
        parsed=[("a", False, None), ("a", False, None), ("b", False, None), ("c", False, None)],
        structured=[("x", True, True), ("x", True, True), (None, True, True), ("a", False, False)],
        matches=[("a", "sure")],
    )
    failed = {name for name, (passed, _) in checks.items() if passed is False}
    assert failed == {
        "parsed_doc_ids_unique", "structured_doc_ids_unique", "structured_in_parsed", "member_classes_valid", "extraction_complete",
    }
    assert checks["structured_in_parsed"][1] == "orphans=3"
    assert checks["extraction_complete"][1] == "rate=50.0, missing=2, readable=4"


def test_empty_tables(spark):
    checks = report(spark, parsed=[], structured=[])
    assert checks["parsed_has_rows"][0] is False
    assert checks["structured_has_rows"][0] is None and checks["extraction_complete"][0] is None


def test_matches_must_follow_pairs(spark):
    checks = report(spark, **{**GOOD, "matches": [], "pairs": [("a", "x")]})
    assert checks["member_matches_populated"] == (False, "pairs=1, matches=0")


def test_null_class_is_not_invalid(spark):
    assert report(spark, **{**GOOD, "matches": [("a", None)]})["member_classes_valid"][0] is True


def test_one_exception_names_all_failures(spark):
    bad = tables(spark, parsed=[("a", False, None)] * 2, structured=[("x", True, True)])
    with pytest.raises(ValidationFailed) as failure:
        assert_valid(validation_report(bad))
    assert "parsed_doc_ids_unique" in str(failure.value) and "structured_in_parsed" in str(failure.value)


def test_orphans_and_duplicates(spark):
    t = tables(spark, parsed=[("a", False, None), ("b", False, None), ("u", True, None)], structured=[("a", True, True), ("x", True, True), ("x", True, True), (None, True, True)])
    assert {(r.doc_id, r["rows"]) for r in orphans(t["structured"], t["parsed"]).collect()} == {("x", 2), (None, 1)}
    assert [r.doc_id for r in missing_structured(t["parsed"], t["structured"]).collect()] == ["b"]
    assert [(r.doc_id, r.cnt) for r in duplicate_doc_ids(t["structured"]).collect()] == [("x", 2)]
    assert {r.table: r["rows"] for r in table_counts(t).collect()}["structured"] == 4


def metrics(spark, form, **kwargs):
    t = tables(spark, **kwargs)
    return form(t["parsed"], t["structured"], t["member_matches"]).first()


def test_metrics_count_documents_once(spark):
    row = metrics(spark, dq_metrics, **GOOD)
    assert (row.total_docs, row.pct_unreadable, row.pct_missing_dob, row.parse_errors) == (3, 33.33, 33.33, 1)
    assert (row.pct_match, row.pct_possible_match, row.pct_non_match) == (33.33, 33.33, 33.33)


def test_pairweighted_form_may_pass_100_percent(spark):
    kwargs = dict(
        parsed=[("a", False, None), ("b", False, None)],
        structured=[("a", True, False), ("b", False, False)],
        matches=[("a", "match"), ("a", "non_match"), ("a", "non_match")],
    )
    assert metrics(spark, dq_metrics_pairweighted, **kwargs).pct_missing_dob == 150.0
    assert metrics(spark, dq_metrics, **kwargs).pct_missing_dob == 50.0


def test_pairweighted_form_equals_the_joins(spark):
    t = tables(
        spark,
        parsed=[("a", False, None), ("a", True, "E"), ("b", False, None), (None, True, "E"), ("d", False, None)],
        structured=[("a", True, False), ("a", False, True), ("b", True, True), (None, True, True), ("z", True, True)],
        matches=[("a", "match"), ("a", "non_match"), ("b", None), ("b", "match"), (None, "match"), ("y", "match")],
    )
    for name in ("parsed", "structured", "member_matches"):
        t[name].createOrReplaceTempView("q_" + name)
    joined = spark.sql("""
        SELECT count(DISTINCT p.doc_id) AS docs, count_if(unreadable_flag) AS unreadable, count_if(missing_dob) AS dob,
               count_if(missing_ssn4) AS ssn4, count(parse_error_status) AS errors, count(match_class) AS classed,
               count_if(match_class = 'match') AS matched
        FROM q_parsed p LEFT JOIN q_structured s ON p.doc_id = s.doc_id LEFT JOIN q_member_matches m ON p.doc_id = m.doc_id
    """).first()
    row = dq_metrics_pairweighted(t["parsed"], t["structured"], t["member_matches"]).first()
    share = lambda n, d: round(100 * n / d + 1e-9, 2)
    assert (row.total_docs, row.parse_errors) == (joined.docs, joined.errors)
    assert row.pct_unreadable == share(joined.unreadable, joined.docs)
    assert row.pct_missing_dob == share(joined.dob, joined.docs)
    assert row.pct_missing_ssn4 == share(joined.ssn4, joined.docs)
    assert row.pct_match == share(joined.matched, joined.classed)


def test_gate_statuses(spark):
    schema = "pct_unreadable double, pct_missing_dob double, pct_missing_ssn4 double"
    rows = {r.metric: (r.breached, r.status) for r in dq_gate(spark.createDataFrame([(5.0, 20.01, None)], schema)).collect()}
    assert rows == {"pct_unreadable": (False, "PASS"), "pct_missing_dob": (True, "BREACH"), "pct_missing_ssn4": (None, "NO_DATA")}


def test_metrics_without_documents_are_no_data(spark):
    t = tables(spark, parsed=[], structured=[])
    gate = dq_gate(dq_metrics(t["parsed"], t["structured"], t["member_matches"]))
    assert {r.status for r in gate.collect()} == {"NO_DATA"}


def test_threshold_report(spark):
    t = tables(spark, **GOOD)
    rows = {r.check_name: (r.value, r.threshold, r.status) for r in dq_threshold_report(t["parsed"], t["structured"]).collect()}
    assert rows["Pct Unreadable"] == (33.33, "< 15%", "FAIL")
    assert rows["Pct Missing DOB"] == (50.0, "< 95%", "PASS")
    assert rows["Total Structured"] == (2.0, "n/a", "INFO")


def gates(spark, tmp_path, data, limits, views=None):
    results = LogTable(spark, str(tmp_path / "results"), DQ_RESULTS_SCHEMA)
    log = RunLog(spark, str(tmp_path / "log"))
    run = lambda ts: run_gates(tables(spark, **data), results, log, views or {}, limits, ts)
    return results, log, run


def test_gates_log_success(spark, tmp_path):
    views = {"v_one": lambda: spark.range(3), "v_bad": lambda: spark.table("no_such_table")}
    results, log, run = gates(spark, tmp_path, GOOD, QualityLimits(50, 50, 50), views)
    outcome = run(dt.datetime(2025, 1, 1))
    assert outcome["v_one"] == "REFRESHED" and outcome["v_bad"].startswith("SKIPPED")
    assert spark.table("v_one").count() == 3
    run(dt.datetime(2025, 1, 2))
    assert [r.status for r in recent_runs(log.read()).collect()] == ["SUCCESS", "SUCCESS"]
    assert log.read().first().run_by
    assert latest_run(results.read()).first().run_ts == dt.datetime(2025, 1, 2)


def test_gate_judges_its_own_run(spark, tmp_path):
    results, log, run = gates(spark, tmp_path, GOOD, QualityLimits(0, 0, 0))
    clean = {**GOOD, "parsed": [("a", False, None), ("b", False, None)], "structured": [("a", False, False), ("b", False, False)]}
    _, _, run_clean = gates(spark, tmp_path, clean, QualityLimits(0, 0, 0))
    run_clean(dt.datetime(2030, 1, 1))
    for stamp in (dt.datetime(2025, 1, 1), dt.datetime(2030, 1, 1), dt.datetime(2030, 1, 1)):
        with pytest.raises(QualityBreach):
            run(stamp)
    run_clean(dt.datetime(2025, 1, 1))
    assert sorted((r.run_ts.year, r.status) for r in log.read().collect()) == [
        (2025, "DQ_BREACH"), (2025, "SUCCESS"), (2030, "DQ_BREACH"), (2030, "DQ_BREACH"), (2030, "SUCCESS"),
    ]


def test_metrics_since_a_time(spark):
    stamp = lambda day: dt.datetime(2025, 1, day)
    t = tables(spark, **GOOD)
    days = spark.createDataFrame([("a", stamp(1)), ("b", stamp(3)), ("c", stamp(3))], "doc_id string, pipeline_run_ts timestamp")
    parsed, structured, matches = (t[n].join(days, "doc_id") for n in ("parsed", "structured", "member_matches"))
    row = dq_metrics(parsed, structured, matches, since=F.lit(stamp(2))).first()
    assert (row.total_docs, row.pct_unreadable, row.pct_missing_dob, row.pct_possible_match) == (2, 50.0, 0.0, 100.0)


def test_breach_is_logged_raised_and_stops_the_views(spark, tmp_path):
    built = []
    _, log, run = gates(spark, tmp_path, GOOD, DEMO_LIMITS, {"v": lambda: built.append(1)})
    with pytest.raises(QualityBreach, match="pct_unreadable=33.33%"):
        run(dt.datetime(2025, 1, 1))
    assert [r.status for r in log.read().collect()] == ["DQ_BREACH"] and not built


def test_failed_validation_stops_the_metrics(spark, tmp_path):
    results, log, run = gates(spark, tmp_path, {**GOOD, "structured": [("x", True, True)]}, DEMO_LIMITS)
    results.create_if_missing()
    with pytest.raises(ValidationFailed):
        run(dt.datetime(2025, 1, 1))
    assert [r.status for r in log.read().collect()] == ["VALIDATION_FAILED"]
    assert results.read().count() == 0


def test_log_table_is_created_once(spark, tmp_path):
    log = RunLog(spark, str(tmp_path / "log"))
    log.create_if_missing()
    log.record("SUCCESS")
    log.create_if_missing()
    assert log.read().count() == 1


def test_refresh_replaces_a_view(spark):
    refresh_views(spark, {"v_again": lambda: spark.range(1)})
    refresh_views(spark, {"v_again": lambda: spark.range(2)})
    assert spark.table("v_again").count() == 2


@pytest.mark.parametrize("text, size", [("10g", 10 << 30), ("5MB", 5 << 20), ("1.5k", 1536), (77, 77), ("88", 88)])
def test_byte_sizes(text, size):
    assert parse_bytes(text) == size
