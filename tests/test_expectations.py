import datetime as dt

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import Observation, functions as F

from docmeld.operators.expectations import (
    DROP, FAIL, WARN, Expectation, apply_expectations, expectations_report, match_expectations,
    pair_expectations, structured_expectations, table_expectations,
)

STRUCTURED = "doc_id string, first_name string, last_name string, dob date, ssn4 string"


def violations(df, rules):
    return {r.rule: r.violations for r in expectations_report(df, rules, "t").collect()}


def test_every_rule_of_the_pipeline(spark):
    rules = table_expectations()
    assert sum(len(r) for r in rules.values()) == 21
    levels = {f"{t}.{r.name}": r.level for t, rs in rules.items() for r in rs if r.level != WARN}
    assert levels == {
        "structured.no_all_nulls": DROP,
        "member_pairs.valid_pair": DROP,
        "auth_pairs.valid_pair": DROP,
        "member_matches.weight_class_consistent": FAIL,
        "auth_matches.weight_class_consistent_auth": FAIL,
    }


def test_structured_rules(spark):
    rows = [
        ("d1", "Ann", None, dt.date(1980, 1, 1), "0042"),
        (None, None, None, None, "12a4"),
        ("d3", None, None, dt.date(1899, 12, 31), "123"),
        ("d4", None, None, dt.date(2031, 1, 1), None),
        ("d5", None, None, None, None),
    ]
    today = F.lit(dt.date(2030, 1, 1))
    assert violations(spark.createDataFrame(rows, STRUCTURED), structured_expectations(today)) == {
        "doc_id_present": 1, "has_extracted_field": 2, "valid_dob_format": 2, "valid_ssn4_format": 2, "no_all_nulls": 1,
    }


def test_null_flags_do_not_pass(spark):
    schema = "doc_id string, member_id string, first_name_sim double, last_name_sim double, ssn4_exact double, dob_exact double"
    rows = [("d", "m", 0.5, 1.0, 1.0, 0.0), ("d", "m", 0.5, 1.2, None, 0.0), ("d", None, 0.0, 0.0, 1.0, 1.0)]
    assert violations(spark.createDataFrame(rows, schema), pair_expectations("member_id")) == {
        "valid_pair": 1, "valid_similarity_scores": 1, "valid_exact_flags": 1,
    }


def test_drop_removes_and_warn_keeps(spark):
    df = spark.createDataFrame([(1, "a"), (2, None), (None, "c")], "id int, v string")
    rules = [Expectation("v_given", F.col("v").isNotNull()), Expectation("id_positive", F.col("id") > 0, DROP)]
    assert {r.id for r in apply_expectations(df, rules).collect()} == {1, 2}


def test_counts_are_taken_before_dropping(spark):
    df = spark.createDataFrame([(1, "a"), (2, None), (None, None)], "id int, v string")
    rules = [Expectation("id_given", F.col("id").isNotNull(), DROP), Expectation("v_given", F.col("v").isNotNull())]
    seen = Observation()
    checked = apply_expectations(df, rules, seen)
    assert checked.count() == 2
    assert seen.get == {"total": 3, "id_given": 1, "v_given": 2}


MATCHES = "total_weight double, match_class string"


def test_fail_stops_the_query(spark, tmp_path):
    bad = spark.createDataFrame([(9.0, "match"), (3.0, "match")], MATCHES)
    with pytest.raises(PySparkException, match="weight_class_consistent"):
        apply_expectations(bad, match_expectations()).write.parquet(str(tmp_path / "out"))
    assert not list((tmp_path / "out").glob("*.parquet"))


def test_fail_is_not_pruned_with_its_column(spark):
    bad = spark.createDataFrame([(3.0, "match")], MATCHES)
    with pytest.raises(PySparkException, match="weight_class_consistent"):
        apply_expectations(bad, match_expectations()).select(F.lit(1)).count()


def test_good_rows_pass_the_fail_rule(spark):
    good = spark.createDataFrame([(9.0, "match"), (3.0, "non_match")], MATCHES)
    assert apply_expectations(good, match_expectations()).count() == 2
