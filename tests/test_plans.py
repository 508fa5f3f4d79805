"""What the plans of costly queries must and must not hold."""

import re

import pytest

from docmeld.operators.blocking import MEMBER_RULES, candidate_pairs, hot_blocks, pair_layout
from docmeld.plans import derived, registry
from docmeld.plans.registry import QUERIES
from docmeld.sources.tables import dealt
from docmeld.workspace import Workspace


def plan(df):
    return df._jdf.queryExecution().toString()


@pytest.mark.parametrize("name", ["expectations_report", "orphan_structured", "v_pipeline_kpis", "dq_metrics", "validation_report"])
def test_texts_are_read_and_extracted_once(spark, sf_dir, name):
    text = plan(QUERIES[name](spark, sf_dir))
    assert "regexp_extract" not in text and "raw_text#" not in text and "documents.parquet" not in text


@pytest.mark.parametrize("name", ["parse_documents", "structure_documents", "jaro_winkler"])
def test_scans_are_not_dealt_anew(spark, sf_dir, name):
    assert "Repartition" not in plan(QUERIES[name](spark, sf_dir))


def test_narrow_tables_of_few_splits_are_dealt_before_costly_steps(spark, sf_dir):
    assert "RepartitionByExpression [o_orderkey" in plan(QUERIES["extract_fields"](spark, sf_dir))
    many = spark.range(0, 100, 1, 50)
    assert dealt(many, "id") is many


def test_share_of_total_is_no_window(spark, sf_dir):
    assert "Window" not in plan(QUERIES["auth_status_share"](spark, sf_dir))


def test_hot_keys_are_not_brought_together_to_be_looked_up(spark):
    left = spark.createDataFrame([(i, "hot" if i % 2 else str(i), None) for i in range(200)], "doc_id int, ssn4 string, dob string")
    right = spark.createDataFrame([(i, "hot" if i % 2 else str(i), None) for i in range(60)], "member_id int, ssn4 string, dob string")
    ws = Workspace(spark)
    left, right = ws.store(left, "left"), ws.store(right, "right")
    hot = ws.store(hot_blocks(left, right, MEMBER_RULES, 500), "hot")
    expected = sorted(map(tuple, candidate_pairs(left, right, MEMBER_RULES).select("l_doc_id", "r_member_id").collect()))
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        for limit in (1 << 20, 0):
            pairs = candidate_pairs(left, right, MEMBER_RULES, hot, hot_limit=limit)
            exchanges = re.findall(r"Exchange hashpartitioning\(([^)]*)\)", pairs._jdf.queryExecution().executedPlan().toString())
            assert exchanges and not [e for e in exchanges if "salt" not in e and "cell" not in e]
            assert sorted(map(tuple, pairs.select("l_doc_id", "r_member_id").collect())) == expected
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_candidates_are_dealt_as_ids_and_anchors(spark, sf_dir, monkeypatch):
    """Rows that are copied to the parts of a block carry no more than a candidate needs."""
    sides = []
    monkeypatch.setattr(derived, "pair_layout", lambda w, n, left, right, *a, **k: sides.append((left, right)) or pair_layout(w, n, left, right, *a, **k))
    t = derived.DerivedTables(spark, sf_dir)
    found = registry.candidate_pairs_member(t)
    assert [set(x.columns) for x in sides[0]] == [{"doc_id", "ssn4", "dob"}, {"member_id", "ssn4", "dob"}]
    whole = t.member_candidates.select("l_doc_id", "r_member_id")
    assert found.count() == whole.count() > 0
    assert found.exceptAll(whole).isEmpty()
