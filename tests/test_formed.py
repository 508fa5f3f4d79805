"""Pair features formed as arrays against those of the join."""

import datetime as dt
import itertools
import random

import numpy as np
import pytest

from docmeld.operators import blocking, formed, summed
from docmeld.operators.blocking import MEMBER_RULES, candidate_pairs
from docmeld.operators.scoring import pair_features
from docmeld.plans.registry import QUERIES
from docmeld.workspace import Workspace

DOCUMENT = "doc_id string, pipeline_run_ts timestamp, first_name string, last_name string, ssn4 string, dob date"
MEMBER = "member_id string, first_name string, last_name string, ssn4 string, dob date"
DAYS = [None, dt.date(1980, 1, 1), dt.date(1990, 2, 2)]
NAMES = [("Ann", "Lee"), ("Anna", None), (None, "Müller"), ("", "lee "), ("Bob", "Eel")]


@pytest.fixture(scope="module")
def lanes(spark):
    """Null and empty anchors and names, a frequent key, rows that come twice, rows without an id."""
    rng = random.Random(6)
    keys = list(itertools.product([None, "", "0001", "0002"], DAYS, NAMES)) + [("0001", DAYS[1], n) for n in NAMES] * 9
    rng.shuffle(keys)
    stamps = [None, dt.datetime(2025, 1, 1, 12), dt.datetime(2025, 1, 2, 23)]
    docs = [(f"d{i % 80}" if i else None, stamps[i % 3], *names, ssn4, dob) for i, (ssn4, dob, names) in enumerate(keys + keys[:5])]
    members = [(f"m{i}" if i % 7 else None, *names, ssn4, dob) for i, (ssn4, dob, names) in enumerate(keys + keys[8:14])]
    return spark.createDataFrame(docs, DOCUMENT), spark.createDataFrame(members, MEMBER)


def rows(df):
    return sorted(map(str, df.collect()))


@pytest.mark.parametrize("small", [False, True])
def test_features_are_those_of_the_join(spark, lanes, small, monkeypatch):
    if small:
        monkeypatch.setattr(formed, "HELD", 7)
        monkeypatch.setattr(formed, "STRETCH", 3)
        monkeypatch.setattr(summed, "TABLE", 0)
    expected = pair_features(candidate_pairs(*lanes, MEMBER_RULES), "member_id")
    found = formed.member_pair_features(Workspace(spark), "layout", *lanes, 100 if small else formed.PAIRS_PER_TASK)
    assert found.schema == expected.schema
    assert rows(found) == rows(expected)


def test_lists_and_not_pairs_are_handed_over(spark, monkeypatch):
    """What Python hands to Spark grows with both sides of a block and their distinct names, not with its pairs."""
    docs = spark.createDataFrame([(f"d{i}", None, *NAMES[i % 2], "0001", DAYS[1 + i % 2]) for i in range(60)], DOCUMENT)
    members = spark.createDataFrame([(f"m{i}", *NAMES[i % 2], "0001", DAYS[1 + i % 2]) for i in range(50)], MEMBER)
    assert formed.member_pair_features(Workspace(spark), "layout", docs, members).count() == 3000
    monkeypatch.setattr(formed, "_exploded", lambda handed: handed)
    monkeypatch.setattr(blocking, "SHARES", 1)
    handed = formed.member_pair_features(Workspace(spark), "layout", docs, members)
    values = [len(x) for row in handed.collect() for x in row if isinstance(x, list)]
    # both rules find pairs
    assert 0 < sum(values) < 3000 + 1500


def test_no_keys_give_no_pairs(spark, lanes):
    none = formed.member_pair_features(Workspace(spark), "layout", lanes[0].where("false"), lanes[1].where("false"))
    assert none.columns[:2] == ["doc_id", "member_id"] and none.isEmpty()


def test_long_runs_are_cut():
    assert formed._stretches(np.array([4, 4, 4, 4, 1, 2, 2]), 3).tolist() == [0, 3, 4, 5, 7]


@pytest.mark.parametrize("name", ["pair_features_member", "fs_score", "match_events"])
def test_queries_of_all_pairs_compare_no_names_row_by_row(spark, sf_dir, name):
    """Names of the member lane travel once per document and task, not once per pair."""
    plan = QUERIES[name](spark, sf_dir)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("FlatMapGroupsInArrow") == 1
    assert plan.count("ArrowEvalPython") == (1 if name == "match_events" else 0)
