"""Reports over sums of pairs against the same reports over the pairs themselves."""

import datetime as dt
import itertools
import random

import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from docmeld.config import MatchWeights
from docmeld.operators import reports, states, summed
from docmeld.operators.blocking import MEMBER_RULES, candidate_pairs
from docmeld.operators.expectations import apply_expectations, expectations_report, match_expectations, pair_expectations
from docmeld.operators.scoring import fs_score, pair_features
from docmeld.plans.derived import DerivedTables
from docmeld.plans.registry import QUERIES
from docmeld.workspace import Workspace

DOCUMENT = "doc_id string, pipeline_run_ts timestamp, first_name string, last_name string, ssn4 string, dob date"
MEMBER = "member_id string, first_name string, last_name string, ssn4 string, dob date"
DAYS = [None, dt.date(1980, 1, 1), dt.date(1990, 2, 2)]
NAMES = [("Ann", "Lee"), ("Anna", None), (None, "Müller"), ("", "lee "), ("Bob", "Eel")]


@pytest.fixture(scope="module")
def lanes(spark):
    """Null and empty anchors and names, a frequent key, rows that come twice, rows without an id."""
    rng = random.Random(5)
    keys = list(itertools.product([None, "", "0001", "0002"], DAYS, NAMES)) + [("0001", DAYS[1], n) for n in NAMES] * 9
    rng.shuffle(keys)
    stamps = [None, dt.datetime(2025, 1, 1, 12), dt.datetime(2025, 1, 2, 23)]
    docs = [(f"d{i % 80}" if i else None, stamps[i % 3], *names, ssn4, dob) for i, (ssn4, dob, names) in enumerate(keys + keys[:5])]
    members = [(f"m{i}" if i % 7 else None, *names, ssn4, dob) for i, (ssn4, dob, names) in enumerate(keys + keys[8:14])]
    return spark.createDataFrame(docs, DOCUMENT), spark.createDataFrame(members, MEMBER)


def formed(lanes, weights=MatchWeights()):
    features = pair_features(candidate_pairs(*lanes, MEMBER_RULES), "member_id")
    return fs_score(apply_expectations(features, pair_expectations("member_id")), weights, scored_ts=F.col("pipeline_run_ts"))


def sums(spark, lanes, **more):
    return summed.summed_matches(Workspace(spark), "sums", *lanes, {"batch_date": F.to_date("pipeline_run_ts")}, **more)


def rows(df):
    return sorted(map(str, df.select(*sorted(df.columns)).collect()))


@pytest.fixture(params=["whole", "in small lots"])
def lots(request, monkeypatch):
    if request.param != "whole":
        monkeypatch.setattr(summed, "HELD", 7)
        monkeypatch.setattr(summed, "TABLE", 0)
        monkeypatch.setattr(summed, "PAIRS_PER_TASK", 100)


def test_reports_of_sums_are_those_of_pairs(spark, lanes, lots, tmp_path):
    pairs, table = formed(lanes), sums(spark, lanes)
    for report in (reports.match_distribution, reports.score_histogram, reports.match_summary, reports.batch_match_metrics):
        assert rows(report(table)) == rows(report(pairs)), report.__name__
    state = states.StateTable(spark, str(tmp_path / "state"), states.summed_match_measures())
    state.add(table.where("match_class = 'match'"), 0)
    state.add(table.where("match_class <> 'match'"), 1)
    for kept, whole in ((states.match_summary, reports.match_summary), (states.score_histogram, reports.score_histogram), (states.batch_match_metrics, reports.batch_match_metrics)):
        assert rows(kept(state)) == rows(whole(pairs)), whole.__name__


def test_best_of_each_document(spark, lanes, lots):
    parsed = lanes[0].select("doc_id", F.lit(False).alias("unreadable_flag"))
    best = summed.best_matches(Workspace(spark), "best", *lanes)
    assert rows(reports.doc_match_status(parsed, best)) == rows(reports.doc_match_status(parsed, formed(lanes)))


def test_violations_counted_over_sums(spark, lanes, lots):
    weights, lost = MatchWeights(match_at=2.0), F.col("member_id").endswith("3")
    pairs = formed(lanes, weights).withColumn("member_id", F.when(~lost, F.col("member_id")))
    table = sums(spark, lanes, right_keys={"lost": lost}, weights=weights)
    sim = F.when(F.col("sims_valid"), F.col("first_sum") / F.col("pairs"))
    table = table.withColumns({"doc_id": F.lit("any"), "member_id": F.when(~F.col("lost"), "any"), "first_name_sim": sim, "last_name_sim": sim, "total_weight": F.col("weight_min")})
    for rules in (pair_expectations("member_id"), match_expectations()):
        want = expectations_report(pairs, rules, "t")
        assert want.where("violations > 0").count() > 0
        assert rows(expectations_report(table, rules, "t", "pairs")) == rows(want)


def test_a_match_that_is_too_light_stops_the_run(spark, lanes):
    weights = MatchWeights(match_at=2.0)
    with pytest.raises(Exception, match="weight_class_consistent"):
        summed.checked(sums(spark, lanes, weights=weights)).collect()
    with pytest.raises(Exception, match="weight_class_consistent"):
        summed.best_matches(Workspace(spark), "best", *lanes, weights)


def test_partners_of_equal_names_are_scored_together():
    """Cells grow with the distinct names of a block and the values of the other anchor a document meets, not with its partners."""
    block = {"task": 0, "rule": 0, "key": "0001", "cell": 0}
    docs = [block | {"l_first_name": "Ann", "l_last_name": "Lee", "l_ssn4": "0001", "l_dob": dob} for dob in DAYS]
    members = [
        block | {"r_first_name": name, "r_last_name": "Lee", "r_ssn4": "0001", "r_dob": dob, "r_n": 1000 + k}
        for name in ("Ann", "Bob") for k, dob in enumerate([*DAYS, dt.date(1970, 1, 1)])
    ]
    lots = list(summed._lots(pa.Table.from_pylist(docs), pa.Table.from_pylist(members), MatchWeights(), []))
    found = {}
    for lot in lots:
        assert len(set(zip(lot.left, lot.right, lot.flags[1]))) == len(lot.left)
        for i, j, dob, n in zip(lot.left, lot.right, lot.flags[1], lot.pairs):
            key = (int(i), members[j]["r_first_name"], int(dob))
            found[key] = found.get(key, 0) + int(n)
    unknown = {(0, name, 2): 4006 for name in ("Ann", "Bob")}
    of_day = {(i, name, dob): n for i, same in ((1, 1001), (2, 1002)) for name in ("Ann", "Bob") for dob, n in ((2, 1000), (1, same), (0, 3006 - same))}
    assert found == unknown | of_day


def test_no_keys_no_pairs(spark, lanes):
    docs = lanes[0].where("ssn4 is null and dob is null")
    nobody = lanes[1].where("false")
    assert sums(spark, (docs, nobody)).isEmpty() and summed.best_matches(Workspace(spark), "best", docs, nobody).isEmpty()


def test_weights_round_as_in_spark(spark):
    weights = [0.5, -0.5, 1.5, 2.5, -2.5, 0.49999999999999994, 2.4999999999999996, -0.2, 7.0]
    df = spark.createDataFrame([(w,) for w in weights], "w double").select(F.round("w", 0))
    assert [r[0] for r in df.collect()] == summed._rounded(pa.array(weights).to_numpy()).tolist()


@pytest.mark.parametrize("name", ["match_distribution", "v_doc_match_status", "v_score_distribution_kept", "expectations_report"])
def test_queries_form_no_member_pairs(spark, sf_dir, name, monkeypatch):
    def refuse(self):
        raise AssertionError("pairs of the member lane were formed")

    monkeypatch.setattr(DerivedTables, "member_candidates", property(refuse))
    assert not QUERIES[name](spark, sf_dir).isEmpty()
