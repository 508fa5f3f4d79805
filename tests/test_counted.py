"""Counted classes against the pairs themselves."""

import datetime as dt
import itertools

import pytest
from pyspark.sql import functions as F

from docmeld.config import MatchWeights
from docmeld.operators import counted, metrics, reports, validation
from docmeld.operators.blocking import candidate_pairs
from docmeld.operators.expectations import apply_expectations, pair_expectations
from docmeld.operators.scoring import fs_score, pair_features
from docmeld.workspace import Workspace

DOCUMENT = "doc_id string, pipeline_run_ts timestamp, first_name string, last_name string, ssn4 string, dob date"
MEMBER = "member_id string, first_name string, last_name string, ssn4 string, dob date"
DAYS = [None, dt.date(1980, 1, 1), dt.date(1990, 2, 2)]


@pytest.fixture(scope="module")
def lanes(spark):
    """Every combination of anchors, null and empty ones, rows that come twice, and rows without an id."""
    keys = list(itertools.product([None, "", "0001", "0002"], DAYS, [("Ann", "Lee"), ("Bob", None)]))
    noon = dt.datetime(2025, 1, 1, 12)
    docs = [(f"d{i % 20}" if i else None, noon, *names, ssn4, dob) for i, (ssn4, dob, names) in enumerate(keys + keys[:5])]
    members = [(f"m{i}" if i % 7 else None, *names, ssn4, dob) for i, (ssn4, dob, names) in enumerate(keys + keys[8:14])]
    return spark.createDataFrame(docs, DOCUMENT), spark.createDataFrame(members, MEMBER)


def matches_by(weights, formed):
    def scored(docs, members, rules):
        pairs = candidate_pairs(docs, members, rules)
        formed.append(pairs)
        features = apply_expectations(pair_features(pairs, "member_id"), pair_expectations("member_id"))
        return fs_score(features, weights, scored_ts=F.col("pipeline_run_ts"))

    return scored


def rows(df):
    return sorted(map(tuple, df.collect()), key=str)


# names may lift a pair over the second's threshold; by the third an equal SSN4 alone is a possible match, whatever the names
@pytest.mark.parametrize("weights", [MatchWeights(), MatchWeights(possible_at=2.0), MatchWeights(ssn4=6.0, dob=1.0, possible_at=2.5)])
def test_counts_are_those_of_the_pairs(spark, lanes, weights):
    formed = []
    got = counted.member_match_counts(Workspace(spark), *lanes, matches_by(weights, formed), weights)
    whole = matches_by(weights, [])(*lanes, counted.MEMBER_RULES)
    assert rows(got.select(*counted.KEYS, "pairs")) == rows(counted.counted(whole).select(*counted.KEYS, "pairs"))
    decided = weights.possible_at != 2.0
    anchors = (F.col("l_ssn4") == F.col("r_ssn4")) & (F.col("l_dob") == F.col("r_dob"))
    assert formed[0].where(~F.coalesce(anchors, F.lit(False))).isEmpty() == decided


def test_reports_take_counts_in_place_of_pairs(spark, lanes):
    pairs = matches_by(MatchWeights(), [])(*lanes, counted.MEMBER_RULES)
    counts = counted.counted(pairs)
    assert rows(validation.duplicate_doc_ids(counts)) == rows(validation.duplicate_doc_ids(pairs))
    assert rows(validation.table_counts({"t": counts})) == rows(validation.table_counts({"t": pairs}))
    parsed = lanes[0].where("doc_id is not null").select("doc_id", F.lit(False).alias("unreadable_flag"), F.lit(None).cast("string").alias("parse_error_status"))
    structured = parsed.select("doc_id", F.lit(True).alias("missing_dob"), F.lit(False).alias("missing_ssn4"))
    for of in (metrics.dq_metrics, metrics.dq_metrics_pairweighted):
        assert rows(of(parsed, structured, counts)) == rows(of(parsed, structured, pairs))
    tiers = reports.doc_match_status(parsed, pairs).select("doc_id", "best_class", "doc_risk_tier")
    assert rows(reports.doc_risk(parsed, counts)) == rows(tiers)
