"""Every registered query against its SQL counterpart."""

import math
from functools import partial
from pathlib import Path

import duckdb
import pytest

from docmeld.operators.blocking import pair_layout
from docmeld.plans import derived
from docmeld.plans.oracle_queries import ORACLE
from docmeld.plans.registry import QUERIES, VIEWS


@pytest.fixture(scope="module")
def duck(sf_dir):
    connection = duckdb.connect()
    for file in Path(sf_dir).glob("*.parquet"):
        connection.execute(f"CREATE VIEW {file.stem} AS SELECT * FROM '{file}'")
    return connection


def normal(value):
    if isinstance(value, float):
        return None if math.isnan(value) else value + 0.0
    return value


def in_order(rows, columns):
    order = sorted(range(len(columns)), key=columns.__getitem__)
    return sorted((tuple(normal(row[i]) for i in order) for row in rows), key=repr)


def test_every_query_has_a_counterpart():
    assert set(QUERIES) == set(ORACLE)
    assert set(VIEWS) <= set(QUERIES)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_equals_sql(spark, sf_dir, duck, name):
    df = QUERIES[name](spark, sf_dir)
    cursor = duck.execute(ORACLE[name])
    columns = [c[0] for c in cursor.description]
    assert sorted(df.columns) == sorted(columns)
    ours, theirs = in_order(df.collect(), df.columns), in_order(cursor.fetchall(), columns)
    assert len(ours) == len(theirs)
    assert ours == theirs


def test_events_are_the_same_with_every_block_split_and_no_broadcast(spark, sf_dir, duck, monkeypatch):
    monkeypatch.setattr(derived, "pair_layout", partial(pair_layout, pairs_per_task=100))
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        df = QUERIES["match_events"](spark, sf_dir)
        rows = in_order(df.collect(), df.columns)
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    cursor = duck.execute(ORACLE["match_events"])
    assert rows == in_order(cursor.fetchall(), [c[0] for c in cursor.description])


def test_entry(spark):
    import __spark_entry__

    assert {r.match_class: r.cnt for r in __spark_entry__.entry(spark).collect()} == {
        "match": 952, "possible_match": 13, "non_match": 380,
    }
