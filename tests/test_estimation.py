"""Agreement patterns against all pairs, and estimates against known owners."""

import itertools
import math
import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

from docmeld.operators import estimation as est
from docmeld.operators.scoring import fs_parameters
from docmeld.plans.derived import DerivedTables

SCHEMA = "id long, ssn4 string, dob string, first_name string, last_name string"


def plain_patterns(left, right):
    same = lambda v: (v.strip(" ").lower() or None) if v is not None else None
    out = Counter()
    for a, b in itertools.product(left, right):
        x, y = [[same(v) for v in r[1:]] for r in (a, b)]
        present = sum(1 << i for i in range(4) if x[i] is not None and y[i] is not None)
        out[present, sum(1 << i for i in range(4) if present >> i & 1 and x[i] == y[i])] += 1
    return out


def table(rng, rows, hot=0.4):
    """Rows of which many share one key, some miss fields, and some are equal."""
    pick = lambda values: None if rng.random() < 0.15 else rng.choice(values)
    made = [
        (i, "0001" if rng.random() < hot else pick(["0002", "0003", ""]), pick(["1990-01-01", "1991-02-02"]), pick(["Ann", " ann ", "Bo"]), pick(["Lee", "LEE", "Ray"]))
        for i in range(rows)
    ]
    return made + made[:3]


def patterns(spark, left, right):
    got = est.agreement_patterns(spark.createDataFrame(left, SCHEMA), spark.createDataFrame(right, SCHEMA)).collect()
    return {(r.present, r.agree): int(r.pairs) for r in got}


@pytest.mark.parametrize("seed", [1, 2])
def test_patterns_are_those_of_all_pairs(spark, seed):
    rng = random.Random(seed)
    left, right = table(rng, 90), table(rng, 40)
    assert patterns(spark, left, right) == plain_patterns(left, right)


def test_keys_are_dealt_to_tasks_by_their_number(spark):
    """Few rows give many keys; AQE would bring them together in as many tasks as the rows need."""
    rows = est.comparable(spark.createDataFrame(table(random.Random(3), 400), SCHEMA))
    counted = est._counted(rows, est.FIELDS, "l", 9)
    sizes = [len(p) for p in counted.rdd.glom().collect()]
    assert len(sizes) == 9 and max(sizes) < sum(sizes) / 3


def test_nothing_and_missing_fields(spark):
    row, empty = (1, "0001", None, "", "Lee"), (2, None, None, None, None)
    assert patterns(spark, [], [row]) == {} == patterns(spark, [row], [])
    assert patterns(spark, [row, empty], [row, empty]) == {(9, 9): 1, (0, 0): 3}
    nothing = spark.createDataFrame([], SCHEMA)
    assert [(r.m_probability, r.u_probability) for r in est.estimate_parameters(nothing, nothing).collect()] == [(0.9, 0.5)] * 4


def test_no_pair_is_formed(spark):
    """Both sides are counted before they meet, and no step multiplies rows."""
    left = spark.range(1000).select("id", *[F.lit("x").alias(f) for f in est.FIELDS])
    plan = est.agreement_patterns(left, left)._jdf.queryExecution().executedPlan().toString()
    assert "CartesianProduct" not in plan and "NestedLoop" not in plan
    (row,) = est.agreement_patterns(left, left).collect()
    assert (row.present, row.agree, row.pairs) == (15, 15, 1_000_000)


def test_estimates_are_near_the_truth(spark):
    """Owners are known here, but not told: documents that state a field wrongly, or not at all, at known rates."""
    rng = random.Random(7)
    m = {"ssn4": 0.98, "dob": 0.93, "first_name": 0.8, "last_name": 0.85}
    sizes = {"ssn4": 300, "dob": 400, "first_name": 12, "last_name": 15}
    members = [(i, *[str(rng.randrange(n)) for n in sizes.values()]) for i in range(300)]
    docs = []
    for i in range(3000):
        owner = rng.choice(members)
        values = [v if rng.random() < rate else str(rng.randrange(n)) for v, rate, n in zip(owner[1:], m.values(), sizes.values())]
        docs.append((i, *[None if rng.random() < 0.1 else v for v in values]))
    rows = est.estimate_parameters(spark.createDataFrame(docs, SCHEMA), spark.createDataFrame(members, SCHEMA))
    found = {r.field_name: r for r in fs_parameters(rows).collect()}
    for field, rate in m.items():
        r = found[field]
        assert abs(r.m_probability - (rate + (1 - rate) / sizes[field])) < 0.02
        assert abs(r.u_probability - 1 / sizes[field]) < 0.02
        assert r.agreement_weight == pytest.approx(math.log(r.m_probability / r.u_probability))


def test_estimates_of_the_fixture(spark, sf_dir):
    """Against each form and the member that it was made of."""
    t = DerivedTables(spark, sf_dir)
    parsed = est.estimate_parameters(t.structured, t.member).collect()
    found = {r.field_name: r.m_probability for r in parsed}
    owner = t.structured.where("path like '/docs/%'").withColumn("o_orderkey", F.regexp_extract("path", "([0-9]+)[.]pdf", 1).cast("long"))
    orders = t.auth.select(F.substring("auth_id", 2, 20).cast("long").alias("o_orderkey"), "member_id")
    own = owner.join(orders, "o_orderkey").alias("d").join(t.member.alias("m"), "member_id")
    for field in est.FIELDS:
        a, b = [F.nullif(F.lower(F.trim(F.col(f"{side}.{field}").cast("string"))), F.lit("")) for side in "dm"]
        truth = own.agg((F.count_if(a == b) / F.count_if(a.isNotNull() & b.isNotNull())).alias("m")).first().m
        assert abs(found[field] - truth) < 0.02, field
