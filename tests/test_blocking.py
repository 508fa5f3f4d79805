import random

import pytest
from pyspark.sql import functions as F

from docmeld.operators.blocking import _cells, _entries, _placed_sides, AUTH_RULES, MEMBER_RULES, Rule, candidate_pairs, hot_blocks, pair_layout, stored_hot_blocks
from docmeld.plans.derived import DerivedTables
from docmeld.workspace import Workspace


def tables(spark, n_left=120, n_right=60, seed=3):
    rng = random.Random(seed)
    key = lambda: rng.choice(["hot", "hot", "a", "b", "c", "", None])
    left = [(i, key(), key()) for i in range(n_left)]
    right = [(i, key(), key()) for i in range(n_right)]
    pairs = {
        (x[0], y[0])
        for x in left
        for y in right
        if (x[1] is not None and x[1] == y[1]) or (x[2] is not None and x[2] == y[2])
    }
    schema = "id int, ssn4 string, dob string"
    return spark.createDataFrame(left, schema), spark.createDataFrame(right, schema), pairs


def found(pairs):
    return [(r.l_id, r.r_id) for r in pairs.select("l_id", "r_id").collect()]


def test_pairs_equal_the_or_of_the_rules_each_once(spark):
    left, right, expected = tables(spark)
    got = found(candidate_pairs(left, right, MEMBER_RULES))
    assert len(got) == len(set(got)) and set(got) == expected


@pytest.mark.parametrize("pairs_per_task", [1, 9, 100, 400])
def test_split_blocks_give_the_same_pairs(spark, pairs_per_task):
    left, right, expected = tables(spark)
    hot = hot_blocks(left, right, MEMBER_RULES, pairs_per_task)
    assert hot.count() > 0
    got = found(candidate_pairs(left, right, MEMBER_RULES, hot))
    assert len(got) == len(set(got)) and set(got) == expected


def test_hot_blocks_weigh_both_sides(spark):
    left = spark.createDataFrame([(i, "x") for i in range(300)] + [(i, "z") for i in range(200)] + [(99, "y"), (98, None)], "id int, k string")
    right = spark.createDataFrame([(i, "y") for i in range(90)] + [(i, "x") for i in range(30)], "id int, k string")
    hot = {r.key: (r.left_parts, r.right_parts) for r in hot_blocks(left, right, [Rule("k", "k")], 100).collect()}
    assert hot == {"x": (30, 3), "z": (2, 1)}


def test_one_block_with_a_third_of_all_rows(spark):
    """The pairs of a hot block are spread over many cells of about the wanted size."""
    left = spark.range(3000).selectExpr("id", "if(id % 3 = 0, 'hot', cast(id as string)) as k")
    right = spark.range(300).selectExpr("id", "if(id % 3 = 0, 'hot', cast(id as string)) as k")
    rules = [Rule("k", "k")]
    hot = hot_blocks(left, right, rules, 2500)
    assert [(r.key, r.left_parts, r.right_parts) for r in hot.collect()] == [("hot", 20, 2)]
    cells = _cells(_entries(left, ["k"], "l_"), hot, ["l_id", "l_k"], "left").where("key = 'hot'")
    sizes = [r["count"] for r in cells.groupBy("cell").count().collect()]
    assert len(sizes) == 40 and sum(sizes) == 2000 and max(sizes) < 100
    pairs = candidate_pairs(left, right, rules, hot)
    same = sum(1 for i in range(300) if i % 3)
    assert pairs.count() == 1000 * 100 + same
    assert pairs.distinct().count() == 1000 * 100 + same


def test_no_hot_blocks_is_none(spark):
    left, right, _ = tables(spark)
    assert stored_hot_blocks(Workspace(spark), "hot", left, right, MEMBER_RULES, 100_000) is None
    assert stored_hot_blocks(Workspace(spark), "hot", left, right, MEMBER_RULES, 10) is not None


@pytest.mark.parametrize("pairs_per_task", [20, 300, 10**6])
def test_dealt_pairs_are_the_same(spark, pairs_per_task):
    left, right, expected = tables(spark)
    layout = pair_layout(Workspace(spark), "layout", left, right, MEMBER_RULES, pairs_per_task)
    for limit in (1 << 20, 0):
        got = found(candidate_pairs(left, right, MEMBER_RULES, layout, limit))
        assert len(got) == len(set(got)) and set(got) == expected


def per_task(pairs):
    return sorted(r["count"] for r in pairs.groupBy(F.spark_partition_id()).count().collect())


def test_tasks_form_about_as_many_pairs_each_whatever_the_skew(spark):
    """A hot key, some large ones and a long tail, read as one split."""
    key = "case when id % 3 = 0 then 'hot' when id % 3 = 1 then concat('k', id % 7) else cast(id as string) end"
    left = spark.range(0, 6000, 1, 1).selectExpr("id", f"{key} as k")
    right = spark.range(0, 900, 1, 1).selectExpr("id", f"{key} as k")
    rules, ws = [Rule("k", "k")], Workspace(spark)
    left, right = ws.store(left, "left"), ws.store(right, "right")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        layout = pair_layout(ws, "layout", left, right, rules, 40_000)
        pairs = candidate_pairs(left, right, rules, layout).select("l_id", "r_id")
        rows = per_task(pairs)
    finally:
        spark.conf.unset("spark.sql.adaptive.enabled")
    assert sum(rows) == candidate_pairs(left, right, rules).count() and len(rows) == layout.tasks > 8
    assert max(rows) <= 1.5 * sum(rows) / len(rows)
    assert pairs.exceptAll(candidate_pairs(left, right, rules).select("l_id", "r_id")).isEmpty()


def test_small_blocks_are_dealt_to_all_tasks(spark):
    """Keys that occur once on each side lie in buckets only; rows, not pairs, give the number of tasks."""
    rules, ws = [Rule("k", "k")], Workspace(spark)
    table = ws.store(spark.range(0, 8000, 1, 1).selectExpr("id", "concat('k', id) as k"), "table")
    layout = pair_layout(ws, "layout", table, table, rules, 10**6, 1000)
    assert layout.tasks == 16 and layout.split.isEmpty()
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        rows = per_task(candidate_pairs(table, table, rules, layout).select("l_id"))
    finally:
        spark.conf.unset("spark.sql.adaptive.enabled")
    assert sum(rows) == 8000 and len(rows) == 16 and max(rows) <= 1.5 * sum(rows) / len(rows)


def test_layout_knows_each_bucket_so_that_new_keys_find_a_task(spark):
    left, right, _ = tables(spark)
    layout = pair_layout(Workspace(spark), "layout", left, right, MEMBER_RULES, 50)
    assert layout.buckets.count() == layout.n_buckets
    other = spark.createDataFrame([(1, "late", None)], "id int, ssn4 string, dob string")
    assert found(candidate_pairs(other, other, MEMBER_RULES, layout)) == [(1, 1)]
    assert pair_layout(Workspace(spark), "none", left.limit(0), right.limit(0), MEMBER_RULES) is None


def test_dealing_adds_no_shuffle_to_the_join(spark):
    left, right, _ = tables(spark)
    layout = pair_layout(Workspace(spark), "layout", left, right, MEMBER_RULES, 50)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = candidate_pairs(left, right, MEMBER_RULES, layout)._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert plan.count("Exchange shufflepartitionidpassthrough") == 2 and "Exchange hashpartitioning" not in plan


def test_rows_are_dealt_before_they_are_copied_to_cells(spark):
    """A small file that becomes many copies does not do so in one task."""
    left = spark.range(20_000).selectExpr("id", "'x' as k").repartition(8)
    right = spark.range(500).selectExpr("id", "'x' as k").coalesce(1)
    rules = [Rule("k", "k")]
    layout = pair_layout(Workspace(spark), "layout", left, right, rules, 10_000, 30_000)
    rights = _placed_sides(left, right, rules, layout, 1 << 20)[1]
    rows = [r["count"] for r in rights.groupBy(F.spark_partition_id()).count().collect()]
    assert sum(rows) > 100_000 and max(rows) <= 60_000
    pairs = candidate_pairs(left, right, rules, layout)
    assert pairs.count() == 10_000_000


def test_tables_without_copies_are_not_dealt_twice(spark):
    left = spark.range(5000).selectExpr("id", "cast(id as string) as k")
    layout = pair_layout(Workspace(spark), "layout", left, left, [Rule("k", "k")], 100, 500)
    assert layout.spread == {"left": 0, "right": 0}


def test_empty_string_is_a_key(spark):
    left = spark.createDataFrame([(1, "", None)], "id int, ssn4 string, dob string")
    assert found(candidate_pairs(left, left, MEMBER_RULES)) == [(1, 1)]


@pytest.mark.parametrize("rules", [MEMBER_RULES, AUTH_RULES])
def test_plan_has_no_nested_loop_and_reads_only_needed_columns(spark, sf_dir, rules):
    t = DerivedTables(spark, sf_dir)
    pairs = t.member_pairs if rules is MEMBER_RULES else t.auth_pairs
    plan = pairs._jdf.queryExecution().toString()
    assert "NestedLoop" not in plan and "CartesianProduct" not in plan
    physical = pairs._jdf.queryExecution().executedPlan().toString()
    assert "raw_text" not in physical and "page_count" not in physical


def test_similarity_is_computed_once_per_pair(spark, sf_dir):
    physical = DerivedTables(spark, sf_dir).member_matches._jdf.queryExecution().executedPlan().toString()
    assert physical.count("ArrowEvalPython") == 1
