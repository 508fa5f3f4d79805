"""Candidate pairs: rows of two tables that agree on at least one blocking key.

An OR of equalities makes Spark compare every row with every row. Here each side is
exploded into its ``(rule, key)`` entries and joined on them, so the work follows the
number of true candidates; a pair found by several rules is kept for the first one only.
That needs no ``distinct``, hence no state, and is legal in an append-mode stream.

Pairs are dealt by work (:func:`pair_layout`): blocks with more pairs than a small part of a task are split into cells,
the others are gathered in buckets, all of them get numbers by a running sum of their pairs, and equal ranges of numbers
are the tasks. However skewed the keys and however few the splits of the scan, each task forms about as many pairs.
"""

from __future__ import annotations

import math
from collections.abc import Sequence
from functools import reduce
from operator import or_
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, Window, functions as F

from docmeld.workspace import Workspace


class Rule(NamedTuple):
    """Left and right column whose equality makes a candidate pair."""

    left: str
    right: str


MEMBER_RULES = (Rule("ssn4", "ssn4"), Rule("dob", "dob"))
AUTH_RULES = (Rule("auth_id", "auth_number"), Rule("member_id_on_form", "member_id"))

# Pairs of one block that one task may form; a block with more is split. Rows of both sides that a task gets in the mean.
PAIRS_PER_TASK, ROWS_PER_TASK = 5_000_000, 1_000_000
# Units of work per task: a cell of a split block or a bucket of small ones is about this part of a task.
SHARES = 32
# The list of hot blocks is broadcast up to this size, and looked up by salted keys beyond it.
HOT_BROADCAST_BYTES, HOT_ROW_BYTES, LOOKUP_SALTS = 32 << 20, 128, 32


def _entries(df: DataFrame, columns: Sequence[str], prefix: str) -> DataFrame:
    """``df`` once per non-NULL key, columns prefixed; an empty string is a key like any other."""
    keys = F.array(
        *[F.struct(F.lit(i).alias("rule"), F.col(c).cast("string").alias("key")) for i, c in enumerate(columns)]
    )
    return (
        df.select(*[F.col(c).alias(prefix + c) for c in df.columns], F.explode(keys).alias("k"))
        .select("*", F.col("k.rule").alias("rule"), F.col("k.key").alias("key"))
        .where(F.col("key").isNotNull())
        .drop("k")
    )


def block_sizes(left: DataFrame, right: DataFrame, rules: Sequence[Rule]) -> DataFrame:
    """Rows of both sides per (rule, key). A side without rows counts as one row, so a key that very many rows of one side
    share has weight even where it has no partner."""

    def keys(df: DataFrame, columns: list[str]) -> DataFrame:
        return _entries(df.select(*dict.fromkeys(columns)), columns, "c_")

    return entry_sizes(keys(left, [r.left for r in rules]), keys(right, [r.right for r in rules]))


def entry_sizes(lefts: DataFrame, rights: DataFrame) -> DataFrame:
    """:func:`block_sizes` of entries."""
    both = lefts.select("rule", "key", F.lit(1).alias("left"), F.lit(0).alias("right"))
    both = both.unionAll(rights.select("rule", "key", F.lit(0).alias("left"), F.lit(1).alias("right")))
    rows = [F.greatest(F.sum(side), F.lit(1)).cast("double").alias(side) for side in ("left", "right")]
    return both.groupBy("rule", "key").agg(*rows)


def _split(sizes: DataFrame, pairs_per_cell: float) -> DataFrame:
    """Blocks with more than ``pairs_per_cell`` pairs, and into how many parts each side splits."""
    is_smaller = F.col("left") <= F.col("right")
    pairs = F.col("left") * F.col("right")
    parts_small = F.ceil(F.least("left", "right") / max(1, math.isqrt(int(pairs_per_cell))))
    parts_large = F.ceil(pairs / pairs_per_cell / F.col("small"))
    return (
        sizes.where(pairs > pairs_per_cell)
        .withColumn("small", parts_small)
        .withColumn("large", parts_large)
        .select(
            "rule",
            "key",
            F.when(is_smaller, F.col("small")).otherwise(F.col("large")).cast("long").alias("left_parts"),
            F.when(is_smaller, F.col("large")).otherwise(F.col("small")).cast("long").alias("right_parts"),
            pairs.alias("pairs"),
            "left",
            "right",
        )
    )


def hot_blocks(left: DataFrame, right: DataFrame, rules: Sequence[Rule], pairs_per_task: int = PAIRS_PER_TASK) -> DataFrame:
    """Blocks with more than ``pairs_per_task`` pairs, and into how many parts each side splits.

    The smaller side splits into parts of about the square root of that many rows, the larger
    one as often as the rest needs; that keeps the copies few.
    """
    return _split(block_sizes(left, right, rules), pairs_per_task).drop("pairs", "left", "right")


class Layout(NamedTuple):
    """Which task forms which pairs.

    ``split`` holds the blocks that are split (rule, key, left_parts, right_parts, and as ``start`` and ``step`` the pairs
    before its first cell and those of one cell), ``buckets`` the task of each bucket of other blocks. Both are written
    tables of at most ``SHARES`` rows per task, whatever the data. ``spread`` says to how many tasks each side's rows are dealt
    before they are copied to their cells; 0 leaves them where they are.
    """

    split: DataFrame
    buckets: DataFrame
    tasks: int
    pairs_per_task: float
    spread: dict[str, int]

    @property
    def n_buckets(self) -> int:
        return self.tasks * SHARES


def _bucket(n_buckets: int) -> Column:
    return F.pmod(F.xxhash64("rule", "key"), F.lit(n_buckets)).cast("int")


def pair_layout(
    workspace: Workspace, name: str, left: DataFrame, right: DataFrame, rules: Sequence[Rule], pairs_per_task: int = PAIRS_PER_TASK, rows_per_task: int = ROWS_PER_TASK
) -> Layout | None:
    """Deal the pairs of two tables to tasks of equal work; None if there are no keys."""
    return layout_of_sizes(workspace, name, block_sizes(left, right, rules), pairs_per_task, rows_per_task)


def layout_of_sizes(
    workspace: Workspace, name: str, sizes: DataFrame, pairs_per_task: int = PAIRS_PER_TASK, rows_per_task: int = ROWS_PER_TASK
) -> Layout | None:
    """:func:`pair_layout` of blocks whose sizes are known.

    There is one task for each ``pairs_per_task`` pairs, and at least one per shuffle partition and for each
    ``rows_per_task`` rows, as tables of many small blocks have few pairs to a row. A unit of work is at most about a ``SHARES``-th of a task and goes to the task its middle falls into, so no task has much more than its part.
    The running sum goes over the units, whose number follows that of the tasks and not that of the keys.
    """
    sizes = workspace.store(sizes, f"{name}_sizes")
    pairs = F.col("left") * F.col("right")
    total, *rows_of = sizes.agg(F.sum(pairs), F.sum("left"), F.sum("right")).first()
    rows = sum(n or 0 for n in rows_of)
    if not total:
        return None
    partitions = int(workspace.spark.conf.get("spark.sql.shuffle.partitions"))
    tasks = max(partitions, math.ceil(total / pairs_per_task), math.ceil(rows / rows_per_task))
    share, unit = total / tasks, max(1.0, total / tasks / SHARES)
    n_buckets = tasks * SHARES
    heavy = _split(sizes, unit)
    small = sizes.where(pairs <= unit).groupBy(_bucket(n_buckets).alias("bucket")).agg(F.sum(pairs).alias("pairs"))
    small = workspace.spark.range(n_buckets).select(F.col("id").cast("int").alias("bucket")).join(small, "bucket", "left")
    units = heavy.unionByName(small.withColumn("pairs", F.coalesce("pairs", F.lit(0.0))), allowMissingColumns=True)
    before = F.sum("pairs").over(Window.orderBy("bucket", "rule", "key").rowsBetween(Window.unboundedPreceding, -1))
    units = workspace.store(units.withColumn("start", F.coalesce(before, F.lit(0.0))), f"{name}_units")
    step = F.col("pairs") / (F.col("left_parts") * F.col("right_parts"))
    split = units.where("bucket is null").select("rule", "key", "left_parts", "right_parts", "start", step.alias("step"))
    middle = F.floor((F.col("start") + F.col("pairs") / 2) / share)
    dealt = units.where("bucket is not null").select("bucket", F.least(middle, F.lit(tasks - 1)).cast("int").alias("bucket_task"))
    copies = units.agg(*[F.sum(F.col(mine) * (F.col(f"{other}_parts") - 1)) for mine, other in (("left", "right"), ("right", "left"))]).first()
    # worth a shuffle of its own where the copies are as many as the rows
    spread = {
        side: math.ceil((n + more) / rows_per_task) if (more or 0) > n and n + more > rows_per_task else 0
        for side, n, more in zip(("left", "right"), rows_of, copies)
    }
    return Layout(split, dealt, tasks, share, spread)


def _placed(entries: DataFrame, layout: Layout, row_id: list[str], side: str, limit: int) -> DataFrame:
    """``entries`` with their cell and the task that forms the pairs of that cell."""
    if layout.spread[side]:
        entries = entries.repartition(layout.spread[side], "rule", *row_id)
    cells = _cells(entries, layout.split, row_id, side, limit)
    middle = F.floor((F.col("start") + (F.col("cell") + 0.5) * F.col("step")) / layout.pairs_per_task)
    buckets = F.broadcast(layout.buckets) if layout.n_buckets * HOT_ROW_BYTES <= limit else layout.buckets
    placed = cells.withColumn("bucket", _bucket(layout.n_buckets)).join(buckets, "bucket")
    # the bound comes last, as ``least`` passes over the NULL that blocks in buckets have here
    task = F.least(F.coalesce(middle, "bucket_task"), F.lit(layout.tasks - 1)).cast("int")
    return placed.withColumn("task", task).drop("bucket", "bucket_task", "start", "step")


def _sides(left: DataFrame, right: DataFrame, rules: Sequence[Rule]) -> tuple[DataFrame, DataFrame]:
    return _entries(left, [r.left for r in rules], "l_"), _entries(right, [r.right for r in rules], "r_")


def _placed_sides(left: DataFrame, right: DataFrame, rules: Sequence[Rule], layout: Layout, limit: int) -> tuple[DataFrame, DataFrame]:
    lefts, rights = _sides(left, right, rules)
    lefts = _placed(lefts, layout, ["l_" + c for c in left.columns], "left", limit)
    return lefts, _placed(rights, layout, ["r_" + c for c in right.columns], "right", limit)


def dealt_sides(left: DataFrame, right: DataFrame, rules: Sequence[Rule], layout: Layout, limit: int = HOT_BROADCAST_BYTES) -> tuple[DataFrame, DataFrame]:
    """Both sides' entries by task; rows of one (rule, key, cell) are a pair."""
    lefts, rights = (side.repartitionById(layout.tasks, "task") for side in _placed_sides(left, right, rules, layout, limit))
    return lefts, rights


def dealt_together(left: DataFrame, right: DataFrame, rules: Sequence[Rule], layout: Layout, limit: int = HOT_BROADCAST_BYTES) -> DataFrame:
    """The entries of both sides as one table by task, ``is_left`` says whose; the columns of the other side are NULL."""
    lefts, rights = _placed_sides(left, right, rules, layout, limit)
    both = lefts.withColumn("is_left", F.lit(True)).unionByName(rights.withColumn("is_left", F.lit(False)), allowMissingColumns=True)
    return both.repartitionById(layout.tasks, "task")


def stored_hot_blocks(
    workspace: Workspace, name: str, left: DataFrame, right: DataFrame, rules: Sequence[Rule], pairs_per_task: int = PAIRS_PER_TASK
) -> DataFrame | None:
    """The hot blocks as a written table, whose known size decides how it is joined; None if there are none."""
    hot = workspace.store(hot_blocks(left, right, rules, pairs_per_task), name)
    return None if hot.isEmpty() else hot


def _looked_up(entries: DataFrame, hot: DataFrame, row_id: list[str], limit: int) -> DataFrame:
    """``entries`` with the parts of their block, NULL for blocks that are not hot.

    The list is broadcast if its rows fit the limit. Beyond that both sides carry a salt, so that the rows of a hot key
    are not brought together only to learn that they have to be spread.
    """
    if hot.count() * HOT_ROW_BYTES <= limit:
        return entries.join(F.broadcast(hot), ["rule", "key"], "left")
    salted = hot.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(LOOKUP_SALTS - 1))))
    own = F.pmod(F.xxhash64(*row_id), F.lit(LOOKUP_SALTS)).cast("int")
    return entries.withColumn("salt", own).join(salted, ["rule", "key", "salt"], "left").drop("salt")


def _cells(entries: DataFrame, hot: DataFrame, row_id: list[str], side: str, limit: int = HOT_BROADCAST_BYTES) -> DataFrame:
    """Spread a hot block over a grid of left parts x right parts.

    A left row goes to its own row of the grid, a right row to its own column, so every pair
    meets in exactly one cell. Rows of other blocks stay in cell 0. The part is a hash of the whole row, so a task
    that is run again puts its rows where they were; rows that are equal in every column share a part.
    """
    one = F.lit(1).cast("long")
    left_parts, right_parts = F.coalesce("left_parts", one), F.coalesce("right_parts", one)
    mine, others = (left_parts, right_parts) if side == "left" else (right_parts, left_parts)
    part = F.pmod(F.xxhash64(*row_id), mine)

    def cell(x: Column) -> Column:
        return part * right_parts + x if side == "left" else x * right_parts + part

    return (
        _looked_up(entries, hot, row_id, limit)
        .withColumn("cell", F.explode(F.transform(F.sequence(F.lit(0).cast("long"), others - 1), cell)))
        .drop("left_parts", "right_parts")
    )


def candidate_pairs(
    left: DataFrame,
    right: DataFrame,
    rules: Sequence[Rule],
    hot: DataFrame | Layout | None = None,
    hot_limit: int = HOT_BROADCAST_BYTES,
) -> DataFrame:
    """Pairs agreeing on any rule, each once; left columns come back as ``l_*``, right ones as ``r_*``.

    A layout (see :func:`pair_layout`) deals the pairs to tasks of equal work, a list of hot blocks (:func:`hot_blocks`)
    only spreads oversize ones; the pairs are the same with either and without. A list above ``hot_limit`` bytes is not
    broadcast.
    """
    on = ["rule", "key"]
    if isinstance(hot, Layout):
        lefts, rights = dealt_sides(left, right, rules, hot, hot_limit)
        on += ["cell", "task"]
    else:
        lefts, rights = _sides(left, right, rules)
    if hot is not None and not isinstance(hot, Layout):
        lefts = _cells(lefts, hot, ["l_" + c for c in left.columns], "left", hot_limit)
        rights = _cells(rights, hot, ["r_" + c for c in right.columns], "right", hot_limit)
        on.append("cell")
    pairs = lefts.join(rights, on, "inner")
    found_before = [
        (F.col("rule") > i)
        & F.coalesce(F.col("l_" + r.left).cast("string") == F.col("r_" + r.right).cast("string"), F.lit(False))
        for i, r in enumerate(rules[:-1])
    ]
    if found_before:
        pairs = pairs.where(~reduce(or_, found_before))
    return pairs.drop(*on)
