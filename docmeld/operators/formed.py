"""Features of the pairs of the member lane, formed by Spark from lists of the rows that meet.

The rows are those of ``pair_features`` over ``candidate_pairs``. A task gets the entries of both sides of its blocks and hands over, for
some documents and some partners of a block, the two lists and the similarities of their distinct names; Spark explodes both lists,
so no pair passes through Python. Similarities come from a table of the task's distinct names where that is smaller than its
pairs. A filter on the pairs does not reach the documents, so queries that want few of them take the join.
"""

from __future__ import annotations

import sys
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute  # noqa: F401
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.types import ArrayType, DoubleType, IntegerType, StructField, StructType

from docmeld.operators.blocking import MEMBER_RULES, dealt_together, pair_layout
from docmeld.operators.summed import _BLOCK, ANCHORS, NAMES, _coded, _column, _ranges, _row_codes_of_both, _Similarity
from docmeld.workspace import Workspace

# Executors get the code of these functions with the task and need no copy of the package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

#: Pairs that a task forms in the mean, those of one handed row and similarities handed at once at most, and partners in one list.
PAIRS_PER_TASK, HELD, CELLS, STRETCH = 50_000_000, 1 << 13, 1 << 18, 1 << 10
_FIELDS = (*NAMES, *ANCHORS)


def _stretches(left: np.ndarray, stretch: int | np.ndarray) -> np.ndarray:
    """Where the runs of equal numbers start, long ones cut, and the end of the last."""
    place = np.arange(len(left))
    new = np.diff(left, prepend=-1) != 0
    within = place - np.maximum.accumulate(np.where(new, place, 0))
    return np.append(np.flatnonzero(within % stretch == 0), len(left))


def _lists(values: pa.Array, sizes: np.ndarray, nullable: bool = False) -> pa.ListArray:
    offsets = pa.array(np.append(0, np.cumsum(sizes)).astype(np.int32))
    return pa.ListArray.from_arrays(offsets, values, pa.list_(pa.field("element", values.type, nullable)))


class _Names(NamedTuple):
    """Distinct names of each stretch: where they start, how many they are, a row that has each; per row the number within its stretch."""

    starts: np.ndarray
    sizes: np.ndarray
    rows: np.ndarray
    codes: np.ndarray


def _names(codes: np.ndarray, rows: np.ndarray, ends: np.ndarray) -> _Names:
    stretch = np.repeat(np.arange(len(ends) - 1), np.diff(ends))
    keys, one, back = np.unique(stretch * (codes.max(initial=0) + 1) + codes[rows], return_index=True, return_inverse=True)
    sizes = np.bincount(stretch[one], minlength=len(ends) - 1)
    starts = np.cumsum(sizes) - sizes
    return _Names(starts, sizes, rows[one], (back.reshape(-1) - starts[stretch]).astype(np.int32))


def _handed(left: pa.Table, right: pa.Table, names: list[str]) -> Iterator[pa.RecordBatch]:
    """A row for some documents and some partners of a block, all of which are its candidates."""
    block_l, block_r = _row_codes_of_both(left, right)
    n_l, n_r = (np.bincount(b, minlength=max(block_l.max(initial=0), block_r.max(initial=0)) + 1) for b in (block_l, block_r))
    rows_l, rows_r = (np.argsort(own, kind="stable") for own in (block_l, block_r))
    rows_l, rows_r = rows_l[n_r[block_l[rows_l]] > 0], rows_r[n_l[block_r[rows_r]] > 0]
    if not len(rows_l):
        return
    ends_r = _stretches(block_r[rows_r], STRETCH)
    ends_l = _stretches(block_l[rows_l], np.clip(HELD // np.clip(n_r, 1, STRETCH), 1, STRETCH)[block_l[rows_l]])
    # a stretch of documents meets every stretch of partners of its block
    of_l, of_r = block_l[rows_l[ends_l[:-1]]], block_r[rows_r[ends_r[:-1]]]
    first, last = (np.searchsorted(of_r, of_l, side=side) for side in ("left", "right"))
    at_l = np.repeat(np.arange(len(of_l)), last - first)
    at_r = _ranges(first, last - first)
    fields = [_Similarity(_column(left, "l_" + c), _column(right, "r_" + c), int((n_l * n_r).sum())) for c in NAMES]
    names_l, names_r = ([_names(x, rows, ends) for x in own] for own, rows, ends in (([f.left for f in fields], rows_l, ends_l), ([f.right for f in fields], rows_r, ends_r)))
    anchors = [_coded(_column(left, "l_" + c), _column(right, "r_" + c))[:2] for c in ANCHORS]
    codes_l = [*(n.codes for n in names_l), *(x[rows_l].astype(np.int32) for x, _ in anchors)]
    codes_r = [*(n.codes for n in names_r), *(y[rows_r].astype(np.int32) for _, y in anchors)]
    ids = [_column(left, c).take(pa.array(rows_l)) for c in ("l_doc_id", "l_pipeline_run_ts")], _column(right, "r_member_id").take(pa.array(rows_r))
    rule = _column(left, "rule").to_numpy(zero_copy_only=False)[rows_l[ends_l[:-1]]].astype(np.int32)
    sizes_l, sizes_r = np.diff(ends_l), np.diff(ends_r)
    cells = [l.sizes[at_l] * r.sizes[at_r] for l, r in zip(names_l, names_r)]
    # lists and similarities of a batch
    ends = np.cumsum(sum(cells) + sizes_l[at_l] + sizes_r[at_r])
    start = 0
    while start < len(at_l):
        stop = max(start + 1, int(np.searchsorted(ends, (ends[start - 1] if start else 0) + CELLS, side="right")))
        some_l, some_r = at_l[start:stop], at_r[start:stop]
        n, m = sizes_l[some_l], sizes_r[some_r]
        docs, partners = _ranges(ends_l[some_l], n), _ranges(ends_r[some_r], m)
        take_l, take_r = pa.array(docs), pa.array(partners)
        columns = [pa.array(rule[some_l]), *(_lists(x.take(take_l), n, True) for x in ids[0]), *(_lists(pa.array(x[docs]), n) for x in codes_l)]
        columns += [_lists(ids[1].take(take_r), m, True), *(_lists(pa.array(x[partners]), m) for x in codes_r)]
        for field, l, r, size in zip(fields, names_l, names_r, cells):
            size, width = size[start:stop], r.sizes[some_r]
            within, wide = _ranges(np.zeros(len(size), np.int64), size), np.repeat(width, size)
            i = l.rows[np.repeat(l.starts[some_l], size) + within // wide]
            j = r.rows[np.repeat(r.starts[some_r], size) + within % wide]
            columns += [pa.array(width.astype(np.int32)), _lists(pa.array(field.of(i, j)), size)]
        yield pa.RecordBatch.from_arrays(columns, names)
        start = stop


def _agrees(field: str) -> Column:
    """NULL if a side is not given."""
    mine, other = F.col("l_" + field), F.get("r_" + field, F.col("at"))
    return F.when((mine >= 0) & (other >= 0), (mine == other).cast("double"))


def _exploded(handed: DataFrame) -> DataFrame:
    """A row per pair."""
    docs = handed.select("*", F.posexplode("docs").alias("at", "doc_id"))
    own = {"l_" + c: F.get("l_" + c, F.col("at")) for c in _FIELDS} | {"pipeline_run_ts": F.get("stamps", F.col("at"))}
    own |= {"l_" + c: own["l_" + c] * F.col(c + "_width") for c in NAMES}
    docs = docs.withColumns(own).drop("at", "docs", "stamps")
    pairs = docs.select("*", F.posexplode("partners").alias("at", "member_id"))
    # a pair that an earlier rule finds is that rule's
    found = [F.coalesce((F.col("rule") > k) & (_agrees(c) == 1.0), F.lit(False)) for k, c in enumerate(ANCHORS[:-1])]
    for x in found:
        pairs = pairs.where(~x)
    sims = [F.get(c + "_sims", F.col("l_" + c) + F.get("r_" + c, F.col("at"))).alias(c + "_sim") for c in NAMES]
    return pairs.select("doc_id", "member_id", "pipeline_run_ts", *sims, *[_agrees(c).alias(c + "_exact") for c in ANCHORS])


def member_pair_features(
    workspace: Workspace, name: str, documents: DataFrame, members: DataFrame, pairs_per_task: int = PAIRS_PER_TASK
) -> DataFrame:
    """(doc_id, member_id, pipeline_run_ts, first_name_sim, last_name_sim, ssn4_exact, dob_exact) of each candidate pair."""

    def lists(prefix: str, names: tuple[str, ...], kind=IntegerType(), nullable: bool = False) -> list[StructField]:
        return [StructField(prefix + c, ArrayType(kind, nullable)) for c in names]

    kinds = documents.schema["doc_id"].dataType, documents.schema["pipeline_run_ts"].dataType, members.schema["member_id"].dataType
    schema = StructType([StructField("rule", IntegerType()), *lists("", ("docs",), kinds[0], True), *lists("", ("stamps",), kinds[1], True), *lists("l_", _FIELDS)])
    schema = StructType([*schema, *lists("", ("partners",), kinds[2], True), *lists("r_", _FIELDS)])
    for c in NAMES:
        schema = StructType([*schema, StructField(c + "_width", IntegerType()), StructField(c + "_sims", ArrayType(DoubleType(), False))])
    names = schema.names
    documents, members = documents.select("doc_id", "pipeline_run_ts", *_FIELDS), members.select("member_id", *_FIELDS)
    layout = pair_layout(workspace, name, documents, members, MEMBER_RULES, pairs_per_task)

    def of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = pa.Table.from_batches(batches)
        is_left = _column(rows, "is_left")
        left, right = rows.filter(is_left), rows.filter(pa.compute.invert(is_left))
        yield from _handed(left, right, names)

    if layout is None:
        return _exploded(workspace.spark.createDataFrame([], schema))
    columns = [p + c for p, df in (("l_", documents), ("r_", members)) for c in df.columns]
    entries = dealt_together(documents, members, MEMBER_RULES, layout).select("is_left", *_BLOCK, *columns)
    return _exploded(entries.groupBy("task").applyInArrow(of, schema))
