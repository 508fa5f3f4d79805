"""Pairs of the member lane scored and added up where they meet, for reports that need weights but not the pairs.

Blocks are dealt to tasks as for :func:`docmeld.operators.blocking.candidate_pairs`. Partners of a block that are equal in their names
and the other anchor are one row with a number. A task goes through documents and distinct names of their partners, a bounded lot at a
time: such a cell is scored once for each agreement of the other anchor, with the number of its pairs. It hands over sums: a row per group
of documents and members, agreement of the anchors, class and whole-number weight (a summed table), or one row per document with its best
weight. Where all names differ there are as many cells as pairs.
"""

from __future__ import annotations

import sys
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, functions as F

from docmeld.config import MATCH_CLASSES, POSSIBLE_THRESHOLD, MatchWeights
from docmeld.functions.similarity import jaro_winkler_scores
from docmeld.operators.blocking import HOT_BROADCAST_BYTES, MEMBER_RULES, _placed, _sides, entry_sizes, layout_of_sizes
from docmeld.operators.expectations import apply_expectations, match_expectations
from docmeld.operators.scoring import classify
from docmeld.workspace import Workspace

# Executors get the code of these functions with the task and need no copy of the package.
for _module in (__name__, MatchWeights.__module__):
    cloudpickle.register_pickle_by_value(sys.modules[_module])

#: Cells that a task adds up in the mean, and those it holds at once; similarities it keeps as a table of names by names.
PAIRS_PER_TASK, HELD, TABLE = 200_000_000, 1 << 18, 4_000_000
ANCHORS, NAMES = ("ssn4", "dob"), ("first_name", "last_name")
_BLOCK = ("task", "rule", "key", "cell")

MEASURES = (
    "ssn4_exact double, dob_exact double, match_class string, weight_bucket double, light boolean, sims_valid boolean, "
    "pairs long, weight_sum double, first_sum double, last_sum double, weight_min double, weight_max double"
)


class _Lot(NamedTuple):
    """Some cells: places of a row of each side, codes of the agreement of both anchors (2: unknown), similarities, weights, number of pairs."""

    left: np.ndarray
    right: np.ndarray
    flags: list[np.ndarray]
    sims: list[np.ndarray]
    weight: np.ndarray
    pairs: np.ndarray


def _coded(left: pa.Array, right: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Codes of both sides' values by one dictionary, -1 for null."""
    both = pa.concat_arrays([left, right]).dictionary_encode()
    codes = both.indices.fill_null(-1).to_numpy(zero_copy_only=False).astype(np.int64)
    return codes[: len(left)], codes[len(left) :], both.dictionary.to_numpy(zero_copy_only=False)


def _column(table: pa.Table, name: str) -> pa.Array:
    column = table.column(name).combine_chunks()
    return pa.concat_arrays(column.chunks) if isinstance(column, pa.ChunkedArray) else column


def _row_codes(table: pa.Table, names: list[str]) -> np.ndarray:
    """A number per distinct row of some columns, nulls like any value."""
    codes = np.zeros(table.num_rows, np.int64)
    for name in names:
        own = _column(table, name).dictionary_encode().indices.fill_null(-1).to_numpy(zero_copy_only=False).astype(np.int64)
        codes = pd.factorize(codes * (own.max(initial=0) + 2) + own + 1)[0]
    return codes


class _Similarity:
    """Similarities of one name field, by a table if it has no more cells than there are pairs."""

    def __init__(self, left: pa.Array, right: pa.Array, pairs: int):
        codes_l, codes_r, self.texts = _coded(left.fill_null(""), right.fill_null(""))
        self.left, self.texts_l = pd.factorize(codes_l)
        self.right, self.texts_r = pd.factorize(codes_r)
        self.width = len(self.texts_r)
        cells = len(self.texts_l) * self.width
        self.table = self._scores(np.arange(cells)) if cells <= min(pairs, TABLE) else None

    def _scores(self, cells: np.ndarray) -> np.ndarray:
        return jaro_winkler_scores(self.texts[self.texts_l[cells // self.width]], self.texts[self.texts_r[cells % self.width]])

    def of(self, i: np.ndarray, j: np.ndarray) -> np.ndarray:
        cells = self.left[i] * self.width + self.right[j]
        if self.table is not None:
            return self.table[cells]
        back, distinct = pd.factorize(cells)
        return self._scores(distinct)[back]


def _ranges(starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """The numbers of all ranges, one range after the other."""
    return np.arange(sizes.sum()) + np.repeat(starts - (np.cumsum(sizes) - sizes), sizes)


def _lots(left: pa.Table, right: pa.Table, weights: MatchWeights, keys_r: list[str]) -> Iterator[_Lot]:
    """All pairs of the blocks of a task, those of a document with partners of equal names and ``keys_r`` counted by agreement of the anchors."""
    block_l, block_r = _row_codes_of_both(left, right)
    n = _column(right, "r_n").to_numpy(zero_copy_only=False)
    named = _row_codes(right, ["r_" + c for c in NAMES] + keys_r)
    # groups of partners, in order of their blocks
    keys, one, group = np.unique(block_r * (named.max(initial=0) + 1) + named, return_index=True, return_inverse=True)
    group, block_g = group.reshape(-1), block_r[one]
    first = np.searchsorted(block_g, block_l, side="left")
    partners = np.searchsorted(block_g, block_l, side="right") - first
    rows = np.argsort(block_l, kind="stable")
    rows = rows[partners[rows] > 0]
    ends = np.cumsum(partners[rows])
    if not len(rows):
        return
    fields = [_Similarity(_column(left, "l_" + c), _column(right, "r_" + c), int(ends[-1])) for c in NAMES]
    anchors = [_coded(_column(left, "l_" + c), _column(right, "r_" + c))[:2] for c in ANCHORS]
    # the rows of a block agree in its own anchor
    rule_l, rule_r = (_column(t, "rule").to_numpy(zero_copy_only=False) for t in (left, right))
    other_l, other_r = (np.where(rule == 0, *own) for rule, own in ((rule_l, (anchors[1][0], anchors[0][0])), (rule_r, (anchors[1][1], anchors[0][1]))))
    size, unknown = (np.bincount(group, weights=x, minlength=len(keys)).astype(np.int64) for x in (n, n * (other_r < 0)))
    # partners by the other anchor
    width = max(other_l.max(initial=0), other_r.max(initial=0)) + 1
    known = np.flatnonzero(other_r >= 0)
    values, value_r = np.unique(block_r[known] * width + other_r[known], return_inverse=True)
    triples, triple_r = np.unique(value_r.reshape(-1) * len(keys) + group[known], return_inverse=True)
    group_t = triples % len(keys)
    n_t = np.bincount(triple_r.reshape(-1), weights=n[known], minlength=len(triples)).astype(np.int64)
    value_l = np.where(other_l >= 0, block_l * width + other_l, -1)
    first_t = np.searchsorted(values[triples // len(keys)], value_l, side="left")
    agreeing = np.searchsorted(values[triples // len(keys)], value_l, side="right") - first_t
    signs = [np.array([-w, w, -w]) for w in (weights.ssn4, weights.dob)]
    start = 0
    while start < len(rows):
        before = ends[start - 1] if start else 0
        stop = max(start + 1, int(np.searchsorted(ends, before + HELD, side="right")))
        some = rows[start:stop]
        i, g = np.repeat(some, partners[some]), _ranges(first[some], partners[some])
        sims_of = [field.of(i, one[g]) for field in fields]
        missing = other_l[i] < 0
        # unknown, agreeing, differing
        n_unknown = np.where(missing, size[g], unknown[g])
        n_differing = size[g] - n_unknown
        t = _ranges(first_t[some], agreeing[some])
        starts = np.cumsum(partners[some]) - partners[some]
        same = np.repeat(starts - first[some], agreeing[some]) + group_t[t]
        n_differing[same] -= n_t[t]
        # a pair that an earlier rule finds is that rule's
        mine = rule_l[i[same]] == 0
        kinds = [(2, np.flatnonzero(n_unknown), n_unknown), (0, np.flatnonzero(n_differing), n_differing)]
        at = np.concatenate([*(x for _, x, _ in kinds), same[mine]])
        pairs = np.concatenate([*(number[x] for _, x, number in kinds), n_t[t[mine]]])
        other = np.repeat([2, 0, 1], [len(kinds[0][1]), len(kinds[1][1]), mine.sum()])
        i, j, sims = i[at], one[g[at]], [sim[at] for sim in sims_of]
        flags = [np.where(rule_l[i] == k, 1, other) for k in range(len(ANCHORS))]
        # added up in the order of fs_score
        weight = signs[0][flags[0]] + signs[1][flags[1]]
        for sim in sims:
            weight = weight + (sim * weights.name_scale - 1.0)
        if len(i):
            yield _Lot(i, j, flags, sims, weight, pairs)
        start = stop


def _row_codes_of_both(left: pa.Table, right: pa.Table) -> tuple[np.ndarray, np.ndarray]:
    both = pa.concat_tables([t.select(list(_BLOCK)) for t in (left, right)])
    codes = _row_codes(both, list(_BLOCK))
    return codes[: left.num_rows], codes[left.num_rows :]


def _rounded(x: np.ndarray) -> np.ndarray:
    """To whole numbers, halves away from zero."""
    whole = np.trunc(x)
    return whole + np.copysign(np.abs(x - whole) >= 0.5, x)


def _added(left: pa.Table, right: pa.Table, weights: MatchWeights, keys_l: list[str], keys_r: list[str]) -> pa.Table:
    """The pairs of a task as rows of a summed table."""
    group_l, group_r = _row_codes(left, keys_l), _row_codes(right, keys_r)
    n_r = int(group_r.max(initial=0)) + 1
    # a row of each group, to read its values from
    one_l, one_r = (pd.Series(np.arange(len(g))).groupby(g).first().to_numpy() for g in (group_l, group_r))
    parts = []
    for lot in _lots(left, right, weights, keys_r):
        t, bucket = lot.weight, _rounded(lot.weight)
        lowest = bucket.min()
        classed = np.where(t >= weights.match_at, 0, np.where(t >= weights.possible_at, 1, 2))
        valid = np.ones(len(t), bool)
        for sim in lot.sims:
            valid &= (sim >= 0) & (sim <= 1)
        bins = (((lot.flags[0] * 3 + lot.flags[1]) * 3 + classed) * 2 + (t < POSSIBLE_THRESHOLD)) * 2 + valid
        bins = (bucket - lowest).astype(np.int64) * 108 + bins
        # few of the possible bins and groups occur
        used = np.flatnonzero(np.bincount(bins))
        place = np.zeros(used[-1] + 1, np.int64)
        place[used] = np.arange(len(used))
        group = group_l[lot.left] * n_r + group_r[lot.right]
        group, groups = pd.factorize(group)
        at, size = group * len(used) + place[bins], len(groups) * len(used)
        pairs = np.bincount(at, weights=lot.pairs, minlength=size).astype(np.int64)
        low, high = np.full(size, np.inf), np.full(size, -np.inf)
        np.minimum.at(low, at, t)
        np.maximum.at(high, at, t)
        some = np.flatnonzero(pairs)
        sums = [np.bincount(at, weights=x * lot.pairs, minlength=size)[some] for x in (t, *lot.sims)]
        bucket = used[some % len(used)] // 108 + lowest
        parts.append((groups[some // len(used)], used[some % len(used)] % 108, bucket, pairs[some], *sums, low[some], high[some]))
    names = ("group", "bin", "weight_bucket", "pairs", "weight_sum", "first_sum", "last_sum", "weight_min", "weight_max")
    columns = [np.concatenate(x) for x in zip(*parts)] if parts else [np.zeros(0, np.int64 if k in (0, 1, 3) else float) for k in range(len(names))]
    kinds = {c: "min" if c == "weight_min" else "max" if c == "weight_max" else "sum" for c in names[3:]}
    rows = pd.DataFrame(dict(zip(names, columns))).groupby(list(names[:3]), as_index=False, sort=False).agg(kinds)
    group, bins = rows["group"].to_numpy(), rows["bin"].to_numpy()
    flag, known = np.array([0.0, 1.0, 0.0]), np.array([False, False, True])
    found = {c: _column(left, c).take(pa.array(one_l[group // n_r])) for c in keys_l}
    found |= {c: _column(right, c).take(pa.array(one_r[group % n_r])) for c in keys_r}
    for c, code in zip(("ssn4_exact", "dob_exact"), (bins // 36, bins // 12 % 3)):
        found[c] = pa.array(flag[code], mask=known[code])
    found["match_class"] = pa.array(np.array(MATCH_CLASSES, dtype=object)[bins // 4 % 3], pa.string())
    found["weight_bucket"] = pa.array(rows["weight_bucket"].to_numpy())
    found |= {"light": pa.array(bins // 2 % 2 == 1), "sims_valid": pa.array(bins % 2 == 1)}
    found |= {c: pa.array(rows[c].to_numpy()) for c in names[3:]}
    return pa.table(found)


def _best(left: pa.Table, right: pa.Table, weights: MatchWeights) -> pa.Table:
    """Per row of the left side with pairs: the highest weight, and the lowest of a match."""
    best, low = np.full(left.num_rows, -np.inf), np.full(left.num_rows, np.inf)
    for lot in _lots(left, right, weights, []):
        np.maximum.at(best, lot.left, lot.weight)
        np.minimum.at(low, lot.left, np.where(lot.weight >= weights.match_at, lot.weight, np.inf))
    row = np.flatnonzero(best > -np.inf)
    best, low = best[row], low[row]
    return pa.table({
        "doc_id": _column(left, "l_doc_id").take(pa.array(row)), "best_weight": pa.array(best), "lightest_match": pa.array(low, mask=np.isinf(low))
    })


def _per_task(workspace: Workspace, name: str, documents: DataFrame, members: DataFrame, keys_l: list[str], keys_r: list[str], of, schema: str) -> DataFrame:
    """``of`` both sides of each task; rows without an id make no valid pair."""
    documents, members = documents.where("doc_id is not null"), members.where("member_id is not null")
    fields = [*NAMES, *ANCHORS]
    lefts, rights = _sides(documents, members, MEMBER_RULES)
    alike = ["r_" + c for c in NAMES] + keys_r
    partners = ["rule", "key", *dict.fromkeys(["r_" + c for c in fields] + keys_r)]
    rights = workspace.store(rights.groupBy(*partners).agg(F.count(F.lit(1)).alias("r_n")), f"{name}_partners")
    layout = layout_of_sizes(workspace, name, entry_sizes(lefts, rights.select("rule", "key", *alike).distinct()), PAIRS_PER_TASK)
    if layout is None:
        return workspace.spark.createDataFrame([], schema)
    lefts = _placed(lefts, layout, ["l_" + c for c in documents.columns], "left", HOT_BROADCAST_BYTES)
    # partners that are alike stay together
    rights = _placed(rights, layout, alike, "right", HOT_BROADCAST_BYTES)
    columns = list(dict.fromkeys(["l_" + c for c in fields] + keys_l)), [*partners[2:], "r_n"]
    lefts, rights = (df.repartitionById(layout.tasks, "task").select(*_BLOCK, *c).groupBy("task") for df, c in zip((lefts, rights), columns))
    return lefts.cogroup(rights).applyInArrow(of, schema)


def _types(df: DataFrame, names: list[str]) -> str:
    kinds = dict(df.dtypes)
    return "".join(f"{c} {kinds[c]}, " for c in names)


def summed_matches(
    workspace: Workspace, name: str, documents: DataFrame, members: DataFrame, left_keys: dict[str, Column] | None = None,
    right_keys: dict[str, Column] | None = None, weights: MatchWeights = MatchWeights(),
) -> DataFrame:
    """The matches of the member lane as a stored summed table (``MEASURES``), by columns of the documents and the members.

    ``light``: below the threshold of a possible match; ``sims_valid``: both similarities lie between 0 and 1.
    """
    left_keys, right_keys = left_keys or {}, right_keys or {}
    documents, members = documents.withColumns(left_keys), members.withColumns(right_keys)
    keys_l, keys_r = list(left_keys), list(right_keys)
    schema = _types(documents, keys_l) + _types(members, keys_r) + MEASURES
    names = [c.split()[0] for c in schema.split(", ")]

    def of(left: pa.Table, right: pa.Table) -> pa.Table:
        found = _added(left, right, weights, ["l_" + c for c in keys_l], ["r_" + c for c in keys_r])
        return found.rename_columns([c.removeprefix("l_") if c in {"l_" + k for k in keys_l} else c.removeprefix("r_") if c in {"r_" + k for k in keys_r} else c for c in found.column_names]).select(names)

    rows = _per_task(workspace, f"{name}_layout", documents, members, ["l_" + c for c in keys_l], ["r_" + c for c in keys_r], of, schema)
    sums = names[names.index("pairs") : names.index("weight_min")]
    measures = [F.sum(c).alias(c) for c in sums] + [F.min("weight_min").alias("weight_min"), F.max("weight_max").alias("weight_max")]
    return workspace.store(rows.groupBy(*names[: names.index("pairs")]).agg(*measures), name)


def checked(summed: DataFrame) -> DataFrame:
    """A summed table behind the rules of matches: a group breaks the one that stops the run if its lightest pair does."""
    return apply_expectations(summed.withColumn("total_weight", F.col("weight_min")), match_expectations()).drop("total_weight")


def best_matches(workspace: Workspace, name: str, documents: DataFrame, members: DataFrame, weights: MatchWeights = MatchWeights()) -> DataFrame:
    """(doc_id, best_weight, best_class) of each document with pairs; a class is a range of weights, so the best weight has the best one."""

    def of(left: pa.Table, right: pa.Table) -> pa.Table:
        return _best(left, right, weights)

    rows = _per_task(workspace, f"{name}_layout", documents, members, ["l_doc_id"], [], of, _types(documents, ["doc_id"]) + "best_weight double, lightest_match double")
    best = rows.groupBy("doc_id").agg(F.max("best_weight").alias("best_weight"), F.min("lightest_match").alias("lightest_match"))
    lightest = F.coalesce("lightest_match", "best_weight")
    best = apply_expectations(best.withColumns({"total_weight": lightest, "match_class": classify(lightest, weights)}), match_expectations())
    return workspace.store(best.select("doc_id", "best_weight", classify(F.col("best_weight"), weights).alias("best_class")), name)
