"""Jaro and Jaro-Winkler similarity as vectorised Arrow UDFs.

A batch of pairs is scored as matrices of code points: one numpy step per character
position handles all pairs of the batch at once, and a pair that occurs many times in the
batch is scored once.
"""

from __future__ import annotations

import sys

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import SparkSession
from pyspark.sql.functions import arrow_udf
from pyspark.sql.types import DoubleType

# Executors get the code of these functions with the task and need no copy of the package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

# Prefix length and weight of the Winkler boost.
PREFIX_LENGTH = 4
PREFIX_WEIGHT = 0.1

# Cells (pairs x characters) held at once; bounds the memory of a batch with long strings.
_CELLS = 4_000_000


def _code_points(texts: np.ndarray, width: int) -> np.ndarray:
    padded = "".join([t.ljust(width, "\0") for t in texts])
    return np.frombuffer(padded.encode("utf-32-le", "surrogatepass"), dtype=np.uint32).reshape(len(texts), width)


def _matched(a: np.ndarray, b: np.ndarray, len_a: np.ndarray, len_b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Masks of the characters of each side that found a partner inside the window."""
    reach = np.maximum(np.maximum(len_a, len_b) // 2 - 1, 0)
    farthest = int(reach.max())
    places = np.arange(b.shape[1])
    free = places < len_b[:, None]
    hit_a = np.zeros(a.shape, dtype=bool)
    hit_b = np.zeros(b.shape, dtype=bool)
    for i in range(int(len_a.max())):
        lo, hi = max(0, i - farthest), min(b.shape[1], i + farthest + 1)
        if lo >= hi:
            break
        near = np.abs(places[lo:hi] - i) <= reach[:, None]
        usable = (b[:, lo:hi] == a[:, i, None]) & free[:, lo:hi] & near & (i < len_a)[:, None]
        first = usable.argmax(axis=1)
        rows = np.flatnonzero(usable[np.arange(len(a)), first])
        taken = first[rows] + lo
        hit_a[rows, i] = True
        hit_b[rows, taken] = True
        free[rows, taken] = False
    return hit_a, hit_b


def _score_block(left: np.ndarray, right: np.ndarray, len_a: np.ndarray, len_b: np.ndarray) -> np.ndarray:
    a = _code_points(left, int(len_a.max()))
    b = _code_points(right, int(len_b.max()))
    hit_a, hit_b = _matched(a, b, len_a, len_b)
    common = hit_a.sum(axis=1)
    # Row-major masks line the k-th matched characters of both sides up.
    moved = np.nonzero(hit_a)[0][a[hit_a] != b[hit_b]]
    out_of_order = np.bincount(moved, minlength=len(a))
    score = np.zeros(len(a))
    some = common > 0
    m, la, lb = common[some], len_a[some], len_b[some]
    score[some] = (m / la + m / lb + (m - out_of_order[some] / 2) / m) / 3.0
    return score


def jaro_scores(left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """Jaro similarity of two equally long object arrays of ``str``.

    Each character of the left string takes the first free equal character of the right one
    inside the window; characters that end up in another order count half.
    """
    score = (left == right).astype(float)
    len_a = np.fromiter(map(len, left), dtype=np.int64, count=len(left))
    len_b = np.fromiter(map(len, right), dtype=np.int64, count=len(right))
    todo = np.flatnonzero((score == 0) & (len_a > 0) & (len_b > 0))
    widest = np.maximum(len_a, len_b)
    todo = todo[np.argsort(widest[todo], kind="stable")]
    start = 0
    while start < len(todo):
        # Sorted by length: grow the block until its padded matrix reaches the cell budget.
        cells = widest[todo[start:]] * np.arange(1, len(todo) - start + 1)
        stop = start + max(1, int(np.searchsorted(cells, _CELLS, side="right")))
        block = todo[start:stop]
        score[block] = _score_block(left[block], right[block], len_a[block], len_b[block])
        start = stop
    return score


def _shared_prefix(left: np.ndarray, right: np.ndarray) -> np.ndarray:
    heads = _code_points(np.array([t[:PREFIX_LENGTH] for t in left], dtype=object), PREFIX_LENGTH)
    others = _code_points(np.array([t[:PREFIX_LENGTH] for t in right], dtype=object), PREFIX_LENGTH)
    shortest = np.array([min(len(x), len(y)) for x, y in zip(left, right)])
    same = (heads == others) & (np.arange(PREFIX_LENGTH) < shortest[:, None])
    return np.logical_and.accumulate(same, axis=1).sum(axis=1)


def jaro_winkler_scores(left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """Case and outer blanks do not count; an empty string on either side scores 0."""
    given = (left != "") & (right != "")
    left = np.array([t.lower().strip() for t in left], dtype=object)
    right = np.array([t.lower().strip() for t in right], dtype=object)
    score = np.zeros(len(left))
    if len(left):
        base = jaro_scores(left, right)
        boosted = base + _shared_prefix(left, right) * PREFIX_WEIGHT * (1.0 - base)
        score = np.where(given, np.minimum(boosted, 1.0), 0.0)
    return score


def _per_distinct_pair(scores, left: pa.Array, right: pa.Array) -> pa.Array:
    codes_a, codes_b = left.fill_null("").dictionary_encode(), right.fill_null("").dictionary_encode()
    texts_a = codes_a.dictionary.to_numpy(zero_copy_only=False)
    texts_b = codes_b.dictionary.to_numpy(zero_copy_only=False)
    width = max(len(texts_b), 1)
    combined = codes_a.indices.to_numpy().astype(np.int64) * width + codes_b.indices.to_numpy()
    back, pairs = pd.factorize(combined)
    return pa.array(scores(texts_a[pairs // width], texts_b[pairs % width])[back])


@arrow_udf(DoubleType())
def jaro(left: pa.Array, right: pa.Array) -> pa.Array:
    """Jaro similarity of the strings as given; NULL counts as empty."""
    return _per_distinct_pair(jaro_scores, left, right)


@arrow_udf(DoubleType())
def jaro_winkler(left: pa.Array, right: pa.Array) -> pa.Array:
    """Jaro-Winkler similarity, NULL-safe."""
    return _per_distinct_pair(jaro_winkler_scores, left, right)


def register_functions(spark: SparkSession) -> None:
    """Make ``jw_sim(a, b)`` callable from SQL."""
    spark.udf.register("jw_sim", jaro_winkler)
