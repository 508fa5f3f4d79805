"""Keys that occur more often, or in other tables, than they should, found without moving every key.

Each task counts 64-bit fingerprints of its keys and hands over sorted runs of them, packed as differences: some six bytes a
key where the key with its row would be a hundred. Runs of one range of fingerprints are merged by adding counts, which
stop at two. Only fingerprints with unusual counts come back, and only rows that have one are grouped by their keys.
"""

from __future__ import annotations

import sys
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame, functions as F

from docmeld.workspace import Workspace

# Executors get the code of these functions with the task and need no copy of the package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

#: Keys that a task holds before it hands over runs, and keys in one range of fingerprints, that is, in one group.
HELD, PER_RANGE = 4_000_000, 1_000_000
#: Unusual fingerprints are broadcast up to this number, some 64 bytes each as Spark holds them.
BROADCAST_ROWS = 1_000_000


def packed(sorted_keys: np.ndarray) -> bytes:
    """Differences of rising 64-bit numbers, all lowest bytes first, then all second ones: the high ones are zeros and compress."""
    steps = np.diff(sorted_keys, prepend=np.zeros(1, np.uint64)).astype("<u8")
    return steps.view(np.uint8).reshape(-1, 8).T.tobytes()


def unpacked(run: bytes) -> np.ndarray:
    return np.ascontiguousarray(np.frombuffer(run, np.uint8).reshape(8, -1).T).view("<u8").ravel().cumsum(dtype=np.uint64)


def added(keys: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct keys in order with the sums of their counts per table, at most 2 each."""
    distinct, at = np.unique(keys, return_inverse=True)
    sums = [np.bincount(at, weights=column, minlength=len(distinct)) for column in counts.T]
    return distinct, np.minimum(np.stack(sums, 1), 2).astype(np.uint8)


def unusual(ws: Workspace, name: str, tables: list[DataFrame], usual: set[tuple[int, ...]]) -> tuple[DataFrame, int]:
    """Stored fingerprints (fp) whose counts in ``tables`` are none of ``usual``, and their number.

    A table is its key column(s) alone; counts are 0, 1, or 2 for more. Keys are known by ``xxhash64`` of their values: a chance
    of n^2 / 2^65 that two of n keys look like one. Such a key is then counted twice and looked at, unless each lacks just what
    the other has. Null keys count like any other.
    """
    spark, width = tables[0].sparkSession, len(tables)
    rows = None
    for k, table in enumerate(tables):
        own = table.select(F.xxhash64(*table.columns).alias("fp"), F.lit(k).cast("byte").alias("kind"))
        rows = own if rows is None else rows.unionAll(own)
    wanted = max(2, int(spark.conf.get("spark.sql.shuffle.partitions")), rows.count() // PER_RANGE)
    shift = np.uint64(64 - (wanted - 1).bit_length())
    unit = np.eye(width, dtype=np.uint8)
    patterns = np.array(sorted(usual), np.uint8)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keys, counts, held = [], [], 0

        def runs() -> pa.RecordBatch:
            distinct, sums = added(np.concatenate(keys), np.concatenate(counts))
            ranges = (distinct >> shift).astype(np.int64)
            starts = np.flatnonzero(np.diff(ranges, prepend=-1))
            parts = list(zip(starts, [*starts[1:], len(distinct)], strict=True))
            return pa.RecordBatch.from_pydict({
                "range": pa.array(ranges[starts], pa.int64()),
                "run": pa.array([packed(distinct[a:b]) for a, b in parts], pa.binary()),
                "counts": pa.array([sums[a:b].T.tobytes() for a, b in parts], pa.binary()),
            })

        for batch in batches:
            keys.append(batch["fp"].to_numpy(zero_copy_only=False).view(np.uint64))
            counts.append(unit[batch["kind"].to_numpy(zero_copy_only=False)])
            held += batch.num_rows
            if held >= HELD:
                yield runs()
                keys, counts, held = [], [], 0
        if held:
            yield runs()

    def merge(group: pd.DataFrame) -> pd.DataFrame:
        keys = np.concatenate([unpacked(r) for r in group["run"]])
        counts = np.concatenate([np.frombuffer(c, np.uint8).reshape(width, -1).T for c in group["counts"]])
        distinct, sums = added(keys, counts)
        known = (sums[:, None, :] == patterns[None]).all(2).any(1)
        return pd.DataFrame({"fp": distinct[~known].view(np.int64)})

    found = rows.mapInArrow(count, "range long, run binary, counts binary").groupBy("range").applyInPandas(merge, "fp long")
    found = ws.store(found, name)
    return found, found.count()


def only(df: DataFrame, found: tuple[DataFrame, int], *keys: str) -> DataFrame:
    """Rows of ``df`` whose key has one of the fingerprints, or all rows if those are too many to send to the scan."""
    fingerprints, number = found
    if number > BROADCAST_ROWS:
        return df
    return df.join(F.broadcast(fingerprints), F.xxhash64(*(df[k] for k in keys)) == fingerprints["fp"], "left_semi")


def repeated_ids(df: DataFrame, key: str = "doc_id") -> DataFrame:
    """(key, cnt) of each key with several rows, nulls included, in a table where most keys have one.

    The rows of :func:`docmeld.operators.validation.duplicate_doc_ids`, which suits tables where most keys repeat.
    """
    found = unusual(Workspace(df.sparkSession), "repeated", [df.select(key)], {(1,)})
    return only(df, found, key).groupBy(key).agg(F.count(F.lit(1)).alias("cnt")).where(F.col("cnt") > 1)
