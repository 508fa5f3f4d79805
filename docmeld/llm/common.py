"""Helpers that several operators of this folder share."""

from __future__ import annotations

import ctypes
from collections.abc import Callable, Iterator
from functools import cache, wraps

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from docmeld.workspace import Workspace

#: Rows whose texts a task holds as Python objects at a time.
CHUNK = 256
#: A side is broadcast up to this many bytes as Spark holds it, keys and their table included; beyond it Spark joins by shuffling.
BROADCAST_BYTES, RELATION_ROW = 64 << 20, 56
#: What workers remember from task to task, by the operator that does.
_remembered: dict[str, Callable[[], None]] = {}


def fold(id_column: Column, folds: int) -> Column:
    """Remainder of the CRC-32 of the id as text; a null id counts as the empty text."""
    return F.crc32(F.coalesce(id_column.cast("string"), F.lit("")).cast("binary")) % folds


def remembers(operator: str, forget: Callable[[], None]) -> None:
    """Say how to make a worker process forget what an operator keeps for its next tasks."""
    _remembered[operator] = forget


@cache
def _trim() -> Callable[[int], int] | None:
    return getattr(ctypes.CDLL(None), "malloc_trim", None)


def released(run: Callable[[Iterator], Iterator], operator: str = "") -> Callable[[Iterator], Iterator]:
    """``run`` over the batches of a task, whose worker holds no more than it needs.

    Workers outlive their tasks: when one of another operator begins, what was remembered goes, and what a task frees goes
    back to the system when it ends.
    """

    @wraps(run)
    def whole(batches: Iterator) -> Iterator:
        for name, forget in _remembered.items():
            if name != operator:
                forget()
        try:
            yield from run(batches)
        finally:
            pa.default_memory_pool().release_unused()
            if trim := _trim():
                trim(0)

    return whole


def chunks(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
    for at in range(0, batch.num_rows, CHUNK):
        yield batch.slice(at, CHUNK)


def text_bytes(column: pa.Array) -> list[bytes]:
    """Texts as UTF-8, null as empty."""
    return [x or b"" for x in column.cast(pa.binary()).to_pylist()]


def map_texts(df: DataFrame, rows: Callable[[pa.RecordBatch], dict], schema: str) -> DataFrame:
    """Run ``rows`` over small slices of each Arrow batch; it returns the output columns in the order of ``schema``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in chunks(batch):
                yield pa.RecordBatch.from_pydict(rows(part))

    return df.mapInArrow(released(run), schema)


def checked_broadcast(df: DataFrame, bytes_per_row: int, limit: int = BROADCAST_BYTES) -> DataFrame:
    """``df``, which must be a stored table, marked for broadcasting if its counted rows of ``bytes_per_row`` fit the limit."""
    return F.broadcast(df) if df.count() * (bytes_per_row + RELATION_ROW) <= limit else df


def shuffle_partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def components(workspace: Workspace, edges: DataFrame, name: str) -> DataFrame:
    """Connected components of ``edges`` (a, b long): rows (id, root) with the smallest id that each id reaches.

    Alternates large-star and small-star: each round every node hands its neighbours to the smallest one it
    knows, until each tree is one star. A round is two groupings of the edge table; labels travel as rows, and
    the smallest neighbour is found by a pre-aggregated minimum, so a node with very many links needs no list.
    Each round is written, which cuts its lineage; the number of rounds grows with the logarithm of the
    longest path.
    """
    edges = workspace.store(edges.filter("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), f"{name}-0")
    turn, before = 0, None
    while True:
        turn += 1
        both = edges.select("a", "b").union(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        # large star: larger neighbours of each node go to the smallest of the node and its neighbours
        least = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
        large = both.filter("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b")).filter("a <> b")
        large = workspace.store(large.distinct(), f"{name}-{turn}-large")
        # small star: smaller neighbours of each node, and the node, go to the smallest of them
        least = large.groupBy("a").agg(F.min("b").alias("m"))
        pulled = large.join(least, "a")
        small = pulled.select(F.col("b").alias("a"), F.col("m").alias("b")).filter("a <> b").union(least.select("a", F.col("m").alias("b")))
        new = workspace.store(small.distinct(), f"{name}-{turn}")
        state = new.agg(F.count("*"), F.bit_xor(F.xxhash64("a", "b")), F.sum(F.crc32(F.concat_ws(",", "a", "b").cast("binary")))).first()
        edges = new
        if state == before:
            break
        before = state
    return edges.select(F.col("a").alias("id"), F.col("b").alias("root"))
