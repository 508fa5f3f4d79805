"""Merkle manifest of a table: one tree per group over its rows in order, one tree over the groups' roots.

Trees are cut into aligned blocks of ``HEIGHT`` levels. A block is one row that holds its nodes in van Emde Boas order: the
tree is split at half its height, the upper half comes first and then each lower half, each laid out the same way. Where a
node lies follows from its depth and index alone, so building a block and reading the siblings of a leaf are the same
arithmetic (:func:`address`). The roots of the blocks are the leaves of the next round of blocks, until each tree has one
block; siblings are then read from the top round down.

Ranks come from one sorting of narrow rows (ids and digests), never from a window over a group: a group may hold most
of the rows. No step needs more of a tree than a block in one place.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator, Mapping, Sequence
from functools import cache, reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from docmeld.llm.common import checked_broadcast, shuffle_partitions
from docmeld.workspace import Workspace

#: Levels below the root of a block; a block has up to 2^HEIGHT leaves.
HEIGHT = 8
#: Rows that one task sorts.
ROWS_PER_PART = 1_000_000
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")
PATH = "array<struct<left: boolean, sibling: string>>"


def address(levels: int, depth: int, index: np.ndarray) -> np.ndarray:
    """Place of the nodes ``index`` at ``depth`` (the root has 0) in the layout of a complete tree of ``levels`` levels."""
    if levels == 1:
        return np.zeros_like(index)
    top = levels // 2
    if depth < top:
        return address(top, depth, index)
    below, depth = levels - top, depth - top
    tree, own = index >> depth, index & ((1 << depth) - 1)
    return (1 << top) - 1 + tree * ((1 << below) - 1) + address(below, depth, own)


@cache
def _addresses() -> list[np.ndarray]:
    return [address(HEIGHT + 1, d, np.arange(1 << d)) for d in range(HEIGHT + 1)]


def digest(text: str) -> str:
    return hashlib.sha256(text.encode()).hexdigest()


def leaf(columns: Mapping[str, Column] | None = None, fields: Sequence[str] = FIELDS) -> Column:
    """Digest of a row: per field ``-`` for null, else its length in bytes, a colon and its value. ``columns`` replaces fields."""

    def written(name: str) -> Column:
        value = (columns or {}).get(name, F.col(name)).cast("string")
        return F.coalesce(F.concat(F.octet_length(value).cast("string"), F.lit(":"), value), F.lit("-"))

    return F.sha2(F.concat(*map(written, fields)).cast("binary"), 256)


def build(leaves: list[str], rounds_follow: bool) -> tuple[bytes, int]:
    """The nodes of a block in their layout, and the depth at which its root lies.

    A block of a larger tree is reduced over all its levels, a lone node becoming the digest of itself; the only block of
    a tree is reduced until one node is left.
    """
    nodes, row, depth = np.zeros(((2 << HEIGHT) - 1, 32), np.uint8), leaves, HEIGHT
    while True:
        nodes[_addresses()[depth][: len(row)]] = np.frombuffer(bytes.fromhex("".join(row)), np.uint8).reshape(-1, 32)
        if depth == 0 or (len(row) == 1 and not rounds_follow):
            return nodes.tobytes(), depth
        row = [digest("".join(row[i : i + 2])) for i in range(0, len(row), 2)]
        depth -= 1


def siblings(nodes: bytes, size: int, root_depth: int) -> tuple[list[str], list[list[dict]]]:
    """The leaves of a block, and for each the steps to the block's root: which side the sibling is on, and its digest,
    both null where a node has none."""
    whole = nodes.hex()
    read = lambda depth, i: whole[64 * (at := int(_addresses()[depth][i])) : 64 * at + 64]
    steps: list[list[dict]] = [[] for _ in range(size)]
    count = size
    for depth in range(HEIGHT, root_depth, -1):
        row = [read(depth, i) for i in range(count)]
        for slot, own in enumerate(steps):
            other = (slot >> (HEIGHT - depth)) ^ 1
            own.append({"left": bool(other & 1 == 0), "sibling": row[other]} if other < count else {"left": None, "sibling": None})
        count = (count + 1) // 2
    return [read(HEIGHT, i) for i in range(size)], steps


def _numbered(ws: Workspace, rows: DataFrame, order: Sequence[str], name: str) -> DataFrame:
    """``rows`` with their rank ``idx`` in their ``tree`` by ``order``, nulls first, and the size ``n`` of the tree.

    Rows are sorted by ranges, in which each one's place is stored; where the part of a tree in a range begins is a sum over
    ranges. Rows that are equal in all of ``order`` are told apart by where they were stored, so they are split like others.
    """
    stored = ws.store(rows.withColumn("tie", F.monotonically_increasing_id()), f"{name}-rows")
    parts = max(shuffle_partitions(ws.spark), stored.count() // ROWS_PER_PART)
    keys = ["tree", *order, "tie"]
    # the place holds the number of the range in its upper bits; as it is stored, a task that runs again changes nothing
    placed = stored.repartitionByRange(parts, *keys).sortWithinPartitions(*keys).withColumn("place", F.monotonically_increasing_id())
    placed = ws.store(placed.drop("tie"), f"{name}-sorted").withColumn("part", F.shiftright("place", 33))
    runs = placed.groupBy("tree", "part").agg(F.min("place").alias("first"), F.count("*").alias("rows"))
    before = runs.select(F.col("tree"), F.col("part").alias("p"), F.col("rows").alias("r"))
    # one row for each range that a tree lies in
    by_part = Window.partitionBy("tree").orderBy("p")
    total = F.sum("r").over(Window.partitionBy("tree"))
    before = before.select("tree", F.col("p").alias("part"), (F.sum("r").over(by_part) - F.col("r")).alias("offset"), total.alias("n"))
    runs = ws.store(runs.join(before, ["tree", "part"]).drop("rows"), f"{name}-runs")
    found = placed.join(checked_broadcast(runs, 100), ["tree", "part"])
    return found.withColumn("idx", F.col("place") - F.col("first") + F.col("offset")).drop("place", "part", "first", "offset")


def _blocks(ws: Workspace, nodes: DataFrame, name: str) -> list[DataFrame]:
    """Rounds of blocks over ``nodes`` (tree, idx, n, digest, payload), each a stored table with one row per block."""
    kind = nodes.schema["payload"].dataType.simpleString()
    rounds: list[DataFrame] = []

    def made(group: pa.Table) -> pa.Table:
        group = group.sort_by("idx")
        n_blocks = -(-group["n"][0].as_py() >> HEIGHT)
        nodes, root_depth = build(group["digest"].to_pylist(), n_blocks > 1)
        address_of_root = int(_addresses()[root_depth][0])
        payload = group["payload"].combine_chunks()
        if isinstance(payload, pa.ChunkedArray):
            payload = pa.concat_arrays(payload.chunks)
        return pa.table({
            "tree": [group["tree"][0].as_py()], "block": [group["idx"][0].as_py() >> HEIGHT], "n_blocks": [n_blocks], "size": pa.array([len(group)], pa.int32()),
            "root_depth": pa.array([root_depth], pa.int32()), "nodes": [nodes], "digest": [nodes[32 * address_of_root : 32 * address_of_root + 32].hex()],
            "payload": pa.ListArray.from_arrays(pa.array([0, len(group)], pa.int32()), payload),
        })

    while True:
        schema = f"tree string, block long, n_blocks long, size int, root_depth int, nodes binary, digest string, payload array<{kind}>"
        grouped = nodes.groupBy("tree", F.shiftright("idx", HEIGHT).alias("block"))
        rounds.append(ws.store(grouped.applyInArrow(made, schema), f"{name}-blocks-{len(rounds)}"))
        nodes = rounds[-1].filter("n_blocks > 1").select("tree", F.col("block").alias("idx"), F.col("n_blocks").alias("n"), "digest", F.lit(0).alias("payload"))
        kind = "int"
        if nodes.isEmpty():
            return rounds


def _down(ws: Workspace, rounds: list[DataFrame], upper: DataFrame, name: str) -> DataFrame:
    """Rows (tree, subroot, payload, leaf, path) of all leaves; ``upper`` has the (tree, subroot, path) of each tree's root."""
    above = None
    for k in range(len(rounds) - 1, -1, -1):
        blocks = rounds[k]
        tops = blocks.filter("n_blocks = 1").select("tree", "block").join(upper, "tree")
        above = tops if above is None else above.unionByName(tops)
        kind = blocks.schema["payload"].dataType.elementType.simpleString()
        last = k == 0

        def read(batches: Iterator[pa.RecordBatch], last: bool = last) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                for at in range(batch.num_rows):
                    b = batch.slice(at, 1)
                    size = b["size"][0].as_py()
                    leaves, steps = siblings(b["nodes"][0].as_py(), size, b["root_depth"][0].as_py())
                    rest = b["path"][0].as_py()
                    paths = pa.array([own + rest for own in steps], pa.list_(pa.struct([("left", pa.bool_()), ("sibling", pa.string())])))
                    first = b["block"][0].as_py() << HEIGHT
                    kept = {"payload": b["payload"].flatten()} if last else {}
                    yield pa.RecordBatch.from_pydict({
                        "tree": [b["tree"][0].as_py()] * size, "block": list(range(first, first + size)), "subroot": [b["subroot"][0].as_py()] * size,
                        "leaf": leaves, "path": paths, **kept,
                    })

        schema = f"tree string, block long, subroot string, leaf string, path {PATH}" + (f", payload {kind}" if last else "")
        above = blocks.join(above, ["tree", "block"]).mapInArrow(read, schema)
        if not last:
            above = ws.store(above.drop("leaf"), f"{name}-paths-{k}")
    return above


def manifest(docs: DataFrame, claimed: Mapping[str, Column] | None = None, group: str = "lang", order: str = "doc_id", fields: Sequence[str] = FIELDS) -> DataFrame:
    """Rows (doc_id, leaf, claimed, subroot, root, path), one for each row of ``docs``.

    Rows are leaves of their group's tree in the order of their id; the groups' roots, null first and then by bytes, are leaves
    of the tree above. ``path`` holds the steps from the leaf to the root. ``claimed`` is the leaf with the columns given in
    place of its own, for an audit of what is there now against the manifest; without them it is the leaf.

    Nulls in any field have a digest of their own; null ids come first in their group. Rows with one id are ordered by
    their leaves, equal rows in any order, which gives the same tree. Texts of any length are hashed where they are read and
    go no further. Other columns of ``docs`` play no part, whatever their names. An empty table gives no rows.
    """
    ws = Workspace(docs.sparkSession)
    tree = F.coalesce(F.concat(F.lit("="), F.col(group).cast("string")), F.lit("-"))
    own = leaf(fields=fields)
    other = leaf(claimed, fields) if claimed else own
    rows = docs.select(
        tree.alias("tree"), F.col(order).cast("long").alias("id"), own.alias("digest"), F.when(other != own, other).alias("claimed")
    )
    nodes = _numbered(ws, rows, ["id", "digest"], "leaves").withColumn("payload", F.struct("id", "claimed")).drop("id", "claimed")
    rounds = _blocks(ws, nodes, "leaves")
    single = F.lit("").alias("tree")
    roots = reduce(DataFrame.unionAll, [r.filter("n_blocks = 1").select(single, F.col("tree").alias("of"), "digest") for r in rounds])
    tops = _numbered(ws, roots, ["of"], "roots").withColumn("payload", F.col("of")).drop("of")
    top_rounds = _blocks(ws, tops, "roots")
    last = top_rounds[-1].filter("n_blocks = 1").select("digest").first()
    start = ws.spark.createDataFrame([("", "", [])], f"tree string, subroot string, path {PATH}")
    upper = _down(ws, top_rounds, start, "roots").select(F.col("payload").alias("tree"), F.col("leaf").alias("subroot"), "path")
    found = _down(ws, rounds, ws.store(upper, "upper"), "leaves")
    return found.select(
        F.col("payload.id").alias("doc_id"), "leaf", F.coalesce("payload.claimed", "leaf").alias("claimed"), "subroot",
        F.lit(last["digest"] if last else None).cast("string").alias("root"), "path",
    )


def folded(start: Column, path: Column) -> Column:
    """The root that a leaf and the siblings on its path lead to."""

    def step(so_far: Column, s: Column) -> Column:
        joined = F.when(s["left"].isNull(), so_far).when(s["left"], F.concat(s["sibling"], so_far)).otherwise(F.concat(so_far, s["sibling"]))
        return F.sha2(joined.cast("binary"), 256)

    return F.aggregate(path, start, step)


def proof(path: Column) -> Column:
    """Digest of the siblings on a path, in order."""
    return F.sha2(F.array_join(F.filter(F.transform(path, lambda s: s["sibling"]), lambda x: x.isNotNull()), "").cast("binary"), 256)
