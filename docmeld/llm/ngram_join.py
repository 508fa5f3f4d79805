"""N-gram Jaccard join with an R-tree over count vectors.

Shingles are hashed to groups; the counts per group are a point, and the summed minima of two points bound the
overlap of their sets from above. In the many dimensions that make this bound sharp, no box around unrelated points
prunes anything, so a tree over all sets would compare each with each. Sets are therefore first brought together by
segments of the hash range whose content is equal, of which linked sets share one by the pigeonhole principle
(``shingles.keys``). Below that, each bucket's points form an R-tree: boxes and then points whose summed minima are too
small are passed over, and what survives is verified on the whole sets.

Equal sets are one set from the start. Each set is first compared with the set that most of its buckets share most with.
Buckets that verified links do not connect by then are searched by tree, in cells of bounded size, twice: at first only
the likeliest pairs that would connect a cell's parts are verified, then every pair that is left between parts.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from docmeld.llm.common import CHUNK, checked_broadcast, chunks, components, map_texts, released, shuffle_partitions, text_bytes
from docmeld.llm.shingles import digest, keys, shingle_set
from docmeld.workspace import Workspace

#: Groups that shingles are hashed to, and how many of them the tree's boxes take together.
GROUPS, FOLDED = 512, 8
#: Points of a bucket in one part; a cell joins two parts.
CELL = 2_000
FANOUT = 32
#: Rows of small buckets that one task searches together.
BUNDLE = 20_000
#: Keys that are sorted together, while that takes no more than so many parts; larger parts are sorted on disk.
KEYS_PER_PART, MOST_PARTS = 300_000, 4_000
SALTS = 16
#: Bits of a key that travel. Sets that meet by chance are told apart when they are verified: of 3.4 billion keys 3 in 1,000 do.
KEY_BITS = 40
#: Pairs whose summed minima are computed at a time.
_PAIRS = 1 << 15


def group_counts(hashes: np.ndarray) -> np.ndarray:
    """Shingles per group, in the narrowest type that holds them."""
    counts = np.bincount((hashes & np.uint64(GROUPS - 1)).astype(np.int64), minlength=GROUPS)
    return counts.astype(np.uint8 if counts.max() < 1 << 8 else np.uint16 if counts.max() < 1 << 16 else np.int32)


def as_points(counts: list[bytes]) -> np.ndarray:
    """Stored counts as rows of one array."""
    kinds = {GROUPS: np.uint8, 2 * GROUPS: np.uint16, 4 * GROUPS: np.int32}
    if {len(c) for c in counts} <= {GROUPS}:
        return np.frombuffer(b"".join(counts), np.uint8).reshape(-1, GROUPS)
    return np.stack([np.frombuffer(c, kinds[len(c)]).astype(np.int32) for c in counts])


def _can_link(overlap: np.ndarray, sizes: np.ndarray, least: int) -> np.ndarray:
    """Whether ``overlap`` is enough for two sets with ``sizes`` shingles together: 100 I >= least (sizes - I)."""
    return (100 + least) * overlap >= least * sizes


def _minima(a: np.ndarray, b: np.ndarray, i: np.ndarray, j: np.ndarray) -> np.ndarray:
    parts = [np.minimum(a[i[k : k + _PAIRS]], b[j[k : k + _PAIRS]]).sum(1, dtype=np.int64) for k in range(0, len(i), _PAIRS)]
    return np.concatenate(parts) if parts else np.empty(0, np.int64)


def tree_pairs(counts: np.ndarray, sizes: np.ndarray, least: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Pairs i < j of rows of ``counts`` that may be linked, and their bounds, by descending an R-tree against itself.

    Rows are packed by size and then by their fullest group, ``FANOUT`` to a node, nodes to nodes above; a node knows the
    largest count per group and the smallest size below it. Boxes and points are compared in groups taken together, and
    the points that pass in all groups.
    """
    sizes = sizes.astype(np.int64)
    points = counts.reshape(len(counts), FOLDED, -1).sum(1, dtype=np.int32)
    order = np.lexsort((points.argmax(1), sizes // np.maximum(1, sizes // 10 + 1)))
    floors = [(points[order], sizes[order])]
    while len(floors[-1][0]) > FANOUT:
        top, small = floors[-1]
        cuts = np.arange(0, len(top), FANOUT)
        floors.append((np.maximum.reduceat(top, cuts), np.minimum.reduceat(small, cuts)))
    n = len(floors[-1][0])
    i, j = (a.astype(np.int64) for a in np.triu_indices(n))
    for depth in range(len(floors) - 1, -1, -1):
        box, small = floors[depth]
        if depth == 0:
            i, j = i[i < j], j[i < j]
        kept = _can_link(_minima(box, box, i, j), small[i] + small[j], least)
        i, j = i[kept], j[kept]
        if depth:
            below = len(floors[depth - 1][0])
            child = np.arange(FANOUT)
            ii = (i[:, None, None] * FANOUT + child[None, :, None] + 0 * child[None, None, :]).ravel()
            jj = (j[:, None, None] * FANOUT + child[None, None, :] + 0 * child[None, :, None]).ravel()
            fit = (ii < below) & (jj < below) & (ii <= jj)
            i, j = ii[fit], jj[fit]
    a, b = np.minimum(order[i], order[j]), np.maximum(order[i], order[j])
    bound = _minima(counts, counts, a, b)
    kept = _can_link(bound, sizes[a] + sizes[b], least)
    return a[kept], b[kept], bound[kept]


def connecting(a: np.ndarray, b: np.ndarray, weight: np.ndarray) -> np.ndarray:
    """Which of the edges between labels, heaviest first, connect what those before them did not."""
    parent: dict[int, int] = {}

    def root(x: int) -> int:
        while (up := parent.get(x, x)) != x:
            parent[x] = x = parent.get(up, up)
        return x

    kept = np.zeros(len(a), bool)
    for k in np.argsort(-weight, kind="stable").tolist():
        x, y = root(int(a[k])), root(int(b[k]))
        if x != y:
            parent[max(x, y)] = min(x, y)
            kept[k] = True
    return kept


def _signed(a: np.ndarray) -> np.ndarray:
    return a.view(np.int64)


def _meetings(docs: DataFrame, words: int, least: int) -> DataFrame:
    """(digest, key) of each set's keys; a task hands in each set once. The zeros above the bits of a key and the head of
    the next row are one run, which compresses."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[int] = set()
        for batch in batches:
            for part in chunks(batch):
                found, ids = [np.empty(0, np.uint64)], [np.empty(0, np.int64)]
                for t in text_bytes(part["text"]):
                    hashes = shingle_set(t, words)
                    if len(hashes) and (d := digest(hashes)) not in seen:
                        seen.add(d)
                        found.append(keys(hashes, least))
                        ids.append(np.full(len(found[-1]), d))
                short = np.concatenate(found) >> np.uint64(64 - KEY_BITS)
                yield pa.RecordBatch.from_pydict({"digest": np.concatenate(ids), "key": _signed(short)})

    return docs.select("text").mapInArrow(released(run, "shingles"), "digest long, key long")


def _made(ws: Workspace, docs: DataFrame, reps: DataFrame, digests: DataFrame, words: int, column: str, name: str) -> DataFrame:
    """Stored (digest, n, ``column``) of the sets asked for, made anew from one document each: their counts or their hashes.

    Only these documents reach Python, and no set travels. Ids need not tell documents apart; what comes out is matched by digest.
    """
    wanted = ws.store(reps.join(digests, "digest"), f"{name}-wanted")
    ids = checked_broadcast(wanted.select(F.col("rep").alias("_rep")), 8)
    chosen = docs.join(ids, F.col("doc_id").eqNullSafe(F.col("_rep")), "left_semi")
    value = group_counts if column == "counts" else lambda hashes: hashes

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[int] = set()
        for batch in batches:
            for part in chunks(batch):
                rows = []
                for t in text_bytes(part["text"]):
                    hashes = shingle_set(t, words)
                    if len(hashes) and (d := digest(hashes)) not in seen:
                        seen.add(d)
                        rows.append((d, len(hashes), value(hashes).tobytes()))
                kinds = {"digest": pa.int64(), "n": pa.int64(), column: pa.binary()}
                yield pa.RecordBatch.from_pydict({k: pa.array([r[i] for r in rows], t) for i, (k, t) in enumerate(kinds.items())})

    made = chosen.select("text").mapInArrow(released(run, "shingles"), f"digest long, n long, {column} binary")
    return ws.store(made.join(checked_broadcast(wanted.select("digest"), 8), "digest", "left_semi"), name)


class _Verifier:
    """Verifies pairs of sets: by the bound of their counts first, then on the whole sets."""

    def __init__(self, ws: Workspace, docs: DataFrame, reps: DataFrame, counts: DataFrame, words: int, least: int):
        self.ws, self.docs, self.reps, self.counts, self.words, self.least = ws, docs, reps, counts, words, least

    def linked(self, pairs: DataFrame, name: str) -> DataFrame:
        """Those of ``pairs`` (a, b) that are similar enough, stored."""
        least = self.least

        def bounded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                for part in chunks(batch):
                    a, b = (as_points(part[f"counts_{s}"].to_pylist()) for s in "ab")
                    sizes = part["n_a"].to_numpy() + part["n_b"].to_numpy()
                    kept = _can_link(np.minimum(a, b).sum(1, dtype=np.int64), sizes, least)
                    yield part.select(["a", "b"]).filter(pa.array(kept))

        def verified(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                for part in chunks(batch):
                    kept = []
                    for x, y in zip(part["hashes_a"].to_pylist(), part["hashes_b"].to_pylist(), strict=True):
                        p, q = np.frombuffer(x, np.uint64), np.frombuffer(y, np.uint64)
                        both = len(np.intersect1d(p, q, assume_unique=True))
                        kept.append(bool(_can_link(both, len(p) + len(q), least)))
                    yield part.select(["a", "b"]).filter(pa.array(kept, pa.bool_()))

        near = self.ws.store(_with_sides(pairs, self.counts, "counts").mapInArrow(released(bounded), "a long, b long").distinct(), f"{name}-near")
        digests = near.select(F.explode(F.array("a", "b")).alias("digest")).distinct()
        sets = _made(self.ws, self.docs, self.reps, digests, self.words, "hashes", f"{name}-sets")
        return self.ws.store(_with_sides(near, sets, "hashes").mapInArrow(released(verified), "a long, b long").distinct(), f"{name}-links")


def _with_sides(pairs: DataFrame, sets: DataFrame, column: str) -> DataFrame:
    for side in "ab":
        named = sets.select(F.col("digest").alias(side), F.col("n").alias(f"n_{side}"), F.col(column).alias(f"{column}_{side}"))
        pairs = pairs.join(named, side)
    return pairs


def _hub_pairs(members: DataFrame) -> DataFrame:
    """(a, b) of each set b with one other: of each bucket the set that meets most others in all its buckets, of these the
    one that b shares most buckets with. An original meets its copies more often than they meet each other."""
    weights = members.groupBy("digest").agg(F.sum("size").alias("weight"))
    hubs = members.join(weights, "digest").groupBy("key").agg(F.max(F.struct("weight", "digest")).alias("hub"))
    shared = members.join(hubs.select("key", F.col("hub.digest").alias("a"), F.col("hub.weight").alias("weight")), "key")
    shared = shared.filter("a <> digest").groupBy(F.col("digest").alias("b"), "a").agg(F.count("*").alias("n"), F.max("weight").alias("weight"))
    return shared.groupBy("b").agg(F.max(F.struct("n", "weight", "a"))["a"].alias("a")).select("a", "b")


def _open_pairs(ws: Workspace, members: DataFrame, roots: DataFrame, counts: DataFrame, least: int, every: bool, name: str) -> DataFrame:
    """Pairs of sets that share a bucket, are not connected yet, and pass the tree: ``every`` such pair, or of each cell
    those that would connect its parts, the ones with the highest bounds."""
    labelled = members.join(roots.withColumnRenamed("id", "digest"), "digest", "left").withColumn("label", F.coalesce("root", "digest")).drop("root", "size")
    ends = labelled.groupBy("key").agg(
        F.min("label").alias("first"), F.max("label").alias("last"), F.count("*").alias("size"),
        F.sum(F.xxhash64("digest") % (1 << 40)).alias("sum"), F.bit_xor(F.xxhash64("digest", F.lit(7))).alias("xor"),
    )
    # near copies share many buckets: of buckets with the same members one is searched
    ends = ends.filter("first <> last").groupBy("first", "last", "size", "sum", "xor").agg(F.min("key").alias("key")).select("key", "size")
    rows = ws.store(labelled.join(ws.store(ends, f"{name}-open"), "key"), f"{name}-members")
    bundles = max(shuffle_partitions(ws.spark), rows.count() // BUNDLE)
    rows = rows.join(counts, "digest")
    parts = F.ceil(F.col("size") / CELL).cast("int")
    own = F.pmod(F.xxhash64("digest"), parts).cast("int")
    rows = rows.withColumn("part", own).withColumn("other", F.explode(F.sequence(F.lit(0), parts - 1)))
    rows = rows.withColumn("i", F.least("part", "other")).withColumn("j", F.greatest("part", "other"))
    task = F.when(F.col("size") <= CELL, F.pmod(F.xxhash64("key"), F.lit(bundles))).otherwise(F.xxhash64("key", "i", "j"))

    def search(group: pd.DataFrame) -> pd.DataFrame:
        out = [np.empty((0, 2), np.int64)]
        for (_, i, j), cell in group.groupby(["key", "i", "j"], sort=False):
            n = cell["n"].to_numpy()
            x, y, bound = tree_pairs(as_points(cell["counts"].to_list()), n, least)
            label, part, ids = cell["label"].to_numpy(), cell["part"].to_numpy(), cell["digest"].to_numpy()
            kept = (label[x] != label[y]) & ((i == j) | (part[x] != part[y]))
            x, y, bound = x[kept], y[kept], bound[kept]
            if not every:
                kept = connecting(label[x], label[y], bound / (n[x] + n[y]))
                x, y = x[kept], y[kept]
            out.append(np.sort(np.stack((ids[x], ids[y]), 1), 1))
        found = np.unique(np.concatenate(out), axis=0)
        return pd.DataFrame({"a": found[:, 0], "b": found[:, 1]})

    found = rows.withColumn("task", task).select("task", "key", "i", "j", "part", "digest", "label", "n", "counts")
    return ws.store(found.groupBy("task").applyInPandas(search, "a long, b long").distinct(), f"{name}-pairs")


def _groups(ws: Workspace, docs: DataFrame, words: int, least: int, doc_id: str, text: str) -> tuple[DataFrame, DataFrame]:
    """Stored (doc_id, n_shingles, digest) of all rows, and (digest, least, root, component_id) of the sets in groups of two rows or more."""
    own = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text"))

    def sizes(part: pa.RecordBatch) -> dict:
        sets = [shingle_set(t, words) for t in text_bytes(part["text"])]
        return {"doc_id": part["doc_id"], "n_shingles": pa.array([len(s) for s in sets], pa.int64()), "digest": pa.array([digest(s) if len(s) else None for s in sets], pa.int64())}

    points = ws.store(map_texts(own, sizes, "doc_id long, n_shingles long, digest long"), "points")
    # as many parts as keep the keys of one within a sort of moderate size; a set has fewer keys than half its shingles
    keys_at_most = (points.agg(F.sum("n_shingles")).first()[0] or 0) // 2
    parts = max(shuffle_partitions(ws.spark), min(MOST_PARTS, keys_at_most // KEYS_PER_PART))
    dealt = _meetings(own, words, least).repartition(parts, "key")
    shared = dealt.groupBy("key").agg(F.min("digest").alias("first"), F.max("digest").alias("last"), F.count("*").alias("size"))
    shared = shared.filter("first <> last").select("key", "size")
    members = ws.store(dealt.join(shared.hint("merge"), "key").distinct(), "members")
    reps = ws.store(points.filter("digest is not null").groupBy("digest").agg(F.min("doc_id").alias("rep")), "reps")
    counts = _made(ws, own, reps, members.select("digest").distinct(), words, "counts", "counts")
    verifier = _Verifier(ws, own, reps, counts, words, least)
    # three rounds, each over what those before it did not connect
    roots = components(ws, verifier.linked(ws.store(_hub_pairs(members), "hub-pairs"), "hub"), "hubs")
    for every, name in ((False, "likely"), (True, "rest")):
        links = verifier.linked(_open_pairs(ws, members, roots, counts, least, every, name), name)
        roots = components(ws, links.union(roots.select(F.col("id").alias("a"), F.col("root").alias("b"))), name)
    # the smallest id of each component goes back to all documents of its sets
    classes = points.filter("digest is not null").groupBy("digest").agg(F.min("doc_id").alias("least"), F.count("*").alias("rows"))
    classes = classes.join(roots.withColumnRenamed("id", "digest"), "digest", "left").withColumn("root", F.coalesce("root", "digest"))
    classes = ws.store(classes, "classes")
    found = classes.groupBy("root").agg(F.min("least").alias("component_id"), F.sum("rows").alias("members")).filter("members > 1")
    return points, ws.store(classes.join(found, "root").select("digest", "least", "root", "component_id"), "found")


def _of_rows(points: DataFrame, found: DataFrame, how: str) -> DataFrame:
    """``points`` with what ``found`` says of their digests, salted, as a digest may be that of very many rows."""
    found = found.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    points = points.withColumn("salt", F.pmod(F.xxhash64("doc_id"), F.lit(SALTS)).cast("int"))
    return points.join(found, ["digest", "salt"], how)


def join(docs: DataFrame, words: int = 5, least: int = 80, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Rows (doc_id, n_shingles, component_id), one for each row of ``docs``.

    Documents are linked if their sets of ``words``-word shingles share ``least`` per cent or more of their union;
    ``component_id`` is the smallest id that links lead to, nulls aside, the document's own included. With fewer words the
    whole sequence is one shingle; a null text or one without words has no shingles and no links. Rows that repeat an id
    and a text are linked to themselves. Sets are known by 64-bit hashes of their 64-bit shingle hashes.
    """
    points, found = _groups(Workspace(docs.sparkSession), docs, words, least, doc_id, text)
    joined = _of_rows(points, found.select("digest", "component_id"), "left")
    return joined.select("doc_id", "n_shingles", F.coalesce("component_id", "doc_id").alias("component_id"))


def deduplicate(docs: DataFrame, words: int = 5, least: int = 80, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """``docs`` with one row of each group of linked ones: that of the smallest id, nulls last, and of the smallest digest among those.

    Each row is decided by its own text: ids may be null or occur with several texts. Texts without words have no links and stay.
    """
    ws = Workspace(docs.sparkSession)
    points, found = _groups(ws, docs, words, least, doc_id, text)
    first = found.filter(F.col("least").eqNullSafe(F.col("component_id"))).groupBy("root").agg(F.min("digest").alias("first"))
    found = ws.store(found.join(first, "root").select("digest", "component_id", (F.col("digest") == F.col("first")).alias("first")), "decided")
    stays = F.col("first") & F.col("doc_id").eqNullSafe(F.col("component_id"))
    grouped = ws.store(_of_rows(points, found, "inner").select("doc_id", "digest", stays.alias("stays")), "grouped")
    gone = ws.store(grouped.filter("not stays").select(F.col("doc_id").alias("__docmeld_gone"), F.col("digest").alias("__docmeld_digest")).distinct(), "gone")
    repeated = points.filter("doc_id is not null").groupBy("doc_id").count().filter("count > 1")
    if not grouped.filter("doc_id is null").limit(1).count() and not repeated.limit(1).count():
        return docs.join(checked_broadcast(gone.select("__docmeld_gone"), 8), F.col(doc_id).cast("long") == F.col("__docmeld_gone"), "left_anti")

    # ids that occur with several texts, or not at all, need the set to tell rows apart
    @F.arrow_udf("long")
    def own_digest(texts: pa.Array) -> pa.Array:
        sets = (shingle_set(t, words) for at in range(0, len(texts), CHUNK) for t in text_bytes(texts.slice(at, CHUNK)))
        return pa.array([digest(s) if len(s) else None for s in sets], pa.int64())

    names = {f"_c{i}": c for i, c in enumerate(docs.columns)}
    at = {c: k for k, c in names.items()}
    rows = docs.toDF(*names).withColumn("_digest", own_digest(F.col(at[text]).cast("string")))
    rows = rows.join(checked_broadcast(gone, 16), F.col(at[doc_id]).cast("long").eqNullSafe(F.col("__docmeld_gone")) & (F.col("_digest") == F.col("__docmeld_digest")), "left_anti")
    # of rows with the same id and set one stays; a row without a set is like no other
    rows = rows.filter("_digest is null").unionAll(rows.filter("_digest is not null").dropDuplicates([at[doc_id], "_digest"]))
    return rows.select(*(F.col(k).alias(c) for k, c in names.items()))
