"""Document fingerprints by order min-hash.

Every k-mer of a text is numbered by how often it occurred before, and hashed with that number. For each component the
smallest of these hashes are selected, put back in text order, and hashed as a tuple. Two texts agree in a component if
the same k-mers are selected in the same order, so the share of equal components falls with edits, moved ones included.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from docmeld.llm.common import chunks, shuffle_partitions
from docmeld.llm.shingles import mix

#: Characters of a k-mer, components, and k-mers selected for each.
K, COMPONENTS, SELECTED = 5, 64, 2
#: Ranges of ids per shuffle partition.
RANGES = 4
_BASE = np.uint64(0x9E3779B97F4A7C15)
_HIGH = np.uint64(0xFFFFFFFF00000000)


def order_minhash(text: str) -> np.ndarray:
    """The components of a text, 16 bits each.

    A component orders the numbered k-mers by their hash, counted upwards from a value of its own and around the end, so
    one sorting serves all components. Texts shorter than a k-mer are one k-mer; the empty text has components of zeros.
    """
    points = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.uint64)
    if not len(points):
        return np.zeros(COMPONENTS, np.uint16)
    n = max(1, len(points) - K + 1)
    code = np.full(n, min(K, len(points)), np.uint64)
    for j in range(min(K, len(points))):
        code = (code + points[j : j + n]) * _BASE
        code ^= code >> np.uint64(29)
    # equal k-mers side by side, in text order: 32 bits of hash above, the place below
    place = np.arange(n, dtype=np.uint64)
    packed = np.sort((mix(code) & _HIGH) | place)
    kmer = packed & _HIGH
    first = np.concatenate(([True], kmer[1:] != kmer[:-1]))
    at = np.arange(n)
    occurrence = at - np.maximum.accumulate(np.where(first, at, 0))
    # the same again for the numbered k-mers
    ranked = np.sort((mix(kmer + mix(occurrence.astype(np.uint64) + np.uint64(1))) & _HIGH) | (packed & ~_HIGH))
    starts = np.searchsorted(ranked, np.arange(COMPONENTS, dtype=np.uint64) << np.uint64(64 - (COMPONENTS - 1).bit_length()))
    rows = ranked[(starts[:, None] + np.arange(min(SELECTED, n))) % n]
    in_order = np.take_along_axis(rows, np.argsort(rows & ~_HIGH, axis=1), 1) & _HIGH
    out = np.zeros(COMPONENTS, np.uint64)
    for column in in_order.T:
        out = mix(out + column + np.uint64(1))
    return (out >> np.uint64(48)).astype(np.uint16)


def hexed(components: np.ndarray) -> str:
    return components.astype(">u2").tobytes().hex()


def likeness(a: np.ndarray, b: np.ndarray) -> float:
    """Share of equal components."""
    return float((a == b).mean())


class _Row(NamedTuple):
    doc_id: int | None
    text: str
    print: np.ndarray


def _range_of(ids: pa.Array, bounds: np.ndarray) -> np.ndarray:
    """Range k holds the ids in [bounds[k - 1], bounds[k]), range 0 also the null ids."""
    null = ids.is_null().to_numpy(zero_copy_only=False)
    return np.where(null, 0, np.searchsorted(bounds, ids.fill_null(0).to_numpy(), side="right")).astype(np.int32)


def _ranges(ids: DataFrame, n: int) -> tuple[np.ndarray, dict[int, tuple[int | None, int]]]:
    """Bounds that cut the ids into about ``n`` ranges. Of each range that has rows: its largest id, and the range that
    the document of this id closes, which is the one above it, and the lowest for the very first document."""
    bounds = np.array(sorted({int(x) for x in ids.filter("doc_id is not null").approxQuantile("doc_id", [k / n for k in range(1, n)], 0.2 / n)}), np.int64)

    def largest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found: dict[int, int | None] = {}
        for batch in batches:
            for k, i in zip(_range_of(batch["doc_id"], bounds).tolist(), batch["doc_id"].to_pylist(), strict=True):
                if found.get(k) is None or (i is not None and i > found[k]):
                    found[k] = i
        yield pa.RecordBatch.from_arrays([pa.array(list(found), pa.int32()), pa.array(list(found.values()), pa.int64())], ["range", "head"])

    heads = ids.mapInArrow(largest, "range int, head long").groupBy("range").agg(F.max("head").alias("head")).collect()  # one row per range
    ordered = sorted((r["range"], r["head"]) for r in heads)[::-1]
    return bounds, {k: (head, ordered[i - 1][0]) for i, (k, head) in enumerate(ordered)}


def neighbours(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Rows (doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next), one for each of ``docs``.

    The next document is that of the next smaller id, after the smallest the largest again; null ids come last, and rows
    that repeat an id follow each other by text. A null text is empty. One document alone is its own next.

    Documents are dealt into ranges of ids and sorted there; the first document of each range is dealt to the range
    before it as well, so that every document meets its next in one pass over sorted rows.
    """
    spark = docs.sparkSession
    own = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.coalesce(F.col(text), F.lit("")).alias("text"))
    n = RANGES * shuffle_partitions(spark)
    bounds, heads = _ranges(own.select("doc_id"), n)

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Each row with its range, and the first rows of a range once more for the range they close."""
        for batch in batches:
            ranges, ids = _range_of(batch["doc_id"], bounds), batch["doc_id"].to_pylist()
            first = [k for k, i in enumerate(ids) if heads[int(ranges[k])][0] == i]
            rows = batch.take(pa.array([*range(len(ids)), *first], pa.int64()))
            to = np.concatenate((ranges, np.array([heads[int(ranges[k])][1] for k in first], np.int32)))
            ghost = np.arange(len(to)) >= len(ids)
            yield pa.RecordBatch.from_arrays([rows["doc_id"], rows["text"], pa.array(to, pa.int32()), pa.array(ghost)], ["doc_id", "text", "to", "ghost"])

    dealt = own.mapInArrow(deal, "doc_id long, text string, to int, ghost boolean")
    ordered = dealt.repartition(n, "to").sortWithinPartitions("to", "ghost", F.col("doc_id").desc(), "text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last: _Row | None = None
        last_to, closed, out = None, False, []

        def flush() -> pa.RecordBatch:
            names = ("doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next")
            kinds = (pa.int64(), pa.int64(), pa.string(), pa.string(), pa.string(), pa.float64(), pa.float64())
            batch = pa.RecordBatch.from_arrays([pa.array([r[i] for r in out], k) for i, k in enumerate(kinds)], names)
            out.clear()
            return batch

        def finish(row: _Row, after: _Row) -> None:
            half = len(row.text) // 2
            edited = row.text[: len(row.text) - half] + after.text[:half]
            own, other = row.print, order_minhash(edited)
            digest = hashlib.sha256(edited.encode()).hexdigest()
            out.append((row.doc_id, len(row.text), digest, hexed(own), hexed(other), likeness(own, other), likeness(own, after.print)))

        for batch in batches:
            for part in chunks(batch):
                columns = (part[c].to_pylist() for c in ("doc_id", "text", "to", "ghost"))
                for i, t, to, ghost in zip(*columns, strict=True):
                    if to != last_to:
                        last, last_to, closed = None, to, False
                    if closed:
                        continue  # rows that repeat the first id of a range come again; the first of them is the next
                    row = _Row(i, t, order_minhash(t))
                    if last is not None:
                        finish(last, row)
                    last, closed = row, ghost
                yield flush()

    schema = "doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, near_edited double, near_next double"
    return ordered.mapInArrow(run, schema)


def fingerprints(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Rows (doc_id, fingerprint) without any comparison; a null text is empty."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in chunks(batch):
                prints = [hexed(order_minhash(t or "")) for t in part["text"].to_pylist()]
                yield pa.RecordBatch.from_arrays([part["doc_id"], pa.array(prints, pa.string())], ["doc_id", "fingerprint"])

    own = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text"))
    return own.mapInArrow(run, "doc_id long, fingerprint string")
