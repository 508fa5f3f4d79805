"""Exact duplicates by counting quotient filters.

Each task fills a counting quotient filter with the fingerprints of its texts. The filters travel in blocks of
equal uppermost bits and are merged by sorted remainders. Texts whose fingerprint counts more than one are
grouped by their bytes; all others are known to be alone without being compared or moved.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from docmeld.llm import quotient
from docmeld.llm.common import checked_broadcast, map_texts, shuffle_partitions, text_bytes
from docmeld.workspace import Workspace

#: Fingerprints that a task holds before it hands over its filter.
FILTER_ROWS = 2_000_000
#: Fingerprints of a block, about.
BLOCK_ROWS = 2_000_000
#: Copies of each group's row that its members are dealt over, so that one huge group is no hot join key.
SALTS = 16
_FILTER = "block int, quotient_bits int, occupied binary, ends binary, remainders binary, counts binary"


def normal(text: bytes) -> bytes:
    """A-Z in lower case, every other byte as it is."""
    return text.lower()


def _fingerprint(digest: bytes, bits: int) -> int:
    return int.from_bytes(digest[:8], "big") >> (64 - bits)


def _digests(docs: DataFrame, bits: int) -> DataFrame:
    def rows(batch: pa.RecordBatch) -> dict:
        found = [hashlib.sha256(normal(t)) for t in text_bytes(batch["text"])]
        return {
            "doc_id": batch["doc_id"],
            "fingerprint": pa.array([_fingerprint(d.digest(), bits) for d in found], pa.int64()),
            "text_sha256": [d.hexdigest() for d in found],
        }

    return map_texts(docs, rows, "doc_id long, fingerprint long, text_sha256 string")


def _texts(docs: DataFrame, bits: int) -> DataFrame:
    def rows(batch: pa.RecordBatch) -> dict:
        texts = [normal(t) for t in text_bytes(batch["text"])]
        prints = pa.array([_fingerprint(hashlib.sha256(t).digest(), bits) for t in texts], pa.int64())
        return {"doc_id": batch["doc_id"], "fingerprint": prints, "normal": pa.array(texts, pa.binary())}

    return map_texts(docs, rows, "doc_id long, fingerprint long, normal binary")


def repeated_fingerprints(ws: Workspace, prints: DataFrame, bits: int = quotient.BITS) -> DataFrame:
    """Stored (fingerprint) of those that occur in more than one row of ``prints``."""
    # as many blocks as there are tasks, and more where a block would hold too many fingerprints for one group
    blocks = max(shuffle_partitions(ws.spark), -(-prints.count() // BLOCK_ROWS))
    block_bits = max(1, min(24, (blocks - 1).bit_length()))
    low = bits - block_bits

    def filters(values: np.ndarray) -> Iterator[pd.DataFrame]:
        keys, counts = quotient.add_up(values, np.ones(len(values), np.int64))
        blocks = (keys >> np.uint64(low)).astype(np.int64)
        edges = np.concatenate((np.flatnonzero(np.diff(blocks, prepend=-1)), [len(keys)]))
        mask = np.uint64((1 << low) - 1)
        rows = [{"block": blocks[i]} | quotient.encode(keys[i:j] & mask, counts[i:j], low) for i, j in zip(edges[:-1], edges[1:], strict=True)]
        if rows:
            yield pd.DataFrame(rows)

    def build(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held, n = [], 0
        for batch in batches:
            held.append(batch["fingerprint"].to_numpy().astype(np.uint64))
            n += len(batch)
            if n >= FILTER_ROWS:
                yield from filters(np.concatenate(held))
                held, n = [], 0
        if held:
            yield from filters(np.concatenate(held))

    def join(group: pd.DataFrame) -> pd.DataFrame:
        keys, counts = quotient.merge(group.to_dict("records"), low)
        top = np.uint64(int(group["block"].iloc[0]) << low)
        return pd.DataFrame({"fingerprint": (keys[counts > 1] | top).astype(np.int64)})

    parts = prints.select("fingerprint").mapInPandas(build, _FILTER)
    return ws.store(parts.groupBy("block").applyInPandas(join, "fingerprint long"), "repeated")


def duplicates(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", bits: int = quotient.BITS) -> DataFrame:
    """Rows (doc_id, keep_id, group_size, kept, text_sha256), one for each row of ``docs``.

    Texts are equal if their bytes are, after lower-casing A-Z; null counts as empty. The row with the largest id
    of each group stays; a null id is smaller than any other, and alone or among nulls it stays. Rows that repeat
    both id and text carry the same flags. Empty input gives no rows. Fingerprints have ``bits`` bits; fewer cost more comparing, not results.
    """
    ws = Workspace(docs.sparkSession)
    own = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text"))
    rows = ws.store(_digests(own, bits), "digests")
    repeated = checked_broadcast(repeated_fingerprints(ws, rows, bits), 8)
    # texts that may have a copy, compared as bytes; equal ones meet in the task that read them before they move
    texts = _texts(own, bits).join(repeated, "fingerprint", "left_semi")
    groups = texts.groupBy("normal").agg(F.max("doc_id").alias("keep_id"), F.count("*").alias("group_size"))
    groups = groups.filter("group_size > 1").select(F.sha2("normal", 256).alias("text_sha256"), "keep_id", "group_size")
    groups = ws.store(groups, "groups").withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    rows = rows.withColumn("salt", F.pmod(F.xxhash64("doc_id"), F.lit(SALTS)).cast("int"))
    joined = rows.join(groups, ["text_sha256", "salt"], "left")
    keep = F.when(F.col("group_size").isNull(), F.col("doc_id")).otherwise(F.col("keep_id"))
    return joined.select(
        "doc_id", keep.alias("keep_id"), F.coalesce("group_size", F.lit(1)).cast("long").alias("group_size"),
        F.col("doc_id").eqNullSafe(keep).alias("kept"), "text_sha256",
    )


def deduplicate(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """``docs`` with one row for each text; of rows with the same text and id, one stays as well."""
    ws = Workspace(docs.sparkSession)
    found = ws.store(duplicates(docs, doc_id, text), "found")
    kept = found.filter("kept").groupBy(F.col("doc_id").alias("_kept_id"), F.col("text_sha256").alias("_kept_sha")).agg(F.count("*").alias("_kept_rows"))
    kept = ws.store(kept, "kept")
    # most rows have a text of their own: what goes is the shorter list
    gone = ws.store(found.filter("not kept").select(F.col("doc_id").alias("__docmeld_gone")).distinct(), "gone")
    same = kept.filter("_kept_rows > 1 or _kept_id is null")
    some = same.limit(1).count() > 0
    # ids that occur with several texts, or not at all, need the text to tell rows apart
    mixed = found.groupBy("doc_id").agg(F.max("kept").alias("_any"), F.min("kept").alias("_all"), F.count("*").alias("_n")).filter("_n > 1 or doc_id is null")
    if not some and not mixed.limit(1).count():
        return docs.join(checked_broadcast(gone, 8), F.col(doc_id) == F.col("__docmeld_gone"), "left_anti")
    names = {f"_c{i}": c for i, c in enumerate(docs.columns)}
    at = {c: k for k, c in names.items()}
    sha = F.sha2(F.translate(F.coalesce(F.col(at[text]), F.lit("")), "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz").cast("binary"), 256)
    rows = docs.toDF(*names).withColumn("_sha", sha)
    rows = rows.join(kept, F.col(at[doc_id]).cast("long").eqNullSafe(F.col("_kept_id")) & (F.col("_sha") == F.col("_kept_sha")), "left_semi")
    return rows.dropDuplicates([at[doc_id], "_sha"]).select(*(F.col(k).alias(c) for k, c in names.items()))
