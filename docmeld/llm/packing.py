"""Best-fit packing of token sequences by the sum of squares.

Documents become pieces of at most one sequence. Pieces are dealt by hash into groups of bounded size, and each
group is packed on its own: a piece goes where the sum of the squared numbers of open sequences per residual gap
becomes smallest. Sequences that are left open by the groups are then taken apart and packed once more together,
group by group, so that what a group wastes does not add up.
"""

from __future__ import annotations

import json
import re
import struct
import zlib
from collections.abc import Iterator
from functools import cache

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from docmeld.llm.common import chunks, released, remembers, text_bytes
from docmeld.workspace import Workspace

#: Pieces that are packed together.
GROUP_PIECES = 100_000
#: Words whose ids a task remembers.
MEMORY_WORDS = 500_000
# How the tokenizer normalises and splits, if it is one whose words can be taken apart here.
_NORMAL = {"type": "Sequence", "normalizers": [{"type": "NFC"}, {"type": "Replace", "pattern": {"Regex": "\\s+"}, "content": " "}, {"type": "Lowercase"}]}
_SPLIT = "'s|'t|'re|'ve|'m|'ll|'d|[\\p{L}]+|[\\p{N}]|[^\\s\\p{L}\\p{N}]+"
_PLAIN = re.compile("([a-z\u00df-\u00f6\u00f8-\u00ff]+)([.,;:!?]*)")
# Byte-level tokens write each byte as a printable character: itself, or the next free one from 256 on.
_LITTLE = struct.Struct("<I").pack
_ODD = [b for b in range(256) if not (33 <= b <= 126 or 161 <= b <= 172 or b >= 174)]
_BYTE_LETTERS = {c: "".join(chr(256 + _ODD.index(b) if b in _ODD else b) for b in chr(c).encode()) for c in range(33, 256)}


def _tokenizer(path: str):
    from tokenizers import Tokenizer

    return Tokenizer.from_file(path)


class WordIds:
    """Token ids of texts, looked up word by word.

    The tokenizer of ``path`` splits at white space before anything else and no token spans a word's end, so the ids
    of a text are those of its words in turn. Words not remembered are encoded by the library, as one text.
    """

    def __init__(self, path: str):
        self.tokenizer, self.known, self.stems = _tokenizer(path), {}, {}
        self.model = self.tokenizer.model
        # a text that holds a special token as a string is encoded whole, as the library finds these before splitting
        self.special = [t.content.encode() for t in self.tokenizer.get_added_tokens_decoder().values()]
        parts = json.loads(self.tokenizer.to_str())
        self.plain = [parts["normalizer"], parts["pre_tokenizer"]["pretokenizers"][0]["pattern"]] == [_NORMAL, {"Regex": _SPLIT}]

    def _stem(self, stem: str) -> bytes:
        """Ids of one run of letters or of marks, which is one unit of the tokenizer's split."""
        if (ids := self.stems.get(stem)) is None:
            tokens = self.model.tokenize(stem if stem.isascii() else stem.translate(_BYTE_LETTERS))
            ids = self.stems[stem] = b"".join([_LITTLE(t.id) for t in tokens])
        return ids

    def _learn_plain(self, words: list[bytes]) -> list[bytes]:
        """Learn the words of Latin letters with marks at the end; return the others."""
        rest, known, stem, plain = [], self.known, self._stem, _PLAIN.fullmatch
        for w in words:
            if m := plain(w.decode().lower()):
                letters, marks = m.groups()
                known[w] = stem(letters) + stem(marks) if marks else stem(letters)
            else:
                rest.append(w)
        return rest

    def _learn(self, words: list[bytes]) -> None:
        texts = [w.decode() for w in words]
        starts = np.cumsum([0] + [len(t) + 1 for t in texts])
        encoded = self.tokenizer.encode(" ".join(texts), add_special_tokens=False)
        ids = np.array(encoded.ids, "<u4")
        of = np.searchsorted(starts, np.fromiter((a for a, _ in encoded.offsets), np.int64, len(ids)), side="right") - 1
        cuts = np.searchsorted(of, np.arange(len(words) + 1)).tolist()
        whole = ids.tobytes()
        for k, w in enumerate(words):
            self.known[w] = whole[4 * cuts[k] : 4 * cuts[k + 1]]

    def __call__(self, texts: list[bytes]) -> list[bytes]:
        """The ids of each text as little-endian unsigned 32-bit numbers."""
        split = [() if any(s in t for s in self.special) else t.split() for t in texts]
        wanted = set().union(*split)
        if len(self.known) > MEMORY_WORDS:
            self.known.clear()
            self.stems.clear()
        new = [w for w in wanted if w not in self.known]
        new = self._learn_plain(new) if self.plain else new
        if new:
            self._learn(new)
        get = self.known.__getitem__
        return [
            b"".join(map(get, words)) if words or not t else np.array(self.tokenizer.encode(t.decode(), add_special_tokens=False).ids, "<u4").tobytes()
            for t, words in zip(texts, split, strict=True)
        ]


@cache
def _word_ids(path: str) -> WordIds:
    """One for each worker process, so that its tasks share what is remembered."""
    return WordIds(path)


remembers("packing", _word_ids.cache_clear)


def pieces(docs: DataFrame, tokenizer: str, capacity: int, doc_id: str = "doc_id", text: str = "text", end_id: int = 0) -> DataFrame:
    """Rows (doc_id, piece, start, length, ids_crc32): whole documents, or consecutive pieces of those above the capacity."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids_of, end = _word_ids(tokenizer), np.array([end_id], "<u4").tobytes()
        for batch in batches:
            for part in chunks(batch):
                out: list[tuple] = []
                for i, own_ids in zip(part["doc_id"].to_pylist(), ids_of(text_bytes(part["text"])), strict=True):
                    ids = own_ids + end
                    for k, at in enumerate(range(0, len(ids), 4 * capacity)):
                        own = ids[at : at + 4 * capacity]
                        out.append((i, k, at // 4, len(own) // 4, zlib.crc32(own)))
                names, kinds = ("doc_id", "piece", "start", "length", "ids_crc32"), (pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64())
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*out, strict=True), kinds, strict=True)], names)

    own = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text"))
    return own.mapInArrow(released(run, "packing"), "doc_id long, piece int, start long, length long, ids_crc32 long")


def sum_of_squares(lengths: np.ndarray, capacity: int) -> np.ndarray:
    """The bin of each length, in the order given.

    With N(g) open bins of gap g, putting length s into gap g > 0 changes the sum of squares by
    2 (N(g - s) - N(g) + 1), and opening a bin by 2 N(capacity - s) + 1; full bins do not count. The least change
    wins, and of equal ones the smallest gap.
    """
    count = np.zeros(capacity + 1, np.int64)
    stacks: list[list[int]] = [[] for _ in range(capacity + 1)]
    bins, opened = np.empty(len(lengths), np.int64), 0
    for i, s in enumerate(lengths.tolist()):
        # change for gaps s .. capacity, halved and less a constant; a gap without open bins is no choice
        had = count[s:]
        rest = count[: capacity + 1 - s].copy()
        rest[0] = 0
        change = 2 * (rest - had) + 2
        change[0] = 1 - 2 * had[0]  # a filled bin leaves the sum
        change[had == 0] = np.iinfo(np.int64).max
        g = int(change.argmin())
        new = 2 * rest[-1] + 1 if s < capacity else 0
        if had[g] and change[g] <= new:
            gap = g + s
            b = stacks[gap].pop()
            count[gap] -= 1
        else:
            gap, b, opened = capacity, opened, opened + 1
        bins[i] = b
        if gap > s:
            stacks[gap - s].append(b)
            count[gap - s] += 1
    return bins


def _packed(group: pd.DataFrame, capacity: int) -> pd.DataFrame:
    group = group.sort_values(["length", "doc_id", "piece"], ascending=[False, True, True], kind="stable", ignore_index=True)
    bins = sum_of_squares(group["length"].to_numpy(), capacity)
    group["bin"] = bins
    group["offset"] = group.groupby("bin")["length"].cumsum() - group["length"]
    group["filled"] = group.groupby("bin")["length"].transform("sum")
    return group


def pack(rows: DataFrame, capacity: int, group_pieces: int = GROUP_PIECES) -> DataFrame:
    """``rows`` of ``pieces`` with sequence_id and offset. Groups of pieces of one length are dealt by hash, so each looks like the whole."""
    ws = Workspace(rows.sparkSession)
    rows = ws.store(rows, "pieces")
    full = rows.filter(F.col("length") == capacity)
    columns = "doc_id long, piece int, start long, length long, ids_crc32 long, part long, bin long, offset long, filled long"

    def dealt(part: DataFrame) -> DataFrame:
        n = max(1, -(-part.count() // group_pieces))
        part = part.withColumn("part", F.pmod(F.xxhash64("doc_id", "piece", "ids_crc32"), F.lit(n)))
        return part.groupBy("part").applyInPandas(lambda g: _packed(g, capacity), columns)

    first = ws.store(dealt(rows.filter(F.col("length") < capacity)), "first")
    again = ws.store(dealt(first.filter(F.col("filled") < capacity).select("doc_id", "piece", "start", "length", "ids_crc32")), "again")
    # even numbers, thirds apart: first round, second round, and sequences of one whole piece
    lot = lambda df, k: df.withColumn("sequence_id", (F.col("part") * (2 * group_pieces) + F.col("bin")) * 3 + k)
    alone = full.withColumn("sequence_id", F.monotonically_increasing_id() * 3 + 2).withColumn("offset", F.lit(0).cast("long"))
    out = ["doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"]
    return lot(first.filter(F.col("filled") == capacity), 0).select(out).union(lot(again, 1).select(out)).union(alone.select(out))


def best_fit(docs: DataFrame, tokenizer: str, capacity: int = 2048, doc_id: str = "doc_id", text: str = "text", end_id: int = 0, group_pieces: int = GROUP_PIECES) -> DataFrame:
    """Rows (doc_id, piece, start, length, ids_crc32, sequence_id, offset), one for each piece of a document.

    A null or empty text is the end id alone. Rows that repeat an id are documents of their own; ties in length go
    by id and piece. No rows give no rows.
    """
    return pack(pieces(docs, tokenizer, capacity, doc_id, text, end_id), capacity, group_pieces)
