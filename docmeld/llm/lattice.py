"""Language-model scores from a lattice of subwords.

A published vocabulary of pieces with unigram scores weighs every segmentation of a word; a forward recursion in log
space adds all of them up, so a word's probability is the marginal over its segmentations. Words counted in the training
documents are further arcs of the lattice, from the word's start to its end, and what the counts leave for unseen words
goes to the pieces. A text's probability is the product over its words and one end.
"""

from __future__ import annotations

import math
from collections import Counter, deque
from collections.abc import Iterator
from functools import cache

import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from docmeld.llm.common import chunks, fold, text_bytes
from docmeld.workspace import Workspace

#: Most frequent words that every task knows; all others are looked up by a join.
HEAD_WORDS = 100_000
#: Distinct words that a task counts before it hands over its counts.
COUNTED_WORDS = 300_000
#: Rank that flattens the head of the vocabulary's scores.
_FLAT = 20.0
_SPACE = "▁"


class Lattice:
    """Pieces of a sentencepiece vocabulary with log probabilities.

    The vocabulary orders its pieces by score; the score's rank becomes a probability that falls as the rank grows
    (Zipf), since these scores are ranks and no logarithms. Every character that is no piece is spelled in byte pieces, so
    each word has a segmentation. A word starts with the piece that marks a space.
    """

    def __init__(self, path: str):
        import sentencepiece

        model = sentencepiece.SentencePieceProcessor(model_file=path)
        self.log_p: dict[str, float] = {}
        pieces = sorted(
            ((model.get_score(i), model.id_to_piece(i)) for i in range(model.get_piece_size()) if not (model.is_control(i) or model.is_unknown(i) or model.is_byte(i))),
            key=lambda x: (-x[0], x[1]),
        )
        weights = [1 / (r + _FLAT) for r in range(len(pieces))]
        byte_weight = weights[-1] if weights else 1.0
        self.total = math.log(sum(weights) + 256 * byte_weight)
        for (_, piece), w in zip(pieces, weights, strict=True):
            self.log_p[piece] = math.log(w) - self.total
        self.byte = math.log(byte_weight) - self.total
        self.longest = max(map(len, self.log_p), default=1)

    def _marginal(self, text: str) -> float:
        log_p, longest, exp, log = self.log_p, self.longest, math.exp, math.log
        # no piece reaches further back than the longest one
        forward = deque([0.0], maxlen=longest)
        for end in range(1, len(text) + 1):
            ways = []
            for start in range(max(0, end - longest), end):
                p = log_p.get(text[start:end])
                if p is not None:
                    ways.append(forward[start - end] + p)
            if text[end - 1] not in log_p:
                ways.append(forward[-1] + self.byte * len(text[end - 1].encode()))
            top = max(ways)
            forward.append(top + log(sum(exp(w - top) for w in ways)) if len(ways) > 1 else top)
        return forward[-1]

    def log10(self, word: bytes) -> float:
        """Logarithm of the probability of a word, the sum over all its segmentations."""
        return self._marginal(_SPACE + word.decode()) / math.log(10)


@cache
def _lattice(path: str) -> Lattice:
    return Lattice(path)


def word_table(ws: Workspace, docs: DataFrame, train: Column, vocabulary: str) -> DataFrame:
    """Stored (word, c, lattice): every word of every document, its count in the training documents, its lattice score.

    Counting is by task first; words travel with their counts. The table grows with the documents.
    """

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known: Counter[bytes] = Counter()
        other: set[bytes] = set()

        def flush() -> pa.RecordBatch:
            words = list(known) + [w for w in other if w not in known]
            counts = [known.get(w, 0) for w in words]
            known.clear()
            other.clear()
            return pa.RecordBatch.from_arrays([pa.array(words, pa.binary()), pa.array(counts, pa.int64())], ["word", "c"])

        for batch in batches:
            for part in chunks(batch):
                for t, learned in zip(text_bytes(part["text"]), part["train"].to_pylist(), strict=True):
                    words = t.lower().split()
                    if learned:
                        known.update(words)
                    else:
                        other.update(words)
                if len(known) + len(other) > COUNTED_WORDS:
                    yield flush()
        yield flush()

    def weigh(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lattice = _lattice(vocabulary)
        for batch in batches:
            scores = [lattice.log10(w) for w in batch["word"].to_pylist()]
            yield pa.RecordBatch.from_arrays([batch["word"], batch["c"], pa.array(scores, pa.float64())], ["word", "c", "lattice"])

    counted = docs.select("text", train.alias("train")).mapInArrow(count, "word binary, c long").groupBy("word").agg(F.sum("c").alias("c"))
    return ws.store(counted.mapInArrow(weigh, "word binary, c long, lattice double"), "words")


def score(docs: DataFrame, train: Column, vocabulary: str, doc_id: str = "doc_id", text: str = "text", head_words: int = HEAD_WORDS) -> DataFrame:
    """Rows (doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score), one for each row of ``docs``.

    ``train`` is a condition on the column ``doc_id``. ``base_score`` adds log10((c + 1) / (N + V + 1)) over the words and
    the end, ``score`` the logarithm of the model: (1 - g) c / N + g times the lattice's marginal, where g = V / (N + V)
    is the share of tokens that were new when they came. The end is a token of its own; its lattice part is one byte
    piece. A null text is the end alone. Without training documents all weight is on the lattice. Rows that repeat an id
    are scored each.
    """
    ws = Workspace(docs.sparkSession)
    own = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text")).withColumn("train", train)
    words = word_table(ws, own, F.col("train"), vocabulary)
    ends = own.agg(F.count(F.when(F.col("train"), 1))).first()[0]
    sums = words.agg(F.sum("c"), F.count(F.when(F.col("c") > 0, 1))).first()
    n, v = (sums[0] or 0) + ends, sums[1] + bool(ends)
    new = v / (n + v) if n else 1.0

    def base_of(c: Column | int) -> Column:
        return F.log10((F.lit(c) if isinstance(c, int) else c) + F.lit(1.0)) - F.lit(math.log10(n + v + 1))

    def model_of(c: Column, lattice: Column) -> Column:
        # both parts relative to the larger one, since a long word's lattice part is below the smallest double
        rest = F.lit(math.log10(new)) + lattice
        counted = F.when(c > 0, F.log10(c * F.lit((1 - new) / max(n, 1))))
        top = F.greatest(rest, counted)
        return top + F.log10(F.pow(F.lit(10.0), rest - top) + F.coalesce(F.pow(F.lit(10.0), counted - top), F.lit(0.0)))

    rated = words.select("word", (F.col("c") > 0).cast("long").alias("known"), base_of(F.col("c")).alias("base"), model_of(F.col("c"), F.col("lattice")).alias("model"), "c")
    # the head ends at the rarest step of counts, sixteen to a doubling, above which the words fit
    step = F.floor(F.log2("c") * 16)
    steps = words.filter("c > 0").groupBy(step.alias("step")).count().orderBy(F.col("step").desc()).collect()
    kept, least = 0, math.inf
    for r in steps:
        kept += r["count"]
        if kept > head_words:
            break
        least = r["step"]
    head = rated.filter("c > 0").filter(step >= F.lit(float(least))).select("word", "known", "base", "model").collect()
    shared = docs.sparkSession.sparkContext.broadcast({bytes(r["word"]): (r["base"], r["model"]) for r in head})
    end_lattice = _lattice(vocabulary).byte / math.log(10)
    end_base = math.log10((ends + 1) / (n + v + 1))
    end_model = math.log10((1 - new) * ends / max(n, 1) + new * 10**end_lattice)

    def look_up(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        table, at = shared.value, TaskContext.get().partitionId() << 40
        for batch in batches:
            for part in chunks(batch):
                rows, rare = [], []
                for t in text_bytes(part["text"]):
                    words = t.lower().split()
                    met = Counter(words)
                    base, model, n_known, left = end_base, end_model, int(ends > 0), []
                    for w, k in met.items():
                        found = table.get(w)
                        if found is None:
                            left.append({"word": w, "k": k})
                        else:
                            base, model, n_known = base + k * found[0], model + k * found[1], n_known + k
                    rows.append((at, len(words) + 1, n_known, base, model))
                    rare.append(left)
                    at += 1
                columns = [pa.array(c, k) for c, k in zip(zip(*rows, strict=True), (pa.int64(), pa.int64(), pa.int64(), pa.float64(), pa.float64()), strict=True)]
                rare_kind = pa.list_(pa.struct([("word", pa.binary()), ("k", pa.int64())]))
                names = ["doc_id", "train", "row", "n_tokens", "n_known", "base", "model", "rare"]
                yield pa.RecordBatch.from_arrays([part["doc_id"], part["train"], *columns, pa.array(rare, rare_kind)], names)

    kind = dict(own.dtypes)["doc_id"]
    schema = f"doc_id {kind}, train boolean, row long, n_tokens long, n_known long, base double, model double, rare array<struct<word:binary,k:bigint>>"
    partial = ws.store(own.mapInArrow(look_up, schema), "partial")
    # words outside the head are rare each, so none is a hot key
    rare = partial.select("row", F.explode("rare").alias("r")).select("row", F.col("r.word").alias("word"), F.col("r.k").alias("k"))
    rare = rare.join(rated.select("word", "known", "base", "model"), "word")
    rare = rare.select("row", (F.col("known") * F.col("k")).alias("n_known"), (F.col("base") * F.col("k")).alias("base"), (F.col("model") * F.col("k")).alias("model"))
    rare = rare.groupBy("row").agg(F.sum("n_known").alias("more_n_known"), F.sum("base").alias("more_base"), F.sum("model").alias("more_model"))
    more = lambda name: F.col(name) + F.coalesce(f"more_{name}", F.lit(0))
    return partial.drop("rare").join(rare, "row", "left").select(
        "doc_id", (~F.col("train")).alias("held_out"), "n_tokens", more("n_known").alias("n_known"), F.lit(n).cast("long").alias("train_tokens"),
        more("base").alias("base_score"), more("model").alias("score"),
    )


def training_rows(doc_id: str = "doc_id") -> Column:
    return fold(F.col(doc_id), 7) != 2
