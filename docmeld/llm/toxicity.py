"""Toxicity by a counterfactually regularised classifier.

A logistic model over hashed words and word beginnings. Labelled texts that name a group are also taken with the
group swapped for others of its kind, and training penalises the squared change of the score, so the model cannot
lean on the mention of a group.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from docmeld.llm.common import checked_broadcast, fold, map_texts, text_bytes
from docmeld.workspace import Workspace

#: Hash buckets of features.
BUCKETS = 1 << 18
#: Labelled rows that the classifier is fitted on, at most: the smallest hashes of the id, half of them toxic if there are as many.
SAMPLE_ROWS = 8_000
#: Standard deviations by which a feature's shares in the two classes have to differ.
DEVIATIONS = 4.5
# Words for groups; those of one line are swapped for each other.
GROUPS = (
    ("men", "women"), ("man", "woman"), ("male", "female"), ("boys", "girls"), ("muslim", "christian", "jewish", "hindu", "buddhist", "atheist"),
    ("muslims", "christians", "jews", "hindus", "buddhists", "atheists"), ("black", "white", "asian", "latino"), ("gay", "straight", "lesbian", "bisexual"),
    ("transgender", "cisgender"), ("immigrants", "natives"), ("immigrant", "native"), ("old", "young"), ("disabled", "healthy"), ("african", "american", "european", "mexican", "chinese"),
)
_SWAP = {w.encode(): [x.encode() for x in line if x != w] for line in GROUPS for w in line}
_CUT = bytes(c if 48 <= c <= 57 or 97 <= c <= 122 or c >= 128 else 32 for c in range(256))


def words(text: bytes) -> set[bytes]:
    """Distinct words, A-Z in lower case: runs of digits, letters a-z and bytes above 127."""
    return set(text.lower().translate(_CUT).split())


def _bucket(feature: bytes) -> int:
    from xxhash import xxh64_intdigest

    return xxh64_intdigest(feature) % BUCKETS


def features(word: bytes) -> tuple[int, ...]:
    """A word counts as itself and, if longer, by its first five and four characters, whatever its ending is."""
    text = word.decode(errors="replace")
    parts = [b"w" + word] + [f"{n}{text[:n]}".encode() for n in (4, 5) if len(text) > n]
    return tuple(_bucket(p) for p in parts)


@dataclass(frozen=True)
class ToxicityModel:
    weights: np.ndarray
    bias: float


def _sample(docs: DataFrame, labels: DataFrame, rows: int, train: Column, doc_id: str, text: str) -> list:
    """A bounded sample of labelled texts as (label, features, swapped features) for the driver.

    Of the texts of an id that repeats, the one with the smallest hash counts.
    """
    ws = Workspace(docs.sparkSession)
    order = F.xxhash64(F.col("_id"))
    known = labels.filter("toxic in (0, 1)").select(F.col("doc_id").alias("_id"), F.col("toxic").cast("int").alias("label"))
    known = known.filter(F.col("_id").isNotNull()).filter(train).groupBy("_id").agg(F.max("label").alias("label"))
    parts = [known.filter(F.col("label") == k).orderBy(order, "_id").limit(rows // 2) for k in (0, 1)]
    chosen = checked_broadcast(ws.store(parts[0].union(parts[1]), "sample"), 16)
    hashed = docs.select(F.col(doc_id).alias("_id"), F.col(text).alias("text")).join(chosen, "_id").withColumn("_hash", F.xxhash64("text"))
    first = ws.store(hashed.groupBy("_id").agg(F.min("_hash").alias("_hash")), "texts")
    texts = hashed.join(checked_broadcast(first, 16), ["_id", "_hash"])
    seen: set[int] = set()

    def encode(part: pa.RecordBatch) -> dict:
        # equal texts of an id: a task hands over one
        new = []
        for i in part["_id"].to_pylist():
            new.append(i not in seen)
            seen.add(i)
        part = part.filter(pa.array(new, pa.bool_()))
        plain, gone, come = [], [], []
        for t in text_bytes(part["text"]):
            own = words(t)
            plain.append(sorted({f for w in own for f in features(w)}))
            named = sorted(w for w in own if w in _SWAP)
            others = [x for w in named for x in _SWAP[w][:1] if x not in own]
            gone.append(sorted({f for w in named for f in features(w)}))
            come.append(sorted({f for w in others for f in features(w)}))
        lists = {k: pa.array(v, pa.list_(pa.int32())) for k, v in (("plain", plain), ("gone", gone), ("come", come))}
        return {"id": part["_id"], "label": part["label"]} | lists

    schema = "id long, label int, plain array<int>, gone array<int>, come array<int>"
    return map_texts(texts.select(F.col("_id").cast("long").alias("_id"), "label", "text"), encode, schema).dropDuplicates(["id"]).toArrow().sort_by("id").to_pylist()


def fit(
    docs: DataFrame, labels: DataFrame, train: Column, sample_rows: int = SAMPLE_ROWS, penalty: float = 10.0, ridge: float = 1e-4,
    epochs: int = 30, doc_id: str = "doc_id", text: str = "text",
) -> ToxicityModel:
    """Fit on at most ``sample_rows`` labelled rows for which ``train`` (a condition on ``_id``) holds.

    Gradient steps scaled per weight; the penalty pulls the score of a text and of its swapped form together.
    Without labelled rows of both classes the score is the share of toxic ones, or 0 if there are none.
    """
    rows = _sample(docs, labels, sample_rows, train, doc_id, text)
    y = np.array([r["label"] for r in rows], float)
    weights = np.zeros(BUCKETS)
    if len(set(y.tolist())) < 2:
        return ToxicityModel(weights, 30.0 if len(y) and y[0] else -30.0)
    swaps = [np.array(r["gone"] + r["come"], np.int64) for r in rows]
    signs = [np.repeat([1.0, -1.0], [len(r["gone"]), len(r["come"])]) for r in rows]
    # identity words: each swap of a group of words has to leave the score where it is
    pairs = [(np.array(features(a)), np.array(features(b))) for a, others in _SWAP.items() for b in others]
    swaps += [np.concatenate(p) for p in pairs]
    signs += [np.repeat([1.0, -1.0], [len(a), len(b)]) for a, b in pairs]
    flat, sizes = np.concatenate([np.array(r["plain"], np.int64) for r in rows]), np.array([len(r["plain"]) for r in rows])
    row = np.repeat(np.arange(len(rows)), sizes)
    swap_flat, swap_sign = np.concatenate(swaps), np.concatenate(signs)
    swap_row = np.repeat(np.arange(len(swaps)), [len(s) for s in swaps])
    share = np.where(y == 1, 0.25 / y.sum(), 0.75 / (1 - y).sum())
    # only features whose presence differs between the classes by more than chance among so many may carry weight
    hits = np.stack([np.bincount(flat[y[row] == k], minlength=BUCKETS) for k in (0, 1)])
    sizes = np.array([[(y == 0).sum()], [(y == 1).sum()]])
    share_in, pooled = (hits + 0.5) / (sizes + 1), (hits.sum(0) + 0.5) / (len(y) + 1)
    telling = np.abs(share_in[1] - share_in[0]) > DEVIATIONS * np.sqrt(pooled * (1 - pooled) * (1 / sizes).sum())
    bias, speed, bias_speed = 0.0, np.full(BUCKETS, 1e-8), 1e-8
    for _ in range(epochs):
        z = bias + np.bincount(row, weights[flat], len(rows))
        error = share * (1 / (1 + np.exp(-np.clip(z, -30, 30))) - y)
        slope = np.bincount(flat, error[row], BUCKETS) + ridge * weights
        change = np.bincount(swap_row, swap_sign * weights[swap_flat], len(swaps))
        slope += np.bincount(swap_flat, penalty / len(swaps) * swap_sign * change[swap_row], BUCKETS)
        slope[~telling] = 0
        speed += slope**2
        bias_speed += error.sum() ** 2
        weights -= 0.1 * slope / np.sqrt(speed)
        bias -= 0.1 * error.sum() / np.sqrt(bias_speed)
    return ToxicityModel(weights, bias)


def score(docs: DataFrame, model: ToxicityModel, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Rows (doc_id, score), one for each row of ``docs``: the probability that its text is toxic. A null text is empty."""
    shared = docs.sparkSession.sparkContext.broadcast((model.weights, model.bias))
    known: dict[bytes, float] = {}

    def rows(part: pa.RecordBatch) -> dict:
        weights, bias = shared.value
        logits = []
        for t in text_bytes(part["text"]):
            own = words(t)
            if len(known) > 400_000:
                known.clear()
            for w in own:
                if w not in known:
                    known[w] = features(w)
            marks = {f for w in own for f in known[w]}
            logits.append(bias + float(weights[np.fromiter(marks, np.int64, len(marks))].sum()))
        return {"doc_id": part["doc_id"], "score": 1 / (1 + np.exp(-np.clip(np.array(logits), -700, 700)))}

    own = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"))
    return map_texts(own, rows, f"doc_id {dict(own.dtypes)['doc_id']}, score double")


def training_rows() -> Column:
    return fold(F.col("_id"), 5) != 0
