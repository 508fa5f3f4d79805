"""Language identification as a mixture of languages per document.

Training counts byte n-grams per language over all labelled texts. A document is a mixture: each of its n-grams
comes from one of the languages, and expectation-maximisation finds the proportions that make its n-grams likeliest.
Languages enter the document's set one by one as long as a likelihood penalised per language rises.
"""

from __future__ import annotations

import unicodedata
from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from docmeld.llm.common import chunks, fold, map_texts, released, text_bytes

#: Buckets that n-grams are hashed to; with one row of numbers per language this bounds the model.
BUCKETS = 1 << 16
ITERATIONS = 12
UNKNOWN = "und"
_LETTER = frozenset({"Lu", "Ll", "Lt", "Lm", "Lo"})


def has_letter(text: str) -> bool:
    return any(unicodedata.category(c) in _LETTER for c in text)


def grams(text: bytes) -> np.ndarray:
    """Buckets of the three-byte grams of a text in lower case, white space as one space around words."""
    b = np.frombuffer(b" " + b" ".join(text.lower().split()) + b" ", np.uint8).astype(np.uint32)
    if len(b) < 3:
        return np.empty(0, np.int64)
    code = (b[:-2] << 16) | (b[1:-1] << 8) | b[2:]
    return ((code * np.uint32(0x9E3779B1)) >> np.uint32(16)).astype(np.int64)


@dataclass(frozen=True)
class LanguageModel:
    languages: tuple[str, ...]
    #: probability of each bucket in each language, (BUCKETS, languages)
    table: np.ndarray

    def mixture(self, text: bytes) -> tuple[list[int], np.ndarray]:
        """The language set, most of it first, and its proportions."""
        counts = np.bincount(grams(text), minlength=1)
        buckets = np.flatnonzero(counts)
        n = counts[buckets].astype(float)
        p, total = self.table[buckets], n.sum()
        if not total or not self.languages:
            return [], np.empty(0)

        def fit(chosen: list[int]) -> tuple[float, np.ndarray]:
            own, share = p[:, chosen], np.full(len(chosen), 1 / len(chosen))
            mixed = own @ share
            if len(chosen) == 1:
                return float(n @ np.log(mixed)), share
            for _ in range(ITERATIONS):
                share = (share * ((n / mixed) @ own)) / total
                mixed = own @ share
            return float(n @ np.log(mixed)), share

        def fit_each(chosen: list[int], rest: list[int]) -> tuple[np.ndarray, np.ndarray]:
            """``fit`` of the chosen languages with each one of the rest: likelihoods and, in columns, shares."""
            own, new = p[:, chosen], p[:, rest]
            share = np.full((len(chosen) + 1, len(rest)), 1 / (len(chosen) + 1))
            mixed = own @ share[:-1] + new * share[-1]
            for _ in range(ITERATIONS):
                weight = n[:, None] / mixed
                share = share * np.concatenate((own.T @ weight, (new * weight).sum(0)[None])) / total
                mixed = own @ share[:-1] + new * share[-1]
            return n @ np.log(mixed), share

        # all languages at once say which is first; then each step tries all others and takes the one that gains most
        order = np.argsort(-fit(list(range(len(self.languages))))[1], kind="stable").tolist()
        chosen, (best, share) = order[:1], fit(order[:1])
        rest = order[1:]
        while rest:
            likelihood, proportions = fit_each(chosen, rest)
            k = int(likelihood.argmax())
            if likelihood[k] - best <= 1.5 * np.log(total) + 0.02 * total:
                break
            best, share = float(likelihood[k]), proportions[:, k]
            chosen = [*chosen, rest.pop(k)]
        by = np.argsort(-share, kind="stable")
        return [chosen[i] for i in by], share[by]

    def explains(self, text: bytes, chosen: list[int], share: np.ndarray) -> bool:
        """Whether the mixture makes a gram of the text likelier, in the mean, than a draw from all buckets does."""
        found = grams(text)
        return len(found) > 0 and float(np.log(self.table[found][:, chosen] @ share).mean()) > -np.log(BUCKETS)


def fit(docs: DataFrame, train: Column | None = None, text: str = "text", lang: str = "lang") -> LanguageModel:
    """Count n-grams per language over all rows of ``docs`` with a language for which ``train`` holds.

    Each task adds its counts up per language; what reaches the driver is one vector of ``BUCKETS`` numbers per language.
    """
    rows = docs.filter(F.col(lang).isNotNull() & (F.lit(True) if train is None else train)).select(F.col(text).alias("text"), F.col(lang).alias("lang"))

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[str, np.ndarray] = {}
        for batch in batches:
            for part in chunks(batch):
                for t, name in zip(text_bytes(part["text"]), part["lang"].to_pylist(), strict=True):
                    if name not in sums:
                        sums[name] = np.zeros(BUCKETS, np.int64)
                    sums[name] += np.bincount(grams(t), minlength=BUCKETS)
        for name, s in sums.items():
            yield pa.RecordBatch.from_pydict({"lang": pa.array([name]), "counts": pa.array([s.tobytes()], pa.binary())})

    def total(group: pd.DataFrame) -> pd.DataFrame:
        s = sum(np.frombuffer(c, np.int64) for c in group["counts"])
        return pd.DataFrame({"lang": [group["lang"].iloc[0]], "counts": [s.tobytes()]})

    found = rows.mapInArrow(released(count), "lang string, counts binary").groupBy("lang").applyInPandas(total, "lang string, counts binary").collect()
    found = sorted((r["lang"], np.frombuffer(bytes(r["counts"]), np.int64)) for r in found)
    table = np.stack([(c + 0.5) / (c.sum() + 0.5 * BUCKETS) for _, c in found], 1) if found else np.empty((BUCKETS, 0))
    return LanguageModel(tuple(name for name, _ in found), table)


def predict(docs: DataFrame, model: LanguageModel, doc_id: str = "doc_id", text: str = "text", keep: Sequence[str] = ()) -> DataFrame:
    """Rows (doc_id, lang_pred, score, languages, proportions) and the columns ``keep``, one for each row of ``docs``.

    ``languages`` is the set chosen, the largest share first; ``lang_pred`` is its first and ``score`` its share.
    A null text, a text without letters, and any text if nothing was learned, is ``und`` with score 0. Of equal
    shares, the language first in order leads.
    """
    shared = docs.sparkSession.sparkContext.broadcast((model.languages, model.table))
    own = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"), *(F.col(c).alias(c) for c in keep))

    def rows(part: pa.RecordBatch) -> dict:
        model = LanguageModel(*shared.value)
        sets, shares = [], []
        for t in text_bytes(part["text"]):
            chosen, share = model.mixture(t) if has_letter(t.decode()) else ([], np.empty(0))
            sets.append([model.languages[i] for i in chosen])
            shares.append(share.tolist())
        return {
            "doc_id": part["doc_id"],
            "lang_pred": [s[0] if s else UNKNOWN for s in sets],
            "score": [min(1.0, s[0]) if s else 0.0 for s in shares],
            "languages": pa.array(sets, pa.list_(pa.string())),
            "proportions": pa.array(shares, pa.list_(pa.float64())),
        } | {c: part[c] for c in keep}

    kinds = dict(own.dtypes)
    schema = f"doc_id {kinds['doc_id']}, lang_pred string, score double, languages array<string>, proportions array<double>"
    return map_texts(own, rows, schema + "".join(f", `{c}` {kinds[c]}" for c in keep))


def training_rows(doc_id: str = "doc_id") -> Column:
    """The rows that op4 learns from."""
    return fold(F.col(doc_id), 4) != 2


def keep_identified(docs: DataFrame, model: LanguageModel, least: float = 0.5, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """``docs`` without those that have no letter, or neither a language with a share of ``least`` nor a set of languages that
    explains them; all columns stay as they are. If nothing was learned, all with a letter stay."""
    shared = docs.sparkSession.sparkContext.broadcast((model.languages, model.table))

    def clear(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        model = LanguageModel(*shared.value)

        def stays(text: str) -> bool:
            if not model.languages:
                return True
            chosen, share = model.mixture(text.encode())
            return len(share) > 0 and (share[0] >= least or model.explains(text.encode(), chosen, share))

        for texts in batches:
            yield pd.Series([bool(t) and has_letter(t) and bool(stays(t)) for t in texts], dtype=bool)

    return docs.filter(F.pandas_udf(released(clear), "boolean", F.PandasUDFType.SCALAR_ITER)(F.col(text)))
