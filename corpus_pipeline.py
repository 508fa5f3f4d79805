"""From raw documents to packed training sequences: identify, deduplicate, join near copies, mix, pack.

Each stage takes what its predecessor wrote. All but the last return the columns of the documents.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from docmeld.llm import exact_dedup, language, mixing, ngram_join, packing
from docmeld.llm.queries import PACKING_VOCABULARY, table, vocabulary
from docmeld.workspace import Workspace

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def identify_languages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that one language, or a set of languages, explains; the rest has no letters or no language."""
    return language.keep_identified(docs, language.fit(docs))


def drop_exact_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return exact_dedup.deduplicate(docs)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group linked by 80 % or more of its five-word shingles."""
    return ngram_join.deduplicate(docs, words=5, least=80)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return mixing.mixed_documents(docs)


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return packing.best_fit(docs, vocabulary(PACKING_VOCABULARY))


STAGES: list[tuple[str, Stage]] = [
    ("language_id", identify_languages),
    ("exact_dedup", drop_exact_copies),
    ("ngram_jaccard_join", drop_near_copies),
    ("mixing", mix_sources),
    ("packing", pack_sequences),
]

#: Packing goes piece by piece, which SQL cannot say; the tests compare with a plain version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    ws, docs = Workspace(spark), table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = ws.store(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
