"""Mixing sources to target weights, by DataFrame operations only.

Tokens are summed per source, each source's repetition rate is its target over its sum, and a document comes
out floor(rate) times plus one more time if a hash of its id falls below the fraction.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.window import Window as W

from docmeld.functions.once import with_once
from docmeld.llm.common import shuffle_partitions
from docmeld.workspace import Workspace

#: Copies of each source's row that its documents are dealt over, so that a source with a third of all rows is no hot join key.
SALTS = 16
_COIN_HEX = 12


def word_count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(r"[^\x20\x09-\x0D]+")), F.lit(0)).cast("long")


def coin(doc_id: Column, text: Column, seed: str) -> Column:
    """A number in [0, 1) that depends on the id, the text and the seed alone."""
    parts = [F.coalesce(doc_id.cast("string"), F.lit("")), F.md5(F.coalesce(text, F.lit("")).cast("binary"))]
    digest = F.md5(F.concat_ws(":", F.lit(seed), *parts).cast("binary"))
    return F.conv(F.substring(digest, 1, _COIN_HEX), 16, 10).cast("double") / float(16**_COIN_HEX)


def _ranked(ws: Workspace, sources: DataFrame) -> DataFrame:
    """Sources with ``rank`` from 0 by code point, null last. Ranges are ranked apart and shifted by the sizes of those before."""
    ordered = sources.repartitionByRange(shuffle_partitions(ws.spark), F.col("_source").isNull(), "_source")
    ordered = ws.store(ordered.withColumn("_range", F.spark_partition_id()), "mix-ranges")
    before = ordered.groupBy("_range").agg(F.count("*").alias("_n"))
    # one row per range: as many as there are shuffle partitions, whatever the data
    before = before.select("_range", (F.sum("_n").over(W.orderBy("_range")) - F.col("_n")).alias("_before"))
    within = F.row_number().over(W.partitionBy("_range").orderBy(F.col("_source").isNull(), "_source"))
    return ordered.withColumn("_within", within).join(before, "_range").withColumn("rank", F.col("_before") + F.col("_within") - 1).drop("_range", "_within", "_before")


def source_rates(ws: Workspace, sizes: DataFrame, weights: Sequence[float], share: float, most: float) -> DataFrame:
    """(_source, source_size, target, rate) from rows of (_source, size), one row per source.

    Targets start at the weighted share of ``share`` times all sizes. Sources above ``most`` times their size
    stop there, and what is left is dealt again by weight to the others until none is above. Each turn reads
    three sums of the small source table.
    """
    sources = sizes.groupBy("_source").agg(F.sum("size").alias("source_size"))
    ranked = _ranked(ws, sources)
    weight = F.element_at(F.array(*map(F.lit, map(float, weights))), (F.col("rank") % len(weights) + 1).cast("int"))
    ranked = ws.store(ranked.withColumn("_weight", weight).drop("rank"), "mix-sources")
    cap = F.lit(float(most)) * F.col("source_size")
    total = (ranked.agg(F.sum("source_size")).first()[0] or 0) * share
    level, left = 0.0, -1
    while True:
        open_ = cap > F.lit(level) * F.col("_weight")
        n, w, stopped = ranked.agg(F.count(F.when(open_, 1)), F.sum(F.when(open_, F.col("_weight"))), F.sum(F.when(~open_, cap))).first()
        if not n or n == left:
            break
        level, left = max(level, (total - (stopped or 0.0)) / w), n
    target = F.least(cap, F.lit(level) * F.col("_weight"))
    rate = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(0.0)
    return ranked.withColumn("target", target).withColumn("rate", rate).drop("_weight")


def mix(
    docs: DataFrame, weights: Sequence[float] = (5, 2, 1), share: float = 1.5, most: float = 2.0, seed: str = "mix",
    doc_id: str = "doc_id", text: str = "text", source: str = "source", keep: Sequence[str] = (),
) -> DataFrame:
    """Rows (doc_id, size, source_size, target, copies) and the columns ``keep``, one for each row of ``docs``.

    Sources in code point order, null as a source of its own at the end, take ``weights`` in turn and share
    ``share`` times all words; no source takes more than ``most`` times its own. A null or empty text has size 0;
    a source without words has target 0. Coins follow id and text, so rows that have one id, or none, go each by its own
    text; only rows equal in both go together. Texts are taken whole. Tied sources cannot occur.
    Empty input gives no rows.
    """
    ws = Workspace(docs.sparkSession)
    key = F.col(source).alias("_source")
    sized = docs.select(F.col(doc_id).alias("_id"), key, F.col(text).alias("_text"), *(F.col(c).alias(f"_keep_{i}") for i, c in enumerate(keep)))
    sized = with_once(sized, "_own", F.struct(word_count(F.col("_text")).alias("size"), coin(F.col("_id"), F.col("_text"), seed).alias("coin")))
    sized = sized.withColumn("size", F.col("_own.size")).withColumn("_coin", F.col("_own.coin")).drop("_own")
    narrow = sized.drop("_text", *(f"_keep_{i}" for i in range(len(keep))))
    # without further columns the counted rows are stored and the texts are read once
    narrow = narrow if keep else ws.store(narrow, "mix-sizes")
    rates = source_rates(ws, narrow.select("_source", "size"), weights, share, most)
    rates = rates.withColumn("_salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1)))).withColumnRenamed("_source", "_of")
    rows = (sized if keep else narrow).withColumn("_at", F.pmod(F.xxhash64("_id", "size"), F.lit(SALTS)).cast("int"))
    rows = rows.join(rates, F.col("_source").eqNullSafe(F.col("_of")) & (F.col("_at") == F.col("_salt")))
    whole = F.floor("rate")
    copies = whole + (F.col("_coin") < F.col("rate") - whole).cast("long")
    return rows.select(
        F.col("_id").alias("doc_id"), "size", "source_size", "target", copies.alias("copies"),
        *(F.col(f"_keep_{i}").alias(c) for i, c in enumerate(keep) if c != "doc_id"),
    )


def mixed_documents(docs: DataFrame, **options) -> DataFrame:
    """The documents themselves, each as often as the mix takes it, with all their columns."""
    inner = {f"_c{i}": c for i, c in enumerate(docs.columns)}
    names = {c: k for k, c in inner.items()}
    asked = {k: names[options.pop(k, k)] for k in ("doc_id", "text", "source")}
    found = mix(docs.toDF(*inner), **asked, keep=list(inner), **options)
    copied = found.withColumn("_copy", F.explode(F.sequence(F.lit(1), F.greatest("copies", F.lit(1))))).filter("copies > 0")
    return copied.select(*(F.col(k).alias(c) for k, c in inner.items()))
