"""Report views and metrics that are kept up to date: each batch adds its partial aggregates, a refresh merges those and reads no rows."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from docmeld.functions.numeric import round_half_up
from docmeld.operators.metrics import FLAGS, PAIR_COUNTS, document_counts, document_figures, percentages
from docmeld.workspace import Workspace, names, remove

#: Batches that a state is made of before they are merged into one.
MERGE_AT = 16


@dataclass(frozen=True)
class Measures:
    """Groups of rows and what is kept of each: sums (a count is a sum of ones), lowest and highest values."""

    keys: dict[str, Column]
    sums: dict[str, Column]
    lows: dict[str, Column]
    highs: dict[str, Column]

    def of(self, rows: DataFrame) -> DataFrame:
        """State of rows. Nulls in a key are a group of their own; a null value changes nothing."""
        kept = [f(column).alias(n) for f, part in self._parts() for n, column in part.items()]
        return rows.groupBy(*[column.alias(name) for name, column in self.keys.items()]).agg(*kept)

    def merged(self, states: DataFrame, keys: list[str] | None = None) -> DataFrame:
        """States added up per group, or per coarser group."""
        return states.groupBy(*(list(self.keys) if keys is None else keys)).agg(*[f(n).alias(n) for f, part in self._parts() for n in part])

    def _parts(self) -> list[tuple[Callable, dict[str, Column]]]:
        return [(F.sum, self.sums), (F.min, self.lows), (F.max, self.highs)]


class StateTable:
    """The states of all batches in a folder: one folder per batch, and one for all up to some batch.

    A batch that is added again replaces what it added before. Merged states count once they are written whole; the
    batches they cover are deleted by the merge after that, so that a reader of the older list finds its files.
    """

    def __init__(self, spark: SparkSession, path: str, measures: Measures, wide: bool = False):
        """A ``wide`` state has very many groups; it is written as the session shuffles it, others in one file."""
        self.spark, self.path, self.measures, self.wide = spark, path, measures, wide

    def _numbers(self, kind: str) -> list[int]:
        """Numbers of the folders of a kind that were written whole."""
        found = [n for n in names(self.spark, self.path) if n.startswith(f"{kind}-")]
        return sorted(int(n.split("-")[1]) for n in found if "_SUCCESS" in names(self.spark, f"{self.path}/{n}"))

    def _live(self) -> tuple[int | None, list[int]]:
        whole = self._numbers("upto")[-1:] or [None]
        return whole[0], [b for b in self._numbers("batch") if whole[0] is None or b > whole[0]]

    def add(self, rows: DataFrame, batch_id: int) -> None:
        """Add a batch; batches have rising numbers. One that is merged already is not added again."""
        if self.covers(batch_id):
            return
        self._write(self.measures.of(rows), f"batch-{batch_id}")
        if len(self._live()[1]) >= MERGE_AT:
            self.merge()

    def _write(self, state: DataFrame, folder: str) -> None:
        (state if self.wide else state.coalesce(1)).write.mode("overwrite").parquet(f"{self.path}/{folder}")

    def merge(self) -> None:
        whole, batches = self._live()
        if not batches:
            return
        self._write(self.read(), f"upto-{batches[-1]}")
        if whole is not None:
            remove(self.spark, f"{self.path}/upto-{whole}")
            for b in (b for b in self._numbers("batch") if b <= whole):
                remove(self.spark, f"{self.path}/batch-{b}")

    def read(self, keys: list[str] | None = None) -> DataFrame:
        """State of all batches per group, or per coarser group; it fails if nothing was ever added."""
        return self.measures.merged(reduce(DataFrame.unionAll, self._stored(*self._live())), keys)

    def covers(self, batch_id: int) -> bool:
        """Whether a batch was merged with others, so that it cannot be replaced any more."""
        whole, _ = self._live()
        return whole is not None and batch_id <= whole

    def before(self, batch_id: int) -> DataFrame | None:
        """Unmerged state rows of all batches below a number that is not merged yet; None if there are none."""
        whole, batches = self._live()
        stored = self._stored(whole, [b for b in batches if b < batch_id])
        return reduce(DataFrame.unionAll, stored) if stored else None

    def _stored(self, whole: int | None, batches: list[int]) -> list[DataFrame]:
        folders = [f"{self.path}/batch-{b}" for b in batches] + ([] if whole is None else [f"{self.path}/upto-{whole}"])
        return [self.spark.read.parquet(f) for f in folders]


_SIMILARITY = {"ssn4_agreement": "ssn4_exact", "dob_agreement": "dob_exact", "first_name_sim": "first_name_sim", "last_name_sim": "last_name_sim"}


def summed_match_measures() -> Measures:
    """:func:`match_measures` of a summed table (``operators/summed.py``), whose weights and similarities are never null."""
    n = F.col("pairs")
    sums = {"n": n, "weight_n": n, "weight_sum": F.col("weight_sum")}
    for name, column in list(_SIMILARITY.items())[:2]:
        known = F.col(column).isNotNull().cast("long")
        sums |= {f"{name}_n": n * known, f"{name}_sum": F.col(column) * n}
    for name, column in (("first_name_sim", "first_sum"), ("last_name_sim", "last_sum")):
        sums |= {f"{name}_n": n, f"{name}_sum": F.col(column)}
    keys = {c: F.col(c) for c in ("batch_date", "match_class", "weight_bucket")}
    return Measures(keys, sums, {"weight_min": F.col("weight_min")}, {"weight_max": F.col("weight_max")})


def match_measures() -> Measures:
    """What the views of matches need, by day, class and whole-number weight; as many groups as days times some hundreds."""
    weight, one = F.col("total_weight"), F.lit(1)
    keys = {"batch_date": F.to_date("pipeline_run_ts"), "match_class": F.col("match_class"), "weight_bucket": F.round(weight, 0)}
    sums = {"n": one, "weight_n": weight.isNotNull().cast("long"), "weight_sum": weight}
    for name, column in _SIMILARITY.items():
        sums |= {f"{name}_n": F.col(column).isNotNull().cast("long"), f"{name}_sum": F.col(column)}
    return Measures(keys, sums, {"weight_min": weight}, {"weight_max": weight})


def _mean(name: str) -> Column:
    return round_half_up(F.try_divide(f"{name}_sum", f"{name}_n"), 3)


def match_summary(state: StateTable) -> DataFrame:
    return state.read(["match_class"]).select(
        "match_class", F.col("n").alias("candidate_count"), _mean("weight").alias("avg_weight"),
        round_half_up(F.col("weight_min"), 3).alias("min_weight"), round_half_up(F.col("weight_max"), 3).alias("max_weight"),
        *[_mean(name).alias(f"avg_{name}") for name in _SIMILARITY],
    )


def score_histogram(state: StateTable) -> DataFrame:
    found = state.read(["weight_bucket", "match_class"])
    return found.select("weight_bucket", "match_class", F.col("n").alias("pair_count")).orderBy("weight_bucket", "match_class")


def batch_match_metrics(state: StateTable) -> DataFrame:
    found = state.read(["batch_date", "match_class"])
    return found.select("batch_date", "match_class", F.col("n").alias("pair_count"), _mean("weight").alias("avg_weight")).orderBy("batch_date", "match_class")


class RunningMetrics:
    """The metrics of all runs so far, from the rows of each run alone.

    Two states lie side by side: row counts per document, which only grow, and totals over documents. A batch looks up what
    earlier ones know of its own documents, and adds the difference that it makes to the totals. So a document that
    arrives twice, or whose pairs come in a later run, counts as it does when all rows are read at once. Everything is a
    whole number, so sums do not depend on their order. ``metrics`` reads totals only: one row per batch.

    A batch that runs again replaces its own part. Totals are written first: a batch known to the documents is whole.
    """

    #: Documents of a batch are broadcast to the scan of earlier counts up to this number, of ids up to some hundred bytes.
    BROADCAST_ROWS = 100_000

    def __init__(self, spark: SparkSession, path: str):
        counts = {c: F.col(c) for c in ("parsed_rows", *FLAGS, *PAIR_COUNTS)}
        self.spark = spark
        self.documents = StateTable(spark, f"{path}/documents", Measures({"doc_id": F.col("doc_id")}, counts, {}, {}), wide=True)
        totals = {c: F.col(c) for c in ("docs", *FLAGS, *PAIR_COUNTS)}
        self.totals = StateTable(spark, f"{path}/totals", Measures({}, totals, {}, {}))

    def add(self, parsed: DataFrame, structured: DataFrame, matches: DataFrame, batch_id: int) -> None:
        """Add what a run brought; any of the three may be empty, and documents may be known from earlier runs."""
        if self.documents.covers(batch_id):
            return
        work = Workspace(self.spark)
        try:
            new = work.store(document_counts(parsed, structured, matches).drop("structured_rows", "match_rows"), "new")
            earlier = self.documents.before(batch_id)
            if earlier is None:
                change = self._totals(new, 1)
            else:
                ids = new.select("doc_id")
                few = new.count() <= self.BROADCAST_ROWS
                # null-safe: rows without an id are one document
                known = earlier.alias("e").join(F.broadcast(ids) if few else ids, F.col("e.doc_id").eqNullSafe(ids["doc_id"]), "left_semi")
                known = work.store(self.documents.measures.merged(known), "known")
                after = self.documents.measures.merged(known.unionByName(new))
                change = self._totals(after, 1).unionAll(self._totals(known, -1))
            self.totals.add(change, batch_id)
            self.documents.add(new, batch_id)
        finally:
            work.remove()

    @staticmethod
    def _totals(documents: DataFrame, sign: int) -> DataFrame:
        """One row of totals over documents with a parsed row."""
        sums = {"docs": F.count("doc_id"), **document_figures()}
        return documents.where("parsed_rows > 0").agg(*[(F.coalesce(v, F.lit(0)) * sign).alias(c) for c, v in sums.items()])

    def metrics(self) -> DataFrame:
        """One row, equal to :func:`docmeld.operators.metrics.dq_metrics` over all rows added; it fails if nothing was."""
        return percentages(self.totals.read())
