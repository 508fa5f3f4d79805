"""Quality metrics of a run, the gate on them, and threshold reports."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from docmeld.config import DEMO_LIMITS, PRODUCTION_LIMITS, QualityLimits
from docmeld.functions.numeric import percent, round_half_up
from docmeld.operators.counted import pair_number

# Names of the metrics, and below of the checks in the threshold reports.
METRIC_COLUMNS = (
    "total_docs", "pct_unreadable", "pct_missing_dob", "pct_missing_ssn4", "parse_errors",
    "pct_match", "pct_possible_match", "pct_non_match",
)
#: Counts of a document's rows that say whether something is wrong with it, and counts of its pairs.
FLAGS = ("unreadable", "no_dob", "no_ssn4", "errors")
PAIR_COUNTS = ("classed", "match", "possible_match", "non_match")


def document_figures() -> dict[str, Column]:
    """Number of documents with each flag and of pairs, over one row per document."""
    return {c: F.count_if(F.col(c) > 0) for c in FLAGS} | {c: F.sum(c) for c in PAIR_COUNTS}


def document_counts(parsed: DataFrame, structured: DataFrame, matches: DataFrame, batch: str | None = None) -> DataFrame:
    """One row per document id in any of the three tables, with its row counts in each.

    One shuffle on the document id, aggregated before it; the pairs are never joined to the
    documents. Structured rows and pairs without an id belong to no document. ``matches`` may be a counted table.
    """

    def flag(condition: Column) -> Column:
        return F.coalesce(condition.cast("long"), F.lit(0))

    one = F.lit(1).cast("long")
    groups = [F.col(batch).alias("batch_id")] if batch else []
    documents = parsed.select(
        "doc_id",
        *groups,
        one.alias("parsed_rows"),
        flag(F.col("unreadable_flag")).alias("unreadable"),
        flag(F.col("parse_error_status").isNotNull()).alias("errors"),
    )
    extracted = structured.where(F.col("doc_id").isNotNull()).select(
        "doc_id",
        one.alias("structured_rows"),
        flag(F.col("missing_dob")).alias("no_dob"),
        flag(F.col("missing_ssn4")).alias("no_ssn4"),
    )
    match_class, n = F.col("match_class"), pair_number(matches)
    scored = matches.where(F.col("doc_id").isNotNull()).select(
        "doc_id",
        n.alias("match_rows"),
        (n * flag(match_class.isNotNull())).alias("classed"),
        (n * flag(match_class == "match")).alias("match"),
        (n * flag(match_class == "possible_match")).alias("possible_match"),
        (n * flag(match_class == "non_match")).alias("non_match"),
    )
    rows = documents.unionByName(extracted, allowMissingColumns=True).unionByName(scored, allowMissingColumns=True)
    keys = {"doc_id", "batch_id"}
    sums = [F.coalesce(F.sum(c), F.lit(0)).alias(c) for c in rows.columns if c not in keys]
    stamps = [F.max("batch_id").alias("batch_id")] if batch else []
    return rows.groupBy("doc_id").agg(*stamps, *sums)


def _per_document(parsed: DataFrame, structured: DataFrame, matches: DataFrame, batch: str | None) -> DataFrame:
    """:func:`document_counts` of the documents that the parse table has."""
    return document_counts(parsed, structured, matches, batch).where(F.col("parsed_rows") > 0)


def _metrics(per_doc: DataFrame, batch: str | None, docs: Column, figures: dict[str, Column]) -> DataFrame:
    grouped = per_doc.groupBy("batch_id") if batch else per_doc.groupBy()
    sums = {"docs": docs, **figures}
    totals = grouped.agg(*[c.alias("t_" + name) for name, c in sums.items()])
    return percentages(totals, "t_", ["batch_id"] if batch else [])


def percentages(totals: DataFrame, prefix: str = "", keys: Sequence[str] = ()) -> DataFrame:
    """The metrics from rows of totals over documents."""
    t = lambda name: F.col(prefix + name)
    return totals.select(
        *keys,
        t("docs").alias("total_docs"),
        percent(t("unreadable"), t("docs")).alias("pct_unreadable"),
        percent(t("no_dob"), t("docs")).alias("pct_missing_dob"),
        percent(t("no_ssn4"), t("docs")).alias("pct_missing_ssn4"),
        t("errors").alias("parse_errors"),
        percent(t("match"), t("classed")).alias("pct_match"),
        percent(t("possible_match"), t("classed")).alias("pct_possible_match"),
        percent(t("non_match"), t("classed")).alias("pct_non_match"),
    )


def dq_metrics(
    parsed: DataFrame, structured: DataFrame, matches: DataFrame, batch: str | None = None, since: Column | None = None
) -> DataFrame:
    """Metrics per document: each document counts once. With ``batch`` one row per value of that parsed column.

    ``since`` leaves out what earlier runs took in; the filter on the run stamp reaches the scans of all three tables.
    """
    if since is not None:
        parsed, structured, matches = (df.where(F.col("pipeline_run_ts") >= since) for df in (parsed, structured, matches))
    per_doc = _per_document(parsed, structured, matches, batch)
    return _metrics(per_doc, batch, F.count("doc_id"), document_figures())


def dq_metrics_pairweighted(parsed: DataFrame, structured: DataFrame, matches: DataFrame, batch: str | None = None) -> DataFrame:
    """Metrics over parsed left-joined to structured and to match pairs, where a document with k
    pairs counts k times.

    The joined rows are not produced: a document contributes the product of its row counts.
    """
    per_doc = _per_document(parsed, structured, matches, batch)
    parsed_rows = F.col("parsed_rows")
    by_structured = F.greatest(F.col("structured_rows"), F.lit(1))
    by_match = F.greatest(F.col("match_rows"), F.lit(1))
    figures = {
        "unreadable": F.sum(F.col("unreadable") * by_structured * by_match),
        "no_dob": F.sum(parsed_rows * F.col("no_dob") * by_match),
        "no_ssn4": F.sum(parsed_rows * F.col("no_ssn4") * by_match),
        "errors": F.sum(F.col("errors") * by_structured * by_match),
    }
    pairs = {c: F.sum(parsed_rows * by_structured * F.col(c)) for c in PAIR_COUNTS}
    return _metrics(per_doc, batch, F.count("doc_id"), figures | pairs)


def dq_gate(metrics: DataFrame, limits: QualityLimits = PRODUCTION_LIMITS) -> DataFrame:
    """(metric, value, limit, breached, status); a metric without data neither passes nor breaches."""
    entries = []
    for name in ("pct_unreadable", "pct_missing_dob", "pct_missing_ssn4"):
        value, limit = F.col(name), F.lit(getattr(limits, name))
        status = F.when(value.isNull(), "NO_DATA").when(value > limit, "BREACH").otherwise("PASS")
        entries.append(
            F.struct(
                F.lit(name).alias("metric"),
                value.alias("value"),
                limit.alias("limit"),
                (value > limit).alias("breached"),
                status.alias("status"),
            )
        )
    return metrics.select(F.inline(F.array(*entries)))


def _threshold_rows(figures: DataFrame, *rows: Column) -> DataFrame:
    return figures.select(F.inline(F.array(*rows)))


def _row(name: str, value: Column, threshold: str, ok: Column | None) -> Column:
    status = F.lit("INFO") if ok is None else F.when(ok, "PASS").otherwise("FAIL")
    return F.struct(
        F.lit(name).alias("check_name"),
        value.cast("double").alias("value"),
        F.lit(threshold).alias("threshold"),
        status.alias("status"),
    )


def _share_row(name: str, part: str, whole: str, limit: float) -> Column:
    # The status compares the unrounded share: 100 * part < limit * whole.
    n, d = F.col(part), F.col(whole)
    below = (d > 0) & (n * 100 < d * limit)
    return _row(name, percent(n, d), f"< {limit:g}%", below)


def dq_threshold_report(parsed: DataFrame, structured: DataFrame, limits: QualityLimits = DEMO_LIMITS) -> DataFrame:
    """Five check rows, one aggregate per table."""
    rows = F.count(F.lit(1))
    docs = parsed.agg(rows.alias("docs"), F.count_if("unreadable_flag").alias("unreadable"))
    extracted = structured.agg(rows.alias("rows"), F.count_if("missing_dob").alias("no_dob"), F.count_if("missing_ssn4").alias("no_ssn4"))
    from_docs = _threshold_rows(
        docs,
        _share_row("Pct Unreadable", "unreadable", "docs", limits.pct_unreadable),
        _row("Total Docs Parsed", F.col("docs"), "n/a", None),
    )
    from_extracted = _threshold_rows(
        extracted,
        _share_row("Pct Missing DOB", "no_dob", "rows", limits.pct_missing_dob),
        _share_row("Pct Missing SSN4", "no_ssn4", "rows", limits.pct_missing_ssn4),
        _row("Total Structured", F.col("rows"), "n/a", None),
    )
    return from_docs.unionAll(from_extracted)


def dq_threshold_report_readable(curated: DataFrame, limits: QualityLimits = QualityLimits(15.0, 20.0, 25.0), confidence: float = 0.7) -> DataFrame:
    """Older four-row form over one table with ``extracted_dob``, ``extracted_ssn4`` and ``parse_confidence``."""
    ok = ~F.col("unreadable_flag")
    no_ssn4 = F.col("extracted_ssn4").isNull() | (F.col("extracted_ssn4") == "")
    figures = curated.agg(
        F.count(F.lit(1)).alias("docs"),
        F.count_if("unreadable_flag").alias("unreadable"),
        F.count_if(ok).alias("readable"),
        F.count_if(ok & F.col("extracted_dob").isNull()).alias("no_dob"),
        F.count_if(ok & no_ssn4).alias("no_ssn4"),
        F.avg(F.when(ok, F.col("parse_confidence"))).alias("confidence"),
    )
    return _threshold_rows(
        figures,
        _share_row("Pct Unreadable", "unreadable", "docs", limits.pct_unreadable),
        _share_row("Pct Missing DOB", "no_dob", "readable", limits.pct_missing_dob),
        _share_row("Pct Missing SSN4", "no_ssn4", "readable", limits.pct_missing_ssn4),
        _row("Avg Parse Confidence", round_half_up(F.col("confidence"), 3), f"> {confidence:g}", F.col("confidence") > confidence),
    )


def recent_runs(log: DataFrame, n: int = 20) -> DataFrame:
    """The latest ``n`` rows of a run log or metrics log; rows of one stamp by their other columns, so that ties are fixed."""
    rest = [F.col(c) for c in log.columns if c != "run_ts"]
    return log.orderBy(F.desc("run_ts"), *rest).limit(n)


def latest_run(log: DataFrame) -> DataFrame:
    return recent_runs(log, 1)
