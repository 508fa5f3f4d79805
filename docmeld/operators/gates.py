"""Steps after a run: validate, measure, gate, refresh the views; each stops the ones after it."""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable, Mapping

from pyspark.errors import PySparkException
from pyspark.sql import DataFrame, SparkSession, functions as F

from docmeld.config import PRODUCTION_LIMITS, QualityLimits
from docmeld.operators.metrics import dq_gate, dq_metrics
from docmeld.operators.validation import ValidationFailed, assert_valid, validation_report
from docmeld.sources.logs import LogTable, RunLog


class QualityBreach(Exception):
    """One or more quality metrics are above their limits."""


def refresh_views(spark: SparkSession, views: Mapping[str, Callable[[], DataFrame]]) -> dict[str, str]:
    """Register each view anew; one that cannot be built is skipped and the others go on."""
    outcome = {}
    for name, build in views.items():
        try:
            build().createOrReplaceTempView(name)
            outcome[name] = "REFRESHED"
        except PySparkException as problem:
            outcome[name] = f"SKIPPED: {problem.getCondition() or type(problem).__name__}"
    return outcome


def assert_within_limits(gate: DataFrame) -> None:
    """Raise one exception that names every breached metric."""
    breaches = [f"{r['metric']}={r['value']}% > {r['limit']}%" for r in gate.where("breached").collect()]
    if breaches:
        raise QualityBreach(", ".join(breaches))


def run_gates(
    tables: Mapping[str, DataFrame],
    results: LogTable,
    log: RunLog,
    views: Mapping[str, Callable[[], DataFrame]],
    limits: QualityLimits = PRODUCTION_LIMITS,
    run_ts: dt.datetime | None = None,
) -> dict[str, str]:
    """Validation, metrics row, gate, views; the run log gets the outcome and a failure is raised on."""
    run_ts = run_ts or dt.datetime.now()
    try:
        assert_valid(validation_report(tables))
    except ValidationFailed:
        log.record("VALIDATION_FAILED", run_ts)
        raise
    # One row: the log may hold later runs and others with this time stamp, so the gate takes this very row.
    metrics = dq_metrics(tables["parsed"], tables["structured"], tables["member_matches"])
    metrics = log.spark.createDataFrame(metrics.collect(), metrics.schema)
    results.append(metrics.withColumns({"batch_id": F.lit(run_ts), "run_ts": F.lit(run_ts)}))
    try:
        assert_within_limits(dq_gate(metrics, limits))
    except QualityBreach:
        log.record("DQ_BREACH", run_ts)
        raise
    outcome = refresh_views(log.spark, views)
    log.record("SUCCESS", run_ts)
    return outcome
