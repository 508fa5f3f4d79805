"""Named queries over a folder of test tables."""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from docmeld.config import DEMO_LIMITS, MAX_FILES_PER_TRIGGER, PRODUCTION_LIMITS
from docmeld.functions.numeric import round_half_up
from docmeld.functions.similarity import jaro, jaro_winkler, register_functions
from docmeld.operators import documents as docs
from docmeld.operators import estimation, metrics, repeats, reports, scoring, states, validation
from docmeld.operators.expectations import expectations_report, table_expectations
from docmeld.operators.scoring import EVENT_DAY, EVENT_MONTH
from docmeld.operators.gates import QualityBreach, refresh_views, run_gates
from docmeld.plans.derived import DerivedTables
from docmeld.sources.discovery import FileDiscovery
from docmeld.sources.files import binary_file_stream
from docmeld.sources.logs import DQ_RESULTS_SCHEMA, LogTable, RunLog
from docmeld.sources.publish import payload, publish, recent_events, recent_since
from docmeld.sources.tables import scan
from docmeld.streaming.pipeline import Pipeline
from docmeld.workspace import set_modified

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}

# Fixed points in time, for repeatable results.
TODAY = dt.date(2025, 1, 1)
PUBLISH_AS_OF = "2001-06-01 10:30:00"


Build = Callable[[DerivedTables], DataFrame]


def query(build: Build, name: str | None = None) -> Build:
    """Register a function of the derived tables, under its own name if no other is given."""
    QUERIES[name or build.__name__] = lambda spark, sf_dir: build(DerivedTables(spark, sf_dir))
    return build


def _as_text(df: DataFrame, *columns: str) -> DataFrame:
    return df.withColumns({c: F.col(c).cast("string") for c in columns})


# Documents


def _files(t: DerivedTables) -> DataFrame:
    return scan(t.spark, t.sf_dir, "documents").select(
        F.concat(F.lit("/notes/"), "doc_id", F.lit(".tif")).alias("path"), F.encode("text", "UTF-8").alias("content")
    )


@query
def parse_documents(t: DerivedTables) -> DataFrame:
    arrived = F.lit("2025-01-01 10:20:30").cast("timestamp_ntz")
    parsed = docs.parse_documents(_files(t), arrived=arrived)
    return parsed.select(
        "path", "doc_id", "page_count", "parse_error_status", "unreadable_flag",
        F.col("pipeline_run_ts").cast("timestamp_ntz").alias("pipeline_run_ts"),
        F.length("raw_text").alias("n_chars"), F.md5("raw_text").alias("text_md5"),
    )


@query
def assemble_text(t: DerivedTables) -> DataFrame:
    text = docs.assemble_text(docs.plain_text_parser(F.col("content")))
    return _files(t).withColumn("raw_text", text).select("path", F.md5("raw_text").alias("text_md5"))


@query
def unreadable_flag(t: DerivedTables) -> DataFrame:
    return t.parsed.select("doc_id", "unreadable_flag")


@query
def readable_documents(t: DerivedTables) -> DataFrame:
    return docs.readable(t.texts).select("doc_id", F.md5("raw_text").alias("text_md5"))


@query
def extract_fields(t: DerivedTables) -> DataFrame:
    return docs.extract_fields(docs.readable(t.texts)).select("doc_id", "fields.*")


@query
def extract_fields_json(t: DerivedTables) -> DataFrame:
    """The fields by way of an extractor that replies in JSON, as a model would."""
    reply = lambda text: F.to_json(F.struct(docs.labelled_fields(docs.labelled_lines(text)).alias("result")))
    return docs.extract_fields(docs.readable(t.texts), reply).select("doc_id", "fields.*")


@query
def structure_documents(t: DerivedTables) -> DataFrame:
    return _as_text(t.structured_unchecked, "dob")


@query
def expect_drop(t: DerivedTables) -> DataFrame:
    return _as_text(t.structured, "dob")


# Matching


@query
def enrich_auth(t: DerivedTables) -> DataFrame:
    return _as_text(t.auth_with_member, "dob")


@query
def candidate_pairs_member(t: DerivedTables) -> DataFrame:
    return t.member_candidate_ids


@query
def candidate_pairs_auth(t: DerivedTables) -> DataFrame:
    return t.auth_candidates.select(F.col("l_doc_id").alias("doc_id"), F.col("r_auth_id").alias("auth_id"))


def _business_pairs(t: DerivedTables, similarity: Callable[[str, str], Column]) -> DataFrame:
    """Buyer and supplier name of every order line."""
    buyers = scan(t.spark, t.sf_dir, "orders").join(
        scan(t.spark, t.sf_dir, "customer"), F.col("c_custkey") == F.col("o_custkey")
    )
    return (
        scan(t.spark, t.sf_dir, "lineitem")
        .join(buyers, F.col("o_orderkey") == F.col("l_orderkey"))
        .join(scan(t.spark, t.sf_dir, "supplier"), F.col("s_suppkey") == F.col("l_suppkey"))
        .select("l_orderkey", "l_linenumber", "c_name", "s_name", similarity("c_name", "s_name").alias("sim"))
    )


query(lambda t: _business_pairs(t, jaro), "jaro")
query(lambda t: _business_pairs(t, jaro_winkler), "jaro_winkler")


@query
def jw_sim_sql(t: DerivedTables) -> DataFrame:
    """The similarity as a function of SQL."""
    register_functions(t.spark)
    names = _business_pairs(t, lambda x, y: F.lit(None)).drop("sim")
    return t.spark.sql("SELECT *, jw_sim(c_name, s_name) AS sim FROM {names}", names=names)


@query
def pair_features_member(t: DerivedTables) -> DataFrame:
    return t.all_member_pairs


@query
def pair_features_auth(t: DerivedTables) -> DataFrame:
    return t.auth_pairs


@query
def fs_score(t: DerivedTables) -> DataFrame:
    return t.all_member_matches.select(
        "doc_id", "member_id", "w_ssn4", "w_dob", "w_first", "w_last", "total_weight"
    )


@query
def fs_classify(t: DerivedTables) -> DataFrame:
    return t.auth_matches.select("doc_id", "auth_id", "total_weight", "match_class")


@query
def match_events(t: DerivedTables) -> DataFrame:
    return t.all_match_events


@query
def fs_parameters(t: DerivedTables) -> DataFrame:
    return scoring.fs_parameter_report(t.parameters)


@query
def fs_agreement_patterns(t: DerivedTables) -> DataFrame:
    patterns = estimation.agreement_patterns(t.structured, t.member)
    return patterns.select("present", "agree", F.col("pairs").cast("long").alias("pairs"))


@query
def fs_parameters_estimated(t: DerivedTables) -> DataFrame:
    report = scoring.fs_parameter_report(estimation.estimate_parameters(t.structured, t.member))
    return report.withColumns({c: round_half_up(F.col(c), 6) for c in ("m_probability", "u_probability")})


# Quality


def _expectations(t: DerivedTables) -> DataFrame:
    """Violations of every rule in tables that no rule was applied to."""
    t.keep_auth_pairs()
    tables = {"parsed": t.parsed, "structured": t.structured_unchecked, **t.faulty_lanes()}
    report = None
    for name, rules in table_expectations(F.lit(TODAY), text="text_length").items():
        rows = expectations_report(tables[name], rules, name, "pairs" if "pairs" in tables[name].columns else None)
        report = rows if report is None else report.unionAll(rows)
    return report


query(_expectations, "expectations_report")


@query
def table_counts(t: DerivedTables) -> DataFrame:
    return validation.table_counts(t.counted_mapping())


@query
def duplicate_doc_ids(t: DerivedTables) -> DataFrame:
    """Documents with several candidate pairs."""
    return validation.duplicate_doc_ids(t.member_match_counts)


@query
def repeated_documents(t: DerivedTables) -> DataFrame:
    """Documents that a second intake delivers again, in a table where all others occur once."""
    again = t.parsed.where(F.col("path").like("%7.%"))
    return repeats.repeated_ids(t.parsed.select("doc_id").unionAll(again.select("doc_id")))


@query
def orphan_structured(t: DerivedTables) -> DataFrame:
    """Structured documents of all intakes that the parse table of one intake does not have."""
    return validation.orphans(t.structured, t.parsed.where(F.col("path").startswith("/notes/")))


@query
def missing_structured(t: DerivedTables) -> DataFrame:
    return validation.missing_structured(t.parsed, t.structured)


@query
def validation_report(t: DerivedTables) -> DataFrame:
    return validation.validation_report(t.counted_mapping())


@query
def dq_metrics(t: DerivedTables) -> DataFrame:
    return metrics.dq_metrics(t.parsed, t.structured, t.member_match_counts)


@query
def dq_metrics_kept(t: DerivedTables) -> DataFrame:
    """The same metrics from three runs, each read alone; a tenth of the documents comes again in a later run, pairs come one run late."""
    running = states.RunningMetrics(t.spark, t.workspace.path("running"))
    run = F.pmod(F.xxhash64("doc_id"), F.lit(30)).cast("int")
    parsed = t.parsed.withColumn("run", F.explode(F.when(run < 3, F.array(F.lit(0), F.lit(2))).otherwise(F.array(run % 3))))
    for k in (0, 1, 1, 2):
        matches = t.member_match_counts.where((run % 3 == k - 1) | ((k == 2) & (run % 3 == 2)))
        running.add(parsed.where(F.col("run") == k), t.structured.where(run % 3 == k), matches, k)
        if k == 0:
            running.documents.merge()
    return running.metrics()


@query
def dq_metrics_pairweighted(t: DerivedTables) -> DataFrame:
    return metrics.dq_metrics_pairweighted(t.parsed, t.structured, t.member_match_counts)


@query
def dq_gate(t: DerivedTables) -> DataFrame:
    return metrics.dq_gate(dq_metrics(t), PRODUCTION_LIMITS)


@query
def dq_threshold_report(t: DerivedTables) -> DataFrame:
    return metrics.dq_threshold_report(t.parsed, t.structured)


@query
def dq_threshold_report_readable(t: DerivedTables) -> DataFrame:
    return metrics.dq_threshold_report_readable(t.curated)


def _metrics_log(t: DerivedTables) -> DataFrame:
    """A metrics log with one row per month of intake."""
    stamped = t.parsed.withColumn("month", F.date_trunc("month", "pipeline_run_ts").cast("timestamp_ntz"))
    rows = metrics.dq_metrics(stamped, t.structured, t.member_match_counts, batch="month")
    log = LogTable(t.spark, t.workspace.path("dq_run_results"), DQ_RESULTS_SCHEMA)
    log.append(rows.withColumn("run_ts", F.col("batch_id")))
    stamps = {c: F.col(c).cast("timestamp_ntz") for c in ("batch_id", "run_ts")}
    return log.read().withColumns(stamps)


@query
def recent_runs(t: DerivedTables) -> DataFrame:
    return metrics.recent_runs(_metrics_log(t), 20)


@query
def latest_dq_run(t: DerivedTables) -> DataFrame:
    return metrics.latest_run(_metrics_log(t))


@query
def run_log_append(t: DerivedTables) -> DataFrame:
    """Gate runs against the production and the demo limits; the log keeps all outcomes.

    The third run is stamped before the second, the fourth has the stamp of the first.
    """
    results = LogTable(t.spark, t.workspace.path("dq_run_results"), DQ_RESULTS_SCHEMA)
    log = RunLog(t.spark, t.workspace.path("pipeline_run_log"))
    tables = t.counted_mapping()
    for hour, limits in ((2, PRODUCTION_LIMITS), (4, DEMO_LIMITS), (3, PRODUCTION_LIMITS), (2, DEMO_LIMITS)):
        try:
            run_gates(tables, results, log, {}, limits, dt.datetime(2025, 1, 1, hour))
        except QualityBreach:
            pass  # recorded in the log
    own = (F.col("run_by") == F.current_user()).alias("by_this_user")
    return log.read().select(F.col("run_ts").cast("timestamp_ntz").alias("run_ts"), "status", own)


@query
def run_history(t: DerivedTables) -> DataFrame:
    """The latest 19 rows of a run log that has two rows per month of intake, of one stamp: a repeated run that failed."""
    log = RunLog(t.spark, t.workspace.path("pipeline_run_log"))
    status = F.when(F.col("pct_missing_dob") > DEMO_LIMITS.pct_missing_dob, "DQ_BREACH").otherwise("SUCCESS")
    months, by = _metrics_log(t), F.lit("history").alias("run_by")
    for outcome in (status, F.when(F.month("run_ts") % 2 == 1, "VALIDATION_FAILED").otherwise("ABORTED")):
        log.append(months.select("run_ts", outcome.alias("status"), by))
    return metrics.recent_runs(log.read(), 19).withColumn("run_ts", F.col("run_ts").cast("timestamp_ntz"))


# Streaming


def _pipeline(t: DerivedTables) -> Pipeline:
    """The flow as streams over a written parse table."""
    schema = t.texts.schema
    t.workspace.store(t.texts, "arriving")
    arriving = t.spark.readStream.schema(schema).option("maxFilesPerTrigger", MAX_FILES_PER_TRIGGER)
    return Pipeline(
        t.spark,
        t.workspace.path("pipeline"),
        lambda: arriving.parquet(t.workspace.path("arriving")),
        t.member,
        t.auth,
        scored_ts=F.col("pipeline_run_ts"),
    )


def _pages_in_two_runs(t: DerivedTables, stream_of: Callable[[str], DataFrame]) -> DataFrame:
    """Pages in files of 20, taken in by a file stream in two runs.

    Half of the files arrive before the second run with time stamps a month older than the first ones have.
    """
    folder, landed = t.workspace.path("pages"), t.workspace.path("landed")
    lot = F.expr("page_id div 20")
    pages = scan(t.spark, t.sf_dir, "pages").select(lot.alias("lot"), "page_id", F.col("html").alias("value"))
    pages = pages.withColumn("half", F.col("lot") % 2).repartition("lot").sortWithinPartitions("lot", "page_id")
    month_ago = int((dt.datetime.now() - dt.timedelta(days=30)).timestamp() * 1000)
    for half in (0, 1):
        part = f"{folder}/half={half}"
        pages.where(F.col("half") == half).select("lot", "value").write.partitionBy("lot").text(part)
        if half:
            set_modified(t.spark, part, month_ago)
        stream = stream_of(folder)
        lot = F.regexp_extract("path", "lot=([0-9]+)", 1).cast("long")
        arrived = stream.select(lot.alias("lot"), "length", F.md5("content").alias("content_md5"))
        run = arrived.writeStream.format("parquet").option("checkpointLocation", t.workspace.path("pages_checkpoint"))
        run.trigger(availableNow=True).start(landed).awaitTermination()
    return t.spark.read.schema(arrived.schema).parquet(landed)


@query
def src_binary_stream(t: DerivedTables) -> DataFrame:
    """Files that the file source finds."""
    return _pages_in_two_runs(t, lambda folder: binary_file_stream(t.spark, folder, glob="*.{txt,TXT}", max_files=1000, recursive=True))


@query
def src_listed_files(t: DerivedTables) -> DataFrame:
    """Files that tasks list, less those in the table of files taken before."""
    state = t.workspace.path("listed")
    return _pages_in_two_runs(t, lambda folder: FileDiscovery(t.spark, folder, state, glob="*.{txt,TXT}", max_files=1000).arriving())


@query
def stream_structured(t: DerivedTables) -> DataFrame:
    """Two incremental runs: the second finds nothing new."""
    pipeline = _pipeline(t)
    pipeline.run(tables=("structured",))
    pipeline.run(tables=("structured",))
    return _as_text(pipeline.table("structured"), "dob")


@query
def stream_full_refresh(t: DerivedTables) -> DataFrame:
    """An incremental run, then everything once more from the start."""
    pipeline = _pipeline(t)
    pipeline.run(tables=("structured",))
    pipeline.run("full", tables=("structured",))
    return _as_text(pipeline.table("structured"), "dob")


def _stream_table(t: DerivedTables, name: str) -> DataFrame:
    pipeline = _pipeline(t)
    pipeline.run(tables=(name,))
    return pipeline.table(name).drop(EVENT_DAY, EVENT_MONTH)


@query
def stream_member_matches(t: DerivedTables) -> DataFrame:
    return _stream_table(t, "member_matches")


@query
def stream_auth_matches(t: DerivedTables) -> DataFrame:
    return _stream_table(t, "auth_matches")


@query
def stream_match_events(t: DerivedTables) -> DataFrame:
    return _stream_table(t, "match_events")


# Publishing


@query
def publish_payload(t: DerivedTables) -> DataFrame:
    """Every column of the events by way of the JSON text."""
    as_of = F.lit(PUBLISH_AS_OF).cast("timestamp_ntz")
    events = t.match_events_since(recent_since(as_of), for_review=True)
    return payload(recent_events(events, as_of)).select("key", F.from_json("value", events.schema).alias("v")).select("key", "v.*")


@query
def publish_status(t: DerivedTables) -> DataFrame:
    """Publish to a file sink; the number of events sent comes from the write itself."""
    as_of = F.lit(PUBLISH_AS_OF).cast("timestamp_ntz")
    sent = publish(t.match_events_since(recent_since(as_of), for_review=True), {"path": t.workspace.path("published")}, as_of, sink="json")
    received = t.spark.read.schema("key string, value string").json(t.workspace.path("published"))
    return received.agg(F.count(F.lit(1)).alias("received")).select(
        F.lit(sent.status).alias("status"), F.lit(sent.events).cast("long").alias("events"), "received"
    )


# Reports


@query
def match_distribution(t: DerivedTables) -> DataFrame:
    return reports.match_distribution(t.member_match_sums)


@query
def score_histogram(t: DerivedTables) -> DataFrame:
    return reports.score_histogram(t.member_match_sums)


@query
def event_volume(t: DerivedTables) -> DataFrame:
    return reports.event_volume(t.event_counts)


@query
def doc_types(t: DerivedTables) -> DataFrame:
    return reports.group_counts(t.intake, "document_type")


@query
def intake_channels(t: DerivedTables) -> DataFrame:
    return reports.group_counts(t.intake, "source_channel")


@query
def auth_status_share(t: DerivedTables) -> DataFrame:
    return reports.share_of_total(t.auth, "status")


@query
def risk_tiers(t: DerivedTables) -> DataFrame:
    return reports.risk_tiers(reports.doc_risk(t.parsed, t.member_match_counts))


# The report views of the dashboard.
VIEWS: dict[str, Build] = {
    "v_pipeline_kpis": lambda t: reports.pipeline_kpis(t.member, t.auth, t.curated, t.member_match_counts),
    "v_dq_metrics": lambda t: reports.dq_overview(t.curated),
    "v_doc_match_status": lambda t: reports.doc_match_status(t.parsed, t.best_member_matches),
    "v_match_summary": lambda t: reports.match_summary(t.member_match_sums),
    "v_score_distribution": lambda t: reports.score_histogram(t.member_match_sums),
    "v_auth_match_summary": lambda t: reports.auth_match_summary(t.auth_matches),
    "v_intake_summary": lambda t: reports.intake_summary(t.intake),
    "v_batch_metrics": lambda t: _as_text(reports.batch_metrics(t.parsed), "batch_date"),
    "v_batch_extraction_metrics": lambda t: _as_text(
        reports.batch_extraction_metrics(t.parsed, t.structured), "batch_date"
    ),
    "v_batch_match_metrics": lambda t: _as_text(reports.batch_match_metrics(t.member_match_sums), "batch_date"),
}


def _checksum(df: DataFrame, name: str) -> DataFrame:
    """(table, rows, checksum): hashes of the rows as text, added up; numbers with six decimals."""
    values = [
        F.coalesce(F.col(c).cast("decimal(28,6)" if kind == "double" else "string").cast("string"), F.lit("-"))
        for c, kind in sorted(df.dtypes)
    ]
    part = F.conv(F.substring(F.md5(F.concat_ws("|", *values)), 1, 8), 16, 10).cast("long")
    return df.agg(F.count(F.lit(1)).alias("rows"), F.sum(part).alias("checksum")).select(F.lit(name).alias("table"), "rows", "checksum")


def _refreshed_views(t: DerivedTables) -> DataFrame:
    """Register all report views over stored sums and pairs; rows and a checksum of all values that each one shows."""
    t.keep_auth_pairs()
    outcome = refresh_views(t.spark, {name: lambda view=view: view(t) for name, view in VIEWS.items()})
    sums = [_checksum(t.spark.table(n), n) for n, state in outcome.items() if state == "REFRESHED"]
    return reduce(DataFrame.unionAll, sums)


def _three_runs(t: DerivedTables) -> states.StateTable:
    """State of the member matches after three runs, each with the documents of some hours; the second ran twice."""
    state = states.StateTable(t.spark, t.workspace.path("match_state"), states.summed_match_measures())
    for run in (0, 1, 1, 2):
        state.add(t.member_match_sums.where(F.col("run") == run), run)
        if run == 0:
            state.merge()
    return state


# The same views, kept by batch.
KEPT_VIEWS: dict[str, Build] = {
    "v_match_summary": lambda t: states.match_summary(_three_runs(t)),
    "v_score_distribution": lambda t: states.score_histogram(_three_runs(t)),
    "v_batch_match_metrics": lambda t: _as_text(states.batch_match_metrics(_three_runs(t)), "batch_date"),
}

query(_refreshed_views, "refresh_views")
for _name, _view in KEPT_VIEWS.items():
    query(_view, _name + "_kept")
for _name, _view in VIEWS.items():
    query(_view, _name)
