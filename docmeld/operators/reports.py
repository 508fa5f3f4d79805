"""Report queries: each takes stored tables and returns a small result.

Reports of member matches take the matches, or a summed table of them (``operators/summed.py``), which says in ``pairs`` how
many each row stands for.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from docmeld.functions.numeric import percent, round_half_up
from docmeld.functions.rows import side_by_side
from docmeld.operators.counted import n_pairs


def group_counts(df: DataFrame, column: str, alias: str | None = None) -> DataFrame:
    """Rows per value of one column, most frequent first."""
    name = alias or column
    return df.groupBy(F.col(column).alias(name)).agg(F.count(F.lit(1)).alias("cnt")).orderBy(F.desc("cnt"), name)


def share_of_total(df: DataFrame, column: str) -> DataFrame:
    """Rows per value and their share of all rows, whose number is a scalar subquery."""
    total = df.agg(F.count(F.lit(1))).scalar()
    return (
        df.groupBy(column)
        .agg(F.count(F.lit(1)).alias("cnt"))
        .withColumn("pct", percent(F.col("cnt"), total, 1))
        .orderBy(F.desc("cnt"), column)
    )


def _mean(df: DataFrame, column: str, total: str, digits: int) -> Column:
    """Mean over pairs; a summed table holds the totals of its groups."""
    mean = F.sum(total) / F.sum("pairs") if "pairs" in df.columns else F.avg(column)
    return round_half_up(mean, digits)


def _mean_flag(df: DataFrame, flag: str, digits: int) -> Column:
    """Share of pairs that agree among those where it is known."""
    if "pairs" not in df.columns:
        return round_half_up(F.avg(flag), digits)
    known = F.sum(F.when(F.col(flag).isNotNull(), F.col("pairs")))
    return round_half_up(F.sum(F.col(flag) * F.col("pairs")) / known, digits)


def _weights(df: DataFrame, digits: int) -> list[Column]:
    low, high = ("weight_min", "weight_max") if "pairs" in df.columns else ("total_weight", "total_weight")
    return [
        _mean(df, "total_weight", "weight_sum", digits).alias("avg_weight"),
        round_half_up(F.min(low), digits).alias("min_weight"),
        round_half_up(F.max(high), digits).alias("max_weight"),
    ]


def match_distribution(matches: DataFrame) -> DataFrame:
    return (
        matches.groupBy("match_class")
        .agg(n_pairs(matches).alias("cnt"), *_weights(matches, 2))
        .orderBy(F.desc("avg_weight"))
    )


def score_histogram(matches: DataFrame) -> DataFrame:
    """Pairs per whole-number weight bucket and class."""
    bucket = F.col("weight_bucket") if "pairs" in matches.columns else F.round("total_weight", 0)
    return (
        matches.groupBy(bucket.alias("weight_bucket"), "match_class")
        .agg(n_pairs(matches).alias("pair_count"))
        .orderBy("weight_bucket", "match_class")
    )


def event_volume(events: DataFrame) -> DataFrame:
    return (
        events.groupBy("match_class", "entity_type")
        .agg(n_pairs(events).alias("n"))
        .orderBy("entity_type", "match_class")
    )


def pipeline_kpis(members: DataFrame, auths: DataFrame, curated: DataFrame, member_matches: DataFrame) -> DataFrame:
    """Table sizes, member matches by class, mean parse confidence of the readable documents."""
    rows = F.count(F.lit(1))
    match_class = F.col("match_class")
    return side_by_side(
        members.agg(rows.alias("total_members")),
        auths.agg(rows.alias("total_authorizations")),
        curated.agg(
            rows.alias("total_documents"),
            round_half_up(F.avg(F.when(~F.col("unreadable_flag"), F.col("parse_confidence"))), 3).alias("avg_confidence"),
        ),
        member_matches.agg(
            n_pairs(member_matches, match_class == "match").alias("high_confidence_matches"),
            n_pairs(member_matches, match_class == "possible_match").alias("possible_matches"),
        ),
    )


def dq_overview(curated: DataFrame) -> DataFrame:
    """Counts and percentages per document over the table with extracted fields."""
    ok = ~F.col("unreadable_flag")
    no_ssn4 = F.col("extracted_ssn4").isNull() | (F.col("extracted_ssn4") == "")
    return curated.agg(
        F.count(F.lit(1)).alias("total_docs"),
        F.count_if("unreadable_flag").alias("unreadable_count"),
        F.count_if(ok & F.col("extracted_dob").isNull()).alias("missing_dob_count"),
        F.count_if(ok & no_ssn4).alias("missing_ssn4_count"),
        round_half_up(F.avg(F.when(ok, F.col("parse_confidence"))), 3).alias("avg_parse_confidence"),
    ).withColumns(
        {
            "pct_unreadable": percent(F.col("unreadable_count"), F.col("total_docs")),
            "pct_missing_dob": percent(F.col("missing_dob_count"), F.col("total_docs")),
            "pct_missing_ssn4": percent(F.col("missing_ssn4_count"), F.col("total_docs")),
        }
    )


def doc_match_status(parsed: DataFrame, matches: DataFrame) -> DataFrame:
    """Best pair of each document and the review tier that follows from it. ``matches`` may hold the best of each document
    already (best_weight, best_class)."""
    best = matches
    if "best_weight" not in matches.columns:
        best = matches.groupBy("doc_id").agg(
            F.max("total_weight").alias("best_weight"), F.max_by("match_class", "total_weight").alias("best_class")
        )
    return parsed.join(best, "doc_id", "left").select("doc_id", "unreadable_flag", "best_class", "best_weight", _risk_tier())


def _risk_tier() -> Column:
    tier = F.when(F.col("best_class") == "match", "LOW").when(F.col("best_class") == "possible_match", "MEDIUM")
    return tier.otherwise("HIGH").alias("doc_risk_tier")


def doc_risk(parsed: DataFrame, matches: DataFrame) -> DataFrame:
    """Review tier of each document. A class is a range of weights, so the best pair's is the highest that occurs, and
    ``matches`` may be a counted table."""
    rank = F.when(F.col("match_class") == "match", 2).when(F.col("match_class") == "possible_match", 1).otherwise(0)
    best = matches.groupBy("doc_id").agg(F.max_by("match_class", rank).alias("best_class"))
    return parsed.join(best, "doc_id", "left").select("doc_id", "best_class", _risk_tier())


def risk_tiers(status: DataFrame) -> DataFrame:
    return group_counts(status, "doc_risk_tier")


def match_summary(matches: DataFrame) -> DataFrame:
    """Per class: candidates, weights, mean agreement and similarity; unknown flags do not count in the means."""
    return matches.groupBy("match_class").agg(
        n_pairs(matches).alias("candidate_count"),
        *_weights(matches, 3),
        _mean_flag(matches, "ssn4_exact", 3).alias("avg_ssn4_agreement"),
        _mean_flag(matches, "dob_exact", 3).alias("avg_dob_agreement"),
        _mean(matches, "first_name_sim", "first_sum", 3).alias("avg_first_name_sim"),
        _mean(matches, "last_name_sim", "last_sum", 3).alias("avg_last_name_sim"),
    )


def auth_match_summary(matches: DataFrame) -> DataFrame:
    """Per class; needs the optional flags ``auth_number_exact`` and ``provider_exact`` on the pairs."""
    return matches.groupBy("match_class").agg(
        F.count(F.lit(1)).alias("auth_candidate_count"),
        round_half_up(F.avg("total_weight"), 3).alias("avg_weight"),
        F.count_if(F.col("auth_number_exact") == 1.0).alias("direct_auth_matches"),
        F.count_if(F.col("provider_exact") == 1.0).alias("provider_npi_matches"),
    )


def intake_summary(intake: DataFrame) -> DataFrame:
    return (
        intake.groupBy("document_type", "source_channel")
        .agg(F.count(F.lit(1)).alias("cnt"))
        .orderBy("document_type", "source_channel")
    )


def _day() -> Column:
    return F.to_date("pipeline_run_ts").alias("batch_date")


def batch_metrics(parsed: DataFrame) -> DataFrame:
    return (
        parsed.groupBy(_day())
        .agg(F.count(F.lit(1)).alias("docs_parsed"), F.count_if("unreadable_flag").alias("unreadable"))
        .orderBy("batch_date")
    )


def batch_extraction_metrics(parsed: DataFrame, structured: DataFrame) -> DataFrame:
    """Per day: extracted documents, missing fields, extracted share of the readable documents."""
    one, zero = F.lit(1), F.lit(0)
    readable = parsed.where(~F.col("unreadable_flag")).select(
        _day(), one.alias("readable"), zero.alias("extracted"), zero.alias("no_dob"), zero.alias("no_ssn4")
    )
    extracted = structured.select(
        _day(), zero, one, F.col("missing_dob").cast("int"), F.col("missing_ssn4").cast("int")
    )
    return (
        readable.unionAll(extracted)
        .groupBy("batch_date")
        .agg(
            F.sum("extracted").alias("docs_extracted"),
            F.sum("no_dob").alias("missing_dob"),
            F.sum("no_ssn4").alias("missing_ssn4"),
            percent(F.sum("extracted"), F.sum("readable"), 1).alias("extraction_rate"),
        )
        .orderBy("batch_date")
    )


def batch_match_metrics(matches: DataFrame) -> DataFrame:
    day = F.col("batch_date") if "pairs" in matches.columns else _day()
    return (
        matches.groupBy(day, "match_class")
        .agg(n_pairs(matches).alias("pair_count"), _mean(matches, "total_weight", "weight_sum", 3).alias("avg_weight"))
        .orderBy("batch_date", "match_class")
    )
