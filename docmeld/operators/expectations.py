"""Row-level expectations: warn counts, drop removes, fail stops the run."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import and_
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, Observation, functions as F

from docmeld.config import MATCH_CLASSES, POSSIBLE_THRESHOLD

WARN, DROP, FAIL = "warn", "drop", "fail"


class Expectation(NamedTuple):
    name: str
    predicate: Column
    level: str = WARN

    @property
    def passes(self) -> Column:
        """A row passes only if the predicate is true; NULL does not pass."""
        return F.coalesce(self.predicate, F.lit(False))


def present(*columns: str) -> Column:
    """All of the columns are given."""
    return reduce(and_, [F.col(c).isNotNull() for c in columns])


def any_present(*columns: str) -> Column:
    return F.coalesce(*[F.col(c).cast("string") for c in columns]).isNotNull()


# The names of the rules.


def parsed_expectations(text: str = "raw_text") -> list[Expectation]:
    """``text``: the text, or another column that is NULL where the text is."""
    return [
        Expectation("doc_id_present", present("doc_id")),
        Expectation("path_present", present("path")),
        Expectation("raw_text_or_unreadable", present(text) | F.col("unreadable_flag")),
        Expectation("valid_ingest_ts", present("ingest_ts")),
    ]


def structured_expectations(today: Column | None = None) -> list[Expectation]:
    today = F.current_date() if today is None else today
    dob, ssn4 = F.col("dob"), F.col("ssn4")
    return [
        Expectation("doc_id_present", present("doc_id")),
        Expectation("has_extracted_field", any_present("first_name", "last_name", "dob")),
        Expectation("valid_dob_format", dob.isNull() | dob.between(F.to_date(F.lit("1900-01-01")), today)),
        Expectation("valid_ssn4_format", ssn4.isNull() | ((F.length(ssn4) == 4) & ssn4.rlike("^[0-9]{4}$"))),
        Expectation("no_all_nulls", any_present("first_name", "last_name", "dob", "ssn4"), DROP),
    ]


def pair_expectations(entity_id: str, suffix: str = "") -> list[Expectation]:
    sims = F.col("first_name_sim").between(0, 1) & F.col("last_name_sim").between(0, 1)
    flags = F.col("ssn4_exact").isin(0.0, 1.0) & F.col("dob_exact").isin(0.0, 1.0)
    return [
        Expectation("valid_pair", present("doc_id", entity_id), DROP),
        Expectation("valid_similarity_scores" + suffix, sims),
        Expectation("valid_exact_flags" + suffix, flags),
    ]


def match_expectations(suffix: str = "") -> list[Expectation]:
    weight, match_class = F.col("total_weight"), F.col("match_class")
    too_light = (match_class == "match") & (weight < POSSIBLE_THRESHOLD)
    return [
        Expectation("valid_weight" + suffix, present("total_weight")),
        Expectation("valid_classification" + suffix, match_class.isin(*MATCH_CLASSES)),
        Expectation("weight_class_consistent" + suffix, ~too_light, FAIL),
    ]


def table_expectations(today: Column | None = None, text: str = "raw_text") -> dict[str, list[Expectation]]:
    """The expectations of each table of the pipeline."""
    return {
        "parsed": parsed_expectations(text),
        "structured": structured_expectations(today),
        "member_pairs": pair_expectations("member_id"),
        "auth_pairs": pair_expectations("auth_id", "_auth"),
        "member_matches": match_expectations(),
        "auth_matches": match_expectations("_auth"),
    }


def apply_expectations(df: DataFrame, rules: Sequence[Expectation], name: str | Observation | None = None) -> DataFrame:
    """Enforce the rules; with a ``name`` the violations are counted before any row is dropped.

    The counts are observed metrics of the query, per micro-batch in a stream. The fail rule
    sits in a filter, where the optimizer cannot prune it.
    """
    if name is not None:
        counts = [F.count_if(~rule.passes).alias(rule.name) for rule in rules]
        df = df.observe(name, F.count(F.lit(1)).alias("total"), *counts)
    for rule in rules:
        if rule.level == DROP:
            df = df.where(rule.passes)
        elif rule.level == FAIL:
            stop = F.raise_error(F.lit(f"expectation {rule.name} violated")).cast("boolean")
            df = df.where(F.when(rule.passes, True).otherwise(stop))
    return df


def expectations_report(df: DataFrame, rules: Sequence[Expectation], table: str, rows: str | None = None) -> DataFrame:
    """Violations of each rule in one pass: (table, rule, level, violations, total).

    ``rows``: column that says how many rows one stands for, all of which break the same rules.
    """
    n = F.lit(1).cast("long") if rows is None else F.col(rows)
    none = F.lit(0).cast("long")
    entries = [
        F.struct(
            F.lit(rule.name).alias("rule"),
            F.lit(rule.level).alias("level"),
            F.coalesce(F.sum(F.when(~rule.passes, n)), none).alias("violations"),
            F.coalesce(F.sum(n), none).alias("total"),
        )
        for rule in rules
    ]
    return (
        df.agg(F.array(*entries).alias("entries"))
        .select(F.lit(table).alias("table"), F.inline("entries"))
    )
