"""From files to typed identifiers: parse, assemble text, extract, structure."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, functions as F

from docmeld.config import MIN_TEXT_LENGTH
from docmeld.functions.once import with_once

Parser = Callable[[Column], Column]
Extractor = Callable[[Column], Column]

# The identifiers pulled out of a document and the label each has on a form.
FIELD_LABELS = {
    "first_name": "First name",
    "last_name": "Last name",
    "dob": "DOB",
    "ssn4": "SSN4",
    "member_id_on_form": "Member",
    "auth_id": "Auth",
    "provider_name": "Provider",
}
FIELDS_DDL = ", ".join(f"{name}: string" for name in FIELD_LABELS)


def plain_text_parser(content: Column) -> Column:
    """Parser for text files, as VARIANT: one element per line, form feeds part the pages.

    Stands where an OCR service would be called; any column function with the same output fits.
    """
    text = F.try_validate_utf8(content.cast("string"))
    element = lambda line: F.struct(F.nullif(line, F.lit("")).alias("content"))
    return F.to_variant_object(
        F.struct(
            F.struct(
                F.transform(F.split(text, "[\n\f]"), element).alias("elements"),
                F.regexp_count(text, F.lit("\f")).__add__(1).alias("page_count"),
            ).alias("document"),
            F.when(text.isNull(), "UNDECODABLE").alias("error_status"),
        )
    )


def assemble_text(parsed: Column) -> Column:
    """Contents of the parser's elements in order, parted by a blank line; elements without text are skipped."""
    elements = F.try_variant_get(parsed, "$.document.elements", "array<variant>")
    return F.array_join(F.transform(elements, lambda e: F.try_variant_get(e, "$.content", "string")), "\n\n")


def is_unreadable(error: Column, text: Column) -> Column:
    return error.isNotNull() | text.isNull() | (F.length(text) < MIN_TEXT_LENGTH)


def parse_documents(files: DataFrame, parser: Parser = plain_text_parser, arrived: Column | None = None) -> DataFrame:
    """Parse table of a file listing (``path``, ``content``); the bytes are dropped.

    ``arrived`` fixes the arrival time, by default now; the run stamp is its hour.
    """
    arrived = F.current_timestamp() if arrived is None else arrived
    variant = F.col("parsed")
    return (
        files.withColumns({"doc_id": F.md5("path"), "ingest_ts": arrived, "parsed": parser(F.col("content"))})
        .select(
            "path",
            "doc_id",
            "ingest_ts",
            F.date_trunc("hour", "ingest_ts").alias("pipeline_run_ts"),
            F.coalesce(assemble_text(variant), F.lit("")).alias("raw_text"),
            F.try_variant_get(variant, "$.error_status", "string").alias("parse_error_status"),
            F.try_variant_get(variant, "$.document.page_count", "int").alias("page_count"),
        )
        .withColumn("unreadable_flag", is_unreadable(F.col("parse_error_status"), F.col("raw_text")))
    )


def readable(parsed: DataFrame) -> DataFrame:
    return parsed.where(~F.col("unreadable_flag"))


def labelled_lines(text: Column) -> Column:
    """The ``Label: value`` lines of the known labels as a short text, found in one pass over the whole one."""
    labels = "|".join(FIELD_LABELS.values())
    return F.concat_ws("\n", F.regexp_extract_all(text, F.lit(rf"(?md)^(?:{labels}): [^\n]+"), F.lit(0)))


def labelled_field(lines: Column, label: str) -> Column:
    """Value of the first line with that label, NULL without one."""
    return F.nullif(F.regexp_extract(lines, rf"(?md)^{label}: ([^\n]+)", 1), F.lit(""))


def labelled_fields(lines: Column) -> Column:
    return F.struct(*[labelled_field(lines, label).alias(name) for name, label in FIELD_LABELS.items()])


def json_fields(reply: Column) -> Column:
    """Fields from a model's JSON reply ``{"result": {...}}``; a malformed reply gives NULL fields."""
    return F.from_json(reply, f"result struct<{FIELDS_DDL}>")["result"]


def extract_fields(docs: DataFrame, extractor: Extractor | None = None) -> DataFrame:
    """Add struct ``fields`` with the seven identifiers as text.

    ``extractor`` maps the text column to a JSON reply (a Pandas UDF around a model, say);
    without one the labelled lines of the form are read.
    """
    if extractor is not None:
        replies = docs.withColumn("reply", extractor(F.col("raw_text")))
        return with_once(replies, "fields", json_fields(F.col("reply"))).drop("reply")
    lines = with_once(docs, "lines", labelled_lines(F.col("raw_text")))
    return with_once(lines, "fields", labelled_fields(F.col("lines"))).drop("lines")


def structure_documents(parsed: DataFrame, extractor: Extractor | None = None) -> DataFrame:
    """Typed identifiers of the readable documents, with their missing flags."""
    return typed_fields(extract_fields(readable(parsed), extractor))


def typed_fields(extracted: DataFrame) -> DataFrame:
    """Identifiers of documents whose ``fields`` are extracted.

    A date that does not parse becomes NULL but is not "missing"; an empty SSN4 is.
    """
    field = lambda name: F.col("fields")[name]
    return extracted.select(
        "doc_id",
        "path",
        "ingest_ts",
        "pipeline_run_ts",
        "page_count",
        field("first_name").alias("first_name"),
        field("last_name").alias("last_name"),
        F.try_to_date(field("dob"), "yyyy-MM-dd").alias("dob"),
        field("ssn4").alias("ssn4"),
        field("member_id_on_form").alias("member_id_on_form"),
        field("auth_id").alias("auth_id"),
        field("provider_name").alias("provider_name"),
        field("dob").isNull().alias("missing_dob"),
        (field("ssn4").isNull() | (field("ssn4") == "")).alias("missing_ssn4"),
    )
