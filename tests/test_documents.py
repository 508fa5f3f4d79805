import datetime as dt

from pyspark.sql import functions as F

from docmeld.operators import documents as docs

FORM = "First name: Ann\nLast name: Lee\nDOB: 1980-02-03\nSSN4: 0042\nAuth: AUTH-7\nMember: M1\nProvider: Clinic\nNote: none"


def parse(spark, *contents):
    files = spark.createDataFrame([(f"/in/{i}.pdf", bytearray(c)) for i, c in enumerate(contents)], "path string, content binary")
    arrived = F.lit(dt.datetime(2025, 1, 2, 10, 40))
    return docs.parse_documents(files, arrived=arrived).orderBy("path").collect()


def parsed(spark, *texts):
    rows = [(f"/in/{i}", f"d{i}", dt.datetime(2025, 1, 1), dt.datetime(2025, 1, 1), t, None, 1, False) for i, t in enumerate(texts)]
    schema = (
        "path string, doc_id string, ingest_ts timestamp, pipeline_run_ts timestamp, raw_text string, "
        "parse_error_status string, page_count int, unreadable_flag boolean"
    )
    return spark.createDataFrame(rows, schema)


def test_parse_table(spark):
    good, empty, broken = parse(spark, b"line one\n\nline two\x0c" + b"x" * 60, b"", b"\xff\xfe\xff")
    assert good.raw_text == "line one\n\nline two\n\n" + "x" * 60
    assert (good.page_count, good.unreadable_flag, good.parse_error_status) == (2, False, None)
    assert good.pipeline_run_ts == dt.datetime(2025, 1, 2, 10)
    assert empty.unreadable_flag and empty.parse_error_status is None
    assert broken.unreadable_flag and broken.parse_error_status == "UNDECODABLE" and broken.raw_text == ""
    assert "content" not in good.asDict() and "parsed" not in good.asDict()


def test_unreadable_rule(spark):
    rows = [(None, "x" * 50), (None, "x" * 49), ("CORRUPT", "x" * 80), (None, None)]
    df = spark.createDataFrame(rows, "e string, t string").select(docs.is_unreadable(F.col("e"), F.col("t")).alias("u"))
    assert [r.u for r in df.collect()] == [False, True, True, True]


def test_structured_fields(spark):
    (row,) = docs.structure_documents(parsed(spark, FORM)).collect()
    assert (row.first_name, row.last_name, row.dob, row.ssn4) == ("Ann", "Lee", dt.date(1980, 2, 3), "0042")
    assert (row.auth_id, row.member_id_on_form, row.provider_name) == ("AUTH-7", "M1", "Clinic")
    assert not row.missing_dob and not row.missing_ssn4


def test_first_line_of_a_label_wins_and_labels_start_lines(spark):
    (row,) = docs.structure_documents(parsed(spark, "see DOB: 1999-01-01\nDOB: 1980-02-03\nDOB: 1990-01-01")).collect()
    assert row.dob == dt.date(1980, 2, 3)


def test_malformed_date_is_null_but_not_missing(spark):
    malformed, absent = docs.structure_documents(parsed(spark, "DOB: 13/01/1980", "no fields at all")).collect()
    assert malformed.dob is None and malformed.missing_dob is False
    assert absent.dob is None and absent.missing_dob is True and absent.missing_ssn4 is True


def test_unreadable_documents_are_left_out(spark):
    df = parsed(spark, FORM).withColumn("unreadable_flag", F.lit(True))
    assert docs.structure_documents(df).count() == 0


def test_extractor_may_be_a_model_reply(spark):
    reply = lambda text: F.lit('{"result": {"first_name": "Bo", "dob": "1970-01-01", "ssn4": ""}}')
    (row,) = docs.structure_documents(parsed(spark, FORM), reply).collect()
    assert (row.first_name, row.dob, row.last_name) == ("Bo", dt.date(1970, 1, 1), None)
    assert row.missing_ssn4 and not row.missing_dob


def test_malformed_model_reply_gives_null_fields(spark):
    (row,) = docs.structure_documents(parsed(spark, FORM), lambda text: F.lit("not json")).collect()
    assert row.first_name is None and row.missing_dob and row.missing_ssn4


def test_long_texts_are_read_to_the_end(spark):
    (row,) = docs.structure_documents(parsed(spark, "word " * 100_000 + "\nSSN4: 1234")).collect()
    assert row.ssn4 == "1234"
