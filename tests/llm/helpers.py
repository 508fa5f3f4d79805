import re

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"
#: columns that clash with names inside the operators
EXTRA = ("size", "rate", "target", "copies", "hits", "words", "key", "digest", "label", "salt", "kept", "range", "row", "train", "_id", "text_sha256", "component_id")
LONG = " ".join(f"w{i % 5003}x" for i in range(60_000))


def frame(spark, rows, parts=3, extra=False):
    """documents from (doc_id, text[, source[, lang]]) tuples."""
    full = [(r[0], r[1], r[3] if len(r) > 3 else "en", r[2] if len(r) > 2 else "s", len(r[1] or "")) for r in rows]
    df = spark.createDataFrame(full, SCHEMA).repartition(parts)
    for c in EXTRA if extra else ():
        df = df.selectExpr("*", f"'x' AS `{c}`")
    return df


def odd_rows():
    """Nulls, empty and blank texts, a long one, ties, repeats."""
    return [
        (1, None, None, None), (2, "", "a"), (3, " \n\t ", "b"), (4, LONG, "a"), (5, "One Two three four", "b"), (6, "one two THREE four", "b"),
        (7, "one two three four", None), (7, "one two three four", None), (None, "one two three four", "a"), (None, None, None), (8, "ÀB é ß", "ä"), (9, "x", "a"), (10, "123 456", "B"),
    ]


def words(text):
    return re.findall("[^\x20\x09-\x0d]+", lower(text))


def lower(text):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")


def rows_of(df):
    return [r.asDict() for r in df.collect()]
