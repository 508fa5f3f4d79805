"""Licence texts by a positional index of rare words, by DataFrame operations only.

A template is a run of words with a mandatory key phrase in it. The corpus says how rare the templates' words are.
A file can only have the templates all of whose key words it has; of these it looks up the rarest words, as many as give each
such template ``POSTINGS`` of its own. Where a word stands, less its place in the template, is where the template would start;
the starts by its looked-up words are intersected, the key phrase is verified word for word at what is left, and the rare-word
weight of the template's words that stand at their aligned places is its score.
"""

from __future__ import annotations

import math
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from docmeld.functions.once import with_once

#: Words: runs of digits, a-z and characters above 127, after lower-casing.
WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]++"
#: Share of a template's rare-word weight that has to stand in place.
LEAST_SHARE = 0.6
#: Words of a key phrase that are looked up, the rarest ones; all of it if it has no more.
POSTINGS = 2
# Characters whose lower case would be an ASCII letter or end in one; another letter above 127 stands in for them.
_STAND_IN = {"K": "ê", "İ": "ê"}


@dataclass(frozen=True)
class Template:
    label: str
    words: tuple[str, ...]
    #: where the key phrase starts and how many words it has
    key_at: int
    key_size: int
    base: bool = False

    @property
    def key(self) -> tuple[str, ...]:
        return self.words[self.key_at : self.key_at + self.key_size]


def looked_up(t: Template, idf: dict[str, float]) -> list[int]:
    """Places in the template of the rarest words of its key phrase, each word once."""
    places = [t.words.index(w, t.key_at) for w in dict.fromkeys(t.key)]
    return sorted(places, key=lambda j: (-idf[t.words[j]], j))[:POSTINGS]


def template(label: str, text: str, key: str, base: bool = False) -> Template:
    words, phrase = tuple(text.split()), tuple(key.split())
    at = next(i for i in range(len(words)) if words[i : i + len(phrase)] == phrase)
    return Template(label, words, at, len(phrase), base)


# The phrases that have to be found, and well-known licence lines.
TEMPLATES = (
    template("cc-by", "cc by", "cc by", True),
    template("gpl", "general public license", "general public license", True),
    template("reserved", "all rights reserved", "all rights reserved", True),
    template("apache-2.0", "licensed under the apache license version 2 0", "apache license"),
    template("bsd", "redistribution and use in source and binary forms with or without modification are permitted", "redistribution and use in source and binary forms"),
    template("cc-by-nc", "licensed under cc by nc 4 0", "cc by nc"),
    template("cc-by-nd", "licensed under cc by nd 4 0", "cc by nd"),
    template("cc-by-sa", "licensed under cc by sa 4 0", "cc by sa"),
    template("cc0", "released under the cc0 1 0 universal public domain dedication", "cc0 1 0"),
    template("epl", "made available under the terms of the eclipse public license", "eclipse public license"),
    template("gpl-3.0", "licensed under the gnu general public license version 3", "gnu general public license"),
    template("isc", "permission to use copy modify and or distribute this software for any purpose", "permission to use copy modify"),
    template("lgpl", "licensed under the gnu lesser general public license", "lesser general public license"),
    template("mit", "released under the mit license", "mit license"),
    template("mit", "permission is hereby granted free of charge to any person obtaining a copy of this software", "permission is hereby granted free of charge"),
    template("mpl-2.0", "subject to the terms of the mozilla public license v 2 0", "mozilla public license"),
    # bare names, with the version where there are several
    *(template(label, name, name) for label, name in (
        ("apache-2.0", "apache license version 2 0"), ("apache-2.0", "apache license 2 0"), ("apache-2.0", "apache license v2 0"), ("bsd", "bsd license"),
        ("cc-by-nc", "cc by nc"), ("cc-by-nd", "cc by nd"), ("cc-by-sa", "cc by sa"), ("cc0", "cc0"), ("epl", "eclipse public license"),
        ("gpl-3.0", "general public license version 3"), ("gpl-3.0", "general public license v3"), ("isc", "isc license"), ("lgpl", "lesser general public license"),
        ("mit", "mit license"), ("mpl-2.0", "mozilla public license version 2 0"), ("mpl-2.0", "mozilla public license v 2 0"),
        ("mpl-2.0", "mozilla public license 2 0"), ("mpl-2.0", "mozilla public license v2 0"),
    )),
    template("unlicense", "this is free and unencumbered software released into the public domain", "free and unencumbered software"),
)


def _words(text: Column) -> Column:
    text = F.coalesce(text, F.lit(""))
    for odd, other in _STAND_IN.items():
        text = F.replace(text, F.lit(odd), F.lit(other))
    return F.regexp_extract_all(F.lower(text), F.lit(WORD), F.lit(0))


def rarity(docs: DataFrame, text: str = "text", templates: tuple[Template, ...] = TEMPLATES) -> dict[str, float]:
    """Inverse document frequency of each template word over all rows; as many numbers as the templates have words."""
    vocabulary = sorted({w for t in templates for w in t.words})
    present = F.array_intersect(_words(F.col(text)), F.array(*map(F.lit, vocabulary)))
    # an extra null word counts the documents in the same pass
    found = docs.select(F.explode(F.concat(present, F.array(F.lit(None).cast("string")))).alias("w")).groupBy("w").count()
    counts = {r["w"]: r["count"] for r in found.collect()}
    n = counts.get(None, 0)
    return {w: math.log((n + 1) / (counts.get(w, 0) + 1)) + 1e-6 for w in vocabulary}


def scan(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", templates: tuple[Template, ...] = TEMPLATES) -> DataFrame:
    """Rows (doc_id, n_words, places, found, score), one for each row of ``docs``.

    ``places``: array of (label, at) of the base templates' key phrases, ``found``: array of (label, at, share) of all
    others whose share of rare-word weight is at least ``LEAST_SHARE``; ``at`` counts words from 0, where the template
    would start. ``score`` is the largest share, 1 for a base phrase and 0 without any. A null text is empty. Rows that
    repeat an id are scanned each; of equally rare words the first of the key phrase is looked up.
    """
    idf = rarity(docs, text, templates)
    rarest = {t: looked_up(t, idf) for t in templates}
    rows = with_once(docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("_text")), "words", _words(F.col("_text"))).drop("_text")
    words = F.col("words")
    key_words = sorted({w for t in templates for w in t.key})
    rows = with_once(rows, "present", F.array_intersect(words, F.array(*map(F.lit, key_words))))
    # templates with the same words to look up are asked for together
    needs: dict[tuple[str, ...], set[tuple[str, ...]]] = {}
    for t in templates:
        needs.setdefault(tuple(sorted(t.words[j] for j in rarest[t])), set()).add(tuple(sorted(set(t.key))))
    wanted = []
    for asked, keys in sorted(needs.items()):
        possible = [F.size(F.array_except(F.array(*map(F.lit, key)), F.col("present"))) == 0 for key in sorted(keys)]
        wanted.append(F.when(_any(possible), F.array(*map(F.lit, asked))).otherwise(F.array().cast("array<string>")))
    nothing = F.array().cast("array<string>")
    rows = with_once(rows, "wanted", F.when(F.size("present") > 0, F.array_distinct(F.concat(*wanted))).otherwise(nothing))
    at = F.filter(F.sequence(F.lit(0), F.size(words) - 1), lambda i: F.array_contains("wanted", F.get(words, i)))
    rows = with_once(rows, "hits", F.when(F.size("wanted") > 0, at).otherwise(F.array().cast("array<int>")))

    def by_word(word: str, j: int) -> Column:
        return F.transform(F.filter("hits", lambda i: F.get(words, i) == word), lambda i: i - j)

    def aligned(t: Template) -> Column:
        """Starts of the template on which its looked-up words agree and where its key phrase stands word for word."""
        starts = reduce(F.array_intersect, [by_word(t.words[j], j) for j in rarest[t]])
        rest = [k for k in range(t.key_at, t.key_at + t.key_size) if k not in rarest[t]]
        met = lambda s: F.coalesce(_all([F.get(words, s + k) == t.words[k] for k in rest]), F.lit(False))
        return F.filter(starts, met) if rest else starts

    def share(t: Template, start: Column) -> Column:
        weight = sum(idf[w] for w in t.words)
        parts = [F.when(F.get(words, start + k) == w, idf[w] / weight).otherwise(0.0) for k, w in enumerate(t.words)]
        return F.round(sum(parts[1:], parts[0]), 9)

    def placed(t: Template) -> Column:
        return F.transform(aligned(t), lambda s: F.struct(F.lit(t.label).alias("label"), (s + t.key_at).alias("at")))

    def scored(t: Template) -> Column:
        starts = F.transform(aligned(t), lambda s: F.struct(F.lit(t.label).alias("label"), s.alias("at"), share(t, s).alias("share")))
        return F.filter(starts, lambda x: x["share"] >= LEAST_SHARE)

    base, more = [placed(t) for t in templates if t.base], [scored(t) for t in templates if not t.base]
    none = F.size("hits") == 0
    rows = with_once(rows, "places", F.when(none, F.array().cast("array<struct<label:string,at:int>>")).otherwise(F.concat(*base)))
    rows = with_once(rows, "found", F.when(none, F.array().cast("array<struct<label:string,at:int,share:double>>")).otherwise(F.concat(*more)))
    best = F.coalesce(F.array_max(F.transform("found", lambda x: x["share"])), F.lit(0.0))
    return rows.select(
        "doc_id", F.size("words").cast("long").alias("n_words"), "places", "found",
        F.when(F.size("places") > 0, 1.0).otherwise(F.least(best, F.lit(1.0))).alias("score"),
    )


def _all(conditions: list[Column]) -> Column:
    return reduce(lambda a, b: a & b, conditions)


def _any(conditions: list[Column]) -> Column:
    return reduce(lambda a, b: a | b, conditions)
