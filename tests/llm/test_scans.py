"""Personal data and licences against plain versions."""

import hashlib
import math
import random
import re
from collections import Counter

import numpy as np
import pytest
from helpers import LONG, frame, odd_rows, rows_of, lower
from pyspark.sql import functions as F

from docmeld.llm import licenses, pii

PLAIN = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def luhn(digits):
    return sum(int(c) if i % 2 == 0 else sum(divmod(2 * int(c), 10)) for i, c in enumerate(reversed(digits))) % 10 == 0


def valid(kind, m):
    digits = re.sub("[^0-9]", "", m)
    if kind == "ip":
        return all(int(p) <= 255 for p in m.split("."))
    if kind == "card":
        return 14 <= len(digits) <= 19 and luhn(digits)
    return kind == "email" or 10 <= len(digits) <= 15


def plain_spans(text):
    found = [(m.start(), k, m.end()) for k, p in enumerate(PLAIN.values()) for m in re.finditer(p, text or "") if valid(list(PLAIN)[k], m[0])]
    return [(k, s, e) for s, k, e in sorted(found)]


TRICKY = [
    "a.b@c.de", "x@y", "@a.b", "a@b@c.d.e", "a@b.co%x@d.com", "é😀 jo+hn@ex-am.ple.org, and more", "a@b..c", "..@a.b.", "1.2.3.4", "1.2.3.4.5.6.7.8.9", "256.1.1.1",
    "001.002.003.004", "12.34.56", "1.2.3.4@5.6.7.8", "4111 1111 1111 1111", "4111-1111-1111-1111.", "4111 1111  1111 1111", "41111111111111112", "0000 0000 0000 00",
    "+1 (415) 555-0134", "+1 (415) 555-0134 +44 20 7946 0958", "+123", "+1234567890123456", "++49 30 901820 12", "1" * 30, "1 " * 5000, "9" * 20000, "x" * 30000 + "@a.b",
    "mail me: a@b.cd " * 700, "😀" * 50 + "+1 212 555 0100" + "😀", "10.0.0.1 " * 600, "", None, LONG,
]


def test_base_spans_are_those_of_the_patterns(spark):
    rows = list(enumerate(TRICKY)) + odd_rows() + [(3, "again a@b.cd")]
    found = rows_of(pii.find(frame(spark, rows, extra=True)))
    got = Counter((r["doc_id"], tuple(tuple(x) for x in r["base"])) for r in found)
    assert got == Counter((i, tuple(plain_spans(t))) for i, t, *_ in rows)
    for r in found:
        assert set(map(tuple, r["base"])) <= set(map(tuple, r["spans"]))


def test_no_documents(spark):
    assert pii.find(frame(spark, [])).count() == 0 and pii.redact(frame(spark, [])).count() == 0
    assert licenses.scan(frame(spark, [])).count() == 0


def test_what_looks_like_base_spans_is_added(spark):
    rows = [(i, f"please call +1 ({200 + i}) 555-{1000 + i:04d}, thanks") for i in range(200)]
    rows += [(1000 + i, f"order {i} of {i * 7} items") for i in range(200)]
    rows += [(5000, "please call (212) 555-0100, thanks"), (5001, "nothing in here")]
    found = {r["doc_id"]: r for r in rows_of(pii.find(frame(spark, rows)))}
    assert [tuple(x) for x in found[5000]["spans"]] == [(3, 12, 26)] and found[5000]["base"] == []
    assert found[5001]["spans"] == [] and all(not found[1000 + i]["spans"] for i in range(200))


def test_unconfirmed_personal_data_is_no_error(spark):
    """Half of the phones lack the plus and half of the addresses spell the at."""
    rows = [(i, f"please call {'+1 ' if i % 2 else ''}({200 + i}) 555-{1000 + i:04d}, thanks") for i in range(200)]
    rows += [(1000 + i, f"please write to person{i}{' [at] ' if i % 2 else '@'}example.org. Thanks") for i in range(200)]
    rows += [(2000 + i, f"table {1700 + i} {1800 + i} {1900 + i} {100000 + i} ends (at) noon") for i in range(200)]
    found = {r["doc_id"]: r for r in rows_of(pii.find(frame(spark, rows)))}
    for i, text in rows:
        spans = [text[x["s"] : x["e"]] for x in found[i]["spans"] if not found[i]["base"]]
        if i < 200 and not i % 2:
            assert spans == [f"({200 + i}) 555-{1000 + i:04d}"]
        if 1000 <= i < 2000 and i % 2:
            assert spans == [f"person{i - 1000} [at] example.org"]
        assert i < 2000 or not [x for x in found[i]["spans"] if x["kind"] in (0, 3)]


def test_threshold_is_calibrated_on_the_other_half():
    cells = [(3, 1, 0, True, 90), (3, 1, 0, False, 1), (3, 1, 1, True, 10), (3, 1, 1, False, 30), (3, 2, 0, True, 50), (3, 2, 1, True, 50), (3, 4, 0, False, 70), (3, 4, 1, False, 70)]
    assert pii.chosen_bits(cells) == {3: [2]}
    assert pii.chosen_bits([]) == {}


def test_unlabelled_are_corrected_by_the_chance_to_be_confirmed():
    """Half of what is personal data is confirmed; a pattern that is confirmed far less often than that is not chosen."""
    cells = [(3, b, half, c, n) for b, yes, no in ((9, 100, 100), (16, 5, 95), (2, 0, 80)) for half in (0, 1) for c, n in ((True, yes), (False, no))]
    assert pii.chosen_bits(cells) == {3: [9]}
    assert pii.chosen_bits([(4, 9, 0, True, 50), (4, 9, 1, False, 50)]) == {4: []}
    # a pattern that only half 1 has scores as nothing was learnt of it, so it takes its own confirmed ones
    seen = [(4, 9, half, True, 80) for half in (0, 1)] + [(4, 2, half, False, 80) for half in (0, 1)]
    assert pii.chosen_bits([*seen, (4, 278, 1, False, 3)]) == {4: [9]}
    assert pii.chosen_bits([*seen, (4, 278, 1, True, 3)]) == {4: [9, 278]}


def plain_boosting(cells):
    """Boosting over single proposals: a tree of two levels at a time, each leaf one Newton step with a penalty of 1."""
    x = np.array([[b >> i & 1 for i in range(12)] for b, (yes, no) in cells.items() for _ in range(yes + no)])
    y = np.array([float(i < yes) for yes, no in cells.values() for i in range(yes + no)])
    f = np.zeros(len(y))
    for _ in range(40):
        p = 1 / (1 + np.exp(-f))

        def worth(rows, p=p):
            return (y - p)[rows].sum() ** 2 / ((p * (1 - p))[rows].sum() + 1) if rows.any() else 0.0

        def halves(rows, worth=worth):
            options = [(rows & (x[:, i] == 1), rows & (x[:, i] == 0)) for i in range(12)]
            values = np.array([worth(a) + worth(b) for a, b in options])
            return options[int(np.argmax(values >= values.max() - 1e-9))]

        leaves = [leaf for half in halves(np.ones(len(y), bool)) for leaf in halves(half) if leaf.any()]
        for leaf in leaves:
            f[leaf] += 0.3 * (y - p)[leaf].sum() / ((p * (1 - p))[leaf].sum() + 1)
    rows = np.cumsum([0] + [yes + no for yes, no in cells.values()])[:-1]
    return {b: f[i] for b, i in zip(cells, rows)}


def test_boosting_against_single_proposals():
    rng = np.random.default_rng(5)
    for _ in range(4):
        cells = {int(b): (int(rng.integers(0, 40)), int(rng.integers(1, 60))) for b in rng.choice(4096, 25, replace=False)}
        got, want = pii._boosted(cells), plain_boosting(cells)
        assert got == pytest.approx(want, abs=1e-6)


def test_secrets_and_ids_by_two_generators(spark):
    """What form and name agree on teaches the trees the form; values of that form are found without a name, others are not."""
    digest = lambda i: hashlib.sha1(str(i).encode()).hexdigest()
    rows = [(i, f'set token = "{digest(i)}" and go on') for i in range(60)]
    rows += [(100 + i, f"the ssn {200 + i}-{10 + i % 80}-{3000 + i} of {i} people") for i in range(60)]
    rows += [(200 + i, f"a secret: {'what' * (2 + i % 3)} about Donaudampfschifffahrtsgesellschaft{'en' * (i % 2)} and its account of {i}") for i in range(60)]
    rows += [(900, f'it reads "{digest(900)}" here'), (901, "call it 219-09-9999 then"), (902, "no secret in the passport office of 1999")]
    found = {r["doc_id"]: r for r in rows_of(pii.find(frame(spark, rows)))}
    spans = {i: [(pii.KINDS[x["kind"]], t[x["s"] : x["e"]]) for x in found[i]["spans"]] for i, t in rows}
    for i in range(60):
        assert spans[i] == [("secret", digest(i))] and spans[200 + i] == []
        assert spans[100 + i] == [("id", f"{200 + i}-{10 + i % 80}-{3000 + i}")]
    assert spans[900] == [("secret", digest(900))] and spans[901] == [("id", "219-09-9999")] and spans[902] == []
    assert all(not r["base"] for r in found.values())


def test_redaction(spark):
    texts = {1: "mail a@b.cd or +1 (415) 555-0134.", 2: "😀 10.0.0.1", 3: None, 4: "clean"}
    out = {r["doc_id"]: r["redacted"] for r in rows_of(pii.redact(frame(spark, list(texts.items()))))}
    assert out == {1: "mail [email] or [phone].", 2: "😀 [ip]", 3: "", 4: "clean"}


def test_main_path_has_no_python(spark):
    for df in (pii.find(frame(spark, odd_rows())), licenses.scan(frame(spark, odd_rows()))):
        assert not re.search("Python|Arrow|Pandas", df._jdf.queryExecution().executedPlan().toString())


PHRASES = {("cc", "by"): "cc-by", ("general", "public", "license"): "gpl", ("all", "rights", "reserved"): "reserved"}
LICENCES = [
    "CC BY", "cc-by-nc 4.0 cc by", "CC\nBY, and cc by!", "accby cc bye", "General Public License General  public LICENSE", "all rights reserved. All Rights Reserved",
    "rights reserved all", "Licensed under the Apache License, Version 2.0.", "Released under the MIT License.", "The Apache license", "cCéby cc by", "license " * 3000 + "cc by",
    "ALL RIGHTS RESERVED " * 400, "all rİghts reserved", "allKrights", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software", "", None, LONG,
]


def plain_scan(text):
    words = re.findall("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+", lower(text))
    places = [(label, i) for p, label in PHRASES.items() for i in range(len(words)) if tuple(words[i : i + len(p)]) == p]
    return len(words), Counter(places)


def test_base_phrases(spark):
    rows = list(enumerate(LICENCES)) + odd_rows()
    got = Counter()
    for r in rows_of(licenses.scan(frame(spark, rows, extra=True))):
        got[r["doc_id"], r["n_words"], frozenset(Counter(tuple(x) for x in r["places"]).items())] += 1
        assert 0 <= r["score"] <= 1 and (not r["places"] or r["score"] == 1)
    assert got == Counter((i, n, frozenset(c.items())) for i, t, *_ in rows for n, c in [plain_scan(t)])


def plain_templates(texts, text):
    """(label, start, share) of each template but the base ones, by trying every start."""
    split = lambda x: re.findall("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+", lower(x))
    sets = [set(split(x)) for x in texts]
    idf = lambda w: math.log((len(sets) + 1) / (sum(w in s for s in sets) + 1)) + 1e-6
    words, found = split(text), Counter()
    for t in licenses.TEMPLATES:
        weight = sum(idf(w) for w in t.words)
        for start in range(-len(t.words), len(words)):
            there = [0 <= start + k < len(words) and words[start + k] == w for k, w in enumerate(t.words)]
            share = round(sum(idf(w) for w, ok in zip(t.words, there, strict=True) if ok) / weight, 9)
            if not t.base and all(there[t.key_at : t.key_at + t.key_size]) and share >= 0.6 - 1e-12:
                found[t.label, start, share] += 1
    return found


def test_templates_by_the_index_are_those_of_every_start(spark):
    """Texts of template words with words left out, doubled and swapped, so that postings meet in wrong places too."""
    rng = random.Random(5)
    texts = []
    for _ in range(120):
        words = []
        for t in rng.choices(licenses.TEMPLATES, k=3):
            part = list(t.words[rng.choice([0, 0, t.key_at]) :])
            if rng.random() < 0.4:
                part.insert(rng.randrange(len(part) + 1), rng.choice(part))
            if rng.random() < 0.3:
                part.pop(rng.randrange(len(part)))
            words += [*part, *rng.choices(["the", "of", "license", "prose", "and"], k=rng.randrange(3))]
        texts.append(" ".join(words))
    texts += ["and use and " * 50 + "redistribution and use in source and binary forms", "2 0 license apache version", "cc0", ""]
    got = {r["doc_id"]: Counter((x["label"], x["at"], round(x["share"], 9)) for x in r["found"]) for r in rows_of(licenses.scan(frame(spark, list(enumerate(texts)))))}
    expected = {i: plain_templates(texts, x) for i, x in enumerate(texts)}
    close = lambda c: sorted((label, at, round(share, 7)) for label, at, share in c.elements())
    assert {i: close(c) for i, c in got.items()} == {i: close(c) for i, c in expected.items()}
    assert sum(map(len, expected.values())) > 150


def test_rarest_words_are_looked_up():
    t = licenses.template("x", "a common rare rare words", "common rare rare words")
    assert licenses.looked_up(t, {"a": 9.0, "common": 1.0, "rare": 5.0, "words": 2.0}) == [2, 4]
    assert licenses.looked_up(t, {"a": 9.0, "common": 1.0, "rare": 1.0, "words": 1.0}) == [1, 2]


@pytest.mark.parametrize(
    ("text", "labels"),
    [
        (LICENCES[7], {"apache-2.0"}), (LICENCES[8], {"mit"}), (LICENCES[15], {"mit"}), ("This work is licensed under the GNU General Public License, version 3.", {"gpl-3.0"}),
        ("Licensed under CC BY-NC 4.0.", {"cc-by-nc"}), ("the mit building is old", set()), ("apache helicopters need no license", set()),
    ],
)
def test_template_labels(spark, text, labels):
    rows = [(i, "some other prose without any of it") for i in range(40)] + [(99, "before it " + text + " and after")]
    found = {r["doc_id"]: r for r in rows_of(licenses.scan(frame(spark, rows)))}
    assert {x["label"] for x in found[99]["found"]} == labels
    assert all(not found[i]["found"] and found[i]["score"] == 0 for i in range(40))


def test_bare_names_are_labels(spark):
    """A name is found whatever the corpus says of how rare its words are."""
    names = {"MIT License": "mit", "Eclipse Public License": "epl", "CC BY-SA": "cc-by-sa", "Apache License 2.0": "apache-2.0", "Mozilla Public License, v2.0": "mpl-2.0"}
    rows = [(i, f"see the {name}, and more") for i, name in enumerate(names)]
    for more in ([], [(100 + i, "a license of the public") for i in range(60)], [(100 + i, " ".join(names).lower()) for i in range(60)]):
        found = {r["doc_id"]: r for r in rows_of(licenses.scan(frame(spark, rows + more)))}
        assert [{x["label"] for x in found[i]["found"]} for i in range(len(rows))] == [{x} for x in names.values()]
    (row,) = rows_of(licenses.scan(frame(spark, [(1, "the Apache License, version 1.1")])))
    assert not row["found"]


def test_rarity_counts_documents(spark):
    rows = [(1, "license license"), (2, "the license"), (3, None)]
    idf = licenses.rarity(frame(spark, rows))
    assert idf["license"] < idf["the"] < idf["apache"]


def test_span_text_of_joined(spark):
    df = spark.range(1).select(pii.joined(F.expr("array(struct(0 as kind, 1L as s, 5L as e), struct(3 as kind, 7L as s, 9L as e))")).alias("j"))
    assert df.first().j == "email:1:5,phone:7:9"
