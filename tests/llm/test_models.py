"""Languages, toxicity, lattice scores and fingerprints: plain versions, held-out accuracy, odd input."""

import hashlib
import math
import random
from collections import Counter

import numpy as np
import pytest
from helpers import LONG, frame, odd_rows, rows_of, words
from pyspark.sql import functions as F

from docmeld.llm import fingerprint, language, lattice, toxicity
from docmeld.llm.queries import PIECES, vocabulary

SOUNDS = {"xa": ["ka", "lo", "mi", "sun"], "yb": ["thr", "ing", "ous", "ble"], "zc": ["été", "eau", "çon", "oui"]}


def prose(rng, lang, n):
    return " ".join("".join(rng.choice(SOUNDS[lang]) for _ in range(rng.randrange(1, 4))) for _ in range(n))


@pytest.fixture(scope="module")
def languages():
    rng = random.Random(3)
    return [(i, prose(rng, lang, 40), "s", lang) for i in range(90) for lang in [rng.choice(list(SOUNDS))]]


def test_languages_and_mixtures(spark, languages):
    docs = frame(spark, languages, extra=True)
    model = language.fit(docs, language.training_rows())
    assert model.languages == tuple(sorted(SOUNDS))
    found = {r["doc_id"]: r for r in rows_of(language.predict(docs, model, keep=["lang"]))}
    assert all(r["lang_pred"] == r["lang"] and r["score"] > 0.9 for r in found.values())
    rng = random.Random(4)
    mixed = prose(rng, "xa", 300) + " " + prose(rng, "zc", 100)
    (row,) = rows_of(language.predict(frame(spark, [(1, mixed)]), model))
    assert row["languages"] == ["xa", "zc"] and 0.6 < row["score"] < 0.9


def plain_model(names):
    """A model of the languages ``names``, of which those with the same first two letters sound the same."""
    rng = random.Random(5)
    counts = {lang: np.bincount(language.grams(prose(rng, lang, 3_000).encode()), minlength=language.BUCKETS) for lang in SOUNDS}
    table = np.stack([(counts[x[:2]] + 0.5) / (counts[x[:2]].sum() + 0.5 * language.BUCKETS) for x in names], 1)
    return language.LanguageModel(tuple(names), table)


def test_a_language_that_does_not_pay_keeps_no_other_out():
    rng = random.Random(6)
    text = (prose(rng, "xa", 300) + " " + prose(rng, "zc", 60)).encode()
    model = plain_model(["xa", "xa2", "yb", "zc"])
    chosen, share = model.mixture(text)
    assert [model.languages[i][:2] for i in chosen] == ["xa", "zc"] and 0.1 < share[1] < 0.3


def test_documents_without_letters_or_model(spark, languages):
    model = language.fit(frame(spark, languages))
    odd = odd_rows() + [(50, "12 34 !?"), (51, "x")]
    found = rows_of(language.predict(frame(spark, odd), model))
    assert len(found) == len(odd)
    for r in found:
        texts = {t or "" for i, t, *_ in odd if i == r["doc_id"]}
        if not any(c.isalpha() for t in texts for c in t):
            assert (r["lang_pred"], r["score"], r["languages"]) == ("und", 0.0, [])
        elif "" not in texts:
            assert r["lang_pred"] in SOUNDS and 0 < r["score"] <= 1
    nothing = language.fit(frame(spark, [(1, "text", "s", None)]))
    assert {r["lang_pred"] for r in rows_of(language.predict(frame(spark, odd), nothing))} == {"und"}
    assert language.predict(frame(spark, []), language.fit(frame(spark, []))).count() == 0


def test_identified_documents_are_kept_whole(spark, languages):
    df = frame(spark, languages + [(900, "12 34"), (901, None), (902, "")], extra=True)
    out = language.keep_identified(df, language.fit(df))
    assert out.columns == df.columns
    assert sorted(r["doc_id"] for r in rows_of(out)) == sorted(i for i, *_ in languages)


def test_documents_in_three_languages_and_without_a_model_are_kept(spark, languages):
    rng = random.Random(7)
    mixed = " ".join(prose(rng, lang, n) for lang, n in (("xa", 300), ("yb", 250), ("zc", 200)))
    model = language.fit(frame(spark, languages))
    assert max(model.mixture(mixed.encode())[1]) < 0.5
    df = frame(spark, [(1, mixed), (2, "12 34"), (3, None), (4, "xa")])
    assert sorted(r["doc_id"] for r in rows_of(language.keep_identified(df, model))) == [1, 4]
    nothing = language.fit(frame(spark, [(1, "text", "s", None)]).withColumn("lang", F.lit(None).cast("string")))
    assert nothing.languages == () and sorted(r["doc_id"] for r in rows_of(language.keep_identified(df, nothing))) == [1, 4]


def toxic_rows(n, seed=1):
    rng = random.Random(seed)
    rows, labels = [], []
    for i in range(n):
        bad = rng.random() < 0.3
        ws = [f"w{rng.randrange(300)}" for _ in range(30)] + rng.choices(["men", "women", "muslim", "christian"], k=rng.randrange(2))
        if bad:
            ws += [f"vile{rng.choice('abcdefgh')}x"] + (["women"] if rng.random() < 0.5 else [])
        rng.shuffle(ws)
        rows.append((i, " ".join(ws)))
        labels.append((i, int(bad)))
    return rows, labels


def test_toxicity_on_held_out_rows(spark):
    rows, labels = toxic_rows(900)
    docs, known = frame(spark, rows, extra=True), spark.createDataFrame(labels, "doc_id long, toxic int").withColumn("quality", F.lit(0))
    model = toxicity.fit(docs, known, toxicity.training_rows())
    score = {r["doc_id"]: r["score"] for r in rows_of(toxicity.score(docs, model))}
    held = {r["doc_id"] for r in rows_of(docs.where(toxicity.fold(F.col("doc_id"), 5) == 0).select("doc_id"))}
    right = [(score[i] >= 0.5) == bool(t) for i, t in labels if i in held]
    assert len(right) > 100 and np.mean(right) > 0.97
    # naming a group changes next to nothing, though more toxic rows name one
    pairs = frame(spark, [(1, "w1 w2 w3"), (2, "w1 w2 w3 women"), (3, "w1 w2 w3 men"), (4, None), (5, ""), (5, LONG)])
    s = {(r["doc_id"]): r["score"] for r in rows_of(toxicity.score(pairs, model))}
    assert abs(s[2] - s[3]) < 0.05 and s[2] < 0.5 and all(0 <= x <= 1 for x in s.values())
    plain = toxicity.fit(docs, known, toxicity.training_rows(), penalty=0.0)
    gap = lambda m: abs(sum(m.weights[f] for f in toxicity.features(b"women")) - sum(m.weights[f] for f in toxicity.features(b"men")))
    assert gap(model) < 0.5 * gap(plain)


def test_toxicity_without_labels(spark):
    docs = frame(spark, odd_rows())
    for labels, expected in (([], 0.0), ([(5, 0), (6, None)], 0.0), ([(5, 1)], 1.0)):
        model = toxicity.fit(docs, spark.createDataFrame(labels, "doc_id long, toxic int"), F.lit(True))
        assert {round(r["score"], 6) for r in rows_of(toxicity.score(docs, model))} == {expected}
    assert toxicity.score(frame(spark, []), model).count() == 0


def test_sample_is_bounded(spark):
    rows, labels = toxic_rows(200)
    got = toxicity._sample(frame(spark, rows), spark.createDataFrame(labels, "doc_id long, toxic int"), 40, F.lit(True), "doc_id", "text")
    assert Counter(r["label"] for r in got) == {0: 20, 1: 20}


def test_sample_has_one_row_of_an_id_that_repeats(spark):
    rows, labels = toxic_rows(60)
    docs = frame(spark, rows + [(5, f"hot text {i % 50}") for i in range(300)])
    got = toxicity._sample(docs, spark.createDataFrame(labels, "doc_id long, toxic int"), 200, F.lit(True), "doc_id", "text")
    assert sorted(r["id"] for r in got) == list(range(60))


@pytest.fixture(scope="module")
def pieces():
    return lattice.Lattice(vocabulary(PIECES))


def test_piece_probabilities_add_up(pieces):
    assert sum(map(math.exp, pieces.log_p.values())) + 256 * math.exp(pieces.byte) == pytest.approx(1)


@pytest.mark.parametrize("word", ["a", "the", "license", "é", "日x", "zqj", "\U0001f600k"])
def test_marginal_is_the_sum_over_segmentations(pieces, word):
    def total(text):
        if not text:
            return 1.0
        ways = [math.exp(pieces.log_p[text[:k]]) * total(text[k:]) for k in range(1, len(text) + 1) if text[:k] in pieces.log_p]
        if text[0] not in pieces.log_p:
            ways.append(math.exp(pieces.byte) ** len(text[0].encode()) * total(text[1:]))
        return sum(ways)

    assert pieces.log10(word.encode()) == pytest.approx(math.log10(total("▁" + word)))


def plain_scores(rows, learned, pieces):
    counts = Counter()
    for i, t, *_ in rows:
        if learned[i]:
            counts.update([*words(t), None])
    n, v = counts.total(), len(counts)
    new = v / (n + v) if n else 1.0
    out = []
    for i, t, *_ in rows:
        tokens = [*words(t), None]
        base = sum(math.log10((counts[w] + 1) / (n + v + 1)) for w in tokens)
        below = [pieces.byte / math.log(10) if w is None else pieces.log10(w.encode()) for w in tokens]
        model = sum(math.log10((1 - new) * counts[w] / max(n, 1) + new * 10**x) if counts[w] or x > -250 else math.log10(new) + x for w, x in zip(tokens, below, strict=True))
        out.append((i, len(tokens), sum(counts[w] > 0 for w in tokens), n, base, model))
    return out


@pytest.mark.parametrize("head_words", [0, 3, 100_000])
def test_scores(spark, pieces, head_words):
    rng = random.Random(6)
    rows = odd_rows() + [(100 + i, " ".join(rng.choice(["The", "cat", "sat", "été", f"q{rng.randrange(50)}"]) for _ in range(rng.randrange(20)))) for i in range(40)]
    df = frame(spark, rows, extra=True)
    learned = {r["doc_id"]: r["t"] for r in rows_of(df.select("doc_id", lattice.training_rows().alias("t")))}
    found = rows_of(lattice.score(df, lattice.training_rows(), vocabulary(PIECES), head_words=head_words))
    got = sorted(((r["doc_id"], r["n_tokens"], r["n_known"], r["train_tokens"], r["base_score"], r["score"]) for r in found), key=str)
    for a, b in zip(got, sorted(plain_scores(rows, learned, pieces), key=str), strict=True):
        assert a[:4] == b[:4] and a[4:] == pytest.approx(b[4:], rel=1e-9)
    assert all(r["held_out"] != learned[r["doc_id"]] for r in found)


def test_scores_without_training_or_documents(spark, pieces):
    (row,) = rows_of(lattice.score(frame(spark, [(1, "a b")]), F.lit(False), vocabulary(PIECES)))
    assert (row["n_tokens"], row["n_known"], row["train_tokens"], row["base_score"]) == (3, 0, 0, 0.0)
    assert row["score"] == pytest.approx(pieces.log10(b"a") + pieces.log10(b"b") + pieces.byte / math.log(10))
    assert lattice.score(frame(spark, []), lattice.training_rows(), vocabulary(PIECES)).count() == 0


def test_a_very_long_word(spark, pieces):
    (row,) = rows_of(lattice.score(frame(spark, [(1, "x" * 20_000)]), F.lit(False), vocabulary(PIECES)))
    assert row["score"] < -4_000 and math.isfinite(row["score"])


def test_a_long_word_is_one_lattice(pieces):
    """No place in a word is a border that no piece may cross."""
    word, forward = "the" * 3_000, [0.0]
    text = "▁" + word
    for end in range(1, len(text) + 1):
        ways = [forward[at] + pieces.log_p[text[at:end]] for at in range(max(0, end - pieces.longest), end) if text[at:end] in pieces.log_p]
        forward.append(max(ways) + math.log(sum(math.exp(w - max(ways)) for w in ways)))
    assert pieces.log10(word.encode()) == pytest.approx(forward[-1] / math.log(10), rel=1e-9)


def mixed(x):
    """A bijection of 64-bit numbers, in whole numbers."""
    x = (x ^ x >> 30) * 0xBF58476D1CE4E5B9 % 2**64
    x = (x ^ x >> 27) * 0x94D049BB133111EB % 2**64
    return x ^ x >> 31


def plain_minhash(text, k=5, components=64, selected=2):
    """By definition: every numbered k-mer has a hash; a component takes the ones that follow its start on the circle of hashes,
    ties by place, and hashes them in the order of the text."""
    numbered, seen = [], Counter()
    for place in range(max(1, len(text) - k + 1)) if text else ():
        code = min(k, len(text))
        for c in text[place : place + k]:
            code = (code + ord(c)) * 0x9E3779B97F4A7C15 % 2**64
            code ^= code >> 29
        kmer = mixed(code) >> 32 << 32
        numbered.append((mixed((kmer + mixed(seen[kmer] + 1)) % 2**64) >> 32, place))
        seen[kmer] += 1
    out = []
    for component in range(components):
        start = component * 2**32 // components
        chosen = sorted(numbered, key=lambda hp: ((hp[0] - start) % 2**32, hp[1]))[: min(selected, len(numbered))]
        value = 0
        for h, _ in sorted(chosen, key=lambda hp: hp[1]):
            value = mixed((value + (h << 32) + 1) % 2**64)
        out.append(value >> 48)
    return out


def test_components_equal_those_by_definition():
    rng = random.Random(5)
    texts = ["", "a", "abcd", "abcde", "aaaaaaaaa", "\U0001f600é" * 7, "abcabcabc" * 9]
    texts += ["".join(rng.choice("abc de") for _ in range(rng.randrange(1, 400))) for _ in range(30)]
    for text in texts:
        assert fingerprint.order_minhash(text).tolist() == plain_minhash(text)
    # the definition depends on each of its parts
    assert plain_minhash(texts[-1]) != plain_minhash(texts[-1], k=4) and plain_minhash(texts[-1]) != plain_minhash(texts[-1], selected=3)


def test_fingerprints_of_edits_moves_and_lengths():
    rng = random.Random(8)
    text = " ".join(f"word{rng.randrange(5000)}" for _ in range(400))
    prints = fingerprint.order_minhash
    like = lambda a, b: fingerprint.likeness(prints(a), prints(b))
    one, ten = text[:100] + "#" + text[101:], "".join("#" if i % 100 == 7 else c for i, c in enumerate(text))
    other = " ".join(f"term{rng.randrange(5000)}" for _ in range(400))
    assert like(text, text) == 1 >= like(text, one) > like(text, ten) > like(text, other)
    # the same k-mers in another order are not the same text
    halves = text[len(text) // 2 :] + text[: len(text) // 2]
    assert like(text, halves) < 0.7
    # a k-mer hashes alike whatever the length of its text
    assert like(text, text + " and a little more") > 0.8
    for short in ("a", "ab", "abcd", "abcde", "aaaaaaaa", "\U0001f600"):
        assert like(short, short) == 1 and like(short, short + "z") < 1
    assert not prints("").any() and prints("x" * 100_000).any()


def test_repeated_kmers_are_numbered():
    prints = fingerprint.order_minhash
    assert fingerprint.likeness(prints("abcabcabc" * 3), prints("abcabcabc" * 30)) < 1


def plain_neighbours(rows):
    order = sorted(rows, key=lambda r: (r[0] is None, -(r[0] or 0), r[1] or ""))
    out = []
    for k, (i, t, *_) in enumerate(order):
        t, after = t or "", order[(k + 1) % len(order)][1] or ""
        half = len(t) // 2
        edited = t[: len(t) - half] + after[:half]
        p, e, n = (fingerprint.order_minhash(x) for x in (t, edited, after))
        out.append((i, len(t), hashlib.sha256(edited.encode()).hexdigest(), fingerprint.hexed(p), fingerprint.hexed(e), fingerprint.likeness(p, e), fingerprint.likeness(p, n)))
    return sorted(out, key=str)


@pytest.mark.parametrize("n", [1, 2, 150])
def test_next_documents(spark, n):
    rng = random.Random(n)
    rows = [(i * 13 % 1009, "".join(rng.choice("abcé😀 ") for _ in range(rng.randrange(80)))) for i in range(n)]
    rows += odd_rows() if n > 2 else []
    found = sorted((tuple(r.values()) for r in rows_of(fingerprint.neighbours(frame(spark, rows, extra=True)))), key=str)
    assert found == plain_neighbours(rows)


def test_no_neighbours(spark):
    assert fingerprint.neighbours(frame(spark, [])).count() == 0
    prints = {r["doc_id"]: r["fingerprint"] for r in rows_of(fingerprint.fingerprints(frame(spark, [(1, None), (2, ""), (3, "text"), (4, "text")])))}
    assert prints[1] == prints[2] and prints[3] == prints[4] != prints[1]
