"""Language mixtures and the toxicity fit against versions written from their definitions, number by number.

Constants are spelled out here, so that a change of one in the modules fails.
"""

import math
import random
from collections import Counter

import numpy as np
import pytest
from helpers import frame, rows_of
from pyspark.sql import functions as F

from docmeld.llm import language, toxicity

SOUNDS = {"xa": ["ka", "lo", "mi", "sun"], "yb": ["thr", "ing", "ous", "ble"], "zc": ["été", "eau", "çon", "oui"], "wd": ["ka", "ing", "ost", "pir"]}


def prose(rng, lang, n):
    return " ".join("".join(rng.choice(SOUNDS[lang]) for _ in range(rng.randrange(1, 4))) for _ in range(n))


def plain_grams(text):
    b = b" " + b" ".join(text.encode().lower().split()) + b" "
    return [((b[i] * 65536 + b[i + 1] * 256 + b[i + 2]) * 2654435761 % 2**32) // 65536 for i in range(len(b) - 2)]


def plain_table(rows):
    counts = {}
    for text, lang in rows:
        counts.setdefault(lang, Counter()).update(plain_grams(text))
    return {lang: (lambda g, c=c: (c[g] + 0.5) / (sum(c.values()) + 0.5 * 65536)) for lang, c in counts.items()}


def plain_em(found, model, chosen):
    """Log likelihood and shares of the languages after twelve steps from equal shares."""
    share = {k: 1 / len(chosen) for k in chosen}
    chance = {(g, k): model[k](g) for g in set(found) for k in chosen}
    for _ in range(12 if len(chosen) > 1 else 0):
        owed = dict.fromkeys(chosen, 0.0)
        for g in found:
            all_ = sum(share[k] * chance[g, k] for k in chosen)
            for k in chosen:
                owed[k] += share[k] * chance[g, k] / all_
        share = {k: v / len(found) for k, v in owed.items()}
    return math.fsum(math.log(sum(share[k] * chance[g, k] for k in chosen)) for g in found), share


def plain_mixture(text, model):
    """The set of languages by forward search: a language enters if the likelihood rises by more than its penalty."""
    found = plain_grams(text)
    _, share = plain_em(found, model, sorted(model))
    chosen = [max(sorted(model), key=lambda k: share[k])]
    best, share = plain_em(found, model, chosen)
    while len(chosen) < len(model):
        trials = {k: plain_em(found, model, [*chosen, k]) for k in sorted(model) if k not in chosen}
        k = max(trials, key=lambda k: trials[k][0])
        if trials[k][0] - best <= 1.5 * math.log(len(found)) + 0.02 * len(found):
            break
        chosen, (best, share) = [*chosen, k], trials[k]
    return share


def test_mixtures_by_definition(spark):
    rng = random.Random(11)
    train = [(i, prose(rng, lang, 60), "s", lang) for i, lang in enumerate(list(SOUNDS) * 6)]
    model = plain_table([(r[1], r[3]) for r in train])
    texts = [prose(rng, "xa", 20), prose(rng, "xa", 30) + " " + prose(rng, "zc", 20), " ".join(prose(rng, k, 15) for k in ("zc", "yb", "wd")), prose(rng, "wd", 8) + " KA\n\n  Lo", "q", "été 12 ka"]
    fitted = language.fit(frame(spark, train))
    assert fitted.languages == tuple(sorted(SOUNDS))
    for text in texts:
        for g in plain_grams(text)[:20]:
            assert fitted.table[g].tolist() == pytest.approx([model[k](g) for k in fitted.languages], rel=1e-12)
    found = {r["doc_id"]: r for r in rows_of(language.predict(frame(spark, list(enumerate(texts))), fitted))}
    sizes = set()
    for i, text in enumerate(texts):
        want, got = plain_mixture(text, model), dict(zip(found[i]["languages"], found[i]["proportions"]))
        assert got == pytest.approx(want, abs=1e-9)
        assert found[i]["score"] == pytest.approx(max(want.values()), abs=1e-9) and want[found[i]["lang_pred"]] == max(want.values())
        sizes.add(len(want))
    assert sizes >= {1, 2, 3}


def plain_words(text):
    out = "".join(c if c.isascii() and c.isalnum() or ord(c) > 127 else " " for c in text.lower())
    return set(out.split())


def plain_features(words):
    return {f for w in words for f in [("w", w)] + [(n, w[:n]) for n in (4, 5) if len(w) > n]}


def plain_fit(rows, epochs=30, penalty=10.0, ridge=1e-4):
    """Weights of (text, label) rows: full gradients, each weight with its own speed; swaps of identity words are pulled together."""
    lines = {w: [x for x in line if x != w] for line in toxicity.GROUPS for w in line}
    texts = [plain_features(plain_words(t)) for t, _ in rows]
    toxic = [y for _, y in rows]
    swaps = []
    for t, _ in rows:
        own = plain_words(t)
        named = [w for w in own if w in lines]
        come = [lines[w][0] for w in named if lines[w][0] not in own]
        swaps.append((plain_features(named), plain_features(come)))
    swaps += [(plain_features([a]), plain_features([b])) for a, others in lines.items() for b in others]
    n1, n0 = sum(toxic), len(toxic) - sum(toxic)
    tells = set()
    for f in set().union(*texts):
        h1, h0 = sum(f in t for t, y in zip(texts, toxic) if y), sum(f in t for t, y in zip(texts, toxic) if not y)
        pooled = (h1 + h0 + 0.5) / (n1 + n0 + 1)
        if abs((h1 + 0.5) / (n1 + 1) - (h0 + 0.5) / (n0 + 1)) > 4.5 * math.sqrt(pooled * (1 - pooled) * (1 / n1 + 1 / n0)):
            tells.add(f)
    w, speed, bias, bias_speed = dict.fromkeys(tells, 0.0), dict.fromkeys(tells, 1e-8), 0.0, 1e-8
    for _ in range(epochs):
        slope, bias_slope = {f: ridge * w[f] for f in tells}, 0.0
        for t, y in zip(texts, toxic):
            error = (1 / (1 + math.exp(-(bias + sum(w[f] for f in t & tells)))) - y) * (0.25 / n1 if y else 0.75 / n0)
            bias_slope += error
            for f in t & tells:
                slope[f] += error
        for gone, come in swaps:
            change = sum(w[f] for f in gone & tells) - sum(w[f] for f in come & tells)
            for side, sign in ((gone, 1), (come, -1)):
                for f in side & tells:
                    slope[f] += penalty / len(swaps) * sign * change
        for f in tells:
            speed[f] += slope[f] ** 2
            w[f] -= 0.1 * slope[f] / math.sqrt(speed[f])
        bias_speed += bias_slope**2
        bias -= 0.1 * bias_slope / math.sqrt(bias_speed)
    return w, bias


def test_toxicity_fit_by_definition(spark):
    """Identity words go with toxic texts here, so the penalty matters; without it the scores are others."""
    rng = random.Random(4)
    filler = ["river", "stone", "Garden", "night", "été", "market"]
    rows = []
    for i in range(160):
        toxic = i % 2
        words = rng.choices(filler, k=6) + (["horrible", "scum"] if toxic and rng.random() < 0.9 else []) + (["women"] if rng.random() < (0.9 if toxic else 0.05) else ["men"])
        rows.append((" ".join(words), toxic))
    rows += [("muslims and jews " + t, y) for t, y in rows[:20]]
    docs = frame(spark, [(i, t) for i, (t, _) in enumerate(rows)] + [(900, "men stone"), (901, "women stone"), (902, "scum"), (903, ""), (904, None)])
    labels = spark.createDataFrame([(i, 1, y) for i, (_, y) in enumerate(rows)], "doc_id long, quality int, toxic int")
    for penalty in (10.0, 0.0):
        model = toxicity.fit(docs, labels, F.lit(True), penalty=penalty)
        w, bias = plain_fit(rows, penalty=penalty)
        got = {r["doc_id"]: r["score"] for r in rows_of(toxicity.score(docs, model))}
        texts = dict(enumerate(t for t, _ in rows)) | {900: "men stone", 901: "women stone", 902: "scum", 903: "", 904: ""}
        want = {i: 1 / (1 + math.exp(-(bias + sum(w.get(f, 0.0) for f in plain_features(plain_words(t)))))) for i, t in texts.items()}
        assert got == pytest.approx(want, abs=1e-9)
        assert np.count_nonzero(model.weights) == len(w) > 3
        gaps = abs(want[901] - want[900])
        assert gaps < 0.1 if penalty else gaps > 0.1
