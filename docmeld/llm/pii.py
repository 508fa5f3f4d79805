"""Personal data by boosted trees over proposed spans, by DataFrame operations only.

Strict patterns give the base spans. Loose generators propose further, overlapping spans. Each proposal gets a few
format and context bits; counting proposals by their bits and by whether they are confirmed gives a small table of the
whole corpus, on which boosted trees are fitted. Confirmed is a weak label: a base span overlaps, or, for the kinds
without a base pattern, a span of the kind's other generator. The bits do not hold what confirms. A threshold per kind,
calibrated on the other half of the documents, says which bits are redacted. An unconfirmed proposal is unlabelled, not
negative, so both the trees' probabilities and the precision of the threshold are divided by the chance that personal
data is confirmed at all (``chosen_bits``).
"""

from __future__ import annotations

import math
from collections import defaultdict

from pyspark.sql import Column, DataFrame, functions as F

from docmeld.functions.once import with_once
from docmeld.llm.common import fold
from docmeld.workspace import Workspace

BASE_KINDS = ("email", "ip", "card", "phone")
KINDS = (*BASE_KINDS, "secret", "id")
# The strict patterns. Possessive repeats and the look-behinds only save the attempts that cannot match:
# a match starts where the last one ended or at the start of a run of its first characters.
EMAIL = r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++"
IP = r"(?:\G|(?<![0-9]))[0-9]++(?:\.[0-9]++){3}"
CARD = r"[0-9](?:[\x20-]?[0-9])++"
PHONE = r"\+[0-9][\x20().0-9-]+[0-9]"
# The loose ones.
ANY_AT = r"[^\s@<>()\[\],;:\x22]++(?:@|\x20?[\[(]at[\])]\x20?)[^\s@<>()\[\],;:\x22]++"
ANY_QUAD = r"(?:\G|(?<![0-9]))[0-9]++(?:\x20?[.]\x20?[0-9]++){3}"
ANY_NUMBER = r"(?:\([0-9]++\)\x20?)?[0-9](?:[\x20().-]{0,2}[0-9])++"
_AT = r"\x20?[\[(]at[\])]\x20?"
# The kinds without a base pattern have two generators: one by form, one by the name in front of the value.
_SECRET_NAMES = "token|secret|passw(?:or)?d|pwd|api[_-]?key|access[_-]?key|private[_-]?key|credential|bearer|auth"
_ID_NAMES = "ssn|social security|iban|passport|account|konto|compte|cuenta|identity|tax id"
LONG_RUN = r"(?<![A-Za-z0-9+/_=-])[A-Za-z0-9+/_=-]{20,}+"
NAMED_SECRET = rf"(?i)(?<=(?:{_SECRET_NAMES})[\x22']?\s{{0,2}}[:=]\s{{0,2}}[\x22']?)(?<=[\s\x22':=])[^\s\x22',;:=]{{6,}}+"
ID_FORM = r"(?<![A-Za-z0-9-])(?:[0-9]{3}[-\x20][0-9]{2}[-\x20][0-9]{4}|[A-Z]{2}[0-9]{2}(?:\x20?[A-Z0-9]{4}){2,7}(?:\x20?[A-Z0-9]{1,3})?)(?![A-Za-z0-9-])"
NAMED_ID = rf"(?i)(?<=\b(?:{_ID_NAMES})(?:\x20(?:no|nr|number))?[.:#]{{0,2}}\s{{1,2}})[A-Z0-9](?:[\x20-]?[A-Z]?[0-9]){{6,}}+"
#: Precision, by the confirmed proposals and the chance to be confirmed, that a threshold has to reach on the calibration half.
PRECISION = 0.95
TREES, RATE = 40, 0.3
#: Characters of context.
BEFORE, AFTER = 24, 8
_BLOCK = 256


def _with_prefix_sums(rows: DataFrame, name: str, numbers: str) -> DataFrame:
    """Column ``name``: the sum of the numbers before each place. Sums go by blocks, so that the work per place is bounded;
    each step is a column of its own, as a lambda evaluates for each element all that it holds."""
    none, n = F.array().cast("array<long>"), F.size(numbers)
    add = lambda part: F.aggregate(part, F.lit(0).cast("long"), lambda a, x: a + x)
    blocks = F.transform(F.sequence(F.lit(0), F.floor((n - 1) / _BLOCK).cast("int")), lambda b: add(F.slice(numbers, b * _BLOCK + 1, _BLOCK)))
    rows = with_once(rows, "_blocks", F.when(n > 0, blocks).otherwise(none))
    before = F.aggregate("_blocks", F.array(F.lit(0).cast("long")), lambda a, x: F.concat(a, F.array(F.element_at(a, -1) + x)))
    rows = with_once(rows, "_before", F.when(n > 0, before).otherwise(none))
    place = lambda i: F.get("_before", F.floor(i / _BLOCK).cast("int")) + add(F.slice(numbers, i - i % _BLOCK + 1, i % _BLOCK))
    sums = F.transform(F.sequence(F.lit(0), n - 1), place)
    return with_once(rows, name, F.when(n > 0, sums).otherwise(none)).drop("_blocks", "_before")


def _with_matches(rows: DataFrame, name: str, pattern: str, worth: Column) -> DataFrame:
    """Column ``name``: array of (s, e, m) of all matches in ``text``, in code points, where ``worth`` holds.

    Matches and the text between them, laid end to end, are the text, so lengths give positions.
    """
    empty = F.array().cast("array<string>")
    rows = with_once(rows, "_m", F.when(worth, F.regexp_extract_all("text", F.lit(pattern), F.lit(0))).otherwise(empty))
    rows = with_once(rows, "_gap", F.when(F.size("_m") > 0, F.transform(F.split("text", pattern, -1), lambda g: F.length(g).cast("long"))).otherwise(F.array().cast("array<long>")))
    step = F.transform(F.arrays_zip(F.slice("_gap", 1, F.size("_m")).alias("g"), F.col("_m").alias("m")), lambda x: x["g"] + F.length(x["m"]))
    rows = with_once(rows, "_step", F.when(F.size("_m") > 0, step).otherwise(F.array().cast("array<long>")))
    rows = _with_prefix_sums(rows, "_start", "_step")
    spans = F.transform(
        F.sequence(F.lit(0), F.size("_m") - 1),
        lambda i: F.struct(
            (F.get("_start", i) + F.get("_gap", i)).alias("s"), (F.get("_start", i) + F.get("_gap", i) + F.length(F.get("_m", i))).alias("e"), F.get("_m", i).alias("m")
        ),
    )
    none = F.array().cast("array<struct<s:bigint,e:bigint,m:string>>")
    return with_once(rows, name, F.when(F.size("_m") > 0, spans).otherwise(none)).drop("_m", "_gap", "_step", "_start")


def _digits(m: Column) -> Column:
    return F.regexp_replace(m, "[^0-9]", "")


def _valid(kind: str, m: Column) -> Column:
    if kind == "ip":
        return F.forall(F.split(m, r"\."), lambda p: p.cast("double") <= 255)
    n = F.length(_digits(m))
    if kind == "card":
        return F.when(n.between(14, 19), F.call_function("luhn_check", _digits(m))).otherwise(False)
    return n.between(10, 15) if kind == "phone" else F.lit(True)


def _valid_spans(number: int, kind: str) -> Column:
    kept = F.filter(kind, lambda x: _valid(kind, x["m"]))
    return F.transform(kept, lambda x: F.struct(F.lit(number).alias("kind"), x["s"].alias("s"), x["e"].alias("e")))


def _bits(kind: int, m: Column, before: Column, after: Column) -> Column:
    """Format and context of a proposal as one number of at most 12 bits. A spelled-out [at] is an @."""
    n = F.length(_digits(m))
    word = F.lower(before)
    if KINDS[kind] in BASE_KINDS:
        m = F.regexp_replace(m, _AT, "@")
        facts = [
            n.between(10, 15),
            F.when(n.between(14, 19), F.call_function("luhn_check", _digits(m))).otherwise(False),
            m.rlike(r"[\x20-]"),
            m.rlike(r"\([0-9]{3}\)"),
            m.rlike(r"[0-9]{3}[\x20.-][0-9]{4}$"),
            m.rlike(r"^[0-9]{4}[\x20-]?[0-9]{4}[\x20-]?[0-9]{4}[\x20-]?[0-9]{1,7}$"),
            m.rlike(r"@[A-Za-z0-9-]+([.][A-Za-z0-9-]+)*[.][A-Za-z]{2,}$"),
            F.forall(F.split(m, r"\x20?[.]\x20?"), lambda p: p.rlike("^[0-9]{1,3}$") & (p.cast("double") <= 255)),
            before.rlike(r"(^|[\s:(+])$") & after.rlike(r"^($|[\s.,;:!?)])"),
            word.rlike(r"\b(calls?|phones?|telephones?|tel|cell|mobile|fax|contacts?)\b[^\n]*$"),
            word.rlike(r"(card|visa|credit|account|payment)[^\n]*$"),
            word.rlike(r"(mail|server|host|address|\bip\b)[^\n]*$"),
        ]
    else:
        facts = [
            n > 0,
            m.rlike("[a-z]"),
            m.rlike("[A-Z]"),
            m.rlike("^[0-9a-fA-F]+$"),
            F.length(m) >= 20,
            F.length(m).isin(32, 40, 64, 128),
            m.rlike("[^A-Za-z0-9]"),
            m.rlike("(?:[0-9]+[A-Za-z]+){3}"),
            m.rlike("[A-Za-z]{7}"),
            before.rlike(r"[\x22']$") & after.rlike(r"^[\x22']"),
            m.rlike(r"^[0-9]{3}[-\x20][0-9]{2}[-\x20][0-9]{4}$"),
            m.rlike(r"^[A-Z]{2}[0-9]{2}[A-Z0-9\x20]{8,}$"),
        ]
    return sum((F.when(f, 1 << i).otherwise(0) for i, f in enumerate(facts)), F.lit(0)).cast("int")


def _boosted(cells: dict[int, tuple[float, float]]) -> dict[int, float]:
    """Score of each bit pattern from counts (confirmed, not) by gradient boosting with trees of depth two."""
    logit = dict.fromkeys(cells, 0.0)
    width = range(12)
    for _ in range(TREES):
        slope, bend = {}, {}
        for c, (yes, no) in cells.items():
            p = 1 / (1 + math.exp(-logit[c]))
            slope[c], bend[c] = yes * (1 - p) - no * p, (yes + no) * p * (1 - p) + 1e-9

        def gain(part: list[int], slope=slope, bend=bend) -> float:
            return sum(slope[c] for c in part) ** 2 / (sum(bend[c] for c in part) + 1.0) if part else 0.0

        def split(part: list[int], gain=gain) -> list[list[int]]:
            halves = [([c for c in part if c >> b & 1], [c for c in part if not c >> b & 1]) for b in width]
            best = max(halves, key=lambda h: gain(h[0]) + gain(h[1]))
            return [h for h in best if h]

        for leaf in [leaf for half in split(sorted(cells)) for leaf in split(half)]:
            step = RATE * sum(slope[c] for c in leaf) / (sum(bend[c] for c in leaf) + 1.0)
            for c in leaf:
                logit[c] = max(-30.0, min(30.0, logit[c] + step))
    return logit


def chosen_bits(cells: list[tuple[int, int, int, bool, int]]) -> dict[int, list[int]]:
    """By kind, the bit patterns to redact. ``cells``: (kind, bits, half, confirmed, count).

    The trees see half 0: how probable it is that a proposal with these bits is confirmed. Some personal data is never
    confirmed. Its share is taken to be the same whatever the bits, so the mean probability of the confirmed proposals
    of half 1 is the chance to be confirmed, ``found``. A pattern is personal data where its probability reaches half of
    ``found``; the threshold is the lowest such score above which the confirmed of half 1, divided by ``found``, make up
    ``PRECISION`` of all proposals. Nothing is chosen where half 1 has no confirmed proposal, nor a pattern that the trees
    never saw and half 1 does not confirm.
    """
    by: dict = defaultdict(lambda: defaultdict(lambda: [[0.0, 0.0], [0.0, 0.0]]))
    for kind, bits, half, confirmed, n in cells:
        by[kind][bits][half][not confirmed] += n
    out: dict[int, list[int]] = {}
    for kind, table in by.items():
        scores = _boosted({b: tuple(h[0]) for b, h in table.items()})
        chance = {b: 1 / (1 + math.exp(-x)) for b, x in scores.items()}
        confirmed = sum(h[1][0] for h in table.values())
        found = sum(h[1][0] * chance[b] for b, h in table.items()) / confirmed if confirmed else 1.0
        yes = no = 0.0
        known = [b for b, h in table.items() if any(h[0]) or h[1][0]]
        ranked, upto = sorted(known, key=lambda b: (-scores[b], b)), 0
        for i, b in enumerate(ranked, 1):
            yes, no = yes + table[b][1][0], no + table[b][1][1]
            last = i == len(ranked) or scores[ranked[i]] < scores[b]
            if last and yes and chance[b] >= found / 2 and yes >= PRECISION * found * (yes + no):
                upto = i
        out[kind] = sorted(ranked[:upto])
    return out


def proposals(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Rows (doc_id, base, proposed): base spans (kind, s, e) by start and kind, and proposals (kind, s, e, bits, confirmed).

    A proposal is confirmed if a base span of its kind overlaps it or, in kinds without base spans, a span of the other generator.
    """
    rows = docs.select(F.col(doc_id).alias("doc_id"), F.coalesce(F.col(text), F.lit("")).alias("text"))
    digit, at, plus = F.col("text").rlike("[0-9]"), F.contains("text", F.lit("@")), F.contains("text", F.lit("+"))
    for kind, pattern, worth in (("email", EMAIL, at), ("ip", IP, digit), ("card", CARD, digit), ("phone", PHONE, plus & digit)):
        rows = _with_matches(rows, kind, pattern, worth)
    named = lambda names: F.col("text").rlike(f"(?i)(?:{names})")
    long_run, spaced = F.col("text").rlike("[A-Za-z0-9+/_=-]{20}"), digit & F.col("text").rlike("[0-9]{2}[\\x20-]?[A-Z0-9]{4}")
    more = (
        ("long_run", LONG_RUN, long_run), ("named_secret", NAMED_SECRET, named(_SECRET_NAMES)),
        ("id_form", ID_FORM, spaced), ("named_id", NAMED_ID, digit & named(_ID_NAMES)),
    )
    for name, pattern, worth in (("any_at", ANY_AT, at | F.contains("text", F.lit("at]")) | F.contains("text", F.lit("at)"))), ("any_quad", ANY_QUAD, digit), ("any_number", ANY_NUMBER, digit), *more):
        rows = _with_matches(rows, name, pattern, worth)
    none = F.array().cast("array<struct<kind:int,s:bigint,e:bigint>>")
    valid = [_valid_spans(k, kind) for k, kind in enumerate(BASE_KINDS)]
    by_place = lambda a: F.transform(F.array_sort(F.transform(a, lambda x: F.struct(x["s"], x["kind"], x["e"]))), lambda x: F.struct(x["kind"], x["s"], x["e"]))
    found = F.size("email") + F.size("ip") + F.size("card") + F.size("phone") > 0
    rows = with_once(rows, "base", F.when(found, by_place(F.concat(*valid))).otherwise(none))

    def proposed(kind: int, name: str, other: str | None = None) -> Column:
        def one(x: Column) -> Column:
            if kind == 0:  # the end of a sentence is none of the address
                m = F.rtrim(x["m"], F.lit(".!?"))
                x = {"s": x["s"], "e": x["s"] + F.length(m), "m": m}
            before = F.substring(F.col("text"), F.greatest(x["s"] - BEFORE, F.lit(0)).cast("int") + 1, F.least(x["s"], F.lit(BEFORE)).cast("int"))
            after = F.substring(F.col("text"), x["e"].cast("int") + 1, F.lit(AFTER))
            over = lambda b: (b["s"] < x["e"]) & (b["e"] > x["s"])
            confirmed = F.exists(other, over) if other else F.exists("base", lambda b: (b["kind"] == kind) & over(b))
            return F.struct(F.lit(kind).alias("kind"), x["s"].alias("s"), x["e"].alias("e"), _bits(kind, x["m"], before, after).alias("bits"), confirmed.alias("confirmed"))

        return F.transform(F.filter(name, lambda x: F.length(x["m"]) >= (6 if other else 7)), one)

    some = sum((F.size(name) for name, _, _ in more), F.size("any_at") + F.size("any_quad") + F.size("any_number")) > 0
    nothing = F.array().cast("array<struct<kind:int,s:bigint,e:bigint,bits:int,confirmed:boolean>>")
    lists = F.concat(
        proposed(0, "any_at"), proposed(1, "any_quad"), proposed(2, "any_number"), proposed(3, "any_number"),
        proposed(4, "long_run", "named_secret"), proposed(4, "named_secret", "long_run"),
        proposed(5, "id_form", "named_id"), proposed(5, "named_id", "id_form"),
    )
    rows = with_once(rows, "proposed", F.when(some, lists).otherwise(nothing))
    return rows.select("doc_id", "base", "proposed")


def find(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Rows (doc_id, base, spans), one for each row of ``docs``; both are arrays of (kind, s, e), ordered by start and kind.

    ``spans`` holds the base spans and every chosen proposal that overlaps no base span of its kind.
    Only the base kinds have base spans. A null text is
    empty and has none. Rows that repeat an id are searched each.
    """
    ws = Workspace(docs.sparkSession)
    rows = ws.store(proposals(docs, doc_id, text), "proposals")
    cells = rows.select(fold(F.col("doc_id"), 2).cast("int").alias("half"), F.explode("proposed").alias("p"))
    cells = cells.groupBy("p.kind", "p.bits", "half", "p.confirmed").count().collect()  # at most 2**12 patterns, 6 kinds, 2 halves
    chosen = chosen_bits([tuple(r) for r in cells])
    codes = [kind * 4096 + bits for kind, patterns in chosen.items() for bits in patterns]
    picked = lambda p: (~p["confirmed"] | (p["kind"] >= len(BASE_KINDS))) & ((p["kind"] * 4096 + p["bits"]).isin(codes) if codes else F.lit(False))
    added = F.transform(F.filter("proposed", picked), lambda p: F.struct(p["s"], p["kind"], p["e"]))
    both = F.array_sort(F.array_distinct(F.concat(F.transform("base", lambda b: F.struct(b["s"], b["kind"], b["e"])), added)))
    spans = F.transform(both, lambda x: F.struct(x["kind"], x["s"], x["e"]))
    return rows.select("doc_id", "base", F.when(F.size(added) > 0, spans).otherwise(F.col("base")).alias("spans"))


def joined(spans: Column) -> Column:
    """The spans as kind:start:end, comma-joined."""
    names = F.array(*map(F.lit, KINDS))
    return F.array_join(F.transform(spans, lambda x: F.concat_ws(":", F.get(names, x["kind"]), x["s"].cast("string"), x["e"].cast("string"))), ",")


def redact(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Rows (doc_id, redacted) with every span replaced by its kind in brackets; where spans overlap, the first stays whole and what it covers goes."""
    found = find(docs.select(F.struct(F.col(doc_id).alias("id"), F.col(text).alias("text")).alias("row"), F.col(text).alias("text")), "row", "text").withColumnRenamed("doc_id", "_row")
    names, whole = F.array(*map(F.lit, KINDS)), F.coalesce(F.col("_row.text"), F.lit(""))
    start = F.struct(F.lit("").alias("out"), F.lit(0).cast("long").alias("at"))

    def step(a: Column, x: Column) -> Column:
        piece = F.concat(a["out"], F.substring(whole, (a["at"] + 1).cast("int"), (x["s"] - a["at"]).cast("int")), F.lit("["), F.get(names, x["kind"]), F.lit("]"))
        return F.when(x["s"] >= a["at"], F.struct(piece.alias("out"), x["e"].alias("at"))).otherwise(F.struct(a["out"].alias("out"), F.greatest(a["at"], x["e"]).alias("at")))

    end = F.aggregate("spans", start, step, lambda a: F.concat(a["out"], F.substring(whole, (a["at"] + 1).cast("int"), F.length(whole))))
    return found.select(F.col("_row.id").alias("doc_id"), end.alias("redacted"))
