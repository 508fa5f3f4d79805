"""m and u where the true pairs are unknown: expectation-maximisation over counts of agreement patterns.

The counts are those of all pairs of a document and an entity, but no pair is formed: rows are counted per key, for each
subset of the fields, and the products of both sides' counts say how many pairs agree on at least the subset. What agrees
on exactly a subset follows by inclusion and exclusion. Blocking has no part in it, so u is not biased by it.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, functions as F

# Fields of the comparison.
FIELDS = ("ssn4", "dob", "first_name", "last_name")
STEPS = 100
#: First guess of m; u starts as the share of all pairs that agree.
FIRST_M = 0.9
#: Keys that a task counts or joins; an upper bound, as equal rows give one.
KEYS_PER_TASK = 1_000_000
#: Pairs that are added, half of them agreeing, so that no probability is 0 or 1.
PSEUDO_PAIRS = 1.0


def comparable(rows: DataFrame, fields: tuple[str, ...] = FIELDS) -> DataFrame:
    """The fields as they are compared: trimmed, in lower case; an empty one is missing."""
    return rows.select(*[F.nullif(F.lower(F.trim(F.col(f).cast("string"))), F.lit("")).alias(f) for f in fields])


def _counted(rows: DataFrame, fields: tuple[str, ...], side: str, tasks: int) -> DataFrame:
    """Rows per fields that are present, subset of them, and values in the subset, dealt by subset and values. At most one row
    per set of present fields has a key, so no key is hot however often it occurs.

    Values outside the subset come back empty, which no value is.
    """
    has = sum((F.when(F.col(f).isNotNull(), 1 << i).otherwise(0) for i, f in enumerate(fields)), F.lit(0))
    tuples = rows.groupBy(*fields).agg(F.count(F.lit(1)).alias("n")).withColumn("has", has)
    subsets = F.filter(F.sequence(F.lit(0), F.lit((1 << len(fields)) - 1)), lambda s: s.bitwiseAND(F.col("has")) == s)
    # a row gives many keys, so few tasks, though enough for the rows, would hold too many
    entries = tuples.repartition(tasks, "has", *fields).withColumn("subset", F.explode(subsets))
    kept = {f: F.when(F.col("subset").bitwiseAND(F.lit(1 << i)) != 0, F.col(f)) for i, f in enumerate(fields)}
    keyed = entries.withColumns(kept).groupBy("has", "subset", *fields).agg(F.sum("n").alias("n"))
    values = [F.coalesce(f, F.lit("")).alias(f) for f in fields]
    return keyed.select("subset", *values, *[F.col(c).alias(f"{side}_{c}") for c in ("has", "n")]).repartition(tasks, "subset", *fields)


def agreement_patterns(left: DataFrame, right: DataFrame, fields: tuple[str, ...] = FIELDS) -> DataFrame:
    """Rows (present, agree, pairs): of all pairs of a row of both tables, how many have exactly the fields of the bits
    ``present`` on both sides and agree on exactly those of ``agree``. Patterns without a pair are left out.

    Null and empty values are missing. Equal rows count each. An empty table gives no rows.
    """
    keys = (left.count() + right.count()) << len(fields)
    tasks = max(int(left.sparkSession.conf.get("spark.sql.shuffle.partitions")), math.ceil(keys / KEYS_PER_TASK))
    d, e = (_counted(comparable(rows, fields), fields, side, tasks) for rows, side in ((left, "l"), (right, "r")))
    whole = lambda c: F.col(c).cast("decimal(19,0)")
    present = F.col("l_has").bitwiseAND(F.col("r_has"))
    at_least = d.join(e, ["subset", *fields]).groupBy(present.alias("present"), "subset").agg(F.sum(whole("l_n") * whole("r_n")).alias("pairs"))
    subset = F.col("subset")
    smaller = F.filter(F.sequence(F.lit(0), subset), lambda a: a.bitwiseAND(subset) == a)
    signed = F.when((F.bit_count(subset) - F.bit_count("agree")) % 2 == 0, F.col("pairs")).otherwise(-F.col("pairs"))
    exact = at_least.withColumn("agree", F.explode(smaller)).groupBy("present", "agree").agg(F.sum(signed).alias("pairs"))
    return exact.where("pairs > 0")


def expectation_maximisation(
    patterns: list[tuple[int, int, float]], fields: int, share: float, steps: int = STEPS
) -> tuple[float, list[float], list[float]]:
    """Share of true pairs, and m and u per field, from (present, agree, pairs). A missing field says nothing."""
    has = [[p >> i & 1 for i in range(fields)] for p, _, _ in patterns]
    agrees = [[a >> i & 1 for i in range(fields)] for _, a, _ in patterns]
    pairs = [float(n) for _, _, n in patterns]

    def rates(weights: list[float]) -> list[float]:
        total = lambda bits, i: math.fsum(w * b[i] for w, b in zip(weights, bits))
        return [(total(agrees, i) + PSEUDO_PAIRS / 2) / (total(has, i) + PSEUDO_PAIRS) for i in range(fields)]

    m, u = [FIRST_M] * fields, rates(pairs)
    for _ in range(steps if pairs else 0):
        like = lambda rate, h, a: math.prod(r if y else 1 - r for r, x, y in zip(rate, h, a) if x)
        true = [share * like(m, h, a) for h, a in zip(has, agrees)]
        false = [(1 - share) * like(u, h, a) for h, a in zip(has, agrees)]
        sure = [n * t / (t + f) for n, t, f in zip(pairs, true, false)]
        m, u = rates(sure), rates([n - s for n, s in zip(pairs, sure)])
        share = math.fsum(sure) / math.fsum(pairs)
    return share, m, u


def estimate_parameters(
    left: DataFrame, right: DataFrame, fields: tuple[str, ...] = FIELDS, multiplier: Column | None = None
) -> DataFrame:
    """One row per field: m, u and the multiplier, as ``fs_parameters`` takes them.

    The driver holds one count per pattern, at most 3 to the number of fields. The first guess of the share of true pairs
    is one entity per document. Without rows, m and u are what they start from.
    """
    patterns = [(r.present, r.agree, float(r.pairs)) for r in agreement_patterns(left, right, fields).collect()]
    entities = right.count()
    _, m, u = expectation_maximisation(patterns, len(fields), 1 / max(entities, 2))
    rows = list(zip(fields, m, u))
    frame = left.sparkSession.createDataFrame(rows, "field_name string, m_probability double, u_probability double")
    return frame.withColumn("field_weight_multiplier", F.lit(1.0) if multiplier is None else multiplier)
