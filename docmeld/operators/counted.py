"""Classes of pairs counted per document; only pairs whose class depends on the names are formed.

Names move a weight by a bounded amount. Where both ends of that range lie in one class, agreement of the anchors alone decides,
and the pairs are counted per key. A counted table has a row per document and class and says in ``pairs`` how many pairs it
stands for; reports that count pairs take it in place of the pairs.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, functions as F

from docmeld.config import POSSIBLE_THRESHOLD, MatchWeights
from docmeld.operators.blocking import MEMBER_RULES, Rule
from docmeld.workspace import Workspace

ANCHORS = (Rule("anchors", "anchors"),)
KEYS = ("doc_id", "pipeline_run_ts", "match_class")


def pair_number(df: DataFrame) -> Column:
    """How many pairs a row stands for: one, or what a counted table says."""
    return F.col("pairs") if "pairs" in df.columns else F.lit(1).cast("long")


def n_pairs(df: DataFrame, condition: Column | None = None) -> Column:
    """Number of pairs, or of those with a condition, as an aggregate."""
    n = pair_number(df)
    return F.coalesce(F.sum(n if condition is None else F.when(condition, n)), F.lit(0).cast("long"))


def counted(matches: DataFrame) -> DataFrame:
    """Matches as a counted table."""
    return matches.groupBy(*KEYS).agg(F.count(F.lit(1)).alias("pairs"))


def decided_class(weights: MatchWeights, ssn4: bool, dob: bool) -> str | None:
    """Class of all pairs with this agreement of the anchors; None if the names may change it, or if a rule has to look at them.

    The weight is added up in the order of ``fs_score``; rounding keeps the order of sums, so its ends are those of the range.
    """
    anchors = (weights.ssn4 if ssn4 else -weights.ssn4) + (weights.dob if dob else -weights.dob)
    names = sorted((-1.0, weights.name_scale - 1.0))
    ends = [anchors + w + w for w in names]
    classes = ["match" if x >= weights.match_at else "possible_match" if x >= weights.possible_at else "non_match" for x in ends]
    if classes[0] != classes[1] or (classes[0] == "match" and ends[0] < POSSIBLE_THRESHOLD):
        return None
    return classes[0]


def with_anchors(df: DataFrame) -> DataFrame:
    """Both anchors as one key, NULL if one is."""
    # the date comes first, as it holds no blank
    return df.withColumn("anchors", F.concat(F.col("dob").cast("string"), F.lit(" "), F.col("ssn4")))


def worth_review_rules(weights: MatchWeights = MatchWeights()) -> tuple[Rule, ...]:
    """Blocking rules that find all pairs of the member lane but non-matches: both anchors together (:func:`with_anchors`) if one
    alone makes a non-match whatever the names, else those of the lane."""
    one = {decided_class(weights, True, False), decided_class(weights, False, True)}
    return ANCHORS if one == {"non_match"} else MEMBER_RULES


def member_match_counts(
    workspace: Workspace, documents: DataFrame, members: DataFrame, scored: Callable[[DataFrame, DataFrame, tuple[Rule, ...]], DataFrame],
    weights: MatchWeights = MatchWeights(),
) -> DataFrame:
    """(doc_id, pipeline_run_ts, match_class, pairs) of the member lane.

    ``scored`` makes the matches of two tables by blocking rules. It gets the rows of both by both anchors together, so a pair
    that agrees in one anchor only is counted and never formed; if the weights leave the class of such pairs open, it gets
    the rules of the lane and makes all.
    """
    one = {"ssn4": decided_class(weights, True, False), "dob": decided_class(weights, False, True)}
    if None in one.values():
        return counted(scored(documents, members, MEMBER_RULES))
    docs, entities = with_anchors(documents), with_anchors(members)
    keyed = docs.where("doc_id is not null").select("doc_id", "pipeline_run_ts", "ssn4", "dob", "anchors")
    known = entities.where("member_id is not null")

    def per_key(key: str, match_class: str, sign: int) -> DataFrame:
        sizes = workspace.store(known.where(F.col(key).isNotNull()).groupBy(key).agg(F.count(F.lit(1)).alias("n")), f"members_by_{key}_{match_class}")
        return keyed.join(sizes, key).select("doc_id", "pipeline_run_ts", F.lit(match_class).alias("match_class"), (F.col("n") * sign).alias("pairs"))

    # pairs that agree in both anchors are in both counts, and are not of that kind
    parts = [per_key(key, match_class, 1) for key, match_class in one.items()]
    parts += [per_key("anchors", match_class, -k) for match_class, k in {c: list(one.values()).count(c) for c in one.values()}.items()]
    parts.append(counted(scored(docs, entities, ANCHORS)))
    rows = parts[0]
    for part in parts[1:]:
        rows = rows.unionByName(part)
    return rows.groupBy(*KEYS).agg(F.sum("pairs").alias("pairs")).where("pairs > 0")


def counted_events(member: DataFrame, auth: DataFrame) -> DataFrame:
    """Both counted lanes as the event log has them."""
    return member.withColumn("entity_type", F.lit("member")).unionByName(auth.withColumn("entity_type", F.lit("auth")))
