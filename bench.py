"""Times the headline queries and prints one JSON line.

BENCH_SF_DIR   data folder (default /root/testdata/sf0.1)
BENCH_CPUS     local cores (default 8)
BENCH_SHAPES=0 leaves out the member lane from stored fields on, ours and the direct way: one OR condition, one Python call per pair
"""

from __future__ import annotations

import json
import os
import time
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from docmeld.plans.derived import DerivedTables
from docmeld.plans.registry import QUERIES

SF_DIR = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
CPUS = os.environ.get("BENCH_CPUS", "8")
HEADLINE = (
    "structure_documents",
    "candidate_pairs_member",
    "candidate_pairs_auth",
    "pair_features_member",
    "jaro_winkler",
    "match_distribution",
    "match_events",
    "expectations_report",
    "validation_report",
    "dq_metrics",
    "v_doc_match_status",
    "v_batch_match_metrics",
    "stream_match_events",
)


def session() -> SparkSession:
    spark = (
        SparkSession.builder.master(f"local[{CPUS}]")
        .appName("bench")
        .config("spark.sql.shuffle.partitions", CPUS)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", "16g")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def seconds(build: Callable[[], DataFrame]) -> float:
    start = time.perf_counter()
    build().write.format("noop").mode("overwrite").save()
    return round(time.perf_counter() - start, 3)


def direct_shapes(t: DerivedTables) -> dict[str, Callable[[], DataFrame]]:
    """The member lane as an OR join with a row-at-a-time similarity."""

    def plain_similarity(a: str | None, b: str | None) -> float:
        a, b = (a or "").lower(), (b or "").lower()
        if not a or not b or a == b:
            return float(bool(a) and a == b)
        reach, free, found = max(max(len(a), len(b)) // 2 - 1, 0), set(range(len(b))), []
        for i, c in enumerate(a):
            spot = next((p for p in range(max(0, i - reach), min(len(b), i + reach + 1)) if p in free and b[p] == c), None)
            if spot is not None:
                free.discard(spot)
                found.append((spot, c))
        if not found:
            return 0.0
        moved, m = sum(c != b[p] for (_, c), (p, _) in zip(found, sorted(found))), len(found)
        base = (m / len(a) + m / len(b) + (m - moved / 2) / m) / 3
        prefix = next((i for i, (x, y) in enumerate(zip(a[:4], b[:4])) if x != y), min(4, len(a), len(b)))
        return min(1.0, base + prefix * 0.1 * (1 - base))

    def joined() -> DataFrame:
        d, m = t.structured.alias("d"), t.member.alias("m")
        return d.join(m, (F.col("d.ssn4") == F.col("m.ssn4")) | (F.col("d.dob") == F.col("m.dob")))

    similarity = F.udf(plain_similarity, "double")
    return {
        "or_join": lambda: joined().select("d.doc_id", "m.member_id"),
        "keyed_join": lambda: t.member_candidates.select("l_doc_id", "r_member_id"),
        "keyed_join_scored": lambda: t.member_pairs,
        "or_join_row_udf": lambda: joined().select(
            "d.doc_id", "m.member_id", similarity("d.first_name", "m.first_name"), similarity("d.last_name", "m.last_name")
        ),
    }


def main() -> None:
    spark = session()
    small = os.path.join(os.path.dirname(SF_DIR.rstrip("/")), "sf0.001")
    if os.path.isdir(small):
        QUERIES["match_events"](spark, small).count()
    times = {name: seconds(lambda name=name: QUERIES[name](spark, SF_DIR)) for name in HEADLINE}
    result = {
        "metric": "headline queries, total",
        "value": round(sum(times.values()), 3),
        "unit": "sec",
        "queries": times,
        "sf": float(os.path.basename(SF_DIR.rstrip("/")).removeprefix("sf")),
    }
    if os.environ.get("BENCH_SHAPES", "1") != "0":
        tables = DerivedTables(spark, SF_DIR)
        tables.documents
        result["direct_shapes"] = {name: seconds(build) for name, build in direct_shapes(tables).items()}
    print(json.dumps(result))


if __name__ == "__main__":
    main()
