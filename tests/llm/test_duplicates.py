"""Exact duplicates, quotient filters and the n-gram join against plain versions."""

import hashlib
import random
from collections import defaultdict

import numpy as np
import pytest
from helpers import EXTRA, frame, lower, odd_rows, rows_of, words

from docmeld.llm import exact_dedup, ngram_join, quotient, shingles
from docmeld.llm.common import components
from docmeld.workspace import Workspace


def plain_duplicates(rows):
    groups = defaultdict(list)
    for r in rows:
        groups[lower(r[1])].append(r[0])
    out = []
    for i, t, *_ in rows:
        ids = groups[lower(t)]
        keep = max((x for x in ids if x is not None), default=None)
        out.append((i, keep, len(ids), i == keep, hashlib.sha256(lower(t).encode()).hexdigest()))
    return sorted(out, key=str)


def found_duplicates(df, **options):
    return sorted(((r["doc_id"], r["keep_id"], r["group_size"], r["kept"], r["text_sha256"]) for r in rows_of(exact_dedup.duplicates(df, **options))), key=str)


def test_duplicates_of_odd_rows(spark):
    rows = odd_rows()
    assert found_duplicates(frame(spark, rows, extra=True)) == plain_duplicates(rows)


def test_duplicates_with_a_hot_group(spark):
    rng = random.Random(1)
    rows = [(i, rng.choice(["Hot text", "HOT TEXT", f"t{rng.randrange(300)}"])) for i in range(900)]
    assert found_duplicates(frame(spark, rows, 7)) == plain_duplicates(rows)


def test_no_documents(spark):
    assert found_duplicates(frame(spark, [])) == []
    assert exact_dedup.deduplicate(frame(spark, [])).count() == 0


def test_equal_fingerprints_of_different_texts_are_told_apart(spark):
    rows = [(i, f"text {i % 40}") for i in range(60)]
    assert found_duplicates(frame(spark, rows), bits=6) == plain_duplicates(rows)


def test_deduplicate_keeps_one_row_per_text_and_all_columns(spark):
    rows = odd_rows()
    for part in (rows, [r for r in rows if r[0] is not None and r[0] != 7]):
        df = frame(spark, part, extra=True)
        out = exact_dedup.deduplicate(df)
        assert out.columns == df.columns and set(EXTRA) <= set(out.columns)
        kept = rows_of(out)
        assert sorted(lower(r["text"]) for r in kept) == sorted({lower(r[1]) for r in part})
        keep = {p[4]: p[1] for p in plain_duplicates(part)}
        assert all(keep[hashlib.sha256(lower(r["text"]).encode()).hexdigest()] == r["doc_id"] for r in kept)


@pytest.mark.parametrize("n", [0, 1, 2, 500])
@pytest.mark.parametrize("low", [20, 40, 56])
def test_quotient_filter_gives_back_what_it_holds(n, low):
    rng = np.random.default_rng(n + low)
    values = np.unique(rng.integers(0, 1 << low, n, dtype=np.uint64))
    counts = rng.integers(1, 100_000, len(values))
    keys, back = quotient.decode(quotient.encode(values, counts, low), low)
    assert keys.tolist() == values.tolist() and back.tolist() == counts.tolist()


def test_merged_filters_equal_the_filter_of_everything():
    rng = np.random.default_rng(5)
    parts = [rng.integers(0, 1 << 12, 400).astype(np.uint64) for _ in range(4)]
    filters = [quotient.encode(*quotient.add_up(p, np.ones(len(p), np.int64)), 12) for p in parts]
    merged, counts = quotient.merge(filters, 12)
    keys, n = np.unique(np.concatenate(parts), return_counts=True)
    assert merged.tolist() == keys.tolist() and counts.tolist() == n.tolist()


def plain_sets(rows, size):
    out = []
    for _, t, *_ in rows:
        w = words(t)
        out.append({tuple(w[i : i + size]) for i in range(max(1, len(w) - size + 1))} if w else set())
    return out


def plain_join(rows, size, least):
    sets, group = plain_sets(rows, size), list(range(len(rows)))
    for i in range(len(rows)):
        for j in range(i):
            both = len(sets[i] & sets[j])
            if sets[i] and sets[j] and 100 * both >= least * len(sets[i] | sets[j]) and group[i] != group[j]:
                group = [group[j] if g == group[i] else g for g in group]
    ids = [min((rows[k][0] for k in range(len(rows)) if group[k] == g and rows[k][0] is not None), default=rows[i][0]) for i, g in enumerate(group)]
    return sorted(((r[0], len(s), c) for r, s, c in zip(rows, sets, ids, strict=True)), key=str)


def found_join(df, size, least):
    return sorted(((r["doc_id"], r["n_shingles"], r["component_id"]) for r in rows_of(ngram_join.join(df, size, least))), key=str)


def near_copies(rng, n):
    rows = []
    for i in range(n):
        if rows and rng.random() < 0.6:
            w = words(rng.choice(rows)[1])
            for _ in range(rng.randrange(1 + len(w) // 20)):
                k = rng.randrange(len(w))
                w[k : k + 1] = rng.choice([[], [str(rng.random())], [w[k], "new"]])
        else:
            w = [f"w{rng.randrange(400)}" for _ in range(rng.choice([1, 2, 3, 8, 30, 60, 120, 400]))]
        rows.append((i * 7 % 1009, " ".join(w)))
    return rows


@pytest.mark.parametrize(("size", "least"), [(3, 90), (5, 80)])
def test_join_finds_all_links(spark, size, least):
    rows = near_copies(random.Random(size), 250) + odd_rows()
    assert found_join(frame(spark, rows, 5, extra=True), size, least) == plain_join(rows, size, least)


def test_join_of_a_bucket_larger_than_a_cell(spark, monkeypatch):
    """A chain of sets, each linked to the next only, that all share their buckets."""
    monkeypatch.setattr(ngram_join, "CELL", 16)
    core = [f"c{i}" for i in range(300)]
    rows = [(i, " ".join(core[: 300 - 12] + [f"t{k}" for k in range(i * 6, i * 6 + 40)])) for i in range(90)]
    assert found_join(frame(spark, rows, 4), 3, 90) == plain_join(rows, 3, 90)


def test_keys_travel_in_few_bits(spark):
    """The key comes last, so that its zeros and the head of the next row are one run."""
    docs = spark.createDataFrame([(" ".join(f"w{i}" for i in range(400)),)], "text string")
    met = ngram_join._meetings(docs, 3, 90)
    keys = [r["key"] for r in met.collect()]
    assert met.columns == ["digest", "key"] and len(set(keys)) > 30 and 0 <= min(keys) and max(keys) < 1 << 40


def test_join_deduplicate_and_empty(spark):
    rows = near_copies(random.Random(9), 80)
    df = frame(spark, rows, extra=True)
    out = ngram_join.deduplicate(df)
    assert out.columns == df.columns
    assert sorted(r["doc_id"] for r in rows_of(out)) == sorted(i for i, _, c in plain_join(rows, 5, 80) if i == c)
    assert found_join(frame(spark, []), 5, 80) == []


@pytest.mark.parametrize("case", ["odd", "repeated", "nulls"])
def test_join_deduplicate_with_null_and_repeated_ids(spark, case):
    """One row of each group stays, of the smallest id, nulls last, whatever happens to other rows of that id."""
    a, b, c = (" ".join(f"{x}{i}" for i in range(60)) for x in "abc")
    if case == "odd":
        rows = odd_rows() + [(None, "a clean text that has nothing to do with any other row"), (None, "One two three FOUR")]
    elif case == "repeated":
        rows = [(3, a), (7, a + " more"), (3, b), (2, b + " more"), (3, c), (3, c + " more"), (3, c + " more"), (None, ""), (4, "")]
    else:
        rows = [(None, a), (None, a + " more"), (1, b), (None, b + " more"), (None, c), (None, None), (None, "")]
    sets, group = plain_sets(rows, 5), list(range(len(rows)))
    for i in range(len(rows)):
        for j in range(i):
            if sets[i] and 100 * len(sets[i] & sets[j]) >= 80 * len(sets[i] | sets[j]):
                group = [group[j] if g == group[i] else g for g in group]
    least = {g: min((rows[k][0] is None, rows[k][0] or 0) for k in range(len(rows)) if group[k] == g) for g in group}
    df = frame(spark, rows, extra=True)
    out = ngram_join.deduplicate(df)
    assert out.columns == df.columns
    found = [(r["doc_id"], r["text"]) for r in rows_of(out)]
    at = {(r[0], r[1]): g for r, g in zip(rows, group, strict=True)}
    assert sorted(at[x] for x in found) == sorted(set(group))
    assert all((i is None, i or 0) == least[at[i, t]] for i, t in found)


@pytest.mark.parametrize("least", [80, 90])
def test_linked_sets_share_a_key(least):
    rng = random.Random(least)
    linked = 0
    for _ in range(400):
        n = rng.choice([1, 2, 5, 20, 31, 32, 33, 40, 41, 64, 150, 600])
        a = [rng.randrange(1 << 60) for _ in range(n)]
        b = a[: n - rng.randrange(1 + n // 7)] + [rng.randrange(1 << 60) for _ in range(rng.randrange(1 + n // 9))]
        x, y = (np.unique(shingles.mix(np.array(s, np.uint64))) for s in (a, b))
        both = len(np.intersect1d(x, y))
        if 100 * both >= least * (len(x) + len(y) - both):
            linked += 1
            assert len(np.intersect1d(shingles.keys(x, least), shingles.keys(y, least)))
    assert linked > 100


def test_tree_passes_every_pair_that_its_bound_allows():
    rng = np.random.default_rng(2)
    centres = rng.poisson(3, (40, ngram_join.GROUPS))
    points = (centres[rng.integers(0, 40, 700)] + rng.poisson(0.05, (700, ngram_join.GROUPS))).astype(np.uint8)
    sizes = points.sum(1, dtype=np.int64)
    i, j = np.triu_indices(700, 1)
    enough = 180 * np.minimum(points[i], points[j]).sum(1, dtype=np.int64) >= 80 * (sizes[i] + sizes[j])
    a, b, _ = ngram_join.tree_pairs(points, sizes, 80)
    assert set(zip(i[enough].tolist(), j[enough].tolist(), strict=True)) == set(zip(a.tolist(), b.tolist(), strict=True))


def test_edges_that_connect():
    a, b = np.array([1, 2, 1, 5, 3]), np.array([2, 3, 3, 6, 4])
    assert ngram_join.connecting(a, b, np.array([0.9, 0.8, 0.95, 0.1, 0.2])).tolist() == [True, False, True, True, True]


def test_components_of_paths_stars_and_rings(spark):
    edges = [(i, i + 1) for i in range(40)] + [(1000, k) for k in range(1001, 1100)] + [(500 + i, 500 + (i + 1) % 9) for i in range(9)] + [(7000, 7000)]
    df = spark.createDataFrame(edges, "a long, b long").repartition(3)
    roots = {r["id"]: r["root"] for r in rows_of(components(Workspace(spark), df, "c"))}
    assert roots == {k: 0 for k in range(1, 41)} | {k: 1000 for k in range(1001, 1100)} | {k: 500 for k in range(501, 509)}
