"""Manifest, audit of sources and main text of pages against plain versions."""

import hashlib
import html
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from helpers import LONG, frame, lower, odd_rows, rows_of
from pyspark.sql import functions as F

from docmeld.llm import divergence, html_blocks, merkle, queries
from docmeld.llm.divergence import Lookup, perfect_hash


def in_order(rows):
    return sorted(map(str, rows))


# Manifest


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def plain_leaf(*fields):
    return sha("".join("-" if f is None else f"{len(str(f).encode())}:{f}" for f in fields))


def plain_tree(leaves):
    """All levels, the leaves first."""
    levels = [leaves]
    while len(levels[-1]) > 1:
        row = levels[-1]
        levels.append([sha("".join(row[i : i + 2])) for i in range(0, len(row), 2)])
    return levels


def plain_steps(levels, i):
    steps = []
    for row in levels[:-1]:
        j = i ^ 1
        steps.append((None, None) if j >= len(row) else (j < i, row[j]))
        i //= 2
    return steps


def plain_manifest(rows):
    """(doc_id, leaf, subroot, root, steps) in the order of groups and ids."""
    groups = defaultdict(list)
    for doc_id, text, source, lang, n_chars in rows:
        groups[lang].append((doc_id is not None, doc_id, plain_leaf(doc_id, source, lang, n_chars, text)))
    names = sorted(groups, key=lambda g: (g is not None, (g or "").encode()))
    trees = {g: plain_tree([leaf for _, _, leaf in sorted(groups[g], key=lambda x: (x[0], x[1] or 0, x[2]))]) for g in names}
    top = plain_tree([trees[g][-1][0] for g in names])
    for k, g in enumerate(names):
        for i, (_, doc_id, leaf) in enumerate(sorted(groups[g], key=lambda x: (x[0], x[1] or 0, x[2]))):
            yield doc_id, leaf, trees[g][-1][0], top[-1][0], plain_steps(trees[g], i) + plain_steps(top, k)


def wide(spark, rows, parts=5):
    """documents from (doc_id, text, source, lang, n_chars)."""
    schema = "doc_id long, text string, source string, lang string, n_chars long"
    return spark.createDataFrame(rows, schema).select("doc_id", "text", "lang", "source", "n_chars").repartition(parts)


@pytest.mark.parametrize("levels", [1, 2, 3, 4, 7, 9])
def test_layout_gives_each_node_a_place_and_keeps_lower_trees_together(levels):
    places = [merkle.address(levels, d, np.arange(1 << d)) for d in range(levels)]
    assert sorted(np.concatenate(places).tolist()) == list(range((1 << levels) - 1)) and places[0].tolist() == [0]
    top = levels // 2
    if top:
        # the nodes below each leaf of the upper half lie in one run
        for tree in range(1 << top):
            own = np.concatenate([p[tree << (d - top) : (tree + 1) << (d - top)] for d, p in enumerate(places) if d >= top])
            assert own.max() - own.min() + 1 == len(own) == (1 << (levels - top)) - 1


@pytest.mark.parametrize("sizes", [(1,), (2,), (3, 1), (5, 256, 257), (700, 1, 512, 511)])
def test_manifest_equals_plain_trees(spark, sizes):
    rows = [(1000 * g + i * 3, f"text {i}", "s", None if g == 0 else f"l{g}", i) for g, n in enumerate(sizes) for i in range(n)]
    found = {r["doc_id"]: r for r in rows_of(merkle.manifest(wide(spark, rows)))}
    expected = list(plain_manifest(rows))
    assert len(found) == len(expected) == len(rows)
    for doc_id, leaf, subroot, root, steps in expected:
        r = found[doc_id]
        assert (r["leaf"], r["claimed"], r["subroot"], r["root"]) == (leaf, leaf, subroot, root)
        assert [(s["left"], s["sibling"]) for s in r["path"]] == steps


def test_manifest_of_a_group_with_blocks_over_several_rounds(spark, monkeypatch):
    monkeypatch.setattr(merkle, "HEIGHT", 2)
    merkle._addresses.cache_clear()
    try:
        # one block after the other in this process, as workers have the module's own height
        leaves = [sha(str(i)) for i in range(4)]
        nodes, depth = merkle.build(leaves, False)
        assert depth == 0 and nodes[:32].hex() == plain_tree(leaves)[-1][0]
        assert [[(s["left"], s["sibling"]) for s in steps] for steps in merkle.siblings(nodes, 4, 0)[1]] == [plain_steps(plain_tree(leaves), i) for i in range(4)]
        lone, depth = merkle.build(leaves[:1], True)
        assert depth == 0 and lone[:32].hex() == sha(sha(leaves[0]))
        assert merkle.build(leaves[:1], False)[1] == 2
    finally:
        merkle._addresses.cache_clear()


def test_manifest_of_odd_rows_and_of_none(spark):
    df = frame(spark, odd_rows(), extra=True)
    rows = [(r["doc_id"], r["text"], r["source"], r["lang"], r["n_chars"]) for r in rows_of(df)] * 2
    found = rows_of(merkle.manifest(wide(spark, rows)))
    key = lambda doc_id, leaf, subroot, root: (str(doc_id), leaf, subroot, root)
    assert sorted(key(r["doc_id"], r["leaf"], r["subroot"], r["root"]) for r in found) == sorted(key(*r[:4]) for r in plain_manifest(rows))
    once = rows_of(merkle.manifest(df))
    assert len(once) == len(odd_rows()) and len({r["root"] for r in once}) == 1
    assert merkle.manifest(frame(spark, []).limit(0)).count() == 0


def test_tampering_is_found(spark):
    rows = [(i, "t", "s", "en" if i % 3 else None, None if i % 5 == 0 else i) for i in range(300)]
    docs = wide(spark, rows)
    found = merkle.manifest(docs, {"n_chars": F.when(F.col("doc_id") % 7 == 0, F.col("n_chars") + 1).otherwise(F.col("n_chars"))})
    for r in rows_of(found.withColumn("folded", merkle.folded(F.col("claimed"), F.col("path"))).withColumn("proof", merkle.proof(F.col("path")))):
        touched = r["doc_id"] % 7 == 0 and r["doc_id"] % 5
        assert (r["folded"] == r["root"]) != bool(touched)
        assert r["proof"] == sha("".join(s["sibling"] for s in r["path"] if s["sibling"]))


# Audit


@pytest.mark.parametrize("n, shards", [(0, 1), (1, 1), (2, 3), (50, 4), (5000, 7)])
def test_perfect_hash_is_minimal_and_knows_its_terms(n, shards):
    words = [f"term{i}".encode() for i in range(n)]
    of = divergence.shard_of(divergence.term_hashes(words), shards)
    lookup = Lookup.of([perfect_hash([w for w, s in zip(words, of.tolist()) if s == k]) for k in range(shards)])
    assert len(lookup) == n and sorted(lookup.slots(words).tolist()) == list(range(n))
    assert all(lookup.words[s].as_py() == w for w, s in zip(words, lookup.slots(words).tolist()))
    assert set(lookup.slots([b"other%d" % i for i in range(3000)]).tolist()) == {-1}


def test_terms_of_equal_hash_are_told_apart(monkeypatch):
    monkeypatch.setattr(divergence, "term_hashes", lambda words: np.array([len(w) << 32 for w in words], np.uint64))
    lookup = Lookup.of([perfect_hash([b"ab", b"cd", b"efg"]), perfect_hash([])])
    assert sorted(lookup.slots([b"ab", b"cd", b"efg"]).tolist()) == [0, 1, 2] and lookup.slots([b"xy", b"xyz"]).tolist() == [-1, -1]


def plain_audit(rows, least=3, top=200):
    """Rows of the report from (lang, source, text)."""
    rows = [((lang or ""), (source or ""), re.findall("[^\x00-\x40\x5b-\x60\x7b-\x7f]+", lower(text))) for lang, source, text in rows]
    seen = Counter((lang, t) for lang, _, ts in rows for t in set(ts))
    for lang in {r[0] for r in rows}:
        kept = [t for (g, t), n in seen.items() if g == lang and n >= least]
        groups = {s: Counter() for g, s, _ in rows if g == lang}
        for g, s, ts in rows:
            if g == lang:
                groups[s].update(t for t in ts if seen[lang, t] >= least)
        share = lambda c: {t: 1 + 10**9 * (c[t] + 1) // (sum(c.values()) + len(kept)) for t in kept}
        p, q = {s: share(c) for s, c in groups.items()}, share(sum(groups.values(), Counter()))
        for s, c in groups.items():
            pairs = [(-sum((p[s][t] - p[o][t]) ** 2 // p[o][t] for t in kept), o.encode(), o) for o in groups if o != s]
            more = [(-((p[s][t] - q[t]) ** 2 // q[t]), t.encode(), t) for t in kept if c[t] and p[s][t] > q[t]]
            for part, found in (("pair", pairs), ("term", sorted(more)[:top])):
                for rank, (value, _, item) in enumerate(sorted(found), 1):
                    yield lang, s, part, item, -value, rank


def audit_rows(df, **options):
    return in_order((r["lang"], r["source"], r["part"], r["item"], r["value"], r["rank"]) for r in rows_of(divergence.audit(df, **options)))


def texts(n=120):
    return [(i, " ".join(f"{'Wörd' if k % 3 else 'term'}{chr(97 + k % 7)}{chr(97 + (i * k) % 11)}" for k in range(i % 40)), f"s{i % 5}", f"l{i % 2}") for i in range(n)]


@pytest.mark.parametrize("limit", [divergence.BROADCAST_BYTES, 0])
def test_audit_equals_a_plain_recount(spark, limit):
    rows = texts() + [(900, "one", "alone", "xx"), (901, None, "none", "xx"), (902, "1 2 3", None, None)]
    assert audit_rows(frame(spark, rows), limit=limit) == in_order(plain_audit([(r[3], r[2], r[1]) for r in rows]))


def test_audit_of_many_shards_and_blocks_of_sources(spark, monkeypatch):
    monkeypatch.setattr(divergence, "SHARD", 5)
    monkeypatch.setattr(divergence, "BLOCK", 2)
    rows = texts()
    assert audit_rows(frame(spark, rows), top=3) == in_order(plain_audit([(r[3], r[2], r[1]) for r in rows], top=3))


def test_audit_of_odd_rows_and_of_none(spark):
    rows = odd_rows() * 3
    own = [(r[3] if len(r) > 3 else "en", r[2] if len(r) > 2 else "s", r[1]) for r in rows]
    assert audit_rows(frame(spark, rows, extra=True)) == in_order(plain_audit(own))
    assert audit_rows(frame(spark, []).limit(0)) == []


def test_tampered_rows_are_those_whose_checksum_seven_divides(spark, sf_dir):
    found = rows_of(queries.QUERIES["op13_merkle_manifest"](spark, sf_dir))
    assert all(r["verified"] != (zlib.crc32(str(r["doc_id"]).encode()) % 7 == 0) for r in found)


# Pages


def plain_article(page):
    """The article of pages as the test table has them: tags of blocks part it, all others are dropped."""
    inner = re.search("<article>(.*?)</article>", page, re.S)[1]
    parts = re.split("</?(?:p|h1)[^>]*>", re.sub("<br>", " ", re.sub("</?b>", "", inner)))
    return "\n\n".join(x for p in parts if (x := " ".join(html.unescape(p).split())))


def test_all_articles_of_the_pages_are_found_whole(spark, sf_dir):
    pages = {r["page_id"]: r["html"] for r in rows_of(spark.read.parquet(f"{sf_dir}/pages.parquet"))}
    found = rows_of(queries.QUERIES["op11_html_text"](spark, sf_dir))
    assert len(found) == len(pages)
    for r in found:
        assert r["text"] == plain_article(pages[r["page_id"]]) and r["n_chars"] == len(r["text"])


TEXT = "Some words of a paragraph that goes on for a while, as they do in prose."


@pytest.mark.parametrize(
    "page, text",
    [
        ("", ""), ("   \n", ""), ("<!-- cut off <p>x", ""), ("<script>var a = '<p>no</p>'", ""), ("<nav><a href=x>Menu</a></nav>", ""),
        (f"<article><p>{TEXT}<p>Two.</article>", f"{TEXT}\n\nTwo."),
        (f"<main><header><h1>T &amp; t</h1></header><p>a\n  &lt;b&gt;&#33;&eacute;</p>{TEXT}</main>", f"T & t\n\na <b>!é\n\n{TEXT}"),
        (f"<header><h1>Site</h1></header><article>{TEXT}<aside>by the way</aside><p>x</p></article><footer>end</footer>", f"{TEXT}\n\nx"),
        (f"<article><p>{TEXT}</p><section class='reader comments'><p>{TEXT}</p></section></article>", TEXT),
        (f"<div class=cookie-notice>{TEXT}</div><div id='main-content'><p>{TEXT}</p><form><label>Mail</label><p>{TEXT}</p></form></div>", TEXT),
        (f"<article><p>{TEXT}</p><div class='ad'>{TEXT}</div><p hidden>no</p><ul><li>one</li><li>two</li></ul></article>", f"{TEXT}\n\none\n\ntwo"),
        (f"<div><a href=/>Home</a></div><div><a href=/a>News</a></div><div>{TEXT} {TEXT}</div><div>{TEXT}</div>", f"{TEXT} {TEXT}\n\n{TEXT}"),
        ("<ARTICLE><P TITLE='a > b'>x</P><STYLE>p{}</STYLE></ARTICLE>", "x"),
        (f"<article><p>See <a href=x>this</a> and <a href=y>that one</a></p><p>{TEXT}</p></article>", f"See this and that one\n\n{TEXT}"),
    ],
)
def test_pages_of_other_makes(page, text):
    assert html_blocks.main_text(page)[0] == text


def test_tree_is_the_best_split_at_each_node_by_search():
    x, y = np.array(html_blocks.LABELLED, float)[:, :-1], np.array(html_blocks.LABELLED, float)[:, -1]

    def impurity(part):
        return 2 * len(part) * part.mean() * (1 - part.mean()) if len(part) else 0.0

    def check(node, x, y):
        options = [impurity(y[x[:, f] <= v]) + impurity(y[x[:, f] > v]) for f in range(x.shape[1]) for v in np.unique(x[:, f])[:-1]]
        if node.feature < 0:
            assert node.share == y.mean()
            return
        low = x[:, node.feature] <= node.at
        assert impurity(y[low]) + impurity(y[~low]) == pytest.approx(min(options))
        check(node.left, x[low], y[low])
        check(node.right, x[~low], y[~low])

    check(html_blocks.trained(), x, y)
    assert ((html_blocks.shares(html_blocks.trained(), x) > 0.5) == y).all()


def test_links_and_neighbours_are_features():
    found = html_blocks.blocks("<nav><a>one two</a> three</nav><p>four</p>")
    assert html_blocks.features(found).tolist() == [[3, 2 / 3, 0, 0, 1, 0, 1, 0, 0], [1, 0, 3, 2 / 3, 0, 0, 0, 0, 0]]


def test_pages_null_long_repeated_and_none(spark):
    page = f"<article><p>{LONG}</p></article>"
    rows = [(1, "u", None), (2, None, ""), (3, "u", page), (3, "u", page), (None, "u", "<p" * 20_000), (4, "u", "<a title='" * 5_000)]
    df = spark.createDataFrame(rows, "page_id long, url string, html string").selectExpr("*", "1 as text", "2 as n_chars", "3 as _0")
    found = rows_of(html_blocks.extract(df))
    assert sorted((str(r["page_id"]), str(r["url"]), r["n_chars"]) for r in found if r["page_id"] in (1, 2, 3)) == sorted(
        (str(i), str(u), len(LONG) if h else 0) for i, u, h in rows if i in (1, 2, 3)
    )
    assert len(found) == len(rows) and html_blocks.extract(df.limit(0)).count() == 0
