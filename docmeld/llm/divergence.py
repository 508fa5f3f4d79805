"""How the sources of a language differ in their words: a recount through minimal perfect hashes.

The first pass counts exactly in how many documents of a language each term occurs and keeps those in ``least`` or more.
The kept terms are dealt into shards by their hash, and each shard gets a minimal perfect hash: every kept term has a slot of
its own, without gaps. The second pass reads the texts again and adds into dense arrays, one per group and shard, at the
slot of each term; the hash would give any other term some slot too, so the term stored there is compared byte by byte.

The shards are broadcast while they fit ``BROADCAST_BYTES``. Vocabularies beyond that are not sent anywhere: counts per
term are then brought to the shard's table by a join, which gives the same slots.
"""

from __future__ import annotations

import re
from collections import Counter, defaultdict
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window, functions as F

from docmeld.llm.common import checked_broadcast, chunks, text_bytes
from docmeld.llm.shingles import mix
from docmeld.workspace import Workspace

#: Documents of a language that a term must occur in, and the ranks of terms in the report.
LEAST, TOP = 3, 200
SCALE = 1_000_000_000
#: Terms of a shard, about.
SHARD = 4_096
#: Bits for each term that is still to be placed at a level of a perfect hash, and the number of levels.
GAMMA, LEVELS = 2, 24
#: All shards together are broadcast up to this size.
BROADCAST_BYTES = 64 << 20
#: Counts that a task holds before it hands them over.
HELD_TERMS, HELD_BYTES = 300_000, 96 << 20
#: Sources of a language whose counts are compared together.
BLOCK = 128
_TERM = re.compile(rb"[A-Za-z\x80-\xff]+")
_SEEDS = mix(np.arange(1, LEVELS + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15))


def terms(text: bytes) -> list[bytes]:
    """Runs of letters A-Z and of characters beyond ASCII, A-Z in lower case."""
    return _TERM.findall(text.lower())


def term_hashes(words: list[bytes]) -> np.ndarray:
    from xxhash import xxh64_intdigest

    return np.fromiter((xxh64_intdigest(w) for w in words), np.uint64, len(words))


def shard_of(hashes: np.ndarray, shards: int) -> np.ndarray:
    return (((hashes >> np.uint64(32)) * np.uint64(shards)) >> np.uint64(32)).astype(np.int64)


class Shard(NamedTuple):
    """A minimal perfect hash of n terms: the bits of its levels, and the terms by slot.

    A level is a row of bits: terms whose place in it no other term has are settled there, the others go on to the next one.
    The slot of a settled term is the number of bits before its own. Terms that are left after all levels, as terms of
    equal hash would be, take the last slots and are looked up by name.
    """

    sizes: list[int]
    bits: np.ndarray
    words: list[bytes]


def perfect_hash(words: list[bytes]) -> Shard:
    left, hashes = np.arange(len(words)), term_hashes(words)
    sizes, levels, order = [0] * LEVELS, [np.zeros(0, bool)], []
    for level, seed in enumerate(_SEEDS):
        if not len(left):
            break
        sizes[level] = GAMMA * len(left)
        at = (mix(hashes[left] ^ seed) % np.uint64(sizes[level])).astype(np.int64)
        alone = np.bincount(at, minlength=sizes[level]) == 1
        levels.append(alone)
        settled = alone[at]
        order += left[settled][np.argsort(at[settled])].tolist()
        left = left[~settled]
    return Shard(sizes, np.concatenate(levels), [words[i] for i in order + left.tolist()])


class Lookup:
    """The shards of a language in the order of their numbers; slots go on from shard to shard."""

    def __init__(self, sizes: np.ndarray, bits: np.ndarray, counts: np.ndarray, words: pa.Array):
        """Sizes of the levels and number of terms by shard, all bits and all terms in order."""
        self.sizes, self.bits, self.words = sizes, bits, words
        ends = np.cumsum(sizes, axis=1)
        shard_bits = np.concatenate(([0], np.cumsum(ends[:, -1])))
        self.starts = shard_bits[:-1, None] + ends - sizes
        before = np.concatenate(([0], np.cumsum(bits, dtype=np.int64)))
        first = np.concatenate(([0], np.cumsum(counts)))
        # bits count settled terms only: what a shard's rest adds shifts all shards after it
        settled = before[shard_bits[1:]] - before[shard_bits[:-1]]
        self.shift = first[:-1] - before[shard_bits[:-1]]
        self.before = before.astype(np.int32)
        rest = [i for a, n, c in zip(first[:-1].tolist(), settled.tolist(), counts.tolist()) for i in range(a + n, a + c)]
        self.rest = {words[i].as_py(): i for i in rest}

    @classmethod
    def of(cls, shards: list[Shard]) -> Lookup:
        words = pa.array([w for s in shards for w in s.words], pa.binary())
        counts = np.array([len(s.words) for s in shards], np.int64)
        return cls(np.array([s.sizes for s in shards], np.int64).reshape(-1, LEVELS), np.concatenate([s.bits for s in shards]), counts, words)

    def __len__(self) -> int:
        return len(self.words)

    def slots(self, words: list[bytes]) -> np.ndarray:
        """The slot of each term, -1 for terms that are none of those stored."""
        hashes, found = term_hashes(words), np.full(len(words), -1, np.int64)
        shard, open_ = shard_of(hashes, len(self.sizes)), np.arange(len(words))
        for level, seed in enumerate(_SEEDS):
            size = self.sizes[shard[open_], level]
            open_, size = open_[size > 0], size[size > 0]
            if not len(open_):
                break
            own = shard[open_]
            at = self.starts[own, level] + (mix(hashes[open_] ^ seed) % size.astype(np.uint64)).astype(np.int64)
            hit = self.bits[at]
            found[open_[hit]] = self.before[at[hit]] + self.shift[own[hit]]
            open_ = open_[~hit]
        hit = np.flatnonzero(found >= 0)
        same = pc.equal(self.words.take(pa.array(found[hit])), pa.array([words[i] for i in hit.tolist()], pa.binary()))
        found[hit[~same.to_numpy(zero_copy_only=False)]] = -1
        if self.rest:
            for i in np.flatnonzero(found < 0).tolist():
                found[i] = self.rest.get(words[i], -1)
        return found


def lookups(shards: pa.Table) -> dict[str, Lookup]:
    """Lookups by language from rows (lang, shard, sizes, bits, words)."""
    shards, out = shards.sort_by([("lang", "ascending"), ("shard", "ascending")]), {}
    names = np.array(shards["lang"].to_pylist(), object)
    for lang in sorted(set(names.tolist())):
        own = shards.filter(pa.array(names == lang))
        sizes = np.array(own["sizes"].to_pylist(), np.int64).reshape(-1, LEVELS)
        bits = [np.unpackbits(np.frombuffer(b, np.uint8))[:n].astype(bool) for b, n in zip(own["bits"].to_pylist(), sizes.sum(1).tolist())]
        words = pa.concat_arrays([c.flatten() for c in own["words"].chunks])
        out[lang] = Lookup(sizes, np.concatenate(bits), own["size"].to_numpy(), words)
    return out


def _frequencies(docs: DataFrame) -> DataFrame:
    """(lang, term, n): documents of the language that have the term."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def out() -> pa.RecordBatch:
            rows = [(lang, w, n) for lang, c in held.items() for w, n in c.items()]
            held.clear()
            kinds = {"lang": pa.string(), "term": pa.binary(), "n": pa.int64()}
            return pa.RecordBatch.from_pydict({k: pa.array([r[i] for r in rows], t) for i, (k, t) in enumerate(kinds.items())})

        held: dict[str, Counter] = defaultdict(Counter)
        for batch in batches:
            for part in chunks(batch):
                for lang, text in zip(part["lang"].to_pylist(), text_bytes(part["text"]), strict=True):
                    held[lang].update(set(terms(text)))
                if sum(map(len, held.values())) > HELD_TERMS:
                    yield out()
        yield out()

    found = docs.select("lang", "text").mapInArrow(run, "lang string, term binary, n long")
    return found.groupBy("lang", "term").agg(F.sum("n").alias("n"))


def _sharded(ws: Workspace, kept: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Stored perfect hashes (lang, shard, size, sizes, bits, words), and the vocabulary (lang, term, slot)."""
    sizes = ws.store(kept.groupBy("lang").agg(F.ceil(F.count("*") / SHARD).cast("long").alias("shards")), "languages")
    rows = kept.join(checked_broadcast(sizes, 100), "lang")

    @F.arrow_udf("long")
    def own_shard(term: pa.Array, shards: pa.Array) -> pa.Array:
        hashes = term_hashes(term.to_pylist()) >> np.uint64(32)
        return pa.array(((hashes * shards.to_numpy().astype(np.uint64)) >> np.uint64(32)).astype(np.int64))

    def made(group: pa.Table) -> pa.Table:
        row = perfect_hash(sorted(group["term"].to_pylist()))
        return pa.table({
            "lang": [group["lang"][0].as_py()], "shard": [group["shard"][0].as_py()], "size": [len(group)], "sizes": pa.array([row.sizes], pa.list_(pa.int64())),
            "bits": pa.array([np.packbits(row.bits).tobytes()], pa.binary()), "words": pa.array([row.words], pa.list_(pa.binary())),
        })

    schema = "lang string, shard long, size long, sizes array<long>, bits binary, words array<binary>"
    grouped = rows.withColumn("shard", own_shard("term", "shards")).select("lang", "term", "shard").groupBy("lang", "shard")
    # a shard that no term fell into is there all the same
    every = sizes.select("lang", F.explode(F.sequence(F.lit(0).cast("long"), F.col("shards") - 1)).alias("shard"))
    shards = every.join(ws.store(grouped.applyInArrow(made, schema), "filled"), ["lang", "shard"], "left")
    zeros = F.array_repeat(F.lit(0).cast("long"), LEVELS)
    shards = shards.select(
        "lang", "shard", F.coalesce("size", F.lit(0).cast("long")).alias("size"), F.coalesce("sizes", zeros).alias("sizes"),
        F.coalesce("bits", F.lit(b"")).alias("bits"), F.coalesce("words", F.array().cast("array<binary>")).alias("words"),
    )
    shards = ws.store(shards, "shards")
    # one row for each SHARD terms
    first = F.sum("size").over(Window.partitionBy("lang").orderBy("shard")) - F.col("size")
    words = shards.withColumn("first", first).select("lang", "first", F.posexplode("words").alias("at", "term"))
    return shards, ws.store(words.select("lang", "term", (F.col("first") + F.col("at")).alias("slot")), "vocabulary")


def _recount(docs: DataFrame, shards: DataFrame) -> DataFrame:
    """(lang, source, slot, n) of the kept terms, partial per task, by broadcast perfect hashes."""
    shared = docs.sparkSession.sparkContext.broadcast(shards.toArrow())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tables = lookups(shared.value)
        dense: dict[tuple[str, str], np.ndarray] = {}

        def out() -> Iterator[pa.RecordBatch]:
            for (lang, source), counts in dense.items():
                slots = np.flatnonzero(counts)
                columns = [pa.array([lang], pa.string()).take(pa.array(np.zeros(len(slots), np.int64))), pa.array([source], pa.string()).take(pa.array(np.zeros(len(slots), np.int64)))]
                yield pa.RecordBatch.from_arrays([*columns, pa.array(slots), pa.array(counts[slots].astype(np.int64))], ["lang", "source", "slot", "n"])
            dense.clear()

        for batch in batches:
            for part in chunks(batch):
                counts: dict[str, dict[str, Counter]] = defaultdict(lambda: defaultdict(Counter))
                for lang, source, text in zip(part["lang"].to_pylist(), part["source"].to_pylist(), text_bytes(part["text"]), strict=True):
                    if lang in tables:
                        counts[lang][source].update(terms(text))
                for lang, by_source in counts.items():
                    words = list(set().union(*by_source.values()))
                    slot_of = dict(zip(words, tables[lang].slots(words).tolist()))
                    for source, c in by_source.items():
                        at = np.fromiter(map(slot_of.__getitem__, c), np.int64, len(c))
                        n = np.fromiter(c.values(), np.int64, len(c))
                        if (lang, source) not in dense:
                            dense[lang, source] = np.zeros(len(tables[lang]), np.int32)
                        dense[lang, source][at[at >= 0]] += n[at >= 0].astype(np.int32)
                if sum(a.nbytes for a in dense.values()) > HELD_BYTES:
                    yield from out()
        yield from out()

    return docs.mapInArrow(run, "lang string, source string, slot long, n long")


def _joined_counts(docs: DataFrame, vocabulary: DataFrame) -> DataFrame:
    """The same rows without a broadcast: terms counted per task are brought to the vocabulary."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[tuple[str, str], Counter] = defaultdict(Counter)

        def out() -> pa.RecordBatch:
            rows = [(lang, source, w, n) for (lang, source), c in held.items() for w, n in c.items()]
            held.clear()
            kinds = {"lang": pa.string(), "source": pa.string(), "term": pa.binary(), "n": pa.int64()}
            return pa.RecordBatch.from_pydict({k: pa.array([r[i] for r in rows], t) for i, (k, t) in enumerate(kinds.items())})

        for batch in batches:
            for part in chunks(batch):
                for lang, source, text in zip(part["lang"].to_pylist(), part["source"].to_pylist(), text_bytes(part["text"]), strict=True):
                    held[lang, source].update(terms(text))
                if sum(map(len, held.values())) > HELD_TERMS:
                    yield out()
        yield out()

    found = docs.mapInArrow(run, "lang string, source string, term binary, n long")
    found = found.groupBy("lang", "source", "term").agg(F.sum("n").alias("n"))
    return found.join(vocabulary, ["lang", "term"]).select("lang", "source", "slot", "n")


def _share(count: Column, total: Column, kept: Column) -> Column:
    """p = 1 + floor(SCALE (count + 1) / (total + kept)), exact in whole numbers."""
    whole = (count.cast("decimal(18,0)") + 1) * F.lit(SCALE).cast("decimal(10,0)")
    return F.call_function("div", whole, (total + kept).cast("decimal(18,0)")) + 1


def _pair_sums(counts: DataFrame, groups: DataFrame) -> DataFrame:
    """(lang, a, b, more): summed over the terms that occur in any of the sources compared with them, what the value of
    each pair of sources has beyond that of terms which occur in neither.

    The slots of a language are cut into ranges and its sources into blocks; the counts of a range are compared for one pair
    of blocks at a time, as arrays of sources x terms.
    """
    ranges = F.explode(F.sequence(F.lit(0).cast("long"), F.floor((F.col("kept") - 1) / SHARD)))
    last = F.max("block").over(Window.partitionBy("lang"))
    groups = groups.filter("kept > 0").withColumn("last", last).select("lang", "source", "number", "block", "last", "total", "kept")
    rows = counts.join(groups.select("lang", "source", "number", "block", "last"), ["lang", "source"])
    rows = rows.select("lang", F.floor(F.col("slot") / SHARD).alias("range"), "number", "block", "last", "slot", "n")
    # each source is in each range, with the denominator of its shares where others have a slot
    marks = groups.select("lang", ranges.alias("range"), "number", "block", "last", F.lit(-1).cast("long").alias("slot"), (F.col("total") + F.col("kept")).alias("n"))
    rows = rows.unionByName(marks)
    all_blocks = F.sequence(F.lit(0).cast("long"), F.col("last"))
    cells = F.array_union(
        F.transform(all_blocks, lambda j: F.struct(F.col("block").alias("i"), j.alias("j"))),
        F.transform(all_blocks, lambda i: F.struct(i.alias("i"), F.col("block").alias("j"))),
    )
    one = F.array(F.struct(F.lit(0).cast("long").alias("i"), F.lit(0).cast("long").alias("j")))
    rows = rows.withColumn("cell", F.explode(F.when(F.col("last") == 0, one).otherwise(cells))).select("lang", "range", "cell.i", "cell.j", "number", "slot", "n")

    def share(count: np.ndarray, below: np.ndarray) -> np.ndarray:
        # count below 9 * 10^9 in 64 bits; whole numbers of any size beyond it
        if int(count.max(initial=0)) < 9_000_000_000:
            return 1 + SCALE * (count + 1) // below
        return 1 + (SCALE * (count.astype(object) + 1) // below.astype(object)).astype(np.int64)

    def compare(group: pa.Table) -> pa.Table:
        lang, i, j = group["lang"][0].as_py(), group["i"][0].as_py(), group["j"][0].as_py()
        number, slot, n = (group[c].to_numpy() for c in ("number", "slot", "n"))
        sources, row = np.unique(number, return_inverse=True)
        block, mark = sources // BLOCK, slot < 0
        below = np.zeros(len(sources), np.int64)
        below[row[mark]] = n[mark]
        slots, column = np.unique(slot[~mark], return_inverse=True)
        dense = np.zeros((len(sources), len(slots)), np.int64)
        dense[row[~mark], column] = n[~mark]
        shares = share(dense, below[:, None])
        empty = share(np.zeros(len(sources), np.int64), below)
        out: list[tuple[int, int, int]] = []
        for x in np.flatnonzero(block == i):
            for y in np.flatnonzero(block == j):
                if x != y:
                    with_terms = (shares[x] - shares[y]) ** 2 // shares[y]
                    without = (int(empty[x]) - int(empty[y])) ** 2 // int(empty[y])
                    out.append((int(sources[x]), int(sources[y]), int(with_terms.sum()) - without * len(slots)))
        names = {"a": 0, "b": 1, "more": 2}
        return pa.table({"lang": pa.array([lang] * len(out), pa.string()), **{k: pa.array([o[c] for o in out], pa.int64()) for k, c in names.items()}})

    return rows.groupBy("lang", "range", "i", "j").applyInArrow(compare, "lang string, a long, b long, more long").groupBy("lang", "a", "b").agg(F.sum("more").alias("more"))


def audit(docs: DataFrame, least: int = LEAST, top: int = TOP, limit: int = BROADCAST_BYTES) -> DataFrame:
    """Rows (lang, source, part, item, value, rank) for each group of a language and a source.

    ``part`` ``pair``: how the group's terms are spread compared with each other source of the language, the larger the more;
    ``term``: the ``top`` terms that the group has more of than its language as a whole. Only terms in ``least`` documents
    of the language or more count. All arithmetic is in whole numbers.

    Null text, language or source count as the empty string. A group without terms, and a language without kept terms, has
    its pairs all the same. Rows that repeat an id are documents of their own. Equal values are ranked by item, by bytes. Texts
    are taken whole; other columns of ``docs`` play no part. An empty table gives no rows.
    """
    ws = Workspace(docs.sparkSession)
    own = docs.select(*(F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c) for c in ("lang", "source", "text")))
    kept = ws.store(_frequencies(own).filter(F.col("n") >= least).select("lang", "term"), "kept")
    shards, vocabulary = _sharded(ws, kept)
    size = shards.agg(F.sum(F.octet_length("bits") + F.aggregate("words", F.lit(0).cast("long"), lambda a, w: a + F.octet_length(w) + 4))).first()[0] or 0
    found = _recount(own, shards) if size <= limit else _joined_counts(own, vocabulary)
    # dealt by slot once: for the sums of each group and of the language, and to the terms
    counts = found.repartition("lang", "slot").groupBy("lang", "source", "slot").agg(F.sum("n").alias("n"))
    counts = counts.withColumn("all", F.sum("n").over(Window.partitionBy("lang", "slot"))).join(vocabulary, ["lang", "slot"])
    counts = ws.store(counts, "counts")
    of_lang = shards.groupBy("lang").agg(F.sum("size").alias("kept"))
    totals = counts.groupBy("lang", "source").agg(F.sum("n").alias("total"))
    groups = own.select("lang", "source").distinct().join(totals, ["lang", "source"], "left").join(of_lang, "lang", "left")
    number = F.row_number().over(Window.partitionBy("lang").orderBy("source")).cast("long") - 1
    groups = groups.select("lang", "source", F.coalesce("total", F.lit(0)).alias("total"), F.coalesce("kept", F.lit(0)).alias("kept"), number.alias("number"))
    groups = ws.store(groups.withColumn("block", F.floor(F.col("number") / BLOCK)), "groups")

    # pairs: each ordered pair of sources of a language is a row of the report
    side = lambda s: groups.select("lang", *(F.col(c).alias(f"{s}_{c}") for c in ("source", "total", "kept", "number")))
    sums = ws.store(_pair_sums(counts.select("lang", "source", "slot", "n"), groups), "pair-sums").select("lang", F.col("a").alias("a_number"), F.col("b").alias("b_number"), "more")
    pairs = side("a").join(side("b"), "lang").filter("a_number <> b_number").join(sums, ["lang", "a_number", "b_number"], "left")
    p, q = (_share(F.lit(0), F.col(f"{s}_total"), F.col(f"{s}_kept")) for s in "ab")
    pairs = pairs.withColumns({"p": F.when(F.col("a_kept") > 0, p), "q": F.when(F.col("a_kept") > 0, q)})
    value = F.coalesce(F.col("a_kept") * _distance("p", "q") + F.coalesce("more", F.lit(0)), F.lit(0))
    pairs = pairs.select("lang", F.col("a_source").alias("source"), F.lit("pair").alias("part"), F.col("b_source").alias("item"), value.alias("value"))
    pairs = pairs.withColumn("rank", F.row_number().over(_ranking()))

    # terms: against the language as a whole
    lang_total = groups.groupBy("lang").agg(F.sum("total").alias("lang_total"))
    totals = ws.store(groups.join(lang_total, "lang").select("lang", "source", "total", "kept", "lang_total"), "totals")
    rows = counts.join(checked_broadcast(totals, 150), ["lang", "source"])
    rows = rows.withColumns({"p": _share(F.col("n"), F.col("total"), F.col("kept")), "q": _share(F.col("all"), F.col("lang_total"), F.col("kept"))}).filter("p > q")
    rows = rows.select("lang", "source", F.lit("term").alias("part"), F.col("term").cast("string").alias("item"), _distance("p", "q").alias("value"))
    rows = rows.withColumn("rank", F.row_number().over(_ranking())).filter(F.col("rank") <= top)
    return pairs.unionByName(rows)


def _distance(p: str, q: str) -> Column:
    return F.expr(f"(({p} - {q}) * ({p} - {q})) div {q}")


def _ranking() -> Window:
    return Window.partitionBy("lang", "source").orderBy(F.desc("value"), F.asc("item"))
