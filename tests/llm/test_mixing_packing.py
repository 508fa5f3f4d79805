"""Mixing to target weights and packing."""

import zlib
from collections import defaultdict

import numpy as np
import pytest
from helpers import LONG, frame, odd_rows, rows_of, words

from docmeld.llm import mixing, packing
from docmeld.llm.queries import PACKING_VOCABULARY, vocabulary

WEIGHTS = (5, 2, 1)


def plain_targets(rows):
    size = defaultdict(int)
    for r in rows:
        size[r[2]] += len(words(r[1]))
    order = sorted((s for s in size if s is not None), key=lambda s: [ord(c) for c in s]) + ([None] if None in size else [])
    weight = {s: WEIGHTS[i % 3] for i, s in enumerate(order)}
    target, left, free = {}, 1.5 * sum(size.values()), set(order)
    while free:
        each = {s: left * weight[s] / sum(weight[x] for x in free) for s in free}
        above = {s for s in free if each[s] >= 2 * size[s]}
        if not above:
            target |= each
            break
        for s in above:
            target[s] = 2.0 * size[s]
            left -= target[s]
        free -= above
    return size, target


def test_targets_of_odd_rows(spark):
    rows = odd_rows()
    size, target = plain_targets(rows)
    source = {(r[0], len(words(r[1]))): r[2] for r in rows}
    found = rows_of(mixing.mix(frame(spark, rows, extra=True)))
    assert len(found) == len(rows)
    for r in found:
        s = source[r["doc_id"], r["size"]]
        assert r["source_size"] == size[s] and r["target"] == pytest.approx(target[s])
        assert 0 <= r["copies"] <= 2


def test_sources_come_near_their_targets_and_reruns_agree(spark):
    rows = [(i, "w " * (20 + i % 30), f"s{min(i % 11, 7)}") for i in range(3000)]
    found = rows_of(mixing.mix(frame(spark, rows, 6)))
    size, target = plain_targets(rows)
    taken = defaultdict(int)
    for r in found:
        taken[rows[r["doc_id"]][2]] += r["copies"] * r["size"]
    assert all(abs(taken[s] - target[s]) <= 0.1 * target[s] for s in size)
    again = {r["doc_id"]: r["copies"] for r in rows_of(mixing.mix(frame(spark, rows, 2)))}
    assert again == {r["doc_id"]: r["copies"] for r in found}


def test_mixed_documents_repeat_whole_rows(spark):
    rows = [r for r in odd_rows() if r[0] is not None and r[0] != 7]
    df = frame(spark, rows, extra=True)
    out = mixing.mixed_documents(df)
    assert out.columns == df.columns
    copies = {r["doc_id"]: r["copies"] for r in rows_of(mixing.mix(df))}
    counts = defaultdict(int)
    for r in rows_of(out):
        counts[r["doc_id"]] += 1
        assert r["text"] == next(x[1] for x in rows if x[0] == r["doc_id"])
    assert {k: v for k, v in copies.items() if v} == dict(counts)


def test_mix_without_documents_or_words(spark):
    assert mixing.mix(frame(spark, [])).count() == 0
    assert [(r["size"], r["target"], r["copies"]) for r in rows_of(mixing.mix(frame(spark, [(1, " "), (2, None)])))] == [(0, 0.0, 0)] * 2


@pytest.fixture(scope="module")
def tokenizer():
    from tokenizers import Tokenizer

    return Tokenizer.from_file(vocabulary(PACKING_VOCABULARY))


TEXTS = [
    "", " ", "Plain words, here. And more!?", "ÀB́é İstanbul ΣΑΣ ß's don't it's 12a,b x", "end <|endoftext|> here", "a b\x1cc", "é... ÿŸ ÷×", "日本語 テスト", "a" * 3000,
    "x'll y'Re 'tis", "\x00\x01 \x7f", "ﬁ ½ Ⅷ ǆ",
]


def test_word_ids_are_the_tokenizers(tokenizer):
    ids = packing.WordIds(vocabulary(PACKING_VOCABULARY))
    assert ids.plain
    got = [np.frombuffer(b, "<u4").tolist() for b in ids([t.encode() for t in TEXTS] * 2)]
    assert got == [tokenizer.encode(t, add_special_tokens=False).ids for t in TEXTS] * 2


def test_words_are_forgotten_without_change(tokenizer, monkeypatch):
    monkeypatch.setattr(packing, "MEMORY_WORDS", 3)
    ids = packing.WordIds(vocabulary(PACKING_VOCABULARY))
    for t in TEXTS + TEXTS:
        assert np.frombuffer(ids([t.encode()])[0], "<u4").tolist() == tokenizer.encode(t, add_special_tokens=False).ids


@pytest.mark.parametrize("group_pieces", [7, 100_000])
def test_pieces_and_places(spark, tokenizer, group_pieces):
    rows = odd_rows() + [(100 + i, t) for i, t in enumerate(TEXTS)] + [(200 + i, "some words " * (i * 7 % 60)) for i in range(60)]
    capacity = 64
    found = rows_of(packing.best_fit(frame(spark, rows, extra=True), vocabulary(PACKING_VOCABULARY), capacity, group_pieces=group_pieces))
    expected = []
    for i, t, *_ in rows:
        ids = np.array(tokenizer.encode(t or "", add_special_tokens=False).ids + [0], "<u4")
        expected += [(i, k, at, len(p := ids[at : at + capacity]), zlib.crc32(p.tobytes())) for k, at in enumerate(range(0, len(ids), capacity))]
    assert sorted(((r["doc_id"], r["piece"], r["start"], r["length"], r["ids_crc32"]) for r in found), key=str) == sorted(expected, key=str)
    by = defaultdict(list)
    for r in found:
        by[r["sequence_id"]].append((r["offset"], r["length"]))
    for parts in by.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= capacity
    least = -(-sum(r["length"] for r in found) // capacity)
    assert len(by) <= (1.02 if group_pieces > 1000 else 1.3) * least + 1


def test_packing_nothing(spark):
    assert packing.best_fit(frame(spark, []), vocabulary(PACKING_VOCABULARY)).count() == 0


def plain_sum_of_squares(lengths, capacity):
    bins, out = [], []
    for s in lengths:
        def total(fill):
            gaps = defaultdict(int)
            for f in fill:
                if f < capacity:
                    gaps[capacity - f] += 1
            return sum(n * n for n in gaps.values())

        choices = [(total(bins[:b] + [f + s] + bins[b + 1 :]), capacity - f, b) for b, f in enumerate(bins) if f + s <= capacity]
        best = min(choices, default=None)
        if best and best[0] <= total([*bins, s]):
            # of open bins with the gap, any will do
            out.append(best[:2])
            bins[best[2]] += s
        else:
            out.append((total([*bins, s]), None))
            bins.append(s)
    return sorted(bins)


def test_sum_of_squares_places_like_the_definition():
    rng = np.random.default_rng(4)
    for _ in range(30):
        lengths = rng.integers(1, 13, 60)
        bins = packing.sum_of_squares(lengths, 12)
        assert sorted(np.bincount(bins, lengths).astype(int).tolist()) == plain_sum_of_squares(lengths.tolist(), 12)


def test_long_text_is_cut_into_pieces(spark):
    found = rows_of(packing.best_fit(frame(spark, [(1, LONG)]), vocabulary(PACKING_VOCABULARY)))
    assert sorted(r["piece"] for r in found) == list(range(len(found))) and sum(r["length"] < 2048 for r in found) <= 1
