"""Sets of hashed word shingles, and keys by which similar sets must meet."""

from __future__ import annotations

import hashlib
import math
from functools import cache
from typing import NamedTuple

import numpy as np

from docmeld.llm.common import remembers

#: Sets up to this size meet by their smallest hashes, larger ones by equal segments.
SMALL = 32
#: Words whose hashes a worker remembers; frequent ones are soon back after it forgets.
KNOWN_WORDS = 50_000
_STEP = 1.4
_M1, _M2 = np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB)
_known: dict[bytes, int] = {}
remembers("shingles", _known.clear)


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers that spreads their bits."""
    x = (x ^ (x >> np.uint64(30))) * _M1
    x = (x ^ (x >> np.uint64(27))) * _M2
    return x ^ (x >> np.uint64(31))


def word_hashes(words: list[bytes]) -> np.ndarray:
    from xxhash import xxh64_intdigest

    if len(_known) > KNOWN_WORDS:
        _known.clear()
    get = _known.get
    out = list(map(get, words))
    if None in out:
        for i, h in enumerate(out):
            if h is None:
                out[i] = _known[words[i]] = xxh64_intdigest(words[i])
    return np.array(out, np.uint64)


def shingle_set(text: bytes, size: int) -> np.ndarray:
    """Sorted distinct hashes of the runs of ``size`` words of a text with A-Z in lower case; with fewer words, of all of them."""
    words = text.lower().split()
    if not words:
        return np.empty(0, np.uint64)
    h, k = word_hashes(words), min(size, len(words))
    runs = np.full(len(h) - k + 1, k, np.uint64)
    for j in range(k):
        runs = mix(runs + h[j : len(h) - k + 1 + j])
    runs.sort()
    return runs[np.concatenate(([True], runs[1:] != runs[:-1]))]


def digest(hashes: np.ndarray) -> int:
    """A set's identity."""
    return int.from_bytes(hashlib.blake2b(hashes.tobytes(), digest_size=8).digest(), "big", signed=True)


class Level(NamedTuple):
    """Sizes low .. high of the smaller set of a pair; its linked pairs agree in ``spare + 1`` of ``parts`` segments or more."""

    number: int
    low: int
    high: int
    parts: int
    spare: int
    #: shingles that a segment must hold to be worth a key
    strong: int


def _spare(differ: int, low: int, strong: int) -> int | None:
    """Segments that a set of the level may be expected to have with fewer than ``strong`` shingles, if that settles soon."""
    spare = 0
    for _ in range(50):
        parts = differ + 1 + spare
        weak = parts * (1 + (low / parts if strong == 2 else 0)) * math.exp(-low / parts)
        need = math.ceil(weak + 3 * math.sqrt(weak))
        if need <= spare:
            return spare
        if need > 0.4 * (differ + 1) + 6:
            return None
        spare = need
    return spare


@cache
def levels(least: int) -> tuple[Level, ...]:
    """For sets linked by ``least`` per cent of their union.

    Linked sets of sizes a <= b have b <= 100 a / least and differ in at most (a + b) (100 - least) / (100 + least)
    shingles, so of one segment more than that at least one holds the same shingles in both. ``spare`` segments more cover
    those that hold too few shingles to tell much: fewer than two, or none where sets may differ too much for two.
    """
    out, low = [], SMALL + 1
    while low < 1 << 40:
        high = int(low * _STEP)
        differ = (high + 100 * high // least) * (100 - least) // (100 + least)
        spare, strong = _spare(differ, low, 2), 2
        if spare is None:
            spare, strong = _spare(differ, low, 1) or 0, 1
        out.append(Level(len(out) + 1, low, high, differ + 1 + spare, spare, strong))
        low = high + 1
    return tuple(out)


def keys(hashes: np.ndarray, least: int) -> np.ndarray:
    """Keys of a set, of which linked sets share at least one.

    Up to ``SMALL`` shingles: the smallest hashes, as many as may be missing in the other set and one more. Above: per
    segment of the hash range, its number and the sum of its mixed hashes. Segments of fewer than ``strong`` shingles are
    left out, unless there are more of them than the level has to spare: a pair that agrees in ``spare + 1`` segments or
    more agrees in a strong one, or both sets have too many of the others and hand in all of them.
    """
    n, out = len(hashes), []
    if least * n <= 100 * SMALL:
        out.append(mix(hashes[: n - -(-least * n // 100) + 1] ^ np.uint64(0x5851F42D4C957F2D)))
    for level in levels(least):
        if level.low > n:
            break
        if least * n > 100 * level.high and n > level.high:
            continue
        segment = ((hashes >> np.uint64(32)) * np.uint64(level.parts)) >> np.uint64(32)
        sizes = np.bincount(segment.astype(np.int64), minlength=level.parts)
        total = np.concatenate((np.zeros(1, np.uint64), np.cumsum(mix(hashes), dtype=np.uint64)))
        end = np.cumsum(sizes)
        content = total[end] - total[end - sizes]
        number = np.arange(level.parts, dtype=np.uint64) + np.uint64(level.number << 40)
        own = mix(mix(number) + content)
        strong = sizes >= level.strong
        out.append(own if level.parts - strong.sum() > level.spare else own[strong])
    return np.concatenate(out) if out else np.empty(0, np.uint64)
