"""Counting quotient filters as plain arrays.

A filter holds fingerprints, ``BITS`` bits unless said otherwise, with counts. The upper bits of a fingerprint, its quotient, are not
stored: one bit per quotient says that it occurs, one bit per entry that it ends its quotient's run, and the
entries of a run lie in the order of their remainders. So entries are sorted by fingerprint, decoding gives
every fingerprint back, and merging is a merge of sorted remainders that adds counts and loses nothing.
A filter is made per block, the range of fingerprints that share their uppermost bits.
"""

from __future__ import annotations

import numpy as np

BITS = 56


def encode(fingerprints: np.ndarray, counts: np.ndarray, low_bits: int) -> dict[str, bytes | int]:
    """Filter of one block. ``fingerprints``: sorted, distinct, below ``2**low_bits``."""
    n = len(fingerprints)
    quotient_bits = min(low_bits, max(1, int(n).bit_length()))
    shift = np.uint64(low_bits - quotient_bits)
    quotients = fingerprints >> shift
    occupied = np.zeros(1 << quotient_bits, bool)
    occupied[quotients.astype(np.int64)] = True
    ends = np.empty(n, bool)
    ends[:-1], ends[-1:] = quotients[1:] != quotients[:-1], True
    remainders = fingerprints & np.uint64((1 << int(shift)) - 1)
    width = np.uint32 if shift <= 32 else np.uint64
    return {
        "quotient_bits": quotient_bits,
        "occupied": np.packbits(occupied).tobytes(),
        "ends": np.packbits(ends).tobytes(),
        "remainders": remainders.astype(width).tobytes(),
        "counts": counts.astype(np.uint64).tobytes() if n and counts.max() >= 1 << 16 else counts.astype(np.uint16).tobytes(),
    }


def decode(f: dict[str, bytes | int], low_bits: int) -> tuple[np.ndarray, np.ndarray]:
    """The sorted fingerprints of a filter and their counts."""
    quotient_bits = f["quotient_bits"]
    shift = low_bits - quotient_bits
    remainders = np.frombuffer(f["remainders"], np.uint32 if shift <= 32 else np.uint64).astype(np.uint64)
    n = len(remainders)
    counts = np.frombuffer(f["counts"], np.uint16 if len(f["counts"]) == 2 * n else np.uint64).astype(np.int64)
    ends = np.unpackbits(np.frombuffer(f["ends"], np.uint8), count=n).astype(bool)
    quotients = np.flatnonzero(np.unpackbits(np.frombuffer(f["occupied"], np.uint8), count=1 << quotient_bits)).astype(np.uint64)
    run = np.cumsum(ends) - ends  # the run that each entry belongs to
    return (quotients[run] << np.uint64(shift)) | remainders, counts


def add_up(fingerprints: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Sort by fingerprint and add the counts of equal ones. Sorted pieces laid end to end are merged, not sorted anew."""
    if not len(fingerprints):
        return fingerprints, counts
    order = np.argsort(fingerprints, kind="stable")
    fingerprints, counts = fingerprints[order], counts[order]
    first = np.flatnonzero(np.concatenate(([True], fingerprints[1:] != fingerprints[:-1])))
    return fingerprints[first], np.add.reduceat(counts, first)


def merge(filters: list[dict], low_bits: int) -> tuple[np.ndarray, np.ndarray]:
    parts = [decode(f, low_bits) for f in filters]
    return add_up(np.concatenate([p[0] for p in parts]), np.concatenate([p[1] for p in parts]))
