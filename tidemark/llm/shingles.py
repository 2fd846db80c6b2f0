"""Sets of word shingles, MinHash samples and odd sketches, for many texts at once."""

from __future__ import annotations

from functools import lru_cache

import numpy as np
import pyarrow as pa

from tidemark.llm.common import hashes, inverses, lower, mixed, powers, spans, utf8

#: MinHash samples of a text, at least (see ``layout``); sketches are made of so many.
SAMPLES = 96
#: Samples of a band at most.
ROWS = 4
#: How likely a link at the lowest similarity asked for is missed by all bands, and by its sketches, at most.
MISSED = 2.5e-8
#: Bits of an odd sketch.
BITS = 512


@lru_cache
def layout(percent: int) -> tuple[int, int, int]:
    """For links of ``percent`` of 100 or more: how many samples a text has, how many of them make a band, and the number
    of differing bits up to which a pair of odd sketches may be a link."""
    if not 1 <= percent <= 100:
        raise ValueError(f"percent has to be from 1 to 100, not {percent}")
    p = percent / 100
    missed = lambda rows: (1 - p**rows) ** (SAMPLES // rows)
    rows = next((r for r in range(ROWS, 1, -1) if missed(r) <= MISSED), 1)
    count = SAMPLES if missed(rows) <= MISSED else int(np.ceil(np.log(MISSED) / np.log1p(-p)))
    # samples that differ put two marks each on the bits; how many bits have an odd number of them, by number of marks
    bits = np.arange(BITS + 1)
    odd, total, chance = np.zeros(BITS + 1), np.zeros(BITS + 1), p**SAMPLES
    odd[0] = 1.0
    for differing in range(SAMPLES + 1):
        total += chance * odd
        chance *= (SAMPLES - differing) / (differing + 1) * (1 - p) / p
        for _ in range(2):
            up, down = odd * (BITS - bits) / BITS, odd * bits / BITS
            odd = np.concatenate([[0], up[:-1]]) + np.concatenate([down[1:], [0]])
    beyond = np.cumsum(total[::-1])[::-1]  # so many bits or more
    return count, rows, int(np.flatnonzero(beyond > MISSED)[-1])


@lru_cache
def _orders(count: int) -> tuple[np.ndarray, np.ndarray]:
    factors = (mixed(np.arange(1, count + 1, dtype=np.uint64) * np.uint64(0xD1342543DE82EF95)) | np.uint64(1)).astype(np.uint32)
    return factors, mixed(np.arange(1001, 1001 + count, dtype=np.uint64)).astype(np.uint32)


def shingle_sets(column: pa.Array, size: int = 5) -> tuple[np.ndarray, np.ndarray]:
    """The sorted, distinct shingles of each text, one after the other, and where each text's begin (and the last ends).

    A shingle is ``size`` words in a row, A to Z in lower case, or all words of a text with fewer; texts without words have none.
    """
    data, offsets = utf8(column)
    data = lower(data)
    start, end, first = spans(data, offsets)
    words = mixed(hashes(data, start, end))
    n = np.diff(first)
    each = np.where(n >= size, n - size + 1, np.minimum(n, 1))
    begins = np.concatenate([[0], np.cumsum(each)])
    at = np.repeat(first[:-1] - begins[:-1], each) + np.arange(begins[-1])
    stop = at + np.repeat(np.minimum(n, size), each)
    sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(words * powers(len(words)))])
    all_shingles = mixed((sums[stop] - sums[at]) * inverses(len(words) + 1)[at] + (stop - at).astype(np.uint64))
    sets = [all_shingles[i:j] for i, j in zip(begins[:-1].tolist(), begins[1:].tolist(), strict=True)]
    sets = [np.unique(s) if len(s) > 1 else s for s in sets]
    ends = np.cumsum([0, *map(len, sets)])
    return (np.concatenate(sets) if sets else np.zeros(0, np.uint64)), ends


def digests(sets: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Two 64-bit numbers for each set, equal for equal sets."""
    out = np.zeros((2, len(ends) - 1), np.uint64)
    for i, salt in enumerate((0x1234567, 0x89ABCDEF)):
        sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(mixed(sets ^ np.uint64(salt)))])
        out[i] = mixed(sums[ends[1:]] - sums[ends[:-1]] + np.diff(ends).astype(np.uint64))
    return out


def samples(sets: np.ndarray, ends: np.ndarray, count: int = SAMPLES) -> np.ndarray:
    """MinHash: for each of ``count`` orders of all shingles, the first one of each set (sets may not be empty)."""
    out = np.zeros((count, len(ends) - 1), np.uint32)
    factors, salts = _orders(count)
    if len(sets):
        # halves apart, so that an order depends on all 64 bits
        low, high = sets.astype(np.uint32), (sets >> np.uint64(32)).astype(np.uint32)
        for i in range(count):
            out[i] = np.minimum.reduceat((low ^ salts[i]) * factors[i] + high, ends[:-1])
    return out


def bands(found: np.ndarray, rows: int = ROWS) -> np.ndarray:
    """A key for each band, of ``rows`` samples, and text."""
    out = np.zeros((len(found) // rows, found.shape[1]), np.uint64)
    for i in range(len(out)):
        key = np.full(found.shape[1], i + 1, np.uint64)
        for row in found[i * rows : (i + 1) * rows]:
            key = mixed(key * np.uint64(0x9E3779B97F4A7C15) + row)
        out[i] = key
    return out


def odd_sketches(found: np.ndarray) -> np.ndarray:
    """Each text's samples folded into a bitmap by parity: bit b is set if an odd number of samples fall on b. Two bitmaps
    differ in the bits on which the samples that only one text has fall an odd number of times."""
    texts = np.arange(found.shape[1])
    bits = np.zeros((found.shape[1], BITS), np.uint8)
    for i in range(SAMPLES):
        bits[texts, (mixed(found[i].astype(np.uint64) + np.uint64((i + 1) << 32)) % np.uint64(BITS)).astype(np.int64)] ^= 1
    return np.packbits(bits, axis=1)


def parities(sets: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Each whole set folded into a bitmap by parity. Two of them differ in at most as many bits as shingles are in one set
    only, so they can rule a pair out for sure."""
    n = len(ends) - 1
    place = np.repeat(np.arange(n) * BITS, np.diff(ends)) + (sets % np.uint64(BITS)).astype(np.int64)
    return np.packbits((np.bincount(place, minlength=n * BITS) & 1).astype(np.uint8).reshape(n, BITS), axis=1)


def estimate(differing: np.ndarray | int) -> np.ndarray:
    """The similarity that so many differing bits tell of."""
    left = np.maximum(1 - 2 * np.asarray(differing, float) / BITS, 1e-9)
    return 1 + BITS / (4 * SAMPLES) * np.log(left)
