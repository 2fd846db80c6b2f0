"""Suffix sorting of many short texts by a difference cover, for arrays.

Suffixes that start at offsets 1 and 2 modulo 3 are sorted by their first three symbols and named by their rank; the names,
written down in order, are a text of two thirds the length, whose suffixes are sorted in the same way. The remaining
suffixes, those at offsets 0, are sorted by one symbol and the rank that follows, and merged. As only prefixes of ``depth`` symbols
matter, the recursion ends as soon as names stand for that many.
"""

from __future__ import annotations

import numpy as np


def _named(*columns: np.ndarray) -> np.ndarray:
    """Ranks of rows by several columns of numbers, equal rows alike, from 1 on."""
    key, top = columns[0].astype(np.int64), int(columns[0].max(initial=0)) + 1
    for column in columns[1:]:
        width = int(column.max(initial=0)) + 1
        if top * width >= 1 << 62:
            key = np.unique(key, return_inverse=True)[1].astype(np.int64)
            top = int(key.max(initial=0)) + 1
        key, top = key * width + column, top * width
    return np.unique(key, return_inverse=True)[1].astype(np.int32) + np.int32(1)


def _below(ranked: np.ndarray, of: np.ndarray) -> np.ndarray:
    """For each of ``of``, how many of ``ranked`` are less."""
    counts = np.bincount(ranked, minlength=int(of.max(initial=0)) + 1)
    return (np.cumsum(counts) - counts).astype(np.int32)[of]


def ranks(symbols: np.ndarray, starts: np.ndarray, depth: int) -> np.ndarray:
    """Each suffix's rank among the suffixes of all texts, by its first ``depth`` symbols at least.

    ``symbols`` holds the texts one after the other, each with a zero at its end that is part of it, other symbols being
    above zero; ``starts`` says where texts begin (and the last ends). Suffixes end with their text.
    """
    n = len(symbols)
    if depth <= 1 or n == 0:
        return _named(symbols) if n else symbols
    lengths = np.diff(starts)
    # numbers of 32 bits: of all that is held at once, these arrays are the most
    residue = ((np.arange(n) - np.repeat(starts[:-1], lengths)) % 3).astype(np.int8)
    last = np.repeat(starts[1:].astype(np.int32), lengths)

    def shifted(values: np.ndarray, by: int) -> np.ndarray:
        out = np.zeros(n, np.int32)
        out[: n - by] = values[by:]
        out[np.arange(by, n + by, dtype=np.int32) >= last] = 0
        return out

    one = shifted(symbols, 1)
    sampled = np.flatnonzero(residue != 0).astype(np.int32)
    names = _named(symbols[sampled], one[sampled], shifted(symbols, 2)[sampled])
    if depth > 3 and len(names) and names.max() < len(names):
        # two texts of names for each text: offsets 1, 4, 7, ... and 2, 5, 8, ...
        half = 2 * np.repeat(np.arange(len(lengths), dtype=np.int32), lengths)[sampled] + (residue[sampled] == 2)
        new_starts = np.concatenate([[0], np.cumsum(np.bincount(half, minlength=2 * len(lengths)) + 1)])
        place = new_starts[half] + (sampled - starts[half >> 1] - residue[sampled]) // 3
        reduced = np.zeros(int(new_starts[-1]), np.int32)
        reduced[place] = names
        del half, names, one
        names = ranks(reduced, new_starts, -(-depth // 3))[place]
        del reduced, place
        one = shifted(symbols, 1)
    rank = np.zeros(n, np.int32)
    rank[sampled] = names  # names of names are ranks already
    del names
    rest = np.flatnonzero(residue == 0).astype(np.int32)
    firsts, seconds = sampled[residue[sampled] == 1], sampled[residue[sampled] == 2]
    m = len(rest)
    # of each suffix those of its own kind that are below it, and those of the other kind
    out = np.zeros(n, np.int32)
    out[sampled] = _below(rank[sampled], rank[sampled])
    # a remaining suffix against one at offset 1: a symbol and a rank at offset 1 or 2; against one at offset 2: two symbols
    both, next_rank = np.concatenate([rest, firsts]), shifted(rank, 1)
    by_one = _named(symbols[both], next_rank[both])
    out[rest] = _below(by_one[:m], by_one[:m]) + _below(by_one[m:], by_one[:m])
    out[firsts] += _below(by_one[:m], by_one[m:])
    del by_one, next_rank
    both, after = np.concatenate([rest, seconds]), shifted(rank, 2)
    by_two = _named(symbols[both], one[both], after[both])
    out[rest] += _below(by_two[m:], by_two[:m])
    out[seconds] += _below(by_two[:m], by_two[m:])
    return out + np.int32(1)


def same_prefixes(text: np.ndarray, starts: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray]:
    """Places of ``text`` from which ``length`` bytes of their own text follow, and for each a number that is equal for
    equal strings: neighbours in suffix order are compared."""
    n = len(starts) - 1
    padded_starts = starts + np.arange(n + 1)
    symbols = np.zeros(int(padded_starts[-1]), np.int32)
    shift = np.repeat(np.arange(n, dtype=np.int32), np.diff(starts))
    symbols[np.arange(len(text)) + shift] = text.astype(np.int32) + 1
    rank = ranks(symbols, padded_starts, length)
    left = np.repeat(starts[1:], np.diff(starts)) - np.arange(len(text))
    places = np.flatnonzero(left >= length)
    order = places[np.argsort(rank[places + shift[places]], kind="stable")]
    new = np.ones(len(order), bool)
    for i in range(0, len(order) - 1, 20_000):
        a, b = order[i : i + 20_001][:-1], order[i : i + 20_001][1:]
        differ = np.zeros(len(a), bool)
        for j in range(length):
            differ |= text[a + j] != text[b + j]
        new[i + 1 : i + 1 + len(a)] = differ
    number = np.zeros(len(text), np.int64)
    number[order] = np.cumsum(new)
    return places, number[places]
