"""A unigram vocabulary's probabilities of words: sums over all segmentations of a word into pieces.

A word is a path through a lattice whose nodes lie between its characters and whose edges are the pieces that stand there. Its
marginal probability is the forward recursion's value at the last node, in logarithms. Many words go through it side by side, node by node.
"""

from __future__ import annotations

import math
from collections.abc import Iterator, Sequence
from functools import lru_cache

import numpy as np

#: What is added to a piece's count, so that every piece is possible.
UNSEEN = 0.1
#: Characters of a word beyond which it is gone through by itself, in windows; expected counts take it in parts.
LONG = 512
WINDOW = 1 << 16
#: Characters that go through the recursion together.
TOGETHER = 1 << 19

MARK = "▁"
_FACTOR = 0x9E3779B97F4A7C15


@lru_cache(1)
def vocabulary(path: str):
    import sentencepiece

    return sentencepiece.SentencePieceProcessor(model_file=path)


@lru_cache(1)
def _pieces(path: str) -> Pieces:
    return Pieces(path)


class Pieces:
    """The pieces and all their beginnings, found by 64-bit hashes of their characters."""

    def __init__(self, path: str) -> None:
        model = vocabulary(path)
        self.size = model.vocab_size()
        self.names = [model.id_to_piece(i) for i in range(self.size)]
        self.use = np.array([not (model.is_control(i) or model.is_unknown(i) or model.is_unused(i)) for i in range(self.size)], bool)
        self.begins = np.array([name.startswith(MARK) for name in self.names], bool) & self.use
        self.bytes = {int(self.names[i][3:5], 16): i for i in range(self.size) if model.is_byte(i)}
        self.ids = {self.names[i]: int(i) for i in np.flatnonzero(self.use) if not model.is_byte(int(i))}
        found: dict[str, int] = {}
        for name, i in self.ids.items():
            for n in range(1, len(name)):
                found.setdefault(name[:n], -1)
            found[name] = i
        keys = np.array([_hash(name) for name in found], np.uint64)
        order = np.argsort(keys)
        self.keys, self.of_key = keys[order], np.array(list(found.values()), np.int64)[order]
        self.longest = max(map(len, found), default=1)

    def edges(self, codes: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """All pieces in the words: where they begin, how long they are, and which they are.

        ``ends`` has the end of its word for each character. A character without a piece of its own is one of length 1,
        called ``size`` and up from there by its code.
        """
        at, found = np.arange(len(codes)), np.zeros(len(codes), np.uint64)
        begin, length, piece = [], [], []
        for n in range(1, self.longest + 1):
            inside = at + n <= ends[at]
            at = at[inside]
            found = found[inside] * np.uint64(_FACTOR) + codes[at + n - 1] + np.uint64(1)
            place = np.minimum(np.searchsorted(self.keys, found), len(self.keys) - 1)
            live = self.keys[place] == found
            at, found, place = at[live], found[live], place[live]
            whole = self.of_key[place]
            is_piece = whole >= 0
            begin.append(at[is_piece])
            piece.append(whole[is_piece])
            length.append(np.full(len(begin[-1]), n))
            if n == 1:
                alone = np.ones(len(codes), bool)
                alone[begin[0]] = False
                alone = np.flatnonzero(alone)
                begin.append(alone)
                piece.append(self.size + codes[alone].astype(np.int64))
                length.append(np.ones(len(alone), np.int64))
            if not len(at):
                break
        return np.concatenate(begin), np.concatenate(length), np.concatenate(piece)


def _hash(text: str) -> int:
    value = 0
    for c in text:
        value = (value * _FACTOR + ord(c) + 1) % (1 << 64)
    return value


_INNER = 0x110000  # stands for a mark inside a word, which no piece may begin at


def _codes(words: Sequence[str]) -> tuple[np.ndarray, np.ndarray]:
    """The characters of all words, each with a mark before it, and the words' lengths."""
    codes = np.frombuffer("".join([MARK + w for w in words]).encode("utf-32-le"), np.uint32).astype(np.uint64)
    lengths = np.fromiter(map(len, words), np.int64, len(words)) + 1
    first = np.cumsum(lengths) - lengths
    marks = codes == ord(MARK)
    marks[first] = False
    codes[marks] = _INNER
    return codes, lengths


class Lattice:
    """Probabilities of words as sums over their segmentations into pieces.

    The first piece holds the mark of a word's begin; after each piece the word ends with probability ``stop``. ``counts`` are
    how often each piece is used, ``words`` in how many words.
    """

    def __init__(self, path: str, counts: np.ndarray, words: float) -> None:
        self.of = _pieces(path)
        use, begins = self.of.use, self.of.begins
        weight = np.where(use, counts + UNSEEN, 0.0)
        stop = min(max(words / max(float(counts.sum()), 1.0), 0.05), 0.95)
        self.logs_of = np.log(np.maximum(weight, 1e-300))
        self.logs_of -= np.where(begins, math.log(weight[begins].sum()), math.log(weight[~begins].sum()) - math.log1p(-stop))
        self.end = math.log(stop)
        self.bytes = {b: float(self.logs_of[i]) for b, i in self.of.bytes.items()}
        self.pieces = {name: float(self.logs_of[i]) for name, i in self.of.ids.items()}

    def log(self, word: str) -> float:
        """The natural logarithm of the word's marginal probability."""
        return float(self.logs([word])[0])

    def logs(self, words: Sequence[str]) -> np.ndarray:
        """The natural logarithms of the words' marginal probabilities."""
        out = np.zeros(len(words))
        for some in _together(words):
            several = [words[i] for i in some]
            if len(several[0]) > LONG:
                out[some] = self._walk(several[0])
            else:
                codes, lengths = _codes(several)
                *_, last = self._forward(codes, lengths)
                out[some] = last
        return out + self.end

    def expected(self, words: Sequence[str]) -> np.ndarray:
        """How often each piece is expected in the words; longer ones than ``LONG`` are taken in parts."""
        counts = np.zeros(self.of.size)
        for some in _together(words):
            several = [words[i] for i in some]
            codes, lengths = _codes(several)
            if len(several[0]) > LONG:
                lengths = np.diff(np.minimum(np.arange(-(-lengths[0] // LONG) + 1) * LONG, lengths[0]))
            at = np.concatenate([[0], np.cumsum(lengths)])
            for i, j in _spans(lengths):
                counts += self._expected(codes[at[i] : at[j]], lengths[i:j])
        return counts

    def _values(self, piece: np.ndarray) -> np.ndarray:
        """The pieces' logarithms; those of characters without a piece are of their bytes."""
        alone = piece >= self.of.size
        value = self.logs_of[np.where(alone, 0, piece)]
        if alone.any():
            which, same = np.unique(piece[alone], return_inverse=True)
            value[alone] = np.array([sum(self.bytes[b] for b in _spelt(c - self.of.size)) for c in which.tolist()])[same]
        return value

    def _graph(self, codes: np.ndarray, lengths: np.ndarray):
        first = np.cumsum(lengths) - lengths
        word = np.repeat(np.arange(len(lengths)), lengths)
        begin, length, piece = self.of.edges(codes, np.repeat(first + lengths, lengths))
        source = begin + word[begin]  # a word has a node more than characters
        return first + np.arange(len(lengths)), word[begin], source, source + length, piece

    def _forward(self, codes: np.ndarray, lengths: np.ndarray):
        start, word, source, target, piece = self._graph(codes, lengths)
        value = self._values(piece)
        reached = np.full(len(codes) + len(lengths), -np.inf)
        reached[start] = 0.0
        for some, heads in _steps(target - start[word], target):
            reached[target[some[heads]]] = np.logaddexp.reduceat(reached[source[some]] + value[some], heads)
        return start, word, source, target, piece, value, reached, reached[start + lengths]

    def _expected(self, codes: np.ndarray, lengths: np.ndarray) -> np.ndarray:
        start, word, source, target, piece, value, reached, last = self._forward(codes, lengths)
        left = np.full(len(reached), -np.inf)
        left[start + lengths] = 0.0
        for some, heads in _steps((start + lengths)[word] - source, source):
            left[source[some[heads]]] = np.logaddexp.reduceat(left[target[some]] + value[some], heads)
        share = np.exp(reached[source] + value + left[target] - last[word])
        alone = piece >= self.of.size
        counts = np.bincount(piece[~alone], weights=share[~alone], minlength=self.of.size)
        which, same = np.unique(piece[alone], return_inverse=True)
        for c, n in zip(which.tolist(), np.bincount(same, weights=share[alone], minlength=len(which)).tolist(), strict=True):
            for b in _spelt(c - self.of.size):
                counts[self.of.bytes[b]] += n
        return counts

    def _walk(self, word: str) -> float:
        """The same for a word of any length, of which a window is held at a time."""
        reached, ahead = [0.0], self.of.longest
        for i in range(0, len(word) + 1, WINDOW):
            text = (MARK if i == 0 else word[i - 1]) + word[i : i + WINDOW - 1 + ahead]
            codes = np.frombuffer(text.encode("utf-32-le"), np.uint32).astype(np.uint64)
            codes[(codes == ord(MARK)) & (np.arange(len(codes)) + i > 0)] = _INNER
            here = min(WINDOW, len(codes))
            begin, length, piece = self.of.edges(codes, np.full(len(codes), len(codes)))
            order = np.argsort(begin, kind="stable")
            order = order[begin[order] < here]
            reached += [-math.inf] * (len(codes) + 1 - len(reached))
            for a, b, v in zip(begin[order].tolist(), (begin + length)[order].tolist(), self._values(piece[order]).tolist(), strict=True):
                new, old = reached[a] + v, reached[b]
                reached[b] = new if old == -math.inf else _add(old, new)
            reached = reached[here:]
        return reached[0]


def _spelt(code: int) -> bytes:
    return (MARK if code == _INNER else chr(code)).encode()


def _add(a: float, b: float) -> float:
    """log(exp(a) + exp(b))"""
    return a + math.log1p(math.exp(b - a)) if a > b else b + math.log1p(math.exp(a - b))


def _steps(step: np.ndarray, node: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """The edges by step, those of a node together, and where each node's begin."""
    order = np.lexsort((node, step))
    changes = np.flatnonzero(np.diff(node[order], prepend=-1))
    edges = np.searchsorted(step[order], np.arange(1, int(step.max(initial=0)) + 2))
    heads = np.searchsorted(changes, edges)
    for i, j, a, b in zip(edges[:-1].tolist(), edges[1:].tolist(), heads[:-1].tolist(), heads[1:].tolist(), strict=True):
        yield order[i:j], changes[a:b] - i


def _spans(lengths: np.ndarray) -> Iterator[tuple[int, int]]:
    """Runs of at most ``TOGETHER`` characters, or of one item."""
    at = np.cumsum(lengths)
    i = 0
    while i < len(lengths):
        j = max(int(np.searchsorted(at, (at[i - 1] if i else 0) + TOGETHER, "right")), i + 1)
        yield i, j
        i = j


def _together(words: Sequence[str]) -> Iterator[np.ndarray]:
    """Numbers of words that go through together: of about the same length, long ones by themselves."""
    lengths = np.fromiter(map(len, words), np.int64, len(words))
    order = np.argsort(lengths, kind="stable")
    short = order[: int(np.searchsorted(lengths[order], LONG, "right"))]
    for i, j in _spans(lengths[short] + 1):
        yield short[i:j]
    for i in order[len(short) :]:
        yield np.array([i])
