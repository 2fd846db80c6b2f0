import math
import re
import zlib
from collections import Counter

import brute
import numpy as np
import pytest

from tidemark.llm import lattice, unigram


def test_against_counting(documents, rows):
    got = lattice.lm_scores(documents).collect()
    held = lambda doc: zlib.crc32(("" if doc is None else str(doc)).encode()) % 7 == 2
    tokens = [[*brute.words(text), None] for _, text, _ in rows]
    counts = Counter(t for (doc, _, _), ts in zip(rows, tokens, strict=True) if not held(doc) for t in ts)
    n, v = sum(counts.values()), len(counts)
    want = []
    for (doc, _, _), ts in zip(rows, tokens, strict=True):
        base = sum(math.log10((counts[t] + 1) / (n + v + 1)) for t in ts)
        want.append((repr(doc), held(doc), len(ts), sum(counts[t] > 0 for t in ts), n, round(base, 6)))
    assert sorted((repr(r.doc_id), r.held_out, r.n_tokens, r.n_known, r.train_tokens, round(r.base_score, 6)) for r in got) == sorted(want)
    assert all(math.isfinite(r.score) and r.score < 0 for r in got)


def test_forward_recursion_sums_all_segmentations():
    path = lattice.default_vocabulary()
    model = lattice._vocabulary(path)
    draw = np.random.default_rng(1)
    made = lattice.Lattice(path, draw.integers(0, 50, model.vocab_size()), 5000)

    def total(text):
        if not text:
            return math.exp(made.end)
        value = 0.0
        for i in range(1, len(text) + 1):
            piece = made.pieces.get(text[:i], -math.inf)
            if piece > -math.inf:
                value += math.exp(piece) * total(text[i:])
        if made.pieces.get(text[0], -math.inf) == -math.inf:
            value += math.exp(sum(made.bytes[b] for b in text[0].encode())) * total(text[1:])
        return value

    for word in ("the", "thonha", "été", "a", "x\U0001f600y", "!!"):
        assert made.log(word) == pytest.approx(math.log(total("▁" + word)))
    assert math.isfinite(made.log("w" * 5000))


def test_probabilities_of_words_sum_to_less_than_one():
    path = lattice.default_vocabulary()
    made = lattice.Lattice(path, np.zeros(lattice._vocabulary(path).vocab_size(), int), 0)
    words = ["".join((a, b)) for a in "abcdefghijklmnopqrstuvwxyz" for b in ["", *"abcdefghijklmnopqrstuvwxyz"]]
    assert 0 < sum(math.exp(made.log(w)) for w in words) < 1


def test_repeated_sentences_are_likelier(spark):
    line = "this line stands in many documents and is known by heart"
    rows = [(i, f"{line}. word{i} other{i} things{i} here.") for i in range(60)]
    rows += [(1000 + i, f"{' '.join(reversed(line.split(' ')))}. word{i} other{i} things{i} here.") for i in range(60)]
    got = {r.doc_id: r for r in lattice.lm_scores(spark.createDataFrame(rows[:60] + [r for r in rows[60:] if zlib.crc32(str(r[0]).encode()) % 7 == 2], "doc_id long, text string")).collect()}
    known = [r.score for r in got.values() if r.doc_id < 1000 and r.held_out]
    other = [r.score for r in got.values() if r.doc_id >= 1000]
    assert min(known) > max(other)


def test_nothing_to_learn_from(spark, nothing):
    assert lattice.lm_scores(nothing).count() == 0
    held = [i for i in range(100) if zlib.crc32(str(i).encode()) % 7 == 2][:3]
    got = lattice.lm_scores(spark.createDataFrame([(i, "some words") for i in held], "doc_id long, text string")).collect()
    assert all(r.train_tokens == 0 and r.base_score == 0 and math.isfinite(r.score) for r in got)


class Spelt:
    """Pieces' scores and words' probabilities, with every segmentation written out."""

    def __init__(self, path):
        model = lattice._vocabulary(path)
        self.names = [model.id_to_piece(i) for i in range(model.vocab_size())]
        self.use = [not (model.is_control(i) or model.is_unknown(i) or model.is_unused(i)) for i in range(len(self.names))]
        self.bytes = {int(self.names[i][3:5], 16): i for i in range(len(self.names)) if model.is_byte(i)}
        self.ids = {self.names[i]: i for i, use in enumerate(self.use) if use and not model.is_byte(i)}

    def ways(self, text):
        if not text:
            return [[]]
        heads = [([self.ids[text[:n]]], n) for n in range(1, len(text) + 1) if text[:n] in self.ids]
        if text[0] not in self.ids:
            heads.append(([self.bytes[b] for b in text[0].encode()], 1))
        return [head + way for head, n in heads for way in self.ways(text[n:])]

    def scores(self, counts, words):
        begins = [use and name.startswith("▁") for use, name in zip(self.use, self.names, strict=True)]
        weight = [c + 0.1 if use else 0.0 for c, use in zip(counts, self.use, strict=True)]
        stop = min(max(words / max(sum(counts), 1), 0.05), 0.95)
        of = {b: sum(w for w, x in zip(weight, begins, strict=True) if x == b) / (1 if b else 1 - stop) for b in (True, False)}
        return [w / of[b] for w, b in zip(weight, begins, strict=True)], stop

    def fit(self, words, rounds):
        counts, n = [0.0] * len(self.names), 0
        for _ in range(rounds):
            score, _ = self.scores(counts, n)
            counts, n = [0.0] * len(self.names), len(words)
            for word in words:
                ways = self.ways("▁" + word)
                each = [math.prod(score[p] for p in way) for way in ways]
                for way, p in zip(ways, each, strict=True):
                    for piece in way:
                        counts[piece] += p / sum(each)
        score, stop = self.scores(counts, n)
        return lambda word: stop * sum(math.prod(score[p] for p in way) for way in self.ways("▁" + word))


def test_whole_texts_against_all_segmentations(spark):
    """The scores of all texts, from pieces' scores over whole words to whole sentences, worked out the long way."""
    texts = ["The cat sat. The cat sat. A dog\nran off!", "", None, "naïve \U0001f600 cat", "cat", "the cat sat. off it", "A dog"] * 2
    texts += ["The cat sat. Unheard words", "zebra \U0001f600x ran", "", "A dog\nran off! cat"] * 12
    rows = list(enumerate(texts))
    held = {i for i, _ in rows if zlib.crc32(str(i).encode()) % 7 == 2}
    assert held and len(held) < len(rows)

    def sentences(text):
        lines = [re.split(r"(?<=[.!?])[ \n]+", line) for line in (text or "").lower().split("\n")]
        return [s.split() for line in lines for s in line if s.split()]

    learnt = [s for i, text in rows if i not in held for s in sentences(text)]
    words, whole = Counter(w for s in learnt for w in s), Counter(tuple(s) for s in learnt if len(s) > 1)
    ends = len(rows) - len(held)
    n, of_whole = sum(words.values()) + ends, sum(whole.values())

    def taken(counts):
        once, twice = (sum(x == k for x in counts.values()) for k in (1, 2))
        return min(max(once / max(once + 2 * twice, 1), 0.1), 0.99)

    of_word, of_sentence = taken(words), taken(whole)
    spelt = Spelt(lattice.default_vocabulary()).fit(sorted(words), lattice.ROUNDS)
    p_word = lambda w: max(words[w] - of_word, 0) / n + of_word * len(words) / n * spelt(w)

    def p_sentence(s):
        p = math.prod(map(p_word, s))
        return p if len(s) == 1 else p * of_sentence * len(whole) / of_whole + max(whole[tuple(s)] - of_sentence, 0) / of_whole

    want = {i: sum(math.log10(p_sentence(s)) for s in sentences(text)) + math.log10(ends / n) for i, text in rows}
    got = {r.doc_id: r.score for r in lattice.lm_scores(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert got == pytest.approx(want, rel=1e-4)


def test_expected_counts_of_long_words_and_windows(monkeypatch):
    path = lattice.default_vocabulary()
    draw = np.random.default_rng(2)
    made = unigram.Lattice(path, draw.integers(0, 50, lattice._vocabulary(path).vocab_size()), 5000)
    words = ["thereandback▁again" * 20, "the\U0001f600re" * 9, "x", "été"]
    at_once = made.logs(words)
    monkeypatch.setattr(unigram, "LONG", 10)
    monkeypatch.setattr(unigram, "WINDOW", 64)
    assert made.logs(words) == pytest.approx(at_once)
    pieces = [n for n in made.expected(words) if n > 0]
    assert pieces and math.isfinite(sum(pieces))


def test_more_rounds_make_training_words_likelier():
    path = lattice.default_vocabulary()
    words = ["thereon", "thereby", "hereby", "nearby", "there", "on", "by", "here"] * 3
    counts, n, before = np.zeros(lattice._vocabulary(path).vocab_size()), 0, -math.inf
    for _ in range(5):
        made = unigram.Lattice(path, counts, n)
        assert (now := float(made.logs(words).sum())) > before
        counts, n, before = made.expected(words), len(words), now
