import numpy as np
from hypothesis import given, settings
from hypothesis import strategies as st

from tidemark.llm.suffixes import ranks, same_prefixes

TEXTS = st.lists(st.text("ab", max_size=30), min_size=1, max_size=6)


def arrays(texts):
    raw = [np.frombuffer(t.encode(), np.uint8) for t in texts]
    return np.concatenate(raw), np.concatenate([[0], np.cumsum([len(t) for t in raw])])


@settings(max_examples=150, deadline=None)
@given(TEXTS, st.integers(1, 12))
def test_same_prefixes(texts, length):
    text, starts = arrays(texts)
    places, number = same_prefixes(text, starts, length)
    want = [(starts[i] + k, t[k : k + length]) for i, t in enumerate(texts) for k in range(len(t) - length + 1)]
    assert places.tolist() == [p for p, _ in want]
    seen = {}
    for n, (_, string) in zip(number.tolist(), want, strict=True):
        assert seen.setdefault(string, n) == n
    assert len(set(seen.values())) == len(seen)


@settings(max_examples=100, deadline=None)
@given(TEXTS)
def test_ranks_are_the_suffix_order(texts):
    ends = [t + "\0" for t in texts]
    symbols = np.concatenate([np.frombuffer(t.encode(), np.uint8) for t in ends]).astype(np.int64)
    starts = np.concatenate([[0], np.cumsum([len(t) for t in ends])])
    rank = ranks(symbols, starts, 1000)
    suffixes = [t[k:] for t in ends for k in range(len(t))]
    order = {s: i for i, s in enumerate(sorted(set(suffixes)))}
    got = {s: r for s, r in zip(suffixes, rank.tolist(), strict=True)}
    assert [got[s] for s in suffixes] == rank.tolist()
    assert sorted(got, key=got.get) == sorted(order, key=order.get)
