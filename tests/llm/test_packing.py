import random
import zlib
from functools import lru_cache

import numpy as np
import pytest

from tidemark.llm import packing


@pytest.mark.parametrize("capacity", [64, 2048])
def test_pack(documents, rows, capacity):
    from tokenizers import Tokenizer

    got = packing.pack(documents, capacity=capacity).collect()
    tokenizer, want = Tokenizer.from_file(packing.default_tokenizer()), []
    for doc, text, _ in rows:
        ids = np.array([*tokenizer.encode(text or "", add_special_tokens=False).ids, 0], "<u4")
        for piece, at in enumerate(range(0, len(ids), capacity)):
            cut = ids[at : at + capacity].tobytes()
            want.append((repr(doc), piece, at, len(cut) // 4, zlib.crc32(cut), cut))
    assert sorted((repr(r.doc_id), r.piece, r.start, r.length, r.ids_crc32, bytes(r.ids)) for r in got) == sorted(want)
    ends = {}
    for r in sorted(got, key=lambda r: (r.sequence_id, r.offset)):
        assert r.offset == ends.get(r.sequence_id, 0)
        ends[r.sequence_id] = r.offset + r.length
    assert max(ends.values()) <= capacity
    assert len(ends) <= -(-sum(r.length for r in got) // capacity) + 1


def test_pack_nothing(nothing):
    assert packing.pack(nothing).count() == 0


def fewest(items, capacity):
    """The fewest bins, by trying all."""

    @lru_cache(None)
    def bins(left):
        if not left:
            return 0
        best = len(left)
        for used in range(1 << (len(left) - 1)):
            chosen = [0] + [i + 1 for i in range(len(left) - 1) if used >> i & 1]
            if sum(left[i] for i in chosen) <= capacity:
                best = min(best, 1 + bins(tuple(x for i, x in enumerate(left) if i not in chosen)))
        return best

    return bins(tuple(sorted(items, reverse=True)))


@pytest.mark.parametrize("seed", range(40))
def test_dominating_sets_cost_nothing(seed):
    draw = random.Random(seed)
    capacity = draw.randint(6, 20)
    items = [draw.randint(1, capacity) for _ in range(7)]
    left = np.bincount(items, minlength=capacity + 1)
    for j in set(items):
        found = packing.dominating(left, j, capacity)
        if found:
            rest = list(items)
            for item in found:
                rest.remove(item)
            assert sum(found) <= capacity and 1 + fewest(rest, capacity) == fewest(items, capacity), (items, capacity, found)


@pytest.mark.parametrize("seed", range(20))
def test_plan_places_every_rank_once(seed):
    draw = np.random.default_rng(seed)
    capacity = 50
    counts = np.concatenate([[0], draw.integers(0, 12, capacity)])
    made = packing.plan(counts, capacity)
    for length in range(1, capacity + 1):
        assert made.used[length] == counts[length]
    runs = np.array(made.runs).reshape(-1, 4)
    assert made.sequences >= -(-int((counts * np.arange(capacity + 1)).sum()) // capacity)
    lower = np.bincount(runs[:, 0], minlength=1)
    assert lower.sum() == len(runs)


@pytest.mark.parametrize("text", ["ΟΔΟΣ", "ΟΔΟΣ.", "Σ", "ΣΑΣ, ΟΔΟΣ; οδος Οδός ΟΔΌΣ! aΣ"])
def test_capital_sigma_at_the_end_of_words(text):
    from tokenizers import Tokenizer

    want = Tokenizer.from_file(packing.default_tokenizer()).encode(text, add_special_tokens=False).ids
    assert np.frombuffer(packing.tokenize([text], packing.default_tokenizer())[0], "<u4").tolist() == [*want, 0]


def test_other_tokenizers_read_whole_texts(spark):
    """A byte-level one keeps white space and capitals."""
    import public_tokenizers
    from tokenizers import Tokenizer

    path = public_tokenizers.path("byte_bpe_50k.json")
    texts = ["Hello World, ok", "", "  two  spaces\n", "été"]
    tokenizer = Tokenizer.from_file(path)
    want = [[*tokenizer.encode(text, add_special_tokens=False).ids, 0] for text in texts]
    assert want[0] == [15496, 2159, 11, 12876, 0]
    assert [np.frombuffer(raw, "<u4").tolist() for raw in packing.tokenize(texts, path)] == want
    got = packing.pack(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string"), tokenizer=path).collect()
    assert {r.doc_id: np.frombuffer(r.ids, "<u4").tolist() for r in got} == dict(enumerate(want))
    assert packing._words(packing.default_tokenizer()).by_words
