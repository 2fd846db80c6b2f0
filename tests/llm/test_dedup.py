import hashlib
import random

import brute
import pytest

from tidemark.llm import exact_dedup, near_dedup, substrings
from tidemark.llm.shingles import SAMPLES, estimate, odd_sketches, samples, shingle_sets


def pairs(rows):
    return [(r[0], r[1]) for r in rows]


@pytest.mark.parametrize("counters", [1, 3, 1024])  # few counters: most groups go the ordinary way
def test_exact(documents, rows, counters):
    got = exact_dedup.exact_dedup(documents, counters=counters).collect()
    digests, groups = brute.exact(pairs(rows))
    assert len(got) == len(rows)
    assert sorted(r.text_sha256 for r in got) == sorted(digests)
    for digest, members in groups.items():
        some = [r for r in got if r.text_sha256 == digest]
        best = min(members, key=lambda i: (-len(rows[i][1] or ""), rows[i][0] is None, rows[i][0] or 0))
        assert {r.group_size for r in some} == {len(members)} and {r.keep_id for r in some} == {rows[best][0]}
        assert [r.doc_id for r in some if r.kept] == [rows[best][0]]


def test_exact_of_nothing(nothing):
    assert exact_dedup.exact_dedup(nothing).count() == 0


def test_misra_gries_keeps_frequent_values():
    import pyarrow as pa

    values = ["a"] * 60 + ["b"] * 30 + [str(i) for i in range(200)]
    random.Random(1).shuffle(values)
    batches = [pa.RecordBatch.from_pydict({"d": values[i : i + 37]}) for i in range(0, len(values), 37)]
    [out] = exact_dedup.frequent(iter(batches), 10)
    low = dict(zip(out.column(0).to_pylist(), out.column(1).to_pylist(), strict=True))
    assert len(low) <= 10 and "a" in low and 60 - len(values) / 11 <= low["a"] <= 60


def check_near(got, rows):
    order = sorted(range(len(rows)), key=lambda i: (rows[i][0] is None, rows[i][0] or 0))
    sets, component = brute.near([rows[i][1] for i in order])
    want = sorted((repr(rows[i][0]), len(s), repr(rows[order[c]][0])) for i, s, c in zip(order, sets, component, strict=True))
    assert sorted((repr(r.doc_id), r.n_shingles, repr(r.component_id)) for r in got) == want
    assert sum(r.stays for r in got) == len(set(component))
    assert all(r.kept == (r.doc_id == r.component_id) and r.kept >= r.stays for r in got)


def test_near(documents, rows):
    check_near(near_dedup.near_dedup(documents).collect(), rows)


def test_near_in_blocks(spark, monkeypatch):
    """A group of near copies of near copies, larger than a block."""
    monkeypatch.setattr(near_dedup, "BLOCK", 16)
    draw = random.Random(5)
    word = lambda: "".join(draw.choice("abcdefghij") for _ in range(5))
    texts = [[word() for _ in range(100)]]
    for _ in range(120):
        copy = list(draw.choice(texts))
        for _ in range(draw.randint(0, 4)):
            copy[draw.randrange(100)] = word()
        texts.append(copy)
    rows = [(i, " ".join(t)) for i, t in enumerate(texts)]
    check_near(near_dedup.near_dedup(spark.createDataFrame(rows, "doc_id long, text string")).collect(), rows)


def test_near_of_nothing(nothing):
    assert near_dedup.near_dedup(nothing).count() == 0


def test_odd_sketches_estimate_similarity():
    import numpy as np
    import pyarrow as pa

    base = [f"w{i}" for i in range(400)]
    texts = [" ".join(base)] + [" ".join(base[: 400 - n] + [f"x{i}" for i in range(n)]) for n in (20, 60, 150)]
    sets, ends = shingle_sets(pa.array(texts))
    found = samples(sets, ends)
    sketches = odd_sketches(found)
    assert found.shape == (SAMPLES, 4)
    for i in (1, 2, 3):
        a, b = brute.shingles(texts[0]), brute.shingles(texts[i])
        true = len(a & b) / len(a | b)
        assert abs(estimate(np.bitwise_count(sketches[0] ^ sketches[i]).sum()) - true) < 0.12


def test_substrings(documents, rows, monkeypatch):
    got = substrings.remove_repeats(documents).collect()
    want = []
    for (doc, text, _), gone in zip(rows, brute.without_repeats(pairs(rows)), strict=True):
        raw = (text or "").encode()
        left = bytes(b for b, g in zip(raw, gone, strict=True) if not g)
        spans = sum(g and not (i and gone[i - 1]) for i, g in enumerate(gone))
        want.append((repr(doc), len(raw), sum(gone), spans, hashlib.sha256(left).hexdigest(), left))
    assert sorted((repr(r.doc_id), r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256, bytes(r.kept)) for r in got) == sorted(want)


def test_substrings_of_nothing(nothing):
    assert substrings.remove_repeats(nothing).count() == 0


def test_pipeline_drops_near_copies_from_80_of_100(spark):
    """Pairs that share 80 to 84 of 100 shingles: op2 keeps both, the stage keeps one."""
    import corpus_pipeline

    draw = random.Random(8)
    word = lambda: "".join(draw.choice("abcdefghij") for _ in range(6))
    rows = []
    for i in range(40):
        base = [word() for _ in range(104)]  # 100 shingles; n new words at the end give (100 - n) / (100 + n)
        rows += [(2 * i, " ".join(base)), (2 * i + 1, " ".join(base[: 104 - 11 + i % 3] + [word() for _ in range(11 - i % 3)]))]
    _, component = brute.near([t for _, t in rows], percent=80)
    assert len(set(component)) == 40 and len(set(brute.near([t for _, t in rows])[1])) == 80
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    assert sorted(r.doc_id for r in corpus_pipeline.near_copies(spark, docs, "").collect()) == list(range(0, 80, 2))
    assert near_dedup.near_dedup(docs).where("kept").count() == 80


def test_rows_that_repeat_are_kept_by_their_id_and_one_stays(spark):
    text = " ".join(f"w{i}" for i in range(30))
    docs = spark.createDataFrame([(7, text), (7, text), (8, text), (9, None), (9, None)], "doc_id long, text string")
    got = near_dedup.near_dedup(docs).collect()
    assert sorted((r.doc_id, r.component_id, r.kept) for r in got) == [(7, 7, True)] * 2 + [(8, 7, False)] + [(9, 9, True)] * 2
    assert [sum(r.stays for r in got if r.doc_id == i) for i in (7, 8, 9)] == [1, 0, 2]  # texts without words are linked with nothing
    assert near_dedup.without_near_copies(docs).count() == 3


@pytest.mark.parametrize("percent", [5, 30, 50, 65, 70, 80, 85, 100])
def test_bands_and_sketches_follow_from_the_similarity(percent):
    """Pairs exactly at the limit, drawn: none is missed, at any limit."""
    import numpy as np

    from tidemark.llm.shingles import BITS, ROWS, layout

    count, rows, far = layout(percent)
    assert count >= SAMPLES and 1 <= rows <= ROWS and (1 - (percent / 100) ** rows) ** (count // rows) <= 2.5e-8
    draw = np.random.default_rng(percent)
    for _ in range(4):
        apart = draw.random((5000, SAMPLES)) * 100 >= percent
        marks = np.zeros((5000, BITS), np.uint8)
        for i in range(SAMPLES):
            for _ in range(2):
                marks[np.flatnonzero(apart[:, i]), draw.integers(0, BITS, apart[:, i].sum())] ^= 1
        assert marks.sum(1).max() <= far


@pytest.mark.parametrize("percent", [0, 101])
def test_limits_that_are_no_share_are_refused(nothing, percent):
    with pytest.raises(ValueError, match="percent"):
        near_dedup.near_dedup(nothing, percent=percent)


def test_pipeline_stage_on_the_table(spark):
    import corpus_pipeline

    docs = spark.read.parquet(f"{brute.SF}/documents.parquet")
    held = sorted(docs.select("doc_id", "text").collect())
    _, component = brute.near([r.text for r in held], percent=80)
    got = corpus_pipeline.near_copies(spark, docs, brute.SF)
    assert sorted(r.doc_id for r in got.collect()) == [held[i].doc_id for i in sorted(set(component))]
