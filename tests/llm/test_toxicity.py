import random
import zlib

import pytest

from tidemark.llm import toxicity

DATA = "/root/testdata/sf0.1"


@pytest.fixture(scope="module")
def model(spark):
    return toxicity.fit(spark.read.parquet(f"{DATA}/documents.parquet"), spark.read.parquet(f"{DATA}/labels.parquet"))


def test_held_out_documents(spark, model):
    labels = spark.read.parquet(f"{DATA}/labels.parquet")
    got = toxicity.score(spark.read.parquet(f"{DATA}/documents.parquet"), model).join(labels, "doc_id").where("held_out").collect()
    hit = sum(r.predicted and r.toxic for r in got)
    assert hit >= 0.75 * sum(r.toxic for r in got) and hit >= 0.93 * sum(r.predicted for r in got)


def planted(spark):
    draw = random.Random(4)
    word = lambda: "".join(draw.choice("abcdefgh") for _ in range(5))
    rows, labels = [], []
    for i in range(600):
        sentences = [" ".join(word() for _ in range(6)) for _ in range(5)]
        if i % 5 == 0:
            sentences[draw.randrange(5)] += " vile" + draw.choice(["", "ness", "ly"])
        rows.append((i, ". ".join(sentences).capitalize() + ".", "x"))
        labels.append((i, 1 if i % 5 == 0 else int(draw.random() < 0.03)))
    return spark.createDataFrame(rows, "doc_id long, text string, score string"), spark.createDataFrame(labels, "doc_id long, toxic int")


def test_sentences_are_located(spark):
    docs, labels = planted(spark)
    made = toxicity.fit(docs, labels)
    texts = {r.doc_id: r.text for r in docs.collect()}
    for r in toxicity.score(docs, made).collect():
        assert r.predicted == (r.doc_id % 5 == 0) and r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 3 == 1)
        cut = [texts[r.doc_id][s.start : s.start + s.length] for s in r.sentences]
        assert len(cut) == r.predicted and all("vile" in c and "." not in c for c in cut)
    assert {r.doc_id for r in toxicity.without_toxic(docs, made).collect()} == {i for i in texts if i % 5}


def test_odd_documents(documents, rows, nothing, model):
    got = toxicity.score(documents, model).collect()
    assert len(got) == len(rows) and all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.7) for r in got)
    kept = toxicity.without_toxic(documents, model)
    assert kept.columns == documents.columns and kept.count() == sum(r.predicted == 0 for r in got)
    assert toxicity.score(nothing, model).count() == 0


@pytest.mark.parametrize("labels", [[], [(1, 1), (2, 1)], [(None, 1), (3, None)]])
def test_without_labels_of_both_kinds_nothing_is_toxic(documents, spark, labels):
    made = toxicity.fit(documents, spark.createDataFrame(labels, "doc_id long, toxic int"))
    assert not any(r.predicted for r in toxicity.score(documents, made).collect())


def test_words_that_share_bits_with_a_telling_one_are_not_telling(spark):
    """Clean words whose hashes agree with those of telling terms in the 24 lowest bits."""
    import numpy as np
    import pyarrow as pa

    made = toxicity.fit(*planted(spark))
    strong, mask = made.words[made.weights > 3], 0xFFFFFF
    assert len(strong)
    draw, found = np.random.default_rng(6), []
    while len(found) < 2:
        some = draw.integers(ord("k"), ord("u"), (300_000, 10), dtype=np.uint8)
        some[:, -1] = ord(" ")
        text = some.tobytes().decode()
        words, terms = text.split(), toxicity.read(pa.array([text]))[0].words
        whole = terms[: len(words)]  # whole words come first
        found += [words[i] for i in np.flatnonzero(np.isin(whole & mask, strong & mask))]
        for k, length in enumerate(toxicity.STEMS, 1):
            stems = terms[k * len(words) : (k + 1) * len(words)]
            found += [words[i] for i in np.flatnonzero(np.isin(stems & mask, strong & mask) & ~np.isin(stems, strong))]
    rows = [(-1, "zz zz."), *((i, f"zz {w}.") for i, w in enumerate(found))]
    got = {r.doc_id: r.score for r in toxicity.score(spark.createDataFrame(rows, "doc_id long, text string"), made).collect()}
    assert len(set(got.values())) == 1 and got[-1] < 0.1
