"""Toxicity by multiple-instance learning: labels are of documents, what is scored are sentences.

A document is toxic if any of its sentences is: with sentence scores q, by noisy-or 1 - prod(1 - q). A sentence's
score is logistic in its words and their stems. Labels may be wrong either way, so the fit sees a label through two error rates
that the scores do not contain.

The fit takes a bounded sample of labelled rows (``sample_rows``); scoring is one pass over whole texts with a model of
a few words, without a shuffle.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm.common import byte_sums, hash_between, kept, lower, mixed, slices, spans, table, text_of, utf8

#: Labelled rows that a fit takes at most, about: a documented bound, as the fit is made on the driver.
SAMPLE_ROWS = 8000
#: How sure a term has to be to get a weight: log likelihood ratio against chance, beyond the log of the number of terms
#: that are in so many documents.
CHANCE, SEEN = 0.0, 4
#: Words count whole and by their first 4 to 7 bytes, which share what derived words have in common.
STEMS = (4, 5, 6, 7)

#: Terms are told apart by 61 bits of their hash; the lowest three hold a stem's length, 0 for whole words.
_HASH, _LENGTH = np.uint64((1 << 64) - 8), np.uint64(7)

_WORD_GAPS = np.ones(256, bool)
_WORD_GAPS[128:] = False
for _a, _b in (("0", "9"), ("A", "Z"), ("a", "z")):
    _WORD_GAPS[ord(_a) : ord(_b) + 1] = False
_ENDS = np.zeros(256, bool)
_ENDS[[ord(c) for c in ".!?\n\r"]] = True


@dataclass
class Model:
    words: np.ndarray  # sorted terms
    weights: np.ndarray
    bias: float


@dataclass
class Sentences:
    """The sentences with words of a batch of texts, and their words."""

    start: np.ndarray
    end: np.ndarray
    first: np.ndarray  # of each text, one more than texts
    words: np.ndarray  # terms: words and their stems
    of: np.ndarray  # the sentence of each


def read(column: pa.Array) -> tuple[Sentences, np.ndarray, np.ndarray]:
    data, offsets = utf8(column)
    start, end, _ = spans(data, offsets, _ENDS)
    word_start, word_end, _ = spans(data, offsets, _WORD_GAPS)
    of = np.searchsorted(start, word_start, "right") - 1
    full = np.zeros(len(start), bool)
    full[of] = True
    place = np.cumsum(full) - 1
    start, end = start[full], end[full]
    small, sentence = lower(data), place[of]
    sums = byte_sums(small)
    terms, owners = [hash_between(small, sums, word_start, word_end) & _HASH], [sentence]
    for length in STEMS:
        fit = word_end - word_start >= length
        terms.append(hash_between(small, sums, word_start[fit], word_start[fit] + length) & _HASH | np.uint64(length))
        owners.append(sentence[fit])
    return Sentences(start, end, np.searchsorted(start, offsets), np.concatenate(terms), np.concatenate(owners)), data, offsets


def held_out(id_col: str) -> Column:
    return F.pmod(F.crc32(F.coalesce(F.col(f"`{id_col}`").cast("string"), F.lit("")).cast("binary")), F.lit(3)) == 1


def _as_bytes(values: np.ndarray, ends: np.ndarray) -> pa.Array:
    return pa.array([values[i:j].tobytes() for i, j in zip(ends[:-1], ends[1:], strict=True)], pa.binary())


def _sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Of each labelled text, what its sentences are told apart by."""
    for batch in slices(batches, 1):
        found, _, _ = read(batch.column(1))
        whole = (found.words & _LENGTH) == 0
        sums = np.zeros(len(found.start), np.uint64)
        np.add.at(sums, found.of[whole], mixed(found.words[whole]))
        yield pa.RecordBatch.from_pydict({"row": batch.column(0), "sums": _as_bytes(sums, found.first), "toxic": batch.column(2)})


def _counts(batches: Iterator[pa.RecordBatch], marks: dict[int, bytes]) -> Iterator[pa.RecordBatch]:
    """Terms, in how many texts they are, and in how many of them in a sentence that tells of toxic ones."""
    for batch in slices(batches, 1):
        found, _, _ = read(batch.column(1))
        mark = np.frombuffer(b"".join(marks[row] for row in batch.column(0).to_pylist()), np.uint8)[found.of]
        text = np.searchsorted(found.first, found.of, "right") - 1
        order = np.lexsort((text, found.words))
        order = order[mark[order] > 0]
        words, text, mark = found.words[order], text[order], mark[order]
        if not len(words):
            continue
        at = np.flatnonzero(np.concatenate([[True], (np.diff(words) != 0) | (np.diff(text) != 0)]))
        words, telling = words[at], np.maximum.reduceat(mark, at) == 2
        at = np.flatnonzero(np.concatenate([[True], np.diff(words) != 0]))
        seen, bad = np.diff([*at, len(words)]), np.add.reduceat(telling.astype(np.int64), at)
        yield pa.RecordBatch.from_pydict({"term": pa.array(words[at].view(np.int64)), "seen": pa.array(seen, pa.int64()), "bad": pa.array(bad, pa.int64())})


def _hits(batches: Iterator[pa.RecordBatch], chosen: np.ndarray) -> Iterator[pa.RecordBatch]:
    """Of each labelled text, the places of its terms among the chosen ones, and their sentences."""
    for batch in slices(batches, 1):
        found, _, _ = read(batch.column(1))
        at = np.searchsorted(chosen, found.words).clip(0, max(len(chosen) - 1, 0))
        hit = np.flatnonzero(chosen[at] == found.words) if len(chosen) else np.zeros(0, int)
        hit = hit[np.argsort(found.of[hit], kind="stable")]
        of = found.of[hit]
        text = np.searchsorted(found.first, of, "right") - 1
        ends = np.searchsorted(of, found.first)
        yield pa.RecordBatch.from_pydict({"row": batch.column(0), "terms": _as_bytes(at[hit].astype(np.int32), ends), "of": _as_bytes((of - found.first[text]).astype(np.int32), ends)})


def fit(
    docs: DataFrame,
    labels: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    label_col: str = "toxic",
    sample_rows: int = SAMPLE_ROWS,
) -> Model:
    """Learn from labelled rows that are not held out. Rows without an id or label take no part; of several labels of
    one id the highest counts. Without any labelled row, or with one kind of label only, nothing is toxic."""
    known = (
        labels.select(F.col(f"`{id_col}`").alias("_id"), F.col(f"`{label_col}`").cast("int").alias("_toxic"))
        .where(F.col("_id").isNotNull() & F.col("_toxic").isNotNull())
        .groupBy("_id")
        .agg(F.max("_toxic").alias("_toxic"))
        .where(~held_out("_id"))
    )
    rows = max(known.count(), 1)
    drawn = F.pmod(F.xxhash64("_id"), F.lit(1 << 30)) < int(min(1.0, sample_rows / rows) * (1 << 30))
    sample = docs.select(F.col(f"`{id_col}`").alias("_id"), text_of(text_col).alias("_text")).join(known.where(drawn), "_id")
    once = sample.groupBy(F.xxhash64("_text"), "_toxic").agg(F.first("_text").alias("_text"))  # copies prove nothing more
    once = kept(once.select(F.monotonically_increasing_id().alias("row"), "_text", "_toxic"), "sample")
    got = once.mapInArrow(_sums, "row long, sums binary, toxic int").toArrow()
    sums, toxic = [np.frombuffer(x.as_buffer(), np.uint64) for x in got["sums"]], got["toxic"].to_numpy().astype(float)
    if not 0 < toxic.sum() < len(toxic):
        return Model(np.zeros(0, np.uint64), np.zeros(0), -12.0)
    in_order = sorted(range(len(toxic)), key=lambda i: (sums[i].tobytes(), toxic[i]))  # results do not hang on the rows' order
    rows, sums, toxic = got["row"].to_numpy()[in_order], [sums[i] for i in in_order], toxic[in_order]
    marks = dict(zip(rows.tolist(), _marks(sums, toxic), strict=True))
    counts = once.mapInArrow(lambda b: _counts(b, marks), "term long, seen long, bad long")
    counts = kept(counts.groupBy("term").agg(F.sum("seen").alias("seen"), F.sum("bad").alias("bad")).where(F.col("seen") >= SEEN), "terms")
    chosen = _screen(counts.where("2 * bad > seen").toArrow(), counts.count(), toxic.mean())
    hits = once.mapInArrow(lambda b: _hits(b, chosen), "row long, terms binary, of binary").toArrow()
    of_row = {row: i for i, row in enumerate(hits["row"].to_pylist())}
    places = [of_row[row] for row in rows.tolist()]
    terms, of = ([np.frombuffer(hits[c][i].as_buffer(), np.int32) for i in places] for c in ("terms", "of"))
    return _fit(chosen, terms, of, [len(s) for s in sums], toxic)


def _marks(sums: list[np.ndarray], toxic: np.ndarray) -> Iterator[bytes]:
    """A byte for each sentence of each document: 0 if a document before has it, 2 if it tells of toxic documents, else 1.
    Different sentences count, as what copies share proves nothing more; a sentence is clean if any clean document has it."""
    clean = np.unique(np.concatenate([s for s, y in zip(sums, toxic, strict=True) if not y]))
    past: set[int] = set()
    for sentences, y in zip(sums, toxic, strict=True):
        new = np.array([x not in past for x in sentences.tolist()], bool)
        past.update(sentences.tolist())
        known = clean[np.searchsorted(clean, sentences).clip(0, len(clean) - 1)] == sentences if len(clean) else np.zeros(len(new), bool)
        yield (new + (new & ~known & bool(y)).astype(np.uint8)).astype(np.uint8).tobytes()


def _screen(counts: pa.Table, terms: int, p: float) -> np.ndarray:
    """The terms that tell sentences of toxic documents from others: of those in more toxic documents than others, with
    ``terms`` the number of all that are in enough documents."""
    seen, bad = (counts[c].to_numpy().astype(float) for c in ("seen", "bad"))
    share = bad / seen
    with np.errstate(divide="ignore", invalid="ignore"):
        apart = np.nan_to_num(share * np.log(share / p)) + np.nan_to_num((1 - share) * np.log((1 - share) / (1 - p)))
    sure = seen * apart >= np.log(max(terms, 1)) + CHANCE
    return np.sort(counts["term"].to_numpy().astype(np.int64)[sure].view(np.uint64))


def _fit(chosen: np.ndarray, terms: list[np.ndarray], of: list[np.ndarray], sentences_of: list[int], toxic: np.ndarray, steps: int = 600, rate: float = 0.05) -> Model:
    n = len(toxic)
    # documents as a number of plain sentences, and sentences that hold a chosen term
    columns, rows, docs, plain, held = [], [], [], np.zeros(n), 0
    for i, (at, sentence) in enumerate(zip(terms, of, strict=True)):
        sentences, row = np.unique(sentence, return_inverse=True)
        columns.append(at)
        rows.append(row + held)
        docs.append(np.full(len(sentences), i))
        plain[i] = sentences_of[i] - len(sentences)
        held += len(sentences)
    column, row, doc = (np.concatenate(x).astype(int) for x in (columns, rows, docs))
    theta = np.zeros(len(chosen) + 3)
    theta[: len(chosen)] = 4.0
    theta[-3:] = -7.0, -4.0, -4.0  # bias; logits of the two error rates
    first, second = np.zeros_like(theta), np.zeros_like(theta)
    for step in range(1, steps + 1):
        w, bias = theta[:-3], theta[-3]
        false_toxic, false_clean = 0.4 / (1 + np.exp(-theta[-2:]))
        s = bias + np.bincount(row, weights=w[column], minlength=held)
        q, q0 = 1 / (1 + np.exp(-s)), 1 / (1 + np.exp(-bias))
        clean = np.exp(-(np.bincount(doc, weights=np.logaddexp(0, s), minlength=n) + plain * np.logaddexp(0, bias)))
        latent = 1 - clean
        chance = np.clip(false_toxic + (1 - false_toxic - false_clean) * latent, 1e-9, 1 - 1e-9)
        by_chance = ((1 - toxic) / (1 - chance) - toxic / chance) / n
        by_sum = by_chance * (1 - false_toxic - false_clean) * clean
        by_s = by_sum[doc] * q
        gradient = np.concatenate([np.bincount(column, weights=by_s[row], minlength=len(w)), [by_s.sum() + (by_sum * plain).sum() * q0, (by_chance * (1 - latent)).sum() * false_toxic * (1 - false_toxic / 0.4), -(by_chance * latent).sum() * false_clean * (1 - false_clean / 0.4)]])
        gradient += np.concatenate([3e-6 * w, [1e-4 * (bias + 9)], [0, 0]])
        first, second = 0.9 * first + 0.1 * gradient, 0.99 * second + 0.01 * gradient**2
        theta -= rate * (first / (1 - 0.9**step)) / (np.sqrt(second / (1 - 0.99**step)) + 1e-9)
    return Model(chosen, theta[:-3], float(theta[-3]))


def _score(batches: Iterator[pa.RecordBatch], model: Model, offending: float, with_id: bool = True) -> Iterator[pa.RecordBatch]:
    for batch in slices(batches, 2 if with_id else 0):
        found, data, offsets = read(batch.column(batch.num_columns - 1))
        s = np.full(len(found.start), model.bias)
        if len(model.words) and len(found.words):
            at = np.searchsorted(model.words, found.words).clip(0, len(model.words) - 1)
            hit = model.words[at] == found.words
            s += np.bincount(found.of[hit], weights=model.weights[at[hit]], minlength=len(s))
        sums = np.concatenate([[0], np.cumsum(np.logaddexp(0, s))])
        total = sums[found.first[1:]] - sums[found.first[:-1]]
        total[found.first[1:] == found.first[:-1]] = np.logaddexp(0, model.bias)
        bad = np.flatnonzero(s >= np.log(offending / (1 - offending)))
        points = np.concatenate([[0], np.cumsum((data & 0xC0) != 0x80)])
        text = np.searchsorted(found.first, bad, "right") - 1
        starts = points[found.start[bad]] - points[offsets[text]]
        place = pa.array(np.searchsorted(bad, found.first), pa.int32())
        sentence = pa.StructArray.from_arrays([pa.array(starts), pa.array(points[found.end[bad]] - points[found.start[bad]]), pa.array(1 / (1 + np.exp(-s[bad])))], ["start", "length", "score"])
        columns = [*batch.columns[:-1], pa.array(-np.expm1(-total)), pa.ListArray.from_arrays(place, sentence)]
        yield pa.RecordBatch.from_arrays(columns, [*batch.schema.names[:-1], "score", "sentences"])


def score(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text", threshold: float = 0.7, offending: float = 0.5) -> DataFrame:
    """One row for each row of ``docs``: doc_id, held_out, score, predicted, and ``sentences``, the start, length (in code
    points) and score of those that score ``offending`` or more.

    A null text counts as empty; a text without words scores as one sentence without known words. Null ids are given
    back as null and count as not held out. Rows that repeat are scored alike. Other columns are not read.
    """
    rows = docs.select(F.col(f"`{id_col}`").alias("doc_id"), held_out(id_col).alias("held_out"), text_of(text_col).alias("text"))
    kind = "doc_id " + rows.schema["doc_id"].dataType.simpleString()
    schema = f"{kind}, held_out boolean, score double, sentences array<struct<start: bigint, length: bigint, score: double>>"
    scored = rows.mapInArrow(lambda batches: _score(batches, model, offending), schema)
    return scored.select("doc_id", "held_out", "score", (F.col("score") >= threshold).cast("int").alias("predicted"), "sentences")


def without_toxic(docs: DataFrame, model: Model, text_col: str = "text", threshold: float = 0.7) -> DataFrame:
    """The rows of ``docs``, all columns as they are, that score below the threshold. One pass, no shuffle."""

    at = docs.columns.index(text_col)

    def clean(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, at):
            [scored] = _score(iter([pa.RecordBatch.from_arrays([batch.column(at)], ["text"])]), model, 0.5, with_id=False)
            yield batch.filter(pa.array(scored.column(0).to_numpy() < threshold))

    return docs.mapInArrow(clean, docs.schema)


def op10_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return score(docs, fit(docs, table(spark, sf_dir, "labels"))).drop("sentences")
