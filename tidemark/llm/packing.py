"""Packing of documents into sequences: Martello-Toth dominance reduction, then best fit on what is left.

Tokens are counted in one pass over the texts. How pieces go together depends on their lengths alone, so the plan is
made on the histogram of lengths (at most ``capacity`` rows, whatever the size of the table): all pieces of one
length are one class with a count, and a decision is taken for as many bins as its classes allow. The plan is a list of
runs, which send the ranks of a class to sequences; each piece looks up the run of its rank where it is read.

Ranks need no sort: a piece carries the task that read it and its number among that task's pieces of its length, and
only the tasks' counts are summed up.
"""

from __future__ import annotations

import json
import os
import zlib
from collections.abc import Iterator
from functools import lru_cache, partial
from itertools import filterfalse

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidemark.llm.common import kept, table, text_of

CAPACITY = 2048
#: Words that a task remembers the ids of; the memory starts anew beyond.
REMEMBERED = 800_000
#: What may follow a word of letters and is then a token group of its own.
_TAIL = ".,!?;:%&*$#|"
# What a tokenizer file says if words between white space can be read one by one, in lower case. Others read whole texts.
_NORMALIZER = {"type": "Sequence", "normalizers": [{"type": "NFC"}, {"type": "Replace", "pattern": {"Regex": "\\s+"}, "content": " "}, {"type": "Lowercase"}]}
_PRE_TOKENIZER = {
    "type": "Sequence",
    "pretokenizers": [
        {"type": "Split", "pattern": {"Regex": "'s|'t|'re|'ve|'m|'ll|'d|[\\p{L}]+|[\\p{N}]|[^\\s\\p{L}\\p{N}]+"}, "behavior": "Removed", "invert": True},
        {"type": "ByteLevel", "add_prefix_space": False, "trim_offsets": True, "use_regex": False},
    ],
}


def default_tokenizer() -> str:
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


class Words(dict):
    """The ids, as little-endian unsigned 32-bit numbers, of words between white space."""

    def __init__(self, path: str) -> None:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # a task has one core
        from tokenizers import Tokenizer

        super().__init__()
        self.tokenizer = Tokenizer.from_file(path)
        says = json.loads(self.tokenizer.to_str())
        self.by_words = says["normalizer"] == _NORMALIZER and says["pre_tokenizer"] == _PRE_TOKENIZER

    def learn(self, words: set[str]) -> None:
        new = set(filterfalse(self.__contains__, words))
        if len(self) + len(new) > REMEMBERED:
            self.clear()
            new = words
        split = {}
        for word in new:
            core = word.rstrip(_TAIL)
            if core.isalpha() and (len(core) < len(word) or not core.islower()):
                # character by character, as the tokenizer does it: str.lower() has another sigma at the end of words
                low = core.lower() if "\u03a3" not in core else "".join(c.lower() for c in core)
                split[word] = (low if len(low) == len(core) else core), word[len(core) :]
        parts = {part for both in split.values() for part in both if part and part not in self}
        self._encode(new.difference(split) | parts)
        for word, (core, tail) in split.items():
            self[word] = self[core] + self[tail] if tail else self[core]

    def _encode(self, words: set[str]) -> None:
        """Words of letters are one token group each, so many of them are read as one text; others are read one by one."""
        letters = [w for w in words if w.isalpha()]
        rest = [w for w in words if not w.isalpha()]
        for i in range(0, len(letters), 2000):
            some = letters[i : i + 2000]
            found = self.tokenizer.encode(" ".join(some), add_special_tokens=False)
            group = np.array(found.word_ids, np.int64)
            ids = np.array(found.ids, "<u4")
            ends = np.searchsorted(group, np.arange(len(some)), "right") * 4
            if len(group) and group[-1] == len(some) - 1 and ends[0] and (np.diff(ends) > 0).all():
                raw = ids.tobytes()
                self.update(zip(some, (raw[a:b] for a, b in zip([0, *ends[:-1]], ends, strict=True)), strict=True))
            else:
                rest += some
        for word, found in zip(rest, self.tokenizer.encode_batch(rest, add_special_tokens=False), strict=True):
            self[word] = np.array(found.ids, "<u4").tobytes()


@lru_cache(1)
def _words(path: str) -> Words:
    return Words(path)


def _split(text: str) -> list[str]:
    """The text at white space. Python's own split also takes four control characters that the tokenizer does not."""
    if any(c in text for c in "\x1c\x1d\x1e\x1f"):
        return "".join(" " if c.isspace() and c not in "\x1c\x1d\x1e\x1f" else c for c in text).split(" ")
    return text.split()


def tokenize(texts: list[str], path: str) -> list[bytes]:
    """Each text's ids, then id 0. Where white space always ends a token, words are looked up one by one."""
    known = _words(path)
    out: list[bytes] = []
    if not known.by_words:
        return [np.array([*known.tokenizer.encode(text, add_special_tokens=False).ids, 0], "<u4").tobytes() for text in texts]
    for i in range(0, len(texts), 1000):
        split = [_split(text) for text in texts[i : i + 1000]]
        known.learn(set().union(*split))
        out += [b"".join(map(known.__getitem__, words)) + b"\0\0\0\0" for words in split]
    return out


def _pieces(batches: Iterator[pa.RecordBatch], path: str, capacity: int, with_ids: bool) -> Iterator[pa.RecordBatch]:
    part = TaskContext.get().partitionId()
    seen = np.zeros(capacity + 1, np.int64)
    for batch in batches:
        rows, pieces, lengths, crcs, ids = [], [], [], [], []
        for row, found in enumerate(tokenize(batch.column(1).to_pylist(), path)):
            for piece, at in enumerate(range(0, len(found), 4 * capacity)):
                cut = found[at : at + 4 * capacity]
                rows.append(row)
                pieces.append(piece)
                lengths.append(len(cut) // 4)
                crcs.append(zlib.crc32(cut))
                ids.append(cut)
        size = np.array(lengths, np.int64)
        order = np.argsort(size, kind="stable")
        ordered = size[order]
        place = np.empty(len(size), np.int64)
        place[order] = np.arange(len(size)) - np.searchsorted(ordered, ordered)
        place += seen[size]
        seen += np.bincount(size, minlength=capacity + 1)
        number = np.array(pieces, np.int64)
        out = {"doc_id": batch.column(0).take(pa.array(rows, pa.int64())), "piece": pa.array(number, pa.int32()), "start": number * capacity, "length": size, "ids_crc32": pa.array(crcs, pa.int64()), "part": np.full(len(size), part, np.int64), "place": place}
        yield pa.RecordBatch.from_pydict(out | ({"ids": pa.array(ids, pa.binary())} if with_ids else {}))


class Plan:
    """Runs that send ranks of a length to sequences: ``count`` ranks from ``rank`` on go one each to the sequences from
    ``sequence`` on, at ``offset``."""

    def __init__(self, capacity: int) -> None:
        self.capacity, self.sequences = capacity, 0
        self.used = np.zeros(capacity + 1, np.int64)  # ranks given away, by length
        self.runs: list[tuple[int, int, int, int]] = []

    def place(self, length: int, bins: int, sequence: int, offset: int) -> None:
        self.runs.append((length, int(self.used[length]), sequence, offset))
        self.used[length] += bins

    def open(self, items: list[int], bins: int) -> int:
        """So many new sequences with these items each; the first one's number."""
        first, at = self.sequences, 0
        for item in items:
            self.place(item, bins, first, at)
            at += item
        self.sequences += bins
        return first


def dominating(left: np.ndarray, j: int, capacity: int) -> list[int] | None:
    """Items that go with one item of length ``j`` in some best packing of ``left`` (counts by length), if that is sure.

    A set dominates another if its items can be swapped for groups of the other's, each group no longer than the item.
    """
    room = capacity - j
    others = left[: room + 1].copy()
    if j <= room:
        others[j] -= 1
    fits = np.flatnonzero(others > 0)
    if not len(fits):
        return [j]  # nothing goes with it
    k = int(fits[-1])
    small = np.repeat(fits[:3], np.minimum(others[fits[:3]], 3))[:3]
    if k == room or len(small) < 2 or small[:2].sum() > room:
        return [j, k]  # a full sequence, or no third item fits
    if len(small) == 3 and small.sum() <= room:
        return None  # sets of four are possible
    # the best partner of each r: the largest s of at most r with r + s in the room
    below = np.maximum.accumulate(np.where(others > 0, np.arange(room + 1), 0))
    strictly = np.concatenate([[0], below[:-1]])
    limit = np.minimum(fits, room - fits)
    s = np.where((limit == fits) & (others[fits] < 2), strictly[limit], below[np.maximum(limit, 0)])
    s = np.where(s > 0, s, 0)
    pairs = fits + s
    if pairs[s > 0].max(initial=0) <= k:
        return [j, k]  # any pair fits in the place of k
    own = others.copy()
    own[k] -= 1
    b = int(np.flatnonzero(own[: room - k + 1] > 0)[-1]) if (own[: room - k + 1] > 0).any() else 0
    if b and s.max() <= b:
        return [j, k, b]  # of any pair the larger is at most k and the smaller at most b
    return None


def plan(counts: np.ndarray, capacity: int) -> Plan:
    """``counts[n]`` pieces of n tokens, n up to ``capacity``."""
    made, left = Plan(capacity), counts.astype(np.int64).copy()
    changed = True
    while changed:
        changed = False
        for j in range(capacity, 0, -1):
            while left[j] > 0 and (items := dominating(left, j, capacity)):
                need = np.bincount(items, minlength=capacity + 1)
                held = np.flatnonzero(need)
                bins = int((left[held] // need[held]).min())
                made.open(items, bins)
                left[held] -= need[held] * bins
                changed = True
    # best fit, largest first; spaces[r]: sequences with room for r tokens, as first one and count
    spaces: list[list[tuple[int, int]]] = [[] for _ in range(capacity + 1)]
    for length in range(capacity, 0, -1):
        n = int(left[length])
        for room in range(length, capacity + 1):
            while n and spaces[room]:  # a sequence stays the best fit for as long as the length fits in it
                first, bins = spaces[room].pop()
                n = _fill(made, spaces, length, n, first, bins, room)
            if not n:
                break
        if n:
            bins = -(-n // (capacity // length))
            first = made.sequences
            made.sequences += bins
            _fill(made, spaces, length, n, first, bins, capacity)
    return made


def _fill(made: Plan, spaces: list[list[tuple[int, int]]], length: int, n: int, first: int, bins: int, room: int) -> int:
    """Put up to ``n`` items into ``bins`` sequences with ``room`` tokens left, as many as fit in one before the next."""
    each = room // length
    full, over = divmod(min(n, each * bins), each)
    for start, some, items in ((first, full, each), (first + full, 1 if over else 0, over)):
        if some:
            for i in range(items):
                made.place(length, some, start, made.capacity - room + i * length)
            spaces[room - items * length].append((start, some))
    touched = full + (1 if over else 0)
    if touched < bins:
        spaces[room].append((first + touched, bins - touched))
    return n - full * each - over


def _look_up(batches: Iterator[pa.RecordBatch], keys: np.ndarray, runs: np.ndarray) -> Iterator[pa.RecordBatch]:
    """Adds where each piece goes; its rank within its length is the last column."""
    for batch in batches:
        rank = batch.column(batch.num_columns - 1).to_numpy()
        length = batch.column(batch.schema.get_field_index("length")).to_numpy()
        at = np.searchsorted(keys, (length << 44) + rank, "right") - 1
        columns = [*batch.columns[:-1], pa.array(runs[at, 2] + rank - runs[at, 1]), pa.array(runs[at, 3])]
        yield pa.RecordBatch.from_arrays(columns, [*batch.schema.names[:-1], "sequence_id", "offset"])


def pack(docs: DataFrame, capacity: int = CAPACITY, tokenizer: str | None = None, with_ids: bool = True, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row for each piece: doc_id, piece, start, length, ids_crc32, sequence_id, offset, and ids (binary, little-endian
    unsigned 32-bit) if asked for.

    A null or empty text is one piece of one token, id 0. Only texts of more than ``capacity`` tokens are cut. Rows
    that repeat are packed each on its own; a null id is given back as null. Other columns are not read. An empty table
    gives no rows.
    """
    path = tokenizer or default_tokenizer()
    rows = docs.select(F.col(f"`{id_col}`").alias("doc_id"), text_of(text_col).alias("text"))
    columns = f"doc_id {rows.schema['doc_id'].dataType.simpleString()}, piece int, start long, length long, ids_crc32 long, part long, place long"
    cut = partial(_pieces, path=path, capacity=capacity, with_ids=with_ids)
    pieces = kept(rows.mapInArrow(cut, columns + ", ids binary" * with_ids), "pieces")
    of_tasks = kept(pieces.groupBy("length", "part").agg(F.count("*").alias("pieces")), "lengths")
    counts = np.zeros(capacity + 1, np.int64)
    for length, n in of_tasks.groupBy("length").agg(F.sum("pieces")).collect():  # at most ``capacity`` rows
        counts[length] = n
    runs = np.array(plan(counts, capacity).runs, np.int64).reshape(-1, 4)
    runs = runs[np.lexsort((runs[:, 1], runs[:, 0]))]
    before = Window.partitionBy("length").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    starts = of_tasks.select("length", "part", F.coalesce(F.sum("pieces").over(before), F.lit(0)).alias("first"))
    wanted = ["doc_id", "piece", "start", "length", "ids_crc32", *(["ids"] if with_ids else [])]
    ranked = pieces.join(starts, ["length", "part"]).select(*wanted, (F.col("first") + F.col("place")).alias("rank"))
    schema = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in ranked.schema.fields[:-1])
    find = partial(_look_up, keys=(runs[:, 0] << 44) + runs[:, 1], runs=runs)
    return ranked.mapInArrow(find, schema + ", sequence_id long, offset long")


def op3_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack(table(spark, sf_dir, "documents"), with_ids=False)
