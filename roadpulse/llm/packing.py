"""Documents packed into sequences of at most ``LENGTH`` tokens.

The tokens of the documents of a partition, in the order they are read, are one
stream.  It is cut where a document or a sentence ends, or inside a sentence,
so that padding plus penalties for the cuts is least: with ``cost[j]`` the cost
of the best packing of the first ``j`` tokens,

    cost[i] = penalty(i) + SEQUENCE + min over j in [i - LENGTH, i) of cost[j] + padding(i - j)

where ``SEQUENCE`` is a small price per sequence, so that long ones are preferred.

Padding of a sequence shorter than ``LENGTH`` is ``LENGTH - (i - j)``, so the
minimum runs over ``cost[j] + j`` in a sliding window: a monotone queue gives it
without a search.  A sequence whose length is a power of two needs no padding;
such lengths from an eighth of ``LENGTH`` up are looked up one by one.  Cuts inside a sentence are only
considered where no sentence ends for ``STRIDE`` tokens.

The stream is planned ``HORIZON`` tokens at a time; the last few sequences of a
plan are planned again with what follows.  A task holds one horizon and one
document.  What is left at the end of a partition is cut into powers of two
where that costs less than its padding.

Null and empty texts are a document of the closing token alone.  Repeated rows
are packed each.  A sequence never spans partitions; its id is unique and the
same on every run over the same files.  Further columns are ignored; an empty
table gives an empty result.
"""

from __future__ import annotations

import os
import sys
import types
import zlib
from collections import deque

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame

from roadpulse.llm.textbytes import Tokeniser, slices
from roadpulse.llm.work import map_batches, texts

LENGTH = 4096
CLOSE = 2
STRIDE = 64
SEQUENCE, SENTENCE, INSIDE = 16, 4, 48
HORIZON = 256 * LENGTH
CACHED = 700_000
TEXTS = 1 << 20
# words tokenized in one call
TOGETHER = 200


def default_tokenizer() -> str:
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


class WordIds:
    """Token ids of texts, word by word: the tokenizer never joins letters over
    white space and ignores the case of A-Z, so a word (a run without 0x20 and
    0x09-0x0D) is tokenized once and kept under its hash, in sorted arrays."""

    def __init__(self, path: str):
        # tasks share the cores; threads in each of them only add overhead
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.model = Tokenizer.from_file(path)
        self.words = Tokeniser("space", True)
        special = sorted(self.model.get_added_tokens_decoder().items())
        self.marks = [t.content.encode() for _, t in special]
        # one of these between words keeps their ids apart: a rare word of one
        # token, which costs half as much, or a special token, which no word has
        self.apart = self.rare_word() + [(number, token.content) for number, token in special[-1:]]
        self.clear()

    def rare_word(self) -> list[tuple[int, str]]:
        """The last word of the vocabulary that is one token, with its id."""
        for token, number in sorted(self.model.get_vocab(False).items(), key=lambda x: -x[1]):
            word = token.removesuffix("</w>")
            if word.isascii() and word.isalpha() and self.model.encode(f" {word} ", add_special_tokens=False).ids == [number]:
                return [(number, word)]
        return []

    def clear(self) -> None:
        self.hashes = np.zeros(0, dtype=np.uint64)
        self.size, self.start = np.zeros(0, dtype=np.int32), np.zeros(0, dtype=np.int64)
        self.flat, self.used = np.zeros(1 << 16, dtype=np.uint32), 0

    def tokenized(self, found: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of words, one after the other, and how many each has."""
        joined = b" ".join(found)
        if any(m in joined for m in self.marks):
            return self.tokenized_each(found)
        parts = [self.tokenized_apart([w.decode() for w in found[k : k + TOGETHER]]) for k in range(0, len(found), TOGETHER)]
        return np.concatenate([ids for ids, _ in parts]), np.concatenate([size for _, size in parts])

    def tokenized_apart(self, found: list[str]) -> tuple[np.ndarray, np.ndarray]:
        for number, token in self.apart:
            between = f" {token} "
            text = between.join(found) + between
            ids = np.array(self.model.encode_batch_fast([text], add_special_tokens=False)[0].ids, dtype=np.uint32)
            ends = np.flatnonzero(ids == number)
            # more, if a word holds the rare one
            if len(ends) == len(found):
                return ids[ids != number], np.diff(ends, prepend=-1) - 1
        return self.tokenized_each([w.encode() for w in found])

    def tokenized_each(self, found: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        all_ids = [e.ids for e in self.model.encode_batch_fast([w.decode() for w in found], add_special_tokens=False)]
        return np.array([i for ids in all_ids for i in ids], dtype=np.uint32), np.array([len(ids) for ids in all_ids])

    def add(self, hashes: np.ndarray, found: list[bytes]) -> None:
        """``hashes`` are sorted and new."""
        ids, size = self.tokenized(found)
        while self.used + len(ids) > len(self.flat):
            self.flat = np.append(self.flat, np.zeros_like(self.flat))
        self.flat[self.used : self.used + len(ids)] = ids
        at = np.searchsorted(self.hashes, hashes)
        self.hashes = np.insert(self.hashes, at, hashes)
        self.size = np.insert(self.size, at, size)
        self.start = np.insert(self.start, at, self.used + np.cumsum(size) - size)
        self.used += len(ids)

    def places(self, hashes: np.ndarray) -> np.ndarray:
        """Place of each hash, -1 if it isn't known."""
        if not len(self.hashes):
            return np.full(len(hashes), -1)
        at = np.minimum(np.searchsorted(self.hashes, hashes), len(self.hashes) - 1)
        return np.where(self.hashes[at] == hashes, at, -1)

    def ids(self, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts of a slice, and where each text's ids begin and end."""
        words = self.words.words(data, offsets)
        distinct, at, back = np.unique(words.hashes, return_index=True, return_inverse=True)
        if len(self.hashes) + len(distinct) > max(CACHED, 2 * len(distinct)):
            self.clear()
        new = np.flatnonzero(self.places(distinct) < 0)
        if len(new):
            raw = words.data.tobytes()
            low, high = words.starts[at[new]].tolist(), words.ends[at[new]].tolist()
            self.add(distinct[new], [raw[x:y] for x, y in zip(low, high)])
        place = self.places(distinct)
        size, start = self.size[place][back].astype(np.int64), self.start[place][back]
        ends = np.cumsum(size)
        index = np.arange(ends[-1] if len(ends) else 0) + np.repeat(start - (ends - size), size)
        return self.flat[index], np.concatenate(([0], ends))[words.first]


def word_ids(path: str) -> WordIds:
    """Kept between the tasks of a Python worker."""
    kept = sys.modules.setdefault("_word_ids", types.ModuleType("_word_ids"))
    if not hasattr(kept, "of") or kept.of[0] != path:
        kept.of = (path, WordIds(path))
    return kept.of[1]


def sentence_ends(path: str) -> np.ndarray:
    """Marks the ids of tokens that end with . ! or ?"""
    from tokenizers import Tokenizer

    vocabulary = Tokenizer.from_file(path).get_vocab()
    marks = np.zeros(max(vocabulary.values(), default=0) + CLOSE + 1, dtype=bool)
    for token, i in vocabulary.items():
        marks[i] = token.removesuffix("</w>")[-1:] in (".", "!", "?")
    return marks


def cuts(ids: np.ndarray, doc_ends: np.ndarray, marks: np.ndarray, stride: int) -> tuple[np.ndarray, np.ndarray]:
    """Places where the stream may be cut (after so many tokens), and penalties."""
    soft = np.flatnonzero(marks[ids]) + 1
    at = np.union1d(soft, doc_ends)
    at = at[at < len(ids)]
    edges = np.concatenate(([0], at, [len(ids)]))
    gap = np.diff(edges)
    wide = np.flatnonzero(gap > stride)
    extra = [np.arange(edges[k] + stride, edges[k + 1], stride) for k in wide.tolist()]
    inside = np.concatenate(extra) if extra else np.zeros(0, dtype=np.int64)
    places = np.concatenate((at, inside, [len(ids)]))
    penalty = np.concatenate((np.full(len(at), SENTENCE), np.full(len(inside), INSIDE), [0]))
    penalty[np.isin(places, doc_ends)] = 0
    order = np.argsort(places, kind="stable")
    return places[order], penalty[order]


def plan(places: np.ndarray, penalty: np.ndarray, length: int) -> list[int]:
    """Cuts of the cheapest packing from 0 to the last place."""
    spots, prices = [0, *places.tolist()], [0, *penalty.tolist()]
    line = np.array(spots)
    # by place: places a power of two before it, nearest first
    exact: dict[int, list[int]] = {}
    for w in [1 << k for k in range(length.bit_length()) if length // 8 <= 1 << k < length]:
        at = np.searchsorted(line, line - w)
        for i in np.flatnonzero(line[at] == line - w).tolist():
            exact.setdefault(i, []).append(int(at[i]))
    cost, came = [0] * len(spots), [0] * len(spots)
    queue: deque[tuple[int, int]] = deque([(0, 0)])
    for i in range(1, len(spots)):
        p = spots[i]
        while spots[queue[0][1]] < p - length:
            queue.popleft()
        least, j = queue[0][0] + length - p, queue[0][1]
        for k in exact.get(i, ()):
            if cost[k] < least:
                least, j = cost[k], k
        cost[i], came[i] = least + prices[i] + SEQUENCE, j
        value = cost[i] + p
        while queue and queue[-1][0] >= value:
            queue.pop()
        queue.append((value, i))
    out, i = [], len(spots) - 1
    while i:
        out.append(spots[i])
        i = came[i]
    return out[::-1]


def powers_of(n: int) -> list[int]:
    return [1 << k for k in range(n.bit_length() - 1, -1, -1) if n >> k & 1]


def pack(docs: DataFrame, tokenizer: str | None = None, length: int = LENGTH, with_ids: bool = True) -> DataFrame:
    """One row per piece of a document: ``doc_id, start, length, ids_crc32``
    (checksum of the ids, little-endian and unsigned), ``doc_tokens, sequence_id,
    offset`` and, if asked for, ``ids`` (the piece's token ids)."""
    path = tokenizer or default_tokenizer()

    def make():
        lookup, marks = word_ids(path), sentence_ends(path)
        part = (TaskContext.get().partitionId() if TaskContext.get() else 0) << 33
        # documents whose tokens are not all packed: id, ids, packed so far
        waiting: deque[list] = deque()
        state = {"tokens": 0, "sequence": 0}

        def emit(sizes: list[int]):
            """Rows of the next sequences, of these sizes."""
            rows = {k: [] for k in ("doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset", "ids")}
            for size in sizes:
                offset = 0
                while offset < size:
                    doc_id, ids, done = waiting[0]
                    n = min(len(ids) - done, size - offset)
                    own = ids[done : done + n]
                    crc = zlib.crc32(own.astype("<u4").tobytes())
                    for k, v in zip(rows, (doc_id, done, n, crc, len(ids), part + state["sequence"], offset, own)):
                        rows[k].append(v)
                    offset += n
                    if done + n == len(ids):
                        waiting.popleft()
                    else:
                        waiting[0][2] = done + n
                state["sequence"] += 1
                state["tokens"] -= size
            own = rows.pop("ids")
            if with_ids:
                ends = np.cumsum([0, *map(len, own)], dtype=np.int32)
                flat = np.concatenate(own or [np.zeros(0, dtype=np.uint32)]).astype(np.int32)
                rows["ids"] = pa.ListArray.from_arrays(pa.array(ends), pa.array(flat))
            return rows

        def planned(last: bool):
            ids = np.concatenate([w[1][w[2] :] for w in waiting])
            ends = np.cumsum([len(w[1]) - w[2] for w in waiting])
            if not last:
                ids, ends = ids[:HORIZON], ends[ends <= HORIZON]
            sizes = np.diff([0, *plan(*cuts(ids, ends, marks, STRIDE), length)]).tolist()
            if not last:
                return emit(sizes[: max(1, len(sizes) - 4)])
            final = []
            for n in sizes:
                parts = powers_of(n)
                final += parts if length - n > (INSIDE + SEQUENCE) * (len(parts) - 1) else [n]
            return emit(final)

        def step(batch):
            names = batch.column("doc_id").to_pylist()
            for low, high, data, offsets in slices(batch.column("text"), TEXTS):
                ids, edges = lookup.ids(data, offsets)
                for k in range(high - low):
                    own = np.append(ids[edges[k] : edges[k + 1]], np.uint32(CLOSE))
                    waiting.append([names[low + k], own, 0])
                    state["tokens"] += len(own)
                while state["tokens"] >= HORIZON:
                    yield planned(False)

        def finish():
            if waiting:
                yield planned(True)

        step.finish = finish
        return step

    schema = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long"
    return map_batches(texts(docs), make, schema + ", ids array<int>" * with_ids)


def op5_packing(spark, sf_dir: str) -> DataFrame:
    return pack(spark.read.parquet(f"{sf_dir}/documents.parquet"), with_ids=False)
