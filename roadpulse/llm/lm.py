"""Log-probabilities of texts under a smoothed word n-gram model.

A text is its words (A-Z lowered) and one end.  The model is a weighted backoff
automaton: a state per context seen in training, an arc per n-gram seen, and from
each state a failure arc to the state of the context without its first word.
With c the training counts,

    p(w | h) = (c(h w) + PULL * p(w | h')) / (c(h) + PULL),   h' = h without its first word,

a hierarchical Dirichlet model (MacKay and Peto, 1995), which ends in the base
(c(w) + 1) / (N + V + 1).  For an n-gram not seen this is the failure weight
PULL / (c(h) + PULL) times the shorter context's probability, so the failure arcs
give it exactly, and a state's probabilities add up to one.  A text is read once
from left to right: each token takes the arc out of the state reached, or falls
until one has such an arc, and its weight is added.

The automaton grows with the corpus, so no task holds all of it.  Texts are
gathered into blocks of ``BLOCK`` bytes, kept as word numbers with the block's
words.  A block sends its distinct n-grams (a 64-bit hash, the order in its low
bits, and how often its training texts have them), sorted and cut at the bounds
of ``BUCKET``-sized hash ranges; a range adds up the counts of all blocks and
answers each with what the others have.  The answers of all ranges, in order, are
the counts of the block's own n-grams, from which it builds the part of the
automaton its texts pass through.  A range has at most one entry per n-gram and
block, however frequent the n-gram.  An entry takes about six bytes.

Null texts count as empty: one end.  Null ids are not held out and not learned
from.  Repeated rows are learned from and scored each.  With nothing to learn
from every token has probability 1 / (0 + 0 + 1).  Two words that share a hash
would count as one; with 64 bits that takes billions of words.  Further columns
are ignored; an empty table gives an empty result.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from roadpulse.llm.language import fold
from roadpulse.llm.textbytes import BASE, BASE2, Tokeniser, mix, slices
from roadpulse.llm.work import map_batches, small_batches, texts, written

ORDER = 2
# of 2, 20 and 200 the best on held-out rows of the test tables
PULL = 200.0
BLOCK = 8 << 20
# n-grams sent to one range, about
BUCKET = 1 << 19
START, END = (np.uint64(mix(np.array([k], dtype=np.uint64))[0]) for k in (0x5354415254, 0x454E44))
LOW = np.uint64(7)


def squeeze(values: np.ndarray) -> bytes:
    """Numbers by byte position, compressed."""
    raw = np.ascontiguousarray(values).view(np.uint8).reshape(len(values), values.itemsize).T.tobytes()
    return pa.Codec("zstd", compression_level=1).compress(raw, asbytes=True)


def loosen(packed: bytes, n: int, kind) -> np.ndarray:
    size = np.dtype(kind).itemsize
    raw = pa.Codec("zstd").decompress(packed, decompressed_size=n * size, asbytes=True) if n else b""
    return np.frombuffer(raw, dtype=np.uint8).reshape(size, n).T.copy().view(kind).ravel()


def distinct(values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Sorted distinct values and the place of each value among them."""
    order = np.argsort(values, kind="stable")
    ordered = values[order]
    new = np.ones(len(values), dtype=bool)
    new[1:] = ordered[1:] != ordered[:-1]
    place = np.empty(len(values), dtype=np.int64)
    place[order] = np.cumsum(new) - 1
    return ordered[new], place


def blocks(docs: DataFrame, size: int) -> DataFrame:
    """One row per block: its documents' ids, whether they are learned from, their
    number of words; the block's words by falling frequency, and the texts as
    numbers of words.  ``docs`` has ``doc_id, text, learned``."""

    def make():
        tokeniser = Tokeniser("space", True)
        state = {"n": 0, "bytes": 0}
        part = (TaskContext.get().partitionId() if TaskContext.get() else 0) << 33
        ids, learned, hashes, sizes = [], [], [], []

        def flush():
            words, place = distinct(np.concatenate(hashes))
            often = np.argsort(-np.bincount(place, minlength=len(words)), kind="stable")
            number = np.empty(len(words), dtype=np.uint32)
            number[often] = np.arange(len(words))
            size, known = np.concatenate(sizes), np.concatenate(learned)
            row = {
                "block": [part + state["n"]],
                "doc_id": pa.array([pa.concat_arrays(ids)], type=pa.list_(pa.int64())),
                "learned": pa.array([pa.array(known)], type=pa.list_(pa.bool_())),
                "size": pa.array([pa.array(size)], type=pa.list_(pa.int64())),
                "n_words": [len(words)],
                "words": [squeeze(words[often])],
                "n_tokens": [len(place)],
                "tokens": [squeeze(number[place])],
                "train_tokens": [int(((size + 1) * known).sum())],
            }
            for kept in (ids, learned, hashes, sizes):
                kept.clear()
            state["n"] += 1
            state["bytes"] = 0
            return row

        def step(batch):
            for low, high, data, offsets in slices(batch.column("text")):
                words = tokeniser.words(data, offsets)
                ids.append(batch.column("doc_id").slice(low, high - low))
                learned.append(batch.column("learned").slice(low, high - low).to_numpy(zero_copy_only=False))
                hashes.append(words.hashes)
                sizes.append(np.diff(words.first))
                state["bytes"] += len(data)
                if state["bytes"] >= size:
                    yield flush()

        def finish():
            if ids:
                yield flush()

        step.finish = finish
        return step

    schema = (
        "block long, doc_id array<long>, learned array<boolean>, size array<long>, n_words long, words binary,"
        " n_tokens long, tokens binary, train_tokens long"
    )
    return map_batches(docs, make, schema)


class Stream:
    """The texts of a block one after the other, each with a start and an end,
    and the n-grams that end at each place."""

    def __init__(self, row: dict, order: int):
        size = np.asarray(row["size"], dtype=np.int64)
        words = loosen(row["words"], row["n_words"], np.uint64)
        self.learned = np.asarray(row["learned"], dtype=bool)
        self.first = np.concatenate(([0], np.cumsum(size + 2)))
        n = int(self.first[-1])
        token = np.empty(n, dtype=np.uint64)
        inside = np.ones(n, dtype=bool)
        inside[self.first[:-1]] = inside[self.first[1:] - 1] = False
        token[self.first[:-1]], token[self.first[1:] - 1] = START, END
        token[inside] = words[loosen(row["tokens"], row["n_tokens"], np.uint32)]
        self.place = np.arange(n) - np.repeat(self.first[:-1], size + 2)
        self.doc = np.repeat(np.arange(len(size)), size + 2)
        # grams[m - 1]: n-gram of m tokens that ends here, where[m - 1]: places that have one
        gram = mix(token * np.uint64(BASE) + np.uint64(1))
        self.grams, self.where = [gram & ~LOW | np.uint64(1)], [np.arange(n)]
        for m in range(2, order + 1):
            at = np.flatnonzero(self.place >= m - 1)
            head = token[at - (m - 1)]
            longer = np.zeros(n, dtype=np.uint64)
            longer[at] = mix(gram[at] * np.uint64(BASE) + mix(head + np.uint64(m)))
            gram = longer
            self.grams.append(gram[at] & ~LOW | np.uint64(m))
            self.where.append(at)


START_KEY = np.uint64(mix(np.array([int(START) * BASE % 2**64 + 1], dtype=np.uint64))[0]) & ~LOW | np.uint64(1)


def edges(ranges: int) -> np.ndarray:
    """First hash of each range but the first."""
    return np.array([-(-(k << 64) // ranges) for k in range(1, ranges)], dtype=np.uint64)


def sent(table: DataFrame, order: int, ranges: int) -> DataFrame:
    """``block, range, n, grams, counts``: a block's distinct n-grams in a hash range."""
    bounds = edges(ranges)

    def make():
        def step(batch):
            for row in batch.to_pylist():
                stream = Stream(row, order)
                every = np.sort(np.concatenate(stream.grams))
                grams = every[np.concatenate(([True], every[1:] != every[:-1]))]
                own = np.sort(np.concatenate([g[stream.learned[stream.doc[w]]] for g, w in zip(stream.grams, stream.where)]))
                counts = (np.searchsorted(own, grams, side="right") - np.searchsorted(own, grams)).astype(np.uint32)
                cut = np.concatenate(([0], np.searchsorted(grams, bounds), [len(grams)]))
                some = np.flatnonzero(np.diff(cut))
                for few in np.array_split(some, -(-len(some) // 256)):
                    spans = [slice(cut[k], cut[k + 1]) for k in few]
                    yield {
                        "block": [row["block"]] * len(few),
                        "range": few,
                        "n": np.diff(cut)[few],
                        "grams": [squeeze(np.diff(grams[s], prepend=np.uint64(0))) for s in spans],
                        "counts": [squeeze(counts[s]) for s in spans],
                    }

        return step

    return map_batches(table, make, "block long, range int, n long, grams binary, counts binary")


def answered(entries: DataFrame) -> DataFrame:
    """``block, range, n, others, known``: counts that a range's other blocks have
    of the block's n-grams.  One more row per range (block null) has the number
    of words it knows."""
    small_batches(entries.sparkSession)
    schema = "block long, range int, n long, others binary, known long"

    def reply(table):
        size = table.column("n").to_numpy()
        read = [
            (np.cumsum(loosen(g.as_py(), n, np.uint64), dtype=np.uint64), loosen(c.as_py(), n, np.uint32))
            for g, c, n in zip(table.column("grams"), table.column("counts"), size.tolist())
        ]
        grams, own = (np.concatenate(x) for x in zip(*read))
        own = own.astype(np.int64)
        names, place = distinct(grams)
        total = np.zeros(len(names), dtype=np.int64)
        np.add.at(total, place, own)
        others = (total[place] - own).astype(np.uint64)
        ends = np.cumsum(size)
        known = int(((names & LOW == 1) & (names != START_KEY) & (total > 0)).sum())
        packed = [squeeze(others[e - n : e]) for e, n in zip(ends.tolist(), size.tolist())]
        bucket = table.column("range").to_pylist()
        return pa.table(
            {
                "block": pa.array([*table.column("block").to_pylist(), None], type=pa.int64()),
                "range": pa.array([*bucket, bucket[0]], type=pa.int32()),
                "n": pa.array([*size.tolist(), 0], type=pa.int64()),
                "others": pa.array([*packed, b""], type=pa.binary()),
                "known": pa.array([0] * len(bucket) + [known], type=pa.int64()),
            }
        )

    return entries.groupBy("range").applyInArrow(reply, schema)


class Automaton:
    """The states and arcs that a block's texts can pass through.

    ``place[m - 1]`` numbers the n-gram of m tokens ending at each place of
    ``where[m - 1]``; an n-gram with a count is an arc, and a state if shorter
    than ``order``."""

    def __init__(self, stream: Stream, names: np.ndarray, place: np.ndarray, count: np.ndarray, total: int, known: int, pull: float):
        parts = np.split(place, np.cumsum([len(g) for g in stream.grams])[:-1])
        n = len(stream.doc)
        # number of the n-gram ending at each place, -1 where the text is too short
        self.gram = np.full((len(parts), n), -1)
        for m, (w, p) in enumerate(zip(stream.where, parts)):
            self.gram[m, w] = p
        self.count = count
        self.fall = np.log10(pull / (count + pull))
        chance = (count + 1.0) / (total + known + 1.0)
        for m in range(1, len(parts)):
            # an n-gram's context and its shorter form, from any place it ends at
            some, at = parts[m], stream.where[m]
            context, shorter = self.gram[m - 1, at - 1], self.gram[m - 1, at]
            chance[some] = (count[some] + pull * chance[shorter]) / (count[context] + pull)
        self.weight = np.log10(chance)

    def walk(self) -> np.ndarray:
        """Weight of each place's token, given the state the tokens before it lead to."""
        orders, n = self.gram.shape
        out = np.zeros(n)
        open_ = np.ones(n, dtype=bool)
        for m in range(orders - 1, 0, -1):
            # those with a state of m tokens before them that is known
            at = np.flatnonzero(open_ & (self.gram[m] >= 0))
            state = self.gram[m - 1, at - 1]
            at, state = at[self.count[state] > 0], state[self.count[state] > 0]
            arc = self.gram[m, at]
            seen = self.count[arc] > 0
            out[at] += np.where(seen, self.weight[arc], self.fall[state])
            open_[at[seen]] = False
        return out + np.where(open_, self.weight[self.gram[0]], 0.0)


def score(docs: DataFrame, order: int = ORDER, pull: float = PULL, block: int = BLOCK, bucket: int = BUCKET) -> DataFrame:
    """``doc_id, n_tokens, n_known, train_tokens, base_score, score``, one row per
    row of ``docs`` (``doc_id, text, learned``)."""
    table = written(blocks(docs, block), "blocks")
    sums = table.agg(F.coalesce(F.sum("train_tokens"), F.lit(0)), F.coalesce(F.sum("n_tokens"), F.lit(0))).first()
    total, ranges = sums[0], max(1, order * sums[1] // bucket)
    replies = written(answered(sent(table, order, ranges)), "answers")
    known = replies.agg(F.coalesce(F.sum("known"), F.lit(0))).first()[0]

    def read(left, right):
        """A block's texts through its part of the automaton."""
        right = right.sort_by("range")
        others = [loosen(o.as_py(), n, np.uint64) for o, n in zip(right.column("others"), right.column("n").to_pylist())]
        found = []
        for row in left.to_pylist():
            stream = Stream(row, order)
            names, place = distinct(np.concatenate(stream.grams))
            mine = np.concatenate([stream.learned[stream.doc[w]] for w in stream.where])
            count = np.bincount(place[mine], minlength=len(names)) + np.concatenate(others).astype(np.int64)
            machine = Automaton(stream, names, place, count, total, known, pull)
            weight = machine.walk()
            first = stream.first[:-1]
            token = stream.place > 0
            single = machine.gram[0]
            base = np.where(token, np.log10((count[single] + 1.0) / (total + known + 1.0)), 0.0)
            found.append(
                pa.table(
                    {
                        "doc_id": pa.array(row["doc_id"], type=pa.int64()),
                        "n_tokens": np.diff(stream.first) - 1,
                        "n_known": np.add.reduceat((token & (count[single] > 0)).astype(np.int64), first),
                        "train_tokens": np.full(len(first), total),
                        "base_score": np.add.reduceat(base, first),
                        "score": np.add.reduceat(np.where(token, weight, 0.0), first),
                    }
                )
            )
        return pa.concat_tables(found)

    schema = "doc_id long, n_tokens long, n_known long, train_tokens long, base_score double, score double"
    answers = replies.filter("block is not null").select("block", "range", "n", "others")
    return table.groupBy("block").cogroup(answers.groupBy("block")).applyInArrow(read, schema)


def op11_lm_score(spark, sf_dir: str) -> DataFrame:
    docs = texts(spark.read.parquet(f"{sf_dir}/documents.parquet"))
    learned = F.coalesce(fold(7) != 2, F.lit(False))
    found = score(docs.withColumn("learned", learned))
    held_out = F.coalesce(fold(7) == 2, F.lit(False)).alias("held_out")
    return found.select("doc_id", held_out, "n_tokens", "n_known", "train_tokens", "base_score", "score")
