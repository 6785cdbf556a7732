"""Toxicity of a text by a bidirectional gated recurrent network.

A word enters the network twice: as a word (an embedding per hash bucket) and
through its characters (the mean of the embeddings of its letter trigrams), so
that unseen forms of a known stem are recognised.  Two gated recurrent layers
read a window of ``WINDOW`` words from both ends, attention weighs the places,
and a logistic unit scores the window.  Windows start every ``STRIDE`` words,
overlap by half, and cover the whole text (17 neighbouring words or fewer lie whole
in one); a text's score is that of its worst window.

Training is done here, in numpy, on a sample of labelled documents: at most
``POSITIVES`` toxic and ``NEGATIVES`` other ones of at most ``LONGEST``
characters, by the order of a hash of their ids.  Only windows of a toxic text
that look toxic are trained as such (the label is the text's, not the
window's): first by word frequencies, then by the network's own scores.

Null and empty texts are one window of padding and get a score as well.
Labels that are null are left out; a document with several labels is toxic if
one says so.  Without labels of both kinds every score is the share of toxic
labels (0.5 without any).  Repeated rows get a result each; further columns
are ignored.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from roadpulse.llm.language import fold
from roadpulse.llm.textbytes import Tokeniser, mix, slices
from roadpulse.llm.work import map_batches, texts

WINDOW, STRIDE = 32, 16
WIDTH, HIDDEN, ATTEND = 12, 10, 8
WORD_BUCKETS, GRAM_BUCKETS = 1 << 15, 1 << 14
POSITIVES, NEGATIVES, LONGEST = 1000, 2000, 20_000
ROUNDS, EPOCHS, BATCH, RATE = 3, 3, 128, 5e-3
CHUNK = 4096


def grams_of(words, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Buckets of the byte trigrams of the words ``at``, with marks at both
    ends, and where each word's begin."""
    size = (words.ends - words.starts)[at]
    # a word of n bytes has n trigrams, each around one byte
    first = np.concatenate(([0], np.cumsum(size)))
    place = np.arange(first[-1]) + np.repeat(words.starts[at] - first[:-1], size)
    data = words.data
    low = np.where((data >= 65) & (data <= 90), data + 32, data).astype(np.uint64)
    left = np.where(np.isin(np.arange(first[-1]), first[:-1]), 1, low[np.maximum(place - 1, 0)])
    right = np.where(np.isin(np.arange(first[-1]), first[1:] - 1), 2, low[np.minimum(place + 1, len(data) - 1)])
    key = (left.astype(np.uint64) << np.uint64(16)) | (low[place] << np.uint64(8)) | right.astype(np.uint64)
    return (mix(key) % np.uint64(GRAM_BUCKETS)).astype(np.int64), first[:-1]


def windows_of(first: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Place of every word of every window (-1: padding), and the number of the
    first window of each text; ``first`` has the word range of each text."""
    n = np.diff(first)
    count = np.maximum(1, -(-(n - WINDOW) // STRIDE) + 1)
    begin = np.concatenate(([0], np.cumsum(count)))
    number = np.arange(begin[-1]) - np.repeat(begin[:-1], count)
    start = np.repeat(first[:-1], count) + number * STRIDE
    place = start[:, None] + np.arange(WINDOW)
    return np.where(place < np.repeat(first[1:], count)[:, None], place, -1), begin[:-1]


def sigmoid(x: np.ndarray) -> np.ndarray:
    return 0.5 * np.tanh(0.5 * x) + 0.5


class Network:
    """Forward and backward pass; arrays have a leading axis for the direction."""

    def __init__(self, seed: int = 1):
        rng = np.random.default_rng(seed)

        def normal(*shape, scale):
            return (rng.standard_normal(shape) * scale).astype(np.float32)

        h = HIDDEN
        self.p = {
            "word": normal(WORD_BUCKETS + 1, WIDTH, scale=0.05),
            "gram": normal(GRAM_BUCKETS, WIDTH, scale=0.2),
            "w": normal(2, 2 * WIDTH, 3 * h, scale=0.3),
            "u": normal(2, h, 3 * h, scale=0.3),
            "b": np.zeros((2, 1, 3 * h), np.float32),
            "a": normal(2 * h, ATTEND, scale=0.3),
            "v": normal(ATTEND, 1, scale=0.3),
            "o": normal(2 * h, 1, scale=0.3),
            "c": np.zeros(1, np.float32),
        }

    def inputs(self, buckets: np.ndarray, grams: np.ndarray, begin: np.ndarray) -> np.ndarray:
        """Input vector of each distinct word; the last row is padding."""
        chars = np.add.reduceat(self.p["gram"][grams], begin, axis=0) if len(begin) else np.zeros((0, WIDTH), np.float32)
        size = np.diff(np.append(begin, len(grams)))[:, None]
        rows = np.concatenate((self.p["word"][buckets], chars / np.maximum(size, 1)), axis=1)
        return np.concatenate((rows, np.zeros((1, 2 * WIDTH), np.float32))).astype(np.float32)

    def recur(self, gates: np.ndarray, keep: bool):
        """``gates``: time, direction, batch, 3 * HIDDEN, the words' part."""
        h, u = HIDDEN, self.p["u"]
        state = np.zeros((*gates.shape[1:3], h), np.float32)
        states, kept = [], []
        for t in range(len(gates)):
            past = state @ u
            rz = sigmoid(gates[t, :, :, : 2 * h] + past[:, :, : 2 * h])
            r, z = rz[:, :, :h], rz[:, :, h:]
            n = np.tanh(gates[t, :, :, 2 * h :] + r * past[:, :, 2 * h :])
            if keep:
                kept.append((state, r, z, n, past[:, :, 2 * h :]))
            state = n + z * (state - n)
            states.append(state)
        both = np.stack(states)
        # time, batch, both directions at their own places
        return np.concatenate((both[:, 0], both[::-1, 1]), axis=2), kept

    def head(self, states: np.ndarray):
        m = np.tanh(states @ self.p["a"])
        e = (m @ self.p["v"])[:, :, 0]
        e = np.exp(e - e.max(axis=0))
        e /= e.sum(axis=0)
        pooled = (states * e[:, :, None]).sum(axis=0)
        return m, e, pooled, (pooled @ self.p["o"])[:, 0] + self.p["c"][0]

    def gates(self, table: np.ndarray, places: np.ndarray) -> np.ndarray:
        forward, back = table[0][places.T], table[1][places.T[::-1]]
        return np.stack((forward, back), axis=1)

    def score(self, rows: np.ndarray, places: np.ndarray) -> np.ndarray:
        """Logits of windows (places of distinct words in ``rows``)."""
        table = rows @ self.p["w"] + self.p["b"]
        out = np.empty(len(places), np.float32)
        for i in range(0, len(places), CHUNK):
            states, _ = self.recur(self.gates(table, places[i : i + CHUNK]), False)
            out[i : i + CHUNK] = self.head(states)[3]
        return out

    def gradients(self, x: np.ndarray, y: np.ndarray, weight: np.ndarray):
        """Gradients of the weighted logistic loss for inputs ``x`` (time,
        batch, 2 * WIDTH), and that of ``x``."""
        p, h = self.p, HIDDEN
        g = {k: np.zeros_like(v) for k, v in p.items() if k not in ("word", "gram")}
        two = np.stack((x, x[::-1]), axis=1)
        gates = np.einsum("tdbi,dij->tdbj", two, p["w"], optimize=True) + p["b"]
        states, kept = self.recur(gates, True)
        m, e, pooled, logit = self.head(states)
        d = ((sigmoid(logit) - y) * weight / weight.sum()).astype(np.float32)
        g["c"][0] = d.sum()
        g["o"] = pooled.T @ d[:, None]
        d_pool = d[:, None] * p["o"][:, 0]
        d_states = e[:, :, None] * d_pool
        d_e = (states * d_pool).sum(axis=2)
        d_e = e * (d_e - (e * d_e).sum(axis=0))
        g["v"] = np.einsum("tbk,tb->k", m, d_e)[:, None]
        d_m = d_e[:, :, None] * p["v"][:, 0] * (1 - m * m)
        g["a"] = np.einsum("tbi,tbk->ik", states, d_m, optimize=True)
        d_states = d_states + d_m @ p["a"].T
        d_both = np.stack((d_states[:, :, :h], d_states[::-1, :, h:]), axis=1)
        d_gates = np.zeros_like(gates)
        carry = np.zeros_like(d_both[0])
        for t in range(len(kept) - 1, -1, -1):
            before, r, z, n, past = kept[t]
            d_h = d_both[t] + carry
            d_n = d_h * (1 - z) * (1 - n * n)
            d_z = d_h * (before - n) * z * (1 - z)
            d_r = d_n * past * r * (1 - r)
            d_gates[t] = np.concatenate((d_r, d_z, d_n), axis=2)
            d_past = np.concatenate((d_r, d_z, d_n * r), axis=2)
            g["u"] += np.swapaxes(before, 1, 2) @ d_past
            carry = d_h * z + d_past @ np.swapaxes(p["u"], 1, 2)
        g["b"] = d_gates.sum(axis=(0, 2))[:, None, :]
        g["w"] = np.einsum("tdbi,tdbj->dij", two, d_gates, optimize=True)
        d_two = np.einsum("tdbj,dij->tdbi", d_gates, p["w"], optimize=True)
        return g, d_two[:, 0] + d_two[::-1, 1]


class Adam:
    def __init__(self, p: dict):
        self.m = {k: np.zeros_like(v) for k, v in p.items()}
        self.s = {k: np.zeros_like(v) for k, v in p.items()}
        self.t = 0

    def step(self, p: dict, g: dict, rate: float) -> None:
        self.t += 1
        for k, v in g.items():
            self.m[k] += 0.1 * (v - self.m[k])
            self.s[k] += 0.005 * (v * v - self.s[k])
            p[k] -= rate * (self.m[k] / (1 - 0.9**self.t)) / (np.sqrt(self.s[k] / (1 - 0.995**self.t)) + 1e-7)


class Sample:
    """Training texts as windows over distinct words."""

    def __init__(self, found: list[str]):
        data = [t.encode() for t in found]
        offsets = np.cumsum([0] + [len(t) for t in data])
        words = Tokeniser("alnum", True).words(np.frombuffer(b"".join(data), dtype=np.uint8), offsets)
        hashes, at, back = np.unique(words.hashes, return_index=True, return_inverse=True)
        self.buckets = (hashes % np.uint64(WORD_BUCKETS)).astype(np.int64)
        self.grams, self.begin = grams_of(words, at)
        place, self.first = windows_of(words.first)
        back = np.append(back, len(hashes))  # place -1 reads the last: padding
        self.places = back[place]
        self.text = np.repeat(np.arange(len(found)), np.diff(np.append(self.first, len(place))))


def suspicion(sample: Sample, toxic: np.ndarray) -> np.ndarray:
    """Window scores from word frequencies alone, to begin with."""
    n = len(sample.buckets)
    pairs = np.unique(sample.text[:, None] * (n + 1) + sample.places)
    doc, word = pairs // (n + 1), pairs % (n + 1)
    yes = np.bincount(word[toxic[doc]], minlength=n + 1)
    no = np.bincount(word[~toxic[doc]], minlength=n + 1)
    odds = np.log((yes + 0.1) / (toxic.sum() + 1)) - np.log((no + 0.1) / ((~toxic).sum() + 1))
    odds[(yes < 3) | (np.arange(n + 1) == n)] = 0
    return np.maximum(odds, 0)[sample.places].max(axis=1)


def train(found: list[str], toxic: np.ndarray, seed: int = 1) -> Network:
    net, rng, sample = Network(seed), np.random.default_rng(seed), Sample(found)
    adam = Adam(net.p)
    scores = suspicion(sample, toxic)
    size = np.diff(np.append(sample.begin, len(sample.grams)))
    for round_ in range(ROUNDS):
        # per text its worst window, and further ones of texts that aren't toxic
        order = np.lexsort((-scores, sample.text))
        head = np.concatenate(([True], sample.text[order][1:] != sample.text[order][:-1]))
        worst = order[head]
        clean = np.flatnonzero(~toxic[sample.text])
        other = rng.choice(clean, min(len(clean), 3 * len(found)), replace=False)
        hard = clean[np.argsort(-scores[clean])[: len(found) // 2]]
        chosen = np.concatenate((worst, other, hard))
        y = toxic[sample.text[chosen]].astype(np.float32)
        weight = np.where(y > 0, min(10.0, max(1.0, 0.5 * (y == 0).sum() / max(1, y.sum()))), 1.0).astype(np.float32)
        for epoch in range(EPOCHS):
            rate = RATE * (1 - (round_ * EPOCHS + epoch) / (ROUNDS * EPOCHS + 1))
            for part in np.array_split(rng.permutation(len(chosen)), max(1, len(chosen) // BATCH)):
                places = sample.places[chosen[part]].T
                words, back = np.unique(places, return_inverse=True)
                back = back.reshape(places.shape)
                real = words < len(sample.buckets)
                some = words[real]
                first = np.concatenate(([0], np.cumsum(size[some])))
                index = np.arange(first[-1]) + np.repeat(sample.begin[some] - first[:-1], size[some])
                grams = sample.grams[index]
                rows = net.inputs(sample.buckets[some], grams, first[:-1])
                x = rows[np.where(real[back], back, len(some))]
                # a word is at times known by its characters only
                mask = (rng.random(places.shape) > 0.3).astype(np.float32)[:, :, None]
                x = np.concatenate((x[:, :, :WIDTH] * mask, x[:, :, WIDTH:]), axis=2)
                g, dx = net.gradients(x, y[part], weight[part])
                d_rows = np.zeros((len(words), 2 * WIDTH), np.float32)
                np.add.at(d_rows, back.ravel(), np.concatenate((dx[:, :, :WIDTH] * mask, dx[:, :, WIDTH:]), axis=2).reshape(-1, 2 * WIDTH))
                d_rows = d_rows[real]
                g["word"], g["gram"] = np.zeros_like(net.p["word"]), np.zeros_like(net.p["gram"])
                np.add.at(g["word"], sample.buckets[some], d_rows[:, :WIDTH])
                np.add.at(g["gram"], grams, np.repeat(d_rows[:, WIDTH:] / size[some][:, None], size[some], axis=0))
                adam.step(net.p, g, rate)
        rows = net.inputs(sample.buckets, sample.grams, sample.begin)
        scores = net.score(rows, sample.places)
    return net


def learn(docs: DataFrame, labels: DataFrame, usable: Column) -> Network | float:
    """The network, or the share of toxic labels if one kind is missing."""
    known = labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("toxic").cast("int").alias("toxic"))
    known = known.filter(usable & F.col("toxic").isNotNull()).groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
    short = texts(docs).filter(F.col("text").isNotNull() & (F.length("text") <= LONGEST))
    # ids alone are ordered; then a list of bounded length is joined
    some = known.join(short.filter(usable).select("doc_id").distinct(), "doc_id").withColumn("order", F.xxhash64("doc_id"))
    picked = some.filter("toxic > 0").orderBy("order", "doc_id").limit(POSITIVES).unionByName(
        some.filter("toxic <= 0").orderBy("order", "doc_id").limit(NEGATIVES)
    )
    chosen = short.join(F.broadcast(picked), "doc_id").select("order", "doc_id", "toxic", "text").limit(2 * (POSITIVES + NEGATIVES)).toPandas()
    chosen = chosen.sort_values(["order", "doc_id", "text"]).drop_duplicates(["doc_id"])
    toxic = chosen["toxic"].to_numpy() > 0
    if not toxic.any() or toxic.all():
        return float(toxic.mean()) if len(toxic) else 0.5
    return train(chosen["text"].tolist(), toxic)


def score(docs: DataFrame, model: Network | float) -> DataFrame:
    """``doc_id, score`` and the place of the worst window: ``first_word, n_words``."""

    def make():
        tokeniser = Tokeniser("alnum", True)

        def step(batch):
            for low, high, data, offsets in slices(batch.column("text")):
                words = tokeniser.words(data, offsets)
                place, begin = windows_of(words.first)
                if isinstance(model, float):
                    logit = np.full(len(place), np.log(max(model, 1e-6) / max(1 - model, 1e-6)))
                else:
                    hashes, at, back = np.unique(words.hashes, return_index=True, return_inverse=True)
                    grams, starts = grams_of(words, at) if len(at) else (np.zeros(0, np.int64), np.zeros(0, np.int64))
                    rows = model.inputs((hashes % np.uint64(WORD_BUCKETS)).astype(np.int64), grams, starts)
                    logit = model.score(rows, np.append(back, len(hashes))[place]).astype(np.float64)
                worst = np.maximum.reduceat(logit, begin)
                text = np.repeat(np.arange(high - low), np.diff(np.append(begin, len(place))))
                hit = np.flatnonzero(logit == worst[text])
                hit = hit[np.unique(text[hit], return_index=True)[1]]
                yield {
                    "doc_id": batch.column("doc_id").slice(low, high - low),
                    "score": 1 / (1 + np.exp(-np.clip(worst, -30, 30))),
                    "first_word": (hit - begin) * STRIDE,
                    "n_words": (place[hit] >= 0).sum(axis=1),
                }

        return step

    return map_batches(texts(docs), make, "doc_id long, score double, first_word long, n_words long")


def op7_toxicity(spark, sf_dir: str) -> DataFrame:
    docs, labels = spark.read.parquet(f"{sf_dir}/documents.parquet"), spark.read.parquet(f"{sf_dir}/labels.parquet")
    scored = score(docs, learn(docs, labels, fold(5) != 0))
    return scored.select(
        "doc_id",
        F.coalesce(fold(5) == 0, F.lit(False)).alias("held_out"),
        "score",
        (F.col("score") >= 0.5).cast("int").alias("predicted"),
    )
