"""Language of a text and of its parts.

Learning counts, over every labelled document, the letter trigrams of each
language (hashed into ``BUCKETS``) and the scripts its letters are in.  The
counts are summed by Spark; the model has a size of languages times buckets,
however many documents there are.

A word's script leaves the languages that use it (a share of ``SCRIPT_SHARE``
of their letters at least); each of those gets the sum of its trigrams' log
probabilities as the word's score.  Viterbi over the words, with a penalty per
change of language, labels spans of a mixed text.  A text for which no span
gains more than half a penalty over its best single language needs no search:
a path of s spans changes language s - 1 times at least, so that language
throughout is the best path.

Every language fits a text somehow, so ``accepted`` asks for evidence as well:
letters in scripts that no learned language uses are at most ``FOREIGN`` of the
text's, and the mean log probability per letter of the others, each under its
span's language, falls short of the mean of that language's learned texts by at
most ``SHORTFALL`` (in nats; ``SPREAD`` over the root of the number of letters
is added, as few letters vary more).  A clean mixed text fits span by span.

Null texts and texts without a letter are ``und`` with score 0; so is every
text if nothing could be learned.  Rows whose language or id is null are not
learned from.  Ties go to the language that sorts first.  Repeated rows get a
result each; further columns are ignored.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from roadpulse.llm.textbytes import mix
from roadpulse.llm.work import map_batches, small_batches, texts

BUCKETS = 1 << 16
SCRIPT_SHARE = 0.01
PENALTY = 12.0
SMOOTHING = 0.05
BARRED = -50.0
FOREIGN = 0.5
SHORTFALL, SPREAD = 1.5, 10.0
# characters looked at together; a text is never cut
CHUNK = 1 << 18
# words of a block of the search for the best path
BLOCK = 64
# Code point ranges of scripts (first, last).
SCRIPTS = {
    "latin": [(0x41, 0x24F), (0x1E00, 0x1EFF)],
    "greek": [(0x370, 0x3FF), (0x1F00, 0x1FFF)],
    "cyrillic": [(0x400, 0x52F)],
    "armenian": [(0x530, 0x58F)],
    "hebrew": [(0x590, 0x5FF)],
    "arabic": [(0x600, 0x6FF), (0x750, 0x77F)],
    "devanagari": [(0x900, 0x97F)],
    "bengali": [(0x980, 0x9FF)],
    "tamil": [(0xB80, 0xBFF)],
    "thai": [(0xE00, 0xE7F)],
    "georgian": [(0x10A0, 0x10FF)],
    "kana": [(0x3040, 0x30FF)],
    "hangul": [(0x1100, 0x11FF), (0xAC00, 0xD7AF)],
    "han": [(0x3400, 0x4DBF), (0x4E00, 0x9FFF), (0x20000, 0x2FFFF)],
}
NAMES = [*SCRIPTS, "other"]


class Letters:
    """Lower-case letters of texts as code points, 0 for everything else."""

    def __init__(self):
        self.is_letter = np.array([chr(i).isalpha() for i in range(0x3000)])
        edges, which = [0], [len(SCRIPTS)]
        for first, last, k in sorted((a, b, k) for k, spans in enumerate(SCRIPTS.values()) for a, b in spans):
            edges += [first, last + 1]
            which += [k, len(SCRIPTS)]
        self.edges, self.which = np.array(edges), np.array(which)

    def script(self, points: np.ndarray) -> np.ndarray:
        return self.which[np.searchsorted(self.edges, points, side="right") - 1]

    def of(self, texts: list[str]):
        """Trigram bucket of each letter, its text, its word's number, and the
        script of each word."""
        lowered = [t.lower() for t in texts]
        points = np.frombuffer((" ".join(lowered) + " ").encode("utf-32-le", "surrogatepass"), dtype=np.uint32)
        ends = np.cumsum([len(t) + 1 for t in lowered])
        letter = np.zeros(len(points), dtype=bool)
        small = points < 0x3000
        letter[small] = self.is_letter[points[small]]
        if not small.all():
            rest, back = np.unique(points[~small], return_inverse=True)
            letter[~small] = np.array([chr(c).isalpha() for c in rest.tolist()])[back]
        codes = np.where(letter, points, 0).astype(np.uint64)
        left, right = np.zeros_like(codes), np.zeros_like(codes)
        left[1:], right[:-1] = codes[:-1], codes[1:]
        at = np.flatnonzero(letter)
        key = (left[at] << np.uint64(42)) | (codes[at] << np.uint64(21)) | right[at]
        bucket = (mix(key) >> np.uint64(48)).astype(np.int64) & (BUCKETS - 1)
        first = np.ones(len(at), dtype=bool)
        first[1:] = at[1:] != at[:-1] + 1
        return bucket, np.searchsorted(ends, at, side="right"), np.flatnonzero(first), self.script(points[at[first]])


def chunks(texts: list[str | None]):
    """Runs of whole texts of about ``CHUNK`` characters: (first, after last)."""
    low, size = 0, 0
    for i, t in enumerate(texts):
        size += len(t or "")
        if size >= CHUNK or i + 1 == len(texts):
            yield low, i + 1
            low, size = i + 1, 0


def learn(labelled: DataFrame) -> dict:
    """Model from ``text, lang``: log probabilities and script shares by language."""

    def make():
        letters, counts = Letters(), {}

        def step(batch):
            texts, langs = batch.column("text").to_pylist(), batch.column("lang").to_pylist()
            names, codes = np.unique(langs, return_inverse=True) if langs else ([], np.zeros(0, dtype=np.int64))
            for low, high in chunks(texts):
                bucket, doc, words, script = letters.of(texts[low:high])
                if not len(bucket):
                    continue
                of = codes[low:high][doc]
                size = np.diff(np.append(words, len(bucket)))
                for k in np.unique(of).tolist():
                    sums = counts.setdefault(str(names[k]), np.zeros(BUCKETS + len(NAMES), dtype=np.int64))
                    sums[:BUCKETS] += np.bincount(bucket[of == k], minlength=BUCKETS)
                    mine = of[words] == k
                    sums[BUCKETS:] += np.bincount(script[mine], weights=size[mine], minlength=len(NAMES)).astype(np.int64)
            return ()

        def finish():
            for lang, sums in counts.items():
                some = np.flatnonzero(sums)
                yield {"lang": [lang] * len(some), "feature": some, "n": sums[some]}

        step.finish = finish
        return step

    counted = map_batches(labelled.select("text", "lang"), make, "lang string, feature int, n long")
    table = counted.groupBy("lang", "feature").agg(F.sum("n").alias("n")).toPandas()
    names = sorted(table["lang"].unique().tolist())
    sums = np.zeros((len(names), BUCKETS + len(NAMES)))
    if names:
        sums[np.searchsorted(names, table["lang"].to_numpy().astype(str)), table["feature"].to_numpy()] = table["n"].to_numpy()
    grams, scripts = sums[:, :BUCKETS] + SMOOTHING, sums[:, BUCKETS:]
    logs = np.log(grams / grams.sum(axis=1, keepdims=True)).astype(np.float32)
    uses = scripts >= SCRIPT_SHARE * np.maximum(scripts.sum(axis=1, keepdims=True), 1)
    known = uses.any(axis=0)
    # a script that no language uses narrows nothing
    uses |= ~known
    counts = sums[:, :BUCKETS]
    typical = (counts * logs).sum(axis=1) / np.maximum(counts.sum(axis=1), 1)
    return {"names": names, "logs": logs, "uses": uses.T.copy(), "known": known, "typical": typical}


def blocks(first: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Texts cut into blocks of at most ``BLOCK`` words: first word and number of
    words of each block, and the range of blocks of each text."""
    count = -(-np.diff(first) // BLOCK)
    edges = np.concatenate(([0], np.cumsum(count)))
    place = np.arange(edges[-1]) - np.repeat(edges[:-1], count)
    start = np.repeat(first[:-1], count) + BLOCK * place
    return start, np.minimum(BLOCK, np.repeat(first[1:], count) - start), edges


def together(size: np.ndarray):
    """Steps over sequences of these sizes, longest first: (step, those that have it)."""
    order = np.argsort(-size, kind="stable")
    ends = np.searchsorted(-size[order], -np.arange(int(size.max())), side="left")
    for t, n in enumerate(ends.tolist()):
        yield t, order[:n]


def viterbi(scores: np.ndarray, first: np.ndarray, penalty: float) -> np.ndarray:
    """Best language of each word; ``first`` has the word range of each text.

    A long text would be as many steps as it has words.  So the best sum of each
    block from every language it is entered in to every language it is left in
    comes first, for all blocks together; then the best way through the blocks
    of each text; then the way through each block, all together again."""
    k = scores.shape[1]
    start, size, edges = blocks(first)
    own = np.eye(k, dtype=bool)
    # through[block, entered, left]: the first word is read in ``left``
    through = np.where(own, 0.0, -penalty)[None] + scores[start][:, None, :]
    for t, at in together(size):
        if t:
            now = through[at]
            through[at] = np.maximum(now, now.max(axis=2, keepdims=True) - penalty) + scores[start[at] + t][:, None, :]
    number = np.diff(edges)
    best = np.zeros((len(number), k))
    entered, left = np.zeros(len(start), dtype=np.int64), np.zeros(len(start), dtype=np.int64)
    came = np.zeros((len(start), k), dtype=np.int64)
    for t, at in together(number):
        # a text's first word costs no change, whichever language it enters in
        sums = best[at][:, :, None] + through[edges[at] + t]
        came[edges[at] + t] = sums.argmax(axis=1)
        best[at] = sums.max(axis=1)
    last = best.argmax(axis=1)
    for t, at in reversed(list(together(number))):
        where = edges[at] + t
        # the text's last block is left in the best language, others as the next is entered
        final = number[at] == t + 1
        left[where] = np.where(final, last[at], entered[np.minimum(where + 1, len(start) - 1)])
        entered[where] = came[where, left[where]]
    path = np.zeros(len(scores), dtype=np.int64)
    moved = np.zeros(scores.shape, dtype=np.int16)
    sums = np.where(own[entered], 0.0, -penalty) + scores[start]
    stay = np.arange(k, dtype=np.int16)
    for t, at in together(size):
        if t:
            now = sums[at]
            top = now.argmax(axis=1)
            switch = now.max(axis=1, keepdims=True) - penalty
            move = switch > now
            moved[start[at] + t] = np.where(move, top[:, None], stay)
            sums[at] = np.where(move, switch, now) + scores[start[at] + t]
    here = left.copy()
    for t, at in reversed(list(together(size))):
        where = start[at] + t
        path[where] = here[at]
        if t:
            here[at] = moved[where, here[at]]
    return path


def best_paths(scores: np.ndarray, doc: np.ndarray, n_docs: int, penalty: float) -> np.ndarray:
    """Language of each word of several texts (``doc``: text of each word)."""
    totals = np.stack([np.bincount(doc, weights=s, minlength=n_docs) for s in scores.T], axis=1)
    top = totals.argmax(axis=1)
    path = top[doc]
    first = np.searchsorted(doc, np.arange(n_docs + 1))
    own = scores[np.arange(len(doc)), path]
    mixed = np.zeros(n_docs, dtype=bool)
    filled = np.flatnonzero(np.diff(first))
    for k in range(scores.shape[1]):
        gain = np.cumsum(scores[:, k] - own)
        before = np.concatenate(([0.0], gain[:-1]))
        # a step down from text to text larger than any range keeps their minima apart
        apart = doc * (2 * np.abs(gain).max() + 1)
        lowest = np.minimum.accumulate(before - apart) + apart
        mixed[filled] |= np.maximum.reduceat(gain - lowest, first[filled]) > penalty / 2
    if mixed.any():
        mine = mixed[doc]
        sizes = np.diff(first)[mixed]
        path[mine] = viterbi(scores[mine], np.concatenate(([0], np.cumsum(sizes))), penalty)
    return path


def reader(model: dict, penalty: float):
    """Function from texts to (language, score, spans, whether the letters are
    such as the learned texts have) of each."""
    names, logs, uses, known, typical = (model[k] for k in ("names", "logs", "uses", "known", "typical"))
    letters = Letters()

    def read(texts: list[str]):
        n = len(texts)
        pred, score, spans, fits = ["und"] * n, np.zeros(n), [[] for _ in range(n)], np.zeros(n, dtype=bool)
        bucket, doc, words, script = letters.of(texts)
        if not len(words) or not names:
            return pred, score, spans, fits
        of = doc[words]
        scores = np.stack([np.add.reduceat(row[bucket], words, dtype=np.float64) for row in logs], axis=1)
        size = np.diff(np.append(words, len(bucket)))
        barred = np.where(uses[script], scores, scores.min(axis=1, keepdims=True) + BARRED)
        path = best_paths(barred, of, n, penalty)
        share = np.zeros((n, len(names)))
        np.add.at(share, (of, path), size)
        total, top = share.sum(axis=1), share.argmax(axis=1)
        short = np.where(known[script], typical[path] * size - scores[np.arange(len(of)), path], 0.0)
        inside = np.bincount(of, weights=size * known[script], minlength=n)
        most = SHORTFALL * inside + SPREAD * np.sqrt(inside)
        fits = (total > 0) & (total - inside <= FOREIGN * total) & (np.bincount(of, weights=short, minlength=n) <= most)
        new = np.ones(len(of), dtype=bool)
        new[1:] = (of[1:] != of[:-1]) | (path[1:] != path[:-1])
        head = np.flatnonzero(new)
        count = np.diff(np.append(head, len(of)))
        begin = np.searchsorted(of, np.arange(n))
        for h, c in zip(head.tolist(), count.tolist()):
            spans[of[h]].append({"lang": names[path[h]], "first": h - int(begin[of[h]]), "number": c})
        for d in np.flatnonzero(total).tolist():
            pred[d] = names[top[d]]
            score[d] = share[d, top[d]] / total[d]
        return pred, score, spans, fits

    return read


def identify(docs: DataFrame, model: dict, penalty: float = PENALTY) -> DataFrame:
    """``doc_id, lang_pred, score`` (share of the letters that the path gives to
    it) and ``spans`` (language, first word, number of words)."""

    def make():
        read = reader(model, penalty)

        def step(batch):
            texts = [t or "" for t in batch.column("text").to_pylist()]
            for low, high in chunks(texts):
                pred, score, spans, _ = read(texts[low:high])
                yield {"doc_id": batch.column("doc_id").slice(low, high - low), "lang_pred": pred, "score": score, "spans": spans}

        return step

    return map_batches(
        docs.select("doc_id", "text"),
        make,
        "doc_id long, lang_pred string, score double, spans array<struct<lang string, first long, number long>>",
    )


def fold(folds: int) -> Column:
    """Remainder of the checksum of the id as text; null for a null id."""
    return F.crc32(F.col("doc_id").cast("string").cast("binary")) % folds


def learned(docs: DataFrame) -> dict:
    """Model of the documents that aren't held out and have a language."""
    rows = texts(docs, F.col("lang").cast("string").alias("lang"))
    return learn(rows.filter((fold(4) != 2) & F.col("lang").isNotNull() & F.col("text").isNotNull()))


def accepted(docs: DataFrame, penalty: float = PENALTY) -> DataFrame:
    """The documents whose language is found, as they are; out go those without
    a letter and those whose letters aren't such as the learned texts have."""
    model = learned(docs)
    small_batches(docs.sparkSession)

    def run(batches):
        read = reader(model, penalty)
        for batch in batches:
            texts = [t or "" for t in batch.column("text").to_pylist()]
            keep: list[bool] = []
            for low, high in chunks(texts):
                pred, _, _, fits = read(texts[low:high])
                keep += [p != "und" and bool(f) for p, f in zip(pred, fits)]
            yield batch.filter(pa.array(keep, type=pa.bool_()))

    return docs.mapInArrow(run, docs.schema)


def op10_language_id(spark, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    found = identify(texts(docs), learned(docs))
    return found.select("doc_id", F.coalesce(fold(4) == 2, F.lit(False)).alias("held_out"), "lang_pred", "score")
