"""Repeated word runs by relative Lempel-Ziv parsing.

A run of ``window`` words that starts anywhere else as well is removed, at all
its places.  The reference is the whole table, indexed in blocks:

1. Every window is represented by its anchor, the ``GRAM`` words with the least
   hash in it, so equal windows have equal anchors at equal places.  Neighbouring
   windows with one anchor make a block: anchor hash, hash of all its words.
2. Blocks are joined with the index on the anchor.  An anchor found once holds
   no repeat.  A block whose words all stand elsewhere is a factor as it is; one
   copy of it stays in the reference.
3. The other blocks are parsed greedily from left to right against every block of
   their anchor, lined up at the anchor.  The reference's suffixes are sorted at
   each start, so the longest match is with a neighbour in that order.  A match of
   ``window`` words or more is a factor and becomes a duplicate span; the parse
   goes on with the window that reaches one word over the factor's end, otherwise
   with the next word.  A factor that runs on past its block is found again there.
4. Anchors with more than ``CROWD`` different blocks are not gathered in one
   task: their windows are compared by a shuffle on the windows' hashes, with the
   same result.

Counts are combined before each shuffle; keys with a large part of the rows are
counted and joined in pieces (``pieced_join``), so a passage held by a third of all
documents costs its occurrences only.  No pair of documents is ever formed.

Null and empty texts have no words.  Rows equal in id and text are different
places (their windows repeat) and get equal results; a null id is an id.
Further columns are ignored; an empty table gives an empty result.  Equal word
hashes (64 bits) are taken for equal words.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from roadpulse.llm.textbytes import BASE2, Powers, Tokeniser, mix, run_hashes, slices
from roadpulse.llm.work import map_batches, packed_texts, text_hash, texts, unpacked, written

WINDOW = 35
GRAM = 8
# blocks of one anchor that are parsed in one task
CROWD = 4096
# rows parsed together
PARSED = 16_384
# a key with more than this part of the rows is joined in pieces
PIECES = 500
PLACE = ["doc_id", "text_hash"]


def least(values: np.ndarray, size: int) -> np.ndarray:
    """Place of the leftmost least value in each run of ``size`` values."""
    at = np.arange(len(values))
    length = 1
    while length < size:
        step = min(length, size - length)
        left, right = at[:-step], at[step:]
        at = np.where(values[left] <= values[right], left, right)
        length += step
    return at


def blocks_of(words, window: int, gram: int, powers: Powers):
    """(text, first window's start, windows, anchor's place from that start,
    anchor hash, words' hash) of each block of a slice; starts count words of the
    slice."""
    n = len(words)
    none = np.zeros(0, dtype=np.int64)
    if n < window:
        return none, none, none, none, none.astype(np.uint64), none.astype(np.uint64)
    grams = run_hashes(words.hashes, gram, powers)
    anchor = least(grams, window - gram + 1)
    doc = words.doc_of()[: n - window + 1]
    start = np.flatnonzero(np.arange(n - window + 1) + window <= words.first[doc + 1])
    if not len(start):
        return none, none, none, none, none.astype(np.uint64), none.astype(np.uint64)
    new = np.ones(len(start), dtype=bool)
    new[1:] = (anchor[start[1:]] != anchor[start[:-1]]) | (doc[start[1:]] != doc[start[:-1]])
    head = np.flatnonzero(new)
    count = np.diff(np.append(head, len(start)))
    low = start[head]
    up, down = powers.upto(n)
    sums = np.zeros(n + 1, dtype=np.uint64)
    np.cumsum(words.hashes * up[:n], out=sums[1:])
    whole = (sums[low + count + window - 1] - sums[low]) * down[low]
    shift = anchor[low] - low
    shape = shift.astype(np.uint64) * np.uint64(BASE2) + count.astype(np.uint64)
    return doc[low], low, count, shift, grams[anchor[low]], mix(whole + mix(shape))


def blocks(docs: DataFrame, window: int, gram: int) -> DataFrame:
    def make():
        tokeniser, powers = Tokeniser("space", False), Powers()

        def step(batch):
            for low, high, data, offsets in slices(batch.column("text")):
                words = tokeniser.words(data, offsets)
                doc, start, count, shift, anchor, whole = blocks_of(words, window, gram, powers)
                take = pa.array(doc + low)
                yield {
                    "doc_id": batch.column("doc_id").take(take),
                    "text_hash": batch.column("text_hash").take(take),
                    "low": start - words.first[doc],
                    "count": count,
                    "shift": shift,
                    "anchor": anchor.view(np.int64),
                    "whole": whole.view(np.int64),
                }

        return step

    return map_batches(docs, make, "doc_id long, text_hash long, low int, count int, shift int, anchor long, whole long")


CONTEXT = "doc_id long, text_hash long, low int, count int, shift int, anchor long, factor boolean, crowded boolean, words binary"


def contexts(docs: DataFrame, window: int) -> DataFrame:
    """The blocks listed in ``spans`` with the hashes of their words."""

    def make():
        tokeniser = Tokeniser("space", False)
        names = ["low", "count", "shift", "anchor", "factor", "crowded"]

        def step(batch):
            spans = batch.column("spans").to_pylist()
            for low, high, data, offsets in slices(unpacked(batch)):
                words = tokeniser.words(data, offsets)
                rows, listed, hashes = [], [], []
                for d in range(low, high):
                    for s in spans[d]:
                        at = words.first[d - low] + s["low"]
                        rows.append(d)
                        listed.append(s)
                        hashes.append(words.hashes[at : at + s["count"] + window - 1].tobytes())
                if rows:
                    take = pa.array(rows)
                    yield {
                        "doc_id": batch.column("doc_id").take(take),
                        "text_hash": batch.column("text_hash").take(take),
                        **{c: [s[c] for s in listed] for c in names},
                        "words": hashes,
                    }

        return step

    return map_batches(docs, make, CONTEXT)


def lined_up(batch: pa.RecordBatch, window: int, gram: int) -> np.ndarray:
    """Word hashes of blocks, a row each, with the anchors in one column; 0 where
    a block has no word."""
    reach = window - gram
    table = np.zeros((batch.num_rows, window + reach), dtype=">u8")
    for row, (shift, words) in enumerate(zip(batch.column("shift").to_pylist(), batch.column("words").to_pylist())):
        hashes = np.frombuffer(words, dtype=np.uint64)
        table[row, reach - shift : reach - shift + len(hashes)] = hashes
    return table


def parse(anchors: np.ndarray, table: np.ndarray, first: np.ndarray, count: np.ndarray, window: int):
    """Greedy factors of every block against the others of its anchor:
    (row, first column, windows in the factor).  ``first`` and ``count`` are the
    columns in which a block's windows start."""
    n, width = table.shape
    at, end = first.copy(), first + count
    rows, starts, lengths = [], [], []
    for column in range(width - window + 1):
        asking = np.flatnonzero((at == column) & (column < end))
        if not len(asking):
            continue
        # the suffixes of all blocks from here on, sorted within their anchor
        known = np.flatnonzero((first <= column) & (column < end))
        keys = np.concatenate([anchors[known, None], table[known, column:]], axis=1)
        order = np.argsort(np.ascontiguousarray(keys).view(f"S{keys.shape[1] * 8}").ravel(), kind="stable")
        keys = keys[order]
        longest = np.zeros(len(known), dtype=np.int64)
        if len(known) > 1:
            differs = keys[1:] != keys[:-1]
            common = np.where(differs.any(axis=1), differs.argmax(axis=1), keys.shape[1])
            # the first column is the anchor
            common = np.maximum(common - 1, 0)
            longest[order[1:]] = common
            longest[order[:-1]] = np.maximum(longest[order[:-1]], common)
        # no further than the block's own words
        longest = np.minimum(longest, end[known] + window - 1 - column)
        found = longest[np.searchsorted(known, asking)]
        hit = found >= window
        rows.append(asking[hit])
        starts.append(np.full(int(hit.sum()), column))
        lengths.append(found[hit] - window + 1)
        at[asking] = np.where(hit, column + found - window + 1, column + 1)
    none = np.zeros(0, dtype=np.int64)
    return tuple(np.concatenate(x) if x else none for x in (rows, starts, lengths))


def parsed(blocks: DataFrame, window: int, gram: int) -> DataFrame:
    """Factors of the blocks as ``doc_id, text_hash, low, count``.  Blocks of one
    anchor come together, ``CROWD`` at most."""
    together = blocks.repartition("anchor").sortWithinPartitions("anchor")

    def make():
        kept = []

        def factors(batch):
            first = window - gram - batch.column("shift").to_numpy()
            count, own = batch.column("count").to_numpy(), ~batch.column("factor").to_numpy(zero_copy_only=False)
            anchors = batch.column("anchor").to_numpy().view(np.uint64).astype(">u8")
            row, column, windows = parse(anchors, lined_up(batch, window, gram), first.astype(np.int64), count.astype(np.int64), window)
            mine = own[row]
            row, column, windows = row[mine], column[mine], windows[mine]
            take = pa.array(row)
            return {
                "doc_id": batch.column("doc_id").take(take),
                "text_hash": batch.column("text_hash").take(take),
                "low": batch.column("low").to_numpy()[row] + column - first[row],
                "count": windows,
            }

        def gathered():
            return pa.Table.from_batches(kept).combine_chunks().to_batches()[0]

        def step(batch):
            if not batch.num_rows:
                return
            kept.append(batch)
            if sum(b.num_rows for b in kept) < PARSED:
                return
            whole = gathered()
            anchors = whole.column("anchor").to_numpy()
            # the last anchor may go on in the next batch
            cut = int(np.flatnonzero(anchors != anchors[-1])[-1]) + 1 if (anchors != anchors[-1]).any() else 0
            kept[:] = [whole.slice(cut)]
            if cut:
                yield factors(whole.slice(0, cut))

        def finish():
            if kept:
                yield factors(gathered())

        step.finish = finish
        return step

    return map_batches(together, make, "doc_id long, text_hash long, low int, count int")


def crowded_windows(blocks: DataFrame, window: int) -> DataFrame:
    """The blocks' windows one by one, by two hashes."""

    def make():
        powers, second = Powers(), Powers(BASE2)

        def step(batch):
            if not batch.num_rows:
                return
            words = [np.frombuffer(w, dtype=np.uint64) for w in batch.column("words").to_pylist()]
            rows = np.repeat(np.arange(len(words)), [len(w) - window + 1 for w in words])
            take = pa.array(rows)
            inside = [np.arange(len(w) - window + 1) for w in words]
            yield {
                "doc_id": batch.column("doc_id").take(take),
                "text_hash": batch.column("text_hash").take(take),
                "low": batch.column("low").to_numpy()[rows] + np.concatenate(inside),
                "factor": batch.column("factor").take(take),
                "one": np.concatenate([run_hashes(w, window, powers) for w in words]).view(np.int64),
                "two": np.concatenate([run_hashes(w, window, second) for w in words]).view(np.int64),
            }

        return step

    return map_batches(blocks, make, "doc_id long, text_hash long, low int, factor boolean, one long, two long")


def pieced_join(rows: DataFrame, counted: DataFrame, keys: list[str]) -> DataFrame:
    """Inner join with a table of one row per key, whose ``n`` is the number of
    rows the key has.  Keys with more than one in ``PIECES`` of all rows (so at
    most ``PIECES`` keys, which are broadcast) are cut into as many pieces as it takes."""
    total = counted.agg(F.sum("n")).first()[0] or 0
    share = max(total // PIECES, 1)
    hot = F.broadcast(counted.filter(F.col("n") > share).select(*keys, F.ceil(F.col("n") / share).cast("int").alias("pieces")))
    number = F.coalesce("pieces", F.lit(1))
    left = rows.join(hot, keys, "left").withColumn("piece", F.pmod(F.xxhash64(*PLACE, "low"), number).cast("int")).drop("pieces")
    piece = F.explode(F.sequence(F.lit(0), F.ceil(F.col("n") / share).cast("int") - 1))
    right = counted.filter(F.col("n") > share).withColumn("piece", piece).unionByName(
        counted.filter(F.col("n") <= share).withColumn("piece", F.lit(0))
    )
    return left.join(right, [*keys, "piece"]).drop("piece")


def same_place(left: DataFrame, right: DataFrame, how: str) -> DataFrame:
    """Join on id and text hash, a null id being equal to itself."""
    right = right.withColumnsRenamed({"doc_id": "id_", "text_hash": "hash_"})
    return left.join(right, F.col("doc_id").eqNullSafe(F.col("id_")) & (F.col("text_hash") == F.col("hash_")), how).drop("id_", "hash_")


def duplicate_spans(docs: DataFrame, window: int = WINDOW, gram: int = GRAM, crowd: int = CROWD) -> DataFrame:
    """``doc_id, text_hash, spans``: runs of window starts (``low``, ``count``)
    whose windows stand elsewhere too; documents without any are left out.
    ``docs`` has ``doc_id, text, text_hash``."""
    gram = min(gram, window)
    index = written(blocks(docs, window, gram), "blocks")
    kinds = written(index.groupBy("anchor", "whole").agg(F.count("*").alias("n"), F.min(F.xxhash64(*PLACE, "low")).alias("copy")), "kinds")
    reference = written(
        kinds.groupBy("anchor").agg(F.sum("n").alias("n"), F.count("*").alias("kinds")).filter("n > 1"), "reference"
    )
    shared = written(
        pieced_join(index, reference, ["anchor"]).select(*PLACE, "low", "count", "shift", "anchor", "whole", "kinds"), "shared"
    )
    apart = shared.filter("kinds > 1")
    judged = written(
        pieced_join(apart, written(kinds.join(reference.filter("kinds > 1").select("anchor"), "anchor", "left_semi"), "factors"), ["anchor", "whole"])
        .withColumn("place", F.xxhash64(*PLACE, "low"))
        .select(
            *PLACE, "low", "count", "shift", "anchor", (F.col("kinds") > crowd).alias("crowded"),
            (F.col("n") > 1).alias("factor"), ((F.col("n") == 1) | (F.col("place") == F.col("copy"))).alias("check"),
        ),
        "judged",
    )
    listed = F.struct("low", "count", "shift", "anchor", "factor", "crowded")
    to_check = judged.filter("check").groupBy(*PLACE).agg(F.collect_set(listed).alias("spans"))
    # rows equal in id and text would give their blocks more than once
    wanted = same_place(packed_texts(docs), to_check, "inner").dropDuplicates(PLACE)
    checked = written(contexts(wanted, window), "contexts")
    found = parsed(checked.filter("not crowded"), window, gram)
    windows = written(crowded_windows(checked.filter("crowded"), window), "windows")
    repeated = windows.groupBy("one", "two").agg(F.count("*").alias("n"), F.max("factor").alias("in_factor"))
    repeated = written(repeated.filter("n > 1 or in_factor").select("one", "two", "n"), "repeated")
    crowded = pieced_join(windows.filter("not factor"), repeated, ["one", "two"]).select(*PLACE, "low", F.lit(1).alias("count"))
    spans = shared.filter("kinds = 1").select(*PLACE, "low", "count")
    spans = spans.unionByName(judged.filter("factor").select(*PLACE, "low", "count")).unionByName(found).unionByName(crowded)
    return spans.groupBy(*PLACE).agg(F.collect_set(F.struct("low", "count")).alias("spans"))


def remove_repeats(docs: DataFrame, window: int = WINDOW, gram: int = GRAM, crowd: int = CROWD) -> DataFrame:
    """One row per document: ``doc_id, n_words, n_removed, removed`` (runs of
    removed words: first, number) and ``kept`` (kept words, one space between)."""
    docs = texts(docs, text_hash(docs))
    spans = duplicate_spans(docs, window, gram, crowd)

    def make():
        tokeniser = Tokeniser("space", False)

        def step(batch):
            spans = batch.column("spans").to_pylist()
            for low, high, data, offsets in slices(unpacked(batch)):
                words = tokeniser.words(data, offsets)
                # +1 where a removed run begins, -1 after its end
                turn = np.zeros(len(words) + 1, dtype=np.int64)
                for d in range(low, high):
                    for s in spans[d] or ():
                        at = words.first[d - low] + s["low"]
                        turn[at] += 1
                        turn[at + s["count"] + window - 1] -= 1
                gone = np.cumsum(turn)[:-1] > 0
                kept, runs = [], []
                for d in range(high - low):
                    a, b = words.first[d], words.first[d + 1]
                    mine = gone[a:b]
                    if mine.any():
                        edge = np.flatnonzero(np.diff(np.concatenate(([0], mine, [0]))))
                        runs.append([{"first": x, "number": y - x} for x, y in edge.reshape(-1, 2).tolist()])
                    else:
                        runs.append([])
                    raw, keep = data[offsets[d] : offsets[d + 1]].tobytes(), np.flatnonzero(~mine) + a
                    s, e = (words.starts[keep] - offsets[d]).tolist(), (words.ends[keep] - offsets[d]).tolist()
                    kept.append(b" ".join([raw[x:y] for x, y in zip(s, e)]).decode())
                yield {
                    "doc_id": batch.column("doc_id").slice(low, high - low),
                    "n_words": np.diff(words.first),
                    "n_removed": [sum(r["number"] for r in x) for x in runs],
                    "removed": runs,
                    "kept": kept,
                }

        return step

    return map_batches(
        same_place(packed_texts(docs), spans, "left"),
        make,
        "doc_id long, n_words long, n_removed long, removed array<struct<first long, number long>>, kept string",
    )


def op6_substring_dedup(spark, sf_dir: str) -> DataFrame:
    cleaned = remove_repeats(spark.read.parquet(f"{sf_dir}/documents.parquet"))
    return cleaned.select("doc_id", "n_words", "n_removed", F.sha2("kept", 256).alias("kept_sha256"))
