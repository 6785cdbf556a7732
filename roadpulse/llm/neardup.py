"""Near-duplicate documents by b-bit MinHash.

A document is its set of ``size``-word shingles; two are linked if
``100 * intersection >= percent * union`` (whole percents, exact arithmetic).

1. Documents with equal sets form a class; from here on a class is one node.
2. ``BANDS * ROWS`` minima are taken per class.  Bands of ``ROWS`` minima give
   candidate keys: at similarity 0.8 a pair shares none of 28 bands of 4 with a
   probability of 4e-7.  Of each minimum only ``BITS`` bits are kept, packed
   into longs; equal bits, corrected for chance collisions, estimate the
   similarity of a candidate pair, and pairs more than five standard deviations
   below the threshold are dropped.
3. Every class of a band's group is compared with the group's least class only
   (linear in the group).  Candidates are confirmed on the full shingle sets.
4. Groups whose classes are then not all in one component are cut into tiles.
   Two tiles at a time, pairs of *different* components are compared by bit
   counts and the likely ones confirmed on the sets, which travel with the tiles.
   Pairs inside a component need no confirmation, since they can't change it.

So no group is expanded into all its pairs in a table, none is gathered in a
task, and no link between components is lost to a cap.

Null and empty texts have no shingles and are linked with nothing.  A text of
fewer words than a shingle has its whole word sequence as one.  Rows that share
an id are judged each by its text; a null id is larger than any other and gives
no component its name unless all its ids are null.  Further columns are ignored.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from roadpulse.llm.graph import components
from roadpulse.llm.textbytes import BASE2, Powers, Tokeniser, mix, run_hashes, slices
from roadpulse.llm.work import map_batches, text_hash, texts, whole_rows, written

SIZE = 5
PERCENT = 80
ROWS, BANDS, BITS = 4, 28, 4
LONGS = ROWS * BANDS * BITS // 64
TILE = 512
# the estimate's standard deviation at 0.8 is 0.04
SLACK = 0.2
NIBBLES = 0x1111111111111111


def seeds() -> tuple[np.ndarray, np.ndarray]:
    k = np.arange(1, ROWS * BANDS + 1, dtype=np.uint64)
    return mix(k * np.uint64(BASE2)) | np.uint64(1), mix(k + np.uint64(0xABCDEF))


def minima(shingles: np.ndarray, factor: np.ndarray, shift: np.ndarray) -> np.ndarray:
    least = np.full(len(factor), np.iinfo(np.uint64).max, dtype=np.uint64)
    for i in range(0, len(shingles), 4096):
        least = np.minimum(least, (shingles[i : i + 4096, None] * factor + shift).min(axis=0))
    return mix(least)


def pack(values: np.ndarray) -> np.ndarray:
    """The low ``BITS`` bits of each value, packed into longs."""
    low = (values & np.uint64((1 << BITS) - 1)).reshape(LONGS, 64 // BITS)
    return np.bitwise_or.reduce(low << (np.arange(64 // BITS, dtype=np.uint64) * np.uint64(BITS)), axis=1)


def shingle_sets(words, size: int, powers: Powers):
    """Distinct shingle hashes of each text of a slice."""
    grams = run_hashes(words.hashes, size, powers)
    for a, b in zip(words.first[:-1].tolist(), words.first[1:].tolist()):
        if b - a >= size:
            yield np.unique(grams[a : b - size + 1])
        elif b > a:
            yield run_hashes(words.hashes[a:b], b - a, powers) + np.uint64(b - a)
        else:
            yield np.zeros(0, dtype=np.uint64)


def signatures(docs: DataFrame, size: int) -> DataFrame:
    """``doc_id, text_hash, n_shingles, node`` (hash of the set), ``packed`` (the
    bits) and ``bands`` (a key per band; none without shingles)."""

    def make():
        tokeniser, powers = Tokeniser("space", True), Powers()
        factor, shift = seeds()
        salt = mix(np.arange(BANDS, dtype=np.uint64) + np.uint64(99))
        weights = np.array([pow(BASE2, i + 1, 1 << 64) for i in range(ROWS)], dtype=np.uint64)

        def step(batch):
            for low, high, data, offsets in slices(batch.column("text")):
                words = tokeniser.words(data, offsets)
                n, node, packed, bands = [], [], [], []
                for s in shingle_sets(words, size, powers):
                    n.append(len(s))
                    node.append(np.bitwise_xor.reduce(mix(s + np.uint64(1))) if len(s) else np.uint64(0))
                    least = minima(s, factor, shift)
                    packed.append(pack(least).view(np.int64))
                    keys = mix((least.reshape(BANDS, ROWS) * weights).sum(axis=1, dtype=np.uint64) + salt)
                    bands.append(keys.view(np.int64) if len(s) else keys[:0].view(np.int64))
                yield {
                    "doc_id": batch.column("doc_id").slice(low, high - low),
                    "text_hash": batch.column("text_hash").slice(low, high - low),
                    "n_shingles": n,
                    "node": np.array(node, dtype=np.uint64).view(np.int64),
                    "packed": packed,
                    "bands": bands,
                }

        return step

    return map_batches(
        docs, make, "doc_id long, text_hash long, n_shingles long, node long, packed array<long>, bands array<long>"
    )


def estimate(left: str, right: str):
    """Similarity from equal bits, less what chance makes equal."""
    apart = " + ".join(
        f"bit_count((x{i} | shiftrightunsigned(x{i}, 1) | shiftrightunsigned(x{i}, 2) | shiftrightunsigned(x{i}, 3)) & {NIBBLES}L)".replace(
            f"x{i}", f"({left}[{i}] ^ {right}[{i}])"
        )
        for i in range(LONGS)
    )
    return F.expr(f"1 - ({apart}) / {ROWS * BANDS}D / (1 - 1 / {1 << BITS}D)")


def similar(x: pa.Scalar, y: pa.Scalar, percent: int) -> bool:
    """The exact test on two sets of shingle hashes."""
    x, y = np.frombuffer(x.as_buffer(), dtype=np.uint64), np.frombuffer(y.as_buffer(), dtype=np.uint64)
    if 100 * min(len(x), len(y)) < percent * max(len(x), len(y)):
        return False
    both = len(x) + len(y) - len(np.unique(np.concatenate((x, y))))
    return 100 * both >= percent * (len(x) + len(y) - both)


def confirmed(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Pairs ``a, b`` whose full shingle sets reach the threshold."""

    def make():
        def step(batch):
            left, right = batch.column("left"), batch.column("right")
            good = []
            for x, y in zip(left, right):
                good.append(similar(x, y, percent))
            keep = pa.array(good, type=pa.bool_())
            yield {"a": batch.column("a").filter(keep), "b": batch.column("b").filter(keep)}

        return step

    left = sets.select(F.col("node").alias("a"), F.col("set").alias("left"))
    right = sets.select(F.col("node").alias("b"), F.col("set").alias("right"))
    return map_batches(pairs.select("a", "b").join(left, "a").join(right, "b"), make, "a long, b long")


def likely(table: pa.Table, tiles: tuple[int, int], key: int, cut: float):
    """Rows, columns and estimates of the likely pairs of two tiles: of different
    components, similar by their bits, and sharing no earlier group (so a pair
    is looked at in one group only)."""
    n = table.num_rows
    tile, component = table.column("tile").to_numpy(), table.column("component").to_numpy()
    bits = table.column("packed").combine_chunks().flatten().to_numpy().reshape(n, LONGS).view(np.uint64)
    shared = table.column("groups").combine_chunks()
    size, pairs = np.diff(shared.offsets.to_numpy()), shared.flatten()
    slots, at = np.zeros((n, BANDS), dtype=np.int64), np.repeat(np.arange(n), size)
    slots[at, pairs.field("band").to_numpy()] = pairs.field("key").to_numpy()
    band = int(np.flatnonzero(slots[0] == key)[0])
    # a slot without a group agrees with nothing
    empty = slots == 0
    first, second = np.flatnonzero(tile == tiles[0]), np.flatnonzero(tile == tiles[1])
    rows, cols, scores = [first[:0]], [first[:0]], [np.zeros(0)]
    for i in first.tolist():
        others = second[component[second] != component[i]]
        if tiles[0] == tiles[1]:
            others = others[others > i]
        x = bits[others] ^ bits[i]
        x = (x | (x >> np.uint64(1)) | (x >> np.uint64(2)) | (x >> np.uint64(3))) & np.uint64(NIBBLES)
        score = 1 - np.bitwise_count(x).sum(axis=1) / (ROWS * BANDS) / (1 - 1 / (1 << BITS))
        good = score >= cut
        others, score = others[good], score[good]
        known = ((slots[others, :band] == slots[i, :band]) & ~empty[i, :band]).any(axis=1)
        rows.append(np.full((~known).sum(), i))
        cols.append(others[~known])
        scores.append(score[~known])
    return np.concatenate(rows), np.concatenate(cols), np.concatenate(scores)


def links_in_groups(members: DataFrame, sets: DataFrame, percent: int, cut: float) -> DataFrame:
    """Links between classes of different components that share a group.

    ``members``: ``key, n, node, component, packed, groups``.  A group is cut into
    tiles by hash, and a pair of tiles is one task's work.  The bits alone tell
    which classes have a likely partner; those are joined with their sets, and
    the pairs are confirmed most similar first.  A link found makes one component
    of two, so at most as many links leave a task as it has classes."""
    cell = ["key", "i", "j"]

    def involved(key, table):
        rows, cols, _ = likely(table, (key[1].as_py(), key[2].as_py()), key[0].as_py(), cut)
        return table.take(pa.array(np.union1d(rows, cols))).select([*cell, "tile", "node", "component", "packed", "groups"])

    def confirm(key, table):
        rows, cols, scores = likely(table, (key[1].as_py(), key[2].as_py()), key[0].as_py(), cut)
        node, component = table.column("node").to_numpy(), table.column("component").to_numpy()
        held = table.column("set").combine_chunks()
        root: dict[int, int] = {}

        def find(c):
            while root.get(c, c) != c:
                c = root[c]
            return c

        links = []
        for k in np.argsort(-scores, kind="stable").tolist():
            x, y = rows[k], cols[k]
            a, b = find(int(component[x])), find(int(component[y]))
            if a != b and similar(held[int(x)], held[int(y)], percent):
                root[max(a, b)] = min(a, b)
                links.append((int(node[x]), int(node[y])))
        return pa.table({"a": [x for x, _ in links], "b": [y for _, y in links]}, schema=pa.schema([("a", pa.int64()), ("b", pa.int64())]))

    tiles = F.ceil(F.col("n") / F.lit(TILE))
    cells = members.withColumn("tile", F.pmod(F.xxhash64("node", F.lit(1)), tiles)).withColumn(
        "other", F.explode(F.sequence(F.lit(0).cast("long"), tiles - 1))
    )
    cells = cells.select(
        "key", F.least("tile", "other").alias("i"), F.greatest("tile", "other").alias("j"), "tile", "node", "component", "packed", "groups"
    )
    some = cells.repartition(*cell).groupBy(*cell).applyInArrow(involved, cells.schema)
    some = written(some, "involved")
    return some.join(sets, "node").repartition(*cell).groupBy(*cell).applyInArrow(confirm, "a long, b long")


def components_of(docs: DataFrame, size: int = SIZE, percent: int = PERCENT) -> DataFrame:
    """One row per document: ``doc_id, text_hash, n_shingles, node`` (its class),
    ``component`` (a class of it, null without shingles), ``component_id`` (least doc_id of all linked with it, over any number of
    links) and ``kept`` (it is that document)."""
    docs = texts(docs, text_hash(docs))
    cut = percent / 100 - SLACK
    signed = written(signatures(docs, size), "signatures")
    held = signed.filter("n_shingles > 0")
    # one row per class; the bits are a function of the set
    classes = held.groupBy("node").agg(
        F.min("doc_id").alias("doc_id"),
        # the text of that document, of any if all ids are null
        F.coalesce(F.min_by("text_hash", "doc_id"), F.min("text_hash")).alias("text_hash"),
        F.first("packed").alias("packed"),
        F.first("bands").alias("bands"),
    )
    classes = written(classes, "classes")
    keyed = written(classes.select("node", F.posexplode("bands").alias("band", "key")), "bands")
    groups = keyed.groupBy("key").agg(F.min("node").alias("least"), F.count("*").alias("n"), F.bit_xor(F.xxhash64("node")).alias("sum"))
    groups = groups.filter("n > 1")
    # bands with the same members are one group
    groups = written(groups.groupBy("least", "n", "sum").agg(F.min("key").alias("key")), "groups")
    members = written(
        keyed.join(groups, "key").select("key", "band", "n", "least", "node").join(classes.select("node", "packed"), "node"), "members"
    )
    known = classes.join(members.select("node").distinct(), "node", "left_semi").select("node", "doc_id", "text_hash")
    sets = written(full_sets(docs, known, size), "sets")

    bits = members.filter("node = least").select("key", F.col("packed").alias("their"))
    star = members.filter("node != least").join(bits, "key").filter(estimate("packed", "their") >= cut)
    pairs = star.select(F.col("least").alias("a"), F.col("node").alias("b")).distinct()
    links = written(confirmed(pairs, sets, percent), "confirmed")
    found = components(links)
    labelled = members.join(found, "node", "left").withColumn("component", F.coalesce("component", "node"))
    labelled = written(labelled.select("key", "band", "n", "node", "component", "packed"), "labelled")
    open_groups = labelled.groupBy("key").agg(F.min("component").alias("x"), F.max("component").alias("y")).filter("x != y")
    slots = labelled.groupBy("node").agg(F.collect_list(F.struct("band", "key")).alias("groups"))
    rest = labelled.join(open_groups.select("key"), "key", "left_semi").drop("band").join(slots, "node")
    more = written(links_in_groups(rest, sets, percent, cut), "confirmed")
    if not more.isEmpty():
        found = components(links.unionByName(more))
    named = classes.join(found, "node", "left").withColumn("component", F.coalesce("component", "node"))
    names = named.groupBy("component").agg(F.min("doc_id").alias("component_id"))
    named = named.join(names, "component").select("node", "component", "component_id")
    out = signed.select("doc_id", "text_hash", "n_shingles", "node").join(named, "node", "left")
    own = F.when(F.col("n_shingles") > 0, F.col("component_id")).otherwise(F.col("doc_id"))
    linked = F.when(F.col("n_shingles") > 0, F.col("component")).alias("component")
    return out.select("doc_id", "text_hash", "n_shingles", "node", linked, own.alias("component_id")).withColumn(
        "kept", F.col("doc_id").eqNullSafe(F.col("component_id"))
    )


def full_sets(docs: DataFrame, wanted: DataFrame, size: int) -> DataFrame:
    """``node, set``: all shingle hashes of the classes in ``wanted``
    (``node, doc_id, text_hash`` of one document each), recomputed from its text.
    The text hash is part of the key, so rows without an id meet their own class
    only."""

    def make():
        tokeniser, powers = Tokeniser("space", True), Powers()

        def step(batch):
            nodes = batch.column("node").to_numpy()
            for low, high, data, offsets in slices(batch.column("text")):
                words = tokeniser.words(data, offsets)
                found = {}
                for d, s in enumerate(shingle_sets(words, size, powers)):
                    node = int(np.bitwise_xor.reduce(mix(s + np.uint64(1))).view(np.int64)) if len(s) else 0
                    if node == nodes[low + d]:
                        found[node] = s.tobytes()
                yield {"node": list(found), "set": list(found.values())}

        return step

    wanted = wanted.withColumnsRenamed({"doc_id": "wanted_id", "text_hash": "wanted_hash"})
    same = F.col("doc_id").eqNullSafe(F.col("wanted_id")) & (F.col("text_hash") == F.col("wanted_hash"))
    hits = docs.join(wanted, same).select("node", "text")
    # rows that share an id and the text give a set twice
    return map_batches(hits, make, "node long, set binary").dropDuplicates(["node"])


def near_duplicates(docs: DataFrame, size: int = SIZE, percent: int = PERCENT) -> DataFrame:
    """The documents less all but one (the least id, then text hash; null ids
    last) of each component; of rows equal in id and text one stays.  Columns
    stay as they are."""
    theirs = ["their_id_", "their_hash_"]
    judged = components_of(docs, size, percent).select(F.col("doc_id").alias(theirs[0]), F.col("text_hash").alias(theirs[1]), "component")
    judged = written(judged.groupBy(*theirs, "component").agg(F.count("*").alias("n")), "judged")
    first = F.min(F.struct(F.col("their_id_").isNull().alias("last"), *theirs, "n")).alias("first")
    one = judged.filter("component is not null").groupBy("component").agg(first).select("first.*")
    # id and text hash tell a component's documents apart, and its own from others
    stay = written(one.select(*theirs, "n").unionByName(judged.filter("component is null").select(*theirs, "n")), "survivors")
    rows = whole_rows(docs).select("doc_id", "text_hash", "row")
    same = F.col("doc_id").eqNullSafe(F.col("their_id_")) & F.col("text_hash").eqNullSafe(F.col("their_hash_"))
    out = rows.join(stay.select(*theirs), same, "left_semi")
    if not stay.filter("n > 1").isEmpty():
        place = Window.partitionBy("doc_id", "text_hash").orderBy("order")
        # the limit of one is applied before the shuffle as well
        out = out.withColumn("order", F.xxhash64("row")).withColumn("number", F.row_number().over(place)).filter("number = 1")
    return out.select("row.*")


def op1_near_dedup(spark, sf_dir: str) -> DataFrame:
    found = components_of(spark.read.parquet(f"{sf_dir}/documents.parquet"), size=2, percent=80)
    return found.select("doc_id", "n_shingles", "component_id", "kept")
