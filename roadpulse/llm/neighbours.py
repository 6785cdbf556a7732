"""Nearest neighbours by a block matrix join of int8 tiles.

Vectors are packed into blocks where they are read and quantised there, once: a
block holds the int8 values, the scales and error norms, and the original
vectors in their own type.  Every block of queries meets every block of
candidates (a stated query set against all rows), but blocks do not travel
alone: the key of the join is a group of some ``CANDIDATE_BLOCKS`` blocks of
candidates and one of some ``QUERY_BLOCKS`` blocks of queries.  The number of
keys grows with both sides; what a key holds does not.

A vector is quantised to int8 with a scale of its own, ``v = s * q + e``.  The
product of two quantised vectors is an integer matrix product, and

    |u.v - s t (p.q)| <= |s p| |f| + |t q| |e| + |e| |f|

with e and f the two rests, so each tile gives every pair a lower and an upper
bound.  A candidate survives if its upper bound reaches the k-th largest lower
bound known for its query; survivors are computed in float64 from the original
vectors, added component by component in order, and kept in a heap per query.
Survivors are recomputed where they are found, since a crowd of equal vectors
would make more pairs than a shuffle should carry; of a tile, only the best
``k`` of each query reach its heap.  The result is exact, ties going to the
smaller id.  The heaps of the groups are merged at the end: at most ``k`` rows
per query and group, ranked per task before they are shuffled.

Vectors that are null, empty or zero, or hold a null or a non-finite component
take no part, nor do rows with a null id.  Only vectors of equal length are
compared.  Rows that repeat an id are candidates each, but a query is never its
own candidate: rows with its id are left out, and repeated rows of a query give
the query once, with the vector that is first in byte order.  Further columns
are ignored; an empty table gives an empty result.
"""

from __future__ import annotations

import heapq

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from roadpulse.llm.work import map_batches, written

BLOCK = 1024
QUERY_BLOCK = 256
# blocks of wide vectors have fewer rows
BLOCK_BYTES = 4 << 20
CANDIDATE_BLOCKS = 24
QUERY_BLOCKS = 16
K = 20
COLUMNS = ["ids", "codes", "errors", "data"]


def usable(vectors: DataFrame) -> DataFrame:
    """``vec_id, embedding`` (float32 where it is stored so, else float64) of the
    rows that take part."""
    stored = vectors.schema["embedding"].dataType
    single = isinstance(stored, T.ArrayType) and isinstance(stored.elementType, T.FloatType)
    kind = "array<float>" if single else "array<double>"
    rows = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("embedding").cast(kind).alias("embedding"))
    finite = F.forall("embedding", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return rows.filter(F.col("vec_id").isNotNull() & (F.size("embedding") > 0) & finite & F.exists("embedding", lambda x: x != 0))


def blocks(rows: DataFrame, most: int) -> DataFrame:
    """``block, width`` and ``COLUMNS``: up to ``most`` vectors of one length, as
    ids, int8 values, scales and norms (see ``quantised``), and originals."""

    def make():
        part = TaskContext.get().partitionId() << 33
        state = {"n": 0}
        open_blocks: dict[int, list] = {}

        def closed(width):
            ids, data = zip(*open_blocks.pop(width))
            state["n"] += 1
            codes, *errors = quantised(np.stack(data).astype(np.float64))
            return {
                "block": [part + state["n"]],
                "width": [width],
                "ids": [np.array(ids, dtype=np.int64).tobytes()],
                "codes": [codes.tobytes()],
                "errors": [np.stack(errors).tobytes()],
                "data": [np.stack(data).tobytes()],
            }

        def step(batch):
            column = batch.column("embedding")
            flat, size = column.flatten().to_numpy(), np.array([len(x) for x in column])
            ends = np.cumsum(size)
            for vec_id, width, end in zip(batch.column("vec_id").to_pylist(), size.tolist(), ends.tolist()):
                open_blocks.setdefault(width, []).append((vec_id, flat[end - width : end]))
                if len(open_blocks[width]) >= min(most, max(1, BLOCK_BYTES // (8 * width))):
                    yield closed(width)

        def finish():
            for width in list(open_blocks):
                yield closed(width)

        step.finish = finish
        return step

    return map_batches(rows, make, "block long, width int, ids binary, codes binary, errors binary, data binary")


def quantised(vectors: np.ndarray):
    """int8 values, scales, norms of the quantised vectors and of the rests."""
    scale = np.abs(vectors).max(axis=1) / 127
    # a denormal scale can't be divided by; such a vector is all rest
    whole = np.where(scale[:, None] > 1e-300, np.rint(vectors / np.maximum(scale, 1e-300)[:, None]), 0)
    near = whole * scale[:, None]
    # a little more than the norms, for their own rounding and underflow
    up, least = 1 + 1e-9, 1e-150
    return whole.astype(np.int8), scale, np.linalg.norm(near, axis=1) * up + least, np.linalg.norm(vectors - near, axis=1) * up + least


def tile_bounds(queries, candidates) -> tuple[np.ndarray, np.ndarray]:
    """Lower and upper bound of every inner product of a tile."""
    p, s, np_, f = queries
    q, t, nq, e = candidates
    # as float32 for the matrix product, which is exact for integers below 2**24:
    # 127 * 127 * 1040 components
    p, q = (x.astype(np.float32, copy=False) for x in (p, q))
    step = 1024
    product = sum((p[:, i : i + step] @ q[:, i : i + step].T).astype(np.float64) for i in range(0, p.shape[1], step))
    near = product * s[:, None] * t[None, :]
    slack = np_[:, None] * e[None, :] + f[:, None] * nq[None, :] + f[:, None] * e[None, :]
    slack = slack * (1 + 1e-9) + np.abs(near) * 1e-9
    return near - slack, near + slack


def exact(left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """Inner products of row pairs, added from the first component to the last."""
    return np.add.accumulate(left.astype(np.float64) * right, axis=1)[:, -1]


def best_of(query: np.ndarray, other: np.ndarray, scores: np.ndarray, k: int) -> np.ndarray:
    """Places of each query's ``k`` best: largest score, then smallest id."""
    order = np.lexsort((other, -scores, query))
    sorted_query = query[order]
    first = np.searchsorted(sorted_query, sorted_query)
    return order[np.arange(len(order)) - first < k]


class Block:
    """One row of ``blocks``, its int8 values ready for the matrix product."""

    def __init__(self, table: pa.Table, row: int, kind: np.dtype):
        width = table["width"][row].as_py()
        ids, codes, errors, data = (np.frombuffer(table[c][row].as_buffer(), dtype=t) for c, t in zip(COLUMNS, (np.int64, np.int8, np.float64, kind)))
        self.ids = ids
        self.data = data.reshape(-1, width)
        self.packed = (codes.reshape(-1, width).astype(np.float32), *errors.reshape(3, -1))


def search_tile(queries: Block, heaps: list[list], candidates: Block, k: int) -> None:
    """Put what the tile has into the queries' heaps of ``(score, -id)``."""
    low, high = tile_bounds(queries.packed, candidates.packed)
    same = queries.ids[:, None] == candidates.ids[None, :]
    low[same], high[same] = -np.inf, -np.inf
    least = np.array([h[0][0] if len(h) == k else -np.inf for h in heaps])
    if low.shape[1] >= k:
        least = np.maximum(least, np.partition(low, -k, axis=1)[:, -k])
    x, y = np.nonzero((high >= least[:, None]) & ~same)
    for i in range(0, len(x), 1 << 16):
        a, b = x[i : i + (1 << 16)], y[i : i + (1 << 16)]
        scores = exact(queries.data[a], candidates.data[b])
        best = best_of(a, candidates.ids[b], scores, k)
        for q, c, score in zip(a[best].tolist(), candidates.ids[b[best]].tolist(), scores[best].tolist()):
            if len(heaps[q]) < k:
                heapq.heappush(heaps[q], (score, -c))
            elif (score, -c) > heaps[q][0]:
                heapq.heapreplace(heaps[q], (score, -c))


def nearest(
    vectors: DataFrame,
    is_query: Column,
    k: int = K,
    block: int = BLOCK,
    query_block: int = QUERY_BLOCK,
    candidate_blocks: int = CANDIDATE_BLOCKS,
    query_blocks: int = QUERY_BLOCKS,
) -> DataFrame:
    """``query_id, rank, vec_id, score``: the ``k`` rows of largest inner product
    for each row that ``is_query`` marks.  Blocks have ``block`` and
    ``query_block`` rows, groups about ``candidate_blocks`` and ``query_blocks``
    blocks."""
    rows = usable(vectors)
    kind = np.dtype(np.float32 if rows.schema["embedding"].dataType.elementType == T.FloatType() else np.float64)
    queries = rows.filter(is_query).groupBy("vec_id").agg(F.min("embedding").alias("embedding"))
    left, right = written(blocks(queries, query_block), "query_blocks"), written(blocks(rows, block), "candidate_blocks")
    # two numbers; groups are as large as their hashes make them
    across, down = -(-right.count() // candidate_blocks), -(-left.count() // query_blocks)

    def group(number: int) -> Column:
        return F.pmod(F.xxhash64("block"), F.lit(max(1, number))).cast("int")

    def each(number: int) -> Column:
        return F.explode(F.sequence(F.lit(0), F.lit(max(1, number) - 1)))

    left = left.select("width", group(down).alias("down"), each(across).alias("across"), *COLUMNS)
    right = right.select("width", group(across).alias("across"), each(down).alias("down"), *COLUMNS)
    schema = "query_id long, vec_id long, score double"

    def tiles(left_table: pa.Table, right_table: pa.Table) -> pa.Table:
        own = [Block(left_table, i, kind) for i in range(left_table.num_rows)]
        heaps = [[[] for _ in b.ids] for b in own]
        for i in range(right_table.num_rows if own else 0):
            other = Block(right_table, i, kind)
            for b, h in zip(own, heaps):
                search_tile(b, h, other, k)
        out = [(q, -i, s) for b, h in zip(own, heaps) for q, heap in zip(b.ids.tolist(), h) for s, i in heap]
        ids, found, scores = zip(*out) if out else ((), (), ())
        return pa.table(
            {"query_id": pa.array(ids, pa.int64()), "vec_id": pa.array(found, pa.int64()), "score": pa.array(scores, pa.float64())}
        )

    key = ["width", "across", "down"]
    found = left.groupBy(*key).cogroup(right.groupBy(*key)).applyInArrow(tiles, schema)
    rank = F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id"))
    return found.withColumn("rank", rank).filter(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")


def op9_nearest(spark, sf_dir: str) -> DataFrame:
    return nearest(spark.read.parquet(f"{sf_dir}/embeddings.parquet"), F.col("vec_id") % 20 == 0)


OP9_SQL = """
with v as (
    select vec_id, cast(embedding as double[]) as e from embeddings
    where vec_id is not null and len(embedding) > 0
      and len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0
      and len(list_filter(embedding, lambda x: x <> 0)) > 0
), s as (
    select q.vec_id as query_id, c.vec_id, list_inner_product(q.e, c.e) as score
    from v q join v c on q.vec_id % 20 = 0 and c.vec_id <> q.vec_id and len(c.e) = len(q.e)
), r as (
    select *, row_number() over (partition by query_id order by score desc, vec_id) as rank from s
)
select query_id, cast(rank as integer) as rank, vec_id, score from r where rank <= 20
"""
