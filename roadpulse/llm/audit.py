"""How five filters overlap, in every order they may be applied in.

A document's failures are a mask of five bits.  Where it goes under an order
depends on the mask alone: at the first letter of the order that is in it.  So
Spark counts documents by part and mask, and the 120 orders are worked out from
32 counts of a part.

Orders are ranked lexicographically (Lehmer code), so those that begin with the
same ``s`` letters are an interval of ``(5 - s)!`` ranks.  A mask leaves at step
``s`` under exactly the orders whose first ``s - 1`` letters pass it and whose
letter ``s`` doesn't: its count is added where each such interval begins and
taken off where it ends, and prefix sums over the 120 ranks give the removals of
every step of every order.

Null texts count as empty, null languages as the part ``''``.  Copies are told
by SHA-256 of the text.  A null ``doc_id`` is smaller than no other and has none
smaller, so such a row fails E never, and it has no labels.  Rows that repeat id
and text don't fail E through each other.  A document is good (toxic) if any
label row of its id says so.  Further columns are ignored; without documents
there is no part, so the result is empty.
"""

from __future__ import annotations

from itertools import permutations
from math import factorial

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from roadpulse.llm.work import map_batches, texts, written

FILTERS = "ABCDE"
MASKS = 1 << len(FILTERS)
ORDERS = ["".join(p) for p in permutations(FILTERS)]
LEAST_WORDS, LEAST_DISTINCT, MOST_CAPITALS = 200, 50, 3
COPY = 1 << FILTERS.index("E")
CAPITALS = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


def rank(letters: str) -> int:
    """Lexicographic rank of the first order that begins with these letters."""
    left, out = list(FILTERS), 0
    for i, letter in enumerate(letters):
        out += left.index(letter) * factorial(len(FILTERS) - 1 - i)
        left.remove(letter)
    return out


def intervals() -> list[tuple[int, int, int, int]]:
    """(mask, step from 0, first rank, rank after the last) of every interval of
    orders under which the mask leaves at that step."""
    out = []
    for s in range(len(FILTERS)):
        for prefix in permutations(FILTERS, s + 1):
            low = rank("".join(prefix))
            passed = sum(1 << FILTERS.index(x) for x in prefix[:-1])
            fails = 1 << FILTERS.index(prefix[-1])
            high = low + factorial(len(FILTERS) - 1 - s)
            out += [(m, s, low, high) for m in range(MASKS) if m & fails and not m & passed]
    return out


def removals(counts: np.ndarray) -> np.ndarray:
    """``counts[part, mask]`` to documents removed, ``[part, step, rank]``."""
    mask, step, low, high = np.array(intervals()).T
    turn = np.zeros((len(FILTERS), len(ORDERS) + 1, len(counts)), dtype=np.int64)
    np.add.at(turn, (step, low), counts.T[mask])
    np.subtract.at(turn, (step, high), counts.T[mask])
    return np.cumsum(turn, axis=1)[:, :-1].transpose(2, 0, 1)


def failures(docs: DataFrame) -> DataFrame:
    """``doc_id, part, copy_key, bits``: failures of A to D, one row per document.
    ``docs`` has ``doc_id, text, part``."""
    text = F.coalesce("text", F.lit(""))
    blank = F.translate(text, "\t\n\x0b\x0c\r", "     ")
    rows = docs.select("doc_id", "part", text.alias("text"), F.array_remove(F.split(blank, " "), "").alias("words"))
    n, distinct = F.size("words"), F.size(F.array_distinct("words"))
    capitals = F.length("text") - F.length(F.translate("text", CAPITALS, ""))
    conditions = [
        n < LEAST_WORDS,
        100 * distinct < LEAST_DISTINCT * n,
        100 * capitals > MOST_CAPITALS * F.length("text"),
        F.col("text").rlike(r"[#$%&*|]"),
    ]
    bits = sum((F.when(c, 1 << k).otherwise(0) for k, c in enumerate(conditions)), F.lit(0))
    return rows.select("doc_id", "part", F.unhex(F.sha2("text", 256)).alias("copy_key"), bits.cast("int").alias("bits"))


def mask_counts(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """``part, mask, n, good, toxic``: at most 32 rows per part.

    Rows equal in id, text and part are one row with a count before anything is
    joined, and the least id of a text is a partial aggregate, so neither a text
    nor an id that many rows share is gathered in one task."""
    judged = written(failures(docs), "failures")
    units = judged.filter("doc_id is not null").groupBy("doc_id", "copy_key", "part", "bits").agg(F.count("*").alias("n"))
    firsts = judged.groupBy("copy_key").agg(F.min("doc_id").alias("doc_id")).filter("doc_id is not null")
    marks = (
        labels.select(F.col("doc_id").cast("long").alias("doc_id"), "quality", "toxic")
        .filter("doc_id is not null")
        .groupBy("doc_id")
        .agg(
            F.max(F.when(F.col("quality") == 1, 1).otherwise(0)).alias("good"),
            F.max(F.when(F.col("toxic") == 1, 1).otherwise(0)).alias("toxic"),
        )
    )
    known = (
        units.join(firsts.withColumn("first", F.lit(True)), ["doc_id", "copy_key"], "left")
        .join(marks, "doc_id", "left")
        .select(
            "part",
            (F.col("bits") + F.when(F.col("first"), 0).otherwise(COPY)).alias("mask"),
            "n",
            (F.col("n") * F.coalesce("good", F.lit(0))).alias("good"),
            (F.col("n") * F.coalesce("toxic", F.lit(0))).alias("toxic"),
        )
    )
    zero = F.lit(0).cast("long")
    nameless = judged.filter("doc_id is null").select(
        "part", F.col("bits").alias("mask"), F.lit(1).cast("long").alias("n"), zero.alias("good"), zero.alias("toxic")
    )
    sums = [F.sum(c).alias(c) for c in ("n", "good", "toxic")]
    return known.unionByName(nameless).groupBy("part", "mask").agg(*sums)


def audit(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """One row per part, order and step with ``kept, removed, redundant,
    unique_fails, good_lost, toxic_lost, shapley``."""
    rows = texts(docs, F.coalesce(docs["lang"].cast("string"), F.lit("")).alias("part"))
    by_part = mask_counts(rows, labels).groupBy("part").agg(F.collect_list(F.struct("mask", "n", "good", "toxic")).alias("masks"))

    def make():
        letter = np.array([[FILTERS.index(o[s]) for o in ORDERS] for s in range(len(FILTERS))])
        names = pa.array(ORDERS)

        def step(batch):
            parts, masks = batch.column("part"), batch.column("masks")
            of = masks.value_parent_indices().to_numpy()
            flat = masks.flatten()
            at = (of, flat.field("mask").to_numpy())
            number, good, toxic = (np.zeros((len(parts), MASKS), dtype=np.int64) for _ in range(3))
            for table, name in ((number, "n"), (good, "good"), (toxic, "toxic")):
                np.add.at(table, at, flat.field(name).to_numpy())
            gone = removals(number)
            fails = np.stack([number[:, [m for m in range(MASKS) if m >> f & 1]].sum(axis=1) for f in range(len(FILTERS))], axis=1)
            share = np.stack([np.where(letter == f, gone, 0).sum(axis=(1, 2)) for f in range(len(FILTERS))], axis=1)
            alone = number[:, [1 << f for f in range(len(FILTERS))]]
            shape = gone.shape
            yield {
                "part": parts.take(pa.array(np.repeat(np.arange(len(parts)), shape[1] * shape[2]))),
                "filter_order": names.take(pa.array(np.tile(np.arange(len(ORDERS)), len(parts) * shape[1]))),
                "step": np.tile(np.repeat(np.arange(1, shape[1] + 1), shape[2]), len(parts)),
                "kept": (number.sum(axis=1)[:, None, None] - np.cumsum(gone, axis=1)).ravel(),
                "removed": gone.ravel(),
                "redundant": (fails[:, letter] - gone).ravel(),
                "unique_fails": alone[:, letter].ravel(),
                "good_lost": removals(good).ravel(),
                "toxic_lost": removals(toxic).ravel(),
                "shapley": share[:, letter].ravel(),
            }

        return step

    schema = "part string, filter_order string, step int, kept long, removed long, redundant long, unique_fails long, good_lost long, toxic_lost long, shapley long"
    return map_batches(by_part, make, schema)


def op13_filter_audit(spark, sf_dir: str) -> DataFrame:
    return audit(spark.read.parquet(f"{sf_dir}/documents.parquet"), spark.read.parquet(f"{sf_dir}/labels.parquet"))


OP13_SQL = r"""
WITH docs AS (
  SELECT doc_id, coalesce(lang, '') AS part, coalesce(text, '') AS t,
    regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w
  FROM documents
), marks AS (
  SELECT doc_id, max(CASE WHEN quality = 1 THEN 1 ELSE 0 END) AS good, max(CASE WHEN toxic = 1 THEN 1 ELSE 0 END) AS toxic
  FROM labels GROUP BY doc_id
), flags AS (
  SELECT part, coalesce(good, 0) AS good, coalesce(toxic, 0) AS toxic,
    len(w) < 200 AS a,
    100 * len(list_distinct(w)) < 50 * len(w) AS b,
    100 * len(regexp_replace(t, '[^A-Z]', '', 'g')) > 3 * len(t) AS c,
    regexp_matches(t, '[#$%&*|]') AS d,
    coalesce(doc_id > min(doc_id) OVER (PARTITION BY t), FALSE) AS e
  FROM docs LEFT JOIN marks USING (doc_id)
), fails AS (
  SELECT *, CASE WHEN a THEN 'A' ELSE '' END || CASE WHEN b THEN 'B' ELSE '' END || CASE WHEN c THEN 'C' ELSE '' END
    || CASE WHEN d THEN 'D' ELSE '' END || CASE WHEN e THEN 'E' ELSE '' END AS bad
  FROM flags
), masks AS (
  SELECT part, bad, count(*) AS n, sum(good) AS good, sum(toxic) AS toxic FROM fails GROUP BY part, bad
), letters AS (SELECT unnest(['A', 'B', 'C', 'D', 'E']) AS f
), orders AS (
  SELECT p.f || q.f || r.f || s.f || t.f AS filter_order
  FROM letters p JOIN letters q ON q.f <> p.f JOIN letters r ON r.f NOT IN (p.f, q.f)
  JOIN letters s ON s.f NOT IN (p.f, q.f, r.f) JOIN letters t ON t.f NOT IN (p.f, q.f, r.f, s.f)
), steps AS (
  SELECT filter_order, step, filter_order[step] AS f, filter_order[1:step - 1] AS earlier
  FROM orders, (SELECT unnest([1, 2, 3, 4, 5])::INT AS step)
), judged AS (
  SELECT part, filter_order, step, f, n, good, toxic, contains(bad, f) AS fails, bad = f AS alone,
    len(regexp_replace(bad, '[^' || CASE WHEN earlier = '' THEN '-' ELSE earlier END || ']', '', 'g')) > 0 AS gone
  FROM masks, steps
), totals AS (
  SELECT part, filter_order, step, f,
    sum(CASE WHEN NOT gone AND NOT fails THEN n ELSE 0 END)::BIGINT AS kept,
    sum(CASE WHEN NOT gone AND fails THEN n ELSE 0 END)::BIGINT AS removed,
    sum(CASE WHEN gone AND fails THEN n ELSE 0 END)::BIGINT AS redundant,
    sum(CASE WHEN alone THEN n ELSE 0 END)::BIGINT AS unique_fails,
    sum(CASE WHEN NOT gone AND fails THEN good ELSE 0 END)::BIGINT AS good_lost,
    sum(CASE WHEN NOT gone AND fails THEN toxic ELSE 0 END)::BIGINT AS toxic_lost
  FROM judged GROUP BY part, filter_order, step, f
)
SELECT part, filter_order, step, kept, removed, redundant, unique_fails, good_lost, toxic_lost,
  (sum(removed) OVER (PARTITION BY part, f))::BIGINT AS shapley
FROM totals
"""
