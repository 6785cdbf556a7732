"""Documents drawn towards the distribution of a target (the benchmark items).

Features are runs of 1 to ``RUN`` words, each in one of ``BUCKETS`` buckets by
the CRC-32 of its bytes.  A text is bytes throughout: one 256-byte table lowers
A-Z and blanks every separator, ``bytes.split`` gives the words, and the checksum
of a longer run starts from that of the run it extends, so no run is joined.
Words are counted before their buckets are looked up.

Bucket sums of corpus and target are sums per task added up by Spark; what
reaches the driver is one number per bucket, whatever the input's size.  A
bucket's gain is the smoothed log ratio of both; a document's weight is the sum
of its features' gains, and its score adds Gumbel noise from a hash of its id,
so the highest scores are a draw without replacement in proportion to the
weights' exponentials.  Ranks come from a range-partitioned sort: each row's place in
its partition plus the rows of the partitions before it (a number per partition).

Null texts have no words and no features: weight 0, a score, no rank.  A null id
is hashed as the empty text and comes last among equal scores.  Repeated rows
have equal scores and ranks of their own; rows of one id with different texts
and equal scores go by weight, then features.  Without benchmark the
target has no features.  Further columns are ignored; an empty table gives an
empty result.
"""

from __future__ import annotations

import zlib
from collections import Counter

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from roadpulse.llm.work import map_batches, texts, written

BUCKETS = 10_000
RUN = 1
SEED = 2024
PERCENT = 10
LEAST_WORDS = 20
GAIN_SCALE = 1000
# buckets of distinct words kept in a task
KEPT = 1 << 18


def word_table() -> bytes:
    """A-Z to a-z; bytes below 0x80 that aren't ASCII letters or digits to a space."""
    lowered = bytes(range(256)).lower()
    return bytes(b if b >= 0x80 or bytes((b,)).isalnum() else 0x20 for b in lowered)


class Features:
    """Buckets of the features of texts, with how often each is met."""

    def __init__(self, run: int, buckets: int):
        self.run, self.buckets, self.table, self.known = run, buckets, word_table(), {}

    def bucket(self, word: bytes) -> int:
        if len(self.known) >= KEPT:
            self.known.clear()
        found = self.known[word] = zlib.crc32(word) % self.buckets
        return found

    def of(self, text: bytes) -> tuple[int, np.ndarray, np.ndarray]:
        """Number of words, buckets of the distinct features, their counts."""
        words = text.translate(self.table).split()
        counts = Counter(words)
        known = self.known
        at = [known[w] if w in known else self.bucket(w) for w in counts]
        times = list(counts.values())
        seeds, crc = [zlib.crc32(w) for w in words] if self.run > 1 else [], zlib.crc32
        for n in range(1, self.run):
            seeds = [crc(w, crc(b" ", s)) for s, w in zip(seeds, words[n:])]
            longer = Counter(s % self.buckets for s in seeds)
            at += longer.keys()
            times += longer.values()
        return len(words), np.array(at, dtype=np.int64), np.array(times, dtype=np.int64)


def raw(column) -> list[bytes]:
    return [t.encode("utf-8", "surrogatepass") if t else b"" for t in column.to_pylist()]


def bucket_sums(docs: DataFrame, run: int, buckets: int) -> np.ndarray:
    """Features of all texts by bucket."""

    def make():
        features, sums = Features(run, buckets), np.zeros(buckets, dtype=np.int64)

        def step(batch):
            for text in raw(batch.column("text")):
                _, at, times = features.of(text)
                np.add.at(sums, at, times)
            return ()

        def finish():
            some = np.flatnonzero(sums)
            yield {"bucket": some, "n": sums[some]}

        step.finish = finish
        return step

    counted = map_batches(docs.select("text"), make, "bucket int, n long").groupBy("bucket").agg(F.sum("n").alias("n"))
    out = np.zeros(buckets, dtype=np.int64)
    for row in counted.collect():
        out[row["bucket"]] = row["n"]
    return out


def gains(corpus: np.ndarray, target: np.ndarray, scale: int) -> np.ndarray:
    """The smoothed log ratio of target and corpus in each bucket, in whole steps."""
    s, t, k = corpus.astype(np.float64), target.astype(np.float64), len(corpus)
    ratio = ((t + 1) * (s.sum() + k)) / ((s + 1) * (t.sum() + k))
    return np.floor(scale * np.log(ratio)).astype(np.int64)


def noise(seed: int, scale: int) -> Column:
    """Gumbel noise from the id, in whole steps."""
    name = F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("doc_id").cast("string"), F.lit("")))
    h = F.conv(F.substring(F.sha2(name.cast("binary"), 256), 1, 8), 16, 10).cast("double")
    return F.floor(-scale * F.log(-F.log((h + 0.5) / 4294967296.0))).cast("long")


def scored(docs: DataFrame, gain: np.ndarray, run: int) -> DataFrame:
    """``doc_id, n_words, n_features, weight``, one row per document."""

    def make():
        features = Features(run, len(gain))

        def step(batch):
            rows = [(n, int(times.sum()), int((gain[at] * times).sum())) for n, at, times in map(features.of, raw(batch.column("text")))]
            n, size, weight = zip(*rows) if rows else ((), (), ())
            yield {"doc_id": batch.column("doc_id"), "n_words": n, "n_features": size, "weight": weight}

        return step

    return map_batches(texts(docs), make, "doc_id long, n_words long, n_features long, weight long")


def ranked(rows: DataFrame, most: int) -> DataFrame:
    """``rows`` with ``rank`` from 1 by falling score, ties to the smaller id; null
    beyond ``most``.  No task holds more than its range of scores."""
    order = [F.desc("score"), F.col("doc_id").asc_nulls_last(), "weight", "n_features"]
    placed = written(
        rows.orderBy(*order).withColumns({"part": F.spark_partition_id(), "place": F.monotonically_increasing_id()}), "ranked"
    )
    size = {r["part"]: r["count"] for r in placed.groupBy("part").count().collect()}
    before, total = [], 0
    for part in sorted(size):
        before.append((part, total))
        total += size[part]
    offsets = rows.sparkSession.createDataFrame(before, "part int, before long")
    rank = F.col("before") + F.col("place").bitwiseAND((1 << 33) - 1) + 1
    rank = F.when(rank <= most, rank)
    return placed.join(F.broadcast(offsets), "part").select(*rows.columns, rank.alias("rank"))


def resample(
    docs: DataFrame,
    target: DataFrame,
    run: int = RUN,
    buckets: int = BUCKETS,
    percent: int = PERCENT,
    least_words: int = LEAST_WORDS,
    seed: int = SEED,
    scale: int = GAIN_SCALE,
) -> DataFrame:
    """One row per document: ``doc_id, n_words, n_features, weight, score, rank``;
    the drawn ones are those with a rank."""
    corpus = docs.select(docs["text"].cast("string").alias("text"))
    wanted = target.select(target["text"].cast("string").alias("text"))
    gain = gains(bucket_sums(corpus, run, buckets), bucket_sums(wanted, run, buckets), scale)
    rows = written(scored(docs, gain, run).withColumn("score", F.col("weight") + noise(seed, scale)), "scored")
    fit = F.col("n_words") >= least_words
    most = percent * rows.filter(fit).count() // 100
    rest = rows.filter(~fit).withColumn("rank", F.lit(None).cast("long"))
    return ranked(rows.filter(fit), most).unionByName(rest)


def op12_resample(spark, sf_dir: str) -> DataFrame:
    docs, target = (spark.read.parquet(f"{sf_dir}/{name}.parquet") for name in ("documents", "benchmark"))
    return resample(docs, target).select("doc_id", "n_features", "weight", "score", "rank")


OP12_SQL = r"""
WITH RECURSIVE bytes AS (
  SELECT i, i::UBIGINT AS c, 0 AS turn FROM (SELECT unnest(range(256)) AS i)
  UNION ALL
  SELECT i, CASE WHEN c % 2 = 1 THEN xor(c // 2, 3988292384::UBIGINT) ELSE c // 2 END, turn + 1 FROM bytes WHERE turn < 8
), crc_table AS (
  SELECT list(c ORDER BY i) AS crcs FROM bytes WHERE turn = 8
), words AS (
  SELECT 'd' AS kind, doc_id, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')) AS word
  FROM documents
  UNION ALL
  SELECT 'b', NULL, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+'))
  FROM benchmark
), counted AS (SELECT kind, doc_id, word, count(*) AS n FROM words GROUP BY ALL
), spelled AS (
  SELECT word, list_transform(range(octet_length(encode(word))), lambda i: ('0x' || hex(encode(word))[2 * i + 1:2 * i + 2])::UBIGINT) AS codes
  FROM (SELECT DISTINCT word FROM counted)
), buckets AS (
  SELECT word, xor(list_reduce(codes, lambda c, b: xor(c // 256, crcs[(xor(c, b) % 256 + 1)::BIGINT]), 4294967295::UBIGINT), 4294967295::UBIGINT)::BIGINT % 10000 AS bucket
  FROM spelled, crc_table
), sums AS (
  SELECT bucket, coalesce(sum(n) FILTER (kind = 'd'), 0)::DOUBLE AS s, coalesce(sum(n) FILTER (kind = 'b'), 0)::DOUBLE AS t
  FROM counted JOIN buckets USING (word) GROUP BY bucket
), gains AS (
  SELECT bucket, floor(1000 * ln(((t + 1) * (sum(s) OVER () + 10000)) / ((s + 1) * (sum(t) OVER () + 10000))))::BIGINT AS gain FROM sums
), weights AS (
  SELECT doc_id, sum(n)::BIGINT AS n_features, sum(n * gain)::BIGINT AS weight
  FROM counted JOIN buckets USING (word) JOIN gains USING (bucket) WHERE kind = 'd' GROUP BY doc_id
), scores AS (
  SELECT doc_id, coalesce(n_features, 0) AS n_features, coalesce(weight, 0) AS weight,
    coalesce(weight, 0) + floor(-1000 * ln(-ln((('0x' || sha256('2024:' || doc_id)[1:8])::BIGINT::DOUBLE + 0.5) / 4294967296.0)))::BIGINT AS score
  FROM documents LEFT JOIN weights USING (doc_id)
), drawn AS (
  SELECT doc_id, row_number() OVER (ORDER BY score DESC, doc_id) AS place, count(*) OVER () AS total FROM scores WHERE n_features >= 20
)
SELECT doc_id, n_features, weight, score, CASE WHEN place <= 10 * total // 100 THEN place END AS rank
FROM scores LEFT JOIN drawn USING (doc_id)
"""
