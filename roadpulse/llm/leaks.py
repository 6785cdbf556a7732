"""Passages of benchmark items in documents, by a prefix-filtered join, in
DataFrame operations only.

An item is a set of windows of ``window`` words (one window if it has fewer).
A document contains a window only if it holds all its words, so it is enough
to look for the rarest: with containment 1 the necessary prefix of a window,
ordered by rarity, is its first word.

1. Occurrences of the items' words are counted over all documents.
2. A window is indexed by its rarest word, with the word's place in the item;
   windows of an item that share it make one entry.  A window with a word that
   no document holds is dropped.
3. Words of documents are joined with the index.  A match fixes where the
   window would begin; bounds on place and length drop windows that would not
   fit in the document.
4. Matches are verified exactly: the words of the item-sized window against
   those of the document.

The index is broadcast up to ``BROADCAST`` entries, and then a match is verified
where it is found.  Beyond that, places are joined by a shuffle, and candidates
meet their document again by its id and text hash.  Results are the same.

Null and empty texts have no words and are hit by nothing.  Items that are null
or have no word are left out; items with equal ids count as one.  Rows equal in
id and text get equal results.  Further columns are ignored or kept as stated.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from roadpulse.llm.substrings import same_place
from roadpulse.llm.work import text_hash, texts, whole_rows, written

WINDOW = 10
BROADCAST = 100_000
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
BETWEEN = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
PLACE = ["doc_id", "text_hash"]


def words(text: str) -> Column:
    """Words of a text, A-Z in lower case; other letters stay as they are, so
    ``lower`` serves ASCII texts only."""
    column = F.col(text)
    low = F.when(column.rlike(r"[^\x00-\x7F]"), F.translate(column, UPPER, LOWER)).otherwise(F.lower(column))
    # splitting takes a twentieth of the time of extracting every match
    return F.coalesce(F.array_remove(F.split(low, BETWEEN), ""), F.array().cast("array<string>"))


def index_of(items: DataFrame, docs: DataFrame, window: int) -> DataFrame:
    """``word, item_id, item_words, at`` (place of the word in the item) and
    ``lows`` (starts of the windows it stands for), of windows that can occur."""
    parts = items.select(
        F.col("item_id").cast("string").alias("item_id"), words("text").alias("item_words")
    ).filter("size(item_words) > 0")
    parts = written(parts.dropDuplicates(["item_id", "item_words"]), "items")
    vocabulary = written(parts.select(F.explode("item_words").alias("word")).distinct(), "vocabulary")
    held = docs.select(F.explode(words("text")).alias("word"))
    if vocabulary.count() <= BROADCAST:
        counts = held.join(F.broadcast(vocabulary), "word", "left_semi").groupBy("word").agg(F.count("*").alias("n"))
    else:
        counts = held.groupBy("word").agg(F.count("*").alias("n")).join(vocabulary, "word", "left_semi")
    counts = written(counts, "counts")
    last = F.greatest(F.size("item_words") - window, F.lit(0))
    spread = parts.select("item_id", "item_words", F.explode(F.sequence(F.lit(0), last)).alias("low"))
    tokens = spread.select(
        "item_id", "item_words", "low", F.posexplode(F.slice("item_words", F.col("low") + 1, window)).alias("shift", "word")
    ).join(counts, "word", "left")
    key = ["item_id", "item_words", "low"]
    rarest = tokens.groupBy(*key).agg(
        F.min(F.struct(F.coalesce("n", F.lit(0)).alias("n"), "word", (F.col("low") + F.col("shift")).alias("at"))).alias("least")
    )
    rarest = rarest.filter("least.n > 0").select(*key, "least.word", "least.at")
    return written(rarest.groupBy("word", "item_id", "item_words", "at").agg(F.collect_list("low").alias("lows")), "index")


def verified(place: str, window: int) -> Column:
    """Starts in the document of the windows that stand there in full.
    Needs ``words, item_words, at, lows`` and the word's place."""

    def fits(low: Column) -> Column:
        size = F.least(F.size("item_words"), F.lit(window))
        start = F.col(place) - F.col("at") + low
        inside = (start >= 0) & (start + size <= F.size("words"))
        return F.when(inside, F.slice("words", F.when(inside, start + 1).otherwise(1), size) == F.slice("item_words", low + 1, size)).otherwise(False)

    return F.transform(F.filter("lows", fits), lambda low: F.col(place) - F.col("at") + low)


def window_hits(docs: DataFrame, items: DataFrame, window: int = WINDOW) -> DataFrame:
    """``doc_id, text_hash, item_id, low, size``: every occurrence of a window."""
    rows = texts(docs, text_hash(docs)).filter("text is not null")
    index = index_of(items, rows, window)
    split = rows.select(*PLACE, words("text").alias("words"))
    if index.count() <= BROADCAST:
        placed = split.select(*PLACE, "words", F.posexplode("words").alias("place", "word"))
        matched = placed.join(F.broadcast(index), "word")
    else:
        placed = split.select(*PLACE, F.posexplode("words").alias("place", "word"))
        matched = same_place(placed.join(index, "word").drop("word"), split.dropDuplicates(PLACE), "inner")
    size = F.least(F.size("item_words"), F.lit(window)).alias("size")
    return matched.select(*PLACE, "item_id", F.explode(verified("place", window)).alias("low"), size)


def contamination(docs: DataFrame, items: DataFrame, window: int = WINDOW) -> DataFrame:
    """One row per document: ``doc_id, text_hash, n_words, n_hit`` (words in an
    occurrence of a window), ``spans`` (low, size) and ``items`` (sorted)."""
    hits = window_hits(docs, items, window).groupBy(*PLACE).agg(
        F.sort_array(F.collect_set(F.struct("low", "size"))).alias("spans"), F.sort_array(F.collect_set("item_id")).alias("items")
    )
    rows = texts(docs, text_hash(docs)).select("doc_id", F.coalesce("text_hash", F.lit(0)).alias("text_hash"), F.size(words("text")).cast("long").alias("n_words"))
    state = F.struct(F.lit(0).cast("long").alias("hit"), F.lit(0).alias("reach"))
    covered = F.aggregate(
        "spans",
        state,
        lambda s, x: F.struct(
            (s["hit"] + F.greatest(F.lit(0), x["low"] + x["size"] - F.greatest(s["reach"], x["low"]))).cast("long").alias("hit"),
            F.greatest(s["reach"], x["low"] + x["size"]).alias("reach"),
        ),
        lambda s: s["hit"],
    )
    joined = same_place(rows, hits, "left")
    return joined.select(
        *PLACE,
        "n_words",
        F.coalesce(covered, F.lit(0)).cast("long").alias("n_hit"),
        F.coalesce("spans", F.array().cast("array<struct<low:int,size:int>>")).alias("spans"),
        F.coalesce("items", F.array().cast("array<string>")).alias("items"),
    )


def without_leaks(docs: DataFrame, items: DataFrame, window: int = WINDOW) -> DataFrame:
    """The documents in which no window of an item occurs."""
    hit = written(window_hits(docs, items, window).select(*PLACE).distinct(), "hit")
    return same_place(whole_rows(docs).select(*PLACE, "row"), hit, "left_anti").select("row.*")


def op3_decontamination(spark, sf_dir: str) -> DataFrame:
    docs, items = spark.read.parquet(f"{sf_dir}/documents.parquet"), spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    found = contamination(docs, items)
    return found.select(
        "doc_id",
        "n_words",
        "n_hit",
        F.size("items").cast("long").alias("n_items"),
        F.sha2(F.concat_ws(",", "items"), 256).alias("items_sha256"),
        (F.col("n_hit") > 0).alias("contaminated"),
    )


OP3_SQL = r"""
with d as (
    select doc_id, coalesce(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
        '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+'), []) as w from documents
), b as (
    select cast(item_id as varchar) as item_id, regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
        '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') as w from benchmark
), v as (
    select item_id, least(len(w), 10) as size, array_to_string(list_slice(w, s, s + 9), ' ') as seq
    from (select item_id, w, unnest(range(1, greatest(len(w) - 9, 1) + 1)) as s from b where len(w) > 0)
), sizes as (select distinct size from v), x as (
    select doc_id, s, size, array_to_string(list_slice(w, s, s + size - 1), ' ') as seq
    from (select doc_id, w, size, unnest(range(1, len(w) - size + 2)) as s from d, sizes)
), h as (
    select distinct doc_id, s, x.size, item_id from x join v on x.seq = v.seq and x.size = v.size
), c as (
    select doc_id, count(distinct s + k) as n_hit from (select doc_id, s, unnest(range(0, size)) as k from h) group by doc_id
), i as (
    select doc_id, count(*) as n_items, sha256(string_agg(item_id, ',' order by item_id)) as items_sha256
    from (select distinct doc_id, item_id from h) group by doc_id
)
select d.doc_id, len(w) as n_words, coalesce(n_hit, 0) as n_hit, coalesce(n_items, 0) as n_items,
    coalesce(items_sha256, sha256('')) as items_sha256, coalesce(n_hit, 0) > 0 as contaminated
from d left join c on d.doc_id = c.doc_id left join i on d.doc_id = i.doc_id
"""
