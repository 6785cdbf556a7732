"""Repeated runs of lines by winnowing, in DataFrame operations only.

1. Every line is hashed.  In each window of ``run`` neighbouring lines the
   leftmost line of least hash is selected; the selected lines are a document's
   fingerprints, and only they go on, each with the ``run - 1`` hashes on either
   side.  Equal windows select equal lines, so a run of ``run`` equal lines is
   guaranteed to share a fingerprint.
2. Fingerprints are counted (combined before the shuffle); those found twice
   or more are joined with their positions.
3. A match is extended from the shared line both ways, over the hashes beside
   it, to the windows that selected it.  An extension's first position is joined
   back to the others.  Matches of neighbouring fingerprints overlap and make up
   the longest matching runs.
4. The first occurrence of an extension stays, in the order of doc_id, text hash
   and line; lines covered by a later one are deleted.

With ``long`` given, a line of that many characters or more is a window of its
own as well, whatever stands beside it, and its own fingerprint: a passage
planted as one line goes although its neighbours differ, and so does a document
that is nothing else.  Both the pipeline and ``op4_line_dedup`` take ``LONG``.

Nothing is paired: a window's occurrences are compared with the first one, so a
line held by a third of all documents costs its occurrences.  All windows are
judged on the input.  Lines are what stands between line feeds; an empty line
is a line.  A null text has none and stays null, an empty one has one empty
line.  Null ids come last.  Rows equal in id and text are one document and get
equal results.  Further columns are kept.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from roadpulse.llm.substrings import same_place
from roadpulse.llm.work import text_hash, texts, whole_rows, written

RUN = 2
# characters from which a single line is a run
LONG = 200
PLACE = ["doc_id", "text_hash"]


def fingerprints(docs: DataFrame, run: int, long: int | None = None) -> DataFrame:
    """``doc_id, text_hash, line, mark`` (its hash), ``near`` (the hashes of the
    lines around it), ``at`` (its place among them) and ``number`` (of lines in a
    window): one row for each selected line, and one for each long line."""
    hashed = docs.select(
        *PLACE,
        F.transform(F.split("text", "\n"), lambda x: F.xxhash64(x)).alias("hashes"),
        F.transform(F.split("text", "\n"), F.length).alias("sizes"),
    )
    last = F.size("hashes") - run

    def least(low: Column) -> Column:
        window = F.slice("hashes", low + 1, run)
        return low + F.array_position(window, F.array_min(window)).cast("int") - 1

    none = F.array().cast("array<int>")
    picked = hashed.withColumn("picked", F.when(last >= 0, F.array_distinct(F.transform(F.sequence(F.lit(0), last), least))).otherwise(none))

    def around(line: Column) -> Column:
        low = F.greatest(line - (run - 1), F.lit(0))
        near = F.slice("hashes", low + 1, line - low + run)
        return F.struct(line.alias("line"), near.alias("near"), (line - low).alias("at"), F.lit(run).alias("number"))

    prints = F.transform("picked", around)
    if long is not None:
        alone = F.transform("sizes", lambda x, i: F.when(x >= long, i))
        alone = F.transform(
            F.array_compact(alone),
            lambda i: F.struct(i.alias("line"), F.slice("hashes", i + 1, 1).alias("near"), F.lit(0).alias("at"), F.lit(1).alias("number")),
        )
        prints = F.concat(prints, alone)
    rows = picked.select(*PLACE, F.inline(prints))
    return rows.select(*PLACE, "line", F.element_at("near", F.col("at") + 1).alias("mark"), "near", "at", "number")


def extended(prints: DataFrame) -> DataFrame:
    """``doc_id, text_hash, mark, number, low`` and ``whole`` (hash of the lines)
    of the windows around a fingerprint that select it."""

    def selects(shift: Column) -> Column:
        window = F.slice("near", shift + 1, F.col("number"))
        return shift + F.array_position(window, F.array_min(window)) - 1 == F.col("at")

    shifts = F.filter(F.sequence(F.lit(0), F.size("near") - F.col("number")), selects)
    rows = prints.select(*PLACE, "line", "mark", "near", "at", "number", F.explode(shifts).alias("shift"))
    lines = F.slice("near", F.col("shift") + 1, F.col("number"))
    return rows.select(
        *PLACE, "mark", "number", (F.col("line") - F.col("at") + F.col("shift")).alias("low"), F.xxhash64(lines).alias("whole")
    )


def later_windows(docs: DataFrame, run: int, long: int | None = None) -> DataFrame:
    """``doc_id, text_hash, low, number`` of the windows whose lines stand earlier
    too, and ``first``, the position where they do."""
    prints = written(fingerprints(docs, run, long), "line_prints")
    shared = prints.groupBy("mark", "number").agg(F.count("*").alias("n")).filter("n > 1").select("mark", "number")
    # rows equal in id and text are one document
    near = written(extended(prints.join(shared, ["mark", "number"])).distinct(), "line_matches")
    key = ["mark", "number", "whole"]
    place = F.struct(F.col("doc_id").isNull().alias("last"), "doc_id", "text_hash", "low")
    first = near.groupBy(*key).agg(F.min(place).alias("first"), F.count("*").alias("n")).filter("n > 1").drop("n")
    return near.join(first, key).filter(~place.eqNullSafe(F.col("first"))).select(*PLACE, "low", "number", "first")


def cleaned(docs: DataFrame, run: int, long: int | None = None) -> DataFrame:
    """``row`` (the columns of ``docs``), ``text`` less its later repeated runs,
    ``n_lines``, ``n_removed`` and ``removed`` (first line, number of lines)."""
    places = later_windows(texts(docs, text_hash(docs)), run, long)
    cut = places.groupBy(*PLACE).agg(F.collect_set(F.struct("low", "number")).alias("spans"))
    covered = F.flatten(F.transform("spans", lambda x: F.sequence(x["low"], x["low"] + x["number"] - 1)))
    cut = cut.select(*PLACE, F.array_sort(F.array_distinct(covered)).alias("gone"))
    # a run begins where the line before stays, and ends likewise
    cut = cut.withColumn("heads", F.filter("gone", lambda x, i: (i == 0) | (x - F.get("gone", i - 1) > 1)))
    cut = cut.withColumn(
        "ends",
        F.transform(F.filter("gone", lambda x, i: (i == F.size("gone") - 1) | (F.get("gone", i + 1) - x > 1)), lambda x: x + 1),
    ).drop("gone")
    lines = same_place(whole_rows(docs), cut, "left").withColumn("lines", F.split("text", "\n"))
    pieces = F.transform(
        F.sequence(F.lit(0), F.size("heads")),
        lambda k: F.slice(
            "lines",
            F.coalesce(F.get("ends", k - 1), F.lit(0)) + 1,
            F.coalesce(F.get("heads", k), F.size("lines")) - F.coalesce(F.get("ends", k - 1), F.lit(0)),
        ),
    )
    whole = F.col("heads").isNull()
    removed = F.when(whole, F.array().cast("array<struct<first:int,number:int>>")).otherwise(
        F.zip_with("heads", "ends", lambda a, b: F.struct(a.alias("first"), (b - a).alias("number")))
    )
    return lines.select(
        "row",
        F.when(whole, F.col("text")).otherwise(F.array_join(F.flatten(pieces), "\n")).alias("text"),
        F.when(F.col("lines").isNull(), F.lit(0)).otherwise(F.size("lines")).cast("long").alias("n_lines"),
        removed.alias("removed"),
    ).withColumn("n_removed", F.aggregate("removed", F.lit(0), lambda s, r: s + r["number"]).cast("long"))


def remove_repeated_lines(docs: DataFrame, run: int = RUN, long: int | None = None) -> DataFrame:
    """``docs`` with ``text`` less its later repeated runs, and the columns
    ``n_lines``, ``n_removed`` and ``removed`` in place of any of these names."""
    added = ["n_lines", "n_removed", "removed"]
    kept = [c for c in docs.columns if c not in added]
    return cleaned(docs, run, long).select(*[F.col("text") if c == "text" else F.col("row")[c].alias(c) for c in kept], *added)


def without_repeated_lines(docs: DataFrame, run: int = RUN, long: int | None = LONG) -> DataFrame:
    """The documents with their later repeated runs and long lines deleted, ``n_chars``
    following the text; documents of which nothing is left go."""
    changed = F.col("n_removed") > 0
    left = cleaned(docs, run, long).filter(~changed | (F.trim("text") != ""))
    new = {"text": F.col("text"), "n_chars": F.length("text").cast("long")}
    return left.select(
        *[F.when(changed, new[c]).otherwise(F.col("row")[c]).alias(c) if c in new else F.col("row")[c].alias(c) for c in docs.columns]
    )


def op4_line_dedup(spark, sf_dir: str) -> DataFrame:
    found = remove_repeated_lines(spark.read.parquet(f"{sf_dir}/documents.parquet"), RUN, LONG)
    return found.select("doc_id", "n_lines", "n_removed", F.sha2("text", 256).alias("kept_sha256"))


OP4_SQL = """
with l as (
    select doc_id, unnest(string_split(text, chr(10))) as line,
        generate_subscripts(string_split(text, chr(10)), 1) as k from documents where text is not null
), w as (
    select doc_id, k, line, lead(line) over (partition by doc_id order by k) as next,
        lead(k) over (partition by doc_id order by k) as k2 from l
), f as (
    select doc_id, k, row_number() over (partition by line, next order by doc_id, k) as n from w where k2 is not null
), g as (
    select doc_id, k, row_number() over (partition by line order by doc_id, k) as n from l where length(line) >= 200
), c as (
    select doc_id, k from f where n > 1 union select doc_id, k + 1 from f where n > 1 union select doc_id, k from g where n > 1
), j as (
    select l.doc_id, count(*) as n_lines, count(c.k) as n_removed,
        sha256(coalesce(string_agg(case when c.k is null then line end, chr(10) order by l.k), '')) as kept_sha256
    from l left join c on l.doc_id = c.doc_id and l.k = c.k group by l.doc_id
)
select d.doc_id, coalesce(n_lines, 0) as n_lines, cast(coalesce(n_removed, 0) as bigint) as n_removed, kept_sha256
from documents d left join j on d.doc_id = j.doc_id
"""
