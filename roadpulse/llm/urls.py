"""URL rules by a sort-merge range join.

A rule is a host with a path prefix; it fits the host and all its subdomains.
With the host's labels reversed and closed by a byte that sorts before any
other (``com\\x01example\\x01``), the hosts a rule fits are one interval of
keys, and two rules' intervals are nested or apart.

1. Boundaries are taken from a sample of at most ``SAMPLE`` urls and cut the
   sorted keys into ranges.  A url goes to one range; a host with many urls is
   split further by path and a hash of the row, which are part of the sort key.
   A rule goes to each range that its interval meets.
2. In a range, rules and urls are sorted together and swept once.  A stack
   holds the rules whose intervals are open; a url is compared with those only,
   and gets the longest whose path its own begins with.

Longest counts host and path; of equally long ones that with the longer host,
then the smaller text.  Urls no rule fits get the method's verdict, ``allow``.
Null urls and urls without ``://`` have an empty host and path.  Rows are kept
each, repeated ones and null ids too; rules with a null part are left out, and
of a repeated rule ``block`` counts.  Further columns are ignored.
"""

from __future__ import annotations

from bisect import bisect_right

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from roadpulse.llm.work import map_batches

SAMPLE = 20_000
RANGES = 64
DEFAULT = "allow"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

# (host, path, verdict)
RULES = (
    ("com", "/", "allow"),
    ("example.com", "/en/", "block"),
    ("www.example.com", "/en/", "allow"),
    ("net", "/es/", "block"),
    ("net", "/fr/", "block"),
)


def host_and_path(pages: DataFrame) -> DataFrame:
    """``page_id, host, path``."""
    url = F.col("url").cast("string")
    rest = F.when(F.instr(url, "://") > 0, F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)([^?#]*)", 1))
    path = F.when(F.instr(url, "://") > 0, F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)([^?#]*)", 2))
    return pages.select(
        F.col("page_id").cast("long").alias("page_id"),
        F.translate(F.coalesce(rest, F.lit("")), UPPER, LOWER).alias("host"),
        F.coalesce(path, F.lit("")).alias("path"),
    )


def host_key(host: Column) -> Column:
    """Reversed labels, each closed by 0x01; an empty host has an empty key."""
    labels = F.concat_ws("\x01", F.reverse(F.split(host, r"\.")))
    return F.when(host == "", F.lit("")).otherwise(F.concat(labels, F.lit("\x01")))


def rules_table(spark: SparkSession, rules=RULES) -> DataFrame:
    return spark.createDataFrame(list(rules), "host string, path string, verdict string")


def judge(pages: DataFrame, rules: DataFrame, ranges: int = RANGES, default: str = DEFAULT) -> DataFrame:
    """``page_id, host, path, rule, verdict`` for every row of ``pages``."""
    rows = host_and_path(pages).withColumn(
        "key", F.concat(host_key(F.col("host")), F.lit("\x00"), "path", F.lit("\x00"), F.hex(F.xxhash64("page_id", "host", "path", F.monotonically_increasing_id())))
    )
    known = rules.select(
        F.translate(F.col("host").cast("string"), UPPER, LOWER).alias("host"), F.col("path").cast("string").alias("path"), F.col("verdict").cast("string").alias("verdict")
    ).dropna()
    known = known.groupBy("host", "path").agg(F.max("verdict").alias("verdict")).withColumn("key", host_key(F.col("host")))

    n = rows.count()
    if not n:
        return rows.select("page_id", "host", "path", F.lit(None).cast("string").alias("rule"), F.lit(default).alias("verdict"))
    picked = F.rand(7) < min(1.0, SAMPLE / 2 / n) if n > SAMPLE else F.lit(True)
    sample = sorted(r["key"].encode() for r in rows.filter(picked).select("key").limit(SAMPLE).toLocalIterator())
    edges = sorted({sample[len(sample) * k // ranges] for k in range(1, ranges)} - {b""}) if sample else []

    def with_range(table: DataFrame, schema: str, of) -> DataFrame:
        def make():
            def step(batch):
                spans = [of(k.encode()) for k in batch.column("key").to_pylist()]
                take = pa.array([i for i, (a, b) in enumerate(spans) for _ in range(a, b + 1)], type=pa.int64())
                yield {c: batch.column(c).take(take) for c in batch.schema.names} | {"span": [r for a, b in spans for r in range(a, b + 1)]}

            return step

        return map_batches(table, make, schema + ", span int")

    def of_url(key: bytes):
        at = bisect_right(edges, key)
        return at, at

    def of_rule(key: bytes):
        # keys of the interval begin with the rule's key; 0x02 ends it
        return bisect_right(edges, key), bisect_right(edges, key[:-1] + b"\x02") if key else len(edges)

    urls = with_range(rows, "page_id long, host string, path string, key string", of_url)
    urls = urls.select("span", "key", F.lit(1).alias("kind"), "page_id", "host", "path", F.lit(None).cast("string").alias("verdict"))
    nested = with_range(known, "host string, path string, verdict string, key string", of_rule)
    nested = nested.select("span", "key", F.lit(0).alias("kind"), F.lit(None).cast("long").alias("page_id"), "host", "path", "verdict")
    both = urls.unionByName(nested).repartition(ranges, "span").sortWithinPartitions("span", "key", "kind")

    def make():
        state = {"span": None, "stack": []}

        def step(batch):
            out = {c: [] for c in ("page_id", "host", "path", "rule", "verdict")}
            columns = [batch.column(c).to_pylist() for c in ("span", "key", "kind", "page_id", "host", "path", "verdict")]
            for span, key, kind, page_id, host, path, verdict in zip(*columns):
                if span != state["span"]:
                    state.update(span=span, stack=[])
                stack = state["stack"]
                while stack and not key.startswith(stack[-1][0]):
                    stack.pop()
                if not kind:
                    stack.append((key, host, path, verdict))
                    continue
                fits = [(len(h) + len(p), len(h), h, p, v) for _, h, p, v in stack if path.startswith(p)]
                best = min(fits, key=lambda f: (-f[0], -f[1], f[2], f[3]), default=None)
                for c, v in zip(out, (page_id, host, path, best and best[2] + best[3], best[4] if best else default)):
                    out[c].append(v)
            yield out

        return step

    return map_batches(both, make, "page_id long, host string, path string, rule string, verdict string")


def op2_url_filter(spark, sf_dir: str) -> DataFrame:
    return judge(spark.read.parquet(f"{sf_dir}/pages.parquet"), rules_table(spark))


OP2_SQL = r"""
with u as (
    select page_id,
        coalesce(translate(regexp_extract(url, '^.*?://([^/?#]*)([^?#]*)', 1, 's'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '') as host,
        coalesce(regexp_extract(url, '^.*?://([^/?#]*)([^?#]*)', 2, 's'), '') as path
    from pages
), r(rule_host, rule_path, verdict) as (
    values ('com', '/', 'allow'), ('example.com', '/en/', 'block'), ('www.example.com', '/en/', 'allow'),
           ('net', '/es/', 'block'), ('net', '/fr/', 'block')
), f as (
    select u.host, u.path, r.rule_host || r.rule_path as rule, r.verdict,
        row_number() over (partition by u.host, u.path order by length(r.rule_host || r.rule_path) desc, length(r.rule_host) desc, r.rule_host || r.rule_path) as k
    from (select distinct host, path from u) u
    join r on (u.host = r.rule_host or ends_with(u.host, '.' || r.rule_host)) and starts_with(u.path, r.rule_path)
)
select u.page_id, u.host, u.path, f.rule, coalesce(f.verdict, 'allow') as verdict
from u left join f on f.k = 1 and u.host = f.host and u.path = f.path
"""
