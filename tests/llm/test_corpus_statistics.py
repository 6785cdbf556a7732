"""Resampling, filter audit and language-model scores against brute force."""

from __future__ import annotations

import hashlib
import math
import random
import re
import zlib
from collections import Counter
from itertools import permutations

import pytest
from pyspark.sql import functions as F

from roadpulse.llm import audit, lm, resample
from test_llm_operators import SCHEMA, UPPER, corpus, plain, spaced


@pytest.fixture(scope="module")
def docs(spark):
    langs = ["en", "de", None, ""]
    rows = [(i, t, langs[k % 4], "s", len(t or ""), "r", k, "h", "x") for k, (i, t) in enumerate(corpus())]
    return spark.createDataFrame(rows + rows[:3], SCHEMA)


@pytest.fixture(scope="module")
def nothing(spark):
    return spark.createDataFrame([], SCHEMA)


def features_of(text, run):
    words = [w.encode() for w in plain(text)]
    return [zlib.crc32(b" ".join(words[i : i + n])) % 500 for n in range(1, run + 1) for i in range(len(words) - n + 1)]


@pytest.mark.parametrize("run", [1, 3])
def test_resample(spark, docs, nothing, run):
    items = ["w1 w2 w3 w4 W5", None, "", "w7 w8 w9 élan"]
    target = spark.createDataFrame([(k, t, 1) for k, t in enumerate(items)], "item_id long, text string, weight int")
    rows = [(r["doc_id"], r["text"]) for r in docs.collect()]
    s, t = (Counter(f for x in side for f in features_of(x, run)) for side in ([x for _, x in rows], items))
    size, goal = sum(s.values()), sum(t.values())
    gain = [math.floor(1000 * math.log(((t[b] + 1) * (size + 500)) / ((s[b] + 1) * (goal + 500)))) for b in range(500)]
    scores = []
    for i, x in rows:
        weight = sum(gain[f] for f in features_of(x, run))
        h = int(hashlib.sha256(f"9:{'' if i is None else i}".encode()).hexdigest()[:8], 16)
        scores.append([i, len(features_of(x, run)), weight, weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 2**32))), len(plain(x))])
    fit = sorted((r for r in scores if r[4] >= 5), key=lambda r: (-r[3], r[0] is None, r[0] or 0, r[2], r[1]))
    most = 40 * len(fit) // 100
    want = Counter(tuple(r[:4]) + (k + 1 if k < most else None,) for k, r in enumerate(fit))
    want += Counter(tuple(r[:4]) + (None,) for r in scores if r[4] < 5)
    got = resample.resample(docs, target, run, 500, 40, 5, 9).drop("n_words")
    assert Counter(map(tuple, got.collect())) == want
    assert resample.resample(nothing, target).count() == 0
    assert resample.resample(docs, target.filter("false")).filter("rank is not null").count() > 0


def test_ranks_over_many_ranges(spark):
    """Ranks run on from one range of scores to the next, ties by id."""
    rng = random.Random(4)
    rows = [(i, 0, 0, rng.randint(0, 40)) for i in range(3000)]
    table = spark.createDataFrame(rows, "doc_id long, n_features long, weight long, score long")
    got = resample.ranked(table, 1000).filter("rank is not null").collect()
    want = sorted(rows, key=lambda r: (-r[3], r[0]))[:1000]
    assert {r["rank"]: r["doc_id"] for r in got} == {k + 1: r[0] for k, r in enumerate(want)}


def test_intervals_cover_every_order_once():
    assert [audit.rank(o) for o in audit.ORDERS] == list(range(120)) and audit.ORDERS == sorted(audit.ORDERS)
    for mask in range(1, audit.MASKS):
        ranks = [r for m, _, low, high in audit.intervals() if m == mask for r in range(low, high)]
        assert sorted(ranks) == list(range(120))


def test_filter_audit(spark, docs, nothing):
    marks = [(0, 1, 0), (1, 0, 1), (3, 1, 1), (3, 0, 0), (None, 1, 1), (20, 1, None), (24, 1, 1), (33, 1, 0), (31, None, 1), (999, 1, 1)]
    labels = spark.createDataFrame([(*m, "x") for m in marks], "doc_id long, quality int, toxic int, part string")
    rows = [(r["doc_id"], r["text"] or "", r["lang"] or "") for r in docs.collect()]
    rows += [(100, "A" * 40, "en"), (101, "A" * 40, "fr"), (102, "cost $5 ok " * 90, "en"), (99, "cost $5 ok " * 90, "")]
    extra = [(i, t, lang, "s", 0, "r", 0, "h", "x") for i, t, lang in rows[-4:]]
    good, bad = {i for i, q, _ in marks if q == 1}, {i for i, _, x in marks if x == 1}

    def failed(i, t):
        w = spaced(t)
        copy = i is not None and any(o is not None and o < i and x == t for o, x, _ in rows)
        hits = [len(w) < 200, 100 * len(set(w)) < 50 * len(w), 100 * len(re.findall("[A-Z]", t)) > 3 * len(t), bool(re.search("[#$%&*|]", t)), copy]
        return {f for f, h in zip("ABCDE", hits) if h}

    want, shares = {}, Counter()
    for part in {p for _, _, p in rows}:
        mine = [(failed(i, t), i is not None and i in good, i is not None and i in bad) for i, t, p in rows if p == part]
        for order in permutations("ABCDE"):
            left = mine
            for k, f in enumerate(order):
                gone = [m for m in left if f in m[0]]
                left = [m for m in left if f not in m[0]]
                redundant = sum(f in m[0] for m in mine) - len(gone)
                alone = sum(m[0] == {f} for m in mine)
                want[part, "".join(order), k + 1] = [len(left), len(gone), redundant, alone, sum(m[1] for m in gone), sum(m[2] for m in gone), f]
                shares[part, f] += len(gone)
    want = {k: (*v[:6], shares[k[0], v[6]]) for k, v in want.items()}
    got = {tuple(r)[:3]: tuple(r)[3:] for r in audit.audit(docs.union(spark.createDataFrame(extra, SCHEMA)), labels).collect()}
    assert got == want
    assert audit.audit(nothing, labels).count() == 0
    assert audit.audit(docs, labels.filter("false")).filter("good_lost + toxic_lost > 0").count() == 0


def model_scores(rows, order, pull):
    """(tokens, known, N, base, score) of each (text, learned) by the definition."""
    reads = [["<s>", *[w.translate(UPPER) for w in spaced(t)], "</s>"] for t, _ in rows]
    counts = Counter()
    for tokens, (_, learned) in zip(reads, rows):
        for m in range(1, order + 1):
            counts.update(tuple(tokens[i : i + m]) for i in range(len(tokens) - m + 1) if learned)
    train = {w: c for w, c in counts.items() if len(w) == 1 and w != ("<s>",)}
    size, kinds = sum(train.values()), len(train)

    def chance(history, w):
        if not history:
            return (train.get((w,), 0) + 1) / (size + kinds + 1)
        shorter = chance(history[1:], w)
        if not counts[history]:
            return shorter
        return (counts[(*history, w)] + pull * shorter) / (counts[history] + pull)

    for tokens in reads:
        base = sum(math.log10(chance((), w)) for w in tokens[1:])
        full = sum(math.log10(chance(tuple(tokens[max(0, i - order + 1) : i]), tokens[i])) for i in range(1, len(tokens)))
        yield len(tokens) - 1, sum((w,) in train for w in tokens[1:]), size, base, full


@pytest.mark.parametrize("order, block, bucket", [(1, 1 << 20, 1 << 20), (2, 2000, 100), (3, 5000, 1000)])
def test_language_model(spark, docs, nothing, order, block, bucket):
    learned = F.coalesce(F.col("doc_id") % 3 != 1, F.lit(False))
    rows = [(r["doc_id"], r["text"], r["doc_id"] is not None and r["doc_id"] % 3 != 1) for r in docs.collect()]
    table = docs.select("doc_id", "text", learned.alias("learned")).repartition(3)
    got = lm.score(table, order, 1.5, block, bucket).collect()
    want = [(i, *s) for (i, _, _), s in zip(rows, model_scores([r[1:] for r in rows], order, 1.5))]
    key = lambda r: (r[0] is None, r[0] or 0, r[1], r[4])
    for g, w in zip(sorted(map(tuple, got), key=key), sorted(want, key=key), strict=True):
        assert g[:4] == w[:4] and g[4:] == pytest.approx(w[4:], rel=1e-9, abs=1e-9)
    assert lm.score(nothing.select("doc_id", "text", learned.alias("learned"))).count() == 0


def test_language_model_learns_nothing(spark, docs):
    table = docs.select("doc_id", "text", F.lit(False).alias("learned"))
    assert {tuple(r) for r in lm.score(table).select("n_known", "train_tokens", "base_score", "score").collect()} == {(0, 0, 0.0, 0.0)}


def test_language_model_beats_its_base(spark):
    from conftest import SMALL

    held = lm.op11_lm_score(spark, SMALL).filter("held_out").agg(F.sum("base_score"), F.sum("score")).first()
    assert held[1] > held[0]
