"""Each operator against brute force on texts with nulls, blanks, copies, long
texts, repeated rows and columns whose names the operators use themselves."""

from __future__ import annotations

import hashlib
import random
import re
import zlib
from collections import Counter, defaultdict
from functools import reduce
from operator import add
from types import SimpleNamespace

import numpy as np
import pytest

from compare import connect, difference
from conftest import SMALL
from roadpulse.llm import language, leaks, licenses, lines, neardup, neighbours, packing, queries, substrings, textbytes, toxicity, urls

UPPER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, row string, key int, text_hash string, removed string"


def spaced(text):
    return re.findall(r"[^\x20\x09-\x0D]+", text or "")


def plain(text):
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (text or "").translate(UPPER))


def corpus():
    rng = random.Random(5)
    vocabulary = [f"w{i}" for i in range(400)] + ["élan", "Über", "a-b", "x,y."]
    base = [" ".join(rng.choices(vocabulary, k=rng.randint(40, 90))) for _ in range(12)]
    rows = [(i, t) for i, t in enumerate(base)]
    rows += [(20, base[0]), (21, base[0].upper()), (22, base[1] + " tail"), (23, "\n".join(base[:3]))]
    rows += [(24, f"{base[4]}\n\n{base[5]}\n{base[6]}"), (25, f"lead\n{base[5]}\n{base[6]}\nend")]
    rows += [(26, ""), (27, None), (28, " \n\t "), (29, "one"), (30, "one"), (31, "1 + 2 = 3 !!"), (32, "x" * 5000)]
    rows += [(33, " ".join(rng.choices(vocabulary, k=9000)) + " " + base[7]), (7, base[7]), (None, base[8]), (None, None)]
    edited = base[9].split()
    rows += [(40 + k, " ".join(edited[:k] + ["new"] + edited[k + 1 :])) for k in range(0, 30, 5)]
    rows += [(60, "All rights reserved. Licensed under CC BY-NC 4.0. This work is licensed under the GNU General Public License, version 3."), (61, "cc by cc by")]
    return rows


@pytest.fixture(scope="module")
def docs(spark):
    langs = ["en", "de", None]
    rows = [(i, t, langs[k % 3], "s", len(t or ""), "r", k, "h", "x") for k, (i, t) in enumerate(corpus())]
    return spark.createDataFrame(rows, SCHEMA)


@pytest.fixture(scope="module")
def nothing(spark):
    return spark.createDataFrame([], SCHEMA)


def by_row(rows, *names):
    return Counter(tuple(r[n] for n in names) for r in rows)


def test_near_dedup(docs, nothing):
    rows = corpus()
    sets = []
    for _, t in rows:
        w = [x.translate(UPPER) for x in spaced(t)]
        sets.append({*zip(w, w[1:])} if len(w) > 1 else {tuple(w)} - {()})
    group = list(range(len(rows)))
    for i in range(len(rows)):
        for j in range(i):
            both = len(sets[i] & sets[j])
            if sets[i] and sets[j] and 100 * both >= 80 * len(sets[i] | sets[j]):
                old, new = group[i], group[j]
                group = [new if g == old else g for g in group]
    ids = defaultdict(list)
    for g, (i, _) in zip(group, rows):
        ids[g] += [i] if i is not None else []
    want = Counter()
    for s, g, (i, _) in zip(sets, group, rows):
        name = (min(ids[g]) if ids[g] else None) if s else i
        want[(i, len(s), name, i == name)] += 1
    got = neardup.components_of(docs, size=2).collect()
    assert by_row(got, "doc_id", "n_shingles", "component_id", "kept") == want
    assert neardup.components_of(nothing).count() == 0


def test_classes_of_rows_without_ids(spark):
    """Each class is read once, whatever number of rows has no id."""
    rng = random.Random(2)
    rows = [(None, " ".join(rng.choices("abcdefgh", k=12)) + f" {i // 2}") for i in range(300)]
    table = spark.createDataFrame(rows + rows[:5], "doc_id long, text string")
    found = neardup.components_of(table, size=2).groupBy("node").count()
    assert found.count() == len(set(rows))
    docs = table.select("*", neardup.text_hash(table))
    classes = neardup.signatures(docs, 2).groupBy("node", "doc_id").agg(neardup.F.min("text_hash").alias("text_hash"))
    sets = neardup.full_sets(docs, classes, 2)
    assert sets.count() == len(set(rows))


def test_near_duplicates_keep_one(docs, nothing):
    kept = neardup.near_duplicates(docs, size=2)
    assert kept.columns == docs.columns
    ids = [r["doc_id"] for r in kept.collect()]
    assert ids.count(7) == 1 and 0 in ids and 20 not in ids and 21 not in ids and 27 in ids
    assert neardup.near_duplicates(nothing).count() == 0


def test_tiles_find_links_between_groups(spark, monkeypatch):
    """Copies that aren't close to the least of their group are linked as well."""
    rng = random.Random(2)
    words = [f"v{i}" for i in range(200)]
    rows = []
    for k in range(60):
        w = list(words)
        for p in rng.sample(range(200), 9):
            w[p] = f"n{k}_{p}"
        rows.append((k, " ".join(w)))
    monkeypatch.setattr(neardup, "TILE", 8)
    got = neardup.components_of(spark.createDataFrame(rows, "doc_id long, text string"), size=2).collect()
    sets = [{*zip(t.split(), t.split()[1:])} for _, t in rows]
    group = list(range(60))
    for i in range(60):
        for j in range(i):
            if 100 * len(sets[i] & sets[j]) >= 80 * len(sets[i] | sets[j]):
                group = [group[j] if g == group[i] else g for g in group]
    least = {g: group.index(g) for g in group}
    assert {r["doc_id"]: r["component_id"] for r in got} == {i: least[g] for i, g in enumerate(group)}


def test_url_rules(spark):
    pages = [(1, "http://Example.COM/en/x?q"), (2, "https://www.example.com/en/"), (3, "ftp://a.net/es/1#y"), (4, None), (5, "no scheme"),
             (6, "http://example.com"), (6, "http://notexample.com/en/"), (None, "http://b.fr/"), (7, "http://x.y.net/fr/a://b"), (8, "http://com/")]
    pages = spark.createDataFrame([(*p, "h") for p in pages], "page_id long, url string, host string")
    rules = urls.rules_table(spark)
    got = by_row(urls.judge(pages, rules, ranges=4).collect(), "page_id", "host", "path", "rule", "verdict")
    assert got == Counter(
        [
            (1, "example.com", "/en/x", "example.com/en/", "block"), (2, "www.example.com", "/en/", "www.example.com/en/", "allow"),
            (3, "a.net", "/es/1", "net/es/", "block"), (4, "", "", None, "allow"), (5, "", "", None, "allow"),
            (6, "example.com", "", None, "allow"), (6, "notexample.com", "/en/", "com/", "allow"), (None, "b.fr", "/", None, "allow"),
            (7, "x.y.net", "/fr/a://b", "net/fr/", "block"), (8, "com", "/", "com/", "allow"),
        ]
    )
    assert urls.judge(pages.limit(0), rules).count() == 0


def brute_hits(rows, items, window):
    out = []
    for i, t in rows:
        w, hit, found = plain(t), set(), set()
        for name, text in items:
            x = plain(text)
            size = min(window, len(x))
            for s in range(len(x) - size + 1) if x else ():
                for p in range(len(w) - size + 1):
                    if w[p : p + size] == x[s : s + size]:
                        hit |= {*range(p, p + size)}
                        found.add(str(name))
        out.append((i, len(w), len(hit), tuple(sorted(found))))
    return Counter(out)


@pytest.mark.parametrize("most", [leaks.BROADCAST, 0])
def test_decontamination(spark, docs, nothing, monkeypatch, most):
    rows = corpus()
    items = [(1, " ".join(rows[2][1].split()[5:30])), (12, "W3 one"), (2, None), (3, ""), (4, rows[4][1] + " unseen"), (5, "ONE")]
    table = spark.createDataFrame([(*x, 1) for x in items], "item_id long, text string, word int")
    monkeypatch.setattr(leaks, "BROADCAST", most)
    got = leaks.contamination(docs, table, 10).collect()
    assert Counter((r["doc_id"], r["n_words"], r["n_hit"], tuple(r["items"])) for r in got) == brute_hits(rows, items, 10)
    kept = leaks.without_leaks(docs, table, 10)
    clean = Counter(i for i, _, hit, _ in brute_hits(rows, items, 10).elements() if not hit)
    assert kept.columns == docs.columns and Counter(r["doc_id"] for r in kept.collect()) == clean
    assert leaks.contamination(nothing, table).count() == 0
    assert leaks.without_leaks(docs, table.limit(0)).count() == docs.count()


def test_fingerprints_are_selected_lines(spark):
    """Every window has its least line among the fingerprints, and only such lines are."""
    rng = random.Random(3)
    texts = ["\n".join(f"l{rng.randrange(40)}" for _ in range(n)) for n in (0, 1, 2, 3, 4, 50, 300)] + [None]
    table = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").selectExpr("*", "xxhash64(text) as text_hash")
    hashes = {r["l"]: r["h"] for r in spark.createDataFrame([(f"l{i}",) for i in range(40)] + [("",)], "l string").selectExpr("l", "xxhash64(l) as h").collect()}
    for run in (2, 4):
        got = defaultdict(dict)
        for r in lines.fingerprints(table, run).collect():
            got[r["doc_id"]][r["line"]] = r
        for i, text in enumerate(texts):
            h = [hashes[x] for x in text.split("\n")] if text is not None else []
            want = {s + h[s : s + run].index(min(h[s : s + run])) for s in range(len(h) - run + 1)}
            assert set(got[i]) == want
            for p, r in got[i].items():
                assert r["mark"] == h[p] == r["near"][r["at"]] and r["near"] == h[max(p - run + 1, 0) : p + run]
        assert len(got[6]) < 0.8 * 299 if run == 2 else len(got[6]) < 0.55 * 297


def test_source_of_a_later_run(spark):
    table = spark.createDataFrame([(1, "a\nb\nc\nd"), (2, "x\nb\nc\nd\ny"), (3, "c\nd")], "doc_id long, text string")
    got = lines.later_windows(table.selectExpr("*", "xxhash64(text) as text_hash"), 2).collect()
    assert sorted((r["doc_id"], r["low"], r["first"]["doc_id"], r["first"]["low"]) for r in got) == [(2, 1, 1, 1), (2, 2, 1, 2), (3, 0, 1, 2)]


@pytest.mark.parametrize("run", [1, 2, 3])
def test_line_dedup(docs, nothing, run):
    rows = [(i, t) for i, t in corpus()]
    # rows equal in id and text are one document; null ids come last
    order = sorted({(i is None, i or 0, t) for i, t in rows if t is not None})
    seen, want = set(), {}
    for last, i, t in order:
        x, gone = t.split("\n"), set()
        for s in range(len(x) - run + 1):
            window = tuple(x[s : s + run])
            if window in seen:
                gone |= {*range(s, s + run)}
            seen.add(window)
        want[(None if last else i, t)] = ("\n".join(y for k, y in enumerate(x) if k not in gone), len(x), len(gone))
    got = lines.remove_repeated_lines(docs.withColumn("source", docs["text"]), run)
    assert got.columns == [c for c in docs.columns if c != "removed"] + ["n_lines", "n_removed", "removed"]
    for r in got.collect():
        expected = want.get((r["doc_id"], r["source"]), (None, 0, 0))
        assert (r["text"], r["n_lines"], r["n_removed"]) == expected
    assert lines.without_repeated_lines(docs, run).columns == docs.columns
    assert lines.remove_repeated_lines(nothing, run).count() == 0


@pytest.mark.parametrize("window, gram, crowd", [(35, 8, 4096), (35, 8, 1), (5, 2, 4096), (5, 2, 2), (3, 3, 4096)])
def test_substring_dedup(docs, nothing, window, gram, crowd):
    rows = corpus()
    count = Counter(tuple(w[i : i + window]) for w in (spaced(t) for _, t in rows) for i in range(len(w) - window + 1))
    want = Counter()
    for i, t in rows:
        w = spaced(t)
        gone = {k for s in range(len(w) - window + 1) if count[tuple(w[s : s + window])] > 1 for k in range(s, s + window)}
        want[(i, len(w), len(gone), " ".join(x for k, x in enumerate(w) if k not in gone))] += 1
    got = substrings.remove_repeats(docs, window, gram, crowd).collect()
    assert by_row(got, "doc_id", "n_words", "n_removed", "kept") == want
    assert substrings.remove_repeats(nothing).count() == 0


def test_parse_is_greedy_and_longest():
    rng = np.random.default_rng(3)
    window, gram = 6, 2
    reach, width = window - gram, 2 * window - gram
    for _ in range(40):
        n = int(rng.integers(1, 12))
        anchors = rng.integers(1, 3, n)
        table = rng.integers(1, 3, (n, width))
        first = rng.integers(0, reach + 1, n)
        count = np.array([int(rng.integers(1, reach + 2 - f)) for f in first])
        for i in range(n):
            table[i, : first[i]] = 0
            table[i, first[i] + count[i] + window - 1 :] = 0
        want = []
        for i in range(n):
            at = first[i]
            while at < first[i] + count[i]:
                long = 0
                for j in range(n):
                    if j != i and anchors[j] == anchors[i] and first[j] <= at < first[j] + count[j]:
                        k = 0
                        while at + k < width and table[i, at + k] == table[j, at + k] != 0:
                            k += 1
                        long = max(long, k)
                if long >= window:
                    want.append((i, at, long - window + 1))
                at += long - window + 1 if long >= window else 1
        got = substrings.parse(anchors.astype(">u8"), table.astype(">u8"), first, count, window)
        assert sorted(zip(*map(list, got))) == sorted(want)


def test_plan_is_cheapest():
    rng = np.random.default_rng(0)
    for _ in range(60):
        n = int(rng.integers(5, 60))
        places = np.unique(np.append(rng.integers(1, n + 1, 30), n))
        if np.diff(np.append(0, places)).max() > 16:
            continue
        price = rng.integers(0, 6, len(places))
        spots, prices = [0, *places.tolist()], [0, *price.tolist()]

        def cost(size):
            return packing.SEQUENCE + (0 if size in (2, 4, 8, 16) else 16 - size)

        best = [0]
        for i in range(1, len(spots)):
            best.append(min(best[j] + cost(spots[i] - spots[j]) for j in range(i) if spots[i] - spots[j] <= 16) + prices[i])
        cuts = packing.plan(places, price, 16)
        assert sum(cost(b - a) + prices[spots.index(b)] for a, b in zip([0, *cuts], cuts)) == best[-1]


def test_packing_round_trip(docs, nothing):
    from tokenizers import Tokenizer

    model = Tokenizer.from_file(packing.default_tokenizer())
    extra = docs.sparkSession.createDataFrame([(90, "a <|endoftext|> b<|startoftext|>c it's İ! e\u0301 ...")], "doc_id long, text string")
    rows = [*corpus(), *[(r["doc_id"], r["text"]) for r in extra.collect()]]
    want = Counter((i, (*model.encode(t or "", add_special_tokens=False).ids, 2)) for i, t in rows)
    got, at, places = Counter(), defaultdict(list), defaultdict(list)
    for r in packing.pack(docs.select("doc_id", "text").unionByName(extra).coalesce(1)).collect():
        assert r["ids_crc32"] == zlib.crc32(np.array(r["ids"], dtype="<u4").tobytes()) and r["length"] == len(r["ids"])
        places[r["sequence_id"]].append((r["offset"], r["length"]))
        at[r["sequence_id"]].append(r)
    whole = []
    for s in sorted(at):
        reach = 0
        for offset, length in sorted(places[s]):
            assert offset == reach
            reach += length
        assert reach <= packing.LENGTH
        whole += sorted(at[s], key=lambda r: r["offset"])
    # pieces follow each other, so a document ends where its last id is reached
    ids = []
    for r in whole:
        assert r["start"] == len(ids)
        ids += r["ids"]
        if len(ids) == r["doc_tokens"]:
            got[(r["doc_id"], tuple(ids))] += 1
            ids = []
    assert got == want
    assert packing.pack(nothing).count() == 0


def test_gradients():
    net, rng = toxicity.Network(3), np.random.default_rng(0)
    net.p = {k: v.astype(np.float64) for k, v in net.p.items()}
    x, y = rng.normal(0, 0.5, (5, 4, 2 * toxicity.WIDTH)), np.array([1.0, 0, 1, 0])

    def loss():
        two = np.stack((x, x[::-1]), axis=1)
        states, _ = net.recur(np.einsum("tdbi,dij->tdbj", two, net.p["w"]) + net.p["b"], False)
        logit = net.head(states)[3]
        return np.mean(np.log1p(np.exp(logit)) - y * logit)

    g, dx = net.gradients(x, y, np.ones(4))
    for values, slope in [(net.p[k], v) for k, v in g.items()] + [(x, dx)]:
        for _ in range(4):
            i = tuple(rng.integers(0, n) for n in values.shape)
            old = values[i]
            values[i] = old + 1e-5
            up = loss()
            values[i] = old - 1e-5
            down = loss()
            values[i] = old
            assert abs((up - down) / 2e-5 - slope[i]) < 1e-6


def test_toxicity_learns(spark, docs, nothing):
    rng = random.Random(1)
    words = [f"term{i}" for i in range(200)]
    rows, labels = [], []
    for i in range(500):
        w = rng.choices(words, k=rng.randint(20, 120))
        if i % 4 == 0:
            w[rng.randrange(len(w))] = "vile" + rng.choice(["", "s", "ly", "ness", "st"])
        rows.append((i, " ".join(w)))
        labels.append((i, int(i % 4 == 0)))
    table = spark.createDataFrame(rows, "doc_id long, text string")
    marks = spark.createDataFrame([*labels, (1, None), (None, 1)], "doc_id long, toxic int")
    model = toxicity.learn(table, marks, language.fold(5) != 0)
    score = {r["doc_id"]: r["score"] for r in toxicity.score(table, model).collect()}
    held = [i for i in range(500) if zlib.crc32(str(i).encode()) % 5 == 0]
    assert np.mean([(score[i] >= 0.5) == (i % 4 == 0) for i in held]) > 0.95
    every = toxicity.score(docs, model).collect()
    assert len(every) == docs.count() and all(0 <= r["score"] <= 1 for r in every)
    assert toxicity.score(nothing, model).count() == 0
    assert toxicity.learn(table, marks.limit(0), language.fold(5) != 0) == 0.5
    assert toxicity.score(docs, 0.5).first()["score"] == 0.5


def test_licenses(docs, nothing):
    want = Counter()
    for i, t in corpus():
        w, places, labels = plain(t), [], set()
        for p in licenses.BASE_PHRASES:
            for s in range(len(w)):
                if tuple(w[s : s + len(p.words)]) == p.words:
                    places.append(s)
                    labels.add(p.label)
        want[(i, len(w), len(places), min(places, default=None), max(places, default=None), tuple(sorted(labels)))] += 1
    got = licenses.scan(docs).collect()
    assert Counter((*(r[c] for c in ("doc_id", "n_words", "n_base", "first_word", "last_word")), tuple(r["base_labels"])) for r in got) == want
    found = {r["doc_id"]: r for r in got}
    assert found[60]["labels"] == ["cc-by", "cc-by-nc", "gpl", "gpl-3.0", "reserved"] and found[60]["score"] == 1.0
    assert found[27]["labels"] == [] and found[27]["score"] == 0.0
    assert licenses.scan(nothing).count() == 0


def test_neighbours(spark):
    rng = np.random.default_rng(4)
    rows = [(i, rng.normal(size=8).tolist()) for i in range(150)] + [(i, [0.5] * 8) for i in range(150, 190)]
    odd = [(200, None), (220, [0.0] * 8), (240, [1.0, None] + [0.0] * 6), (260, [float("nan")] + [1.0] * 7), (280, [float("inf")] * 8)]
    odd += [(300, []), (320, [1.0, 2.0]), (321, [2.0, 1.0]), (None, [1.0] * 8), (20, rows[20][1]), (400, [1e-310] * 8)]
    table = spark.createDataFrame([(*r, 3) for r in rows + odd], "vec_id long, embedding array<double>, score int")
    got = defaultdict(list)
    for r in neighbours.nearest(table, table["vec_id"] % 20 == 0, k=5, block=16, query_block=4, candidate_blocks=2, query_blocks=2).orderBy("query_id", "rank").collect():
        got[r["query_id"]].append((r["vec_id"], r["score"]))
    valid = [(i, v) for i, v in rows + odd if i is not None and v and all(x is not None and np.isfinite(x) for x in v) and any(v)]
    for q, v in {i: v for i, v in valid if i % 20 == 0}.items():
        scores = sorted((-reduce(add, (a * b for a, b in zip(v, u))), i) for i, u in valid if i != q and len(u) == len(v))
        assert got.pop(q) == [(i, -s) for s, i in scores[:5]]
    assert not got
    assert neighbours.nearest(table.limit(0), table["vec_id"] % 20 == 0).count() == 0
    single = table.withColumn("embedding", table["embedding"].cast("array<float>"))
    double = single.withColumn("embedding", single["embedding"].cast("array<double>"))
    found = [sorted(neighbours.nearest(t, t["vec_id"] % 20 == 0, k=5).collect()) for t in (single, double)]
    assert found[0] == found[1] and neighbours.usable(single).schema["embedding"].dataType.simpleString() == "array<float>"


def test_blocks_hold_int8(spark):
    vectors = np.random.default_rng(6).normal(size=(300, 16))
    table = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(vectors)], "vec_id long, embedding array<float>")
    rows = neighbours.blocks(neighbours.usable(table), 64).collect()
    assert sum(len(r["codes"]) for r in rows) == 300 * 16 and sum(len(r["data"]) for r in rows) == 300 * 16 * 4
    left = neighbours.quantised(vectors[:40])
    assert left[0].dtype == np.int8
    low, high = neighbours.tile_bounds(left, neighbours.quantised(vectors))
    product = vectors[:40] @ vectors.T
    assert (low <= product).all() and (product <= high).all()
    query, other, scores = np.array([0, 0, 0, 1, 1]), np.array([9, 4, 7, 2, 3]), np.array([1.0, 1.0, 2.0, 5.0, 6.0])
    assert neighbours.best_of(query, other, scores, 2).tolist() == [2, 1, 4, 3]


def test_whole_licences_and_many_templates(spark):
    lead = "Copyright 2020 somebody\n\n"
    damaged = licenses.MIT.replace("merge", "combine").replace("deal in", "trade in")
    texts = [lead + licenses.MIT, lead + licenses.ISC + " x " + licenses.MIT, damaged, licenses.MIT[300:], "mit license", licenses.BSD_2]
    table = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {r["doc_id"]: r for r in licenses.scan(table).collect()}
    assert [got[i]["labels"] for i in range(6)] == [["mit"], ["isc", "mit"], ["mit"], [], [], ["bsd", "bsd-2-clause"]]
    # the short notice is in it unchanged, of the whole text two words differ
    assert max(m["equal"] for m in got[2]["matches"]) == len(licenses.plain_words(licenses.MIT)) - 2
    whole = max(got[1]["matches"], key=lambda m: m["equal"])
    assert whole["word"] == 3 + len(licenses.plain_words(licenses.ISC)) + 1 and whole["equal"] == len(licenses.plain_words(licenses.MIT))
    # other templates change nothing but the weights of words
    more = tuple(licenses.template(f"t{i}", f"terms number {i} of the licence {i + 1} are special", "of the licence") for i in range(300))
    again = {r["doc_id"]: r for r in licenses.scan(table, templates=licenses.TEMPLATES + more).collect()}
    assert {i: r["labels"] for i, r in again.items()} == {i: r["labels"] for i, r in got.items()}


def test_alignments_against_brute_force():
    rng = random.Random(9)
    vocabulary = [f"w{i}" for i in range(12)]
    templates = tuple(licenses.Template(f"t{i}", tuple(w), tuple(w[2:4])) for i, w in enumerate(rng.choices(vocabulary, k=rng.randint(4, 9)) for _ in range(30)))
    code = dict(zip(vocabulary, licenses.hash_words(vocabulary).tolist()))
    idf = {w: 1.0 + i for i, w in enumerate(vocabulary)}
    index = licenses.Index.of((), templates, idf, code, 3)
    texts = [rng.choices(vocabulary, k=rng.randint(0, 60)) for _ in range(20)]
    data = [" ".join(t).encode() for t in texts]
    offsets = np.cumsum([0] + [len(d) for d in data])
    words = textbytes.Tokeniser("alnum", True).words(np.frombuffer(b"".join(data), dtype=np.uint8), offsets)
    doc, number, start = index.alignments(words, words.doc_of())
    key, equal, share = index.compared(words, doc, number, start)
    got = {(d, t, s - words.first[d]): (k, e, round(x, 9)) for d, t, s, k, e, x in zip(doc, number, start, key, equal, share)}
    want = {}
    for d, text in enumerate(texts):
        for n, t in enumerate(templates):
            rare = sorted(range(len(t.words)), key=lambda i: (-idf[t.words[i]], i))[:3]
            begin = next(i for i in range(len(t.words)) if t.words[i : i + 2] == t.key)
            for s in range(-len(t.words), len(text)):
                same = [0 <= s + i < len(text) and text[s + i] == w for i, w in enumerate(t.words)]
                if sum(same[i] for i in rare) >= 2:
                    weights = [idf[w] for w in t.words]
                    want[d, n, s] = (all(same[begin : begin + 2]), sum(same), round(sum(w for w, x in zip(weights, same) if x) / sum(weights), 9))
    assert got == want and len(want) > 50


def test_viterbi_finds_the_best_path():
    rng = np.random.default_rng(1)
    for _ in range(200):
        n, languages = int(rng.integers(1, 6)), int(rng.integers(1, 5))
        doc = np.repeat(np.arange(n), rng.integers(0, int(rng.choice([12, 300])), n))
        if not len(doc):
            continue
        scores = rng.normal(0, 3, (len(doc), languages))
        path = language.best_paths(scores, doc, n, 4.0)
        for d in np.unique(doc):
            s, p = scores[doc == d], path[doc == d]
            best = s[0]
            for row in s[1:]:
                best = np.maximum(best, best.max() - 4.0) + row
            assert abs(s[np.arange(len(s)), p].sum() - 4.0 * (p[1:] != p[:-1]).sum() - best.max()) < 1e-9


def test_words_of_two_letters_hash_apart():
    """Words that agree under any polynomial modulo a power of two."""
    tokeniser = textbytes.Tokeniser("space", True)
    for power in (10, 11, 13):
        turns = "".join("ab"[bin(i).count("1") % 2] for i in range(1 << power))
        data = f"{turns} {turns.translate(str.maketrans('ab', 'ba'))} {turns.upper()}".encode()
        a, b, c = tokeniser.words(np.frombuffer(data, dtype=np.uint8), np.array([0, len(data)])).hashes
        assert a != b and a == c


def test_language(spark, docs, nothing):
    rng = random.Random(3)
    syllables = {"aa": ["ka", "to", "mi", "ru"], "bb": ["sch", "pf", "tz", "ng"], "gr": ["λο", "γι", "κα"]}
    rows = []
    for i in range(300):
        lang = list(syllables)[i % 3]
        rows.append((i, " ".join("".join(rng.choices(syllables[lang], k=3)) for _ in range(20)), lang))
    rows += [(900, None, "aa"), (901, "12 !?", "bb"), (902, "", None), (None, "kato", "aa")]
    mixed = " ".join(["katomi"] * 9 + ["schpftz"] * 30)
    table = spark.createDataFrame([*rows, (903, mixed, None)], "doc_id long, text string, lang string")
    got = {r["doc_id"]: r for r in language.identify(table.select("doc_id", "text"), language.learned(table)).collect()}
    assert all(got[i]["lang_pred"] == lang for i, _, lang in rows[:300])
    assert [(got[i]["lang_pred"], got[i]["score"]) for i in (900, 901, 902)] == [("und", 0.0)] * 3
    assert [(s["lang"], s["first"], s["number"]) for s in got[903]["spans"]] == [("aa", 0, 9), ("bb", 9, 30)]
    kept = language.accepted(docs)
    assert kept.columns == docs.columns
    assert not {26, 27, 28, 31} & {r["doc_id"] for r in kept.collect()}
    assert language.accepted(nothing).count() == 0
    assert language.learned(docs.filter("false"))["names"] == []


@pytest.mark.parametrize("name", sorted(queries.ORACLE))
def test_sql(spark, name):
    assert difference(queries.QUERIES[name](spark, SMALL), connect(SMALL), queries.ORACLE[name]) is None


@pytest.mark.parametrize("name", ["op3_decontamination", "op4_line_dedup"])
def test_native_plans(spark, name):
    plan = queries.QUERIES[name](spark, SMALL)._jdf.queryExecution().toString()
    assert not re.search("Python|Pandas|Arrow|CartesianProduct|NestedLoop", plan)


def test_digests(spark):
    table = spark.read.parquet(f"{SMALL}/documents.parquet").collect()
    got = {r["doc_id"]: r for r in queries.QUERIES["op6_substring_dedup"](spark, SMALL).collect()}
    whole = [r for r in table if got[r["doc_id"]]["n_removed"] == 0]
    assert whole and all(got[r["doc_id"]]["kept_sha256"] == hashlib.sha256(" ".join(spaced(r["text"])).encode()).hexdigest() for r in whole)


def test_pipeline(spark):
    import corpus_pipeline

    table = spark.read.parquet(f"{SMALL}/documents.parquet")
    out = corpus_pipeline.run(spark, SMALL)
    assert [name for name, _ in corpus_pipeline.STAGES] == ["language_id", "line_dedup", "near_dedup", "decontamination", "packing"]
    docs = table
    for name, stage in corpus_pipeline.STAGES[:-1]:
        docs = stage(spark, docs, SMALL)
        assert docs.columns == table.columns
    assert {r["doc_id"] for r in out.select("doc_id").distinct().collect()} == {r["doc_id"] for r in docs.select("doc_id").collect()}


def test_words_are_tokenized_apart_by_a_rare_word():
    lookup = packing.WordIds(packing.default_tokenizer())
    (number, rare), (special, _) = lookup.apart
    assert rare.isalpha() and number != special
    calls = []
    # separators of a special token cost half of all the time
    encode = lookup.model.encode_batch_fast
    lookup.model = SimpleNamespace(
        encode_batch_fast=lambda found, **how: calls.append(found) or encode(found, **how)
    )
    for words in (
        ["don't", "x<y", "K", "́abc", "a　b", "\U0001f642!!", "日本語", "Ab1", "\x00"],
        # the rare word itself, alone, as a part and in capitals
        ["one", rare, f"{rare}s", f"({rare.upper()})", "two"],
        ["one", "<|endoftext|>two"],
    ):
        calls.clear()
        ids, size = lookup.tokenized([w.encode() for w in words])
        alone = [e.ids for e in encode(words, add_special_tokens=False)]
        assert ids.tolist() == [i for one in alone for i in one]
        assert size.tolist() == [len(one) for one in alone]
        if words[0] == "don't":
            assert len(calls) == 1 and "<|" not in calls[0][0]
