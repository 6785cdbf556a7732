"""Cases that the operators once left out, with what must come of them."""

from __future__ import annotations

import random
import zlib
from collections import Counter

import numpy as np

import corpus_pipeline
from conftest import SMALL
from roadpulse.llm import language, lines, neardup, packing, toxicity

DOCS = "doc_id long, text string, n_chars long"


def table(spark, rows):
    return spark.createDataFrame([(i, t, len(t or "")) for i, t in rows], DOCS)


def prose(seed, words):
    rng = random.Random(seed)
    return " ".join(f"{rng.choice('bcdfg')}{rng.choice('aeiou')}{rng.randrange(1000)}" for _ in range(words))


def test_long_single_lines(spark):
    """A long line goes at any place where it stood before, a short one stays."""
    long, short = prose(1, 60), "Read on."
    own = [prose(10 + k, 12) for k in range(12)]
    rows = [
        (1, f"{own[0]}\n{long}\n{own[1]}"), (2, f"{own[2]}\n{long}\n{own[3]}"), (3, f"{long}\n{own[4]}"), (4, f"{own[5]}\n{long}"), (5, long),
        (6, f"{own[6]}\n{short}\n{own[7]}"), (7, f"{short}\n{own[8]}\n{long}\n{own[9]}\n{long}"), (8, f"{own[0]}\n{long}\n{own[10]}"),
        (9, None), (None, f"{long}\n{own[11]}"), (10, "x" * (lines.LONG - 1)), (11, "x" * (lines.LONG - 1)), (12, "y" * lines.LONG), (13, "y" * lines.LONG),
    ]
    seen, want = set(), Counter()
    for i, t in sorted(rows, key=lambda r: (r[0] is None, r[0] or 0)):
        x, gone = (t or "").split("\n"), set()
        for size in (1, 2):
            for s in range(len(x) - size + 1):
                window = tuple(x[s : s + size])
                if size == 2 or len(window[0]) >= lines.LONG:
                    if window in seen:
                        gone |= {*range(s, s + size)}
                    seen.add(window)
        left = "\n".join(y for k, y in enumerate(x) if k not in gone) if t is not None else None
        if not gone or left.strip():
            want[(i, left, len(left or ""))] += 1
    assert not {5, 13} & {i for i, _, _ in want} and sum(long in (t or "") for _, t, _ in want) == 1
    assert Counter(map(tuple, lines.without_repeated_lines(table(spark, rows)).collect())) == want


def test_language_rejects(spark):
    """Gibberish and unlearned scripts go; clean documents stay, mixed evenly or not."""
    rng = random.Random(8)
    syllables = {"aa": ["ka", "to", "mi", "ru"], "bb": ["sch", "pf", "tz", "ng"], "cc": ["ou", "ée", "ai", "vr"], "dd": ["ñe", "ll", "os", "ja"]}

    def text(lang, words):
        return " ".join("".join(rng.choices(syllables[lang], k=3)) for _ in range(words))

    def noise(letters, words):
        return " ".join("".join(rng.choices(letters, k=7)) for _ in range(words))

    rows = [(i, text(list(syllables)[i % 4], 60), list(syllables)[i % 4]) for i in range(400)]
    even = " ".join(text(k, 25) for k in syllables)
    greek, latin = noise("αβγδεζηθικλμνξοπρ", 40), "abcdefghijklmnopqrstuvwxyz"
    keep = [(500, even, None), (501, text("aa", 3), None), (502, f"{text('bb', 40)} {noise('αβγδ', 10)}", None), (503, text("cc", 30) + " 12 !?", None)]
    gone = [(600, noise(latin, 60), None), (601, greek, None), (602, f"{greek} {text('aa', 5)}", None), (603, "漢字仮名交じり文" * 9, None), (604, noise(latin, 8), None)]
    docs = spark.createDataFrame([*rows, *keep, *gone, (None, noise(latin, 60), None), (605, "12 !?", None)], "doc_id long, text string, lang string")
    got = Counter(r["doc_id"] for r in language.accepted(docs).collect())
    assert got == Counter([i for i, _, _ in rows + keep])


def test_one_of_each_component(spark):
    """Near copies that share the least id, or have no id at all, go but one."""
    def copies(seed, number):
        base = prose(seed, 60).split()
        return [" ".join([*base[:-1], f"end{k}"]) for k in range(number)]

    shared, nameless, named = copies(1, 3), copies(2, 3), copies(3, 2)
    rows = [*((4, t) for t in shared), (5, shared[0]), *((None, t) for t in nameless), (None, named[0]), (9, named[1])]
    rows += [(10, None), (10, None), (11, ""), (None, None), (12, prose(4, 60))]
    kept = [(r["doc_id"], r["text"]) for r in neardup.near_duplicates(table(spark, rows), size=2).collect()]
    assert sum((4, t) in kept for t in shared) == 1 and sum((None, t) in kept for t in nameless) == 1
    assert Counter(i for i, _ in kept) == Counter([4, None, 9, 10, 11, None, 12])


def test_pipeline_returns_tokens(spark):
    """The last stage's rows hold the sequences; op5's are digests of the same rows."""
    from tokenizers import Tokenizer

    docs = table(spark, [(1, prose(5, 300)), (2, None), (3, prose(6, 20))])
    out = corpus_pipeline.packing(spark, docs, SMALL).collect()
    assert out and all(zlib.crc32(np.array(r["ids"], dtype="<u4").tobytes()) == r["ids_crc32"] for r in out)
    assert sum(len(r["ids"]) for r in out) == sum({r["doc_id"]: r["doc_tokens"] for r in out}.values())
    model = Tokenizer.from_file(packing.default_tokenizer())
    ids = [i for r in sorted(out, key=lambda r: r["start"]) if r["doc_id"] == 1 for i in r["ids"]]
    assert ids == [*model.encode(prose(5, 300), add_special_tokens=False).ids, packing.CLOSE]


def test_a_passage_lies_whole_in_a_window():
    """17 words at every offset of texts of several lengths."""
    for n in (17, 31, 32, 33, 48, 49, 100, 161):
        place, _ = toxicity.windows_of(np.array([0, n]))
        held = [{*row[row >= 0].tolist()} for row in place]
        assert all(any({*range(p, p + 17)} <= h for h in held) for p in range(n - 16))
        assert len(set().union(*held)) == n
