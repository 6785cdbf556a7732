"""Licence scan with a positional index of rare tokens.

Every licence template is a list of words.  Word frequencies come from all
documents; a template is indexed by its rarest words (highest inverse document
frequency) with their positions.  The index is one list of postings, word to
template and position.  Each word of a file is looked up in it once; postings
vote for the alignment ``place in file - place in template``.  Alignments that
gather enough distinct words are compared word by word, those of all templates
together, and a label is given if the template's mandatory key phrase stands
there in full.  The work depends on the words of the files and the postings
they hit, not on the number of templates.

A phrase (the base labels) is a template whose key phrase is all of it: its
rarest word finds every occurrence, the other words verify it.

Null and empty texts have no words, no places and no labels, and score 0.
Repeated rows get a result each; further columns are ignored; an empty table
gives an empty result.
"""

from __future__ import annotations

import re
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from roadpulse.llm.textbytes import Tokeniser, slices
from roadpulse.llm.work import map_batches, texts


@dataclass(frozen=True)
class Template:
    """``words`` of the licence sentence and the phrase that must be in it."""

    label: str
    words: tuple[str, ...]
    key: tuple[str, ...]


def template(label: str, sentence: str, key: str) -> Template:
    return Template(label, plain_words(sentence), plain_words(key))


def plain_words(text: str) -> tuple[str, ...]:
    return tuple(re.findall(r"[a-z0-9]+", text.lower()))


BASE_PHRASES = (
    template("cc-by", "cc by", "cc by"),
    template("gpl", "general public license", "general public license"),
    template("reserved", "all rights reserved", "all rights reserved"),
)
# Texts of short licences, without the lines that name the holders.
MIT = """Permission is hereby granted, free of charge, to any person obtaining a copy of this software and
associated documentation files (the "Software"), to deal in the Software without restriction, including without
limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the
Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions:
The above copyright notice and this permission notice shall be included in all copies or substantial portions of
the Software. THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT
LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT
SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF
CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN
THE SOFTWARE."""
ISC = """Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is
hereby granted, provided that the above copyright notice and this permission notice appear in all copies. THE
SOFTWARE IS PROVIDED "AS IS" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL
IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT,
INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS, WHETHER IN
AN ACTION OF CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH THE USE OR
PERFORMANCE OF THIS SOFTWARE."""
BSD_2 = """Redistribution and use in source and binary forms, with or without modification, are permitted provided
that the following conditions are met: 1. Redistributions of source code must retain the above copyright notice,
this list of conditions and the following disclaimer. 2. Redistributions in binary form must reproduce the above
copyright notice, this list of conditions and the following disclaimer in the documentation and/or other materials
provided with the distribution. THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS "AS IS" AND ANY
EXPRESS OR IMPLIED WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS
FOR A PARTICULAR PURPOSE ARE DISCLAIMED."""
APACHE_NOTICE = """Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except
in compliance with the License. You may obtain a copy of the License at
http://www.apache.org/licenses/LICENSE-2.0"""
UNLICENSE = """This is free and unencumbered software released into the public domain. Anyone is free to copy,
modify, publish, use, compile, sell, or distribute this software, either in source code form or as a compiled
binary, for any purpose, commercial or non-commercial, and by any means."""

# Notices as projects write them in file headers.
TEMPLATES = (
    template("apache-2.0", "licensed under the apache license version 2 0", "apache license"),
    template("bsd", "redistribution and use in source and binary forms with or without modification are permitted", "source and binary forms"),
    template("cc-by-nc", "licensed under cc by nc 4 0", "cc by nc"),
    template("cc-by-sa", "licensed under cc by sa 4 0", "cc by sa"),
    template("gpl-3.0", "this work is licensed under the gnu general public license version 3", "gnu general public license version 3"),
    template("lgpl", "under the terms of the gnu lesser general public license", "lesser general public license"),
    template("mit", "released under the mit license", "mit license"),
    template("mit", "permission is hereby granted free of charge to any person obtaining a copy", "permission is hereby granted free of charge"),
    template("apache-2.0", APACHE_NOTICE, "licensed under the apache license version 2 0"),
    template("bsd-2-clause", BSD_2, "redistribution and use in source and binary forms"),
    template("isc", ISC, "permission to use copy modify and or distribute this software"),
    template("mit", MIT, "permission is hereby granted free of charge"),
    template("unlicense", UNLICENSE, "free and unencumbered software"),
    template("mpl-2.0", "subject to the terms of the mozilla public license", "mozilla public license"),
)
RARE = 4
COVER = 0.6
# words compared in one pass over alignments
COMPARED = 1 << 20


def hash_words(words) -> np.ndarray:
    """Hashes of single words, in order."""
    data = [w.encode() for w in words]
    offsets = np.cumsum([0] + [len(w) for w in data])
    found = Tokeniser("alnum", True).words(np.frombuffer(b"".join(data), dtype=np.uint8), offsets)
    if len(found) != len(data):
        raise ValueError(f"not single words: {words}")
    return found.hashes


def document_frequencies(docs: DataFrame, vocabulary: list[str]) -> tuple[int, dict[str, int]]:
    """Documents in all, and how many hold each word of the vocabulary.  Each
    task counts its documents first; the result has a row per word."""
    known = hash_words(vocabulary)

    def make():
        tokeniser, order = Tokeniser("alnum", True), np.argsort(known)
        sorted_known = known[order]

        def step(batch: pa.RecordBatch):
            counts = np.zeros(len(known) + 1, dtype=np.int64)
            counts[-1] = batch.num_rows
            for low, high, data, offsets in slices(batch.column("text")):
                words = tokeniser.words(data, offsets)
                at = np.minimum(np.searchsorted(sorted_known, words.hashes), len(known) - 1)
                hit = np.flatnonzero(sorted_known[at] == words.hashes)
                pairs = np.unique(words.doc_of()[hit] * len(known) + order[at[hit]])
                counts[:-1] += np.bincount(pairs % len(known), minlength=len(known))
            yield {"word": np.arange(len(counts)), "n": counts}

        return step

    rows = map_batches(docs.select("text"), make, "word long, n long").groupBy("word").agg(F.sum("n").alias("n")).collect()
    found = {r["word"]: r["n"] for r in rows}
    return found.get(len(vocabulary), 0), {w: found.get(i, 0) for i, w in enumerate(vocabulary)}


@dataclass(frozen=True)
class Index:
    """Postings sorted by word, and the templates' words one after the other.

    ``posting_word`` has each indexed word once; its postings are
    ``first_posting[i] .. first_posting[i + 1]`` of ``template`` and ``position``."""

    labels: list[str]
    phrase: np.ndarray
    needed: np.ndarray
    first_word: np.ndarray
    words: np.ndarray
    weights: np.ndarray
    in_key: np.ndarray
    posting_word: np.ndarray
    first_posting: np.ndarray
    template: np.ndarray
    position: np.ndarray

    @classmethod
    def of(cls, phrases, templates, idf: dict[str, float], code: dict[str, int], rare: int) -> Index:
        """A phrase is indexed by its rarest word, a template by its ``rare`` rarest."""
        both = (*phrases, *templates)
        postings, in_key, needed = [], [], []
        for number, t in enumerate(both):
            most = 1 if number < len(phrases) else rare
            order = sorted(range(len(t.words)), key=lambda i: (-idf[t.words[i]], i))[:most]
            postings += [(code[t.words[i]], number, i) for i in order]
            needed.append(min(2, len(order)) if number >= len(phrases) else 1)
            key = next(i for i in range(len(t.words)) if t.words[i : i + len(t.key)] == t.key)
            in_key += [key <= i < key + len(t.key) for i in range(len(t.words))]
        postings.sort()
        word, number, position = (np.array(x, dtype=t) for x, t in zip(zip(*postings), (np.uint64, np.int64, np.int64)))
        unique, first = np.unique(word, return_index=True)
        return cls(
            labels=[t.label for t in both],
            phrase=np.arange(len(both)) < len(phrases),
            needed=np.array(needed),
            first_word=np.cumsum([0] + [len(t.words) for t in both]),
            words=np.array([code[w] for t in both for w in t.words], dtype=np.uint64),
            weights=np.array([idf[w] for t in both for w in t.words]),
            in_key=np.array(in_key),
            posting_word=unique,
            first_posting=np.append(first, len(postings)),
            template=number,
            position=position,
        )

    def alignments(self, words, of: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Document, template and start of every alignment with enough votes."""
        at = np.minimum(np.searchsorted(self.posting_word, words.hashes), len(self.posting_word) - 1)
        hit = np.flatnonzero(self.posting_word[at] == words.hashes)
        low, number = self.first_posting[at[hit]], np.diff(self.first_posting)[at[hit]]
        place = np.repeat(hit, number)
        posting = np.repeat(low - np.cumsum(number) + number, number) + np.arange(number.sum())
        votes = np.stack([of[place], self.template[posting], place - self.position[posting]])
        found, count = np.unique(votes, axis=1, return_counts=True)
        doc, template, start = found[:, count >= self.needed[found[1]]]
        return doc, template, start

    def compared(self, words, doc: np.ndarray, template: np.ndarray, start: np.ndarray):
        """For each alignment: is the key phrase there, how many words stand at
        their place, and what share of the weight they have."""
        size = np.diff(self.first_word)[template]
        key, equal, share = np.zeros(len(doc), bool), np.zeros(len(doc), np.int64), np.zeros(len(doc))
        ends = np.cumsum(size)
        low = 0
        while low < len(doc):
            before = ends[low] - size[low]
            high = max(low + 1, int(np.searchsorted(ends, before + COMPARED, side="right")))
            n = size[low:high]
            head = np.cumsum(n) - n
            shift = np.arange(n.sum()) - np.repeat(head, n)
            word = np.repeat(self.first_word[template[low:high]], n) + shift
            spot, text = np.repeat(start[low:high], n) + shift, np.repeat(doc[low:high], n)
            same = (spot >= words.first[text]) & (spot < words.first[text + 1])
            same &= words.hashes[np.where(same, spot, 0)] == self.words[word]
            weight = self.weights[word]
            key[low:high] = np.logical_and.reduceat(same | ~self.in_key[word], head)
            equal[low:high] = np.add.reduceat(same.astype(np.int64), head)
            share[low:high] = np.add.reduceat(weight * same, head) / np.add.reduceat(weight, head)
            low = high
        return key, equal, share


def scan(
    docs: DataFrame,
    phrases: tuple[Template, ...] = BASE_PHRASES,
    templates: tuple[Template, ...] = TEMPLATES,
    rare: int = RARE,
    cover: float = COVER,
) -> DataFrame:
    """One row per document: ``doc_id, n_words, n_base, first_word, last_word,
    base_labels, labels`` (arrays, distinct and sorted), ``matches`` (label,
    first word, words compared equal) and ``score``.

    ``score`` is the largest IDF-weighted share of a template's words that
    stand at their place; a base phrase that occurs gives 1.
    """
    docs = texts(docs)
    vocabulary = sorted({w for t in (*phrases, *templates) for w in t.words})
    total, frequency = document_frequencies(docs, vocabulary)
    idf = {w: float(np.log((1 + total) / (1 + n)) + 1) for w, n in frequency.items()}
    code = dict(zip(vocabulary, hash_words(vocabulary).tolist()))
    index = Index.of(phrases, templates, idf, code, rare)

    def make():
        tokeniser = Tokeniser("alnum", True)

        def step(batch: pa.RecordBatch):
            for low, high, data, offsets in slices(batch.column("text")):
                words = tokeniser.words(data, offsets)
                n = high - low
                doc, template, start = index.alignments(words, words.doc_of())
                key, equal, share = index.compared(words, doc, template, start)
                good = key & (share >= cover)
                doc, template, start, equal, share = (x[good] for x in (doc, template, start, equal, share))
                at = start - words.first[doc]
                base = index.phrase[template]
                first, last, score = np.full(n, np.iinfo(np.int64).max), np.full(n, -1), np.zeros(n)
                n_base = np.bincount(doc[base], minlength=n)
                np.minimum.at(first, doc[base], at[base])
                np.maximum.at(last, doc[base], at[base])
                np.maximum.at(score, doc, np.where(base, 1.0, share))
                base_labels, labels, matches = [set() for _ in range(n)], [set() for _ in range(n)], [[] for _ in range(n)]
                for d, t, a, e in zip(doc.tolist(), template.tolist(), at.tolist(), equal.tolist()):
                    label = index.labels[t]
                    labels[d].add(label)
                    matches[d].append((label, max(0, a), e))
                    if index.phrase[t]:
                        base_labels[d].add(label)
                none = n_base == 0
                yield {
                    "doc_id": batch.column("doc_id").slice(low, n),
                    "n_words": np.diff(words.first),
                    "n_base": n_base,
                    "first_word": pa.array(first, mask=none),
                    "last_word": pa.array(last, mask=none),
                    "base_labels": [sorted(x) for x in base_labels],
                    "labels": [sorted(x) for x in labels],
                    "matches": [[{"label": a, "word": b, "equal": c} for a, b, c in sorted(m)] for m in matches],
                    "score": np.minimum(score, 1.0),
                }

        return step

    return map_batches(
        docs,
        make,
        "doc_id long, n_words long, n_base long, first_word long, last_word long, base_labels array<string>, "
        "labels array<string>, matches array<struct<label string, word long, equal long>>, score double",
    )


def op8_license_scan(spark, sf_dir: str) -> DataFrame:
    found = scan(spark.read.parquet(f"{sf_dir}/documents.parquet"))
    return found.select(
        "doc_id", "n_words", "n_base", "first_word", "last_word",
        F.concat_ws(",", "base_labels").alias("base_labels"),
        F.concat_ws(",", "labels").alias("labels"),
        "score",
    )
