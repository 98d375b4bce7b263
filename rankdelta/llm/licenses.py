"""License scan: which licence notices stand in a document, and where.

A template is a notice, its words numbered, with mandatory key phrases.  The
index is positional and holds rare tokens: for each key phrase its word of
highest IDF, counted over all documents, with the place of that word in the
template.  A file looks its own occurrences of those words up; a posting
turns each into a relative position (file minus template), at which the whole
phrase is verified word by word.  A template matches where all of its key
phrases stand at about the same relative position; the IDF-weighted share of
its words that stand there is the score of the match.

Every key phrase is necessary and each has a word in the index, so no match is
lost however many licence words a file has.  Templates are parameters, a few
hundred words in all; documents are read twice and never shuffled.
"""

from __future__ import annotations

import math
from collections.abc import Sequence
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rankdelta.llm.common import slices, utf8
from rankdelta.llm.wordscan import plain_words

SLACK = 8  # words by which relative positions inside one notice may differ
MIN_SHARE = 0.6  # weight of the template's words that has to stand there


@dataclass(frozen=True)
class Template:
    """A notice; ``phrases`` are word runs of it that have to stand in a file (the first fixes the position).

    A ``base`` template is one phrase, and every place where it stands counts.
    """

    label: str
    text: str
    phrases: tuple[str, ...] = ()
    base: bool = False
    words: tuple[str, ...] = field(init=False)
    spans: tuple[tuple[int, int], ...] = field(init=False)  # (start, length) of each phrase

    def __post_init__(self):
        words = tuple(self.text.split())
        spans = []
        for phrase in self.phrases or (self.text,):
            want = tuple(phrase.split())
            spans.append((next(i for i in range(len(words)) if words[i:i + len(want)] == want), len(want)))
        object.__setattr__(self, "words", words)
        object.__setattr__(self, "spans", tuple(spans))


# Phrases and labels that every scan reports.
BASE = (
    Template("mit", "under the mit license", base=True),
    Template("apache-2", "apache license version 2", base=True),
    Template("cc-by-nc", "cc by nc", base=True),
)

# Notices as their licences word them, lower-cased, without punctuation.
NOTICES = (
    Template("mit", "permission is hereby granted free of charge to any person obtaining a copy of this software and "
             "associated documentation files the software to deal in the software without restriction",
             ("permission is hereby granted free of charge", "without restriction")),
    Template("apache-2", "licensed under the apache license version 2 0 the license you may not use this file except in "
             "compliance with the license", ("apache license version 2 0", "except in compliance with the license")),
    Template("gpl-2", "licensed under the gnu general public license version 2", ("gnu general public license", "version 2")),
    Template("gpl-3", "licensed under the gnu general public license version 3", ("gnu general public license", "version 3")),
    Template("lgpl-3", "licensed under the gnu lesser general public license version 3",
             ("gnu lesser general public license", "version 3")),
    Template("agpl-3", "licensed under the gnu affero general public license version 3",
             ("gnu affero general public license", "version 3")),
    Template("mpl-2", "this source code form is subject to the terms of the mozilla public license v 2 0",
             ("mozilla public license", "2 0")),
    Template("bsd", "redistribution and use in source and binary forms with or without modification are permitted",
             ("redistribution and use in source and binary forms",)),
    Template("isc", "permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted",
             ("permission to use copy modify", "with or without fee")),
    Template("cc-by", "licensed under cc by 4 0", ("cc by 4 0",)),
    Template("cc-by-sa", "licensed under cc by sa 4 0", ("cc by sa",)),
    Template("cc0", "released under cc0 1 0 universal", ("cc0 1 0",)),
    Template("unlicense", "this is free and unencumbered software released into the public domain",
             ("free and unencumbered software",)),
)


def _vocabulary(templates: Sequence[Template]) -> dict[bytes, int]:
    return {w.encode(): i for i, w in enumerate(sorted({w for t in templates for w in t.words}))}


def word_weights(docs: DataFrame, templates: Sequence[Template]) -> np.ndarray:
    """IDF of every template word over all rows of ``docs``, in thousandths: floor(1000 * ln((2N+2) / (2df+1))), 1 at least."""
    vocab = _vocabulary(templates)

    def run(batches):
        scan, df, rows = plain_words(), [0] * len(vocab), 0
        for b in slices(batches, "_text"):
            for text in b.column("_text").to_pylist():
                rows += 1
                for w in set().union(*(vocab.keys() & set(ws) for ws in scan.pieces(text))):
                    df[vocab[w]] += 1
        yield pa.RecordBatch.from_arrays([pa.array(range(-1, len(df)), pa.int32()), pa.array([rows, *df], pa.int64())], ["word", "n"])

    counts = docs.select(utf8(F.col("text")).alias("_text")).mapInArrow(run, "word int, n long")
    n = {r["word"]: r["n"] for r in counts.groupBy("word").agg(F.sum("n").alias("n")).collect()}  # a row per template word
    rows = n.get(-1, 0)
    return np.array([max(1, math.floor(1000 * math.log((2 * rows + 2) / (2 * n.get(i, 0) + 1)))) for i in range(len(vocab))], np.int64)


class Index:
    """Postings of the rare tokens: word -> (template, phrase, place of the word in the phrase)."""

    def __init__(self, templates: Sequence[Template], weights: np.ndarray, slack: int = SLACK, min_share: float = MIN_SHARE):
        self.templates, self.weights, self.slack, self.min_share = templates, weights, slack, min_share
        self.vocab = _vocabulary(templates)
        self.ids = [np.array([self.vocab[w.encode()] for w in t.words], np.int16) for t in templates]
        self.postings: dict[int, list[tuple[int, int, int]]] = {}
        for t, ids in enumerate(self.ids):
            for k, (start, length) in enumerate(templates[t].spans):
                at = int(np.argmax(weights[ids[start:start + length]]))  # the first of those with the highest IDF
                self.postings.setdefault(int(ids[start + at]), []).append((t, k, at))
        self.rare = np.zeros(len(self.vocab) + 1, bool)  # the last entry stands for all other words (-1)
        self.rare[list(self.postings)] = True

    def _places(self, ids: np.ndarray) -> dict[tuple[int, int], np.ndarray]:
        """(template, phrase) -> sorted starts of the phrase in the file."""
        spots = np.flatnonzero(self.rare[ids])
        out = {}
        for word in np.unique(ids[spots]).tolist():
            at_word = spots[ids[spots] == word]
            for t, k, at in self.postings[word]:
                start, length = self.templates[t].spans[k]
                s = at_word - at
                s = s[(s >= 0) & (s + length <= len(ids))]
                for j in range(length):
                    s = s[ids[s + j] == self.ids[t][start + j]]
                if len(s):
                    out[t, k] = s
        return out

    def _shares(self, ids: np.ndarray, t: int, diagonals: np.ndarray) -> np.ndarray:
        """Weight of the template's words that stand near their place, for every relative position."""
        want, weight = self.ids[t], self.weights[self.ids[t]]
        got = np.zeros(len(diagonals), np.int64)
        for j in range(len(want)):
            seen = np.zeros(len(diagonals), bool)
            for off in range(-self.slack, self.slack + 1):
                p = diagonals + j + off
                inside = (p >= 0) & (p < len(ids))
                seen |= inside & (ids[np.where(inside, p, 0)] == want[j])
            got += np.where(seen, weight[j], 0)
        return got / int(weight.sum())

    def matches(self, ids: np.ndarray) -> list[tuple[str, int, int, float, bool]]:
        """(label, start, end, share, base) of every notice in a file given as word numbers (-1: no licence word)."""
        out, places = [], self._places(ids)
        for t in sorted({t for t, _ in places}):
            template, first = self.templates[t], places.get((t, 0))
            if template.base:
                out += [(template.label, s, s + len(template.words), 1.0, True) for s in first.tolist()]
                continue
            if any((t, k) not in places for k in range(len(template.spans))):
                continue
            d = first - template.spans[0][0]
            for k in range(1, len(template.spans)):
                there = places[t, k] - template.spans[k][0]
                after = np.searchsorted(there, d - self.slack)
                d = d[(after < len(there)) & (there[np.minimum(after, len(there) - 1)] <= d + self.slack)]
            share = self._shares(ids, t, d)
            keep = share >= self.min_share
            out += [(template.label, max(0, s), min(len(ids), s + len(template.words)), x, False)
                    for s, x in zip(d[keep].tolist(), share[keep].tolist(), strict=True)]
        return out


MATCH = pa.struct([("label", pa.string()), ("start", pa.int64()), ("end", pa.int64()), ("share", pa.float64()), ("base", pa.bool_())])


def _scan(index: Index):
    def run(batches):
        scan, get = plain_words(), index.vocab.get
        for b in slices(batches, "_text"):
            n_words, found = [], []
            for text in b.column("_text").to_pylist():
                ids = np.concatenate([np.fromiter((get(w, -1) for w in ws), np.int16, len(ws)) for ws in scan.pieces(text)])
                n_words.append(len(ids))
                found.append([dict(zip(("label", "start", "end", "share", "base"), m, strict=True)) for m in index.matches(ids)])
            yield pa.RecordBatch.from_arrays([b.column("doc_id"), pa.array(n_words, pa.int64()), pa.array(found, pa.list_(MATCH))],
                                             ["doc_id", "n_words", "matches"])
    return run


def find_licenses(docs: DataFrame, notices: Sequence[Template] = NOTICES, base: Sequence[Template] = BASE, *,
                  slack: int = SLACK, min_share: float = MIN_SHARE) -> DataFrame:
    """(doc_id, n_words, matches): one row per row of ``docs``.

    Words are ``[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+`` of the whole text with A-Z
    lower-cased.  ``matches`` holds (label, start, end, share, base) with word
    positions from 0: every place of a base phrase (share 1), and every place of
    a notice whose key phrases stand within ``slack`` words of one relative
    position and whose words there have at least ``min_share`` of its weight.

    A null or empty text has no words and no match; repeated rows are treated
    alike (each counts for the IDF); a null doc_id stays null; an empty table
    gives no rows.  Other columns are not read.
    """
    templates = (*base, *notices)
    index = Index(templates, word_weights(docs, templates), slack, min_share)
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), utf8(F.col("text")).alias("_text"))
    return rows.mapInArrow(_scan(index), "doc_id long, n_words long, "
                           "matches array<struct<label: string, start: long, end: long, share: double, base: boolean>>")


def summary(found: DataFrame) -> DataFrame:
    """One row per row of ``find_licenses``: counts, first and last place of base phrases, labels, best share.

    Without a match: n_base 0, first_word and last_word null, empty labels, score 0.
    """
    base = F.filter("matches", lambda m: m["base"])

    def labels(ms):
        return F.array_join(F.array_sort(F.array_distinct(F.transform(ms, lambda m: m["label"]))), ",")
    return found.select(
        "doc_id", "n_words", F.size(base).cast("long").alias("n_base"),
        F.array_min(F.transform(base, lambda m: m["start"])).alias("first_word"),
        F.array_max(F.transform(base, lambda m: m["start"])).alias("last_word"),
        labels(base).alias("base_labels"), labels(F.col("matches")).alias("labels"),
        F.coalesce(F.array_max(F.transform("matches", lambda m: m["share"])), F.lit(0.0)).alias("score"))
