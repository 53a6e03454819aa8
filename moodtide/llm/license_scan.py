"""Licence scan: positional rare-token index over licence templates, verified by key phrases."""

from __future__ import annotations

import math
from bisect import bisect_left
from collections import Counter, defaultdict
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from moodtide.llm.common import ALNUM_WORDS, Words, pieces

# Phrases whose every place is counted, and their labels.
BASE_PHRASES = {
    "cc by": "cc-by",
    "general public license": "gpl",
    "all rights reserved": "reserved",
}


@dataclass(frozen=True)
class Template:
    label: str
    text: str
    keys: tuple[str, ...]  # phrases that must stand in the aligned stretch


TEMPLATES = (
    Template("apache-2.0", "Licensed under the Apache License, Version 2.0", ("apache license version 2 0",)),
    Template("mit", "Released under the MIT License", ("mit license",)),
    Template(
        "mit",
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software",
        ("permission is hereby granted", "free of charge"),
    ),
    Template("gpl-3.0", "Licensed under the GNU GPL version 3.0", ("gnu gpl version 3",)),
    Template("gpl-2.0", "Licensed under the GNU GPL version 2.0", ("gnu gpl version 2",)),
    Template(
        "gpl",
        "under the terms of the GNU General Public License as published by the Free Software Foundation",
        ("gnu general public license",),
    ),
    Template("lgpl", "under the terms of the GNU Lesser General Public License", ("gnu lesser general public license",)),
    Template("agpl", "under the terms of the GNU Affero General Public License", ("gnu affero general public license",)),
    Template(
        "bsd",
        "Redistribution and use in source and binary forms, with or without modification, are permitted",
        ("redistribution and use in source and binary forms",),
    ),
    Template("bsd", "Licensed under the BSD License", ("bsd license",)),
    Template("mpl-2.0", "subject to the terms of the Mozilla Public License, v. 2.0", ("mozilla public license",)),
    Template("cc-by-4.0", "Licensed under CC BY 4.0", ("cc by 4 0",)),
    Template("cc-by-sa", "Licensed under CC BY-SA 4.0", ("cc by sa",)),
    Template("cc-by-nc", "Licensed under CC BY-NC 4.0", ("cc by nc",)),
    Template(
        "cc-by",
        "This work is licensed under a Creative Commons Attribution 4.0 International License",
        ("creative commons attribution",),
    ),
    Template("cc0", "CC0 1.0 Universal Public Domain Dedication", ("cc0 1 0",)),
    Template("unlicense", "This is free and unencumbered software released into the public domain", ("free and unencumbered software",)),
)

SCHEMA = (
    "{id}, n_words long, n_base long, first_word long, last_word long, "
    "base_labels string, labels string, score double"
)


def _split(text: str) -> list[bytes]:
    return text.encode().translate(ALNUM_WORDS).split()


class Index:
    """word -> positions in each template, with the weight of each word."""

    def __init__(self, templates, phrases: dict[str, str]):
        self.templates = templates
        self.words = [_split(t.text) for t in templates]
        self.keys = [[_split(k) for k in t.keys] for t in templates]
        self.phrases = [(_split(p), label) for p, label in phrases.items()]
        self.postings: dict[bytes, list[tuple[int, int]]] = defaultdict(list)
        for t, words in enumerate(self.words):
            for i, w in enumerate(words):
                self.postings[w].append((t, i))
        in_keys = {w for ks in self.keys for k in ks for w in k}
        self.vocabulary = sorted({*self.postings, *in_keys, *(w for p, _ in self.phrases for w in p)})
        self.number = {w: i for i, w in enumerate(self.vocabulary)}
        self.needed = [sorted({self.number[w] for k in ks for w in k}) for ks in self.keys]

    def places(self, words: Words) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(text, position in it, vocabulary number) of every licence word."""
        known = np.fromiter((self.number.get(w, -1) for w in words.dictionary), np.int64, len(words.dictionary))
        number = known[words.codes] if len(words.codes) else np.zeros(0, np.int64)
        at = np.flatnonzero(number >= 0)
        text = np.searchsorted(words.starts, at, side="right") - 1
        return text, at - words.starts[text], number[at]


def _present(text: np.ndarray, number: np.ndarray, n_texts: int, n_words: int) -> np.ndarray:
    seen = np.zeros((n_texts, n_words), bool)
    seen[text, number] = True
    return seen


def document_counts(docs: DataFrame, index: Index, text: str = "text") -> tuple[int, dict[bytes, int]]:
    """Number of texts, and of texts holding each template word (a few hundred words at most)."""

    def count(batches):
        total, found = 0, np.zeros(len(index.vocabulary), np.int64)
        for batch in pieces(batches, text):
            words = Words(batch.column(text), ALNUM_WORDS)
            where, _, number = index.places(words)
            found += _present(where, number, batch.num_rows, len(found)).sum(axis=0)
            total += batch.num_rows
        yield pa.RecordBatch.from_pydict({"word": [-1, *range(len(found))], "n": [total, *found.tolist()]})

    rows = docs.select(text).mapInArrow(count, "word long, n long").groupBy("word").agg(F.sum("n").alias("n")).collect()
    by = {r["word"]: r["n"] for r in rows}
    return by.get(-1, 0), {w: by.get(i, 0) for i, w in enumerate(index.vocabulary)}


def _runs(pos: list[int], number: list[int], phrase: list[int]) -> list[int]:
    """Starts of places where the phrase stands word by word."""
    at = dict(zip(pos, number, strict=True))
    return [p for p in pos if all(at.get(p + i) == w for i, w in enumerate(phrase))]


def _align(index: Index, idf: list[float], pos, number, candidates, rare: int, slack: int, least: float):
    """{label: share} of the templates that stand in one text."""
    places: dict[int, list[int]] = defaultdict(list)
    for p, w in zip(pos, number, strict=True):
        places[w].append(p)
    found: dict[str, float] = {}
    for t in candidates:
        words = [index.number[w] for w in index.words[t]]
        whole = sum(idf[w] for w in words) or 1.0
        keys = [[index.number[w] for w in k] for k in index.keys[t]]
        stands = [_runs(pos, number, k) for k in keys]
        if not all(stands):
            continue
        times = Counter(w for w in words if w in places)
        rest = sum(idf[w] * n for w, n in times.items())
        buckets: set[int] = set()
        for k, w in enumerate(sorted(times, key=lambda w: (-idf[w], w))):
            if k >= rare and rest < least * whole - 1e-6:
                break  # the other words alone are not enough
            rest -= idf[w] * times[w]
            for u, i in index.postings[index.vocabulary[w]]:
                if u == t:
                    buckets.update((p - i) // (slack + 1) for p in places[w])
        sets = {w: set(places.get(w, ())) for w in words}
        best = 0.0
        for b in buckets:
            lo, hi = b * (slack + 1) - slack, b * (slack + 1) + 2 * slack
            near = (ss[(j := bisect_left(ss, lo)) : j + 1] for ss in stands)
            if all(s and s[0] <= hi + len(words) for s in near):
                got = sum(idf[w] for i, w in enumerate(words) if any(s + i in sets[w] for s in range(lo, hi + 1)))
                best = max(best, got / whole)
        if best >= least:
            label = index.templates[t].label
            found[label] = max(found.get(label, 0.0), min(1.0, best))
    return found


def scan(
    docs: DataFrame,
    templates=TEMPLATES,
    phrases: dict[str, str] = BASE_PHRASES,
    doc_id: str = "doc_id",
    text: str = "text",
    rare: int = 12,
    slack: int = 2,
    least: float = 0.6,
) -> DataFrame:
    """Licence labels of every text.

    Each template whose key phrases stand is looked up by its own highest-IDF words in the text: ``rare``
    of them, and more until the others cannot make up ``least``. Places that agree on where a template
    starts, within ``slack`` words, are aligned; a template stands if all its key phrases do and
    ``least`` of its IDF weight is aligned. IDF comes from all texts.
    ``score`` is the largest aligned share, 1 where a base phrase stands, else 0.

    Null and empty texts have no words and no labels; repeated rows give repeated results; ties in
    IDF go by word; other columns are ignored.
    """
    index = Index(templates, phrases)
    n, seen = document_counts(docs, index, text)
    idf = [math.log((1 + n) / (1 + seen[w])) + 1e-9 for w in index.vocabulary]
    kind = docs.schema[doc_id].dataType.simpleString()

    def label(batches):
        for batch in pieces(batches, text):
            words = Words(batch.column(text), ALNUM_WORDS)
            where, pos, number = index.places(words)
            rows = batch.num_rows
            has = _present(where, number, rows, len(index.vocabulary))
            cut = np.searchsorted(where, np.arange(rows + 1))
            base: list[dict[str, list[int]]] = [defaultdict(list) for _ in range(rows)]
            for phrase, name in index.phrases:
                ids = [index.number[w] for w in phrase]
                for r in np.flatnonzero(has[:, ids].all(axis=1)):
                    a, b = cut[r], cut[r + 1]
                    if starts := _runs(pos[a:b].tolist(), number[a:b].tolist(), ids):
                        base[r][name] += starts
            extra: list[dict[str, float]] = [{} for _ in range(rows)]
            ready: dict[int, set[int]] = defaultdict(set)
            for t, need in enumerate(index.needed):
                for r in np.flatnonzero(has[:, need].all(axis=1)):
                    ready[int(r)].add(t)
            for r, candidates in ready.items():
                a, b = cut[r], cut[r + 1]
                extra[r] = _align(index, idf, pos[a:b].tolist(), number[a:b].tolist(), candidates, rare, slack, least)
            starts = [[s for ss in b.values() for s in ss] for b in base]
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(doc_id),
                    pa.array(words.counts, pa.int64()),
                    pa.array([len(s) for s in starts], pa.int64()),
                    pa.array([min(s) if s else None for s in starts], pa.int64()),
                    pa.array([max(s) if s else None for s in starts], pa.int64()),
                    pa.array([",".join(sorted(b)) for b in base]),
                    pa.array([",".join(sorted({*b, *e})) for b, e in zip(base, extra, strict=True)]),
                    pa.array([1.0 if b else max(e.values(), default=0.0) for b, e in zip(base, extra, strict=True)], pa.float64()),
                ],
                names=[doc_id, "n_words", "n_base", "first_word", "last_word", "base_labels", "labels", "score"],
            )

    return docs.select(doc_id, text).mapInArrow(label, SCHEMA.format(id=f"`{doc_id}` {kind}"))
