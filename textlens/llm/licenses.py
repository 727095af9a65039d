"""License scan: generalised suffix automaton of licence tokens (operator 10).

One automaton holds the tokens of every template.  Each text is streamed
through it: after each word the automaton knows the longest run of words that
ends there and occurs in some template (the matching statistics).  Long
matches of one template that follow each other in text and template are
chained into covered spans.

The templates are a parameter of bounded size, never data from the corpus;
texts are handled whole, each in one task, and nothing is shuffled.

Defined results: a null or empty text has no words, no spans and score 0;
equal rows give equal results; an empty table gives an empty result; other
columns are left out of the result except the id, which may be null.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from textlens.llm import tokens as T

# Public licence wording.
TEMPLATES = {
    "mit": (
        "Released under the MIT License.",
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated "
        "documentation files, to deal in the Software without restriction, including without limitation the rights to "
        "use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software"),
    "apache": (
        "Licensed under the Apache License, Version 2.0.",
        "you may not use this file except in compliance with the License. You may obtain a copy of the License at "
        "http://www.apache.org/licenses/LICENSE-2.0"),
    "gpl": (
        "This work is licensed under the GNU General Public License, version 3.",
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General "
        "Public License as published by the Free Software Foundation, either version 3 of the License, or any later "
        "version"),
    "lgpl": ("under the terms of the GNU Lesser General Public License",),
    "mpl": ("This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0.",),
    "bsd": (
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided that "
        "the following conditions are met",),
    "cc-by-nc": ("Licensed under CC BY-NC 4.0.", "Creative Commons Attribution NonCommercial 4.0 International License"),
    "cc-by": ("Licensed under CC BY 4.0.", "Creative Commons Attribution 4.0 International License"),
    "cc-by-sa": ("Licensed under CC BY-SA 4.0.", "Creative Commons Attribution ShareAlike 4.0 International License"),
}
# The phrases of the base labels.
PHRASES = {"mit license": "mit", "apache license": "apache", "general public license": "gpl"}

_WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
_LOWER = {i: i + 32 for i in range(65, 91)}


def words(text: str) -> list[str]:
    return _WORD.findall(text.translate(_LOWER))


@dataclass
class _State:
    length: int = 0
    link: int = -1
    go: dict[int, int] = field(default_factory=dict)
    #: template -> where a run of this state ends in it
    ends: dict[int, int] = field(default_factory=dict)


class Automaton:
    """Generalised suffix automaton over token ids."""

    def __init__(self, sequences: list[list[int]]):
        self.states = [_State()]
        self.lengths = [len(s) for s in sequences]
        for t, seq in enumerate(sequences):
            last = 0
            for i, x in enumerate(seq):
                last = self._extend(last, x)
                self.states[last].ends.setdefault(t, i + 1)
        for s in sorted(self.states, key=lambda s: -s.length):
            if s.link >= 0:
                for t, e in s.ends.items():
                    self.states[s.link].ends.setdefault(t, e)

    def _copy(self, p: int, q: int, x: int) -> int:
        st = self.states
        st.append(_State(st[p].length + 1, st[q].link, dict(st[q].go)))
        new = len(st) - 1
        st[q].link = new
        while p >= 0 and st[p].go.get(x) == q:
            st[p].go[x] = new
            p = st[p].link
        return new

    def _extend(self, last: int, x: int) -> int:
        st = self.states
        q = st[last].go.get(x)
        if q is not None:
            return q if st[q].length == st[last].length + 1 else self._copy(last, q, x)
        st.append(_State(st[last].length + 1))
        new, p = len(st) - 1, last
        while p >= 0 and x not in st[p].go:
            st[p].go[x] = new
            p = st[p].link
        if p < 0:
            st[new].link = 0
        else:
            q = st[p].go[x]
            st[new].link = q if st[q].length == st[p].length + 1 else self._copy(p, q, x)
        return new

    def statistics(self, tokens: list[int]) -> Iterator[tuple[int, int]]:
        """(state, length of the longest match that ends there) after each token."""
        s = n = 0
        st = self.states
        for x in tokens:
            while s and x not in st[s].go:
                s = st[s].link
                n = st[s].length
            if x in st[s].go:
                s, n = st[s].go[x], n + 1
            yield s, n

    def matches(self, tokens: list[int], least: int) -> list[tuple[int, int, int, int]]:
        """(template, start, start in the template, length) of matches that cannot be longer to the right."""
        stats, out = [*self.statistics(tokens), (0, 0)], []
        for i in range(len(tokens)):
            s, n = stats[i]
            if n >= least and stats[i + 1][1] <= n:
                out += [(t, i + 1 - n, e - n, n) for t, e in self.states[s].ends.items()]
        return out


def chain(matches: list[tuple[int, int, int, int]], lengths: list[int], gap: int) -> list[tuple[int, int, int, float]]:
    """(template, start, end, share of the template covered) of chained matches."""
    out = []
    for t in sorted({m[0] for m in matches}):
        open_: list[int] | None = None
        for _, start, at, n in sorted(m for m in matches if m[0] == t):
            if open_ and 0 <= start - open_[1] <= gap and at >= open_[2]:
                open_[1], open_[2], open_[3] = start + n, at + n, open_[3] + n
            else:
                if open_:
                    out.append((t, open_[0], open_[1], open_[3] / lengths[t]))
                open_ = [start, start + n, at + n, n]
        if open_:
            out.append((t, open_[0], open_[1], open_[3] / lengths[t]))
    return out


class Scanner:
    """The automaton, its vocabulary by word hash, and the base phrases."""

    def __init__(self, templates: dict[str, tuple[str, ...]], phrases: dict[str, str], least: int, gap: int,
                 covered: float):
        self.least, self.gap, self.covered = least, gap, covered
        self.names = [name for name, ts in templates.items() for _ in ts]
        seqs = [words(t) for ts in templates.values() for t in ts]
        vocabulary = sorted({w for s in seqs for w in s} | {w for p in phrases for w in words(p)})
        data, at = T.texts(pa.array(vocabulary, pa.string()))
        h = T.split(data, at, T.NOT_ALNUM, T.LOWER).hashes()
        order = np.argsort(h)
        self.hashes, self.ids = h[order], (order + 1).astype(np.int32)
        ids = {w: i + 1 for i, w in enumerate(vocabulary)}
        self.automaton = Automaton([[ids[w] for w in s] for s in seqs])
        self.phrases = [([ids[w] for w in words(p)], label) for p, label in phrases.items()]

    def tokens(self, hashes: np.ndarray) -> np.ndarray:
        k = np.minimum(np.searchsorted(self.hashes, hashes), len(self.hashes) - 1)
        return np.where(self.hashes[k] == hashes, self.ids[k], 0)

    def scan(self, data: np.ndarray, at: np.ndarray) -> list[dict]:
        w = T.split(data, at, T.NOT_ALNUM, T.LOWER)
        ids, doc = self.tokens(w.hashes()), w.doc()
        out = [{"n_words": int(b - a), "places": [], "spans": []} for a, b in zip(w.lo, w.hi)]
        for seq, label in self.phrases:
            k = len(seq)
            if w.n >= k:
                hit = doc[k - 1:] == doc[:w.n - k + 1]
                for j, x in enumerate(seq):
                    hit = hit & (ids[j:w.n - k + 1 + j] == x)
                for i in np.flatnonzero(hit):
                    out[doc[i]]["places"].append((int(i - w.lo[doc[i]]), label))
        # a match of `least` words lies in as long a run of known words of one document
        known = ids > 0
        begin = known.copy()
        begin[1:] &= ~known[:-1] | (doc[1:] != doc[:-1])
        end = known.copy()
        end[:-1] &= ~known[1:] | (doc[1:] != doc[:-1])
        a, b = np.flatnonzero(begin), np.flatnonzero(end) + 1
        long_ = b - a >= self.least
        found: dict[int, list] = {}
        for i, j in zip(a[long_], b[long_]):
            d = int(doc[i])
            at_ = int(i - w.lo[d])
            found.setdefault(d, []).extend((t, s + at_, p, n) for t, s, p, n in
                                           self.automaton.matches(ids[i:j].tolist(), self.least))
        for d, ms in found.items():
            out[d]["spans"] = chain(ms, self.automaton.lengths, self.gap)
        return out


def scan(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text",
         templates: dict[str, tuple[str, ...]] | None = None, phrases: dict[str, str] | None = None,
         least: int = 4, gap: int = 6, covered: float = 0.75) -> DataFrame:
    """One row per document: (id, n_words, places array<(start, label)>, spans array<(template, label, start, end, covered)>).

    ``least``: words of a match; ``gap``: words between chained matches;
    ``covered``: share of a template from which its label holds.
    """
    s = Scanner(templates or TEMPLATES, phrases or PHRASES, least, gap, covered)
    place = pa.list_(pa.struct([("start", pa.int64()), ("label", pa.string())]))
    span = pa.list_(pa.struct([("template", pa.int64()), ("label", pa.string()), ("start", pa.int64()),
                               ("end", pa.int64()), ("covered", pa.float64())]))

    def scanned(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part, data, at in T.chunks(batch):
                rows = s.scan(data, at)
                yield pa.RecordBatch.from_arrays([
                    part.column(0), pa.array([r["n_words"] for r in rows], pa.int64()),
                    pa.array([[{"start": i, "label": x} for i, x in r["places"]] for r in rows], place),
                    pa.array([[{"template": t, "label": s.names[t], "start": i, "end": j, "covered": min(c, 1.0)}
                               for t, i, j, c in r["spans"]] for r in rows], span)],
                    ["doc_id", "n_words", "places", "spans"])

    return docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text")).mapInArrow(
        scanned, "doc_id long, n_words long, places array<struct<start: long, label: string>>, "
                 "spans array<struct<template: long, label: string, start: long, end: long, covered: double>>")


def digest(scanned: DataFrame, covered: float = 0.75) -> DataFrame:
    """Counts, labels and score of each document from what :func:`scan` returns.

    The score is the largest share of a template that is covered, and at
    least 0.5 where a base phrase stands.
    """
    return scanned.select(
        "doc_id", "n_words", F.size("places").cast("long").alias("n_base"),
        F.expr("array_min(places.start)").alias("first_word"), F.expr("array_max(places.start)").alias("last_word"),
        F.expr("array_join(array_sort(array_distinct(places.label)), ',')").alias("base_labels"),
        F.expr("array_join(array_sort(array_distinct(concat(places.label, "
               f"filter(spans, s -> s.covered >= {covered}).label))), ',')").alias("labels"),
        F.expr("greatest(coalesce(array_max(spans.covered), 0.0D), if(size(places) > 0, 0.5D, 0.0D))").alias("score"))
