"""License scans: matching statistics from a suffix automaton of licence tokens.

The automaton holds all substrings of all template token lists.  A text is streamed
through it word by word; each word gives the longest match that ends there.  Maximal
matches of ``LEAST_MATCH`` words or more, with every occurrence in a template, are
chained by increasing place in text and template with gaps of at most ``MOST_GAP`` words;
a template whose best chain covers ``COVERED`` or more of it gives its label and the
chain's text spans (``label:first-last`` word, from 0).  Base phrases are
found in the same pass: a phrase stands where the match is at least as long as the phrase and
the phrase's state is the match's state or one of its suffixes.

The automaton's size follows the templates, which are fixed; texts are read batch by
batch, whole, and nothing is shuffled.

Defined cases: a null or wordless text has no words, no labels, no spans and score 0; a null id
stays null; repeated rows are scored alike; other columns are not read; an empty table
gives an empty result.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from listenlake.llm.common import id_and_text, table

LEAST_MATCH = 4
MOST_GAP = 10
COVERED = 0.8
_WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
_LOWER = {c: c + 32 for c in range(65, 91)}

# Base phrases and their labels.
BASE = {"under the mit license": "mit", "apache license version 2": "apache-2", "cc by nc": "cc-by-nc"}
# Customary licence notices and their labels.
TEMPLATES = {
    "this work is licensed under the gnu general public license version 3": "gpl-3",
    "this work is licensed under the gnu general public license version 2": "gpl-2",
    "this program is free software you can redistribute it and or modify it under the terms of the "
    "gnu general public license as published by the free software foundation": "gpl",
    "permission is hereby granted free of charge to any person obtaining a copy of this software and "
    "associated documentation files the software to deal in the software without restriction": "mit",
    "licensed under the apache license version 2 0 the license you may not use this file except in "
    "compliance with the license": "apache-2",
    "redistribution and use in source and binary forms with or without modification are permitted "
    "provided that the following conditions are met": "bsd",
    "this work is licensed under a creative commons attribution 4 0 international license": "cc-by-4",
    "this work is licensed under a creative commons attribution sharealike 4 0 international license": "cc-by-sa-4",
    "this source code form is subject to the terms of the mozilla public license v 2 0": "mpl-2",
}


def words_of(text: str) -> list[str]:
    return _WORD.findall(text.translate(_LOWER))


class Automaton:
    """A generalised suffix automaton over token lists.

    ``places`` of a state: template number and end position of every occurrence.
    """

    def __init__(self, templates: list[list[str]]):
        self.next, self.link, self.length = [{}], [-1], [0]
        self.places: list[set[tuple[int, int]]] = [set()]
        for number, tokens in enumerate(templates):
            last = 0
            for end, token in enumerate(tokens):
                last = self._extend(last, token)
                for state in self.suffixes(last):
                    self.places[state].add((number, end))

    def _state(self, length: int, moves: dict, link: int, places: set) -> int:
        self.next.append(moves)
        self.link.append(link)
        self.length.append(length)
        self.places.append(places)
        return len(self.next) - 1

    def _split(self, p: int, token: str) -> int:
        """The state of p's longest string and one token more, alone in its class."""
        q = self.next[p][token]
        if self.length[q] == self.length[p] + 1:
            return q
        clone = self._state(self.length[p] + 1, dict(self.next[q]), self.link[q], set(self.places[q]))
        self.link[q] = clone
        while p >= 0 and self.next[p].get(token) == q:
            self.next[p][token] = clone
            p = self.link[p]
        return clone

    def _extend(self, last: int, token: str) -> int:
        if token in self.next[last]:
            return self._split(last, token)
        made = self._state(self.length[last] + 1, {}, 0, set())
        p = last
        while p >= 0 and token not in self.next[p]:
            self.next[p][token] = made
            p = self.link[p]
        if p >= 0:
            self.link[made] = self._split(p, token)
        return made

    def state_of(self, tokens: list[str]) -> int:
        state = 0
        for token in tokens:
            state = self.next[state][token]
        return state

    def suffixes(self, state: int) -> Iterator[int]:
        while state > 0:
            yield state
            state = self.link[state]

    def statistics(self, words: list[str]) -> Iterator[tuple[int, int, int]]:
        """(position, state, length of the longest match that ends there), where not 0."""
        state = length = 0
        known = self.next[0]
        for at, word in enumerate(words):
            if word not in known:
                if length:
                    state = length = 0
                continue
            while state and word not in self.next[state]:
                state = self.link[state]
                length = self.length[state]
            state = self.next[state][word]
            length += 1
            yield at, state, length


class Scanner:
    def __init__(self, base: dict[str, str] = BASE, templates: dict[str, str] = TEMPLATES):
        self.texts = [words_of(t) for t in templates]
        self.labels = list(templates.values())
        phrases = [words_of(p) for p in base]
        self.automaton = Automaton(self.texts + phrases)
        states = {self.automaton.state_of(p): (len(p), label) for p, label in zip(phrases, base.values())}
        self.phrases = {}
        for state in range(1, len(self.automaton.next)):
            hits = [states[s] for s in self.automaton.suffixes(state) if s in states]
            if hits:
                self.phrases[state] = hits
        # Of a state: (template, end, words that match there at most), shorter matches included.
        self.reach = [self._reach(state) for state in range(len(self.automaton.next))]

    def _reach(self, state: int) -> list[tuple[int, int, int]]:
        most: dict[tuple[int, int], int] = {}
        for s in self.automaton.suffixes(state):
            for number, end in self.automaton.places[s]:
                if number < len(self.texts) and self.automaton.length[s] >= LEAST_MATCH:
                    most.setdefault((number, end), self.automaton.length[s])
        return [(*place, size) for place, size in most.items()]

    def scan(self, text: str) -> tuple:
        words = words_of(text)
        starts, base = [], set()
        # Matches per template as [first word, first template word, length]; ``open_at`` has
        # the last one of every diagonal.
        matches: dict[int, list[list[int]]] = {}
        open_at: dict[tuple[int, int], list[int]] = {}
        for at, state, length in self.automaton.statistics(words):
            for size, label in self.phrases.get(state, ()):
                if length >= size:
                    starts.append(at - size + 1)
                    base.add(label)
            if length < LEAST_MATCH:
                continue
            for number, end, most in self.reach[state]:
                match = open_at.get((number, at - end))
                if match and match[0] + match[2] == at:
                    match[2] += 1
                else:
                    size = min(length, most)
                    match = [at - size + 1, end - size + 1, size]
                    open_at[number, at - end] = match
                    matches.setdefault(number, []).append(match)
        chains = {n: _best_chain(found) for n, found in matches.items()}
        cover = {n: covered / len(self.texts[n]) for n, (covered, _) in chains.items()}
        whole = [n for n, c in cover.items() if c >= COVERED]
        found = base | {self.labels[n] for n in whole}
        spans = sorted({(first, last, self.labels[n]) for n in whole for first, last in chains[n][1]})
        score = 1.0 if base else max(cover.values(), default=0.0)
        return (
            len(words), len(starts), min(starts, default=None), max(starts, default=None),
            ",".join(sorted(base)), ",".join(sorted(found)), score,
            ",".join(f"{label}:{first}-{last}" for first, last, label in spans),
        )


def _best_chain(matches: list[list[int]]) -> tuple[int, list[tuple[int, int]]]:
    """Template words of the best chain of one template's matches, and its text spans."""
    matches = sorted(matches, key=lambda m: (m[0] + m[2], m[0]))
    covered, before = [], []
    for i, (at, place, size) in enumerate(matches):
        best, link = size, -1
        for j in range(i - 1, -1, -1):
            at_j, place_j, size_j = matches[j]
            gap, skipped = at - at_j - size_j, place - place_j - size_j
            if gap > MOST_GAP:
                break
            new = size + min(0, gap, skipped)
            if at_j < at and place_j < place and skipped <= MOST_GAP and new > 0 and covered[j] + new > best:
                best, link = covered[j] + new, j
        covered.append(best)
        before.append(link)
    spans, i = [], int(np.argmax(covered))
    most = covered[i]
    while i >= 0:
        spans.append((matches[i][0], matches[i][0] + matches[i][2] - 1))
        i = before[i]
    return most, spans[::-1]


_RESULT = (
    "n_words long, n_base long, first_word long, last_word long, base_labels string, labels string, score double, "
    "spans string"
)


def scans(text: Column, base: dict[str, str] = BASE, templates: dict[str, str] = TEMPLATES) -> Column:
    """A struct of counts, labels and score per text."""

    @F.pandas_udf(_RESULT, F.PandasUDFType.SCALAR_ITER)
    def scan(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        scanner = Scanner(base, templates)
        names = [field.split()[0] for field in _RESULT.split(", ")]
        for texts in batches:
            made = pd.DataFrame([scanner.scan(t) for t in texts], columns=names)
            yield made.astype({"first_word": "Int64", "last_word": "Int64"})

    return scan(text)


def op6_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = id_and_text(table(spark, sf_dir, "documents"))
    return docs.select("doc_id", scans(F.col("text")).alias("s")).select("doc_id", "s.*")
