"""License scans with a generalised suffix automaton of template tokens.

The automaton accepts every token sequence that stands in some template; each
state knows one end place of its sequences in each template that has them. A
text streams through it: after each word the state and length are the longest
suffix that stands in a template (matching statistics). Where the length
can't grow a maximal match ends; matches of ``LEAST_MATCH`` tokens or more
are chained per template, in the order of both text and template and with
gaps of at most ``GAP`` words, and the best chain's share of the template is
its coverage. A template is found where that reaches its threshold.

A match of three or more tokens consists of token pairs that stand in
templates. Runs of such pairs are found in array operations; only they are
streamed, as everywhere else the statistics stay below ``LEAST_MATCH``.

Words are runs of 0-9, a-z and non-ASCII characters after A-Z became lower
case. The fixed base phrases count at all places where they stand.

Defined results: null and empty texts have no words, no labels, null first
and last word and score 0; repeated rows each get their row; an empty table
gives an empty result; other columns are dropped.
"""

from __future__ import annotations

import bisect
from collections import defaultdict
from dataclasses import dataclass, field
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from cadenza.llm import kernels as K
from cadenza.llm.common import byte_buffer, map_blocks, texts

#: Base phrases and their labels.
PHRASES = {"cc by": "cc-by", "general public license": "gpl", "all rights reserved": "reserved"}
#: Openings of public licence notices.
TEMPLATES = (
    ("apache-2.0", "licensed under the apache license version 2 0"),
    ("apache-2.0", "you may not use this file except in compliance with the license you may obtain a copy of the license at http www apache org licenses license 2 0"),
    ("bsd", "redistribution and use in source and binary forms with or without modification are permitted provided that the following conditions are met"),
    ("cc-by", "this work is licensed under a creative commons attribution 4 0 international license"),
    ("cc0", "to the extent possible under law the author has waived all copyright and related or neighboring rights to this work"),
    ("gpl", "licensed under the gnu general public license"),
    ("gpl", "this program is free software you can redistribute it and or modify it under the terms of the gnu general public license as published by the free software foundation"),
    ("isc", "permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted provided that the above copyright notice and this permission notice appear in all copies"),
    ("lgpl", "gnu lesser general public license"),
    ("mit", "released under the mit license"),
    ("mit", "permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files the software to deal in the software without restriction"),
    ("mpl-2.0", "this source code form is subject to the terms of the mozilla public license v 2 0"),
    ("unlicense", "this is free and unencumbered software released into the public domain"),
)
LEAST_MATCH = 3
GAP = 8
#: The share of a template that a chain must cover.
COVERAGE = 0.75


@dataclass
class Automaton:
    """Suffix automaton of several token sequences, built token by token."""

    next: list[dict[int, int]] = field(default_factory=lambda: [{}])
    link: list[int] = field(default_factory=lambda: [-1])
    length: list[int] = field(default_factory=lambda: [0])
    #: Of each state: template -> one end place (exclusive) there.
    ends: list[dict[int, int]] = field(default_factory=lambda: [{}])

    def _state(self, length: int, next_: dict[int, int], link: int) -> int:
        self.next.append(next_)
        self.link.append(link)
        self.length.append(length)
        self.ends.append({})
        return len(self.next) - 1

    def _split(self, p: int, token: int, q: int) -> int:
        """A copy of q for its sequences that p's extend to."""
        clone = self._state(self.length[p] + 1, dict(self.next[q]), self.link[q])
        self.link[q] = clone
        while p >= 0 and self.next[p].get(token) == q:
            self.next[p][token] = clone
            p = self.link[p]
        return clone

    def _extend(self, last: int, token: int) -> int:
        if token in self.next[last]:  # another sequence went here
            q = self.next[last][token]
            return q if self.length[q] == self.length[last] + 1 else self._split(last, token, q)
        new = self._state(self.length[last] + 1, {}, 0)
        p = last
        while p >= 0 and token not in self.next[p]:
            self.next[p][token] = new
            p = self.link[p]
        if p >= 0:
            q = self.next[p][token]
            self.link[new] = q if self.length[q] == self.length[p] + 1 else self._split(p, token, q)
        return new

    def add(self, tokens: list[int]) -> None:
        last = 0
        for token in tokens:
            last = self._extend(last, token)

    def place(self, template: int, tokens: list[int]) -> None:
        """Note the end places of one template in all states of its prefixes' suffixes (after all were added)."""
        at = 0
        for i, token in enumerate(tokens):
            at = self.next[at][token]
            state = at
            while state > 0 and template not in self.ends[state]:
                self.ends[state][template] = i + 1
                state = self.link[state]

    def statistics(self, tokens: list[int]) -> list[tuple[int, int]]:
        """After each token the state and length of the longest suffix that stands in a template."""
        state, length, out = 0, 0, []
        for token in tokens:
            while state and token not in self.next[state]:
                state = self.link[state]
                length = self.length[state]
            if token in self.next[state]:
                state = self.next[state][token]
                length += 1
            else:
                length = 0
            out.append((state, length))
        return out


class Scanner:
    """The automaton with its vocabulary, for one set of templates and phrases."""

    def __init__(self, templates: tuple[tuple[str, str], ...], phrases: dict[str, str]) -> None:
        self.labels = [label for label, _ in templates]
        words = sorted({w for _, text in templates for w in text.split()} | {w for p in phrases for w in p.split()})
        self.ids = {w: i for i, w in enumerate(words)}
        self.tokens = [[self.ids[w] for w in text.split()] for _, text in templates]
        self.phrases = [([self.ids[w] for w in p.split()], label) for p, label in phrases.items()]
        self.automaton = Automaton()
        for t in self.tokens:
            self.automaton.add(t)
        for i, t in enumerate(self.tokens):
            self.automaton.place(i, t)
        self.pairs = np.zeros((len(words) + 1, len(words) + 1), bool)
        for t in self.tokens:
            self.pairs[t[:-1], t[1:]] = True
        data = "".join(words).encode()
        ends = np.cumsum([len(w.encode()) for w in words])
        h = K.slice_hashes(np.frombuffer(data, np.uint8), ends - [len(w.encode()) for w in words], ends)
        order = np.argsort(h)
        self.hashes, self.places = h[order], order

    def words(self, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Token of each word (no template's: the last number) and the n + 1 row offsets."""
        low = K.LOWER[data]
        starts, ends, rows = K.word_spans(low, offsets, K.ALNUM)
        h = K.slice_hashes(low, starts, ends)
        at = np.minimum(np.searchsorted(self.hashes, h), len(self.hashes) - 1)
        return np.where(self.hashes[at] == h, self.places[at], len(self.hashes)), rows

    def base_places(self, tokens: np.ndarray, rows: np.ndarray) -> list[tuple[np.ndarray, str]]:
        """For each phrase the words of the block at which it stands, and its label."""
        row_end = np.repeat(rows[1:], np.diff(rows))
        out = []
        for phrase, label in self.phrases:
            at = np.flatnonzero(tokens == phrase[0])
            at = at[at + len(phrase) <= row_end[at]]
            for k, token in enumerate(phrase[1:], 1):
                at = at[tokens[at + k] == token]
            out.append((at, label))
        return out

    def runs(self, tokens: np.ndarray, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Starts and ends of the runs of words whose neighbours are all pairs of templates, long enough for a match."""
        if len(tokens) < LEAST_MATCH:
            return np.zeros(0, np.int64), np.zeros(0, np.int64)
        pair = self.pairs[tokens[:-1], tokens[1:]]
        crossing = rows[(rows > 0) & (rows < len(tokens))] - 1
        pair[crossing] = False
        edge = np.diff(np.concatenate([[0], pair.astype(np.int8), [0]]))
        starts, ends = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1) + 1
        long_ = ends - starts >= LEAST_MATCH
        return starts[long_], ends[long_]

    def matches(self, tokens: list[int], at: int) -> list[tuple[int, int, int, int]]:
        """Maximal matches of a run that begins at word ``at``: (template, start in it, start in the text, length)."""
        stats = self.automaton.statistics(tokens)
        out = []
        for i, (state, length) in enumerate(stats):
            if length >= LEAST_MATCH and (i + 1 == len(stats) or stats[i + 1][1] != length + 1):
                out += [(template, end - length, at + i + 1 - length, length) for template, end in self.automaton.ends[state].items()]
        return out

    def spans(self, matches: list[tuple[int, int, int, int]]) -> list[tuple[str, int, int, float]]:
        """Chains of each template, best first, that don't overlap one another: (label, first word, end word, coverage)."""
        by: dict[int, list[tuple[int, int, int]]] = defaultdict(list)
        for template, own, text, length in matches:
            by[template].append((text, own, length))
        out = []
        for template, parts in sorted(by.items()):
            parts.sort()
            best: list[tuple[int, int]] = []  # tokens covered, first word
            low = 0
            for i, (text, own, length) in enumerate(parts):
                score, first = length, text
                while parts[low][0] + len(self.tokens[template]) + GAP < text:
                    low += 1
                for j in range(low, i):
                    t, o, n = parts[j]
                    over = max(0, t + n - text, o + n - own)
                    if t < text and o < own and over < length and text - (t + n) <= GAP and best[j][0] + length - over > score:
                        score, first = best[j][0] + length - over, best[j][1]
                best.append((score, first))
            taken: list[tuple[int, int]] = []
            for i in sorted(range(len(parts)), key=lambda i: (-best[i][0], i)):
                (score, first), stop = best[i], parts[i][0] + parts[i][2]
                at = bisect.bisect_left(taken, (stop, 0))
                if at and taken[at - 1][1] > first:
                    continue
                taken.insert(at, (first, stop))
                out.append((self.labels[template], first, stop, min(1.0, score / len(self.tokens[template]))))
        return out


@lru_cache(maxsize=2)
def scanner(templates: tuple[tuple[str, str], ...] = TEMPLATES) -> Scanner:
    return Scanner(templates, PHRASES)


SCHEMA = "doc_id bigint, n_words bigint, n_base bigint, first_word bigint, last_word bigint, base_labels string, labels string, score double, spans array<struct<label:string,first:bigint,stop:bigint,coverage:double>>"


def scan_licenses(docs: DataFrame, templates: tuple[tuple[str, str], ...] = TEMPLATES, coverage: float = COVERAGE) -> DataFrame:
    """Base places and labels, template labels, the highest coverage and the covered spans of every row."""

    def block(batch: pa.RecordBatch) -> pa.RecordBatch:
        own = scanner(templates)
        tokens, rows = own.words(*byte_buffer(batch.column("text")))
        n = len(rows) - 1
        places: list[list[int]] = [[] for _ in range(n)]
        base: list[set] = [set() for _ in range(n)]
        found: list[list] = [[] for _ in range(n)]
        for at, label in own.base_places(tokens, rows):
            for i, w in zip((np.searchsorted(rows, at, "right") - 1).tolist(), at.tolist()):
                places[i].append(w - int(rows[i]))
                base[i].add(label)
        starts, ends = own.runs(tokens, rows)
        for i, a, b in zip((np.searchsorted(rows, starts, "right") - 1).tolist(), starts.tolist(), ends.tolist()):
            found[i] += own.matches(tokens[a:b].tolist(), a - int(rows[i]))
        spans = [own.spans(f) if f else [] for f in found]
        labels = [base[i] | {s[0] for s in spans[i] if s[3] >= coverage} for i in range(n)]
        kind = pa.list_(pa.struct([("label", pa.string()), ("first", pa.int64()), ("stop", pa.int64()), ("coverage", pa.float64())]))
        columns = [
            batch.column("doc_id"),
            pa.array(np.diff(rows), pa.int64()),
            pa.array([len(p) for p in places], pa.int64()),
            pa.array([min(p, default=None) for p in places], pa.int64()),
            pa.array([max(p, default=None) for p in places], pa.int64()),
            pa.array([",".join(sorted(x)) for x in base], pa.string()),
            pa.array([",".join(sorted(x)) for x in labels], pa.string()),
            pa.array([max((s[3] for s in x), default=0.0) for x in spans], pa.float64()),
            pa.array([[{"label": s[0], "first": s[1], "stop": s[2], "coverage": s[3]} for s in x if s[3] >= coverage] for x in spans], kind),
        ]
        return pa.RecordBatch.from_arrays(columns, ["doc_id", "n_words", "n_base", "first_word", "last_word", "base_labels", "labels", "score", "spans"])

    return map_blocks(texts(docs), block, SCHEMA)
