"""Licence scans with a generalised suffix automaton of licence texts.

The automaton holds all phrases and notices as words. A document is streamed through it
word by word; the longest suffix that is part of some notice (the matching statistic) is
known at every word. Where that length cannot grow, a match ends; matches of at least
`MIN_MATCH` words are chained per notice, in order in both texts and with bounded gaps,
and a chain that covers `MIN_COVER` of its notice is a span with the notice's label.
"""

from __future__ import annotations

import re
from bisect import bisect_left
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from folio_sync.llm.common import in_batches, small_batches

# The phrases of the base, and public licence notices.
PHRASES = {
    "cc by": "cc-by",
    "general public license": "gpl",
    "all rights reserved": "reserved",
}
NOTICES = (
    ("apache-2.0", "Licensed under the Apache License, Version 2.0"),
    ("apache-2.0", "you may not use this file except in compliance with the License"),
    ("bsd", "Redistribution and use in source and binary forms, with or without modification, are permitted"
            " provided that the following conditions are met"),
    ("cc-by", "This work is licensed under a Creative Commons Attribution 4.0 International License"),
    ("cc-by-nc", "Licensed under CC BY-NC 4.0"),
    ("cc-by-sa", "Licensed under CC BY-SA 4.0"),
    ("gpl", "This program is free software: you can redistribute it and/or modify it under the terms of the GNU"
            " General Public License as published by the Free Software Foundation"),
    ("gpl", "This work is licensed under the GNU General Public License, version 3"),
    ("isc", "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee"
            " is hereby granted"),
    ("mit", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and"
            " associated documentation files"),
    ("mit", "Released under the MIT License"),
    ("mpl-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0"),
)
MIN_MATCH, MAX_GAP, MIN_COVER = 3, 6, 0.7
BASE_SCORE = 0.5  # of a text that has a phrase and no notice
CHUNK = 1 << 20

# ASCII bytes other than digits and lower-case letters end a word; case is folded before.
WORD = re.compile(rb"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
BREAK = re.compile(rb"[\x00-\x2F\x3A-\x60\x7B-\x7F]")


def words_of(text: str) -> Iterator[list[bytes]]:
    """The words of a text, in lists that each hold about `CHUNK` bytes of it."""
    body = text.encode(errors="surrogatepass").lower()
    at = 0
    while at < len(body):
        cut = BREAK.search(body, at + CHUNK)
        end = cut.start() if cut else len(body)
        yield WORD.findall(body, at, end)
        at = end


class Automaton:
    """States of a suffix automaton over the words of several texts."""

    def __init__(self, texts: list[tuple[str, list[int]]], phrases: list[bool]):
        self.next: list[dict[int, int]] = [{}]
        self.link, self.size = [-1], [0]
        ends: list[list[tuple[int, int]]] = [[]]  # (text, words up to the end)
        self.texts = texts
        for number, (_, words) in enumerate(texts):
            last = 0
            for count, word in enumerate(words, 1):
                last = self._extend(last, word)
                while len(ends) < len(self.next):
                    ends.append([])
                ends[last].append((number, count))
        by_size = sorted(range(1, len(self.next)), key=lambda s: -self.size[s])
        for state in by_size:
            if self.link[state] > 0:
                ends[self.link[state]] += ends[state]
        # where in the notices a state's words end, and the whole texts that end with it
        self.places = [[(t, e) for t, e in found if not phrases[t]] for found in ends]
        self.whole: list[list[tuple[int, int]]] = [[] for _ in self.next]
        for number, (_, words) in enumerate(texts):
            state = 0
            for word in words:
                state = self.next[state][word]
            self.whole[state].append((number, len(words)))
        for state in reversed(by_size):
            self.whole[state] = self.whole[state] + self.whole[max(0, self.link[state])]

    def _extend(self, last: int, word: int) -> int:
        if word in self.next[last]:
            step = self.next[last][word]
            return step if self.size[step] == self.size[last] + 1 else self._clone(last, word, step)
        new = self._state(self.size[last] + 1, {})
        state = last
        while state >= 0 and word not in self.next[state]:
            self.next[state][word] = new
            state = self.link[state]
        if state >= 0:
            step = self.next[state][word]
            self.link[new] = step if self.size[step] == self.size[state] + 1 else self._clone(state, word, step)
        else:
            self.link[new] = 0
        return new

    def _clone(self, state: int, word: int, step: int) -> int:
        copy = self._state(self.size[state] + 1, dict(self.next[step]))
        self.link[copy], self.link[step] = self.link[step], copy
        while state >= 0 and self.next[state].get(word) == step:
            self.next[state][word] = copy
            state = self.link[state]
        return copy

    def _state(self, size: int, following: dict[int, int]) -> int:
        self.next.append(following)
        self.link.append(0)
        self.size.append(size)
        return len(self.next) - 1


class Scanner:
    def __init__(self, phrases: dict[str, str], notices, min_match: int, max_gap: int, min_cover: float):
        texts = [(label, text, True) for text, label in phrases.items()]
        texts += [(label, text, False) for label, text in notices]
        split = [[w for words in words_of(text) for w in words] for _, text, _ in texts]
        self.ids = {w: i for i, w in enumerate(sorted({w for words in split for w in words}), 1)}
        coded = [(label, [self.ids[w] for w in words]) for (label, _, _), words in zip(texts, split)]
        self.is_phrase = [p for _, _, p in texts]
        self.automaton = Automaton(coded, self.is_phrase)
        self.min_match, self.max_gap, self.min_cover = min_match, max_gap, min_cover

    def scan(self, text: str):
        """Words, base places [(start, label)] and covered spans [(label, start, end, cover)]."""
        find, auto = self.ids.get, self.automaton
        following, link, size = auto.next, auto.link, auto.size
        base, matches = [], []
        state = length = seen = 0
        for words in words_of(text):
            for i, word in enumerate(map(find, words), seen):
                if word is None:
                    if length >= self.min_match:
                        matches.append((i, length, auto.places[state]))
                    state = length = 0
                    continue
                if word not in following[state]:
                    if length >= self.min_match:
                        matches.append((i, length, auto.places[state]))
                    while state and word not in following[state]:
                        state = link[state]
                        length = size[state]
                if word in following[state]:
                    state = following[state][word]
                    length += 1
                    for text_number, n in auto.whole[state]:
                        if n <= length:
                            if self.is_phrase[text_number]:
                                base.append((i - n + 1, auto.texts[text_number][0]))
                            else:  # a notice that may lie inside a longer one's match
                                matches.append((i + 1, n, [(text_number, n)]))
            seen += len(words)
        if length >= self.min_match:
            matches.append((seen, length, auto.places[state]))
        return seen, base, self._spans(matches)

    def _spans(self, matches: list[tuple[int, int, list]]) -> list[tuple[str, int, int, float]]:
        """Chains of matches; each match goes on with the best chain of its notice that it can follow."""
        open_chains: dict[int, list[tuple[int, int, int, int]]] = {}  # notice -> (start, end, place, covered)
        done: dict[int, list[tuple[int, int, int]]] = {}
        for end, length, places in matches:
            for notice, place in places:
                chains = [c for c in open_chains.get(notice, ()) if end - length - c[1] <= self.max_gap]
                # what overlaps the chain's last match, in either text, counts once
                best = max(
                    ((covered + length - over, start) for start, c_end, c_place, covered in chains
                     if c_end <= end and c_place <= place
                     and (over := max(0, c_end - end + length, c_place - place + length)) < length),
                    key=lambda b: (b[0], -b[1]), default=(length, end - length))
                open_chains[notice] = [*chains, (best[1], end, place, best[0])]
                done.setdefault(notice, []).append((best[0], best[1], end))
        spans = set()
        for notice, chains in done.items():
            label, words = self.automaton.texts[notice]
            starts, ends = [], []  # of the spans taken, which do not overlap, in order
            for covered, start, end in sorted(chains, key=lambda c: (-c[0], c[1], c[2])):
                if covered < self.min_cover * len(words):
                    break
                at = bisect_left(starts, end)
                if not at or ends[at - 1] <= start:
                    starts.insert(at, start)
                    ends.insert(at, end)
                    spans.add((label, start, end, min(1.0, covered / len(words))))
        return sorted(spans, key=lambda x: (x[1], x[2], x[0]))


SPAN = pa.struct([("label", pa.string()), ("start", pa.int64()), ("end", pa.int64()), ("cover", pa.float64())])
FOUND = pa.schema([
    ("doc_id", pa.int64()), ("n_words", pa.int64()), ("n_base", pa.int64()), ("first_word", pa.int64()),
    ("last_word", pa.int64()), ("base_labels", pa.string()), ("labels", pa.string()), ("score", pa.float64()),
    ("spans", pa.list_(SPAN)),
])


def scan_licences(
    docs: DataFrame, phrases: dict[str, str] = PHRASES, notices=NOTICES,
    min_match: int = MIN_MATCH, max_gap: int = MAX_GAP, min_cover: float = MIN_COVER,
) -> DataFrame:
    """One row per row of `docs(doc_id, text, ...)` with the words, base places, labels and spans.

    doc_id, n_words, n_base, first_word and last_word (of base places, else null), base_labels,
    labels (distinct, sorted, joined by commas, empty if none), score and spans (label, start,
    end in words, cover). The score is the largest share of a notice that a span covers, at
    least `BASE_SCORE` with a base place, else 0. Null texts count as empty; an empty table
    gives no rows; equal rows give equal rows; other columns are not read."""
    small_batches(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scanner = Scanner(phrases, notices, min_match, max_gap, min_cover)

        def rows():
            for batch in batches:
                for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                    n_words, base, spans = scanner.scan(text or "")
                    starts = [s for s, _ in base]
                    plain = {label for _, label in base}
                    score = max([c for *_, c in spans] + [BASE_SCORE * bool(base)])
                    yield (
                        doc_id, n_words, len(base), min(starts, default=None), max(starts, default=None),
                        ",".join(sorted(plain)), ",".join(sorted(plain | {s[0] for s in spans})), float(score),
                        [dict(zip(("label", "start", "end", "cover"), s)) for s in spans],
                    )

        yield from in_batches(rows(), FOUND, 1000)

    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(
        run, "doc_id long, n_words long, n_base long, first_word long, last_word long, base_labels string,"
             " labels string, score double, spans array<struct<label:string,start:long,end:long,cover:double>>")
