"""Licence scans: matching statistics against a generalised suffix automaton, chained into covered spans.

All token sequences of the licence templates share one automaton. Reading a text word by word gives, at each
word, the longest run ending there that occurs in any template. Runs that cannot be made longer on either side
are anchors; anchors of one template in the same order in text and template, with bounded gaps, form a
span, and a span that covers enough of its template is a finding. Base phrases are templates of their own: one
stands at a word if and only if its state is an ancestor of the current state.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame

from millrace.llm.common import map_slices, raw_texts, with_text

#: Phrases and their labels.
BASE = {"cc by": "cc-by", "general public license": "gpl", "all rights reserved": "reserved"}

#: Public licence notices by label; several templates may share one.
TEMPLATES = [
    ("mit", "released under the MIT License"),
    ("mit", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files "
            "(the \"Software\"), to deal in the Software without restriction"),
    ("apache-2.0", "Licensed under the Apache License, Version 2.0"),
    ("apache-2.0", "you may not use this file except in compliance with the License. You may obtain a copy of the License at"),
    ("gpl", "licensed under the GNU General Public License, version 3"),
    ("gpl", "you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation"),
    ("lgpl", "under the terms of the GNU Lesser General Public License as published by the Free Software Foundation"),
    ("agpl", "under the terms of the GNU Affero General Public License as published by the Free Software Foundation"),
    ("mpl-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0"),
    ("bsd", "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met"),
    ("isc", "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted"),
    ("cc-by", "licensed under a Creative Commons Attribution 4.0 International License"),
    ("cc-by-sa", "licensed under a Creative Commons Attribution-ShareAlike 4.0 International License"),
    ("cc-by-nc", "licensed under CC BY-NC 4.0"),
    ("cc0", "To the extent possible under law, the author has waived all copyright and related or neighboring rights to this work"),
    ("unlicense", "This is free and unencumbered software released into the public domain"),
    ("warranty", "THE SOFTWARE IS PROVIDED \"AS IS\", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED"),
]

#: A match of fewer words is no anchor; a gap between anchors of more words ends a span; a span must cover this share.
MIN_ANCHOR, MAX_GAP, MIN_COVER = 3, 8, 0.75
BLOCK_BYTES = 1 << 22

#: Words: digits, letters (A-Z lower-cased) and everything beyond ASCII; all else separates.
WORD_BYTES = bytes(b + 32 if 65 <= b <= 90 else b if 48 <= b <= 57 or 97 <= b <= 122 or b >= 128 else 32 for b in range(256))


def words_of(text: bytes) -> list[bytes]:
    return text.translate(WORD_BYTES).split()


def word_blocks(text: bytes) -> Iterator[list[bytes]]:
    """The words of a text in blocks, so that a huge text never becomes one list."""
    at = 0
    while at < len(text):
        end = min(at + BLOCK_BYTES, len(text))
        while end < len(text) and WORD_BYTES[text[end]] != 32:
            end += 1
        yield words_of(text[at:end])
        at = end


class SuffixAutomaton:
    """Generalised suffix automaton over sequences of token numbers."""

    def __init__(self, sequences: list[list[int]]):
        self.next: list[dict[int, int]] = [{}]
        self.link, self.length = [-1], [0]
        self.ends: list[set[tuple[int, int]]] = [set()]
        self.whole: list[int] = []
        for number, sequence in enumerate(sequences):
            last = 0
            for at, token in enumerate(sequence):
                last = self._extend(last, token)
                self.ends[last].add((number, at + 1))
            self.whole.append(last)
        for state in sorted(range(1, len(self.next)), key=lambda s: -self.length[s]):
            self.ends[self.link[state]] |= self.ends[state]

    def _state(self, length: int) -> int:
        self.next.append({})
        self.link.append(0)
        self.length.append(length)
        self.ends.append(set())
        return len(self.next) - 1

    def _split(self, parent: int, token: int) -> int:
        """The state for ``parent`` + token with no longer member, made by cloning where needed."""
        target = self.next[parent][token]
        if self.length[target] == self.length[parent] + 1:
            return target
        clone = self._state(self.length[parent] + 1)
        self.next[clone] = dict(self.next[target])
        self.link[clone], self.link[target] = self.link[target], clone
        while parent >= 0 and self.next[parent].get(token) == target:
            self.next[parent][token] = clone
            parent = self.link[parent]
        return clone

    def _extend(self, last: int, token: int) -> int:
        if token in self.next[last]:
            return self._split(last, token)
        made = self._state(self.length[last] + 1)
        while last >= 0 and token not in self.next[last]:
            self.next[last][token] = made
            last = self.link[last]
        self.link[made] = 0 if last < 0 else self._split(last, token)
        return made


class Scanner:
    def __init__(self, templates: list[tuple[str, str]], base: dict[str, str]):
        texts = [words_of(t.encode()) for _, t in templates] + [words_of(p.encode()) for p in base]
        self.labels = [label for label, _ in templates]
        self.base_labels = list(base.values())
        self.sizes = [len(t) for t in texts]
        self.numbers: dict[bytes, int] = {}
        self.automaton = SuffixAutomaton([[self.numbers.setdefault(w, len(self.numbers)) for w in t] for t in texts])
        a, first = self.automaton, len(templates)
        phrase_at = defaultdict(list)
        for k in range(len(base)):
            phrase_at[a.whole[first + k]].append((k, self.sizes[first + k]))
        self.phrases: list[tuple] = [()] * len(a.next)  # base phrases that end in a state
        for state in sorted(range(1, len(a.next)), key=lambda s: a.length[s]):
            self.phrases[state] = (*phrase_at[state], *self.phrases[a.link[state]])
        self.places = [sorted(e for e in ends if e[0] < first) for ends in a.ends]

    def read(self, blocks: Iterable[list[bytes]]) -> tuple[int, list[tuple[int, int]], list[tuple[int, int, int]]]:
        """Number of words, base places (start, phrase) and anchors (start, words, state) of a text."""
        numbers, next_, link, length, phrases = self.numbers, self.automaton.next, self.automaton.link, self.automaton.length, self.phrases
        base, anchors = [], []
        offset, state, run, before = 0, 0, 0, -2
        for words in blocks:
            for i, word in enumerate(words):
                if word not in numbers:
                    continue
                here, token = offset + i, numbers[word]
                if here != before + 1:
                    if run >= MIN_ANCHOR:
                        anchors.append((before - run + 1, run, state))
                    state = run = 0
                elif run and token not in next_[state]:
                    if run >= MIN_ANCHOR:
                        anchors.append((before - run + 1, run, state))
                    while state and token not in next_[state]:
                        state = link[state]
                    run = length[state]
                if token in next_[state]:
                    state, run = next_[state][token], run + 1
                before = here
                for phrase, size in phrases[state]:
                    if run >= size:
                        base.append((here - size + 1, phrase))
            offset += len(words)
        if run >= MIN_ANCHOR:
            anchors.append((before - run + 1, run, state))
        return offset, base, anchors

    def spans(self, anchors: list[tuple[int, int, int]]) -> list[tuple[str, int, int, float]]:
        """(label, first word, last word, share of the template) of the spans that cover enough of a template."""
        by_template: dict[int, list[tuple[int, int, int]]] = defaultdict(list)
        for start, run, state in anchors:
            for template, end in self.places[state]:
                by_template[template].append((start, end - run, run))
        found = []
        for template, pieces in by_template.items():
            best: list[tuple[int, int]] = []  # words covered, first word of the chain
            for i, (start, at, run) in enumerate(pieces):
                score = run, start
                for j in range(i - 1, -1, -1):
                    other_start, other_at, other_run = pieces[j]
                    if start - other_start > MAX_GAP + self.sizes[template]:
                        break
                    over = max(0, other_start + other_run - start, other_at + other_run - at)
                    gap = max(start - other_start - other_run, at - other_at - other_run)
                    if other_start < start and other_at < at and gap <= MAX_GAP and over < run:
                        score = max(score, (best[j][0] + run - over, best[j][1]))
                best.append(score)
                share = score[0] / self.sizes[template]
                if share >= MIN_COVER:
                    found.append((self.labels[template], score[1], start + run - 1, share))
        return sorted(set(found))


def scan_licences(documents: DataFrame, templates: list[tuple[str, str]] | None = None, base: dict[str, str] | None = None) -> DataFrame:
    """One row per row: doc_id, n_words, n_base, first_word, last_word, base_labels, labels, score, spans.

    n_base counts all places of base phrases, first_word and last_word are the smallest and largest start of one
    (null without any). ``spans`` lists label, first and last word and covered share of each template span found;
    ``labels`` joins their labels with the base ones. The score is the largest covered share, a base phrase
    covering itself wholly. A null or empty text has no words, score 0 and empty labels; repeated rows give
    repeated results; an empty table gives none. Texts are read in blocks, words by words; memory holds the
    automaton and the matches of one text. Other columns are not read.
    """
    templates, base = TEMPLATES if templates is None else templates, BASE if base is None else base

    def work(batch: pa.RecordBatch, made=[]) -> dict:
        scanner = made[0] if made else made.append(Scanner(templates, base)) or made[0]
        rows = []
        for text in raw_texts(batch):
            n_words, places, anchors = scanner.read(word_blocks(text))
            spans = scanner.spans(anchors)
            own = {scanner.base_labels[p] for _, p in places}
            starts = [s for s, _ in places]
            rows.append({"n_words": n_words, "n_base": len(places), "first_word": min(starts, default=None), "last_word": max(starts, default=None),
                         "base_labels": ",".join(sorted(own)), "labels": ",".join(sorted(own | {s[0] for s in spans})),
                         "score": max([1.0 if places else 0.0, *(s[3] for s in spans)]),
                         "spans": [dict(zip(("label", "first_word", "last_word", "share"), s)) for s in spans]})
        made_rows = pa.Table.from_pylist(rows, RESULT).to_batches()[0]
        return dict(zip(["doc_id", *RESULT.names], [batch.column("doc_id"), *made_rows.columns]))

    return map_slices(with_text(documents), work, "doc_id long, n_words long, n_base long, first_word long, last_word long, base_labels string, "
                      "labels string, score double, spans array<struct<label:string,first_word:long,last_word:long,share:double>>")


RESULT = pa.schema([("n_words", pa.int64()), ("n_base", pa.int64()), ("first_word", pa.int64()), ("last_word", pa.int64()), ("base_labels", pa.string()),
                    ("labels", pa.string()), ("score", pa.float64()),
                    ("spans", pa.list_(pa.struct([("label", pa.string()), ("first_word", pa.int64()), ("last_word", pa.int64()), ("share", pa.float64())])))])
