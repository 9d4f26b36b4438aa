"""Licence texts by a generalised suffix automaton of their words.

All templates, long notices, one-line grants and fixed phrases alike, make one automaton over word ids. A text streams through it once and
gets matching statistics: for each word the longest stretch ending there that some template holds. A match that the next word does not lengthen is long
enough from ``LEAST`` words on; per template such matches are chained, in the order of the text and of the template, over gaps of at most ``GAP``
words, and a chain that covers ``COVER`` of the template, or all of one with fewer than ``SHORT`` words, is a span. Fixed phrases are read off the same statistics: a phrase stands wherever its
state is at or above the current one in the tree of suffix links and no longer than the match, so no place is lost.

Words that no template holds, or that no template holds next to their neighbour, end every match: a batch looks for neighbouring pairs as arrays and only
stretches of known pairs go through the automaton. Templates are bounded (``TEMPLATES``, some 700 words), so the automaton travels with the task.

Defined cases: null text is empty and has neither words nor labels; null ids and repeated rows are handled like any other; texts of any length are read
whole; an empty table gives an empty result; other columns are not read.
"""

from __future__ import annotations

import re
from bisect import bisect_left
from collections import defaultdict
from itertools import repeat

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from facetlake.llm.text import id_text, map_texts

LEAST, GAP, COVER, SHORT = 3, 12, 0.8, 15
_WORD = re.compile(rb"[0-9a-z\x80-\xff]+")  # of lower-cased UTF-8: every byte of a character beyond ASCII is 0x80 or more

# Phrases and their labels.
PHRASES = {"cc by": "cc-by", "general public license": "gpl", "all rights reserved": "reserved"}

# Public licence notices and the sentences by which works name their licence.
TEMPLATES = [
    ("mit", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the \"Software\"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions: The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software."),
    ("mit", "Released under the MIT License."),
    ("mit", "Licensed under the MIT License."),
    ("isc", "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies."),
    ("bsd", "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met: Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer. Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the documentation and/or other materials provided with the distribution."),
    ("bsd", "Use of this source code is governed by a BSD-style license that can be found in the LICENSE file."),
    ("apache-2.0", "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in compliance with the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0 Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on an \"AS IS\" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. See the License for the specific language governing permissions and limitations under the License."),
    ("apache-2.0", "Licensed under the Apache License, Version 2.0."),
    ("gpl-2.0", "This program is free software; you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation; either version 2 of the License, or (at your option) any later version."),
    ("gpl-3.0", "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version."),
    ("gpl-3.0", "This work is licensed under the GNU General Public License, version 3."),
    ("gpl-2.0", "This work is licensed under the GNU General Public License, version 2."),
    ("lgpl-2.1", "This library is free software; you can redistribute it and/or modify it under the terms of the GNU Lesser General Public License as published by the Free Software Foundation; either version 2.1 of the License, or (at your option) any later version."),
    ("agpl-3.0", "This program is free software: you can redistribute it and/or modify it under the terms of the GNU Affero General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version."),
    ("mpl-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not distributed with this file, You can obtain one at https://mozilla.org/MPL/2.0/."),
    ("unlicense", "This is free and unencumbered software released into the public domain. Anyone is free to copy, modify, publish, use, compile, sell, or distribute this software, either in source code form or as a compiled binary, for any purpose, commercial or non-commercial, and by any means."),
    ("zlib", "Permission is granted to anyone to use this software for any purpose, including commercial applications, and to alter it and redistribute it freely, subject to the following restrictions: The origin of this software must not be misrepresented; you must not claim that you wrote the original software."),
    ("cc-by-4.0", "This work is licensed under a Creative Commons Attribution 4.0 International License."),
    ("cc-by-4.0", "Licensed under CC BY 4.0."),
    ("cc-by-sa-4.0", "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License."),
    ("cc-by-sa-4.0", "Licensed under CC BY-SA 4.0."),
    ("cc-by-nc-4.0", "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License."),
    ("cc-by-nc-4.0", "Licensed under CC BY-NC 4.0."),
    ("cc-by-nd-4.0", "Licensed under CC BY-ND 4.0."),
]


def words_of(text: str) -> list[bytes]:
    return _WORD.findall(text.encode().lower())


class Automaton:
    """The smallest automaton of all substrings of several word sequences, and where each of its states ends in them."""

    def __init__(self, sequences: list[list[int]]):
        self.step: list[dict[int, int]] = [{}]
        self.link, self.length = [-1], [0]
        ends: list[set[tuple[int, int]]] = [set()]
        for number, sequence in enumerate(sequences):
            last = 0
            for at, word in enumerate(sequence):
                last = self._add(last, word)
                while len(ends) < len(self.length):
                    ends.append(set())
                ends[last].add((number, at + 1))
        for state in sorted(range(1, len(self.length)), key=lambda s: -self.length[s]):
            if self.link[state] > 0:
                ends[self.link[state]] |= ends[state]
        self.ends = [sorted(e) for e in ends]

    def _add(self, last: int, word: int) -> int:
        known = self.step[last].get(word)
        if known is not None:
            return known if self.length[known] == self.length[last] + 1 else self._split(last, word, known)
        new = self._state(self.length[last] + 1, {}, 0)
        at = last
        while at >= 0 and word not in self.step[at]:
            self.step[at][word] = new
            at = self.link[at]
        if at >= 0:
            to = self.step[at][word]
            self.link[new] = to if self.length[to] == self.length[at] + 1 else self._split(at, word, to)
        return new

    def _state(self, length: int, step: dict[int, int], link: int) -> int:
        self.length.append(length)
        self.step.append(step)
        self.link.append(link)
        return len(self.length) - 1

    def _split(self, at: int, word: int, old: int) -> int:
        """The part of ``old`` whose strings are no longer than those of ``at`` and the word, as a state of its own."""
        new = self._state(self.length[at] + 1, dict(self.step[old]), self.link[old])
        self.link[old] = new
        while at >= 0 and self.step[at].get(word) == old:
            self.step[at][word] = new
            at = self.link[at]
        return new

    def state_of(self, sequence: list[int]) -> int:
        at = 0
        for word in sequence:
            at = self.step[at][word]
        return at

    def statistics(self, words: list[int]) -> tuple[list[int], list[int]]:
        """For each word the state and the length of the longest match that ends with it."""
        states, lengths, at, n = [], [], 0, 0
        step, link, length = self.step, self.link, self.length
        for word in words:
            while at and word not in step[at]:
                at = link[at]
                n = length[at]
            to = step[at].get(word)
            at, n = (0, 0) if to is None else (to, n + 1)
            states.append(at)
            lengths.append(n)
        return states, lengths


class Scanner:
    """Templates and phrases made ready: vocabulary, automaton, the phrases of each state, the pairs that templates hold."""

    def __init__(self, templates: list[tuple[str, str]] = TEMPLATES, phrases: dict[str, str] = PHRASES):
        texts = [words_of(t) for _, t in templates] + [words_of(p) for p in phrases]
        self.vocabulary: dict[bytes, int] = {}
        sequences = [[self.vocabulary.setdefault(w, len(self.vocabulary)) for w in t] for t in texts]
        self.labels, self.phrase_labels = [label for label, _ in templates], list(phrases.values())
        self.sizes = [len(s) for s in sequences]
        self.least = [COVER * n if n >= SHORT else n for n in self.sizes]  # covered words that make a span
        self.automaton = Automaton(sequences)
        size = len(self.vocabulary) + 1  # the last number is any other word
        self.pair = np.zeros((size, size), bool)
        for s in sequences:
            self.pair[s[:-1], s[1:]] = True
        home = defaultdict(list)
        for k, s in enumerate(sequences[len(templates) :]):
            home[self.automaton.state_of(s)].append((len(s), k))
        self.phrases: list[list[tuple[int, int]]] = [[] for _ in self.automaton.length]  # of a state and its suffixes
        for state in sorted(range(len(self.automaton.length)), key=self.automaton.length.__getitem__):
            self.phrases[state] = home[state] + (self.phrases[self.automaton.link[state]] if state else [])
        self.single = {s[0]: k for k, s in enumerate(sequences[len(templates) :]) if len(s) == 1}

    def numbers(self, words: list[bytes]) -> np.ndarray:
        return np.fromiter(map(self.vocabulary.get, words, repeat(len(self.vocabulary))), np.int64, len(words))

    def scan(self, numbers: np.ndarray) -> tuple[list[tuple[int, int]], list[tuple[int, int, int, int]]]:
        """Places of phrases as (start, phrase), and long matches as (end, length, state) that no further word lengthens."""
        places, matches = [], []
        for number, k in self.single.items():
            places += [(i, k) for i in np.flatnonzero(numbers == number).tolist()]
        known = np.flatnonzero(self.pair[numbers[:-1], numbers[1:]]) if len(numbers) > 1 else numbers[:0]
        if not len(known):
            return sorted(places), matches
        cut = np.flatnonzero(np.diff(known) > 1) + 1
        for part in np.split(known, cut):
            first = int(part[0])
            states, lengths = self.automaton.statistics(numbers[first : int(part[-1]) + 2].tolist())
            for i, (state, n) in enumerate(zip(states, lengths)):
                for size, k in self.phrases[state]:
                    if 1 < size <= n:
                        places.append((first + i + 1 - size, k))
                if n >= LEAST and (i + 1 == len(lengths) or lengths[i + 1] <= n):
                    matches.append((first + i + 1, n, state))
        return sorted(places), matches

    def chains(self, matches: list[tuple[int, int, int]]) -> list[tuple[int, int, int, int]]:
        """Spans as (start, end, template, covered words): for each template the best chains that share no word of the text."""
        by_template: dict[int, list[tuple[int, int, int]]] = defaultdict(list)
        for end, n, state in matches:
            for k, at in self.automaton.ends[state]:
                if k < len(self.labels):
                    by_template[k].append((end, at, n))
        out = []
        for k, items in by_template.items():
            if sum(n for _, _, n in items) < self.least[k]:
                continue
            # best[i]: words covered by the best chain that ends with item i, and its start in the text
            items.sort()
            best: list[tuple[int, int]] = []
            low = 0
            for i, (end, at, n) in enumerate(items):
                while items[low][0] < end - n - GAP:
                    low += 1
                chosen = (n, end - n)
                for j in range(low, i):
                    before, place, _ = items[j]
                    new = min(n, end - before, at - place)  # words that match j has not covered, in the text and in the template
                    if new > 0 and at - n - place <= GAP and (best[j][0] + new, best[j][1]) > chosen:
                        chosen = (best[j][0] + new, best[j][1])
                best.append(chosen)
            ranked = sorted(((c, -s, e) for (c, s), (e, _, _) in zip(best, items) if c >= self.least[k]), reverse=True)
            taken: list[tuple[int, int]] = []  # disjoint, in order
            for covered, start, end in ranked:
                start = -start
                at = bisect_left(taken, (start, end))
                if (not at or taken[at - 1][1] <= start) and (at == len(taken) or end <= taken[at][0]):
                    taken.insert(at, (start, end))
                    out.append((start, end, k, covered))
        return sorted(out)


SCHEMA = "doc_id long, n_words long, phrases array<struct<start:long,label:string>>, spans array<struct<start:long,end:long,label:string,covered:long,share:double>>"


def scan_licenses(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", templates: list[tuple[str, str]] | None = None) -> DataFrame:
    """One row for each document: places of fixed phrases, and template spans with the share of the template they cover."""
    scanner = Scanner(templates or TEMPLATES)

    def work(ids: list, texts: list) -> dict:
        out: dict[str, list] = {"doc_id": ids, "n_words": [], "phrases": [], "spans": []}
        for text in texts:
            words = words_of(text)
            places, matches = scanner.scan(scanner.numbers(words))
            out["n_words"].append(len(words))
            out["phrases"].append([{"start": i, "label": scanner.phrase_labels[k]} for i, k in places])
            out["spans"].append([{"start": a, "end": b, "label": scanner.labels[k], "covered": c, "share": min(1.0, c / scanner.sizes[k])} for a, b, k, c in scanner.chains(matches)] if matches else [])
        return out

    return map_texts(id_text(docs, id_col, text_col), work, SCHEMA)


def digest(scans: DataFrame) -> DataFrame:
    """Counts, first and last word and labels of each document's scan; the score is the largest share of any template, 1 where a phrase stands."""
    starts, spans = F.col("phrases.start"), F.col("spans")
    joined = lambda labels: F.array_join(F.array_sort(F.array_distinct(labels)), ",")
    return scans.select(
        "doc_id",
        "n_words",
        F.size("phrases").cast("long").alias("n_base"),
        F.array_min(starts).alias("first_word"),
        F.array_max(starts).alias("last_word"),
        joined(F.col("phrases.label")).alias("base_labels"),
        joined(F.concat(F.col("phrases.label"), F.col("spans.label"))).alias("labels"),
        F.when(F.size("phrases") > 0, 1.0).otherwise(F.coalesce(F.array_max(F.col("spans.share")), F.lit(0.0))).alias("score"),
        F.size(spans).cast("long").alias("n_spans"),
    )
