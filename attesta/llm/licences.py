"""Licence scans with a generalised suffix automaton.

The words of all licence templates form one suffix automaton. A text's words stream through it: at each word the automaton
holds the longest run, ending there, that occurs in any template (the matching statistics). Runs of at least LEAST
words that cannot grow are matches; matches of one template that follow each other in text and template, with at most GAP
words between, chain into a span. Its score is the share of the template it covers, or the share of the template's telling
words where that is less: those in no template of another licence. So wording that licences share names none of them.

Fixed phrases name licences on their own. A run of LEAST words lies inside template words, so only such stretches are
streamed; array operations over word hashes find them and the phrases.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from attesta.llm.common import query, table
from attesta.llm.wordhash import alphanumeric, buffers, words

LEAST = 4
GAP = 12
COVER = 0.5

# Phrases that name a licence, and the licences' own notices.
PHRASES = {"mit": "mit license", "apache": "apache license", "gpl": "general public license"}
TEMPLATES = (
    ("mit", "Released under the MIT License."),
    ("mit", "Licensed under the MIT License."),
    (
        "mit",
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files, to deal in the Software without restriction, "
        "including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is "
        "furnished to do so, subject to the following conditions: The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software.",
    ),
    (
        "apache",
        "Licensed under the Apache License, Version 2.0 (the License); you may not use this file except in compliance with the License. You may obtain a copy of the License at "
        "http://www.apache.org/licenses/LICENSE-2.0. Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on an AS IS BASIS, WITHOUT "
        "WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. See the License for the specific language governing permissions and limitations under the License.",
    ),
    ("apache", "Licensed under the Apache License, Version 2.0."),
    (
        "gpl",
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation, either version 3 "
        "of the License, or (at your option) any later version. This program is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even the implied warranty of "
        "MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. See the GNU General Public License for more details.",
    ),
    ("gpl", "This work is licensed under the GNU General Public License, version 3."),
    (
        "bsd",
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met: Redistributions of source code must retain "
        "the above copyright notice, this list of conditions and the following disclaimer. Redistributions in binary form must reproduce the above copyright notice, this list of conditions and "
        "the following disclaimer in the documentation and/or other materials provided with the distribution.",
    ),
    (
        "isc",
        "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice "
        "appear in all copies.",
    ),
    ("mpl", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not distributed with this file, You can obtain one at http://mozilla.org/MPL/2.0/."),
    ("cc", "This work is licensed under a Creative Commons Attribution 4.0 International License."),
    ("cc", "Licensed under CC BY 4.0."),
    ("cc", "Licensed under CC BY-SA 4.0."),
    ("cc", "Licensed under CC BY-ND 4.0."),
    ("cc", "Licensed under CC BY-NC 4.0."),
    ("cc", "Licensed under CC BY-NC-SA 4.0."),
    ("cc", "Licensed under CC BY-NC-ND 4.0."),
    ("cc", "Licensed under CC0 1.0 Universal."),
    ("unlicense", "This is free and unencumbered software released into the public domain. Anyone is free to copy, modify, publish, use, compile, sell, or distribute this software."),
)


def hashes_of(text: str) -> np.ndarray:
    return words(*buffers(pa.array([text], pa.string())), is_word=alphanumeric())[0]


class Automaton:
    """A suffix automaton over several word sequences; each state knows where in each template it first ends."""

    def __init__(self, sequences):
        self.next: list[dict] = [{}]
        self.link, self.length, self.ends = [-1], [0], [{}]
        for n, sequence in enumerate(sequences):
            last = 0
            for k, word in enumerate(sequence):
                last = self._extend(last, word)
                self.ends[last].setdefault(n, k)
        # Longer states pass their places on to their suffixes.
        for state in sorted(range(1, len(self.next)), key=lambda s: -self.length[s]):
            up = self.ends[self.link[state]]
            for n, k in self.ends[state].items():
                up[n] = min(k, up.get(n, k))

    def _state(self, length: int, link: int, follow: dict) -> int:
        self.next.append(follow)
        self.link.append(link)
        self.length.append(length)
        self.ends.append({})
        return len(self.next) - 1

    def _split(self, p: int, word, q: int) -> int:
        clone = self._state(self.length[p] + 1, self.link[q], dict(self.next[q]))
        self.link[q] = clone
        while p >= 0 and self.next[p].get(word) == q:
            self.next[p][word] = clone
            p = self.link[p]
        return clone

    def _extend(self, last: int, word) -> int:
        if word in self.next[last]:
            q = self.next[last][word]
            return q if self.length[q] == self.length[last] + 1 else self._split(last, word, q)
        new = self._state(self.length[last] + 1, 0, {})
        p = last
        while p >= 0 and word not in self.next[p]:
            self.next[p][word] = new
            p = self.link[p]
        if p >= 0:
            q = self.next[p][word]
            self.link[new] = q if self.length[q] == self.length[p] + 1 else self._split(p, word, q)
        return new

    def statistics(self, sequence):
        """(state, length) of the longest match that ends at each word."""
        state = length = 0
        for word in sequence:
            while state and word not in self.next[state]:
                state = self.link[state]
                length = self.length[state]
            if word in self.next[state]:
                state = self.next[state][word]
                length += 1
            else:
                length = 0
            yield state, length


@dataclass(frozen=True)
class Span:
    label: str
    start: int
    end: int
    covered: int
    score: float


class Scanner:
    def __init__(self, templates=TEMPLATES, phrases=None):
        sequences = [hashes_of(t).tolist() for _, t in templates]
        self.labels = [label for label, _ in templates]
        self.sizes = [len(s) for s in sequences]
        self.telling = [self._telling(n, sequences) for n in range(len(sequences))]
        self.automaton = Automaton(sequences)
        self.vocabulary = np.unique(np.concatenate([np.array(s, dtype=np.uint64) for s in sequences]))
        self.phrases = [(label, hashes_of(p)) for label, p in sorted((phrases or PHRASES).items())]

    def _telling(self, n: int, sequences) -> list[int]:
        """Telling words of template ``n`` before each of its words and in all; every word where none tells."""
        others = {w for label, s in zip(self.labels, sequences, strict=True) if label != self.labels[n] for w in s}
        tells = [w not in others for w in sequences[n]]
        return [0, *np.cumsum(tells if any(tells) else [True] * len(tells)).tolist()]

    def matches(self, sequence: list[int], first: int):
        """(start, end, state) of the runs of at least LEAST words that cannot grow; places count from ``first``."""
        before = (0, 0)
        for k, now in enumerate([*self.automaton.statistics(sequence), (0, 0)]):
            if before[1] >= LEAST and now[1] != before[1] + 1:
                yield first + k - before[1], first + k, before[0]
            before = now

    def spans(self, found) -> list[Span]:
        """Chains of matches per template, as spans."""
        open_: dict[int, list[int]] = {}
        done: list[Span] = []

        def close(n: int, chain: list[int]):
            done.append(Span(self.labels[n], chain[0], chain[1], chain[3], min(1.0, chain[3] / self.sizes[n], chain[4] / self.telling[n][-1])))

        for start, end, state in found:
            size = end - start
            for n, last in self.automaton.ends[state].items():
                told = lambda words: self.telling[n][last + 1] - self.telling[n][last + 1 - words]  # noqa: B023, E731
                chain = open_.get(n)
                if chain and start <= chain[1] + GAP and last > chain[2]:
                    # Words that the chain already holds, in text or template, count once.
                    fresh = max(0, min(size, end - chain[1], last - chain[2]))
                    open_[n] = [chain[0], end, last, chain[3] + fresh, chain[4] + told(fresh)]
                elif not chain or start > chain[1]:
                    if chain:
                        close(n, chain)
                    open_[n] = [start, end, last, size, told(size)]
        for n, chain in open_.items():
            close(n, chain)
        return done


@cache
def scanner() -> Scanner:
    return Scanner()


def _scan(column: pa.Array, tool: Scanner):
    """Per text: words, places of phrases (label, word) and template spans."""
    n = len(column)
    h, owner = words(*buffers(column), is_word=alphanumeric())
    counts = np.bincount(owner, minlength=n)
    first = np.concatenate([[0], np.cumsum(counts)])
    places: list[list[tuple[str, int]]] = [[] for _ in range(n)]
    for label, phrase in tool.phrases:
        room = len(h) - len(phrase) + 1
        if room <= 0:
            continue
        hit = owner[:room] == owner[len(phrase) - 1 : len(phrase) - 1 + room]
        for k, word in enumerate(phrase):
            hit &= h[k : k + room] == word
        for at in np.flatnonzero(hit).tolist():
            d = int(owner[at])
            places[d].append((label, at - int(first[d])))
    # Stretches of template words inside one text, LEAST words or longer.
    known = np.isin(h, tool.vocabulary)
    joint = known[1:] & known[:-1] & (owner[1:] == owner[:-1])
    edge = np.flatnonzero(np.diff(np.concatenate([[0], joint.view(np.int8), [0]])))
    matches: dict[int, list] = {}
    for a, b in edge.reshape(-1, 2).tolist():
        if b - a + 1 >= LEAST:
            d = int(owner[a])
            matches.setdefault(d, []).extend(tool.matches(h[a : b + 1].tolist(), a - int(first[d])))
    return counts, places, {d: tool.spans(m) for d, m in matches.items()}


def scan(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(id, n_words, places, spans) of every row.

    ``places`` are the fixed phrases (label, word), ``spans`` the chained matches (label, start, end, covered, score), both in
    words from 0. Null and empty texts have no words, places or spans. Each row stands for itself, repeated rows and null ids too. Only the
    two named columns are read, so no other name can clash; empty tables give no rows.
    """
    kind = docs.schema[key].dataType.simpleString()
    place_type = pa.list_(pa.struct([("label", pa.string()), ("word", pa.int64())]))
    span_type = pa.list_(pa.struct([("label", pa.string()), ("start", pa.int64()), ("end", pa.int64()), ("covered", pa.int64()), ("score", pa.float64())]))

    def run(batches):
        tool = scanner()
        for batch in batches:
            counts, places, spans = _scan(batch.column(1), tool)
            place_rows = pa.array([[{"label": x, "word": w} for x, w in p] for p in places], place_type)
            span_rows = pa.array([[vars(s) for s in spans.get(d, ())] for d in range(batch.num_rows)], span_type)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(counts, pa.int64()), place_rows, span_rows], names=["id", "n_words", "places", "spans"])

    schema = f"id {kind}, n_words long, places array<struct<label string, word long>>, spans array<struct<label string, start long, end long, covered long, score double>>"
    return docs.select(F.col(key).alias("id"), F.col(text).alias("text")).mapInArrow(run, schema)


@query("op7_licence_automaton")
def op7_licence_automaton(spark, sf_dir):
    found = scan(table(spark, sf_dir, "documents").select("doc_id", "text"))
    base = F.transform("places", lambda p: p["label"])
    at = F.transform("places", lambda p: p["word"])
    covered = F.transform(F.filter("spans", lambda s: s["score"] >= COVER), lambda s: s["label"])
    joined = lambda labels: F.array_join(F.array_sort(F.array_distinct(labels)), ",")
    score = F.coalesce(F.array_max(F.transform("spans", lambda s: s["score"])), F.lit(0.0))
    return found.select(
        F.col("id").alias("doc_id"), "n_words", F.size("places").cast("long").alias("n_base"), F.array_min(at).alias("first_word"), F.array_max(at).alias("last_word"),
        joined(base).alias("base_labels"), joined(F.concat(base, covered)).alias("labels"), score.alias("score"),
    )
