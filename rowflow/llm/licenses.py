"""Licence scans with a generalised suffix automaton over the words of licence texts.

Words are lower-cased ASCII letters and digits and everything beyond ASCII.  The automaton
holds every run of words of every template.  A document is streamed through it once: after each word the
automaton knows the longest run ending there that some template contains (the matching statistics), and its suffix links
lead to the longest run that each other template contains.  Runs of at least ``LEAST`` words that cannot be extended
in a template are placed there and chained: a chain goes forward in the document and in one template, with at most ``GAP`` words skipped in the document between two runs.  Its
coverage is the share of the template's words it holds; a chain of at least ``COVERED`` names the template's label.

Besides, a few fixed phrases name a label wherever they stand.

Defined results: a null or empty text has no words, no labels and score 0.  Repeated rows are scanned by
themselves; ids may be null.  Columns of the table are carried along whatever their names.
"""

from __future__ import annotations

from bisect import bisect_left
from collections.abc import Iterable, Iterator, Mapping
from dataclasses import dataclass, field

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import add_columns, bare_words, utf8

LEAST = 4
GAP = 40
COVERED = 0.8

# Phrases and the labels they name.
PHRASES: dict[tuple[bytes, ...], str] = {
    (b"mit", b"license"): "mit",
    (b"apache", b"license"): "apache",
    (b"general", b"public", b"license"): "gpl",
}

# Public licence texts and notices, as (label, text).
TEMPLATES: tuple[tuple[str, str], ...] = (
    (
        "mit",
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated "
        "documentation files (the Software), to deal in the Software without restriction, including without limitation "
        "the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and "
        "to permit persons to whom the Software is furnished to do so, subject to the following conditions: The above "
        "copyright notice and this permission notice shall be included in all copies or substantial portions of the Software. "
        "THE SOFTWARE IS PROVIDED AS IS, WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE "
        "WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR "
        "COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR "
        "OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE.",
    ),
    ("mit", "Released under the MIT License"),
    ("mit", "Licensed under the MIT License"),
    (
        "apache",
        "Licensed under the Apache License, Version 2.0 (the License); you may not use this file except in compliance with the "
        "License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0 Unless required by "
        "applicable law or agreed to in writing, software distributed under the License is distributed on an AS IS BASIS, "
        "WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. See the License for the specific language "
        "governing permissions and limitations under the License.",
    ),
    ("apache", "Licensed under the Apache License, Version 2.0"),
    (
        "gpl",
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public "
        "License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later "
        "version. This program is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even the "
        "implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. See the GNU General Public License for more "
        "details. You should have received a copy of the GNU General Public License along with this program.",
    ),
    ("gpl", "licensed under the GNU General Public License"),
    ("gpl", "licensed under the GNU General Public License, version 2"),
    ("gpl", "licensed under the GNU General Public License, version 3"),
    (
        "bsd",
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the "
        "following conditions are met: 1. Redistributions of source code must retain the above copyright notice, this list of "
        "conditions and the following disclaimer. 2. Redistributions in binary form must reproduce the above copyright notice, "
        "this list of conditions and the following disclaimer in the documentation and/or other materials provided with the "
        "distribution. THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS AS IS AND ANY EXPRESS OR IMPLIED "
        "WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR "
        "PURPOSE ARE DISCLAIMED.",
    ),
    (
        "isc",
        "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby "
        "granted, provided that the above copyright notice and this permission notice appear in all copies.",
    ),
    (
        "mpl",
        "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not "
        "distributed with this file, You can obtain one at https://mozilla.org/MPL/2.0/.",
    ),
    ("cc-by", "Licensed under CC BY 4.0"),
    ("cc-by-sa", "Licensed under CC BY SA 4.0"),
    ("cc-by-nc", "Licensed under CC BY NC 4.0"),
    ("cc-by", "licensed under a Creative Commons Attribution 4.0 International License"),
    ("cc0", "dedicated to the public domain under CC0 1.0"),
)


# -- automaton -----------------------------------------------------------------------


@dataclass
class State:
    """Runs of words with the same ends: the longest has ``length`` words."""

    length: int
    link: int
    step: dict[int, int] = field(default_factory=dict)
    ends: list[tuple[int, int]] = field(default_factory=list)  # (template, place of the last word)


class SuffixAutomaton:
    """All runs of words of several texts."""

    def __init__(self, texts: Iterable[list[bytes]]):
        self.texts = [list(t) for t in texts]
        self.numbers: dict[bytes, int] = {}
        self.states = [State(0, -1)]
        for k, text in enumerate(self.texts):
            last = 0
            for place, word in enumerate(text):
                last = self._extend(last, self.numbers.setdefault(word, len(self.numbers)))
                self.states[last].ends.append((k, place))
        # A run ends wherever a longer run that it is the end of does.
        for s in sorted(range(1, len(self.states)), key=lambda s: -self.states[s].length):
            if self.states[s].link > 0:
                self.states[self.states[s].link].ends += self.states[s].ends
        self.placed: list[dict[int, list[int]]] = [{} for _ in self.states]  # per state: places of the last word by template
        for state, placed in zip(self.states, self.placed, strict=True):
            for k, place in state.ends:
                placed.setdefault(k, []).append(place)
        # The longest shorter run that more templates hold.
        self.wider = [0] * len(self.states)
        for s in sorted(range(1, len(self.states)), key=lambda s: self.states[s].length):
            link = self.states[s].link
            self.wider[s] = link if len(self.placed[link]) > len(self.placed[s]) else self.wider[link]

    def _split(self, p: int, q: int, letter: int) -> int:
        """Give the runs that end at ``p`` plus ``letter`` a state of their own, apart from the longer ones of ``q``."""
        old = self.states[q]
        self.states.append(State(self.states[p].length + 1, old.link, dict(old.step)))
        new = len(self.states) - 1
        old.link = new
        while p >= 0 and self.states[p].step.get(letter) == q:
            self.states[p].step[letter] = new
            p = self.states[p].link
        return new

    def _extend(self, last: int, letter: int) -> int:
        states = self.states
        q = states[last].step.get(letter)
        if q is not None:  # an earlier text has this run
            return q if states[q].length == states[last].length + 1 else self._split(last, q, letter)
        states.append(State(states[last].length + 1, 0))
        new, p = len(states) - 1, last
        while p >= 0 and letter not in states[p].step:
            states[p].step[letter] = new
            p = states[p].link
        if p >= 0:
            q = states[p].step[letter]
            states[new].link = q if states[q].length == states[p].length + 1 else self._split(p, q, letter)
        return new

    def _walk(self, words: list[bytes]) -> Iterator[tuple[int, int]]:
        """After each word: the longest run that ends there, as its state and length."""
        get, states = self.numbers.get, self.states
        steps = [s.step for s in states]
        at = length = 0
        for word in words:
            letter = get(word)
            if letter is None:
                at = length = 0
            else:
                while at > 0 and letter not in steps[at]:
                    at = states[at].link
                    length = states[at].length
                if letter in steps[at]:
                    at = steps[at][letter]
                    length += 1
            yield at, length

    def matches(self, words: list[bytes], least: int = 1) -> list[tuple[int, int, int]]:
        """Runs of at least ``least`` words that no following word extends in any template: (last place, length, state)."""
        found, before, held = [], 0, 0
        for place, (at, length) in enumerate(self._walk(words)):
            if held >= least and length != held + 1:
                found.append((place - 1, held, before))
            before, held = at, length
        if held >= least:
            found.append((len(words) - 1, held, before))
        return found

    def _holders(self, at: int, length: int, least: int) -> dict[int, tuple[int, int]]:
        """The longest run that ends here in each template that has one of at least ``least`` words: length and state."""
        held: dict[int, tuple[int, int]] = {}
        while at > 0 and length >= least:
            for template in self.placed[at]:
                held.setdefault(template, (length, at))
            at = self.wider[at]
            length = self.states[at].length
        return held

    def template_matches(self, words: list[bytes], least: int = 1) -> list[tuple[int, int, int, int]]:
        """Runs of at least ``least`` words that no following word extends in their template: (last place, length, state, template)."""
        found: list[tuple[int, int, int, int]] = []
        held: dict[int, tuple[int, int]] = {}
        for place, (at, length) in enumerate(self._walk(words)):
            if held or length >= least:
                now = self._holders(at, length, least)
                for template, (n, state) in held.items():
                    if template not in now or now[template][0] != n + 1:
                        found.append((place - 1, n, state, template))
                held = now
        return found + [(len(words) - 1, n, state, template) for template, (n, state) in held.items()]


# -- chains --------------------------------------------------------------------------


@dataclass(frozen=True)
class Span:
    """A chain: words ``start`` to ``stop`` (exclusive) of the document hold ``coverage`` of a template."""

    template: int
    start: int
    stop: int
    coverage: float


def chain(matches: list[tuple[int, int, int, int]], automaton: SuffixAutomaton, gap: int = GAP) -> list[Span]:
    """The best chain for every last run that no better chain goes on from, template by template."""
    by_template: dict[int, list[tuple[int, int, int]]] = {}
    for last, length, state, template in matches:
        placed = [(last - length + 1, end - length + 1, length) for end in automaton.placed[state][template]]
        by_template.setdefault(template, []).extend(placed)
    spans = []
    for template, runs in by_template.items():
        runs.sort()
        starts = [r[0] for r in runs]
        longest = max(r[2] for r in runs)
        held = [r[2] for r in runs]  # template words in the best chain up to a run
        begun = [r[0] for r in runs]
        extended = [False] * len(runs)
        for k, (doc, place, length) in enumerate(runs):
            best = -1
            for j in range(bisect_left(starts, doc - gap - longest), k):
                d, p, n = runs[j]
                over = max(0, d + n - doc, p + n - place)  # words that both runs hold count once
                if d < doc and p < place and over < length and doc - (d + n) <= gap and held[j] + length - over > held[k]:
                    held[k], begun[k], best = held[j] + length - over, begun[j], j
            if best >= 0:
                extended[best] = True
        size = len(automaton.texts[template])
        spans += [
            Span(template, begun[k], doc + length, min(1.0, held[k] / size))
            for k, (doc, _, length) in enumerate(runs)
            if not extended[k]
        ]
    return spans


def phrase_places(words: list[bytes], phrases: Mapping[tuple[bytes, ...], str] = PHRASES) -> list[tuple[int, str]]:
    """First places and labels of the fixed phrases."""
    found = []
    ends = {p[-1] for p in phrases}
    for k in [k for k, w in enumerate(words) if w in ends]:
        for phrase, label in phrases.items():
            first = k - len(phrase) + 1
            if first >= 0 and tuple(words[first : k + 1]) == phrase:
                found.append((first, label))
    return found


# -- the operator --------------------------------------------------------------------

_SPAN = T.StructType().add("label", "string").add("start", "long").add("stop", "long").add("coverage", "double")
SCANNED = (
    T.StructType().add("n_words", "long").add("n_base", "long").add("first_word", "long").add("last_word", "long")
    .add("base_labels", "string").add("labels", "string").add("score", "double").add("spans", T.ArrayType(_SPAN))
)
_SPAN_ARROW = pa.list_(pa.struct([("label", pa.string()), ("start", pa.int64()), ("stop", pa.int64()), ("coverage", pa.float64())]))
_ARROW = [*[pa.int64()] * 4, pa.string(), pa.string(), pa.float64(), _SPAN_ARROW]


def scan(words: list[bytes], automaton: SuffixAutomaton, labels: list[str], least: int = LEAST, gap: int = GAP, covered: float = COVERED) -> tuple:
    """The columns of ``SCANNED`` for one text."""
    base = phrase_places(words)
    found = chain(automaton.template_matches(words, least), automaton, gap)
    whole = [s for s in found if s.coverage >= covered]
    names = {label for _, label in base}
    places = [k for k, _ in base]
    spans = [{"label": labels[s.template], "start": s.start, "stop": s.stop, "coverage": s.coverage} for s in whole]
    return (
        len(words),
        len(base),
        min(places, default=None),
        max(places, default=None),
        ",".join(sorted(names)),
        ",".join(sorted(names | {labels[s.template] for s in whole})),
        max([s.coverage for s in found], default=0.0),
        sorted(spans, key=lambda s: (s["start"], s["stop"], s["label"], s["coverage"])),
    )


_BUILT: dict[tuple[tuple[str, str], ...], SuffixAutomaton] = {}


def scan_licenses(docs: DataFrame, key: str = "doc_id", text: str = "text", templates: tuple[tuple[str, str], ...] = TEMPLATES) -> DataFrame:
    """Per document: key, phrases found, labels, the best coverage, and the spans of covered templates."""
    labels = [label for label, _ in templates]

    def run(batch: pa.RecordBatch) -> list[pa.Array]:
        if templates not in _BUILT:
            _BUILT.clear()
            _BUILT[templates] = SuffixAutomaton(bare_words(t.encode()) for _, t in templates)
        automaton = _BUILT[templates]
        texts = batch.column(batch.schema.get_field_index("__text"))
        rows = [scan(bare_words(t.as_py()), automaton, labels) for t in texts]
        columns = zip(*rows, strict=True) if rows else [[] for _ in _ARROW]
        return [pa.array(c, t) for c, t in zip(columns, _ARROW, strict=True)]

    return add_columns(docs.select(F.col(key), utf8(text).alias("__text")), ["__text"], SCANNED, run)
