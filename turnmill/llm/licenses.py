"""License scans: templates with optional and replaceable regions as automata over words.

A template is a text with marks: ``<<optional>> ... <<end>>`` around words that may be
missing (marks nest), and ``<<words:NAME>>`` for any number of words of any kind, at least
one. Such a region ends where the wording after it (up to the next mark) first stands in
full. ``one|other`` is either word. All else is mandatory wording that must stand word by
word. Words are compared in lower case; what stands between words doesn't matter.

Licenses are written out to their last word, so a text whose last clause is altered or
missing has no label. Of the Apache, GPL, MPL and Creative Commons licenses only the notices
that name them are templates; ``bsd`` stands for the licenses of two and of three clauses.

All templates become one automaton. It starts at every word that can begin a template and
runs until no template can go on. What follows from a word and the states reached there is
remembered, so places that wait for the end of a region walk the same words once: the work
is one pass over the words and a few steps at the places that look like a license.

Empty, blank and null texts have no words, no labels and score 0. Texts are judged one by
one, whole; ties, repeated rows and other columns change nothing.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from turnmill.llm.common import bounded_batches, text_blocks

#: Phrases whose places are counted, with their labels.
PHRASES = {"cc by": "cc-by", "general public license": "gpl", "all rights reserved": "reserved"}

#: Wording of public licenses and of the usual one-line notices.
TEMPLATES = {
    "apache-2.0-notice": "licensed under the apache license <<optional>> version 2 0 <<end>>",
    "mit-notice": "released under <<optional>> the terms of <<end>> the mit license",
    "mit-licensed": "licensed under <<optional>> the terms of <<end>> the mit license",
    "cc-by-4.0-notice": "licensed under <<optional>> a creative commons <<end>> cc by 4 0",
    "cc-by-nc-4.0-notice": "licensed under <<optional>> a creative commons <<end>> cc by nc 4 0",
    "cc-by-sa-4.0-notice": "licensed under <<optional>> a creative commons <<end>> cc by sa 4 0",
    "gpl-3.0-notice": """licensed under <<optional>> the terms of <<end>> the gnu general public license
        <<optional>> as published by the free software foundation either <<end>> version 3""",
    "gpl-2.0-notice": """licensed under <<optional>> the terms of <<end>> the gnu general public license
        <<optional>> as published by the free software foundation either <<end>> version 2""",
    "copyright-notice": "copyright <<optional>> c <<end>> <<words:holder>> all rights reserved",
    "mit": """permission is hereby granted free of charge to any person obtaining a copy of this software and
        associated documentation files the software to deal in the software without restriction including without
        limitation the rights to use copy modify merge publish distribute sublicense and or sell copies of the
        software and to permit persons to whom the software is furnished to do so subject to the following
        conditions the above copyright notice and this permission notice <<optional>> including the next paragraph
        <<end>> shall be included in all copies or substantial portions of the software the software is provided as
        is without warranty of any kind express or implied including but not limited to the warranties of
        merchantability fitness for a particular purpose and noninfringement in no event shall
        <<words:holder>> be liable for any claim damages or other liability whether in an action of contract
        tort or otherwise arising from out of or in connection with the software or the use or other dealings in
        the software""",
    "isc": """permission to use copy modify and <<optional>> or <<end>> distribute this software for any purpose with
        or without fee is hereby granted provided that the above copyright notice and this permission notice appear
        in all copies the software is provided as is and <<words:holder>> disclaims all warranties with regard to
        this software including all implied warranties of merchantability and fitness in no event shall
        <<words:holder>> be liable for any special direct indirect or consequential damages or any damages
        whatsoever resulting from loss of use data or profits whether in an action of contract negligence or other
        tortious action arising out of or in connection with the use or performance of this software""",
    "bsd": """redistribution and use in source and binary forms with or without modification are permitted provided
        that the following conditions are met <<optional>> 1 <<end>> redistributions of source code must retain the
        above copyright notice this list of conditions and the following disclaimer <<optional>> 2 <<end>>
        redistributions in binary form must reproduce the above copyright notice this list of conditions and the
        following disclaimer in the documentation and or other materials provided with the distribution
        <<optional>> <<optional>> 3 <<end>> neither the name of <<words:holder>> nor the names of its
        contributors may be used to endorse or promote products derived from this software without specific prior
        written permission <<end>> this software is provided by <<words:provider>> as is and any express or
        implied warranties including but not limited to the implied warranties of merchantability and fitness for a
        particular purpose are disclaimed in no event shall <<words:holder>> be liable for any direct indirect
        incidental special exemplary or consequential damages including but not limited to procurement of
        substitute goods or services loss of use data or profits or business interruption however caused and on any
        theory of liability whether in contract strict liability or tort including negligence or otherwise arising
        in any way out of the use of this software even if advised of the possibility of such damage""",
    "zlib": """this software is provided as is without any express or implied warranty in no event will
        <<words:holder>> be held liable for any damages arising from the use of this software permission is
        granted to anyone to use this software for any purpose including commercial applications and to alter it
        and redistribute it freely subject to the following restrictions <<optional>> 1 <<end>> the origin of this
        software must not be misrepresented you must not claim that you wrote the original software if you use this
        software in a product an acknowledgment|acknowledgement in the product documentation would be appreciated
        but is not required <<optional>> 2 <<end>> altered source versions must be plainly marked as such and must
        not be misrepresented as being the original software <<optional>> 3 <<end>> this notice may not be removed
        or altered from any source distribution""",
    "unlicense": """this is free and unencumbered software released into the public domain anyone is free to copy
        modify publish use compile sell or distribute this software either in source code form or as a compiled
        binary for any purpose commercial or non commercial and by any means in jurisdictions that recognize
        copyright laws the author or authors of this software dedicate any and all copyright interest in the
        software to the public domain we make this dedication for the benefit of the public at large and to the
        detriment of our heirs and successors we intend this dedication to be an overt act of relinquishment in
        perpetuity of all present and future rights to this software under copyright law the software is provided as
        is without warranty of any kind express or implied including but not limited to the warranties of
        merchantability fitness for a particular purpose and noninfringement in no event shall
        <<words:holder>> be liable for any claim damages or other liability whether in an action of contract
        tort or otherwise arising from out of or in connection with the software or the use or other dealings in
        the software <<optional>> for more information please refer to http|https unlicense org <<end>>""",
}

WORD = re.compile(rb"[0-9a-z\x80-\xff]+")
_MARK = re.compile(r"<<(optional|end|words:\w+)>>|([^\s<]+)")
ANY = None
#: Steps of a place after which what follows is remembered; most places end before.
REMEMBER_FROM = 32
RESULT = (
    "struct<n_words: bigint, n_base: bigint, first_word: bigint, last_word: bigint, base_labels: string, "
    "labels: string, score: double, matches: array<struct<label: string, first_word: bigint, last_word: bigint>>>"
)


class Automaton:
    """All templates in one: state 0 begins, ``steps[state]`` maps a word (None: any) to states."""

    def __init__(self, templates: dict[str, str]):
        self.steps: list[list[tuple[bytes | None, int]]] = [[]]
        self.silent: list[list[int]] = [[]]
        self.accepts: dict[int, str] = {}
        self.closes: dict[int, set[int]] = {}  # at the end of the wording after a region: the region's state
        for label, template in templates.items():
            start = self._state()
            self.silent[0].append(start)
            self.accepts[self._compile(template, start)] = label
        self.start = self._closed({0})
        if any(word is ANY for s in self.start for word, _ in self.steps[s]) or self.start & self.accepts.keys():
            raise ValueError("a template must begin with mandatory wording")
        self.first_words = sorted({word for s in self.start for word, _ in self.steps[s]})
        self.known = {word for step in self.steps for word, _ in step if word is not ANY}
        self.next = lru_cache(maxsize=100_000)(self._next)

    def _state(self) -> int:
        self.steps.append([])
        self.silent.append([])
        return len(self.steps) - 1

    def _compile(self, template: str, at: int) -> int:
        opened, region, out = [], set(), None
        for kind, word in [*_MARK.findall(template), ("", "")]:
            if word:
                either = word.encode().lower().split(b"|")
                for parts in [either] if len(either) > 1 else [[p] for p in WORD.findall(either[0])]:
                    new = self._state()
                    self.steps[at] += [(part, new) for part in parts]
                    at = new
                continue
            if region and at != out:
                self.closes[at], region = region, set()
            if kind == "optional":
                opened.append(at)
            elif kind == "end":
                new = self._state()
                self.silent[at].append(new)
                self.silent[opened.pop()].append(new)
                at = new
            elif kind:
                new, out = self._state(), self._state()
                region.add(new)
                self.steps[at].append((ANY, new))
                self.steps[new].append((ANY, new))
                self.silent[new].append(out)
                at = out
        if opened:
            raise ValueError("an optional region isn't closed")
        return at

    def _closed(self, states: set[int]) -> frozenset[int]:
        todo, seen = list(states), set(states)
        while todo:
            for s in self.silent[todo.pop()]:
                if s not in seen:
                    seen.add(s)
                    todo.append(s)
        return frozenset(seen)

    def _next(self, states: frozenset[int], word: bytes | None) -> tuple[frozenset[int], tuple[str, ...]]:
        """The states after a word (None: one that no template names), and the labels accepted there."""
        after = self._closed({to for s in states for w, to in self.steps[s] if w is ANY or w == word})
        for s in after & self.closes.keys():
            after -= self.closes[s]
        return after, tuple(self.accepts[s] for s in after if s in self.accepts)

    def matches(self, words: Iterator[tuple[int, bytes]], walked: dict) -> dict[str, int]:
        """Labels of the templates that match from the first word on, with the place where each ends (the last).

        ``words`` are (place, word); ``walked`` remembers what follows from a place and states.
        """
        states, path = self.start, []
        found: dict[str, int] = {}
        for place, word in words:
            key = (place, states)
            if key in walked:
                found = walked[key]
                break
            states, labels = self.next(states, word if word in self.known else None)
            path.append((key, place, labels))
            if not states:
                break
        # Backwards: what follows from each step is what it finds, but for labels found later.
        for n in range(len(path) - 1, -1, -1):
            key, place, labels = path[n]
            new = {label: place for label in labels if label not in found}
            if new:
                found = found | new
            if n >= REMEMBER_FROM:
                walked[key] = found
        return found


def scanner(templates: dict[str, str], phrases: dict[str, str]):
    """A function from a string column to result rows."""
    base = {f"\0{label}": phrase for phrase, label in phrases.items()}  # may share labels with templates
    automaton = Automaton(base | templates)
    edge = rb"[0-9a-z\x80-\xff]"
    anchor = re.compile(
        b"(?<!" + edge + b")(?:" + b"|".join(map(re.escape, automaton.first_words)) + b")(?!" + edge + b")"
    )
    inside = np.zeros(256, dtype=np.int8)
    inside[[*range(0x30, 0x3A), *range(0x61, 0x7B), *range(0x80, 0x100)]] = 1

    def scan(column: pa.Array) -> list[dict]:
        blob, ends = text_blocks(column)
        blob = blob.lower()  # of bytes: A-Z only
        # A word never runs over the edge of a text.
        flags = inside[np.frombuffer(blob, dtype=np.uint8)]
        opens = flags.copy()
        opens[1:] &= 1 - flags[:-1]
        edges = np.array([e for e in ends[:-1] if e < len(blob)], dtype=np.int64)
        opens[edges] = flags[edges]
        starts = np.flatnonzero(opens)
        first = np.searchsorted(starts, ends)
        out = []
        for i in range(len(ends) - 1):
            lo, hi = ends[i], ends[i + 1]
            n = int(first[i + 1] - first[i])
            places, labels, spans = [], set(), []
            text = blob[lo:hi]
            walked: dict = {}
            for begin in reversed([m.start() for m in anchor.finditer(text)]):
                found = automaton.matches(((x.start(), x[0]) for x in WORD.finditer(text, begin)), walked)
                if found:
                    number = lambda place: int(np.searchsorted(starts, lo + place) - first[i])  # noqa: E731, B023
                    at = number(begin)
                    for label, end in found.items():
                        if label[0] == "\0":
                            places.append((at, label[1:]))
                        labels.add(label.removeprefix("\0"))
                        spans.append((label.removeprefix("\0"), at, number(end)))
            spans.reverse()
            covered = 0
            reach = -1
            for _, a, b in sorted(spans, key=lambda s: s[1]):
                covered += max(0, b - max(a, reach + 1) + 1)
                reach = max(reach, b)
            out.append(
                {
                    "n_words": n, "n_base": len(places),
                    "first_word": min((p for p, _ in places), default=None),
                    "last_word": max((p for p, _ in places), default=None),
                    "base_labels": ",".join(sorted({x for _, x in places})), "labels": ",".join(sorted(labels)),
                    "score": covered / n if n else 0.0,
                    "matches": [{"label": x, "first_word": a, "last_word": b} for x, a, b in spans],
                }
            )
        return out

    return scan


def scan_licenses(
    df: DataFrame, text: str = "text", templates: dict[str, str] = TEMPLATES, phrases: dict[str, str] = PHRASES,
    into: str = "license",
) -> DataFrame:
    """``df`` with one struct ``into``: word count, base places, labels, score and all matches.

    A column that has this name already is replaced; all others pass unread.
    ``score`` is the share of the words that lie inside a match. Words count from 0.
    """
    match = pa.list_(pa.struct([("label", pa.string()), ("first_word", pa.int64()), ("last_word", pa.int64())]))
    whole = pa.int64()
    kind = pa.struct(
        [("n_words", whole), ("n_base", whole), ("first_word", whole), ("last_word", whole),
         ("base_labels", pa.string()), ("labels", pa.string()), ("score", pa.float64()), ("matches", match)]
    )

    @F.arrow_udf(RESULT)
    def scan(columns: Iterator[pa.Array]) -> Iterator[pa.Array]:
        run = scanner(templates, phrases)
        for column in columns:
            yield pa.array(run(column), kind)

    return bounded_batches(df).withColumn(into, scan(F.col(text)))

