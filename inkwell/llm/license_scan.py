"""License scans by template markup.

A template is the wording of a licence or of a notice that refers to one. Markup in it names regions that a text may
leave out (``<<beginOptional>> ... <<endOptional>>``, nested if need be) and regions where a text has words of its
own (``<<var;words="1-20">>``: that many words, whatever they are). All other wording is mandatory. Each
template is compiled into an automaton over tokens; a place in a text matches if the automaton accepts the words
from there on, which is if the mandatory wording stands there exactly, in order and without other words in between.

The automaton is non-deterministic; a worker makes it deterministic as it reads (sets of its states, remembered), so
a word costs one look-up. It starts only where a template can start, in texts that hold all the template's
mandatory words.
"""

from __future__ import annotations

import re
from dataclasses import dataclass, field

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from inkwell.llm.common import small_batches, text_or_empty
from inkwell.llm.words import LOWER

WORD = re.compile(rb"[0-9a-z\x80-\xff]+")  # after lower-casing A-Z
MARKUP = re.compile(r'<<(beginOptional|endOptional|var;words="(\d+)-(\d+)")>>')
REMEMBERED = 50_000  # transitions that a worker keeps for a template

# fixed values: phrases that refer to a licence, with their labels
PHRASES = (("mit", "under the mit license"), ("apache-2", "apache license version 2"), ("cc-by-nc", "cc by nc"))

# fixed values: wordings of public licences and of the notices that name them
_CONDITIONS = """
Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following
conditions are met: <<var;words="0-1">> Redistributions of source code must retain the above copyright notice, this list of
conditions and the following disclaimer. <<var;words="0-1">> Redistributions in binary form must reproduce the above copyright
notice, this list of conditions and the following disclaimer in the documentation and/or other materials provided with the
distribution. """
_DISCLAIMER = """
This software is provided by <<var;words="1-20">> "as is" and any express or implied warranties, including, but not limited to,
the implied warranties of merchantability and fitness for a particular purpose are disclaimed. In no event shall
<<var;words="1-20">> be liable for any direct, indirect, incidental, special, exemplary, or consequential damages (including,
but not limited to, procurement of substitute goods or services; loss of use, data, or profits; or business interruption)
however caused and on any theory of liability, whether in contract, strict liability, or tort (including negligence or
otherwise) arising in any way out of the use of this software, even if advised of the possibility of such damage."""
_GNU = """
under <<beginOptional>>the terms of<<endOptional>> the GNU General Public License
<<beginOptional>>(GPL)<<endOptional>><<beginOptional>>as published by the Free Software Foundation<<endOptional>>
<<beginOptional>>either<<endOptional>> version {0} """
_CC = """
Creative Commons Attribution{0} <<beginOptional>><<var;words="1-1">>.0<<endOptional>>
<<beginOptional>>International<<endOptional>> <<beginOptional>>Public<<endOptional>> License"""
TEMPLATES = (
    ("mit", """
Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation
files (the "Software"), to deal in the Software without restriction, including without limitation the rights to use, copy,
modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software
is furnished to do so, subject to the following conditions: The above copyright notice and this permission notice
<<beginOptional>>(including the next paragraph)<<endOptional>> shall be included in all copies or substantial portions of the
Software. <<beginOptional>>The Software is provided "as is", without warranty of any kind, express or implied, including but not
limited to the warranties of merchantability, fitness for a particular purpose and noninfringement. In no event shall
<<var;words="1-20">> be liable for any claim, damages or other liability, whether in an action of contract, tort or otherwise,
arising from, out of or in connection with the Software or the use or other dealings in the Software.<<endOptional>>"""),
    ("isc", """
Permission to use, copy, modify, and<<beginOptional>>/or<<endOptional>> distribute this software for any purpose with or
without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies."""),
    ("bsd-2", _CONDITIONS + _DISCLAIMER),
    ("bsd-3", _CONDITIONS + """<<var;words="0-1">> Neither the name of <<var;words="1-20">> nor the names of its contributors may
be used to endorse or promote products derived from this software without specific prior written permission.""" + _DISCLAIMER),
    ("apache-2", """
Licensed under the Apache License, Version 2.0 <<beginOptional>>(the "License"); you may not use this file except in compliance
with the License. You may obtain a copy of the License at <<var;words="1-12">> Unless required by applicable law or agreed to in
writing, software distributed under the License is distributed on an "as is" basis, without warranties or conditions of any kind,
either express or implied. See the License for the specific language governing permissions and limitations under the
License.<<endOptional>>"""),
    ("gpl-2", _GNU.format(2)), ("gpl-3", _GNU.format(3)),
    ("mpl-2", """
This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. <<beginOptional>>If a copy of the MPL was
not distributed with this file, you can obtain one at <<var;words="1-12">><<endOptional>>"""),
    ("cc-by", _CC.format("")), ("cc-by-nc", _CC.format("-NonCommercial")), ("cc-by-nc", _CC.format(" Non-Commercial")),
    ("cc-by-sa", _CC.format("-ShareAlike")),
    ("unlicense", "This is free and unencumbered software released into the public domain."),
    ("mit", "SPDX-License-Identifier: MIT"), ("apache-2", "SPDX-License-Identifier: Apache-2.0"),
    ("gpl-2", "SPDX-License-Identifier: GPL-2.0"), ("gpl-3", "SPDX-License-Identifier: GPL-3.0"),
    ("bsd-2", "SPDX-License-Identifier: BSD-2-Clause"), ("bsd-3", "SPDX-License-Identifier: BSD-3-Clause"),
    ("mpl-2", "SPDX-License-Identifier: MPL-2.0"), ("isc", "SPDX-License-Identifier: ISC"),
    ("cc-by", "SPDX-License-Identifier: CC-BY-4.0"), ("cc-by-sa", "SPDX-License-Identifier: CC-BY-SA-4.0"),
)


def tokens(text: str | None) -> list[bytes]:
    return WORD.findall((text or "").encode("utf-8", "surrogatepass").translate(LOWER))


def parse(template: str) -> list:
    """A template's items: words, (least, most) replaceable words, and lists of items that are optional."""
    stack: list[list] = [[]]
    at = 0
    for m in MARKUP.finditer(template):
        stack[-1] += tokens(template[at:m.start()])
        at = m.end()
        if m[1] == "beginOptional":
            stack.append([])
        elif m[1] == "endOptional":
            if len(stack) == 1:
                raise ValueError("endOptional without its beginning")
            inner = stack.pop()
            stack[-1].append(inner)
        else:
            stack[-1].append((int(m[2]), int(m[3])))
    if len(stack) > 1:
        raise ValueError("beginOptional without its end")
    return stack[0] + tokens(template[at:])


@dataclass
class Automaton:
    """A template's states 0..n; n accepts. ``words[s]`` is the word from s to s + 1 (None: any word), ``skips[s]`` the
    states that s reaches without a word."""

    label: str
    items: list
    words: list = field(default_factory=list)
    skips: dict = field(default_factory=dict)

    def __post_init__(self):
        self._add(self.items)
        self.need = frozenset(w for w in self.items if isinstance(w, bytes))
        self.wording = sum(isinstance(w, bytes) for w in self.items)
        self.vocabulary = {w for w in self.words if w is not None}
        self.start = self._closed({0})
        if any(s < len(self.words) and self.words[s] is None for s in self.start):
            raise ValueError("a template starts with its own wording")
        self.firsts = {self.words[s] for s in self.start if s < len(self.words)}
        self._next: dict = {}

    def _add(self, items) -> None:
        for item in items:
            at = len(self.words)
            if isinstance(item, bytes):
                self.words.append(item)
            elif isinstance(item, list):
                self._add(item)
                self.skips.setdefault(at, set()).add(len(self.words))
            else:
                least, most = item
                self.words += [None] * most
                for s in range(at + least, at + most):
                    self.skips.setdefault(s, set()).add(at + most)

    def _closed(self, states: set) -> frozenset:
        todo, out = list(states), set(states)
        while todo:
            for t in self.skips.get(todo.pop(), ()):
                if t not in out:
                    out.add(t)
                    todo.append(t)
        return frozenset(out)

    def step(self, states: frozenset, word: bytes) -> frozenset:
        key = states, word if word in self.vocabulary else None
        out = self._next.get(key)
        if out is None:
            if len(self._next) >= REMEMBERED:
                self._next.clear()
            end = len(self.words)
            out = self._next[key] = self._closed({s + 1 for s in states if s < end and self.words[s] in (None, word)})
        return out

    def longest(self, words: list, at: int) -> int | None:
        """The end of the longest match that starts at ``at``."""
        states, end, accept = self.start, None, len(self.words)
        for i in range(at, len(words)):
            states = self.step(states, words[i])
            if not states:
                break
            if accept in states:
                end = i + 1
        return end


def compiled(templates) -> list[Automaton]:
    return [Automaton(label, parse(text)) for label, text in templates]


def find(automata: list[Automaton], words: list) -> list[tuple[int, int, int]]:
    """(automaton, first word, end) of every place where one matches."""
    held = set(words)
    able = [(k, a) for k, a in enumerate(automata) if a.need <= held]
    if not able:
        return []
    places: dict = {}
    for first in {w for _, a in able for w in a.firsts}:
        places[first] = []
    for i, w in enumerate(words):
        if w in places:
            places[w].append(i)
    out = []
    for k, a in able:
        for first in a.firsts:
            for i in places[first]:
                end = a.longest(words, i)
                if end is not None:
                    out.append((k, i, end))
    return sorted(out)


def scan(docs: DataFrame, templates=TEMPLATES, phrases=PHRASES, text: str = "text") -> DataFrame:
    """``docs`` with ``n_words`` and ``matches``: for every place where a template or phrase stands its label, whether it is a
    phrase, its first word (from 0), the end of its longest match, and the count of its mandatory words.

    Whole texts are read; a null or empty text has no words; repeated rows give equal results, other columns ride
    along (but two of them must not be named ``n_words`` or ``matches``); an empty table gives no rows.
    """
    small_batches(docs.sparkSession)
    both = [*phrases, *templates]
    few = len(phrases)
    automata = compiled(both)

    @F.pandas_udf("struct<n_words:long,matches:array<struct<template:int,first:long,end:long>>>")
    def read(texts: pd.Series) -> pd.DataFrame:
        counts, found = [], []
        for t in texts:
            words = tokens(t)
            counts.append(len(words))
            found.append([{"template": k, "first": a, "end": b} for k, a, b in find(automata, words)])
        return pd.DataFrame({"n_words": counts, "matches": found})

    about = F.array(*[F.struct(F.lit(a.label).alias("label"), F.lit(k < few).alias("phrase"), F.lit(a.wording).alias("wording"))
                      for k, a in enumerate(automata)])
    seen = docs.withColumn("matches", read(text_or_empty(text)))
    return seen.withColumn("n_words", F.col("matches.n_words")).withColumn("matches", F.transform("matches.matches", lambda m: F.struct(
        F.get(about, m["template"])["label"].alias("label"), F.get(about, m["template"])["phrase"].alias("phrase"),
        m["first"].alias("first"), m["end"].alias("end"), F.get(about, m["template"])["wording"].alias("wording"))))


def summary(docs: DataFrame) -> DataFrame:
    """doc_id, n_words, n_base, first_word, last_word, base_labels, labels, score per row of ``docs``.

    The score is w / (w + 1) for the longest mandatory wording of w words that the text holds; 0 for none.
    """
    rows = scan(docs.select("doc_id", "text"))
    base = F.filter("matches", lambda m: m["phrase"])
    labels = lambda ms: F.array_join(F.array_sort(F.array_distinct(F.transform(ms, lambda m: m["label"]))), ",")
    starts = F.transform("base", lambda m: m["first"])
    most = F.coalesce(F.array_max(F.transform("matches", lambda m: m["wording"])), F.lit(0))
    return rows.withColumn("base", base).select(
        "doc_id", "n_words", F.size("base").cast("long").alias("n_base"), F.array_min(starts).alias("first_word"),
        F.array_max(starts).alias("last_word"), labels("base").alias("base_labels"), labels("matches").alias("labels"),
        (most / (most + 1)).alias("score"))
