"""License scans by templates with optional and replaceable regions.

A template is the wording of a license or of a notice, with markup: words in
``[[`` ``]]`` may be left out (regions nest), and ``{{n}}`` stands for any
words, ``n`` at most (names, years, addresses).  All other wording is
mandatory.  A template is compiled to an automaton over words: a state per
word, steps over optional regions, and a chain of ``n`` skippable any-word
states for a replaceable one.  A text is accepted from a word on where the
mandatory wording follows exactly, whatever its case and punctuation.

*Base* templates are plain phrases with a label; every place counts.  The
other templates add labels of their own.  Automata of all templates start at
the words that can begin one, so other words cost one lookup; from a start a
template is followed as far as it can go, and the longest acceptance counts.
That takes a time of at most the template's length from each start, so the
work grows with the text, also for texts of one repeated word.

Each row is judged by its own whole text, inside one task and without any
shuffle.  Null text is empty: no words, no matches, score 0.  Repeated rows
are judged each.  Empty tables give empty results.  Further columns are
returned as they are; columns named like the added ones are replaced.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from driftwood.llm.arrowtext import slices_by_chars

BYTES_AT_A_TIME = 4_000_000
# A-Z to lower case, every other ASCII character but digits and letters to a space
_FOLD = bytes(c + 32 if 65 <= c <= 90 else c if c >= 0x80 or chr(c).isalnum() else 32 for c in range(256))

# Base phrases and their labels.
BASE = [("mit", "under the mit license"), ("apache-2", "apache license version 2"), ("cc-by-nc", "cc by nc")]

_WARRANTY = """THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO
THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND [[NON]] NONINFRINGEMENT. IN NO EVENT SHALL THE {{8}}
AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR
OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE."""
_BSD = """Redistribution and use in source and binary forms, with or without modification, are permitted provided that the
following conditions are met: {{1}} Redistributions of source code must retain the above copyright notice, this list of
conditions and the following disclaimer. {{1}} Redistributions in binary form must reproduce the above copyright notice, this
list of conditions and the following disclaimer in the documentation and/or other materials provided with the distribution."""

# Standard wording of licenses and of the notices that refer to them.
TEMPLATES = [
    ("mit", """Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated
documentation files (the "Software"), to deal in the Software without restriction, including without limitation the rights to
use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the
Software is furnished to do so, subject to the following conditions: The above copyright notice and this permission notice
[[(including the next paragraph)]] shall be included in all copies or substantial portions of the Software. [[""" + _WARRANTY + "]]"),
    ("mit", "Released under the [[terms of the]] MIT License"),
    ("mit", "Licensed under the [[terms of the]] MIT License"),
    ("mit", "SPDX License Identifier MIT"),
    ("bsd-2-clause", _BSD + " THIS SOFTWARE IS PROVIDED BY {{12}} AS IS AND ANY EXPRESS OR IMPLIED WARRANTIES"),
    ("bsd-3-clause", _BSD + """ {{1}} Neither the name of {{12}} nor the names of [[its]] [[{{4}}]] contributors may be used to
endorse or promote products derived from this software without specific prior written permission."""),
    ("isc", """Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby
granted, provided that the above copyright notice and this permission notice appear in all copies."""),
    ("apache-2", """Licensed under the Apache License, Version 2.0 [[(the "License"); you may not use this file except in
compliance with the License. You may obtain a copy of the License at [[http]] {{8}} licenses LICENSE 2.0 Unless required by
applicable law or agreed to in writing, software distributed under the License is distributed on an "AS IS" BASIS]]"""),
    ("apache-2", "SPDX License Identifier Apache 2.0"),
    ("gpl-3", """This {{6}} is free software: you can redistribute it and/or modify it under the terms of the GNU General Public
License as published by the Free Software Foundation, either version 3 of the License, or [[(at your option)]] any later version"""),
    ("gpl-3", "This {{4}} is licensed under the [[terms of the]] GNU General Public License, version 3"),
    ("gpl-3", "SPDX License Identifier GPL 3.0 [[or later]] [[only]]"),
    ("gpl-2", """This {{6}} is free software; you can redistribute it and/or modify it under the terms of the GNU General Public
License as published by the Free Software Foundation; either version 2 of the License, or [[(at your option)]] any later version"""),
    ("gpl-2", "This {{4}} is licensed under the [[terms of the]] GNU General Public License, version 2"),
    ("cc-by-nc", "Licensed under [[a]] [[the]] CC BY NC [[SA]] [[ND]] 4.0 [[International]] [[License]]"),
    ("cc-by-nc", """Licensed under [[a]] [[the]] Creative Commons Attribution NonCommercial [[ShareAlike]] [[NoDerivatives]] 4.0
International [[License]]"""),
    ("cc-by", "Licensed under [[a]] [[the]] CC BY 4.0 [[International]] [[License]]"),
    ("cc-by", "Licensed under [[a]] [[the]] Creative Commons Attribution 4.0 International [[License]]"),
    ("mpl-2", """This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. [[If a copy of the MPL was
not distributed with this file, You can obtain one at {{8}}]]"""),
]


@dataclass(frozen=True)
class Template:
    """A label and the automaton of a template: per state the next states for
    a word, and those for any word; ``first`` leads into it."""

    label: str
    base: bool
    first: dict = field(hash=False)
    steps: tuple = field(hash=False)
    wild: tuple = field(hash=False)
    accepts: frozenset = frozenset()

    def end(self, words: Sequence[bytes], start: int) -> int:
        """The end of the longest acceptance from ``start``, -1 for none."""
        states, at, best = self.first.get(words[start], ()), start + 1, -1
        while states:
            if not self.accepts.isdisjoint(states):
                best = at
            if at == len(words):
                break
            word, after = words[at], set()
            for s in states:
                after.update(self.steps[s].get(word, ()))
                after.update(self.wild[s])
            states, at = after, at + 1
        return best


def _parse(markup: str) -> list:
    """Markup as nested lists: bytes for a word, an int for a replaceable
    region, a list for an optional one."""
    spaced = markup.replace("[[", " \x01 ").replace("]]", " \x02 ").replace("{{", " \x03").replace("}}", " ")
    stack: list[list] = [[]]
    for token in spaced.split():
        if token == "\x01":
            stack.append([])
        elif token == "\x02":
            if len(stack) == 1:
                raise ValueError("]] without [[ in a template")
            inner = stack.pop()
            stack[-1].append(inner)
        elif token[0] == "\x03":
            stack[-1].append(int(token[1:]))
        else:
            stack[-1].extend(token.encode().translate(_FOLD).split())
    if len(stack) > 1:
        raise ValueError("[[ without ]] in a template")
    return stack[0]


def compile_template(label: str, markup: str, base: bool = False) -> Template:
    """The automaton of a template.  State ``i`` means that word or any-word
    ``i`` has just been read; a template begins with a mandatory word."""
    parts = _parse(markup)
    if not parts or not isinstance(parts[0], bytes):
        raise ValueError("a template begins with a mandatory word")
    read: list[bytes | None] = []             # per state the word, None for any
    follow: list[set[int]] = []               # per state the states that may come next

    def add(items: list, before: set[int]) -> set[int]:
        """Append items after the states ``before``; the states they may end in."""
        for item in items:
            if isinstance(item, list):
                before = before | add(item, before)
            elif isinstance(item, int):
                open_ends = set(before)
                for _ in range(item):
                    state = _append(None, before)
                    before = {state}
                    open_ends.add(state)
                before = open_ends
            else:
                before = {_append(item, before)}
        return before

    def _append(word: bytes | None, before: set[int]) -> int:
        state = len(read)
        read.append(word)
        follow.append(set())
        for b in before:
            if b >= 0:
                follow[b].add(state)
        return state

    ends = add(parts, {-1})
    steps, wild = [], []
    for after in follow:
        by_word: dict[bytes, tuple] = {}
        for s in sorted(after):
            if read[s] is not None:
                by_word[read[s]] = (*by_word.get(read[s], ()), s)
        steps.append(by_word)
        wild.append(tuple(s for s in sorted(after) if read[s] is None))
    return Template(label, base, {read[0]: (0,)}, tuple(steps), tuple(wild), frozenset(ends - {-1}))


def compile_templates(base=BASE, templates=TEMPLATES) -> list[Template]:
    return [compile_template(label, markup, True) for label, markup in base] + \
        [compile_template(label, markup) for label, markup in templates]


def words_of(text: bytes) -> list[bytes]:
    """Lower-cased words of UTF-8 text."""
    return text.translate(_FOLD).split()


def find(words: Sequence[bytes], starts: dict[bytes, list[Template]]) -> list[tuple[str, bool, int, int]]:
    """``label, base, start, end`` of every acceptance, in order of the start."""
    out = []
    for i in [i for i, w in enumerate(words) if w in starts]:
        for template in starts[words[i]]:
            end = template.end(words, i)
            if end > 0:
                out.append((template.label, template.base, i, end))
    return out


def by_first_word(templates: Sequence[Template]) -> dict[bytes, list[Template]]:
    out: dict[bytes, list[Template]] = {}
    for t in templates:
        for word in t.first:
            out.setdefault(word, []).append(t)
    return out


def coverage(spans: list[tuple[int, int]]) -> int:
    """Words inside any of the spans."""
    total, upto = 0, 0
    for start, end in sorted(spans):
        total += max(0, end - max(start, upto))
        upto = max(upto, end)
    return total


_MATCH = pa.struct([("label", pa.string()), ("base", pa.bool_()), ("start", pa.int64()), ("end", pa.int64())])
_ADDED = T.StructType([
    T.StructField("n_words", T.LongType()),
    T.StructField("matches", T.ArrayType(T.StructType([
        T.StructField("label", T.StringType()), T.StructField("base", T.BooleanType()),
        T.StructField("start", T.LongType()), T.StructField("end", T.LongType())]))),
    T.StructField("score", T.DoubleType())])


def scan(docs: DataFrame, text: str = "text", keep: Sequence[str] | None = None,
         templates: Sequence[Template] | None = None) -> DataFrame:
    """The columns ``keep`` (default: all) with ``n_words``, ``matches``
    (label, base, first word and end, in words) and ``score``, the share of
    the words that license wording covers."""
    added = _ADDED.fieldNames()
    columns = [c for c in (docs.columns if keep is None else keep) if c not in added]
    starts = by_first_word(compile_templates() if templates is None else templates)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices_by_chars(batch, len(columns), BYTES_AT_A_TIME):
                counts, matches, scores = [], [], []
                for t in pc.fill_null(part.column(len(columns)), "").cast(pa.large_binary()).to_pylist():
                    words = words_of(t)
                    found = find(words, starts)
                    counts.append(len(words))
                    matches.append([{"label": a, "base": b, "start": s, "end": e} for a, b, s, e in found])
                    scores.append(coverage([m[2:] for m in found]) / len(words) if found else 0.0)
                yield pa.RecordBatch.from_arrays(
                    [*part.columns[:len(columns)], pa.array(np.array(counts, np.int64)),
                     pa.array(matches, pa.list_(_MATCH)), pa.array(scores, pa.float64())], names=[*columns, *added])

    kept = docs.select(*[F.col(f"`{c}`") for c in columns], F.col(f"`{text}`").alias("_dw_text"))
    return kept.mapInArrow(run, T.StructType([*kept.schema.fields[:-1], *_ADDED.fields]))


def labels_of(matches: Column) -> Column:
    """Distinct labels of matches, sorted and comma-joined."""
    return F.array_join(F.array_sort(F.array_distinct(F.transform(matches, lambda m: m["label"]))), ",")
