"""License scans with template markup.

A template is license wording with markup: ``[[ ... ]]`` is an optional region and
``{{n}}`` or ``{{m-n}}`` a replaceable one of 1 (m) to n words. Everything else is
mandatory and must match word for word. Words are ``[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+``
after lower-casing A-Z, so case, punctuation and line breaks do not matter.

Each template compiles into an automaton over words. A text is hashed into words in numpy;
the automata start only where two words in a row can begin a template (a set test over all
words), and run on word hashes from there. A template is accepted where its automaton
reaches its end.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import words as W

#: fixed values: phrases and labels of the base scan
BASE = (("mit license", "mit"), ("apache license", "apache"), ("general public license", "gpl"))

#: fixed values: wording of public licenses and notices, with markup
TEMPLATES = (
    ("agpl", "GNU Affero General Public License [[as published by the Free Software Foundation]]"),
    ("apache-2.0", "Licensed under the Apache License, Version 2.0 [[(the \"License\"); you may not use this file except in "
                   "compliance with the License. You may obtain a copy of the License at [[http://www.apache.org/licenses/LICENSE-2.0]]"
                   "[[https://www.apache.org/licenses/LICENSE-2.0]]]]"),
    ("apache-2.0", "SPDX-License-Identifier: Apache-2.0"),
    ("bsd-2-clause", "Redistribution and use in source and binary forms, with or without modification, are permitted provided that "
                     "the following conditions are met: {{0-4}} Redistributions of source code must retain the above copyright "
                     "notice, this list of conditions and the following disclaimer. {{0-4}} Redistributions in binary form must "
                     "reproduce the above copyright notice, this list of conditions and the following disclaimer in the "
                     "documentation and/or other materials provided with the distribution. THIS SOFTWARE IS PROVIDED BY"),
    ("bsd-2-clause", "SPDX-License-Identifier: BSD-2-Clause"),
    ("bsd-3-clause", "Redistribution and use in source and binary forms, with or without modification, are permitted provided that "
                     "the following conditions are met: {{0-4}} Redistributions of source code must retain the above copyright "
                     "notice, this list of conditions and the following disclaimer. {{0-4}} Redistributions in binary form must "
                     "reproduce the above copyright notice, this list of conditions and the following disclaimer in the "
                     "documentation and/or other materials provided with the distribution. {{0-4}} Neither the name of "
                     "{{1-12}} nor the names of [[its]] contributors may be used to endorse or promote products derived from this "
                     "software without specific prior written permission."),
    ("bsd-3-clause", "SPDX-License-Identifier: BSD-3-Clause"),
    ("bsl-1.0", "Permission is hereby granted, free of charge, to any person or organization obtaining a copy of the software and "
                "accompanying documentation covered by this license (the \"Software\") to use, reproduce, display, distribute, "
                "execute, and transmit the Software"),
    ("bsl-1.0", "Distributed under the Boost Software License, Version 1.0"),
    ("cc-by", "Licensed under [[the]] [[a]] [[Creative Commons]] [[CC]] BY {{1}} 0 [[International]] [[License]]"),
    ("cc-by", "Creative Commons Attribution {{1}} 0 [[International]] [[Unported]] [[License]]"),
    ("cc-by-nc", "Licensed under [[the]] [[a]] [[Creative Commons]] [[CC]] BY NC [[SA]] [[ND]] {{1}} 0 [[International]] [[License]]"),
    ("cc-by-nc", "Creative Commons Attribution NonCommercial [[ShareAlike]] [[NoDerivatives]] {{1}} 0 [[International]] [[Unported]] "
                 "[[License]]"),
    ("cc-by-nc", "Creative Commons Attribution Non-Commercial [[Share Alike]] [[No Derivatives]] {{1}} 0 [[International]] [[Unported]] "
                 "[[License]]"),
    ("cc-by-nd", "Creative Commons Attribution NoDerivatives {{1}} 0 [[International]] [[License]]"),
    ("cc-by-nd", "Creative Commons Attribution NoDerivs {{1}} 0 [[Unported]] [[License]]"),
    ("cc-by-sa", "Licensed under [[the]] [[a]] [[Creative Commons]] [[CC]] BY SA {{1}} 0 [[International]] [[License]]"),
    ("cc-by-sa", "Creative Commons Attribution ShareAlike {{1}} 0 [[International]] [[Unported]] [[License]]"),
    ("cc-by-sa", "Creative Commons Attribution Share-Alike {{1}} 0 [[International]] [[Unported]] [[License]]"),
    ("cc0-1.0", "CC0 1.0 Universal"),
    ("cc0-1.0", "waived all copyright and related or neighboring rights to this work"),
    ("epl-2.0", "made available under the terms of the Eclipse Public License [[v]] [[version]] 2.0"),
    ("gpl", "Licensed under [[the terms of]] the GNU General Public License [[as published by the Free Software Foundation]] "
            "[[[[either]] version {{1}} [[0]] [[of the License]] [[or (at your option) any later version]]]]"),
    ("gpl", "redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software "
            "Foundation[[; either version {{1}} of the License[[, or (at your option) any later version]]]]"),
    ("isc", "Permission to use, copy, modify, and[[/or]] distribute this software for any purpose with or without fee is hereby "
            "granted, provided that the above copyright notice and this permission notice appear in all copies."),
    ("lgpl", "GNU Lesser General Public License [[as published by the Free Software Foundation]]"),
    ("lgpl", "GNU Library General Public License [[as published by the Free Software Foundation]]"),
    ("mit", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated "
            "documentation files (the \"Software\"), to deal in the Software without restriction, including without limitation "
            "the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to "
            "permit persons to whom the Software is furnished to do so, subject to the following conditions: The above copyright "
            "notice and this permission notice [[(including the next paragraph)]] shall be included in all copies or substantial "
            "portions of the Software."),
    ("mit", "[[Released]] [[Licensed]] [[Distributed]] under [[the terms of]] the MIT License"),
    ("mit", "SPDX-License-Identifier: MIT"),
    ("mpl-2.0", "subject to the terms of the Mozilla Public License, v. 2.0 [[. If a copy of the MPL was not distributed with this "
                "file, You can obtain one at [[http://mozilla.org/MPL/2.0/]][[https://mozilla.org/MPL/2.0/]]]]"),
    ("mpl-2.0", "SPDX-License-Identifier: MPL-2.0"),
    ("unlicense", "This is free and unencumbered software released into the public domain."),
    ("zlib", "This software is provided 'as-is', without any express or implied warranty. In no event will the authors be held liable "
             "for any damages arising from the use of this software. Permission is granted to anyone to use this software for any "
             "purpose, including commercial applications, and to alter it and redistribute it freely"),
)

_TOKEN = re.compile(r"\[\[|\]\]|\{\{(?:([0-9]+)-)?([0-9]+)\}\}|[0-9a-z\x80-\U0010FFFF]+")
ANY = -1  # an edge for any word


@dataclass
class Automaton:
    """Nodes 0.. with edges; a node lists (word hash or ANY, next node) and free moves."""
    label: str
    edges: list[list[tuple[int, int]]] = field(default_factory=list)
    free: list[list[int]] = field(default_factory=list)
    mandatory: list[int] = field(default_factory=list)  # mandatory words before each node
    end: int = 0

    def node(self, mandatory: int) -> int:
        self.edges.append([])
        self.free.append([])
        self.mandatory.append(mandatory)
        return len(self.edges) - 1

    def closure(self, nodes: set[int]) -> frozenset[int]:
        todo, out = list(nodes), set(nodes)
        while todo:
            for b in self.free[todo.pop()]:
                if b not in out:
                    out.add(b)
                    todo.append(b)
        return frozenset(out)

    def step(self, nodes: frozenset[int], word: int) -> frozenset[int]:
        return self.closure({b for a in nodes for w, b in self.edges[a] if w == word or w == ANY})


def compile_template(label: str, markup: str) -> Automaton:
    a = Automaton(label)
    at = a.node(0)
    opened: list[int] = []
    done = 0
    for m in _TOKEN.finditer(markup.lower()):
        token = m.group()
        if token == "[[":
            opened.append(at)
        elif token == "]]":
            a.free[opened.pop()].append(at)
        elif token.startswith("{{"):
            most = int(m.group(2))
            least = int(m.group(1)) if m.group(1) else 1
            for k in range(most):
                to = a.node(done)
                a.edges[at].append((ANY, to))
                if k >= least:
                    a.free[at].append(to)
                at = to
        else:
            done += not opened
            to = a.node(done)
            a.edges[at].append((W.word_hash(token), to))
            at = to
    if opened:
        raise ValueError(f"unclosed optional region in the template of {label}")
    a.end = at
    return a


@dataclass
class Scanner:
    automata: list[Automaton]
    pairs: np.ndarray  # hashes of the two words that can begin a template, sorted

    @staticmethod
    def of(templates=TEMPLATES) -> "Scanner":
        automata = [compile_template(*t) for t in templates]
        pairs = set()
        for a in automata:
            first = a.closure({0})
            for node in first:
                for w, to in a.edges[node]:
                    for mid in a.closure({to}):
                        for w2, _ in a.edges[mid]:
                            if ANY in (w, w2):
                                raise ValueError(f"the template of {a.label} must begin with two words")
                            pairs.add(_pair(np.array([w], np.uint64), np.array([w2], np.uint64))[0])
        return Scanner(automata, np.array(sorted(pairs), np.uint64))

    def run(self, hashes: np.ndarray, begin: int, end: int) -> Iterator[tuple[str, int, float]]:
        """(label, words matched or 0, share of mandatory words) of each automaton from ``begin``."""
        for a in self.automata:
            nodes = a.closure({0})
            matched, share, total = 0, 0.0, a.mandatory[a.end]
            for i in range(begin, end):
                nodes = a.step(nodes, int(hashes[i]))
                if not nodes:
                    break
                share = max(share, max(a.mandatory[x] for x in nodes) / total)
                if a.end in nodes:
                    matched = i + 1 - begin
            yield a.label, matched, 1.0 if matched else min(share, 0.99)


def _pair(first: np.ndarray, second: np.ndarray) -> np.ndarray:
    return W.mix(first * np.uint64(0x9E3779B97F4A7C15) + second)


def base_places(hashes: np.ndarray, offsets: np.ndarray) -> list[tuple[str, np.ndarray]]:
    """(label, positions in ``hashes``) where a base phrase stands within one text."""
    last = np.repeat(offsets[1:], np.diff(offsets))
    out = []
    for phrase, label in BASE:
        w = [np.uint64(W.word_hash(x)) for x in phrase.split()]
        at = np.flatnonzero(hashes == w[0])
        for k in range(1, len(w)):
            at = at[at + k < last[at]] if len(at) else at
            at = at[hashes[at + k] == w[k]]
        out.append((label, at))
    return out


def _scan(scanner: Scanner):
    names = ["id", "n_words", "n_base", "first_word", "last_word", "base_labels", "labels", "score", "matches"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first, h, off in W.groups(batch.column(1)):
                n = len(off) - 1
                places = [[] for _ in range(n)]
                base = [set() for _ in range(n)]
                for label, at in base_places(h, off):
                    for p, d in zip(at.tolist(), (np.searchsorted(off, at, side="right") - 1).tolist()):
                        places[d].append(p - int(off[d]))
                        base[d].add(label)
                matches = [[] for _ in range(n)]
                score = [0.0] * n
                starts = np.flatnonzero(np.isin(_pair(h[:-1], h[1:]), scanner.pairs)) if len(h) > 1 else np.zeros(0, np.int64)
                for p, d in zip(starts.tolist(), (np.searchsorted(off, starts, side="right") - 1).tolist()):
                    for label, words, share in scanner.run(h, p, int(off[d + 1])):
                        score[d] = max(score[d], share)
                        if words:
                            matches[d].append({"label": label, "first": p - int(off[d]), "words": words})
                yield pa.RecordBatch.from_arrays([
                    batch.column(0).slice(first, n), pa.array(np.diff(off), pa.int64()), pa.array([len(x) for x in places], pa.int64()),
                    pa.array([min(x) if x else None for x in places], pa.int64()),
                    pa.array([max(x) if x else None for x in places], pa.int64()),
                    pa.array([",".join(sorted(x)) for x in base], pa.string()),
                    pa.array([",".join(sorted(b | {m["label"] for m in x})) for b, x in zip(base, matches)], pa.string()),
                    pa.array([1.0 if b else s for b, s in zip(base, score)], pa.float64()), pa.array(matches, MATCHES)], names=names)
    return run


MATCHES = pa.list_(pa.struct([("label", pa.string()), ("first", pa.int64()), ("words", pa.int64())]))


def scan_licenses(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", templates=TEMPLATES) -> DataFrame:
    """(id, n_words, n_base, first_word, last_word, base_labels, labels, score, matches).

    One row per row of ``docs``. ``matches`` has label, first word and number of words (the
    longest) of every place where a template is accepted. ``score`` is 1 with a base phrase
    or an accepted template, otherwise the largest share of a template's mandatory words
    that stands in a row from its beginning. A null text counts as empty (no words, no
    labels, score 0); texts of any length are scanned whole; repeated rows get the same
    result; ids may be null or repeat; an empty table gives an empty table. Other columns
    are not looked at.
    """
    t = docs.select(F.col(f"`{id_col}`").alias("id"), F.col(f"`{text_col}`").alias("text"))
    out = t.mapInArrow(_scan(Scanner.of(templates)),
                       f"id {t.schema['id'].dataType.simpleString()}, n_words bigint, n_base bigint, first_word bigint, "
                       "last_word bigint, base_labels string, labels string, score double, "
                       "matches array<struct<label:string,first:bigint,words:bigint>>")
    return out.withColumnRenamed("id", id_col)
