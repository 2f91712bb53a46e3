"""Licence notices in texts: Dice coefficient over word bigrams against licence templates.

Compared are a text's lines, its paragraphs of several lines (paragraphs are parted by blank lines) and
its word windows, which may begin and end inside a line and run over several paragraphs. Words are
lower-cased letters and digits; a unit and a template are sets of word bigrams A and B, and Dice is
``2 |A & B| / (|A| + |B|)``. It can reach ``least`` only if
``least / (2 - least) <= |A| / |B| <= (2 - least) / least``: templates outside these bounds are not
compared, and a unit that shares no bigram with any template is passed over at once.

Windows are anchored at a template's own bigrams: the best window begins and ends with one, and a window
that has the bigram of its begin once more is no better than the one that begins there. A text in which
too few of a template's bigrams occur at all has no window of it. Of windows that share words the one of
the highest Dice stays, then the longer one; none is given half of whose words or more stand in lines
and paragraphs that are notices themselves.

Templates are short notices (``TEMPLATES``), the usual headers of further licences and the whole texts
in ``licence_texts``.
"""

from __future__ import annotations

import re
from collections import Counter
from pathlib import Path

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from crawlframe.llm.common import map_arrow

WORD = re.compile(r"[^\W_]+")
LEAST = 0.8

# Licence and notice, short forms and the usual longer ones.
TEMPLATES = [
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0."),
    ("Apache-2.0", 'Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in compliance with the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0 Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on an "AS IS" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. See the License for the specific language governing permissions and limitations under the License.'),
    ("BSD-3-Clause", "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met:"),
    ("BSD-3-Clause", "Use of this source code is governed by a BSD-style license that can be found in the LICENSE file."),
    ("CC-BY-4.0", "Licensed under CC BY 4.0."),
    ("CC-BY-4.0", "This work is licensed under a Creative Commons Attribution 4.0 International License."),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0."),
    ("CC-BY-NC-4.0", "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License."),
    ("CC-BY-SA-4.0", "Licensed under CC BY-SA 4.0."),
    ("GPL-3.0", "This work is licensed under the GNU General Public License, version 3."),
    ("GPL-3.0", "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version."),
    ("MIT", "Released under the MIT License."),
    ("MIT", 'Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the "Software"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions:'),
    ("MPL-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not distributed with this file, You can obtain one at https://mozilla.org/MPL/2.0/."),
    ("Unlicense", "This is free and unencumbered software released into the public domain."),
]

# Headers of further licences.
HEADERS = [
    ("GPL-2.0", "This program is free software; you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation; either version 2 of the License, or (at your option) any later version."),
    ("LGPL-2.1", "This library is free software; you can redistribute it and/or modify it under the terms of the GNU Lesser General Public License as published by the Free Software Foundation; either version 2.1 of the License, or (at your option) any later version."),
    ("LGPL-3.0", "This library is free software: you can redistribute it and/or modify it under the terms of the GNU Lesser General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version."),
    ("AGPL-3.0", "This program is free software: you can redistribute it and/or modify it under the terms of the GNU Affero General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version."),
    ("CC0-1.0", "To the extent possible under law, the author(s) have dedicated all copyright and related and neighboring rights to this software to the public domain worldwide. This software is distributed without any warranty."),
]


def all_templates() -> list[tuple[str, str]]:
    """Short notices, headers and whole texts; read on the driver."""
    whole = sorted((Path(__file__).parent / "licence_texts").glob("*.txt"))
    return TEMPLATES + HEADERS + [(path.stem, path.read_text("utf-8")) for path in whole]


def bigrams(text: str) -> frozenset[tuple[str, str]]:
    words = WORD.findall(text.lower())
    return frozenset(zip(words, words[1:], strict=False))


class Matcher:
    """Templates by their bigrams' number, with one set of all their bigrams."""

    def __init__(self, templates: list[tuple[str, str]], least: float) -> None:
        self.least = least
        self.sets = sorted(((name, bigrams(text)) for name, text in templates), key=lambda x: len(x[1]))
        self.every = frozenset().union(*(b for _, b in self.sets))
        ratio = least / (2 - least)
        self.low = min((len(b) for _, b in self.sets), default=0) * ratio
        self.high = max((len(b) for _, b in self.sets), default=0) / ratio
        self.holders: dict[tuple[str, str], list[int]] = {}
        for t, (_, theirs) in enumerate(self.sets):
            for bigram in theirs:
                self.holders.setdefault(bigram, []).append(t)

    def best(self, own: frozenset[tuple[str, str]]) -> tuple[float, str] | None:
        """Highest Dice and its licence, the first by name where several have it."""
        if not self.low <= len(own) <= self.high or self.every.isdisjoint(own):
            return None
        ratio, found = self.least / (2 - self.least), []
        for name, theirs in self.sets:
            if len(theirs) * ratio <= len(own) + 1e-9 and len(own) * ratio <= len(theirs) + 1e-9:
                dice = 2 * len(own & theirs) / (len(own) + len(theirs))
                if dice >= self.least - 1e-9:
                    found.append((-dice, name))
        return (-min(found)[0], min(found)[1]) if found else None

    def windows(self, words: list[str]) -> list[tuple[float, str, int, int]]:
        """``(dice, licence, first word, last word)`` of windows that are notices, none sharing a word with another."""
        own = list(zip(words, words[1:], strict=False))
        shared = self.every.intersection(own)
        ratio, found = self.least / (2 - self.least), []
        many = Counter(t for bigram in shared for t in self.holders[bigram])
        chosen = [t for t, n in many.items() if n >= len(self.sets[t][1]) * ratio - 1e-9]
        if not chosen:
            return []
        after = np.full(len(own), len(own))
        before, last = np.full(len(own), -1), {}
        for k, bigram in enumerate(own):
            if bigram in last:
                before[k], after[last[bigram]] = last[bigram], k
            last[bigram] = k
        for t in chosen:
            name, theirs = self.sets[t]
            marks = np.fromiter((bigram in theirs for bigram in own), bool, len(own))
            found += [(-dice, first - last, name, first, last) for dice, first, last in self._best_windows(marks, before, after, len(theirs))]
        out, taken = [], np.zeros(len(words), bool)
        for dice, _, name, first, last in sorted(found):
            if not taken[first : last + 1].any():
                taken[first : last + 1] = True
                out.append((-dice, name, first, last))
        # A shorter window may stand where the best one of its begin shares words with a better one.
        edges = np.flatnonzero(np.diff(np.r_[True, taken, True])) if out else []
        for a, z in zip(edges[::2], edges[1::2], strict=True):
            out += [(dice, name, first + int(a), last + int(a)) for dice, name, first, last in self.windows(words[a:z])]
        return out

    def _best_windows(self, marks: np.ndarray, before: np.ndarray, after: np.ndarray, size: int) -> list[tuple[float, int, int]]:
        """The best window from each begin that reaches ``least``, as Dice, first and last word."""
        ratio, out = self.least / (2 - self.least), []
        for a in np.flatnonzero(marks).tolist():
            stop, step = int(after[a]), int(size / ratio) + 1
            while True:
                end = min(stop, a + step)
                new = before[a:end] < a
                sizes = np.cumsum(new)
                if end == stop or sizes[-1] * ratio > size:
                    break
                step *= 2
            ends = np.flatnonzero(new & marks[a:end])
            if len(ends) >= size * ratio - 1e-9:
                dice = 2 * np.arange(1, len(ends) + 1) / (sizes[ends] + size)
                best = int(np.argmax(dice))
                if dice[best] >= self.least - 1e-9:
                    out.append((float(dice[best]), a, a + int(ends[best]) + 1))
        return out


def units(text: str) -> list[tuple[str, int, int, str]]:
    """``(unit, first line, last line, text)``: lines with words in them, and paragraphs of several lines."""
    lines, out, begin = text.split("\n"), [], 0
    for k, line in enumerate([*lines, ""]):
        if line.strip():
            if k < len(lines):
                out.append(("line", k, k, line))
        else:
            if k - begin > 1:
                out.append(("paragraph", begin, k - 1, "\n".join(lines[begin:k])))
            begin = k + 1
    return out


def windows_of(matcher: Matcher, text: str, notices: list[tuple[str, int, int, str, float]]) -> list[tuple[str, int, int, str, float]]:
    """Windows of a text as units, without those that its notices among lines and paragraphs make up by half or more."""
    windows = matcher.windows(WORD.findall(text.lower()))
    if not windows:
        return []
    counts = [len(WORD.findall(line)) for line in text.lower().split("\n")]
    line = np.repeat(np.arange(len(counts)), counts)
    known = np.isin(line, [k for _, first, last, _, _ in notices for k in range(first, last + 1)])
    return [("window", int(line[a]), int(line[z]), name, dice) for dice, name, a, z in sorted(windows, key=lambda w: w[2]) if 2 * known[a : z + 1].sum() < z + 1 - a]


def licences(docs: DataFrame, templates: list[tuple[str, str]] | None = None, least: float = LEAST) -> DataFrame:
    """``doc_id, unit, first_line, last_line, licence, dice``: a row for each unit of a text that is a notice.

    Units are ``line``, ``paragraph`` and ``window``; a window's lines are those of its first and last word.

    Null and empty texts have no units; units of one word have no bigram and never match. Repeated rows
    each count. No templates or an empty table: no rows. Other columns are not read.
    """
    matcher = Matcher(all_templates() if templates is None else templates, least)

    def find(rows: dict) -> dict | None:
        out: dict[str, list] = {name: [] for name in ("doc_id", "unit", "first_line", "last_line", "licence", "dice")}
        for doc_id, text in zip(rows["doc_id"], rows["text"], strict=True):
            found = []
            for unit, first, last, said in units(text or ""):
                best = matcher.best(bigrams(said))
                if best:
                    found.append((unit, first, last, best[1], best[0]))
            for row in found + windows_of(matcher, text or "", found):
                for name, value in zip(out, (doc_id, *row[:4], round(row[4], 6)), strict=True):
                    out[name].append(value)
        return out if out["doc_id"] else None

    columns = {"doc_id": pa.int64(), "unit": pa.string(), "first_line": pa.int32(), "last_line": pa.int32(), "licence": pa.string(), "dice": pa.float64()}
    return map_arrow(docs.select("doc_id", "text"), find, "doc_id long, unit string, first_line int, last_line int, licence string, dice double", columns)
