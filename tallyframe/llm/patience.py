"""License scans by patience alignment of documents with license texts.

Text and template are compared as words (letters and digits, lower case).  Words that occur once in either are paired;
the longest increasing run of pairs gives anchors, and the gaps between anchors are aligned the same way, after equal
words at their ends are matched.  Coverage is the share of the template's words that are matched.

A template is sought in the windows that begin at any word of the document, as long as the density allows a match to be,
so repeated notices do not hide each other.  The words that window and template share, counted with repeats, bound what
can be matched there.  Windows are aligned from the highest bound on, until no other can be better; windows and whole
documents whose bound is below the wanted coverage are passed over.  These bounds lose nothing.
"""

from __future__ import annotations

import math
import re
from bisect import bisect_left
from collections import Counter
from collections.abc import Iterator, Mapping

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

COVERAGE = 0.8
#: Least share of matched words in the stretch of text that the matches span.
DENSITY = 0.6
_WORD = re.compile(r"[^\W_]+")

# Short notices and license texts of the public licenses.
TEMPLATES = {
    "Apache-2.0 notice": "Licensed under the Apache License, Version 2.0.",
    "MIT notice": "Released under the MIT License.",
    "GPL-3.0 notice": "This work is licensed under the GNU General Public License, version 3.",
    "CC-BY-NC-4.0 notice": "Licensed under CC BY-NC 4.0.",
    "Apache-2.0 header": (
        "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in compliance"
        " with the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0 Unless"
        " required by applicable law or agreed to in writing, software distributed under the License is distributed on an"
        " \"AS IS\" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. See the License for the"
        " specific language governing permissions and limitations under the License."
    ),
    "GPL-3.0 header": (
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public"
        " License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any"
        " later version. This program is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without"
        " even the implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. See the GNU General Public"
        " License for more details."
    ),
    "MIT": (
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated"
        " documentation files (the \"Software\"), to deal in the Software without restriction, including without limitation"
        " the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and"
        " to permit persons to whom the Software is furnished to do so, subject to the following conditions: The above"
        " copyright notice and this permission notice shall be included in all copies or substantial portions of the"
        " Software. THE SOFTWARE IS PROVIDED \"AS IS\", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT"
        " LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT"
        " SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION"
        " OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER"
        " DEALINGS IN THE SOFTWARE."
    ),
    "ISC": (
        "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby"
        " granted, provided that the above copyright notice and this permission notice appear in all copies. THE SOFTWARE"
        " IS PROVIDED \"AS IS\" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED"
        " WARRANTIES OF MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT,"
        " INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS, WHETHER"
        " IN AN ACTION OF CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH THE USE OR"
        " PERFORMANCE OF THIS SOFTWARE."
    ),
    "BSD-2-Clause": (
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the"
        " following conditions are met: 1. Redistributions of source code must retain the above copyright notice, this list"
        " of conditions and the following disclaimer. 2. Redistributions in binary form must reproduce the above copyright"
        " notice, this list of conditions and the following disclaimer in the documentation and/or other materials provided"
        " with the distribution. THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS \"AS IS\" AND ANY"
        " EXPRESS OR IMPLIED WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND"
        " FITNESS FOR A PARTICULAR PURPOSE ARE DISCLAIMED."
    ),
}


def words_of(text: str) -> list[str]:
    return _WORD.findall(text.lower())


def _anchors(a: list[str], b: list[str], a0: int, a1: int, b0: int, b1: int) -> list[tuple[int, int]]:
    """Pairs of places of words that stand once in both stretches, in the longest run that rises in both."""
    once_a, once_b = Counter(a[a0:a1]), Counter(b[b0:b1])
    at = {w: i for i, w in enumerate(b[b0:b1], b0) if once_b[w] == 1}
    pairs = [(i, at[w]) for i, w in enumerate(a[a0:a1], a0) if once_a[w] == 1 and w in at]
    ends, last, before = [], [], []
    for k, (_, j) in enumerate(pairs):
        pile = bisect_left(ends, j)
        before.append(last[pile - 1] if pile else -1)
        if pile == len(ends):
            ends.append(j)
            last.append(k)
        else:
            ends[pile], last[pile] = j, k
    out, k = [], last[-1] if last else -1
    while k >= 0:
        out.append(pairs[k])
        k = before[k]
    return out[::-1]


def align(a: list[str], b: list[str]) -> list[tuple[int, int]]:
    """Matched places of ``a`` and ``b``, increasing in both."""
    out: list[tuple[int, int]] = []
    todo = [(0, len(a), 0, len(b), False)]
    while todo:
        a0, a1, b0, b1, between = todo.pop()
        if between:
            while a0 < a1 and b0 < b1 and a[a0] == b[b0]:
                out.append((a0, b0))
                a0, b0 = a0 + 1, b0 + 1
            while a0 < a1 and b0 < b1 and a[a1 - 1] == b[b1 - 1]:
                a1, b1 = a1 - 1, b1 - 1
                out.append((a1, b1))
        if a0 >= a1 or b0 >= b1:
            continue
        anchors = _anchors(a, b, a0, a1, b0, b1)
        if not anchors:
            continue
        out += anchors
        i, j = a0, b0
        for x, y in [*anchors, (a1, b1)]:
            todo.append((i, x, j, y, True))
            i, j = x + 1, y + 1
    return sorted(out)


def shared(counts: Mapping[str, int], places: Mapping[str, np.ndarray], n: int, window: int) -> np.ndarray:
    """For each of ``n`` words of a text: how many words the window that begins there shares with a template.

    Words count as often as they stand in both, by ``counts`` of the template and ``places`` in the text.
    """
    steps = np.zeros(n + 1, np.int64)
    for w, k in counts.items():
        if w in places:
            at = places[w]
            # A place is among a window's first k if the window begins after the k-th place before it.
            after = np.concatenate([np.full(min(k, len(at)), -1), at[:-k]])
            np.add.at(steps, np.maximum(np.maximum(after, at - window) + 1, 0), 1)
            np.add.at(steps, at + 1, -1)
    return np.cumsum(steps[:-1])


def dense(matched: list[tuple[int, int]], least: int, density: float) -> list[tuple[int, int]]:
    """The longest run of at least ``least`` matches, the first one on a tie, that is dense enough in its span."""
    for n in range(len(matched), least - 1, -1):
        for s in range(len(matched) - n + 1):
            if n >= density * (matched[s + n - 1][1] + 1 - matched[s][1]) - 1e-9:
                return matched[s : s + n]
    return []


class Scanner:
    """Finds the templates in a text."""

    def __init__(self, templates: Mapping[str, str], coverage: float, density: float):
        self.coverage, self.density = coverage, density
        self.templates = {n: w for n, t in sorted(templates.items()) if (w := words_of(t))}
        self.counts = {n: Counter(w) for n, w in self.templates.items()}
        self.least = {n: max(1, math.ceil(coverage * len(w) - 1e-9)) for n, w in self.templates.items()}
        self.windows = {n: math.floor(len(w) / max(density, 1e-6) + 1e-9) for n, w in self.templates.items()}
        self.vocabulary = {w for words in self.templates.values() for w in words}

    def scan(self, text: str) -> list[tuple[str, float, int, int]]:
        """Name, coverage and first and last matched word (its end exclusive) of each template found."""
        words = words_of(text)
        present = self.vocabulary.intersection(words)
        able = [
            n for n, c in self.counts.items()
            if sum(k for w, k in c.items() if w in present) >= self.least[n]
        ]
        if not able:
            return []
        places: dict[str, list[int]] = {}
        for i, w in enumerate(words):
            if w in present:
                places.setdefault(w, []).append(i)
        arrays = {w: np.array(p) for w, p in places.items()}
        return [found for n in able if (found := self._best(n, words, arrays))]

    def _best(self, name: str, words: list[str], places: dict[str, np.ndarray]) -> tuple[str, float, int, int] | None:
        template = self.templates[name]
        window, least = self.windows[name], self.least[name]
        bounds = shared(self.counts[name], places, len(words), window)
        begins = np.flatnonzero(bounds >= least)
        best, most, last = None, 0, -1
        for begin in begins[np.argsort(-bounds[begins], kind="stable")].tolist():
            if bounds[begin] < most:
                break
            # A window that can only draw level counts if its first match is earlier.
            if bounds[begin] == most and begin > last:
                continue
            matched = dense(align(template, words[begin : begin + window]), least, self.density)
            if not matched:
                continue
            first, end = begin + matched[0][1], begin + matched[-1][1] + 1
            if best is None or (len(matched), -first) > (most, -best[2]):
                best, most = (name, len(matched) / len(template), first, end), len(matched)
                heads = set(template[: len(template) - most + 1])
                before = ((at := places[w])[: np.searchsorted(at, first)] for w in heads if w in places)
                last = max((int(at[-1]) for at in before if len(at)), default=-1)
        return best


def scanned(
    docs: DataFrame,
    templates: Mapping[str, str] = TEMPLATES,
    text: str = "text",
    out: str = "licenses",
    coverage: float = COVERAGE,
    density: float = DENSITY,
) -> DataFrame:
    """``docs`` with the templates found in the whole ``text``: an array of (name, coverage, begin, end).

    Of each template the place with the most matched words counts, the first one on a tie; ``begin`` and ``end`` count
    words.  The array is sorted by coverage, then by length, both falling, then by name, and is empty for null or empty
    text.  An existing column ``out`` is replaced; all others and repeated rows pass through.
    """
    kept = [c for c in docs.columns if c != out]
    source = docs.select(*(F.col(f"`{c}`") for c in kept), F.col(f"`{text}`").cast("string").alias("__text"))
    found = T.StructType().add("name", "string").add("coverage", "double").add("begin", "long").add("end", "long")
    schema = T.StructType([*source.schema.fields[:-1], T.StructField(out, T.ArrayType(found))])
    arrow = pa.list_(pa.struct([("name", pa.string()), ("coverage", pa.float64()), ("begin", pa.int64()), ("end", pa.int64())]))
    templates = dict(templates)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scanner = Scanner(templates, coverage, density)
        for whole in batches:
            for at in range(0, whole.num_rows, 1024):
                batch = whole.slice(at, 1024)
                rows = [sorted(scanner.scan(t or ""), key=lambda f: (-f[1], f[2] - f[3], f[0])) for t in batch.column(len(kept)).to_pylist()]
                rows = [[dict(zip(found.names, f)) for f in row] for row in rows]
                yield pa.RecordBatch.from_arrays([*batch.columns[:-1], pa.array(rows, arrow)], names=[*kept, out])

    return source.mapInArrow(run, schema)
