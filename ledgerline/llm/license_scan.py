"""License scans by patience alignment of texts with license templates.

Text and template are words (lower case, punctuation dropped). In a gap (at first the
whole), equal words at both ends are matched; then words that occur once in the text's
part and once in the template's are anchors, the longest increasing subsequence of
their positions is matched, and the gaps between are aligned in the same way. A gap
without anchors, however large, is matched by its longest common subsequence. Coverage is the
share of the template's words that are matched.

A text is aligned in windows that begin at every multiple of the template's length, where
enough of the template's words stand to reach ``COVERAGE`` at all; so a license that
occurs twice, or deep in a long text, is found, and no window grows with the text. Windows
are twice the template, and also as long as the longest stretch that ``DENSITY`` allows
and the template more: every such stretch lies whole in one of these. If matches of a
window span too much, the stretch that holds most of them is aligned again. A template is
found where coverage is at least ``COVERAGE`` and the matched words fill ``DENSITY`` of
the stretch that they span.

Rows: a null or empty text has no license; null and repeated ids pass through, one result
row per input row; of templates that cover equally the longest counts as best, then the
first by name; an empty table gives no rows; only ``doc_id`` and ``text`` are read.
"""

from __future__ import annotations

import re
from bisect import bisect_left
from collections import Counter
from math import ceil

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from .common import doc_texts, slices

COVERAGE, DENSITY = 0.8, 0.5

#: License statements and notices as their owners publish them.
TEMPLATES = {
    "apache-2.0": "Licensed under the Apache License, Version 2.0.",
    "apache-2.0-notice": (
        "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in compliance "
        "with the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0 Unless "
        "required by applicable law or agreed to in writing, software distributed under the License is distributed on an "
        "\"AS IS\" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. See the License for the "
        "specific language governing permissions and limitations under the License."),
    "bsd-2-clause": (
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the "
        "following conditions are met: 1. Redistributions of source code must retain the above copyright notice, this list "
        "of conditions and the following disclaimer. 2. Redistributions in binary form must reproduce the above copyright "
        "notice, this list of conditions and the following disclaimer in the documentation and/or other materials provided "
        "with the distribution."),
    "cc-by-4.0": "Licensed under CC BY 4.0.",
    "cc-by-nc-4.0": "Licensed under CC BY-NC 4.0.",
    "gpl-3.0": "This work is licensed under the GNU General Public License, version 3.",
    "gpl-3.0-notice": (
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public "
        "License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any "
        "later version."),
    "isc": (
        "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby "
        "granted, provided that the above copyright notice and this permission notice appear in all copies."),
    "mit": "Released under the MIT License.",
    "mit-notice": (
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated "
        "documentation files (the \"Software\"), to deal in the Software without restriction, including without limitation "
        "the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to "
        "permit persons to whom the Software is furnished to do so, subject to the following conditions: The above copyright "
        "notice and this permission notice shall be included in all copies or substantial portions of the Software."),
}

_WORD = re.compile(r"\w+(?:\.\w+)*")


def words_of(text: str) -> list[str]:
    return _WORD.findall(text.lower())


def increasing(values: list[int]) -> list[int]:
    """Indices of a longest increasing subsequence, by patience sorting with back links."""
    tops, piles, back = [], [], [0] * len(values)
    for i, v in enumerate(values):
        k = bisect_left(tops, v)
        back[i] = piles[k - 1] if k else -1
        if k == len(tops):
            tops.append(v)
            piles.append(i)
        else:
            tops[k], piles[k] = v, i
    out, i = [], piles[-1] if piles else -1
    while i >= 0:
        out.append(i)
        i = back[i]
    return out[::-1]


def _lengths(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Length of the longest common subsequence of ``a`` with every beginning of ``b`` (one row of the table at a time)."""
    row = np.zeros(len(b) + 1, np.int64)
    for x in a:
        row[1:] = np.maximum.accumulate(np.maximum(row[1:], np.where(b == x, row[:-1] + 1, 0)))
    return row


def _common(a: np.ndarray, b: np.ndarray, at_a: int, at_b: int) -> list[tuple[int, int]]:
    """A longest common subsequence of a gap, in space that grows with its sides only.

    The longer side is halved; the split of the other at which both halves' lengths add up to most is on a
    longest common subsequence, and each half is a gap of its own.
    """
    out, gaps = [], [(0, len(a), 0, len(b))]
    while gaps:
        i, m, j, n = gaps.pop()
        if i == m or j == n:
            continue
        if m - i == 1 or n - j == 1:
            p, q = np.nonzero(a[i:m, None] == b[None, j:n])
            if len(p):
                out.append((at_a + i + int(p[0]), at_b + j + int(q[0])))
            continue
        if m - i >= n - j:
            half = (i + m) // 2
            cut = j + int(np.argmax(_lengths(a[i:half], b[j:n]) + _lengths(a[half:m][::-1], b[j:n][::-1])[::-1]))
            gaps += [(i, half, j, cut), (half, m, cut, n)]
        else:
            half = (j + n) // 2
            cut = i + int(np.argmax(_lengths(b[j:half], a[i:m]) + _lengths(b[half:n][::-1], a[i:m][::-1])[::-1]))
            gaps += [(i, cut, j, half), (cut, m, half, n)]
    return out


def align(a: list[str], b: list[str]) -> list[tuple[int, int]]:
    """Matched positions of two word lists, increasing in both."""
    out, gaps = [], [(0, len(a), 0, len(b))]
    while gaps:
        i, m, j, n = gaps.pop()
        while i < m and j < n and a[i] == b[j]:
            out.append((i, j))
            i, j = i + 1, j + 1
        while i < m and j < n and a[m - 1] == b[n - 1]:
            m, n = m - 1, n - 1
            out.append((m, n))
        if i == m or j == n:
            continue
        in_a, in_b = Counter(a[i:m]), Counter(b[j:n])
        where = {w: k for k, w in enumerate(b[j:n], j) if in_b[w] == 1 and in_a.get(w) == 1}
        if where:
            anchors = [(k, where[w]) for k, w in enumerate(a[i:m], i) if w in where]
            chain = [anchors[x] for x in increasing([q for _, q in anchors])]
            out.extend(chain)
            for (p, q), (r, s) in zip([(i - 1, j - 1), *chain], [*chain, (m, n)]):
                gaps.append((p + 1, r, q + 1, s))
        else:
            number = {w: k for k, w in enumerate(in_b)}
            part = np.array([number.get(w, -1) for w in a[i:m]], np.int64)
            held = np.flatnonzero(part >= 0)             # words that the template's part does not have match nothing
            chain = _common(part[held], np.array([number[w] for w in b[j:n]], np.int64), 0, j)
            out.extend((i + int(held[p]), q) for p, q in chain)
    return sorted(out)


def _placed(words: list[str], start: int, stop: int, template: list[str], longest: int) -> tuple[float, int, int] | None:
    """``(coverage, -first word, end word)`` of the template in a window, if it meets the limits."""
    matched = align(words[start:stop], template)
    if len(matched) < COVERAGE * len(template):
        return None
    first, end = matched[0][0], matched[-1][0] + 1
    if len(matched) < DENSITY * (end - first):
        if stop - start <= longest:
            return None
        at = [p for p, _ in matched]
        begin = max(at, key=lambda p: (bisect_left(at, p + longest) - bisect_left(at, p), -p))
        return _placed(words, start + begin, min(stop, start + begin + longest), template, longest)
    return len(matched) / len(template), -(start + first), start + end


class Scanner:
    """Templates prepared for scanning texts."""

    def __init__(self, templates: dict[str, str]):
        self.words = {name: words_of(t) for name, t in sorted(templates.items())}
        self.vocabulary = {w for ws in self.words.values() for w in ws}
        self.sets = {name: Counter(ws) for name, ws in self.words.items()}

    def scan(self, text: str) -> list[tuple[str, float, int, int]]:
        """``(name, coverage, first word, end word)`` of every template found, the best place of each."""
        words = words_of(text)
        hits = [i for i, w in enumerate(words) if w in self.vocabulary]
        if not hits:
            return []
        found, held = [], Counter([words[i] for i in hits])
        for name, template in self.words.items():
            counts, n = self.sets[name], len(template)
            if sum(min(c, held[w]) for w, c in counts.items() if w in held) < COVERAGE * n:
                continue                          # no window has more of the template than the text
            step = n
            blocks: dict[int, Counter] = {}
            for i in hits:
                if words[i] in counts:
                    blocks.setdefault(i // step, Counter())[words[i]] += 1
            longest = ceil(n / DENSITY)
            wide = ceil(longest / step) + 1       # blocks in which a stretch of that length stands, wherever it begins
            best = None
            for k in {k - d for k in blocks for d in range(wide)}:
                if k < 0:                         # the first block stands in the window that begins with it
                    continue
                near, seen = Counter(), 0
                for size in (2, wide):
                    while seen < size:
                        near.update(blocks.get(k + seen, ()))
                        seen += 1
                    if near.total() < COVERAGE * n or sum(min(c, near[w]) for w, c in counts.items()) < COVERAGE * n:
                        continue
                    candidate = _placed(words, k * step, (k + size) * step, template, longest)
                    if candidate:
                        best = max(best, candidate) if best else candidate
                        if candidate[0] == 1.0:   # the wider window has no more
                            break
            if best:
                found.append((name, best[0], -best[1], best[2]))
        return found


def scan_documents(docs: DataFrame, templates: dict[str, str] | None = None) -> DataFrame:
    """One row per document: best ``license`` with ``coverage, first_word, end_word``, and all ``licenses`` found."""
    templates = dict(TEMPLATES if templates is None else templates)
    src = doc_texts(docs)

    def run(batches):
        scanner = Scanner(templates)
        size = {name: len(ws) for name, ws in scanner.words.items()}
        for b in slices(batches):
            out = {k: [] for k in ("license", "coverage", "first_word", "end_word", "licenses")}
            for text in b.column(1).to_pylist():
                found = scanner.scan(text)
                top = min(found, key=lambda f: (-f[1], -size[f[0]], f[0]), default=(None, 0.0, None, None))
                for k, v in zip(out, (*top, [f[0] for f in found])):
                    out[k].append(v)
            yield pa.RecordBatch.from_arrays(
                [b.column(0), pa.array(out["license"], pa.string()), pa.array(out["coverage"], pa.float64()),
                 pa.array(out["first_word"], pa.int64()), pa.array(out["end_word"], pa.int64()),
                 pa.array(out["licenses"], pa.list_(pa.string()))], ["doc_id", *out])

    kind = src.schema["doc_id"].dataType.simpleString()
    return src.mapInArrow(run, f"doc_id {kind}, license string, coverage double, first_word long, end_word long, licenses array<string>")
