"""License texts in documents, by patience alignment.

Words that are unique to both a stretch of text and a template are anchors; the longest
increasing subsequence of their places is kept, and the gaps between are aligned in
the same way. Equal words at both ends of a gap match first. The coverage is the
share of the template's words that are matched.

A stretch is considered only if it has enough of the template's words, which no match
can do without, so nothing is lost by it and every alignment is small. Where anchors
repeat, stretches that may hold more than the alignment found are matched by their
longest common subsequence with the template.
"""

from __future__ import annotations

import bisect
import math
import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .shared import text_of

# Notices, the whole texts of the BSD licenses, and excerpts from the beginnings of
# other license texts. The coverage is that of the excerpt; BSD-beginning begins both BSD texts
# and is the best match only where the rest is not there.
TEMPLATES = {
    "MIT-notice": "Released under the MIT License.",
    "Apache-2.0-notice": "Licensed under the Apache License, Version 2.0.",
    "GPL-3.0-notice": "This work is licensed under the GNU General Public License, version 3.",
    "CC-BY-NC-4.0-notice": "Licensed under CC BY-NC 4.0.",
    "all-rights-reserved": "All rights reserved.",
    "MIT": (
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this "
        "software and associated documentation files (the \"Software\"), to deal in the Software "
        "without restriction, including without limitation the rights to use, copy, modify, merge, "
        "publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons "
        "to whom the Software is furnished to do so, subject to the following conditions: The above "
        "copyright notice and this permission notice shall be included in all copies or substantial "
        "portions of the Software. THE SOFTWARE IS PROVIDED \"AS IS\", WITHOUT WARRANTY OF ANY KIND, "
        "EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS "
        "FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT."
    ),
    "ISC": (
        "Permission to use, copy, modify, and/or distribute this software for any purpose with or "
        "without fee is hereby granted, provided that the above copyright notice and this permission "
        "notice appear in all copies."
    ),
    "Apache-2.0-header": (
        "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file "
        "except in compliance with the License. You may obtain a copy of the License at "
        "http://www.apache.org/licenses/LICENSE-2.0 Unless required by applicable law or agreed to in "
        "writing, software distributed under the License is distributed on an \"AS IS\" BASIS, WITHOUT "
        "WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied."
    ),
    "GPL-header": (
        "This program is free software: you can redistribute it and/or modify it under the terms of "
        "the GNU General Public License as published by the Free Software Foundation, either version "
        "3 of the License, or (at your option) any later version."
    ),
    "BSD-beginning": (
        "Redistribution and use in source and binary forms, with or without modification, are "
        "permitted provided that the following conditions are met: Redistributions of source code "
        "must retain the above copyright notice, this list of conditions and the following disclaimer."
    ),
    "BSD-2-Clause": (
        "Redistribution and use in source and binary forms, with or without modification, are "
        "permitted provided that the following conditions are met: 1. Redistributions of source code "
        "must retain the above copyright notice, this list of conditions and the following disclaimer. "
        "2. Redistributions in binary form must reproduce the above copyright notice, this list of "
        "conditions and the following disclaimer in the documentation and/or other materials provided "
        "with the distribution. THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS "
        "\"AS IS\" AND ANY EXPRESS OR IMPLIED WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE IMPLIED "
        "WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE DISCLAIMED. IN NO EVENT "
        "SHALL THE COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE FOR ANY DIRECT, INDIRECT, INCIDENTAL, "
        "SPECIAL, EXEMPLARY, OR CONSEQUENTIAL DAMAGES (INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF "
        "SUBSTITUTE GOODS OR SERVICES; LOSS OF USE, DATA, OR PROFITS; OR BUSINESS INTERRUPTION) HOWEVER "
        "CAUSED AND ON ANY THEORY OF LIABILITY, WHETHER IN CONTRACT, STRICT LIABILITY, OR TORT (INCLUDING "
        "NEGLIGENCE OR OTHERWISE) ARISING IN ANY WAY OUT OF THE USE OF THIS SOFTWARE, EVEN IF ADVISED OF "
        "THE POSSIBILITY OF SUCH DAMAGE."
    ),
    "BSD-3-Clause": (
        "Redistribution and use in source and binary forms, with or without modification, are "
        "permitted provided that the following conditions are met: 1. Redistributions of source code "
        "must retain the above copyright notice, this list of conditions and the following disclaimer. "
        "2. Redistributions in binary form must reproduce the above copyright notice, this list of "
        "conditions and the following disclaimer in the documentation and/or other materials provided "
        "with the distribution. 3. Neither the name of the copyright holder nor the names of its "
        "contributors may be used to endorse or promote products derived from this software without "
        "specific prior written permission. THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND "
        "CONTRIBUTORS \"AS IS\" AND ANY EXPRESS OR IMPLIED WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE "
        "IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE DISCLAIMED. IN NO "
        "EVENT SHALL THE COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE FOR ANY DIRECT, INDIRECT, INCIDENTAL, "
        "SPECIAL, EXEMPLARY, OR CONSEQUENTIAL DAMAGES (INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF "
        "SUBSTITUTE GOODS OR SERVICES; LOSS OF USE, DATA, OR PROFITS; OR BUSINESS INTERRUPTION) HOWEVER "
        "CAUSED AND ON ANY THEORY OF LIABILITY, WHETHER IN CONTRACT, STRICT LIABILITY, OR TORT (INCLUDING "
        "NEGLIGENCE OR OTHERWISE) ARISING IN ANY WAY OUT OF THE USE OF THIS SOFTWARE, EVEN IF ADVISED OF "
        "THE POSSIBILITY OF SUCH DAMAGE."
    ),
}

_WORD = re.compile(r"[a-z0-9]+")
MATCHES = (
    "doc_id long, license string, coverage double, matched int, template_words int, "
    "start_word int, end_word int, n_licenses int"
)


def words_of(text: str) -> list[str]:
    return _WORD.findall(text.lower())


def longest_increasing(values: list[int]) -> list[int]:
    """Places of a longest strictly increasing subsequence, by patience sorting."""
    tops: list[int] = []
    piles: list[int] = []
    back: list[int] = []
    for i, v in enumerate(values):
        at = bisect.bisect_left(tops, v)
        if at == len(tops):
            tops.append(v)
            piles.append(i)
        else:
            tops[at], piles[at] = v, i
        back.append(piles[at - 1] if at else -1)
    out = []
    i = piles[-1] if piles else -1
    while i >= 0:
        out.append(i)
        i = back[i]
    return out[::-1]


def align(a: list[str], b: list[str]) -> list[tuple[int, int]]:
    """Matched places of two word lists, ascending in both."""
    out: list[tuple[int, int]] = []
    gaps = [(0, len(a), 0, len(b))]
    while gaps:
        a0, a1, b0, b1 = gaps.pop()
        while a0 < a1 and b0 < b1 and a[a0] == b[b0]:
            out.append((a0, b0))
            a0, b0 = a0 + 1, b0 + 1
        while a0 < a1 and b0 < b1 and a[a1 - 1] == b[b1 - 1]:
            a1, b1 = a1 - 1, b1 - 1
            out.append((a1, b1))
        if a0 == a1 or b0 == b1:
            continue
        once_a = {w for w, n in Counter(a[a0:a1]).items() if n == 1}
        count_b = Counter(b[b0:b1])
        place_b = {w: i for i, w in enumerate(b[b0:b1], b0) if count_b[w] == 1 and w in once_a}
        shared = [(i, place_b[w]) for i, w in enumerate(a[a0:a1], a0) if w in place_b]
        if not shared:
            continue
        before = (a0 - 1, b0 - 1)
        for at in [*longest_increasing([j for _, j in shared]), None]:
            here = (a1, b1) if at is None else shared[at]
            if at is not None:
                out.append(here)
            gaps.append((before[0] + 1, here[0], before[1] + 1, here[1]))
            before = here
    return sorted(out)


class Template:
    def __init__(self, name: str, text: str, least: float) -> None:
        self.name, self.words = name, words_of(text)
        if not self.words:
            raise ValueError(f"template {name} has no words")
        self.counts = Counter(self.words)
        self.needed = max(math.ceil(least * len(self.words) - 1e-9), 1)
        self.masks: dict[str, int] = {}
        for i, word in enumerate(self.words):
            self.masks[word] = self.masks.get(word, 0) | 1 << i
        #: A match may be spread over so many words of the text.
        self.spread = 2 * len(self.words)

    def best(self, words: list[str]) -> tuple[int, int, int] | None:
        """Matched words, first and last word of the best match in the text, if it suffices.

        Windows of twice the spread, one beginning at every spread, cover every match. Where
        anchors repeat, as in copies that follow each other, their alignment may be less than
        the best, so stretches that could hold more are matched exactly.
        """
        bounds = self.bounds(words)
        if not bounds:
            return None
        best = None
        for first in sorted({start // self.spread for start in bounds}):
            start = first * self.spread
            pairs = align(words[start : start + 2 * self.spread], self.words)
            low = 0
            for high in range(len(pairs)):
                while pairs[high][0] - pairs[low][0] >= self.spread:
                    low += 1
                n = high - low + 1
                if n >= self.needed and (best is None or n > best[0]):
                    best = (n, start + pairs[low][0], start + pairs[high][0])
        after = 0
        for start, bound in bounds.items():
            least = best[0] if best else self.needed - 1
            if start < after or bound <= least:
                continue
            n, end = self.common(words, start, start + self.spread)
            if n > least:
                best = (n, start, end)
            else:
                # A stretch that begins so many words later has so many more at most.
                after = start + least - n + 1
        if best is None:
            return None
        # The latest beginning from which as many words match up to the same end.
        n, start, _ = best
        _, end = self.common(words, start, best[2] + 1)
        while self.common(words, start + 1, end + 1)[0] == n:
            start += 1
        return n, start, end

    def bounds(self, words: list[str]) -> dict[int, int]:
        """Beginnings of stretches of the spread that begin with a template word and may
        suffice, each with the number of template words it has in any order."""
        inside = np.fromiter(map(self.counts.__contains__, words), dtype=bool, count=len(words))
        at = np.flatnonzero(inside)
        ends = np.searchsorted(at, at + self.spread)
        if not len(at) or (ends - np.arange(len(at))).max() < self.needed:
            return {}
        places = at.tolist()
        held: Counter[str] = Counter()
        out = {}
        n = high = 0
        for low, end in enumerate(ends.tolist()):
            for i in range(high, end):
                word = words[places[i]]
                held[word] += 1
                n += held[word] <= self.counts[word]
            high = end
            if n >= self.needed:
                out[places[low]] = n
            word = words[places[low]]
            n -= held[word] <= self.counts[word]
            held[word] -= 1
        return out

    def common(self, words: list[str], start: int, end: int) -> tuple[int, int]:
        """Length of the longest common subsequence of a stretch and the template, and the
        place of the first word by which it is reached; a bit stands for a template word."""
        free = full = (1 << len(self.words)) - 1
        last = start
        for i in range(start, min(end, len(words))):
            if mask := self.masks.get(words[i]):
                met = free & mask
                after = ((free + met) | (free - met)) & full
                if after.bit_count() < free.bit_count():
                    last = i
                free = after
        return len(self.words) - free.bit_count(), last


def scan_text(text: str, templates: list[Template]) -> list[tuple]:
    """``license, coverage, matched, template_words, start_word, end_word`` of each match."""
    words = words_of(text)
    held = set(words)
    out = []
    for t in templates:
        common = sum(n for w, n in t.counts.items() if w in held)
        if common >= t.needed and (found := t.best(words)):
            n, start, end = found
            out.append((t.name, n / len(t.words), n, len(t.words), start, end))
    return out


def scan_licenses(
    docs: DataFrame, templates: dict[str, str] | None = None, least: float = 0.8
) -> DataFrame:
    """The license each document has most of, one row for each document.

    Returns ``doc_id, license, coverage, matched, template_words, start_word, end_word,
    n_licenses``. The best match has the most matched words, then the highest coverage,
    then the first name. Without a match the license is null and the coverage 0; so it is
    for null and empty texts. Repeated rows stay repeated. Other columns are not read. No
    rows give no rows.
    """
    known = dict(TEMPLATES if templates is None else templates)

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        all_templates = [Template(name, text, least) for name, text in known.items()]
        for batch in batches:
            rows = []
            for doc, text in zip(
                batch.column("doc_id").to_pylist(), batch.column("text").to_pylist(), strict=True
            ):
                found = scan_text(text, all_templates)
                if found:
                    top = min(found, key=lambda m: (-m[2], -m[1], m[0]))
                    rows.append((doc, *top, len(found)))
                else:
                    rows.append((doc, None, 0.0, 0, None, None, None, 0))
            if rows:
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, t) for c, t in zip(zip(*rows), _KINDS, strict=True)],
                    [c.split()[0] for c in MATCHES.split(", ")],
                )

    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_of().alias("text"))
    return texts.mapInArrow(scan, MATCHES)


_KINDS = [
    {"long": pa.int64(), "int": pa.int32(), "string": pa.string(), "double": pa.float64()}[
        c.split()[1]
    ]
    for c in MATCHES.split(", ")
]
