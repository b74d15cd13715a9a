"""License scans: Dice coefficient of word bigrams against license notices.

A unit of text (a line, a sentence of it, a paragraph, the whole text, a run of
words as long as a notice where none of the others holds it) is normalised to
lower-case words of letters and digits and compared with each notice of TEMPLATES
by 2 * |common bigrams| / (|bigrams| + |bigrams|), bigrams as multisets. A unit
can reach the threshold t against a notice of n bigrams only if it has from
n * t / (2 - t) to n * (2 - t) / t bigrams itself; others are passed over. Notices
are few and fixed, so each unit meets only the notices that its size admits and
that share a bigram with it.

Edge cases: a null or empty text has no finding; units of under two words have no
bigrams and none either; repeated notices in a text count once each unit. Each row
stands for itself, so repeated rows repeat. Further columns are ignored.
"""

from __future__ import annotations

import re
from bisect import bisect_left, bisect_right
from collections import Counter, defaultdict
from collections.abc import Iterator
from functools import partial

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.llm.common import map_arrow

THRESHOLD = 0.8

#: The notices by which a text states its license, and the bodies of short licenses.
TEMPLATES = {
    "MIT": ["Released under the MIT License.", "Licensed under the MIT License.", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files, to deal in the Software without restriction.", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the \"Software\"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions:", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the \"Software\"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions: The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software. THE SOFTWARE IS PROVIDED \"AS IS\", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE."],
    "Apache-2.0": ["Licensed under the Apache License, Version 2.0.", "Licensed under the Apache License, Version 2.0 (the License); you may not use this file except in compliance with the License."],
    "GPL-3.0": ["This work is licensed under the GNU General Public License, version 3.", "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation, either version 3 of the License, or any later version."],
    "GPL-2.0": ["This work is licensed under the GNU General Public License, version 2."],
    "LGPL-3.0": ["This library is licensed under the GNU Lesser General Public License, version 3."],
    "AGPL-3.0": ["This work is licensed under the GNU Affero General Public License, version 3."],
    "BSD-3-Clause": ["Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met.", "Released under the BSD 3-Clause License.", "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met: 1. Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer. 2. Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the documentation and/or other materials provided with the distribution. 3. Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission."],
    "MPL-2.0": ["This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0."],
    "CC-BY-4.0": ["Licensed under CC BY 4.0.", "This work is licensed under a Creative Commons Attribution 4.0 International License."],
    "CC-BY-SA-4.0": ["Licensed under CC BY-SA 4.0.", "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License."],
    "CC-BY-NC-4.0": ["Licensed under CC BY-NC 4.0.", "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License."],
    "CC-BY-ND-4.0": ["Licensed under CC BY-ND 4.0.", "This work is licensed under a Creative Commons Attribution-NoDerivatives 4.0 International License."],
    "CC-BY-NC-SA-4.0": ["Licensed under CC BY-NC-SA 4.0.", "This work is licensed under a Creative Commons Attribution-NonCommercial-ShareAlike 4.0 International License."],
    "CC-BY-NC-ND-4.0": ["Licensed under CC BY-NC-ND 4.0.", "This work is licensed under a Creative Commons Attribution-NonCommercial-NoDerivatives 4.0 International License."],
    "CC0-1.0": ["To the extent possible under law, the author has waived all copyright and related rights to this work."],
    "ISC": ["Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted.", "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies. THE SOFTWARE IS PROVIDED \"AS IS\" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT, INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS, WHETHER IN AN ACTION OF CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH THE USE OR PERFORMANCE OF THIS SOFTWARE."],
    "Zlib": ["This software is provided 'as-is', without any express or implied warranty. In no event will the authors be held liable for any damages arising from the use of this software. Permission is granted to anyone to use this software for any purpose, including commercial applications, and to alter it and redistribute it freely."],
    "Unlicense": ["This is free and unencumbered software released into the public domain."],
}

_WORD = re.compile(r"[a-z0-9]+")
_END = re.compile(r"(?<=[.!?])\s+(?=\S)")
_GAP = re.compile(r"\n\s*\n")


def bigrams(text: str) -> list[tuple[str, str]]:
    words = _WORD.findall(text.lower())
    return list(zip(words, words[1:], strict=False))


class Notices:
    """Templates as (name, bigrams) with their sizes, and the notices that hold a bigram."""

    def __init__(self, templates: dict[str, list[str]], threshold: float) -> None:
        self.threshold = threshold
        self.known = [(name, Counter(bigrams(t))) for name, ts in templates.items() for t in ts]
        self.sizes = [sum(c.values()) for _, c in self.known]
        self.holds: dict[tuple[str, str], list[int]] = defaultdict(list)
        for i, (_, c) in enumerate(self.known):
            for b in c:
                self.holds[b].append(i)

    def dice(self, i: int, pairs: list[tuple[str, str]]) -> float:
        return 2 * sum((Counter(pairs) & self.known[i][1]).values()) / (self.sizes[i] + len(pairs))


def units(text: str, notices: Notices | None = None) -> Iterator[str]:
    """Lines, sentences of lines, paragraphs and the whole text, each once, and notices that run on over their bounds."""
    lines = text.split("\n")
    yield from lines
    for line in lines:
        parts = _END.split(line)
        if len(parts) > 1:
            yield from parts
    if len(lines) > 1:
        paragraphs = _GAP.split(text)
        if len(paragraphs) > 1:
            yield from (p for p in paragraphs if "\n" in p)
        yield text
    yield from _wrapped(text, notices or _NOTICES)


def _wrapped(text: str, notices: Notices) -> Iterator[str]:
    """Runs of as many words as a notice that reach the threshold, where no sentence, line, paragraph or text around them does."""
    words = _WORD.findall(text.lower())
    pairs = list(zip(words, words[1:], strict=False))
    holds = notices.holds
    places: dict[int, list[int]] = defaultdict(list)
    for at, b in enumerate(pairs):
        if b in holds:
            for i in holds[b]:
                places[i].append(at)
    found: list[tuple[float, int, int, int]] = []
    for i, own in places.items():
        n = notices.sizes[i]
        for k, at in enumerate(own):
            # A run of n bigrams that reaches the threshold begins, without loss, at a bigram of the notice.
            if bisect_left(own, at + n, k) - k >= notices.threshold * n / (2 - notices.threshold) and (dice := notices.dice(i, pairs[at : at + n])) >= notices.threshold:
                found.append((-dice, at, at + min(n, len(pairs) - at), i))
    if not found:
        return
    marks = [0] * 3
    labels = []  # paragraph, line and sentence of each word
    for paragraph in _GAP.split(text):
        for line in paragraph.split("\n"):
            for sentence in _END.split(line):
                labels += [tuple(marks)] * len(_WORD.findall(sentence.lower()))
                marks[2] += 1
            marks[1] += 1
        marks[0] += 1
    taken: dict[str, list[tuple[int, int]]] = defaultdict(list)
    bounds = [[0, *(i for i in range(1, len(words)) if labels[i][c] != labels[i - 1][c]), len(words)] for c in range(3)] + [[0, len(words)]]
    for name, c in {(notices.known[f[3]][0], c) for f in found for c in range(4)}:
        mine = [i for i, (x, _) in enumerate(notices.known) if x == name]
        spans = {(b[j], b[j + 1]) for b in (bounds[c],) for _, s, e, i in found if notices.known[i][0] == name for j in range(bisect_right(b, s) - 1, bisect_left(b, e + 1))}
        for s, e in spans:
            near = [i for i in mine if notices.sizes[i] * notices.threshold / (2 - notices.threshold) <= e - s - 1 <= notices.sizes[i] * (2 - notices.threshold) / notices.threshold]
            if any(notices.dice(i, pairs[s : e - 1]) >= notices.threshold for i in near):
                taken[name].append((s, e - 1))
    for _, s, e, i in sorted(found):
        name = notices.known[i][0]
        if all(e <= x or y <= s for x, y in taken[name]):
            taken[name].append((s, e))
            yield " ".join(words[s : e + 1])


_NOTICES = Notices(TEMPLATES, THRESHOLD)


def _scan(batches: Iterator[pa.RecordBatch], templates: dict[str, list[str]], threshold: float) -> Iterator[pa.RecordBatch]:
    notices = Notices(templates, threshold)
    known, sizes, holds = notices.known, notices.sizes, notices.holds
    low, high = min(sizes) * threshold / (2 - threshold), max(sizes) * (2 - threshold) / threshold
    for batch in batches:
        out = []
        for doc_id, text in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            best: dict[str, tuple[float, int]] = {}
            for unit in units(text, notices) if text else ():
                spaces = unit.count(" ") if len(unit) < 4000 else None
                if spaces is not None and spaces + len(unit) // 2 < low:  # too short to hold as many words
                    continue
                pairs = bigrams(unit)
                if not low <= len(pairs) <= high:
                    continue
                own = None
                for i in sorted({i for b in pairs for i in holds.get(b, ())}):
                    name, notice = known[i]
                    n = sizes[i]
                    if n * threshold / (2 - threshold) <= len(pairs) <= n * (2 - threshold) / threshold:
                        own = own or Counter(pairs)
                        dice = 2 * sum((own & notice).values()) / (n + len(pairs))
                        if dice >= threshold:
                            found = best.get(name, (0.0, 0))
                            best[name] = (max(found[0], dice), found[1] + 1)
            out += [(doc_id, name, round(dice, 6), n) for name, (dice, n) in sorted(best.items())]
        columns = list(zip(*out, strict=True)) or [()] * 4
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, (pa.int64(), pa.string(), pa.float64(), pa.int64()), strict=True)], names=["doc_id", "license", "dice", "n_units"])


def scanned(docs: DataFrame, templates: dict[str, list[str]] | None = None, threshold: float = THRESHOLD) -> DataFrame:
    """(doc_id, license, dice, n_units): notices found, the best coefficient and in how many units."""
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    return map_arrow(rows, partial(_scan, templates=templates or TEMPLATES, threshold=threshold), "doc_id long, license string, dice double, n_units long")
