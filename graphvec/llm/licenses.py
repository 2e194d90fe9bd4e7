"""License scans: winnowed template fingerprints, then banded alignment.

Each template is cut into words; of its 3-word shingles, winnowing keeps the smallest hash in
every 3 neighbours, and an inverted index maps the kept ones to (template, position).  All of a
document's shingles are looked up, so five equal words in a row are enough to meet.  Hits on
one template that lie within its reach form a candidate region, where a Smith-Waterman
alignment in a band around the hits' diagonals gives the matched words, the coverage and the
span in characters.  The band takes in all hits whose diagonals differ by the template's length at most: words
put in between cost one each and a matched word counts two, so a longer gap never pays.

Edge cases: null and empty texts have no spans; several regions of one license in a text are
all reported; of overlapping regions with different licenses all that reach the coverage are
reported; repeated rows are scanned alike; extra columns are ignored.
"""

from __future__ import annotations

import re
from collections.abc import Iterator, Mapping

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# License notices as published.
TEMPLATES = {
    "MIT-notice": "Released under the MIT License.",
    "Apache-2.0-notice": "Licensed under the Apache License, Version 2.0.",
    "GPL-3.0-notice": "This work is licensed under the GNU General Public License, version 3.",
    "CC-BY-NC-4.0-notice": "Licensed under CC BY-NC 4.0.",
    "MIT": """Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation
files (the "Software"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge,
publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so,
subject to the following conditions: The above copyright notice and this permission notice shall be included in all copies or substantial
portions of the Software.""",
    "ISC": """Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided
that the above copyright notice and this permission notice appear in all copies.""",
    "BSD-3-Clause": """Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following
conditions are met: Redistributions of source code must retain the above copyright notice, this list of conditions and the following
disclaimer. Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer
in the documentation and/or other materials provided with the distribution. Neither the name of the copyright holder nor the names of its
contributors may be used to endorse or promote products derived from this software without specific prior written permission.""",
    "Apache-2.0": """Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in compliance with the License.
You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0 Unless required by applicable law or agreed to in writing,
software distributed under the License is distributed on an "AS IS" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or
implied. See the License for the specific language governing permissions and limitations under the License.""",
    "GPL-3.0": """This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as
published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version. This program is distributed
in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even the implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR
PURPOSE. See the GNU General Public License for more details.""",
    "MPL-2.0": """This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not distributed
with this file, You can obtain one at http://mozilla.org/MPL/2.0/.""",
    "CC0-1.0": """To the extent possible under law, the author has waived all copyright and related or neighboring rights to this work.""",
    "Unlicense": """This is free and unencumbered software released into the public domain. Anyone is free to copy, modify, publish, use, compile,
sell, or distribute this software, either in source code form or as a compiled binary, for any purpose, commercial or non-commercial, and by
any means.""",
}
SHINGLE = 3
WINNOW = 3
BAND = 8
MIN_COVERAGE = 0.8
WORD = re.compile(r"[^\W_]+")


class Index:
    """Templates as word numbers and the inverted index of their winnowed shingles."""

    def __init__(self, templates: Mapping[str, str]):
        words = {name: WORD.findall(text.lower()) for name, text in templates.items()}
        self.number = {w: i for i, w in enumerate(sorted({w for ws in words.values() for w in ws}))}
        self.base = max(2, len(self.number))
        self.names = sorted(words)
        self.ids = [[self.number[w] for w in words[n]] for n in self.names]
        places: dict[int, list[tuple[int, int]]] = {}
        for t, ids in enumerate(self.ids):
            codes = [self._code(ids[i : i + SHINGLE]) for i in range(len(ids) - SHINGLE + 1)]
            hashes = [xxhash.xxh64_intdigest(c.to_bytes(8, "little")) for c in codes]
            kept = {min(range(i, min(i + WINNOW, len(codes))), key=lambda k: (hashes[k], -k)) for i in range(max(1, len(codes) - WINNOW + 1))} if codes else set()
            for i in kept:
                places.setdefault(codes[i], []).append((t, i))
        self.places = places
        self.codes = np.array(sorted(places), np.int64)

    def _code(self, ids: list[int]) -> int:
        code = 0
        for i in ids:
            code = code * self.base + i
        return code

    def hits(self, words: list[str]) -> list[tuple[int, int, int]]:
        """(template, position in the document, position in the template)."""
        if len(words) < SHINGLE or not len(self.codes):
            return []
        get = self.number.get
        a = np.fromiter((get(w, -1) for w in words), np.int64, len(words))
        at = np.flatnonzero((a[:-2] >= 0) & (a[1:-1] >= 0) & (a[2:] >= 0))
        code = (a[at] * self.base + a[at + 1]) * self.base + a[at + 2]
        k = np.minimum(np.searchsorted(self.codes, code), len(self.codes) - 1)
        found = self.codes[k] == code
        return [(t, int(p), i) for p, c in zip(at[found], code[found]) for t, i in self.places[int(c)]]


def align(doc: list[int], template: list[int], low: int, high: int) -> tuple[int, int, int]:
    """Best local alignment on diagonals low to high (document minus template position):
    matched words, and the first and last document word of it."""
    nothing = (0, 0, -1, -1)  # score, matched, first, last
    best, before = nothing, [nothing] * (high - low + 1)
    for i, want in enumerate(template):
        row = [nothing] * len(before)
        for k in range(len(row)):
            j = i + low + k
            if not 0 <= j < len(doc):
                continue
            score, matched, first, _ = before[k]
            if doc[j] == want:
                cell = (score + 2, matched + 1, first if first >= 0 else j, j)
            else:
                cell = (score - 1, matched, first, before[k][3])
                if k + 1 < len(row) and before[k + 1][0] - 1 > cell[0]:
                    cell = (before[k + 1][0] - 1, *before[k + 1][1:])
                if k and row[k - 1][0] - 1 > cell[0]:
                    cell = (row[k - 1][0] - 1, *row[k - 1][1:])
            row[k] = cell if cell[0] > 0 else nothing
            if row[k][0] > best[0]:
                best = row[k]
        before = row
    return best[1], best[2], best[3]


def scan(text: str, index: Index, band: int = BAND, min_coverage: float = MIN_COVERAGE) -> list[tuple[str, int, int, float, int, int]]:
    """(license, matched words, template words, coverage, start, end) of each match."""
    words = WORD.findall(text.lower())
    hits = sorted(index.hits(words))
    if not hits:
        return []
    # lower() can change the number of characters, so places come from the words of the text itself
    spans = [m.span() for m in WORD.finditer(text)]
    if len(spans) != len(words):
        words, spans = zip(*[(m.group().lower(), m.span()) for m in WORD.finditer(text)])
        hits = sorted(index.hits(list(words)))
    out = []
    k = 0
    while k < len(hits):
        t, p, i = hits[k]
        ids, low, high, last, at = index.ids[t], p - i, p - i, p, i
        k += 1
        # a hit further back in the template begins the next copy of it
        while k < len(hits) and hits[k][0] == t and abs(hits[k][1] - hits[k][2] - low) <= max(2 * band, len(ids)) and hits[k][1] - last <= 2 * len(ids) and hits[k][2] > at:
            _, last, at = hits[k]
            low, high = min(low, last - at), max(high, last - at)
            k += 1
        near = min(band, max(1, len(ids) // 2))  # so that the next copy of a short template stays outside
        a, b = max(0, low - near), min(len(words), high + len(ids) + near)
        region = [index.number.get(w, -1) for w in words[a:b]]
        matched, first, final = align(region, ids, low - near - a, high + near - a)
        if matched >= min_coverage * len(ids):
            out.append((index.names[t], matched, len(ids), matched / len(ids), spans[a + first][0], spans[a + final][1]))
    return sorted(set(out))


def find_licenses(docs: DataFrame, templates: Mapping[str, str] = TEMPLATES, text_col: str = "text", band: int = BAND, min_coverage: float = MIN_COVERAGE) -> DataFrame:
    """One row for each match: doc_id, license, n_matched, n_template, coverage, and the span
    [start, end) in characters."""
    held = dict(templates)
    types = [pa.int64(), pa.string(), pa.int64(), pa.int64(), pa.float64(), pa.int64(), pa.int64()]
    names = ["doc_id", "license", "n_matched", "n_template", "coverage", "start", "end"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        index = Index(held)
        for b in batches:
            rows = [(d, *x) for d, t in zip(b.column(0).to_pylist(), b.column(1).to_pylist()) if t for x in scan(t, index, band, min_coverage)]
            cols = list(zip(*rows)) or [()] * len(types)
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, types)], names=names)

    return docs.select(F.col("doc_id").cast("bigint"), F.col(text_col).cast("string")).mapInArrow(
        run, "doc_id bigint, license string, n_matched bigint, n_template bigint, coverage double, start bigint, end bigint")
