"""License scans by patience alignment.

Words are runs of ASCII letters and digits in lower case.  A text is compared
with every template of ``TEMPLATES``.  Words that occur once in the stretch of
text and once in the template are anchors; the longest increasing subsequence
of their positions is kept, and the gaps between the kept anchors are aligned
the same way, after their common beginnings and ends.  Coverage is the share
of the template's words that are aligned; a template is found where it
reaches MIN_COVERAGE.

Which stretches are aligned: those around enough of the template's own words
(its words that are not in COMMON).  A place where MIN_COVERAGE of the words
align holds at least that share less the common words, so nothing that could
be found is passed over.  Stretches are at most SPREAD times as long as the
template, and one text can hold a template more than once.  Of overlapping
finds the one with the highest product of coverage and aligned share of its
stretch is reported.

Null and empty texts hold no template.  Rows are scanned one by one, repeated
ones too; an empty table gives no rows.
"""

from __future__ import annotations

from bisect import bisect_left
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from odflow.llm.common import table
from odflow.llm.textvec import WordHasher, stretches

MIN_COVERAGE = 0.8
SPREAD = 1.5

# Notices and license texts by SPDX id.
TEMPLATES = {
    "Apache-2.0": [
        "Licensed under the Apache License, Version 2.0.",
        "you may not use this file except in compliance with the License. You may obtain a copy of the License at"
        " http://www.apache.org/licenses/LICENSE-2.0 Unless required by applicable law or agreed to in writing, software"
        " distributed under the License is distributed on an \"AS IS\" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND,"
        " either express or implied. See the License for the specific language governing permissions and limitations under"
        " the License.",
    ],
    "BSD-3-Clause": [
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the"
        " following conditions are met: Redistributions of source code must retain the above copyright notice, this list of"
        " conditions and the following disclaimer. Redistributions in binary form must reproduce the above copyright notice,"
        " this list of conditions and the following disclaimer in the documentation and/or other materials provided with the"
        " distribution. Neither the name of the copyright holder nor the names of its contributors may be used to endorse or"
        " promote products derived from this software without specific prior written permission.",
        "Released under the BSD 3-Clause License.",
    ],
    "CC-BY-4.0": ["Licensed under CC BY 4.0.", "This work is licensed under a Creative Commons Attribution 4.0 International License."],
    "CC-BY-NC-4.0": ["Licensed under CC BY-NC 4.0.", "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License."],
    "CC-BY-SA-4.0": ["Licensed under CC BY-SA 4.0.", "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License."],
    "GPL-3.0": [
        "This work is licensed under the GNU General Public License, version 3.",
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public"
        " License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any"
        " later version. This program is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without"
        " even the implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. See the GNU General Public"
        " License for more details.",
    ],
    "ISC": [
        "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby"
        " granted, provided that the above copyright notice and this permission notice appear in all copies.",
    ],
    "MIT": [
        "Released under the MIT License.",
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated"
        " documentation files (the \"Software\"), to deal in the Software without restriction, including without limitation"
        " the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to"
        " permit persons to whom the Software is furnished to do so, subject to the following conditions: The above copyright"
        " notice and this permission notice shall be included in all copies or substantial portions of the Software.",
    ],
    "MPL-2.0": [
        "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not"
        " distributed with this file, You can obtain one at https://mozilla.org/MPL/2.0/.",
    ],
    "Unlicense": ["This is free and unencumbered software released into the public domain."],
    "all-rights-reserved": ["All rights reserved."],
}
# Words too common in any text to start a comparison.
COMMON = frozenset("a all an and any are as at be by can do for from if in is it its may not of on one or see so that the this to use was with you".split())


def patience(a: list, b: list) -> list[tuple[int, int]]:
    """Pairs (i, j) of equal, aligned items of a and b, rising in both."""
    out, todo = [], [(0, len(a), 0, len(b))]
    while todo:
        i, i_end, j, j_end = todo.pop()
        while i < i_end and j < j_end and a[i] == b[j]:
            out.append((i, j))
            i, j = i + 1, j + 1
        while i < i_end and j < j_end and a[i_end - 1] == b[j_end - 1]:
            i_end, j_end = i_end - 1, j_end - 1
            out.append((i_end, j_end))
        if i >= i_end or j >= j_end:
            continue
        anchors = _rising(sorted(_once(a, i, i_end, b, j, j_end)))
        if not anchors:
            continue
        for x, y in [*anchors, (i_end, j_end)]:
            todo.append((i, x, j, y))
            if x < i_end:
                out.append((x, y))
            i, j = x + 1, y + 1
    return sorted(out)


def _once(a: list, i: int, i_end: int, b: list, j: int, j_end: int) -> list[tuple[int, int]]:
    def places(items, start, end):
        at: dict = {}
        for k in range(start, end):
            at[items[k]] = -1 if items[k] in at else k
        return at
    in_b = places(b, j, j_end)
    return [(x, in_b[w]) for w, x in places(a, i, i_end).items() if x >= 0 and in_b.get(w, -1) >= 0]


def _rising(pairs: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """Longest subsequence that rises in the second place too."""
    tops: list[int] = []
    piles: list[int] = []
    back = [-1] * len(pairs)
    for k, (_, y) in enumerate(pairs):
        p = bisect_left(tops, y)
        back[k] = piles[p - 1] if p else -1
        if p == len(tops):
            tops.append(y)
            piles.append(k)
        else:
            tops[p], piles[p] = y, k
    out, k = [], piles[-1] if piles else -1
    while k >= 0:
        out.append(pairs[k])
        k = back[k]
    return out[::-1]


class LicenseScanner:
    def __init__(self, templates: dict[str, list[str]] | None = None) -> None:
        self.hasher = WordHasher(5)
        self.hasher.space = np.ones(256, bool)
        for first, last in ((48, 58), (65, 91), (97, 123)):
            self.hasher.space[first:last] = False
        self.templates = []
        own: set[int] = set()
        common = set(self._words(" ".join(sorted(COMMON))))
        for name, texts in (templates or TEMPLATES).items():
            for n, text in enumerate(texts):
                words = self._words(text)
                keys = set(words) - common
                # what a place of enough coverage holds at least, each repeated word counted once
                loose = len(words) - int(np.ceil(MIN_COVERAGE * len(words)))
                least = max(1, len(keys) - loose)
                single = {w: i for i, w in enumerate(words) if w in keys and words.count(w) == 1}
                single = single or {w: words.index(w) for w in keys}
                self.templates.append((name, n, words, keys, least, single, max(1, len(single) - loose)))
                own |= keys
        self.own = np.array(sorted(own), np.uint64)

    def _words(self, text: str) -> list[int]:
        data = np.frombuffer(text.encode(), np.uint8)
        return self.hasher.words(data, np.array([0, len(data)]))[0].tolist()

    def column(self, column: pa.Array):
        """(row, [(license, template, coverage, first byte, end byte)], data) of
        the texts with a template."""
        for row, data, offsets in stretches(column):
            h, bounds, s, e = self.hasher.words(data, offsets)
            at = np.minimum(np.searchsorted(self.own, h), len(self.own) - 1)
            hits = np.flatnonzero(self.own[at] == h)
            per_text = np.searchsorted(hits, bounds)
            for d in np.flatnonzero(np.diff(per_text)):
                mine = hits[per_text[d]:per_text[d + 1]]
                found = self.text(h, mine, int(bounds[d]), int(bounds[d + 1]))
                if found:
                    spans = [(name, n, share, int(s[x] - offsets[d]), int(e[y] - offsets[d])) for name, n, share, x, y in found]
                    yield row + int(d), spans, data[offsets[d]:offsets[d + 1]]

    def text(self, h: np.ndarray, hits: np.ndarray, begin: int, end: int) -> list[tuple]:
        """(license, template, coverage, first word, last word) in one text."""
        out = []
        words = h[hits].tolist()
        present = set(words)
        for name, n, template, keys, least, single, least_single in self.templates:
            if len(keys & present) < least:
                continue
            at = [(int(p), w) for p, w in zip(hits, words) if w in single]
            for pairs, x, y in self._copies(h, at, template, single, least_single, begin, end):
                share = pairs / len(template)
                out.append((share * pairs / (y + 1 - x), pairs, name, n, share, x, y))
        # where templates overlap, the one that accounts for most of its stretch and itself, then the longest
        kept: list[tuple] = []
        for _, _, name, n, share, x, y in sorted(out, key=lambda o: (-o[0], -o[1], o[2], o[3], o[5])):
            if all(y < k[3] or x > k[4] for k in kept):
                kept.append((name, n, share, x, y))
        return sorted(kept, key=lambda k: k[3])

    @staticmethod
    def _copies(h: np.ndarray, at: list[tuple[int, int]], template: list[int], single: dict[int, int], least: int,
                begin: int, end: int) -> Iterator[tuple[int, int, int]]:
        """(words aligned, first word, last word) of the copies of a template,
        leftmost first.

        A word that the template has once tells where a copy that holds it
        would begin.  The text is aligned from each such place: over the
        template's length, where a neighbour's words cannot make those of this
        copy ambiguous, and over SPREAD times that, for copies with words put in.
        The search goes on behind each copy found, so copies may stand side by side.
        """
        places = [p for p, _ in at]
        low, wide = begin, int(SPREAD * len(template)) + 1
        for start in sorted({p - single[w] for p, w in at}):
            if start + wide <= low:
                continue
            first = max(start, low)
            if len({w for _, w in at[bisect_left(places, first):bisect_left(places, start + wide)]}) < least:
                continue
            pairs = max((patience(h[first:min(end, start + width)].tolist(), template) for width in (len(template) + 1, wide)), key=len)
            if len(pairs) >= MIN_COVERAGE * len(template):
                yield len(pairs), first + pairs[0][0], first + pairs[-1][0]
                low = first + pairs[-1][0] + 1


def scan(docs: DataFrame, keep: list[str], text: str = "text") -> DataFrame:
    """The columns ``keep`` with ``licenses`` (array of license, template,
    coverage, start and end in code points), in order of place."""
    picked = docs.select(*[F.col(f"`{c}`") for c in keep], F.col(f"`{text}`").alias("_text"))
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in picked.schema.fields[:-1])
    schema += ", licenses array<struct<license:string,template:int,coverage:double,start:long,end:long>>"
    kind = pa.list_(pa.struct([("license", pa.string()), ("template", pa.int32()), ("coverage", pa.float64()), ("start", pa.int64()), ("end", pa.int64())]))

    def run(batches):
        scanner = LicenseScanner()
        for batch in batches:
            out: list[list] = [[] for _ in range(batch.num_rows)]
            for row, spans, data in scanner.column(batch.column(batch.num_columns - 1)):
                lead = np.concatenate([[0], np.cumsum((data & 0xC0) != 0x80)])     # code points before each byte
                out[row] = [{"license": a, "template": n, "coverage": c, "start": int(lead[x]), "end": int(lead[y])} for a, n, c, x, y in spans]
            columns = {f.name: batch.column(i) for i, f in enumerate(batch.schema) if i < len(keep)}
            yield pa.RecordBatch.from_pydict(columns | {"licenses": pa.array(out, kind)})

    return picked.mapInArrow(run, schema)


def op10_patience_licenses(spark, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    found = scan(docs, ["doc_id"])
    best = F.expr("array_max(transform(licenses, x -> struct(x.coverage as coverage, -x.start as at, x.license as license)))")
    return found.select(
        "doc_id", F.size("licenses").cast("long").alias("n_licenses"), best["license"].alias("license"),
        F.coalesce(best["coverage"], F.lit(0.0)).alias("coverage"),
        F.expr("array_join(transform(licenses, x -> concat_ws(':', x.license, x.start, x.end)), ',')").alias("spans"))
