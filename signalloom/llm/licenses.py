"""License scans by patience alignment of texts with license templates."""

from __future__ import annotations

import re
from bisect import bisect_left
from collections import Counter
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from .shared import renamed
from .words import ALNUM, groups


def _creative(code: str, name: str, version: str) -> list[str]:
    return [f"{{{code} {version}}}", f"Licensed under {{{code} {version}}}", f"{{Creative Commons {name} {version}}}",
            f"This work is licensed under a {{Creative Commons {name} {version}}} International License",
            f"This work is licensed under the {{Creative Commons {name} {version}}} International License. To view a "
            "copy of this license, visit http://creativecommons.org/licenses/"]


def _gnu(code: str, name: str, version: str, date: str, work: str = "This program") -> list[str]:
    """Short notices, the head of the whole text, the header of files."""
    short, program = version.removesuffix(".0"), work.removeprefix("This ")
    name = f"GNU {name} License"
    return [f"This work is licensed under the {{{name}}}, {{version {short}}}",
            *[f"{{{name}}} {v}" for v in (f"{{version {short}}}", f"{{v{short}}}")],
            *[f"Licensed under the {{{x}}}" for x in (f"{code} {short}", f"{code}v{short}")],
            f"{{{name} Version {short}, {date}}} Copyright (C) Free Software Foundation, Inc. Everyone is permitted to "
            "copy and distribute verbatim copies of this license document, but changing it is not allowed.",
            f"{work} is free software: you can redistribute it and/or modify it under the terms of the "
            f"{{{name}}} as published by the Free Software Foundation, either {{version {short}}} of the License, or (at "
            f"your option) any later version. {work} is distributed in the hope that it will be useful, but WITHOUT ANY "
            "WARRANTY; without even the implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. See "
            f"the {name} for more details. You should have received a copy of the {name} along with this {program}.",
            f"{work} is free software: you can redistribute it and/or modify it under the terms of the {{{name}}} "
            f"as published by the Free Software Foundation, either {{version {short}}} of the License, or (at your "
            "option) any later version."]


_LIABILITY = (
    "IN NO EVENT SHALL THE COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE FOR ANY DIRECT, INDIRECT, INCIDENTAL, SPECIAL, "
    "EXEMPLARY, OR CONSEQUENTIAL DAMAGES (INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF SUBSTITUTE GOODS OR SERVICES; "
    "LOSS OF USE, DATA, OR PROFITS; OR BUSINESS INTERRUPTION) HOWEVER CAUSED AND ON ANY THEORY OF LIABILITY, WHETHER "
    "IN CONTRACT, STRICT LIABILITY, OR TORT (INCLUDING NEGLIGENCE OR OTHERWISE) ARISING IN ANY WAY OUT OF THE USE OF "
    "THIS SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE.")
_BSD = ("{Redistribution and use in source and binary forms, with or without modification}, are permitted provided that "
        "the following conditions are met:")
_CLAUSES = (
    "1. Redistributions of source code must retain the above copyright notice, this list of conditions and the following "
    "disclaimer. 2. Redistributions in binary form must reproduce the above copyright notice, this list of conditions "
    "and the following disclaimer in the documentation and/or other materials provided with the distribution.")
_NEITHER = (
    "3. {Neither the name of} the copyright holder nor the names of its contributors may be used to endorse or promote "
    "products derived from this software without specific prior written permission.")
_AS_IS = (
    "THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS \"AS IS\" AND ANY EXPRESS OR IMPLIED "
    "WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR "
    "PURPOSE ARE DISCLAIMED.")
_ISC = (
    "{Permission to use, copy, modify, and/or distribute this software} for any purpose with or without fee is hereby "
    "granted, {provided that the above copyright notice and this permission notice appear} in all copies.")
_MIT = (
    "{Permission is hereby granted, free of charge, to any person obtaining a copy of this software} and "
    "associated documentation files (the \"Software\"), to deal in the Software without restriction, including "
    "without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell "
    "copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the "
    "following conditions:")

# Notices, headers and texts of public licenses. Words in braces tell a license from others: a text must
# have all of them, side by side.
TEMPLATES = {
    "Apache-2.0": [
        "Licensed under the {Apache} License, {Version 2.0}",
        "{Apache License, Version 2.0}", "{Apache License 2.0}", "Licensed under {Apache 2.0}",
        "{Apache License Version 2.0, January 2004} http://www.apache.org/licenses/ TERMS AND CONDITIONS FOR USE, "
        "REPRODUCTION, AND DISTRIBUTION",
        "Licensed under the {Apache} License, {Version 2.0} (the \"License\"); you may not use this file except in "
        "compliance with the License. You may obtain a copy of the License at "
        "http://www.apache.org/licenses/LICENSE-2.0 Unless required by applicable law or agreed to in writing, "
        "software distributed under the License is distributed on an \"AS IS\" BASIS, WITHOUT WARRANTIES OR "
        "CONDITIONS OF ANY KIND, either express or implied. See the License for the specific language governing "
        "permissions and limitations under the License."],
    "MIT": [
        "Released under the {MIT} License", "Licensed under the {MIT} License", "{The MIT License MIT}",
        _MIT + " The above copyright notice and this permission notice shall be included in all copies or substantial "
        "portions of the Software. THE SOFTWARE IS PROVIDED \"AS IS\", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR "
        "IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND "
        "NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER "
        "LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE "
        "SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE.",
        _MIT],
    "GPL-2.0": _gnu("GPL", "General Public", "2.0", "June 1991"),
    "GPL-3.0": _gnu("GPL", "General Public", "3.0", "29 June 2007"),
    "LGPL-2.1": _gnu("LGPL", "Lesser General Public", "2.1", "February 1999", "This library"),
    "LGPL-3.0": _gnu("LGPL", "Lesser General Public", "3.0", "29 June 2007", "This library"),
    "AGPL-3.0": _gnu("AGPL", "Affero General Public", "3.0", "19 November 2007"),
    "MPL-2.0": [
        "{Mozilla Public License}, {Version 2.0}", "{Mozilla Public License 2.0}", "Licensed under {MPL 2.0}",
        "This Source Code Form is subject to the terms of the {Mozilla Public License}, {v. 2.0}. If a copy of the MPL "
        "was not distributed with this file, You can obtain one at http://mozilla.org/MPL/2.0/."],
    "EPL-1.0": [
        "{Eclipse Public License}, {Version 1.0}", "{Eclipse Public License v 1.0}", "{Eclipse Public License v1.0}",
        "{Eclipse Public License 1.0}"],
    "EPL-2.0": [
        "{Eclipse Public License}, {Version 2.0}", "{Eclipse Public License v 2.0}", "{Eclipse Public License v2.0}",
        "{Eclipse Public License 2.0}",
        "This program and the accompanying materials are made available under the terms of the {Eclipse Public License "
        "2.0} which is available at https://www.eclipse.org/legal/epl-2.0/"],
    **{f"{code.replace(' ', '-')}-{version}": _creative(code, name, version) for version in ("3.0", "4.0")
       for code, name in (
        ("CC BY-NC", "Attribution-NonCommercial"), ("CC BY", "Attribution"), ("CC BY-SA", "Attribution-ShareAlike"),
        ("CC BY-ND", "Attribution-NoDerivatives" if version == "4.0" else "Attribution-NoDerivs"),
        ("CC BY-NC-SA", "Attribution-NonCommercial-ShareAlike"),
        ("CC BY-NC-ND", "Attribution-NonCommercial-" + ("NoDerivatives" if version == "4.0" else "NoDerivs")))},
    "CC0-1.0": [
        "{CC0 1.0}", "{CC0} 1.0 {Universal}", "Released under {CC0}", "Licensed under {CC0}",
        "To the extent possible under law, the author has {waived all copyright and related or neighboring rights} to "
        "this work."],
    "Unlicense": [
        "Released under the {Unlicense}",
        "This is {free and unencumbered software released into the public domain}. Anyone is free to copy, modify, "
        "publish, use, compile, sell, or distribute this software, either in source code form or as a compiled "
        "binary, for any purpose, commercial or non-commercial, and by any means.",
        "This is {free and unencumbered software released into the public domain}."],
    "BSD": [_BSD],
    "BSD-2-Clause": [
        "Licensed under the {BSD 2 Clause} License", " ".join((_BSD, _CLAUSES, _AS_IS, _LIABILITY))],
    "BSD-3-Clause": [
        "Licensed under the {BSD 3 Clause} License", " ".join((_BSD, _CLAUSES, _NEITHER, _AS_IS, _LIABILITY))],
    "ISC": [
        "Released under the {ISC} License", "Licensed under the {ISC} License",
        _ISC + " THE SOFTWARE IS PROVIDED \"AS IS\" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS "
        "SOFTWARE INCLUDING ALL IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE "
        "LIABLE FOR ANY SPECIAL, DIRECT, INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM "
        "LOSS OF USE, DATA OR PROFITS, WHETHER IN AN ACTION OF CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING "
        "OUT OF OR IN CONNECTION WITH THE USE OR PERFORMANCE OF THIS SOFTWARE.",
        _ISC],
}


def rising(values: list[int]) -> list[int]:
    """Places of a longest increasing subsequence of distinct numbers."""
    tails: list[int] = []
    ends: list[int] = []
    back: list[int] = []
    for n, v in enumerate(values):
        k = bisect_left(tails, v)
        back.append(ends[k - 1] if k else -1)
        if k == len(tails):
            tails.append(v)
            ends.append(n)
        else:
            tails[k], ends[k] = v, n
    out, n = [], ends[-1] if ends else -1
    while n >= 0:
        out.append(n)
        n = back[n]
    return out[::-1]


def patience(a: list[int], b: list[int]) -> list[tuple[int, int]]:
    """Aligned places of two word lists.

    Words that stand once in both are anchors where they are in rising order; equal ends of each gap are
    taken along, and the gap between two anchors is aligned in the same way, by its own unique words.
    """
    out: list[tuple[int, int]] = []
    todo = [(0, len(a), 0, len(b))]
    while todo:
        i, k, j, m = todo.pop()
        while i < k and j < m and a[i] == b[j]:
            out.append((i, j))
            i, j = i + 1, j + 1
        while i < k and j < m and a[k - 1] == b[m - 1]:
            k, m = k - 1, m - 1
            out.append((k, m))
        if i == k or j == m:
            continue
        in_a, in_b = Counter(a[i:k]), Counter(b[j:m])
        place = {w: j + p for p, w in enumerate(b[j:m]) if in_b[w] == 1}
        pairs = [(i + p, place[w]) for p, w in enumerate(a[i:k]) if in_a[w] == 1 and w in place]
        anchors = [pairs[p] for p in rising([y for _, y in pairs])]
        out += anchors
        if anchors:
            for (x, y), (u, v) in zip([(i - 1, j - 1), *anchors], [*anchors, (k, m)]):
                todo.append((x + 1, u, y + 1, v))
    return sorted(out)


class Template(NamedTuple):
    license: str
    words: list[int]
    #: First place and end of what must be there word by word.
    marked: list[tuple[int, int]]


class Templates:
    """Templates as numbers of words, and which words occur in any."""

    def __init__(self, templates: dict[str, list[str]]):
        flat = [(name, text) for name, texts in sorted(templates.items()) for text in texts]
        parts = [(d, k % 2 == 1, x) for d, (_, text) in enumerate(flat) for k, x in enumerate(re.split("[{}]", text))]
        (_, _, words), = groups(pa.array([" ".join(x.split()) for *_, x in parts], pa.string()), ALNUM)
        self.vocabulary = np.unique(words.hash)
        number = np.searchsorted(self.vocabulary, words.hash)
        self.all = [Template(name, [], []) for name, _ in flat]
        for (d, marked, _), a, b in zip(parts, words.first, words.first[1:]):
            own = self.all[d]
            if marked and b > a:
                own.marked.append((len(own.words), len(own.words) + int(b - a)))
            own.words.extend(number[a:b].tolist())
        self.needed = [frozenset(w for a, b in t.marked for w in t.words[a:b]) for t in self.all]

    def numbers(self, hashes: np.ndarray) -> np.ndarray:
        """Numbers of words, -1 for those in no template."""
        at = np.minimum(np.searchsorted(self.vocabulary, hashes), len(self.vocabulary) - 1)
        return np.where(self.vocabulary[at] == hashes, at, -1)

    def within(self, numbers: np.ndarray) -> list[Template]:
        """Templates whose marked words are all among the numbers."""
        there = set(np.unique(numbers).tolist())
        return [t for t, needed in zip(self.all, self.needed) if needed <= there]


def found(numbers: np.ndarray, template: Template, coverage: float) -> list[tuple[int, float, int, int]]:
    """(aligned words, coverage, first word, end) of each stretch of a text that holds the template.

    A stretch is one and a half templates long; only stretches with enough of the template's words to reach
    ``coverage`` and with what is marked are aligned. Of stretches that overlap the best aligned one is found.
    """
    words = template.words
    need = int(np.ceil(coverage * len(words)))
    own = np.zeros(int(max(words)) + 2, bool)
    own[words] = True
    at = np.flatnonzero(own[np.minimum(numbers, len(own) - 1)] & (numbers >= 0))
    if len(at) < need:
        return []
    width = len(words) + len(words) // 2 + 1
    good = np.searchsorted(at, at + width) - np.arange(len(at)) >= need
    for a, b in template.marked:
        same = np.ones(max(0, len(numbers) - (b - a) + 1), bool)
        for k, w in enumerate(words[a:b]):
            same &= numbers[k: k + len(same)] == w
        begins = np.flatnonzero(same)
        good &= np.searchsorted(begins, at) < np.searchsorted(begins, at + width - (b - a), "right")
    hits = set()
    for low in at[good].tolist():
        pairs = patience(numbers[low: low + width].tolist(), words)
        place = {y: x for x, y in pairs}
        if len(pairs) >= need and all(place.get(y, -1) == place.get(a, -2) + y - a
                                      for a, b in template.marked for y in range(a, b)):
            hits.add((len(pairs), len(pairs) / len(words), low + pairs[0][0], low + pairs[-1][0] + 1))
    return apart(hits, lambda h: (-h[0], h[3] - h[2], h[2]))


def apart(hits, order) -> list:
    """The hits, best first, less those that overlap a better one."""
    out: list = []
    for hit in sorted(hits, key=order):
        if all(hit[3] <= h[2] or h[3] <= hit[2] for h in out):
            out.append(hit)
    return out


def _scan(shared, coverage: float):
    def run(batches):
        templates = Templates(shared)
        kinds = {"license": pa.string(), "coverage": pa.float64(), "first_word": pa.int64(), "end_word": pa.int64()}
        for batch in batches:
            out: dict[str, list] = {c: [] for c in ("at", *kinds)}
            for i, j, words in groups(batch.column("text"), ALNUM):
                numbers, first = templates.numbers(words.hash), words.first.tolist()
                for d in range(j - i):
                    own = numbers[first[d]: first[d + 1]]
                    hits = [(*hit, t.license) for t in templates.within(own) for hit in found(own, t, coverage)]
                    hits = apart(hits, lambda h: (-h[0], -h[1], h[2], h[4]))
                    for _, covered, low, high, name in sorted(hits, key=lambda h: h[2]):
                        for c, v in zip(out, (i + d, name, covered, low, high)):
                            out[c].append(v)
            ids = batch.column("doc_id").take(pa.array(out.pop("at"), pa.int64()))
            yield pa.RecordBatch.from_pydict({"doc_id": ids} | {c: pa.array(v, kinds[c]) for c, v in out.items()})
    return run


def scan(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
         templates: dict[str, list[str]] | None = None, coverage: float = 0.85) -> DataFrame:
    """Licenses that whole texts hold: (doc_id, license, coverage, first_word, end_word).

    Words are runs of ASCII letters, digits and characters beyond ASCII, after lower-casing A to Z. A text
    holds a license if a stretch aligns with ``coverage`` or more of the words of one of its templates, and word by
    word with what a template has in braces. All such stretches are returned, one row each; of those that overlap,
    the one with most words. Null, empty and other texts
    give no row, repeated rows repeated ones, an empty table an empty result; other columns are ignored.
    Templates are a small fixed table. One pass without exchange.
    """
    rows = renamed(docs, doc_id=id_col, text=text_col)
    return rows.mapInArrow(_scan(templates or TEMPLATES, coverage),
                           f"doc_id {rows.schema['doc_id'].dataType.simpleString()}, license string, "
                           "coverage double, first_word long, end_word long")
