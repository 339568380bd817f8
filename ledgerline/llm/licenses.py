"""License scans: windows of a text that contain a license notice.

Templates of similar length share overlapping windows a little longer than the longest of them.
A window is reduced to the shingles that any template has, and the MinHash values of these are
looked up, band by band, in an index from band values to templates: whatever agrees in a band is
retrieved, and nothing else. The share of the template's shingles in a window of its own length
then decides. So the work per window does not grow with the number of templates. Words are
compared without the punctuation around them, and marks alone, as of comments, are no words. A
match inside a longer match of another template, or with the same words as a fuller one, is part
of that one.

A stretch as long as a template of m shingles that holds a share c of them lies inside a window of
at most 1.54 m + 2 shingles, so the Jaccard similarity of window and template is at least about
c / (1.54 + 1 - c). At c = 0.8 that is 0.46, and 48 bands of 2 values miss it with a probability of
1e-5, or less, since most shingles of a window are in no template. A window with fewer shingles of
templates than the share asks for contains none and is passed over.
"""

from __future__ import annotations

import pickle
from collections.abc import Iterator, Mapping
from dataclasses import dataclass
from importlib import resources

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerline.llm import words as W
from ledgerline.llm.rows import in_small_batches

# words of a shingle, in notices of fewer than ten words and of fewer than six
SHINGLE, SHORT, SHORTEST = 5, 3, 2
CONTAINMENT = 0.8
BAND = 2
BANDS = 48
# windows begin at every m/8-th shingle
OVERLAP = 8
# templates share windows if the longest has at most so many times the shingles of the shortest
ALIKE = 1.25
# shingles of windows that are reduced to MinHash values at once
CHUNK = 250_000
# places in the table of known shingles, by their top bits
TABLE_BITS = 20
SHIFT = np.uint64(64 - TABLE_BITS)

_random = np.random.Generator(np.random.PCG64(8))
MARKS = np.zeros(256, bool)
MARKS[list(b"!\"#$%&'()*+,-./:;<=>?@[\\]^_`{|}~")] = True
MULTIPLIERS = _random.integers(0, 1 << 63, BAND * BANDS, dtype=np.uint64) * np.uint64(2) + np.uint64(1)

# fixed values: notices as their licenses word them
TEMPLATES = {
    "Apache-2.0": "Licensed under the Apache License, Version 2.0.",
    "Apache-2.0 header": (
        "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in "
        "compliance with the License. You may obtain a copy of the License at "
        "http://www.apache.org/licenses/LICENSE-2.0 Unless required by applicable law or agreed to in writing, "
        "software distributed under the License is distributed on an \"AS IS\" BASIS, WITHOUT WARRANTIES OR "
        "CONDITIONS OF ANY KIND, either express or implied."
    ),
    "MIT": "Released under the MIT License.",
    "MIT permission": (
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and "
        "associated documentation files (the \"Software\"), to deal in the Software without restriction, including "
        "without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell "
        "copies of the Software"
    ),
    "GPL-3.0": "This work is licensed under the GNU General Public License, version 3.",
    "GPL-3.0 notice": (
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU "
        "General Public License as published by the Free Software Foundation, either version 3 of the License, or "
        "(at your option) any later version."
    ),
    "BSD-3-Clause": (
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided "
        "that the following conditions are met"
    ),
    "CC-BY-NC-4.0": "Licensed under CC BY-NC 4.0.",
    "CC-BY-SA-4.0": "Licensed under CC BY-SA 4.0.",
    "CC-BY-4.0": "This work is licensed under a Creative Commons Attribution 4.0 International License.",
    "All rights reserved": "All rights reserved.",
}

_GNU = (
    "This {0} is free software: you can redistribute it and/or modify it under the terms of the GNU {1}General Public "
    "License as published by the Free Software Foundation, either version {2} of the License, or (at your option) any "
    "later version."
)
_GNU_COMMA = _GNU.replace("software: you", "software; you").replace(", either", "; either")
_DISCLAIMER = (
    "THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS \"AS IS\" AND ANY EXPRESS OR IMPLIED "
    "WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR "
    "PURPOSE ARE DISCLAIMED. IN NO EVENT SHALL THE COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE FOR ANY DIRECT, INDIRECT, "
    "INCIDENTAL, SPECIAL, EXEMPLARY, OR CONSEQUENTIAL DAMAGES (INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF SUBSTITUTE "
    "GOODS OR SERVICES; LOSS OF USE, DATA, OR PROFITS; OR BUSINESS INTERRUPTION) HOWEVER CAUSED AND ON ANY THEORY OF "
    "LIABILITY, WHETHER IN CONTRACT, STRICT LIABILITY, OR TORT (INCLUDING NEGLIGENCE OR OTHERWISE) ARISING IN ANY WAY "
    "OUT OF THE USE OF THIS SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE."
)
_BSD_2 = (
    TEMPLATES["BSD-3-Clause"] + ": 1. Redistributions of source code must retain the above copyright notice, this list "
    "of conditions and the following disclaimer. 2. Redistributions in binary form must reproduce the above copyright "
    "notice, this list of conditions and the following disclaimer in the documentation and/or other materials provided "
    "with the distribution. "
)
_CC = "This work is licensed under a Creative Commons {0} {1} International License."
_CC_KINDS = {
    "BY": "Attribution", "BY-SA": "Attribution-ShareAlike", "BY-ND": "Attribution-NoDerivatives",
    "BY-NC": "Attribution-NonCommercial", "BY-NC-SA": "Attribution-NonCommercial-ShareAlike",
    "BY-NC-ND": "Attribution-NonCommercial-NoDerivatives",
}

# further notices and the short licenses as a whole
NOTICES = {
    "MIT text": (
        TEMPLATES["MIT permission"] + ", and to permit persons to whom the Software is furnished to do so, subject to "
        "the following conditions: The above copyright notice and this permission notice shall be included in all "
        "copies or substantial portions of the Software. THE SOFTWARE IS PROVIDED \"AS IS\", WITHOUT WARRANTY OF ANY "
        "KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A "
        "PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY "
        "CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF "
        "OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE."
    ),
    "MIT notice": "This project is licensed under the MIT License.",
    "BSD-2-Clause text": _BSD_2 + _DISCLAIMER,
    "BSD-3-Clause text": (
        _BSD_2 + "3. Neither the name of the copyright holder nor the names of its contributors may be used to endorse "
        "or promote products derived from this software without specific prior written permission. " + _DISCLAIMER
    ),
    "ISC text": (
        "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby "
        "granted, provided that the above copyright notice and this permission notice appear in all copies. THE SOFTWARE "
        "IS PROVIDED \"AS IS\" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED "
        "WARRANTIES OF MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT, "
        "INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS, "
        "WHETHER IN AN ACTION OF CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH THE "
        "USE OR PERFORMANCE OF THIS SOFTWARE."
    ),
    "ISC": "Released under the ISC License.",
    "Unlicense": (
        "This is free and unencumbered software released into the public domain. Anyone is free to copy, modify, publish, "
        "use, compile, sell, or distribute this software, either in source code form or as a compiled binary, for any "
        "purpose, commercial or non-commercial, and by any means."
    ),
    "MPL-2.0": (
        "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was "
        "not distributed with this file, You can obtain one at http://mozilla.org/MPL/2.0/."
    ),
    "CC0-1.0": "To the extent possible under law, the author has waived all copyright and related or neighboring rights to this work.",
    "GPL-2.0": "This work is licensed under the GNU General Public License, version 2.",
    "GPL-2.0 notice": _GNU_COMMA.format("program", "", "2"),
    "LGPL-2.1 notice": _GNU_COMMA.format("library", "Lesser ", "2.1"),
    "LGPL-3.0 notice": _GNU.format("program", "Lesser ", "3"),
    "AGPL-3.0 notice": _GNU.format("program", "Affero ", "3"),
    "Apache-1.1": "Licensed under the Apache License, Version 1.1.",
}
NOTICES |= {f"CC-{kind}-4.0 notice": _CC.format(name, "4.0") for kind, name in _CC_KINDS.items() if kind != "BY"}
NOTICES |= {f"CC-{kind}-4.0 short": f"Licensed under CC {kind} 4.0." for kind in _CC_KINDS if kind not in ("BY-NC", "BY-SA")}

# the long licenses as a whole, one file each
_FILES = sorted(resources.files("ledgerline.llm").joinpath("license_texts").iterdir(), key=lambda file: file.name)
TEXTS = {f"{file.name.removesuffix('.txt')} text": file.read_text("utf-8") for file in _FILES}
# fixed values: identifiers of the SPDX list
SPDX_IDS = (
    "Apache-2.0 MIT MIT-0 ISC Zlib BSL-1.0 Unlicense BSD-2-Clause BSD-3-Clause MPL-2.0 EPL-2.0 GPL-2.0 GPL-2.0-only "
    "GPL-2.0-or-later GPL-3.0 GPL-3.0-only GPL-3.0-or-later LGPL-2.1 LGPL-2.1-only LGPL-2.1-or-later LGPL-3.0-only "
    "LGPL-3.0-or-later AGPL-3.0-only AGPL-3.0-or-later CC0-1.0 CC-BY-4.0 CC-BY-SA-4.0 CC-BY-NC-4.0 CC-BY-ND-4.0"
).split()
IDENTIFIERS = {f"{name} identifier": f"SPDX-License-Identifier: {name}" for name in SPDX_IDS}
LICENSES = {**TEMPLATES, **NOTICES, **TEXTS, **IDENTIFIERS}


@dataclass
class Template:
    """The shingles of a notice: their size in words, the distinct values, and the bands."""

    name: str
    size: int
    length: int
    values: np.ndarray
    bands: np.ndarray


def signature(values: np.ndarray, first: np.ndarray, last: np.ndarray) -> np.ndarray:
    """The band values of the shingles values[first:last] of every window, one row a window."""
    # every second segment lies between two windows and is not used
    ends = np.stack([first, last], 1).ravel()
    least = np.empty((len(first), len(MULTIPLIERS)), np.uint64)
    for k, m in enumerate(MULTIPLIERS):
        least[:, k] = np.minimum.reduceat(np.append(values * m, np.uint64(0)), ends)[::2]
    pairs = least.reshape(len(first), BANDS, BAND)
    bands = W.mix(pairs[..., 0] * np.uint64(W.BASE) + pairs[..., 1])
    # a band's values are told apart from those of other bands
    return W.mix(bands + np.arange(1, BANDS + 1, dtype=np.uint64) * np.uint64(W.BASE))


def _punctuation(data: np.ndarray) -> np.ndarray:
    """Which bytes are ASCII punctuation, or of the dashes, quotes and bullets of U+2010 to U+203F."""
    marks = MARKS[data]
    first = np.flatnonzero((data[:-2] == 0xE2) & (data[1:-1] == 0x80) & (data[2:] >= 0x90))
    for k in range(3):
        marks[first + k] = True
    return marks


def _normal_words(piece: W.Piece) -> tuple[W.Words, np.ndarray]:
    """The words that hold more than punctuation, and their hashes without punctuation at the ends."""
    words = W.find_words(piece)
    core = np.flatnonzero(~(W.SPACE[piece.bytes] | _punctuation(piece.bytes)))
    first, last = np.searchsorted(core, words.starts), np.searchsorted(core, words.ends)
    filled = last > first
    starts, ends = words.starts[filled], words.ends[filled]
    hashes = W.span_hashes(W.LOWER_VALUES[piece.bytes], core[first[filled]], core[last[filled] - 1] + 1)
    return W.Words(starts, ends, np.searchsorted(starts, piece.bounds)), hashes


def _shingle_size(words: int) -> int:
    return SHINGLE if words >= 10 else SHORT if words >= 6 else min(SHORTEST, words)


def prepare(templates: Mapping[str, str]) -> list[Template]:
    """Templates ready for scanning. A template without words is left out."""
    ready = []
    for name, text in templates.items():
        piece = next(W.pieces(pa.array([text], pa.string())))
        _, hashes = _normal_words(piece)
        size = _shingle_size(len(hashes))
        if size:
            shingles = W.window_hashes(hashes, size)
            values = np.unique(shingles)
            bands = signature(values, np.array([0]), np.array([len(values)]))[0]
            ready.append(Template(name, size, len(shingles), values, bands))
    return ready


def _windows(hits: np.ndarray, bounds: np.ndarray, width: int, stride: int, size: int) -> tuple[np.ndarray, ...]:
    """(text, first shingle, end) of the windows that hold a hit; no window leaves its text."""
    texts = np.searchsorted(bounds, hits, "right") - 1
    base = bounds[texts]
    first = np.maximum(0, -(-(hits - base - width + 1) // stride))
    counts = (hits - base) // stride - first + 1
    index = np.arange(counts.sum()) - np.repeat(np.cumsum(counts) - counts, counts) + np.repeat(first, counts)
    texts, index = np.unique(np.stack([np.repeat(texts, counts), index], 1), axis=0).T
    starts = bounds[texts] + index * stride
    return texts, starts, np.minimum(starts + width, bounds[texts + 1] - size + 1)


class Group:
    """Templates of similar length: their common windows, and the index of their band values."""

    def __init__(self, templates: list[Template]):
        self.templates = templates
        longest = max(t.length for t in templates)
        self.stride = max(1, min(t.length for t in templates) // OVERLAP)
        self.width = longest + max(1, longest // OVERLAP) + self.stride
        self.fewest = min(len(t.values) for t in templates)
        keys = np.concatenate([t.bands for t in templates])
        owners = np.repeat(np.arange(len(templates)), BANDS)
        order = np.argsort(keys, kind="stable")
        self.keys, self.owners = keys[order], owners[order]

    def retrieve(self, bands: np.ndarray) -> np.ndarray:
        """The pairs (window, template) that agree in a band."""
        flat = bands.ravel()
        first = np.searchsorted(self.keys, flat, "left")
        counts = np.searchsorted(self.keys, flat, "right") - first
        at = np.repeat(first, counts) + np.arange(counts.sum()) - np.repeat(np.cumsum(counts) - counts, counts)
        windows = np.repeat(np.arange(len(flat)) // BANDS, counts)
        return np.unique(np.stack([windows, self.owners[at]], 1), axis=0)


class Library:
    """Templates by the size of their shingles, and in groups of similar length."""

    def __init__(self, templates: list[Template]):
        self.sizes: dict[int, tuple[np.ndarray, np.ndarray, list[Group]]] = {}
        for size in sorted({t.size for t in templates}):
            own = sorted((t for t in templates if t.size == size), key=lambda t: t.length)
            # a small table that most other shingles fail
            known = np.zeros(1 << TABLE_BITS, bool)
            values = np.unique(np.concatenate([t.values for t in own]))
            known[values >> SHIFT] = True
            groups: list[list[Template]] = []
            for template in own:
                if groups and template.length <= ALIKE * groups[-1][0].length:
                    groups[-1].append(template)
                else:
                    groups.append([template])
            self.sizes[size] = (known, values, [Group(g) for g in groups])

    def find(self, hashes: np.ndarray, bounds: np.ndarray, least: float):
        """(template, text, containment, first word, last word) of every window that contains a template.

        ``hashes`` are word hashes of texts that begin at ``bounds``.
        """
        for size, (known, values, groups) in self.sizes.items():
            shingles = W.window_hashes(hashes, size)
            # shingles that reach into the next text belong to no window
            likely = np.flatnonzero(known[shingles >> SHIFT] & W.within(bounds, size))
            at = np.minimum(np.searchsorted(values, shingles[likely]), len(values) - 1)
            hits = likely[values[at] == shingles[likely]]
            if len(hits):
                for group in groups:
                    yield from self._in_group(group, size, shingles[hits], hits, bounds, least)

    def _in_group(self, group: Group, size: int, values: np.ndarray, hits: np.ndarray, bounds: np.ndarray, least: float):
        """``values`` are the shingles at the positions ``hits`` that any template has."""
        texts, starts, ends = _windows(hits, bounds, group.width, group.stride, size)
        first, last = np.searchsorted(hits, starts), np.searchsorted(hits, ends)
        enough = last - first >= least * group.fewest
        texts, starts, ends, first, last = (x[enough] for x in (texts, starts, ends, first, last))
        upto = np.cumsum(last - first)
        wanted: dict[int, list[np.ndarray]] = {}
        for chunk in np.split(np.arange(len(texts)), np.flatnonzero(np.diff(upto // CHUNK)) + 1):
            if len(chunk):
                for window, owner in group.retrieve(signature(values, first[chunk], last[chunk])):
                    wanted.setdefault(int(owner), []).append(chunk[window])
        for owner, windows in wanted.items():
            template = group.templates[owner]
            own = _own_windows(template, texts[windows], starts[windows], ends[windows], bounds)
            for text, start, end in own:
                a, b = np.searchsorted(hits, [start, end])
                found = np.isin(values[a:b], template.values)
                share = len(np.unique(values[a:b][found])) / len(template.values)
                if share >= least:
                    places = hits[a:b][found] - bounds[text]
                    left, right = _span(values[a:b][found], places, template.length)
                    yield template, int(text), share, left, right + template.size - 1


def _own_windows(
    template: Template, texts: np.ndarray, starts: np.ndarray, ends: np.ndarray, bounds: np.ndarray
) -> list[tuple[int, int, int]]:
    """The windows of the template's own length that lie inside retrieved windows: text, first shingle, end."""
    stride = max(1, template.length // OVERLAP)
    width = template.length + stride
    found = set()
    for text, start, end in zip(texts.tolist(), starts.tolist(), ends.tolist(), strict=True):
        base, stop = int(bounds[text]), int(bounds[text + 1]) - template.size + 1
        last = (stop - 1 if end == stop else end - width) - base
        for k in range(-(-(start - base) // stride), last // stride + 1):
            found.add((text, base + k * stride, min(base + k * stride + width, stop)))
    return sorted(found)


def _span(values: np.ndarray, places: np.ndarray, length: int) -> tuple[int, int]:
    """The first and last place of a match; where that is longer than its template, without repetitions at the ends."""
    first, last = int(places.min()), int(places.max())
    if last - first >= length:
        _, back = np.unique(values, return_inverse=True)
        ends = np.full(back.max() + 1, -1)
        np.maximum.at(ends, back, places)
        first = int(ends.min())
        begins = np.full(len(ends), last)
        np.minimum.at(begins, back[places >= first], places[places >= first])
        last = int(begins.max())
    return first, last


def _whole(matches: list[tuple[int, int, str, float]]) -> Iterator[tuple[int, int, str, float]]:
    """The matches (first word, last word, template, share) of a text that are no part of another template's."""
    fullest: dict[tuple[int, int], float] = {}
    for first, last, _, share in matches:
        fullest[first, last] = max(share, fullest.get((first, last), 0.0))
    # the farthest end so far, and the farthest of the other templates, of spans that begin earlier or end later
    far, far_name, other = -1, "", -1
    spans = sorted(fullest, key=lambda s: (s[0], -s[1]))
    by_span: dict[tuple[int, int], set[str]] = {}
    for first, last, name, share in matches:
        if share == fullest[first, last]:
            by_span.setdefault((first, last), set()).add(name)
    for first, last in spans:
        names = by_span[first, last]
        for name in names:
            if last > (other if name == far_name else far):
                yield first, last, name, fullest[first, last]
        for name in names:
            if name == far_name:
                far = max(far, last)
            elif last > far:
                far, far_name, other = last, name, far
            else:
                other = max(other, last)


def _scanner(shipped, least: float):
    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        library = pickle.loads(shipped.value)
        for batch in batches:
            for piece in W.pieces(batch["text"]):
                words, hashes = _normal_words(piece)
                matches: dict[int, list[tuple[int, int, str, float]]] = {}
                for template, text, share, first, last in library.find(hashes, words.bounds, least):
                    matches.setdefault(text, []).append((first, last, template.name, share))
                best: dict[tuple[int, str], tuple[float, int, int]] = {}
                for text, own in matches.items():
                    for first, last, name, share in _whole(own):
                        known = best.get((text, name))
                        # the fullest match, the earliest and shortest of equals
                        if known is None or (-share, first, last) < (-known[0], known[1], known[2]):
                            best[text, name] = (share, first, last)
                found = sorted(best.items())
                rows = pa.array([text for (text, _), _ in found], pa.int64())
                starts = [int(words.starts[words.bounds[t] + f] - piece.bounds[t]) for (t, _), (_, f, _) in found]
                ends = [int(words.ends[words.bounds[t] + e] - piece.bounds[t]) for (t, _), (_, _, e) in found]
                yield pa.RecordBatch.from_arrays(
                    [
                        batch["doc_id"].slice(piece.first, len(piece)).take(rows),
                        pa.array([name for (_, name), _ in found], pa.string()),
                        pa.array([m[0] for _, m in found], pa.float64()),
                        pa.array(starts, pa.int64()),
                        pa.array(ends, pa.int64()),
                    ],
                    names=["doc_id", "license", "containment", "first_byte", "end_byte"],
                )

    return scan


def template_table(licenses: DataFrame) -> dict[str, str]:
    """Templates from a table of licenses (license, text), a dimension; several texts of one license are numbered."""
    templates: dict[str, str] = {}
    rows = licenses.select(F.col("license").cast("string"), F.col("text").cast("string")).dropna().distinct()
    for name, text in sorted(tuple(row) for row in rows.collect()):
        key, k = name, 1
        while key in templates:
            k += 1
            key = f"{name} ({k})"
        templates[key] = text
    return templates


def scan(docs: DataFrame, templates: Mapping[str, str] = LICENSES, containment: float = CONTAINMENT) -> DataFrame:
    """One row per row of ``docs`` (doc_id, text) and license found in it.

    Columns: doc_id, license, containment (share of the template's distinct shingles found in the
    best window), first_byte and end_byte (the match in the text's UTF-8).

    * Words are compared without regard to the case of A to Z and to punctuation at their ends; words
      of nothing else, such as comment marks, are passed over. Shingles have five words, three in a
      template of fewer than ten and two in one of fewer than six.
    * A match inside a longer match of another template, or on the same words as a fuller one, is not
      given: a license as a whole is one match, not its notices as well.
    * NULL and empty texts contain nothing. Of several matches of a license in a text the fullest is
      given, then the earliest. Repeated rows give repeated results; an empty table gives none.
    * The templates are broadcast. They are a parameter, of which ``template_table`` makes one from
      a table of licenses, a dimension. Other columns are ignored.
    """
    inputs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    # as bytes, classes and all, since executors have no copy of this package
    library = docs.sparkSession.sparkContext.broadcast(cloudpickle.dumps(Library(prepare(templates))))
    return in_small_batches(inputs).mapInArrow(
        _scanner(library, containment),
        "doc_id long, license string, containment double, first_byte long, end_byte long",
    )
