"""License scans: MinHash bands over overlapping windows retrieve templates, containment verifies at every place.

Only shingles of some template can match, so windows are sets of these, for templates
of like size together. Windows of a template's size and a half stand a quarter of it
apart, so one of them holds any place that a template may take whole. There the two sets share 0.47 or more of their union,
and none of 50 bands of two MinHashes agrees with a chance of 4e-6. A template with a
band in common is verified on the whole text: its containment is that of the best of all
windows of its size and a quarter, one from each shingle on.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from pathlib import Path

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from samplewright.llm.arrow import as_bytes, pieces
from samplewright.llm.words import SPACES, Piece, mixed, shingle_hashes, word_hashes

_U = np.uint64

# Notices by which texts declare a license.
NOTICES: dict[str, str] = {
    "Apache-2.0": "Licensed under the Apache License, Version 2.0.",
    "Apache-2.0 header": 'Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in compliance with the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0 Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on an "AS IS" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied.',
    "CC-BY-NC-4.0": "Licensed under CC BY-NC 4.0.",
    "GPL-3.0": "This work is licensed under the GNU General Public License, version 3.",
    "GPL header": "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version.",
    "MIT": "Released under the MIT License.",
    "MIT permission": "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the \"Software\"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions:",
}

#: Notices and headers of further licenses.
MORE_NOTICES: dict[str, str] = {
    "AGPL-3.0 header": "This program is free software: you can redistribute it and/or modify it under the terms of the GNU Affero General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version.",
    "Apache-2.0 name": "Licensed under the Apache License 2.0",
    "BSD notice": "Use of this source code is governed by a BSD-style license that can be found in the LICENSE file.",
    "BSD-2-Clause": "Licensed under the BSD 2-Clause License",
    "BSD-3-Clause": "Licensed under the BSD 3-Clause License",
    "CC-BY-3.0": "This work is licensed under a Creative Commons Attribution 3.0 Unported License.",
    "CC-BY-4.0": "This work is licensed under a Creative Commons Attribution 4.0 International License.",
    "CC-BY-4.0 name": "Licensed under CC BY 4.0",
    "CC-BY-NC-4.0 notice": "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License.",
    "CC-BY-NC-ND-4.0": "This work is licensed under a Creative Commons Attribution-NonCommercial-NoDerivatives 4.0 International License.",
    "CC-BY-NC-SA-4.0": "This work is licensed under a Creative Commons Attribution-NonCommercial-ShareAlike 4.0 International License.",
    "CC-BY-ND-4.0": "This work is licensed under a Creative Commons Attribution-NoDerivatives 4.0 International License.",
    "CC-BY-SA-3.0": "This work is licensed under a Creative Commons Attribution-ShareAlike 3.0 Unported License.",
    "CC-BY-SA-4.0": "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License.",
    "CC-BY-SA-4.0 name": "Licensed under CC BY-SA 4.0",
    "CC0-1.0": "To the extent possible under law, the author(s) have dedicated all copyright and related and neighboring rights to this software to the public domain worldwide. This software is distributed without any warranty.",
    "EPL-2.0 header": "This program and the accompanying materials are made available under the terms of the Eclipse Public License 2.0 which is available at https://www.eclipse.org/legal/epl-2.0/",
    "GFDL header": "Permission is granted to copy, distribute and/or modify this document under the terms of the GNU Free Documentation License, Version 1.3 or any later version published by the Free Software Foundation; with no Invariant Sections, no Front-Cover Texts, and no Back-Cover Texts.",
    "GPL-2.0 header": "This program is free software; you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation; either version 2 of the License, or (at your option) any later version.",
    "ISC": "Released under the ISC License.",
    "LGPL-2.1 header": "This library is free software; you can redistribute it and/or modify it under the terms of the GNU Lesser General Public License as published by the Free Software Foundation; either version 2.1 of the License, or (at your option) any later version.",
    "LGPL-3.0 header": "This program is free software: you can redistribute it and/or modify it under the terms of the GNU Lesser General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version.",
    "MIT name": "Licensed under the MIT License",
    "MPL-2.0 header": "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not distributed with this file, You can obtain one at http://mozilla.org/MPL/2.0/.",
    "Unlicense": "This is free and unencumbered software released into the public domain.",
    "WTFPL": "This program is free software. It comes without any warranty, to the extent permitted by applicable law. You can redistribute it and/or modify it under the terms of the Do What The Fuck You Want To Public License, Version 2, as published by Sam Hocevar.",
    "Zlib": "This software is provided 'as-is', without any express or implied warranty. In no event will the authors be held liable for any damages arising from the use of this software. Permission is granted to anyone to use this software for any purpose, including commercial applications, and to alter it and redistribute it freely, subject to the following restrictions:",
}


def common_templates() -> dict[str, str]:
    """The whole set: notices, headers and full texts."""
    return {**NOTICES, **MORE_NOTICES, **full_texts()}


def full_texts() -> dict[str, str]:
    """The whole licenses of license_texts/, by name and " text"."""
    return {f"{p.stem} text": p.read_text(encoding="utf-8") for p in sorted((Path(__file__).parent / "license_texts").glob("*.txt"))}


_PUNCTUATION_BYTES = bytes(b for b in range(0x21, 0x7F) if not chr(b).isalnum())
_PUNCTUATION = np.zeros(256, bool)
_PUNCTUATION[list(_PUNCTUATION_BYTES)] = True
_BLANK = np.zeros(256, bool)
_BLANK[list(SPACES)] = True
#: Typographic marks, as ASCII ones.
_MARKS = {c.encode(): a for c, a in {"\u2018": b"'", "\u2019": b"'", "\u201c": b'"', "\u201d": b'"', "\u201e": b'"', "\u00ab": b'"', "\u00bb": b'"', "\u2013": b"-", "\u2014": b"-", "\u2022": b"*"}.items()}


def _ascii_marks(text: bytes) -> bytes:
    if not text.isascii():
        for mark, ascii_mark in _MARKS.items():
            text = text.replace(mark, ascii_mark)
    return text


def plain(text: bytes) -> bytes:
    """The text with blanks for the punctuation at either end of a word, and typographic marks as ASCII ones.

    Words of nothing but punctuation go, and with them the marks of comment blocks:
    ` * `, `//`, `#`, `;`, `--`. Punctuation inside a word stays.
    """
    text = _ascii_marks(text)
    codes = np.frombuffer(text, np.uint8)
    edge = np.zeros(codes.size + 2, np.int8)
    edge[1:-1] = _PUNCTUATION[codes]
    turns = np.flatnonzero(edge[1:] != edge[:-1])
    starts, ends = turns[0::2], turns[1::2]
    blank = np.ones(codes.size + 2, bool)
    blank[1:-1] = _BLANK[codes]
    outer = blank[starts] | blank[ends + 1]
    steps = np.zeros(codes.size + 1, np.int8)
    steps[starts[outer]] = 1
    steps[ends[outer]] -= 1
    return np.where(np.cumsum(steps[:-1], dtype=np.int8) > 0, np.uint8(32), codes).tobytes()


def kept_words(text: bytes) -> list[int]:
    """For each word that `plain` leaves, its place among the words as written."""
    return [k for k, word in enumerate(_ascii_marks(text).split()) if word.strip(_PUNCTUATION_BYTES)]


@dataclass(frozen=True)
class Scan:
    """Words of a shingle, least containment, whether words are taken bare of punctuation (see `plain`), bands and rows."""

    shingle: int = 5
    containment: float = 0.8
    bare: bool = False
    bands: int = 50
    rows: int = 2


#: Windows whose MinHashes are made at once, and shingles at most of them together.
TOGETHER = 512
MANY = 1 << 16


class Templates:
    """Templates by their shingles; some hundred bytes for each word of them."""

    def __init__(self, templates: dict[str, str], scan: Scan) -> None:
        self.scan, self.names = scan, list(templates)
        sets = [np.unique(self._shingles(t.encode())) for t in templates.values()]
        self.sizes = np.array([x.size for x in sets], np.int64)
        self.words = [len(t.encode().split()) for t in templates.values()]
        #: each shingle of any template, and each template's shingles as places in it
        self.every = np.unique(np.concatenate([np.empty(0, _U), *sets]))
        self.members = [np.searchsorted(self.every, x) for x in sets]
        #: the place of each of `every` in each permutation, and each template's MinHashes
        seeds = mixed(np.arange(1, scan.bands * scan.rows + 1, dtype=_U) * _U(0x9E3779B97F4A7C15))
        self.ranks = np.array([(mixed(self.every ^ s) >> _U(32)).astype(np.uint32) for s in seeds]).reshape(seeds.size, -1)
        self.signs = np.array([self.ranks[:, m].min(axis=1) for m in self.members], np.uint32).reshape(len(sets), seeds.size)
        #: templates of like size: from a power of 1.25 to the next
        power = np.floor(np.log(np.maximum(self.sizes, 1)) / np.log(1.25)).astype(np.int64)
        self.alike = [np.flatnonzero(power == p) for p in np.unique(power)]
        #: for each of these groups, which of `every` its templates hold
        self.of_alike = [np.isin(np.arange(self.every.size), np.concatenate([self.members[t] for t in alike])) for alike in self.alike]

    def _shingles(self, text: bytes) -> np.ndarray:
        words = word_hashes(plain(text) if self.scan.bare else text, fold=True)
        if 0 < words.size < self.scan.shingle:
            raise ValueError("a template needs as many words as a shingle")
        return shingle_hashes(words, self.scan.shingle)

    def known(self, runs: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The place in `every` of each shingle, and whether it is there."""
        if not self.every.size:
            return np.zeros(runs.size, np.int64), np.zeros(runs.size, bool)
        place = np.minimum(np.searchsorted(self.every, runs), self.every.size - 1)
        return place, self.every[place] == runs

    def retrieved(self, at: np.ndarray, which: np.ndarray) -> list[int]:
        """The templates of which a window of the text has a band; parameters as in `scan_text`."""
        out: set[int] = set()
        all_at, all_which = at, which
        for alike, members in zip(self.alike, self.of_alike, strict=True):
            own = members[all_which]
            at, which = all_at[own], all_which[own]
            least, most = int(self.sizes[alike].min()), int(self.sizes[alike].max())
            step = 1 + least // 4
            # the window at the grid's place before a shingle reaches a whole template and a quarter beyond it
            start = np.unique(at // step) * step
            low, high = np.searchsorted(at, start), np.searchsorted(at, start + most + most // 4 + step)
            full = high - low >= self.scan.containment * least
            low, high = low[full], high[full]
            signs = self.signs[alike].reshape(len(alike), self.scan.bands, self.scan.rows)
            k = 0
            while k < low.size:
                end = min(k + TOGETHER, low.size)
                while end > k + 1 and high[end - 1] - low[k] > MANY:
                    end = k + (end - k) // 2
                first, last = int(low[k]), int(high[end - 1])
                # one more column, so that the last window's end is a place too
                ranks = np.pad(self.ranks[:, which[first:last]], ((0, 0), (0, 1)))
                edges = np.stack([low[k:end], high[k:end]], axis=1).ravel() - first
                mins = np.minimum.reduceat(ranks, edges, axis=1)[:, ::2].T.reshape(-1, 1, self.scan.bands, self.scan.rows)
                hit = (mins == signs).all(axis=3).any(axis=(0, 2))
                out.update(alike[hit].tolist())
                k = end
        return sorted(out)

    def scan_text(self, at: np.ndarray, which: np.ndarray) -> list[tuple[int, float, int]]:
        """(template, containment, first shingle) of the best window of each template found in a text.

        at: the places of its shingles that are known, rising; which: each one's place in `every`.
        """
        found = []
        for template in self.retrieved(at, which):
            own = np.isin(which, self.members[template])
            if not own.any():  # ranks of 32 bits may agree by chance
                continue
            size = int(self.sizes[template])
            count, first = _most_distinct(at[own], which[own], size + size // 4)
            if count / size >= self.scan.containment:
                found.append((template, count / size, first))
        return found


def _most_distinct(at: np.ndarray, which: np.ndarray, width: int) -> tuple[int, int]:
    """The most distinct values of `which` whose places lie within `width`, and the first place of the earliest such window."""
    ends = np.searchsorted(at, at + width)
    # the value's place before, by index; -1 for its first
    order = np.argsort(which, kind="stable")
    before = np.full(at.size, -1)
    again = np.flatnonzero(which[order][1:] == which[order][:-1])
    before[order[again + 1]] = order[again]
    if not again.size:
        counts = ends - np.arange(at.size)
        best = int(counts.argmax())
        return int(counts[best]), int(at[best])
    after = np.full(at.size, at.size)
    after[order[again]] = order[again + 1]
    most, first, now, end = 0, 0, 0, 0
    for start, (stop, following) in enumerate(zip(ends.tolist(), after.tolist(), strict=True)):
        while end < stop:
            now += int(before[end] < start)
            end += 1
        if now > most:
            most, first = now, int(at[start])
        now -= following >= stop  # the value leaves with its only place in the window
    return most, first


def scan_licenses(docs: DataFrame, templates: dict[str, str] | None = None, scan: Scan = Scan(), key: str = "doc_id", text: str = "text") -> DataFrame:
    """One row for each document and template found in it: key, license, containment, first_word, n_words.

    containment: the share of the template's distinct five-word shingles in the best
    window of as many shingles and a quarter, `scan.containment` or more. Words are parted
    by ASCII white space and A-Z count as a-z; with `scan.bare`, punctuation around words
    doesn't count (see `plain`), in texts and templates alike. first_word: the place, from 0, of the
    first word matched; n_words: those of the template; both count the words as written.
    Of equally good windows the earliest counts. Null, empty and short texts give no rows,
    nor does an empty table; repeated rows each give theirs. Texts are scanned whole, with
    about a hundred bytes of memory for each of theirs; other columns aren't read. The templates, NOTICES by default, are
    broadcast with the function.
    """
    known = Templates(NOTICES if templates is None else templates, scan)

    def scanned(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for piece in pieces(batches, "text"):
            bodies = as_bytes(piece.column("text"))
            whole = Piece([plain(x) if x and scan.bare else x or b"" for x in bodies], fold=True)
            runs, at = whole.shingles(scan.shingle)
            place, hit = known.known(runs)
            at, place = at[hit], place[hit]
            owner = whole.doc[at]
            rows = []
            for doc in np.unique(owner).tolist():
                low, high = np.searchsorted(owner, [doc, doc + 1])
                found = known.scan_text(at[low:high], place[low:high])
                found = [(t, share, int(first - whole.first[doc])) for t, share, first in found]
                places = kept_words(bodies[doc]) if found and scan.bare else None
                rows += [(doc, known.names[t], share, places[first] if places else first, known.words[t]) for t, share, first in found]
            docs_, names, shares, firsts, counts = zip(*rows, strict=True) if rows else ((),) * 5
            columns = [piece.column("key").take(pa.array(docs_, pa.int64())), pa.array(names, pa.string()), pa.array(shares, pa.float64()), pa.array(firsts, pa.int64()), pa.array(counts, pa.int64())]
            yield pa.RecordBatch.from_arrays(columns, names=["key", "license", "containment", "first_word", "n_words"])

    slim = docs.select(F.col(key).alias("key"), F.col(text).alias("text"))
    return slim.mapInArrow(scanned, f"key {slim.schema['key'].dataType.simpleString()}, license string, containment double, first_word long, n_words long").withColumnRenamed("key", key)
