"""License scan: Dice coefficient over word bigrams against templates."""

from __future__ import annotations

import math
import re
from bisect import bisect_right
from collections import Counter, deque
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T

#: Least Dice coefficient of a match.
LEAST = 0.8

# The templates, as (licence, wording). What stands in braces decides: without these words in a row, a run of words is not this licence.
TEMPLATES = [
    ("Apache-2.0", "Licensed under the {Apache License, Version 2.0}."),
    ("Apache-2.0", 'Licensed under the {Apache License, Version 2.0} (the "License"); you may not use this file except in compliance with the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0'),
    ("BSD-3-Clause", "Use of this source code is governed by a {BSD-style} license that can be found in the LICENSE file."),
    ("BSD-2-Clause", "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met: Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer. Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the documentation and/or other materials provided with the distribution."),
    ("BSD-3-Clause", "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met: Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer. Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the documentation and/or other materials provided with the distribution. Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission."),
    ("CC-BY-4.0", "This work is licensed under a Creative Commons {Attribution 4.0} International License."),
    ("CC0-1.0", "To the extent possible under law, the author has waived all copyright and related or neighboring rights to this work."),
    ("GPL-3.0", "This work is licensed under the {GNU General Public License, version 3}."),
    ("GPL-3.0", "This program is free software: you can redistribute it and/or modify it under the terms of the {GNU General} Public License as published by the Free Software Foundation, either {version 3} of the License, or (at your option) any later version."),
    ("LGPL-3.0", "This library is licensed under the {GNU Lesser General Public License, version 3}."),
    ("LGPL-3.0", "This library is free software: you can redistribute it and/or modify it under the terms of the {GNU Lesser General} Public License as published by the Free Software Foundation, either {version 3} of the License, or (at your option) any later version."),
    ("AGPL-3.0", "This program is free software: you can redistribute it and/or modify it under the terms of the {GNU Affero General} Public License as published by the Free Software Foundation, either {version 3} of the License, or (at your option) any later version."),
    ("ISC", "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies."),
    ("MIT", "Released under the {MIT} License."),
    ("MIT", 'Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the "Software"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions: The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software.'),
    ("MPL-2.0", "This Source Code Form is subject to the terms of the {Mozilla Public License, v. 2.0}."),
    ("Unlicense", "This is free and unencumbered software released into the public domain."),
    ("Unlicense", 'This is free and unencumbered software released into the public domain. Anyone is free to copy, modify, publish, use, compile, sell, or distribute this software, either in source code form or as a compiled binary, for any purpose, commercial or non-commercial, and by any means. In jurisdictions that recognize copyright laws, the author or authors of this software dedicate any and all copyright interest in the software to the public domain. We make this dedication for the benefit of the public at large and to the detriment of our heirs and successors. We intend this dedication to be an overt act of relinquishment in perpetuity of all present and future rights to this software under copyright law.'),
    ("Zlib", "This software is provided 'as-is', without any express or implied warranty. In no event will the authors be held liable for any damages arising from the use of this software. Permission is granted to anyone to use this software for any purpose, including commercial applications, and to alter it and redistribute it freely, subject to the following restrictions: 1. The origin of this software must not be misrepresented; you must not claim that you wrote the original software. If you use this software in a product, an acknowledgment in the product documentation would be appreciated but is not required. 2. Altered source versions must be plainly marked as such, and must not be misrepresented as being the original software. 3. This notice may not be removed or altered from any source distribution."),
    ("BSL-1.0", 'Permission is hereby granted, free of charge, to any person or organization obtaining a copy of the software and accompanying documentation covered by this license (the "Software") to use, reproduce, display, distribute, execute, and transmit the Software, and to prepare derivative works of the Software, and to permit third-parties to whom the Software is furnished to do so, all subject to the following: The copyright notices in the Software and this entire statement, including the above license grant, this restriction and the following disclaimer, must be included in all copies of the Software, in whole or in part, and all derivative works of the Software, unless such copies or derivative works are solely in the form of machine-executable object code generated by a source language processor.'),
    ("GPL-2.0", "This work is licensed under the {GNU General Public License, version 2}."),
    ("GPL-2.0", "This program is free software; you can redistribute it and/or modify it under the terms of the {GNU General} Public License as published by the Free Software Foundation; either {version 2} of the License, or (at your option) any later version."),
    ("LGPL-2.0", "This library is licensed under the {GNU Lesser General Public License, version 2}."),
    ("LGPL-2.1", "This library is licensed under the {GNU Lesser General Public License, version 2.1}."),
    ("LGPL-2.1", "This library is free software; you can redistribute it and/or modify it under the terms of the {GNU Lesser General} Public License as published by the Free Software Foundation; either {version 2.1} of the License, or (at your option) any later version."),
    ("AGPL-3.0", "This work is licensed under the {GNU Affero General Public License, version 3}."),
    ("MIT OR Apache-2.0", "Dual licensed under {MIT or Apache-2.0}."),
]
# The disclaimers with which these licences end.
_AS_IS = 'THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE.'
_BSD = 'THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS "AS IS" AND ANY EXPRESS OR IMPLIED WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE DISCLAIMED. IN NO EVENT SHALL THE COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE FOR ANY DIRECT, INDIRECT, INCIDENTAL, SPECIAL, EXEMPLARY, OR CONSEQUENTIAL DAMAGES (INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF SUBSTITUTE GOODS OR SERVICES; LOSS OF USE, DATA, OR PROFITS; OR BUSINESS INTERRUPTION) HOWEVER CAUSED AND ON ANY THEORY OF LIABILITY, WHETHER IN CONTRACT, STRICT LIABILITY, OR TORT (INCLUDING NEGLIGENCE OR OTHERWISE) ARISING IN ANY WAY OUT OF THE USE OF THIS SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE.'
_ISC = 'THE SOFTWARE IS PROVIDED "AS IS" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT, INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS, WHETHER IN AN ACTION OF CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH THE USE OR PERFORMANCE OF THIS SOFTWARE.'
_ENDS = {"MIT": _AS_IS, "BSD-2-Clause": _BSD, "BSD-3-Clause": _BSD, "ISC": _ISC}
#: The whole licences: the longest wording of each, with its disclaimer.
TEMPLATES += [(name, max((t for n, t in TEMPLATES if n == name), key=len) + " " + end) for name, end in _ENDS.items()]

# The Creative Commons licences, short and long.
CREATIVE = {"BY": "Attribution", "BY-SA": "Attribution-ShareAlike", "BY-NC": "Attribution-NonCommercial", "BY-ND": "Attribution-NoDerivatives", "BY-NC-SA": "Attribution-NonCommercial-ShareAlike", "BY-NC-ND": "Attribution-NonCommercial-NoDerivatives"}
# Identifiers, and the names that short notices give.
SHORT = {"Apache-2.0": "Apache 2.0", "BSD-2-Clause": "BSD 2-Clause", "BSD-3-Clause": "BSD 3-Clause", "BSL-1.0": "Boost Software", "GPL-2.0": "GPLv2", "GPL-3.0": "GPLv3", "ISC": "ISC", "LGPL-2.1": "LGPLv2.1", "LGPL-3.0": "LGPLv3", "AGPL-3.0": "AGPLv3", "MPL-2.0": "MPL 2.0", "Zlib": "zlib"}
TEMPLATES += [(f"CC-{k}-4.0", f"Licensed under {{CC {k} 4.0}}.") for k in CREATIVE]
TEMPLATES += [(f"CC-{k}-4.0", f"This work is licensed under a Creative Commons {{{v} 4.0}} International License.") for k, v in CREATIVE.items() if k != "BY"]
TEMPLATES += [(k, f"Released under the {{{v}}} License.") for k, v in SHORT.items()]
TEMPLATES += [(k, f"{{SPDX-License-Identifier: {k}}}") for k in sorted({n for n, _ in TEMPLATES})]

_WORD = re.compile(r"[^\W_]+")


def words(text: str) -> list[str]:
    """Normalised: lower case, letters and digits only."""
    return _WORD.findall(text.lower())


def bigrams(words: list[str]) -> Counter:
    """Counted pairs of neighbours; one word alone pairs with the end."""
    return Counter(zip(words, [*words[1:], ""] if len(words) == 1 else words[1:], strict=False))


def dice(a: Counter, b: Counter) -> float:
    total = a.total() + b.total()
    return 2 * (a & b).total() / total if total else 0.0


def deciding(template: str) -> list[list[str]]:
    """The words in braces, in a row each."""
    return [words(part) for part in re.findall(r"\{([^}]*)\}", template)]


class Scanner:
    """Templates by size. A text of n bigrams reaches Dice t only with templates of up to n (2 - t) / t, and a run of it with those of n t / (2 - t) to n (2 - t) / t."""

    def __init__(self, templates: list[tuple[str, str]], least: float) -> None:
        made = sorted(((bigrams(words(t)), name, deciding(t)) for name, t in templates), key=lambda x: x[0].total())
        self.made, self.sizes, self.least = [x[:2] for x in made], [x[0].total() for x in made], least
        self.deciding = [x[2] for x in made]
        self.ratio = (2 - least) / least
        self.ids: dict[tuple[str, str], int] = {}
        self.holders: list[list[tuple[int, int]]] = []  # of each bigram: templates and how often each has it
        self.counts: list[dict[int, int]] = [{} for _ in made]
        for t, (own, _) in enumerate(self.made):
            for b, n in own.items():
                i = self.ids.setdefault(b, len(self.ids))
                self.holders += [[]] * (len(self.ids) - len(self.holders))
                self.holders[i] = [*self.holders[i], (t, n)]
                self.counts[t][i] = n
        self.alone = {b[0] for b in self.ids if not b[1]}

    def candidates(self, n: int) -> int:
        """How many templates, of which the shortest come first, a run of a text of n bigrams can reach."""
        return bisect_right(self.sizes, n * self.ratio + 1e-9)

    def decided(self, t: int, found: list[str], starts: np.ndarray, spots: dict[str, list[int]]) -> np.ndarray:
        """For runs that begin with these bigrams the least last bigram by which all deciding words of the template have stood in a row; past the text's end if never.

        ``spots`` keeps where words stand, for the other templates of the text.
        """
        need = starts.copy()
        for phrase in self.deciding[t]:
            n = len(phrase)
            if phrase[0] not in spots:
                spots[phrase[0]] = [i for i, w in enumerate(found) if w == phrase[0]]
            places = np.array([*[i for i in spots[phrase[0]] if found[i : i + n] == phrase], len(found) + 1], np.int64)
            need = np.maximum(need, places[np.searchsorted(places, starts)] + n - 2)  # bigrams i to j hold the words i to j + 1
        return need

    def windows(self, found: list[str]) -> list[tuple[int, float, int, int, str]]:
        """(gain, dice, first bigram, last bigram, licence): from each place the most similar run of words, for each template it reaches.

        A run that begins or ends with a bigram the template lacks, or has had often enough, is less similar than without it. So
        runs begin and end at bigrams of the template, and only where enough of them lie within its largest size.
        The gain is what is in common less what either has alone.
        """
        hits = [(i, b) for i, b in enumerate(map(self.ids.get, zip(found, found[1:], strict=False))) if b is not None]
        if self.alone:
            hits = sorted(hits + [(i, self.ids[w, ""]) for i, w in enumerate(found) if w in self.alone])
        common, reach = Counter(), self.candidates(max(1, len(found) - 1))
        for b, n in Counter(b for _, b in hits).items():
            for t, most in self.holders[b]:
                if t < reach:
                    common[t] += min(n, most)
        result: list[tuple[int, float, int, int, str]] = []
        places: dict[str, list[int]] = {}
        for t, n_common in common.items():
            size, own, name = self.sizes[t], self.counts[t], self.made[t][1]
            least, longest = max(1, math.ceil(size / self.ratio - 1e-9)), int(size * self.ratio + 1e-9)
            if n_common < least:
                continue
            spots = [(i, b) for i, b in hits if b in own]
            at, earlier, seen = np.array([i for i, _ in spots]), np.full(len(spots), -1), {}
            for e, (_, b) in enumerate(spots):  # the spot with which the template has this bigram once too often
                before = seen.setdefault(b, deque(maxlen=own[b]))
                if len(before) == own[b]:
                    earlier[e] = before[0]
                before.append(e)
            start = np.arange(len(spots) - least + 1)
            start = start[at[start + least - 1] - at[start] < longest]
            need = self.decided(t, found, at[start], places)
            c, gain, top, last = (np.zeros(len(start), kind) for kind in (np.int64, np.int64, float, np.int64))
            live = np.arange(len(start))
            for far in range(longest):  # all runs that take one more spot
                e = start[live] + far
                live = live[e < len(spots)]
                e = start[live] + far
                near = at[e] - at[start[live]] < longest
                live, e = live[near], e[near]
                if not len(live):
                    break
                new = earlier[e] < start[live]
                c[live] += new
                width = at[e] - at[start[live]] + 1
                score = 2 * c[live] / (width + size)
                better = new & (score >= self.least) & (score > top[live]) & (at[e] >= need[live])
                own_rows = live[better]
                top[own_rows], last[own_rows], gain[own_rows] = score[better], at[e[better]], 3 * c[own_rows] - width[better] - size
            result += [(int(gain[i]), float(top[i]), int(at[start[i]]), int(last[i]), name) for i in np.flatnonzero(top)]
        return result

    def licenses(self, found: list[str]) -> dict[str, tuple[float, int]]:
        """Of each licence the best match: minus its Dice coefficient, first bigram.

        Where runs of different licences overlap, the one with the higher gain counts: a licence that goes on with further
        conditions is not also the shorter one.
        """
        best: dict[str, tuple[float, int]] = {}
        starts: list[int] = []
        kept: list[tuple[int, str]] = []
        for _, score, first, last, name in sorted(self.windows(found), key=lambda x: (-x[0], x[2], x[4])):
            i = end = bisect_right(starts, last)
            while i and kept[i - 1][0] >= first:
                i -= 1
            if any(other != name for _, other in kept[i:end]):
                continue
            if i == end:
                starts.insert(i, first)
                kept.insert(i, (last, name))
            best[name] = min(best.get(name, (0.0, 0)), (-score, first))
        return best


def lines(text: str, places: set[int]) -> dict[int, int]:
    """The line, from 0, of each of these words."""
    text = text.lower()
    return {i: text.count("\n", 0, m.start()) for i, m in enumerate(_WORD.finditer(text)) if i in places}


def scan(docs: DataFrame, *, templates: list[tuple[str, str]] | None = None, least: float = LEAST) -> DataFrame:
    """doc_id, license, dice, line: the best match of each licence in each document that has one.

    A template's deciding words (name, version, restrictions) must stand in the run in a row, so a non-commercial notice is not the permissive one that shares the rest of
    its words. What a sentence says about a notice is not read: "not released under the MIT License" is MIT. Every run of words of the whole text is compared to the templates, across lines and paragraphs. ``line`` counts from 0 and is
    where the match begins; among equally similar matches the first counts. Null and empty texts match nothing; a repeated row gives its rows again; very long
    texts are read whole. The templates are a parameter of fixed size.
    """
    schema = T.StructType([T.StructField("doc_id", docs.schema["doc_id"].dataType), T.StructField("license", T.StringType()), T.StructField("dice", T.DoubleType()), T.StructField("line", T.IntegerType())])
    scanner = Scanner(templates or TEMPLATES, least)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows: list[tuple] = []
            for doc, text in zip(batch["doc_id"].to_pylist(), batch["text"].to_pylist(), strict=True):
                if best := scanner.licenses(words(text or "")):
                    line = lines(text, {first for _, first in best.values()})
                    rows += [(doc, name, -score, line[first]) for name, (score, first) in sorted(best.items())]
            columns = list(zip(*rows, strict=True)) or [[]] * 4
            yield pa.RecordBatch.from_arrays([pa.array(columns[0], batch.schema.field("doc_id").type), pa.array(columns[1], pa.string()), pa.array(columns[2], pa.float64()), pa.array(columns[3], pa.int32())], names=schema.names)

    return docs.select("doc_id", "text").mapInArrow(run, schema)
