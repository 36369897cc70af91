"""License scans by conditional compression.

Around every place of a cue, as many words as a wording reaches on both sides are compressed twice: alone, and with that wording as a raw zstandard
dictionary. The wordings are ranked by how many bytes they take off, and looked at in this order: the words of both are aligned, and what is missing or put in between decides whether the statement is exact, modified, or not
this license. The first one that its words confirm is the statement; its words are taken out and the rest is looked at again. Wordings that lack
too many of their words around the place are passed over, as no alignment could confirm them.
"""

from __future__ import annotations

import re
from bisect import bisect_left, bisect_right
from collections.abc import Iterable, Iterator
from dataclasses import dataclass
from difflib import SequenceMatcher
from functools import lru_cache
from itertools import accumulate

import pandas as pd
import zstandard
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cityloom.llm.common import text_of

# Wordings of license statements, notices and texts.
_GNU = (
    ("GPL-2.0-or-later", "General", "2"), ("GPL-3.0-or-later", "General", "3"), ("LGPL-2.1-or-later", "Lesser General", "2.1"),
    ("LGPL-3.0-or-later", "Lesser General", "3"), ("AGPL-3.0-or-later", "Affero General", "3"),
)
_CC = {
    "CC-BY-4.0": "Attribution", "CC-BY-SA-4.0": "Attribution-ShareAlike", "CC-BY-NC-4.0": "Attribution-NonCommercial", "CC-BY-ND-4.0": "Attribution-NoDerivatives",
    "CC-BY-NC-SA-4.0": "Attribution-NonCommercial-ShareAlike", "CC-BY-NC-ND-4.0": "Attribution-NonCommercial-NoDerivatives",
}


def _gnu_notice(kind: str, version: str) -> str:
    """The notice that the GNU licenses ask for."""
    thing = "library" if version == "2.1" else "program"
    return (
        f"This {thing} is free software: you can redistribute it and/or modify it under the terms of the GNU {kind} Public License as published by the Free Software Foundation, "
        f"either version {version} of the License, or (at your option) any later version. This {thing} is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; "
        f"without even the implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. See the GNU {kind} Public License for more details."
    )


_PERMISSION = (
    "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the \"Software\"), to deal in the Software "
    "without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit "
    "persons to whom the Software is furnished to do so, subject to the following conditions:"
)
_AS_IS_MIT = (
    'THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR '
    "PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR "
    "OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE."
)
_BSD = (
    "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met: Redistributions of source code "
    "must retain the above copyright notice, this list of conditions and the following disclaimer. Redistributions in binary form must reproduce the above copyright notice, this "
    "list of conditions and the following disclaimer in the documentation and/or other materials provided with the distribution."
)
_AS_IS_BSD = (
    'THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS "AS IS" AND ANY EXPRESS OR IMPLIED WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF '
    "MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE DISCLAIMED. IN NO EVENT SHALL THE COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE FOR ANY DIRECT, INDIRECT, INCIDENTAL, "
    "SPECIAL, EXEMPLARY, OR CONSEQUENTIAL DAMAGES (INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF SUBSTITUTE GOODS OR SERVICES; LOSS OF USE, DATA, OR PROFITS; OR BUSINESS "
    "INTERRUPTION) HOWEVER CAUSED AND ON ANY THEORY OF LIABILITY, WHETHER IN CONTRACT, STRICT LIABILITY, OR TORT (INCLUDING NEGLIGENCE OR OTHERWISE) ARISING IN ANY WAY OUT OF THE "
    "USE OF THIS SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE."
)
TEMPLATES = {
    "all-rights-reserved": "All rights reserved.",
    "Apache-2.0": "Licensed under the Apache License, Version 2.0.",
    "BSD-3-Clause": "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met: "
    "Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer.",
    "CC-BY-4.0": "Licensed under CC BY 4.0.",
    "CC-BY-NC-4.0": "Licensed under CC BY-NC 4.0.",
    "CC-BY-SA-4.0": "Licensed under CC BY-SA 4.0.",
    "CC0-1.0": "To the extent possible under law, the author has waived all copyright and related rights to this work, dedicated to the public domain.",
    "GPL-2.0": "This work is licensed under the GNU General Public License, version 2.",
    "GPL-3.0": "This work is licensed under the GNU General Public License, version 3.",
    "LGPL-3.0": "This work is licensed under the GNU Lesser General Public License, version 3.",
    "MIT": "Released under the MIT License.",
    "MIT-text": "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files, to deal in the "
    "Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies.",
    "MPL-2.0": "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0.",
    # Published notices.
    "Apache-2.0-notice": 'Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in compliance with the License. You may obtain a '
    "copy of the License at http://www.apache.org/licenses/LICENSE-2.0 Unless required by applicable law or agreed to in writing, software distributed under the License is "
    'distributed on an "AS IS" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. See the License for the specific language governing '
    "permissions and limitations under the License.",
    "MPL-2.0-notice": "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not distributed with this file, You can "
    "obtain one at https://mozilla.org/MPL/2.0/.",
    **{f"{name}-notice": _gnu_notice(kind, version) for name, kind, version in _GNU},
    **{f"{name}-notice": f"This work is licensed under a Creative Commons {title} 4.0 International License." for name, title in _CC.items()},
    # Published texts.
    "MIT-full": _PERMISSION + " The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software. " + _AS_IS_MIT,
    "ISC": "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and "
    'this permission notice appear in all copies. THE SOFTWARE IS PROVIDED "AS IS" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED '
    "WARRANTIES OF MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT, INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER "
    "RESULTING FROM LOSS OF USE, DATA OR PROFITS, WHETHER IN AN ACTION OF CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH THE USE OR "
    "PERFORMANCE OF THIS SOFTWARE.",
    "BSD-2-Clause-full": f"{_BSD} {_AS_IS_BSD}",
    "BSD-3-Clause-full": f"{_BSD} Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software "
    f"without specific prior written permission. {_AS_IS_BSD}",
}
#: A statement is looked for around each place of these; every wording holds one.
CUES = ("licens", "licenc", "rights reserved", "copyright", "permission is hereby", "public domain", "redistribution")

_WORD = re.compile(r"[a-z0-9]+(?:[-./][a-z0-9]+)*")
LEVEL = 9
#: Most share of a wording's words that a modified statement may lack or put in.
MOST_CHANGED = 0.1
#: So many words may differ in any wording, however short.
LEAST_CHANGED = 2
#: Words that tell licenses apart: they may neither be lacking nor be put in, nor may numbers.
NAMING = frozenset(
    "mit apache gnu gpl lgpl agpl lesser affero library mozilla mpl bsd isc cc by by-nc by-sa by-nd by-nc-sa by-nc-nd nc sa nd cc0 creative commons attribution attribution-sharealike "
    "attribution-noncommercial attribution-noderivatives attribution-noncommercial-sharealike attribution-noncommercial-noderivatives sharealike noncommercial noderivatives".split()
)
#: The same in wordings so short that MOST_CHANGED allows fewer than LEAST_CHANGED words.
NAMING_SHORT = NAMING | frozenset("all rights reserved general public license domain free documentation not no never non nor neither without except some".split())
#: Before a short wording these say the opposite of it.
NEGATIONS = frozenset("not no never nor neither without".split())
_SPDX = re.compile(r"spdx-license-identifier:[ \t]*(\(*[a-z0-9.+-]+\)*(?:[ \t]+(?:and|or|with)[ \t]+\(*[a-z0-9.+-]+\)*)*)", re.IGNORECASE)


class Numbering(str):
    """Number of a list item; put in between the words of a wording it is no difference."""


_NUMBERING = re.compile(r"^[^a-z0-9\n]*(\d{1,2})[.)](?=\s)", re.MULTILINE)


def words_of(text: str) -> list[str]:
    return _WORD.findall(text.lower())


@dataclass(frozen=True)
class Found:
    """A confirmed statement: license, bytes saved as a share of those that the wording saves of itself, ``exact`` or ``modified``, and the words that differ."""

    license: str
    saved: float
    status: str
    differences: str


class Scanner:
    """Compressors for all wordings; one for each process."""

    def __init__(self, templates: dict[str, str]):
        self.words = {name: words_of(text) for name, text in templates.items()}
        self.distinct = {name: frozenset(words) for name, words in self.words.items()}
        self.required = {name: frozenset(word for word in words if self.naming(word, name)) for name, words in self.distinct.items()}
        self.plain = zstandard.ZstdCompressor(level=LEVEL, write_content_size=False)
        self.own, self.given = {}, {}
        for name, words in self.words.items():
            data = " ".join(words).encode()
            raw = zstandard.ZstdCompressionDict(data, dict_type=zstandard.DICT_TYPE_RAWCONTENT)
            self.given[name] = zstandard.ZstdCompressor(level=LEVEL, dict_data=raw, write_content_size=False, write_dict_id=False)
            self.own[name] = len(self.plain.compress(data)) - len(self.given[name].compress(data))

    def reach(self, name: str) -> int:
        """How many words before and behind a cue a statement can stand."""
        return len(self.words[name]) + max(2, self.changes(name))

    def ranking(self, words: list[str], at: int) -> list[tuple[int, str]]:
        """All licenses by the bytes that their wordings take off the words around a place, most first; of equal ones the longer wording, then the smaller name."""
        plain: dict[int, int] = {}
        reduced = []
        for name, compressor in self.given.items():
            reach = self.reach(name)
            data = " ".join(words[max(0, at - reach) : at + reach + 1]).encode()
            if reach not in plain:
                plain[reach] = len(self.plain.compress(data))
            reduced.append((plain[reach] - len(compressor.compress(data)), name))
        return sorted(reduced, key=lambda entry: (-entry[0], -len(self.words[entry[1]]), entry[1]))

    def changes(self, name: str) -> int:
        """Most words that a modified statement may lack or put in."""
        return max(LEAST_CHANGED, int(MOST_CHANGED * len(self.words[name])))

    def naming(self, word: str, name: str) -> bool:
        """Whether a word is part of the license's name or version."""
        return bool(re.search(r"\d", word)) or word in (NAMING_SHORT if self.short(name) else NAMING)

    def short(self, name: str) -> bool:
        return MOST_CHANGED * len(self.words[name]) < LEAST_CHANGED

    def possible(self, words: Iterable[str], names: Iterable[str]) -> list[str]:
        """Licenses that lack no word of their name and version and not more others than a modified statement may."""
        there = set(words)
        return [name for name in names if self.required[name] <= there and len(self.distinct[name] - there) <= self.changes(name)]

    def compare(self, words: list[str], name: str) -> tuple[str, str, int, int] | None:
        """Status, differing words, and span of a license's wording in a block; None if it is not there."""
        wording = self.words[name]
        pairs = [m for m in SequenceMatcher(None, words, wording, autojunk=False).get_matching_blocks() if m.size]
        if not pairs:
            return None
        # Chance matches far from the longest one are no part of the statement.
        longest = max(pairs, key=lambda m: m.size)
        near = [m for m in pairs if abs((m.a - m.b) - (longest.a - longest.b)) <= max(2, len(wording) // 5)]
        begin, end = near[0].a, near[-1].a + near[-1].size
        matched = {i for m in near for i in range(m.a, m.a + m.size)}
        kept = {i for m in near for i in range(m.b, m.b + m.size)}
        lacking = [word for i, word in enumerate(wording) if i not in kept]
        added = [word for i, word in enumerate(words[begin:end], begin) if i not in matched and not isinstance(word, Numbering)]
        differences = " ".join([*(f"-{word}" for word in lacking), *(f"+{word}" for word in added)])
        if self.short(name) and begin and words[begin - 1] in NEGATIONS:
            return None
        if not differences:
            return "exact", "", begin, end
        if len(lacking) + len(added) <= self.changes(name) and not any(self.naming(word, name) for word in lacking + added):
            return "modified", differences, begin, end
        return None

    def _best(self, words: list[str], at: int) -> tuple[Found, int, int] | None:
        """The statement around one place, and its span: the first of the ranking that its words confirm."""
        for reduced, name in self.ranking(words, at):
            low = max(0, at - self.reach(name))
            block = words[low : at + self.reach(name) + 1]
            if self.possible(block, [name]) and (compared := self.compare(block, name)):
                status, differences, begin, end = compared
                return Found(name, round(reduced / self.own[name], 4), status, differences), low + begin, low + end
        return None

    def _places(self, words: list[str]) -> list[int]:
        """Numbers of the words at which a cue begins; what stands between words, line ends too, plays no part."""
        joined, starts = " ".join(words), [0, *accumulate(len(word) + 1 for word in words)]
        found = {m.start() for cue in CUES for m in re.finditer(re.escape(cue), joined)}
        return sorted({bisect_right(starts, at) - 1 for at in found})

    def scan(self, text: str) -> list[tuple[int, int, Found]]:
        """Statements of a whole text with the first and last line of their words, in the order of these lines.

        ``licence`` counts as ``license``. An SPDX tag states each license of its expression exactly, known here or not, with a share of 1.
        """
        lowered = text.lower()
        if not any(all(part in lowered for part in cue.split()) for cue in CUES):
            return []
        numbering = {m.start(1) for m in _NUMBERING.finditer(lowered)}
        spans = [(m.start(), m.group()) for m in _WORD.finditer(lowered)]
        starts = [start for start, _ in spans]
        words = [Numbering(word) if start in numbering else word.replace("licenc", "licens") for start, word in spans]
        places, left, result = self._places(words) if self.possible(words, self.words) else [], list(range(len(words))), []
        more = bool(places)
        # What is taken out brings other words together, so all places are looked at until nothing more is found.
        while more:
            more = False
            for place in places:
                while (at := bisect_left(left, place)) < len(left) and left[at] == place and (best := self._best(words, at)):
                    found, begin, end = best
                    result.append((left[begin], left[end - 1], found))
                    del left[begin:end], words[begin:end]
                    more = True
        line = lambda word: lowered.count("\n", 0, starts[word])
        stated = [(line(first), line(last), found) for first, last, found in sorted(result, key=lambda entry: entry[:2])]
        return sorted([*self._tags(text), *stated], key=lambda entry: entry[:2])

    def _tags(self, text: str) -> list[tuple[int, int, Found]]:
        """Licenses named by SPDX tags."""
        found = []
        for tag in _SPDX.finditer(text):
            number = text.count("\n", 0, tag.start())
            names = [name.strip("().") for name in tag.group(1).split()]
            found += [(number, number, Found(name, 1.0, "exact", "")) for name in names if name and name.lower() not in ("and", "or", "with")]
        return found


@lru_cache(maxsize=1)
def _scanner(templates: tuple[tuple[str, str], ...]) -> Scanner:
    return Scanner(dict(templates))


_TYPE = "array<struct<first_line:int,last_line:int,license:string,saved:double,status:string,differences:string>>"


def license_statements(text: str | Column, templates: dict[str, str] | None = None) -> Column:
    """Statements found in each whole text, in the order of their lines; none for NULL and empty texts."""
    wordings = tuple((templates or TEMPLATES).items())

    @F.pandas_udf(_TYPE)
    def found(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        scanner = _scanner(wordings)
        for series in batches:
            yield pd.Series([_rows(scanner.scan(value)) for value in series], dtype=object)

    return found(text_of(text))


def _rows(found: Iterable[tuple[int, int, Found]]) -> list[dict]:
    return [{"first_line": first, "last_line": last, "license": f.license, "saved": f.saved, "status": f.status, "differences": f.differences} for first, last, f in found]


def with_licenses(docs: DataFrame, templates: dict[str, str] | None = None, text_column: str = "text", result: str = "licenses") -> DataFrame:
    """``docs`` with an array of the license statements of each text.

    All rows and other columns stay; a column named like the result is replaced. NULL and empty texts state nothing. Of wordings that save the same
    bytes the longer one, then the smaller name, is tried first. Rows stand alone, so repeated rows and empty tables need no rule.
    """
    return docs.drop(result).withColumn(result, license_statements(text_column, templates))
