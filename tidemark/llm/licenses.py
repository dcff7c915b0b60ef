"""License scans by conditional compression.

A block of lines that may state a license is compressed with every template as a raw dictionary. In the order of what they
save, templates are confirmed by exact differences of wording; the first that is confirmed takes its words, what is left is
compressed again, and so on until no template is confirmed. So the template that explains most of what is left decides which of
several like wordings is told, and neither long notices nor siblings hide others.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from itertools import accumulate, chain

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from tidemark.llm.common import col

_BSD = (
    "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the "
    "following conditions are met:"
)
_BSD_2 = (
    f"{_BSD} Redistributions of source code must retain the above copyright notice, this list of conditions and the following "
    "disclaimer. Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the "
    "following disclaimer in the documentation and/or other materials provided with the distribution."
)
_ADVERTISING = (
    "All advertising materials mentioning features or use of this software must display the following acknowledgement: This "
    "product includes software developed by the copyright holder."
)
_NO_NAMES = (
    "Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products "
    "derived from this software without specific prior written permission."
)
_BSD_END = (
    'THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS "AS IS" AND ANY EXPRESS OR IMPLIED WARRANTIES, '
    "INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE DISCLAIMED."
)

#: Notices and grants by which works state their license.
TEMPLATES = {
    "Apache-2.0": (
        "Licensed under the Apache License, Version 2.0.",
        'Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in compliance with '
        "the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0 Unless required by "
        'applicable law or agreed to in writing, software distributed under the License is distributed on an "AS IS" BASIS, '
        "WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. See the License for the specific language "
        "governing permissions and limitations under the License.",
    ),
    "MIT": (
        "Released under the MIT License.",
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated "
        'documentation files (the "Software"), to deal in the Software without restriction, including without limitation the '
        "rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit "
        "persons to whom the Software is furnished to do so, subject to the following conditions:",
    ),
    "ISC": (
        "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, "
        "provided that the above copyright notice and this permission notice appear in all copies.",
    ),
    # The sentence that all of the family begin with, for texts without clauses that tell which one it is.
    "BSD": (_BSD,),
    "BSD-2-Clause": (_BSD_2, f"{_BSD_2} {_BSD_END}"),
    "BSD-3-Clause": (f"{_BSD_2} {_NO_NAMES}", f"{_BSD_2} {_NO_NAMES} {_BSD_END}"),
    "BSD-4-Clause": (f"{_BSD_2} {_ADVERTISING} {_NO_NAMES}", f"{_BSD_2} {_ADVERTISING} {_NO_NAMES} {_BSD_END}"),
    "GPL-2.0": (
        "This work is licensed under the GNU General Public License, version 2.",
        "This program is free software; you can redistribute it and/or modify it under the terms of the GNU General Public "
        "License as published by the Free Software Foundation; either version 2 of the License, or (at your option) any later "
        "version.",
    ),
    "GPL-3.0": (
        "This work is licensed under the GNU General Public License, version 3.",
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public "
        "License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later "
        "version.",
    ),
    "LGPL-2.1": (
        "This work is licensed under the GNU Lesser General Public License, version 2.1.",
        "This library is free software; you can redistribute it and/or modify it under the terms of the GNU Lesser General "
        "Public License as published by the Free Software Foundation; either version 2.1 of the License, or (at your option) "
        "any later version.",
    ),
    "LGPL-3.0": ("This work is licensed under the GNU Lesser General Public License, version 3.",),
    "AGPL-3.0": (
        "This work is licensed under the GNU Affero General Public License, version 3.",
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU Affero General "
        "Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any "
        "later version.",
    ),
    "MPL-2.0": (
        "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not "
        "distributed with this file, You can obtain one at http://mozilla.org/MPL/2.0/.",
    ),
    "CC-BY-4.0": (
        "Licensed under CC BY 4.0.",
        "This work is licensed under a Creative Commons Attribution 4.0 International License.",
    ),
    "CC-BY-SA-4.0": (
        "Licensed under CC BY-SA 4.0.",
        "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License.",
    ),
    "CC-BY-NC-4.0": (
        "Licensed under CC BY-NC 4.0.",
        "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License.",
    ),
    "Unlicense": (
        "This is free and unencumbered software released into the public domain.",
        "This is free and unencumbered software released into the public domain. Anyone is free to copy, modify, publish, use, "
        "compile, sell, or distribute this software, either in source code form or as a compiled binary, for any purpose, "
        "commercial or non-commercial, and by any means.",
    ),
    "Zlib": (
        "This software is provided 'as-is', without any express or implied warranty. In no event will the authors be held liable "
        "for any damages arising from the use of this software. Permission is granted to anyone to use this software for any "
        "purpose, including commercial applications, and to alter it and redistribute it freely, subject to the following "
        "restrictions:",
    ),
    "BSL-1.0": (
        "Distributed under the Boost Software License, Version 1.0.",
        "Permission is hereby granted, free of charge, to any person or organization obtaining a copy of the software and "
        'accompanying documentation covered by this license (the "Software") to use, reproduce, display, distribute, execute, and '
        "transmit the Software, and to prepare derivative works of the Software, and to permit third-parties to whom the Software "
        "is furnished to do so, all subject to the following:",
    ),
    "EPL-2.0": (
        "This program and the accompanying materials are made available under the terms of the Eclipse Public License 2.0 which is "
        "available at https://www.eclipse.org/legal/epl-2.0/",
    ),
    "CC0-1.0": ("To the extent possible under law, the author has waived all copyright and related or neighboring rights to this work.",),
}

#: A license that others add clauses to, words of such clauses, and the family that is told where they are in its wording, or
#: after it up to the next wording or the end of the block.
BEGINS_OTHERS = {"BSD-2-Clause": ({"advertising", "endorse", "promote"}, "BSD")}
#: Words that tell a license from another one; like numbers, a wording may not lack them.
TELLING = {"affero", "lesser", "library", "by-sa", "by-nc", "attribution-sharealike", "attribution-noncommercial"}

#: Lower-case strings of which a block's lines hold one at least.
CUES = ("licen", "copyright", "permission", "warrant", "redistribut", "spdx", "public domain", "creative commons",
        "all rights reserved", "free software", "cc by", "cc0", "disclaimer", "endorse", "advertising materials",
        "mentioning features", "following acknowledg", "subject to the following", "derivative works",
        "compiled binary")
#: Lines without a cue that a block holds before its first and after its last line with one.
GAP = 2
#: The least share of a template's words that have to be there, in order. As many may be amid them as may be lacking.
MIN_SAME = 0.9
#: Words of a block that are compared at once.
WINDOW = 4096

#: More words than any wording may have amid its own.
_NEVER = 1 << 20

_WORD = re.compile(r"[^\W_]+(?:[.'-][^\W_]+)*")


_TAG = re.compile(r"SPDX-License-Identifier:[ \t]*([^\r\n]*)", re.IGNORECASE)
_TAG_PART = re.compile(r"[\s()]*([A-Za-z0-9][A-Za-z0-9.:-]*\+?)[ \t)]*")
_BY_IDENTIFIER = {name.lower(): name for name in TEMPLATES}


def identifiers(block: str) -> list[tuple[str, int, int]]:
    """The licenses that SPDX tags name, with the places of their identifiers.

    GPL-2.0-only, GPL-2.0-or-later and GPL-2.0+ are told as GPL-2.0; a license without a template is told as it is written,
    if nothing but signs follows the expression on its line.
    """
    found = []
    for tag in _TAG.finditer(block):
        own, at, joined = [], tag.start(1), ""
        while joined is not None and (part := _TAG_PART.match(block, at, tag.end())):
            if joined != "with":
                own.append(part.span(1))
            at = part.end()
            joint = re.compile(r"(and|or|with)\b", re.IGNORECASE).match(block, at, tag.end())
            joined, at = (joint[1].lower(), joint.end()) if joint else (None, at)
        ended = not re.search(r"\w", block[at : tag.end()])
        for a, b in own:
            plain = re.sub(r"(\+|-only|-or-later)$", "", block[a:b].rstrip(".:-").lower())
            name = _BY_IDENTIFIER.get(plain)
            if name or (ended and plain not in ("none", "noassertion")):
                found.append((name or block[a:b].rstrip(".:-"), a, b))
    return found


def words(text: str) -> list[str]:
    return _WORD.findall(text.lower())


def _tells(word: str) -> bool:
    return word in TELLING or any(c.isdigit() for c in word)


def blocks(text: str) -> list[tuple[int, int]]:
    """Places (start, end) of candidate blocks: lines with a cue at most ``GAP`` lines apart, and as many lines around them."""
    if not any(cue in text.lower() for cue in CUES):
        return []
    lines = text.split("\n")
    ends = list(accumulate(len(line) + 1 for line in lines))
    marked = [i for i, line in enumerate(lines) if any(cue in line.lower() for cue in CUES)]
    runs: list[list[int]] = []
    for i in marked:
        if runs and i - runs[-1][1] <= 2 * GAP + 1:
            runs[-1][1] = i
        else:
            runs.append([i, i])
    first = [max(0, a - GAP) for a, _ in runs]
    last = [min(len(lines) - 1, b + GAP) for _, b in runs]
    return [(ends[a] - len(lines[a]) - 1, ends[b] - 1) for a, b in zip(first, last)]


class Scanner:
    def __init__(self):
        self.templates = [(name, text) for name, texts in TEMPLATES.items() for text in texts]
        self.words = [words(text) for _, text in self.templates]
        self.counted = [Counter(own) for own in self.words]
        self.alone = zstandard.ZstdCompressor(level=3)
        self.given = [
            zstandard.ZstdCompressor(
                level=3,
                dict_data=zstandard.ZstdCompressionDict(" ".join(own).encode(), dict_type=zstandard.DICT_TYPE_RAWCONTENT),
            )
            for own in self.words
        ]

    def reductions(self, have: list[str]) -> list[float]:
        """The share of the compressed size of a block's words that each template saves."""
        data = " ".join(have).encode("utf-8", "surrogatepass")
        size = len(self.alone.compress(data))
        return [1 - len(c.compress(data)) / size for c in self.given]

    def ends(self, have: list[str], template: int, counted: Counter | None = None) -> list[tuple[int, int, int]]:
        """Where a template's wording may end among a block's words: (words before the end, words it lacks, words amid them).

        For every end, among all that are allowed, the one with the fewest differences. A template's numbers and telling words
        all have to be there, so that no version stands for another.
        """
        want = self.words[template]
        limit = int((1 - MIN_SAME) * len(want) + 1e-9)
        # What a template lacks can be told from how often words are there, wherever they stand.
        lacking = self.counted[template] - (Counter(have) if counted is None else counted)
        if sum(lacking.values()) > limit or any(_tells(word) for word in lacking):
            return []
        found: dict[int, tuple[int, int]] = {}
        # A wording is no longer than its words and those amid them, so overlapping windows hold each.
        for first in range(0, len(have), WINDOW):
            last = self._rows(have[first : first + WINDOW + len(want) + limit], template, limit)[-1]
            for lacks, end in zip(*np.nonzero(last <= limit)):
                amid = int(last[lacks, end])
                best = found.get(first + int(end))
                if best is None or (2 * int(lacks) + amid) < 2 * best[0] + best[1]:
                    found[first + int(end)] = int(lacks), amid
        return [(end, lacks, amid) for end, (lacks, amid) in sorted(found.items())]

    def _rows(self, have: list[str], template: int, limit: int) -> list[np.ndarray]:
        """For each number of a template's words: the fewest words amid them by the words that they lack and the words before
        their end. A wording may begin anywhere."""
        number = {word: i for i, word in enumerate(self.counted[template])}
        codes = np.array([number.get(word, -1) for word in have], np.int32)
        places = np.arange(len(have) + 1, dtype=np.int32)
        row = np.full((limit + 1, len(have) + 1), _NEVER, np.int32)
        row[0] = 0
        rows = [row]
        for word in self.words[template]:
            new = np.full_like(row, _NEVER)
            new[:, 1:] = np.where(codes == number[word], row[:, :-1], _NEVER)
            if not _tells(word):
                np.minimum(new[1:], row[:-1], out=new[1:])
            row = np.minimum(np.minimum.accumulate(new - places, axis=1) + places, _NEVER)
            rows.append(row)
        return rows

    def differences(self, have: list[str], template: int, lacks: int) -> tuple[list[str], list[str]]:
        """The words that a template's wording lacks, and those amid them; ``have`` is its words from the first to the last."""
        want, lacking, added = self.words[template], [], []
        rows = self._rows(have, template, lacks)
        j, end = len(want), len(have)
        while j:
            here = rows[j][lacks, end]
            if end and want[j - 1] == have[end - 1] and rows[j - 1][lacks, end - 1] == here:
                j, end = j - 1, end - 1
            elif lacks and not _tells(want[j - 1]) and rows[j - 1][lacks - 1, end] == here:
                j, lacks = j - 1, lacks - 1
                lacking.append(want[j])
            else:
                end -= 1
                added.append(have[end])
        return lacking[::-1], added[::-1]

    def _confirmed(self, have: list[str], parts: list[tuple[int, int]], counted: list[Counter], template: int) -> list[tuple]:
        """(first word, last + 1, words it lacks) of a template's wordings in what is left that have the fewest differences, none
        in another. Others may be closer to another template, and wait for a later round."""
        ways = [
            (2 * lacks + amid, first + end - (len(self.words[template]) - lacks) - amid, first + end, lacks)
            for (first, last), own in zip(parts, counted)
            for end, lacks, amid in self.ends(have[first:last], template, own)
        ]
        taken: list[tuple] = []
        least = min(ways, default=(0,))[0]
        used = bytearray(len(have))
        for cost, start, end, lacks in sorted(ways):
            if cost > least:
                break
            if not any(used[start:end]):
                used[start:end] = b"\1" * (end - start)
                taken.append((start, end, lacks))
        return taken

    def wordings(self, have: list[str]) -> list[tuple[int, int, int, int, float]]:
        """(template, first word, last + 1, words it lacks, share saved) of all wordings among a block's words, none within
        another, in the order in which they are confirmed."""
        found, parts = [], [(0, len(have))]
        while parts:
            saved = self.reductions([word for first, last in parts for word in have[first:last]])
            counted = [Counter(have[first:last]) for first, last in parts]
            for template in sorted(range(len(saved)), key=lambda i: (-saved[i], i)):
                if taken := self._confirmed(have, parts, counted, template):
                    break
            else:
                return found
            found += [(template, *one, saved[template]) for one in taken]
            rest = []
            for first, last in parts:
                spans = sorted((start, end) for start, end, _ in taken if first <= start < last)
                edges = [first, *chain(*spans), last]
                rest += [(a, b) for a, b in zip(edges[::2], edges[1::2]) if a < b]
            parts = rest
        return found

    def licenses(self, block: str) -> list[dict]:
        """The templates whose wording is in a block: license, saved, same, lacking, added, and the place of the wording.

        Each license is told once, by the wording that is confirmed first, or else by an SPDX tag's identifier, which has no
        share saved.
        """
        places = [m.span() for m in _WORD.finditer(block)]
        have = [block[a:b].lower() for a, b in places]
        best: dict[str, tuple[int, int, int, int, float]] = {}
        wordings = self.wordings(have)
        starts = sorted(start for _, start, _, _, _ in wordings)
        for i, start, end, lacks, saved in wordings:
            name = self.templates[i][0]
            if name in BEGINS_OTHERS:
                more, family = BEGINS_OTHERS[name]
                if more.intersection(have[start : next((s for s in starts if s >= end), len(have))]):
                    name = family
            best.setdefault(name, (i, start, end, lacks, saved))
        found = []
        for name, (i, start, end, lacks, saved) in best.items():
            lacking, added = self.differences(have[start:end], i, lacks)
            one = {"license": name, "start": places[start][0], "end": places[end - 1][1], "saved": saved}
            found.append(one | {"same": 1 - lacks / len(self.words[i]), "lacking": lacking, "added": added})
        for name, start, end in identifiers(block):
            if name not in best:
                best[name] = ()
                found.append({"license": name, "start": start, "end": end, "saved": None, "same": 1.0, "lacking": [], "added": []})
        return found


_FOUND = T.ArrayType(
    T.StructType()
    .add("license", "string").add("start", "integer").add("end", "integer").add("saved", "double").add("same", "double")
    .add("lacking", T.ArrayType(T.StringType())).add("added", T.ArrayType(T.StringType()))
)


def _scan(batches: Iterator[pa.RecordBatch], schema: pa.Schema) -> Iterator[pa.RecordBatch]:
    scanner = Scanner()
    known: dict[str, list] = {}
    for batch in batches:
        n_blocks, found = [], []
        for text in batch.column("text"):
            text = text.as_py() or ""
            places, own = blocks(text), []
            for start, end in places:
                block = text[start:end]
                if block not in known:
                    if len(known) >= 10_000:
                        known.clear()
                    known[block] = scanner.licenses(block)
                own += [one | {"start": start + one["start"], "end": start + one["end"]} for one in known[block]]
            n_blocks.append(len(places))
            found.append(own)
        columns = [batch.column("doc_id"), pa.array(n_blocks, pa.int64()), pa.array(found, schema.field("found").type)]
        yield pa.RecordBatch.from_arrays(columns, schema=schema)


def scan(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, n_blocks (candidates), found (license, place in code points, share saved, share of words, lacking and added words)
    for every row.

    Null and empty texts have no blocks. Rows that repeat an id are scanned each. Blocks of any length are compressed whole.
    """
    from pyspark.sql.pandas.types import to_arrow_schema

    rows = docs.select(col(id_col).alias("doc_id"), col(text_col).alias("text"))
    made = T.StructType().add("doc_id", rows.schema["doc_id"].dataType).add("n_blocks", "long").add("found", _FOUND)
    arrow = to_arrow_schema(made)
    return rows.mapInArrow(lambda batches: _scan(batches, arrow), made)
