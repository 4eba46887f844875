"""License notices in texts.

Templates of notices are cut into words; runs of GRAM words are hashed and
winnowed (the least hash of each WINDOW neighbours is a fingerprint), which makes
an inverted index from fingerprint to template and place. Every run of GRAM
words of a text is looked up; a hit names a template and, by its place, where in
the text the template would begin. Templates that are hit are aligned with the
words there, in a band around the hit's diagonal, by longest common subsequence
with a cost for words that have no partner. The alignment gives the matched
coverage of the template and the span in the text, in code points.

A match needs COVERAGE of the template. Where spans overlap, the alignment with
the best score stands; of equal ones the longer template, then the first by name.
Hits beside it, whose alignment it took words from, are aligned again with the
words between the spans that stand. Of equal alignments of one hit the nearest to
its diagonal counts, so that notices that repeat are found each.

Lines that name a license by its short name (SPDX-License-Identifier) have no text to
align: they are read as they are, with coverage 1 and the words of the line.

Texts are not shuffled, and the templates are fixed and small, so the index goes
to the tasks as it is. All occurrences are reported; a text that holds a template
whole has all of its fingerprints, so none is missed.

Defined results: a null or empty text matches nothing; words are letters and
digits without regard to case, so marks and line breaks between them do not
matter; rows that repeat are scanned each; an empty table gives no rows.
"""

from __future__ import annotations

import re
from bisect import bisect_left
from collections.abc import Iterable, Iterator
from dataclasses import dataclass
from functools import cache

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm.common import table

GRAM, WINDOW = 3, 4
COVERAGE = 0.8
#: Words that an alignment may stray from its diagonal, at least, and by template length.
BAND, BAND_SHARE = 6, 0.1
#: Cost of a word without a partner, against 1 for a pair.
GAP = 0.25

#: Texts of notices as their licenses give them, by SPDX name where there is one.
TEMPLATES = {
    "MIT": """Permission is hereby granted, free of charge, to any person obtaining a copy of this software and
        associated documentation files (the "Software"), to deal in the Software without restriction, including without
        limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the
        Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions:
        The above copyright notice and this permission notice shall be included in all copies or substantial portions of
        the Software.""",
    "MIT (notice)": "Released under the MIT License.",
    "MIT (licensed)": "Licensed under the MIT License.",
    "Apache-2.0": """Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in
        compliance with the License. You may obtain a copy of the License at
        http://www.apache.org/licenses/LICENSE-2.0 Unless required by applicable law or agreed to in writing, software
        distributed under the License is distributed on an "AS IS" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND,
        either express or implied.""",
    "Apache-2.0 (notice)": "Licensed under the Apache License, Version 2.0.",
    "BSD-3-Clause": """Redistribution and use in source and binary forms, with or without modification, are permitted
        provided that the following conditions are met: Redistributions of source code must retain the above copyright
        notice, this list of conditions and the following disclaimer. Redistributions in binary form must reproduce the
        above copyright notice, this list of conditions and the following disclaimer in the documentation and/or other
        materials provided with the distribution. Neither the name of the copyright holder nor the names of its
        contributors may be used to endorse or promote products derived from this software without specific prior
        written permission.""",
    "BSD-2-Clause": """Redistribution and use in source and binary forms, with or without modification, are permitted
        provided that the following conditions are met: Redistributions of source code must retain the above copyright
        notice, this list of conditions and the following disclaimer. Redistributions in binary form must reproduce the
        above copyright notice, this list of conditions and the following disclaimer in the documentation and/or other
        materials provided with the distribution.""",
    "ISC": """Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is
        hereby granted, provided that the above copyright notice and this permission notice appear in all copies.""",
    "GPL-3.0-or-later": """This program is free software: you can redistribute it and/or modify it under the terms of the
        GNU General Public License as published by the Free Software Foundation, either version 3 of the License, or (at
        your option) any later version. This program is distributed in the hope that it will be useful, but WITHOUT ANY
        WARRANTY; without even the implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE.""",
    "GPL-2.0-or-later": """This program is free software; you can redistribute it and/or modify it under the terms of the
        GNU General Public License as published by the Free Software Foundation; either version 2 of the License, or (at
        your option) any later version.""",
    "GPL-2.0-only": """This program is free software; you can redistribute it and/or modify it under the terms of the GNU
        General Public License version 2 as published by the Free Software Foundation.""",
    "AGPL-3.0-or-later": """This program is free software: you can redistribute it and/or modify it under the terms of the
        GNU Affero General Public License as published by the Free Software Foundation, either version 3 of the License,
        or (at your option) any later version. This program is distributed in the hope that it will be useful, but
        WITHOUT ANY WARRANTY; without even the implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE.""",
    "LGPL-3.0-or-later": """This program is free software: you can redistribute it and/or modify it under the terms of the
        GNU Lesser General Public License as published by the Free Software Foundation, either version 3 of the License,
        or (at your option) any later version. This program is distributed in the hope that it will be useful, but
        WITHOUT ANY WARRANTY; without even the implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE.""",
    "LGPL-2.1-or-later": """This library is free software; you can redistribute it and/or modify it under the terms of the
        GNU Lesser General Public License as published by the Free Software Foundation; either version 2.1 of the
        License, or (at your option) any later version.""",
    "EPL-2.0": """This program and the accompanying materials are made available under the terms of the Eclipse Public
        License 2.0 which is available at https://www.eclipse.org/legal/epl-2.0/""",
    "EPL-1.0": """All rights reserved. This program and the accompanying materials are made available under the terms of
        the Eclipse Public License v1.0 which accompanies this distribution, and is available at
        http://www.eclipse.org/legal/epl-v10.html""",
    "Artistic-2.0": "This is free software, licensed under: The Artistic License 2.0 (GPL Compatible)",
    "BSL-1.0": """Distributed under the Boost Software License, Version 1.0. (See accompanying file LICENSE_1_0.txt or copy
        at https://www.boost.org/LICENSE_1_0.txt)""",
    "GPL-3.0 (notice)": "This work is licensed under the GNU General Public License, version 3.",
    "GPL-2.0 (notice)": "This work is licensed under the GNU General Public License, version 2.",
    "LGPL-3.0 (notice)": "This work is licensed under the GNU Lesser General Public License, version 3.",
    "AGPL-3.0 (notice)": "This work is licensed under the GNU Affero General Public License, version 3.",
    "MPL-2.0": """This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the
        MPL was not distributed with this file, You can obtain one at https://mozilla.org/MPL/2.0/.""",
    "Unlicense": """This is free and unencumbered software released into the public domain. Anyone is free to copy,
        modify, publish, use, compile, sell, or distribute this software, either in source code form or as a compiled
        binary, for any purpose, commercial or non-commercial, and by any means.""",
    "Zlib": """This software is provided 'as-is', without any express or implied warranty. In no event will the authors
        be held liable for any damages arising from the use of this software.""",
    "CC-BY-4.0": "Licensed under CC BY 4.0.",
    "CC-BY-SA-4.0": "Licensed under CC BY-SA 4.0.",
    "CC-BY-NC-4.0": "Licensed under CC BY-NC 4.0.",
    "CC-BY-ND-4.0": "Licensed under CC BY-ND 4.0.",
    "CC-BY-NC-SA-4.0": "Licensed under CC BY-NC-SA 4.0.",
    "CC-BY-NC-ND-4.0": "Licensed under CC BY-NC-ND 4.0.",
    "CC-BY-4.0 (long)": "This work is licensed under a Creative Commons Attribution 4.0 International License.",
    "CC-BY-SA-4.0 (long)": "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License.",
    "CC-BY-NC-4.0 (long)": """This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International
        License.""",
    "CC-BY-ND-4.0 (long)": """This work is licensed under a Creative Commons Attribution-NoDerivatives 4.0 International
        License.""",
    "CC-BY-NC-SA-4.0 (long)": """This work is licensed under a Creative Commons Attribution-NonCommercial-ShareAlike 4.0
        International License.""",
    "CC-BY-NC-ND-4.0 (long)": """This work is licensed under a Creative Commons Attribution-NonCommercial-NoDerivatives 4.0
        International License.""",
    "CC0-1.0 (notice)": "To the extent possible under law, the author has waived all copyright and related rights to this work.",
    "all rights reserved": "All rights reserved.",
}

_word = re.compile(r"\w+")
# Fixed value: a line that names its license, or several, by their short names.
_tag = re.compile(
    r"SPDX-License-Identifier:[ \t]*(\(?[A-Za-z0-9.+-]+(?:\)?[ \t]+(?:OR|AND|WITH)[ \t]+\(?[A-Za-z0-9.+-]+)*\)?)"
)


@dataclass(frozen=True)
class Match:
    license: str
    start: int  # words of the text, end exclusive
    end: int
    matched: int
    coverage: float
    score: float

    def holds(self, place: int) -> bool:
        """Whether a run of GRAM words lies inside."""
        return self.start <= place and place + GRAM <= self.end


def align(template: list, words: list, at: int, band: int) -> tuple[float, int, int, int]:
    """Score, matched words, start and end in `words` of the best alignment of a whole template.

    `at` is where the template's first word would stand; word n of the template
    may meet words at + n - band to at + n + band.
    """
    low = at - band
    nothing = (float("-inf"), 0, 0, 0)
    width = 2 * band + 1
    # the cell (score, matched, start, end) of diagonal d after a row: start is -1 as long as nothing matched
    row = [(0.0, 0, -1, -1)] * width
    for n, wanted in enumerate(template):
        new = []
        for d in range(width):
            w = low + n + d
            score, matched, start, end = row[d]
            if 0 <= w < len(words) and words[w] == wanted:
                paired = (score + 1, matched + 1, w if start < 0 else start, w + 1)
            else:  # neither has a partner
                paired = (score - (2 * GAP if start >= 0 else GAP), matched, start, end)
            score, matched, start, end = row[d + 1] if d + 1 < width else nothing
            missing = (score - GAP, matched, start, end)  # the template's word is missing
            best = max(paired, missing)
            if new:  # a word of the text too many
                score, matched, start, end = new[-1]
                best = max(best, (score - (GAP if start >= 0 else 0.0), matched, start, end))
            new.append(best)
        row = new
    nearest = max(range(width), key=lambda d: (*row[d][:2], -abs(d - band), *row[d][2:]))
    return row[nearest]


class Templates:
    def __init__(self, texts: dict[str, str]):
        self.names = sorted(texts)
        self.words = [_word.findall(texts[name].lower()) for name in self.names]
        self.number = {w: n for n, w in enumerate(sorted({w for words in self.words for w in words}))}
        self.index: dict[int, list[tuple[int, int]]] = {}
        for t, words in enumerate(self.words):
            numbers = [self.number[w] for w in words]
            size = min(GRAM, len(numbers))
            grams = [self.gram(numbers[i : i + size]) for i in range(len(numbers) - size + 1)]
            for place in self.winnowed(grams):
                self.index.setdefault(grams[place], []).append((t, place))
        self.known = np.array(sorted(self.index), dtype=np.int64)

    def gram(self, numbers) -> int:
        """A run of words as one number."""
        value = 0
        for n in numbers:
            value = value * (len(self.number) + 1) + int(n) + 1
        return value

    @staticmethod
    def winnowed(grams: list[int]) -> list[int]:
        """Places of the fingerprints: the least hash of every WINDOW neighbours, the last of equals."""
        hashes = [xxhash.xxh64_intdigest(g.to_bytes(8, "little")) for g in grams]
        starts = range(max(1, len(grams) - WINDOW + 1))
        return sorted({min(range(s, min(s + WINDOW, len(grams))), key=lambda i: (hashes[i], -i)) for s in starts})

    def hits(self, words: list[str]) -> dict[tuple[int, int], list[int]]:
        """By template and place of its first word in the text the places of the runs that hit it."""
        number, base = self.number.get, len(self.number) + 1
        numbers = np.array([number(w, -1) for w in words], dtype=np.int64) + 1
        if len(numbers) < GRAM:
            return {}
        runs, known = numbers[: len(numbers) - GRAM + 1].copy(), numbers[: len(numbers) - GRAM + 1] > 0
        for k in range(1, GRAM):
            part = numbers[k : len(numbers) - GRAM + 1 + k]
            runs, known = runs * base + part, known & (part > 0)
        places = np.nonzero(known)[0]
        places = places[np.isin(runs[places], self.known)]
        found: dict[tuple[int, int], list[int]] = {}
        for place, run in zip(places.tolist(), runs[places].tolist()):
            for t, within in self.index[run]:
                found.setdefault((t, place - within), []).append(place)
        return found

    @staticmethod
    def _free(place: int, starts: list[int], taken: dict[int, Match], n_words: int) -> tuple[int, int] | None:
        """The words around a run of words up to the matches beside it; None if one has words of the run."""
        n = bisect_left(starts, place + GRAM)
        low = taken[starts[n - 1]].end if n else 0
        return (low, starts[n] if n < len(starts) else n_words) if low <= place else None

    def _aligned(self, t: int, at: int, words: list[str], low: int, high: int) -> Match:
        """The best alignment of a template with its first word near `at`, among the words from low to high."""
        template = self.words[t]
        band = max(BAND, int(BAND_SHARE * len(template)))
        low = max(low, at - band)
        score, matched, start, end = align(template, words[low : min(high, at + len(template) + band)], at - low, band)
        return Match(self.names[t], start + low, end + low, matched, matched / len(template), score)

    def matches(self, text: str | None, least: float = COVERAGE) -> list[tuple[Match, int, int]]:
        """Matches in page order, each with its span in code points."""
        words = _word.findall((text or "").lower())
        hits = self.hits(words)
        if not hits:
            return []
        starts: list[int] = []  # of the matches that stand, sorted
        taken: dict[int, Match] = {}  # by start
        while hits:
            found: dict[tuple[int, int], Match] = {}
            whole: dict[int, Match] = {}  # by template: the last match word by word
            for t, at in sorted(hits):
                places = [x for x in hits[t, at] if t not in whole or not whole[t].holds(x)]
                stretch = next((f for f in (self._free(x, starts, taken, len(words)) for x in places) if f), None)
                if stretch is None:
                    continue  # its words are taken
                m = self._aligned(t, at, words, *stretch)
                if m.coverage >= least:
                    found[t, at] = m
                    if m.matched == m.end - m.start == len(self.words[t]):
                        whole[t] = m
            for m in sorted(set(found.values()), key=lambda m: (-m.score, -m.matched, m.license, m.start)):
                n = bisect_left(starts, m.start)
                if (n == 0 or taken[starts[n - 1]].end <= m.start) and (n == len(starts) or m.end <= starts[n]):
                    starts.insert(n, m.start)
                    taken[m.start] = m
            # left are hits whose match does not stand, or is another occurrence than theirs
            hits = {
                hit: hits[hit]
                for hit, m in found.items()
                if taken.get(m.start) != m or not any(m.holds(x) for x in hits[hit])
            }
        # code points of the words, in the text as it was: lower-casing may change its length
        spans = [m.span() for m in _word.finditer(text)]
        if len(spans) != len(words):
            spans = _spans_of_lowered(text)
        return [(taken[n], spans[n][0], spans[taken[n].end - 1][1]) for n in starts]


def _spans_of_lowered(text: str) -> list[tuple[int, int]]:
    """Spans in the text of the words of its lower-cased form."""
    origin = [n for n, c in enumerate(text) for _ in c.lower()]
    lowered = "".join(c.lower() for c in text)
    return [(origin[m.start()], origin[m.end() - 1] + 1) for m in _word.finditer(lowered)]


def tags(text: str | None) -> list[tuple[str, int, int, int]]:
    """License, words, start and end of each line that names its license."""
    return [(m[1], len(_word.findall(m[0])), *m.span()) for m in _tag.finditer(text or "")]


@cache
def built_in() -> Templates:
    return Templates(TEMPLATES)


def licenses(docs: DataFrame, templates: dict[str, str] | None = None, least: float = COVERAGE) -> DataFrame:
    """A row for each match: doc_id, license, coverage, matched_words, span_start, span_end."""
    index = Templates(templates) if templates else built_in()
    fields = [
        ("doc_id", pa.int64()),
        ("license", pa.string()),
        ("coverage", pa.float64()),
        ("matched_words", pa.int64()),
        ("span_start", pa.int64()),
        ("span_end", pa.int64()),
    ]

    def each(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = batch.column("doc_id")
            rows = []
            for doc_id, text in zip(ids.to_pylist(), batch.column("text")):
                text = text.as_py()
                found = [(m.license, m.coverage, m.matched, start, end) for m, start, end in index.matches(text, least)]
                found += [(license, 1.0, n, start, end) for license, n, start, end in tags(text)]
                rows += [(doc_id, *each) for each in found]
            columns = list(zip(*rows)) or [[]] * len(fields)
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, t) for c, (_, t) in zip(columns, fields)], names=[name for name, _ in fields]
            )

    rows = docs.select(F.col("doc_id").cast("long"), "text")
    schema = "doc_id long, license string, coverage double, matched_words long, span_start long, span_end long"
    return rows.mapInArrow(each, schema)


def op9_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every license notice in every document."""
    return licenses(table(spark, sf_dir, "documents"))
