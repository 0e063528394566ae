"""Licence scans: texts, their lines and windows of them against licence templates, by Dice.

Text is normalised to lower-case words of letters and digits. Of two bags of word bigrams,
the Dice coefficient is twice the common ones over the sum of both sizes; at a threshold t
only sizes between t / (2 - t) and (2 - t) / t of each other can reach it.

A match holds so many bigrams of its template that one of the template's rarest is among
them. Templates whose rare bigrams a batch lacks aren't compared; of the others only the
places are that hold enough of their bigrams close together. Neither loses a match.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from functools import partial
from math import ceil, floor
from pathlib import Path

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm.decontamination import Lookup
from tidemark.llm.words import Words, slices, texts_of

# Short notices by which texts state their licence.
NOTICES = {
    "Apache-2.0": [
        "Licensed under the Apache License, Version 2.0",
        "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in "
        "compliance with the License.",
        "Released under the Apache License 2.0.",
    ],
    "BSD-3-Clause": [
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided "
        "that the following conditions are met:",
        "Licensed under the BSD 3-Clause License.",
    ],
    "BSD-2-Clause": [
        "Licensed under the BSD 2-Clause License.",
    ],
    "ISC": [
        "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is "
        "hereby granted, provided that the above copyright notice and this permission notice appear in all copies.",
        "Licensed under the ISC License.",
        "Released under the ISC License.",
    ],
    "Unlicense": [
        "This is free and unencumbered software released into the public domain.",
        "Released under the Unlicense.",
        "Licensed under the Unlicense.",
    ],
    "CC-BY-4.0": [
        "This work is licensed under a Creative Commons Attribution 4.0 International License.",
        "Licensed under CC BY 4.0.",
    ],
    "CC-BY-NC-4.0": [
        "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License.",
        "Licensed under CC BY-NC 4.0.",
    ],
    "CC-BY-SA-4.0": [
        "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License.",
        "Licensed under CC BY-SA 4.0.",
    ],
    "CC0-1.0": ["This work is dedicated to the public domain under CC0 1.0 Universal."],
    "MIT": [
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and "
        "associated documentation files (the \"Software\"), to deal in the Software without restriction",
        "Released under the MIT License.",
        "Licensed under the MIT License.",
    ],
    "MPL-2.0": [
        "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0.",
    ],
    "all-rights-reserved": ["All rights reserved."],
}

# Wordings that most families share.
_STATED = [
    "This work is licensed under the {}.",
    "This program is licensed under the {}.",
    "This software is licensed under the {}.",
    "This project is licensed under the {}.",
    "This library is licensed under the {}.",
    "Licensed under the {}.",
    "Released under the {}.",
    "Distributed under the terms of the {}.",
]
_TITLES = {
    "Apache-2.0": ["Apache License, Version 2.0"],
    "BSD-2-Clause": ["BSD 2-Clause License"],
    "BSD-3-Clause": ["BSD 3-Clause License"],
    "ISC": ["ISC License"],
    "MIT": ["MIT License"],
    "MPL-2.0": ["Mozilla Public License, version 2.0"],
}
_GNU = {
    "GPL": ("General", "program", ["2.0", "3.0"]),
    "LGPL": ("Lesser General", "library", ["2.1", "3.0"]),
    "AGPL": ("Affero General", "program", ["3.0"]),
}
_HEADER = (
    "This {what} is free software: you can redistribute it and/or modify it under the terms of the {title} as "
    "published by the Free Software Foundation, either version {number} of the License, or (at your option) any "
    "later version."
)
_ONLY = (
    "This {what} is free software; you can redistribute it and/or modify it under the terms of the {title} as "
    "published by the Free Software Foundation; version {number} of the License."
)
for _family, (_kind, _what, _versions) in _GNU.items():
    for _version in _versions:
        _number, _title = _version.removesuffix(".0"), f"GNU {_kind} Public License"
        _TITLES[f"{_family}-{_version}"] = [
            *(f"{_title}{x}" for x in (f", version {_number}", f" v{_version}", f" v{_number}")),
            f"{_title}, version {_number} or later",
        ]
        NOTICES[f"{_family}-{_version}"] = [
            *(x.format(what=_what, title=_title, number=_number) for x in (_HEADER, _ONLY)),
            f"Licensed under {_family}-{_version}.",
            f"Licensed under {_family}-{_version}-or-later.",
            f"Licensed under the GNU {_family} v{_number}.",
            f"Released under the GNU {_family}, version {_number}.",
        ]
for _name, _titles in _TITLES.items():
    _more = [x.format(title) for title in _titles for x in _STATED]
    NOTICES[_name] = list(dict.fromkeys([*NOTICES.get(_name, []), *_more]))

# Whole texts of the licences. The short ones differ by their paragraphs.
_AS_IS = (
    'THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS "AS IS" AND ANY EXPRESS OR IMPLIED '
    "WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A "
    "PARTICULAR PURPOSE ARE DISCLAIMED. IN NO EVENT SHALL THE COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE FOR ANY "
    "DIRECT, INDIRECT, INCIDENTAL, SPECIAL, EXEMPLARY, OR CONSEQUENTIAL DAMAGES (INCLUDING, BUT NOT LIMITED TO, "
    "PROCUREMENT OF SUBSTITUTE GOODS OR SERVICES; LOSS OF USE, DATA, OR PROFITS; OR BUSINESS INTERRUPTION) HOWEVER "
    "CAUSED AND ON ANY THEORY OF LIABILITY, WHETHER IN CONTRACT, STRICT LIABILITY, OR TORT (INCLUDING NEGLIGENCE OR "
    "OTHERWISE) ARISING IN ANY WAY OUT OF THE USE OF THIS SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE."
)
_BSD_2 = (
    "Redistribution and use in source and binary forms, with or without modification, are permitted provided that "
    "the following conditions are met: 1. Redistributions of source code must retain the above copyright notice, "
    "this list of conditions and the following disclaimer. 2. Redistributions in binary form must reproduce the "
    "above copyright notice, this list of conditions and the following disclaimer in the documentation and/or "
    "other materials provided with the distribution. "
)
_BSD_3 = (
    "3. Neither the name of the copyright holder nor the names of its contributors may be used to endorse or "
    "promote products derived from this software without specific prior written permission. "
)
NOTICES["BSD-2-Clause"].append(_BSD_2 + _AS_IS)
NOTICES["BSD-3-Clause"].append(_BSD_2 + _BSD_3 + _AS_IS)
NOTICES["ISC"].append(
    NOTICES["ISC"][0] + ' THE SOFTWARE IS PROVIDED "AS IS" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO '
    "THIS SOFTWARE INCLUDING ALL IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE "
    "LIABLE FOR ANY SPECIAL, DIRECT, INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM "
    "LOSS OF USE, DATA OR PROFITS, WHETHER IN AN ACTION OF CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING "
    "OUT OF OR IN CONNECTION WITH THE USE OR PERFORMANCE OF THIS SOFTWARE."
)
NOTICES["MIT"].append(
    NOTICES["MIT"][0] + ", including without limitation the rights to use, copy, modify, merge, publish, distribute, "
    "sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do "
    "so, subject to the following conditions: The above copyright notice and this permission notice shall be "
    'included in all copies or substantial portions of the Software. THE SOFTWARE IS PROVIDED "AS IS", WITHOUT '
    "WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, "
    "FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE "
    "LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING "
    "FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE."
)
# Longer ones are files beside this one, named by their licence.
for _file in sorted(Path(__file__).with_name("licences").glob("*.txt")):
    NOTICES[_file.name.removesuffix(".txt")].append(_file.read_text())

#: Templates that are looked up together.
BLOCK = 100

_APART = np.ones(256, bool)
_APART[[*range(0x30, 0x3A), *range(0x41, 0x5B), *range(0x61, 0x7B)]] = False


def templates(spark: SparkSession, notices: dict[str, list[str]] = NOTICES) -> DataFrame:
    rows = [(name, text) for name, texts in notices.items() for text in texts]
    return spark.createDataFrame(rows, "license string, template string")


def plain_words(texts: pa.Array) -> Words:
    """Lower-case words of letters and digits; two more letters become ASCII in lower case."""
    for letter, lower in (("\u0130", "i\u0307"), ("\u212a", "k")):
        texts = pc.replace_substring(texts, letter, lower)
    return Words.of(texts, lower=True, apart=_APART)


def telling(names: list[str], texts: list[str]) -> np.ndarray:
    """The bigrams that stand in templates of one licence only."""
    words = plain_words(texts_of(pa.array(texts, pa.string())))
    pairs, whole = words.runs(words.hashes(), 2), words.full_runs(2)
    licences = np.unique(names, return_inverse=True)[1][words.text_of_words()]
    held = np.unique(np.stack([pairs[whole], licences[whole].astype(np.uint64)]), axis=1)[0]
    bigrams, times = np.unique(held, return_counts=True)
    return bigrams[times == 1]


class Templates:
    """A block of templates: how often each holds the bigrams of all."""

    def __init__(self, names: list[str], texts: list[str], least: float, apart: np.ndarray | None = None):
        words = plain_words(texts_of(pa.array(texts, pa.string())))
        hashes, bounds = words.hashes(), words.first
        pairs = words.runs(hashes, 2)
        self.least = least
        #: Templates of one word, which is their only mark.
        self.single = [(n, hashes[a]) for n, a, b in zip(names, bounds, bounds[1:]) if b - a == 1]
        bags = [(n, Counter(pairs[a : b - 1].tolist())) for n, a, b in zip(names, bounds, bounds[1:]) if b - a > 1]
        self.names = [name for name, _ in bags]
        self.lookup = Lookup(np.array([p for _, bag in bags for p in bag], np.uint64))
        self.counts = np.zeros((len(bags), len(self.lookup.numbers)), np.uint16)
        for row, (_, bag) in zip(self.counts, bags):
            row[np.searchsorted(self.lookup.numbers, np.array(list(bag), np.uint64))] = list(bag.values())
        self.sizes = self.counts.sum(1, dtype=np.int64)
        #: The bigrams that tell a licence apart, see :func:`telling`.
        self.telling = np.isin(self.lookup.numbers, telling(names, texts) if apart is None else apart)
        #: Of each template the rarest bigrams, one of which every match holds.
        self.anchors = np.zeros(self.counts.shape, bool)
        common = self.counts.sum(0, dtype=np.int64)
        for row, counts, size in zip(self.anchors, self.counts, self.sizes):
            held = np.flatnonzero(counts)
            held = held[np.argsort(common[held], kind="stable")]
            without = size - ceil(least * size / (2 - least) - 1e-9)
            row[held[: int(np.searchsorted(np.cumsum(counts[held]), without, "right")) + 1]] = True

    def unit_scores(self, t: int, at: np.ndarray, pair: np.ndarray, begin: np.ndarray, end: np.ndarray):
        """``(unit, dice)`` of the units, ranges of words in order, that match the template."""
        size = self.sizes[t]
        if not len(begin):
            return ()
        unit = np.searchsorted(begin, at, "right") - 1
        sizes = end - begin - 1
        fits = (sizes >= size * self.least / (2 - self.least)) & (sizes <= size * (2 - self.least) / self.least)
        inside = (unit >= 0) & (at + 1 < end[unit]) & fits[unit]
        unit, pair = unit[inside], pair[inside]
        seen, times = np.unique(unit * len(self.lookup.numbers) + pair, return_counts=True)
        unit, pair = np.divmod(seen, len(self.lookup.numbers))
        both = np.bincount(unit, np.minimum(times, self.counts[t][pair]), len(begin))
        dice = 2.0 * both / (size + sizes)
        match = np.flatnonzero(fits & (dice >= self.least))
        return zip(match, dice[match])

    def window_scores(self, t: int, at: np.ndarray, pair: np.ndarray, text: np.ndarray, long: np.ndarray):
        """Per text ``(text, dice, word)`` of the best window, with the first word of the
        template's bigrams in it. One shorter than the template must hold a telling bigram.
        ``long`` tells whether a match's text has more words than the template has bigrams."""
        size, counts, least = int(self.sizes[t]), self.counts[t].astype(np.int64), self.least
        need, most = ceil(least * size / (2 - least) - 1e-9), floor(size * (2 - least) / least + 1e-9)
        n = len(at)
        if n < need:
            return
        close = (at[need - 1 :] - at[: n - need + 1] < most) & (text[need - 1 :] == text[: n - need + 1])
        starts = np.flatnonzero(close)
        if not len(starts):
            return
        # a bigram counts in a window unless as many equal ones as the template has stand before it there
        order = np.argsort(pair, kind="stable")
        back = np.arange(n) - counts[pair[order]]
        held = (back >= 0) & (pair[order][np.maximum(back, 0)] == pair[order])
        full = np.empty(n, np.int64)
        full[order] = np.where(held, order[np.maximum(back, 0)], -1)
        nth, best, word, doc = 0, 0.0, 0, text[starts[0]]
        while nth < len(starts):
            first = starts[nth]
            if text[first] != doc:
                if best >= least:
                    yield doc, best, word
                best, doc = 0.0, text[first]
            stop = np.searchsorted(at, at[first] + 2 * most)
            stop = min(stop, np.searchsorted(text, doc, "right"))
            both = np.cumsum(full[first:stop] < first)
            length = at[first:stop] - at[first] + 1
            dice = 2.0 * both / (size + length)
            top = float(dice.max())
            # without a telling bigram the window is as long as the template, if its text is
            told = np.logical_or.accumulate(self.telling[pair[first:stop]])
            longer = 2.0 * both / (size + np.maximum(length, size)) * (long[first] | (length >= size))
            if (here := float(np.where(told, dice, longer).max())) > best:
                best, word = here, int(at[first])
            if best >= 1.0:
                nth = np.searchsorted(text[starts], doc, "right")
                continue
            # d words on, no window of ``need`` bigrams is better than the top times 1 + d / (size + need)
            step = min((max(best, least) / top - 1) * (size + need) - 1e-6, most)
            nth = max(nth + 1, int(np.searchsorted(at[starts], at[first] + step)))
        if best >= least:
            yield doc, best, word


def _scan(batches: Iterator[pa.RecordBatch], blocks: list[Templates]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        texts = texts_of(batch.column(1))
        rows = []
        for begin, end in slices(texts):
            rows += [(begin + i, *row) for i, *row in _matches(texts[begin:end], blocks)]
        if rows:
            at, license_, unit, dice = zip(*rows)
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0).take(pa.array(at, pa.int64())),
                    pa.array(license_, pa.string()),
                    pa.array(unit, pa.int64()),
                    pa.array(dice, pa.float64()),
                ],
                ["doc_id", "license", "unit", "dice"],
            )


def _matches(texts: pa.Array, blocks: list[Templates]) -> Iterator[tuple[int, str, int, float]]:
    """``(text, license, unit, dice)`` of all matches of units, and of the best windows."""
    words = plain_words(texts)
    if not len(words.starts):
        return
    hashes, text = words.hashes(), words.text_of_words()
    pairs, whole = words.runs(hashes, 2), words.full_runs(2)
    # words are counted in the bytes of the lower-cased text, which ``words`` holds
    breaks = np.flatnonzero(words.data[:-8] == 0x0A)
    line = np.searchsorted(breaks, words.starts)
    before = np.searchsorted(breaks, words.offsets)
    several = np.diff(before) > 0
    number = line - before[text] + 1
    heads = np.ones(len(text), bool)
    heads[1:] = (line[1:] != line[:-1]) | (text[1:] != text[:-1])
    begin = np.flatnonzero(heads)
    end = np.append(begin[1:], len(text))
    keep = several[text[begin]]
    some = np.flatnonzero(words.counts())
    units = [
        (words.first[some], words.first[some + 1], np.zeros(len(some), np.int64)),
        (begin[keep], end[keep], number[begin[keep]]),
    ]
    for held in blocks:
        for name, mark in held.single:
            for begin, end, called in units:
                for u in np.flatnonzero((end - begin == 1) & (hashes[begin] == mark)):
                    yield int(text[begin[u]]), name, int(called[u]), 1.0
        if not held.names:
            continue
        at, pair = held.lookup.find(pairs)
        at, pair = at[whole[at]], pair[whole[at]]
        for t in np.flatnonzero(held.anchors[:, np.unique(pair)].any(1)):
            mine = held.counts[t][pair] > 0
            here, what = at[mine], pair[mine]
            for begin, end, called in units:
                for u, dice in held.unit_scores(t, here, what, begin, end):
                    yield int(text[begin[u]]), held.names[t], int(called[u]), float(dice)
            for i, dice, word in held.window_scores(t, here, what, text[here], words.counts()[text[here]] > held.sizes[t]):
                yield int(i), held.names[t], -int(number[word]), dice


def scan_licenses(docs: DataFrame, templates: DataFrame, least: float = 0.8, block: int = BLOCK) -> DataFrame:
    """``(doc_id, license, unit, dice)``: per document and licence, the best unit's score.

    ``docs`` needs ``doc_id`` and ``text``, ``templates`` ``license`` and ``template``. The
    units of a document are its lines, numbered from 1, the whole text, 0, and all windows
    of words of it, whatever its line breaks, of every size that can reach ``least``. A
    window shorter than the template counts only with a bigram that no other licence's
    templates hold, as the words that all notices share name no licence. A window is told
    by minus the number of the line in which the notice begins. Of equal scores lines and whole texts go before windows, then the least
    number is told. Bigrams are counted as often as they stand. Only scores of ``least`` or
    more are matches. Notices that differ in few words, such as versions of one licence,
    match together; the best score tells which one it is.

    Null and empty texts match nothing, and so do templates without words; templates of
    one word have no windows. Rows with a null or repeated doc_id are told together, with
    the best of their scores.
    """
    rows = templates.where("license IS NOT NULL AND template IS NOT NULL").select("license", "template")
    held = sorted(tuple(r) for r in rows.distinct().collect())
    apart = telling(*map(list, zip(*held))) if held else None
    blocks = [Templates(*map(list, zip(*held[i : i + block])), least, apart) for i in range(0, len(held), block)]
    kind = docs.schema["doc_id"].dataType.simpleString()
    scores = (
        docs.where("text IS NOT NULL")
        .select("doc_id", "text")
        .mapInArrow(partial(_scan, blocks=blocks), f"doc_id {kind}, license string, unit long, dice double")
    )
    best = F.max(F.struct("dice", F.col("unit") >= 0, -F.abs("unit"), "unit")).alias("best")
    return scores.groupBy("doc_id", "license").agg(best).select(
        "doc_id", "license", F.col("best.unit").alias("unit"), F.col("best.dice").alias("dice")
    )
