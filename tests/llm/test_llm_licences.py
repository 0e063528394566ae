"""Licence wordings, wrapped and inline notices, and windows against brute force."""

import random
import textwrap
from collections import Counter

import pyarrow as pa
import pytest

from tidemark.llm.license_scan import NOTICES, Templates, _matches, scan_licenses, telling, templates
from tidemark.llm.words import texts_of

WORDINGS = {
    "This work is licensed under the GNU General Public License, version 3.": "GPL-3.0",
    "This program is licensed under the GNU General Public License, version 2.": "GPL-2.0",
    "This library is licensed under the GNU Lesser General Public License, version 2.1": "LGPL-2.1",
    "This work is licensed under the GNU Lesser General Public License, version 3.": "LGPL-3.0",
    "This program is licensed under the GNU Affero General Public License, version 3.": "AGPL-3.0",
    "Licensed under the BSD 2-Clause License.": "BSD-2-Clause",
    "Licensed under the ISC License": "ISC",
    "This is free and unencumbered software released into the public domain.": "Unlicense",
    "This project is licensed under the MIT License.": "MIT",
    "This software is licensed under the Apache License, Version 2.0": "Apache-2.0",
}
HEADERS = {
    "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in compliance "
    "with the License.": "Apache-2.0",
    "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated "
    "documentation files (the \"Software\"), to deal in the Software without restriction": "MIT",
    "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the "
    "following conditions are met:": "BSD-3-Clause",
    "This program is free software; you can redistribute it and/or modify it under the terms of the GNU General Public "
    "License as published by the Free Software Foundation; either version 2 of the License, or (at your option) any "
    "later version.": "GPL-2.0",
}


def prose(rng, n):
    return " ".join(f"word{rng.randrange(500)}" for _ in range(n))


def test_wordings_wrapped_and_inline(spark):
    rng, docs, wanted = random.Random(7), [], []
    for text, name in {**WORDINGS, **HEADERS}.items():
        wrapped = "\n".join(" * " + x for x in textwrap.wrap(text, 30))
        for shape in (f"{prose(rng, 90)}\n{text}\n{prose(rng, 80)}", f"{prose(rng, 90)}\n{wrapped}\n{prose(rng, 80)}",
                      f"{prose(rng, 90)} {text} {prose(rng, 80)}"):
            docs.append((len(docs), shape))
            wanted.append(name)
    clean = len(docs)
    docs += [(clean + i, f"{prose(rng, 150)} this work is licensed under the other thing {prose(rng, 9)}") for i in range(5)]
    best = {}
    for r in scan_licenses(spark.createDataFrame(docs, "doc_id long, text string"), templates(spark)).collect():
        best[r.doc_id] = max(best.get(r.doc_id, (0.0, "")), (r.dice, r.license))
        assert r.unit in (0, 2, -1, -2)
    assert {i: name for i, (_, name) in best.items()} == dict(enumerate(wanted))
    assert all(dice == 1.0 for dice, _ in best.values())


@pytest.mark.parametrize("seed", range(4))
def test_units_and_windows_by_brute_force(seed):
    rng, least = random.Random(seed), 0.8

    def bag(words):
        return Counter(zip(words, words[1:])) if len(words) > 1 else Counter([tuple(words)] if words else [])

    def dice(a, b):
        return 2.0 * sum((a & b).values()) / max(sum(a.values()) + sum(b.values()), 1)

    held = [(f"L{i}", [rng.choice("abcdef") for _ in range(rng.choice([1, 2, 3, 6, 12, 25]))]) for i in range(12)]
    texts = []
    for _ in range(60):
        words = [rng.choice("abcdefgh") for _ in range(rng.randrange(40))]
        for _ in range(rng.randrange(3)):
            copy = list(rng.choice(held)[1])
            for _ in range(rng.randrange(1 + len(copy) // 6)):
                copy.insert(rng.randrange(len(copy)), "z")
            at = rng.randrange(len(words) + 1)
            words[at:at] = copy
        texts.append("".join(w + rng.choice([" ", " ", ", ", "\n"]) for w in words))
    everywhere = Counter(p for _, t in held for p in bag(t))
    telling_pairs = {p for p in everywhere if sum(p in bag(t) for _, t in held) == 1}
    wanted = {}
    for i, text in enumerate(texts):
        words = text.replace(",", " ").split()
        lines = text.split("\n")
        units = [text, *lines] if len(lines) > 1 else [text]
        for name, template in held:
            for u in units:
                score = dice(bag(u.replace(",", " ").split()), bag(template))
                wanted[i, name] = max(wanted.get((i, name), 0.0), score)
            size = len(template) - 1
            for s in range(1, int(size * 1.5 + 1e-9) + 1) if size else ():
                for a in range(len(words) - s):
                    window = bag(words[a : a + s + 1])
                    if s >= size or any(p in telling_pairs for p in window & bag(template)):
                        wanted[i, name] = max(wanted[i, name], dice(window, bag(template)))
    got = {}
    parts = [[*map(list, zip(*((n, " ".join(t)) for n, t in half)))] for half in (held, held[:5], held[5:])]
    apart = telling(*parts[0])
    blocks = [Templates(*half, least, apart) for half in parts[1:]]
    for i, name, _, score in _matches(texts_of(pa.array(texts)), blocks):
        got[i, name] = max(got.get((i, name), 0.0), score)
    assert got == {k: v for k, v in wanted.items() if v >= least} and got


@pytest.mark.parametrize("share", [0.72, 0.8, 0.9])
def test_beginnings_of_a_notice_inline(spark, share):
    """What scores as a line of its own does so inside a line; words that all notices share don't."""
    rng, words = random.Random(3), NOTICES["MIT"][0].split()
    part = " ".join(words[: round(share * len(words))])
    shared = "this work is licensed under the"
    docs = [(0, f"{prose(rng, 60)}\n{part}\n{prose(rng, 60)}"), (1, f"{prose(rng, 60)} {part} {prose(rng, 60)}"),
            (2, f"{prose(rng, 60)} {shared} {prose(rng, 60)}")]
    found = {(r.doc_id, r.license): r.dice for r in
             scan_licenses(spark.createDataFrame(docs, "doc_id long, text string"), templates(spark)).collect()}
    size, own = len(words) - 1, len(part.split()) - 1
    assert found[0, "MIT"] == found[1, "MIT"] == 2 * own / (own + size)
    assert not any(doc_id == 2 for doc_id, _ in found)
