"""Evenly spread edits, up to the threshold, in rare and in frequent words."""

import random

import pytest

from tidemark.llm.decontamination import benchmark_passages


def third_replaced(words):
    return [w if i % 3 != 2 else f"other{i}" for i, w in enumerate(words)]


def third_dropped(words):
    return [w for i, w in enumerate(words) if i % 3 != 2]


def word_between(words):
    return [x for i, w in enumerate(words) for x in (w, f"other{i}")][:-1]


@pytest.mark.parametrize("vocabulary", [3000, 60])
def test_evenly_edited_items_are_found(spark, vocabulary):
    rng = random.Random(23)
    terms = [f"term{i}" for i in range(vocabulary)]
    items = [[rng.choice(terms) for _ in range(rng.randrange(4, 60))] for _ in range(24)]
    docs, wanted = [], set()
    for edit in (third_replaced, third_dropped, word_between):
        for i, item in enumerate(items):
            words = [f"filler{rng.randrange(40)}" for _ in range(200)]
            words[90:90] = edit(item)
            wanted.add((len(docs), i))
            docs.append((len(docs), " ".join(words)))
    docs += [(1000 + i, " ".join(rng.choice(terms) for _ in range(4000))) for i in range(10)]
    found = benchmark_passages(
        spark.createDataFrame(docs, "doc_id long, text string"),
        spark.createDataFrame([(i, " ".join(x)) for i, x in enumerate(items)], "item_id long, text string"),
    ).collect()
    got = {(r.doc_id, r.item_id) for r in found}
    assert wanted <= got
    if vocabulary == 3000:
        assert got == wanted and len(found) == len(wanted)
    assert all(r.score >= 0.5 for r in found)


@pytest.mark.parametrize("between", [0, 1, 4, 40])
def test_passages_side_by_side_are_told_one_by_one(spark, between):
    rng = random.Random(between)
    items = [(i, " ".join(f"q{i}x{rng.randrange(90)}" for _ in range(24))) for i in range(4)]
    docs, wanted = [], set()
    for i, text in items:
        words = [f"w{rng.randrange(4000)}" for _ in range(30)]
        for n in range(3):
            wanted.add((i, i, len(words), len(words) + 24))
            words += text.split() + [f"w{rng.randrange(4000)}" for _ in range(between)]
        docs.append((i, " ".join(words)))
    found = benchmark_passages(
        spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string")
    ).collect()
    assert {(r.doc_id, r.item_id, r.start_word, r.end_word) for r in found} == wanted and len(found) == len(wanted)
    assert all(r.score == 1.0 for r in found)
