"""Jaccard join, collocations and ranked search against brute force, and their edges."""

import math
import random
import re
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from tidemark.llm import lexical_search
from tidemark.llm.collocations import collocations
from tidemark.llm.jaccard_join import jaccard_groups
from tidemark.llm.lexical_search import ranked_search
from tidemark.llm.near_dedup import near_duplicates

DOCUMENTS = (
    "doc_id long, text string, lang string, n long, token long, cls long, bag binary, m int, print long, "
    "phrase string, score double, item int, rank int, label string, own long"
)
EXTRA = (1, 2, 3, b"x", 4, 5, "p", 0.5, 6, 7, "l", 8)


def documents(spark, rows):
    return spark.createDataFrame([(i, t, lang, *EXTRA) for i, t, lang in rows], DOCUMENTS)


def shingle_set(text, k):
    words = re.findall(r"[^\x20\x09-\x0D]+", text.lower())
    return frozenset(tuple(words[i : i + k]) for i in range(max(len(words) - k + 1, 1))) if words else frozenset()


def components_of(texts, k, percent):
    """The least id reachable, by comparing all pairs."""
    sets = {i: shingle_set(t, k) for i, t in texts.items()}
    least = {i: i for i in sets}

    def root(i):
        while least[i] != i:
            i = least[i]
        return i

    ids = sorted(sets)
    for a in ids:
        for b in ids[ids.index(a) + 1 :]:
            common = len(sets[a] & sets[b])
            if common and 100 * common >= percent * (len(sets[a]) + len(sets[b]) - common):
                x, y = sorted((root(a), root(b)))
                least[y] = x
    return {i: (len(sets[i]), root(i)) for i in sets}


def edited(rng, words, edits):
    words = list(words)
    for _ in range(edits):
        at = rng.randrange(len(words))
        kind = rng.random()
        if kind < 0.5:
            words[at] = f"new{rng.randrange(40)}"
        elif kind < 0.75:
            del words[at]
        else:
            words.insert(at, rng.choice(words))
    return " ".join(words)


def corpus(seed, edits, copies=60):
    """Edited copies of two templates, chains of copies of copies, and a common passage."""
    rng = random.Random(seed)
    vocabulary = [f"w{i}" for i in range(400)]
    texts = []
    for _ in range(2):
        template = rng.choices(vocabulary, k=120)
        texts += [edited(rng, template, rng.randrange(edits)) for _ in range(copies)]
    chain = rng.choices(vocabulary, k=90)
    for _ in range(25):
        texts.append(" ".join(chain))
        chain = edited(rng, chain, 2).split()
    passage = " ".join(rng.choices(vocabulary, k=60))
    texts += [f"{passage} {' '.join(rng.choices(vocabulary, k=rng.randrange(5, 80)))}" for _ in range(40)]
    texts += texts[:20] + ["", "one", "one", "One two", "one TWO"]
    rng.shuffle(texts)
    return dict(enumerate(texts))


@pytest.mark.parametrize(
    "join, k, percent, edits",
    [(jaccard_groups, 3, 90, 4), (jaccard_groups, 2, 70, 12), (near_duplicates, 4, 80, 12), (near_duplicates, 4, 80, 4)],
)
def test_links_by_brute_force(spark, join, k, percent, edits):
    texts = corpus(7 * edits, edits)
    rows = join(documents(spark, [(i, t, "en") for i, t in texts.items()]), k=k, percent=percent).collect()
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in rows} == components_of(texts, k, percent)


def test_one_template_is_not_compared_pair_by_pair(spark):
    """Copies of one template, most of them not similar enough to each other: few pairs are compared."""
    from tidemark.llm import jaccard_join

    rng = random.Random(5)
    template = [f"t{i}" for i in range(100)]

    def copy():
        words = list(template)
        for at in rng.sample(range(0, 100, 4), rng.randrange(3, 8)):
            words[at] = f"own{rng.random()}"
        return " ".join(words)

    texts = {i: copy() for i in range(300)}
    seen = []
    inner = jaccard_join._compare

    def counted(pairs, sets):
        seen.append(pairs.count())
        return inner(pairs, sets)

    jaccard_join._compare = counted
    try:
        rows = jaccard_groups(documents(spark, [(i, t, "en") for i, t in texts.items()]), percent=80).collect()
    finally:
        jaccard_join._compare = inner
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in rows} == components_of(texts, 3, 80)
    assert sum(seen) < 300 * 299 / 2 / 15


EDGES = [
    (1, "one two three four", "en"),
    (1, "something else entirely with words", "en"),
    (2, "something else entirely with words", "en"),
    (3, None, None),
    (4, " \n\t ", "en"),
    (None, "one two three four", "en"),
    (None, "one two three four", "en"),
    (5, "ONE two\tthree four", None),
    (6, " ".join(f"v{i % 7919}" for i in range(120_000)), "de"),
    (7, " ".join(f"v{i % 7919}" for i in range(120_000)), "de"),
    (8, "x" * 1_000_000, "en"),
    (9, " " * 1_000_000, "en"),
]


@pytest.mark.parametrize("rows", [EDGES, EDGES[3:4], []], ids=["edges", "nulls", "empty"])
def test_jaccard_edges(spark, rows):
    found = jaccard_groups(documents(spark, rows)).collect()
    assert len(found) == len(rows)
    got = {r.doc_id: r.component_id for r in found if r.doc_id is not None}
    if rows is EDGES:
        # document 1 has two texts, and links the copies of both
        assert got == {1: 1, 2: 1, 3: 3, 4: 4, 5: 1, 6: 6, 7: 6, 8: 8, 9: 9}
    assert all(r.component_id is None for r in found if r.doc_id is None)


def counted_phrases(rows, least, subsumed, top):
    total, counts = Counter(), defaultdict(Counter)
    for _, text, lang in rows:
        lang = "und" if lang is None else lang
        lower = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
        for piece in re.split("[.,;:!?\x0a-\x0d]", lower):
            words = re.findall("[^\x20\x09]+", piece)
            total[lang] += len(words)
            for n in range(1, 5):
                counts[lang].update(tuple(words[i : i + n]) for i in range(len(words) - n + 1))
    out = []
    for lang, f in counts.items():
        candidates = {p: a for p, a in f.items() if len(p) > 1 and a >= least}
        inside = defaultdict(int)
        for p, a in candidates.items():
            for n in range(2, len(p)):
                for i in range(len(p) - n + 1):
                    inside[p[i : i + n]] = max(inside[p[i : i + n]], a)
        scored = []
        for p, a in candidates.items():
            if 100 * inside[p] >= subsumed * a:
                continue
            score, k = min((2_000_000 * a // (f[p[:k]] + f[p[k:]]), k) for k in range(1, len(p)))
            scored.append((-score, -a, " ".join(p).encode(), f[p[:k]], f[p[k:]]))
        for rank, (score, a, phrase, left, right) in enumerate(sorted(scored)[:top], 1):
            out.append((lang, rank, phrase.decode(), -a, left, right, total[lang], -score))
    return out


@pytest.mark.parametrize("seed", [1, 2])
def test_collocations_by_brute_force(spark, seed):
    rng = random.Random(seed)
    words = ["a", "b", "C", "d", "É", "ff", "g g", "h"]
    marks = [" ", " ", " ", "  ", "\t", ". ", ",", "\n", "\x0b", " ! ", " ;"]
    rows = [
        (i, "".join(rng.choice(words) + rng.choice(marks) for _ in range(rng.randrange(60))), rng.choice(["en", None, "und", ""]))
        for i in range(120)
    ]
    rows += [rows[0]] * 20 + [(None, None, "en"), (3, "", None)]
    found = collocations(documents(spark, rows), least=6, top=50).collect()
    wanted = counted_phrases(rows, 6, 80, 50)
    assert len(wanted) > 100
    assert sorted(tuple(r) for r in found) == sorted(wanted)


def test_collocations_of_edges(spark):
    assert collocations(documents(spark, [])).count() == 0
    assert collocations(documents(spark, EDGES[3:4])).count() == 0
    rows = [(1, "new york " * 200_000, "en"), (2, "x" * 1_000_000, "en"), (3, " " * 1_000_000, None)]
    found = {r.phrase: (r.a, r.l, r.r, r.n) for r in collocations(documents(spark, rows)).collect()}
    n = 400_001
    # every phrase but the longest lies in a longer one
    assert found == {
        "new york new york": (199_999, 200_000, 200_000, n), "york new york new": (199_998, 200_000, 199_999, n),
    }


TERM = re.compile("[^\x00-\x2f\x3a-\x40\x5b-\x60\x7b-\x7f]+")


def ranked(rows, items, top):
    def terms(text):
        return [re.sub("[A-Z]", lambda m: m[0].lower(), t) for t in TERM.findall(text or "")]

    docs = [(i, Counter(terms(t))) for i, t, _ in rows]
    sizes = [sum(tf.values()) for _, tf in docs]
    n_docs, total = sum(n > 0 for n in sizes), sum(sizes)
    df = Counter(t for _, tf in docs for t in tf)
    out = []
    for item_id, text in items:
        scores = []
        for (doc_id, tf), n in zip(docs, sizes):
            m = 10 + 90 * n * n_docs // max(total, 1)
            score = sum(
                math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1))) * (10**9 * tf[t] // (1000 * tf[t] + 8 * m))
                for t in set(terms(text)) if t in tf
            )
            if score > 0:
                scores.append((-score, doc_id is None, doc_id or 0, doc_id))
        out += [(item_id, r, x[3], -x[0]) for r, x in enumerate(sorted(scores)[:top], 1)]
    return out


def results(found):
    return sorted(tuple(r) for r in found.collect())


@pytest.mark.parametrize("block_words", [lexical_search.BLOCK_WORDS, 20])
def test_search_by_brute_force(spark, block_words):
    rng = random.Random(3)
    vocabulary = ["Alpha", "beta", "GAMMA", "été", "x1", "delta", "zeta", "común", "naïve", "q"]
    rows = [
        (i, rng.choice([" ", ", ", "-", "_"]).join(rng.choices(vocabulary, k=rng.randrange(9))), None) for i in range(300)
    ]
    # one class of many members, ids not in order
    rows += [(1000 - i, "alpha Beta, alpha", "en") for i in range(60)]
    items = [(i, " ".join(rng.sample(vocabulary, 3) + ["nowhere"])) for i in range(12)]
    items += [(3, "alpha beta"), (50, None), (51, "..."), (52, "nothing matches")]
    found = ranked_search(
        documents(spark, rows), spark.createDataFrame(items, "item_id long, text string"), block_words=block_words
    )
    assert results(found) == sorted(ranked(rows, items, 10))


def test_search_of_edges(spark):
    items = spark.createDataFrame([(1, "one words"), (2, "v5 v7918"), (3, None)], "item_id long, text string")
    rows = [r for r in EDGES if r[0] is not None]
    found = ranked_search(documents(spark, rows), items)
    assert results(found) == sorted(ranked(rows, [(1, "one words"), (2, "v5 v7918")], 10))
    nulls = documents(spark, EDGES).where(F.col("doc_id").isNull() | (F.col("doc_id") < 3))
    last = [r.doc_id for r in ranked_search(nulls, items.where("item_id = 1")).orderBy("rank").collect()]
    assert last == [1, 2, 1, None, None] or last == [1, None, None, 1, 2]
    empty = spark.createDataFrame([], "item_id long, text string")
    assert ranked_search(documents(spark, EDGES), empty).count() == 0
    assert ranked_search(documents(spark, []), items).count() == 0
