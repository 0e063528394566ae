"""The toxicity grammar: composition against its parts run one by one, and single clauses."""

import random
from functools import reduce

import numpy as np
import pyarrow as pa
import pytest

from tidemark.llm.toxicity import (
    ANALYSES,
    ANNOUNCE,
    INSULT,
    NEGATION,
    OTHER,
    SPEECH,
    TARGET,
    THREAT,
    Grammar,
    cascade,
    fit,
    read_clause,
)
from tidemark.llm.transducers import Transducer, compose
from tidemark.llm.words import Words, texts_of

NAMES = list(ANALYSES)


def grammar(*insults):
    hashes = Words.of(texts_of(pa.array(insults))).hashes()
    return Grammar(words=hashes, weights=np.full(len(insults), 2.0))


def found(text):
    row = grammar("moron", "clown").analyse(texts_of(pa.array([text])))[0, : len(NAMES)]
    return {NAMES[i] for i in np.flatnonzero(row)}


@pytest.mark.parametrize("text, analyses", [
    ("What a moron.", {"plain"}),
    ("You are a moron.", {"targeted"}),
    ("A moron like you.", {"targeted"}),
    ("You are not a moron.", {"negated"}),
    ("He said you are a clown.", {"reported"}),
    ("He said you are no clown.", {"reported"}),
    ("I will hurt them.", {"threat"}),
    ("Ich werde dich töten.", {"threat"}),
    ("I will not hurt you.", {"negated"}),
    ("She wrote that they will kill him.", {"reported"}),
    ("I will beat the eggs until stiff.", set()),
    ("She will beat the eggs until stiff.", set()),
    ("It may hurt. You left, a moron", {"targeted"}),
    ("You left. What a moron", {"plain"}),
    ("You are never early and always in our way, a moron", {"targeted"}),
    ("A clown, I will hurt you", {"targeted", "threat"}),
    ("Nothing here.", set()),
    ("", set()),
])
def test_clauses(text, analyses):
    assert found(text) == analyses


def one_by_one(clause):
    """Every way through the transducers, each run over the whole output of the one before."""
    ways = [(0.0, [frozenset([c]) for c in clause])]
    for machine in cascade():
        ways = [(total + weight, list(out)) for total, word in ways for weight, out in machine.paths(word)]
    return ways


@pytest.mark.parametrize("seed", range(3))
def test_composition_is_its_parts_one_by_one(seed):
    rng = random.Random(seed)
    whole = reduce(compose, cascade())
    for _ in range(150):
        clause = rng.choices(range(7), [4, 2, 2, 2, 2, 1, 1], k=rng.randrange(9))
        ways = one_by_one(clause)
        same = whole.paths([frozenset([c]) for c in clause])
        assert sorted((w, list(out)) for w, out in same) == sorted(ways) and len(ways) == 1
        told = [NAMES[a] for a, _ in read_clause(clause, [1.0] * len(clause))]
        assert told == [x for x in ways[0][1] if x]


def test_long_stretches_of_other_words_change_nothing():
    for gap in (0, 1, 2, 3, 50):
        told = read_clause([NEGATION, *[OTHER] * gap, INSULT], [0.0] * (gap + 1) + [1.0])
        assert NAMES[told[0][0]] == ("negated" if gap < 3 else "plain")
        told = read_clause([ANNOUNCE, THREAT, *[OTHER] * gap, TARGET], [1.0] * (gap + 3))
        assert [NAMES[a] for a, _ in told] == ["threat"]
        told = read_clause([SPEECH, *[OTHER] * gap, INSULT], [1.0] * (gap + 2))
        assert NAMES[told[0][0]] == "reported"


def test_composition_of_nondeterministic_machines():
    """Of two paths with the same output both stay, and dead ends go."""
    twice = Transducer.of("ab", [0], lambda s, x: [(x, 1.0, 0), (x.upper(), 2.0, 1)])
    upper = Transducer.of("abAB", [0], lambda s, x: [(x, 0.5, 0)] if x in "AB" else [], lambda s: True)
    both = compose(twice, upper)
    assert sorted(both.paths("ab")) == sorted(
        (w + 1.0, out) for w, out in twice.paths("ab") if all(x in "AB" for x in out)
    )
    assert all(out in "AB" for out in both.writes())


def test_the_grammar_tells_apart_what_isolated_words_cannot():
    """Each pair holds the same insults and threat verbs; only their clauses differ."""
    toxic = ["You are a moron.", "What clowns, you moron!", "I will hurt you.", "They are going to kill him."]
    clean = ["You are not a moron.", "He said: what he says, moron.", "I will hurt. Thank you.", "They kill going to him."]
    reader = grammar("moron", "clowns")
    scores = reader.scores(reader.analyse(texts_of(pa.array(toxic + clean))))
    assert scores[:4].min() > 0.5 > scores[4:][[0, 2, 3]].max()
    assert scores[0] > scores[4] and scores[2] > scores[6]


def test_labels_move_only_the_analyses_that_they_hold():
    rng = np.random.default_rng(3)
    rows = np.zeros((300, 2 * len(NAMES)))
    rows[:, 0] = rows[:, len(NAMES)] = rng.random(300)
    model = fit(rows, (rows[:, 0] > 0.5).astype(float))
    moved = np.exp(model[: len(NAMES)]) != np.array(list(ANALYSES.values()))
    assert moved.tolist() == [True, False, False, False, False]
    right = (Grammar(model=model).scores(rows) >= 0.5) == (rows[:, 0] > 0.5)
    assert right.mean() > 0.95
