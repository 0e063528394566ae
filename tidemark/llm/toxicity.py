"""Toxicity by a weighted finite-state grammar over clauses.

The *lexicon* rewrites the words of a clause to classes: insults, with weights learned
from labelled documents, and fixed lists of threat verbs, announcing words, targets,
negations and speech verbs. Five transducers then read the classes one after another.
*Negation* marks what stands in its reach, *speech* what follows a speech verb, *target*
everything in a clause that addresses or names somebody, before or after; *threat* marks
threat verbs that are announced and have a target after the announcement, on either side
of the verb; *analysis* turns the marks into one of five analyses with its own weight.
:func:`grammar` composes them into one machine, which gives each clause its heaviest
path. A document's score comes from the analyses of its clauses, by a logistic model: its
weights per analysis start from those of the grammar, and labelled documents move them as
far as they hold such clauses. A threat verb or insult outside of any analysis counts
nothing.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field
from functools import cache, partial, reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.decontamination import Lookup, bare_words
from tidemark.llm.training import fold, labelled_sample
from tidemark.llm.transducers import Transducer, compose
from tidemark.llm.words import U64, Words, slices, texts_of
from tidemark.operators.staging import stored

OTHER, INSULT, THREAT, ANNOUNCE, TARGET, NEGATION, SPEECH = range(7)
# Small closed classes of English, German, French and Spanish.
CLASSES = {
    THREAT: "kill hurt beat destroy stab shoot töten umbringen schlagen tuer tuerai frapper matar golpear pegar".split(),
    ANNOUNCE: "will gonna going shall must should werde wirst soll vais va doit voy vas debe".split(),
    TARGET: (
        "you your yours he him his she her they them their these those people du dich dir ihr euch sie er ihn "
        "tu te toi vous ton il ils elle ti usted ustedes vosotros él ella ellos"
    ).split(),
    NEGATION: "not no never isn't aren't don't nicht kein keine nie pas jamais aucun nunca jamás ni".split(),
    SPEECH: (
        "said says say called calls wrote writes quoted quote claimed told reported sagte sagt nannte schrieb dit "
        "disait appelle écrit dijo dice llamó escribió"
    ).split(),
}
#: Words a negation reaches.
REACH = 3
#: Bytes of the word beginnings that may be insults.
STEMS = (4, 5, 6)
#: Weights by which the grammar ranks the analyses of a clause.
ANALYSES = {"plain": 1.0, "targeted": 1.5, "negated": 0.25, "reported": 0.25, "threat": 2.0}
_STOPS = np.zeros(256, bool)
_STOPS[[ord(c) for c in ".!?;:\n"]] = True


def negation_machine(alphabet) -> Transducer:
    """Marks the words that a negation reaches; a state is how many it still does."""

    def step(reach, symbol):
        yield symbol | {"negated"} if reach else symbol, 0.0, REACH if NEGATION in symbol else max(0, reach - 1)

    return Transducer.of(alphabet, [0], step)


def speech_machine(alphabet) -> Transducer:
    """Marks the words after a speech verb."""

    def step(reported, symbol):
        yield symbol | {"reported"} if reported else symbol, 0.0, reported or SPEECH in symbol

    return Transducer.of(alphabet, [False], step)


def target_machine(alphabet) -> Transducer:
    """Marks all words of a clause with a target: guesses at the start whether one comes."""

    def step(state, symbol):
        if state != "none":
            yield symbol | {"targeted"}, 0.0, "seen" if TARGET in symbol else state
        elif TARGET not in symbol:
            yield symbol, 0.0, state

    return Transducer.of(alphabet, ["none", "awaited"], step, lambda state: state != "awaited")


def threat_machine(alphabet) -> Transducer:
    """Marks announced threat verbs: guesses at the announcement whether a target comes."""

    def step(state, symbol):
        if state == "idle":
            for follow in ("none", "awaited") if ANNOUNCE in symbol else ("idle",):
                yield symbol, 0.0, follow
        elif state != "none":
            yield symbol | {"announced"}, 0.0, "seen" if TARGET in symbol else state
        elif TARGET not in symbol:
            yield symbol, 0.0, state

    return Transducer.of(alphabet, ["idle"], step, lambda state: state != "awaited")


def analysis_machine(alphabet) -> Transducer:
    """Writes the analysis that the marks of a word come to, or None."""

    def step(state, symbol):
        said = next((x for x in ("reported", "negated") if x in symbol), None)
        out = None
        if INSULT in symbol:
            out = said or ("targeted" if "targeted" in symbol else "plain")
        elif THREAT in symbol and "announced" in symbol:
            out = said or "threat"
        yield out, ANALYSES.get(out, 0.0), state

    return Transducer.of(alphabet, [0], step)


MACHINES = (negation_machine, speech_machine, target_machine, threat_machine, analysis_machine)


def cascade() -> list[Transducer]:
    """The transducers, each made for what the one before it writes."""
    made, alphabet = [], [frozenset([class_]) for class_ in range(7)]
    for machine in MACHINES:
        made.append(machine(alphabet))
        alphabet = made[-1].writes()
    return made


@cache
def grammar() -> tuple[list[int], set[int], list[list[list[tuple[int, float, int]]]]]:
    """The composed machine with states and analyses as numbers: its starts, its final
    states, and per state and class the ``(analysis or -1, weight, next state)`` of its arcs."""
    whole = reduce(compose, cascade())
    number = {state: i for i, state in enumerate(whole.arcs)}
    names = list(ANALYSES)
    table = [[[] for _ in range(7)] for _ in number]
    for state, arcs in whole.arcs.items():
        for symbol, out, weight, follow in arcs:
            (class_,) = symbol
            table[number[state]][class_].append((-1 if out is None else names.index(out), weight, number[follow]))
    return [number[s] for s in whole.starts], {number[s] for s in whole.finals}, table


def read_clause(classes: list[int], weights: list[float]) -> list[tuple[int, float]]:
    """``(analysis, word weight)`` along the heaviest path of a clause through the grammar."""
    starts, finals, table = grammar()
    live = {state: (0.0, None) for state in starts}
    others = 0
    for class_, weight in zip(classes, weights):
        others = others + 1 if class_ == OTHER else 0
        if others > REACH:
            continue  # no state changes at further ones
        after: dict = {}
        for state, (total, path) in live.items():
            for analysis, more, follow in table[state][class_]:
                score = total + more * weight
                if follow not in after or score > after[follow][0]:
                    after[follow] = (score, path if analysis < 0 else (path, analysis, weight))
        live = after
    _, path = max((live[s] for s in live if s in finals), key=lambda found: found[0])
    found = []
    while path:
        path, analysis, weight = path
        found.append((analysis, weight))
    return found[::-1]


#: The model before labels move it: logarithms of the weights per analysis, then the factors
#: of the whole text and of its best clauses, and the bias.
PRIOR = np.array([*np.log(list(ANALYSES.values())), 1.5, 1.5, -3.0])


@dataclass
class Grammar:
    """The lexicon: hashes of whole insults and bytes of their stems, with weights."""

    words: np.ndarray = field(default_factory=lambda: np.zeros(0, U64))
    weights: np.ndarray = field(default_factory=lambda: np.zeros(0))
    stems: np.ndarray = field(default_factory=lambda: np.zeros(0, U64))
    stem_weights: np.ndarray = field(default_factory=lambda: np.zeros(0))
    #: as :data:`PRIOR`
    model: np.ndarray = field(default_factory=PRIOR.copy)

    def __post_init__(self) -> None:
        fixed = [bare_words(texts_of(pa.array(words))).hashes() for words in CLASSES.values()]
        self.fixed = [Lookup(x) for x in fixed]
        order = np.argsort(self.words)
        self.lexicon, self.weights = Lookup(self.words), self.weights[order]
        order = np.argsort(self.stems)
        self.beginnings, self.stem_weights = Lookup(self.stems), self.stem_weights[order]

    def classify(self, words: Words) -> tuple[np.ndarray, np.ndarray]:
        """The lexicon: class and weight of each word. Insults are learned; of the fixed
        lists only the threat verbs may be learned as insults."""
        hashes = words.hashes()
        classes, weights = np.zeros(len(hashes), np.int8), np.zeros(len(hashes))
        fixed = dict(zip(CLASSES, (lookup.find(hashes)[0] for lookup in self.fixed)))
        classes[fixed[THREAT]] = THREAT
        for n in STEMS:
            which, stems = stems_of(words, n)
            at, number = self.beginnings.find(stems)
            classes[which[at]] = INSULT
            weights[which[at]] = np.maximum(weights[which[at]], self.stem_weights[number])
        at, number = self.lexicon.find(hashes)
        classes[at] = INSULT
        weights[at] = np.maximum(weights[at], self.weights[number])
        for class_, at in fixed.items():
            if class_ != THREAT:
                classes[at] = class_
        weights[classes == THREAT] = 1.0
        return classes, weights

    def analyse(self, texts: pa.Array) -> np.ndarray:
        """Per text the weights of each analysis: summed, and of the best clause."""
        words = bare_words(texts)
        out = np.zeros((len(texts), 2 * len(ANALYSES)))
        if not len(words.starts):
            return out
        classes, weights = self.classify(words)
        # a clause ends where a stop or another text stands between two words
        stops = np.concatenate([[0], np.cumsum(_STOPS[words.data])])
        text = words.text_of_words()
        cut = (stops[words.starts[1:]] > stops[words.ends[:-1]]) | (text[1:] != text[:-1])
        clause = np.concatenate([[0], np.cumsum(cut)])
        # only clauses with an insult or a threat can have an output
        hot = np.unique(clause[(classes == INSULT) | (classes == THREAT)])
        first = np.searchsorted(clause, hot, "left")
        last = np.searchsorted(clause, hot, "right")
        n = len(ANALYSES)
        for begin, end in zip(first.tolist(), last.tolist()):
            sums = np.zeros(n)
            for analysis, weight in read_clause(classes[begin:end].tolist(), weights[begin:end].tolist()):
                sums[analysis] += weight
            row = out[text[begin]]
            row[:n] += sums
            row[n:] = np.maximum(row[n:], sums)
        return out

    def scores(self, analyses: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-_odds(analyses, self.model)[0]))


def _odds(analyses: np.ndarray, model: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Log-odds of texts, and their slopes by each number of the model.

    The weighted analyses of a text are added up, and so are those of its best clauses;
    what counts is the logarithm of either sum.
    """
    n = len(ANALYSES)
    weighted = [part * np.exp(model[:n]) for part in (analyses[:, :n], analyses[:, n:])]
    sums = [part.sum(1) for part in weighted]
    logs = [np.log1p(x) for x in sums]
    slopes = sum(f * part / (1 + x)[:, None] for f, part, x in zip(model[n:], weighted, sums))
    odds = model[n] * logs[0] + model[n + 1] * logs[1] + model[n + 2]
    return odds, np.column_stack([slopes, *logs, np.ones(len(odds))])


def stems_of(words: Words, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Words longer than ``n`` bytes, and their first ``n`` bytes as a number."""
    which = np.flatnonzero(words.ends - words.starts > n)
    eights = np.ndarray(len(words.data) - 7, "<u8", words.data, strides=(1,))
    return which, (eights[words.starts[which]] & U64((1 << (8 * n)) - 1)) | U64(n << 56)


def _count_terms(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Documents of each label that have a word, or a stem; per task. Term 0: all documents."""
    for batch in batches:
        texts, labels = texts_of(batch.column(1)), np.asarray(batch.column(2), np.int64)
        for begin, end in slices(texts):
            words = bare_words(texts[begin:end])
            of = words.text_of_words()
            terms = [(0, np.arange(end - begin), np.zeros(end - begin, U64)), (0, of, words.hashes())]
            terms += [(n, of[(x := stems_of(words, n))[0]], x[1]) for n in STEMS]
            for kind, text, term in terms:
                text, term = np.unique(np.stack([text.astype(U64), term]), axis=1)
                label = labels[begin:end][text.astype(np.int64)]
                term, at = np.unique(term, return_inverse=True)
                toxic = np.bincount(at, label, len(term)).astype(np.int64)
                every = np.bincount(at, minlength=len(term))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(len(term), kind, np.int32)), pa.array(term.view(np.int64)),
                     pa.array(toxic), pa.array(every - toxic)],
                    ["kind", "term", "toxic", "clean"],
                )


def learn_lexicon(sample: DataFrame, least_sure: float, most_terms: int) -> Grammar:
    """Words and stems that stand in toxic documents much oftener than in clean ones.

    The weight is the log-odds of the two rates; it must be ``least_sure`` times its
    standard error. A stem must also have several words' worth of documents.
    """
    counts = stored(
        sample.mapInArrow(_count_terms, "kind int, term long, toxic long, clean long")
        .groupBy("kind", "term").agg(F.sum("toxic").alias("toxic"), F.sum("clean").alias("clean")), "terms"
    )
    every = counts.where("kind = 0 AND term = 0").first()
    if every is None or not every.toxic or not every.clean:
        return Grammar()
    odds = F.log((F.col("toxic") + 0.5) / (every.toxic + 1)) - F.log((F.col("clean") + 0.5) / (every.clean + 1))
    error = F.sqrt(1 / (F.col("toxic") + 0.5) + 1 / (F.col("clean") + 0.5))
    found = (
        counts.where("term <> 0").withColumn("weight", odds).where(F.col("weight") >= least_sure * error)
        .orderBy(F.desc(F.col("weight") / error), "kind", "term").limit(most_terms).collect()
    )

    def part(stems: bool) -> tuple[np.ndarray, np.ndarray]:
        rows = [r for r in found if bool(r.kind) == stems]
        return np.array([r.term for r in rows], np.int64).view(U64), np.array([r.weight for r in rows], float)

    return Grammar(*part(False), *part(True))


def _analyse(batches: Iterator[pa.RecordBatch], grammar: Grammar) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        texts = texts_of(batch.column(1))
        for begin, end in slices(texts):
            rows = grammar.analyse(texts[begin:end])
            yield pa.RecordBatch.from_arrays(
                [batch.column(2)[begin:end], pa.array(list(rows), pa.list_(pa.float64()))], ["label", "analyses"]
            )


def fit(analyses: np.ndarray, labels: np.ndarray, pull: float = 1e-4, steps: int = 60) -> np.ndarray:
    """The model that tells the labels best, drawn towards :data:`PRIOR`; by Gauss-Newton steps.

    Analyses that the labelled rows don't hold keep the weights of the grammar.
    """

    def loss(model):
        odds = _odds(analyses, model)[0]
        return np.mean(np.logaddexp(0, odds) - labels * odds) + pull / 2 * ((model - PRIOR) ** 2).sum()

    model, held = PRIOR.copy(), loss(PRIOR)
    for _ in range(steps):
        odds, slopes = _odds(analyses, model)
        right = 1 / (1 + np.exp(-odds))
        gradient = slopes.T @ (right - labels) / len(labels) + pull * (model - PRIOR)
        curve = (slopes * (right * (1 - right))[:, None]).T @ slopes / len(labels) + pull * np.eye(len(model))
        step = np.linalg.solve(curve, gradient)
        while (new := loss(model - step)) > held and np.abs(step).max() > 1e-9:
            step /= 2
        if held - new < 1e-10:
            break
        model, held = model - step, new
    return model


def _score(batches: Iterator[pa.RecordBatch], grammar: Grammar) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        texts = texts_of(batch.column(1))
        rows = [np.zeros((0, 2 * len(ANALYSES)))]
        rows += [grammar.analyse(texts[begin:end]) for begin, end in slices(texts)]
        yield pa.RecordBatch.from_arrays(
            [batch.column(0), pa.array(grammar.scores(np.concatenate(rows)))], ["row", "score"]
        )


def score_toxicity(
    docs: DataFrame,
    labels: DataFrame,
    label: str = "toxic",
    folds: int = 5,
    held_out: int = 0,
    most: int = 20000,
    least_sure: float = 3.0,
    most_terms: int = 20000,
) -> DataFrame:
    """``(doc_id, held_out, score, predicted)``, one row per row of ``docs``.

    Learns ``label`` (0 or 1) from at most ``most`` rows of ``labels`` outside the fold
    ``held_out`` of ``folds``; ``score`` is the probability of 1, for the whole text.

    Null and empty texts have no clause and get the model's bias alone. Without labelled
    rows of both kinds the lexicon has no insults and the model is a fixed prior. Null and
    repeated ids are scored row by row.
    """
    sample = stored(labelled_sample(docs, labels, label, folds, held_out, most), "labelled")
    grammar = learn_lexicon(sample, least_sure, most_terms)
    # at most ``most`` rows of ten numbers
    rows = sample.mapInArrow(partial(_analyse, grammar=grammar), "label int, analyses array<double>").collect()
    if len({r.label for r in rows}) > 1:
        grammar.model = fit(np.array([r.analyses for r in rows]), np.array([r.label for r in rows], float))
    scored = docs.select(F.struct("doc_id", (fold(folds) == held_out).alias("held_out")).alias("row"), "text").mapInArrow(
        partial(_score, grammar=grammar), "row struct<doc_id: long, held_out: boolean>, score double"
    )
    return scored.select("row.doc_id", "row.held_out", "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))
