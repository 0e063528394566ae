"""The operators against SQL, brute force, exact round trips and held-out rows."""

import itertools
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pandas as pd
import pytest
import public_tokenizers
from tokenizers import Tokenizer

import __spark_entry__ as contract
import corpus_pipeline
from check import connect, differences
from tidemark.llm.answers import ANSWERS
from tidemark.llm.chat_format import INSERT, MERGE, RELABEL, ROLES, UNKNOWN, format_chats
from tidemark.llm.decontamination import benchmark_passages, local_alignment
from tidemark.llm.near_dedup import near_duplicates
from tidemark.llm.packing import BestFit
from tidemark.llm.queries import QUERIES

SMALL, MIDDLE = "/root/testdata/sf0.001", "/root/testdata/sf0.01"
WORD = re.compile(rb"[^\x20\x09-\x0D]+")


def table(folder, name):
    return pd.read_parquet(f"{folder}/{name}.parquet")


@pytest.mark.parametrize("name", sorted(ANSWERS))
def test_answer(spark, name):
    assert differences(QUERIES[name](spark, SMALL), connect(SMALL), ANSWERS[name]) == ""


def test_registered():
    assert len(QUERIES) == 13 and "pipeline" in contract.queries()
    assert [name for name, _ in corpus_pipeline.STAGES][0] == "quality_rules"


def test_licences_by_brute_force(spark):
    from tidemark.llm.license_scan import NOTICES

    def bag(text):
        words = [w for w in re.split("[^a-z0-9]+", text.lower()) if w]
        pairs = list(zip(words, words[1:])) or [tuple(words)]
        return Counter(pairs) if words else Counter()

    held = [(name, bag(t)) for name, texts in NOTICES.items() for t in texts]
    docs = table(SMALL, "documents")
    wanted = {}
    for doc_id, text in zip(docs.doc_id, docs.text):
        lines = text.split("\n")
        for unit, part in enumerate([text, *lines] if len(lines) > 1 else [text]):
            own = bag(part)
            for name, template in held:
                dice = 2.0 * sum((own & template).values()) / max(sum(own.values()) + sum(template.values()), 1)
                if dice >= 0.8:
                    before = wanted.get((doc_id, name), (0.0, 0))
                    wanted[doc_id, name] = max(before, (dice, -unit)) if before[0] else (dice, -unit)
    got = {(r.doc_id, r.license): (r.dice, -r.unit) for r in QUERIES["op1_license_scan"](spark, SMALL).collect()}
    assert got == wanted and wanted


@pytest.mark.parametrize("name, label", [("op2_toxicity", "toxic"), ("op9_quality_classifier", "quality")])
def test_held_out_rows(spark, name, label):
    folds, rest = {"toxic": (5, 0), "quality": (3, 1)}[label]
    found = QUERIES[name](spark, "/root/testdata/sf0.1").toPandas()
    assert (found.held_out == found.doc_id.map(lambda i: zlib.crc32(str(i).encode()) % folds == rest)).all()
    known = found.merge(table("/root/testdata/sf0.1", "labels"), on="doc_id").query("held_out")
    wrong = (known.predicted != known[label]).mean()
    assert wrong < 0.02
    hit = known[known[label] == 1].predicted.mean()
    assert hit > 0.85


def _shingles(text, k):
    words = WORD.findall((text or "").encode().lower())
    if not words:
        return set()
    return {tuple(words[i : i + k]) for i in range(max(1, len(words) - k + 1))}


def test_near_duplicates_by_brute_force(spark):
    """Chains, copies in bulk and sets just at and just below the bound."""
    rng = random.Random(3)
    texts = []
    for _ in range(12):
        words = [f"w{rng.randrange(5000)}" for _ in range(rng.randrange(3, 120))]
        for _ in range(8):
            texts.append(" ".join(words))
            words = list(words)
            words[rng.randrange(len(words))] = f"w{rng.randrange(5000)}"
    texts += [texts[0]] * 30 + [None, "", "A b", "a  B", "a b c d e"]
    rng.shuffle(texts)
    sets = [_shingles(t, 4) for t in texts]
    parent = list(range(len(texts)))

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for a, b in itertools.combinations(range(len(texts)), 2):
        common = len(sets[a] & sets[b])
        if common and 100 * common >= 80 * len(sets[a] | sets[b]):
            x, y = sorted((root(a), root(b)))
            parent[y] = x
    wanted = {i: (len(sets[i]), root(i), root(i) == i) for i in range(len(texts))}
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {r.doc_id: (r.n_shingles, r.component_id, r.kept) for r in near_duplicates(docs, k=4).collect()}
    assert got == wanted


def test_alignment_by_brute_force():
    rng = np.random.default_rng(5)
    for _ in range(60):
        a, b = (rng.integers(0, 4, rng.integers(1, 14)).astype(np.uint64) for _ in range(2))
        table_ = np.zeros((len(a) + 1, len(b) + 1), int)
        for i, j in itertools.product(range(len(a)), range(len(b))):
            same = 2 if a[i] == b[j] else -1
            table_[i + 1, j + 1] = max(0, table_[i, j] + same, table_[i, j + 1] - 1, table_[i + 1, j] - 1)
        assert local_alignment(a, b)[0] == table_.max()


def test_edited_items_are_found_and_clean_documents_left_alone(spark):
    rng = random.Random(11)
    vocabulary = [f"term{i}" for i in range(3000)]
    items = [[rng.choice(vocabulary) for _ in range(30)] for _ in range(20)]
    docs = []
    for i in range(200):
        words = [rng.choice(vocabulary) for _ in range(300)]
        if i < 20:
            edited = list(items[i])
            for at in (7, 15, 23):
                edited[at] = "edited"
            del edited[11]
            words[100:100] = [w.capitalize() + "," for w in edited]
        docs.append((i, " ".join(words)))
    found = benchmark_passages(
        spark.createDataFrame(docs, "doc_id long, text string"),
        spark.createDataFrame([(i, " ".join(x)) for i, x in enumerate(items)], "item_id long, text string"),
    ).collect()
    assert sorted((r.doc_id, r.item_id) for r in found) == [(i, i) for i in range(20)]
    assert all(r.start_word == 100 and r.end_word == 129 for r in found)


def test_base_counts_by_hand(spark):
    docs = table(SMALL, "documents")
    wanted = {}
    for doc_id, text in zip(docs.doc_id, docs.text):
        words = re.findall("[^\x20\x09-\x0D]+", text)
        windows = [tuple(words[i : i + 3]) for i in range(len(words) - 2)]
        times, covered = Counter(windows), set()
        for i, w in enumerate(windows):
            if times[w] > 1:
                covered |= {i, i + 1, i + 2}
        lines = [x for x in text.split("\n") if re.search("[^\x20\x09-\x0D]", x)]
        failed = len(words) < 50 or 100 * len(covered) > 50 * len(words)
        wanted[doc_id] = (len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)),
                          len(lines) - len(set(lines)), len(covered), failed)
    rows = QUERIES["op6_quality_rules"](spark, SMALL).collect()
    got = {r.doc_id: (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words, r.base_failed) for r in rows}
    assert got == wanted
    assert not any(r.kept and r.base_failed for r in rows)


def _cheapest(roles):
    """Least cost over every relabelling, merge and insertion."""
    legal = {None: ("system", "user"), "system": ("user",), "user": ("assistant",), "assistant": ("user",)}
    best = {None: 0.0}
    for role in roles:
        now = {}
        for before, cost in best.items():
            for given in ROLES:
                price = 0.0 if role == given else RELABEL if role in ROLES else UNKNOWN
                ways = [0.0] if given in legal[before] else []
                ways += [MERGE] if given == before else []
                ways += [INSERT] if any(given in legal[x] for x in legal[before]) and given not in legal[before] else []
                for way in ways:
                    now[given] = min(now.get(given, np.inf), cost + price + way)
        best = now
    return min(best.values())


@pytest.mark.parametrize("stretch", [1, 3, 4096])
def test_repair_is_cheapest_and_legal(spark, stretch):
    rng = random.Random(stretch)
    conversations = {c: [rng.choice([*ROLES, "narrator", "human"]) for _ in range(rng.randrange(1, 9))] for c in range(60)}
    rows = [(c, t, role, f"t{t}") for c, roles in conversations.items() for t, role in enumerate(roles)]
    found = format_chats(spark.createDataFrame(rows, "conv_id long, turn long, role string, text string"), stretch).collect()
    whole = defaultdict(list)
    for r in sorted(found, key=lambda r: (r.conv_id, r.turn)):
        whole[r.conv_id].append(r)
    assert set(whole) == set(conversations)
    for c, turns in whole.items():
        names = ["user" if x == "human" else x for x in conversations[c]]
        assert turns[0].conversation_cost == _cheapest(names)
        text = "".join(r.rendered for r in turns)
        said = re.findall(r"<\|(\w+)\|>\n", text.replace("<|end|>\n", ""))
        assert re.fullmatch("s?(ua)*u?", "".join(x[0] for x in said))
        assert re.findall(r"t\d+", text) == [f"t{t}" for t in range(len(names))]


def test_packing_is_a_round_trip(spark):
    tokenizer = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    docs = table(SMALL, "documents")
    wanted = {}
    for doc_id, text in zip(docs.doc_id, docs.text):
        ids = [*tokenizer.encode(text, add_special_tokens=False).ids, 0]
        wanted[doc_id] = np.array(ids, "<u4")
    found = QUERIES["op10_best_fit_packing"](spark, SMALL).toPandas().sort_values(["doc_id", "piece"])
    for doc_id, pieces in found.groupby("doc_id"):
        assert pieces.piece.tolist() == list(range(len(pieces)))
        assert pieces.start.tolist() == np.cumsum([0, *pieces.length])[:-1].tolist()
        assert len(pieces) == 1 or (pieces.length[1:] == 2048).all() and pieces.length.sum() > 2048
        for start, length, crc in zip(pieces.start, pieces.length, pieces.ids_crc32):
            assert crc == zlib.crc32(wanted[doc_id][start : start + length].tobytes())
        assert pieces.length.sum() == len(wanted.pop(doc_id))
    assert not wanted
    for _, pieces in found.sort_values("offset").groupby("sequence_id"):
        assert pieces.offset.tolist() == np.cumsum([0, *pieces.length])[:-1].tolist()
        assert pieces.length.sum() <= 2048
    assert found.sequence_id.nunique() <= 1.02 * -(-found.length.sum() // 2048) + 1


def test_best_fit_takes_the_tightest_bin_and_closes_the_fullest():
    packer = BestFit(10, 2)
    assert [packer.place(n) for n in (6, 7, 3, 4)] == [(0, 0), (1, 0), (1, 7), (0, 6)]
    packer = BestFit(10, 2)
    assert [packer.place(n) for n in (6, 7, 9, 4)] == [(0, 0), (1, 0), (2, 0), (0, 6)]


def test_pipeline_stages_take_effect(spark):
    docs = spark.read.parquet(f"{MIDDLE}/documents.parquet")
    stages = dict(corpus_pipeline.STAGES)
    verdicts = QUERIES["op6_quality_rules"](spark, MIDDLE).where("kept").select("doc_id")
    kept = stages["quality_rules"](spark, docs, MIDDLE)
    assert {r[0] for r in kept.select("doc_id").collect()} == {r[0] for r in verdicts.collect()}
    leaked = {r.doc_id for r in QUERIES["op5_benchmark_decontamination"](spark, MIDDLE).collect()}
    left = {r[0] for r in stages["benchmark_decontamination"](spark, docs, MIDDLE).select("doc_id").collect()}
    assert leaked and left == {r[0] for r in docs.select("doc_id").collect()} - leaked
    single = {r.doc_id for r in near_duplicates(docs, k=5).where("kept").collect()}
    assert {r[0] for r in stages["minhash_near_dedup"](spark, docs, MIDDLE).select("doc_id").collect()} == single
    cut = {r.doc_id: r.n_removed for r in QUERIES["op4_substring_dedup"](spark, MIDDLE).collect()}
    texts = {r.doc_id: r.text for r in docs.collect()}
    for r in stages["substring_dedup"](spark, docs, MIDDLE).collect():
        assert (r.text == texts[r.doc_id]) == (cut[r.doc_id] == 0)
        assert len(WORD.findall(r.text.encode())) == len(WORD.findall(texts[r.doc_id].encode())) - cut[r.doc_id]
