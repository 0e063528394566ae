"""Nulls, empty and long texts, repeated rows, empty tables and clashing columns."""

import pytest

import corpus_pipeline
from tidemark.llm.chat_format import format_chats
from tidemark.llm.decontamination import benchmark_passages
from tidemark.llm.license_scan import scan_licenses, templates
from tidemark.llm.near_dedup import near_duplicates
from tidemark.llm.packing import pack
from tidemark.llm.quality_classifier import score_quality
from tidemark.llm.quality_rules import quality_rules
from tidemark.llm.substring_dedup import remove_repeats
from tidemark.llm.toxicity import score_toxicity
from tidemark.llm.url_filters import judge_urls

#: The operators' own columns stand beside the table's, under names that clash.
DOCUMENTS = (
    "doc_id long, text string, lang string, source string, n_chars long, "
    "row string, rep long, band long, label int, owner long, check int, kept boolean, n_words long, id long"
)
EXTRA = ("x", 1, 2, 3, 4, 5, True, 6, 7)
LONG = " ".join(f"word{i % 9973}" for i in range(150_000))
ROWS = [
    (1, "one two three four five six seven", "en"),
    (1, "one two three four five six seven", "en"),
    (2, None, "en"),
    (3, "", None),
    (4, " \n\t ", "de"),
    (5, LONG, "en"),
    (6, LONG, None),
    (None, "nothing names this document but it has words", "fr"),
    (None, None, None),
    (7, "ein", "de"),
]


def documents(spark, rows=ROWS):
    return spark.createDataFrame([(i, t, lang, "s", len(t or ""), *EXTRA) for i, t, lang in rows], DOCUMENTS)


def labels(spark, rows=((1, 1, 0), (7, 0, 1), (2, None, None), (None, 1, 1), (1, 1, 0))):
    return spark.createDataFrame(list(rows), "doc_id long, quality int, toxic int")


PER_ROW = {
    "toxicity": lambda spark, docs: score_toxicity(docs, labels(spark)),
    "near": lambda spark, docs: near_duplicates(docs),
    "substring": lambda spark, docs: remove_repeats(docs),
    "quality_rules": lambda spark, docs: quality_rules(docs),
    "classifier": lambda spark, docs: score_quality(docs, labels(spark), least_steps=200),
}


@pytest.mark.parametrize("name", PER_ROW)
@pytest.mark.parametrize("rows", [ROWS, ROWS[8:9], []], ids=["edges", "nulls", "empty"])
def test_one_row_per_document(spark, name, rows):
    assert PER_ROW[name](spark, documents(spark, rows)).count() == len(rows)


@pytest.mark.parametrize("name", ["toxicity", "classifier"])
def test_scores_lie_between_0_and_1(spark, name):
    found = PER_ROW[name](spark, documents(spark)).collect()
    assert all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.5) for r in found)


@pytest.mark.parametrize("scorer", [score_toxicity, score_quality])
def test_no_labels(spark, scorer):
    found = scorer(documents(spark), labels(spark, [])).collect()
    assert len(found) == len(ROWS) and all(0 <= r.score <= 1 for r in found)


def test_near_duplicates_of_edges(spark):
    found = near_duplicates(documents(spark)).collect()
    got = {r.doc_id: (r.component_id, r.kept) for r in found if r.doc_id is not None}
    assert got == {1: (1, True), 2: (2, True), 3: (3, True), 4: (4, True), 5: (5, True), 6: (5, False), 7: (7, True)}
    assert all(r.component_id is None and r.kept for r in found if r.doc_id is None)


def test_substring_dedup_of_edges(spark):
    found = {(r.row.doc_id, r.n_words, r.n_removed) for r in remove_repeats(documents(spark)).collect()}
    assert {(5, 150_000, 150_000), (6, 150_000, 150_000), (3, 0, 0), (2, 0, 0), (7, 1, 0)} <= found


def test_packing_of_edges(spark):
    pieces = pack(documents(spark)).collect()
    assert sum(1 for r in pieces if r.piece == 0) == len(ROWS)
    assert [r.length for r in pieces if r.doc_id in (2, 3)] == [1, 1]
    assert pack(documents(spark, [])).count() == 0


def test_decontamination_of_edges(spark):
    schema = "item_id long, text string, doc_id long"
    items = spark.createDataFrame([(1, None, 1), (None, "", 2), (2, ROWS[0][1], 3), (2, ROWS[0][1], 3)], schema)
    found = benchmark_passages(documents(spark), items).collect()
    assert sorted((r.doc_id, r.item_id, r.score) for r in found) == [(1, 2, 1.0)] * 4
    assert benchmark_passages(documents(spark), items.limit(0)).count() == 0
    assert benchmark_passages(documents(spark, []), items).count() == 0


def test_licences_of_edges(spark):
    rows = [(1, "Released under the MIT License."), (1, "x\nReleased under the MIT License."), (None, "All rights reserved.")]
    docs = documents(spark, [*ROWS, *((i, t, None) for i, t in rows)])
    found = {(r.doc_id, r.license, r.unit, r.dice) for r in scan_licenses(docs, templates(spark)).collect()}
    assert found == {(1, "MIT", 0, 1.0), (None, "all-rights-reserved", 0, 1.0)}
    assert scan_licenses(docs, templates(spark).limit(0)).count() == 0
    assert scan_licenses(documents(spark, []), templates(spark)).count() == 0


def test_urls_of_edges(spark):
    rules = spark.createDataFrame([("block", "a.com", "/x"), ("allow", "a.com", "/x"), ("block", None, "/")],
                                  "verdict string, host string, path string")
    urls = ["http://A.com/x?q", "http://b.a.com/x#f", None, "a.com/x", "http://", "http://a.com/x", "http://ca.com/x"]
    pages = spark.createDataFrame([(i, u, "v", "h") for i, u in enumerate(urls)], "page_id long, url string, verdict string, host string")
    got = {r.page_id: (r.host, r.path, r.rule, r.verdict) for r in judge_urls(pages, rules).collect()}
    hit = ("/x", "a.com/x", "block")
    assert got == {
        0: ("a.com", *hit), 1: ("b.a.com", *hit), 2: ("", "", None, "allow"), 3: ("", "", None, "allow"),
        4: ("", "", None, "allow"), 5: ("a.com", *hit), 6: ("ca.com", "/x", None, "allow"),
    }
    assert judge_urls(pages, rules.limit(0)).count() == len(urls)
    assert judge_urls(pages.limit(0), rules).count() == 0


def test_chats_of_edges(spark):
    schema = "conv_id long, turn long, role string, text string, key string, state int"
    rows = [(1, 0, "user", "a", "k", 0), (1, 0, "user", "a", "k", 0), (1, None, None, None, "k", 0),
            (None, 1, "robot", "b", "k", 0), (None, None, None, None, "k", 0)]
    found = format_chats(spark.createDataFrame(rows, schema)).collect()
    assert len(found) == 4
    assert format_chats(spark.createDataFrame([], schema)).count() == 0


def test_chats_with_crowded_numbers(spark):
    """Unnumbered turns, and many of one number, go in short stretches and in the same order."""
    from tidemark.llm import chat_format

    def row(i):
        return (1, None if i < 3000 else 7 if i < 6000 else i % 20, ("user", "assistant", "Bot", None)[i % 4], f"t{i}")

    turns = spark.createDataFrame([row(i) for i in range(6500)], "conv_id long, turn long, role string, text string")
    longest = (
        chat_format._with_stretches(
            turns.selectExpr(
                "'c' key", "coalesce(floor(turn / 16), -1) block", "struct(conv_id, turn, role AS given_role) row",
                "lower(role) name", "text", "xxhash64(text) print",
            ), 100,
        ).groupBy("stretch").count().agg({"count": "max"}).first()[0]
    )
    assert longest <= 100
    whole, cut = (format_chats(turns, stretch).collect() for stretch in (100_000, 100))

    def told(rows):
        return sorted((r.turn if r.turn is not None else -1, str(r.given_role), r.role, r.merged, str(r.inserted_role), r.rendered) for r in rows)

    assert len(whole) == 6500 and whole[0].conversation_cost == cut[0].conversation_cost
    assert sum(r.rendered.count("<|end|>") for r in whole) == sum(r.rendered.count("<|end|>") for r in cut)
    assert [x[:2] for x in told(whole)] == [x[:2] for x in told(cut)]


def test_every_stage_keeps_edges_alive(spark):
    """Stages run on rows with nulls and on no rows at all, and return the columns of documents."""
    folder = "/root/testdata/sf0.001"
    for docs in (documents(spark), documents(spark, [])):
        for _, stage in corpus_pipeline.STAGES[:-1]:
            assert stage(spark, docs, folder).columns == docs.columns
            stage(spark, docs, folder).count()
    stays = corpus_pipeline.near_dedup(spark, documents(spark), folder).select("doc_id", "text").collect()
    assert sorted(r.doc_id for r in stays if r.doc_id is not None) == [1, 2, 3, 4, 5, 7]
    assert sum(r.doc_id is None for r in stays) == 2
