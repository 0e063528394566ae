"""Exact set similarity join on word n-grams, skipping by set relations.

Documents of equal sets are one class. A set's tokens stand in one order for all sets, the
rarest first, and an inverted index lists each set under its prefix only: the tokens that
it can't lose all of and still be similar enough to anything. Two relations between sets
spare most of the work that is left:

* *Index skipping.* A token's list is kept as blocks of entries of equal size, position and
  relation to their hub. Blocks are held against blocks, and a pair of blocks whose sizes or
  positions leave too little room for common tokens is skipped as a whole.
* *Answer skipping.* Every set is first compared with one *hub*, a set of one of its lists
  that has fewest tokens of its own and then most tokens; this gives the number ``c`` of their common tokens. The
  answers of two sets of one hub follow from the hub's: they have at least ``c1 + c2 - hub``
  and at most ``min(c1, c2)`` tokens of the hub in common, and others only as far as both
  have tokens outside the hub that are not theirs alone. Pairs that this decides, and those
  that the links found so far connect already, are not compared.

Before the index, tokens of a quarter of all hashes tell most sets that are similar to
nothing: those with more tokens of their own than a similar set may have.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.components import components
from tidemark.llm.shingle_sets import (
    SLICE_BYTES,
    by_document,
    classes_of,
    own_tokens,
    sets_of,
    spare,
    token_sets,
    without_strangers,
)
from tidemark.llm.words import U64, signed, slices, texts_of
from tidemark.operators.staging import stored

#: One token in so many, chosen by its hash, goes into the first look for own tokens.
SAMPLED = 4
#: Rounds of comparing sets with a hub of their lists.
HUB_ROUNDS = 2


def _prints(batches: Iterator[pa.RecordBatch], k: int) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        texts = texts_of(batch.column(1))
        for begin, end in slices(texts, most_bytes=SLICE_BYTES):
            _, first, prints = token_sets(texts[begin:end], k)
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0)[begin:end],
                    pa.array(np.diff(first).astype(np.int64)),
                    pa.array(prints[:, 0]),
                    pa.array(prints[:, 1]),
                ],
                ["doc_id", "n", "high", "low"],
            )


def _sampled_tokens(batches: Iterator[pa.RecordBatch], k: int) -> Iterator[pa.RecordBatch]:
    """One token in ``SAMPLED`` of each text, with the print of its set."""
    below = U64((1 << 64) // SAMPLED - 1)
    for batch in batches:
        texts = texts_of(batch.column(0))
        for begin, end in slices(texts, most_bytes=SLICE_BYTES):
            marks, first, prints = token_sets(texts[begin:end], k)
            take = marks <= below
            high = np.repeat(prints[:, 0], np.diff(first))
            yield pa.RecordBatch.from_arrays([pa.array(high[take]), pa.array(signed(marks[take]))], ["high", "token"])


def _needed(percent: int, n: str, m: str) -> str:
    """Tokens that sets of ``n`` and ``m`` must have in common."""
    return f"(({percent} * ({n} + {m}) + {99 + percent}) div {100 + percent})"


def _enough(percent: int, n: str, m: str, common: str) -> str:
    return f"100 * {common} >= {percent} * ({n} + {m} - {common})"


def _postings(sets: DataFrame, percent: int) -> DataFrame:
    """``(token, cls, n, own, pos)``: each set under the tokens of its prefix that other sets
    have too. ``own`` tokens, that no other set has, come first in the order."""
    tokens = sets.select("cls", "n", F.explode("tokens").alias("token"))
    shared = tokens.groupBy("token").agg(F.count("*").alias("holders")).where("holders > 1")
    ordered = (
        tokens.join(shared, "token")
        .groupBy("cls", "n").agg(F.sort_array(F.collect_list(F.struct("holders", "token"))).alias("shared"))
        .withColumn("own", F.col("n") - F.size("shared"))
        .withColumn("room", (spare(percent) + 1 - F.col("own")).cast("int"))
        .where("room > 0")
    )
    return ordered.select(
        "cls", "n", "own", F.posexplode(F.slice("shared", F.lit(1), F.col("room"))).alias("place", "entry")
    ).select("entry.token", "cls", "n", "own", (F.col("own") + F.col("place")).alias("pos"))


def _labelled(postings: DataFrame, links: DataFrame | None) -> DataFrame:
    """Entries with the component of their set so far, in lists that hold two or more."""
    entries = postings.withColumn("label", F.col("cls"))
    if links is not None:
        reached = components(links).select(F.col("node").alias("cls"), "component")
        entries = (
            postings.join(reached, "cls", "left").withColumn("label", F.coalesce("component", "cls")).drop("component")
        )
    entries = stored(entries, "entries")
    mixed = entries.groupBy("token").agg(F.min("label").alias("a"), F.max("label").alias("b")).where("a < b")
    return entries.join(stored(mixed.select("token"), "lists"), "token")


def _compare(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """Pairs ``(u, v)`` of sets with their sizes and ``common``, the tokens they share."""
    first = sets.select(F.col("cls").alias("u"), F.col("n").alias("n_u"), F.col("tokens").alias("tokens_u"))
    second = sets.select(F.col("cls").alias("v"), F.col("n").alias("n_v"), F.col("tokens").alias("tokens_v"))
    common = F.size(F.array_intersect("tokens_u", "tokens_v")).cast("long")
    return pairs.join(first, "u").join(second, "v").withColumn("common", common).drop("tokens_u", "tokens_v")


def _hub_pairs(entries: DataFrame) -> DataFrame:
    """``(u, v)``: each set ``u`` with one hub ``v`` of its lists, of another label."""
    # no tokens of its own, and none lost: the likeliest middle of a group of copies
    order = F.struct("own", (-F.col("n")).alias("less"), F.col("cls").alias("hub"), "label")
    hubs = stored(entries.groupBy("token").agg(F.min(order).alias("best")), "hubs")
    return (
        entries.join(hubs, "token").where("label <> best.label")
        .groupBy("cls").agg(F.min("best").alias("best"))
        .select(F.col("cls").alias("u"), F.col("best.hub").alias("v"))
    )


def _block_pairs(entries: DataFrame, hubs: DataFrame, percent: int, few_lists: bool) -> DataFrame:
    """``(u, v, sure)``: pairs of sets that the index and the hubs' answers leave over;
    ``sure`` ones are similar by their hub's answers alone.

    Where a set is in ``few_lists``, entries carry them all, and a pair is told in the first
    list that both are in."""
    relation = hubs.select(
        F.col("u").alias("cls"), F.col("v").alias("hub"), F.col("n_v").alias("n_hub"), F.col("common").alias("c"),
        F.expr(_enough(percent, "n_u", "n_v", "common")).alias("near"),
    )
    kind = ["token", "n", "own", "pos", "hub", "n_hub", "c", "near"]
    entries = entries.join(relation, "cls", "left")
    lists = F.lit(None).cast("array<long>")
    if few_lists:
        own_lists = entries.groupBy("cls").agg(F.sort_array(F.collect_set("token")).alias("all_lists"))
        entries, lists = entries.join(own_lists, "cls"), F.col("all_lists")
    entries = entries.select(F.xxhash64(*kind).alias("block"), "cls", "label", lists.alias("lists"), *kind)
    entries = stored(entries, "blocked")
    blocks = stored(entries.select("block", *kind).distinct(), "blocks")
    one = blocks.select([F.col(c).alias(f"{c}_a") for c in blocks.columns])
    two = blocks.select([F.col(c).alias(f"{c}_b") for c in blocks.columns])
    needed = _needed(percent, "n_a", "n_b")
    room = F.expr(
        f"{percent} * greatest(n_a, n_b) <= 100 * least(n_a, n_b) AND least(n_a - pos_a, n_b - pos_b) >= {needed}"
    )
    # own tokens are neither the hub's nor the other set's
    derived = F.expr(
        f"coalesce(hub_a = hub_b AND ((near_a AND near_b) OR "
        f"least(c_a, c_b) + least(n_a - c_a - own_a, n_b - c_b - own_b) < {needed}), false)"
    )
    sure = F.expr(f"coalesce(hub_a = hub_b AND c_a + c_b - n_hub_a >= {needed}, false)")
    met = (
        one.join(two, F.col("token_a") == F.col("token_b"))
        .where((F.col("block_a") <= F.col("block_b")) & room & ~derived)
        .select("token_a", "token_b", "block_a", "block_b", sure.alias("sure"))
    )
    met = stored(met, "met")
    side = {
        s: entries.select(*(F.col(c).alias(f"{c}_{s}") for c in ("token", "block", "cls", "label", "lists"))) for s in "ab"
    }
    apart = "label_a <> label_b"
    if few_lists:
        apart += " AND array_min(array_intersect(lists_a, lists_b)) = token_a"
    return (
        met.join(side["a"], ["token_a", "block_a"]).join(side["b"], ["token_b", "block_b"])
        .where(apart)
        .select(F.least("cls_a", "cls_b").alias("u"), F.greatest("cls_a", "cls_b").alias("v"), "sure")
        .groupBy("u", "v").agg(F.bool_or("sure").alias("sure"))
    )


def similar_sets(postings: DataFrame, sets: DataFrame, percent: int, few_lists: bool = False) -> DataFrame:
    """Links ``(u, v)`` of the sets ``(cls, n, tokens)`` that meet in a list of the index
    ``postings``: enough for all components of the relation ``100 * intersection >=
    percent * union``, and none that is not in it.

    ``postings`` are ``(token, cls, n, own, pos)``: the list, and how many tokens of a set
    come before its entry there or are no other set's. ``few_lists``: a set has a bounded
    number of them, and its places in them all stand for the same.
    """
    links, hubs = None, None
    for _ in range(HUB_ROUNDS):
        entries = stored(_labelled(postings, links), "labelled")
        if entries.isEmpty():
            break
        compared = stored(_compare(_hub_pairs(entries), sets), "compared")
        found = compared.where(_enough(percent, "n_u", "n_v", "common")).select("u", "v")
        links = found if links is None else links.union(found)
        hubs = compared if hubs is None else hubs
    if links is None:
        return postings.select(F.col("cls").alias("u"), F.col("cls").alias("v")).limit(0)
    entries = stored(_labelled(postings, links), "labelled")
    if entries.isEmpty():
        return links
    # a hub is compared with itself, so that its own pairs are derived too
    itself = hubs.select("v", "n_v").distinct().select(
        F.col("v").alias("u"), "v", F.col("n_v").alias("n_u"), "n_v", F.col("n_v").alias("common")
    )
    itself = itself.join(hubs.select("u"), "u", "left_anti").select("u", "v", "n_u", "n_v", "common")
    pairs = stored(_block_pairs(entries, hubs.select(itself.columns).union(itself), percent, few_lists), "pairs")
    links = links.union(pairs.where("sure").select("u", "v"))
    compared = _compare(pairs.where("NOT sure").select("u", "v"), sets)
    return links.union(stored(compared.where(_enough(percent, "n_u", "n_v", "common")).select("u", "v"), "similar"))


def jaccard_groups(docs: DataFrame, k: int = 3, percent: int = 90) -> DataFrame:
    """``(doc_id, n_shingles, component_id)``, one row per row of ``docs``.

    ``docs`` needs ``doc_id`` and ``text``; A-Z are lower-cased. A document's set are its
    different k-word shingles, or all its words as one if there are fewer. Documents with
    ``100 * intersection >= percent * union`` are linked; the join is exact but for clashes of
    64-bit hashes. ``component_id`` is the least doc_id reachable.

    Null and empty texts have no shingles and are linked with nothing. Rows without a
    doc_id are linked with nothing and have no component. Rows that share a doc_id are one
    document: a link of one of them links all.
    """
    texts = docs.select("doc_id", "text")
    scanned = stored(texts.mapInArrow(partial(_prints, k=k), "doc_id long, n long, high long, low long"), "prints")
    classes = classes_of(scanned)
    own = own_tokens(texts.select("text").mapInArrow(partial(_sampled_tokens, k=k), "high long, token long"), "high")
    likely = classes.join(own, "high", "left").where(F.coalesce("own", F.lit(0)) <= spare(percent))
    likely = stored(likely.drop("own"), "likely")
    sets = stored(without_strangers(stored(sets_of(docs, likely, k), "likely-sets"), percent), "sets")
    links = similar_sets(stored(_postings(sets, percent), "postings"), sets, percent)

    return by_document(scanned, classes, links).select("doc_id", F.col("n").alias("n_shingles"), "component_id")
