"""Type 2 history against a row-by-row model, and the corner cases one by one."""

import random
from datetime import datetime, timedelta

import pytest

from tidemark.operators import classify, first_versions, merge_versions, stored

FAR = datetime(9999, 12, 31)
T0 = datetime(2020, 1, 1)
BATCH = "k long, v string, note string, created_at timestamp_ntz, updated_at timestamp_ntz"


def day(n):
    return T0 + timedelta(days=n)


def batch(spark, *rows):
    return spark.createDataFrame(list(rows), BATCH)


def rows_of(history):
    picked = history.select("k", "v", "start_date", "end_date", "current_flag", "sk_k").collect()
    return sorted((tuple(r) for r in picked), key=lambda r: r[5])


def start(spark, *keys):
    return first_versions(batch(spark, *[(k, "a", "", T0, T0) for k in keys]), "k")


def check_invariants(rows):
    keys = [r[5] for r in rows]
    assert None not in keys and len(set(keys)) == len(keys)
    by_key: dict = {}
    for r in rows:
        by_key.setdefault(r[0], []).append(r)
    for versions in by_key.values():
        assert sum(r[4] for r in versions) <= 1
        versions.sort(key=lambda r: (r[2], r[3]))
        for before, after in zip(versions, versions[1:]):
            assert before[3] <= after[2]
        for r in versions:
            assert r[2] <= r[3] and r[4] == (r[3] == FAR)


def test_update_without_insert_keeps_surrogate_keys(spark):
    merged = rows_of(merge_versions(start(spark, 1, 2, 3), batch(spark, (2, "b", "", T0, day(5))), "k", ["v"], day(9)))
    assert (2, "b", day(5), FAR, True, 4) in merged
    assert (2, "a", T0, day(5), False, 2) in merged
    check_invariants(merged)


def test_untracked_changes_keep_the_old_row(spark):
    merged = merge_versions(start(spark, 1), batch(spark, (1, "a", "new note", T0, day(5))), "k", ["v"], day(9))
    assert [r.note for r in merged.collect()] == [""]


def test_delta_and_snapshot_treat_missing_keys_differently(spark):
    news = batch(spark, (1, "a", "", T0, T0))
    delta = rows_of(merge_versions(start(spark, 1, 2, 3), news, "k", ["v"], day(9), "delta"))
    assert [r[4] for r in delta] == [True, True, True]
    snapshot = rows_of(merge_versions(start(spark, 1, 2, 3), news, "k", ["v"], day(9), "snapshot"))
    assert [(r[0], r[3], r[4]) for r in snapshot] == [(1, FAR, True), (2, day(9), False), (3, day(9), False)]


def test_revived_key_opens_after_its_last_end(spark):
    gone = stored(merge_versions(start(spark, 1, 2), batch(spark, (1, "a", "", T0, T0)), "k", ["v"], day(9), "snapshot"))
    # The source did not touch updated_at when the row came back.
    back = rows_of(merge_versions(gone, batch(spark, (2, "a", "", T0, day(3))), "k", ["v"], day(20)))
    assert (2, "a", day(9), FAR, True, 3) in back
    check_invariants(back)
    later = rows_of(merge_versions(gone, batch(spark, (2, "a", "", T0, day(15))), "k", ["v"], day(20)))
    assert (2, "a", day(15), FAR, True, 3) in later


def test_newest_row_of_a_key_in_one_batch_wins(spark):
    news = batch(spark, (1, "b", "", T0, day(2)), (1, "c", "", T0, day(3)), (1, "c", "", T0, day(3)), (1, "d", "", T0, day(1)))
    merged = rows_of(merge_versions(start(spark, 1), news, "k", ["v"], day(9)))
    assert [r[1] for r in merged] == ["a", "c"]
    assert rows_of(first_versions(news, "k")) == [(1, "c", T0, FAR, True, 1)]


def test_null_values_are_values(spark):
    to_null = stored(merge_versions(start(spark, 1), batch(spark, (1, None, "", T0, day(2))), "k", ["v"], day(9)))
    assert [r[1] for r in rows_of(to_null) if r[4]] == [None]
    again = merge_versions(to_null, batch(spark, (1, None, "", T0, day(3))), "k", ["v"], day(9))
    assert rows_of(again) == rows_of(to_null)


def test_no_tracked_columns_means_no_updates(spark):
    merged = rows_of(merge_versions(start(spark, 1), batch(spark, (1, "b", "", T0, day(2))), "k", [], day(9)))
    assert merged == rows_of(start(spark, 1))


def test_inserts_are_numbered_before_updates(spark):
    news = batch(spark, (1, "b", "", T0, day(2)), (9, "x", "", day(1), day(1)), (5, "x", "", day(1), day(1)))
    merged = {(r[0], r[5]) for r in rows_of(merge_versions(start(spark, 1, 2), news, "k", ["v"], day(9))) if r[4]}
    assert merged == {(2, 2), (5, 3), (9, 4), (1, 5)}


def test_version_start_at_creation(spark):
    merged = rows_of(
        merge_versions(start(spark, 1), batch(spark, (1, "b", "", T0, day(2))), "k", ["v"], day(9), version_start="created_at")
    )
    assert (1, "b", T0, FAR, True, 2) in merged


def test_unknown_options_are_refused(spark):
    with pytest.raises(ValueError):
        merge_versions(start(spark, 1), batch(spark, (1, "a", "", T0, T0)), "k", ["v"], day(1), "full")
    with pytest.raises(ValueError):
        merge_versions(start(spark, 1), batch(spark, (1, "a", "", T0, T0)), "k", ["v"], day(1), version_start="now")


def test_classify(spark):
    history = start(spark, 1, 2, 3)
    news = batch(spark, (1, "a", "", T0, T0), (2, "b", "", T0, T0), (4, "a", "", T0, T0))
    got = {(r.k, r.action) for r in classify(history, news, "k", ["v"]).collect()}
    assert got == {(1, "NOCHANGE"), (2, "UPDATE"), (3, "DELETE"), (4, "INSERT")}


class Model:
    """The same rules on Python lists."""

    def __init__(self):
        self.rows, self.top = [], 0

    def merge(self, news, as_of, kind):
        newest = {}
        for row in sorted(news, key=lambda r: (r[4], r[1], r[2], r[3])):
            newest[row[0]] = row
        opened = []
        for row in self.rows:
            if not row["open"]:
                continue
            new = newest.get(row["k"])
            if new is None and kind == "snapshot":
                row.update(end=max(as_of, row["start"]), open=False)
            elif new is not None and new[1] != row["v"]:
                at = max(new[4], row["start"])
                row.update(end=at, open=False)
                opened.append((1, new[0], new[1], at))
        for k, new in newest.items():
            mine = [r for r in self.rows if r["k"] == k]
            if any(r["open"] for r in mine) or any(o[1] == k for o in opened):
                continue
            at = max(new[4], max(r["end"] for r in mine)) if mine else new[3]
            opened.append((0, k, new[1], at))
        for _, k, v, at in sorted(opened, key=lambda o: o[:2]):
            self.top += 1
            self.rows.append({"k": k, "v": v, "start": at, "end": FAR, "open": True, "sk": self.top})

    def listed(self):
        return [(r["k"], r["v"], r["start"], r["end"], r["open"], r["sk"]) for r in self.rows]


@pytest.mark.parametrize("seed", [1, 2])
def test_random_sequences_match_the_model(spark, seed):
    rng = random.Random(seed)
    model, history = Model(), None
    for step in range(4):
        kind = "delta" if step == 0 else rng.choice(["delta", "snapshot"])
        news = [
            (rng.randrange(12), rng.choice("abc"), "", day(0), day(10 * step + rng.randrange(12)))
            for _ in range(rng.randrange(3, 15))
        ]
        as_of = day(10 * step + 9)
        model.merge(news, as_of, kind)
        df = batch(spark, *news)
        closed_before = [r for r in rows_of(history) if not r[4]] if history is not None else []
        merged = first_versions(df, "k") if history is None else merge_versions(history, df, "k", ["v"], as_of, kind)
        history = stored(merged)
        assert rows_of(history) == model.listed()
        check_invariants(rows_of(history))
        assert set(closed_before) <= set(rows_of(history))
        if step:
            assert rows_of(merge_versions(history, df, "k", ["v"], as_of, kind)) == rows_of(history)
