import datetime
import os

import pytest

from placemat.operators import history
from placemat.scratch import fresh_path

DAY = datetime.datetime(2024, 1, 1)


def rows(spark, *versions):
    made = [(k, DAY + datetime.timedelta(days=d), v) for k, d, v in versions]
    return spark.createDataFrame(made, "id string, at timestamp, value string")


def files(path):
    """Data files by partition."""
    return {os.path.relpath(d, path): sorted(f for f in names if f.endswith(".parquet")) for d, _, names in os.walk(path) if any(f.endswith(".parquet") for f in names)}


def merged(spark, first, *updates, slots=8):
    """Stored history after all updates, the recomputed one, and the files before and after each update."""
    known = history.scd2_history(first, "id", "at", ["value"])
    path = fresh_path(spark, "history")
    history.write_history(known, path, "id", slots)
    seen, new = [files(path)], []
    for update in updates:
        new.append(history.merge_history(path, update, "id", "at", slots))
        known = history.snapshot_merge(known, update, "id", "at")
        seen.append(files(path))
    stored = history.read_history(spark, path, known.schema)
    assert sorted(map(repr, stored.select(*known.columns).collect())) == sorted(map(repr, known.collect()))
    return seen, new


def changed(a, b):
    return {p for p in a.keys() | b.keys() if a.get(p) != b.get(p)}


def test_only_partitions_of_changed_keys_are_written(spark):
    first = rows(spark, *[(f"k{i}", i % 3, "a") for i in range(60)], *[(f"k{i}", 40, "b") for i in range(0, 60, 2)])
    unchanged = [(f"k{i}", 0, "old") for i in range(10, 30)]
    seen, new = merged(spark, first, rows(spark, ("k1", 70, "c"), *unchanged), rows(spark, ("k1", 75, "d"), ("new", 75, "d")))
    assert new == [1, 2]
    # One open slot and the month and slot that the closed version moves to.
    assert len(changed(seen[0], seen[1])) == 2 and any("2024-03" in p for p in changed(seen[0], seen[1]))
    assert len(changed(seen[1], seen[2])) <= 3


def test_nothing_new_writes_nothing(spark):
    first = rows(spark, ("a", 1, "x"), ("b", 2, "y"))
    seen, new = merged(spark, first, rows(spark, ("a", 1, "x")), rows(spark, ("a", 0, "older")), rows(spark))
    assert new == [0, 0, 0] and seen[0] == seen[1] == seen[2] == seen[3]


@pytest.mark.parametrize("slots", [1, 64])
def test_all_keys_change(spark, slots):
    first = rows(spark, *[(f"k{i}", 1, "a") for i in range(20)])
    merged(spark, first, rows(spark, *[(f"k{i}", 50 + i, "b") for i in range(25)]), slots=slots)


def test_null_keys_never_match(spark):
    """As in the full recompute: their versions stay as they are, and each merge adds one."""
    first = rows(spark, (None, 1, "a"), ("b", 1, "a"))
    _, new = merged(spark, first, rows(spark, (None, 2, "c")), rows(spark, (None, 0, "d"), ("b", 3, "e")))
    assert new == [1, 2]
