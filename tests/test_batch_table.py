from __future__ import annotations

import os

import pytest

from clickweave.session import work_folder
from clickweave.sources import batch_table, files
from clickweave.sources.batch_table import FANOUT, KEPT, BatchTable
from tests.tables import tuples

SCHEMA = "date STRING, k BIGINT, n BIGINT"


@pytest.fixture
def path(spark):
    """A folder of its own; one shuffle partition is enough for a few rows."""
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "1")
    yield work_folder(spark, "table")
    spark.conf.set("spark.sql.shuffle.partitions", before)


def rows(spark, *values):
    return spark.createDataFrame(list(values), SCHEMA).coalesce(1)


def folders(path):
    found = []
    for top, names, _ in os.walk(f"{path}/data"):
        found += [f"{top}/{n}" for n in names if n.startswith("date=")]
    return found


def test_over_two_hundred_batches_what_is_listed_stays_flat(spark, path):
    """Three days, each open for a third of the batches; every batch changes one key."""
    table = BatchTable(spark, path, SCHEMA, batch_table.latest("date", "k"), "date")
    sizes, on_disk = [], []
    batches = 201
    for i in range(batches):
        day = f"2024010{1 + 3 * i // batches}"
        assert table.commit(rows(spark, (day, i % 5, i)), i)
        table.compact(lambda d: d < day)
        runs = table.manifest().runs
        sizes.append(len([r for r in runs if r.day == day]))
        on_disk.append(len(folders(path)))
        assert len(runs) - sizes[-1] <= 2 or i % 67 == 0
    # So many runs as levels allow, of 67 batches a day.
    assert max(sizes) <= 2 * (FANOUT - 1) + 1
    assert max(on_disk[120:]) <= max(on_disk[:120]) + 3
    assert len(os.listdir(f"{path}/manifests")) <= 2 * KEPT + 2
    expected = {}
    for i in range(batches):
        expected[f"2024010{1 + 3 * i // batches}", i % 5] = i
    assert tuples(table.read(), "date", "k", "n") == sorted((*k, n) for k, n in expected.items())


def test_a_batch_is_published_once(spark, path):
    table = BatchTable(spark, path, SCHEMA)
    assert table.read().count() == 0
    assert table.commit(rows(spark, ("a", 1, 1)), 0)
    assert not table.commit(rows(spark, ("a", 1, 2)), 0)
    assert table.commit(rows(spark), 1)
    assert tuples(table.read()) == [("a", 1, 1)]
    assert table.written(1).count() == 0 and table.written(0).count() == 1


def test_what_was_not_published_is_not_there(spark, path, monkeypatch):
    table = BatchTable(spark, path, SCHEMA, batch_table.summed("date", "k"), "date")
    table.commit(rows(spark, ("a", 1, 1), ("b", 1, 1)), 0)

    def lost(*_):
        raise OSError("lost")

    for step in ("commit", "compact"):
        with monkeypatch.context() as patch:
            patch.setattr(files, "write_text", lost)
            with pytest.raises(OSError):
                if step == "commit":
                    table.commit(rows(spark, ("a", 1, 100), ("c", 1, 1)), 1)
                else:
                    table.compact(lambda day: True)
        if step == "commit":
            assert tuples(table.read(), "date", "n") == [("a", 1), ("b", 1)]
            table.commit(rows(spark, ("a", 1, 10)), 1)
        assert tuples(table.read(), "date", "n") == [("a", 11), ("b", 1)]
    table.compact(lambda day: True)
    assert tuples(table.read(), "date", "n") == [("a", 11), ("b", 1)]
    assert len(table.manifest().runs) == 2


def test_a_reader_keeps_its_version(spark, path):
    table = BatchTable(spark, path, SCHEMA)
    for i in range(FANOUT):
        table.commit(rows(spark, ("a", i, i)), i)
    before = table.read()
    table.compact()
    assert len(table.manifest().runs) == 1
    assert before.count() == table.read().count() == FANOUT


def test_merging_keeps_the_order_of_batches(spark, path):
    """Days merge at different times: a day that rests keeps its own newest batch."""
    table = BatchTable(spark, path, SCHEMA, batch_table.latest("date", "k"), "date")
    number = 0
    for turn in range(FANOUT + 4):
        for day in ("a", "b") if turn % 3 else ("a",):
            table.commit(rows(spark, (day, 1, number)), number)
            newest = {**(newest if number else {}), day: number}
            table.compact()
            number += 1
            assert tuples(table.read(), "date", "n") == sorted(newest.items())


def test_a_batch_that_replaces(spark, path):
    table = BatchTable(spark, path, SCHEMA, day="date", replaces=True)
    table.commit(rows(spark, ("a", 1, 1), ("a", 2, 1), ("b", 1, 1)), 0)
    table.commit(rows(spark, ("a", 3, 2)), 1)
    table.commit(rows(spark), 2)
    assert tuples(table.read(), "date", "k") == [("a", 3), ("b", 1)]
    whole = BatchTable(spark, f"{path}-whole", SCHEMA, replaces=True)
    whole.commit(rows(spark, ("a", 1, 1)), 0)
    whole.commit(rows(spark, ("b", 1, 1)), 1)
    assert tuples(whole.read(), "date") == [("b",)]


def test_notes_and_null_days(spark, path):
    table = BatchTable(spark, path, SCHEMA, day="date")
    table.commit(rows(spark, (None, 1, 1)), 0, lambda: {"newest": 5})
    table.commit(rows(spark, ("a", 2, 1)), 1)
    table.compact(lambda day: day < "b")
    assert table.manifest().note == {"newest": 5}
    assert sorted(tuple(r) for r in table.read().select("k", "date").collect()) == [(1, None), (2, "a")]
