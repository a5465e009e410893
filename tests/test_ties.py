"""Marks that lose no row at ties (S-04, M-04, M-05)."""

import datetime as dt

import pytest

from cohortflow.operators import watermark as WM

SCHEMA = "id int, body string, modified timestamp"


def day(n):
    return dt.datetime(2024, 1, n, 10, 0, 0, 123456)


def ids(df):
    return [r["id"] for r in df.collect()]


def test_rows_that_land_later_at_the_mark_come_once(spark):
    def source(rows):
        return spark.createDataFrame([(i, b, None if d is None else day(d)) for i, b, d in rows], SCHEMA)

    first = [(1, "a", 1), (2, "b", 2), (3, "c", 2), (4, "no time", None)]
    rows, marks = WM.extract_ties(source(first), "modified", ["id"], WM.empty_tie_marks(spark), "s")
    assert sorted(ids(rows)) == [1, 2, 3] and marks.count() == 2
    # a row with the mark's very time lands after the extract; a strict mark would lose it
    second = [*first, (5, "late", 2), (6, "older still", 1)]
    strict = source(second).filter(f"modified > timestamp'{day(2)}'")
    assert ids(strict) == []
    rows, marks = WM.extract_ties(source(second), "modified", ["id"], marks, "s")
    assert ids(rows) == [5] and marks.count() == 3
    rows, same = WM.extract_ties(source(second), "modified", ["id"], marks, "s")
    assert ids(rows) == [] and sorted(map(tuple, same.collect())) == sorted(map(tuple, marks.collect()))
    # keys at an older value go when the mark moves on
    third = [*second, (7, "next", 3), (8, "late again", 2)]
    rows, marks = WM.extract_ties(source(third), "modified", ["id"], marks, "s")
    assert ids(rows) == [8, 7] and marks.count() == 1 and marks.first()["watermark"] == day(3)


def test_sources_keep_their_own_marks(spark):
    a = spark.createDataFrame([(1, "x", day(5))], SCHEMA)
    b = spark.createDataFrame([(1, "x", day(1)), (2, "y", day(5))], SCHEMA)
    _, marks = WM.extract_ties(a, "modified", ["id"], WM.empty_tie_marks(spark), "a")
    rows, marks = WM.extract_ties(b, "modified", ["id"], marks, "b")
    assert ids(rows) == [1, 2] and sorted(r["table_name"] for r in marks.collect()) == ["a", "b"]
    assert ids(WM.extract_ties(a, "modified", ["id"], marks, "a")[0]) == []


def test_whole_rows_as_key_see_a_further_change(spark):
    one = spark.createDataFrame([(1, "x", day(1)), (2, None, day(1))], SCHEMA)
    two = spark.createDataFrame([(1, "changed", day(1)), (2, None, day(1))], SCHEMA)
    _, marks = WM.extract_ties(one, "modified", one.columns, WM.empty_tie_marks(spark), "s")
    assert [r["body"] for r in WM.extract_ties(two, "modified", two.columns, marks, "s")[0].collect()] == ["changed"]


@pytest.mark.parametrize("kind", ["date", "timestamp"])
def test_empty_source_leaves_the_marks(spark, kind):
    empty = spark.createDataFrame([], f"id int, modified {kind}")
    rows, marks = WM.extract_ties(empty, "modified", ["id"], WM.empty_tie_marks(spark), "s")
    assert rows.count() == 0 and marks.count() == 0
