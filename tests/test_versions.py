"""Versioned tables: loads are seen as a whole or not at all."""

import json
from datetime import date
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from wayfare.session import shared_dir
from wayfare.sources import targets, versions
from wayfare.sources.versions import ConcurrentLoad, VersionedTable


def days(spark, first, last, note, start=1):
    rows = [(start + k, date(2024, 1, d), note) for k, d in enumerate(range(first, last + 1))]
    return spark.createDataFrame(rows, "sk long, day date, note string")


@pytest.fixture
def table(spark):
    schema = days(spark, 1, 1, "").schema
    folders = ("month", "date_format(day, 'yyyy-MM')")
    return VersionedTable(shared_dir(spark), schema, range_by="day", folders=folders, key="sk")


def failing(df):
    """Rows of which one, not the first, fails when it is evaluated."""
    bad = F.col("sk") == df.agg(F.max("sk")).first()[0]
    return df.withColumn("note", F.when(bad, F.raise_error(F.lit("broken source"))).otherwise(F.col("note")))


def rows_of(table, spark):
    return sorted((str(r.day), r.note) for r in table.read(spark).collect())


def local(table):
    return Path(table.path.removeprefix("file:"))


def test_a_table_without_commits_is_empty(spark, table):
    assert table.read(spark).columns == ["sk", "day", "note"] and table.read(spark).isEmpty()
    assert table.last_key(spark) == 0


def test_a_failed_load_leaves_the_old_table(spark, table):
    targets.full_refresh(days(spark, 1, 9, "old"), table)
    before = rows_of(table, spark)
    for load in (
        lambda df: targets.full_refresh(df, table),
        lambda df: targets.append(df, table),
        lambda df: table.write(df, since=date(2024, 1, 5)),
    ):
        with pytest.raises(Exception, match="broken source"):
            load(failing(days(spark, 5, 12, "new").repartition(4)))
        assert rows_of(table, spark) == before
    assert len(list((local(table) / "data").iterdir())) == 1
    assert not list((local(table) / "open").glob("v*"))


def test_a_load_that_died_is_not_seen_and_is_cleaned(spark, table, monkeypatch):
    targets.full_refresh(days(spark, 1, 3, "old"), table)
    pending = table.write(days(spark, 1, 9, "lost"))  # never committed
    assert rows_of(table, spark) == [(f"2024-01-0{d}", "old") for d in (1, 2, 3)]
    assert table.clean(spark) == []
    monkeypatch.setattr(versions, "ABANDONED_SECONDS", -1)
    assert table.clean(spark) == [pending.version]
    assert len(rows_of(table, spark)) == 3


def test_days_are_replaced_by_the_commit_alone(spark, table):
    targets.full_refresh(days(spark, 1, 20, "old"), table)
    first = table.read(spark)
    pending = table.write(days(spark, 10, 15, "new", start=21), since=date(2024, 1, 10))
    assert len(rows_of(table, spark)) == 20
    pending.commit(spark)
    expected = [(f"2024-01-{d:02d}", "old") for d in range(1, 10)]
    expected += [(f"2024-01-{d:02d}", "new") for d in range(10, 16)]
    assert rows_of(table, spark) == expected
    # A reader that began before sees what it saw then.
    assert first.count() == 20
    assert table.last_key(spark) == 26
    table.write(days(spark, 12, 12, "newest"), since=date(2024, 1, 12)).commit(spark)
    assert rows_of(table, spark) == [*expected[:11], ("2024-01-12", "newest")]
    targets.full_refresh(days(spark, 1, 1, "all"), table)
    assert rows_of(table, spark) == [("2024-01-01", "all")] and table.last_key(spark) == 1


def test_rows_without_a_day_stay_with_the_oldest(spark, table):
    old = days(spark, 1, 4, "old").withColumn("day", F.when(F.col("sk") > 1, F.col("day")))
    targets.full_refresh(old, table)
    table.write(days(spark, 3, 4, "new"), since=date(2024, 1, 3)).commit(spark)
    assert rows_of(table, spark) == [
        ("2024-01-02", "old"), ("2024-01-03", "new"), ("2024-01-04", "new"), ("None", "old"),
    ]


def test_appends_add_versions(spark, table):
    for note in ("a", "b"):
        assert targets.append(days(spark, 1, 2, note), table) == 2
    assert [note for _, note in rows_of(table, spark)] == ["a", "b", "a", "b"]


def test_months_and_versions_are_pruned(spark, table):
    targets.full_refresh(days(spark, 1, 20, "old"), table)
    table.write(days(spark, 10, 15, "new"), since=date(2024, 1, 10)).commit(spark)
    plan = table.read(spark)._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters" in plan and "version#" in plan.split("PartitionFilters")[1]
    assert "month#" in plan.split("PartitionFilters")[1].split("PushedFilters")[0]


def test_two_loads_at_once_do_not_both_count(spark, table):
    one, two = table.write(days(spark, 1, 1, "one")), table.write(days(spark, 1, 1, "two"))
    one.commit(spark)
    with pytest.raises(ConcurrentLoad):
        two.commit(spark)
    assert rows_of(table, spark) == [("2024-01-01", "one")]


def test_old_versions_go_and_readers_keep_two(spark, table):
    for n in range(5):
        targets.full_refresh(days(spark, 1, 1, str(n)), table)
    table.clean(spark)
    assert len(list((local(table) / "data").iterdir())) == 2
    assert len(list((local(table) / "commits").glob("*.json"))) == 2
    assert rows_of(table, spark) == [("2024-01-01", "4")]
    newest = max((local(table) / "commits").glob("*.json"))
    assert json.loads(newest.read_text())["segments"][0]["rows"] == 1


def test_nothing_new_keeps_what_is_there(spark, table):
    targets.full_refresh(days(spark, 1, 2, "old"), table)
    for nothing in (days(spark, 1, 2, "x").filter("note = 'none'"), days(spark, 1, 2, "x").filter("false")):
        assert targets.refresh_unless_empty(nothing, table) == 0
        assert targets.refresh_unless_empty(nothing.repartition(3), table) == 0
    assert len(rows_of(table, spark)) == 2
    assert targets.refresh_unless_empty(days(spark, 1, 1, "new"), table) == 1
    assert rows_of(table, spark) == [("2024-01-01", "new")]


def test_tables_are_published_together_or_not(spark, table):
    other = VersionedTable(shared_dir(spark), table.schema)
    targets.publish_together(spark, [(days(spark, 1, 1, "a"), table, None), (days(spark, 1, 1, "a"), other, None)])
    with pytest.raises(Exception, match="broken source"):
        targets.publish_together(
            spark, [(days(spark, 1, 1, "b"), table, None), (failing(days(spark, 1, 1, "b")), other, None)]
        )
    assert rows_of(table, spark) == rows_of(other, spark) == [("2024-01-01", "a")]
    assert len(list((local(table) / "data").iterdir())) == 1
