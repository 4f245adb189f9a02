"""Row numbers and joins under repeated, sparse, missing and identical keys."""

import re
from collections import Counter

import pytest
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from wayfare import session
from wayfare.operators import joins, numbering

SMALL = {"row_limit": 50, "bits": 3}
SMALL_CELLS = {**SMALL, "cell_rows": 16}


def rows_of(df):
    return Counter(tuple(row) for row in df.collect())


def assert_numbered(numbered, expected, key, name="sk"):
    """The numbers are 1..n in key order with missing keys last, and no row changed."""
    rows = sorted(numbered.collect(), key=lambda row: row[name])
    assert [row[name] for row in rows] == list(range(1, len(rows) + 1))
    keys = [row[key] for row in rows]
    assert keys == sorted(keys, key=lambda k: (k is None, k or 0))
    assert rows_of(numbered.drop(name).select(*expected.columns)) == rows_of(expected)


KEYS = {
    "dense": "id",
    "negative and sparse": "(id - 500) * 9007199254740993",
    "wide gaps": "CASE WHEN id % 2 = 0 THEN id ELSE 9223372036854775000 + id % 807 END",
    "a third is one key": "CASE WHEN id % 3 = 0 THEN 77 ELSE id END",
    "a third is missing": "CASE WHEN id % 3 = 0 THEN NULL ELSE id END",
    "one key only": "CAST(5 AS BIGINT)",
}


@pytest.mark.parametrize("limits", [{}, SMALL], ids=["default limits", "small limits"])
@pytest.mark.parametrize("keys", KEYS)
def test_surrogate_key(spark, keys, limits):
    df = spark.range(1000).select(F.expr(KEYS[keys]).alias("key"), (F.col("id") % 7).alias("v"))
    assert_numbered(numbering.surrogate_key(df, "key", "sk", ("v",), **limits), df, "key")


@pytest.mark.parametrize("keys", KEYS)
def test_ties_decide_at_every_size(spark, keys):
    df = spark.range(1000).select(
        F.expr(KEYS[keys]).alias("key"), (F.col("id") * 37 % 11).alias("v"), (-F.col("id")).alias("w")
    )
    few, many = (
        rows_of(numbering.surrogate_key(df, "key", "sk", ("v", "w"), row_limit=limit, bits=3))
        for limit in (50, 10_000)
    )
    assert few == many


@pytest.mark.parametrize("sides", ["hot on both", "hot on the left"])
def test_ties_of_a_join_decide_at_every_size(spark, sides):
    left, right = two_sides(spark, *SIDES[sides])
    few, many = (
        rows_of(numbering.numbered_left_join(
            left, right, "key", "sk", ("r", "l"), row_limit=limit, bits=3, cell_rows=16))
        for limit in (50, 1_000_000)
    )
    assert few == many


def test_identical_copies_are_all_numbered(spark):
    df = spark.range(900).select(
        F.when(F.col("id") % 3 == 0, 8).otherwise(F.col("id")).alias("key"), F.lit("same").alias("v")
    )
    assert_numbered(numbering.surrogate_key(df, "key", "sk", **SMALL), df, "key")


@pytest.mark.parametrize("limits", [{}, SMALL], ids=["default limits", "small limits"])
@pytest.mark.parametrize("keys", KEYS)
def test_in_key_order_cuts_equal_partitions(spark, keys, limits):
    df = spark.range(1000).select(F.expr(KEYS[keys]).alias("key"), F.col("id").alias("v"))
    ordered = numbering.in_key_order(df, "key", rows_per_partition=300, **limits)
    found = ordered.select("*", F.spark_partition_id().alias("p")).collect()
    assert Counter(row.p for row in found) == {0: 300, 1: 300, 2: 300, 3: 100}
    assert [row.p for row in found] == sorted(row.p for row in found)
    found_keys = [row.key for row in found]
    assert found_keys == sorted(found_keys, key=lambda k: (k is None, k or 0))
    assert Counter((row.key, row.v) for row in found) == rows_of(df)


def test_levels_give_the_same_starts_as_one_window(spark):
    counts = spark.range(4000).select(
        ((F.col("id") - 2000) * 70368744177).alias(numbering.BUCKET),
        (F.col("id") % 5 + 1).alias("_rows"),
    )
    one = rows_of(numbering.bucket_starts(counts, ()).select(numbering.BUCKET, "_start"))
    assert one == rows_of(numbering.bucket_starts(counts).select(numbering.BUCKET, "_start"))
    assert one == rows_of(numbering.bucket_starts(counts, (30, 8)))


def two_sides(spark, left_key, right_key):
    left = spark.range(600).select(F.expr(left_key).alias("key"), F.col("id").alias("l"))
    right = spark.range(300).select(F.expr(right_key).alias("key"), F.col("id").alias("r"))
    return left, right


SIDES = {
    "unique": ("id", "id * 2"),
    "hot on the right": ("id", "CASE WHEN id % 3 = 0 THEN 10 ELSE id END"),
    "hot on the left": ("CASE WHEN id % 3 = 0 THEN 10 ELSE id END", "id"),
    "hot on both": ("CASE WHEN id % 3 = 0 THEN 10 ELSE id END",
                    "CASE WHEN id % 3 = 0 THEN 10 ELSE id END"),
    "hot on the right without partner": ("id", "CASE WHEN id % 3 = 0 THEN -10 ELSE id END"),
    "hot on the left without partner": ("CASE WHEN id % 3 = 0 THEN -10 ELSE id END", "id"),
    "no partners": ("id", "id + 100000"),
}


@pytest.mark.parametrize("limits", [{}, SMALL_CELLS], ids=["default limits", "small limits"])
@pytest.mark.parametrize("sides", SIDES)
def test_numbered_left_join(spark, sides, limits):
    left, right = two_sides(spark, *SIDES[sides])
    expected = left.join(right, "key", "left")
    joined = numbering.numbered_left_join(left, right, "key", "sk", ("l", "r"), **limits)
    assert_numbered(joined, expected, "key")


def tied_sides(spark):
    """A key with many rows on both sides, ties and identical rows on either, missing values."""
    key = "CASE WHEN id % 3 = 0 THEN 10 WHEN id % 3 = 1 THEN id END"
    sides = [(600, "l", key), (300, "r", key.replace("END", "ELSE -id END"))]
    return [
        spark.range(rows).select(
            F.expr(by).alias("key"), F.expr("NULLIF(id % 4, 1)").alias(f"{side}1"),
            F.expr("NULLIF(id DIV 7 % 5, 2)").alias(f"{side}2"), F.lit(side).alias(f"{side}3"),
        )
        for rows, side, by in sides
    ]


TIES = [
    (), ("l1", "l2", "r1", "r2"), ("r1", "l1"), ("l1", "r1", "l2", "r2"), ("r2", "r1", "l2", "l1"),
]


@pytest.mark.parametrize("ties", TIES, ids="-".join)
def test_numbers_of_joined_rows_are_those_of_a_plain_window(spark, ties):
    left, right = tied_sides(spark)
    plain = Window.orderBy(F.asc_nulls_last("key"), *ties)
    expected = left.join(right, "key", "left").withColumn("sk", F.row_number().over(plain))
    joined = numbering.numbered_left_join(left, right, "key", "sk", ties, **SMALL_CELLS)
    assert joined.columns == ["key", "l1", "l2", "l3", "r1", "r2", "r3", "sk"]
    assert rows_of(joined.select("sk", "key", *ties)) == rows_of(expected.select("sk", "key", *ties))
    assert_numbered(joined, expected.drop("sk"), "key")


def test_rows_joined_in_cells_are_not_written_to_be_numbered(spark, monkeypatch):
    """Only sides and counts are: a key with n and m rows yields n times m."""
    written = []

    def noted(df):
        stored = session.materialise(df)
        written.append(stored.count())
        return stored

    monkeypatch.setattr(numbering, "materialise", noted)
    monkeypatch.setattr(joins, "materialise", noted)
    left, right = two_sides(spark, *SIDES["hot on both"])
    joined = numbering.numbered_left_join(left, right, "key", "sk", ("l", "r"), **SMALL_CELLS)
    assert joined.count() > 20_000 and 0 < max(written) <= 600


def test_cells_of_a_key_are_dealt_apart_without_broadcasts(spark, monkeypatch):
    """Sides already hashed by the key alone must not stay so."""
    for module in (numbering, joins):
        monkeypatch.setattr(module, "broadcast_if_small", lambda df: df)
    monkeypatch.setattr(F, "broadcast", lambda df: df)
    threshold = "spark.sql.autoBroadcastJoinThreshold"
    before = spark.conf.get(threshold)
    spark.conf.set(threshold, "-1")
    try:
        left, right = two_sides(spark, *SIDES["hot on both"])
        joined = numbering.numbered_left_join(left, right, "key", "sk", ("l", "r"), **SMALL_CELLS)
        text = joined._jdf.queryExecution().executedPlan().toString()
        assert len(re.findall(r"hashpartitioning\(key#\d+L?, _i#\d+L?, _j#\d+L?,", text)) == 2
        assert_numbered(joined, left.join(right, "key", "left"), "key")
    finally:
        spark.conf.set(threshold, before)


def test_cells_copy_rows_to_a_bound_however_small_they_are(spark):
    left, right = (
        joins.with_slots(spark.range(rows).select(F.lit(7).alias("key"), F.col("id").alias(own)), slot)
        for rows, own, slot in ((400, "l", joins.LEFT_SLOT), (300, "r", joins.RIGHT_SLOT))
    )
    sides = joins.cell_sides(left, right, "key", joins.cell_grid(left, right, "key", cell_rows=1))
    assert sum(side.count() for side in sides) <= 2 * (joins.COPIES + 1) * 400
    pairs = joins.join_cells(*sides, "key").select("l", "r").distinct()
    assert pairs.count() == 400 * 300


def test_a_small_limit_writes_only_rows_next_to_the_repeated_key(spark, monkeypatch):
    """Buckets of keys that do not repeat are within the limit, however small it is."""
    written = []

    def noted(df):
        stored = session.materialise(df)
        written.append(stored.count())
        return stored

    monkeypatch.setattr(numbering, "materialise", noted)
    monkeypatch.setattr(joins, "materialise", noted)
    left, right = (
        spark.range(20_000).select(
            F.expr("CASE WHEN id % 50 = 0 THEN 50 ELSE id END").alias("key"), F.col("id").alias(own)
        )
        for own in ("l", "r")
    )
    joined = numbering.numbered_left_join(left, right, "key", "sk", ("l", "r"), row_limit=300)
    assert 400 <= max(written) <= 400 + 256
    assert_numbered(joined, left.join(right, "key", "left"), "key")


@pytest.mark.parametrize("bits", [0, 3, 8, joins.BUCKET_BITS])
@pytest.mark.parametrize("keys", ["negative and sparse", "wide gaps", "a third is missing"])
def test_levels_fit_narrow_buckets(spark, monkeypatch, keys, bits):
    assert 64 - bits - sum(numbering._levels(bits)) <= 18
    monkeypatch.setattr(numbering, "_ONE_WINDOW_ROWS", 0)
    df = spark.range(1000).select(F.expr(KEYS[keys]).alias("key"), (F.col("id") % 7).alias("v"))
    assert_numbered(numbering.surrogate_key(df, "key", "sk", ("v",), bits=bits), df, "key")


@pytest.mark.parametrize("limit", [joins.ROW_LIMIT, 50])
@pytest.mark.parametrize("sides", SIDES)
def test_left_join(spark, sides, limit):
    left, right = two_sides(spark, *SIDES[sides])
    joined = joins.left_join(left, right, "key", row_limit=limit, bits=3, cell_rows=16)
    assert rows_of(joined) == rows_of(left.join(right, "key", "left"))


def test_left_join_keeps_rows_without_a_key(spark):
    left = spark.createDataFrame([(None, 1), (1, 2), (9, 3)], "key BIGINT, l INT")
    right = spark.createDataFrame([(1, i) for i in range(80)] + [(None, 0)], "key BIGINT, r INT")
    joined = joins.left_join(left, right, "key", row_limit=20, bits=3, cell_rows=9)
    assert rows_of(joined) == rows_of(left.join(right, "key", "left"))
