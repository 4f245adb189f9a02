"""Edge semantics of the column expressions and checks."""

from decimal import Decimal

import pytest
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from wayfare.functions import driver_tier, exact_mean, is_cancelled, share, surge_multiplier
from wayfare.operators import extract, quality, staging
from wayfare.schemas import STAGED_TRIPS, conform


def column(spark, values, kind, expression):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"i INT, v {kind}")
    return [row[0] for row in df.orderBy("i").select(expression(F.col("v"))).collect()]


def test_driver_tier(spark):
    ratings = [Decimal(r) if r else None for r in ("4.80", "4.79", "4.30", "4.29", None)]
    tiers = column(spark, ratings, "DECIMAL(3,2)", driver_tier)
    assert tiers == ["Gold", "Silver", "Silver", "Bronze", "Bronze"]


def test_is_cancelled(spark):
    found = column(spark, ["Cancelled", "cancelled", "completed", None], "STRING", is_cancelled)
    assert found == [1, 1, 0, 0]


def test_surge_multiplier(spark):
    fares = [("10", "20.05"), ("10", "20.04"), ("0", "5"), ("-1", "5"), (None, "5"), ("10", None),
             ("200", "1"), ("200", "-1")]
    df = spark.createDataFrame([(i, *pair) for i, pair in enumerate(fares)], "i INT, b STRING, s STRING")
    fare = [F.col(c).cast("decimal(10,2)") for c in "bs"]
    found = [row[0] for row in df.orderBy("i").select(surge_multiplier(*fare)).collect()]
    want = ["2.01", "2.00", "1.00", "1.00", "1.00", None, "0.01", "-0.01"]
    assert found == [None if w is None else Decimal(w) for w in want]


def test_means_and_shares_of_nothing_are_null(spark):
    none = spark.range(0).select(F.lit(1).cast("decimal(10,2)").alias("v"))
    row = none.agg(exact_mean(F.col("v")), share(F.sum("v"), F.count("v"))).first()
    assert list(row) == [None, None]


def test_mean_rounds_half_up_exactly(spark):
    found = spark.createDataFrame([("69.58",), ("69.59",)], "v STRING").agg(
        exact_mean(F.col("v").cast("decimal(10,2)"))
    ).first()[0]
    assert found == Decimal("69.59")


def trip(spark, **values):
    row = {field.name: values.get(field.name) for field in STAGED_TRIPS}
    return spark.createDataFrame([row], STAGED_TRIPS)


def test_cleaning_keeps_zero_fares_only(spark):
    kept = {
        fare: staging.clean_trips(
            trip(spark, trip_id=1, base_fare=None if fare is None else Decimal(fare))
        ).count()
        for fare in (None, "-0.01", "0", "1")
    }
    assert kept == {None: 0, "-0.01": 0, "0": 1, "1": 1}
    assert staging.clean_trips(trip(spark, base_fare=Decimal(1))).isEmpty()


def test_lookback_has_a_lower_bound_that_counts_and_no_upper_bound(spark):
    times = ["2001-07-31 00:00:00", "2001-07-30 23:59:59", "2001-08-05 00:00:00", None]
    df = spark.createDataFrame([(t,) for t in times], "t STRING").select(
        F.col("t").cast("timestamp_ntz").alias("t")
    )
    kept = extract.recent(df, "t", "2001-08-01 00:00:00", 24)
    assert sorted(str(row[0]) for row in kept.collect()) == [times[0], times[2]]
    assert extract.recent(df, "t", None, None).count() == 4


def test_conform_casts_and_misses_no_column(spark):
    df = spark.range(1).select(
        F.lit("7").alias("trip_id"), F.lit(1).alias("extra"),
        F.lit("2001-08-01 10:00:00").cast("timestamp").alias("requested_at"),
    )
    declared = StructType([STAGED_TRIPS["trip_id"], STAGED_TRIPS["requested_at"]])
    assert conform(df, declared).dtypes == [("trip_id", "bigint"), ("requested_at", "timestamp_ntz")]
    with pytest.raises(ValueError, match="no columns user_id, driver_id"):
        conform(df, STAGED_TRIPS)


def test_payment_rules(spark):
    rows = [(1, "10", "0", "10", None), (2, "10", "1", "9", "P"), (3, "10", "1", "10", "P"),
            (4, "10", "1", "9", None), (5, "10", "0", "10", "P"), (6, None, "0", None, None)]
    df = spark.createDataFrame(rows, "trip_id BIGINT, a STRING, d STRING, n STRING, promo_code STRING")
    df = df.select(
        "trip_id", "promo_code",
        *(F.col(c).cast("decimal(10,2)").alias(name) for c, name in
          (("a", "amount_egp"), ("d", "discount_egp"), ("n", "net_amount_egp"))),
    )
    assert {row.trip_id for row in quality.unbalanced_payments(df).collect()} == {3, 4, 5}
