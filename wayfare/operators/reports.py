"""Dashboard aggregates over the gold tables, and the row-count report.

Revenue is the surge fare of completed trips. Sums, shares and means are exact decimals.
"""

from __future__ import annotations

from collections.abc import Mapping
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wayfare.functions import exact_mean, share

def _trips() -> Column:
    return F.count(F.lit(1)).alias("trips")


def _revenue() -> Column:
    paid = F.when(F.col("trip_status") == "completed", F.col("surge_fare"))
    return F.coalesce(F.sum(paid), F.lit(0)).cast("decimal(28,2)").alias("revenue_egp")


def kpi_overview(fact: DataFrame) -> DataFrame:
    """One row: trip counts, cancel rate, revenue and mean distance."""
    cancelled = F.sum("is_cancelled")
    return fact.agg(
        _trips(),
        F.count_if(F.col("trip_status") == "completed").alias("completed_trips"),
        F.coalesce(cancelled, F.lit(0)).alias("cancelled_trips"),
        share(cancelled, F.count(F.lit(1))).alias("cancel_rate"),
        _revenue(),
        exact_mean(F.col("distance_km")).alias("avg_distance_km"),
    )


def revenue_trend(fact: DataFrame) -> DataFrame:
    """Trips and revenue per day."""
    return fact.groupBy("trip_date").agg(_trips(), _revenue())


def trips_by_governorate(fact: DataFrame) -> DataFrame:
    """Trips and revenue by where the trip began."""
    return fact.groupBy("pickup_governorate").agg(_trips(), _revenue())


def by_vehicle_type(fact: DataFrame) -> DataFrame:
    """Trips, revenue and mean surge multiplier per vehicle type."""
    multiplier = exact_mean(F.col("surge_multiplier")).alias("avg_surge_multiplier")
    return fact.groupBy("vehicle_type").agg(_trips(), _revenue(), multiplier)


def by_payment(fact: DataFrame) -> DataFrame:
    """Trips and net amount per payment method and provider."""
    net = F.sum("net_amount_egp").alias("net_amount_egp")
    return fact.groupBy("payment_method", "payment_provider").agg(_trips(), net)


def peak_hours(fact: DataFrame) -> DataFrame:
    """Trips per hour of the day."""
    return fact.groupBy("trip_hour").agg(_trips())


def drivers_by_tier(drivers: DataFrame) -> DataFrame:
    """Drivers and mean rating per tier."""
    return drivers.groupBy("driver_tier").agg(
        F.count(F.lit(1)).alias("drivers"), exact_mean(F.col("rating")).alias("avg_rating")
    )


def drivers_by_geo(drivers: DataFrame) -> DataFrame:
    """Drivers per governorate and vehicle type."""
    return drivers.groupBy("governorate", "vehicle_type").agg(
        F.count(F.lit(1)).alias("drivers")
    )


def _per_driver(fact: DataFrame) -> DataFrame:
    """The fact reduced to one row per driver, so that a busy driver cannot skew the join."""
    return fact.groupBy("driver_id").agg(
        _trips(), _revenue(), F.sum("is_cancelled").alias("cancelled_trips")
    )


def driver_performance(fact: DataFrame, drivers: DataFrame) -> DataFrame:
    """Trips, revenue and cancel rate per driver; drivers missing in the dimension stay."""
    described = drivers.select("driver_id", "full_name", "driver_tier")
    return _per_driver(fact).join(described, "driver_id", "left").select(
        "driver_id", "full_name", "driver_tier", "trips", "revenue_egp",
        share(F.col("cancelled_trips"), F.col("trips")).alias("cancel_rate"),
    )


def star_trips_by_tier(fact: DataFrame, drivers: DataFrame) -> DataFrame:
    """Trips and revenue per driver tier, through the star join."""
    tiers = drivers.select("driver_id", "driver_tier")
    return (
        _per_driver(fact)
        .join(tiers, "driver_id", "left")
        .groupBy("driver_tier")
        .agg(F.sum("trips").alias("trips"), F.sum("revenue_egp").alias("revenue_egp"))
    )


def row_counts(tables: Mapping[str, DataFrame]) -> DataFrame:
    """(table_name, row_count) for each named table."""
    counts = [
        df.agg(F.count(F.lit(1)).alias("row_count")).select(
            F.lit(name).alias("table_name"), "row_count"
        )
        for name, df in tables.items()
    ]
    return reduce(DataFrame.unionByName, counts)


def latest_windows(log: DataFrame, rows: int = 10) -> DataFrame:
    """The newest rows of the window log.

    All rows of a micro-batch have one processing time, so window and zone decide among them.
    """
    newest = (F.desc("processed_at"), F.desc("batch_id"), F.desc("window_start"))
    return log.orderBy(*newest, F.asc_nulls_last("zone_id")).limit(rows)


def live_zone_view(windows: DataFrame) -> DataFrame:
    """The latest window of each zone, from collapsed windows."""
    measures = [c for c in windows.columns if c != "zone_id"]
    latest = F.max_by(F.struct(*measures), "window_start").alias("latest")
    return windows.groupBy("zone_id").agg(latest).select("zone_id", "latest.*")
