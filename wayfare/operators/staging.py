"""Cleaned staging: conformed names and cases, derived trip columns, no rows without a key."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wayfare.functions import is_cancelled, surge_multiplier, text_enum


def clean_trips(staged: DataFrame) -> DataFrame:
    """Trips that have a key and a base fare of zero or more."""
    kept = staged.filter(F.col("trip_id").isNotNull() & (F.col("base_fare") >= 0))
    return kept.select(
        "trip_id", "user_id", "driver_id", "pickup_zone_id", "dropoff_zone_id",
        text_enum("status").alias("trip_status"),
        text_enum("vehicle_type").alias("vehicle_type"),
        text_enum("payment_method").alias("payment_method"),
        "requested_at", "completed_at", "base_fare", "surge_fare", "distance_km",
        "duration_min", "cancellation_reason", "pickup_zone_name", "dropoff_zone_name",
        "pickup_governorate",
        surge_multiplier(F.col("base_fare"), F.col("surge_fare")).alias("surge_multiplier"),
        is_cancelled(F.col("status")).alias("is_cancelled"),
        F.to_date("requested_at").alias("trip_date"),
        F.hour("requested_at").alias("trip_hour"),
    )


def clean_drivers(staged: DataFrame) -> DataFrame:
    """Drivers that have a key."""
    return staged.filter(F.col("driver_id").isNotNull()).select(
        "driver_id", "full_name", text_enum("vehicle_type").alias("vehicle_type"),
        "vehicle_plate", "rating", "active", "zone_name", "governorate",
    )


def clean_payments(staged: DataFrame) -> DataFrame:
    """Payments that name a trip."""
    return staged.filter(F.col("trip_id").isNotNull()).select(
        "trip_id", "transaction_ref", "provider", "amount_egp", "discount_egp",
        "net_amount_egp", "promo_code", F.col("status").alias("payment_status"), "created_at",
    )


def register_views(trips: DataFrame, drivers: DataFrame, payments: DataFrame) -> None:
    """Publish cleaned staging as lazy views under the names its readers use."""
    trips.createOrReplaceTempView("mart_stg_trips")
    drivers.createOrReplaceTempView("mart_stg_drivers")
    payments.createOrReplaceTempView("mart_stg_payments")
