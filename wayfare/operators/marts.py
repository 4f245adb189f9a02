"""Gold layer: the trip fact and the driver dimension."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wayfare.functions import driver_tier, moment
from wayfare.operators.joins import ROW_LIMIT, left_join
from wayfare.operators.numbering import numbered_left_join

FACT_COLUMNS = (
    "trip_id", "user_id", "driver_id", "pickup_zone_id", "dropoff_zone_id", "trip_status",
    "vehicle_type", "payment_method", "trip_date", "trip_hour", "pickup_zone_name",
    "dropoff_zone_name", "pickup_governorate", "base_fare", "surge_fare", "surge_multiplier",
    "distance_km", "duration_min", "is_cancelled",
)
PAYMENT_FACTS = ("net_amount_egp", "payment_provider", "promo_code", "discount_egp")
# Order of rows that share a trip_id, so that their numbers do not vary between runs.
FACT_TIES = ("requested_at", "user_id", "driver_id", *PAYMENT_FACTS)


def _load_time(as_of: datetime | str | None) -> Column:
    return F.current_timestamp().cast("timestamp_ntz") if as_of is None else moment(as_of)


def dim_drivers(cleaned: DataFrame, as_of: datetime | str | None = None) -> DataFrame:
    """One row per driver with the tier of the rating."""
    return cleaned.filter(F.col("driver_id").isNotNull()).select(
        "driver_id", "full_name", "vehicle_type", "vehicle_plate",
        F.col("rating").cast("decimal(3,2)").alias("rating"),
        F.col("active").alias("is_active"),
        "zone_name", "governorate",
        driver_tier(F.col("rating")).alias("driver_tier"),
        _load_time(as_of).alias("_dbt_loaded_at"),
    )


def _payment_facts(payments: DataFrame) -> DataFrame:
    return payments.select(
        "trip_id", "net_amount_egp", F.col("provider").alias("payment_provider"), "promo_code",
        "discount_egp",
    )


def fact_rows(trips: DataFrame, payments: DataFrame) -> DataFrame:
    """Trips with their payments, without the surrogate key: what the reports read."""
    joined = left_join(trips.select(*FACT_COLUMNS), _payment_facts(payments), "trip_id")
    return joined.select(*FACT_COLUMNS, *PAYMENT_FACTS)


def fct_trips(
    trips: DataFrame,
    payments: DataFrame,
    as_of: datetime | str | None = None,
    row_limit: int = ROW_LIMIT,
    first_key: int = 1,
) -> DataFrame:
    """The trip fact: cleaned trips, their payments if any, and a dense key by trip_id.

    A trip with several payments has several rows. No row is dropped. Keys start at
    `first_key`.
    """
    rows = numbered_left_join(
        trips.select(*FACT_COLUMNS, "requested_at"),
        _payment_facts(payments),
        "trip_id",
        "fct_trip_sk",
        FACT_TIES,
        row_limit,
    )
    return rows.select(
        (F.col("fct_trip_sk") + (first_key - 1)).alias("fct_trip_sk"),
        *FACT_COLUMNS,
        *PAYMENT_FACTS,
        _load_time(as_of).alias("_dbt_loaded_at"),
    )
