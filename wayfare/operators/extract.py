"""Extraction: the look-back filter and the zone lookups."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wayfare.functions import moment
from wayfare.schemas import PAYMENT_COLUMNS, TRIP_COLUMNS

DEFAULT_LOOKBACK_HOURS = 24


def recent(
    df: DataFrame, column: str, as_of: datetime | str | None, hours: int | None
) -> DataFrame:
    """Rows at or after `as_of` minus `hours`, with no upper bound. `hours=None` keeps all."""
    if hours is None:
        return df
    if as_of is None:
        raise ValueError("a look-back needs the time it looks back from")
    return df.filter(F.col(column) >= moment(as_of) - F.expr(f"interval {int(hours)} hours"))


def trips_with_zones(trips: DataFrame, zones: DataFrame) -> DataFrame:
    """Trips with the names of both zones. A trip with an unknown or no zone is left out.

    Zones of known small size are broadcast. Larger ones are joined by sort and merge, where
    adaptive execution splits the partition of a zone that most trips name.
    """
    pickup = zones.select(
        F.col("zone_id").alias("pickup_zone_id"),
        F.col("zone_name").alias("pickup_zone_name"),
        F.col("governorate").alias("pickup_governorate"),
    )
    dropoff = zones.select(
        F.col("zone_id").alias("dropoff_zone_id"), F.col("zone_name").alias("dropoff_zone_name")
    )
    return (
        trips.select(*TRIP_COLUMNS)
        .join(pickup, "pickup_zone_id")
        .join(dropoff, "dropoff_zone_id")
        .select(*TRIP_COLUMNS, "pickup_zone_name", "dropoff_zone_name", "pickup_governorate")
    )


def drivers_with_zones(drivers: DataFrame, zones: DataFrame) -> DataFrame:
    """Drivers with the zone they are registered in. A driver without a known zone is left out."""
    home = zones.select(F.col("zone_id").alias("registered_zone"), "zone_name", "governorate")
    return drivers.join(home, "registered_zone").select(
        "driver_id", "full_name", "vehicle_type", "vehicle_plate", "rating", "active",
        "zone_name", "governorate",
    )


def extract_trips(
    trips: DataFrame, zones: DataFrame, as_of: datetime | str | None, hours: int | None
) -> DataFrame:
    """Recent trips with their zones; the time filter is applied to the source column."""
    return trips_with_zones(recent(trips, "requested_at", as_of, hours), zones)


def extract_payments(
    payments: DataFrame, as_of: datetime | str | None, hours: int | None
) -> DataFrame:
    """Recent payment documents."""
    return recent(payments.select(*PAYMENT_COLUMNS), "created_at", as_of, hours)
