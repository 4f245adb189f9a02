"""Quality checks of the sources and reports from stored gold, as jobs."""

from __future__ import annotations

import uuid
from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wayfare import schemas
from wayfare.operators import health, quality, reports
from wayfare.plans.batch import Sources, Warehouse
from wayfare.session import configure, materialise, planned_bytes
from wayfare.sources import targets
from wayfare.sources.targets import Table

QUALITY_NAME = "quality"
# Columns that must have a value, and keys that must not repeat.
REQUIRED = {
    "trips": ("trip_id", "requested_at", "base_fare", "status", "vehicle_type", "payment_method"),
    "drivers": (
        "driver_id", "full_name", "national_id", "phone", "vehicle_type", "vehicle_plate",
    ),
    "zones": ("zone_id", "zone_name", "governorate"),
    "payments": ("trip_id",),
    "users": ("user_id", "full_name", "phone"),
}
UNIQUE = (
    ("trips", "trip_id"), ("drivers", "driver_id"), ("drivers", "national_id"),
    ("users", "user_id"), ("users", "phone"), ("zones", "zone_id"), ("payments", "trip_id"),
)


def quality_counts(sources: Sources) -> DataFrame:
    """(check, table_name, column_name, bad_rows): one row for each check that found something.

    Duplicates are counted as the rows beyond the first of a key. They matter before the trip
    fact is built, since every payment of a repeated trip id is joined to each of its rows.
    Users are checked where they are given.
    """
    trips, drivers, zones, payments = (
        sources.trips, sources.drivers, sources.zones, sources.payments
    )
    tables = {"trips": trips, "drivers": drivers, "zones": zones, "payments": payments}
    references = [
        ("trips.pickup_zone_id", trips, "pickup_zone_id", zones, "zone_id"),
        ("trips.dropoff_zone_id", trips, "dropoff_zone_id", zones, "zone_id"),
        ("trips.driver_id", trips, "driver_id", drivers, "driver_id"),
        ("drivers.registered_zone", drivers, "registered_zone", zones, "zone_id"),
    ]
    if sources.users is not None:
        tables["users"] = sources.users
        references.append(("trips.user_id", trips, "user_id", sources.users, "user_id"))
    duplicates = quality.duplicate_keys(
        [(name, tables[name], column) for name, column in UNIQUE if name in tables]
    ).select("table_name", "column_name", (F.col("copies") - 1).alias("bad_rows"))
    nulls = quality.null_counts(
        {name: (df, REQUIRED[name]) for name, df in tables.items()}
    ).select("table_name", "column_name", F.col("null_rows").alias("bad_rows"))
    unknown = quality.orphans(references)
    parts = F.split("relation", r"\.")
    unknown = unknown.select(
        parts[0].alias("table_name"), parts[1].alias("column_name"),
        F.col("orphan_rows").alias("bad_rows"),
    )
    outside = quality.outside_domain([
        ("trips", trips, "status", schemas.TRIP_STATUSES),
        ("trips", trips, "vehicle_type", schemas.VEHICLE_TYPES),
        ("trips", trips, "payment_method", schemas.PAYMENT_METHODS),
        ("drivers", drivers, "vehicle_type", schemas.VEHICLE_TYPES),
    ]).select("table_name", "column_name", "bad_rows")
    balance = quality.unbalanced_payments(payments).select(
        F.lit("payments").alias("table_name"), F.lit("net_amount_egp").alias("column_name"),
        F.lit(1).cast("bigint").alias("bad_rows"),
    )
    found = {
        "duplicate": duplicates, "null": nulls, "orphan": unknown, "domain": outside,
        "balance": balance,
    }
    frames = [df.select(F.lit(name).alias("check"), "*") for name, df in found.items()]
    every = frames[0]
    for df in frames[1:]:
        every = every.unionByName(df)
    counted = every.groupBy("check", "table_name", "column_name").agg(
        F.sum("bad_rows").alias("bad_rows")
    )
    return counted.filter("bad_rows > 0")


def run_quality(
    spark: SparkSession,
    sources: Sources,
    audit: Table,
    as_of: datetime,
    fail_on: tuple[str, ...] = (),
) -> DataFrame:
    """Check the sources, log the number of bad rows, and return what was found.

    The status is `success` or `warning`; a check named in `fail_on` raises after it was logged.
    """
    configure(spark, planned_bytes(sources.trips, sources.payments))
    found = materialise(quality_counts(sources))
    status = F.when(F.col("bad") > 0, "warning").otherwise("success")
    total = found.agg(F.coalesce(F.sum("bad_rows"), F.lit(0)).alias("bad"))
    row = health.audit_row(total, F.col("bad"), status, uuid.uuid4().hex, QUALITY_NAME, as_of)
    targets.append(row, audit)
    fatal = found.filter(F.col("check").isin(*fail_on)) if fail_on else found.limit(0)
    if not fatal.isEmpty():
        raise ValueError(f"bad rows in the sources: {fatal.collect()}")
    return found


def run_reports(spark: SparkSession, warehouse: Warehouse) -> dict[str, DataFrame]:
    """All reports, from the gold tables as they are stored."""
    fact, drivers = warehouse.fct_trips.read(spark), warehouse.dim_drivers.read(spark)
    configure(spark, planned_bytes(fact, drivers))
    return {
        "kpi_overview": reports.kpi_overview(fact),
        "revenue_trend": reports.revenue_trend(fact),
        "trips_by_governorate": reports.trips_by_governorate(fact),
        "by_vehicle_type": reports.by_vehicle_type(fact),
        "by_payment": reports.by_payment(fact),
        "peak_hours": reports.peak_hours(fact),
        "drivers_by_tier": reports.drivers_by_tier(drivers),
        "drivers_by_geo": reports.drivers_by_geo(drivers),
        "driver_performance": reports.driver_performance(fact, drivers),
        "star_trips_by_tier": reports.star_trips_by_tier(fact, drivers),
    }
