"""The nightly batch run: extract, stage, clean, gold, audit."""

from __future__ import annotations

import uuid
from collections.abc import Callable
from dataclasses import dataclass, fields
from datetime import datetime, timedelta

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from wayfare import schemas
from wayfare.operators import extract, health, marts, quality, reports, staging
from wayfare.session import broadcast_if_small, configure, planned_bytes, scratch_scope
from wayfare.sources import targets
from wayfare.sources.targets import DatabaseTable, ParquetTable, Table
from wayfare.sources.versions import VersionedTable

BATCH_NAME = "batch"
QUARANTINE_NAME = "quarantine"


@dataclass(frozen=True)
class Sources:
    """The source tables, however they are read."""

    trips: DataFrame
    drivers: DataFrame
    zones: DataFrame
    payments: DataFrame
    # Only checked for quality; no gold table is made of them.
    users: DataFrame | None = None


@dataclass(frozen=True)
class Warehouse:
    """The tables a run writes."""

    stg_trips: Table
    stg_drivers: Table
    stg_payments: Table
    fct_trips: Table
    dim_drivers: Table
    audit: Table
    # Rows that the gate keeps out of gold.
    quarantine: Table | None = None

    @classmethod
    def at(cls, root: str) -> Warehouse:
        """A warehouse of Parquet tables below one folder.

        The loaded tables are versioned: readers see a load as a whole or not at all. The fact
        is kept in a folder for each month, its days in order inside.
        """

        def table(name: str, schema: StructType, **options: object) -> VersionedTable:
            return VersionedTable(f"{root}/{name}", schema, **options)

        return cls(
            table("staging/stg_trips", schemas.STAGED_TRIPS),
            table("staging/stg_drivers", schemas.STAGED_DRIVERS),
            table("staging/stg_payments", schemas.STAGED_PAYMENTS),
            table(
                "gold/fct_trips", schemas.FCT_TRIPS, range_by="trip_date",
                folders=("trip_month", "date_format(trip_date, 'yyyy-MM')"), key="fct_trip_sk",
            ),
            table("gold/dim_drivers", schemas.DIM_DRIVERS),
            ParquetTable(f"{root}/audit/etl_run_log", schemas.AUDIT),
            table("staging/quarantined_payments", schemas.QUARANTINED_PAYMENTS),
        )

    def clean(self, spark: SparkSession) -> None:
        """Delete the files of loads that no reader needs any more."""
        for field in fields(self):
            table = getattr(self, field.name)
            if isinstance(table, VersionedTable):
                table.clean(spark)


def run_batch(
    spark: SparkSession,
    sources: Sources,
    warehouse: Warehouse,
    as_of: datetime,
    lookback_hours: int | None = extract.DEFAULT_LOOKBACK_HOURS,
    incremental: bool = False,
    name: str = BATCH_NAME,
    gate: bool = False,
) -> DataFrame:
    """Load staging, rebuild gold and log the run. Returns the audit row.

    A run that fails is logged as `failed`, and its exception goes on; in a versioned warehouse
    every table then is as it was, or as loaded in full. With `gate`, payments without a trip
    and all but the first of a trip go to quarantine, so that they cannot multiply the fact; a
    second audit row counts them. See `_run` for the rest.
    """
    run_id = uuid.uuid4().hex
    try:
        with scratch_scope(spark):
            loaded, held = _run(spark, sources, warehouse, as_of, lookback_hours, incremental, gate)
    except Exception:
        _log(spark, warehouse.audit, run_id, name, as_of, None, "failed")
        raise
    if gate:
        status = "warning_quarantined" if held else "success"
        _log(spark, warehouse.audit, uuid.uuid4().hex, f"{name}_{QUARANTINE_NAME}", as_of, (held, 0), status)
    row = _log(spark, warehouse.audit, run_id, name, as_of, loaded, "success")
    warehouse.clean(spark)
    return row


def _log(
    spark: SparkSession,
    audit: Table,
    run_id: str,
    name: str,
    as_of: datetime,
    loaded: tuple[int, int] | None,
    status: str,
) -> DataFrame:
    """Add an audit row; returns it as stored, since the end time is a clock."""
    payment_rows, trip_rows = loaded or (None, None)
    counts = spark.range(1).select(
        F.lit(payment_rows).cast("bigint").alias("payment_rows"),
        F.lit(trip_rows).cast("bigint").alias("trip_rows"),
    )
    row = health.audit_row(counts, health.batch_rows_loaded(), F.lit(status), run_id, name, as_of)
    targets.append(row, audit)
    return audit.read(spark).filter(F.col("run_id") == run_id)


def _run(
    spark: SparkSession,
    sources: Sources,
    warehouse: Warehouse,
    as_of: datetime,
    lookback_hours: int | None,
    incremental: bool,
    gate: bool,
) -> tuple[tuple[int, int], int]:
    """Load staging and rebuild gold. Returns the payments and trips loaded, and those held back.

    Staging holds what the look-back covers and gold is rebuilt from it; pass
    `lookback_hours=None` for a full load. With no new payments the staged payments stay.
    `incremental=True` looks back to the start of a day and replaces only the days it covers,
    so earlier days stay in gold; it needs a versioned fact. New rows are numbered after the
    highest key that the fact's commit names, so no stored row is read.
    """
    configure(spark, planned_bytes(sources.trips, sources.payments))
    if incremental and not isinstance(warehouse.fct_trips, VersionedTable):
        raise ValueError("only a versioned fact can be refreshed by day")
    if gate and warehouse.quarantine is None:
        raise ValueError("the gate needs a table for what it holds back")
    # A database reports no table sizes, so the optimiser needs to be told that zones are few.
    zones = broadcast_if_small(sources.zones)
    since = None
    if incremental and lookback_hours is not None:
        start = as_of - timedelta(hours=lookback_hours)
        since = start.replace(hour=0, minute=0, second=0, microsecond=0)
        # Days are replaced as a whole, so trips and payments have one cut-off: a midnight.
        trips = sources.trips.filter(F.col("requested_at") >= extract.moment(since))
        trips = extract.trips_with_zones(trips, zones)
        payments = sources.payments.filter(F.col("created_at") >= extract.moment(since))
        payments = extract.extract_payments(payments, as_of, None)
    else:
        trips = extract.extract_trips(sources.trips, zones, as_of, lookback_hours)
        payments = extract.extract_payments(sources.payments, as_of, lookback_hours)
    drivers = extract.drivers_with_zones(sources.drivers, zones)

    payment_rows = _stage(payments, warehouse.stg_payments, targets.refresh_unless_empty)
    trip_rows = _stage(trips, warehouse.stg_trips, targets.full_refresh)
    _stage(drivers, warehouse.stg_drivers, targets.full_refresh)

    clean_trips = staging.clean_trips(warehouse.stg_trips.read(spark))
    clean_drivers = staging.clean_drivers(warehouse.stg_drivers.read(spark))
    payments, held = warehouse.stg_payments.read(spark), 0
    clean_payments = staging.clean_payments(payments)
    staging.register_views(clean_trips, clean_drivers, clean_payments)
    if gate:
        payments, rejected = quality.first_of_each(payments, "trip_id", ("created_at", "transaction_ref"))
        held = targets.full_refresh(rejected, warehouse.quarantine)
        clean_payments = staging.clean_payments(payments)

    first_key = 1
    if incremental and since is not None:
        first_key += warehouse.fct_trips.last_key(spark)
    fact = marts.fct_trips(clean_trips, clean_payments, as_of, first_key=first_key)
    if isinstance(warehouse.fct_trips, ParquetTable) and warehouse.fct_trips.partition_by:
        fact = targets.in_partition_layout(fact, warehouse.fct_trips.partition_by)
    targets.publish_together(spark, [
        (marts.dim_drivers(clean_drivers, as_of), warehouse.dim_drivers, None),
        (fact, warehouse.fct_trips, since.date() if since else None),
    ])
    return (payment_rows, trip_rows), held


def run_manual_load(spark: SparkSession, sources: Sources, warehouse: Warehouse) -> int:
    """Add all trips, in key order, and all drivers to staging. Returns the rows added.

    Nothing is removed first: a second load doubles the rows, until the next batch run.
    """
    configure(spark, planned_bytes(sources.trips, sources.drivers))
    zones = broadcast_if_small(sources.zones)
    trips = targets.stamp_loaded(extract.trips_with_zones(sources.trips, zones))
    drivers = targets.stamp_loaded(extract.drivers_with_zones(sources.drivers, zones))
    if isinstance(warehouse.stg_trips, DatabaseTable):
        loaded = targets.append(trips, warehouse.stg_trips)
    else:
        with scratch_scope(spark):
            loaded = targets.append_ordered(trips, "trip_id", warehouse.stg_trips)
    return loaded + targets.append(drivers, warehouse.stg_drivers)


def warehouse_counts(spark: SparkSession, warehouse: Warehouse) -> DataFrame:
    """Row counts of staging, cleaned staging and gold."""
    trips, drivers = warehouse.stg_trips.read(spark), warehouse.stg_drivers.read(spark)
    configure(spark, planned_bytes(trips))
    return reports.row_counts({
        "stg_trips": trips,
        "stg_drivers": drivers,
        "stg_payments": warehouse.stg_payments.read(spark),
        "mart_stg_trips": staging.clean_trips(trips),
        "mart_stg_drivers": staging.clean_drivers(drivers),
        "fct_trips": warehouse.fct_trips.read(spark),
        "dim_drivers": warehouse.dim_drivers.read(spark),
    })


def _stage(df: DataFrame, table: Table, load: Callable[[DataFrame, Table], int]) -> int:
    return load(targets.stamp_loaded(df), table)

