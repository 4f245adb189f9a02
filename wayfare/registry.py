"""The registered queries and, next to each, the SQL that states its result.

Money, shares and means are compared as DOUBLE after exact rounding, counts as BIGINT, and
all times without a zone. Load and processing times are clocks and are not compared.
"""

from __future__ import annotations

from collections.abc import Callable
from datetime import datetime, timedelta
from functools import reduce

from pyspark.errors import PySparkException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import DecimalType, TimestampType
from pyspark.sql.window import Window

from wayfare import schemas
from wayfare.fixtures import Fixture, fixture, with_views
from wayfare.functions import driver_tier, surge_multiplier
from wayfare.operators import extract, health, marts, quality, reports, staging
from wayfare.operators.numbering import surrogate_key
from wayfare.plans.batch import Sources, Warehouse, run_batch
from wayfare.plans.checks import run_reports
from wayfare.plans.stream import run_stream
from wayfare.session import broadcast_if_small, shared_dir
from wayfare.sources import readers, targets
from wayfare.sources.targets import ParquetTable
from wayfare.streaming import progress, sinks, windows
from wayfare.streaming.compaction import compacted_log, fold_closed_days, live_zones, newest_rows

Query = Callable[[SparkSession, str], DataFrame]

AS_OF = "2001-08-01 00:00:00"
LOOKBACK_HOURS = 720
HEALTH_AS_OF = "2024-01-30 00:00:00"
LATE_TOLERANCE = "7 days"

QUERIES: dict[str, Query] = {}
ORACLE: dict[str, str] = {}
# The SQL as written, without the tables it stands on.
STATED: dict[str, str] = {}


# Staging and gold as SQL, for the queries above them.
GOLD = {
    "staged_trips": f"""
SELECT {", ".join(schemas.TRIP_COLUMNS)}, pickup_zone_name, dropoff_zone_name,
  pickup_governorate
FROM trips
JOIN (SELECT zone_id AS pickup_zone_id, zone_name AS pickup_zone_name,
    governorate AS pickup_governorate FROM zones) AS pickup USING (pickup_zone_id)
JOIN (SELECT zone_id AS dropoff_zone_id, zone_name AS dropoff_zone_name FROM zones) AS dropoff
  USING (dropoff_zone_id)""",
    "staged_drivers": """
SELECT driver_id, full_name, vehicle_type, vehicle_plate, rating, active, zone_name, governorate
FROM drivers JOIN zones ON registered_zone = zone_id""",
    "clean_trips": """
SELECT trip_id, user_id, driver_id, pickup_zone_id, dropoff_zone_id,
  LOWER(status) AS trip_status, LOWER(vehicle_type) AS vehicle_type,
  LOWER(payment_method) AS payment_method, requested_at, completed_at, base_fare, surge_fare,
  distance_km, duration_min, cancellation_reason, pickup_zone_name, dropoff_zone_name,
  pickup_governorate,
  CASE WHEN base_fare > 0 THEN ((200 * CAST(surge_fare * 100 AS HUGEINT)
    + CAST(base_fare * 100 AS HUGEINT)) // (2 * CAST(base_fare * 100 AS HUGEINT))) / 100.0
    ELSE 1.0 END AS surge_multiplier,
  CAST(COALESCE(LOWER(status) = 'cancelled', FALSE) AS INT) AS is_cancelled,
  CAST(requested_at AS DATE) AS trip_date, CAST(EXTRACT(HOUR FROM requested_at) AS INT) AS trip_hour
FROM staged_trips WHERE trip_id IS NOT NULL AND base_fare >= 0""",
    "clean_drivers": """
SELECT driver_id, full_name, LOWER(vehicle_type) AS vehicle_type, vehicle_plate, rating, active,
  zone_name, governorate
FROM staged_drivers WHERE driver_id IS NOT NULL""",
    "clean_payments": """
SELECT trip_id, transaction_ref, provider, amount_egp, discount_egp, net_amount_egp, promo_code,
  status AS payment_status, created_at
FROM payments WHERE trip_id IS NOT NULL""",
    "dim": """
SELECT driver_id, full_name, vehicle_type, vehicle_plate, rating, active AS is_active, zone_name,
  governorate, CASE WHEN rating >= 4.8 THEN 'Gold' WHEN rating >= 4.3 THEN 'Silver'
    ELSE 'Bronze' END AS driver_tier
FROM clean_drivers""",
    "fact": """
SELECT t.*, p.net_amount_egp, p.provider AS payment_provider, p.promo_code, p.discount_egp
FROM clean_trips t LEFT JOIN clean_payments p ON t.trip_id = p.trip_id""",
    "zone_log": """
SELECT TIME_BUCKET(INTERVAL 5 MINUTE, event_time) AS window_start,
  TIME_BUCKET(INTERVAL 5 MINUTE, event_time) + INTERVAL 5 MINUTE AS window_end, zone_id,
  COUNT(trip_id) AS trip_count,
  CAST(SUM(CAST(fare_egp AS DECIMAL(18,2))) AS DOUBLE) AS total_revenue_egp,
  CAST((2 * CAST(SUM(CAST(fare_egp AS DECIMAL(18,2))) * 100 AS HUGEINT) + COUNT(fare_egp))
    // (2 * COUNT(fare_egp)) AS DOUBLE) / 100 AS avg_fare_egp,
  CAST((2 * CAST(SUM(CAST(distance_km AS DECIMAL(18,2))) * 100 AS HUGEINT) + COUNT(distance_km))
    // (2 * COUNT(distance_km)) AS DOUBLE) / 100 AS avg_distance_km,
  CAST(0 AS BIGINT) AS unusable_values
FROM trip_events WHERE event_type = 'trip_completed' AND event_time IS NOT NULL
GROUP BY 1, 2, 3""",
}

_TRIPS = "COUNT(*) AS trips"
_REVENUE = (
    "CAST(COALESCE(SUM(CASE WHEN trip_status = 'completed' THEN surge_fare END), 0) AS DOUBLE)"
    " AS revenue_egp"
)


def _mean(column: str) -> str:
    """SQL for the mean of a two-decimal column >= 0, rounded half up in whole numbers."""
    return (
        f"CAST((2 * CAST(SUM({column}) * 100 AS HUGEINT) + COUNT({column}))"
        f" // (2 * NULLIF(COUNT({column}), 0)) AS DOUBLE) / 100"
    )


def _rate(part: str, whole: str) -> str:
    """SQL for part / whole to four decimals, rounded half up in whole numbers."""
    return (
        f"CAST((20000 * CAST({part} AS HUGEINT) + ({whole}))"
        f" // (2 * NULLIF({whole}, 0)) AS DOUBLE) / 10000"
    )


def _comparable(df: DataFrame) -> DataFrame:
    """Decimals as doubles and zoned times without a zone."""
    columns = []
    for field in df.schema:
        column = F.col(field.name)
        if isinstance(field.dataType, DecimalType):
            column = column.cast("double").alias(field.name)
        elif isinstance(field.dataType, TimestampType):
            column = column.cast("timestamp_ntz").alias(field.name)
        columns.append(column)
    return df.select(columns)


def query(sql: str, name: str = "") -> Callable[[Callable[[Fixture], DataFrame]], Query]:
    """Register a query over a fixture, by default under its function's name, with its SQL."""

    def register(build: Callable[[Fixture], DataFrame]) -> Query:
        def run(spark: SparkSession, folder: str) -> DataFrame:
            return _comparable(build(fixture(spark, folder)))

        QUERIES[name or build.__name__] = run
        STATED[name or build.__name__] = sql
        ORACLE[name or build.__name__] = with_views(sql, GOLD)
        return run

    return register


def _as_double(*columns: str) -> str:
    return ", ".join(f"CAST({c} AS DOUBLE) AS {c}" for c in columns)


# --- shared inputs -------------------------------------------------------------------------


def _staged_trips(fx: Fixture) -> DataFrame:
    return extract.trips_with_zones(fx.trips, broadcast_if_small(fx.zones))


def _staged_drivers(fx: Fixture) -> DataFrame:
    return extract.drivers_with_zones(fx.drivers, fx.zones)


def _clean_trips(fx: Fixture) -> DataFrame:
    return staging.clean_trips(_staged_trips(fx))


def _clean_payments(fx: Fixture) -> DataFrame:
    return staging.clean_payments(fx.payments)


def _dim(fx: Fixture) -> DataFrame:
    return marts.dim_drivers(staging.clean_drivers(_staged_drivers(fx)), AS_OF)


def _fact(fx: Fixture) -> DataFrame:
    return marts.fact_rows(_clean_trips(fx), _clean_payments(fx))


def _stored(df: DataFrame) -> ParquetTable:
    return ParquetTable(shared_dir(df.sparkSession), df.schema)


def _window_log(fx: Fixture) -> DataFrame:
    """A window log in which each window was processed the moment it ended."""
    log = windows.zone_windows(fx.trip_events)
    return log.withColumn("processed_at", F.col("window_end"))


# --- sources and loads ---------------------------------------------------------------------

_TRIP_EXTRACT = (
    "trip_id, user_id, driver_id, pickup_zone_id, dropoff_zone_id, status, vehicle_type,"
    " payment_method, requested_at, completed_at, "
    + _as_double("base_fare", "surge_fare", "distance_km")
    + ", duration_min, cancellation_reason"
)
_PAYMENT_EXTRACT = (
    "trip_id, transaction_ref, provider, "
    + _as_double("amount_egp", "discount_egp", "net_amount_egp")
    + ", promo_code, status, created_at"
)


@query(f"SELECT {_TRIP_EXTRACT} FROM trips")
def scan_trips(fx: Fixture) -> DataFrame:
    copy = _stored(fx.trips)
    copy.save(fx.trips, "overwrite")
    scan = readers.read_columnar(fx.spark, copy.path, schemas.TRIPS)
    return schemas.conform(scan, schemas.TRIPS).select(*schemas.TRIP_COLUMNS)


@query(f"SELECT {_PAYMENT_EXTRACT} FROM payments")
def scan_payments(fx: Fixture) -> DataFrame:
    metadata = F.struct(F.lit("00").alias("response_code")).alias("provider_metadata")
    path = shared_dir(fx.spark)
    fx.payments.select("*", metadata).write.json(path)
    return readers.read_documents(fx.spark, path)


@query(f"SELECT {_PAYMENT_EXTRACT} FROM payments")
def load_full_refresh(fx: Fixture) -> DataFrame:
    table = _stored(fx.payments)
    targets.append(fx.payments, table)
    targets.full_refresh(fx.payments, table)
    return table.read(fx.spark)


@query(f"SELECT {_PAYMENT_EXTRACT} FROM payments")
def load_empty_keeps_previous(fx: Fixture) -> DataFrame:
    table = _stored(fx.payments)
    targets.full_refresh(fx.payments, table)
    nothing_new = extract.recent(fx.payments, "created_at", "2101-01-01 00:00:00", 24)
    targets.refresh_unless_empty(nothing_new, table)
    return table.read(fx.spark)


@query("""
SELECT driver_id, full_name, vehicle_type, vehicle_plate, CAST(rating AS DOUBLE) AS rating,
  active, zone_name, governorate FROM staged_drivers
UNION ALL
SELECT driver_id, full_name, vehicle_type, vehicle_plate, CAST(rating AS DOUBLE) AS rating,
  active, zone_name, governorate FROM staged_drivers""")
def load_append_twice(fx: Fixture) -> DataFrame:
    staged = _staged_drivers(fx)
    table = _stored(staged)
    targets.append(staged, table)
    targets.append(staged, table)
    return table.read(fx.spark)


@query(f"SELECT {_TRIP_EXTRACT}, pickup_zone_name, dropoff_zone_name, pickup_governorate"
       " FROM staged_trips")
def load_ordered(fx: Fixture) -> DataFrame:
    staged = _staged_trips(fx)
    table = _stored(staged)
    targets.append_ordered(staged, "trip_id", table)
    return table.read(fx.spark)


# --- extraction and cleaning ---------------------------------------------------------------


@query(f"SELECT {_TRIP_EXTRACT}, pickup_zone_name, dropoff_zone_name, pickup_governorate"
       " FROM staged_trips")
def trips_with_zones(fx: Fixture) -> DataFrame:
    return _staged_trips(fx)


@query("""
SELECT driver_id, full_name, vehicle_type, vehicle_plate, CAST(rating AS DOUBLE) AS rating,
  active, zone_name, governorate FROM staged_drivers""")
def drivers_with_zones(fx: Fixture) -> DataFrame:
    return _staged_drivers(fx)


@query(f"""
SELECT {_TRIP_EXTRACT}, pickup_zone_name, dropoff_zone_name, pickup_governorate
FROM staged_trips
WHERE requested_at >= TIMESTAMP '{AS_OF}' - INTERVAL {LOOKBACK_HOURS} HOUR""")
def lookback_trips(fx: Fixture) -> DataFrame:
    return extract.extract_trips(fx.trips, fx.zones, AS_OF, LOOKBACK_HOURS)


@query(f"""
SELECT {_PAYMENT_EXTRACT} FROM payments
WHERE created_at >= TIMESTAMP '{AS_OF}' - INTERVAL {LOOKBACK_HOURS} HOUR""")
def lookback_payments(fx: Fixture) -> DataFrame:
    return extract.extract_payments(fx.payments, AS_OF, LOOKBACK_HOURS)


_CLEAN_TRIP = (
    "trip_id, user_id, driver_id, pickup_zone_id, dropoff_zone_id, trip_status, vehicle_type,"
    " payment_method, requested_at, completed_at, "
    + _as_double("base_fare", "surge_fare", "distance_km")
    + ", duration_min, cancellation_reason, pickup_zone_name, dropoff_zone_name,"
    " pickup_governorate, CAST(surge_multiplier AS DOUBLE) AS surge_multiplier, is_cancelled,"
    " trip_date, trip_hour"
)


@query(f"SELECT {_CLEAN_TRIP} FROM clean_trips")
def stg_trips_clean(fx: Fixture) -> DataFrame:
    return _clean_trips(fx)


@query("""
SELECT driver_id, full_name, vehicle_type, vehicle_plate, CAST(rating AS DOUBLE) AS rating,
  active, zone_name, governorate FROM clean_drivers""")
def stg_drivers_clean(fx: Fixture) -> DataFrame:
    return staging.clean_drivers(_staged_drivers(fx))


@query(f"""
SELECT trip_id, transaction_ref, provider,
  {_as_double("amount_egp", "discount_egp", "net_amount_egp")},
  promo_code, payment_status, created_at FROM clean_payments""")
def stg_payments_clean(fx: Fixture) -> DataFrame:
    return _clean_payments(fx)


@query("""
SELECT trip_id, CAST(base_fare AS DOUBLE) AS base_fare, CAST(surge_fare AS DOUBLE) AS surge_fare,
  CAST(CASE WHEN base_fare > 0 THEN ((200 * CAST(surge_fare * 100 AS HUGEINT)
    + CAST(base_fare * 100 AS HUGEINT)) // (2 * CAST(base_fare * 100 AS HUGEINT))) / 100.0
    ELSE 1.0 END AS DOUBLE) AS surge_multiplier
FROM trips""", name="surge_multiplier")
def multiplied_trips(fx: Fixture) -> DataFrame:
    multiplier = surge_multiplier(F.col("base_fare"), F.col("surge_fare"))
    return fx.trips.select(
        "trip_id", "base_fare", "surge_fare", multiplier.alias("surge_multiplier")
    )


@query("""
SELECT driver_id, CAST(rating AS DOUBLE) AS rating,
  CASE WHEN rating >= 4.8 THEN 'Gold' WHEN rating >= 4.3 THEN 'Silver' ELSE 'Bronze' END
    AS driver_tier
FROM drivers""", name="driver_tier")
def tiered_drivers(fx: Fixture) -> DataFrame:
    return fx.drivers.select(
        "driver_id", "rating", driver_tier(F.col("rating")).alias("driver_tier")
    )


# --- gold ----------------------------------------------------------------------------------


@query("""
SELECT driver_id, full_name, vehicle_type, vehicle_plate, CAST(rating AS DOUBLE) AS rating,
  is_active, zone_name, governorate, driver_tier FROM dim""")
def dim_drivers(fx: Fixture) -> DataFrame:
    return _dim(fx).drop("_dbt_loaded_at")


_FACT = (
    "trip_id, user_id, driver_id, pickup_zone_id, dropoff_zone_id, trip_status, vehicle_type,"
    " payment_method, trip_date, trip_hour, pickup_zone_name, dropoff_zone_name,"
    " pickup_governorate, "
    + _as_double("base_fare", "surge_fare", "surge_multiplier", "distance_km")
    + ", duration_min, is_cancelled, "
    + _as_double("net_amount_egp", "discount_egp")
    + ", payment_provider, promo_code"
)


@query(f"SELECT ROW_NUMBER() OVER (ORDER BY trip_id) AS fct_trip_sk, {_FACT} FROM fact")
def fct_trips(fx: Fixture) -> DataFrame:
    fact = marts.fct_trips(_clean_trips(fx), _clean_payments(fx), AS_OF)
    return fact.drop("_dbt_loaded_at")


@query(f"""
SELECT ROW_NUMBER() OVER (ORDER BY trip_id, requested_at NULLS FIRST, user_id NULLS FIRST,
  driver_id NULLS FIRST, net_amount_egp NULLS FIRST, payment_provider NULLS FIRST,
  promo_code NULLS FIRST, discount_egp NULLS FIRST) AS fct_trip_sk, {_FACT}
FROM (SELECT t.*, p.net_amount_egp, p.provider AS payment_provider, p.promo_code, p.discount_egp
  FROM clean_trips t LEFT JOIN payments_dirty p ON t.trip_id = p.trip_id) f""")
def fct_trips_repeated_payments(fx: Fixture) -> DataFrame:
    payments = staging.clean_payments(fx.payments_dirty)
    return marts.fct_trips(_clean_trips(fx), payments, AS_OF).drop("_dbt_loaded_at")


@query("""
SELECT ROW_NUMBER() OVER (ORDER BY trip_id NULLS LAST, user_id, requested_at) AS trip_sk,
  trip_id, user_id, requested_at FROM trips""", name="surrogate_key")
def numbered_trips(fx: Fixture) -> DataFrame:
    rows = fx.trips.select("trip_id", "user_id", "requested_at")
    return surrogate_key(rows, "trip_id", "trip_sk", ("user_id", "requested_at"))


# One trip id holds a third of all trips, and rows that tie on the first column as well.
_HOT_TRIPS = """
SELECT CASE WHEN user_id % 3 = 0 THEN 77 ELSE trip_id END AS trip_id, trip_id AS first_id,
  user_id % 10 AS user_group, requested_at FROM trips"""


@query(f"""
SELECT *, ROW_NUMBER() OVER (
  ORDER BY trip_id NULLS LAST, user_group, requested_at, first_id NULLS FIRST) AS trip_sk
FROM ({_HOT_TRIPS})""")
def surrogate_key_hot(fx: Fixture) -> DataFrame:
    """With a limit that sends the repeated key through the path for heavy buckets."""
    rows = fx.trips.select(
        F.when(F.col("user_id") % 3 == 0, 77).otherwise(F.col("trip_id")).alias("trip_id"),
        F.col("trip_id").alias("first_id"), (F.col("user_id") % 10).alias("user_group"),
        "requested_at",
    )
    ties = ("user_group", "requested_at", "first_id")
    return surrogate_key(rows, "trip_id", "trip_sk", ties, row_limit=200)


_MERGED = "(SELECT * REPLACE (CASE WHEN trip_id % 50 = 0 THEN 50 ELSE trip_id END AS trip_id) FROM {})"


@query(f"""
SELECT * EXCLUDE (requested_at), ROW_NUMBER() OVER (ORDER BY trip_id, requested_at, user_id, driver_id,
    net_amount_egp NULLS FIRST, payment_provider NULLS FIRST, promo_code NULLS FIRST,
    discount_egp NULLS FIRST) AS fct_trip_sk
FROM (
  SELECT t.trip_id, user_id, driver_id, requested_at, provider AS payment_provider, promo_code,
    {_as_double("net_amount_egp", "discount_egp")}
  FROM {_MERGED.format("clean_trips")} t LEFT JOIN {_MERGED.format("clean_payments")} p
    ON t.trip_id = p.trip_id)""")
def fct_trips_hot(fx: Fixture) -> DataFrame:
    """One trip id stands for a fiftieth of the trips and of the payments: joined in cells."""

    def merged(df: DataFrame) -> DataFrame:
        hot = F.when(F.col("trip_id") % 50 == 0, 50).otherwise(F.col("trip_id"))
        return df.withColumn("trip_id", hot.cast(df.schema["trip_id"].dataType))

    fact = marts.fct_trips(
        merged(_clean_trips(fx)), merged(_clean_payments(fx)), AS_OF, row_limit=300
    )
    return fact.select(
        "trip_id", "user_id", "driver_id", "net_amount_egp", "payment_provider", "promo_code",
        "discount_egp", "fct_trip_sk",
    )



@query(f"SELECT {_FACT}, STRFTIME(trip_date, '%Y-%m') AS trip_month FROM fact")
def gold_by_month(fx: Fixture) -> DataFrame:
    fact = _fact(fx).withColumn("trip_month", F.date_format("trip_date", "yyyy-MM"))
    table = ParquetTable(shared_dir(fx.spark), fact.schema, "trip_month")
    targets.full_refresh(targets.in_partition_layout(fact, "trip_month"), table)
    return table.read(fx.spark)


# --- reports -------------------------------------------------------------------------------


@query(f"""
SELECT {_TRIPS}, COUNT(*) FILTER (WHERE trip_status = 'completed') AS completed_trips,
  CAST(COALESCE(SUM(is_cancelled), 0) AS BIGINT) AS cancelled_trips,
  {_rate("SUM(is_cancelled)", "COUNT(*)")} AS cancel_rate, {_REVENUE},
  {_mean("distance_km")} AS avg_distance_km
FROM fact""")
def kpi_overview(fx: Fixture) -> DataFrame:
    return reports.kpi_overview(_fact(fx))


@query(f"SELECT trip_date, {_TRIPS}, {_REVENUE} FROM fact GROUP BY trip_date")
def revenue_trend(fx: Fixture) -> DataFrame:
    return reports.revenue_trend(_fact(fx))


@query(f"SELECT pickup_governorate, {_TRIPS}, {_REVENUE} FROM fact GROUP BY pickup_governorate")
def trips_by_governorate(fx: Fixture) -> DataFrame:
    return reports.trips_by_governorate(_fact(fx))


@query(f"""
SELECT vehicle_type, {_TRIPS}, {_REVENUE},
  {_mean("CAST(surge_multiplier AS DECIMAL(13,2))")} AS avg_surge_multiplier
FROM fact GROUP BY vehicle_type""")
def by_vehicle_type(fx: Fixture) -> DataFrame:
    return reports.by_vehicle_type(_fact(fx))


@query(f"""
SELECT payment_method, payment_provider, {_TRIPS},
  CAST(SUM(net_amount_egp) AS DOUBLE) AS net_amount_egp
FROM fact GROUP BY payment_method, payment_provider""")
def by_payment(fx: Fixture) -> DataFrame:
    return reports.by_payment(_fact(fx))


@query(f"SELECT trip_hour, {_TRIPS} FROM fact GROUP BY trip_hour")
def peak_hours(fx: Fixture) -> DataFrame:
    return reports.peak_hours(_fact(fx))


@query(f"""
SELECT driver_tier, COUNT(*) AS drivers, {_mean("rating")} AS avg_rating
FROM dim GROUP BY driver_tier""")
def drivers_by_tier(fx: Fixture) -> DataFrame:
    return reports.drivers_by_tier(_dim(fx))


@query("""
SELECT governorate, vehicle_type, COUNT(*) AS drivers FROM dim
GROUP BY governorate, vehicle_type""")
def drivers_by_geo(fx: Fixture) -> DataFrame:
    return reports.drivers_by_geo(_dim(fx))


@query(f"""
SELECT f.driver_id, d.full_name, d.driver_tier, {_TRIPS}, {_REVENUE},
  {_rate("SUM(is_cancelled)", "COUNT(*)")} AS cancel_rate
FROM fact f LEFT JOIN dim d ON f.driver_id = d.driver_id
GROUP BY f.driver_id, d.full_name, d.driver_tier""")
def driver_performance(fx: Fixture) -> DataFrame:
    return reports.driver_performance(_fact(fx), _dim(fx))


@query(f"""
SELECT d.driver_tier, {_TRIPS}, {_REVENUE}
FROM fact f LEFT JOIN dim d ON f.driver_id = d.driver_id GROUP BY d.driver_tier""")
def star_trips_by_tier(fx: Fixture) -> DataFrame:
    return reports.star_trips_by_tier(_fact(fx), _dim(fx))


# Key columns and measures of every report.
_REPORTS = {
    "kpi_overview": (
        (), ("trips", "completed_trips", "cancelled_trips", "cancel_rate", "revenue_egp", "avg_distance_km"),
    ),
    "revenue_trend": (("trip_date",), ("trips", "revenue_egp")),
    "trips_by_governorate": (("pickup_governorate",), ("trips", "revenue_egp")),
    "by_vehicle_type": (("vehicle_type",), ("trips", "revenue_egp", "avg_surge_multiplier")),
    "by_payment": (("payment_method", "payment_provider"), ("trips", "net_amount_egp")),
    "peak_hours": (("trip_hour",), ("trips",)),
    "drivers_by_tier": (("driver_tier",), ("drivers", "avg_rating")),
    "drivers_by_geo": (("governorate", "vehicle_type"), ("drivers",)),
    "driver_performance": (
        ("driver_id", "full_name", "driver_tier"), ("trips", "revenue_egp", "cancel_rate"),
    ),
    "star_trips_by_tier": (("driver_tier",), ("trips", "revenue_egp")),
}


def _key_sql(keys: tuple[str, ...]) -> str:
    return " || '|' || ".join(f"COALESCE(CAST({key} AS VARCHAR), '-')" for key in keys) or "''"


@query("\nUNION ALL ".join(
    f"SELECT '{name}' AS report, {_key_sql(keys)} AS keys, '{measure}' AS measure,"
    f" CAST({measure} AS DOUBLE) AS value FROM ({STATED[name]})"
    for name, (keys, measures) in _REPORTS.items() for measure in measures
))
def reports_from_gold(fx: Fixture) -> DataFrame:
    """All ten reports, from gold that a full batch run stored: one row for each figure."""
    warehouse = Warehouse.at(shared_dir(fx.spark))
    sources = Sources(fx.trips, fx.drivers, fx.zones, fx.payments)
    run_batch(fx.spark, sources, warehouse, datetime.fromisoformat(AS_OF), lookback_hours=None)
    found = run_reports(fx.spark, warehouse)
    rows = []
    for name, (keys, measures) in _REPORTS.items():
        parts = [F.coalesce(F.col(key).cast("string"), F.lit("-")) for key in keys]
        label = F.concat_ws("|", *parts).alias("keys")
        values = [F.col(measure).cast("double").alias(measure) for measure in measures]
        report = found[name].select(F.lit(name).alias("report"), label, *values)
        rows.append(report.unpivot(["report", "keys"], list(measures), "measure", "value"))
    return reduce(DataFrame.unionByName, rows)


_FACT_KEYS = "trip_id, user_id, driver_id, pickup_governorate, trip_date, payment_provider, promo_code"
# The look-back of 30 days from one o'clock, back to midnight.
_SINCE = "2001-07-02"


@query(f"""
SELECT {_FACT_KEYS}, {_as_double("base_fare", "net_amount_egp")}, CAST(1 AS BIGINT) AS key_copies,
  CASE WHEN trip_date >= DATE '{_SINCE}' THEN 'tuk_tuk' ELSE vehicle_type END AS vehicle_type
FROM fact""")
def gold_incremental(fx: Fixture) -> DataFrame:
    """A full load, then one of the last 30 days, in which the vehicle of every trip has changed.

    Days before stay as they were, and no key is given twice.
    """
    warehouse = Warehouse.at(shared_dir(fx.spark))
    as_of = datetime.fromisoformat(AS_OF).replace(hour=1)
    sources = Sources(fx.trips, fx.drivers, fx.zones, fx.payments)
    run_batch(fx.spark, sources, warehouse, as_of, lookback_hours=None)
    changed = Sources(
        fx.trips.withColumn("vehicle_type", F.lit("tuk_tuk")), fx.drivers, fx.zones, fx.payments
    )
    run_batch(fx.spark, changed, warehouse, as_of, lookback_hours=LOOKBACK_HOURS, incremental=True)
    fact = warehouse.fct_trips.read(fx.spark)
    copies = F.count(F.lit(1)).over(Window.partitionBy("fct_trip_sk")).alias("key_copies")
    columns = [c.strip() for c in _FACT_KEYS.split(",")]
    return fact.select(*columns, "base_fare", "net_amount_egp", copies, "vehicle_type")


@query(f"""
SELECT load, {_FACT_KEYS}, {_as_double("base_fare", "surge_fare", "net_amount_egp")}
FROM fact, (VALUES ('full'), ('incremental')) AS loads(load)""")
def load_failed_keeps_previous(fx: Fixture) -> DataFrame:
    """A full load, then loads of all days and of the last ones that fail midway: the fact stays."""
    warehouse = Warehouse.at(shared_dir(fx.spark))
    as_of = datetime.fromisoformat(AS_OF)
    run_batch(
        fx.spark, Sources(fx.trips, fx.drivers, fx.zones, fx.payments), warehouse, as_of, lookback_hours=None
    )
    last = fx.trips.agg(F.max("trip_id")).first()[0]
    broken = F.when(F.col("trip_id") == last, F.raise_error(F.lit("source gone"))).otherwise(F.col("surge_fare"))
    trips = fx.trips.withColumns({
        "surge_fare": broken.cast("decimal(10,2)"), "requested_at": F.lit(AS_OF).cast("timestamp_ntz"),
        "base_fare": F.lit(1).cast("decimal(10,2)"), "pickup_zone_id": F.lit(1), "dropoff_zone_id": F.lit(1),
    })
    sources = Sources(trips, fx.drivers, fx.zones, fx.payments)
    seen = []
    for load, hours in (("full", None), ("incremental", LOOKBACK_HOURS)):
        try:
            run_batch(fx.spark, sources, warehouse, as_of, hours, incremental=hours is not None)
        except PySparkException:
            fact = warehouse.fct_trips.read(fx.spark)
            columns = [c.strip() for c in _FACT_KEYS.split(",")]
            seen.append(fact.select(F.lit(load).alias("load"), *columns, "base_fare", "surge_fare", "net_amount_egp"))
        else:
            raise RuntimeError("the load should have failed")
    return reduce(DataFrame.unionByName, seen)


@query(f"""
SELECT trip_id, transaction_ref, provider, {_as_double("net_amount_egp")}, created_at,
  CASE WHEN trip_id IS NULL THEN 'missing_key' ELSE 'repeated_key' END AS reason
FROM payments_dirty
QUALIFY trip_id IS NULL OR ROW_NUMBER() OVER (PARTITION BY trip_id ORDER BY created_at, transaction_ref) > 1""")
def quarantined_payments(fx: Fixture) -> DataFrame:
    """What the gate of a batch run holds back: payments that would multiply the fact."""
    warehouse = Warehouse.at(shared_dir(fx.spark))
    sources = Sources(fx.trips, fx.drivers, fx.zones, fx.payments_dirty)
    run_batch(
        fx.spark, sources, warehouse, datetime.fromisoformat(AS_OF), lookback_hours=None, gate=True
    )
    return warehouse.quarantine.read(fx.spark).select(
        "trip_id", "transaction_ref", "provider", "net_amount_egp", "created_at", "reason"
    )


@query("""
SELECT 'stg_trips' AS table_name, COUNT(*) AS row_count FROM staged_trips
UNION ALL SELECT 'stg_drivers', COUNT(*) FROM staged_drivers
UNION ALL SELECT 'stg_payments', COUNT(*) FROM payments
UNION ALL SELECT 'mart_stg_trips', COUNT(*) FROM clean_trips
UNION ALL SELECT 'mart_stg_drivers', COUNT(*) FROM clean_drivers
UNION ALL SELECT 'fct_trips', COUNT(*) FROM fact
UNION ALL SELECT 'dim_drivers', COUNT(*) FROM dim""")
def row_count_report(fx: Fixture) -> DataFrame:
    trips, drivers = _staged_trips(fx), _staged_drivers(fx)
    clean_drivers = staging.clean_drivers(drivers)
    return reports.row_counts({
        "stg_trips": trips,
        "stg_drivers": drivers,
        "stg_payments": fx.payments,
        "mart_stg_trips": staging.clean_trips(trips),
        "mart_stg_drivers": clean_drivers,
        "fct_trips": _fact(fx),
        "dim_drivers": marts.dim_drivers(clean_drivers, AS_OF),
    })


# --- data quality --------------------------------------------------------------------------

_REQUIRED = {
    "trips": ("status", "vehicle_type", "payment_method"),
    "zones": ("zone_name", "governorate"),
    "drivers": ("full_name", "national_id", "phone", "vehicle_type", "vehicle_plate"),
    "users": ("full_name", "phone"),
}
_TABLES = {table: f"{table}_dirty" for table in _REQUIRED}


@query("\nUNION ALL ".join(
    f"SELECT '{table}' AS table_name, '{column}' AS column_name,"
    f" COUNT(*) FILTER (WHERE {column} IS NULL) AS null_rows FROM {_TABLES.get(table, table)}"
    for table, columns in _REQUIRED.items() for column in columns
))
def dq_nulls(fx: Fixture) -> DataFrame:
    return quality.null_counts({
        table: (fx[_TABLES.get(table, table)], columns) for table, columns in _REQUIRED.items()
    })


_UNIQUE = (
    ("trips", "trips_dirty", "trip_id"),
    ("drivers", "drivers_dirty", "driver_id"),
    ("drivers", "drivers_dirty", "national_id"),
    ("users", "users_dirty", "user_id"),
    ("users", "users_dirty", "phone"),
    ("zones", "zones_dirty", "zone_id"),
    ("payments", "payments_dirty", "trip_id"),
)


@query("\nUNION ALL ".join(
    f"SELECT '{name}' AS table_name, '{column}' AS column_name,"
    f" CAST({column} AS VARCHAR) AS key_value, COUNT(*) AS copies FROM {table}"
    f" WHERE {column} IS NOT NULL GROUP BY {column} HAVING COUNT(*) > 1"
    for name, table, column in _UNIQUE
))
def dq_duplicates(fx: Fixture) -> DataFrame:
    return quality.duplicate_keys([(name, fx[table], column) for name, table, column in _UNIQUE])


_REFERENCES = (
    ("trips.pickup_zone_id", "trips_dirty", "pickup_zone_id", "zones", "zone_id"),
    ("trips.dropoff_zone_id", "trips_dirty", "dropoff_zone_id", "zones", "zone_id"),
    ("trips.driver_id", "trips_dirty", "driver_id", "drivers", "driver_id"),
    ("trips.user_id", "trips_dirty", "user_id", "users", "user_id"),
    ("drivers.registered_zone", "drivers", "registered_zone", "zones", "zone_id"),
)


@query("\nUNION ALL ".join(
    f"SELECT '{name}' AS relation, CAST({column} AS BIGINT) AS key_value,"
    f" COUNT(*) AS orphan_rows FROM {table} WHERE {column} IS NOT NULL"
    f" AND NOT EXISTS (SELECT 1 FROM {other} o WHERE o.{key} = {table}.{column})"
    f" GROUP BY {column}"
    for name, table, column, other, key in _REFERENCES
))
def dq_orphans(fx: Fixture) -> DataFrame:
    return quality.orphans([
        (name, fx[table], column, fx[other], key)
        for name, table, column, other, key in _REFERENCES
    ])


_DOMAINS = (
    ("trips", "trips_dirty", "status", schemas.TRIP_STATUSES),
    ("trips", "trips_dirty", "vehicle_type", schemas.VEHICLE_TYPES),
    ("trips", "trips_dirty", "payment_method", schemas.PAYMENT_METHODS),
    ("drivers", "drivers_dirty", "vehicle_type", schemas.VEHICLE_TYPES),
)


@query("\nUNION ALL ".join(
    f"SELECT '{name}' AS table_name, '{column}' AS column_name, LOWER({column}) AS bad_value,"
    f" COUNT(*) AS bad_rows FROM {table} WHERE LOWER({column}) NOT IN {allowed}"
    f" GROUP BY LOWER({column})"
    for name, table, column, allowed in _DOMAINS
))
def dq_domains(fx: Fixture) -> DataFrame:
    return quality.outside_domain([
        (name, fx[table], column, allowed) for name, table, column, allowed in _DOMAINS
    ])


@query(f"""
SELECT trip_id, {_as_double("amount_egp", "discount_egp", "net_amount_egp")}, promo_code,
  net_amount_egp <> amount_egp - discount_egp AS wrong_net,
  (discount_egp = 0) <> (promo_code IS NULL) AS wrong_promo
FROM payments_dirty
WHERE net_amount_egp <> amount_egp - discount_egp
  OR (discount_egp = 0) <> (promo_code IS NULL)""")
def dq_payment_balance(fx: Fixture) -> DataFrame:
    return quality.unbalanced_payments(fx.payments_dirty)


# --- event stream --------------------------------------------------------------------------

_WINDOW = (
    "window_start, window_end, zone_id, trip_count, total_revenue_egp, avg_fare_egp,"
    " avg_distance_km, unusable_values"
)


class _Arrivals:
    """The whole event table, landing as broker records in two waves.

    The stream runs after each wave and resumes from its checkpoint in between, so windows
    that both waves touch are written twice.
    """

    def __init__(self, fx: Fixture) -> None:
        self.spark = fx.spark
        self.records = fx.records()
        self.landing, self.checkpoint, self.log = (shared_dir(fx.spark) for _ in range(3))

    def land(self, second_wave: bool, in_second: str) -> None:
        wave = self.records.filter(F.expr(in_second) == F.lit(second_wave))
        wave.drop("event_id").write.mode("append").parquet(self.landing)

    def stream(self) -> DataFrame:
        return readers.stream_landing(self.spark, self.landing)

    def window_log(self, in_second: str, late_tolerance: str | None = None) -> DataFrame:
        for second_wave in (False, True):
            self.wave(second_wave, in_second, late_tolerance)
        return sinks.read_window_log(self.spark, self.log)

    def start(
        self, second_wave: bool, in_second: str, late_tolerance: str | None = None
    ) -> StreamingQuery:
        self.land(second_wave, in_second)
        return run_stream(
            self.stream(), self.log, self.checkpoint, late_tolerance, trigger_seconds=None
        )

    def wave(self, second_wave: bool, in_second: str, late_tolerance: str | None = None) -> None:
        self.start(second_wave, in_second, late_tolerance).awaitTermination()


# Which events arrive in the second wave; all others arrive in the first.
ODD = "event_id % 2 = 1"
EVERY_TENTH = "event_id % 10 = 3"


@query(f"SELECT {_WINDOW} FROM zone_log")
def zone_windows(fx: Fixture) -> DataFrame:
    return windows.zone_windows(fx.trip_events).drop("processed_at")


@query("""
SELECT event_type, trip_id, driver_id, fare_egp, distance_km, zone_id, broker_time AS kafka_ts,
  event_time FROM trip_events""")
def stream_parsed_events(fx: Fixture) -> DataFrame:
    arrivals = _Arrivals(fx)
    for second_wave in (False, True):
        arrivals.land(second_wave, ODD)
        events = windows.parse_events(arrivals.stream())
        sinks.append_events(events, arrivals.log, arrivals.checkpoint).awaitTermination()
    stored = fx.spark.read.schema(events.schema).parquet(arrivals.log)
    return stored.drop("timestamp")


@query(f"SELECT {_WINDOW} FROM zone_log")
def stream_zone_windows(fx: Fixture) -> DataFrame:
    log = _Arrivals(fx).window_log(ODD)
    return windows.newest_versions(log).drop("processed_at")


@query(GOLD["zone_log"].replace(
    "WHERE",
    f"""WHERE (event_id % 10 <> 3 OR TIME_BUCKET(INTERVAL 5 MINUTE, event_time)
    + INTERVAL 5 MINUTE > (SELECT DATE_TRUNC('millisecond', MAX(event_time))
      - INTERVAL {LATE_TOLERANCE} FROM trip_events
      WHERE event_id % 10 <> 3 AND event_type = 'trip_completed')) AND""",
))
def stream_late_data(fx: Fixture) -> DataFrame:
    log = _Arrivals(fx).window_log(EVERY_TENTH, LATE_TOLERANCE)
    return windows.newest_versions(log).drop("processed_at")


@query(f"""
SELECT (SELECT COUNT(*) FROM (
    SELECT DISTINCT TIME_BUCKET(INTERVAL 5 MINUTE, event_time), zone_id FROM trip_events
    WHERE event_id % 10 = 3 AND event_type = 'trip_completed' AND event_time IS NOT NULL
      AND TIME_BUCKET(INTERVAL 5 MINUTE, event_time) + INTERVAL 5 MINUTE <= (
        SELECT DATE_TRUNC('millisecond', MAX(event_time)) - INTERVAL {LATE_TOLERANCE} FROM trip_events
        WHERE event_id % 10 <> 3 AND event_type = 'trip_completed'))) AS late_groups,
  (SELECT COUNT(*) FROM trip_events) AS input_rows""")
def stream_late_loss(fx: Fixture) -> DataFrame:
    """What `stream_late_data` loses: groups of late events, by window and zone."""
    arrivals = _Arrivals(fx)
    stored = shared_dir(fx.spark)
    for second_wave in (False, True):
        query = arrivals.start(second_wave, EVERY_TENTH, LATE_TOLERANCE)
        progress.follow(fx.spark, query, stored)
    return progress.read(fx.spark, stored).agg(
        F.sum("late_groups").alias("late_groups"), F.sum("input_rows").alias("input_rows")
    )


@query(f"SELECT {_WINDOW} FROM zone_log")
def stream_new_checkpoint(fx: Fixture) -> DataFrame:
    """Half of the events under one checkpoint, then all of them under a new one, same log."""
    arrivals = _Arrivals(fx)
    for second_wave in (False, True):
        arrivals.land(second_wave, ODD)
        checkpoint = shared_dir(fx.spark)
        run_stream(arrivals.stream(), arrivals.log, checkpoint, trigger_seconds=None).awaitTermination()
    return windows.newest_versions(sinks.read_window_log(fx.spark, arrivals.log)).drop("processed_at")


_LIVE = f"""
SELECT {_WINDOW} FROM zone_log
QUALIFY ROW_NUMBER() OVER (PARTITION BY zone_id ORDER BY window_start DESC) = 1"""


@query(_LIVE)
def live_zone_view(fx: Fixture) -> DataFrame:
    log = _Arrivals(fx).window_log(ODD)
    return reports.live_zone_view(windows.newest_versions(log)).drop("processed_at")


_TOP10 = f"""
SELECT {_WINDOW} FROM zone_log z
WHERE EXISTS (SELECT 1 FROM trip_events e WHERE e.event_id % 2 = 1
  AND e.event_type = 'trip_completed'
  AND e.event_time >= z.window_start AND e.event_time < z.window_end
  AND e.zone_id IS NOT DISTINCT FROM z.zone_id)
ORDER BY window_start DESC, zone_id NULLS LAST LIMIT 10"""


@query(_TOP10)
def latest_windows_top10(fx: Fixture) -> DataFrame:
    log = _Arrivals(fx).window_log(ODD)
    return reports.latest_windows(log).drop("processed_at", "run", "batch_id")


def _folded_log(fx: Fixture) -> str:
    """The log of both waves; closed days are folded after the first one and after the second."""
    arrivals = _Arrivals(fx)
    last = fx.trip_events.agg(F.max("event_time")).first()[0].date()
    arrivals.wave(False, ODD)
    fold_closed_days(fx.spark, arrivals.log, last - timedelta(days=10))
    arrivals.wave(True, ODD)
    fold_closed_days(fx.spark, arrivals.log, last - timedelta(days=3))
    return arrivals.log


@query(f"SELECT {_WINDOW} FROM zone_log")
def window_log_compacted(fx: Fixture) -> DataFrame:
    """Closed days folded twice, with late rows for days folded before."""
    log = compacted_log(fx.spark, _folded_log(fx))
    return windows.newest_versions(log).drop("processed_at")


@query(_LIVE)
def live_zone_view_compacted(fx: Fixture) -> DataFrame:
    return live_zones(fx.spark, _folded_log(fx)).drop("processed_at", "run", "batch_id")


@query(_TOP10)
def latest_windows_compacted(fx: Fixture) -> DataFrame:
    return newest_rows(fx.spark, _folded_log(fx)).drop("processed_at", "run", "batch_id")


_HEALTH = f"""
SELECT COUNT(*) AS total_rows,
  COUNT(*) FILTER (WHERE window_end >= TIMESTAMP '{HEALTH_AS_OF}' - INTERVAL 30 MINUTE)
    AS recent_rows,
  MAX(window_end) AS latest_window, MAX(window_end) AS latest_processed FROM zone_log"""
_STATUS = """CASE WHEN recent_rows > 0 THEN 'healthy' WHEN total_rows > 0
  THEN 'warning_no_recent_data' ELSE 'warning_empty_table' END AS status"""


@query(f"SELECT total_rows, recent_rows, latest_window, latest_processed, {_STATUS}"
       f" FROM ({_HEALTH}) h")
def stream_health(fx: Fixture) -> DataFrame:
    return health.stream_health(_window_log(fx), HEALTH_AS_OF)


# --- audit ---------------------------------------------------------------------------------


@query(f"""
SELECT 'run-1' AS run_id, 'batch' AS pipeline, TIMESTAMP '{AS_OF}' AS started_at,
  TIMESTAMP '{AS_OF}' AS ended_at,
  (SELECT COUNT(*) FROM payments) + (SELECT COUNT(*) FROM staged_trips) AS rows_loaded,
  'success' AS status""")
def audit_row_batch(fx: Fixture) -> DataFrame:
    counts = reports.row_counts({"payments": fx.payments, "trips": _staged_trips(fx)})
    loaded = counts.agg(
        *(F.sum(F.when(F.col("table_name") == name, F.col("row_count"))).alias(alias)
          for name, alias in (("payments", "payment_rows"), ("trips", "trip_rows")))
    )
    row = health.audit_row(
        loaded, health.batch_rows_loaded(), F.lit("success"), "run-1", "batch", AS_OF, AS_OF
    )
    log = ParquetTable(shared_dir(fx.spark), schemas.AUDIT)
    targets.append(row, log)
    return log.read(fx.spark)


@query(f"""
SELECT 'run-1' AS run_id, 'stream_monitor' AS pipeline,
  TIMESTAMP '{HEALTH_AS_OF}' AS started_at, TIMESTAMP '{HEALTH_AS_OF}' AS ended_at,
  recent_rows AS rows_loaded, {_STATUS} FROM ({_HEALTH}) h""")
def audit_row_monitor(fx: Fixture) -> DataFrame:
    row = health.audit_row(
        health.stream_health(_window_log(fx), HEALTH_AS_OF), F.col("recent_rows"),
        F.col("status"), "run-1", "stream_monitor", HEALTH_AS_OF, HEALTH_AS_OF,
    )
    log = ParquetTable(shared_dir(fx.spark), schemas.AUDIT)
    targets.append(row, log)
    return log.read(fx.spark)
