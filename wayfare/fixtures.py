"""Trip-marketplace tables derived from the general test tables.

The SQL runs unchanged in Spark and in the checking database; `{name}` stands for another
table. Every view reads its whole base table. Edge rows come from replaced values, never
from left-out rows: unknown and missing zones, missing keys, missing, negative and zero fares,
unrated drivers, payments of unknown trips, unreadable events.
"""

from __future__ import annotations

from string import Formatter
from weakref import WeakKeyDictionary

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wayfare import session

BASE_TABLES = {
    "region": "r_regionkey INT, r_name STRING",
    "nation": "n_nationkey INT, n_name STRING, n_regionkey INT",
    "customer": "c_custkey BIGINT, c_name STRING, c_nationkey INT, c_acctbal DOUBLE,"
    " c_mktsegment STRING",
    "supplier": "s_suppkey BIGINT, s_name STRING, s_nationkey INT, s_acctbal DOUBLE",
    "orders": "o_orderkey BIGINT, o_custkey BIGINT, o_orderstatus STRING, o_totalprice DOUBLE,"
    " o_orderdate TIMESTAMP_NTZ, o_orderpriority STRING",
    "events": "event_id BIGINT, ts TIMESTAMP_NTZ, user_id BIGINT, event_type STRING,"
    " value DOUBLE, props STRING",
}

VIEWS = {
    # Trips also name zone 25, which does not exist.
    "zones": """
SELECT n_nationkey AS zone_id, n_name AS zone_name, r_name AS governorate
FROM {nation} JOIN {region} ON n_regionkey = r_regionkey""",
    "drivers": """
SELECT s_suppkey AS driver_id, s_name AS full_name,
  LPAD(CAST(s_suppkey AS VARCHAR(20)), 14, '0') AS national_id,
  '+20' || LPAD(CAST(s_suppkey AS VARCHAR(20)), 10, '1') AS phone,
  CASE CAST(s_suppkey % 3 AS INT) WHEN 0 THEN 'Economy' WHEN 1 THEN 'BUSINESS'
    ELSE 'motorbike' END AS vehicle_type,
  'PLT' || CAST(s_suppkey AS VARCHAR(20)) AS vehicle_plate,
  CASE WHEN s_suppkey % 17 = 0 THEN NULL
    ELSE CAST(CAST(350 + (s_suppkey * 37) % 151 AS DECIMAL(5,0)) * CAST(0.01 AS DECIMAL(3,2))
      AS DECIMAL(3,2)) END AS rating,
  s_suppkey % 10 <> 0 AS active,
  CASE WHEN s_suppkey % 23 = 0 THEN 25 ELSE s_nationkey END AS registered_zone
FROM {supplier}""",
    "users": """
SELECT c_custkey AS user_id, c_name AS full_name,
  '+20' || LPAD(CAST(c_custkey AS VARCHAR(20)), 10, '1') AS phone
FROM {customer}""",
    "trips": """
SELECT CASE WHEN o_orderkey % 101 = 0 THEN NULL ELSE o_orderkey END AS trip_id,
  o_custkey AS user_id, o_orderkey % (SELECT COUNT(*) + 2 FROM {supplier}) AS driver_id,
  CASE WHEN o_custkey % 59 = 0 THEN NULL ELSE CAST(o_custkey % 26 AS INT) END AS pickup_zone_id,
  CAST(o_orderkey % 26 AS INT) AS dropoff_zone_id,
  CASE o_orderstatus WHEN 'F' THEN 'COMPLETED' WHEN 'O' THEN 'in_progress'
    ELSE 'Cancelled' END AS status,
  CASE CAST(o_orderkey % 3 AS INT) WHEN 0 THEN 'Economy' WHEN 1 THEN 'BUSINESS'
    ELSE 'motorbike' END AS vehicle_type,
  CASE CAST(o_orderkey % 3 AS INT) WHEN 0 THEN 'Cash' WHEN 1 THEN 'WALLET'
    ELSE 'credit_card' END AS payment_method,
  o_orderdate + INTERVAL '1' MINUTE * CAST((o_orderkey * 37) % 1440 AS INT) AS requested_at,
  CASE WHEN o_orderstatus = 'F' THEN o_orderdate + INTERVAL '1' MINUTE
    * CAST((o_orderkey * 37) % 1440 + 5 + o_orderkey % 200 AS INT) END AS completed_at,
  CASE WHEN o_orderkey % 97 = 0 THEN NULL
    WHEN o_orderkey % 89 = 0 THEN CAST(-1 AS DECIMAL(10,2))
    WHEN o_orderkey % 83 = 0 THEN CAST(0 AS DECIMAL(10,2))
    ELSE CAST(o_totalprice AS DECIMAL(10,2)) END AS base_fare,
  CAST(CAST(o_totalprice AS DECIMAL(10,2)) + CAST((o_orderkey % 251) * 1000 AS DECIMAL(10,2))
    AS DECIMAL(10,2)) AS surge_fare,
  CAST(CAST(50 + o_orderkey % 3451 AS DECIMAL(6,0)) * CAST(0.01 AS DECIMAL(3,2))
    AS DECIMAL(8,2)) AS distance_km,
  CAST(5 + o_orderkey % 200 AS INT) AS duration_min,
  CASE WHEN o_orderstatus = 'P' AND o_orderkey % 4 <> 0 THEN 'rider_no_show' END
    AS cancellation_reason
FROM {orders}""",
    # Every 7th payment is for a trip that does not exist, so that trip has none.
    "payments": """
SELECT CASE WHEN o_orderkey % 7 = 0 THEN -1 - o_orderkey ELSE o_orderkey END AS trip_id,
  'ref-' || CAST(o_orderkey AS VARCHAR(20)) AS transaction_ref,
  CASE CAST(o_orderkey % 5 AS INT) WHEN 0 THEN 'bluepay' WHEN 1 THEN 'quicktap'
    WHEN 2 THEN 'northbank' WHEN 3 THEN 'in_hand' ELSE 'unionpurse' END AS provider,
  CAST(o_totalprice AS DECIMAL(10,2)) AS amount_egp,
  CAST(CASE WHEN o_orderkey % 2 = 0 THEN 100 ELSE 0 END AS DECIMAL(10,2)) AS discount_egp,
  CAST(CAST(o_totalprice AS DECIMAL(10,2))
    - CAST(CASE WHEN o_orderkey % 2 = 0 THEN 100 ELSE 0 END AS DECIMAL(10,2))
    AS DECIMAL(10,2)) AS net_amount_egp,
  CASE WHEN o_orderkey % 2 = 0 THEN 'RIDE-100' END AS promo_code,
  CASE CAST(o_orderkey % 4 AS INT) WHEN 1 THEN 'returned' WHEN 2 THEN 'declined'
    ELSE 'settled' END AS status,
  o_orderdate AS created_at
FROM {orders}""",
    # Some payments name the trip after theirs, which then has two, or none; some do not add up.
    "payments_dirty": """
SELECT CASE WHEN trip_id % 50 = 0 THEN trip_id + 1 WHEN trip_id % 103 = 0 THEN NULL
    ELSE trip_id END AS trip_id,
  transaction_ref, provider, amount_egp,
  CASE WHEN trip_id % 223 = 0 THEN CAST(discount_egp + 1 AS DECIMAL(10,2))
    ELSE discount_egp END AS discount_egp,
  net_amount_egp,
  CASE WHEN trip_id % 211 = 0 THEN NULL ELSE promo_code END AS promo_code, status, created_at
FROM {payments}""",
    # Every column that is checked has missing, repeated or unknown values.
    "trips_dirty": """
SELECT CASE WHEN user_id % 43 = 0 THEN trip_id - trip_id % 3 ELSE trip_id END AS trip_id,
  driver_id,
  user_id + CASE WHEN user_id % 41 = 0 THEN 1000000000000 ELSE 0 END AS user_id,
  pickup_zone_id, dropoff_zone_id, base_fare,
  CASE WHEN user_id % 19 = 0 THEN NULL WHEN user_id % 23 = 0 THEN 'barter'
    ELSE payment_method END AS payment_method,
  CASE WHEN user_id % 29 = 0 THEN 'lost' WHEN user_id % 17 = 0 THEN NULL ELSE status END
    AS status,
  CASE WHEN user_id % 31 = 0 THEN NULL WHEN user_id % 37 = 0 THEN 'scooter'
    ELSE vehicle_type END AS vehicle_type
FROM {trips}""",
    "drivers_dirty": """
SELECT CASE WHEN driver_id % 9 = 0 THEN driver_id - 1 ELSE driver_id END AS driver_id,
  CASE WHEN driver_id % 7 = 2 THEN NULL ELSE full_name END AS full_name,
  CASE WHEN driver_id % 8 = 3 THEN NULL
    ELSE LPAD(CAST(driver_id - driver_id % 2 AS VARCHAR(20)), 14, '0') END AS national_id,
  CASE WHEN driver_id % 6 = 5 THEN NULL ELSE phone END AS phone,
  CASE WHEN driver_id % 5 = 1 THEN NULL WHEN driver_id % 5 = 4 THEN 'Rickshaw'
    ELSE vehicle_type END AS vehicle_type,
  CASE WHEN driver_id % 10 = 7 THEN NULL ELSE vehicle_plate END AS vehicle_plate,
  rating, active, registered_zone
FROM {drivers}""",
    "users_dirty": """
SELECT CASE WHEN user_id % 13 = 0 THEN user_id - 1 ELSE user_id END AS user_id,
  CASE WHEN user_id % 11 = 5 THEN NULL ELSE full_name END AS full_name,
  CASE WHEN user_id % 12 = 7 THEN NULL ELSE phone END AS phone
FROM {users}""",
    "zones_dirty": """
SELECT CASE WHEN zone_id % 8 = 7 THEN zone_id - 1 ELSE zone_id END AS zone_id,
  CASE WHEN zone_id % 9 = 4 THEN NULL ELSE zone_name END AS zone_name,
  CASE WHEN zone_id % 10 = 3 THEN NULL ELSE governorate END AS governorate
FROM {zones}""",
    # The event stream once parsed. Some records are not JSON: all their fields are NULL.
    "trip_events": """
SELECT CASE WHEN event_id % 997 = 5 THEN NULL WHEN event_type = 'purchase'
    THEN 'trip_completed' ELSE event_type END AS event_type,
  CASE WHEN event_id % 997 = 5 OR event_id % 60 = 7 THEN NULL ELSE event_id END AS trip_id,
  CASE WHEN event_id % 997 = 5 THEN NULL ELSE user_id END AS driver_id,
  CASE WHEN event_id % 997 = 5 THEN NULL ELSE value END AS fare_egp,
  CASE WHEN event_id % 997 = 5 THEN NULL ELSE CAST(event_id % 290 AS DOUBLE) / 10 END
    AS distance_km,
  CASE WHEN event_id % 997 = 5 OR event_id % 40 = 1 THEN NULL
    ELSE CAST(user_id % 8 + 1 AS INT) END AS zone_id,
  CASE WHEN event_id % 997 = 5 OR event_id % 50 = 0 THEN NULL ELSE ts END AS event_time,
  ts AS broker_time, event_id
FROM {events}""",
}


class Fixture:
    """The tables of one data folder, by attribute or by name."""

    def __init__(self, spark: SparkSession, folder: str) -> None:
        self.spark = spark
        self.folder = folder.rstrip("/")
        self._tables: dict[str, DataFrame] = {}

    def __getitem__(self, name: str) -> DataFrame:
        if name not in self._tables:
            self._tables[name] = self._load(name)
        return self._tables[name]

    def __getattr__(self, name: str) -> DataFrame:
        if name in VIEWS or name in BASE_TABLES:
            return self[name]
        raise AttributeError(name)

    def _load(self, name: str) -> DataFrame:
        if name in BASE_TABLES:
            return self.spark.read.schema(BASE_TABLES[name]).parquet(f"{self.folder}/{name}.parquet")
        used = {field for _, field, _, _ in Formatter().parse(VIEWS[name]) if field}
        return self.spark.sql(VIEWS[name], **{table: self[table] for table in used})

    def records(self) -> DataFrame:
        """The events as broker records: UTF-8 JSON values with the time of arrival."""
        events = self["trip_events"]
        stamp = F.date_format("event_time", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'Z'")
        value = F.to_json(
            F.struct(
                "event_type", "trip_id", "driver_id", "fare_egp", "distance_km", "zone_id",
                F.coalesce(stamp, F.lit("bad")).alias("timestamp"),
            )
        )
        unreadable = F.col("event_id") % 997 == 5
        return events.select(
            F.col("event_id"),
            F.col("event_id").cast("string").cast("binary").alias("key"),
            F.when(unreadable, "not json").otherwise(value).cast("binary").alias("value"),
            F.lit("trip_events").alias("topic"),
            F.col("broker_time").cast("timestamp").alias("timestamp"),
        )


_fixtures: WeakKeyDictionary[SparkSession, dict[str, Fixture]] = WeakKeyDictionary()


def fixture(spark: SparkSession, folder: str) -> Fixture:
    """The fixture of a folder, with the session set up for the folder's size.

    Its tables are plans, not data. They are made once per session.
    """
    known = _fixtures.setdefault(spark, {})
    if folder not in known:
        session.configure(spark, session.stored_bytes(spark, folder))
        known[folder] = Fixture(spark, folder)
    return known[folder]


def with_views(sql: str, more: dict[str, str] | None = None) -> str:
    """Plain SQL over the base tables: `sql` preceded by the derived tables, then by `more`."""
    plain = {name: name for name in (*BASE_TABLES, *VIEWS)}
    derived = {name: text.format_map(plain) for name, text in VIEWS.items()} | (more or {})
    ctes = ",\n".join(f"{name} AS ({text.strip()})" for name, text in derived.items())
    return f"WITH {ctes}\n{sql.strip()}"
