"""Explicit schemas of every source and stored table. Nothing is inferred."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import (
    BinaryType, BooleanType, DataType, DateType, DecimalType, DoubleType, IntegerType, LongType,
    StringType, StructField, StructType, TimestampNTZType, TimestampType,
)

# The enum domains of the source database.
TRIP_STATUSES = ("requested", "accepted", "in_progress", "completed", "cancelled")
VEHICLE_TYPES = ("economy", "business", "motorbike", "tuk_tuk")
PAYMENT_METHODS = ("cash", "wallet", "credit_card")


_INT, _LONG, _DOUBLE, _TEXT = IntegerType(), LongType(), DoubleType(), StringType()
_BOOL, _DATE, _TIME, _INSTANT = BooleanType(), DateType(), TimestampNTZType(), TimestampType()
_MONEY, _COORDINATE, _DISTANCE = DecimalType(10, 2), DecimalType(9, 6), DecimalType(8, 2)
_RATING = DecimalType(3, 2)


def schema(**columns: DataType) -> StructType:
    """A schema of nullable columns, in the order given."""
    return StructType([StructField(name, kind) for name, kind in columns.items()])


ZONES = schema(
    zone_id=_INT, zone_name=_TEXT, governorate=_TEXT, latitude=_COORDINATE, longitude=_COORDINATE,
    surge_factor=DecimalType(4, 2),
)

DRIVERS = schema(
    driver_id=_LONG, full_name=_TEXT, national_id=_TEXT, phone=_TEXT, vehicle_type=_TEXT,
    vehicle_plate=_TEXT, rating=_RATING, active=_BOOL, registered_zone=_INT, joined_at=_TIME,
)

USERS = schema(
    user_id=_LONG, full_name=_TEXT, phone=_TEXT, email=_TEXT, joined_at=_TIME,
)

TRIPS = schema(
    trip_id=_LONG, user_id=_LONG, driver_id=_LONG, pickup_zone_id=_INT, dropoff_zone_id=_INT,
    pickup_lat=_COORDINATE, pickup_long=_COORDINATE, dropoff_lat=_COORDINATE,
    dropoff_long=_COORDINATE, status=_TEXT, vehicle_type=_TEXT, payment_method=_TEXT,
    requested_at=_TIME, accepted_at=_TIME, started_at=_TIME, completed_at=_TIME, base_fare=_MONEY,
    surge_fare=_MONEY, distance_km=_DISTANCE, duration_min=_INT, cancellation_reason=_TEXT,
)

# The columns the extract takes from each trip; the zone columns are joined to them.
TRIP_COLUMNS = (
    "trip_id", "user_id", "driver_id", "pickup_zone_id", "dropoff_zone_id", "status",
    "vehicle_type", "payment_method", "requested_at", "completed_at", "base_fare", "surge_fare",
    "distance_km", "duration_min", "cancellation_reason",
)

PAYMENT_DOCUMENTS = schema(
    trip_id=_LONG, transaction_ref=_TEXT, provider=_TEXT, amount_egp=_MONEY, discount_egp=_MONEY,
    net_amount_egp=_MONEY, promo_code=_TEXT, status=_TEXT, created_at=_TIME,
    provider_metadata=schema(response_code=_TEXT, masked_card=_TEXT),
)

PAYMENT_COLUMNS = (
    "trip_id", "transaction_ref", "provider", "amount_egp", "discount_egp", "net_amount_egp",
    "promo_code", "status", "created_at",
)

STAGED_TRIPS = schema(
    trip_id=_LONG, user_id=_LONG, driver_id=_LONG, pickup_zone_id=_INT, dropoff_zone_id=_INT,
    status=_TEXT, vehicle_type=_TEXT, payment_method=_TEXT, requested_at=_TIME,
    completed_at=_TIME, base_fare=_MONEY, surge_fare=_MONEY, distance_km=_DISTANCE,
    duration_min=_INT, cancellation_reason=_TEXT, pickup_zone_name=_TEXT, dropoff_zone_name=_TEXT,
    pickup_governorate=_TEXT, _loaded_at=_TIME,
)

STAGED_DRIVERS = schema(
    driver_id=_LONG, full_name=_TEXT, vehicle_type=_TEXT, vehicle_plate=_TEXT, rating=_RATING,
    active=_BOOL, zone_name=_TEXT, governorate=_TEXT, _loaded_at=_TIME,
)

STAGED_PAYMENTS = schema(
    trip_id=_LONG, transaction_ref=_TEXT, provider=_TEXT, amount_egp=_MONEY, discount_egp=_MONEY,
    net_amount_egp=_MONEY, promo_code=_TEXT, status=_TEXT, created_at=_TIME, _loaded_at=_TIME,
)

QUARANTINED_PAYMENTS = StructType([*STAGED_PAYMENTS.fields, StructField("reason", _TEXT)])

FCT_TRIPS = schema(
    fct_trip_sk=_LONG, trip_id=_LONG, user_id=_LONG, driver_id=_LONG, pickup_zone_id=_INT,
    dropoff_zone_id=_INT, trip_status=_TEXT, vehicle_type=_TEXT, payment_method=_TEXT,
    trip_date=_DATE, trip_hour=_INT, pickup_zone_name=_TEXT, dropoff_zone_name=_TEXT,
    pickup_governorate=_TEXT, base_fare=_MONEY, surge_fare=_MONEY,
    surge_multiplier=DecimalType(13, 2), distance_km=_DISTANCE, duration_min=_INT,
    is_cancelled=_INT, net_amount_egp=_MONEY, payment_provider=_TEXT, promo_code=_TEXT,
    discount_egp=_MONEY, _dbt_loaded_at=_TIME,
)

DIM_DRIVERS = schema(
    driver_id=_LONG, full_name=_TEXT, vehicle_type=_TEXT, vehicle_plate=_TEXT, rating=_RATING,
    is_active=_BOOL, zone_name=_TEXT, governorate=_TEXT, driver_tier=_TEXT, _dbt_loaded_at=_TIME,
)

# The value of a trip event message.
TRIP_EVENT = schema(
    event_type=_TEXT, trip_id=_LONG, driver_id=_LONG, fare_egp=_DOUBLE, distance_km=_DOUBLE,
    zone_id=_INT, timestamp=_TEXT,
)

# The shape in which a message broker hands records to Spark.
BROKER_RECORD = schema(
    key=BinaryType(), value=BinaryType(), topic=_TEXT, timestamp=_INSTANT,
)

ZONE_WINDOW_LOG = schema(
    window_start=_INSTANT, window_end=_INSTANT, zone_id=_INT, trip_count=_LONG,
    total_revenue_egp=DecimalType(32, 2), avg_fare_egp=DecimalType(24, 2),
    avg_distance_km=DecimalType(24, 2), unusable_values=_LONG, processed_at=_INSTANT, run=_TEXT,
    batch_id=_LONG,
)

AUDIT = schema(
    run_id=_TEXT, pipeline=_TEXT, started_at=_TIME, ended_at=_TIME, rows_loaded=_LONG,
    status=_TEXT,
)


def conform(df: DataFrame, declared: StructType) -> DataFrame:
    """Project to the columns of `declared`, cast to the declared types.

    Database drivers return enums as their own type and timestamps with a zone; both end
    here as text and as zone-free timestamps. A declared column that is missing is an error.
    """
    missing = [f.name for f in declared if f.name not in df.columns]
    if missing:
        raise ValueError(f"the source has no columns {', '.join(missing)}")
    return df.select([F.col(f.name).cast(f.dataType).alias(f.name) for f in declared])
