"""From broker records to 5-minute zone windows and their newest versions."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wayfare.schemas import TRIP_EVENT

WINDOW = "5 minutes"
COMPLETED_EVENT = "trip_completed"
WINDOW_KEYS = ("window_start", "window_end", "zone_id")


def parse_events(records: DataFrame) -> DataFrame:
    """Broker records to event columns, broker time and event time.

    A value that is not JSON, a field of the wrong type and a time that cannot be read all
    become NULL; none of them stops the stream.
    """
    event = F.from_json(F.col("value").cast("string"), TRIP_EVENT)
    return records.withColumn("event", event).select(
        "event.*",
        F.col("timestamp").alias("kafka_ts"),
        F.try_to_timestamp("event.timestamp").alias("event_time"),
    )


# Fares and distances of 18 digits before the point: 10**10 of them add up without overflow.
MEASURE = "decimal(24,6)"


def _measure(name: str) -> Column:
    return F.col(name).try_cast(MEASURE)


def _unusable(name: str) -> Column:
    """Values that are there but are no finite number of the size of a measure."""
    return F.col(name).isNotNull() & _measure(name).isNull()


def _mean(name: str) -> Column:
    count = F.nullif(F.count(_measure(name)), F.lit(0))
    return F.round(F.sum(_measure(name)) / count, 2)


def zone_windows(
    events: DataFrame,
    as_of: datetime | str | None = None,
    late_tolerance: str | None = None,
) -> DataFrame:
    """Completed trips per 5-minute window and zone, for a stream or a batch frame.

    Events without a zone form a group; events without a time are in no window. Fares and
    distances that are no usable number add nothing and are counted in `unusable_values`.
    `late_tolerance=None` takes every late event and keeps all state. A tolerance drops
    windows from the state once the stream is that far ahead, with events that come later.
    """
    completed = events.filter(F.col("event_type") == COMPLETED_EVENT)
    if late_tolerance is not None:
        completed = completed.withWatermark("event_time", late_tolerance)
    stamp = F.current_timestamp() if as_of is None else F.lit(str(as_of)).cast("timestamp")
    return (
        completed.groupBy(F.window("event_time", WINDOW), "zone_id")
        .agg(
            F.count("trip_id").alias("trip_count"),
            F.sum(_measure("fare_egp")).cast("decimal(32,2)").alias("total_revenue_egp"),
            _mean("fare_egp").cast("decimal(24,2)").alias("avg_fare_egp"),
            _mean("distance_km").cast("decimal(24,2)").alias("avg_distance_km"),
            F.sum(
                _unusable("fare_egp").cast("bigint") + _unusable("distance_km").cast("bigint")
            ).alias("unusable_values"),
        )
        .select(
            F.col("window.start").alias("window_start"),
            F.col("window.end").alias("window_end"),
            "zone_id", "trip_count", "total_revenue_egp", "avg_fare_egp", "avg_distance_km",
            "unusable_values", stamp.alias("processed_at"),
        )
    )


def newest_versions(log: DataFrame) -> DataFrame:
    """One row per window and zone: the version that was written last.

    Batches are numbered from 0 again under a new checkpoint, so the time of processing decides
    first. The log holds a row for each time a window changed, so its rows must not be summed.
    """
    measures = [c for c in log.columns if c not in (*WINDOW_KEYS, "run", "batch_id")]
    newest = F.max_by(F.struct(*measures), F.struct("processed_at", "batch_id")).alias("newest")
    return log.groupBy(*WINDOW_KEYS).agg(newest).select(*WINDOW_KEYS, "newest.*")
