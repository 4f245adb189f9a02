"""The streaming run and its monitoring."""

from __future__ import annotations

import uuid
from datetime import datetime

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from wayfare.operators import health
from wayfare.session import configure
from wayfare.sources import targets
from wayfare.sources.targets import Table
from wayfare.streaming import sinks, windows

MONITOR_NAME = "stream_monitor"


def run_stream(
    records: DataFrame,
    sink: str | Table,
    checkpoint: str,
    late_tolerance: str | None = None,
    trigger_seconds: int | None = sinks.TRIGGER_SECONDS,
    state_partitions: int | None = None,
) -> StreamingQuery:
    """Aggregate a stream of broker records into the window log, a folder or a table.

    A checkpoint keeps the number of state partitions it was begun with; `state_partitions`
    is that of a new one, otherwise it has the session's number of shuffle partitions.
    """
    spark = configure(records.sparkSession)
    if state_partitions is not None:
        spark.conf.set("spark.sql.shuffle.partitions", str(state_partitions))
    aggregated = windows.zone_windows(
        windows.parse_events(records), late_tolerance=late_tolerance
    )
    return sinks.start_zone_stream(aggregated, sink, checkpoint, trigger_seconds)


def run_monitor(
    log: DataFrame,
    audit: Table,
    started_at: datetime,
    as_of: datetime | None = None,
    name: str = MONITOR_NAME,
) -> DataFrame:
    """Check the freshness of the window log and add the outcome to the audit table.

    Stale or missing data is a status, not a failure.
    """
    spark = configure(log.sparkSession)
    state = health.stream_health(log, as_of)
    run_id = uuid.uuid4().hex
    row = health.audit_row(
        state, F.col("recent_rows"), F.col("status"), run_id, name, started_at, as_of
    )
    targets.append(row, audit)
    return audit.read(spark).filter(F.col("run_id") == run_id)
