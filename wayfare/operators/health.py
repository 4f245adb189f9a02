"""Freshness of the window log, and audit rows."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wayfare.functions import moment

FRESH_MINUTES = 30


def stream_health(
    log: DataFrame, as_of: datetime | str | None = None, fresh_minutes: int = FRESH_MINUTES
) -> DataFrame:
    """One row: size and freshness of the window log, in one pass. An empty log only warns."""
    now = F.current_timestamp() if as_of is None else moment(as_of)
    since = now - F.expr(f"interval {int(fresh_minutes)} minutes")
    counts = log.agg(
        F.count(F.lit(1)).alias("total_rows"),
        F.count_if(F.col("processed_at") >= since).alias("recent_rows"),
        F.max("window_end").alias("latest_window"),
        F.max("processed_at").alias("latest_processed"),
    )
    status = (
        F.when(F.col("recent_rows") > 0, "healthy")
        .when(F.col("total_rows") > 0, "warning_no_recent_data")
        .otherwise("warning_empty_table")
    )
    return counts.withColumn("status", status)


def audit_row(
    counts: DataFrame,
    rows_loaded: Column,
    status: Column,
    run_id: str,
    name: str,
    started_at: datetime | str,
    ended_at: datetime | str | None = None,
) -> DataFrame:
    """One audit row from a one-row frame of counts."""
    ended = F.current_timestamp().cast("timestamp_ntz") if ended_at is None else moment(ended_at)
    return counts.select(
        F.lit(run_id).alias("run_id"),
        F.lit(name).alias("pipeline"),
        moment(started_at).alias("started_at"),
        ended.alias("ended_at"),
        rows_loaded.cast("bigint").alias("rows_loaded"),
        status.alias("status"),
    )


def batch_rows_loaded() -> Column:
    """Payments and trips together, a missing count as none. Drivers do not count."""
    zero = F.lit(0)
    return F.coalesce(F.col("payment_rows"), zero) + F.coalesce(F.col("trip_rows"), zero)
