"""The micro-batch writer and the running query."""

from __future__ import annotations

import json
import math
from collections.abc import Callable

from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from wayfare.schemas import ZONE_WINDOW_LOG
from wayfare.session import read_if_present
from wayfare.sources.targets import Table, append_once

TRIGGER_SECONDS = 60
ROWS_PER_FILE = 1_000_000
# The day a window begins, by which the folders of a batch are divided.
WINDOW_DATE = "window_date"


def run_of(spark: SparkSession, checkpoint: str) -> str:
    """The id of the stream that a checkpoint belongs to; a new checkpoint has a new one."""
    stored = spark.read.text(f"{checkpoint.rstrip('/')}/metadata").first()
    return json.loads(stored[0])["id"]


def batch_writer(sink: str | Table, checkpoint: str) -> Callable[[DataFrame, int], None]:
    """A micro-batch writer that skips empty batches and may be repeated.

    Below a path each batch of each run owns one folder, and a retry overwrites it; runs never
    touch each other's. A database or versioned table notes the batches it holds, so a retry adds
    nothing; in plain files it appends the batch again under its run and number, of which
    `newest_versions` keeps one row. A batch is written in few files, in a folder for each
    day of its windows.
    """

    def write(batch: DataFrame, batch_id: int) -> None:
        batch.persist(StorageLevel.MEMORY_AND_DISK)
        try:
            rows = batch.count()
            if not rows:
                return
            run = run_of(batch.sparkSession, checkpoint)
            few = batch.coalesce(math.ceil(rows / ROWS_PER_FILE))
            if isinstance(sink, str):
                dated = few.withColumn(WINDOW_DATE, F.to_date("window_start"))
                writer = dated.write.mode("overwrite").option("partitionOverwriteMode", "static")
                writer.partitionBy(WINDOW_DATE).parquet(f"{sink}/run={run}/batch_id={batch_id}")
            else:
                marks = {"run": F.lit(run), "batch_id": F.lit(batch_id).cast("bigint")}
                append_once(few.withColumns(marks), sink, run, batch_id)
        finally:
            batch.unpersist()

    return write


def start_zone_stream(
    windows: DataFrame,
    sink: str | Table,
    checkpoint: str,
    trigger_seconds: int | None = TRIGGER_SECONDS,
) -> StreamingQuery:
    """Start writing changed windows to the log, a folder or a table.

    `trigger_seconds=None` works off what has arrived and stops. `checkpoint` must be on
    storage that outlives the driver; a restart with the same folder goes on where it ended.
    """
    writer = windows.writeStream.outputMode("update").foreachBatch(
        batch_writer(sink, checkpoint)
    )
    writer = writer.option("checkpointLocation", checkpoint)
    if trigger_seconds is None:
        writer = writer.trigger(availableNow=True)
    else:
        writer = writer.trigger(processingTime=f"{trigger_seconds} seconds")
    return writer.start()


def read_window_log(spark: SparkSession, path: str) -> DataFrame:
    """All versions of all windows, with the batch that wrote them; none before the first."""
    return read_if_present(spark, path, ZONE_WINDOW_LOG).select(*ZONE_WINDOW_LOG.names)


def append_events(
    events: DataFrame, path: str, checkpoint: str, trigger_seconds: int | None = None
) -> StreamingQuery:
    """Store parsed events as they arrive."""
    writer = events.writeStream.outputMode("append").format("parquet")
    writer = writer.option("path", path).option("checkpointLocation", checkpoint)
    if trigger_seconds is None:
        writer = writer.trigger(availableNow=True)
    else:
        writer = writer.trigger(processingTime=f"{trigger_seconds} seconds")
    return writer.start()
