"""What each micro-batch took in and lost, kept beside the window log.

Spark reports for every batch how many groups of late events, one for each window and zone, the
state refused because the window had closed. The driver polls the running query and stores the
reports, a folder for each batch, so that a report stored twice counts once.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import LongType, StringType

from wayfare.schemas import schema
from wayfare.session import read_if_present

PROGRESS = schema(
    run=StringType(), batch_id=LongType(), input_rows=LongType(), late_groups=LongType(),
    state_rows=LongType(), watermark=StringType(),
)
_STORED = PROGRESS.names[2:]
POLL_SECONDS = 30


def reports(query: StreamingQuery) -> list[tuple]:
    """(run, batch_id, …) of the batches that the query remembers, those without data too."""
    found = {}
    for p in query.recentProgress:
        state = p["stateOperators"]
        found[p["batchId"]] = (
            str(p["id"]), p["batchId"], p["numInputRows"],
            sum(s["numRowsDroppedByWatermark"] for s in state), sum(s["numRowsTotal"] for s in state),
            p["eventTime"].get("watermark"),
        )
    return list(found.values())


def store(spark: SparkSession, query: StreamingQuery, path: str, after: int = -1) -> int:
    """Store the reports of batches after a number; returns the last number seen."""
    last = after
    for row in reports(query):
        if row[1] > after:
            stored = spark.createDataFrame([row], PROGRESS).select(*_STORED).coalesce(1)
            stored.write.mode("overwrite").parquet(f"{path}/run={row[0]}/batch_id={row[1]}")
            last = max(last, row[1])
    return last


def follow(spark: SparkSession, query: StreamingQuery, path: str, seconds: float = POLL_SECONDS) -> None:
    """Wait until the query ends, storing its reports meanwhile; its failure is raised."""
    last = -1
    while not query.awaitTermination(seconds):
        last = store(spark, query, path, last)
    store(spark, query, path, last)


def read(spark: SparkSession, path: str) -> DataFrame:
    return read_if_present(spark, path, PROGRESS).select(*PROGRESS.names)
