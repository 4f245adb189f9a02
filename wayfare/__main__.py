"""Command line: batch, manual-load, counts, quality, reports, stream, fold and monitor.

    spark-submit --py-files wayfare.zip wayfare/__main__.py batch --config job.json --hours 24
    python -m wayfare batch --config job.json --hours 24

The configuration names the sources and where the results go:

    {"warehouse": "s3a://lake/warehouse",
     "trips":    {"format": "jdbc", "url": "jdbc:…", "table": "trips", "properties": {…},
                  "partition_column": "trip_id", "bounds": [1, 900000000], "partitions": 400},
     "drivers":  {"format": "jdbc", …}, "zones": {"format": "jdbc", …},
     "payments": {"format": "mongodb", "options": {…}},
     "users":    {"format": "jdbc", …} (only for quality; may be left out),
     "stream":   {"servers": "broker:9092", "topic": "trip_events",
                  "log": "s3a://lake/windows", "checkpoint": "s3a://lake/checkpoints/windows"}}

A database source may have "cuts": [v1, v2, …] beside its partition column, for keys too uneven for
equal ranges. The stream takes --starting, --records-per-trigger and --state-partitions, which
hold for a new checkpoint (the first and the last) or for each micro-batch.
"""

from __future__ import annotations

import argparse
import json
from datetime import datetime, timedelta, timezone
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

from wayfare import schemas
from wayfare.plans import batch, checks, stream
from wayfare.session import configure, keep_state_on_disk
from wayfare.sources import readers
from wayfare.streaming import compaction, progress


def open_table(spark: SparkSession, spec: dict, schema: StructType) -> DataFrame:
    """A relational source from a database, or from Parquet files."""
    if spec["format"] == "jdbc" and "cuts" in spec:
        return readers.read_relational_slices(
            spark, spec["url"], spec["table"], schema,
            readers.slices(spec["partition_column"], spec["cuts"]), spec.get("properties"),
        )
    if spec["format"] == "jdbc":
        return readers.read_relational(
            spark, spec["url"], spec["table"], schema, spec.get("partition_column"),
            spec.get("bounds"), spec.get("partitions", 1), spec.get("properties"),
        )
    return readers.read_columnar(spark, spec["path"], schema)


def open_sources(spark: SparkSession, config: dict) -> batch.Sources:
    payments = config["payments"]
    return batch.Sources(
        trips=open_table(spark, config["trips"], schemas.TRIPS),
        drivers=open_table(spark, config["drivers"], schemas.DRIVERS),
        zones=open_table(spark, config["zones"], schemas.ZONES),
        payments=readers.read_documents(
            spark, payments.get("path"), source=payments["format"],
            options=payments.get("options"),
        ),
        users=open_table(spark, config["users"], schemas.USERS) if "users" in config else None,
    )


def arguments(given: list[str] | None = None) -> argparse.Namespace:
    parser = argparse.ArgumentParser(prog="wayfare")
    parser.add_argument("job", choices=[
        "batch", "manual-load", "counts", "quality", "reports", "stream", "fold", "monitor",
    ])
    parser.add_argument("--config", required=True, help="JSON file described above")
    parser.add_argument("--as-of", type=datetime.fromisoformat, help="UTC; now by default")
    parser.add_argument("--hours", type=int, default=24, help="look-back of the batch job")
    parser.add_argument("--full", action="store_true", help="no look-back")
    parser.add_argument("--incremental", action="store_true", help="replace covered days only")
    parser.add_argument("--gate", action="store_true", help="keep repeated payments out of gold")
    parser.add_argument("--open-days", type=int, default=2, help="days of windows that fold leaves open")
    parser.add_argument("--starting", default="latest", help="where a new stream begins")
    parser.add_argument("--records-per-trigger", type=int, help="most records of a micro-batch")
    parser.add_argument("--state-partitions", type=int, help="state partitions of a new stream")
    parser.add_argument("--late-tolerance", help='for example "10 minutes"; none by default')
    return parser.parse_args(given)


def main(given: list[str] | None = None) -> None:
    args = arguments(given)
    config = json.loads(Path(args.config).read_text())
    as_of = args.as_of or datetime.now(timezone.utc).replace(tzinfo=None)
    spark = configure(SparkSession.builder.appName(f"wayfare-{args.job}").getOrCreate())
    warehouse = batch.Warehouse.at(config["warehouse"])
    if args.job == "batch":
        hours = None if args.full else args.hours
        batch.run_batch(
            spark, open_sources(spark, config), warehouse, as_of, hours, args.incremental, gate=args.gate
        )
    elif args.job == "manual-load":
        batch.run_manual_load(spark, open_sources(spark, config), warehouse)
    elif args.job == "counts":
        batch.warehouse_counts(spark, warehouse).show(truncate=False)
    elif args.job == "quality":
        checks.run_quality(spark, open_sources(spark, config), warehouse.audit, as_of).show(
            truncate=False
        )
    elif args.job == "reports":
        for name, report in checks.run_reports(spark, warehouse).items():
            report.write.mode("overwrite").parquet(f"{config['warehouse']}/reports/{name}")
    elif args.job == "stream":
        keep_state_on_disk(spark)
        target = config["stream"]
        records = readers.stream_broker(
            spark, target["servers"], target["topic"], args.starting, args.records_per_trigger
        )
        query = stream.run_stream(
            records, target["log"], target["checkpoint"], args.late_tolerance,
            state_partitions=args.state_partitions,
        )
        progress.follow(spark, query, target.get("progress", f"{target['log']}_progress"))
    elif args.job == "fold":
        before = as_of.date() - timedelta(days=args.open_days)
        print(*compaction.fold_closed_days(spark, config["stream"]["log"], before))
    else:
        log = compaction.compacted_log(spark, config["stream"]["log"])
        stream.run_monitor(log, warehouse.audit, started_at=as_of, as_of=as_of)


if __name__ == "__main__":
    main()
