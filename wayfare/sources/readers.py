"""Source scans. Each returns a lazy DataFrame with a declared schema."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from wayfare.schemas import BROKER_RECORD, PAYMENT_COLUMNS, PAYMENT_DOCUMENTS, conform


def relational_options(
    url: str,
    table: str,
    partition_column: str | None = None,
    bounds: tuple[object, object] | None = None,
    partitions: int = 1,
    fetch_size: int = 10_000,
) -> dict[str, str]:
    """Options of a database scan, split by ranges of `partition_column` if one is given."""
    # Without a cast to zone-free time in between, time filters reach the database.
    options = {
        "url": url, "dbtable": table, "fetchsize": str(fetch_size), "preferTimestampNTZ": "true",
    }
    if partition_column is not None:
        if bounds is None:
            raise ValueError("a partition column needs its lower and upper bound")
        options.update(
            partitionColumn=partition_column,
            lowerBound=str(bounds[0]),
            upperBound=str(bounds[1]),
            numPartitions=str(partitions),
        )
    return options


def read_relational(
    spark: SparkSession,
    url: str,
    table: str,
    schema: StructType,
    partition_column: str | None = None,
    bounds: tuple[object, object] | None = None,
    partitions: int = 1,
    properties: Mapping[str, str] | None = None,
) -> DataFrame:
    """Scan a database table in parallel ranges.

    The bounds only place the cuts: rows beyond them, and rows without a value, are read by
    the outermost ranges. Filters and projections on the result reach the database.
    """
    options = relational_options(url, table, partition_column, bounds, partitions)
    scan = spark.read.format("jdbc").options(**{**options, **(properties or {})}).load()
    return conform(scan, schema)


def key_cuts(sample: DataFrame, column: str, slices: int) -> list[int]:
    """Values of an integer key that cut it into slices of about equal numbers of rows.

    `sample` may be any sample of the keys, or the quantiles that the database's catalogue has.
    Keys that repeat may give fewer cuts.
    """
    shares = [k / slices for k in range(1, slices)]
    found = sample.agg(F.percentile_approx(column, shares, 10_000).alias("cuts")).first()["cuts"]
    return sorted(set(found or []))


def slices(column: str, cuts: Sequence[int]) -> list[str]:
    """Predicates for the rows between cuts: every row meets one of them, rows without a key the first."""
    ordered = sorted(set(cuts))
    if not ordered:
        return ["1 = 1"]
    between = [f"{column} >= {a} AND {column} < {b}" for a, b in zip(ordered, ordered[1:])]
    return [f"({column} < {ordered[0]} OR {column} IS NULL)", *between, f"{column} >= {ordered[-1]}"]


def read_relational_slices(
    spark: SparkSession,
    url: str,
    table: str,
    schema: StructType,
    predicates: Sequence[str],
    properties: Mapping[str, str] | None = None,
) -> DataFrame:
    """Scan a database table in caller-chosen slices, for keys too uneven for equal ranges.

    The predicates must cover every row once; each becomes one task.
    """
    options = {**relational_options(url, table), **(properties or {})}
    scan = spark.read.jdbc(url, table, predicates=list(predicates), properties=options)
    return conform(scan, schema)


def read_columnar(spark: SparkSession, path: str, schema: StructType) -> DataFrame:
    """Scan a Parquet copy of a source table."""
    return spark.read.schema(schema).parquet(path)


def read_documents(
    spark: SparkSession,
    path: str | None = None,
    schema: StructType = PAYMENT_DOCUMENTS,
    columns: Sequence[str] = PAYMENT_COLUMNS,
    source: str = "json",
    options: Mapping[str, str] | None = None,
) -> DataFrame:
    """Scan a document collection; a field a document lacks is NULL.

    `source` names any Spark data source that takes a schema, so a database connector reads
    the same collection through `options`.
    """
    reader = spark.read.format(source).schema(schema).options(**(options or {}))
    return (reader.load(path) if path else reader.load()).select(*columns)


def broker_options(
    servers: str, topic: str, starting: str = "latest", records_per_trigger: int | None = None
) -> dict[str, str]:
    """Options of a broker subscription that goes on when old records have expired.

    `starting` is where a new checkpoint begins; a backlog is worked off in micro-batches of
    `records_per_trigger` at most.
    """
    options = {
        "kafka.bootstrap.servers": servers,
        "subscribe": topic,
        "startingOffsets": starting,
        "failOnDataLoss": "false",
    }
    if records_per_trigger is not None:
        options["maxOffsetsPerTrigger"] = str(records_per_trigger)
    return options


def stream_broker(
    spark: SparkSession,
    servers: str,
    topic: str,
    starting: str = "latest",
    records_per_trigger: int | None = None,
    **more: str,
) -> DataFrame:
    """Subscribe to one topic. Needs the broker connector on the class path."""
    options = {**broker_options(servers, topic, starting, records_per_trigger), **more}
    return spark.readStream.format("kafka").options(**options).load()


def stream_landing(
    spark: SparkSession, path: str, files_per_trigger: int | None = None
) -> DataFrame:
    """Stream records in broker shape from Parquet files as they land."""
    reader = spark.readStream.schema(BROKER_RECORD)
    if files_per_trigger is not None:
        reader = reader.option("maxFilesPerTrigger", str(files_per_trigger))
    return reader.parquet(path)
