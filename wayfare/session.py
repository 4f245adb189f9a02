"""Session settings, shared scratch space and size checks."""

from __future__ import annotations

import math
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

# One reduce partition per this many input bytes.
BYTES_PER_SHUFFLE_PARTITION = 256 << 20
# What a source without known size reports is far above this.
UNKNOWN_BYTES = 1 << 60
# Beyond this input size read larger splits, so that map tasks stay in the hundred thousands.
LARGE_INPUT_BYTES = 8 << 40
LARGE_SPLIT = "512m"
MAX_LISTING_TASKS = 10_000
# A side is broadcast only after it was counted and found to hold no more rows than this.
MAX_BROADCAST_ROWS = 200_000
MAX_BROADCAST_BYTES = 1 << 30

_SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # Lets a join on (bucket, key) reuse rows already hashed by bucket alone.
    "spark.sql.requireAllClusterKeysForCoPartition": "false",
}

_scratch_roots: dict[str, str] = {}
# Folders that scratch scopes will delete, innermost last.
_scopes: list[list[str]] = []


def configure(spark: SparkSession, input_bytes: int = 0) -> SparkSession:
    """Apply the settings the library relies on and size shuffles to the input.

    Partition counts are only ever raised above what the session already has; adaptive
    execution merges the ones that turn out to be small.
    """
    for name, value in _SETTINGS.items():
        if spark.conf.get(name, None) != value:
            spark.conf.set(name, value)
    # List stored partitions with a few folders per task, not with a task for each folder.
    listers = min(4 * spark.sparkContext.defaultParallelism, MAX_LISTING_TASKS)
    spark.conf.set("spark.sql.sources.parallelPartitionDiscovery.parallelism", str(listers))
    wanted = math.ceil(input_bytes / BYTES_PER_SHUFFLE_PARTITION)
    initial = "spark.sql.adaptive.coalescePartitions.initialPartitionNum"
    present = int(spark.conf.get(initial, None) or spark.conf.get("spark.sql.shuffle.partitions"))
    if wanted > present:
        spark.conf.set(initial, str(wanted))
    if input_bytes > LARGE_INPUT_BYTES:
        spark.conf.set("spark.sql.files.maxPartitionBytes", LARGE_SPLIT)
    return spark


def keep_state_on_disk(spark: SparkSession) -> None:
    """Hold streaming state in RocksDB, for a stream whose windows outgrow executor memory.

    A checkpoint stays with the kind of state it was begun with.
    """
    store = "spark.sql.streaming.stateStore"
    provider = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
    spark.conf.set(f"{store}.providerClass", provider)
    spark.conf.set(f"{store}.rocksdb.changelogCheckpointing.enabled", "true")


def stored_bytes(spark: SparkSession, path: str) -> int:
    """Total size of the files under `path`, from the listing alone."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(path)
    return files.agg(F.coalesce(F.sum("length"), F.lit(0))).first()[0]


def planned_bytes(*frames: DataFrame) -> int:
    """Bytes the optimiser expects these frames to read; sources of unknown size count nothing."""
    sizes = (
        int(str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes())) for df in frames
    )
    return sum(size for size in sizes if size < UNKNOWN_BYTES)


def shared_dir(spark: SparkSession) -> str:
    """A new folder name below the cluster's shared folder.

    The folder is `spark.checkpoint.dir`. Only a local session may go without it; it then
    gets one temporary folder of its own.
    """
    root = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not root:
        app = spark.sparkContext.applicationId
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        if app not in _scratch_roots:
            _scratch_roots[app] = tempfile.mkdtemp(prefix="wayfare-")
        root = _scratch_roots[app]
    folder = f"{root.rstrip('/')}/wayfare-{uuid.uuid4().hex}"
    if _scopes:
        _scopes[-1].append(folder)
    return folder


@contextmanager
def scratch_scope(spark: SparkSession) -> Iterator[None]:
    """Delete the intermediate results of a job when it ends, whether it fails or not.

    What the job returns must be stored elsewhere by then: frames that read scratch do not
    outlive the scope.
    """
    _scopes.append([])
    try:
        yield
    finally:
        for folder in _scopes.pop():
            delete_folder(spark, folder)


def delete_folder(spark: SparkSession, path: str) -> None:
    """Delete a folder and what is in it, wherever Spark can write; none is no error."""
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    place.getFileSystem(spark._jsc.hadoopConfiguration()).delete(place, True)


def read_if_present(spark: SparkSession, path: str, schema: StructType) -> DataFrame:
    """Scan Parquet files with a declared schema; a folder not yet written has no rows."""
    try:
        return spark.read.schema(schema).parquet(path)
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], schema)


def materialise(df: DataFrame) -> DataFrame:
    """Write `df` to the shared folder and read it back: one evaluation, lineage cut."""
    path = shared_dir(df.sparkSession)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def materialise_with(df: DataFrame, **totals: Column) -> tuple[DataFrame, dict[str, int]]:
    """As `materialise`, with aggregates over the rows taken while they are written."""
    seen = Observation()
    columns = [total.alias(name) for name, total in totals.items()]
    return materialise(df.observe(seen, *columns)), seen.get


def broadcast_if_small(
    df: DataFrame, max_rows: int = MAX_BROADCAST_ROWS, max_bytes: int = MAX_BROADCAST_BYTES
) -> DataFrame:
    """Mark a lookup side for broadcast only if its size and a count show that it is small.

    The count is summed up from counts of the partitions. The optimiser's estimate bounds the bytes,
    where it knows them. A larger side is left to the optimiser: a
    sort-merge join whose skewed partitions adaptive execution splits.
    """
    if max_bytes < planned_bytes(df):
        return df
    return F.broadcast(df) if df.count() <= max_rows else df
