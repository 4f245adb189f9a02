"""Stored tables and the ways of loading them."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass, field, replace
from datetime import date

from py4j.java_gateway import JavaObject
from pyspark.sql import DataFrame, DataFrameWriter, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from wayfare.operators.numbering import in_key_order
from wayfare.schemas import conform
from wayfare.session import read_if_present
from wayfare.sources.versions import Pending, VersionedTable


@dataclass(frozen=True)
class ParquetTable:
    """A table kept as Parquet files, optionally in one folder per value of a column."""

    path: str
    schema: StructType
    partition_by: str | None = None

    def read(self, spark: SparkSession) -> DataFrame:
        # A partition column would come last.
        return read_if_present(spark, self.path, self.schema).select(*self.schema.names)

    def save(self, df: DataFrame, mode: str) -> int:
        """Write in place; readers see a replacement while it happens. Returns the rows."""

        def write(rows: DataFrame) -> None:
            writer = rows.write.mode(mode)
            if self.partition_by:
                writer = writer.partitionBy(self.partition_by).option("partitionOverwriteMode", "static")
            writer.parquet(self.path)

        return _counted(df, write)


class Transaction:
    """Statements on one connection of the driver, all of which count or none."""

    def __init__(self, spark: SparkSession, url: str, properties: Mapping[str, str]):
        settings = spark._jvm.java.util.Properties()
        for name, value in properties.items():
            settings.setProperty(name, value)
        self._connection = spark._jvm.java.sql.DriverManager.getConnection(url, settings)
        self._connection.setAutoCommit(False)

    def _prepared(self, sql: str, values: Sequence[object]) -> JavaObject:
        statement = self._connection.prepareStatement(sql)
        for place, value in enumerate(values, 1):
            statement.setObject(place, value)
        return statement

    def run(self, sql: str, *values: object) -> int:
        return self._prepared(sql, values).executeUpdate()

    def number(self, sql: str, *values: object) -> int:
        """The first column of the first row."""
        found = self._prepared(sql, values).executeQuery()
        found.next()
        return found.getLong(1)

    def __enter__(self) -> Transaction:
        return self

    def __exit__(self, kind: type | None, *_: object) -> None:
        try:
            self._connection.commit() if kind is None else self._connection.rollback()
        finally:
            self._connection.close()


@dataclass(frozen=True)
class DatabaseTable:
    """A table in a database. `connections` bounds the writers that load it at once.

    `slices` are predicates that cover every row once, each read by a connection of its own (see
    `readers.slices`). `ledger` is a table (run, batch_id, row_count) with the first two as its
    key; it says which micro-batches the table holds.
    """

    url: str
    table: str
    schema: StructType
    connections: int = 16
    properties: Mapping[str, str] = field(default_factory=dict)
    slices: tuple[str, ...] = ()
    ledger: str = "wayfare_batches"

    def read(self, spark: SparkSession) -> DataFrame:
        sliced = {"predicates": list(self.slices)} if self.slices else {}
        scan = spark.read.jdbc(self.url, self.table, properties=dict(self.properties), **sliced)
        return conform(scan, self.schema)

    def transaction(self, spark: SparkSession) -> Transaction:
        return Transaction(spark, self.url, self.properties)

    def append_once(self, df: DataFrame, run: str, batch_id: int) -> int:
        """Add a micro-batch, unless the ledger has it. Returns the rows added.

        Writers fill a table beside this one, which a repeat fills anew. One transaction then
        moves its rows and notes the batch, so a failure at any point leaves all of it or nothing.
        """
        spark = df.sparkSession
        with self.transaction(spark) as db:
            known = f"SELECT COUNT(*) FROM {self.ledger} WHERE run = ? AND batch_id = ?"
            if db.number(known, run, batch_id):
                return 0
        staged = replace(self, table=f"{self.table}_incoming")
        rows = staged.save(df.select(*self.schema.names), "overwrite")
        columns = ", ".join(self.schema.names)
        with self.transaction(spark) as db:
            db.run(f"INSERT INTO {self.ledger} (run, batch_id, row_count) VALUES (?, ?, ?)", run, batch_id, rows)
            db.run(f"INSERT INTO {self.table} ({columns}) SELECT {columns} FROM {staged.table}")
        return rows

    def save(self, df: DataFrame, mode: str) -> int:
        return _counted(df, lambda rows: self._writer(rows, mode).save())

    def _writer(self, df: DataFrame, mode: str) -> DataFrameWriter:
        return (
            df.write.format("jdbc")
            .mode(mode)
            .options(**self.properties)
            .option("url", self.url)
            .option("dbtable", self.table)
            .option("truncate", "true")
            .option("numPartitions", str(self.connections))
            .option("batchsize", "10000")
        )


Table = ParquetTable | VersionedTable | DatabaseTable


def stamp_loaded(df: DataFrame) -> DataFrame:
    """Add the load time that staging rows carry."""
    return df.withColumn("_loaded_at", F.current_timestamp().cast("timestamp_ntz"))


def _counted(df: DataFrame, write: Callable[[DataFrame], None]) -> int:
    seen = Observation()
    write(df.observe(seen, F.count(F.lit(1)).alias("rows")))
    return seen.get["rows"]


def full_refresh(df: DataFrame, table: Table) -> int:
    """Replace the contents. Returns the rows written, counted while writing.

    In a versioned table a load that fails leaves what was there. `df` may read the table it
    replaces only if that is versioned.
    """
    return table.save(df, "overwrite")


def refresh_unless_empty(df: DataFrame, table: Table) -> int:
    """Replace the contents, but keep them when there is nothing new; returns rows written."""
    if isinstance(table, VersionedTable):
        pending = table.write(df)
        if pending.rows:
            return pending.commit(df.sparkSession)
        pending.abort(df.sparkSession)
        return 0
    return 0 if df.isEmpty() else full_refresh(df, table)


def append(df: DataFrame, table: Table) -> int:
    """Add rows. A repeated load adds them again."""
    return table.save(df, "append")


def append_once(df: DataFrame, table: Table, run: str, batch_id: int) -> int:
    """Add a micro-batch of a run. Returns the rows added, 0 for one that is there already.

    Plain Parquet files keep no ledger: there a repeat adds the rows again, under the same number.
    """
    return append(df, table) if isinstance(table, ParquetTable) else table.append_once(df, run, batch_id)


def publish_together(
    spark: SparkSession, loads: Sequence[tuple[DataFrame, Table, date | None]]
) -> None:
    """Replace several tables, or what they hold from a day on, only once all are written."""
    written: list[Pending] = []
    try:
        for df, table, since in loads:
            if isinstance(table, VersionedTable):
                written.append(table.write(df, since=since))
            elif since is None:
                full_refresh(df, table)
            else:
                raise ValueError("only a versioned table can be replaced from a day on")
    except BaseException:
        for pending in written:
            pending.abort(spark)
        raise
    for pending in written:
        pending.commit(spark)


def in_partition_layout(df: DataFrame, column: str) -> DataFrame:
    """Bring rows of one partition folder together before writing.

    Adaptive execution splits a folder that holds far more rows than the others over several
    tasks and merges small ones, so neither one task nor a flood of files results.
    """
    return df.hint("rebalance", column)


def append_ordered(df: DataFrame, key: str, table: ParquetTable | VersionedTable) -> int:
    """Add rows in files whose order is the total order of `key`."""
    return append(in_key_order(df, key), table)
