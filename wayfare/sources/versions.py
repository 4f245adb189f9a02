"""Tables that change by one step: loads write folders of their own, a commit makes them seen.

    <path>/data/version=<id>/…     files of one load; never changed once committed
    <path>/open/<id>               there while a load is being written
    <path>/commits/<number>.json   what readers see from that commit on

A reader takes the newest commit and reads the folders it names; a load that fails, or is still
being written, is in no commit, so the table stays as it was. Two loads at once cannot both
become the next commit: the later one fails. Folders that no kept commit names are deleted by
`clean`, a day after their load was begun if it never ended.
"""

from __future__ import annotations

import json
import time
import uuid
from collections.abc import Callable
from dataclasses import dataclass
from datetime import date
from functools import reduce

from py4j.protocol import Py4JJavaError
from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from wayfare.session import delete_folder

# Commits whose folders stay, for readers that began before the last load.
KEPT_COMMITS = 2
# A load that was begun longer ago than this has died.
ABANDONED_SECONDS = 24 * 3600
VERSION = "version"


class ConcurrentLoad(RuntimeError):
    """Another load was committed while this one was written."""


class _Files:
    """The few file operations that commits need, on any file system that Spark knows."""

    def __init__(self, spark: SparkSession, root: str):
        self._jvm = spark._jvm
        self._path = lambda name: spark._jvm.org.apache.hadoop.fs.Path(f"{root}/{name}")
        self._fs = self._path("x").getFileSystem(spark._jsc.hadoopConfiguration())
        self._context = spark._jvm.org.apache.hadoop.fs.FileContext.getFileContext(
            self._fs.getUri(), spark._jsc.hadoopConfiguration()
        )
        self._no_options = spark.sparkContext._gateway.new_array(
            getattr(spark._jvm.org.apache.hadoop.fs, "Options$Rename"), 0
        )

    def names(self, folder: str) -> list[tuple[str, int]]:
        """(name, time of change in seconds) of what is in a folder."""
        if not self._fs.exists(self._path(folder)):
            return []
        return [
            (status.getPath().getName(), status.getModificationTime() // 1000)
            for status in self._fs.listStatus(self._path(folder))
        ]

    def read(self, name: str) -> str:
        stream = self._fs.open(self._path(name))
        try:
            return self._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
        finally:
            stream.close()

    def write(self, name: str, text: str) -> None:
        stream = self._fs.create(self._path(name), True)
        try:
            stream.write(text.encode())
        finally:
            stream.close()

    def create(self, name: str, text: str) -> None:
        """Write a file in one step; one that exists is an error."""
        draft = f"open/{uuid.uuid4().hex}.draft"
        self.write(draft, text)
        folder = self._path(name).getParent()
        self._fs.mkdirs(folder)
        try:
            self._context.rename(
                self._fs.makeQualified(self._path(draft)), self._fs.makeQualified(self._path(name)),
                self._no_options,
            )
        except Py4JJavaError as error:
            self._fs.delete(self._path(draft), False)
            if self._fs.exists(self._path(name)):
                raise ConcurrentLoad(f"{name} was written by another load") from error
            raise

    def delete(self, name: str) -> None:
        self._fs.delete(self._path(name), True)


@dataclass(frozen=True)
class Commit:
    number: int
    content: dict


class VersionStore:
    """Folders of loads below a path, and commits that name the ones to read."""

    def __init__(self, path: str):
        self.path = path.rstrip("/")

    def folder(self, version: str) -> str:
        return f"{self.path}/data/{VERSION}={version}"

    def current(self, spark: SparkSession) -> Commit:
        """The newest commit; number 0 and no content before the first."""
        files = _Files(spark, self.path)
        numbers = self._numbers(files)
        if not numbers:
            return Commit(0, {})
        return Commit(numbers[-1], json.loads(files.read(f"commits/{numbers[-1]:012d}.json")))

    @staticmethod
    def _numbers(files: _Files) -> list[int]:
        found = (name for name, _ in files.names("commits"))
        return sorted(int(name[:-5]) for name in found if name.endswith(".json") and name[:-5].isdigit())

    def begin(self, spark: SparkSession) -> str:
        """The id of a new load."""
        version = f"v{uuid.uuid4().hex}"
        _Files(spark, self.path).write(f"open/{version}", "")
        return version

    def commit(self, spark: SparkSession, before: Commit, content: dict, version: str) -> Commit:
        """Make `content` the state after `before`."""
        files = _Files(spark, self.path)
        found = Commit(before.number + 1, content)
        files.create(f"commits/{found.number:012d}.json", json.dumps(content))
        files.delete(f"open/{version}")
        return found

    def abort(self, spark: SparkSession, version: str) -> None:
        delete_folder(spark, self.folder(version))
        _Files(spark, self.path).delete(f"open/{version}")

    def clean(self, spark: SparkSession, named: Callable[[dict], set[str]], keep: int = KEPT_COMMITS) -> list[str]:
        """Delete old commits and the folders that no kept one names; returns their ids."""
        files = _Files(spark, self.path)
        numbers = self._numbers(files)
        kept = {
            version for number in numbers[-keep:]
            for version in named(json.loads(files.read(f"commits/{number:012d}.json")))
        }
        now = time.time()
        for name, changed in files.names("open"):
            if now - changed < ABANDONED_SECONDS:
                kept.add(name)
            else:
                files.delete(f"open/{name}")
        for number in numbers[:-keep]:
            files.delete(f"commits/{number:012d}.json")
        there = [name.removeprefix(f"{VERSION}=") for name, _ in files.names("data")]
        gone = [version for version in there if version not in kept]
        for version in gone:
            files.delete(f"data/{VERSION}={version}")
        return gone


@dataclass(frozen=True)
class Pending:
    """A load that is written but not seen yet."""

    table: VersionedTable
    before: Commit
    version: str
    rows: int
    content: dict

    def commit(self, spark: SparkSession) -> int:
        self.table.store.commit(spark, self.before, self.content, self.version)
        return self.rows

    def abort(self, spark: SparkSession) -> None:
        self.table.store.abort(spark, self.version)


@dataclass(frozen=True)
class VersionedTable:
    """A table of Parquet files whose loads are seen as a whole or not at all.

    `range_by` is a date column by which a load may replace only what lies from a day on; each
    version then counts for a range of days. `folders` names a partition folder and the
    SQL expression of its value. `key` is a numbered column whose highest value commits keep.
    """

    path: str
    schema: StructType
    range_by: str | None = None
    folders: tuple[str, str] | None = None
    key: str | None = None

    @property
    def store(self) -> VersionStore:
        return VersionStore(self.path)

    def read(self, spark: SparkSession) -> DataFrame:
        segments = self.store.current(spark).content.get("segments", [])
        if not segments:
            return spark.createDataFrame([], self.schema)
        extra = [StructField(self.folders[0], StringType())] if self.folders else []
        schema = StructType([*self.schema.fields, *extra, StructField(VERSION, StringType())])
        # The base path makes the version a partition column, so a segment reads its folder only.
        scan = spark.read.schema(schema).option("basePath", f"{self.path}/data").parquet(
            *(self.store.folder(version) for version in dict.fromkeys(s[VERSION] for s in segments))
        )
        if any(s["from"] or s["to"] for s in segments) or len({s[VERSION] for s in segments}) < len(segments):
            scan = scan.filter(reduce(Column.__or__, (self._within(s) for s in segments)))
        return scan.select(*self.schema.names)

    def _within(self, segment: dict) -> Column:
        """Rows of a segment: days from `from` to before `to`; rows without a day come first."""
        found = F.col(VERSION) == segment[VERSION]
        day = F.col(self.range_by) if self.range_by else None
        for end, compare in (("from", Column.__ge__), ("to", Column.__lt__)):
            if not segment[end]:
                continue
            limit = F.lit(date.fromisoformat(segment[end]))
            inside = compare(day, limit)
            found &= inside if end == "from" else inside | day.isNull()
            if self.folders:
                name, value = self.folders
                folder = F.expr(value.replace(self.range_by, f"DATE '{segment[end]}'"))
                near = F.col(name) >= folder if end == "from" else F.col(name) <= folder
                found &= near if end == "from" else near | F.col(name).isNull()
        return found

    def write(self, df: DataFrame, append: bool = False, since: date | None = None) -> Pending:
        """Write a new version, for `Pending.commit` to publish; on failure nothing remains of it.

        It replaces all rows, or adds to them, or replaces the days from `since` on.
        """
        spark = df.sparkSession
        before = self.store.current(spark)
        version = self.store.begin(spark)
        seen = Observation()
        totals = [F.count(F.lit(1)).alias("rows")]
        if self.key:
            totals.append(F.max(self.key).alias("last_key"))
        try:
            rows = df.select(*self.schema.names)
            if self.folders:
                name, value = self.folders
                rows = rows.withColumn(name, F.expr(value)).hint("rebalance", name)
                rows = rows.sortWithinPartitions(name, *([self.range_by] if self.range_by else []))
            # Observed last, where nothing is planned away if there are no rows.
            writer = rows.observe(seen, *totals).write
            if self.folders:
                writer = writer.partitionBy(self.folders[0])
            writer.parquet(self.store.folder(version))
        except BaseException:
            self.store.abort(spark, version)
            raise
        found = seen.get
        old = before.content.get("segments", []) if append or since else []
        start = since.isoformat() if since else None
        if since:
            if self.range_by is None:
                raise ValueError("only a table with a column of days can be replaced in part")
            old = [s | {"to": min(s["to"] or start, start)} for s in old if (s["from"] or "") < start]
        content = {"segments": [*old, {VERSION: version, "from": start, "to": None, "rows": found["rows"]}]}
        if "ledger" in before.content:
            content["ledger"] = before.content["ledger"]
        if self.key:
            earlier = before.content.get("last_key", 0) if old else 0
            content["last_key"] = max(found["last_key"] or 0, earlier)
        return Pending(self, before, version, found["rows"], content)

    def last_key(self, spark: SparkSession) -> int:
        """The highest value of the key column in all versions that are read, or more."""
        return self.store.current(spark).content.get("last_key", 0)

    def save(self, df: DataFrame, mode: str) -> int:
        """Write and publish; returns the rows written."""
        return self.write(df, append=mode == "append").commit(df.sparkSession)

    def append_once(self, df: DataFrame, run: str, batch_id: int) -> int:
        """Add a micro-batch, unless a commit notes it or a later one; returns the rows added.

        The batch is noted by the commit that adds its rows. Batches of a run follow each other.
        """
        spark = df.sparkSession
        ledger = self.store.current(spark).content.get("ledger", {})
        if ledger.get(run, -1) >= batch_id:
            return 0
        pending = self.write(df, append=True)
        pending.content["ledger"] = {**pending.content.get("ledger", {}), run: batch_id}
        return pending.commit(spark)

    def clean(self, spark: SparkSession, keep: int = KEPT_COMMITS) -> list[str]:
        return self.store.clean(spark, lambda content: {s[VERSION] for s in content["segments"]}, keep)
