"""Folding closed days of the window log into one row per window.

The stream adds a row whenever a window changes, in folders by run, batch and day of the window
(`sinks.batch_writer`). A day is closed when hardly any event for it is still to come; the rows of
closed days are folded into their newest versions and stored by day beside the log, with two
small tables: the newest rows folded so far, and the latest window of every zone among them.

A commit names the folded days, up to which batch of each run they are folded, and where their
rows are. Readers take it and read the folded days as stored, and of the log's folders those the
commit does not cover: open days, and later batches of closed days, since late events still count. So
a reader sees every row once whether a fold is under way or not, and lists few folders. Folders
that one commit covers are deleted by the fold after it.
"""

from __future__ import annotations

from dataclasses import dataclass, field
from datetime import date
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DateType, StructField, StructType

from wayfare.operators import reports
from wayfare.schemas import ZONE_WINDOW_LOG
from wayfare.session import read_if_present
from wayfare.sources.versions import Commit, VersionStore
from wayfare.streaming.sinks import WINDOW_DATE
from wayfare.streaming.windows import WINDOW_KEYS, newest_versions

# Rows of folded days that `newest_rows` can still return.
KEPT_ROWS = 100
_OPEN = StructType([*ZONE_WINDOW_LOG.fields, StructField(WINDOW_DATE, DateType())])


@dataclass(frozen=True)
class Folded:
    """What a commit says: days before `before` are folded, up to a batch of each run."""

    before: str | None = None
    batches: dict[str, int] = field(default_factory=dict)
    # The version that holds a day, and the one that holds the two small tables.
    days: dict[str, str] = field(default_factory=dict)
    tail: str | None = None

    def covers(self) -> Column:
        """Rows of the log that are in the folded days already."""
        if self.before is None or not self.batches:
            return F.lit(False)
        runs = reduce(
            Column.__or__,
            ((F.col("run") == run) & (F.col("batch_id") <= last) for run, last in self.batches.items()),
        )
        return F.coalesce((F.col(WINDOW_DATE) < F.lit(date.fromisoformat(self.before))) & runs, F.lit(False))


def _store(path: str) -> VersionStore:
    # Spark leaves out folders with such a name when it reads the log.
    return VersionStore(f"{path.rstrip('/')}/_closed")


def _folded(commit: Commit) -> Folded:
    return Folded(**commit.content) if commit.content else Folded()


def open_rows(spark: SparkSession, path: str, folded: Folded | None = None) -> DataFrame:
    """Rows of the log that are not folded."""
    if folded is None:
        folded = _folded(_store(path).current(spark))
    return read_if_present(spark, path, _OPEN).filter(~folded.covers())


def _closed_rows(spark: SparkSession, path: str, folded: Folded, days: set[str] | None = None) -> DataFrame:
    wanted: dict[str, list[date]] = {}
    for day, version in folded.days.items():
        if days is None or day in days:
            wanted.setdefault(version, []).append(date.fromisoformat(day))
    if not wanted:
        return spark.createDataFrame([], _OPEN)
    parts = []
    for version, held in wanted.items():
        stored = spark.read.schema(_OPEN).parquet(f"{_store(path).folder(version)}/closed")
        parts.append(stored.filter(F.col(WINDOW_DATE).isin(held)))
    return reduce(DataFrame.unionByName, parts)


def _tail(spark: SparkSession, path: str, folded: Folded, name: str) -> DataFrame:
    if folded.tail is None:
        return spark.createDataFrame([], _OPEN)
    return spark.read.schema(_OPEN).parquet(f"{_store(path).folder(folded.tail)}/{name}")


def compacted_log(spark: SparkSession, path: str) -> DataFrame:
    """The log with one row for each window that is folded; read it through `newest_versions`."""
    folded = _folded(_store(path).current(spark))
    rows = open_rows(spark, path, folded).unionByName(_closed_rows(spark, path, folded))
    return rows.select(*ZONE_WINDOW_LOG.names)


def live_zones(spark: SparkSession, path: str) -> DataFrame:
    """The latest window of each zone, without reading folded days."""
    folded = _folded(_store(path).current(spark))
    rows = open_rows(spark, path, folded).unionByName(_tail(spark, path, folded, "latest"))
    return reports.live_zone_view(newest_versions(rows.select(*ZONE_WINDOW_LOG.names)))


def newest_rows(spark: SparkSession, path: str, rows: int = 10) -> DataFrame:
    """The newest rows of the log, without reading folded days; at most KEPT_ROWS of these."""
    folded = _folded(_store(path).current(spark))
    found = open_rows(spark, path, folded).unionByName(_tail(spark, path, folded, "newest"))
    return reports.latest_windows(found.select(*ZONE_WINDOW_LOG.names), rows)


def _whole_batches(spark: SparkSession, path: str) -> dict[str, int]:
    """The last batch of each run that is written whole: batches follow each other."""
    place = spark._jvm.org.apache.hadoop.fs.Path(f"{path.rstrip('/')}/run=*/batch_id=*/_SUCCESS")
    files = place.getFileSystem(spark._jsc.hadoopConfiguration())
    last: dict[str, int] = {}
    for status in files.globStatus(place) or []:
        batch = status.getPath().getParent()
        run = batch.getParent().getName().partition("=")[2]
        last[run] = max(last.get(run, -1), int(batch.getName().partition("=")[2]))
    return last


def newest_whole(rows: DataFrame) -> DataFrame:
    """`newest_versions` with the run, batch and day of each row kept."""
    measures = [c for c in rows.columns if c not in WINDOW_KEYS]
    newest = F.max_by(F.struct(*measures), F.struct("processed_at", "batch_id")).alias("newest")
    return rows.groupBy(*WINDOW_KEYS).agg(newest).select(*WINDOW_KEYS, "newest.*")


def fold_closed_days(spark: SparkSession, path: str, before: date) -> list[str]:
    """Fold the days before `before`, later batches of earlier days included; returns the days.

    The stream may run meanwhile. A fold that fails changes nothing that readers see. Only days
    that have new rows are written again. Days are never opened again: an earlier `before`
    counts as the last one.
    """
    store = _store(path)
    commit = store.current(spark)
    old = _folded(commit)
    limit = max(before.isoformat(), old.before or "")
    new = Folded(limit, {**old.batches, **_whole_batches(spark, path)})
    rows = open_rows(spark, path, old).filter(new.covers())
    days = sorted(row[0].isoformat() for row in rows.select(WINDOW_DATE).distinct().collect())  # one a day
    if not days:
        return []
    version = store.begin(spark)
    try:
        folder = store.folder(version)
        every = rows.unionByName(_closed_rows(spark, path, old, set(days)))
        merged = newest_whole(every).select(*_OPEN.names)
        merged.hint("rebalance", WINDOW_DATE).write.partitionBy(WINDOW_DATE).parquet(f"{folder}/closed")
        seen = rows.unionByName(_tail(spark, path, old, "newest"))
        reports.latest_windows(seen, KEPT_ROWS).coalesce(1).write.parquet(f"{folder}/newest")
        stored = spark.read.schema(_OPEN).parquet(f"{folder}/closed")
        last = newest_whole(stored.unionByName(_tail(spark, path, old, "latest")))
        reports.live_zone_view(last).select(*_OPEN.names).coalesce(1).write.parquet(f"{folder}/latest")
    except BaseException:
        store.abort(spark, version)
        raise
    content = {
        "before": limit, "batches": new.batches,
        "days": {**old.days, **dict.fromkeys(days, version)}, "tail": version,
    }
    store.commit(spark, commit, content, version)
    _forget(spark, path, old)
    store.clean(spark, lambda c: {*c["days"].values(), c["tail"]})
    return days


def _forget(spark: SparkSession, path: str, folded: Folded) -> None:
    """Delete the log's folders that an earlier commit covers."""
    if folded.before is None:
        return
    place = spark._jvm.org.apache.hadoop.fs.Path(f"{path.rstrip('/')}/run=*/batch_id=*/{WINDOW_DATE}=*")
    files = place.getFileSystem(spark._jsc.hadoopConfiguration())
    for status in files.globStatus(place) or []:
        day = status.getPath()
        run, batch, name = (
            p.getName().partition("=")[2] for p in (day.getParent().getParent(), day.getParent(), day)
        )
        if name < folded.before and int(batch) <= folded.batches.get(run, -1):
            files.delete(day, True)
