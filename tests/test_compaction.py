"""Folding closed days of the window log."""

from collections import Counter
from datetime import date
from pathlib import Path

import pytest

from test_stream import GOOD, checkpoint_of, records
from wayfare.operators import reports
from wayfare.session import shared_dir
from wayfare.streaming import compaction, sinks, windows

DAY = "2024-01-01T"


class Log:
    """A log that batches are written to directly."""

    def __init__(self, spark):
        self.spark, self.path = spark, shared_dir(spark)
        self.runs = {}

    def write(self, run, batch, *events):
        """Events are (day of January, minute of the day, trips, processed minute)."""
        checkpoint = self.runs.setdefault(run, checkpoint_of(self.spark, run))
        parts = None
        for day, minute, trips, processed in events:
            lines = [
                (GOOD % (n, "10", f"{minute // 60:02d}:{minute % 60:02d}:00")).replace(DAY, f"2024-01-{day:02d}T")
                for n in range(trips)
            ]
            part = windows.zone_windows(
                windows.parse_events(records(self.spark, lines)), as_of=f"2024-02-01 00:{processed:02d}:00"
            )
            parts = part if parts is None else parts.unionByName(part)
        sinks.batch_writer(self.path, checkpoint)(parts, batch)

    def whole(self):
        return rows_of(windows.newest_versions(sinks.read_window_log(self.spark, self.path)))

    def folded(self):
        return rows_of(windows.newest_versions(compaction.compacted_log(self.spark, self.path)))

    def files(self):
        return sorted(
            str(p.relative_to(self.path.removeprefix("file:")))
            for p in Path(self.path.removeprefix("file:")).glob("run=*/batch_id=*/window_date=*")
        )


def rows_of(df):
    return Counter((r.window_start, r.zone_id, r.trip_count, r.processed_at) for r in df.collect())


@pytest.fixture
def log(spark):
    log = Log(spark)
    log.write("a", 0, (1, 1, 1, 1), (1, 7, 2, 1), (2, 1, 1, 1), (3, 1, 1, 1))
    log.write("a", 1, (1, 1, 3, 2), (3, 1, 2, 2), (4, 1, 1, 2))
    return log


def test_a_log_that_was_never_folded_reads_as_it_is(spark, log):
    assert log.folded() == log.whole()
    nothing = shared_dir(spark)
    assert compaction.compacted_log(spark, nothing).isEmpty() and compaction.live_zones(spark, nothing).isEmpty()
    assert compaction.fold_closed_days(spark, nothing, date(2024, 1, 3)) == []


def test_folded_days_hold_one_row_per_window(spark, log):
    expected = log.whole()
    assert compaction.fold_closed_days(spark, log.path, date(2024, 1, 3)) == ["2024-01-01", "2024-01-02"]
    assert log.folded() == expected
    # 3 windows are folded; of the open days every version stays.
    assert compaction.compacted_log(spark, log.path).count() == 3 + 3
    assert compaction.fold_closed_days(spark, log.path, date(2024, 1, 3)) == []


def test_late_rows_of_folded_days_count_and_are_folded_next(spark, log):
    compaction.fold_closed_days(spark, log.path, date(2024, 1, 3))
    log.write("a", 2, (1, 1, 7, 3), (2, 9, 1, 3), (4, 1, 5, 3))
    log.write("b", 0, (1, 7, 9, 4))
    expected = log.whole()
    assert log.folded() == expected
    assert compaction.fold_closed_days(spark, log.path, date(2024, 1, 4)) == [
        "2024-01-01", "2024-01-02", "2024-01-03",
    ]
    assert log.folded() == expected
    # The folders that the first fold covered are gone, later ones wait for the next.
    assert [f for f in log.files() if "batch_id=0" in f and "run=a" in f] == ["run=a/batch_id=0/window_date=2024-01-03"]
    assert "run=b/batch_id=0/window_date=2024-01-01" in log.files()
    log.write("a", 3, (5, 1, 1, 5))
    compaction.fold_closed_days(spark, log.path, date(2024, 1, 5))
    assert {f[-10:] for f in log.files()} == {"2024-01-04", "2024-01-05"}
    assert Counter({k: n for k, n in log.folded().items() if k[0].day < 5}) == expected


def test_readers_overlap_with_a_fold(spark, log, monkeypatch):
    before = compaction.compacted_log(spark, log.path)
    expected = log.whole()
    seen = []
    commit = compaction.VersionStore.commit

    def slow(store, *args):
        seen.append(log.folded())
        found = commit(store, *args)
        seen.append(log.folded())
        return found

    monkeypatch.setattr(compaction.VersionStore, "commit", slow)
    compaction.fold_closed_days(spark, log.path, date(2024, 1, 4))
    assert seen == [expected, expected]
    assert rows_of(windows.newest_versions(before)) == expected


def test_a_fold_that_fails_changes_nothing(spark, log, monkeypatch):
    expected = log.whole()
    monkeypatch.setattr(compaction.reports, "latest_windows", lambda *_: 1 / 0)
    with pytest.raises(ZeroDivisionError):
        compaction.fold_closed_days(spark, log.path, date(2024, 1, 4))
    assert log.folded() == expected == log.whole()
    assert not list(Path(log.path.removeprefix("file:")).glob("_closed/data/*"))


def test_a_batch_that_is_not_whole_is_not_folded(spark, log):
    log.write("a", 2, (1, 1, 50, 9))
    Path(log.path.removeprefix("file:"), "run=a/batch_id=2/_SUCCESS").unlink()
    compaction.fold_closed_days(spark, log.path, date(2024, 1, 3))
    log.write("a", 2, (1, 1, 60, 9))
    assert log.folded() == log.whole()
    assert max(n for _, _, n, _ in log.folded()) == 60


def test_live_view_and_newest_rows_equal_those_of_the_whole_log(spark, log):
    def whole():
        log_rows = sinks.read_window_log(spark, log.path)
        live = reports.live_zone_view(windows.newest_versions(log_rows))
        return rows_of(live), rows_of(reports.latest_windows(log_rows, 4))

    def found():
        return rows_of(compaction.live_zones(spark, log.path)), rows_of(compaction.newest_rows(spark, log.path, 4))

    assert found() == whole()
    compaction.fold_closed_days(spark, log.path, date(2024, 1, 5))
    assert found() == whole()
    log.write("a", 2, (4, 1, 8, 3), (2, 3, 1, 3))
    expected = whole()
    assert found() == expected
    compaction.fold_closed_days(spark, log.path, date(2024, 1, 5))
    assert found() == expected


def test_plans_read_open_days_only(spark, log):
    compaction.fold_closed_days(spark, log.path, date(2024, 1, 3))
    log.write("a", 2, (4, 3, 1, 3))
    for found in (compaction.live_zones(spark, log.path), compaction.newest_rows(spark, log.path)):
        plan = found._jdf.queryExecution().executedPlan().toString()
        assert "window_date" in plan.split("PartitionFilters")[1].split("PushedFilters")[0]
        assert found.collect()
    compaction.fold_closed_days(spark, log.path, date(2024, 1, 4))
    read = [f for f in compaction.live_zones(spark, log.path).inputFiles() if "/_closed/" not in f]
    assert read and not [f for f in read if "window_date=2024-01-01" in f or "window_date=2024-01-02" in f]
    assert not [f for f in compaction.live_zones(spark, log.path).inputFiles() if "/closed/" in f]
