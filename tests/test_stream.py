"""The streaming lane: parsing, versions, restarts, late events, retries, monitoring."""

from datetime import datetime

from pyspark.sql import functions as F

from wayfare import registry, schemas
from wayfare.fixtures import fixture
from wayfare.operators import reports
from wayfare.plans.stream import run_monitor, run_stream
from wayfare.session import keep_state_on_disk, shared_dir
from wayfare.sources import readers
from wayfare.sources.targets import ParquetTable
from wayfare.sources.versions import VersionedTable
from wayfare.streaming import sinks, windows

GOOD = (
    '{"event_type": "trip_completed", "trip_id": %d, "driver_id": 2, "fare_egp": %s,'
    ' "distance_km": 3.5, "zone_id": 4, "timestamp": "2024-01-01T%sZ"}'
)


def records(spark, values):
    rows = [(None, value.encode(), "trip_events", datetime(2024, 1, 1)) for value in values]
    return spark.createDataFrame(rows, schemas.BROKER_RECORD)


class Stream:
    def __init__(self, spark, late_tolerance=None):
        self.spark, self.late_tolerance = spark, late_tolerance
        self.landing, self.log, self.checkpoint = (shared_dir(spark) for _ in range(3))

    def arrive(self, *values):
        records(self.spark, values).write.mode("append").parquet(self.landing)
        run_stream(
            readers.stream_landing(self.spark, self.landing), self.log, self.checkpoint,
            self.late_tolerance, trigger_seconds=None,
        ).awaitTermination()

    def versions(self):
        return sinks.read_window_log(self.spark, self.log)

    def counts(self):
        newest = windows.newest_versions(self.versions()).collect()
        return {row.window_start.strftime("%H:%M"): row.trip_count for row in newest}


def test_bad_records_become_nulls(spark):
    values = [
        GOOD % (1, "10.5", "00:01:00"), "not json", '{"trip_id": "x", "zone_id": 5}',
        '{"event_type": "trip_completed", "timestamp": "never"}', "",
    ]
    rows = windows.parse_events(records(spark, values)).collect()
    assert len(rows) == 5
    assert rows[0].event_time == datetime(2024, 1, 1, 0, 1) and rows[0].fare_egp == 10.5
    assert rows[1].trip_id is None and rows[1].event_time is None
    assert rows[2].trip_id is None and rows[2].zone_id == 5
    assert rows[3].event_type == "trip_completed" and rows[3].event_time is None


def test_windows_are_half_open_and_keep_missing_zones(spark):
    values = [GOOD % (1, "10", "00:00:00"), GOOD % (2, "20", "00:04:59.999999"),
              GOOD % (3, "40", "00:05:00"),
              (GOOD % (4, "1", "00:00:30")).replace('"zone_id": 4', '"zone_id": null'),
              (GOOD % (5, "NaN", "00:05:30")).replace('"trip_id": 5', '"trip_id": null')]
    rows = windows.zone_windows(windows.parse_events(records(spark, values))).collect()
    found = {(row.window_start.minute, row.zone_id): row for row in rows}
    assert set(found) == {(0, 4), (0, None), (5, 4)}
    first, second = found[0, 4], found[5, 4]
    assert (first.trip_count, float(first.total_revenue_egp), float(first.avg_fare_egp)) == (2, 30, 15)
    # A missing trip id is not counted; a fare that is no number is left out of the sums.
    assert (second.trip_count, float(second.avg_fare_egp)) == (1, 40)


def test_update_versions_collapse_to_the_newest(spark):
    stream = Stream(spark)
    stream.arrive(GOOD % (1, "10", "00:01:00"), GOOD % (2, "10", "00:11:00"))
    stream.arrive(GOOD % (3, "5", "00:02:00"))
    assert stream.versions().count() == 3
    assert stream.counts() == {"00:00": 2, "00:10": 1}
    live = reports.live_zone_view(windows.newest_versions(stream.versions())).collect()
    assert [(row.zone_id, row.window_start.minute) for row in live] == [(4, 10)]


def test_state_on_disk_gives_the_same_windows(spark):
    settings = ("providerClass", "rocksdb.changelogCheckpointing.enabled")
    names = [f"spark.sql.streaming.stateStore.{name}" for name in settings]
    before = {name: spark.conf.get(name, None) for name in names}
    try:
        keep_state_on_disk(spark)
        stream = Stream(spark)
        stream.arrive(GOOD % (1, "10", "00:01:00"))
        stream.arrive(GOOD % (3, "5", "00:02:00"))
    finally:
        for name, value in before.items():
            if value is None:
                spark.conf.unset(name)
            else:
                spark.conf.set(name, value)
    assert stream.counts() == {"00:00": 2}


def test_late_events_without_and_with_a_tolerance(spark):
    for tolerance, first_window in ((None, 2), ("10 minutes", 1)):
        stream = Stream(spark, tolerance)
        stream.arrive(GOOD % (1, "10", "00:01:00"), GOOD % (2, "10", "01:00:00"))
        stream.arrive(GOOD % (3, "10", "00:02:00"))
        assert stream.counts() == {"00:00": first_window, "01:00": 1}


def checkpoint_of(spark, run):
    path = shared_dir(spark)
    lines = spark.createDataFrame([(f'{{"id":"{run}"}}',)], "value string")
    lines.coalesce(1).write.text(f"{path}/metadata")
    return path


def test_a_new_checkpoint_keeps_what_was_written(spark):
    path = shared_dir(spark)
    events = [GOOD % (i, "10", f"{i:02d}:01:00") for i in range(20)]
    log = windows.zone_windows(windows.parse_events(records(spark, events)))
    sinks.batch_writer(path, checkpoint_of(spark, "one"))(log.repartition(8), 0)
    later = windows.zone_windows(windows.parse_events(records(spark, events[:1] * 3)))
    sinks.batch_writer(path, checkpoint_of(spark, "two"))(later, 0)
    stored = sinks.read_window_log(spark, path)
    newest = windows.newest_versions(stored).collect()
    assert sorted(row.trip_count for row in newest) == [1] * 19 + [3]
    assert len(stored.inputFiles()) == 2


def test_no_amount_is_lost_or_stops_the_stream(spark):
    fares = ["100000000", "10000000000000", "-7.5", '"NaN"', '"Infinity"', "1e30", "null", "3"]
    event = (
        '{"event_type":"trip_completed","trip_id":%d,"driver_id":1,"fare_egp":%s,'
        '"distance_km":2,"zone_id":1,"timestamp":"2024-01-01T00:01:00Z"}'
    )
    lines = [event % (i, fare) for i, fare in enumerate(fares)]
    row = windows.zone_windows(windows.parse_events(records(spark, lines))).first()
    assert row.trip_count == len(fares) and row.unusable_values == 3
    assert float(row.total_revenue_egp) == 1e8 + 1e13 - 7.5 + 3


def test_empty_batches_write_nothing_and_retries_overwrite(spark):
    path = shared_dir(spark)
    write = sinks.batch_writer(path, checkpoint_of(spark, "one"))
    batch = windows.zone_windows(
        windows.parse_events(records(spark, [GOOD % (1, "10", "00:01:00")]))
    )
    write(batch.filter("false"), 0)
    assert sinks.read_window_log(spark, path).isEmpty()
    write(batch, 1)
    write(batch, 1)
    assert [row.batch_id for row in sinks.read_window_log(spark, path).collect()] == [1]


def test_a_batch_repeated_into_a_table_counts_once(spark):
    log = ParquetTable(shared_dir(spark), schemas.ZONE_WINDOW_LOG)
    write = sinks.batch_writer(log, checkpoint_of(spark, "one"))
    batch = windows.zone_windows(
        windows.parse_events(records(spark, [GOOD % (1, "10", "00:01:00")]))
    )
    write(batch, 3)
    write(batch, 3)
    assert log.read(spark).count() == 2
    newest = windows.newest_versions(log.read(spark)).collect()
    assert [row.trip_count for row in newest] == [1]


def test_a_batch_repeated_into_a_versioned_table_is_there_once(spark):
    log = VersionedTable(shared_dir(spark), schemas.ZONE_WINDOW_LOG)
    batch = windows.zone_windows(
        windows.parse_events(records(spark, [GOOD % (1, "10", "00:01:00")]))
    )
    write = sinks.batch_writer(log, checkpoint_of(spark, "one"))
    for number in (3, 3, 4, 3):
        write(batch, number)
    other = sinks.batch_writer(log, checkpoint_of(spark, "two"))
    other(batch, 0)
    other(batch, 0)
    found = sorted((row.run, row.batch_id) for row in log.read(spark).collect())
    assert found == [("one", 3), ("one", 4), ("two", 0)]


def test_a_backlog_is_worked_off_in_bounded_batches(spark):
    stream = Stream(spark)
    for n in range(6):
        line = records(spark, [GOOD % (n, "1", f"{n:02d}:01:00")])
        line.coalesce(1).write.mode("append").parquet(stream.landing)
    before = spark.conf.get("spark.sql.shuffle.partitions")
    try:
        query = run_stream(
            readers.stream_landing(spark, stream.landing, files_per_trigger=2), stream.log, stream.checkpoint,
            trigger_seconds=None, state_partitions=3,
        )
        query.awaitTermination()
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
    sizes = [p["numInputRows"] for p in query.recentProgress if p["numInputRows"]]
    assert sizes == [2, 2, 2]
    assert query.recentProgress[0]["stateOperators"][0]["numShufflePartitions"] == 3
    # A later start has the partitions of the checkpoint.
    stream.arrive(GOOD % (9, "1", "00:02:00"))
    assert stream.counts()["00:00"] == 2


def test_fixture_stream_rewrites_windows(spark):
    fx = fixture(spark, "/root/testdata/sf0.01")
    log = registry._Arrivals(fx).window_log(registry.ODD)
    assert log.count() > windows.newest_versions(log).count()


def test_newest_rows_first(spark):
    stream = Stream(spark)
    stream.arrive(*(GOOD % (i, "1", f"{i:02d}:01:00") for i in range(12)))
    stream.arrive(GOOD % (99, "1", "00:02:00"))
    newest = reports.latest_windows(stream.versions()).collect()
    assert len(newest) == 10 and newest[0].window_start == datetime(2024, 1, 1)
    assert [row.window_start.hour for row in newest[1:]] == list(range(11, 2, -1))


def test_monitor_warns_but_never_fails(spark):
    audit = ParquetTable(shared_dir(spark), schemas.AUDIT)
    nothing = sinks.read_window_log(spark, shared_dir(spark))
    run_monitor(nothing, audit, datetime(2024, 1, 1), datetime(2024, 1, 1))
    log = windows.zone_windows(
        windows.parse_events(records(spark, [GOOD % (1, "10", "00:01:00")])),
        as_of="2024-01-01 00:10:00",
    )
    run_monitor(log, audit, datetime(2024, 1, 1, 0, 40), datetime(2024, 1, 1, 0, 40))
    run_monitor(log, audit, datetime(2024, 1, 1, 0, 41), datetime(2024, 1, 1, 0, 41))
    rows = audit.read(spark).orderBy("started_at").collect()
    assert [(row.rows_loaded, row.status) for row in rows] == [
        (0, "warning_empty_table"), (1, "healthy"), (0, "warning_no_recent_data")
    ]


def test_parsed_times_do_not_depend_on_the_session_zone(spark):
    zone = spark.conf.get("spark.sql.session.timeZone")
    try:
        spark.conf.set("spark.sql.session.timeZone", "Africa/Cairo")
        event = windows.parse_events(records(spark, [GOOD % (1, "1", "00:01:00")]))
        seconds = event.select(F.unix_timestamp("event_time")).first()[0]
    finally:
        spark.conf.set("spark.sql.session.timeZone", zone)
    assert seconds == 1704067260
