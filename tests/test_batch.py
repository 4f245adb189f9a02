"""The batch run end to end: loads, look-back, incremental days, audit."""

import json
from collections import Counter
from datetime import datetime
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from wayfare import __main__ as command
from wayfare import registry, schemas
from wayfare.fixtures import fixture
from wayfare.functions import moment
from wayfare.operators import extract, marts, staging
from wayfare.plans import batch, checks
from wayfare.plans.batch import Sources, Warehouse, run_batch, run_manual_load, warehouse_counts
from wayfare.session import configure, shared_dir
from wayfare.sources import targets
from wayfare.sources.targets import ParquetTable
from wayfare.sources.versions import VersionedTable

DATA = "/root/testdata/sf0.001"
AS_OF = datetime(2001, 8, 1)


@pytest.fixture(scope="module")
def sources(spark):
    fx = fixture(spark, DATA)
    # All trips within the 31 days up to AS_OF, so that gold has 31 folders.
    day = F.expr("TIMESTAMP_NTZ '2001-07-01 00:00:00' + INTERVAL '1' DAY * CAST(user_id % 31 AS INT)")
    tables = {name: fx[name] for name in ("drivers", "zones", "payments")}
    tables["trips"] = fx.trips.withColumn(
        "requested_at", day + (F.col("requested_at") - F.date_trunc("day", "requested_at"))
    )
    # Stored once, as they would be in the source database.
    stored = {}
    for name, df in tables.items():
        path = shared_dir(spark)
        df.write.parquet(path)
        stored[name] = spark.read.schema(df.schema).parquet(path)
    return Sources(**stored)


def rows_of(df):
    return Counter(tuple(row) for row in df.collect())


def test_full_load(spark, sources):
    warehouse = Warehouse.at(shared_dir(spark))
    audit = run_batch(spark, sources, warehouse, AS_OF, lookback_hours=None)

    fact = warehouse.fct_trips.read(spark)
    assert fact.columns == schemas.FCT_TRIPS.names and len(fact.columns) == 25
    trips = staging.clean_trips(extract.trips_with_zones(sources.trips, sources.zones))
    wanted = marts.fct_trips(trips, staging.clean_payments(sources.payments), AS_OF)
    assert rows_of(fact) == rows_of(wanted)
    dim = warehouse.dim_drivers.read(spark)
    assert len(dim.columns) == 10
    assert rows_of(dim) == rows_of(registry._dim(fixture(spark, DATA)).select(dim.columns).withColumn(
        "_dbt_loaded_at", moment(AS_OF)))

    staged = warehouse.stg_trips.read(spark)
    assert staged.filter("_loaded_at IS NULL").isEmpty()
    logged = warehouse.audit.read(spark).collect()
    assert len(logged) == 1
    assert logged[0].rows_loaded == staged.count() + sources.payments.count()
    assert (logged[0].status, logged[0].pipeline) == ("success", "batch")
    assert logged[0].run_id == audit.first().run_id
    for view in ("mart_stg_trips", "mart_stg_drivers", "mart_stg_payments"):
        assert spark.table(view).count() > 0


def test_lookback_run_rebuilds_gold_from_what_it_covers(spark, sources):
    warehouse = Warehouse.at(shared_dir(spark))
    run_batch(spark, sources, warehouse, AS_OF, lookback_hours=None)
    payments = rows_of(warehouse.stg_payments.read(spark))
    # Nothing new among the payments: the staged ones stay while trips are replaced.
    later = datetime(2002, 1, 1)
    run_batch(spark, sources, warehouse, later, lookback_hours=24)
    assert rows_of(warehouse.stg_payments.read(spark)) == payments
    assert warehouse.stg_trips.read(spark).isEmpty()
    assert warehouse.fct_trips.read(spark).isEmpty()
    loaded = [row.rows_loaded for row in warehouse.audit.read(spark).orderBy("started_at").collect()]
    assert len(loaded) == 2 and loaded[1] == 0


def test_incremental_run_replaces_only_its_days(spark, sources):
    warehouse = Warehouse.at(shared_dir(spark))
    run_batch(spark, sources, warehouse, AS_OF, lookback_hours=None)
    rows_before = warehouse.fct_trips.read(spark).count()
    # Trips of the last ten days changed their vehicle; payments did not change.
    changed = sources.trips.withColumn("vehicle_type", F.lit("tuk_tuk"))
    later = Sources(changed, sources.drivers, sources.zones, sources.payments)
    run_batch(spark, later, warehouse, AS_OF, lookback_hours=240, incremental=True)
    fact = warehouse.fct_trips.read(spark)
    old = fact.filter("trip_date < '2001-07-22'")
    new = fact.filter("trip_date >= '2001-07-22'")
    assert not new.isEmpty() and {r[0] for r in new.select("vehicle_type").collect()} == {"tuk_tuk"}
    assert old.filter("vehicle_type = 'tuk_tuk'").isEmpty()
    assert fact.count() == rows_before
    assert fact.select("fct_trip_sk").distinct().count() == fact.count()
    assert new.agg(F.min("fct_trip_sk")).first()[0] > old.agg(F.max("fct_trip_sk")).first()[0]


def test_incremental_run_within_a_day_equals_a_full_load(spark, sources):
    """Payments of the first night, trips whose zone became unknown, a day without trips."""
    as_of = datetime(2001, 8, 1, 1)
    created = F.col("created_at") - (F.col("created_at") - F.date_trunc("day", "created_at"))
    payments = sources.payments.withColumn("created_at", created + F.expr("INTERVAL '30' MINUTE"))
    warehouse = Warehouse.at(shared_dir(spark))
    run_batch(spark, Sources(sources.trips, sources.drivers, sources.zones, payments), warehouse,
              as_of, lookback_hours=None)
    zone = F.when(F.col("requested_at") >= "2001-07-30", 9999).otherwise(F.col("pickup_zone_id"))
    changed = sources.trips.withColumn("pickup_zone_id", zone.cast("int"))
    later = Sources(changed, sources.drivers, sources.zones, payments)
    run_batch(spark, later, warehouse, as_of, lookback_hours=72, incremental=True)
    full = Warehouse.at(shared_dir(spark))
    run_batch(spark, later, full, as_of, lookback_hours=None)
    found, expected = (
        Counter(map(tuple, w.fct_trips.read(spark).drop("fct_trip_sk", "_dbt_loaded_at").collect()))
        for w in (warehouse, full)
    )
    before = {row for row in expected if str(row[8]) < "2001-07-29"}
    assert {row for row in found if str(row[8]) < "2001-07-29"} == before
    fact = warehouse.fct_trips.read(spark)
    assert fact.filter("trip_date >= '2001-07-30'").isEmpty()
    assert fact.select("fct_trip_sk").distinct().count() == fact.count()
    assert sum(found.values()) == sum(expected.values())


def test_an_incremental_run_reads_no_stored_fact(spark, sources, monkeypatch):
    warehouse = Warehouse.at(shared_dir(spark))
    run_batch(spark, sources, warehouse, AS_OF, lookback_hours=None)
    rows = warehouse.fct_trips.read(spark).count()
    assert warehouse.fct_trips.last_key(spark) == rows
    read = VersionedTable.read

    def watched(table, session):
        assert not table.path.endswith("fct_trips")
        return read(table, session)

    monkeypatch.setattr(VersionedTable, "read", watched)
    run_batch(spark, sources, warehouse, AS_OF, lookback_hours=240, incremental=True)
    monkeypatch.undo()
    fact = warehouse.fct_trips.read(spark)
    assert fact.filter("trip_date >= '2001-07-22'").agg(F.min("fct_trip_sk")).first()[0] == rows + 1
    assert warehouse.fct_trips.last_key(spark) == fact.agg(F.max("fct_trip_sk")).first()[0]


def test_the_gate_keeps_payments_from_multiplying_the_fact(spark, sources):
    fx = fixture(spark, DATA)
    dirty = Sources(sources.trips, sources.drivers, sources.zones, fx.payments_dirty)
    open_gate, closed = Warehouse.at(shared_dir(spark)), Warehouse.at(shared_dir(spark))
    run_batch(spark, dirty, open_gate, AS_OF, lookback_hours=None)
    run_batch(spark, dirty, closed, AS_OF, lookback_hours=None, gate=True)
    held = closed.quarantine.read(spark)
    reasons = {r.reason: r["count"] for r in held.groupBy("reason").count().collect()}
    assert set(reasons) == {"missing_key", "repeated_key"}
    trips = staging.clean_trips(closed.stg_trips.read(spark))
    assert closed.fct_trips.read(spark).count() == trips.count() < open_gate.fct_trips.read(spark).count()
    logged = {r.pipeline: (r.rows_loaded, r.status) for r in closed.audit.read(spark).collect()}
    assert logged["batch_quarantine"] == (held.count(), "warning_quarantined")
    assert logged["batch"][1] == "success"


def test_a_run_leaves_two_versions_at_most(spark, sources):
    warehouse = Warehouse.at(shared_dir(spark))
    for _ in range(3):
        run_batch(spark, sources, warehouse, AS_OF, lookback_hours=None)
    for table in (warehouse.stg_trips, warehouse.fct_trips):
        assert len(list((Path(table.path.removeprefix("file:")) / "data").iterdir())) == 2


def test_a_run_leaves_nothing_in_the_shared_folder(spark, sources, tmp_path):
    shared = Path(spark.conf.get("spark.checkpoint.dir"))
    before = set(shared.iterdir())
    warehouse = Warehouse.at(str(tmp_path / "lake"))
    for gate in (False, True):
        run_batch(spark, sources, warehouse, AS_OF, lookback_hours=None, gate=gate)
    run_manual_load(spark, sources, warehouse)
    broken = Sources(sources.trips.drop("base_fare"), sources.drivers, sources.zones, sources.payments)
    with pytest.raises(Exception):
        run_batch(spark, broken, warehouse, AS_OF, lookback_hours=None)
    assert set(shared.iterdir()) == before
    assert warehouse.fct_trips.read(spark).count() > 0
    assert spark.table("mart_stg_payments").count() > 0


def test_every_job_sizes_its_shuffles_by_the_input(spark, sources, monkeypatch):
    initial = "spark.sql.adaptive.coalescePartitions.initialPartitionNum"
    seen = []

    def sized(session, input_bytes=0):
        seen.append(input_bytes)
        return session

    warehouse = Warehouse.at(shared_dir(spark))
    run_batch(spark, sources, warehouse, AS_OF, lookback_hours=None)
    for module in (batch, checks):
        monkeypatch.setattr(module, "planned_bytes", lambda *_: 100 << 40)
        monkeypatch.setattr(module, "configure", sized)
    run_manual_load(spark, sources, warehouse)
    warehouse_counts(spark, warehouse)
    checks.run_reports(spark, warehouse)
    run_batch(spark, sources, warehouse, AS_OF)
    assert seen == [100 << 40] * 4
    monkeypatch.undo()
    before = spark.conf.get(initial, None)
    try:
        assert int(configure(spark, 100 << 40).conf.get(initial)) == 409_600
    finally:
        spark.conf.unset(initial) if before is None else spark.conf.set(initial, before)
        spark.conf.unset("spark.sql.files.maxPartitionBytes")


def test_a_failed_run_is_logged(spark, sources):
    warehouse = Warehouse.at(shared_dir(spark))
    broken = Sources(sources.trips.drop("base_fare"), sources.drivers, sources.zones, sources.payments)
    with pytest.raises(Exception):
        run_batch(spark, broken, warehouse, AS_OF)
    assert [row.status for row in warehouse.audit.read(spark).collect()] == ["failed"]


def test_quality_run_counts_and_can_stop(spark):
    fx = fixture(spark, DATA)
    audit = ParquetTable(shared_dir(spark), schemas.AUDIT)
    status = F.when(F.col("user_id") % 5 == 0, "lost").otherwise(F.col("status"))
    dirty = Sources(fx.trips.withColumn("status", status), fx.drivers, fx.zones, fx.payments_dirty)
    found = {(r.check, r.table_name, r.column_name): r.bad_rows
             for r in checks.run_quality(spark, dirty, audit, AS_OF).collect()}
    copies = fx.payments_dirty.groupBy("trip_id").count().filter("count > 1 AND trip_id IS NOT NULL")
    assert found["duplicate", "payments", "trip_id"] == copies.agg(F.sum(F.col("count") - 1)).first()[0]
    assert {name for name, _, _ in found} == {"duplicate", "null", "orphan", "domain", "balance"}
    with pytest.raises(ValueError):
        checks.run_quality(spark, dirty, audit, AS_OF, fail_on=("duplicate",))
    assert [r.status for r in audit.read(spark).collect()] == ["warning", "warning"]


def test_append_repeats_rows_and_refresh_replaces_them(spark):
    df = spark.range(10)
    table = ParquetTable(shared_dir(spark), df.schema)
    assert [targets.append(df, table), targets.append(df, table)] == [10, 10]
    assert table.read(spark).count() == 20
    assert targets.full_refresh(spark.range(3), table) == 3
    assert table.read(spark).count() == 3
    assert targets.refresh_unless_empty(spark.range(0), table) == 0
    assert table.read(spark).count() == 3
    assert targets.refresh_unless_empty(spark.range(4), table) == 4
    assert table.read(spark).count() == 4


def test_ordered_load_writes_key_order(spark):
    df = spark.range(5000).select(
        F.when(F.col("id") % 3 == 0, 40).otherwise(5000 - F.col("id")).alias("trip_id")
    ).repartition(4)
    table = ParquetTable(shared_dir(spark), df.schema)
    targets.append_ordered(df, "trip_id", table)
    files = table.read(spark).select("trip_id", F.input_file_name().alias("file"),
                                     F.monotonically_increasing_id().alias("row")).collect()
    ordered = [r.trip_id for r in sorted(files, key=lambda r: (r.file.split("/")[-1], r.row))]
    assert len(ordered) == 5000 and ordered == sorted(ordered)


def test_fact_with_repeated_trips_and_payments_keeps_every_row(spark):
    fx = fixture(spark, DATA)
    trips = staging.clean_trips(registry._staged_trips(fx))
    hot = trips.withColumn(
        "trip_id", F.when(F.col("trip_id") % 3 == 0, 12).otherwise(F.col("trip_id"))
    )
    payments = staging.clean_payments(fx.payments)
    paid = payments.withColumn(
        "trip_id", F.when(F.col("trip_id") % 3 == 1, 25).otherwise(F.col("trip_id"))
    )
    fact = marts.fct_trips(hot, paid, AS_OF, row_limit=200)
    plain = hot.select(*marts.FACT_COLUMNS).join(marts._payment_facts(paid), "trip_id", "left")
    columns = [*marts.FACT_COLUMNS, *marts.PAYMENT_FACTS]
    assert rows_of(fact.select(columns)) == rows_of(plain.select(columns))
    keys = [row[0] for row in fact.select("fct_trip_sk").collect()]
    assert sorted(keys) == list(range(1, len(keys) + 1))


def test_command_line_runs_batch_manual_load_and_monitor(spark, sources, tmp_path):
    fx = fixture(spark, DATA)
    config = {"warehouse": shared_dir(spark), "stream": {"log": shared_dir(spark)}}
    for name in ("trips", "drivers", "zones"):
        config[name] = {"format": "parquet", "path": shared_dir(spark)}
        getattr(sources, name).write.parquet(config[name]["path"])
    config["payments"] = {"format": "json", "path": shared_dir(spark)}
    fx.payments.write.json(config["payments"]["path"])
    file = tmp_path / "job.json"
    file.write_text(json.dumps(config))

    def run(job, *more):
        command.main([job, "--config", str(file), "--as-of", "2001-08-01T00:00:00", *more])

    # The first nightly run may find no payments and no staged payments either.
    run("batch", "--as-of", "2101-01-01T00:00:00")
    warehouse = Warehouse.at(config["warehouse"])
    assert warehouse.fct_trips.read(spark).isEmpty()
    run("batch", "--full")
    counts = {r.table_name: r.row_count for r in warehouse_counts(spark, warehouse).collect()}
    assert counts["stg_payments"] == fx.payments.count()
    assert counts["fct_trips"] == counts["mart_stg_trips"] < counts["stg_trips"]
    run("manual-load")
    twice = {r.table_name: r.row_count for r in warehouse_counts(spark, warehouse).collect()}
    for name in ("stg_trips", "stg_drivers", "mart_stg_trips"):
        assert twice[name] == 2 * counts[name]
    assert twice["fct_trips"] == counts["fct_trips"]
    run("monitor")
    statuses = [r.status for r in warehouse.audit.read(spark).collect()]
    assert sorted(statuses) == ["success", "success", "warning_empty_table"]


def test_quality_counts_cover_all_required_and_unique_columns(spark):
    fx = fixture(spark, DATA)
    first = F.col("driver_id") == fx.drivers.agg(F.min("driver_id")).first()[0]
    drivers = fx.drivers.withColumns({
        "full_name": F.when(~first, F.col("full_name")), "national_id": F.lit("1"),
    })
    sources = Sources(fx.trips, drivers, fx.zones, fx.payments, fx.users.withColumn("phone", F.lit("1")))
    found = {(r.check, r.table_name, r.column_name): r.bad_rows
             for r in checks.quality_counts(sources).collect()}
    assert found["null", "drivers", "full_name"] == 1
    assert found["duplicate", "drivers", "national_id"] == fx.drivers.count() - 1
    assert found["duplicate", "users", "phone"] == fx.users.count() - 1
