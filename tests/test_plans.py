"""Physical plans: what is read, broadcast and exchanged."""

import re
from contextlib import contextmanager

import pytest
from pyspark.sql import functions as F

from wayfare import registry
from wayfare.fixtures import fixture
from wayfare.operators import extract, marts, numbering, reports, staging
from wayfare.session import broadcast_if_small, configure, shared_dir

DATA = "/root/testdata/sf0.001"


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@contextmanager
def setting(spark, name, value):
    before = spark.conf.get(name)
    spark.conf.set(name, value)
    try:
        yield
    finally:
        spark.conf.set(name, before)


@pytest.fixture(scope="module")
def stored(spark):
    """Source tables as stored files, so that filters and columns can reach the scan."""
    fx = fixture(spark, DATA)
    tables = {}
    for name in ("trips", "zones", "payments", "drivers"):
        path = shared_dir(spark)
        fx[name].write.parquet(path)
        tables[name] = spark.read.schema(fx[name].schema).parquet(path)
    return tables


def test_zones_are_broadcast_and_the_lookback_reaches_the_scan(spark, stored):
    df = extract.extract_trips(stored["trips"], stored["zones"], "2001-08-01 00:00:00", 24)
    text = plan(df)
    assert text.count("BroadcastHashJoin") == 2 and "SortMergeJoin" not in text
    assert re.search(r"PushedFilters: \[[^]]*GreaterThanOrEqual\(requested_at", text)
    assert "hashpartitioning" not in text


def test_large_zone_side_is_not_broadcast(spark, stored):
    with setting(spark, "spark.sql.autoBroadcastJoinThreshold", "-1"):
        few = extract.drivers_with_zones(stored["drivers"], broadcast_if_small(stored["zones"]))
        assert "BroadcastHashJoin" in plan(few)
        zones = broadcast_if_small(stored["zones"], max_rows=3)
        many = extract.drivers_with_zones(stored["drivers"], zones)
        assert "SortMergeJoin" in plan(many)


def test_reports_read_only_their_columns(spark, stored):
    trips = staging.clean_trips(extract.trips_with_zones(stored["trips"], stored["zones"]))
    text = plan(reports.peak_hours(marts.fact_rows(trips, staging.clean_payments(stored["payments"]))))
    schemas_read = re.findall(r"ReadSchema: struct<([^>]*)>", text)
    assert not any("surge_fare" in s or "distance_km" in s for s in schemas_read)
    assert not any("net_amount_egp" in s for s in schemas_read)


def test_fact_exchanges_each_wide_row_once(spark, stored):
    """With nothing broadcast, the join and the numbering share one exchange per side."""
    with setting(spark, "spark.sql.autoBroadcastJoinThreshold", "-1"):
        trips = staging.clean_trips(
            extract.trips_with_zones(stored["trips"], broadcast_if_small(stored["zones"]))
        )
        fact = marts.fct_trips(trips, staging.clean_payments(stored["payments"]), "2001-08-01 00:00:00")
        text = plan(fact)
    wide = [line for line in text.splitlines() if "Exchange hashpartitioning(_bucket" in line]
    # trips, payments, and the small table of bucket starts
    assert len(wide) == 3
    assert "SortMergeJoin [_bucket" in text and "LeftOuter" in text
    singles = [line for line in text.splitlines() if "Exchange SinglePartition" in line]
    assert len(singles) == 1  # the running sum over bucket counts, never over rows


def test_key_counts_of_a_join_are_exchanged_twice(spark, stored):
    """The keys of both sides together, combined before; then the sums of the buckets."""
    with setting(spark, "spark.sql.autoBroadcastJoinThreshold", "-1"):
        sides = [
            df.select("trip_id").withColumn(numbering.BUCKET, numbering.bucket_of(F.col("trip_id")))
            for df in (stored["trips"], stored["payments"])
        ]
        text = plan(numbering._join_counts(*sides, "trip_id"))
    assert text.count("Exchange hashpartitioning") == 2 and "Join" not in text
    assert text.count("partial_sum") >= 2


def test_numbering_has_no_window_over_all_rows(spark):
    df = spark.range(1000)
    text = plan(numbering.surrogate_key(df, "id", "sk"))
    for line in text.splitlines():
        if "row_number()" in line and "Window" in line:
            assert "windowspecdefinition(_bucket" in line


def test_every_registered_report_aggregates_before_its_exchange(spark):
    for name in ("kpi_overview", "revenue_trend", "driver_performance", "dq_duplicates",
                 "zone_windows"):
        text = plan(registry.QUERIES[name](spark, DATA))
        assert "partial_" in text, name


def test_shuffle_size_follows_the_input_and_is_never_lowered(spark):
    initial = "spark.sql.adaptive.coalescePartitions.initialPartitionNum"
    split = spark.conf.get("spark.sql.files.maxPartitionBytes")
    try:
        configure(spark, 1 << 40)
        assert spark.conf.get(initial) == "4096"
        configure(spark, 1 << 30)
        assert spark.conf.get(initial) == "4096"
        configure(spark, 100 << 40)
        assert spark.conf.get(initial) == "409600"
    finally:
        spark.conf.unset(initial)
        spark.conf.set("spark.sql.files.maxPartitionBytes", split)


def test_latest_rows_are_taken_without_a_full_sort(spark):
    log = spark.range(100).select(
        F.col("id").alias("processed_at"), F.col("id").alias("batch_id"),
        F.col("id").alias("window_start"), F.col("id").alias("zone_id"),
    )
    assert "TakeOrderedAndProject" in plan(reports.latest_windows(log))


@pytest.mark.parametrize("name", sorted(registry.QUERIES))
def test_no_query_gathers_rows_or_pairs_them_all(spark, name):
    """Without broadcasts no plan crosses tables, runs Python or brings rows into one task.

    What may go through one task are partial aggregates and the counts of numbering buckets.
    """
    with setting(spark, "spark.sql.autoBroadcastJoinThreshold", "-1"):
        lines = plan(registry.QUERIES[name](spark, DATA)).splitlines()
    text = "\n".join(lines)
    for node in ("CartesianProduct", "BroadcastNestedLoopJoin", "EvalPython", "MapInPandas"):
        assert node not in text
    for number, line in enumerate(lines):
        if "Exchange SinglePartition" in line:
            below = lines[number + 1]
            assert "partial_" in below or "_rows" in below, below
