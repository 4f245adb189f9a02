"""Reader and writer options, documents and column scans."""

import json

import pytest
from pyspark.sql import functions as F

from wayfare import schemas
from wayfare.session import shared_dir
from wayfare.sources import readers, targets


def test_relational_options():
    plain = readers.relational_options("jdbc:x", "trips")
    assert plain == {
        "url": "jdbc:x", "dbtable": "trips", "fetchsize": "10000", "preferTimestampNTZ": "true",
    }
    split = readers.relational_options("jdbc:x", "trips", "trip_id", (1, 900), 4)
    assert (split["partitionColumn"], split["lowerBound"], split["upperBound"]) == ("trip_id", "1", "900")
    assert split["numPartitions"] == "4"
    with pytest.raises(ValueError):
        readers.relational_options("jdbc:x", "trips", "trip_id")


def test_broker_options():
    options = readers.broker_options("host:9092", "trip_events")
    assert options == {
        "kafka.bootstrap.servers": "host:9092", "subscribe": "trip_events",
        "startingOffsets": "latest", "failOnDataLoss": "false",
    }


def test_broker_intake_can_be_bounded():
    options = readers.broker_options("host:9092", "trip_events", "earliest", 5000)
    assert options["startingOffsets"] == "earliest" and options["maxOffsetsPerTrigger"] == "5000"


@pytest.mark.parametrize("keys", [
    "id * id * id", "CASE WHEN id % 3 = 0 THEN 77 ELSE id END", "CASE WHEN id % 5 = 0 THEN NULL ELSE -id END",
    "CAST(5 AS BIGINT)", "CAST(NULL AS BIGINT)",
])
def test_slices_cover_every_row_once(spark, keys):
    rows = spark.range(3000).select(F.expr(keys).alias("trip_id"))
    cuts = readers.key_cuts(rows.filter("trip_id % 2 = 0 OR trip_id IS NULL"), "trip_id", 8)
    predicates = readers.slices("trip_id", cuts)
    met = [F.coalesce(F.expr(p), F.lit(False)).cast("int") for p in predicates]
    assert {r[0] for r in rows.select(sum(met, F.lit(0))).collect()} == {1}
    if keys.startswith("id * id"):
        sizes = [rows.filter(p).count() for p in predicates]
        assert len(sizes) == 8 and max(sizes) < 1.2 * 3000 / 8
    assert readers.slices("k", []) == ["1 = 1"] and readers.slices("k", [3]) == ["(k < 3 OR k IS NULL)", "k >= 3"]


class Database:
    """What a database would do with the statements that it is sent, in one transaction at a time."""

    def __init__(self):
        self.tables, self.ledger, self.fail_at = {"log": [], "log_incoming": []}, {}, None


class StubTable(targets.DatabaseTable):
    database = None

    def save(self, df, mode):
        rows = [tuple(r) for r in df.collect()]
        assert mode == "overwrite"
        self.database.tables[self.table] = rows
        return len(rows)

    def transaction(self, spark):
        return StubTransaction(self.database)


class StubTransaction:
    def __init__(self, database):
        self.database = database
        self.tables, self.ledger = {k: list(v) for k, v in database.tables.items()}, dict(database.ledger)

    def number(self, sql, run, batch):
        assert sql.startswith("SELECT COUNT(*) FROM wayfare_batches")
        return int((run, batch) in self.ledger)

    def run(self, sql, *values):
        if sql.startswith("INSERT INTO wayfare_batches"):
            assert values[:2] not in self.ledger
            self.ledger[values[:2]] = values[2]
        else:
            assert sql.startswith("INSERT INTO log (") and sql.endswith("FROM log_incoming")
            self.tables["log"] += self.tables["log_incoming"]
        if self.database.fail_at == sql.split()[2]:
            raise ConnectionError("lost")

    def __enter__(self):
        return self

    def __exit__(self, kind, *_):
        if kind is None:
            self.database.tables, self.database.ledger = self.tables, self.ledger


def test_a_batch_repeated_into_a_database_is_there_once(spark, monkeypatch):
    database = Database()
    monkeypatch.setattr(StubTable, "database", database)
    batch = spark.range(5).select("id")
    table = StubTable("jdbc:x", "log", batch.schema)
    assert [targets.append_once(batch, table, "a", n) for n in (0, 0, 1)] == [5, 0, 5]
    for place in ("wayfare_batches", "log"):
        database.fail_at = place
        with pytest.raises(ConnectionError):
            targets.append_once(batch, table, "a", 2)
        assert len(database.tables["log"]) == 10
    database.fail_at = None
    assert [targets.append_once(batch, table, "a", 2), targets.append_once(batch, table, "b", 0)] == [5, 5]
    assert len(database.tables["log"]) == 20
    assert set(database.ledger) == {("a", 0), ("a", 1), ("a", 2), ("b", 0)}


def test_documents_keep_nine_fields_and_fill_missing_ones(spark):
    documents = [
        {"trip_id": 1, "provider": "visa", "amount_egp": 10.25, "created_at": "2024-01-01T10:00:00",
         "provider_metadata": {"response_code": "00"}, "unknown": [1]},
        {"trip_id": 2, "promo_code": "P", "discount_egp": 0, "status": "failed"},
    ]
    path = shared_dir(spark)
    lines = spark.createDataFrame([(json.dumps(d),) for d in documents], "value STRING")
    lines.write.text(path)
    df = readers.read_documents(spark, path)
    assert df.columns == list(schemas.PAYMENT_COLUMNS)
    first, second = df.orderBy("trip_id").collect()
    assert str(first.amount_egp) == "10.25" and str(first.created_at) == "2024-01-01 10:00:00"
    assert first.promo_code is None and second.promo_code == "P" and second.amount_egp is None


def test_stored_copy_is_read_with_the_declared_schema(spark):
    path = shared_dir(spark)
    spark.range(3).select(F.col("id").alias("zone_id").cast("int")).write.parquet(path)
    zones = readers.read_columnar(spark, path, schemas.ZONES)
    assert zones.columns == schemas.ZONES.names
    assert zones.filter("zone_name IS NULL").count() == 3
