"""Data-quality checks: the source constraints, as queries that list what violates them."""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wayfare.functions import text_enum
from wayfare.session import materialise


def _all_of(parts: Iterable[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, parts)


def null_counts(tables: Mapping[str, tuple[DataFrame, Sequence[str]]]) -> DataFrame:
    """(table_name, column_name, null_rows) for columns that must have a value."""

    def one(name: str, df: DataFrame, columns: Sequence[str]) -> DataFrame:
        counts = df.agg(*(F.count_if(F.col(c).isNull()).alias(c) for c in columns))
        return counts.select(F.lit(name).alias("table_name"), "*").unpivot(
            "table_name", list(columns), "column_name", "null_rows"
        )

    return _all_of(one(name, df, columns) for name, (df, columns) in tables.items())


def duplicate_keys(keys: Sequence[tuple[str, DataFrame, str]]) -> DataFrame:
    """(table_name, column_name, key_value, copies) for keys that occur more than once.

    Missing keys are not duplicates. Copies are counted before the exchange.
    """

    def one(name: str, df: DataFrame, column: str) -> DataFrame:
        counted = df.filter(F.col(column).isNotNull()).groupBy(column)
        return counted.agg(F.count(F.lit(1)).alias("copies")).filter("copies > 1").select(
            F.lit(name).alias("table_name"), F.lit(column).alias("column_name"),
            F.col(column).cast("string").alias("key_value"), "copies",
        )

    return _all_of(one(*key) for key in keys)


def orphans(relations: Sequence[tuple[str, DataFrame, str, DataFrame, str]]) -> DataFrame:
    """(relation, key_value, orphan_rows) for references to keys that do not exist.

    Each entry is (relation, table, column, referenced table, referenced column). References
    are counted per key first: the anti join then sees each key once, however often it is used.
    """

    def one(name: str, df: DataFrame, column: str, other: DataFrame, key: str) -> DataFrame:
        used = df.filter(F.col(column).isNotNull()).groupBy(
            F.col(column).cast("bigint").alias("key_value")
        ).agg(F.count(F.lit(1)).alias("orphan_rows"))
        known = other.select(F.col(key).cast("bigint").alias("key_value"))
        missing = used.join(known, "key_value", "left_anti")
        return missing.select(F.lit(name).alias("relation"), "key_value", "orphan_rows")

    return _all_of(one(*relation) for relation in relations)


def outside_domain(domains: Sequence[tuple[str, DataFrame, str, Sequence[str]]]) -> DataFrame:
    """(table_name, column_name, bad_value, bad_rows) for text outside its domain, any case."""

    def one(name: str, df: DataFrame, column: str, allowed: Sequence[str]) -> DataFrame:
        value = text_enum(column)
        bad = df.filter(~value.isin(*allowed)).groupBy(value.alias("bad_value"))
        return bad.agg(F.count(F.lit(1)).alias("bad_rows")).select(
            F.lit(name).alias("table_name"), F.lit(column).alias("column_name"),
            "bad_value", "bad_rows",
        )

    return _all_of(one(*domain) for domain in domains)


def unbalanced_payments(payments: DataFrame) -> DataFrame:
    """Payments whose net is not amount less discount, or with a discount but no promo code
    or the reverse."""
    wrong_net = F.col("net_amount_egp") != F.col("amount_egp") - F.col("discount_egp")
    wrong_promo: Column = (F.col("discount_egp") == 0) != F.col("promo_code").isNull()
    return payments.select(
        "trip_id", "amount_egp", "discount_egp", "net_amount_egp", "promo_code",
        wrong_net.alias("wrong_net"), wrong_promo.alias("wrong_promo"),
    ).filter("wrong_net or wrong_promo")


def first_of_each(rows: DataFrame, key: str, order: Sequence[str]) -> tuple[DataFrame, DataFrame]:
    """(rows that are the first of their key, the others with a `reason`).

    The first one is the least by `order`, of equal ones any single row. Rows without a key are
    held back as `missing_key`, the rest as `repeated_key`. The first of each key is an aggregate
    that is joined back, so one key may hold any share of the rows.
    """
    slotted = materialise(rows.withColumn("_slot", F.monotonically_increasing_id()))
    place = F.struct(*order, "_slot")
    first = slotted.filter(F.col(key).isNotNull()).groupBy(key).agg(F.min(place).alias("_first"))
    marked = slotted.join(first, key, "left").withColumn(
        "_is_first", F.coalesce(F.col("_first._slot") == F.col("_slot"), F.lit(False))
    )
    reason = F.when(F.col(key).isNull(), "missing_key").otherwise("repeated_key")
    held = marked.filter(~F.col("_is_first")).select(*rows.columns, reason.alias("reason"))
    return marked.filter("_is_first").select(*rows.columns), held
