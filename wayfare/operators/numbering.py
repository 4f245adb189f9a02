"""Dense row numbers in key order, without a task that holds all rows.

A bare `row_number() over (order by key)` sends everything to one task. Here the key space
is cut into buckets of 2**BUCKET_BITS neighbouring keys. Rows are numbered inside their
bucket, and each bucket starts after the rows of all lower ones. Those starts are running
sums over the bucket counts, taken level by level over ever wider buckets: every window on
the way spans at most 2**18 counts, whatever the keys are.

A bucket can hold many rows only if keys repeat; under a limit below 2**BUCKET_BITS rows, buckets
are narrower, so that this holds. Buckets above ROW_LIMIT rows go another way: their rows are
range-partitioned by key, ties and written position, so one key may hold any share of the table,
and numbered by partition and place. The order is the same either way.

A join of repeated keys yields far more rows than it takes in. There only the two sides are
ordered; the number of a joined row follows from the places of its two rows, so the result is
neither exchanged nor sorted nor written.
"""

from __future__ import annotations

import math
from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce
from itertools import chain, groupby

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from wayfare.operators.joins import (
    BUCKET, BUCKET_BITS, CELL, CELL_ROWS, LEFT_SLOT, RIGHT_SLOT, ROW_LIMIT, bucket_bits, bucket_of,
    cell_grid, cell_sides, join_cells, with_slots,
)
from wayfare.session import broadcast_if_small, materialise, materialise_with

# Bits removed per level.
_LEVEL_BITS = 18
# Up to this many counts a single running sum needs no levels.
_ONE_WINDOW_ROWS = 1 << 16


def _before(within: Sequence[str], order: Sequence[str | Column]) -> Column:
    """Rows of all earlier entries in an ordered window, 0 for the first."""
    window = Window.partitionBy(*within).orderBy(*order)
    return F.coalesce(
        F.sum("_rows").over(window.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)
    )


def _levels(bits: int) -> tuple[int, ...]:
    """Levels that leave _LEVEL_BITS of a 64-bit key at most; with BUCKET_BITS two, which leave 16."""
    return (_LEVEL_BITS,) * math.ceil((64 - bits - _LEVEL_BITS) / _LEVEL_BITS)


def bucket_starts(counts: DataFrame, levels: Sequence[int] = _levels(BUCKET_BITS)) -> DataFrame:
    """(bucket, rows in all lower buckets) from (bucket, _rows)."""
    if not levels:
        return counts.select(BUCKET, _before([], [BUCKET]).alias("_start"))
    nested = counts.withColumn("_parent", F.shiftright(BUCKET, levels[0]))
    parents = nested.groupBy(F.col("_parent").alias(BUCKET)).agg(F.sum("_rows").alias("_rows"))
    above = bucket_starts(parents, levels[1:]).select(
        F.col(BUCKET).alias("_parent"), F.col("_start").alias("_above")
    )
    inside = nested.select(BUCKET, "_parent", _before(["_parent"], [BUCKET]).alias("_inside"))
    return inside.join(above, "_parent").select(
        BUCKET, (F.col("_above") + F.col("_inside")).alias("_start")
    )


@dataclass(frozen=True)
class BucketPlan:
    """Where each bucket starts, and which buckets have too many rows for one task."""

    starts: DataFrame
    heavy: DataFrame | None
    rows: int

    def light_rows(self, df: DataFrame) -> DataFrame:
        return df if self.heavy is None else df.join(self.heavy, BUCKET, "left_anti")

    def heavy_rows(self, df: DataFrame) -> DataFrame:
        return df.join(self.heavy, BUCKET, "left_semi")


def plan_buckets(
    counts: DataFrame, row_limit: int = ROW_LIMIT, bits: int = BUCKET_BITS
) -> BucketPlan:
    """Plan from (bucket, _rows, _load): rows to number, and rows a task must take in.

    The counts are written once; only their totals reach the driver.
    """
    counts, totals = materialise_with(
        counts,
        buckets=F.count(F.lit(1)),
        heavy=F.count_if(F.col("_load") > row_limit),
        rows=F.coalesce(F.sum("_rows"), F.lit(0)),
    )
    levels = () if totals["buckets"] <= _ONE_WINDOW_ROWS else _levels(bits)
    heavy = None
    if totals["heavy"]:
        heavy = broadcast_if_small(counts.filter(F.col("_load") > row_limit).select(BUCKET))
    starts = bucket_starts(counts.select(BUCKET, "_rows"), levels)
    return BucketPlan(starts, heavy, totals["rows"])


def number_light(
    rows: DataFrame, plan: BucketPlan, key: str, name: str, ties: Sequence[str] = ()
) -> DataFrame:
    """Number rows that are hashed by bucket: one sort per bucket, no further exchange."""
    inside = F.row_number().over(
        Window.partitionBy(BUCKET).orderBy(F.asc_nulls_last(key), *ties)
    )
    return (
        rows.withColumn("_inside", inside)
        .join(plan.starts, BUCKET)
        .withColumn(name, F.col("_start") + F.col("_inside"))
        .drop("_inside", "_start", BUCKET)
    )


def _placed(rows: DataFrame, by: Sequence[str | Column]) -> DataFrame:
    """Rows in the order of `by`, written, with their `_place` in it, 0 for the first.

    `by` ends in columns that tell all rows apart, so a range partition can be cut within a
    key and even within equal ties. Rows are written sorted; what is summed up afterwards is one
    count per partition.
    """
    ranged = rows.repartitionByRange(*by).sortWithinPartitions(*by)
    placed = materialise(
        ranged.withColumns({"_part": F.spark_partition_id(), "_at": F.monotonically_increasing_id()})
    )
    parts = placed.groupBy("_part").agg(F.count(F.lit(1)).alias("_rows"), F.min("_at").alias("_0"))
    offsets = parts.select("_part", (_before([], ["_part"]) - F.col("_0")).alias("_offset"))
    return (
        placed.join(F.broadcast(offsets), "_part")
        .withColumn("_place", F.col("_at") + F.col("_offset"))
        .drop("_part", "_at", "_offset")
    )


def number_ranges(
    rows: DataFrame, plan: BucketPlan, key: str, order: Sequence[str], name: str
) -> DataFrame:
    """Number rows of heavy buckets in the order of the key, then of `order`.

    `order` ends in columns that tell all rows apart.
    """
    placed = _placed(rows, [F.asc_nulls_last(key), *order])
    counts = rows.groupBy(BUCKET).agg(F.count(F.lit(1)).alias("_rows"))
    buckets = bucket_starts(counts).withColumnRenamed("_start", "_heavy").join(plan.starts, BUCKET)
    shift = buckets.select(BUCKET, (F.col("_start") - F.col("_heavy") + 1).alias("_shift"))
    return (
        placed.join(broadcast_if_small(shift), BUCKET)
        .withColumn(name, F.col("_place") + F.col("_shift"))
        .drop("_place", "_shift", BUCKET)
    )


def surrogate_key(
    df: DataFrame,
    key: str,
    name: str,
    ties: Sequence[str] = (),
    row_limit: int = ROW_LIMIT,
    bits: int = BUCKET_BITS,
) -> DataFrame:
    """Number all rows 1, 2, 3 … in the order of an integer key, rows without a key last.

    Rows with equal keys follow `ties`, however many they are.
    """
    return _numbered(df, key, name, ties, row_limit, bits)[0]


def in_key_order(
    df: DataFrame, key: str, rows_per_partition: int = ROW_LIMIT, **limits: int
) -> DataFrame:
    """Rows in the total order of an integer key, in partitions of equal length.

    Partitions are cut on the row number, which is unique, so equal keys cannot crowd one of
    them, and no sample is needed to place the cuts.
    """
    numbered, rows = _numbered(df, key, "_position", **limits)
    partition = F.floor((F.col("_position") - 1) / rows_per_partition).cast("int")
    partitions = max(1, math.ceil(rows / rows_per_partition))
    placed = numbered.repartitionById(partitions, partition)
    return placed.sortWithinPartitions("_position").drop("_position")


def _numbered(
    df: DataFrame,
    key: str,
    name: str,
    ties: Sequence[str] = (),
    row_limit: int = ROW_LIMIT,
    bits: int = BUCKET_BITS,
) -> tuple[DataFrame, int]:
    """The numbered rows, and how many there are."""
    bits = bucket_bits(row_limit, bits)
    bucketed = df.withColumn(BUCKET, bucket_of(F.col(key), bits))
    counts = bucketed.groupBy(BUCKET).agg(F.count(F.lit(1)).alias("_rows"))
    plan = plan_buckets(counts.withColumn("_load", F.col("_rows")), row_limit, bits)
    light = number_light(plan.light_rows(bucketed).repartition(BUCKET), plan, key, name, ties)
    if plan.heavy is None:
        return light, plan.rows
    placed = materialise(
        plan.heavy_rows(bucketed).withColumn("_slot", F.monotonically_increasing_id())
    )
    heavy = number_ranges(placed, plan, key, (*ties, "_slot"), name)
    return light.unionByName(heavy.drop("_slot")), plan.rows


def numbered_left_join(
    left: DataFrame,
    right: DataFrame,
    key: str,
    name: str,
    ties: Sequence[str] = (),
    row_limit: int = ROW_LIMIT,
    bits: int = BUCKET_BITS,
    cell_rows: int = CELL_ROWS,
) -> DataFrame:
    """Left join on an integer key, with the result numbered in key order.

    Both inputs are hashed by bucket, which serves the join and the numbering: each wide row
    is exchanged once. How many rows a bucket will have is worked out beforehand from the
    keys alone. Rows of `left` without a key must have been dropped.
    """
    bits = bucket_bits(row_limit, bits)
    left = left.withColumn(BUCKET, bucket_of(F.col(key), bits))
    right = right.withColumn(BUCKET, bucket_of(F.col(key), bits))
    plan = plan_buckets(_join_counts(left, right, key, bits), row_limit, bits)
    joined = plan.light_rows(left).repartition(BUCKET).join(
        plan.light_rows(right), [BUCKET, key], "left"
    )
    light = number_light(joined, plan, key, name, ties)
    if plan.heavy is None:
        return light
    heavy = _number_cells(
        plan.heavy_rows(left), plan.heavy_rows(right), plan, key, name, ties, cell_rows, bits
    )
    return light.unionByName(heavy)


def _number_cells(
    left: DataFrame,
    right: DataFrame,
    plan: BucketPlan,
    key: str,
    name: str,
    ties: Sequence[str],
    cell_rows: int,
    bits: int,
) -> DataFrame:
    """Join rows of heavy buckets in cells and number the result without ordering it.

    All pairs of a key's left and right rows are there, in the order of the ties and then of
    the slots. Cut that order where its columns change sides. Before a pair come, for each
    such run of columns, the rows of its own side that agree up to the run and are less in it,
    each with all rows of the other side that agree up to there.
    """
    starts = broadcast_if_small(materialise(_key_starts(left, right, plan, key, bits)))
    by_key = F.col(key).eqNullSafe(F.col("_key"))
    left = with_slots(left.drop(BUCKET).join(starts, by_key).drop("_key"), LEFT_SLOT)
    right = with_slots(right.drop(BUCKET), RIGHT_SLOT)
    grid = cell_grid(left, right, key, cell_rows)

    of_left = set(left.columns)
    order = [
        ("_l" if is_left else "_r", list(run))
        for is_left, run in groupby((*ties, LEFT_SLOT, RIGHT_SLOT), lambda c: c in of_left)
    ]
    ranked = (
        _ranked(df, key, [run for of, run in order if of == side], side)
        for df, side in ((left, "_l"), (right, "_r"))
    )
    joined = join_cells(*cell_sides(*ranked, key, grid), key).drop(*CELL)

    number = F.col("_first")
    seen = {"_l": 0, "_r": 0}
    helpers = ["_first", LEFT_SLOT, RIGHT_SLOT]
    for own, _ in order:
        other = "_r" if own == "_l" else "_l"
        before, same = f"{own}_before{seen[own]}", f"{other}_same{seen[other]}"
        # A left row without partner stands beside one right row that is null.
        number += F.coalesce(before, F.lit(0)) * F.coalesce(same, F.lit(1))
        helpers += [before, f"{own}_same{seen[own]}", f"{own}_same{seen[own] + 1}"]
        seen[own] += 1
    return joined.withColumn(name, number).drop(*helpers)


def _ranked(rows: DataFrame, key: str, runs: Sequence[Sequence[str]], side: str) -> DataFrame:
    """Rows of one side with their place among those of their key, run by run of columns.

    `_before{n}`: rows that agree in the key and the first n runs and are less in the next;
    `_same{n}`: rows that agree in the key and the first n runs, the row itself included.
    """
    columns = rows.columns
    placed = _placed(rows, [F.asc_nulls_last(key), *chain.from_iterable(runs)])
    ranked = placed
    for n in range(len(runs)):
        group = [key, *chain.from_iterable(runs[:n])]
        # Most groups are one row, which needs no looking up.
        shared = materialise(
            placed.groupBy(*(F.col(c).alias(f"_g{i}") for i, c in enumerate(group)))
            .agg(F.count(F.lit(1)).alias(f"_same{n}"), F.min("_place").alias(f"_from{n}"))
            .filter(F.col(f"_same{n}") > 1)
        )
        equal = reduce(
            Column.__and__, (F.col(c).eqNullSafe(F.col(f"_g{i}")) for i, c in enumerate(group))
        )
        ranked = ranked.join(broadcast_if_small(shared), equal, "left").drop(
            *(f"_g{i}" for i in range(len(group)))
        )
    # The last run ends in the slot, so nothing agrees in all of them but the row itself.
    first = [F.coalesce(f"_from{n}", "_place") for n in range(len(runs))] + [F.col("_place")]
    same = [F.coalesce(f"_same{n}", F.lit(1)) for n in range(len(runs))] + [F.lit(1)]
    return ranked.select(
        *columns,
        *((first[n + 1] - first[n]).alias(f"{side}_before{n}") for n in range(len(runs))),
        *(size.cast("bigint").alias(f"{side}_same{n}") for n, size in enumerate(same)),
    )


def _key_counts(left: DataFrame, right: DataFrame, key: str, bits: int) -> DataFrame:
    """(bucket, key, _l, _r): how many rows of each side have a key."""

    def marked(df: DataFrame, own: str) -> DataFrame:
        return df.select(key, *(F.lit(int(side == own)).alias(side) for side in ("_l", "_r")))

    # One exchange of the keys, combined before it; buckets follow from them.
    counts = marked(left, "_l").unionByName(marked(right, "_r")).groupBy(key).agg(
        F.sum("_l").alias("_l"), F.sum("_r").alias("_r")
    )
    return counts.withColumn(BUCKET, bucket_of(F.col(key), bits))


def _joined_rows() -> Column:
    """Rows that a left join yields for a key."""
    return F.col("_l") * F.greatest("_r", F.lit(1))


def _key_starts(
    left: DataFrame, right: DataFrame, plan: BucketPlan, key: str, bits: int
) -> DataFrame:
    """(_key, _first): the number of the first joined row of each left key."""
    rows = _key_counts(left, right, key, bits).select(BUCKET, key, _joined_rows().alias("_rows"))
    inside = rows.filter("_rows > 0").withColumn(
        "_inside", _before([BUCKET], [F.asc_nulls_last(key)])
    )
    return inside.join(plan.starts, BUCKET).select(
        F.col(key).alias("_key"), (F.col("_start") + F.col("_inside") + 1).alias("_first")
    )


def _join_counts(
    left: DataFrame, right: DataFrame, key: str, bits: int = BUCKET_BITS
) -> DataFrame:
    """Per bucket: rows the left join yields, and the most rows any side of it has."""
    rows = F.sum(_joined_rows())
    return _key_counts(left, right, key, bits).groupBy(BUCKET).agg(
        rows.alias("_rows"), F.greatest(rows, F.sum("_r")).alias("_load")
    )
