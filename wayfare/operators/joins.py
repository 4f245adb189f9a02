"""Left joins on integer keys that may repeat without bound on either side.

A sort-merge left join can be split where the left side is skewed, but not where the right
side is: one right key with a third of all rows would be one task. Keys are therefore looked
at in buckets of 2**BUCKET_BITS neighbours. Only a bucket above ROW_LIMIT rows can hold such
a key, and usually there is none. The rows of such buckets are joined in cells: a key with
many rows is cut into a grid of left slices times right slices, and each slice is sent to every
cell of its row or column. A cell yields about CELL_ROWS rows, or more where smaller cells would
copy rows more than COPIES times: the copies go to disk, what a cell yields does not.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wayfare.session import broadcast_if_small, materialise

BUCKET_BITS = 12
ROW_LIMIT = 1 << 20
CELL_ROWS = 1 << 20
COPIES = 32
BUCKET = "_bucket"
NO_KEY = (1 << 63) - 1
CELL = ("_i", "_j")
# The written position of a row on either side: unique, and the same in every attempt.
LEFT_SLOT, RIGHT_SLOT = "_left_slot", "_right_slot"


def bucket_of(key: Column, bits: int = BUCKET_BITS) -> Column:
    """The bucket of a key. Rows without a key sort last."""
    return F.shiftright(F.coalesce(key.cast("bigint"), F.lit(NO_KEY)), bits)


def bucket_bits(row_limit: int, bits: int = BUCKET_BITS) -> int:
    """Bits of a bucket that keys without repeats cannot fill beyond the limit."""
    return min(bits, max(1, row_limit).bit_length() - 1)


def _grid(left: DataFrame, right: DataFrame, key: str, cell_rows: int) -> DataFrame:
    """(key, _a, _b): left and right slices of each left key that needs more than one cell.

    Where cells are larger than `cell_rows`, both sides have together, copied, at most
    2 * (COPIES + 1) times the rows of the longer one.
    """
    lefts = left.groupBy(key).agg(F.count(F.lit(1)).alias("_l"))
    rights = right.groupBy(key).agg(F.count(F.lit(1)).alias("_r"))
    rows = lefts.join(rights, key, "left").withColumn("_r", F.coalesce("_r", F.lit(1)))

    def slices(own: str, other: str) -> Column:
        # One side alone may fill a cell; two long sides share it evenly.
        length = F.greatest(
            F.lit(math.isqrt(cell_rows)),
            F.lit(cell_rows) / F.col(other),
            F.least("_l", "_r") / COPIES,
        )
        return F.ceil(F.col(own) / length)

    grid = rows.select(key, slices("_l", "_r").alias("_a"), slices("_r", "_l").alias("_b"))
    return grid.filter("_a > 1 OR _b > 1")


def with_slots(df: DataFrame, slot: str) -> DataFrame:
    """`df` written, each row with its written position."""
    return materialise(df.withColumn(slot, F.monotonically_increasing_id()))


def cell_grid(
    left: DataFrame, right: DataFrame, key: str, cell_rows: int = CELL_ROWS
) -> DataFrame:
    """The keys that need more than one cell. Written once: it is counted and joined to both sides."""
    return broadcast_if_small(materialise(_grid(left, right, key, cell_rows)))


def cell_sides(
    left: DataFrame, right: DataFrame, key: str, grid: DataFrame
) -> tuple[DataFrame, DataFrame]:
    """Both sides with the cell of each row, rows repeated for every cell they belong to.

    The sides have slots. Slices are taken by them, so even identical rows spread evenly and a
    repeated task makes the same choice.
    """

    def in_cells(df: DataFrame, slot: str, own: str, own_slices: str, other: str, others: str):
        ways = df.join(grid, key, "left")
        ways = ways.withColumns({c: F.coalesce(c, F.lit(1)) for c in ("_a", "_b")})
        # A row without a key has no partner, so it may be anywhere.
        place = F.when(F.col(key).isNull(), F.xxhash64(slot)).otherwise(
            F.pmod(F.xxhash64(slot), F.col(own_slices))
        )
        every = F.explode(F.sequence(F.lit(0).cast("bigint"), F.col(others) - 1))
        return ways.withColumn(own, place).withColumn(other, every)

    return (
        in_cells(left, LEFT_SLOT, "_i", "_a", "_j", "_b"),
        in_cells(right, RIGHT_SLOT, "_j", "_b", "_i", "_a").drop("_a", "_b"),
    )


def join_cells(left: DataFrame, right: DataFrame, key: str) -> DataFrame:
    """Left join of two sides in cells, hashed by key and cell.

    A key with several right slices has partners. Where one of its left rows meets an empty
    slice, that is not a row without partner. The sides are dealt by key and cell even if they
    come hashed by the key, which would do for the join but leave a repeated key in one task.
    """
    by = [key, *CELL]
    joined = left.repartition(*by).join(right.repartition(*by), by, "left")
    return joined.filter((F.col("_b") == 1) | F.col(RIGHT_SLOT).isNotNull()).drop("_a", "_b")


def left_join(
    left: DataFrame,
    right: DataFrame,
    key: str,
    row_limit: int = ROW_LIMIT,
    bits: int = BUCKET_BITS,
    cell_rows: int = CELL_ROWS,
) -> DataFrame:
    """Left join; right keys that repeat too often for one task are joined in cells.

    One pass over the right keys finds the buckets in question. It is aggregated before it is
    exchanged.
    """
    bits = bucket_bits(row_limit, bits)
    counts = right.groupBy(bucket_of(F.col(key), bits).alias(BUCKET)).count()
    heavy = counts.filter(F.col("count") > row_limit).select(BUCKET)
    if heavy.isEmpty():
        return left.join(right, key, "left")
    heavy = broadcast_if_small(materialise(heavy))
    left = left.withColumn(BUCKET, bucket_of(F.col(key), bits))
    right = right.withColumn(BUCKET, bucket_of(F.col(key), bits))

    def part(df: DataFrame, how: str) -> DataFrame:
        return df.join(heavy, BUCKET, how).drop(BUCKET)

    light = part(left, "left_anti").join(part(right, "left_anti"), key, "left")
    lefts = with_slots(part(left, "left_semi"), LEFT_SLOT)
    rights = with_slots(part(right, "left_semi"), RIGHT_SLOT)
    sides = cell_sides(lefts, rights, key, cell_grid(lefts, rights, key, cell_rows))
    repeated = join_cells(*sides, key).drop(*CELL, LEFT_SLOT, RIGHT_SLOT)
    return light.unionByName(repeated)
