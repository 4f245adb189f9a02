"""Best-fit packing of documents into sequences by linear grouping.

1. Each document becomes token ids with an end id. A document longer than a sequence is cut
   into full pieces; only its first piece may be shorter.
2. Only the histogram of piece lengths, at most `capacity` numbers, reaches the driver. Large
   lengths are put in groups of equal cardinality and rounded up to the longest of their group.
   The few sizes left are packed by a linear programme over configurations (column generation,
   to its optimum), rounded down.
3. The real lengths take the places of the rounded ones; the last place of a configuration takes
   the longest piece that fits what the others leave. What stays free, and the rest of
   the pieces, are filled by best fit, longest first. Configurations whose real pieces fill too
   little of a sequence are given up, and their pieces are fitted like the rest: by which share
   is found by planning with several, until the sequences are as few as the lengths allow. All
   this is arithmetic on runs of equal
   sequences, whose number depends on `capacity` and not on the number of documents.
4. Pieces are numbered within their length, in salted groups, and look up their run.
"""

from __future__ import annotations

import zlib
from bisect import bisect_left, bisect_right, insort
from collections import defaultdict
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from wayfare.llm.common import ROW, bounded_batches, fields_of, text_of, texts_in, whole_rows
from wayfare.llm.tokens import default_path, library_coder

CAPACITY = 2048
END_ID = 0
# A length above this share of a sequence is large; so many groups of large lengths.
LARGE_SHARE = 8
GROUPS = 64
# Configurations are kept if their real pieces fill this share of a sequence; the last one keeps
# none. The first that gives fewest sequences is taken.
FILLS = (0.0, 0.9, 0.95, 0.98, 0.99, 0.995, 0.998, 1.0, 2.0)
# Rows numbered by one task at a time, and the least number of parts of a length.
SALT_ROWS = 50_000
LEAST_SALTS = 256

PIECES = "doc_id long, piece int, start long, length long, ids_crc32 long"


# -- cutting ---------------------------------------------------------------------------------


def piece_bounds(tokens: int, capacity: int) -> list[tuple[int, int]]:
    """(start, length) of the pieces of a document; all but the first are full."""
    first = tokens % capacity or min(tokens, capacity)
    starts = [0, *range(first, tokens, capacity)]
    return [(s, (first if s == 0 else capacity)) for s in starts]


def cut_documents(
    docs: DataFrame, capacity: int = CAPACITY, path: str | None = None, end_id: int = END_ID
) -> DataFrame:
    """Pieces of all documents: doc_id, piece, start, length, ids_crc32.

    A null text is an empty one and has the end id alone. A null doc_id stays null; equal rows
    give equal pieces. Other columns are not read. No rows give no rows.
    """
    bounded_batches(docs.sparkSession)
    path = path or default_path()
    end = np.array([end_id], "<u4").tobytes()

    def pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = library_coder(path)
        for batch in batches:
            rows: tuple[list, ...] = ([], [], [], [], [])
            encoded = coder.encode(texts_in(batch))
            for doc_id, ids in zip(batch.column("doc_id").to_pylist(), encoded):
                ids += end
                view = memoryview(ids)
                for number, (start, length) in enumerate(piece_bounds(len(ids) // 4, capacity)):
                    crc = zlib.crc32(view[4 * start : 4 * (start + length)])
                    for column, value in zip(rows, (doc_id, number, start, length, crc)):
                        column.append(value)
            kinds = (pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64())
            yield pa.RecordBatch.from_arrays(
                [pa.array(column, kind) for column, kind in zip(rows, kinds)],
                ["doc_id", "piece", "start", "length", "ids_crc32"],
            )

    read = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_of().alias("text"))
    return read.mapInArrow(pieces, PIECES)


# -- configurations --------------------------------------------------------------------------


def _best_pattern(sizes: np.ndarray, values: np.ndarray, capacity: int) -> tuple[float, np.ndarray]:
    """The pattern of most value that fits a sequence (unbounded knapsack, a piece at a time)."""
    room = np.arange(capacity + 1) - sizes[:, None]
    fits = room >= 0
    best = [np.zeros(capacity + 1)]
    taken = []
    while True:
        with_one = np.where(fits, best[-1][room] + values[:, None], -1.0)
        last = with_one.argmax(0)
        most = with_one.max(0)
        better = most > best[-1] + 1e-12
        if not better.any():
            break
        best.append(np.where(better, most, best[-1]))
        taken.append(np.where(better, last, -1))
    pattern = np.zeros(len(sizes), int)
    at = capacity
    for chosen in reversed(taken):
        if chosen[at] >= 0:
            pattern[chosen[at]] += 1
            at -= sizes[chosen[at]]
    return float(best[-1][capacity]), pattern


def configurations(
    sizes: list[int], counts: list[int], capacity: int
) -> list[tuple[np.ndarray, int]]:
    """(pattern, times): whole numbers of configurations that never exceed the counts.

    The linear programme "fewest sequences that hold `counts` pieces of `sizes`" is solved by
    the revised simplex method with column generation, then rounded down. At most one
    configuration per size is in use. Counts are raised a little, each differently, so
    that every step of the method makes progress and it ends at the optimum.
    """
    m = len(sizes)
    if not m:
        return []
    width = np.array(sizes)
    demand = np.array(counts, float)
    demand *= 1 + 1e-7 * np.random.default_rng(m).random(m)
    basis = np.diag(capacity // width).astype(float)
    inverse = np.linalg.inv(basis)
    steps = 0
    while True:
        value, pattern = _best_pattern(width, inverse.sum(0), capacity)
        if value <= 1 + 1e-9 or (basis == pattern[:, None]).all(0).any():
            break
        amounts, change = inverse @ demand, inverse @ pattern
        grows = change > 1e-9
        ratio = np.full(m, np.inf)
        ratio[grows] = np.maximum(amounts[grows], 0) / change[grows]
        out = int(ratio.argmin())
        basis[:, out] = pattern
        steps += 1
        if steps % 50:
            pivot = inverse[out] / change[out]
            inverse -= np.outer(change, pivot)
            inverse[out] = pivot
        else:
            inverse = np.linalg.inv(basis)
    amounts = np.linalg.solve(basis, demand)
    left = np.array(counts, dtype=np.int64)
    plan = []
    for k in np.argsort(-amounts):
        pattern = basis[:, k].astype(np.int64)
        used = pattern > 0
        times = min(int(amounts[k] + 1e-6), int((left[used] // pattern[used]).min()))
        if times > 0:
            plan.append((pattern, times))
            left -= times * pattern
    return plan


def linear_groups(histogram: dict[int, int], groups: int) -> list[list[int]]:
    """Lengths, longest first, in groups of about equal numbers of pieces."""
    total = sum(histogram.values())
    found: list[list[int]] = []
    seen = 0
    last = -1
    for length in sorted(histogram, reverse=True):
        group = seen * groups // max(total, 1)
        if group != last:
            found.append([])
            last = group
        found[-1].append(length)
        seen += histogram[length]
    return found


# -- runs of equal sequences -----------------------------------------------------------------


@dataclass
class Run:
    """`count` equal sequences; `items` are (length, first index, places) in each of them.

    The items of sequence k of the run are numbered first + k * places onwards.
    """

    count: int
    free: int
    items: list[tuple[int, int, int]]


@dataclass
class _Open:
    """`count` equal sequences with room; `items` are (length, places) in each of them."""

    count: int
    free: int
    items: list[tuple[int, int]]


class _Supply:
    """How many pieces of each length are not placed yet."""

    def __init__(self, histogram: dict[int, int]):
        self.left = {n: c for n, c in histogram.items() if c}
        self.lengths = sorted(self.left)

    def take(self, length: int, number: int) -> None:
        self.left[length] -= number
        if not self.left[length]:
            del self.left[length]
            self.lengths.pop(bisect_left(self.lengths, length))

    def give(self, length: int, number: int) -> None:
        if length not in self.left:
            insort(self.lengths, length)
        self.left[length] = self.left.get(length, 0) + number

    def longest(self, room: int) -> int | None:
        """The longest piece left that fits."""
        at = bisect_right(self.lengths, room)
        return self.lengths[at - 1] if at else None


def _substitute(
    slots: list[tuple[int, int]], times: int, capacity: int, supply: _Supply
) -> list[_Open]:
    """Real lengths in the slots (lowest, highest length) of a configuration, longest first.

    Every slot but the last takes the longest piece left in its group, the last one the longest
    that fits beside them.
    """
    runs = []
    while times:
        # Pieces already wanted by this sequence count as taken.
        wanted: dict[int, int] = {}
        room = capacity
        for k, (low, high) in enumerate(slots):
            last = k + 1 == len(slots)
            at = bisect_right(supply.lengths, room if last else min(high, room)) - 1
            while at >= 0 and wanted.get(supply.lengths[at], 0) >= supply.left[supply.lengths[at]]:
                at -= 1
            if at < 0 or supply.lengths[at] < low:
                continue
            length = supply.lengths[at]
            wanted[length] = wanted.get(length, 0) + 1
            room -= length
        if not wanted:
            break
        count = min(times, *(supply.left[n] // places for n, places in wanted.items()))
        for n, places in wanted.items():
            supply.take(n, count * places)
        runs.append(_Open(count, room, list(wanted.items())))
        times -= count
    return runs


def _best_fit(runs: list[_Open], supply: _Supply, capacity: int) -> list[_Open]:
    """Everything left, longest first, into the least room that holds it."""
    open_runs: dict[int, list[_Open]] = defaultdict(list)
    for run in runs:
        open_runs[run.free].append(run)
    spaces = sorted(open_runs)

    def reopen(run: _Open) -> None:
        if not open_runs[run.free]:
            at = bisect_left(spaces, run.free)
            if spaces[at : at + 1] != [run.free]:
                spaces.insert(at, run.free)
        open_runs[run.free].append(run)

    while supply.lengths:
        length = supply.lengths[-1]
        number = supply.left[length]
        at = bisect_left(spaces, length)
        if at < len(spaces):
            space = spaces[at]
            run = open_runs[space].pop()
            if not open_runs[space]:
                spaces.pop(at)
        else:
            space = capacity
            run = _Open(-(-number // (capacity // length)), capacity, [])
        places = min(space // length, number)
        filled = min(run.count, number // places)
        if filled < run.count:
            reopen(_Open(run.count - filled, run.free, list(run.items)))
            run.count = filled
        supply.take(length, filled * places)
        run.items.append((length, places))
        run.free -= places * length
        reopen(run)
    return [run for found in open_runs.values() for run in found]


def fewest_possible(histogram: dict[int, int], capacity: int) -> int:
    """A bound that no plan goes below: by sum, and by pieces of more than half a sequence."""
    total = sum(n * c for n, c in histogram.items())
    return max(-(-total // capacity), sum(c for n, c in histogram.items() if 2 * n > capacity))


def plan_sequences(
    histogram: dict[int, int],
    capacity: int = CAPACITY,
    groups: int = GROUPS,
    large_share: int = LARGE_SHARE,
) -> list[Run]:
    """Runs of sequences that hold every piece of the histogram once."""
    large = {n: c for n, c in histogram.items() if c and n * large_share > capacity and n < capacity}
    grouped = linear_groups(large, groups)
    sizes = [group[0] for group in grouped]
    counts = [sum(large[n] for n in group) for group in grouped]
    chosen = [
        ([(grouped[i][-1], grouped[i][0]) for i, k in enumerate(pattern) for _ in range(k)], times)
        for pattern, times in configurations(sizes, counts, capacity)
    ]
    least = fewest_possible(histogram, capacity)
    best: list[_Open] | None = None
    for fill in FILLS:
        supply = _Supply(histogram)
        kept = []
        for slots, times in chosen:
            kept += _substitute(slots, times, capacity, supply)
        for run in kept:
            if capacity - run.free < fill * capacity:
                for length, places in run.items:
                    supply.give(length, run.count * places)
        runs = _best_fit([r for r in kept if capacity - r.free >= fill * capacity], supply, capacity)
        if best is None or sum(r.count for r in runs) < sum(r.count for r in best):
            best = runs
        if sum(r.count for r in best) <= least:
            break
    return _numbered(best or [])


def _numbered(runs: list[_Open]) -> list[Run]:
    """Pieces of each length in the order of the runs."""
    seen: dict[int, int] = defaultdict(int)
    found = []
    for run in runs:
        items = []
        for length, places in run.items:
            items.append((length, seen[length], places))
            seen[length] += run.count * places
        found.append(Run(run.count, run.free, items))
    return found


def run_rows(runs: list[Run]) -> Iterator[tuple[int, int, int, int, int, int]]:
    """(length, first index, end index, places, first sequence, offset) of each run and length."""
    sequence = 0
    for run in runs:
        offset = 0
        for length, first, places in run.items:
            yield length, first, first + run.count * places, places, sequence, offset
            offset += length * places
        sequence += run.count


# -- packing ---------------------------------------------------------------------------------


def pack(pieces: DataFrame, capacity: int = CAPACITY, groups: int = GROUPS) -> DataFrame:
    """All columns of `pieces`, with sequence_id and the offset in the sequence.

    `pieces` has a `length` from 1 to `capacity` in every row. Offsets have no gaps; sequences
    are numbered from 0. Rows may repeat. No rows give no rows.
    """
    spark = pieces.sparkSession
    placed = whole_rows(pieces.drop("sequence_id", "offset"))
    placed = placed.withColumn("length", F.col("_doc.length"))
    histogram = {r[0]: r[1] for r in placed.groupBy("length").count().collect()}
    if any(n < 1 or n > capacity for n in histogram):
        raise ValueError(f"piece lengths must be from 1 to {capacity}")
    total = sum(histogram.values())
    salts = max(LEAST_SALTS, -(-total // SALT_ROWS))
    salted = placed.withColumn("_salt", F.pmod(F.xxhash64(ROW), F.lit(salts)))
    group = Window.partitionBy("length", "_salt")
    counts = salted.groupBy("length", "_salt").agg(F.count(F.lit(1)).alias("_n"))
    before = Window.partitionBy("length").orderBy("_salt")
    starts = counts.select(
        "length", "_salt", (F.sum("_n").over(before) - F.col("_n")).alias("_before")
    )
    numbered = salted.withColumn("_in", F.row_number().over(group.orderBy(ROW)) - 1).join(
        starts, ["length", "_salt"]
    )
    numbered = numbered.withColumn("_index", F.col("_before") + F.col("_in"))
    runs = spark.createDataFrame(
        list(run_rows(plan_sequences(histogram, capacity, groups))),
        "length long, _first long, _end long, _places long, _sequence long, _offset long",
    )
    # Bounded by `capacity`: the plan has a few runs per length, however many pieces there are.
    inside = (F.col("_index") >= F.col("_first")) & (F.col("_index") < F.col("_end"))
    found = numbered.alias("p").join(
        F.broadcast(runs.withColumnRenamed("length", "_length")),
        (F.col("length") == F.col("_length")) & inside,
    )
    nth = F.col("_index") - F.col("_first")
    return found.select(
        *fields_of(placed),
        (F.col("_sequence") + F.floor(nth / F.col("_places"))).cast("long").alias("sequence_id"),
        (F.col("_offset") + nth % F.col("_places") * F.col("length")).cast("long").alias("offset"),
    )


def pack_documents(
    docs: DataFrame, capacity: int = CAPACITY, path: str | None = None
) -> DataFrame:
    """Cut and pack whole documents (see `cut_documents` and `pack`)."""
    return pack(cut_documents(docs, capacity, path), capacity)
