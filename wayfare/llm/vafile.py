"""Exact top-k by inner product with vector-approximation files.

1. Of rows with equal vectors, which have equal scores, only those of the smallest ids can be
   among the k best, so 2k of them stay. They are written with a place each: the exact file.
2. The approximation file is written beside it, in blocks: for each component a grid
   of equal cells between the least and the greatest value in the block, and for each vector the
   cell number of each component, a byte.
3. Queries, which the caller states, meet the blocks of cells. The cells alone bound every score
   from below and from above. The k-th highest lower bound over all blocks is a score that the
   k-th result of the query has at least.
4. The cells are scanned once more; only places whose upper bound reaches that score are joined to
   their exact vectors, which are scored from the highest bound down, until the k-th best score is
   above every bound that is left. A bound equal to it is still looked at, because ties
   go to the smaller id.

Bounds are computed in doubles and widened by more than doubles can be wrong, so they hold for
components of any size; scores are whole numbers.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from wayfare.llm.common import bounded_batches
from wayfare.session import materialise

TOP = 5
QUERY_STEP = 50
SCALE = 256
CELLS = 256
BLOCK_ROWS = 32_768
QUERY_ROWS = 256
# Rows of a block that are bounded at a time.
ROWS_AT_ONCE = 4096
# Query blocks whose best lower bounds a task holds.
KEPT_QUERIES = 64

BLOCK = "dim int, n int, ids binary, places binary, cells binary, lows binary, widths binary"
QUERIES = "dim int, q_ids binary, q_vectors binary, q_least binary"


def quantised(vector: Column, scale: int = SCALE) -> Column:
    """floor(scale * x) of each component, as long."""
    return F.transform(vector, lambda x: F.floor(x.cast("double") * scale).cast("long"))


def usable(vector: Column) -> Column:
    """Neither null nor with null, infinite or undefined components."""
    finite = F.forall(
        vector,
        lambda x: F.coalesce(
            ~F.isnan(x.cast("double")) & (F.abs(x.cast("double")) < float("inf")), F.lit(False)
        ),
    )
    return vector.isNotNull() & finite


def _in_groups(
    rows: DataFrame, size: int, schema: str, make: Callable[[list[tuple], np.ndarray], tuple]
) -> DataFrame:
    """Rows as they are scanned, `size` vectors of one length at a time; `make` sees all columns."""
    names = [c for c in rows.columns if c != "vector"]
    fields = [field.split() for field in schema.split(", ")]
    kinds = {"int": pa.int32(), "binary": pa.binary()}

    def out(own: list[tuple], vectors: list[np.ndarray]) -> pa.RecordBatch:
        matrix = np.array(vectors, np.int64).reshape(len(own), len(vectors[0]))
        row = make(own, matrix)
        return pa.RecordBatch.from_arrays(
            [pa.array([value], kinds[kind]) for value, (_, kind) in zip(row, fields)], [n for n, _ in fields]
        )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        waiting: dict[int, tuple[list, list]] = {}
        for batch in batches:
            if not batch.num_rows:
                continue
            vectors = batch.column("vector")
            values = vectors.flatten().to_numpy(zero_copy_only=False).astype(np.int64)
            ends = np.cumsum(vectors.value_lengths().to_numpy(zero_copy_only=False))
            own = zip(*(batch.column(name).to_pylist() for name in names))
            for row, vector in zip(own, np.split(values, ends[:-1])):
                rows_of, kept = waiting.setdefault(len(vector), ([], []))
                rows_of.append(row)
                kept.append(vector)
                if len(kept) == size:
                    yield out(*waiting.pop(len(vector)))
        for rows_of, kept in waiting.values():
            yield out(rows_of, kept)

    return rows.select(*names, "vector").mapInArrow(run, schema)


def _numbers(values: list, kind: type) -> bytes:
    return np.array(values, kind).tobytes()


def blocks(rows: DataFrame, block_rows: int, cells: int = CELLS) -> DataFrame:
    """Approximations of (id, place, vector) rows."""

    def block(own: list[tuple], matrix: np.ndarray) -> tuple:
        low = matrix.min(0) if matrix.size else np.zeros(0, np.int64)
        span = matrix.max(0).astype(object) - low if matrix.size else np.zeros(0, np.int64)
        width = np.maximum(1, np.array([-(-(int(s) + 1) // cells) for s in span], np.int64))
        code = ((matrix - low) // width).astype(np.uint8)
        return (
            matrix.shape[1], len(own), _numbers([i for i, _ in own], np.int64),
            _numbers([p for _, p in own], np.int64), code.tobytes(), low.tobytes(), width.tobytes(),
        )

    return _in_groups(rows, block_rows, BLOCK, block)


def query_blocks(asked: DataFrame, query_rows: int = QUERY_ROWS) -> DataFrame:
    """Blocks of (id, least, vector) queries; `least` is a score that results reach."""

    def block(own: list[tuple], matrix: np.ndarray) -> tuple:
        ids, least = zip(*own)
        return matrix.shape[1], _numbers(ids, np.int64), matrix.tobytes(), _numbers(least, float)

    return _in_groups(asked.select("id", "least", "vector"), query_rows, QUERIES, block)


class Block:
    """The cells of one block."""

    def __init__(self, row: dict):
        self.ids = np.frombuffer(row["ids"], np.int64)
        self.places = np.frombuffer(row["places"], np.int64)
        self.cells = np.frombuffer(row["cells"], np.uint8).reshape(len(self.ids), row["dim"])
        self.lows = np.frombuffer(row["lows"], np.int64).astype(float)
        self.widths = np.frombuffer(row["widths"], np.int64).astype(float)

    def bounds(self, queries: np.ndarray, rows: slice) -> tuple[np.ndarray, np.ndarray]:
        """The lowest and highest score that each query can have with each row's cells."""
        queries = queries.astype(float)
        low = self.lows + self.cells[rows] * self.widths
        high = low + (self.widths - 1)
        up, down = np.maximum(queries, 0), np.minimum(queries, 0)
        # A sum of n products is wrong by less than n + 4 roundings of the sum of their sizes.
        size = np.abs(queries) @ np.maximum(np.abs(low), np.abs(high)).T
        slack = size * ((queries.shape[1] + 4) * 2.0**-52)
        return up @ low.T + down @ high.T - slack, up @ high.T + down @ low.T + slack


class Queries:
    def __init__(self, row: dict):
        self.ids = np.frombuffer(row["q_ids"], np.int64)
        self.vectors = np.frombuffer(row["q_vectors"], np.int64).reshape(len(self.ids), row["dim"])
        self.least = np.frombuffer(row["q_least"], float)


def _bounded(queries: Queries, block: Block) -> Iterator[tuple[slice, np.ndarray, np.ndarray]]:
    """(rows, lower, upper) of a block, some rows at a time; a query's own rows are out of it."""
    for at in range(0, len(block.ids), ROWS_AT_ONCE):
        rows = slice(at, at + ROWS_AT_ONCE)
        lower, upper = block.bounds(queries.vectors, rows)
        own = queries.ids[:, None] == block.ids[rows]
        lower[own] = upper[own] = -np.inf
        yield rows, lower, upper


def _lowest_scores(pairs: DataFrame, k: int) -> DataFrame:
    """(id, lower): the k highest lower bounds of each query and task."""

    def out(kept: dict[bytes, np.ndarray]) -> pa.RecordBatch:
        ids = [np.repeat(np.frombuffer(key, np.int64), best.shape[1]) for key, best in kept.items()]
        lower = [best.ravel() for best in kept.values()]
        ids, lower = np.concatenate(ids or [np.zeros(0, np.int64)]), np.concatenate(lower or [np.zeros(0)])
        there = lower > -np.inf
        return pa.RecordBatch.from_arrays([pa.array(ids[there]), pa.array(lower[there])], ["id", "lower"])

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kept: dict[bytes, np.ndarray] = {}
        for batch in batches:
            for row in batch.to_pylist():
                queries, block = Queries(row), Block(row)
                best = kept.get(row["q_ids"], np.full((len(queries.ids), k), -np.inf))
                for _, lower, _ in _bounded(queries, block):
                    both = np.concatenate([best, lower], axis=1)
                    best = np.partition(both, both.shape[1] - k, axis=1)[:, -k:]
                kept[row["q_ids"]] = best
                if len(kept) > KEPT_QUERIES:
                    yield out(kept)
                    kept = {}
        yield out(kept)

    return pairs.mapInArrow(scan, "id long, lower double")


def _reaching(pairs: DataFrame) -> DataFrame:
    """(query_id, place, bound) of the rows whose upper bound reaches what a result has."""

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                queries, block = Queries(row), Block(row)
                for rows, _, upper in _bounded(queries, block):
                    which, place = np.nonzero((upper >= queries.least[:, None]) & (upper > -np.inf))
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(queries.ids[which]), pa.array(block.places[rows][place]), pa.array(upper[which, place])],
                        ["query_id", "place", "bound"],
                    )

    return pairs.mapInArrow(scan, "query_id long, place long, bound double")


def product(first: np.ndarray, second: np.ndarray) -> int:
    """The exact inner product; one that does not fit 64 bits is an error."""
    largest = [max(abs(int(v.min())), abs(int(v.max())), 1) if len(v) else 1 for v in (first, second)]
    if len(first) * largest[0] * largest[1] < 1 << 63:
        return int(first @ second)
    found = sum(a * b for a, b in zip(first.tolist(), second.tolist()))
    if not -(1 << 63) <= found < 1 << 63:
        raise OverflowError("a score does not fit 64 bits")
    return found


def _ranked(candidates: DataFrame, k: int) -> DataFrame:
    """The k best of each query, from rows sorted by query, then by bound, highest first."""

    def refine(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        query, best = None, []
        rows: list[tuple] = []

        def done() -> list[tuple]:
            return [(query, rank, number, -score) for rank, (score, number) in enumerate(best, 1)]

        def out() -> pa.RecordBatch:
            columns = list(zip(*rows)) or [[]] * 4
            kinds = (pa.int64(), pa.int32(), pa.int64(), pa.int64())
            return pa.RecordBatch.from_arrays(
                [pa.array(c, kind) for c, kind in zip(columns, kinds)], ["query_id", "rank", "vec_id", "score"]
            )

        for batch in batches:
            names = ("query_id", "id", "bound", "vector", "asked")
            for own, number, bound, vector, asked in zip(*(batch.column(c).to_pylist() for c in names)):
                if own != query:
                    rows += done()
                    query, best = own, []
                if len(best) == k and bound < -best[-1][0]:
                    continue  # so is every bound that is left
                score = product(np.array(asked, np.int64), np.array(vector, np.int64))
                best = sorted([*best, (-score, number)])[:k]
            if rows:
                yield out()
                rows = []
        rows = done()
        yield out()

    return candidates.mapInArrow(refine, "query_id long, rank int, vec_id long, score long")


def top_k(
    rows: DataFrame,
    is_query: Column,
    k: int = TOP,
    id_column: str = "vec_id",
    vector_column: str = "embedding",
    scale: int = SCALE,
    block_rows: int = BLOCK_ROWS,
) -> DataFrame:
    """(query_id, rank, vec_id, score): the k rows of highest score for each query row.

    Components become floor(scale * x); a score is an inner product of whole numbers, exact. Ties
    go to the smaller id. Rows without id, and vectors that are null or hold null or non-finite
    components, take no part. Vectors are compared with those of equal length. Rows that
    repeat an id all are candidates; as a query such an id has the least of its vectors, and
    none of its own rows as a result. A query without other rows has no result. Other columns
    are not read.
    """
    spark = bounded_batches(rows.sparkSession)
    vector = F.col(vector_column)
    read = rows.filter(F.col(id_column).isNotNull() & usable(vector))
    candidates = read.select(
        F.col(id_column).cast("long").alias("id"), quantised(vector, scale).alias("vector")
    )
    asked = read.filter(is_query).select(
        F.col(id_column).cast("long").alias("id"), quantised(vector, scale).alias("vector")
    )
    asked = materialise(asked.groupBy("id").agg(F.min("vector").alias("vector")))
    # Spark limits the group on each side of the exchange, so a very common vector is few rows.
    # Without any one id, which may be the query's own, k rows of a vector are left.
    repeats, equal = Window.partitionBy("vector", "id").orderBy("id"), Window.partitionBy("vector").orderBy("id")
    few = candidates.withColumn("_copy", F.row_number().over(repeats)).filter(F.col("_copy") <= k)
    few = few.withColumn("_copy", F.row_number().over(equal)).filter(F.col("_copy") <= 2 * k)
    exact = materialise(few.select("id", "vector").withColumn("place", F.monotonically_increasing_id()))
    cells = materialise(blocks(exact.select("id", "place", "vector"), block_rows))
    groups = max(cells.count(), 1)
    # Each block is a group of its own, so that pairs of blocks spread over all tasks.
    placed = materialise(
        cells.withColumn("_group", F.pmod(F.monotonically_increasing_id(), F.lit(groups)))
    )

    def pairs(questions: DataFrame) -> DataFrame:
        sent = materialise(query_blocks(questions)).withColumn(
            "_group", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(groups - 1).cast("long")))
        )
        return placed.join(sent, ["_group", "dim"]).drop("_group")

    nothing = F.lit(float("-inf"))
    lower = _lowest_scores(pairs(asked.withColumn("least", nothing)), k)
    nth = Window.partitionBy("id").orderBy(F.desc("lower"))
    reached = lower.withColumn("_nth", F.row_number().over(nth)).filter(F.col("_nth") <= k)
    # With fewer than k others, every one of them is a result.
    reached = reached.groupBy("id").agg(
        F.when(F.count(F.lit(1)) == k, F.min("lower")).otherwise(nothing).alias("least")
    )
    questions = asked.join(reached, "id").select("id", "vector", "least")
    found = _reaching(pairs(questions))
    candidates = found.join(exact, "place").join(
        asked.select(F.col("id").alias("query_id"), F.col("vector").alias("asked")), "query_id"
    )
    dealt = candidates.select("query_id", "id", "bound", "vector", "asked").repartition("query_id")
    return _ranked(dealt.sortWithinPartitions("query_id", F.desc("bound")), k)


SQL = f"""
WITH rows AS (
  SELECT vec_id, list_transform(embedding, lambda x: CAST(floor({SCALE} * CAST(x AS DOUBLE)) AS BIGINT)) AS v
  FROM embeddings
  WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR isnan(x) OR isinf(x))) = 0
), scores AS (
  SELECT q.vec_id AS query_id, c.vec_id,
    CAST(list_sum(list_transform(list_zip(q.v, c.v), lambda z: z[1] * z[2])) AS BIGINT) AS score
  FROM rows AS q JOIN rows AS c ON q.vec_id <> c.vec_id AND len(q.v) = len(c.v)
  WHERE q.vec_id % {QUERY_STEP} = 0
), ranked AS (
  SELECT query_id, vec_id, score,
    CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank
  FROM scores
)
SELECT query_id, rank, vec_id, score FROM ranked WHERE rank <= {TOP}"""
