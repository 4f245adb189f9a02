"""Centroid clustering with a distance matrix that is kept up to date.

Vectors are integers, so every figure is exact. Each vector is stored with its dot products with
all centroids. When centroids move, a product changes by the components that changed times how
much they changed, and by nothing else; the squared distance is |x|^2 - 2 x.c + |c|^2, and the
nearest centroid the one of the smallest |c|^2 - 2 x.c. The first round starts from products with
the zero vector, of which every component may change.

A round reads the stored table once, row by row, and writes the next one to the shared folder;
the one before is then deleted. Vectors are never exchanged. Sums are made per task and added up
to one row per cluster, which the driver divides; centroids, whose number is a parameter, are the
only thing it sends out.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wayfare.llm.common import bounded_batches
from wayfare.session import delete_folder, shared_dir

SCALE = 256
COMPONENTS = 64
CLUSTERS = 40
ROUNDS = 5
SEED = "2"
# Vectors that a task holds at once.
ROWS_AT_ONCE = 8192

KEPT = "vec_id long, x array<int>, dots array<long>, cluster int, distance long"


def largest_component(components: int) -> int:
    """Components up to this size give distances and products below 2**62."""
    return min(1 << 30, int((2**60 / components) ** 0.5))


def scaled(vectors: DataFrame, components: int = COMPONENTS, scale: int = SCALE) -> DataFrame:
    """vec_id and x, the integers floor(scale * component) of vectors that are whole.

    Left out are vectors that are null, have another number of components, or hold null or
    non-finite ones.
    """
    values = F.col("embedding")
    finite = F.forall(values, lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) < float("inf")))
    whole = (F.size(values) == components) & F.coalesce(finite, F.lit(False))
    return vectors.select(F.col("vec_id").cast("long").alias("vec_id"), "embedding").filter(whole).select(
        "vec_id", F.transform(values, lambda v: F.floor(F.lit(scale) * v.cast("double"))).alias("x")
    )


def changes_between(old: np.ndarray, new: np.ndarray) -> list[tuple[int, np.ndarray, np.ndarray]]:
    """(centroid, components that changed, by how much) for each centroid that moved."""
    found = []
    for c, change in enumerate(new - old):
        places = np.flatnonzero(change)
        if len(places):
            found.append((c, places, change[places]))
    return found


def products(x: np.ndarray, places: np.ndarray, change: np.ndarray, bound: int) -> np.ndarray:
    """Exact products of some components with `change`; `bound` is above every |x|."""
    if bound * int(np.abs(change).sum()) < 1 << 53:  # doubles hold every partial sum
        return (x[:, places].astype(np.float64) @ change.astype(np.float64)).astype(np.int64)
    return x[:, places] @ change


def nearest(
    x: np.ndarray, dots: np.ndarray, centroids: np.ndarray
) -> tuple[np.ndarray, np.ndarray]:
    """(number, squared distance) of the nearest centroid, the smaller number on a tie."""
    scores = (centroids**2).sum(1) - 2 * dots
    best = scores.argmin(1)
    return best, (x**2).sum(1) + scores[np.arange(len(x)), best]


def _lists(values: np.ndarray, kind: pa.DataType) -> pa.Array:
    n, width = values.shape
    offsets = pa.array(np.arange(n + 1, dtype=np.int32) * width)
    return pa.ListArray.from_arrays(offsets, pa.array(values.ravel(), kind))


def _rows(batch: pa.RecordBatch, column: str, width: int) -> np.ndarray:
    return batch.column(column).flatten().to_numpy(zero_copy_only=False).astype(np.int64).reshape(-1, width)


def _update(table: DataFrame, old: np.ndarray, new: np.ndarray, bound: int) -> DataFrame:
    """Products, nearest centroid and distance of every vector after centroids moved."""
    moved = changes_between(old, new)
    k, width = new.shape
    first = "dots" not in table.columns

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for at in range(0, whole.num_rows, ROWS_AT_ONCE):
                batch = whole.slice(at, ROWS_AT_ONCE)
                x = _rows(batch, "x", width)
                dots = np.zeros((len(x), k), np.int64) if first else _rows(batch, "dots", k).copy()
                for c, places, change in moved:
                    dots[:, c] += products(x, places, change, bound)
                cluster, distance = nearest(x, dots, new)
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column("vec_id"), _lists(x, pa.int32()), _lists(dots, pa.int64()),
                        pa.array(cluster, pa.int32()), pa.array(distance, pa.int64()),
                    ],
                    ["vec_id", "x", "dots", "cluster", "distance"],
                )

    read = table.select("vec_id", "x", *(() if first else ("dots",)))
    return read.mapInArrow(run, KEPT)


def _sums(table: DataFrame, k: int, width: int) -> list:
    """One row per cluster: cluster, number of vectors, exact component sums."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts, totals = np.zeros(k, np.int64), np.zeros((k, width), np.int64)
        for batch in batches:
            x, cluster = _rows(batch, "x", width), batch.column("cluster").to_numpy()
            counts += np.bincount(cluster, minlength=k)
            for c in np.unique(cluster).tolist():
                totals[c] += x[cluster == c].sum(0)
        there = np.flatnonzero(counts)
        yield pa.RecordBatch.from_arrays(
            [pa.array(there, pa.int32()), pa.array(counts[there]), _lists(totals[there], pa.int64())],
            ["cluster", "n", "totals"],
        )

    parts = table.select("x", "cluster").mapInArrow(run, "cluster int, n long, totals array<long>")
    exact = "decimal(38,0)"
    return parts.groupBy("cluster").agg(
        F.sum("n").alias("n"),
        F.array(*(F.sum(F.col("totals")[j].cast(exact)) for j in range(width))).alias("totals"),
    ).collect()


def cluster_vectors(
    vectors: DataFrame,
    clusters: int = CLUSTERS,
    rounds: int = ROUNDS,
    components: int = COMPONENTS,
    scale: int = SCALE,
    seed: str = SEED,
) -> DataFrame:
    """vec_id, cluster, distance, cluster_inertia, inertia and centroid of every whole vector.

    Vectors that are not whole (see `scaled`) have no row. The first centroids are the vectors
    of the smallest SHA-256 of `seed:vec_id`, a null vec_id counting as an empty one; equal ids
    are ordered by their vectors. Each round assigns every vector to the nearest centroid, then
    moves every centroid that has vectors to the floor of their mean; at last vectors are
    assigned once more. Rows may repeat; each counts. No vectors give no rows, fewer than
    `clusters` vectors as many centroids. Other columns are not read. Components of more than
    `largest_component` after scaling raise ValueError, since distances would not fit.
    """
    spark = bounded_batches(vectors.sparkSession)
    table = scaled(vectors, components, scale)
    order = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("vec_id").cast("string"), F.lit(""))), 256)
    # A double is compared before it is made an integer, so nothing wraps.
    size = F.greatest(F.abs(F.array_max("embedding")), F.abs(F.array_min("embedding"))).cast("double")
    whole = vectors.filter(F.size("embedding") == components).select(F.coalesce(size, F.lit(0.0)).alias("s"))
    finite = whole.filter(~F.isnan("s") & (F.col("s") < float("inf")))
    bound = int(scale * (finite.agg(F.max("s")).first()[0] or 0)) + 1
    if bound > largest_component(components):
        raise ValueError(f"components of {bound} are too large for exact distances")
    first = table.orderBy(order, "x").limit(clusters).select("x").collect()
    if not first:
        empty = "vec_id long, cluster int, distance long, cluster_inertia long, inertia long, centroid array<long>"
        return spark.createDataFrame([], empty)
    new = np.array([row.x for row in first], np.int64)
    old, folder = np.zeros_like(new), None
    for number in range(rounds + 1):
        before, folder = folder, shared_dir(spark)
        _update(table, old, new, bound).write.parquet(folder)
        table = spark.read.schema(KEPT).parquet(folder)
        if before:
            delete_folder(spark, before)
        if number < rounds:
            old, new = new, new.copy()
            for row in _sums(table, *new.shape):
                new[row.cluster] = [int(total) // row.n for total in row.totals]
            if not changes_between(old, new):
                break  # every further round would repeat this one
    return _with_inertia(table, new)


def _with_inertia(table: DataFrame, centroids: np.ndarray) -> DataFrame:
    """Adds the figures of clusters: one row for each, so they are broadcast."""
    exact = F.sum(F.col("distance").cast("decimal(38,0)"))
    found = {row.cluster: int(row.total) for row in table.groupBy("cluster").agg(exact.alias("total")).collect()}
    total = sum(found.values())
    rows = [(c, found[c], total, centroids[c].tolist()) for c in sorted(found)]
    schema = "cluster int, cluster_inertia long, inertia long, centroid array<long>"
    figures = table.sparkSession.createDataFrame(rows, schema)
    return table.select("vec_id", "cluster", "distance").join(F.broadcast(figures), "cluster").select(
        "vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid"
    )


def _round(number: int) -> str:
    """SQL: assign to the centroids of a round, then move these."""
    return f"""
a{number} AS MATERIALIZED (
    SELECT vec_id, any_value(x) AS x, min(struct_pack(
        distance := list_sum([(p[1] - p[2]) * (p[1] - p[2]) for p in list_zip(x, m)]), cluster := c
    )) AS best
    FROM vectors, c{number} GROUP BY vec_id
),
c{number + 1} AS MATERIALIZED (
    SELECT c, coalesce(moved.m, c{number}.m) AS m
    FROM c{number} LEFT JOIN (
        SELECT c, list(CAST((s - ((s % n + n) % n)) // n AS BIGINT) ORDER BY j) AS m
        FROM (
            SELECT c, j, sum(v) AS s, count(*) AS n
            FROM (SELECT best.cluster AS c, unnest(x) AS v, generate_subscripts(x, 1) AS j FROM a{number})
            GROUP BY c, j
        ) GROUP BY c
    ) AS moved USING (c)
)"""


# For `embeddings`; the same rounds, with all distances computed anew in each.
SQL = f"""
WITH vectors AS MATERIALIZED (
    SELECT vec_id, [CAST(floor({SCALE} * CAST(v AS DOUBLE)) AS BIGINT) for v in embedding] AS x
    FROM embeddings
    WHERE len(embedding) = {COMPONENTS}
        AND len([v for v in embedding if v IS NOT NULL AND isfinite(v)]) = {COMPONENTS}
),
c0 AS MATERIALIZED (
    SELECT row_number() OVER (ORDER BY sha256('{SEED}:' || vec_id)) - 1 AS c, x AS m
    FROM vectors QUALIFY c < {CLUSTERS}
),
{",".join(_round(number) for number in range(ROUNDS + 1))}
SELECT vec_id, CAST(best.cluster AS INTEGER) AS cluster, CAST(best.distance AS BIGINT) AS distance,
    CAST(sum(best.distance) OVER (PARTITION BY best.cluster) AS BIGINT) AS cluster_inertia,
    CAST(sum(best.distance) OVER () AS BIGINT) AS inertia,
    sha256(array_to_string(m, ',')) AS centroid_sha256
FROM a{ROUNDS} JOIN c{ROUNDS} ON c = best.cluster
"""
