"""Clustering against a plain version that computes every distance anew."""

import hashlib
import math
import random
from collections import Counter

import numpy as np
import pytest

from wayfare.llm import centroids as C


def plain(rows, clusters, rounds, components, scale=256):
    kept = []
    for vec_id, v in rows:
        if v is not None and len(v) == components and all(x is not None and math.isfinite(x) for x in v):
            kept.append((vec_id, [math.floor(scale * x) for x in v]))
    order = sorted(kept, key=lambda r: (hashlib.sha256(f"2:{'' if r[0] is None else r[0]}".encode()).hexdigest(), r[1]))
    middle = [x for _, x in order[:clusters]]

    def assign():
        found = []
        for _, x in kept:
            found.append(min((sum((a - b) ** 2 for a, b in zip(x, m)), c) for c, m in enumerate(middle)))
        return found

    for _ in range(rounds):
        found = assign()
        for c in range(len(middle)):
            mine = [x for (_, x), (_, own) in zip(kept, found) if own == c]
            if mine:
                middle[c] = [sum(column) // len(mine) for column in zip(*mine)]
    found = assign()
    inertia = Counter()
    for d, c in found:
        inertia[c] += d
    return Counter(
        (vec_id, c, d, inertia[c], sum(inertia.values()), tuple(middle[c]))
        for (vec_id, _), (d, c) in zip(kept, found)
    )


def rows_of(df):
    return Counter((*r[:5], tuple(r.centroid)) for r in df.collect())


SCHEMA = "vec_id long, embedding array<double>, x string, cluster string, distance long, dots string"


def frame(spark, rows):
    return spark.createDataFrame([(i, v, "a", "b", None, "c") for i, v in rows], SCHEMA).repartition(3)


@pytest.mark.parametrize("seed", range(3))
def test_equal_to_a_plain_version(spark, seed):
    source = random.Random(seed)
    large = [1, 1, 200_000][seed]
    rows = [(n, [large * source.gauss(n % 3, 0.4) for _ in range(4)]) for n in range(150)]
    rows += [(n, [0.5, -0.25, 0.0, 1.0]) for n in range(40)]
    assert rows_of(C.cluster_vectors(frame(spark, rows), 7, 4, 4)) == plain(rows, 7, 4, 4)


def test_odd_rows(spark):
    nan, inf = math.nan, math.inf
    rows = [
        (1, None), (2, []), (3, [1.0]), (4, [1.0, None]), (5, [nan, 1.0]), (6, [inf, 0.0]), (7, [0.0, -inf]),
        (None, [1.0, 2.0]), (8, [-0.001, 0.001]), (8, [-0.001, 0.001]), (8, [3.0, 3.0]), (9, [1.0, 2.0, 3.0]),
    ]
    for clusters in (1, 2, 40):
        assert rows_of(C.cluster_vectors(frame(spark, rows), clusters, 3, 2)) == plain(rows, clusters, 3, 2)
    assert C.cluster_vectors(frame(spark, rows[:7]), 3, 2, 2).count() == 0
    assert C.cluster_vectors(frame(spark, rows[:0]), 3, 2, 2).count() == 0


def test_too_large_components_are_refused(spark):
    with pytest.raises(ValueError, match="too large"):
        C.cluster_vectors(frame(spark, [(1, [1e300, 0.0])]), 1, 1, 2)


def test_only_changed_components_are_used():
    old = np.array([[1, 2, 3], [4, 5, 6], [7, 8, 9]])
    new = np.array([[1, 2, 3], [4, 0, 6], [8, 8, 8]])
    found = [(c, p.tolist(), d.tolist()) for c, p, d in C.changes_between(old, new)]
    assert found == [(1, [1], [-5]), (2, [0, 2], [1, -1])]
    x = np.random.default_rng(1).integers(-(1 << 29), 1 << 29, (50, 3))
    dots = x @ old.T
    for c, places, change in C.changes_between(old, new):
        for bound in (1 << 29, 1 << 62):
            assert (dots[:, c] + C.products(x, places, change, bound) == x @ new[c]).all()


def test_scratch_of_earlier_rounds_is_gone(spark, monkeypatch, tmp_path):
    made = []

    def folder(session):
        made.append(tmp_path / f"round{len(made)}")
        return str(made[-1])

    monkeypatch.setattr(C, "shared_dir", folder)
    source = random.Random(4)
    rows = [(n, [source.random(), source.random()]) for n in range(60)]
    found = C.cluster_vectors(frame(spark, rows), 5, 3, 2)
    assert [path.exists() for path in made] == [False] * (len(made) - 1) + [True]
    assert rows_of(found) == plain(rows, 5, 3, 2)
