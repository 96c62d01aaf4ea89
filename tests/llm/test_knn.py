"""Voronoi kNN join against brute force in Python integers."""

from __future__ import annotations

import math
import random

import pytest

from sigflow.llm.knn import exact_top_k, shipped


def brute(rows, k=5, scale=256):
    clean = sorted({
        (i, tuple(math.floor(scale * x) for x in v))
        for i, v in rows if i is not None and v and all(x is not None and math.isfinite(x) for x in v)
    })
    out = []
    for q, x in clean:
        if q % 3:
            continue
        found = sorted((-sum(a * b for a, b in zip(x, y)), i) for i, y in clean if i != q and len(x) == len(y))
        out += [(q, r + 1, i, -s) for r, (s, i) in enumerate(found[:k])]
    return sorted(out)


def got(spark, rows, **options):
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>, score string")
    out = exact_top_k(df, df.filter("vec_id % 3 = 0"), **options)
    return sorted(tuple(r) for r in out.select("query_id", "rank", "vec_id", "score").collect())


def vectors(seed, n=160, dim=6):
    rng = random.Random(seed)
    hot = [rng.gauss(0, 1) for _ in range(dim)]
    rows = []
    for i in range(n):
        v = hot if i % 3 == 1 else [rng.gauss(0, 0.5) for _ in range(dim)]
        rows.append((i, list(v), "x"))
    return rows


@pytest.mark.parametrize("options", [{}, {"pivots": 4, "cell": 16}, {"pivots": 1, "cell": 7}])
def test_matches_brute_force(spark, options):
    rows = vectors(1)
    assert got(spark, rows, **options) == brute([r[:2] for r in rows])


def test_awkward_vectors(spark):
    rows = vectors(2, 40)
    rows += [(100, None, "x"), (102, [], "x"), (103, [1.0, None, 0.0, 0.0, 0.0, 0.0], "x"), (105, [float("nan")] * 6, "x")]
    rows += [(108, [float("inf")] * 6, "x"), (111, [1.0, 2.0], "x"), (112, [3.0, 4.0], "x"), (None, [0.0] * 6, "x")]
    rows += [(0, rows[0][1], "x")] * 2 + [(114, [0.0] * 6, "x"), (117, [0.0] * 6, "x"), (120, [5.0] * 9, "x")]
    assert got(spark, rows) == brute([r[:2] for r in rows])


def test_large_components_are_exact(spark):
    rng = random.Random(3)
    rows = [(i, [rng.choice([-1, 1]) * rng.random() * 2e5 for _ in range(4)], "x") for i in range(30)]
    assert got(spark, rows, pivots=3) == brute([r[:2] for r in rows])


def test_data_travel_only_where_queries_go(spark):
    """Groups without a visitor aren't shipped; others once per block of their own visitors."""
    cells = spark.createDataFrame([(6, 0, 3), (6, 1, 2), (6, 2, 9), (9, 0, 1)], "dim int, g int, cells int")
    visits = spark.createDataFrame([(6, 0)] * 41 + [(6, 1)] * 20 + [(7, 0)], "dim int, g int")
    out = {(r.dim, r.g): (r.cells, r.blocks) for r in shipped(visits, cells, 20).collect()}
    assert out == {(6, 0): (3, 3), (6, 1): (2, 1)}


def test_columns_with_names_of_its_own(spark):
    rows = vectors(4, 60)
    names = "vec_id long, embedding array<double>, id string, v string, g string, dim string, dist string, query_key string, cells string"
    df = spark.createDataFrame([(i, v, *"abcdefg") for i, v, _ in rows], names)
    out = exact_top_k(df, df.filter("vec_id % 3 = 0"))
    assert sorted(tuple(r) for r in out.select("query_id", "rank", "vec_id", "score").collect()) == brute([r[:2] for r in rows])


def test_empty(spark):
    assert got(spark, []) == []
