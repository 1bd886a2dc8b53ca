"""The metric range join against all pairs in NumPy."""

import math

import numpy as np
import pytest

from yardline.llm import vector_join as V


def brute(rows, cosine):
    good = [i for i, (_, v) in enumerate(rows) if v and all(x is not None and math.isfinite(x) for x in v) and any(v)]
    links = {i: set() for i in range(len(rows))}
    unit = {i: np.array(rows[i][1], float) / np.abs(rows[i][1]).max() for i in good}
    unit = {i: x / np.linalg.norm(x) for i, x in unit.items()}
    for i in good:
        for j in good:
            if i != j and len(unit[i]) == len(unit[j]) and unit[i] @ unit[j] >= cosine:
                links[i].add(j)
    out = []
    for i, (name, _) in enumerate(rows):
        seen, todo = {i}, [i]
        while todo:
            for j in links[todo.pop()] - seen:
                seen.add(j)
                todo.append(j)
        least = min((rows[j][0] for j in seen if rows[j][0] is not None), default=None)
        out.append((name, len(links[i]), least, name is not None and name == least))
    return out


KEY = lambda r: tuple((x is not None, x or 0) for x in r)


def data(seed, n=300, d=6):
    rng = np.random.default_rng(seed)
    x = rng.normal(size=(n, d))
    x[: n // 3] = x[0] + rng.normal(scale=0.03, size=(n // 3, d))  # one tight group
    x[n // 3 : n // 2] = x[1] + rng.normal(scale=0.4, size=(n // 2 - n // 3, d))  # and a loose one
    chain = np.stack([np.cos(np.arange(60) * 0.05), np.sin(np.arange(60) * 0.05), *[np.zeros(60)] * (d - 2)], axis=1)
    rows = [(int(i), v.tolist()) for i, v in enumerate(np.concatenate((x, chain * 7)).astype(np.float32))]
    rows += [(1000, rows[5][1]), (1001, rows[5][1]), (7, rows[7][1]), (None, rows[9][1]), (None, [9.0] * d)]
    rows += [(2000, None), (2001, []), (2002, [0.0] * d), (2003, [1.0, None] + [0.0] * (d - 2)), (2004, [math.inf] + [1.0] * (d - 1)), (2005, [math.nan] * d)]
    rows += [(3000, [1.0, 2.0]), (3001, [2.0, 4.0]), (3002, [-1.0, -2.0]), (3003, [-0.0, 1.0]), (3004, [0.0, 5.0])]
    rows += [(4000, (np.array(rows[3][1]) * 1e-30).tolist())]
    return rows


@pytest.mark.parametrize(("cell", "block", "cosine"), [(1024, 4096, 0.95), (20, 7, 0.95), (3, 2, 0.8), (50, 1000, 0.99)])
def test_near_duplicates(spark, cell, block, cosine):
    rows = [(i, None if v is None else [None if x is None else float(np.float32(x)) for x in v]) for i, v in data(1)]
    table = spark.createDataFrame([(*r, "x", 3) for r in rows], "vec_id long, embedding array<float>, vector string, n int")
    got = [tuple(r) for r in V.near_duplicates(table, cosine=cosine, cell=cell, block=block).collect()]
    assert sorted(got, key=KEY) == sorted(brute(rows, cosine), key=KEY)


def test_doubles_and_small_products(spark, monkeypatch):
    monkeypatch.setattr(V, "PRODUCTS", 100)
    monkeypatch.setattr(V, "PIECE", 8)
    rows = [(i, [float(x) for x in v]) for i, v in data(2, 200, 16)[:200]]
    table = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    got = [tuple(r) for r in V.near_duplicates(table, cell=10, block=5).collect()]
    assert sorted(got, key=KEY) == sorted(brute(rows, 0.95), key=KEY)
    whole = spark.createDataFrame([(1, [1, 2]), (2, [2, 4]), (3, [2, -1])], "vec_id long, embedding array<int>")
    assert sorted(tuple(r) for r in V.near_duplicates(whole).collect()) == [(1, 1, 1, True), (2, 1, 1, False), (3, 0, 3, True)]


def test_pairs_at_the_limit(spark):
    """Cosines within rounding of floats are decided in doubles."""
    angles = [math.acos(0.95) + d for d in (-1e-9, 1e-9, -1e-7, 1e-7)]
    rows = [(0, [1.0, 0.0])] + [(i + 1, [math.cos(a), math.sin(a)]) for i, a in enumerate(angles)]
    got = {r.vec_id: r.n_links for r in V.near_duplicates(spark.createDataFrame(rows, "vec_id long, embedding array<double>")).collect()}
    assert got[0] == 2


def test_a_tight_group_is_not_compared(spark):
    rng = np.random.default_rng(3)
    rows = [(i, (np.ones(8) + rng.normal(scale=1e-3, size=8)).tolist()) for i in range(500)]
    vectors = spark.createDataFrame(rows, "node long, vector array<double>").selectExpr("node", "1L AS n", "vector", "size(vector) AS length")
    cells = V.choose_pivots(vectors, 50)
    placed = V.assigned(vectors.select("node", "n", "vector"), cells)
    V.measure(placed, cells, 100)
    assert V.dealt(placed, cells, math.acos(0.95)).filter("guest OR own").count() == 0
    table = vectors.selectExpr("node AS vec_id", "vector AS embedding")
    assert {(r.n_links, r.component_id) for r in V.near_duplicates(table, cell=50).collect()} == {(499, 0)}


def test_no_rows(spark):
    empty = spark.createDataFrame([], "vec_id long, embedding array<float>")
    assert V.near_duplicates(empty).collect() == []
    bad = spark.createDataFrame([(1, None), (1, None), (None, [])], "vec_id long, embedding array<float>")
    assert sorted((tuple(r) for r in V.near_duplicates(bad).collect()), key=KEY) == [(None, 0, None, False), (1, 0, 1, True), (1, 0, 1, True)]
