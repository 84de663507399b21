"""The M-tree's top-k against all inner products, in exact whole numbers, and what its bounds save."""

import math
import random

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from docflow.llm import metric_tree as mt
from docflow.llm import queries
from tests.compare import connect, same


def clusters(rng, count, each, dim, spread=0.02):
    x = rng.standard_normal((count, dim))
    return np.repeat(x / np.linalg.norm(x, axis=1, keepdims=True), each, 0) + spread * rng.standard_normal((count * each, dim)) / math.sqrt(dim)


CASES = {
    "gaussian": lambda rng: rng.standard_normal((1500, 16)),
    "clusters": lambda rng: clusters(rng, 30, 50, 32),
    "one dense cluster": lambda rng: np.vstack([clusters(rng, 1, 1500, 16, 0.001), clusters(rng, 50, 10, 16)]),
    "unequal norms": lambda rng: rng.standard_normal((1500, 8)) * np.exp(2 * rng.standard_normal((1500, 1))),
    "many ties": lambda rng: rng.integers(-1, 2, (1500, 4)) / 1024,
    "copies": lambda rng: np.vstack([np.ones((900, 8)), rng.standard_normal((600, 8))]),
    "zeros": lambda rng: np.zeros((50, 3)),
    "beyond 64 bits": lambda rng: rng.standard_normal((60, 4)) * 1e12,
    "huge": lambda rng: rng.standard_normal((60, 4)) * 1e300,
    "eleven": lambda rng: rng.standard_normal((11, 5)),
    "five": lambda rng: rng.standard_normal((5, 5)),
    "one": lambda rng: np.ones((1, 5)),
}


def whole(x):
    return [max(-(1 << 63), min((1 << 63) - 1, math.floor(1024.0 * float(c)))) if math.isfinite(1024.0 * float(c)) else ((1 << 63) - 1 if c > 0 else -(1 << 63)) for c in x]


def brute(rows, every):
    v = {i: whole(x) for i, x in rows}
    out = {}
    for q in (i for i in v if i % every == 0):
        clip = lambda s: max(-(1 << 63), min((1 << 63) - 1, s))
        s = sorted((-clip(sum(a * b for a, b in zip(v[q], v[c], strict=True))), c) for c in v if c != q)
        out[q] = [(-x, c) for x, c in s[:10]]
    return {q: x for q, x in out.items() if x}


def got(df):
    out = {}
    for r in sorted(df.collect(), key=lambda r: (r.query_id, r.rank)):
        out.setdefault(r.query_id, []).append((r.score, r.vec_id))
        assert r.rank == len(out[r.query_id])
    return out


@pytest.mark.parametrize("name", CASES)
def test_equals_all_products(spark, name, monkeypatch):
    for n, x in {"CELL": 200, "NODE": 64, "PAGE": 8, "BLOCK": 16, "CROWD": 20}.items():
        monkeypatch.setattr(mt, n, x)
    x = CASES[name](np.random.default_rng(4))
    ids = random.Random(5).sample(range(1, 10_000), len(x))
    ids[0] = 0
    rows = list(zip(ids, x.tolist(), strict=True))
    df = spark.createDataFrame([(i, v, 7) for i, v in rows], "vec_id long, embedding array<double>, score int").repartition(3)
    assert got(mt.nearest(df, lambda i: i % 40 == 0)) == brute(rows, 40)


def test_odd_rows(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(0, [1.0, 2.0]), (None, [9.0, 9.0]), (1, None), (2, [nan, 1.0]), (3, [inf, 1.0]), (4, [None, 1.0]), (5, [1.0]), (6, []), (100, [0.0, 0.0]), (101, [1.0, 2.0]), (101, [1.0, 2.0]), (101, [0.5, 2.0]), (-100, [-1.0, 0.0])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    kept = [(0, [1.0, 2.0]), (100, [0.0, 0.0]), (101, [0.5, 2.0]), (-100, [-1.0, 0.0])]
    assert got(mt.query(df)) == brute(kept, 100)
    for none in (df.limit(0), df.where("vec_id is null"), df.where("vec_id = 0")):
        assert mt.query(none).count() == 0 and mt.query(none).columns == ["query_id", "rank", "vec_id", "score"]


def test_stored_bounds_save_distances(monkeypatch):
    rng = np.random.default_rng(1)
    v = np.floor(1024 * clusters(rng, 40, 50, 32)).astype(np.int64)
    space = mt.Space(32, float(mt._norm2(v).max()))
    pivot = v[0]
    parents = space.distances(v, pivot[None])[:, 0]
    node = mt.Node(space, pivot)
    for route, own, d in mt._paged(v, parents, space):
        columns = {"route": [v[route]], "parent": [parents[route]], "radius": [d.max()], "vs": [v[own].ravel()], "parents": [d], "ids": [[[int(i)] for i in own]]}
        node.add(pa.RecordBatch.from_pydict({k: pa.array([x.tolist() if hasattr(x, "tolist") else x for x in c]) for k, c in columns.items()}))
    ids = np.arange(0, len(v), 20)
    found, computed = node.best(ids, v[ids], np.full(len(ids), mt._LEAST), 10)
    s = v[ids] @ v.T
    for row, i in enumerate(ids):
        order = [j for j in np.lexsort((np.arange(len(v)), -s[row])) if j != i][:10]
        assert found[row] == [(s[row, j], j) for j in order]
    assert computed < 0.35 * len(ids) * len(v)


def test_query_equals_sql(spark, sf):
    same(queries.op11_metric_tree(spark, sf), connect(sf), mt.ORACLE)


def test_every_row_as_query(spark):
    x = np.random.default_rng(2).standard_normal((120, 6))
    df = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], "vec_id long, embedding array<double>")
    assert got(mt.nearest(df, lambda i: F.lit(True))) == brute(list(enumerate(x.tolist())), 1)
