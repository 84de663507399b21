"""Small tables, clusters, unequal norms and extreme magnitudes in the neighbour search, against brute force."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from docflow.llm import nn_descent


def clustered(rng, count, each, size, spread=0.1):
    x = rng.standard_normal((count, size))
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    y = np.repeat(x, each, 0) + spread * rng.standard_normal((count * each, size)) / np.sqrt(size)
    return y[rng.permutation(len(y))]


CASES = {
    "clusters of 17": lambda rng: clustered(rng, 300, 17, 64),
    "few clusters": lambda rng: clustered(rng, 20, 17, 64),
    "one dense cluster among others": lambda rng: np.vstack([clustered(rng, 1, 1500, 32, 0.02), clustered(rng, 40, 20, 32)]),
    "gaussian": lambda rng: rng.standard_normal((2500, 64)),
    "unequal norms": lambda rng: rng.standard_normal((2500, 32)) * np.exp(rng.standard_normal((2500, 1))),
    "huge": lambda rng: np.abs(rng.standard_normal((60, 16))) * 1e200,
    "large": lambda rng: rng.standard_normal((400, 16)) * 1e150,
    "tiny": lambda rng: rng.standard_normal((60, 16)) * 1e-200,
    "subnormal": lambda rng: rng.standard_normal((60, 16)) * 1e-320,
    "21": lambda rng: np.vstack([np.ones((20, 8)) + 0.01 * rng.standard_normal((20, 8)), -np.ones((1, 8))]),
}


@pytest.mark.parametrize("name", CASES)
def test_recall(spark, name):
    x = CASES[name](np.random.default_rng(1))
    n = len(x)
    df = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], "vec_id long, embedding array<double>")
    by = {}
    for r in nn_descent.query(df).collect():
        by.setdefault(r.query_id, []).append((r.rank, r.vec_id, r.score))
    hits = []
    with np.errstate(over="ignore"):
        for q in range(0, n, 20):
            s = x @ x[q]
            ids = np.delete(np.arange(n), q)
            top = ids[np.lexsort((ids, -s[ids]))][:20]
            got = sorted(by[q])
            assert [g[0] for g in got] == list(range(1, min(20, n - 1) + 1))
            hits.append(len({g[1] for g in got} & set(top.tolist())) / len(top))
    assert np.mean(hits) >= 0.9


def test_hot_nodes_are_dealt_out(spark, monkeypatch):
    monkeypatch.setattr(nn_descent, "CROWD", 8)
    x = clustered(np.random.default_rng(2), 10, 30, 16)
    df = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], "vec_id long, embedding array<double>")
    rows = nn_descent.nearest(df, lambda i: i % 3 == 0).collect()
    best = {q: np.sort(np.delete(x @ x[q], q))[::-1][:20] for q in range(0, 300, 3)}
    assert len(rows) == 2000 and np.mean([abs(r.score - best[r.query_id][r.rank - 1]) < 1e-9 for r in rows]) >= 0.9


def test_every_row_of_a_table_of_21(spark):
    x = CASES["21"](np.random.default_rng(1))
    df = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], "vec_id long, embedding array<double>")
    got = nn_descent.nearest(df, lambda i: F.lit(True)).groupBy("query_id").count().collect()
    assert len(got) == 21 and all(r["count"] == 20 for r in got)
