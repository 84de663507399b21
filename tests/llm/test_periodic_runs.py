"""Runs of words against a comparison of every word with every later one, and the query against the plain rule."""

import hashlib
import random
import re
import zlib

import numpy as np
import pytest

from docflow.llm import periodic_runs, queries


def brute(words, min_length=24, min_exponent=3):
    found = {}
    for q in range(1, len(words) // min_exponent + 1):
        i = 0
        while i + q < len(words):
            j = i
            while j + q < len(words) and words[j] == words[j + q]:
                j += 1
            if j > i and j - i + q >= max(min_length, min_exponent * q):
                found.setdefault((i, j - i + q), q)  # the smallest period comes first
            i = j + 1
    return sorted((s, n, q) for (s, n), q in found.items())


def repeating(rng, most=6):
    """Words with stretches that repeat, some of them in part."""
    k, words = rng.choice((1, 2, 2, 3, 6, 50)), []
    for _ in range(rng.randrange(most)):
        part = [str(rng.randrange(k)) for _ in range(rng.randrange(1, 30))]
        words += part * rng.randrange(1, 7) + part[: rng.randrange(len(part))]
    return words


def fibonacci(n):
    a, b = ["a"], ["a", "b"]
    while len(b) < n:
        a, b = b, b + a
    return b[:n]


@pytest.mark.parametrize("bounds", [(24, 3), (2, 2), (6, 2), (10, 4)])
@pytest.mark.parametrize("together", [20, periodic_runs.TOGETHER])
def test_batches_of_texts(bounds, together, monkeypatch):
    monkeypatch.setattr(periodic_runs, "TOGETHER", together)
    rng = random.Random(7)
    for _ in range(60):
        texts = [repeating(rng) for _ in range(rng.randrange(1, 8))] + [fibonacci(rng.randrange(300))]
        ends = np.concatenate([[0], np.cumsum([len(t) for t in texts])])
        number = {w: i for i, w in enumerate(sorted({w for t in texts for w in t}))}
        start, length, period = periodic_runs.runs_of(np.array([number[w] for t in texts for w in t], np.int64), ends, *bounds)
        got = [[] for _ in texts]
        for s, n, q in zip(start, length, period, strict=True):
            row = int(np.searchsorted(ends, s, side="right")) - 1
            got[row].append((s - ends[row], n, q))
        assert got == [brute(t, *bounds) for t in texts]


def test_long_texts_take_few_steps():
    rng = np.random.default_rng(0)
    for words in (np.zeros(300_000), np.tile(np.arange(60_000), 5), np.tile(rng.integers(0, 9, 1000), 200), np.append(rng.integers(0, 2, 100_000), np.zeros(24))):
        start, length, period = periodic_runs.runs_of(words.astype(np.int64), np.array([0, len(words)]))
        assert len(start) and (length >= 3 * period).all()


def expected(doc_id, text):
    words = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    n, h = len(words), None if doc_id is None else zlib.crc32(str(doc_id).encode())
    if h is not None and h % 10 == 0 and n:
        g = h // 10
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        words = words[:a] + [words[a + (i - a) % p] for i in range(a, n)]
    runs = brute(words)
    best = max(runs, key=lambda r: (r[1] / r[2], -r[0], -r[2]), default=None)
    dropped = {i for s, length, q in runs for i in range(s + q, s + length)}
    sha = lambda x: hashlib.sha256(x.encode()).hexdigest()
    told = (*best, 1000 * best[1] // best[2]) if best else (None,) * 4
    return doc_id, len(runs), *told, sha("".join(f"{s},{length},{q}\n" for s, length, q in runs)), sha(" ".join(w for i, w in enumerate(words) if i not in dropped))


def test_query_equals_the_rule(spark):
    rng = random.Random(11)
    texts = [None, "", " \n", "a", "a " * 23, "a " * 24, "b a\x0b" * 13, "c " * 5000, "é\x85x 🎉 " * 30, " ".join(map(str, range(400)))]
    texts += [rng.choice((" ", "\n", "\t ")).join(repeating(rng)) for _ in range(250)]
    rows = [(i, t, 1) for i, t in enumerate(texts)] + [(None, texts[20], 1), (4, texts[4], 1), (10, texts[11], 1)]
    df = spark.createDataFrame(rows, "doc_id long, text string, runs int")
    got = sorted((tuple(r) for r in periodic_runs.query(df).collect()), key=repr)
    assert got == sorted((expected(i, t) for i, t, _ in rows), key=repr)
    assert len({r[0] for r in got if r[1] > 1}) > 20
    assert periodic_runs.query(df.limit(0)).count() == 0
    with pytest.raises(ValueError):
        periodic_runs.find_runs(df, "text", min_exponent=1)


def test_query_on_short_documents_of_the_table(spark, sf):
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}
    got = {r.doc_id: tuple(r) for r in queries.op13_periodic_runs(spark, sf).collect()}
    assert got.keys() == texts.keys()
    short = [i for i, t in texts.items() if len((t or "").split()) < 700]
    assert len(short) > 100 and all(got[i] == expected(i, texts[i]) for i in short)
