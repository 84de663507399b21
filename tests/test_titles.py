"""Titles that meet on pieces: no alike pair is missed, few others meet, and matches stay the same."""

import random

import pytest
from pyspark.sql import functions as F

from docflow.operators import structure

SYLLABLES = ["ka", "lo", "mi", "ne", "tu", "ra", "so", "vi", "de", "po", "xi", "bu"]


def titles(rng, n):
    base = ["".join(rng.choices(SYLLABLES, k=rng.randrange(1, 14))) for _ in range(n)]
    out = []
    for t in base:
        c = list(t)
        for _ in range(rng.randrange(0, 1 + len(c) // 4)):
            k = rng.randrange(len(c) + 1)
            c[k : k + rng.randrange(2)] = rng.choice(["", "z", "q"])
        out.append("".join(c))
    return base, out


@pytest.mark.parametrize("least", [0.8, 0.7, 0.9])
def test_no_alike_pair_is_missed(spark, least):
    a, b = titles(random.Random(1), 150)
    left = spark.createDataFrame([(1, t) for t in a], "doc_id long, key string")
    right = spark.createDataFrame([(1, t) for t in [*b, "", "x"]], "doc_id long, rkey string")
    longest = F.greatest(F.length("key"), F.length("rkey"))
    alike = left.distinct().join(right.distinct(), "doc_id").where((1 - F.levenshtein("key", "rkey") / longest >= least) & (longest > 0))
    met = structure.title_pairs(left, right, least)
    assert alike.join(met, ["doc_id", "key", "rkey"], "left_anti").count() == 0 and alike.count() > 50


def headings(rows):
    return [(d, i, t, 1 + i % 3) for d, ts in rows.items() for i, t in enumerate(ts)]


def test_matches_are_the_same_either_way(spark, monkeypatch):
    rng = random.Random(2)
    sides = {d: titles(rng, 40) for d in range(3)} | {3: (["", "Ab", "a title"], ["ab", "a tidle", ""]), 4: (["alone"], [])}
    schema = "doc_id long, pos long, title string, level long"
    one, two = (spark.createDataFrame(headings({d: s[k] for d, s in sides.items()}), schema) for k in (0, 1))
    key = lambda df: sorted(tuple(r) for r in df.collect())
    direct = key(structure.match_headings(one, two))
    monkeypatch.setattr(structure, "MANY_PAIRS", 0)
    assert key(structure.match_headings(one, two)) == direct
    assert {r[4] for r in direct} == {"exact", "approximate", "missing"}


def test_few_pairs_of_a_large_document(spark):
    a, b = titles(random.Random(3), 2000)
    long = lambda ts: [(1, t) for t in ts if len(t) >= 8]
    left, right = spark.createDataFrame(long(a), "doc_id long, key string"), spark.createDataFrame(long(b), "doc_id long, rkey string")
    assert structure.title_pairs(left, right, 0.8).count() < 0.02 * left.count() * right.count()
