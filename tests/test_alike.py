"""Edit distance and matching blocks against plain dynamic programming and the standard library's matcher."""

import difflib
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from docflow.functions import alike
from docflow.operators import similarity


def plain(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        before, row = row, [i]
        for j, y in enumerate(b, 1):
            row.append(min(before[j] + 1, row[-1] + 1, before[j - 1] + (x != y)))
    return row[-1]


def changed(rng, text, chars, share):
    out = []
    for c in text:
        r = rng.random()
        out.append("" if r < share / 3 else rng.choice(chars) if r < 2 * share / 3 else c + rng.choice(chars) if r < share else c)
    return "".join(out)


ALPHABETS = ["ab", "abcdefgh .,", "etaoin shrdlu ETAOIN.,;0123456789", "".join(map(chr, range(0x4E00, 0x4E00 + 400))), "a🎉é世\x00퟿"]


@pytest.mark.parametrize("chars", ALPHABETS)
def test_edit_distance(chars):
    rng = random.Random(1)
    for n in (0, 1, 2, 5, 63, 64, 65, 130, 200):
        for _ in range(6):
            a = "".join(rng.choices(chars, k=n))
            for b in (changed(rng, a, chars, 0.2), "".join(rng.choices(chars, k=rng.randrange(150))), a[::-1]):
                assert alike.edit_distance(a, b) == alike.edit_distance(b, a) == plain(a, b)


@pytest.mark.parametrize("few", [0, 3, alike.FEW])
@pytest.mark.parametrize("pairs", [7, alike.PAIRS])
@pytest.mark.parametrize("chars", ALPHABETS)
def test_blocks_equal_the_matcher(chars, few, pairs, monkeypatch):
    monkeypatch.setattr(alike, "FEW", few)
    monkeypatch.setattr(alike, "PAIRS", pairs)
    rng = random.Random(2)
    weights = np.random.default_rng(0).zipf(1.5, len(chars)).clip(1, 60).tolist()
    for n in (0, 1, 30, 199, 200, 201, 700):
        for _ in range(3):
            a = "".join(rng.choices(chars, weights, k=n))
            for b in (changed(rng, a, chars, 0.1), a.replace(chars[1], ""), "".join(rng.choices(chars, k=rng.randrange(400))), a):
                assert alike.block_ratio(a, b) == difflib.SequenceMatcher(None, a, b).ratio()


def test_documents(spark, sf):
    rows = spark.read.parquet(f"{sf}/documents.parquet").where("length(text) < 6000").limit(40).select("text", F.regexp_replace("text", "e", "").alias("b"))
    for r in rows.select("text", "b", similarity.edit_distance("text", "b").alias("d"), F.levenshtein("text", "b").alias("n"), similarity.sequence_ratio("text", "b").alias("s")).collect():
        assert r.d == r.n and r.s == difflib.SequenceMatcher(None, r.text, r.b).ratio()
    none = spark.createDataFrame([(None, "a"), ("a", None), (None, None), ("", "")], "a string, b string")
    assert [tuple(r) for r in none.select(similarity.edit_distance("a", "b"), similarity.sequence_ratio("a", "b")).collect()] == [(None, 0.0), (None, 0.0), (None, 1.0), (0, 1.0)]


def test_long_texts_take_no_pairs(monkeypatch):
    """A text of 400,000 characters and what is left of it: one pass, where pairs of places and columns of bits took minutes."""
    rng = random.Random(6)
    chars = "etaoin shrdlu" * 12 + "ETAOINSHRDLUBCDFGJKMPQVWXYZ"
    a = "".join(rng.choices(chars, k=400_000))
    b = a.replace("e", "")
    monkeypatch.setattr(alike.np, "packbits", None)  # no column of bits
    looked, listed = [0], alike._listed

    def counted(places, numbers):
        looked[0] += len(places)
        return listed(places, numbers)

    monkeypatch.setattr(alike, "_listed", counted)
    assert alike.edit_distance(a, b) == alike.edit_distance(b, a) == len(a) - len(b)
    assert 0.5 < alike.block_ratio(a, b) < 1 and 0 < looked[0] < 2 * len(a)
    assert alike.block_ratio(a[:9000], b[:9000]) == difflib.SequenceMatcher(None, a[:9000], b[:9000]).ratio()


def test_crossed_and_long_runs():
    rng = random.Random(7)
    wide = "".join(map(chr, range(0x4E00, 0x4E00 + 3000)))
    x, y = ("".join(rng.choices(wide, k=3000)) for _ in range(2))
    for a, b in ((x + y, y + x), (x, x), (x + "a" * 500 + y, x[5:] + "a" * 300 + y[:-7]), (x, y), ("a" * 300 + x, "a" * 200 + y)):
        assert alike.block_ratio(a, b) == difflib.SequenceMatcher(None, a, b).ratio()
