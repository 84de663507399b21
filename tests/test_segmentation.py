"""Word segmentation against all paths, and the lexicon against plain counts."""

import random
from collections import Counter
from math import log

import pytest
from pyspark.sql import functions as F

from docflow.operators import segmentation, similarity
from docflow.plans import registry


def paths(run):
    if not run:
        yield ()
    for k in range(1, len(run) + 1):
        for rest in paths(run[k:]):
            yield (run[:k], *rest)


def test_best_path_by_brute_force():
    rng = random.Random(0)
    chars = "甲乙丙丁戊"
    for _ in range(150):
        words = {"".join(rng.choices(chars, k=rng.choice((1, 1, 2, 2, 3, 4)))): rng.randrange(1, 50) for _ in range(12)}
        lex, total, least = segmentation.Lexicon(words.items()), sum(words.values()), min(words.values())
        for _ in range(10):
            run = "".join(rng.choices(chars + "己", k=rng.randrange(1, 9)))
            value = lambda p: sum(log(words.get(w, least) / total) if w in words or len(w) == 1 else -1e9 for w in p)  # noqa: B023, E731
            got = lex.words(run)
            assert "".join(got) == run and value(got) == pytest.approx(max(map(value, paths(run))))


def test_texts_and_odd_ones():
    lex = segmentation.Lexicon({"机器": 10, "学习": 10, "机": 2, "器": 2, "学": 2, "习": 2, "机器学习": 9}.items())
    assert lex.cut("机器学习model_v2 学习!") == ["机器学习", "model", "v2", "学习"]
    assert lex.cut(None) == lex.cut("") == lex.cut(" \n") == [] and segmentation.Lexicon([]).cut("未知") == ["未", "知"]
    assert "".join(lex.cut("机器" * 50_000)) == "机器" * 50_000


def test_lexicon_equals_plain_counts(spark):
    rng = random.Random(1)
    texts = ["".join(rng.choices(["机器", "学习", "的", "x ", "系统", "。"], k=30)) for _ in range(40)] + [None, ""]
    counts = Counter()
    for t in texts:
        for run in segmentation.re.findall("[一-鿿]+", t or ""):
            counts.update(run[i : i + k] for k in range(1, 5) for i in range(len(run) - k + 1))
    total = sum(n for w, n in counts.items() if len(w) == 1)
    want = {w: n for w, n in counts.items() if len(w) == 1 or (n >= 5 and all(n * total > counts[w[:k]] * counts[w[k:]] for k in range(1, len(w))))}
    df = spark.createDataFrame([(t,) for t in texts], "text string")
    assert {r.word: r.n for r in segmentation.lexicon_counts(df).collect()} == want and "机器" in want
    assert segmentation.lexicon_counts(df.limit(0)).count() == 0
    lex = segmentation.read_lexicon(segmentation.lexicon_counts(df))
    both = segmentation.segmented(df.withColumn("b", F.lit("学习系统")), lex, {"text": "x", "b": "y"})
    rows = both.select("text", "x", "y", segmentation.token_overlap(F.col("x"), F.col("y")).alias("o")).collect()
    assert all(r.x == lex.cut(r.text) and r.o == (len({*r.x} & {*r.y}) / len({*r.x} | {*r.y})) for r in rows)


def test_likeness_with_words(spark):
    df = spark.createDataFrame([("机器学习", "机器学会", ["机器", "学习"], ["机器", "学会"])], "a string, b string, x array<string>, y array<string>")
    a, b, x, y = map(F.col, "abxy")
    e, s = 0.75, 0.75
    assert df.select(similarity.text_similarity(a, b, (x, y)).alias("s")).first().s == pytest.approx(0.3 * e + 0.2 * 0 + 0.3 * s + 0.2 / 3)


def test_query(spark, sf):
    rows = registry.queries()["segmented_overlap"](spark, sf).collect()
    assert rows and all(r.n_words > 0 and 0 <= r.overlap <= 1 for r in rows)
