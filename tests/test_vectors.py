"""Trained vectors: related titles are nearer than unrelated ones; numbers against a plain computation; all levels in one report."""

import random

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from docflow.config import Pipeline
from docflow.operators import adapters, vectors
from docflow.plans import image_queries, pipeline

TOPICS = {"cold": ["ice", "snow", "frost", "winter", "glacier", "sleet"], "trade": ["price", "market", "stock", "profit", "merchant", "ledger"]}


def titles():
    """Words of one topic, of which the first and the last never meet."""
    rng, out = random.Random(0), []
    for words in TOPICS.values():
        for _ in range(60):
            w = rng.sample(words[1:-1], 2) + [rng.choice((words[0], words[-1]))] + [rng.choice(("the", "a", "notes"))]
            out.append(" ".join(rng.sample(w, len(w))))
    return out


def test_related_titles_are_nearer(spark):
    df = spark.createDataFrame([(t,) for t in titles()], "text string")
    words = {r.word: np.array(r.vector) for r in vectors.word_vectors(df).collect()}
    for mine, other in (("cold", "trade"), ("trade", "cold")):
        first, last = TOPICS[mine][0], TOPICS[mine][-1]
        assert not any(first in t.split() and last in t.split() for t in titles())
        assert words[first] @ words[last] > 0.8 > 0.5 > max(words[first] @ words[w] for w in TOPICS[other])


def test_numbers(spark):
    texts = ["red green", "green blue blue", "red", "red green", None, ""]
    units = spark.createDataFrame([(t,) for t in texts], "text string")
    index = {r.w: np.array(r.v) for r in spark.createDataFrame([("red",), ("green",), ("blue",)], "w string").select("w", vectors.index_vector(F.col("w")).alias("v")).collect()}
    assert all(abs(v).sum() <= vectors.ONES and abs(v).sum() % 2 == vectors.ONES % 2 and len(v) == vectors.SIZE for v in index.values())
    sets = [set((t or "").split()) for t in texts]
    n = {w: sum(w in s for s in sets) for w in index}
    weight = {w: np.log(1 + len(texts) / n[w]) for w in index}
    want = {w: sum((weight[x] * index[x] for s in sets if w in s for x in s if x != w), np.zeros(vectors.SIZE)) for w in index}
    got = {r.word: r for r in vectors.word_vectors(units).collect()}
    for w in index:
        assert got[w].weight == pytest.approx(weight[w]) and np.allclose(got[w].vector, want[w] / np.linalg.norm(want[w]))
    alone = vectors.word_vectors(spark.createDataFrame([("lonely",)], "text string")).collect()
    assert len(alone) == 1 and alone[0].vector is None
    assert vectors.word_vectors(units.limit(0)).count() == 0


def test_titles_and_sections(spark):
    words = vectors.word_vectors(spark.createDataFrame([(t,) for t in titles()], "text string"))
    side = lambda rows: spark.createDataFrame(rows, "doc_id long, pos long, title string")
    a = side([(1, 0, "ice the"), (2, 0, "ice"), (3, 0, "ice"), (4, 0, "unknownword")])
    b = side([(1, 0, "Sleet a"), (2, 0, "ledger"), (4, 0, "ice")])
    got = {r.doc_id: r.semantic for r in vectors.title_likeness(a, b, words).collect()}
    assert got[1] > 0.6 > 0.5 > got[2] and got[3] == got[4] == 0
    docs = spark.createDataFrame([(1, "# ice snow\n## sleet frost\nglacier"), (2, "# ice\n## ledger stock"), (3, "no sections"), (4, None)], "doc_id long, md string")
    c = {r.doc_id: r.semantic for r in vectors.section_coherence(docs, words).collect()}
    assert c[1] > c[2] and c[3] == c[4] == vectors.ALONE


def test_all_levels_in_one_report(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet").where("length(text) < 3000").limit(6).select("doc_id", F.concat(F.lit("# A\n\n"), "text", F.lit("\n\n## B\n\n"), "text").alias("md"))
    pages = image_queries.page_pairs(spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").join(docs.select("doc_id"), "doc_id"))
    done, report = pipeline.run(docs, Pipeline(language="en", correct=True, trained_meaning=True), adapters.EchoModel, pages)
    rows = report.collect()
    assert len(rows) == 6 and all(set(r.level_scores) == {f"level_{n}" for n in range(1, 6)} for r in rows)
    assert all(r.overall_score == pytest.approx(100 * np.mean(list(r.level_scores.values()))) for r in rows)
    ends = done.select("doc_id", "final_text", "pipeline_ready", "corrected").collect()
    assert len(ends) == 6 and {r.doc_id: r.pipeline_ready for r in ends} == {r.doc_id: r.quality_passed for r in rows}
    _, plain = pipeline.run(docs, Pipeline(language="en"))
    assert all(set(r.level_scores) == {"level_1", "level_3", "level_4"} for r in plain.collect())


def test_bins_change_nothing(spark, monkeypatch):
    rng = random.Random(4)
    texts = [" ".join(rng.choices([f"w{i}" for i in range(50)], k=rng.randrange(0, 30))) for _ in range(300)] * 2
    units = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")

    def both():
        words = vectors.word_vectors(units)
        return {r.word: (r.weight, r.vector) for r in words.collect()}, {r.doc_id: r.vector for r in vectors.text_vectors(units, words, ("doc_id",)).collect()}

    one = both()
    monkeypatch.setattr(vectors, "BIN", 4000)
    monkeypatch.setattr(vectors, "PAIRS", 7)
    assert vectors._binned(units, "text").select("_bin").distinct().count() > 20
    many = both()
    assert one[0].keys() == many[0].keys() and one[1].keys() == many[1].keys() and len(one[1]) == sum(t != "" for t in texts)
    assert all(one[0][w][0] == many[0][w][0] and np.allclose(one[0][w][1], many[0][w][1]) for w in one[0])
    assert all(np.allclose(one[1][d], many[1][d]) for d in one[1])


def test_equal_titles_are_met_once(spark, monkeypatch):
    met, binned = [], vectors._binned
    monkeypatch.setattr(vectors, "_binned", lambda rows, col: met.append(rows.count()) or binned(rows, col))
    a = spark.createDataFrame([(i % 2, i, t) for i, t in enumerate(["ice snow", "Snow frost", "ice snow"] * 100)], "doc_id long, pos long, title string")
    words = vectors.word_vectors(a.select("title"), "title")
    got = {r.doc_id: r.semantic for r in vectors.title_likeness(a, a.where("pos > 5"), words).collect()}
    assert got == pytest.approx({0: 1.0, 1: 1.0}) and met == [2, 4, 4]


def test_disk_follows_the_texts(spark):
    """Only words that are asked for have vectors under way, and texts are shuffled once."""
    rng, said = random.Random(5), [f"{i:05x}" for i in range(20000)]
    docs = spark.createDataFrame([(i, ("# 00001 00002 00003\n## b\n" if i < 5 else "") + " ".join(rng.choices(said, k=300))) for i in range(400)], "doc_id long, md string")
    written = lambda: sum(e.totalShuffleWrite() for e in (lambda found: [found.apply(i) for i in range(found.size())])(spark._jsc.sc().statusStore().executorList(False)))
    before = written()
    got = {r.doc_id: r.semantic for r in vectors.section_coherence(docs, vectors.section_words(docs)).collect()}
    assert written() - before < 5 * docs.select(F.sum(F.octet_length("md"))).first()[0]
    whole = {r.doc_id: r.semantic for r in vectors.section_coherence(docs, vectors.word_vectors(vectors.sections(docs))).collect()}
    assert got == pytest.approx(whole, abs=1e-9) and len(got) == 400 and all(got[i] == vectors.ALONE for i in range(5, 400)) and got[0] != vectors.ALONE


def test_words_that_are_asked_for(spark):
    docs = spark.createDataFrame([(1, "ice snow\n## frost ice"), (2, "snow ledger ice"), (3, "ledger stock"), (4, None)], "doc_id long, md string")
    every = {r.word: r for r in vectors.word_vectors(vectors.sections(docs)).collect()}
    some = {r.word: r for r in vectors.section_words(docs).collect()}
    assert set(some) == {"ice", "snow", "frost"} and set(every) == {*some, "ledger", "stock"}
    assert all(some[w].weight == every[w].weight and np.allclose(some[w].vector, every[w].vector, atol=1e-11) for w in some)


def test_vectors_under_way(spark, monkeypatch):
    rng = np.random.default_rng(6)
    matrix = rng.standard_normal((200, vectors.SIZE)) * 10.0 ** rng.integers(-9, 9, 200)[:, None]
    matrix[0] = 0
    matrix[1, 0] = -(10.0**12)
    sent = pa.table(vectors._whole(matrix))
    got = np.array([[r[f"d{d}"] for d in range(vectors.SIZE)] for r in spark.createDataFrame(sent).select(*(vectors._component(d).alias(f"d{d}") for d in range(vectors.SIZE))).collect()])
    assert (np.abs(got - matrix) <= np.abs(matrix).max(axis=1)[:, None] * 2.0**-39).all() and not got[0].any()
    units = spark.createDataFrame([(i, " ".join(f"w{rng.integers(60)}" for _ in range(12))) for i in range(300)], "doc_id long, text string")
    one = {r.word: r.vector for r in vectors.word_vectors(units).collect()}
    monkeypatch.setattr(vectors, "PIECE", 500)
    monkeypatch.setattr(vectors, "PART", 7)
    many = {r.word: r.vector for r in vectors.word_vectors(units).collect()}
    assert one.keys() == many.keys() and all(np.allclose(one[w], many[w], atol=1e-11) for w in one)
