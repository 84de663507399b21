"""Main text, quality, toxicity and nearest neighbours: held-out accuracy and brute force."""

import random
import re
import time
import zlib
from html import unescape

import numpy as np
import pytest
from pyspark.sql import functions as F

from docflow.llm import html_crf, nn_descent, pu_quality, queries, toxic_segments

SF = "/root/testdata/sf0.1"


def test_unseen_layouts():
    model, right, total = html_crf.default_model(), 0, 0
    for html, labels in html_crf.labelled_pages(300, seed=1234):
        found = html_crf.block_features(html)
        got = model.viterbi(model.emissions(found))
        right, total = right + sum(a == b for a, b in zip(got, labels, strict=True)), total + len(labels)
    assert right / total > 0.98


def article(html):
    body = html[html.index("<article>") + 9 : html.index("</article>")]
    parts = [" ".join(unescape(re.sub("<[^>]+>", "", s.replace("<br>", " "))).split()) for s in re.split(r"</?(?:h1|p)>", body)]
    return "\n".join(p for p in parts if p)


def test_every_page(spark, sf):
    pages = spark.read.parquet(f"{sf}/pages.parquet")
    want = {r.page_id: article(r.html) for r in pages.collect()}
    for r in queries.op5_html_crf(spark, sf).collect():
        assert r.text == want[r.page_id] and r.n_chars == len(r.text)


@pytest.mark.parametrize(
    ("html", "text"),
    [(None, ""), ("", ""), ("  <!-- x -->", ""), ("<nav><a>Home</a></nav><article><h1>T &amp; U</h1><p>One\n two&nbsp;three, and so on.<p>1 < 2 & 3<script>x</p></script></article><footer>&copy; me</footer>", "T & U\nOne two three, and so on.\n1 < 2 & 3")],
)
def test_odd_pages(spark, html, text):
    df = spark.createDataFrame([(1, "u", html, 5), (1, "u", html, 5)], "page_id long, url string, html string, n_chars int")
    assert [r.text for r in html_crf.extract(df).collect()] == [text, text]
    assert html_crf.extract(df.limit(0)).count() == 0


PROSE = "The old harbour was rebuilt after the storm, and its walls now hold against the winter tides. Ships come in by night."


@pytest.mark.parametrize(
    ("html", "text"),
    [
        (f"<body><div><ul><li><a href=/>Home</a></li><li><a href=/n>News</a></li></ul></div><div><p>{PROSE}</p><p>{PROSE} More of it.</p></div><div>&copy; 2024 Harbour Press</div></body>", f"{PROSE}\n{PROSE} More of it."),
        (f"<body><div class=x9><p>{PROSE}</p><p>{PROSE}</p></div></body>", f"{PROSE}\n{PROSE}"),
        (f"<article><p>{PROSE} &am<b>p;</b> x</p></article>", f"{PROSE} &amp; x".replace("&amp;", "&am" + "p;")),
        (f"<article><p>{PROSE}<svg></p><p>{PROSE}</p></article>", f"{PROSE}\n{PROSE}"),
        (f"<article><p>{PROSE} <math><mi>x</mi></math> <svg><text>icon</text></svg></p></article>", f"{PROSE} x"),
    ],
)
def test_text_decides_where_names_do_not(html, text):
    assert html_crf.default_model().main_text(html) == text


def wrapped(html, depth):
    return "<div>" * depth + html + "</div>" * depth


SHORT = "The old harbour was rebuilt after the storm. Its walls now hold against the winter tides."


@pytest.mark.parametrize("text", [SHORT, "Rain fell on the market all day. Few people came."])
@pytest.mark.parametrize("box", ["article", "main", "div"])
@pytest.mark.parametrize("depth", [0, 1, 10, 300])
def test_short_pages(text, box, depth):
    read = html_crf.default_model().main_text
    assert read(f"<body>{wrapped(f'<{box}><p>{text}</p></{box}>', depth)}<footer>Copyright 2020</footer></body>") == text
    assert read(f"<body>{wrapped(f'<{box}><p>{text}</p></{box}>', depth)}</body>") == text
    assert read(f"<{box}><p>{text}</p></{box}><div class=comments><p>I disagree.</p></div>") == text


def test_markup_without_bounds():
    read = html_crf.default_model().main_text
    picture = "data:image/svg+xml," + "<svg x='1'>" * 20_000
    assert read(f'<article><p>{SHORT}</p><img src="{picture}"><p>{PROSE}</p></article>') == f"{SHORT}\n{PROSE}"
    assert read(f'<article><p title="{"> " * 100_000}">{SHORT}</p><p>{PROSE}</p></article>') == f"{SHORT}\n{PROSE}"
    many = [(text, tag, above) for text, tag, above, _ in html_crf.blocks(f"<nav>{'<i>' * 10_000}menu</nav><p>{SHORT}</p>")]
    assert many == [("menu", "nav", frozenset({"in:nav"})), (SHORT, "p", frozenset({"in:p"}))]
    names = "".join(f"<div class='{w}'>" for w in sorted({f for f in html_crf.default_model().weights if f.startswith("name:")}) for _ in range(3))
    assert list(html_crf.blocks(names.replace("name:", "") + "x"))[0][0] == "x"
    assert [b[0] for b in html_crf.blocks("<p>one<p a='b>c' d=e>two<b <i>x</b> three<p class=\"open>four")] == ["one", "twox three", "four"]
    assert [b[0] for b in html_crf.blocks("<p>one</p><p>two <b")] == ["one", "two"]


def test_pages_without_names():
    """Unseen pages that have no telling name or tag, and what is left elsewhere when names are taken away."""
    model, rng = html_crf.default_model(), random.Random(99)

    def accuracy(pages, keep):
        right = total = 0
        for html, labels in pages:
            found = [(t, own, frozenset(f for f in above if keep in f)) for t, own, above in html_crf.block_features(html)]
            got = model.viterbi(model.emissions(found))
            right, total = right + sum(a == b for a, b in zip(got, labels, strict=True)), total + len(labels)
        return right / total

    plain = [html_crf._labelled(["<body>", *html_crf._plain_body(rng), "</body>"]) for _ in range(200)]
    assert accuracy(plain, "") > 0.97
    assert accuracy(html_crf.labelled_pages(200, seed=99), "in:") > 0.75


@pytest.mark.parametrize("piece", ["<a ", "<b>x", '<a ">"', "<!", "<svg>", "<div>", "</i><b>", "<i><div><b></i>", "<!--", "<p><table><td><div>", "<a '\"", "<div class=n{}>y"])
def test_time_follows_broken_markup(piece):
    def seconds(n):
        html = "".join(piece.replace("{}", str(i)) for i in range(n // len(piece)))
        began = time.perf_counter()
        list(html_crf.blocks(html))
        return time.perf_counter() - began

    few, many = min(seconds(100_000) for _ in range(2)), min(seconds(200_000) for _ in range(2))
    assert few < 1.5 and many < 3 * few + 0.1


def test_viterbi_is_the_best_path():
    rng = random.Random(2)
    for _ in range(200):
        n = rng.randrange(1, 7)
        e = [rng.gauss(0, 2) for _ in range(n)]
        m = html_crf.Crf({}, [[rng.gauss(0, 1) for _ in range(2)] for _ in range(2)], rng.gauss(0, 1), 0.0)
        paths = [[k >> i & 1 for i in range(n)] for k in range(1 << n)]
        value = lambda y: m.start * y[0] + sum(e[i] * y[i] for i in range(n)) + sum(m.steps[a][b] for a, b in zip(y, y[1:], strict=False))  # noqa: B023, E731
        assert value(m.viterbi(e)) == pytest.approx(max(map(value, paths)))


def held_out(rows, labels, folds, k):
    out = [(labels[r.doc_id], r.score, r.predicted) for r in rows if r.doc_id in labels and r.held_out]
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % folds == k) for r in rows if r.doc_id is not None)
    y, s = np.array([o[0] for o in out]), np.array([o[1] for o in out])
    wins = (s[y == 1][:, None] > s[y == 0]).mean() + 0.5 * (s[y == 1][:, None] == s[y == 0]).mean()
    return wins, np.mean([o[2] == o[0] for o in out])


ODD = [(10**6, None), (10**6 + 1, ""), (10**6 + 2, " \n"), (None, "some words here"), (10**6 + 3, "w " * 30_000), (10**6 + 4, "é|*"), (10**6 + 4, "é|*")]


@pytest.mark.parametrize(("module", "label", "folds", "k", "auc", "accuracy"), [(pu_quality, "quality", 5, 0, 0.97, 0.95), (toxic_segments, "toxic", 4, 2, 0.94, 0.96)])
def test_classifiers_on_held_out_labels(spark, module, label, folds, k, auc, accuracy):
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text")
    labels = spark.read.parquet(f"{SF}/labels.parquet")
    df = docs.union(spark.createDataFrame(ODD, "doc_id long, text string")).withColumn("score", F.lit(1)).withColumn("stats", F.lit("x"))
    rows = module.classify(df, labels).collect()
    assert len(rows) == df.count() and all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.3) for r in rows)
    got = held_out(rows, {r.doc_id: r[label] for r in labels.collect()}, folds, k)
    assert got[0] >= auc and got[1] >= accuracy


@pytest.mark.parametrize("module", [pu_quality, toxic_segments])
def test_classifiers_without_labels_or_rows(spark, module):
    none = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    some = spark.createDataFrame([(1, 1, 1), (2, None, None), (None, 0, 0)], "doc_id long, quality int, toxic int")
    df = spark.createDataFrame([(1, "a b"), (2, None)], "doc_id long, text string")
    for labels in (none, some):
        assert module.classify(df, labels).count() == 2 and module.classify(df.limit(0), labels).count() == 0


def test_prior_and_risk():
    rng = np.random.default_rng(0)
    good, bad = rng.normal(0, 1, (3000, len(pu_quality.NAMES))), rng.normal(0, 1, (3000, len(pu_quality.NAMES)))
    bad[:, 0] += 4
    unlabelled = np.vstack([good[1000:2400], bad[:600]])
    cells = pu_quality._cells
    blocks = lambda edges, start, prior: pu_quality._minimise(cells(good[:1000], edges), cells(unlabelled, edges), start, prior)
    counted = lambda edges, w, cuts: np.histogram(w[cells(unlabelled, edges)].sum(1), cuts)[0]
    m = pu_quality.fit(good[:1000], blocks, counted)
    assert abs(m.prior - 0.7) < 0.12
    assert (m.score(good) > 0.5).mean() > 0.95 and (m.score(bad) < 0.5).mean() > 0.95


def test_quality_scores_do_not_depend_on_the_order_of_rows(spark, monkeypatch):
    monkeypatch.setattr(pu_quality, "BLOCK", 300)
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("doc_id", "text")
    labels = spark.read.parquet("/root/testdata/sf0.01/labels.parquet")
    one = {r.doc_id: r.score for r in pu_quality.classify(docs, labels).collect()}
    two = {r.doc_id: r.score for r in pu_quality.classify(docs.repartition(7), labels).collect()}
    assert one.keys() == two.keys() and max(abs(one[k] - two[k]) for k in one) < 1e-6


def brute_segments(s):

    def rec(a, b):
        best = None
        for i in range(a, b):
            t = 0.0
            for j in range(i, b):
                t += s[j]
                if t > 1e-12 and (best is None or t > best[0] + 1e-12):
                    best = (t, i, j + 1)
        return [] if best is None else rec(a, best[1]) + [(best[1], best[2])] + rec(best[2], b)

    return rec(0, len(s))


def test_segments_by_brute_force():
    rng = random.Random(3)
    for _ in range(600):
        scores = [rng.choice((-1.9, -0.8, -0.3, -0.1, 0.2, 0.7, 1.1, 2.3)) + rng.random() * 0.01 for _ in range(rng.randrange(25))]
        assert [x[:2] for x in toxic_segments.segments(scores)] == brute_segments(scores)


def check_neighbours(rows, vectors, step=20, k=20):
    ids = np.array(sorted(vectors))
    e = np.array([vectors[i] for i in ids], float)
    by = {}
    for r in rows:
        by.setdefault(r.query_id, []).append((r.rank, r.vec_id, r.score))
    recall = []
    for q in ids[ids % step == 0]:
        s = e @ np.array(vectors[q], float)
        keep = ids != q
        top = ids[keep][np.lexsort((ids[keep], -np.round(s[keep], 12)))][:k]
        got = sorted(by.get(q, []))
        assert [g[0] for g in got] == list(range(1, len(top) + 1))
        assert all(abs(g[2] - s[np.searchsorted(ids, g[1])]) < 1e-12 for g in got)
        assert all(a[2] > b[2] or (a[2] == b[2] and a[1] < b[1]) for a, b in zip(got, got[1:], strict=False))
        recall.append(len({g[1] for g in got} & set(top)) / max(len(top), 1))
    return float(np.mean(recall)) if recall else 1.0


def test_neighbours_through_the_graph(spark):
    df = spark.read.parquet(f"{SF}/embeddings.parquet")
    rows = nn_descent.query(df).collect()
    assert check_neighbours(rows, {r.vec_id: r.embedding for r in df.collect()}) >= 0.9


def test_odd_vectors(spark):
    rng = np.random.default_rng(1)
    good = {int(i): rng.normal(0, 1 + i % 3, 8).tolist() for i in range(90)}
    for i in range(100, 160):
        good[i] = good[20]  # one vector many times
    bad = [(200, None), (220, [0.0] * 8), (240, [float("nan")] * 8), (260, [float("inf")] + [1.0] * 7), (280, [None] + [1.0] * 7), (300, [1.0]), (None, [1.0] * 8), (40, good[40])]
    df = spark.createDataFrame([*good.items(), *bad], "vec_id long, embedding array<double>").withColumn("node", F.lit(1)).withColumn("score", F.lit("x"))
    assert check_neighbours(nn_descent.query(df).collect(), good) == 1.0
    few = df.where("vec_id in (0, 1, 2)")
    assert check_neighbours(nn_descent.query(few).collect(), {i: good[i] for i in (0, 1, 2)}) == 1.0
    assert nn_descent.query(df.where("vec_id = 0")).count() == 0 and nn_descent.query(df.limit(0)).count() == 0 and nn_descent.query(df.where("vec_id = 200")).count() == 0
