"""Hand-made cases for text functions, with the expected values worked out by hand."""

import difflib
import random

import pytest
from pyspark.sql import functions as F

from docflow.functions import markdown, scoring, translation
from docflow.operators import chunking, reports, similarity, structure


def one(spark, column, **values):
    schema = ", ".join(f"{k} string" for k in values)
    df = spark.createDataFrame([tuple(values.values())], schema) if values else spark.range(1)
    return df.select(column.alias("x")).first().x


T = lambda: F.col("t")


@pytest.mark.parametrize(
    ("text", "plain"),
    [("# A\n\nb `c`\n| x | y |\n|---|\n: - :\nend\n", "A\n\nb c\nend"), ("", ""), ("###\nx", "x"), (" | a | \ny", "y")],
)
def test_to_plain(spark, text, plain):
    assert one(spark, markdown.to_plain(T()), t=text) == plain


def test_sections(spark):
    got = one(spark, markdown.sections(T()), t="intro\n# A\nx\n\n#\ny\n######## deep\n")
    assert [(s.id, s.title, s.level, s.content) for s in got] == [(0, "Section 1", 1, "intro"), (1, "A", 1, "x"), (2, "Section 3", 1, "y"), (3, "deep", 6, "")]
    assert one(spark, markdown.sections(T()), t="") == []


@pytest.mark.parametrize(
    ("text", "fixed"),
    [("```\na", "```\na\n```\n"), ("```\na\n```\n", "```\na\n```\n"), ("a\n", "a\n"), ("  ```\n", "  ```\n```\n"), ("", "")],
)
def test_close_fences(spark, text, fixed):
    assert one(spark, markdown.close_fences(T()), t=text) == fixed


def test_separator_only_where_a_line_follows(spark):
    f = markdown.add_separators(T())
    assert one(spark, f, t="|a|b|\n|1|2|\n\n|c|d|") == "|a|b|\n| --- | --- |\n|1|2|\n\n|c|d|"
    assert one(spark, f, t="|a|b|\n|---|---|\n|1|2|") == "|a|b|\n|---|---|\n|1|2|"
    assert one(spark, f, t="x | y\nz") == "x | y\n| --- | --- |\nz"


def test_source_rules(spark):
    assert one(spark, markdown.clean_formatting(T()), t="中 文 字 符 ，x  \n\n\n\ny") == "中文 字符，x\n\ny"
    assert one(spark, markdown.annotate_terms(T()), t="联想问天") == "联想问天 (Lenovo WenTian) (WenTian)"
    assert one(spark, markdown.promote_headings(T()), t="第一章 概述\n一、内存\n1、中\ntext") == "# 第一章 概述\n### 一、内存\n## 1、中\ntext"


def test_translation_oddities(spark):
    assert one(spark, translation.substitute_terms(T()), t="联想问天 固态硬盘") == "联想WenTian 固态Drive"
    assert one(spark, translation.post_process(T(), "ru"), t='a.Б "q" (BMC)') == "a. Б «q«  (BMC)"
    assert one(spark, translation.scrub(T()), t="Let me think. <thinking>x\ny</thinking>ok") == " ok"
    r = one(spark, translation.repair_residuals(T(), lambda f: F.when(f == "内存", F.lit("memory"))), t="a 内存 b 存储 内存")
    assert r == "a memory b 存储 memory"


@pytest.mark.parametrize(("message", "category"), [("Connection refused", "network_error"), ("x TIMEOUT", "network_error"), ("Permission denied", "permission_error"), ("?", "general_error")])
def test_errors(spark, message, category):
    assert one(spark, translation.classify_error(T()), t=message).category == category


@pytest.mark.parametrize(
    ("text", "kind"),
    [(" ", "empty"), ("# x", "header"), ("|a|b|c|d|e|f|g|", "complex_table"), ("64 GB", "technical_specs"), ("use IPMITOOL now", "commands"), ("a\nb\nc\nd|e", "mixed"), ("plain", "text"), ("\n".join(["|a|"] * 6), "table")],
)
def test_complexity(spark, text, kind):
    assert one(spark, markdown.complexity(T()), t=text) == kind


def test_scores(spark):
    q = lambda a, b: one(spark, scoring.basic_quality(markdown.features(F.col("a")), markdown.features(F.col("b"))), a=a, b=b)
    assert q("# a\n|x|y|\n中中", "# a\n|x|y|\n中中") == 100
    assert q("# a\n|x|y|\n中中", "a") == 100 - 10 - 15 - 10 - 20
    e = lambda a, b: one(spark, scoring.enhancement_quality(F.col("a"), F.col("b"), markdown.features(F.col("a")), markdown.features(F.col("b"))), a=a, b=b)
    assert e("abc", "abd") == pytest.approx(0.6) and e("abc", "abc") == 0 and e("abc", "") == 0
    v = one(spark, scoring.technical_validation(F.col("a"), F.col("b")), a="问天 64GB", b="x")
    assert (v.score, v.status) == (100 - 20 - 10 - 10, "poor")


def split_words(t):
    return t.split()


def py_merge(chunks, overlap):
    out = chunks[0]
    for c in chunks[1:]:
        cut = 0
        for n in range(min(overlap, len(out), len(c)), 50, -10):
            s, p = split_words(out[-n:]), split_words(c[:n])
            if len(set(s) & set(p)) / max(len(s), 1) > 0.3:
                cut = n
                break
        rest = c[cut:]
        out += ("" if out.endswith("\n\n") or rest.startswith("\n") else "\n\n") + rest
    return out.strip()


def test_chunks_and_merge(spark):
    rng = random.Random(1)
    text = "\n".join(" ".join(rng.choice(("alpha", "beta", "gamma", "delta", "eps")) + str(rng.randrange(99)) for _ in range(12)) for _ in range(120))
    fixed = one(spark, chunking.fixed_chunks(T(), 1000, 200), t=text)
    assert fixed == [text[i : i + 1000] for i in range(0, len(text), 800)]
    assert one(spark, chunking.merge_chunks(chunking.fixed_chunks(T(), 1000, 200), 200), t=text) == py_merge(fixed, 200)
    headed = "\n".join(f"# h{i}\n" + "x y z " * 60 for i in range(9))
    found = one(spark, chunking.header_chunks(T(), 900, 100, 300), t=headed)
    assert all(len(c) >= 300 for c in found) and len(found) >= 8 and found[1].count("# h") >= 1
    assert one(spark, chunking.header_chunks(T()), t="short") == ["short"]


def test_batch_plan(spark):
    plan = one(spark, chunking.batch_plan(T()), t="a\n\nb\nc\r\nd\n# h\n# i")
    # the first batch spans six lines, leaves the blank out, and the next starts five on: a line comes again
    assert [(b.first, b.lines) for b in plan] == [(0, ["a", "b", "c", "d", "# h"]), (5, ["# h", "# i"])]
    fixed = one(spark, chunking.batch_plan(T(), compat=False), t="a\n\nb\nc\r\nd\n# h\n# i")
    assert [b.first for b in fixed] == [0, 6]


def test_table_dedup(spark):
    rows = [(1, 1, 1, "a", 5, 5, 0.9), (1, 1, 2, "b", 6, 5, 0.8), (1, 1, 3, "b", 9, 9, 0.7), (2, 1, 1, "a", 5, 5, 0.5), (2, 1, 2, "a", 5, 5, 0.6)]
    df = spark.createDataFrame(rows, "doc_id int, page int, seq int, engine string, rows int, columns int, quality_score double")
    got = sorted(tuple(r) for r in structure.dedup_tables(df).select("doc_id", "seq", "engine").collect())
    assert got == [(1, 1, "hybrid"), (1, 3, "b"), (2, 1, "a"), (2, 2, "a")]


def test_headings_match_last_exact_and_first_best(spark):
    kind = "doc_id int, pos int, title string, level int"
    a = spark.createDataFrame([(1, 0, "Setup", 1), (1, 1, "Installation", 2), (1, 2, "Gone", 2)], kind)
    b = spark.createDataFrame([(1, 0, "setup", 1), (1, 1, "SETUP", 3), (1, 2, "Installatiom", 2), (1, 3, "Installatiox", 2)], kind)
    got = {r.title: (r.match_type, r.result_title, r.level_match) for r in structure.match_headings(a, b).collect()}
    assert got == {"Setup": ("exact", "SETUP", False), "Installation": ("approximate", "Installatiom", True), "Gone": ("missing", None, False)}


def test_text_similarity(spark):
    a, b = "the quick brown fox", "the quick brown cat"
    want = 0.4 * (1 - 3 / 19) + 0.3 * 3 / 5 + 0.3 * difflib.SequenceMatcher(None, a, b).ratio()
    assert one(spark, similarity.text_similarity(F.col("a"), F.col("b")), a=a, b=b) == pytest.approx(want)
    assert one(spark, similarity.text_similarity(F.col("a"), F.col("b")), a=" ", b=b) == 0


def test_report_profiles(spark):
    rows = [(1, 1, 0.9, ["a"]), (1, 2, None, None), (1, 3, 0.8, ["b", "c"])]
    df = spark.createDataFrame(rows, "doc_id int, level int, score double, issues array<string>")
    dag, service = reports.qa_report(df).first(), reports.qa_report(df, available_only=True).first()
    assert dag.overall_score == pytest.approx(170 / 3) and service.overall_score == pytest.approx(85) and service.quality_passed and not dag.quality_passed
    assert dag.all_issues == ["a", "b", "c"] and dag.level_scores["level_2"] is None


def test_null_and_odd_texts(spark):
    df = spark.createDataFrame([(None,), ("",), ("x",), ("a\r\nb",), ("#　t",)], "t string")
    for f in (markdown.to_plain, markdown.close_fences, markdown.add_separators, markdown.apply_source_rules, markdown.finalize_formatting, chunking.fixed_chunks, markdown.sections, lambda t: translation.translate(t, "ru")):
        assert df.select(f(T()).alias("x")).collect()[0].x in (None, [])
    assert [r.n for r in df.select(markdown.heading_count(T()).alias("n")).collect()] == [None, 0, 0, 0, 1]
