"""Flows with a model, the levels that need one, table functions, and folds whose time must follow their length."""

import hashlib
import time

import pytest
from pyspark.sql import functions as F

from docflow.functions import lexicon, markdown, translation, udfs
from docflow.operators import adapters, chunking, flows, reports, structure


class Upper:
    """Raises capitals; answers several lines that hold a z with one line; fails on a q."""

    def __call__(self, prompt):
        text = prompt.split("<|im_start|>user\n")[-1].split("<|im_end|>")[0].split("\n\nDocument:\n")[-1]
        if "q" in text:
            raise OSError("busy")
        return text.upper().replace("\n", " / ") if "z" in text and "\n" in text else text.upper()


def batches(text):
    """(first line, its lines) as the rule has it; a blank line that is reached comes alone."""
    sizes = dict(lexicon.BATCH_SIZES)
    rows, i = text.replace("\r\n", "\n").replace("\r", "\n").split("\n"), 0
    while i < len(rows):
        if not rows[i].strip():
            yield i, [rows[i]]
            i += 1
            continue
        taken = [x for x in rows[i : i + sizes.get("text", 6)] if x.strip()]
        yield i, taken
        i += len(taken)


def translated(text, ask):
    out = []
    for _, part in batches(text):
        if not part[0].strip():
            out += part
            continue
        whole = ask("\n".join(part)).split("\n")
        out += whole if len(whole) == len(part) else [ask(x) for x in part]
    return "\n".join(out)


def test_lines_are_translated_in_batches_and_alone_where_counts_differ(spark):
    texts = ["one\ntwo\n\nthree", "a z\nb\nc", "", "\n\n", "fine\nq here\nlast", "x\r\ny\rz w", None]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id int, text string")

    def ask(t):
        try:
            return Upper()(t.strip()) if t.strip() else t
        except OSError:
            return t

    got = {r.doc_id: r.translated for r in flows.translate_lines(df, Upper, target="en").collect()}
    assert got == {i: translated(t, ask) for i, t in enumerate(texts) if t is not None}


def test_single_translation_keeps_blank_and_failed_texts(spark):
    df = spark.createDataFrame([(1, "ab"), (2, "  "), (3, "q"), (4, None), (5, "ab")], "doc_id int, text string")
    rows = {r.doc_id: r.translated for r in flows.translate_single(df, Upper, "zh-CN", "en").collect()}
    assert rows == {1: "AB", 2: "  ", 3: "q", 4: None, 5: "AB"}


def test_auto_correction(spark):
    long = "ipmi server text of a certain length " * 3
    rows = [(1, long, ["a"]), (2, long, []), (3, long, [str(i) for i in range(11)]), (4, "q", ["a"]), (5, long, None)]
    df = spark.createDataFrame(rows, "doc_id int, text string, issues array<string>")
    got = {r.doc_id: r for r in flows.auto_correct(df, Upper).collect()}
    assert got[1].corrections == 1 and got[1].corrected == long.strip().upper() and got[1].score == got[1].confidence >= 0.7
    assert got[2].corrections == 0 and got[2].score == 1.0 and got[2].issues == [] and got[5].corrected == long
    assert got[3].issues == ["too many issues"] and got[4].issues == ["correction confidence is low"] and got[4].corrected == "q"
    report = spark.createDataFrame([(i, i < 3) for i in range(1, 6)], "doc_id int, quality_passed boolean")
    end = {r.doc_id: r for r in flows.finished(df, report, flows.auto_correct(df, Upper)).collect()}
    assert end[1].corrected and end[1].final_text == long.strip().upper() and end[1].pipeline_ready and not end[4].corrected and end[3].final_text == long
    assert not flows.finished(df, report).where("corrected").count()
    assert {r.level for r in flows.correction_level(flows.auto_correct(df, Upper)).collect()} == {5}


def test_corrections_apply_in_order(spark):
    df = spark.createDataFrame([(1, "just plain words about a table of ipmi and bmc"), (2, "# fine\n\n| a | b |\n")], "doc_id int, text string")
    none = F.array().cast("array<string>")
    plan = reports.planned_corrections(F.col("text"), F.lit(0.9), none, F.lit(1.0), none)

    class Mark:
        def __call__(self, prompt):
            return prompt.split("only.\n\n")[-1] + " " + prompt[5:12]

    got = {r.doc_id: r for r in flows.apply_corrections(df.withColumn("plan", plan), Mark).collect()}
    entries = {r.doc_id: r.p for r in df.select("doc_id", plan.alias("p")).collect()}
    for i, r in got.items():
        sure = [e for e in entries[i] if e.applied]
        assert (r.planned, r.applied, r.failed) == (len(entries[i]), len(sure), len(entries[i]) - len(sure))
    assert got[1].corrected.startswith("just plain words") and got[1].corrected.count("Markdown") + got[1].corrected.count("technic") >= 0
    assert flows.apply_corrections(df.withColumn("plan", F.slice(plan, 1, 0)), Mark).where("corrected is not null").count() == 0


def test_visual_level_rounds_half_to_even(spark):
    s = spark.createDataFrame([(1, 0.99, 2, 0, 0, 0, 0), (2, 0.99, 3, 0, 0, 0, 0), (3, 0.9, 0, 0, 0, 1, 0)], "doc_id int, similarity double, n_added int, n_removed int, n_changed int, n_high int, n_critical int")
    pages = spark.createDataFrame([(1, 25), (2, 25), (3, 1)], "doc_id int, pages int")
    got = {r.doc_id: r.issues for r in flows.visual_level(s, pages).collect()}
    assert got == {1: [], 2: ["too many differences"], 3: ["low visual likeness", "severe differences"]}


def test_small_rules(spark):
    df = spark.createDataFrame([("- a\n\n•  b\n12. c\n*", None)], "t string, n string")
    r = df.select(flows.list_items(F.col("t")).alias("items"), flows.structure_quality(F.col("t")).alias("q"), flows.structure_quality(F.col("n")).alias("z"), flows.stub_text(F.col("n"), F.lit(3), F.lit("x")).alias("s")).first()
    assert r["items"] == ["a", "b", "2. c"] and r.q.structure == 0.9 and r.z.structure == 0.0 and "Pages: 3" in r.s


def test_meaning_of_headings(spark):
    a = spark.createDataFrame([(1, 1, "Server memory"), (2, 1, "x"), (3, 1, "alone")], "doc_id int, level int, title string")
    b = spark.createDataFrame([(1, 1, "memory SERVER"), (2, 1, "y"), (4, 1, "other")], "doc_id int, level int, title string")
    got = {r.doc_id: r.semantic for r in structure.semantic_similarity(a, b).collect()}

    def vector(t):
        v = [0] * structure.DIMENSIONS
        for w in t.lower().split():
            h = hashlib.md5(w.encode()).hexdigest()
            v[int(h[:2], 16) % structure.DIMENSIONS] += 1 if h[2] >= "8" else -1
        return v

    x, y = vector("x"), vector("y")
    assert got[1] == pytest.approx(1.0) and got[2] == max(0.0, sum(i * j for i, j in zip(x, y, strict=True))) and got[3] == 0.0 == got[4]


def test_table_functions(spark):
    udfs.register(spark)
    text = "intro\\n# A\\nx\\n#\\ny"
    got = spark.sql(f"select * from md_sections('{text}')").collect()
    want = spark.createDataFrame([(text.replace("\\n", "\n"),)], "t string").select(F.inline(markdown.sections(F.col("t")))).collect()
    assert [(r.id, r.title, r.level, r.content) for r in got] == [(r.id, r.title, r.level, r.content) for r in want]
    assert spark.sql("select text_similarity('a b', 'a b') as s").first().s == pytest.approx(1.0)
    assert spark.sql("select text_similarity('', 'a b') as s").first().s == 0.0


LINES = "# h\n| a | b |\n| c | d |\ntext\n\n"
FOLDS = {
    "sections": lambda n: markdown.sections(F.repeat(F.lit(LINES), n // 5)),
    "add_separators": lambda n: markdown.add_separators(F.repeat(F.lit(LINES), n // 5)),
    "space_tables": lambda n: markdown.space_tables(F.repeat(F.lit(LINES), n // 5)),
    "batch_plan": lambda n: chunking.batch_plan(F.repeat(F.lit(LINES), n // 5)),
    "merge_chunks": lambda n: chunking.merge_chunks(F.transform(F.sequence(F.lit(1), F.lit(n)), lambda i: F.concat(F.lit("piece "), i.cast("string")))),
}


@pytest.mark.parametrize("name", FOLDS)
def test_time_follows_the_number_of_lines(spark, name):
    def seconds(n):
        began = time.perf_counter()
        spark.range(1).withColumn("n", F.col("id")).select(F.length(FOLDS[name](n).cast("string")).alias("x")).where("x > 0").count()
        spark.range(1).select(F.max(F.hash(FOLDS[name](n)))).collect()
        return time.perf_counter() - began

    seconds(1000)
    few, many = min(seconds(20_000), seconds(20_000)), min(seconds(40_000), seconds(40_000))
    assert many < 2.5 * few + 0.5


def test_small_columns(spark):
    df = spark.createDataFrame([('{"choices": [{"message": {"content": " hi "}}], "usage": {"prompt_tokens": 2, "completion_tokens": 3}}',)], "b string")
    r = df.select(translation.parse_response(F.col("b")).alias("r")).first().r
    assert (r.content, r.total_tokens) == ("hi", 5)
    results = spark.createDataFrame([(1, 1, "ab"), (1, 2, "ab"), (1, 3, "cd")], "doc_id int, ord int, text string")
    same = lambda a, b: F.when(a == b, 1.0).otherwise(0.0)
    assert reports.pair_similarities(results, same).first().similarity == pytest.approx(1 / 3)
    assert adapters.EchoModel()("x") == "x"
