"""Adapters, the document pipeline, files and streams."""

import pytest
from pyspark.sql import functions as F

from docflow.config import Pipeline, Processing
from docflow.functions import udfs
from docflow.operators import adapters, metrics
from docflow.plans import pipeline
from docflow.sources import files
from docflow.sources.md_docs import md_docs
from docflow.streaming import live


class Flaky:
    """Fails on every prompt with an x, answers nothing on an empty one."""

    def __call__(self, prompt):
        if "x" in prompt:
            raise OSError("busy")
        return prompt.upper()


def test_answers_are_asked_once_and_failures_are_rows(spark):
    df = spark.createDataFrame([(1, "a"), (1, "a"), (1, "x"), (2, "")], "doc_id int, prompt string")
    answers = adapters.answered(df, Flaky)
    got = {r.prompt: r.answer for r in adapters.with_answers(df, answers).collect()}
    assert answers.count() == 3
    assert got["a"].text == "A" and not got["x"].ok and "busy" in got["x"].error and got["x"].attempts == 3 and got[""].error == "empty answer"
    assert adapters.unanswered(df, answers).count() == 0
    budget = {r.doc_id: r.within_budget for r in adapters.within_budget(adapters.with_answers(df, answers), "doc_id").collect()}
    assert budget == {1: True, 2: True}


def test_extraction_falls_back(spark):
    df = spark.createDataFrame([("p1", bytearray(b"# T\nx")), ("p2", bytearray(b""))], "path string, content binary")

    class Ocr:
        def __call__(self, content):
            return {"title": "scan", "markdown_content": "scanned", "raw_text": "scanned"}

    got = {r.path: r.markdown_content for r in adapters.extracted_with_fallback(df, adapters.TextExtractor, Ocr).collect()}
    assert got == {"p1": "# T\nx", "p2": "scanned"}


def test_document_pipeline(spark, sf):
    docs = md_docs(spark, sf).limit(40)
    done, report = pipeline.run(docs, Pipeline(language="en"))
    rows = done.select("doc_id", "final_quality", "ready", "translated").collect()
    assert len(rows) == 40 and all(0 <= r.final_quality <= 100 for r in rows) and report.count() == 40
    original, _ = pipeline.run(docs, Pipeline(language="zh"))
    assert original.where("translated <> final").count() == 0


def test_settings():
    with pytest.raises(ValueError, match="ocr_languages"):
        Processing(ocr_languages=("xx",))


def test_files(spark, tmp_path):
    (tmp_path / "a").mkdir()
    (tmp_path / "a" / "x.pdf").write_bytes(b"%PDF-1.7 body")
    (tmp_path / "y.pdf").write_bytes(b"nope")
    got = {r.path.rsplit("/", 1)[1]: (r.reason, r.status) for r in files.validated(files.pdf_files(spark, str(tmp_path))).collect()}
    assert got == {"x.pdf": (None, 200), "y.pdf": ("not a PDF", 400)}
    hollow = spark.createDataFrame([("z.pdf", 0, bytearray(b"")), ("z.txt", 4, bytearray(b"%PDF")), ("z.pdf", files.LARGEST + 1, bytearray(b"%PDF"))], "path string, length long, content binary")
    assert [(r.reason, r.status) for r in files.validated(hollow).collect()] == [("empty", 400), ("extension", 400), ("too large", 413)]
    (tmp_path / "d.json").write_text('{"title": "t", "markdown_content": "", "raw_text": "raw", "sections": [{"id": 0, "title": "s"}]}')
    d = files.normalised(files.read_intermediate(spark, str(tmp_path / "d.json"))).first()
    assert d.markdown_content == "raw" and d.reason is None
    out = str(tmp_path / "md")
    files.write_markdown(spark.createDataFrame([("ru", "x"), ("en", "y")], "target_language string, markdown string"), out)
    assert spark.read.text(out).count() == 2


def test_sql_functions(spark):
    udfs.register(spark)
    assert spark.sql("select line from md_lines('a\nb') where pos = 1").first().line == "b"
    assert spark.sql("select count(*) as n from chunks('abcdefgh', 4, 2)").first().n == 4
    assert spark.sql("select seq_ratio('abcd', 'bcde') as r").first().r == pytest.approx(0.75)


def test_stream_equals_batch(spark, sf, tmp_path):
    src = str(tmp_path / "in")
    spark.read.parquet(f"{sf}/events.parquet").repartition(3).write.parquet(src)
    rows = live.read_events(spark, src)
    q = live.success_rate(rows, late="3650 days").writeStream.format("memory").queryName("rates").outputMode("complete").trigger(availableNow=True).start()
    q.awaitTermination(120)
    batch = metrics.success_rate(metrics.telemetry(spark.read.parquet(f"{sf}/events.parquet")), "5 minutes", "1 minute")
    got = {(r.window_start, round(r.success_pct, 9)) for r in spark.sql("select cast(window_start as timestamp_ntz) window_start, success_pct from rates").collect()}
    assert got == {(r.window_start, round(r.success_pct, 9)) for r in batch.collect()}


def test_answer_cache_stream(spark, tmp_path):
    src = str(tmp_path / "prompts")
    spark.createDataFrame([("k", "p"), ("k", "p"), ("m", "q")], "key string, prompt string").coalesce(1).write.parquet(src)
    stream = live.cached_answers(spark.readStream.schema("key string, prompt string").parquet(src), lambda p: p.upper())
    q = stream.writeStream.format("memory").queryName("answers").outputMode("append").trigger(availableNow=True).start()
    q.awaitTermination(120)
    got = sorted((r.key, r.text, r.cached) for r in spark.table("answers").collect())
    assert got == [("k", "P", False), ("k", "P", True), ("m", "Q", False)]


def test_library_does_not_import_the_other_subpackage():
    import pathlib
    import re

    root = pathlib.Path(__file__).parents[1] / "docflow"
    for path in root.rglob("*.py"):
        if "llm" not in path.relative_to(root).parts:
            assert not re.search(r"docflow\.llm|from docflow import llm", path.read_text()), path


def test_metric_names(spark):
    df = spark.createDataFrame([("pdf_converter_x",), ("task.a.processing_time",)], "n string")
    assert [r.x for r in df.select(metrics.relabelled(F.col("n")).alias("x")).collect()] == ["pdfconv_x", "task.a.processing_time"]


def test_readers_of_files_and_retry(spark):
    df = spark.createDataFrame([("p1", bytearray(b"ab")), ("p2", bytearray(b"!"))], "path string, content binary")

    def rich():
        def read(content):
            if content == b"!":
                raise ValueError("TableData")
            return [(i, len(content), None, bytes([b])) for i, b in enumerate(content)]

        return read

    rows = adapters.with_retry(df, rich, lambda: lambda content: [(0, 1, 1, b"")], adapters.PAGE_IMAGES).collect()
    assert sorted((r.path, r.page, r.width) for r in rows) == [("p1", 0, 2), ("p1", 1, 2), ("p2", 0, 1)]
    assert adapters.per_file(df, rich, adapters.PAGE_IMAGES).where("error like '%TableData%'").count() == 1


def test_sinks_get_every_batch(spark, sf, tmp_path):
    src, seen = str(tmp_path / "in"), []
    spark.read.parquet(f"{sf}/events.parquet").repartition(2).write.parquet(src)
    table = str(tmp_path / "out")
    q = live.to_sinks(live.read_events(spark, src), str(tmp_path / "cp"), lambda b, n: b.write.mode("append").parquet(table), lambda b, n: seen.append(b.count()))
    q.awaitTermination(120)
    assert sum(seen) == spark.read.parquet(table).count() == spark.read.parquet(src).count()
