"""The document pipeline as one plan: normalise, apply rules, enhance, gate, translate, score, report."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from docflow.config import Pipeline
from docflow.functions import markdown, scoring, translation
from docflow.operators import adapters, chunking, flows, images, reports, structure, vectors
from docflow.runtime import checkpointed


def basic(docs: DataFrame) -> DataFrame:
    """(doc_id, md) with ``basic`` text and its score."""
    text = markdown.finalize_formatting(markdown.apply_source_rules(F.col("md")))
    d = docs.withColumn("basic", text).withColumn("_o", markdown.features(F.col("md"))).withColumn("_n", markdown.features(F.col("basic")))
    return d.withColumn("basic_quality", scoring.basic_quality(F.col("_o"), F.col("_n"))).drop("_o", "_n")


def enhanced(docs: DataFrame, make: Callable[[], adapters.TextModel], config: Pipeline) -> DataFrame:
    """Pieces of documents that passed the first gate go to a model; the answer is taken if it is good enough."""
    c = config.chunking
    pieces = docs.where(F.col("basic_quality") >= config.gates.basic).select("doc_id", F.posexplode(chunking.header_chunks(F.col("basic"), c.longest, c.overlap, c.shortest)).alias("pos", "prompt"))
    answers = adapters.with_answers(pieces, adapters.answered(pieces, make, attempts=config.attempts))
    kept = answers.withColumn("piece", F.coalesce("answer.text", "prompt"))
    merged = kept.groupBy("doc_id").agg(F.array_sort(F.collect_list(F.struct("pos", "piece"))).alias("p"), F.count_if(~F.col("answer.ok")).alias("failed"), F.count(F.lit(1)).alias("n"))
    text = chunking.merge_chunks(F.transform("p", lambda x: x["piece"]), c.overlap)
    within = F.col("failed") <= F.greatest(F.lit(1), F.floor(F.col("n") / 2))
    merged = merged.select("doc_id", F.when(within, text).alias("model_text"))
    d = docs.join(merged, "doc_id", "left")
    quality = scoring.enhancement_quality(F.col("basic"), F.col("model_text"), markdown.features(F.col("basic")), markdown.features(F.col("model_text")))
    d = d.withColumn("enhancement", F.when(F.col("model_text").isNotNull(), quality).otherwise(0.0))
    used = F.col("enhancement") >= config.gates.enhancement
    return d.withColumn("enhanced", used).withColumn("final", markdown.close_fences(F.when(used, F.col("model_text")).otherwise(F.col("basic")))).drop("model_text")


def gated(docs: DataFrame, config: Pipeline) -> DataFrame:
    q = scoring.final_quality(F.col("basic_quality"), F.col("enhanced"), F.col("enhancement"), F.length("md"), F.length("final"))
    return docs.withColumn("final_quality", q).withColumn("ready", F.col("final_quality") >= config.gates.final)


def translated(docs: DataFrame, language: str) -> DataFrame:
    """Documents that are ready in the target language; originals keep their text."""
    if language in ("original", "zh", "zh-CN"):
        return docs.withColumn("translated", F.col("final"))
    return docs.withColumn("translated", F.when(F.col("ready"), translation.translate(F.col("final"), language)).otherwise(F.col("final")))


def level_rows(docs: DataFrame, coherence: DataFrame | None = None) -> DataFrame:
    """(doc_id, level, score, issues) of the levels that texts alone decide; ``coherence`` (doc_id, semantic) takes the place of the rule for meaning."""
    t = F.col("translated")
    d = docs.withColumn("_f", markdown.features(t))
    meaning = scoring.semantic_fallback(t)
    if coherence is not None:
        d, meaning = d.join(coherence, "doc_id", "left"), F.coalesce("semantic", meaning)
    checks = scoring.level4(t, F.col("_f"))
    l4 = sum(checks[1:], checks[0]) / len(checks)
    l3 = (scoring.structure_score(t, F.col("_f")) + meaning) / 2
    none = F.array().cast("array<string>")
    entry = lambda n, s: F.struct(F.lit(n).alias("level"), s.alias("score"), F.when(s < 0.8, F.array(F.lit(f"level {n} is low"))).otherwise(none).alias("issues"))
    return d.select("doc_id", F.inline(F.array(entry(1, scoring.ocr_proxy_consensus(t)), entry(3, l3), entry(4, l4))))


def all_levels(docs: DataFrame, make: Callable[..., adapters.TextModel], config: Pipeline, pages: DataFrame | None = None) -> tuple[DataFrame, DataFrame]:
    """(level rows, corrections): levels 1, 3 and 4, level 2 where there are page images, and level 5, which sees their issues.

    ``pages`` are those of ``images.page_differences``: (doc_id, page, before, before_width, after, after_width).
    """
    coherence = None
    if config.trained_meaning:
        coherence = vectors.section_coherence(docs, vectors.section_words(docs, "translated"), "translated")
    rows = level_rows(docs, coherence)
    if pages is not None:
        likeness = pages.select("doc_id", images.ssim("before", "after", "before_width", "after_width").alias("ssim"))
        seen = structure.visual_summary(images.page_differences(pages), likeness)
        rows = rows.unionByName(flows.visual_level(seen, pages.groupBy("doc_id").agg(F.countDistinct("page").alias("pages"))))
    issues = rows.groupBy("doc_id").agg(F.flatten(F.transform(F.array_sort(F.collect_list(F.struct("level", "issues"))), lambda x: x["issues"])).alias("issues"))
    told = docs.select("doc_id", F.col("translated").alias("text")).join(issues, "doc_id")
    corrected = checkpointed(flows.auto_correct(told, make, config.attempts))
    return rows.unionByName(flows.correction_level(corrected)), corrected


def run(docs: DataFrame, config: Pipeline | None = None, make: Callable[[], adapters.TextModel] = adapters.EchoModel, pages: DataFrame | None = None) -> tuple[DataFrame, DataFrame]:
    """(documents, reports) of (doc_id, md) rows, both lazy but for ``config.correct``.

    With it, reports have all five levels (the second where ``pages`` are given), and documents ``final_text``,
    ``pipeline_ready`` and ``corrected``; without it, the levels that texts alone decide.
    """
    config = config or Pipeline()
    done = translated(gated(enhanced(basic(docs), make, config), config), config.language)
    if not config.correct:
        return done, reports.qa_report(level_rows(done), available_only=True, gate=config.gates.overall)
    done = checkpointed(done)  # what follows reads it several times, and models are asked once
    rows, corrected = all_levels(done, make, config, pages)
    report = reports.qa_report(rows, available_only=True, gate=config.gates.overall)
    ends = flows.finished(done.select("doc_id", F.col("translated").alias("text")), report, corrected)
    return done.join(ends, "doc_id"), report
