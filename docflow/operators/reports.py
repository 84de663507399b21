"""Quality reports over level scores, consensus of text recognition engines, and the correction plan."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from docflow.functions.rx import ML, count

#: Gate of the overall score, and the number of issues from which automatic correction is not tried.
GATE, MOST_ISSUES, LEAST_CONFIDENCE, MOST_CORRECTIONS = 0.85, 10, 0.7, 10


def qa_report(levels: DataFrame, available_only: bool = False, gate: float = GATE) -> DataFrame:
    """(doc_id, overall_score, quality_passed, level_scores, all_issues) from (doc_id, level, score, issues).

    Missing scores count as 0, or not at all with ``available_only``.
    """
    score = F.col("score") if available_only else F.coalesce("score", F.lit(0.0))
    ordered = F.array_sort(F.collect_list(F.struct("level", "score", "issues")))
    out = levels.groupBy("doc_id").agg(F.coalesce(F.avg(score), F.lit(0.0)).alias("mean"), ordered.alias("all"))
    return out.select(
        "doc_id",
        (F.col("mean") * 100).alias("overall_score"),
        (F.col("mean") >= gate).alias("quality_passed"),
        F.map_from_entries(F.transform("all", lambda x: F.struct(F.concat(F.lit("level_"), x["level"].cast("string")), x["score"]))).alias("level_scores"),
        F.flatten(F.transform("all", lambda x: F.coalesce(x["issues"], F.array().cast("array<string>")))).alias("all_issues"),
    )


def pair_similarities(results: DataFrame, similarity) -> DataFrame:
    """(doc_id, similarity): the mean over pairs of a document's engines of ``similarity(text, text)``."""
    a, b = results.select("doc_id", "ord", "text"), results.select("doc_id", F.col("ord").alias("ord2"), F.col("text").alias("text2"))
    pairs = a.join(b, "doc_id").where("ord < ord2")
    return pairs.groupBy("doc_id").agg(F.avg(similarity(F.col("text"), F.col("text2"))).alias("similarity"))


def ocr_consensus(results: DataFrame, similarities: DataFrame, expected: str = "zh-CN", least: float = 0.8) -> DataFrame:
    """(doc_id, engine, confidence, score): the most confident engine, less for disagreement, language and length.

    ``results`` has doc_id, ord, engine, text, confidence, language, word_count. One engine alone scores its own confidence.
    """
    best = F.max_by(F.struct("engine", "confidence"), F.struct("confidence", -F.col("ord"))).alias("best")
    language = F.collect_list(F.when(F.col("language") != "unknown", F.col("language"))).alias("languages")
    g = results.groupBy("doc_id").agg(best, F.count(F.lit(1)).alias("n"), language, F.max("word_count").alias("most"), F.min("word_count").alias("fewest"))
    j = g.join(similarities, "doc_id", "left")
    base = F.col("best.confidence")
    sim = F.col("similarity")
    other = (F.size("languages") > 0) & ~F.exists("languages", lambda x: x == expected[:2])
    c = F.when(sim < least, base * sim).otherwise(base) * F.when(other, 0.9).otherwise(1.0) * F.when(F.try_divide(F.col("most"), F.col("fewest")) > 2, 0.95).otherwise(1.0)
    alone = F.col("n") == 1
    return j.select("doc_id", F.col("best.engine").alias("engine"), F.when(alone, base).otherwise(c).alias("confidence"), F.when(alone, base).otherwise(c * sim).alias("score"))


def planned_corrections(text: Column, ocr_confidence: Column, ocr_issues: Column, likeness: Column, tree_issues: Column) -> Column:
    """Array of (type, description, confidence, applied): at most one of recognition, two of structure, one of translation, two of format."""
    entry = lambda t, d, c: F.struct(F.lit(t).alias("type"), F.lit(d).alias("description"), F.lit(c).alias("confidence"), F.lit(c >= LEAST_CONFIDENCE).alias("applied"))
    low = F.lower(text)
    has = lambda x, w: F.contains(F.lower(x), F.lit(w))
    ocr = F.when((ocr_confidence < 0.8) & F.exists(ocr_issues, lambda x: has(x, "similarity")), F.array(entry("ocr", "recognition differs", 0.8)))
    heading = lambda x: has(x, "heading") & has(x, "missing")
    structural = F.transform(F.filter(tree_issues, lambda x: heading(x) | has(x, "level")), lambda x: F.when(heading(x), entry("structure", "missing headings", 0.7)).otherwise(entry("structure", "heading levels", 0.8)))
    structure = F.when(likeness < 0.9, F.slice(structural, 1, 2))
    words = count(text, "[A-Z]{2,}[A-Za-z0-9_-]*", "") < 5
    commands = ~F.contains(low, F.lit("ipmi")) & ~F.contains(low, F.lit("bmc"))
    translation = F.when(words, F.array(entry("translation", "technical terms", 0.6))).when(commands, F.array(entry("translation", "commands", 0.7)))
    formats = (
        F.when(~text.rlike(rf"{ML}^#{{1,6}}\s+.+$"), entry("formatting", "no headings", 0.9)),
        F.when(~F.contains(text, F.lit("|")) & F.contains(low, F.lit("table")), entry("formatting", "tables", 0.9)),
        F.when(F.contains(low, F.lit("ipmi")) & ~F.contains(text, F.lit("```")), entry("formatting", "code blocks", 0.9)),
    )
    kinds = [F.coalesce(x, F.array().cast("array<struct<type:string,description:string,confidence:double,applied:boolean>>")) for x in (ocr, structure, translation)]
    return F.slice(F.concat(*kinds, F.slice(F.array_compact(F.array(*formats)), 1, 2)), 1, MOST_CORRECTIONS)
