"""Documents between stages: options, recognised lines, tables from extractors, exports, totals and hand-over."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from docflow.functions.rx import strip

OPTIONS = "extract_tables string, extract_images string, use_ocr string, ocr_languages array<string>, output_format string"


def allowed_file(name: Column, extensions: tuple[str, ...] = ("pdf",)) -> Column:
    return F.contains(name, F.lit(".")) & F.lower(F.substring_index(name, ".", -1)).isin(*extensions)


def parsed_options(body: Column) -> Column:
    """Struct of processing options from JSON; words for true are read as such, anything absent or unreadable has its default."""
    o = F.from_json(body, OPTIONS)
    flag = lambda k, default: F.coalesce(F.lower(o[k]).isin("true", "1", "yes", "on"), F.lit(default)).alias(k)
    languages = F.coalesce(o["ocr_languages"], F.array(F.lit("eng"))).alias("ocr_languages")
    return F.struct(flag("extract_tables", True), flag("extract_images", True), flag("use_ocr", False), languages, F.coalesce(o["output_format"], F.lit("markdown")).alias("output_format"))


def kept_lines(lines: DataFrame, least: float = 0.8) -> DataFrame:
    """(doc_id, page, text, confidence, n) of pages from recognised lines (doc_id, page, seq, text, confidence) that are sure enough."""
    sure = F.col("confidence") >= least
    ordered = F.array_sort(F.collect_list(F.when(sure, F.struct("seq", "text"))))
    g = lines.groupBy("doc_id", "page").agg(ordered.alias("l"), F.coalesce(F.avg(F.when(sure, F.col("confidence"))), F.lit(0.5)).alias("confidence"), F.count_if(sure).alias("n"))
    return g.select("doc_id", "page", F.array_join(F.transform("l", lambda x: x["text"]), "\n").alias("text"), "confidence", "n")


def engine_usage(rows: DataFrame) -> DataFrame:
    return rows.groupBy("engine").agg(F.count(F.lit(1)).alias("n"))


def numbered_tables(tables: DataFrame) -> DataFrame:
    """A running id over a document's pages."""
    return tables.withColumn("table_id", F.expr("row_number() over (partition by doc_id order by page, seq)").cast("long"))


def attached_tables(own: DataFrame, extracted: DataFrame) -> DataFrame:
    """A document's own tables and the extractor's, with their source."""
    return own.withColumn("source", F.lit("document")).unionByName(extracted.withColumn("source", F.lit("table_extractor")), allowMissingColumns=True)


def methods_used(docs: DataFrame, extracted: DataFrame) -> DataFrame:
    """``methods`` of each document, with the extractor's name where it found tables."""
    with_tables = extracted.select("doc_id").distinct().withColumn("_found", F.lit(True))
    j = docs.join(with_tables, "doc_id", "left")
    return j.withColumn("methods", F.when(F.col("_found"), F.array_union("methods", F.array(F.lit("table_extractor")))).otherwise(F.col("methods"))).drop("_found")


def document_info(elements: DataFrame) -> DataFrame:
    """(doc_id, pages, blocks, and counts by kind)."""
    kinds = [F.count_if(F.col("kind") == k).alias(f"n_{k}") for k in ("heading", "paragraph", "list", "table")]
    return elements.groupBy("doc_id").agg(F.count_distinct("page").alias("pages"), F.count(F.lit(1)).alias("blocks"), *kinds)


def export_markdown(title: Column, authors: Column, sections: Column, tables: Column) -> Column:
    """Title, authors, sections one level down (six at most), and a stub for each table."""
    head = F.when(strip(F.coalesce(title, F.lit(""))) != "", F.concat(F.lit("# "), title, F.lit("\n")))
    names = F.when(F.size(authors) > 0, F.concat(F.lit("**Authors:** "), F.array_join(authors, ", "), F.lit("\n")))
    section = lambda s: F.concat(F.repeat(F.lit("#"), F.least(s["level"] + 1, F.lit(6))), F.lit(" "), s["title"], F.lit("\n\n"), s["content"], F.lit("\n"))
    stub = lambda t, i: F.concat(F.lit("### Table "), (i + 1).cast("string"), F.lit(" (page "), t["page"].cast("string"), F.lit(")\n"))
    return strip(F.concat_ws("\n", head, names, F.array_join(F.transform(sections, section), "\n"), F.array_join(F.transform(tables, stub), "\n")))


def image_message(role: Column, text: Column) -> Column:
    """A chat message whose content is a list of typed parts."""
    return F.struct(role.alias("role"), F.array(F.struct(F.lit("text").alias("type"), text.alias("text"))).alias("content"))


def batch_totals(runs: DataFrame) -> DataFrame:
    """(processed, failed, seconds, success_pct) of runs (success, seconds)."""
    return runs.agg(F.count(F.lit(1)).alias("processed"), F.count_if(~F.col("success")).alias("failed"), F.sum("seconds").alias("seconds"), (F.try_divide(F.count_if("success"), F.count(F.lit(1))) * 100).alias("success_pct"))


def worth_correcting(issues: Column, most: int = 10) -> Column:
    return (F.size(issues) > 0) & (F.size(issues) <= most)


def final_text(corrected: Column, translated: Column) -> Column:
    return F.coalesce(F.nullif(corrected, F.lit("")), translated)


def stage_text(translation_required: Column, translated: Column, source: Column) -> Column:
    """What the last stage reads: the translation if there is to be one."""
    return F.when(translation_required, translated).otherwise(source)


def summary(name: Column, passed: Column, score: Column, issues: Column) -> Column:
    """One line on a finished document."""
    return F.format_string("%s: %s, score %.1f, %d issues", name, F.when(passed, "passed").otherwise("failed"), score, F.size(issues))
