"""Queries over documents between stages."""

from __future__ import annotations

from pyspark.sql import functions as F

from docflow.functions import markdown
from docflow.operators import documents
from docflow.plans import duck
from docflow.plans.registry import query
from docflow.plans.structure_queries import CLASSIFIED, _elements
from docflow.plans.text_queries import SECTIONS
from docflow.sources.md_docs import md_docs


def _t(spark, sf_dir, name):
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


OPTIONS = "CASE event_id % 4 WHEN 0 THEN '{\"use_ocr\": \"Yes\", \"extract_tables\": \"false\"}' WHEN 1 THEN '{\"output_format\": \"json\"}' WHEN 2 THEN 'no json' ELSE '{}' END"


@query("SELECT event_id, event_id % 4 <> 0 AS extract_tables, event_id % 4 = 0 AS use_ocr, CASE WHEN event_id % 4 = 1 THEN 'json' ELSE 'markdown' END AS output_format FROM events")
def parse_options(spark, sf_dir):
    e = _t(spark, sf_dir, "events").select("event_id", documents.parsed_options(F.expr(OPTIONS.replace('\\"', '"'))).alias("o"))
    return e.select("event_id", "o.extract_tables", "o.use_ocr", "o.output_format")


OCR_LINES = "SELECT user_id AS doc_id, event_id % 3 AS page, event_id AS seq, event_type AS text, value / 200 AS confidence FROM events"


@query(f"SELECT doc_id, page, coalesce(string_agg(text, chr(10) ORDER BY seq) FILTER (WHERE confidence >= 0.8), '') AS text, round(coalesce(avg(confidence) FILTER (WHERE confidence >= 0.8), 0.5), 6) AS confidence, count_if(confidence >= 0.8)::bigint AS n FROM ({OCR_LINES}) GROUP BY doc_id, page")
def ocr_lines(spark, sf_dir):
    _t(spark, sf_dir, "events").createOrReplaceTempView("docflow_events")
    lines = spark.sql(OCR_LINES.replace("FROM events", "FROM docflow_events"))
    return documents.kept_lines(lines).withColumn("confidence", F.round("confidence", 6))


@query("SELECT CASE WHEN p_partkey % 2 = 0 THEN 'lattice' ELSE 'stream' END AS engine, count(*)::bigint AS n FROM part GROUP BY ALL")
def engine_usage(spark, sf_dir):
    return documents.engine_usage(_t(spark, sf_dir, "part").select(F.when(F.col("p_partkey") % 2 == 0, "lattice").otherwise("stream").alias("engine")))


@query("SELECT p_partkey % 30 AS doc_id, p_size % 5 AS page, p_partkey AS seq, row_number() OVER (PARTITION BY p_partkey % 30 ORDER BY p_size % 5, p_partkey) AS table_id, CASE WHEN p_partkey % 2 = 0 THEN 'document' ELSE 'table_extractor' END AS source FROM part")
def attached_tables(spark, sf_dir):
    p = _t(spark, sf_dir, "part").selectExpr("p_partkey % 30 AS doc_id", "p_size % 5 AS page", "p_partkey AS seq")
    return documents.numbered_tables(documents.attached_tables(p.where("seq % 2 = 0"), p.where("seq % 2 <> 0")))


@query(f"WITH {CLASSIFIED} SELECT doc_id, count(DISTINCT page)::bigint AS pages, count(*)::bigint AS blocks, count_if(kind = 'heading')::bigint AS n_heading, count_if(kind = 'paragraph')::bigint AS n_paragraph, count_if(kind = 'list')::bigint AS n_list, count_if(kind = 'table')::bigint AS n_table FROM c GROUP BY doc_id")
def document_info(spark, sf_dir):
    return documents.document_info(_elements(spark, sf_dir))


BODY = "string_agg(repeat('#', least(level + 1, 6)::bigint) || ' ' || title || chr(10) || chr(10) || content || chr(10), chr(10) ORDER BY id)"


EXPORTED = duck.strip("'# D' || doc_id || chr(10) || chr(10) || '**Authors:** a, b' || chr(10) || chr(10) || " + BODY + " || chr(10) || '### Table 1 (page 1)' || chr(10)")


@query(duck.over_md(f"doc_id, {EXPORTED} AS result", SECTIONS, "sections GROUP BY doc_id"))
def export_markdown(spark, sf_dir):
    title = F.concat(F.lit("D"), F.col("doc_id").cast("string"))
    authors, tables = F.array(F.lit("a"), F.lit("b")), F.array(F.struct(F.lit(1).alias("page")))
    return md_docs(spark, sf_dir).select("doc_id", documents.export_markdown(title, authors, markdown.sections(F.col("md")), tables).alias("result"))


@query("SELECT count(*)::bigint AS processed, count_if(event_type = 'error')::bigint AS failed, round(sum(value / 20), 4) AS seconds, round(count_if(event_type <> 'error')::double / count(*) * 100, 6) AS success_pct FROM events")
def batch_totals(spark, sf_dir):
    from docflow.operators.metrics import telemetry

    r = documents.batch_totals(telemetry(_t(spark, sf_dir, "events")))
    return r.withColumn("seconds", F.round("seconds", 4)).withColumn("success_pct", F.round("success_pct", 6))


@query("SELECT doc_id, CASE WHEN doc_id % 3 = 0 THEN text WHEN doc_id % 3 = 1 THEN 'translated' ELSE lang END AS result, doc_id % 12 BETWEEN 1 AND 10 AS correct, ends_with(lower(source || '.PDF'), '.pdf') AS allowed FROM documents")
def stage_handover(spark, sf_dir):
    """What a last stage reads, whether correction is tried, and whether the file's name is allowed."""
    d = _t(spark, sf_dir, "documents")
    i = F.col("doc_id") % 3
    text = documents.final_text(F.when(i == 0, F.col("text")).otherwise(""), documents.stage_text(i == 1, F.lit("translated"), F.col("lang")))
    issues = F.slice(F.array(*map(F.lit, range(12))), F.lit(1), (F.col("doc_id") % 12).cast("int"))
    return d.select("doc_id", text.alias("result"), documents.worth_correcting(issues).alias("correct"), documents.allowed_file(F.concat("source", F.lit(".PDF"))).alias("allowed"))
