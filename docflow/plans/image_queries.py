"""Queries over page images. A document's UTF-8 bytes, row by row, stand for the grey pixels of its pages."""

from __future__ import annotations

from pyspark.sql import functions as F

from docflow.operators import images, structure
from docflow.plans.registry import query

WIDTH, HEIGHT = 80, 60


def page_pairs(docs):
    """(doc_id, page, before, before_width, after, after_width): pages of each text, and of the text with its third quarter
    overwritten; short last pages are padded with white. Every fifth document's later pages are two columns narrower."""
    size, white = WIDTH * HEIGHT, F.expr("unhex('FF')")
    raw = F.coalesce(F.col("text"), F.lit("")).cast("binary")
    n = F.length(raw)
    lower = F.floor(n / 2).cast("int")
    both = docs.select("doc_id", raw.alias("raw"), F.concat(F.substring(raw, F.lit(1), lower), F.expr("repeat('~', int(octet_length(coalesce(text, '')) / 4))").cast("binary"), F.substring(raw, lower + F.floor(n / 4).cast("int") + 1, n)).alias("new"))
    paged = both.select("doc_id", "raw", "new", F.explode(F.sequence(F.lit(0), F.floor(F.greatest(F.length("raw") - 1, F.lit(0)) / size).cast("int"))).alias("page"))
    cut = lambda c, w: F.rpad(F.substring(F.col(c), F.col("page") * size + 1, F.lit(w * HEIGHT)), F.lit(w * HEIGHT), white)
    narrow = F.col("doc_id") % 5 == 0
    return paged.select("doc_id", "page", cut("raw", WIDTH).alias("before"), F.lit(WIDTH).alias("before_width"), F.when(narrow, cut("new", WIDTH - 2)).otherwise(cut("new", WIDTH)).alias("after"), F.when(narrow, WIDTH - 2).otherwise(WIDTH).alias("after_width"))


def _pages(spark, sf_dir):
    return page_pairs(spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text"))


@query()
def page_regions(spark, sf_dir):
    """Where the pages of every document differ from those of its changed form."""
    found = images.page_differences(_pages(spark, sf_dir))
    return found.withColumn("confidence", F.round("confidence", 9))


@query()
def visual_from_images(spark, sf_dir):
    """Level 2's summary of every document, from its page images."""
    pages = _pages(spark, sf_dir)
    likeness = pages.select("doc_id", images.ssim("before", "after", "before_width", "after_width").alias("ssim"))
    return structure.visual_summary(images.page_differences(pages).drop("page"), likeness)
