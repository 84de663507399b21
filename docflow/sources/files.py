"""Files as rows: listing, validation, hashes, profiles, statistics, and the sinks of each stage."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from docflow.functions.rx import CJK

LARGEST = 500 * 1024 * 1024


def pdf_files(spark: SparkSession, folder: str) -> DataFrame:
    """(path, modificationTime, length, content) of all PDF files below a folder; Spark lists no empty ones."""
    return spark.read.format("binaryFile").option("pathGlobFilter", "*.pdf").option("recursiveFileLookup", "true").load(folder)


def validated(files: DataFrame) -> DataFrame:
    """Files with a ``reason`` to reject, null if there is none, and the status code that an upload would get."""
    magic = F.substring("content", 1, 4) == F.lit(b"%PDF")
    reason = F.when(~F.lower("path").endswith(".pdf"), "extension").when(F.col("length") == 0, "empty").when(F.col("length") > LARGEST, "too large").when(~magic, "not a PDF")
    status = F.when(F.col("reason") == "too large", 413).when(F.col("reason").isNotNull(), 400).otherwise(200)
    return files.withColumn("reason", reason).withColumn("status", status)


def hashed(files: DataFrame) -> DataFrame:
    return files.withColumn("md5", F.md5("content")).withColumn("sha256", F.sha2("content", 256))


def profile(df: DataFrame, text_col: str, name_ok: Column) -> DataFrame:
    """What is known of a document before it is read: validity, hashes, pages by size, script, complexity."""
    t = F.col(text_col)
    size = F.octet_length(t)
    source = F.regexp_count(F.substring(t, 1, 500), F.lit(CJK)) > 5
    return df.select(
        "doc_id",
        (name_ok & (F.length(t) > 0) & (F.length(t) <= LARGEST)).alias("valid"),
        F.md5(t.cast("binary")).alias("md5"),
        F.sha2(t, 256).alias("sha256"),
        F.greatest(F.lit(1), F.floor(size / 102400)).cast("long").alias("pages"),
        source.alias("has_source_script"),
        (~source).alias("recommended_ocr"),
        F.when(size > 50 * 1024 * 1024, "high").otherwise("medium").alias("complexity"),
    )


def statistics(df: DataFrame, text_col: str = "text") -> DataFrame:
    t = F.col(text_col)
    rows = F.split(t, "\n")
    return df.select(
        "doc_id",
        F.size(rows).cast("long").alias("n_lines"),
        F.regexp_count(t, F.lit(r"[^ \t\n\r\f\x0B]+")).cast("long").alias("n_words"),
        F.octet_length(t).cast("long").alias("n_bytes"),
        (F.octet_length(t) > 100).alias("adequate"),
        F.array_join(F.slice(rows, 1, 5), "\n").alias("head"),
    )


def safe_name(name: Column) -> Column:
    return F.regexp_replace(name, "[^A-Za-z0-9._-]", "_")


def mapped_path(path: Column, prefix: str, to: str) -> Column:
    return F.regexp_replace(path, prefix, to)


def newest(files: DataFrame) -> DataFrame:
    """The path modified last; the last name on ties."""
    return files.agg(F.max(F.struct("modificationTime", "path"))["path"].alias("path"))


#: Intermediate documents between stages.
INTERMEDIATE = (
    "title string, pages_count int, markdown_content string, raw_text string, sections array<struct<id:int,title:string,level:int,page:int,content:string>>, "
    "tables array<struct<id:string,page:int,content:string,file_path:string>>, images array<struct<id:string,page:int,file_path:string>>, metadata map<string,string>"
)


def read_intermediate(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(INTERMEDIATE).option("multiLine", "true").json(path)


def normalised(docs: DataFrame) -> DataFrame:
    """Empty Markdown taken from the raw text, and a reason for documents without sections."""
    md = F.coalesce(F.nullif("markdown_content", F.lit("")), F.col("raw_text"), F.lit(""))
    reason = F.when(F.size("sections") <= 0, "no sections").when(F.col("sections").isNull(), "no sections")
    return docs.withColumn("markdown_content", md).withColumn("reason", reason)


def write_markdown(df: DataFrame, path: str) -> None:
    """(target_language, markdown) as text files by language."""
    df.select("target_language", F.col("markdown").alias("value")).write.partitionBy("target_language").mode("overwrite").text(path)


def write_tables(df: DataFrame, path: str) -> None:
    """Table rows as CSV with a head, by table."""
    df.write.partitionBy("doc_id", "page", "table").mode("overwrite").option("header", "true").csv(path)


def write_reports(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").json(path)
