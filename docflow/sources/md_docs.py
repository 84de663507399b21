"""Markdown documents derived from ``documents``, by one expression that Spark and DuckDB both read."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

NL = "chr(10)"


def _part(condition: str, *pieces: str) -> str:
    return f"CASE WHEN {condition} THEN {' || '.join(pieces)} ELSE '' END"


#: SQL of ``md`` over doc_id.
MD = " || ".join(
    [
        _part("doc_id % 7 <> 0", "'# 问天服务器 '", "cast(doc_id as varchar(20))", NL, NL),
        _part("doc_id % 3 = 0", "'第一章 概述'", NL),
        _part("doc_id % 5 = 0", "'一、内存'", NL),
        _part("doc_id % 13 <> 0", "'| 参数 | 值 |'", NL, _part("doc_id % 4 <> 0", "'| --- | --- |'", NL), "'| 内存 | 64GB 3.5 GHz |'", NL, NL),
        _part("doc_id % 2 = 0", "'- item'", NL, "'- '", NL),
        _part("doc_id % 14 <> 0", "'处理器 和 存储 ，\"quoted\" (BMC)'", NL),
        _part("doc_id % 8 = 0", "'中 文 字 符'", NL),
        _part("doc_id % 9 < 5", "'введение обзор'", NL),
        _part("doc_id % 10 = 0", "'[x]()'", NL),
        _part("doc_id % 11 = 0", "'####### bad'", NL),
        _part("doc_id % 12 = 0", "'## A'", NL, NL, NL, "'## B'", NL),
        f"text || {NL}",
        _part("doc_id % 15 <> 0", "'```'", NL, "'ipmitool chassis power status 0x1f 10.0.0.1'", NL, _part("doc_id % 6 <> 0", "'```'", NL)),
    ]
)


#: Input bytes that keep one core busy; smaller tables than this times the cores are dealt out anew.
CORE_BYTES = 32 << 20


def spread(df: DataFrame) -> DataFrame:
    """``df`` over all cores if it is a small table in few row groups; large tables have splits enough and are not shuffled."""
    cores = df.sparkSession.sparkContext.defaultParallelism
    size = int(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes())
    return df.repartition(cores) if (1 << 20) < size < CORE_BYTES * cores else df


def md_docs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(doc_id, md)."""
    return spread(spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")).selectExpr("doc_id", f"{MD} AS md")


#: The same as a DuckDB common table expression.
MD_CTE = f"md_docs AS (SELECT doc_id, {MD} AS md FROM documents)"
