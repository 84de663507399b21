"""The registered queries of this subpackage: each applies one operator to its whole table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from docflow.llm import byte_bpe, fill_middle, html_crf, metric_tree, nn_descent, pareto_mix, periodic_runs, pii, pu_quality, quality_rules, simhash, toxic_segments, warc
from docflow.llm.common import table
from docflow.runtime import shipped


def op1_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_rules.apply_policy(quality_rules.quality_ledger(table(spark, sf_dir, "documents")))


def op2_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return byte_bpe.digests(table(spark, sf_dir, "documents"))


def op3_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc.query(table(spark, sf_dir, "pages"))


def op4_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.query(table(spark, sf_dir, "documents"))


def op5_html_crf(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_crf.extract(table(spark, sf_dir, "pages"))


def op6_pareto_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pareto_mix.query(table(spark, sf_dir, "documents"))


def op7_pu_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pu_quality.classify(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op8_nn_descent(spark: SparkSession, sf_dir: str) -> DataFrame:
    return nn_descent.query(table(spark, sf_dir, "embeddings"))


def op9_toxic_segments(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxic_segments.classify(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op10_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.query(table(spark, sf_dir, "documents"))


def op11_metric_tree(spark: SparkSession, sf_dir: str) -> DataFrame:
    return metric_tree.query(table(spark, sf_dir, "embeddings"))


def op12_fill_middle(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fill_middle.query(table(spark, sf_dir, "documents"))


def op13_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return periodic_runs.query(table(spark, sf_dir, "documents"))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    found = {
        "op1_quality_rules": op1_quality_rules,
        "op2_byte_bpe": op2_byte_bpe,
        "op3_warc": op3_warc,
        "op4_simhash": op4_simhash,
        "op5_html_crf": op5_html_crf,
        "op6_pareto_mix": op6_pareto_mix,
        "op7_pu_quality": op7_pu_quality,
        "op8_nn_descent": op8_nn_descent,
        "op9_toxic_segments": op9_toxic_segments,
        "op10_pii": op10_pii,
        "op11_metric_tree": op11_metric_tree,
        "op12_fill_middle": op12_fill_middle,
        "op13_periodic_runs": op13_periodic_runs,
    }
    return {name: shipped(f) for name, f in found.items()}


def oracle_sql() -> dict[str, str]:
    return {
        "op1_quality_rules": quality_rules.ORACLE,
        "op3_warc": warc.ORACLE,
        "op6_pareto_mix": pareto_mix.ORACLE,
        "op10_pii": pii.ORACLE,
        "op11_metric_tree": metric_tree.ORACLE,
        "op12_fill_middle": fill_middle.ORACLE,
    }
