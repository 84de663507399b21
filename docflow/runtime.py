"""Makes this package known to the Python workers of a session, wherever its driver was started."""

from __future__ import annotations

import os
import tempfile
import zipfile
from collections.abc import Callable
from functools import wraps
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession

_shipped: set[str] = set()


def ship(spark: SparkSession) -> None:
    """Hands the package's sources to the session's file server once; executors fetch them from there."""
    context = spark.sparkContext
    if context.applicationId in _shipped:
        return
    root = Path(__file__).parent
    handle, path = tempfile.mkstemp(prefix="docflow-", suffix=".zip")
    with os.fdopen(handle, "wb") as out, zipfile.ZipFile(out, "w", zipfile.ZIP_DEFLATED) as z:
        for source in sorted(root.rglob("*.py")):
            z.write(source, str(Path(root.name) / source.relative_to(root)))
    context.addPyFile(path)
    _shipped.add(context.applicationId)


def shipped(query: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    """The query, with the package shipped before it runs."""

    @wraps(query)
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        ship(spark)
        return query(spark, sf_dir)

    return run


def checkpointed(df: DataFrame) -> DataFrame:
    """``df`` computed once and kept in the folder of ``spark.checkpoint.dir``, which executors share; a local session without it gets its own."""
    spark = df.sparkSession
    context = spark.sparkContext
    if not (spark.conf.get("spark.checkpoint.dir", None) or context.getConf().get("spark.checkpoint.dir") or context.getCheckpointDir()):
        if not context.master.startswith("local") or context.master.startswith("local-cluster"):
            raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
        context.setCheckpointDir(tempfile.mkdtemp(prefix="docflow-"))
    elif not context.getCheckpointDir():
        context.setCheckpointDir(spark.conf.get("spark.checkpoint.dir", None) or context.getConf().get("spark.checkpoint.dir"))
    return df.checkpoint(eager=True)
