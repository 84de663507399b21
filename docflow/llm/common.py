"""What the operators of this subpackage share: the tables, the shared folder, written intermediates and hot-key joins."""

from __future__ import annotations

import gc
import os
import tempfile
import uuid

from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Fixed by the contracts: what separates words.
WORD_BREAK = r"[\x20\x09-\x0D]+"
WORD = r"[^\x20\x09-\x0D]+"

__all__ = ["WORD", "WORD_BREAK", "StorageLevel", "forget", "let", "shared_dir", "stored", "swept", "table", "where_settled", "words_of"]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share, as ``spark.checkpoint.dir`` names it.

    Unset in a local session, a folder of this machine is made and set; unset on a cluster is an error,
    since executors would each write to their own disk.
    """
    at = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir")
    if not at:
        master = spark.sparkContext.master
        if not (master.startswith("local") and not master.startswith("local-cluster")):
            raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
        at = f"file://{tempfile.mkdtemp(prefix='docflow-')}"
        spark.conf.set("spark.checkpoint.dir", at)
        spark.sparkContext.setCheckpointDir(at)
    if at.startswith("/"):
        at = f"file://{at}"
    return at.rstrip("/")


def own_dir(spark: SparkSession, what: str) -> str:
    """A fresh folder name below the shared folder."""
    return f"{shared_dir(spark)}/docflow/{what}-{uuid.uuid4().hex}"


def stored(df: DataFrame, what: str) -> DataFrame:
    """``df`` written as Parquet in the shared folder and read again: cuts lineage and survives lost executors."""
    spark = df.sparkSession
    at = own_dir(spark, what)
    df.write.parquet(at)
    return spark.read.schema(df.schema).parquet(at)


def forget(df: DataFrame | None) -> None:
    """Removes what ``stored`` wrote for a frame that nothing reads any more."""
    for at in {f.rsplit("/", 1)[0] for f in df.inputFiles()} if df is not None else ():
        path = df.sparkSession._jvm.org.apache.hadoop.fs.Path(at)
        path.getFileSystem(df.sparkSession._jsc.hadoopConfiguration()).delete(path, True)


def swept(spark: SparkSession) -> None:
    """Has the driver collect garbage, so that shuffle files of finished steps go now and not when memory happens to run short."""
    gc.collect()
    spark._jvm.System.gc()


def let(value: Column, body) -> Column:
    """``body(value)`` with value evaluated once for each row, wherever the optimizer moves the expression."""
    return F.element_at(F.transform(F.array(value), body), 1)


def where_settled(df: DataFrame, condition: Column | str) -> DataFrame:
    """``df.where(condition)``, with the condition evaluated once and in place.

    The optimizer would push the filter below the projections that its columns come from and repeat their
    expressions for each use; it does not push one through a generator that the kept rows come out of.
    """
    condition = F.expr(condition) if isinstance(condition, str) else condition
    rows = F.array(F.struct(*(F.col(f"`{c}`") for c in df.columns)))
    return df.select(F.explode_outer(F.when(condition, rows)).alias("_kept")).where("_kept is not null").select("_kept.*")


def words_of(text: Column) -> Column:
    """The words of a text, in order; none for null or blank texts."""
    return F.array_remove(F.split(F.coalesce(text, F.lit("")), WORD_BREAK), "")


def local_path(uri: str) -> str | None:
    """The path of a file:// folder, else None."""
    return os.path.normpath(uri[len("file:") :].replace("//", "/")) if uri.startswith("file:") else None
