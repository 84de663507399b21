"""Structured Streaming over telemetry and prompts: windowed rates with late data, sessions, and an answer cache that forgets."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

EVENTS = "event_id long, ts timestamp_ntz, user_id long, event_type string, value double, props string"


def read_events(spark: SparkSession, path: str, files_each: int = 1) -> DataFrame:
    """Event files as a stream of telemetry rows."""
    from docflow.operators.metrics import telemetry

    raw = spark.readStream.schema(EVENTS).option("maxFilesPerTrigger", files_each).parquet(path)
    return telemetry(raw)


def success_rate(rows: DataFrame, size: str = "5 minutes", step: str = "1 minute", late: str = "10 minutes") -> DataFrame:
    """(window_start, n, ok, success_pct) of sliding windows; rows later than ``late`` fall out."""
    g = rows.withWatermark("ts", late).groupBy(F.window("ts", size, step).alias("w")).agg(F.count(F.lit(1)).alias("n"), F.count_if("success").alias("ok"))
    return g.select(F.col("w.start").alias("window_start"), "n", "ok", (F.col("ok") / F.col("n") * 100).alias("success_pct"))


def tumbling_counts(rows: DataFrame, size: str = "1 hour", late: str = "1 hour") -> DataFrame:
    g = rows.withWatermark("ts", late).groupBy(F.window("ts", size).alias("w"), "stage").agg(F.count(F.lit(1)).alias("n"))
    return g.select(F.col("w.start").alias("window_start"), "stage", "n")


def sessions(rows: DataFrame, gap: str = "30 minutes", late: str = "1 hour") -> DataFrame:
    g = rows.withWatermark("ts", late).groupBy("user_id", F.session_window("ts", gap).alias("w")).agg(F.count(F.lit(1)).alias("n"))
    return g.select("user_id", F.col("w.start").alias("session_start"), F.col("w.end").alias("session_end"), "n")


def first_seen(rows: DataFrame, late: str = "1 day") -> DataFrame:
    """Each event once, however often it is delivered within ``late``."""
    return rows.withWatermark("ts", late).dropDuplicatesWithinWatermark(["event_id"])


def cached_answers(prompts: DataFrame, model, ttl_ms: int = 900_000) -> DataFrame:
    """(key, prompt) rows to (key, text, cached): a prompt's answer is kept as state and dropped ``ttl_ms`` after its last use."""

    def work(key: tuple[str], parts: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        if state.hasTimedOut:
            state.remove()
            return
        for part in parts:
            rows = []
            for prompt in part["prompt"]:
                cached = state.exists
                if not cached:
                    state.update((model(prompt),))
                rows.append((key[0], state.get[0], cached))
            yield pd.DataFrame(rows, columns=["key", "text", "cached"])
        state.setTimeoutDuration(ttl_ms)

    return prompts.groupBy("key").applyInPandasWithState(work, "key string, text string, cached boolean", "text string", "append", GroupStateTimeout.ProcessingTimeTimeout)


def write_table(stream: DataFrame, path: str, checkpoint: str, mode: str = "append"):
    """Runs the stream over what there is and ends."""
    return stream.writeStream.format("parquet").option("path", path).option("checkpointLocation", checkpoint).outputMode(mode).trigger(availableNow=True).start()


def to_sinks(stream: DataFrame, checkpoint: str, *sinks) -> object:
    """Hands every micro-batch (DataFrame, id) to each sink in turn, such as a metrics table or a notifier, and ends with the input."""

    def each(batch: DataFrame, number: int) -> None:
        batch.persist()
        for sink in sinks:
            sink(batch, number)
        batch.unpersist()

    return stream.writeStream.foreachBatch(each).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
