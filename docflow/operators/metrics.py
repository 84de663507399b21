"""Telemetry: windowed rates and ratios, histograms and their quantiles, gauges, name mapping. Batch and streaming alike."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from docflow.operators.statsd import RULES

#: Fixed upper bounds of the duration buckets, in seconds.
BUCKETS = (0.005, 0.01, 0.025, 0.05, 0.1, 0.25, 0.5, 1, 2.5, 5, 10)


def telemetry(events: DataFrame) -> DataFrame:
    """(ts, event_id, user_id, stage, success, seconds, labels) of an event table."""
    return events.select(F.col("ts").cast("timestamp").alias("ts"), "event_id", "user_id", F.col("event_type").alias("stage"), (F.col("event_type") != "error").alias("success"), (F.col("value") / 20).alias("seconds"), F.col("props").alias("labels"))


def rate(rows: DataFrame, size: str, step: str, seconds: int, by: Sequence[str] = ()) -> DataFrame:
    """(window_start, by…, per_second): rows of each sliding window over ``seconds``."""
    g = rows.groupBy(F.window("ts", size, step).alias("w"), *by).agg((F.count(F.lit(1)) / seconds).alias("per_second"))
    return g.select(F.col("w.start").cast("timestamp_ntz").alias("window_start"), *by, "per_second")


def success_rate(rows: DataFrame, size: str, step: str, low: float = 85, high: float = 95) -> DataFrame:
    """(window_start, success_pct, state)."""
    pct = F.try_divide(F.count_if("success"), F.count(F.lit(1))) * 100
    g = rows.groupBy(F.window("ts", size, step).alias("w")).agg(pct.alias("success_pct"))
    state = F.when(F.col("success_pct") >= high, "ok").when(F.col("success_pct") >= low, "warn").otherwise("alert")
    return g.select(F.col("w.start").cast("timestamp_ntz").alias("window_start"), "success_pct", state.alias("state"))


def bucket(value: Column) -> Column:
    """The first bucket that holds a value, from 1; one past the last for larger ones."""
    out = F.lit(len(BUCKETS) + 1)
    for i in range(len(BUCKETS), 0, -1):
        out = F.when(value <= BUCKETS[i - 1], i).otherwise(out)
    return out


def histogram_quantile(rows: DataFrame, share: float, by: Sequence[str], value: str = "seconds") -> DataFrame:
    """(by…, quantile): linear within the bucket that the share falls in, the last bound beyond all.

    One aggregation by series to a fixed array of counts; what follows works on those arrays.
    """
    b = bucket(F.col(value))
    counts = rows.groupBy(*by).agg(F.array(*(F.count_if(b == i) for i in range(1, len(BUCKETS) + 2))).alias("c"))
    bounds = F.array(F.lit(0.0), *(F.lit(float(x)) for x in BUCKETS), F.lit(float(BUCKETS[-1])))
    total = F.aggregate("c", F.lit(0).cast("long"), lambda a, x: a + x)

    def step(a: Column, i: Column) -> Column:
        n = F.get(F.col("c"), i)
        found = a["q"].isNull() & (a["n"] + n >= share * total)
        low, high = F.get(bounds, i), F.get(bounds, i + 1)
        q = F.when(found, low + (high - low) * F.try_divide(share * total - a["n"], n)).otherwise(a["q"])
        return F.struct((a["n"] + n).alias("n"), q.alias("q"))

    zero = F.struct(F.lit(0).cast("long").alias("n"), F.lit(None).cast("double").alias("q"))
    return counts.select(*by, F.aggregate(F.sequence(F.lit(0), F.lit(len(BUCKETS))), zero, step)["q"].alias("quantile"))


def last_value(rows: DataFrame, by: Sequence[str], value: str = "seconds") -> DataFrame:
    return rows.groupBy(*by).agg(F.max_by(value, F.struct("ts", "event_id")).alias("value"))


def mapped_name(name: Column, rules: Sequence[tuple[str, str, Sequence[str]]] = RULES) -> Column:
    """Struct (metric, labels) by the first rule that fits; a star is one part of a dotted name and the value of a label."""
    out = None
    for glob, metric, stars in rules:
        rx = "^" + glob.replace(".", r"\.").replace("*", "([^.]+)") + "$"
        labels = F.create_map(*(x for i, s in enumerate(stars) for x in (F.lit(s), F.regexp_extract(name, rx, i + 1)))) if stars else F.create_map().cast("map<string,string>")
        hit = F.struct(F.lit(metric).alias("metric"), labels.alias("labels"))
        out = F.when(name.rlike(rx), hit) if out is None else out.when(name.rlike(rx), hit)
    return F.coalesce(out, F.struct(F.lit(None).cast("string").alias("metric"), F.create_map().cast("map<string,string>").alias("labels")))


def relabelled(name: Column) -> Column:
    return F.regexp_replace(name, "^pdf_converter_(.+)", "pdfconv_$1")


#: Metrics whose whole name fits get the label with this value, whatever it was.
LABEL_RULES = (("vllm_.*", "model_architecture", "a3b"), ("vllm_.*", "model_name", "qwen3-30b-a3b-instruct"))


def labelled(name: Column, labels: Column, rules: Sequence[tuple[str, str, str]] = LABEL_RULES) -> Column:
    """A metric's labels after the rules, each on the result of those before; null labels are none."""
    out = F.coalesce(labels, F.create_map().cast("map<string,string>"))
    without = lambda m, label: F.map_filter(m, lambda k, _: k != label)
    for pattern, label, value in rules:
        put = F.map_concat(without(out, label), F.create_map(F.lit(label), F.lit(value)))
        out = F.when(name.rlike(f"^(?:{pattern})$"), put).otherwise(out)
    return out


def task_metrics(runs: DataFrame) -> DataFrame:
    """(dag, task, seconds, success, pages) rows to one row for each emitted metric."""
    names = F.array(*(F.struct(F.lit(n).alias("metric"), c.cast("double").alias("value")) for n, c in (("processing_time", F.col("seconds")), ("success", F.col("success").cast("int")), ("pages", F.col("pages")))))
    return runs.select("ts", "dag", "task", F.explode(names).alias("m")).select("ts", F.concat_ws(".", "dag", "task", "m.metric").alias("metric"), F.col("m.value").alias("value"))
