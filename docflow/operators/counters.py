"""Rates of counters that restart: increases that see resets, carried to the edges of a window, in sliding windows.

A counter only grows until its process restarts; a sample below the one before it is a reset, and counts from zero. The samples
of a series fold into a summary (how many, first, last, increase, resets). Summaries of neighbouring stretches of time merge in
order, so each pane of one step is summed up once and a window merges its few panes. The same merge serves streams.

The increase between a window's first and last sample is carried on to its edges: where an edge is further away than 1.1 mean
sample distances, by half such a distance only; and never back beyond the time at which the counter was zero.

Samples have ``ts``, ``at`` (a long that orders samples of one instant) and ``value``. Windows begin at whole steps and hold
samples from their start up to, not at, their end. Windows with fewer than two samples have no rate. Samples without a time or a
value do not count; a repeated sample adds nothing.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from docflow.functions.rx import let

#: An edge is near if it is within this many mean distances of samples.
NEAR = 1.1


def samples(rows: DataFrame, by: Sequence[str], lifetime: int, order: str = "event_id") -> DataFrame:
    """(by…, ts, at, value): each row as a sample of the count of rows so far, in processes that restart every ``lifetime`` seconds."""
    t = F.unix_micros("ts")
    upto = Window.partitionBy(*by, F.floor(t / (lifetime * 1_000_000))).orderBy("ts", order)
    return rows.select(*by, "ts", F.col(order).cast("long").alias("at"), F.row_number().over(upto).cast("double").alias("value"))


def _step(before: Column, now: Column) -> Column:
    """What a counter grew between two samples."""
    return F.when(now < before, now).otherwise(now - before)


def folded(ordered: Column) -> Column:
    """The summary of an array of samples (t, at, value) in order."""
    seen = lambda a, s: F.struct(
        (a["n"] + 1).alias("n"),
        F.coalesce(a["first"], s).alias("first"),
        s.alias("last"),
        (a["increase"] + F.coalesce(_step(a["last"]["value"], s["value"]), F.lit(0.0))).alias("increase"),
        (a["resets"] + F.coalesce(s["value"] < a["last"]["value"], F.lit(False)).cast("long")).alias("resets"),
    )
    sample = "struct<t: bigint, at: bigint, value: double>"
    zero = F.lit(None).cast(sample)
    start = F.struct(F.lit(0).cast("long").alias("n"), zero.alias("first"), zero.alias("last"), F.lit(0.0).alias("increase"), F.lit(0).cast("long").alias("resets"))
    return F.aggregate(ordered, start, seen)


def merged(ordered: Column) -> Column:
    """The summary of neighbouring stretches from the array of theirs, in order of time; empty ones are none."""

    def both(a: Column, b: Column) -> Column:
        before, now = a["last"]["value"], b["first"]["value"]
        return F.struct(
            (a["n"] + b["n"]).alias("n"),
            a["first"].alias("first"),
            b["last"].alias("last"),
            (a["increase"] + _step(before, now) + b["increase"]).alias("increase"),
            (a["resets"] + (now < before).cast("long") + b["resets"]).alias("resets"),
        )

    return F.reduce(F.slice(ordered, 2, F.greatest(F.size(ordered), F.lit(1))), F.get(ordered, F.lit(0)), both)


def carried(summary: Column, start: Column, seconds: int) -> Column:
    """The increase in the whole window of a summary (times in microseconds); null with fewer than two samples or no time between them."""
    first, last = summary["first"]["t"] / 1e6, summary["last"]["t"] / 1e6
    begin = start / 1e6

    def whole(s: Column) -> Column:
        mean = s["span"] / (summary["n"] - 1)
        edge = lambda d: F.when(d >= mean * NEAR, mean / 2).otherwise(d)
        grown = summary["increase"]
        zero = F.when(grown > 0, s["span"] * summary["first"]["value"] / grown)
        front = F.least(edge(first - begin), zero)  # least skips a null
        return grown * (s["span"] + front + edge(begin + seconds - last)) / s["span"]

    return F.when((summary["n"] > 1) & (last > first), let(F.struct((last - first).alias("span")), whole))


def panes(rows: DataFrame, by: Sequence[str], step: int) -> DataFrame:
    """(by…, pane, summary): the samples of each series and step. Sorted within a pane, never collected."""
    pane = (F.floor(F.unix_micros("ts") / (step * 1_000_000)) * step * 1_000_000).cast("long")
    own = rows.where(F.col("ts").isNotNull() & F.col("value").isNotNull()).select(*by, pane.alias("pane"), F.struct(F.unix_micros("ts").alias("t"), F.col("at").cast("long").alias("at"), F.col("value").cast("double").alias("value")).alias("s"))
    before = F.lag("s.value").over(Window.partitionBy(*by, "pane").orderBy("s.t", "s.at", "s.value"))
    grown = own.withColumn("b", before)
    summed = grown.groupBy(*by, "pane").agg(
        F.count(F.lit(1)).alias("n"),
        F.min("s").alias("first"),
        F.max("s").alias("last"),
        F.coalesce(F.sum(_step(F.col("b"), F.col("s.value"))), F.lit(0.0)).alias("increase"),
        F.count_if(F.col("s.value") < F.col("b")).alias("resets"),
    )
    return summed.select(*by, "pane", F.struct("n", "first", "last", "increase", "resets").alias("summary"))


def _told(windows: DataFrame, by: Sequence[str], size: int) -> DataFrame:
    """(by…, window_start, samples, resets, increase, per_second) of (by…, start, summary)."""
    known = windows.withColumn("_whole", carried(F.col("summary"), F.col("start"), size))
    start = F.timestamp_micros("start").cast("timestamp_ntz").alias("window_start")
    return known.select(*by, start, F.col("summary.n").alias("samples"), F.col("summary.resets").alias("resets"), F.col("_whole").alias("increase"), (F.col("_whole") / size).alias("per_second"))


def rates(rows: DataFrame, by: Sequence[str], size: int, step: int) -> DataFrame:
    """(by…, window_start, samples, resets, increase, per_second) of windows of ``size`` seconds that begin every ``step`` seconds."""
    _whole_steps(size, step)
    starts = F.transform(F.sequence(F.lit(0), F.lit(size // step - 1)), lambda k: (F.col("pane") - k * (step * 1_000_000)).cast("long"))
    dealt = panes(rows, by, step).select(*by, F.explode(starts).alias("start"), F.struct("pane", "summary").alias("p"))
    # A window has as many panes as it has steps.
    windows = dealt.groupBy(*by, "start").agg(F.array_sort(F.collect_list("p")).alias("l"))
    return _told(windows.select(*by, "start", merged(F.transform("l", lambda p: p["summary"])).alias("summary")), by, size)


def live_rates(rows: DataFrame, by: Sequence[str], size: int, step: int, late: str = "10 minutes") -> DataFrame:
    """The same over a stream of samples; a window comes when the watermark has passed it, samples later than ``late`` fall out."""
    _whole_steps(size, step)
    own = rows.where(F.col("ts").isNotNull() & F.col("value").isNotNull()).withWatermark("ts", late)
    sample = F.struct(F.unix_micros("ts").alias("t"), F.col("at").cast("long").alias("at"), F.col("value").cast("double").alias("value"))
    each = own.groupBy(F.window("ts", f"{step} seconds").alias("pane"), *by).agg(F.array_sort(F.collect_list(sample)).alias("l"))
    parts = each.select(*by, F.window_time("pane").alias("time"), F.struct(F.unix_micros("pane.start").alias("pane"), folded(F.col("l")).alias("summary")).alias("p"))
    windows = parts.groupBy(F.window("time", f"{size} seconds", f"{step} seconds").alias("w"), *by).agg(F.array_sort(F.collect_list("p")).alias("l"))
    return _told(windows.select(*by, F.unix_micros("w.start").alias("start"), merged(F.transform("l", lambda p: p["summary"])).alias("summary")), by, size)


def _whole_steps(size: int, step: int) -> None:
    if size % step:
        raise ValueError("a window is a whole number of steps")
