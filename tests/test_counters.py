"""Rates of counters: resets, gaps, edges; batch against a plain rule and against the stream."""

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from docflow.operators import counters

START = dt.datetime(2024, 1, 1)


def plain(points, start, size):
    """(samples, resets, increase) of sorted (t, at, value) within [start, start + size)."""
    own = sorted(p for p in points if start <= p[0] < start + size)
    if not own:
        return None
    pairs = list(zip(own, own[1:], strict=False))
    grown = sum(b[2] if b[2] < a[2] else b[2] - a[2] for a, b in pairs)
    resets = sum(b[2] < a[2] for a, b in pairs)
    span = own[-1][0] - own[0][0]
    if span <= 0:
        return len(own), resets, None
    mean = span / (len(own) - 1)
    edge = lambda d: mean / 2 if d >= 1.1 * mean else d
    front = edge(own[0][0] - start)
    if grown > 0:
        front = min(front, span * own[0][2] / grown)
    return len(own), resets, grown * (span + front + edge(start + size - own[-1][0])) / span


def series(seed, resets=0.1, gap=0.05):
    rng, t, v, out = random.Random(seed), 0.0, 0.0, []
    for i in range(120):
        t += rng.choice((600, 900)) if rng.random() < gap else rng.choice((5, 10, 15, 0))
        v = rng.choice((0.0, 1.0)) if rng.random() < resets else v + rng.choice((0, 1, 7))
        out.append((t, i, v))
    return out


@pytest.fixture(scope="module")
def points():
    return {"calm": series(1, 0, 0), "restarts": series(2), "gaps": series(3, 0.02, 0.3), "one": [(30.0, 0, 5.0)], "instant": [(30.0, 0, 5.0), (30.0, 1, 6.0)], "flat": [(float(t), t, 3.0) for t in range(0, 300, 20)]}


def frame(spark, points):
    rows = [(k, START + dt.timedelta(seconds=t), at, v) for k, p in points.items() for t, at, v in p]
    return spark.createDataFrame([*rows, ("calm", None, 1, 2.0), ("calm", START, 1, None)], "name string, ts timestamp, at long, value double")


def told(df):
    return {(r.name, int((r.window_start - START).total_seconds())): (r.samples, r.resets, None if r.increase is None else round(r.increase, 6)) for r in df.collect()}


def test_windows_equal_the_plain_rule(spark, points):
    got = told(counters.rates(frame(spark, points), ["name"], 300, 60))
    want = {}
    for k, p in points.items():
        for start in range(-240, int(max(t for t, *_ in p)) + 60, 60):
            found = plain(p, start, 300)
            if found:
                want[k, start] = (*found[:2], None if found[2] is None else round(found[2], 6))
    assert got == want
    assert any(x[1] for x in got.values()) and any(x[2] is None for x in got.values())


def test_stream_equals_batch(spark, points, tmp_path):
    df = frame(spark, points).where("ts is not null")
    last = spark.createDataFrame([("end", START + dt.timedelta(days=3), 0, 0.0)], df.schema)
    for i, part in enumerate([*(df.where(f"ts >= '{START + dt.timedelta(seconds=a)}' and ts < '{START + dt.timedelta(seconds=b)}'") for a, b in ((0, 500), (500, 2000), (2000, 10**6))), last]):
        part.coalesce(1).write.mode("append").parquet(f"{tmp_path}/in/{i}")
    stream = spark.readStream.schema(df.schema).option("maxFilesPerTrigger", 1).option("recursiveFileLookup", True).parquet(f"{tmp_path}/in")
    q = counters.live_rates(stream, ["name"], 300, 60, "1 minute").writeStream.format("parquet").option("path", f"{tmp_path}/out").option("checkpointLocation", f"{tmp_path}/cp").trigger(availableNow=True).start()
    q.awaitTermination(120)
    assert q.exception() is None
    got = told(spark.read.parquet(f"{tmp_path}/out").where("name <> 'end'"))
    assert got == told(counters.rates(df, ["name"], 300, 60))


def test_merging_parts_equals_the_whole(spark):
    p = series(5, 0.2)
    rows = spark.createDataFrame([([{"t": int(t * 1e6), "at": a, "value": v} for t, a, v in p], n) for n in (1, 3, 10, 120)], "l array<struct<t: long, at: long, value: double>>, n int")
    parts = F.transform(F.sequence(F.lit(0), F.floor((F.size("l") - 1) / F.col("n")).cast("int")), lambda k: counters.folded(F.slice("l", k * F.col("n") + 1, F.col("n"))))
    r = rows.select(counters.folded(F.col("l")).alias("whole"), counters.merged(parts).alias("merged")).collect()
    assert len({str(x.whole) for x in r}) == 1 and all(x.whole == x.merged and x.whole.resets > 3 for x in r)


def test_empty_and_uneven(spark, points):
    df = frame(spark, points)
    assert counters.rates(df.limit(0), ["name"], 300, 60).count() == 0
    with pytest.raises(ValueError):
        counters.rates(df, ["name"], 100, 60)
