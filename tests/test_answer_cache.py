"""The bounded answer cache: order of eviction, age, restarts; against a plain rule."""

import datetime as dt
import random
from collections import OrderedDict

import pytest

from docflow.streaming import answer_cache

START = dt.datetime(2024, 1, 1)


class Shouting:
    def __call__(self, prompt):
        if prompt == "bad":
            raise OSError("down")
        return prompt.upper()


def plain(rows, capacity, ttl):
    held, out = OrderedDict(), {}
    for number, t, prompt in rows:
        found = prompt in held and t - held[prompt] <= ttl
        if not found:
            held.pop(prompt, None)
            if prompt not in ("bad", ""):
                held[prompt] = t
        if prompt in held:
            held.move_to_end(prompt)
        while len(held) > capacity:
            held.popitem(last=False)
        out[number] = (None if prompt in ("bad", "") else prompt.upper(), found)
    return out


@pytest.fixture
def rocks(spark):
    name = "spark.sql.streaming.stateStore.providerClass"
    before = spark.conf.get(name)
    spark.conf.set(name, answer_cache.PROVIDER)
    yield spark
    spark.conf.set(name, before)


def run(spark, folder, capacity, ttl):
    stream = spark.readStream.schema("id long, ts timestamp, prompt string, model string").option("maxFilesPerTrigger", 1).option("latestFirst", False).parquet(f"{folder}/in")
    q = answer_cache.lru_answers(stream, Shouting, capacity, ttl * 1000, by="model", late="1 minute").writeStream.format("parquet").option("path", f"{folder}/out").option("checkpointLocation", f"{folder}/cp").trigger(availableNow=True).start()
    q.awaitTermination(180)
    assert q.exception() is None


def test_eviction_age_and_restart_equal_the_rule(rocks, tmp_path):
    rng, t, rows = random.Random(4), 0, []
    for i in range(300):
        t += rng.choice((0, 1, 5, 40))
        rows.append((i, t, rng.choice(["a", "b", "c", "d", "e", "f", "bad", ""])))
    # Restarted after each file; the files' order is that of their times.
    for k in range(0, 300, 100):
        part = rows[k : k + 100]
        rocks.createDataFrame([(i, START + dt.timedelta(seconds=s), p, m) for i, s, p in part for m in ("x", "y")] + [(-1, None, "a", "x"), (-2, START, None, "x")], "id long, ts timestamp, prompt string, model string").coalesce(1).write.mode("append").parquet(f"{tmp_path}/in")
        run(rocks, tmp_path, 3, 60)
    got = {}
    for r in rocks.read.parquet(f"{tmp_path}/out").collect():
        got.setdefault(r.id, []).append((r.text, r.cached))
    want = plain(rows, 3, 60)
    assert got == {i: [x, x] for i, x in want.items()}
    assert sum(c for _, c in want.values()) > 30


def test_order_of_eviction(rocks, tmp_path):
    # a b c, a again (most recent), d drops b; b is asked again and drops c; a, d, b stay.
    prompts = ["a", "b", "c", "a", "d", "a", "b", "c"]
    rows = [(i, START + dt.timedelta(seconds=i), p, "m") for i, p in enumerate(prompts)]
    rocks.createDataFrame(rows, "id long, ts timestamp, prompt string, model string").coalesce(1).write.parquet(f"{tmp_path}/in")
    run(rocks, tmp_path, 3, 900)
    got = [r.cached for r in rocks.read.parquet(f"{tmp_path}/out").orderBy("id").collect()]
    assert got == [False, False, False, True, False, True, False, False]
