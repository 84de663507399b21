"""Calls in waves: the sequence of attempts and their due times equal the rule, whatever the service does."""

import pandas as pd
import pyarrow as pa
import pytest

from docflow.operators import adapters, calls, flows

#: What the service does at each attempt: an answer, a status, an exception, an empty answer.
SCRIPTS = {
    "fine": ["yes"],
    "busy": [503, 429, "late"],
    "failing": [500, 500, 500],
    "missing": [404, 404, "found"],
    "broken": [OSError("reset"), "back"],
    "empty": ["", " ", ""],
    "mixed": [429, "", "done"],
}


class Scripted:
    def __init__(self, attempt):
        self.attempt = attempt

    def __call__(self, prompt):
        step = SCRIPTS[prompt][self.attempt - 1]
        if isinstance(step, int):
            raise calls.CallFailed(step)
        if isinstance(step, Exception):
            raise step
        return step


def rule(script, attempts=3, delay=5.0):
    """(attempt, due, status) of each call."""
    out, due = [], 0.0
    for n, step in enumerate(script[:attempts], 1):
        status = step if isinstance(step, int) else None
        out.append((n, due, status))
        if isinstance(step, str) and step.strip():
            break
        due += 2 * delay if status in (429, 500, 503) else 0.0 if status else delay
    return out


def test_attempts_follow_the_rule(spark):
    clock = calls.StepClock()
    prompts = spark.createDataFrame([(p,) for p in [*SCRIPTS, "fine", None]], "prompt string")
    log = calls.attempts_of(prompts, Scripted, clock)
    got = {}
    for r in log.collect():
        got.setdefault(r.prompt, []).append((r.attempt, r.due, r.status))
    assert {p: sorted(x) for p, x in got.items()} == {p: rule(s) for p, s in SCRIPTS.items()}
    assert clock.waited == sorted(clock.waited) and clock.at == 20.0
    ends = {r.key: r for r in calls.outcomes(log).collect()}
    by = {r.prompt: ends[r.key] for r in log.select("prompt", "key").distinct().collect()}
    assert {p: (r.ok, r.text, r.attempts) for p, r in by.items()} == {
        "fine": (True, "yes", 1), "busy": (True, "late", 3), "failing": (False, None, 3), "missing": (True, "found", 3),
        "broken": (True, "back", 2), "empty": (False, None, 3), "mixed": (True, "done", 3),
    }
    assert by["failing"].error == "status 500" and by["empty"].error == "empty answer"


def test_no_prompts(spark):
    log = calls.attempts_of(spark.createDataFrame([], "prompt string"), Scripted, calls.StepClock())
    assert log.count() == 0 and calls.outcomes(log).count() == 0


def test_flows_take_the_waves(spark):
    clock = calls.StepClock()
    docs = spark.createDataFrame([(1, "文本"), (2, "文本"), (3, " "), (4, None)], "doc_id long, text string")

    class Late:
        def __init__(self, attempt):
            self.attempt = attempt

        def __call__(self, prompt):
            if self.attempt < 3:
                raise calls.CallFailed(503)
            return "текст"

    done = flows.translate_single(docs, Late, "zh-CN", "ru", clock=clock)
    assert {r.doc_id: r.translated for r in done.collect()} == {1: "текст", 2: "текст", 3: " ", 4: None}
    assert clock.at == 20.0


@pytest.mark.parametrize("status", [None, 429, 404])
def test_a_wall_clock_waits_on_the_driver(spark, status, monkeypatch):
    slept = []
    monkeypatch.setattr(calls.time, "sleep", slept.append)

    class Never:
        def __init__(self, attempt):
            pass

        def __call__(self, prompt):
            raise calls.CallFailed(status) if status else OSError("down")

    log = calls.attempts_of(spark.createDataFrame([("p",)], "prompt string"), Never, attempts=2, delay=1000.0)
    assert log.count() == 2
    long = [s for s in slept if s > 60]  # others may sleep for moments
    want = {None: [1000], 429: [2000], 404: []}[status]
    assert len(long) == len(want) and all(w - 60 <= s <= w for s, w in zip(long, want, strict=True))


def test_workers_hold_pieces_of_a_batch(spark):
    """Frames are bounded in bytes, where a batch of Spark's has 10,000 rows of any size."""
    long = spark.range(0, 1200, 1, 1).selectExpr("repeat(concat(id, ' '), if(id = 7, 2000000, 4000)) AS prompt")

    def sizes(parts):
        for part in parts:
            yield pd.DataFrame({"rows": [len(part)], "chars": [part["prompt"].str.len().sum()]})

    got = adapters.in_pieces(long, sizes, "rows int, chars long").collect()
    assert sum(r.rows for r in got) == 1200 and all(r.chars <= adapters.PIECE or r.rows == 1 for r in got)
    assert sum(r.chars for r in got) == long.selectExpr("sum(length(prompt)) AS n").first().n
    batch = pa.record_batch({"x": ["a" * 1000] * 9000 + [None]})
    cut = list(adapters.pieces(iter([batch, batch.slice(0, 0)])))
    assert all(c.nbytes <= adapters.PIECE for c in cut) and pa.Table.from_batches(cut).equals(pa.Table.from_batches([batch]))
