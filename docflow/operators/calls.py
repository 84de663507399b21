"""Calls to a model in waves: an attempt is a row with a due time, a wave asks all that are due, and no task ever sleeps.

What comes back is classed by status: an answer ends a prompt; a busy or failing service (429, 500, 503) is asked again after
twice the delay, other statuses at once, and failures of any other kind (no status: a broken connection, an answer that can't be
read or is empty) after the delay. The last attempt ends a prompt in any case. The driver waits between waves, by a clock that
tests replace; while it waits, no executor is held. Each wave is checkpointed, so a lost executor does not ask again what was
answered, and each prompt is one row however many rows share it.
"""

from __future__ import annotations

import time
from collections.abc import Callable, Iterator
from dataclasses import dataclass, field
from typing import Protocol

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from docflow.operators.adapters import TextModel, in_pieces
from docflow.runtime import checkpointed

#: Attempts, seconds before another one, and the statuses after which it is twice as long.
ATTEMPTS, DELAY, BUSY = 3, 5.0, (429, 500, 503)


class CallFailed(Exception):
    """What a model raises when its service answers with a status other than success."""

    def __init__(self, status: int, message: str = ""):
        super().__init__(status, message)
        self.status = status

    def __str__(self) -> str:
        return f"status {self.status} {self.args[1]}".strip()


class Clock(Protocol):
    def now(self) -> float: ...

    def wait_until(self, due: float) -> None: ...


class WallClock:
    """Seconds since the epoch; waits on the driver."""

    def now(self) -> float:
        return time.time()

    def wait_until(self, due: float) -> None:
        time.sleep(max(0.0, due - time.time()))


@dataclass
class StepClock:
    """Stands still but for waiting, and keeps the times waited for."""

    at: float = 0.0
    waited: list[float] = field(default_factory=list)

    def now(self) -> float:
        return self.at

    def wait_until(self, due: float) -> None:
        self.at = max(self.at, due)
        self.waited.append(due)


def delay_after(status: Column, delay: float = DELAY) -> Column:
    """Seconds from a failed attempt to the next: by its status, null for failures without one."""
    return F.when(status.isNull(), delay).when(status.isin(*BUSY), 2 * delay).otherwise(0.0)


TRIED = "key string, prompt string, attempt int, due double, text string, status int, error string"


def _asked(rows: DataFrame, make: Callable[[int], TextModel], attempt: int) -> DataFrame:
    """Rows (key, prompt, attempt, due) with what one call each gave."""

    def work(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        model = make(attempt)
        for part in parts:
            out = []
            for row in part.itertuples(index=False):
                text = status = error = None
                try:
                    text = (model(row.prompt) or "").strip() or None
                    error = None if text else "empty answer"
                except CallFailed as e:
                    status, error = e.status, str(e)
                except Exception as e:  # noqa: BLE001  any failure of a foreign model is an attempt's error
                    error = f"{type(e).__name__}: {e}"
                out.append((*row, text, status, error))
            yield pd.DataFrame(out, columns=[c.split(" ")[0] for c in TRIED.split(", ")]).astype({"status": "Int32"})

    return in_pieces(rows, work, TRIED)


def attempts_of(prompts: DataFrame, make: Callable[[int], TextModel], clock: Clock | None = None, attempts: int = ATTEMPTS, delay: float = DELAY, prompt_col: str = "prompt") -> DataFrame:
    """(key, prompt, attempt, due, text, status, error): every attempt at every different prompt, by the clock's times.

    ``make`` gets the number of the attempt, from 1. A wave asks what is due when it starts; its failures are due by the time at
    which the wave was due. Null prompts are not asked.
    """
    clock = clock or WallClock()
    waiting = prompts.select(F.col(prompt_col).alias("prompt")).where("prompt is not null").distinct()
    waiting = waiting.select(F.sha2("prompt", 256).alias("key"), "prompt", F.lit(1).alias("attempt"), F.lit(clock.now()).alias("due"))
    log, pending = None, checkpointed(waiting)
    while True:
        next_due, least = pending.agg(F.min("due"), F.min("attempt")).first()
        if next_due is None:
            break
        clock.wait_until(next_due)
        # Prompts of one wave are at one attempt: what is due soonest, of the least attempt.
        due = (F.col("due") <= max(clock.now(), next_due)) & (F.col("attempt") == F.lit(least))
        if pending.where(due).isEmpty():
            least = pending.where(F.col("due") <= max(clock.now(), next_due)).agg(F.min("attempt")).first()[0]
            due = (F.col("due") <= max(clock.now(), next_due)) & (F.col("attempt") == F.lit(least))
        tried = checkpointed(_asked(pending.where(due), make, least))
        again = tried.where(F.col("text").isNull() & (F.col("attempt") < attempts)).select("key", "prompt", (F.col("attempt") + 1).alias("attempt"), (F.col("due") + delay_after(F.col("status"), delay)).alias("due"))
        log = tried if log is None else log.unionByName(tried)
        pending = checkpointed(pending.where(~due).unionByName(again))
    return log if log is not None else _asked(pending, make, 1)


def outcomes(log: DataFrame) -> DataFrame:
    """(key, ok, text, error, attempts) of ``attempts_of``: each prompt's last attempt, in the form of ``adapters.answered``."""
    last = log.groupBy("key").agg(F.max_by(F.struct("text", "error", "attempt"), "attempt").alias("l"))
    return last.select("key", F.col("l.text").isNotNull().alias("ok"), F.col("l.text").alias("text"), F.col("l.error").alias("error"), F.col("l.attempt").alias("attempts"))
