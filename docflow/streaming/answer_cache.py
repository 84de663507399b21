"""A bounded answer cache as stream state: least recently used entries go first, and answers grow old.

Each shard of prompts (a hash of the prompt, or a column such as the model's name) holds at most ``capacity`` answers. A prompt is
found if its answer was stored at most ``ttl_ms`` before; finding it makes it the most recent, without making it younger. A prompt
that isn't found is asked, its answer stored as the most recent, and the least recent ones beyond the capacity are dropped. Blank
or failed answers aren't stored. Time is that of the rows (``ts``), so a replay gives the same hits; timers drop old answers
of prompts that never come again, once the watermark has passed them.

State survives restarts in the query's checkpoint. It needs the RocksDB state store, as Spark asks for such state:
``spark.sql.streaming.stateStore.providerClass`` = ``PROVIDER``.
"""

from __future__ import annotations

from collections import OrderedDict
from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming.stateful_processor import StatefulProcessor, StatefulProcessorHandle

PROVIDER = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
#: Answers kept, and for how long.
CAPACITY, TTL_MS = 128, 900_000


class _Cache(StatefulProcessor):
    def __init__(self, make: Callable, capacity: int, ttl_ms: int):
        self.make, self.capacity, self.ttl_ms = make, capacity, ttl_ms

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle, self.model = handle, self.make()
        # Entries carry the number of their last use; ``uses`` has the last number given.
        self.entries = handle.getMapState("entries", "prompt string", "text string, stored long, used long")
        self.uses = handle.getValueState("uses", "n long")

    def _held(self) -> OrderedDict[str, tuple[str, int, int]]:
        """The shard's entries, at most as many as it holds, least recent first."""
        found = [(k[0], tuple(v)) for k, v in self.entries.iterator()] if self.entries.exists() else []
        return OrderedDict(sorted(found, key=lambda e: e[1][2]))

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:  # noqa: N802, N803
        before = self._held()
        held, uses = OrderedDict(before), self.uses.get()[0] if self.uses.exists() else 0
        for part in rows:
            out = []
            for number, prompt, ts in part.sort_values(["ts", "id"])[["id", "prompt", "ts"]].itertuples(index=False):
                now, entry, uses = int(ts.value // 1_000_000), held.get(prompt), uses + 1
                if entry and now - entry[1] > self.ttl_ms:
                    del held[prompt]
                    entry = None
                if entry:
                    held[prompt] = (*entry[:2], uses)
                    held.move_to_end(prompt)
                    text = entry[0]
                else:
                    text = self._asked(prompt)
                    if text:
                        held[prompt] = (text, now, uses)
                        held.move_to_end(prompt)
                        while len(held) > self.capacity:
                            held.popitem(last=False)
                out.append((number, prompt, text, entry is not None))
            yield pd.DataFrame(out, columns=["id", "prompt", "text", "cached"])
        for prompt in before.keys() - held.keys():
            self.entries.removeKey((prompt,))
        for prompt, entry in held.items():
            if before.get(prompt) != entry:
                self.entries.updateValue((prompt,), entry)
            if prompt not in before or before[prompt][1] != entry[1]:
                self.handle.registerTimer(entry[1] + self.ttl_ms + 1)
        self.uses.update((uses,))

    def _asked(self, prompt: str) -> str | None:
        try:
            return (self.model(prompt) or "").strip() or None
        except Exception:  # noqa: BLE001  a failed call is an answer that isn't there
            return None

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:  # noqa: N802, N803
        now = expiredTimerInfo.getExpiryTimeInMs()
        for prompt, entry in self._held().items():
            if now - entry[1] > self.ttl_ms:
                self.entries.removeKey((prompt,))
        yield pd.DataFrame({"id": pd.Series(dtype="int64"), "prompt": pd.Series(dtype="str"), "text": pd.Series(dtype="str"), "cached": pd.Series(dtype="bool")})

    def close(self) -> None:
        pass


def lru_answers(prompts: DataFrame, make: Callable, capacity: int = CAPACITY, ttl_ms: int = TTL_MS, shards: int = 64, by: str | None = None, late: str = "10 minutes") -> DataFrame:
    """(id, prompt, text, cached) of a stream (id, ts, prompt): each prompt's answer, and whether the cache had it.

    ``by`` names the column that has a cache of its own for each value; without it, prompts are dealt out over ``shards`` caches
    by hash, so that no cache meets all rows in one task. Rows that arrive together are taken in order of time and id.
    """
    shard = F.col(by).cast("string") if by else F.pmod(F.xxhash64("prompt"), F.lit(shards)).cast("string")
    keyed = prompts.select(shard.alias("shard"), F.col("id").cast("long").alias("id"), F.col("ts").cast("timestamp").alias("ts"), "prompt").where("ts is not null and prompt is not null")
    return keyed.withWatermark("ts", late).groupBy("shard").transformWithStateInPandas(statefulProcessor=_Cache(make, capacity, ttl_ms), outputStructType="id long, prompt string, text string, cached boolean", outputMode="Append", timeMode="EventTime")
