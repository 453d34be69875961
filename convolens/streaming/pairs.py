"""Follow-up pairs over a stream of turns: late and shuffled turns wait in state, event-time timers release and end it.

The stream gives exactly the pairs of the batch (`operators.turns.pairs`), in whatever order turns arrive, as long as
a turn is at most `late` behind the newest one and a question follows its answer within `keep`. A turn that is later
than that is dropped by the watermark and counted by Spark (`numRowsDroppedByWatermark`). Of several rows with one
turn number the newest, then the greatest, is the answer; each repeated question is a pair of its own.

State holds, for a conversation, the turns of the last `keep` and the questions that the watermark has not passed,
so it is bounded by a conversation's rate and not by its length, and a conversation that ends leaves nothing.
"""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

OUT = "conv_id long, turn long, question string, answer string"
COLUMNS = [x.split()[0] for x in OUT.split(", ")]
STORE = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


class Pairing(StatefulProcessor):
    """Buffers a conversation's turns; a question is answered when the watermark has passed it."""

    def __init__(self, keep_ms: int):
        self.keep_ms = keep_ms

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.turns = handle.getMapState("turns", "turn long", "ms long, role string, text string")
        self.waiting = handle.getListState("waiting", "turn long, ms long, text string")

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        times, asked = set(), []
        for batch in rows:
            for turn, ms, role, text in zip(batch["turn"], batch["ms"], batch["role"], batch["text"], strict=True):
                turn, ms = int(turn), int(ms)
                before = tuple(self.turns.getValue((turn,))) if self.turns.containsKey((turn,)) else None
                if before is None or _order(before) < _order((ms, role, text)):
                    self.turns.updateValue((turn,), (ms, role, text))
                if role == "user":
                    asked.append((turn, ms, text))
                    times.add(ms)
                times.add(ms + self.keep_ms)
        if asked:
            self.waiting.appendList(asked)
        for ms in times:
            self.handle.registerTimer(ms)
        yield from ()

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        now = expiredTimerInfo.getExpiryTimeInMs()
        waiting = [tuple(x) for x in self.waiting.get()] if self.waiting.exists() else []
        ready = [x for x in waiting if x[1] <= now]
        found = []
        for turn, _, text in sorted(ready, key=lambda x: x[:2]):
            prior = self.turns.getValue((turn - 1,)) if self.turns.containsKey((turn - 1,)) else None
            if prior is not None and prior[1] == "assistant":
                found.append((key[0], turn, text, prior[2]))
        if ready:
            left = [x for x in waiting if x[1] > now]
            self.waiting.put(left) if left else self.waiting.clear()
        if self.turns.exists():
            for turn in [k[0] for k, v in self.turns.iterator() if v[0] + self.keep_ms <= now]:
                self.turns.removeKey((turn,))
        if found:
            yield pd.DataFrame(found, columns=COLUMNS)

    def close(self) -> None:
        pass


def _order(value: tuple) -> tuple:
    """Newest, then greatest; nulls first."""
    ms, role, text = value
    return ms, role is not None, role or "", text is not None, text or ""


def pairs(turns: DataFrame, time: str = "ts", late: str = "1 hour", keep_minutes: int = 24 * 60) -> DataFrame:
    """conv_id, turn, question, answer of streamed turns (conv_id, turn, role, text and an event time).

    Turns without a number or a time take no part. The state store is RocksDB, which timers and lists need.
    """
    turns.sparkSession.conf.set("spark.sql.streaming.stateStore.providerClass", STORE)
    rows = turns.where(F.col("turn").isNotNull() & F.col(time).isNotNull()).select("conv_id", "turn", "role", "text", F.col(time).cast("timestamp").alias("ts")).withWatermark("ts", late)
    rows = rows.withColumn("ms", F.unix_millis("ts"))
    return rows.groupBy("conv_id").transformWithStateInPandas(Pairing(keep_minutes * 60_000), OUT, "Append", "EventTime")
