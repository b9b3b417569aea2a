"""Batches that end by their number of rows or by silence, as state of a stream.

Rows wait in buffers, each a key of the state, dealt by a column's digest so that no buffer is the only one. A buffer is passed on as
soon as it has `most` rows, in groups of that size, and what is left once no row has come for `silence_ms`. Rows that wait when the
stream stops are in its checkpoint: they are passed on after it starts again. Timers are looked at with each trigger, so the
trigger's interval is the shortest silence that can be told.
"""

from __future__ import annotations

from collections.abc import Iterator

from pyspark.sql import DataFrame, Row
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

#: What a stream with such batches needs of its session.
STATE_STORE = {"spark.sql.streaming.stateStore.providerClass": "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"}


class Buffer(StatefulProcessor):
    def __init__(self, columns: list[str], schema: T.StructType, most: int, silence_ms: int):
        self.columns, self.schema, self.most, self.silence_ms = columns, schema, most, silence_ms

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.waiting = handle.getListState("waiting", self.schema)
        self.flushes = handle.getValueState("flushes", T.StructType([T.StructField("n", T.LongType())]))

    def _passed(self, key: tuple, rows: list[tuple], why: str) -> Iterator[Row]:
        n = (self.flushes.get()[0] if self.flushes.exists() else 0) + 1
        self.flushes.update((n,))
        for r in rows:
            yield Row(**dict(zip(self.columns, r, strict=True)), buffer=key[0], flush=n, flushed=why)

    def handleInputRows(self, key: tuple, rows: Iterator[Row], timerValues) -> Iterator[Row]:
        held = [tuple(r) for r in self.waiting.get()] if self.waiting.exists() else []
        for r in rows:
            held.append(tuple(r[c] for c in self.columns))
            if len(held) >= self.most:
                yield from self._passed(key, held, "size")
                held = []
        for at in list(self.handle.listTimers()):
            self.handle.deleteTimer(at)
        if held:
            self.waiting.put(held)
            self.handle.registerTimer(timerValues.getCurrentProcessingTimeInMs() + self.silence_ms)
        else:
            self.waiting.clear()

    def handleExpiredTimer(self, key: tuple, timerValues, expiredTimerInfo) -> Iterator[Row]:
        held = [tuple(r) for r in self.waiting.get()] if self.waiting.exists() else []
        self.waiting.clear()
        if held:
            yield from self._passed(key, held, "silence")

    def close(self) -> None:
        pass


def batched(rows: DataFrame, most: int = 100, silence_ms: int = 50, by: str = "message_id", buffers: int = 16) -> DataFrame:
    """A stream's rows with buffer, flush (a number, rising in each buffer) and flushed (size or silence), as their batch is passed on. At most
    `most` rows have one buffer and flush."""
    out = T.StructType([*rows.schema.fields, *T._parse_datatype_string("buffer int, flush long, flushed string").fields])
    keyed = rows.withColumn("buffer", F.pmod(F.xxhash64(by), F.lit(buffers)).cast("int"))
    return keyed.groupBy("buffer").transformWithState(
        statefulProcessor=Buffer(rows.columns, rows.schema, most, silence_ms), outputStructType=out, outputMode="Append", timeMode="ProcessingTime"
    )
