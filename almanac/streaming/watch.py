"""Watching by time: states that have lasted are told by timers, also when no further sample of their key comes.

A debounced directory watcher and a stall detector are the same machine: something (a fingerprint, a size)
has not changed for so many seconds. A key's state is what it is now, since when, and what was told
last; the change that ends it or a timer at the end of the wait tells it. A further sample of the same value tells
nothing: whether the wait is over is for the watermark to say. Samples of one micro-batch are gone through in the order of
their times with the timers between them, so the result doesn't depend on how a stream was cut into batches.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

#: Timers need this store of states; a query that watches is started under it.
PROVIDER = ("spark.sql.streaming.stateStore.providerClass", "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider")
OUTPUT = "key string, value string, since timestamp, told timestamp"
_MICRO = 1_000_000


def _time(us: int) -> pd.Timestamp:
    return pd.Timestamp(us, unit="us")


class Lasting(StatefulProcessor):
    """Tells each state of a key that lasted ``seconds``, once, unless it is the one told last."""

    def __init__(self, seconds: float, ttl: int | None):
        self.wait, self.ttl = int(seconds * _MICRO), ttl

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.now = handle.getValueState("now", "value string, since long, told string, ever boolean", self.ttl)

    def _told(self, key: tuple, value: str | None, since: int) -> tuple:
        return key[0], value, _time(since), _time(since + self.wait)

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:  # noqa: N802, N803
        value, since, last, ever = self.now.get() if self.now.exists() else (None, None, None, False)
        b = pd.concat(list(rows)).sort_values(["us", "place"], kind="stable")
        out = []
        for at, new in zip(b["us"].tolist(), b["value"].tolist(), strict=True):
            new = None if pd.isna(new) else new
            if since is not None and new == value:
                continue
            if since is not None and at >= since + self.wait and not (ever and value == last):
                out.append(self._told(key, value, since))
                last, ever = value, True
            value, since = new, at
        self.now.update((value, since, last, ever))
        for t in list(self.handle.listTimers()):
            self.handle.deleteTimer(t)
        if not (ever and value == last):
            self.handle.registerTimer(-(-(since + self.wait) // 1000))  # a timer goes off once the watermark is there
        yield pd.DataFrame(out, columns=["key", "value", "since", "told"])

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:  # noqa: N802, N803
        value, since, last, ever = self.now.get()
        out = []
        if not (ever and value == last):
            out.append(self._told(key, value, since))
            self.now.update((value, since, value, True))
        yield pd.DataFrame(out, columns=["key", "value", "since", "told"])

    def close(self) -> None:
        pass


def lasting(samples: DataFrame, key: str, value: str, ts: str, seconds: float, delay: str = "0 seconds", by_clock: bool = False, forget: dt.timedelta | None = None, order: str | None = None) -> DataFrame:
    """(key, value, since, told) of a stream: every state of a key that lasted ``seconds``, told at the end of that time.

    Time is the samples' own, as far as the watermark (``delay`` behind the latest sample of any key) has come; ``by_clock`` it is the
    clock's, so a state is told while nothing arrives at all. A state that is the last one told
    isn't told again when it comes back. With ``by_clock``, keys may be forgotten after a time without samples.
    Samples of one key and time come in the order of the column ``order``; without one their order is open.
    The watermark has whole milliseconds: an end within one is reached with the next.
    Start the query under ``PROVIDER``, as ``started`` does.
    """
    if forget is not None and not by_clock:
        raise ValueError("keys are forgotten by the clock only")
    at = F.current_timestamp() if by_clock else F.col(ts)
    rows = samples.withWatermark(ts, delay).select(F.col(key).cast("string").alias("key"), F.col(value).cast("string").alias("value"), F.unix_micros(at.cast("timestamp")).alias("us"), (F.col(order) if order else F.lit(0)).alias("place"), ts)
    p = Lasting(seconds, int(forget.total_seconds() * 1000) if forget else None)
    return rows.groupBy("key").transformWithStateInPandas(p, OUTPUT, "append", "processingTime" if by_clock else "eventTime")


def started(writer, spark: SparkSession):
    """A stream's writer started with the store of states that timers need; the session's own setting stays."""
    name, provider = PROVIDER
    before = spark.conf.get(name)
    spark.conf.set(name, provider)
    try:
        return writer.start()
    finally:
        spark.conf.set(name, before)
