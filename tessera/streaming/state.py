"""Keyed state with timers: contiguous runs, cursors of sources, and one active run of a job.

Each is a processor over one key's rows; its state is kept by Spark beside the query's checkpoint, so a
query that is killed goes on where its last finished batch ended. A key's rows of one batch are put in
order in a task; how many that can be is bounded by the files of a trigger. Rows of later batches
must come after those of earlier ones, as lines of a growing file do.
"""

from __future__ import annotations

import contextlib
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from tessera.streaming import events

PROVIDER = "spark.sql.streaming.stateStore.providerClass"
ROCKS = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


def _whole(rows: Iterator[pd.DataFrame], *order: str) -> pd.DataFrame:
    return pd.concat(list(rows), ignore_index=True).sort_values(list(order), kind="stable")


class Runs(StatefulProcessor):
    """(key, kind, first, run, closed): runs of rows of one kind. A run is closed when another kind comes, or nothing for ``idle`` milliseconds of events.

    The run that is still open at the end of a batch is told too, not closed.
    """

    def __init__(self, idle: int) -> None:
        self.idle = idle

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle, self.now = handle, handle.getValueState("now", "kind string, first bigint, run bigint, last timestamp")

    def _told(self, key: tuple, runs: list[tuple]) -> pd.DataFrame:
        return pd.DataFrame([(*key, *r) for r in runs], columns=["key", "kind", "first", "run", "closed"])

    def handleInputRows(self, key, rows, timerValues):
        kind, first, run, last = self.now.get() if self.now.exists() else (None, None, 0, None)
        out = []
        for r in _whole(rows, "ord").itertuples():
            if run and r.kind != kind:
                out.append((kind, first, run, True))
                run = 0
            if not run:
                kind, first = r.kind, r.ord
            run, last = run + 1, r.ts
        self.now.update((kind, first, run, last))
        for at in self.handle.listTimers():
            self.handle.deleteTimer(at)
        self.handle.registerTimer(int(last.timestamp() * 1000) + self.idle)
        yield self._told(key, [*out, (kind, first, run, False)])

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo):
        if self.now.exists():
            kind, first, run, _ = self.now.get()
            self.now.clear()
            yield self._told(key, [(kind, first, run, True)])


class Cursors(StatefulProcessor):
    """(key, cursor, rows): pages of a source that go beyond its cursor; a page that comes again, or late, is left out."""

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.at = handle.getValueState("at", "cursor bigint")

    def handleInputRows(self, key, rows, timerValues):
        at, out = self.at.get()[0] if self.at.exists() else None, []
        for r in _whole(rows, "cursor").itertuples():
            if at is None or r.cursor > at:
                at = r.cursor
                out.append((*key, r.cursor, r.rows))
        self.at.update((at,))
        yield pd.DataFrame(out, columns=["key", "cursor", "rows"])


class OneRun(StatefulProcessor):
    """(key, run, verdict): of a job's starts and ends, in order: ``started``, ``refused`` while another run is active, ``ended``, ``unknown``, ``expired``.

    A run that doesn't end within its lease (milliseconds of events) expires, and the next may start.
    """

    def __init__(self, lease: int) -> None:
        self.lease = lease

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle, self.active = handle, handle.getValueState("active", "run string, until bigint")

    def _release(self) -> None:
        self.active.clear()
        for at in self.handle.listTimers():
            self.handle.deleteTimer(at)

    def handleInputRows(self, key, rows, timerValues):
        out = []
        for r in _whole(rows, "ts", "run").itertuples():
            now, (run, until) = int(r.ts.timestamp() * 1000), self.active.get() if self.active.exists() else (None, 0)
            if run is not None and now >= until:
                out.append((*key, run, "expired"))
                self._release()
                run = None
            if r.what == "start" and run is None:
                self.active.update((r.run, now + self.lease))
                self.handle.registerTimer(now + self.lease)
                out.append((*key, r.run, "started"))
            elif r.what == "start":
                out.append((*key, r.run, "refused"))
            elif r.run == run:
                self._release()
                out.append((*key, r.run, "ended"))
            else:
                out.append((*key, r.run, "unknown"))
        yield pd.DataFrame(out, columns=["key", "run", "verdict"])

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo):
        if self.active.exists():
            run, until = self.active.get()
            if until <= expiredTimerInfo.getExpiryTimeInMs():
                self._release()
                yield pd.DataFrame([(*key, run, "expired")], columns=["key", "run", "verdict"])


def runs(stream: DataFrame, idle: int = 6 * 3_600_000, late: str = "0 seconds") -> DataFrame:
    """Of a stream (key, kind, ord, ts)."""
    key = stream.schema["key"].dataType.simpleString()
    return stream.withWatermark("ts", late).groupBy("key").transformWithStateInPandas(Runs(idle), f"key {key}, kind string, first bigint, run bigint, closed boolean", "Append", "EventTime")


def cursors(stream: DataFrame) -> DataFrame:
    """Of a stream (key, cursor, rows)."""
    return stream.groupBy("key").transformWithStateInPandas(Cursors(), "key string, cursor bigint, rows bigint", "Append", "None")


def one_run(stream: DataFrame, lease: int, late: str = "0 seconds") -> DataFrame:
    """Of a stream (key, run, what, ts)."""
    return stream.withWatermark("ts", late).groupBy("key").transformWithStateInPandas(OneRun(lease), "key string, run string, verdict string", "Append", "EventTime")


@contextlib.contextmanager
def kept_state(spark: SparkSession) -> Iterator[None]:
    """State with timers needs the store on disk; the session's own choice comes back afterwards."""
    before = spark.conf.get(PROVIDER)
    spark.conf.set(PROVIDER, ROCKS)
    try:
        yield
    finally:
        spark.conf.set(PROVIDER, before)


def drain_to(stream: DataFrame, checkpoint: str, path: str) -> DataFrame:
    """Works off what has come, appends it to a table of files, and reads that table."""
    with kept_state(stream.sparkSession):
        events.drain_to(stream, checkpoint, path)
    return stream.sparkSession.read.schema(stream.schema).parquet(path)
