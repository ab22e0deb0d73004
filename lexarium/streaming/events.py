"""Streams of events and documents: first-seen ids, windows, sessions, circuit breakers, gates, idempotent loads.

Each operator takes a streaming (or static) DataFrame and gives one; ``start`` runs it against a sink with a checkpoint.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle, StreamingQuery, StreamingQueryListener

from ..operators import blockwise, ingest


def timed(rows: DataFrame, time: str) -> DataFrame:
    """A stream with an event time that watermarks take: one without a zone reads in the session's."""
    if rows.isStreaming and rows.schema[time].dataType.typeName() == "timestamp_ntz":
        return rows.withColumn(time, F.col(time).cast("timestamp"))
    return rows


def first_seen(rows: DataFrame, key: list[str], time: str, late: str = "1 day") -> DataFrame:
    """The first row of each key; a key's state is kept as long as rows may be late."""
    return timed(rows, time).withWatermark(time, late).dropDuplicatesWithinWatermark(key)


def tumbling(events: DataFrame, by: list[str], time: str = "ts", width: str = "1 hour", late: str = "10 minutes", slide: str | None = None) -> DataFrame:
    """Counts and sums of value by window (sliding with ``slide``) and key."""
    n = timed(events, time).withWatermark(time, late).groupBy(F.window(time, width, slide), *by).agg(F.count("*").alias("n"), F.sum("value").alias("total"))
    return n.select(F.col("window.start").alias("window_start"), F.col("window.end").alias("window_end"), *by, "n", "total")


def sessions(events: DataFrame, by: list[str], time: str = "ts", gap: str = "30 minutes", late: str = "10 minutes") -> DataFrame:
    """Counts by session: events of a key less than ``gap`` apart."""
    n = timed(events, time).withWatermark(time, late).groupBy(F.session_window(time, gap), *by).agg(F.count("*").alias("n"))
    return n.select(F.col("session_window.start").alias("session_start"), F.col("session_window.end").alias("session_end"), *by, "n")


def filings(discovered: DataFrame, downloaded: DataFrame, key: list[str], time: str = "detected_at", within: str = "7 days", late: str = "1 day") -> DataFrame:
    """(key, detected_at, downloaded_at) of each filing that was discovered: null if no download came ``within`` that time of it.

    A filing that is discovered, or downloaded, again within the time that rows may be late counts once. A filing without a download
    comes out when the watermark, the lesser of both streams', has passed its time; so state is kept for ``within`` + ``late`` and no
    longer. Rows later than that are dropped, and counted by ``LateRows``. Rows with a null in the key or the time are left out.
    """
    whole = lambda rows: rows.select(*key, time).dropna().withColumn(time, F.col(time).cast("timestamp"))
    left = whole(discovered).withWatermark(time, late).dropDuplicatesWithinWatermark(key)
    right = whole(downloaded).select(*(F.col(k).alias(f"{k}_r") for k in key), F.col(time).alias("downloaded_at")).withWatermark("downloaded_at", late).dropDuplicatesWithinWatermark([f"{k}_r" for k in key])
    same = F.expr(f"downloaded_at >= {time} AND downloaded_at <= {time} + INTERVAL {within}")
    for k in key:
        same = same & (F.col(k) == F.col(f"{k}_r"))
    return left.join(right, same, "left_outer").select(*key, time, "downloaded_at")


class LateRows(StreamingQueryListener):
    """Counts, by query id, the rows that were too late for the state of an operator. ``spark.streams.addListener`` takes it."""

    def __init__(self) -> None:
        self.dropped: dict[str, int] = {}

    def onQueryStarted(self, event) -> None:
        self.dropped.setdefault(str(event.id), 0)

    def onQueryProgress(self, event) -> None:
        p = event.progress
        self.dropped[str(p.id)] = self.dropped.get(str(p.id), 0) + sum(s.numRowsDroppedByWatermark for s in p.stateOperators)

    def onQueryIdle(self, event) -> None: ...

    def onQueryTerminated(self, event) -> None: ...


PAUSE, ABORT = 1, 2


def trips(bad: np.ndarray, in_a_row: int, in_all: int, pause: int, abort: int, total: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Failures in a row and in all at each outcome, from those before, up to the one that aborts; and what is done there: PAUSE, ABORT or nothing (0)."""
    at = np.arange(len(bad))
    last_good = np.maximum.accumulate(np.where(bad, -1, at))
    row = np.where(last_good < 0, at + 1 + in_a_row, at - last_good)
    all_ = in_all + np.cumsum(bad)
    over = np.flatnonzero((row >= abort) | (all_ >= total))
    n = int(over[0]) + 1 if len(over) else len(bad)
    action = np.where((row > 0) & (row % pause == 0), PAUSE, 0)[:n]
    if len(over):
        action[-1] = ABORT
    return row[:n], all_[:n], action


class Breaker(StatefulProcessor):
    """For each key the run of failures in a row and in all: pause at ``pause`` in a row, abort at ``abort`` in a row or ``total`` in all."""

    def __init__(self, key: str, order: str, failed: str, pause: int, abort: int, total: int):
        self.key, self.order, self.failed, self.limits = key, order, failed, (pause, abort, total)

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.state = handle.getValueState("run", "in_a_row int, in_all int, tripped boolean")

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        in_a_row, in_all, tripped = self.state.get() if self.state.exists() else (0, 0, False)
        if not tripped:
            # a batch's rows of a key come in no order, so its two columns are put in order first
            own = pd.concat([r[[self.order, self.failed]] for r in rows]).sort_values(self.order, kind="stable")
            row, all_, action = trips(own[self.failed].fillna(False).to_numpy(bool), in_a_row, in_all, *self.limits)
            told = np.flatnonzero(action)
            if len(told):
                names = np.where(action[told] == ABORT, "abort", "pause")
                yield pd.DataFrame({self.key: key[0], self.order: own[self.order].to_numpy()[told], "action": names, "in_a_row": row[told].astype(np.int32), "in_all": all_[told].astype(np.int32)})
            in_a_row, in_all, tripped = int(row[-1]), int(all_[-1]), bool(len(told) and action[told[-1]] == ABORT)
        self.state.update((in_a_row, in_all, tripped))

    def close(self) -> None:
        pass


def breaker(events: DataFrame, key: str, order: str, failed: str, pause: int = 3, abort: int = 8, total: int = 10**9) -> DataFrame:
    """(key, order, action, in_a_row, in_all): what a breaker does on a stream of outcomes."""
    kinds = {f.name: f.dataType.simpleString() for f in events.schema}
    schema = f"{key} {kinds[key]}, {order} {kinds[order]}, action string, in_a_row int, in_all int"
    return events.select(key, order, failed).groupBy(key).transformWithStateInPandas(Breaker(key, order, failed, pause, abort, total), outputStructType=schema, outputMode="append", timeMode="none")


def breaker_rows(events: DataFrame, key: str, order: list[str], failed: str, pause: int = 3, abort: int = 8, total: int = 10**9) -> DataFrame:
    """The same of a static table: a run of failures starts after each success. Running values are taken in blocks, so no key is one task."""
    bad = F.col(failed).cast("int")
    rows = blockwise.with_block(events, [key], order[0])
    rows = blockwise.running(rows, [key], order, in_all=("sum", bad))
    rows = blockwise.running(rows, [key], order, good_=("max", F.when(bad == 0, F.col("in_all"))))  # failures up to the last success
    rows = rows.withColumn("in_a_row", F.col("in_all") - F.coalesce("good_", F.lit(0)))
    rows = rows.withColumn("trip_", ((F.col("in_a_row") >= abort) | (F.col("in_all") >= total)).cast("int"))
    rows = blockwise.running(rows, [key], order, trips_=("sum", F.col("trip_")))
    action = F.when(F.col("trip_") == 1, "abort").when((F.col("in_a_row") > 0) & (F.col("in_a_row") % pause == 0), "pause")
    rows = rows.where((F.col("trips_") == 0) | ((F.col("trips_") == 1) & (F.col("trip_") == 1))).withColumn("action", action).where("action IS NOT NULL")
    return rows.select(key, *order, "action", F.col("in_a_row").cast("int").alias("in_a_row"), F.col("in_all").cast("int").alias("in_all"))


def gate(rows: DataFrame, by: str, order: list[str], zero: str, first: int = 50, most: int = 5, after: int = 100, share: float = 0.1) -> DataFrame:
    """(by, order, seen, zeroes): the first row of each key at which too many of its rows are zero: over ``most`` among the first ``first``, or over ``share`` after ``after``."""
    own = blockwise.running(blockwise.with_block(rows, [by], order[0]), [by], order, seen=("sum", F.lit(1).cast("long")), zeroes=("sum", F.col(zero).cast("long")))
    bad = own.where(((F.col("seen") <= first) & (F.col("zeroes") > most)) | ((F.col("seen") >= after) & (F.col("zeroes") / F.col("seen") > share)))
    return bad.groupBy(by).agg(F.min(F.struct("seen", *order, "zeroes")).alias("b")).select(by, *(F.col(f"b.{c}") for c in order), "b.seen", "b.zeroes")


class Gate(StatefulProcessor):
    """For each key how many rows and zeroes it has had; tells once of the first row at which there are too many."""

    def __init__(self, key: str, order: str, zero: str, first: int, most: int, after: int, share: float):
        self.key, self.order, self.zero, self.first, self.most, self.after, self.share = key, order, zero, first, most, after, share

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.state = handle.getValueState("gate", "seen long, zeroes long, shut boolean")

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        seen, zeroes, shut = self.state.get() if self.state.exists() else (0, 0, False)
        if shut:
            return
        own = pd.concat([r[[self.order, self.zero]] for r in rows]).sort_values(self.order, kind="stable")
        n = seen + np.arange(1, len(own) + 1)
        z = zeroes + np.cumsum(own[self.zero].fillna(0).to_numpy(np.int64))
        bad = np.flatnonzero(((n <= self.first) & (z > self.most)) | ((n >= self.after) & (z / n > self.share)))
        self.state.update((int(n[-1]), int(z[-1]), bool(len(bad))))
        if len(bad):
            k = bad[0]
            yield pd.DataFrame({self.key: key[0], self.order: own[self.order].to_numpy()[k : k + 1], "seen": n[k : k + 1], "zeroes": z[k : k + 1]})

    def close(self) -> None:
        pass


def gate_stream(rows: DataFrame, by: str, order: str, zero: str, first: int = 50, most: int = 5, after: int = 100, share: float = 0.1) -> DataFrame:
    """What ``gate`` finds, of a stream whose batches come in order: (by, order, seen, zeroes) once a key, across batches and restarts."""
    kinds = {f.name: f.dataType.simpleString() for f in rows.schema}
    schema = f"{by} {kinds[by]}, {order} {kinds[order]}, seen long, zeroes long"
    return rows.select(by, order, F.col(zero).cast("int").alias(zero)).groupBy(by).transformWithStateInPandas(Gate(by, order, zero, first, most, after, share), outputStructType=schema, outputMode="append", timeMode="none")


class Pauses(StatefulProcessor):
    """Rows of a key pass until ``pause`` failures in a row; then the key is held for some time, by a timer, and its rows are kept in
    order. When the time is over they are let go (or, with ``skip``, told as skipped when they came), and the count starts again."""

    def __init__(self, key: str, order: str, failed: str, pause: int, hold_ms: int, skip: bool):
        self.key, self.order, self.failed, self.pause, self.hold, self.skip = key, order, failed, pause, hold_ms, skip

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.run = handle.getValueState("run", "in_a_row int, until long")
        self.kept = handle.getListState("kept", "at string, failed boolean")

    def _told(self, key, rows: list[tuple[str, bool]], actions: list[str]) -> pd.DataFrame:
        return pd.DataFrame({self.key: [key[0]] * len(rows), self.order: [a for a, _ in rows], "action": actions})

    def _pass(self, key, rows: list[tuple[str, bool]], in_a_row: int, now: int) -> pd.DataFrame:
        """Lets rows go until one makes the pause; the others are kept or skipped."""
        done, actions = [], []
        for k, (at, bad) in enumerate(rows):
            done.append((at, bad))
            in_a_row = in_a_row + 1 if bad else 0
            actions.append("passed")
            if in_a_row >= self.pause:
                actions[-1] = "paused"
                until = now + self.hold
                self.handle.registerTimer(until)
                self.run.update((0, until))
                rest = rows[k + 1 :]
                if self.skip:
                    done, actions = done + rest, actions + ["skipped"] * len(rest)
                elif rest:
                    self.kept.put(rest)
                return self._told(key, done, actions)
        self.run.update((in_a_row, 0))
        return self._told(key, done, actions)

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        own = pd.concat([r[[self.order, self.failed]] for r in rows]).sort_values(self.order, kind="stable")
        pairs = [(str(a), bool(b)) for a, b in zip(own[self.order], own[self.failed].fillna(False), strict=True)]
        in_a_row, until = self.run.get() if self.run.exists() else (0, 0)
        if not until:
            yield self._pass(key, pairs, in_a_row, timerValues.getCurrentProcessingTimeInMs())
        elif self.skip:
            yield self._told(key, pairs, ["skipped"] * len(pairs))
        else:
            self.kept.appendList(pairs)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        waiting = [(a, b) for a, b in self.kept.get()] if self.kept.exists() else []
        self.kept.clear()
        self.run.update((0, 0))
        if waiting:
            yield self._pass(key, waiting, 0, timerValues.getCurrentProcessingTimeInMs())

    def close(self) -> None:
        pass


def pauses(events: DataFrame, key: str, order: str, failed: str, pause: int = 3, hold_seconds: float = 60.0, skip: bool = False) -> DataFrame:
    """(key, order as string, action) for each row: passed; paused, for the failure that makes its key wait ``hold_seconds``; skipped, for
    a row that came meanwhile, with ``skip``; without it such rows wait in state and go, in order, when the timer ends the pause.

    A row that waits is in the checkpoint, so a restart neither loses nor repeats it. One key's rows of a batch are put in order in memory.
    """
    schema = f"{key} {dict(events.dtypes)[key]}, {order} string, action string"
    own = Pauses(key, order, failed, pause, int(hold_seconds * 1000), skip)
    return events.select(key, order, failed).groupBy(key).transformWithStateInPandas(own, outputStructType=schema, outputMode="append", timeMode="ProcessingTime")


def load_new(rows: DataFrame, table: str, key: list[str], checkpoint: str) -> StreamingQuery:
    """Appends each key once, whatever is sent again or replayed."""

    def load(batch: DataFrame, _: int) -> None:
        ingest.append_new(batch, table, key)

    return rows.writeStream.foreachBatch(load).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def start(rows: DataFrame, name: str, mode: str = "append", checkpoint: str | None = None) -> StreamingQuery:
    """Runs what is there into a table in memory; for tests and looks."""
    writer = rows.writeStream.format("memory").queryName(name).outputMode(mode).trigger(availableNow=True)
    return (writer.option("checkpointLocation", checkpoint) if checkpoint else writer).start()


class Progress(StreamingQueryListener):
    """Calls ``tell`` with a telemetry event for each start, batch and end of a query."""

    def __init__(self, tell: Callable[[dict], None]):
        self.tell = tell

    def onQueryStarted(self, event) -> None:
        self.tell({"run_id": str(event.runId), "step": event.name or "query", "status": "started"})

    def onQueryProgress(self, event) -> None:
        p = event.progress
        self.tell({"run_id": str(p.runId), "step": p.name or "query", "status": "running", "duration_ms": p.batchDuration, "rows": p.numInputRows})

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryTerminated(self, event) -> None:
        self.tell({"run_id": str(event.runId), "step": "query", "status": "failed" if event.exception else "success", "error_message": event.exception})
