"""Streams over append-only inputs. Each has a batch twin that must give the same rows.

A stream runs with `drain`: everything available goes through, then the query ends; the next run goes
on at its checkpoint. Rows reach a table in one of two ways that repeat no row after a restart: the
file sink's own log, or `epochs`, which overwrites the folder of a micro-batch it has seen before.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming.stateful_processor import ExpiredTimerInfo, StatefulProcessor, StatefulProcessorHandle, TimerValues

from cuelake.operators.ledger import BOUNDS, bounded, fits
from cuelake.operators.linking import speech_in_gaps

STORE = "spark.sql.streaming.stateStore.providerClass"
ROCKS = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


def drain(stream: DataFrame, checkpoint: str, path: str | None = None, mode: str = "append",
          batch: Callable[[DataFrame, int], None] | None = None) -> None:
    """Run a stream over what is there and wait; a failure is raised here. Sink: files, or `batch`."""
    spark = stream.sparkSession
    before = spark.conf.get(STORE)
    spark.conf.set(STORE, ROCKS)  # timers and map state need it
    try:
        writer = stream.writeStream.outputMode(mode).option("checkpointLocation", checkpoint).trigger(availableNow=True)
        query = writer.foreachBatch(batch).start() if batch else writer.format("parquet").option("path", path).start()
        query.awaitTermination()
    finally:
        spark.conf.set(STORE, before)


def epochs(path: str) -> Callable[[DataFrame, int], None]:
    """`foreachBatch` sink: one folder per micro-batch; a batch that runs again replaces its own rows."""
    def write(rows: DataFrame, epoch: int) -> None:
        rows.write.mode("overwrite").parquet(f"{path}/epoch={epoch}")

    return write


def read_epochs(spark: SparkSession, path: str, schema: str) -> DataFrame:
    return spark.read.schema(f"{schema}, epoch bigint").parquet(path)


def stream_event_counts(events: DataFrame, by: tuple[str, ...] = ("run_id",)) -> DataFrame:
    """Running counts per kind; write with `update` (or `complete`). Twin: `event_counts`."""
    return events.groupBy(*by, "kind").agg(F.count(F.lit(1)).alias("n"))


def latest_counts(rows: DataFrame, by: tuple[str, ...] = ("run_id",)) -> DataFrame:
    """The last count of every key among the epochs of an `update` stream."""
    return rows.groupBy(*by, "kind").agg(F.max_by("n", "epoch").alias("n"))


class CappedLedger(StatefulProcessor):
    """One authorization: totals accepted so far, and events that wait for their time slot to close."""

    def __init__(self, slot_ms: int):
        self.slot_ms = slot_ms

    def init(self, handle: StatefulProcessorHandle) -> None:
        longs = lambda prefix: ", ".join(f"{prefix}_{name} bigint" for name in BOUNDS)
        self.handle = handle
        self.totals = handle.getValueState("totals", longs("t"))
        self.waiting = handle.getMapState("waiting", "slot bigint", f"events array<struct<event_id: bigint, {longs('u').replace(' bigint', ': bigint')}, {longs('l').replace(' bigint', ': bigint')}>>")

    def handleInputRows(self, key: tuple, rows: Iterator[Row], timerValues: TimerValues) -> Iterator[Row]:
        held: dict[int, list[tuple]] = {}
        for row in rows:
            slot = row["at_ms"] // self.slot_ms
            held.setdefault(slot, []).append((row["event_id"], *[row[f"u_{n}"] for n in BOUNDS], *[row[f"l_{n}"] for n in BOUNDS]))
        for slot, events in held.items():
            old = self.waiting.getValue((slot,)) if self.waiting.exists() and self.waiting.containsKey((slot,)) else None
            if old is None:
                self.handle.registerTimer((slot + 1) * self.slot_ms)
            self.waiting.updateValue((slot,), ([*(tuple(e) for e in old[0]), *events] if old else events,))
        return iter(())

    def handleExpiredTimer(self, key: tuple, timerValues: TimerValues, expiredTimerInfo: ExpiredTimerInfo) -> Iterator[Row]:
        slot = expiredTimerInfo.getExpiryTimeInMs() // self.slot_ms - 1
        events = sorted(tuple(e) for e in self.waiting.getValue((slot,))[0])
        self.waiting.removeKey((slot,))
        total = list(self.totals.get()) if self.totals.exists() else [0] * len(BOUNDS)
        for event_id, *numbers in events:
            add, room = numbers[: len(BOUNDS)], numbers[len(BOUNDS) :]
            ok = fits(total, add, room)
            total = [t + a for t, a in zip(total, add, strict=True)] if ok else total
            yield Row(auth_id=key[0], event_id=event_id, accepted=ok)
        self.totals.update(tuple(total))

    def close(self) -> None:
        pass


def stream_ledger(events: DataFrame, limits: DataFrame, slot_ms: int = 60_000, lateness: str = "0 seconds") -> DataFrame:
    """Accept or reject reservations in arrival order, whatever order files and shuffles deliver.

    State per authorization: its totals, and the events of time slots that the watermark has not
    passed. A timer closes a slot: its events are decided by id and forgotten, so state holds the
    slots within `lateness` of the newest event only. An event later than that has no verdict (its
    slot is settled); its absence shows in an anti join. Event ids rise with `at`. Twin:
    `decide_reservations`. `events`: as there, and `at` (timestamp); `limits` is a static table.
    """
    rows = bounded(events.withWatermark("at", lateness), limits, "at").withColumn("at_ms", F.unix_millis("at"))
    return rows.groupBy("auth_id").transformWithState(CappedLedger(slot_ms), "auth_id bigint, event_id bigint, accepted boolean", "append", "eventTime")


def refresh_gaps(cues: DataFrame, sink: Callable[[DataFrame, int], None]) -> Callable[[DataFrame, int], None]:
    """`foreachBatch` handler: new observations become gap questions for their own tracks only.

    The cue side is cut down to the tracks of the micro-batch by a semi join before the interval
    join, so a batch costs what its tracks cost. With `epochs` as sink a repeated batch adds nothing.
    """
    def handle(batch: DataFrame, epoch: int) -> None:
        touched = batch.select("track_id").distinct()
        sink(speech_in_gaps(batch, cues.join(touched, "track_id", "left_semi")), epoch)

    return handle
