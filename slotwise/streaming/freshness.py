"""Freshness of each kind while the stream runs: states that change when nothing arrives.

A query on stored rows can only tell how old they are when it is asked. Here every kind has a keyed state with its
newest arrival and timers on the clock: a silent kind turns slow, then stale, in a micro-batch that no row has
caused. Kinds that are expected but were never seen are `unknown`, which is not stale.
"""

from __future__ import annotations

import os
from collections.abc import Iterator

import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.streaming.stateful_processor import StatefulProcessor, StatefulProcessorHandle

from slotwise.schemas import FRESH_SECONDS, STALE_SECONDS
from slotwise.session import ship_package

CHANGES = "kind string, state string, at_ms bigint, newest_ms bigint"
# Keyed timers need the store that keeps state on disk.
STATE_STORE = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


def arrivals(updates: DataFrame) -> DataFrame:
    """(kind, newest_ms, n) of each piece of a batch: what a task has read is combined before it is sent to the state of its kind."""

    def combined(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = pa.table(batch.columns, names=batch.schema.names).group_by("kind").aggregate([("ms", "max"), ("ms", "count")])
            out = [found.column("kind"), pc.cast(found.column("ms_max"), pa.int64()), found.column("ms_count")]
            yield from pa.table(out, names=["kind", "newest_ms", "n"]).to_batches()

    rows = updates.select("kind", F.unix_millis(F.col("ingested_at").cast("timestamp")).alias("ms")).filter("kind is not null and ms is not null")
    return rows.mapInArrow(combined, "kind string, newest_ms bigint, n bigint")


class Freshness(StatefulProcessor):
    """State of one kind: newest arrival and the name of the state that was last reported."""

    def __init__(self, fresh_seconds: float, stale_seconds: float):
        self.fresh_ms, self.stale_ms = int(fresh_seconds * 1000), int(stale_seconds * 1000)

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.known = handle.getValueState("known", "newest_ms bigint, arrived_ms bigint, state string")

    def handleInitialState(self, key, initialState, timerValues) -> None:
        """An expected kind: `unknown` unless a row arrives first. The timer lets the report come out with the next batch."""
        if not self.known.exists():
            self.handle.registerTimer(timerValues.getCurrentProcessingTimeInMs() + 1)

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        now = timerValues.getCurrentProcessingTimeInMs()
        newest = max(int(part["newest_ms"].max()) for part in rows)
        before = self.known.get() if self.known.exists() else None
        newest = newest if before is None or before[0] is None else max(newest, before[0])
        for timer in list(self.handle.listTimers()):
            self.handle.deleteTimer(timer)
        self.handle.registerTimer(now + self.fresh_ms)
        self.handle.registerTimer(now + self.stale_ms)
        yield from self._report(key, "fresh", now, newest, now, before)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        now = timerValues.getCurrentProcessingTimeInMs()
        before = self.known.get() if self.known.exists() else None
        if before is None:
            yield from self._report(key, "unknown", now, None, None, None)
            return
        # Told by the timer, not by the clock: a late batch still reports both steps, in their order.
        due = expiredTimerInfo.getExpiryTimeInMs() - before[1]
        yield from self._report(key, "stale" if due >= self.stale_ms else "slow", now, before[0], before[1], before)

    def _report(self, key, state, now, newest, arrived, before) -> Iterator[pd.DataFrame]:
        if state != "unknown":
            self.known.update((newest, arrived, state))
        if before is None or before[2] != state:
            yield pd.DataFrame({"kind": [key[0]], "state": [state], "at_ms": [now], "newest_ms": pd.array([newest], dtype="Int64")})

    def close(self) -> None:
        pass


def freshness_changes(updates: DataFrame, expected: list[str], fresh_seconds: float = FRESH_SECONDS, stale_seconds: float = STALE_SECONDS) -> DataFrame:
    """A streaming frame of state changes: kind, state (fresh, slow, stale, unknown), when, and the newest arrival."""
    spark = updates.sparkSession
    ship_package(spark)
    seeds = spark.createDataFrame([(k, 0) for k in expected], "kind string, seed int").groupBy("kind")
    return arrivals(updates).groupBy("kind").transformWithStateInPandas(
        Freshness(fresh_seconds, stale_seconds), outputStructType=CHANGES, outputMode="Append", timeMode="ProcessingTime", initialState=seeds
    )


def start_freshness_watch(
    updates: DataFrame, root: str, expected: list[str], fresh_seconds: float = FRESH_SECONDS, stale_seconds: float = STALE_SECONDS, every: str = "10 seconds"
) -> StreamingQuery:
    """Record the changes below `root`, beside the offsets that a restart goes on from."""
    spark = updates.sparkSession
    spark.conf.set("spark.sql.streaming.stateStore.providerClass", STATE_STORE)
    changes = freshness_changes(updates, expected, fresh_seconds, stale_seconds)
    writer = changes.writeStream.format("parquet").outputMode("append").option("path", os.path.join(root, "freshness"))
    return writer.option("checkpointLocation", os.path.join(root, "_freshness_offsets")).trigger(processingTime=every).start()


def has_changes(spark: SparkSession, root: str) -> bool:
    """Whether a batch has been recorded yet."""
    place = spark._jvm.org.apache.hadoop.fs.Path(os.path.join(root, "freshness", "_spark_metadata"))
    return place.getFileSystem(spark._jsc.hadoopConfiguration()).exists(place)


def read_changes(spark: SparkSession, root: str) -> DataFrame:
    """All recorded changes."""
    return spark.read.schema(CHANGES).parquet(os.path.join(root, "freshness"))


def current_states(spark: SparkSession, root: str) -> DataFrame:
    """The newest state of each kind."""
    newest = F.max_by(F.struct("state", "at_ms", "newest_ms"), F.struct("at_ms", F.expr("array_position(array('unknown', 'fresh', 'slow', 'stale'), state)"))).alias("s")
    return read_changes(spark, root).groupBy("kind").agg(newest).select("kind", "s.*")
