"""Live figures over the stream."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from slotwise.functions.verdicts import payload_shape
from slotwise.operators.rows import side_by_side
from slotwise.plans.activity import flow_column
from slotwise.schemas import DECODED_KINDS, MILLIS_PER_SLOT
from slotwise.streaming.ingest import read_batches, run_of


def flow_by_minute(updates: DataFrame, kinds=DECODED_KINDS) -> DataFrame:
    """Writes per minute of a batch of updates."""
    counts = updates.groupBy(F.window("ingested_at", "1 minute")).agg(
        F.count(F.lit(1)).alias("writes"),
        *[F.count_if(F.col("kind") == kind).alias(flow_column(kind)) for kind in kinds],
        F.sum("data_len").alias("bytes"),
    )
    return counts.select(F.unix_seconds("window.start").alias("minute"), *[c for c in counts.columns if c != "window"])


def start_flow_monitor(updates: DataFrame, root: str, kinds=DECODED_KINDS, seconds: int = 10, available_now: bool = False) -> StreamingQuery:
    """Record the writes per minute of each micro-batch.

    Counts are partial and add up on reading, so there is neither state nor a watermark: no row is too late,
    and the newest minutes are there at once.
    """
    run = run_of(updates.sparkSession, f"{root}/_flow_offsets", None)

    def on_batch(batch: DataFrame, batch_id: int) -> None:
        flow_by_minute(batch, kinds).write.mode("overwrite").parquet(f"{root}/flow/batch_id={run.id}-{batch_id:09d}")

    writer = updates.writeStream.foreachBatch(on_batch).option("checkpointLocation", f"{root}/_flow_offsets")
    writer = writer.trigger(availableNow=True) if available_now else writer.trigger(processingTime=f"{seconds} seconds")
    return writer.start()


def read_flow(spark: SparkSession, root: str) -> DataFrame:
    """Writes per minute over all batches."""
    rows = spark.read.parquet(f"{root}/flow").drop("batch_id")
    return rows.groupBy("minute").agg(*[F.sum(c).alias(c) for c in rows.columns if c != "minute"])


def running_shapes(updates: DataFrame) -> DataFrame:
    """Payload shapes over the whole stream so far (update or complete mode)."""
    return updates.groupBy(payload_shape().alias("shape")).agg(
        F.count(F.lit(1)).alias("n"), F.min("slot").alias("first_slot"), F.max("slot").alias("last_slot")
    )


def lag_line(updates: DataFrame, tips: DataFrame, as_of=None, seconds: int = 10) -> DataFrame:
    """How far processing is behind the chain's tip, for one batch of updates and tip notices.

    The tip is a maximum, so it never moves back when notices arrive out of order. `behind` grows in
    quiet spells as well; `stream_lag_s`, the age of the newest message of either kind, does not.
    """
    now = F.current_timestamp() if as_of is None else F.lit(str(as_of)).cast("timestamp")
    produced = F.unix_millis(F.max(F.col("produced_at").cast("timestamp")))
    one = side_by_side(
        tips.agg(F.max("slot").alias("tip_slot"), produced.alias("tip_ms")),
        updates.agg(F.max("slot").alias("processed_slot"), F.count(F.lit(1)).alias("updates"), produced.alias("update_ms")),
    )
    behind = F.greatest(F.col("tip_slot") - F.col("processed_slot"), F.lit(0))
    newest = F.greatest("tip_ms", "update_ms")
    return one.select(
        "tip_slot",
        "processed_slot",
        behind.alias("behind_slots"),
        F.round(behind * (MILLIS_PER_SLOT / 1000), 1).alias("behind_s"),
        F.round(F.greatest((F.unix_millis(now) - newest) / 1000.0, F.lit(0.0)), 1).alias("stream_lag_s"),
        F.round(F.col("updates") / float(seconds), 4).alias("updates_per_s"),
    )


MONITOR_SCHEMA = "tip_slot bigint, processed_slot bigint, updates bigint, newest_ms bigint"


@dataclass
class LagMonitor:
    """Appends one row per micro-batch: the highest tip and update slots so far and the newest message time."""

    root: str
    run: str
    tip_slot: int | None = None
    processed_slot: int | None = None

    def on_batch(self, batch: DataFrame, batch_id: int) -> None:
        is_tip = F.col("event") == "slot"
        seen = batch.agg(
            F.max(F.when(is_tip, F.col("slot"))).alias("tip"),
            F.max(F.when(~is_tip, F.col("slot"))).alias("done"),
            F.count_if(~is_tip).alias("updates"),
            F.unix_millis(F.max(F.col("produced_at").cast("timestamp"))).alias("newest"),
        ).first()
        if seen.newest is None:
            return
        # Notices of different kinds arrive slightly out of order; neither reading may move back.
        self.tip_slot = max((s for s in (self.tip_slot, seen.tip) if s is not None), default=None)
        self.processed_slot = max((s for s in (self.processed_slot, seen.done) if s is not None), default=None)
        row = (self.tip_slot, self.processed_slot, seen.updates, seen.newest)
        spark = batch.sparkSession
        line = spark.createDataFrame([row], MONITOR_SCHEMA).coalesce(1)
        line.write.mode("overwrite").parquet(f"{self.root}/lag/batch_id={self.run}-{batch_id:09d}")


def start_lag_monitor(messages: DataFrame, root: str, seconds: int = 10, available_now: bool = False) -> StreamingQuery:
    """Follow a stream of (event: slot | account, slot, produced_at) messages and record the lag.

    A restart goes on from the highest slots on record, so neither reading moves back.
    """
    spark, offsets = messages.sparkSession, f"{root}/_lag_offsets"
    monitor = LagMonitor(root, run_of(spark, offsets, None).id)
    before = read_batches(spark, root, "lag", MONITOR_SCHEMA)
    if before is not None:
        monitor.tip_slot, monitor.processed_slot = before.agg(F.max("tip_slot"), F.max("processed_slot")).first()
    writer = messages.writeStream.foreachBatch(monitor.on_batch).option("checkpointLocation", offsets)
    writer = writer.trigger(availableNow=True) if available_now else writer.trigger(processingTime=f"{seconds} seconds")
    return writer.start()


def read_lag(spark, root: str) -> DataFrame:
    """Recorded lag rows with the distance to the tip in slots and seconds."""
    rows = spark.read.schema(f"{MONITOR_SCHEMA}, batch_id string").parquet(f"{root}/lag")
    behind = F.greatest(F.col("tip_slot") - F.col("processed_slot"), F.lit(0))
    return rows.select(
        "tip_slot", "processed_slot", behind.alias("behind_slots"),
        F.round(behind * (MILLIS_PER_SLOT / 1000), 1).alias("behind_s"), "updates", "newest_ms",
    )
