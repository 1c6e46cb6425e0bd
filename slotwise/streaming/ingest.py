"""Ingest: one stream of wire records into bronze, three silver tables, positions, gaps, guard and alarm rows.

Every micro-batch writes its share of each table to folders named after the batch, replacing them if the
batch is tried again, and the position last. Spark commits the stream's own offsets after that. A crash
at any point therefore repeats a batch, and what is repeated is not stored twice.

No record is dropped for its slot. A stream stores the intervals of slots that it has received (`frontier`); a record
inside them whose version key is stored already is a replay and is left out, every other record is stored, however late
it arrives and in whatever order the source delivers. New offsets, as after a loss or a change of source, may therefore
begin anywhere.

Batch numbers start again with new offsets, so a batch is named after its run as well. A run lasts as long as
its offsets: its id is kept beside them, and no run ever writes into the folders of another.
"""

from __future__ import annotations

import threading
import time
import uuid
from collections.abc import Iterator
from contextlib import ExitStack, contextmanager
from dataclasses import dataclass, field
from datetime import datetime, timezone

from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from slotwise.functions.kinds import with_derived
from slotwise.functions.layouts import Layout
from slotwise.functions.verdicts import is_fault
from slotwise.plans.decoding import decoded_once
from slotwise.plans.quality import failure_gaps, gap_rows, payload_alarms
from slotwise.plans.rollups import store_rollup
from slotwise.schemas import ALARM_EVERY, DEFAULT_STREAM, SCHEMAS, VERSION_KEY
from slotwise.session import ship_package, tidy
from slotwise.sources.updates import SESSION_COLUMN, held, reject_reason, stored_keys, write_batch
from slotwise.streaming import frontier

# Fixed value: how often a partial batch is written.
FLUSH_SECONDS = 2


def _put(df: DataFrame, root: str, table: str, batch: str) -> None:
    df.write.mode("overwrite").parquet(f"{root}/{table}/batch_id={batch}")


def write_tables(rows: DataFrame, root: str, batch: str, layouts: dict[str, Layout], session: str | None = None) -> None:
    """Raw rows first, then the decoded ones computed from the same batch, each kind decoded once."""
    columns = SCHEMAS["account_updates"].fieldNames()
    raw = rows.select(*columns, F.lit(session).cast("string").alias(SESSION_COLUMN))
    write_batch(raw, root, "account_updates", batch)
    with decoded_once(rows, layouts) as (tables, rejects):
        for table, decoded in tables.items():
            write_batch(decoded, root, table, batch)
        store_rollup({"account_updates": rows, **tables}, root, batch)
        _put(rejects, root, "rejected_snapshots", batch)


def _figures(marked: DataFrame) -> Row:
    """What the position, the guard and the seam need to know about a batch, in one row."""
    good = F.col("reason").isNull()
    fault = is_fault() & good
    slot = F.when(good, F.col("slot"))
    return marked.agg(
        F.count_if(good).alias("updates"),
        F.count_if(~good).alias("rejected"),
        F.max(F.when(good, F.struct("slot", "write_version"))).alias("top"),
        F.min(slot).alias("first_account_slot"),
        F.count_if(fault).alias("impossible"),
        F.count_if(good & (F.col("data_len") == 0) & (F.col("lamports") == 0)).alias("closed"),
        F.min(F.when(fault, F.col("slot"))).alias("first_slot"),
        F.max(F.when(fault, F.col("slot"))).alias("last_slot"),
    ).first()


def _exists(spark: SparkSession, path: str) -> bool:
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    return place.getFileSystem(spark._jsc.hadoopConfiguration()).exists(place)


def read_batches(spark: SparkSession, root: str, table: str, schema=None) -> DataFrame | None:
    """All batches of a table, or None before the first one."""
    if not _exists(spark, f"{root}/{table}"):
        return None
    reader = spark.read.schema(schema or SCHEMAS[table]).option("recursiveFileLookup", "true")
    return reader.parquet(f"{root}/{table}")


GUARD_SCHEMA = "updates bigint, impossible bigint, closed bigint, first_slot bigint, last_slot bigint"
ALARM_SCHEMA = "stream string, n bigint, slot bigint, write_version bigint, pubkey binary, alarm string"
FAULTS_SCHEMA = "stream string, faults bigint"
BUDGET_SCHEMA = "stream string, first_slot bigint, seen_slot bigint"


def read_position(spark: SparkSession, root: str, stream: str = DEFAULT_STREAM) -> int | None:
    """Highest slot on record; None on a first run. Position 0 is a position. What lies below it, `read_frontier` tells."""
    rows = read_batches(spark, root, "ingest_checkpoint")
    if rows is None:
        return None
    mine = rows.filter(F.col("stream") == stream)
    return mine.agg(F.max_by("last_slot", F.struct("last_slot", "last_write_version"))).first()[0]


def read_frontier(spark: SparkSession, root: str, stream: str = DEFAULT_STREAM) -> frontier.Intervals:
    """The slots that a stream has received. A source that can seek begins at its `resume_slot`."""
    return frontier.merged(spark, read_batches(spark, root, "received_slots", frontier.SCHEMA), stream)


@dataclass(frozen=True)
class Run:
    """One life of a stream's offsets: its id, and the position on record when it began."""

    id: str
    start_slot: int | None


def run_of(spark: SparkSession, offsets: str, position: int | None) -> Run:
    """The run that the offsets belong to; a new one when there are none."""
    path, schema = f"{offsets}/run", "id string, start_slot bigint"
    found = spark.read.schema(schema).json(path).take(1) if _exists(spark, path) else []
    if not found:
        row = [(uuid.uuid4().hex, position)]
        spark.createDataFrame(row, schema).coalesce(1).write.mode("overwrite").json(path)
        return Run(*row[0])
    return Run(found[0].id, found[0].start_slot)


@dataclass
class Ingest:
    """State of one ingest session, read back from the tables at its first batch.

    The seam with the previous session is judged once per session. `failure` is the code of an error that the source
    reported when it was opened at `resume_from`; its gap row then carries that reason.
    """

    spark: SparkSession
    root: str
    layouts: dict[str, Layout]
    stream: str = DEFAULT_STREAM
    session: str = field(default_factory=lambda: f"s{int(time.time() * 1000)}")
    resume_from: int | None = None
    judged: bool = False
    run: str = field(default_factory=lambda: uuid.uuid4().hex)
    failure: str | None = None
    budget_slots: int | None = None
    alarm_every: int = ALARM_EVERY
    used_up: bool = False
    received: frontier.Intervals | None = None
    faults: int | None = None
    first_slot: int | None = None

    def on_batch(self, batch: DataFrame, batch_id: int) -> None:
        name = f"{self.stream}-{self.run}-{batch_id:09d}"
        # The batch is read from its source once, and lies in files rather than in the executors, which may be far smaller than it.
        with tidy(batch.sparkSession), held(with_derived(batch).withColumn("reason", reject_reason()), "batch") as marked:
            seen = _figures(marked)
            inside = marked
            if seen.updates and self.budget_slots is not None:
                inside = marked.filter(F.col("reason").isNotNull() | (F.col("slot") <= self._last_slot(seen, name)))
                seen = _figures(inside)
            if seen.rejected:
                _put(inside.filter(F.col("reason").isNotNull()), self.root, "rejected_updates", name)
            if not seen.updates:
                return
            good = inside.filter(F.col("reason").isNull()).drop("reason")
            with self._new(good, seen, name) as rows:
                if rows is not None:
                    write_tables(rows, self.root, name, self.layouts, self.session)
                self._put_row("payload_guard", name, GUARD_SCHEMA, seen.updates, seen.impossible, seen.closed, seen.first_slot, seen.last_slot)
                if seen.impossible and rows is not None:
                    self._raise_alarms(rows, name)
            if not self.judged:
                self._judge(seen.first_account_slot, name)
                self.judged = True
            spans = frontier.intervals_of(good, seen.first_account_slot, seen.top.slot)
            received = [(self.stream, *span) for span in spans]
            _put(self.spark.createDataFrame(received, frontier.SCHEMA).coalesce(1), self.root, "received_slots", name)
            self.received.merge(spans)
            position = (self.stream, seen.top.slot, seen.top.write_version, datetime.now(timezone.utc))
            self._put_row("ingest_checkpoint", name, SCHEMAS["ingest_checkpoint"], *position)

    def _put_row(self, table: str, name: str, schema, *values) -> None:
        _put(self.spark.createDataFrame([values], schema).coalesce(1), self.root, table, name)

    def _mine(self, table: str, schema: str, name: str) -> DataFrame | None:
        """The stream's rows of a table, without those of an earlier attempt at this batch."""
        if not _exists(self.spark, f"{self.root}/{table}"):
            return None
        rows = self.spark.read.schema(f"{schema}, batch_id string").parquet(f"{self.root}/{table}")
        return rows.filter((F.col("stream") == self.stream) & (F.col("batch_id") != name))

    @contextmanager
    def _new(self, rows: DataFrame, seen: Row, name: str) -> Iterator[DataFrame | None]:
        """Without the replays: records whose version key other batches have stored. None if there are no others."""
        if self.received is None:
            self.received = read_frontier(self.spark, self.root, self.stream)
        ranges = self.received.within(seen.first_account_slot, seen.top.slot)
        if not ranges:
            yield rows
            return
        # Keys are compared without payloads; most batches hold no replay, and their rows are then not joined at all.
        keys = rows.select(*VERSION_KEY)
        replays = keys.join(stored_keys(self.spark, self.root, ranges, name), list(VERSION_KEY), "left_semi")
        with ExitStack() as files:
            with held(replays.groupBy(*VERSION_KEY).agg(F.count(F.lit(1)).alias("times")), "replays") as replays:
                found = replays.agg(F.sum("times")).first()[0] or 0
                if found == seen.updates:
                    rows = None  # no payload is moved for a batch that holds nothing new
                elif found:
                    kept = rows.join(replays.select(*VERSION_KEY), list(VERSION_KEY), "left_anti")
                    # Written out once: what is stored below must not change what is left out.
                    rows = files.enter_context(held(kept, "new-updates"))
            yield rows

    def _last_slot(self, seen: Row, name: str) -> int:
        """Where the budget ends: counted from the first slot of the stream, which its first batch stores."""
        if self.first_slot is None:
            self.first_slot = seen.first_account_slot
        last = self.first_slot + self.budget_slots
        self._put_row("ingest_budget", name, BUDGET_SCHEMA, self.stream, self.first_slot, seen.top.slot)
        self.used_up = self.used_up or seen.top.slot >= last
        return last

    def recall_budget(self) -> None:
        """Take up the first slot on record. A budget that is used up already ends the query before it begins."""
        before = self._mine("ingest_budget", BUDGET_SCHEMA, "")
        if before is not None:
            self.first_slot, seen = before.agg(F.min("first_slot"), F.max("seen_slot")).first()
            self.used_up = self.first_slot is not None and seen >= self.first_slot + self.budget_slots

    def _raise_alarms(self, rows: DataFrame, name: str) -> None:
        """Alarm rows of a batch: the first fault of the stream and each `alarm_every`-th, numbered on over batches and restarts."""
        if self.faults is None:
            before = self._mine("payload_faults", FAULTS_SCHEMA, name)
            self.faults = (before.agg(F.sum("faults")).first()[0] or 0) if before is not None else 0
        count = rows.filter(is_fault()).count()
        alarms = payload_alarms(rows, self.alarm_every, self.faults)
        _put(alarms.select(F.lit(self.stream).alias("stream"), *alarms.columns), self.root, "payload_alarms", name)
        self._put_row("payload_faults", name, FAULTS_SCHEMA, self.stream, count)
        self.faults += count

    def _judge(self, first_slot: int, name: str) -> None:
        """Compare the first account slot of the session with the position it resumed from."""
        now = datetime.now(timezone.utc)
        if self.failure is None:
            schema = "session_id string, resume_from bigint, first_account_slot bigint, detected_at timestamp"
            found = gap_rows(self.spark.createDataFrame([(self.session, self.resume_from, first_slot, now)], schema), self.stream)
        else:
            schema = "code string, start_slot bigint, end_slot bigint, detected_at timestamp"
            start = 0 if self.resume_from is None else self.resume_from
            found = failure_gaps(self.spark.createDataFrame([(self.failure, start, first_slot, now)], schema), self.stream)
        _put(found, self.root, "slot_gaps", f"{self.session}-{name}")


def start_ingest(
    wire: DataFrame,
    root: str,
    layouts: dict[str, Layout],
    stream: str = DEFAULT_STREAM,
    available_now: bool = False,
    offsets: str | None = None,
    failure: str | None = None,
    budget_slots: int | None = None,
    session: str | None = None,
    alarm_every: int = ALARM_EVERY,
) -> StreamingQuery:
    """Start ingesting a streaming frame of wire records into the tables below `root`.

    Runs every two seconds, or drains what is there and stops with `available_now`. The batch size is the
    source's own option (maxFilesPerTrigger, maxOffsetsPerTrigger). Offsets are kept per stream, below `root`
    unless `offsets` names a folder, and a second start continues where the first one ended. With new offsets
    the stream may begin anywhere: replays are left out by their keys.

    `failure` is the code of an error that made the source open elsewhere than at the position (see
    `verdicts.FAILURE_REASONS`); it is recorded as a gap with its reason. With `budget_slots` the stream is a bounded
    sample: records up to that many slots past its first, after which the query ends itself. The budget counts the span
    of slots, not the active ones, and holds over restarts.
    """
    spark = wire.sparkSession
    ship_package(spark)
    offsets = offsets or f"{root}/_offsets/{stream}"
    position = read_position(spark, root, stream)
    run = run_of(spark, offsets, position)
    job = Ingest(spark, root, layouts, stream, resume_from=position, run=run.id, failure=failure, budget_slots=budget_slots, alarm_every=alarm_every)
    job.session = session or job.session
    if budget_slots is not None:
        job.recall_budget()
    writer = wire.writeStream.foreachBatch(job.on_batch).option("checkpointLocation", offsets)
    writer = writer.trigger(availableNow=True) if available_now else writer.trigger(processingTime=f"{FLUSH_SECONDS} seconds")
    query = writer.start()
    if budget_slots is not None:
        threading.Thread(target=_end_when_used_up, args=(query, job), daemon=True).start()
    return query


def _end_when_used_up(query: StreamingQuery, job: Ingest) -> None:
    """Stop the query between two batches once the budget is used up; a batch cut short would only be repeated."""
    while query.isActive:
        if job.used_up and not query.status["isTriggerActive"]:
            query.stop()
            return
        time.sleep(0.2)


def guard_totals(spark: SparkSession, root: str) -> DataFrame:
    """Payload guard over the whole stream, restarts included."""
    rows = read_batches(spark, root, "payload_guard", GUARD_SCHEMA)
    if rows is None:
        raise FileNotFoundError(f"no ingest below {root}")
    return rows.agg(
        F.coalesce(F.sum("impossible"), F.lit(0)).alias("impossible"),
        F.coalesce(F.sum("closed"), F.lit(0)).alias("closed"),
        F.min("first_slot").alias("first_slot"),
        F.max("last_slot").alias("last_slot"),
    )


def read_alarms(spark: SparkSession, root: str, stream: str = DEFAULT_STREAM) -> DataFrame:
    """Alarm rows of a stream so far; empty while there was no fault."""
    rows = read_batches(spark, root, "payload_alarms", ALARM_SCHEMA)
    if rows is None:
        rows = spark.createDataFrame([], ALARM_SCHEMA)
    return rows.filter(F.col("stream") == stream)
