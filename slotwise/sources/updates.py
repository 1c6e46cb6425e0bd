"""The change stream as a source, and the tables that ingest writes.

Raw and decoded rows are filed by buckets of 10^7 slots and then by batch, so that a range of slots reads only its
folders, a batch that is tried again replaces itself, and closed buckets can be compacted. Raw rows also name the
session that received them.
"""

from __future__ import annotations

import time
import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from functools import reduce

from pyspark.sql import Column, DataFrame, DataFrameWriter, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from slotwise.functions.kinds import only_kinds
from slotwise.functions.numbers import valid_key
from slotwise.functions.slots import slot_between, slot_bucket
from slotwise.schemas import BUCKET_COLUMN, LATE_COLUMNS, SCHEMAS, SLOTS_PER_HOT_BUCKET, VERSION_KEY
from slotwise.session import delete, tidy, work_dir

SESSION_COLUMN = "session_id"
COMPACTED = "compact-"  # how the names of merged batches begin
_RETIRED = "folder string, at double"

# What arrives: everything else in `account_updates` is derived.
WIRE_SCHEMA = T.StructType(
    [
        T.StructField("slot", T.LongType()),
        T.StructField("write_version", T.LongType()),
        T.StructField("pubkey", T.BinaryType()),
        T.StructField("owner", T.BinaryType()),
        T.StructField("lamports", T.LongType()),
        T.StructField("data", T.BinaryType()),
    ]
)
_MESSAGE = "slot bigint, write_version bigint, pubkey string, owner string, lamports bigint, data string"


def parse_messages(messages: DataFrame) -> DataFrame:
    """Wire records from JSON messages in a `value` column; the three byte fields are strict base64.

    `message` keeps the text of a message that is no JSON object or holds bytes that are not base64, for its reject row.
    """
    value = F.col("value").cast("string")
    bytes_of = {c: F.expr(f"try_to_binary(m.{c}, 'base64')") for c in ("pubkey", "owner", "data")}
    rows = messages.select(F.from_json(value, _MESSAGE).alias("m"), value.alias("message"))
    broken = F.col("m.slot").isNull()
    for c, decoded in bytes_of.items():
        broken = broken | (F.col(f"m.{c}").isNotNull() & decoded.isNull())
    return rows.select(
        "m.slot",
        "m.write_version",
        bytes_of["pubkey"].alias("pubkey"),
        bytes_of["owner"].alias("owner"),
        "m.lamports",
        bytes_of["data"].alias("data"),
        F.when(broken, F.col("message")).alias("message"),
    )


def read_updates_stream(
    spark: SparkSession,
    path: str | None = None,
    start_slot: int | None = None,
    kinds=None,
    options: dict[str, str] | None = None,
) -> DataFrame:
    """Streaming wire records from a folder of Parquet files or from Kafka.

    `start_slot` is inclusive: the slot that was reached is read again, because a copy can be removed and
    a hole cannot be filled. `kinds` keeps records by tag. Kafka is chosen by leaving `path` out and
    passing the source's own options.
    """
    reader = spark.readStream
    if path is not None:
        rows = reader.schema(WIRE_SCHEMA).options(**(options or {})).parquet(path)
    else:
        rows = parse_messages(reader.format("kafka").options(**(options or {})).load())
    if start_slot is not None:
        rows = rows.filter(F.col("slot") >= start_slot)
    return only_kinds(rows, kinds) if kinds is not None else rows


def reject_reason():
    """Why a wire record cannot be stored; null for a proper one."""
    return (
        F.when(~valid_key("pubkey"), "pubkey is not 32 bytes")
        .when(~valid_key("owner"), "owner is not 32 bytes")
        .when(F.coalesce(F.col("slot") < 0, F.lit(True)), "slot is missing or negative")
        .when(F.coalesce(F.col("write_version") < 0, F.lit(True)), "write_version is missing or negative")
        .when(F.coalesce(F.col("lamports") < 0, F.lit(True)), "lamports is missing or negative")
        .when(F.col("data").isNull(), "data is missing or not base64")
    )


def with_late_columns(df: DataFrame, table: str) -> DataFrame:
    """Columns that older files lack read as 0. A filter `> 0` on them therefore excludes old rows."""
    late = {c: F.coalesce(F.col(c), F.lit(0).cast(SCHEMAS[table][c].dataType)).alias(c) for c in LATE_COLUMNS.get(table, ())}
    return df.withColumns(late) if late else df


def _filed(table: str) -> T.StructType:
    # Declared as text: inference would turn the padded number of a bucket into an integer.
    own = [SESSION_COLUMN] if table == "account_updates" else []
    text = [T.StructField(c, T.StringType()) for c in (*own, BUCKET_COLUMN, "batch_id")]
    return T.StructType([*SCHEMAS[table].fields, *text])


def filed_bucket(slot: str = "slot"):
    """Bucket that a stored row is filed under."""
    return slot_bucket(slot, SLOTS_PER_HOT_BUCKET)


# Payloads shrink by almost half against Spark's default, at the same speed. A writer, and a reader in Python, holds one row group.
_PACKED = {"compression": "zstd", "parquet.compression.codec.zstd.level": "1", "parquet.block.size": str(32 << 20)}


def plain_bytes(df: DataFrame) -> DataFrameWriter:
    """Writer that looks up no dictionary for columns of bytes: nearly every payload and most keys are different.

    Building dictionaries that are then given up took half the time of writing raw rows.
    """
    off = {f"parquet.enable.dictionary#{f.name}": "false" for f in df.schema.fields if f.dataType == T.BinaryType()}
    return df.write.options(**_PACKED, **off)


@contextmanager
def held(df: DataFrame, purpose: str = "held") -> Iterator[DataFrame]:
    """The rows in files that last as long as the block, for what is read more than once.

    Unlike blocks of Spark's storage they are compressed, take no memory of the executors, and a narrow reader skips payloads.
    """
    spark, path = df.sparkSession, work_dir(df.sparkSession, purpose)
    try:
        with tidy(spark):
            plain_bytes(df).parquet(path)
        yield spark.read.schema(df.schema).parquet(path)
    finally:
        delete(spark, path)


def write_batch(df: DataFrame, root: str, table: str, batch: str) -> None:
    """File rows of a table with slots under their buckets as one batch, in place of an earlier attempt at it.

    Rows of a bucket are brought together first, or every task would leave a file in every bucket; a bucket with
    many rows is split again by size.
    """
    rows = df.withColumn(BUCKET_COLUMN, filed_bucket()).withColumn("batch_id", F.lit(batch))
    rows = rows.hint("rebalance", BUCKET_COLUMN).sortWithinPartitions(BUCKET_COLUMN, "batch_id", "slot", "write_version")
    writer = plain_bytes(rows).mode("overwrite").option("partitionOverwriteMode", "dynamic")
    with tidy(rows.sparkSession):
        writer.partitionBy(BUCKET_COLUMN, "batch_id").parquet(f"{root}/{table}")


def read_filed(spark: SparkSession, root: str, table: str) -> DataFrame:
    """Rows of a filed table with their bucket and batch."""
    return spark.read.schema(_filed(table)).parquet(f"{root}/{table}")


def read_table(spark: SparkSession, root: str, table: str, slots: tuple[int, int] | None = None) -> DataFrame:
    """A bronze or silver table, files of all ages under one fixed schema; of `slots` [from, to) only those folders are read."""
    rows = read_filed(spark, root, table)
    if slots is not None:
        rows = slot_between(rows, *slots, SLOTS_PER_HOT_BUCKET)
    return with_late_columns(rows.select(*SCHEMAS[table].fieldNames()), table)


def read_session(spark: SparkSession, root: str, session: str) -> DataFrame:
    """Raw rows that one session received; rows from before sessions were recorded belong to none."""
    rows = read_filed(spark, root, "account_updates")
    return rows.filter(F.col(SESSION_COLUMN) == session).select(*SCHEMAS["account_updates"].fieldNames())


def stored_keys(spark: SparkSession, root: str, ranges: list[tuple[int, int]], except_batch: str) -> DataFrame:
    """Version keys stored in any of the inclusive slot ranges by other batches. Payloads are not read, nor are other buckets."""
    rows = read_filed(spark, root, "account_updates")
    rows = slot_between(rows, min(a for a, _ in ranges), max(b for _, b in ranges) + 1, SLOTS_PER_HOT_BUCKET)
    inside = reduce(Column.__or__, [F.col("slot").between(a, b) for a, b in ranges])
    return rows.filter(inside & (F.col("batch_id") != except_batch)).select(*VERSION_KEY)


def compact(spark: SparkSession, root: str, table: str, grace_seconds: float = 0) -> list[str]:
    """Merge the batches of every closed bucket (all but the newest) into one each; returns those buckets.

    The merged copy is complete before the batches go. A reader in between sees rows twice, which collapse on read, and
    never a hole. A batch that is tried again afterwards files its rows once more, which collapses as well. Merged
    batches are kept for `grace_seconds`, for readers that have listed them already; a later call deletes them.
    """
    retired, now = f"{root}/_retired/{table}", time.time()
    waiting = {}
    if _exists(spark, retired):
        rows = spark.read.schema(_RETIRED).json(retired).collect()  # folders of batches that wait to be deleted
        waiting = {r.folder: r.at for r in rows}
    path_of = spark._jvm.org.apache.hadoop.fs.Path
    top = spark._jvm.org.apache.hadoop.fs.Path(f"{root}/{table}")
    fs = top.getFileSystem(spark._jsc.hadoopConfiguration())

    def folders(path, prefix: str) -> list:
        return [s.getPath() for s in fs.listStatus(path) if s.isDirectory() and s.getPath().getName().startswith(prefix)]

    buckets = sorted(folders(top, f"{BUCKET_COLUMN}="), key=lambda p: p.getName())[:-1]
    for folder, at in list(waiting.items()):
        if now - at >= grace_seconds:
            fs.delete(path_of(folder), True)
            del waiting[folder]
    batches = {p.getName().split("=", 1)[1]: [b for b in folders(p, "batch_id=") if b.toString() not in waiting] for p in buckets}
    todo = {b: paths for b, paths in batches.items() if len(paths) > 1}
    if not todo:
        _put_waiting(spark, retired, waiting)
        return []
    names = sorted({p.getName().split("=", 1)[1] for paths in todo.values() for p in paths})
    rows = read_filed(spark, root, table).filter(F.col(BUCKET_COLUMN).isin(list(todo)) & F.col("batch_id").isin(names))
    merged = rows.withColumn("batch_id", F.lit(f"{COMPACTED}{uuid.uuid4().hex}")).hint("rebalance", BUCKET_COLUMN)
    merged = merged.sortWithinPartitions(BUCKET_COLUMN, "slot", "write_version")
    with tidy(spark):
        plain_bytes(merged).mode("append").partitionBy(BUCKET_COLUMN, "batch_id").parquet(f"{root}/{table}")
    for paths in todo.values():
        for path in paths:
            if grace_seconds > 0:
                waiting[path.toString()] = now
            else:
                fs.delete(path, True)
    _put_waiting(spark, retired, waiting)
    return sorted(todo)


def _exists(spark: SparkSession, path: str) -> bool:
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    return place.getFileSystem(spark._jsc.hadoopConfiguration()).exists(place)


def _put_waiting(spark: SparkSession, path: str, waiting: dict[str, float]) -> None:
    if waiting or _exists(spark, path):
        spark.createDataFrame(list(waiting.items()), _RETIRED).coalesce(1).write.mode("overwrite").json(path)
