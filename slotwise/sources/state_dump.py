"""Full-state dumps: JSON pages of every account, loaded beside the stream's rows."""

from __future__ import annotations

import time
import uuid
from dataclasses import dataclass

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from slotwise.functions.base58 import base58_decode
from slotwise.functions.kinds import classify_kind, only_kinds
from slotwise.functions.layouts import Layout
from slotwise.operators.rows import side_by_side
from slotwise.plans.decoding import decoded_once
from slotwise.schemas import DECODED_KINDS, SCHEMAS, STATE_DUMP_WRITE_VERSION
from slotwise.session import ship_package
from slotwise.sources.updates import read_filed, write_batch

_ACCOUNT = "struct<pubkey: string, account: struct<owner: string, lamports: bigint, data: array<string>>>"
# A page is the bare result or the whole response around it.
PAGE_SCHEMA = (
    f"context struct<slot: bigint>, value array<{_ACCOUNT}>, "
    f"result struct<context: struct<slot: bigint>, value: array<{_ACCOUNT}>>"
)
SCOPES = ("known", "all")
# Bytes of the payload that name its owner; the first of them cuts a dump into 256 pages.
OWNER_OFFSET = 64


@dataclass(frozen=True)
class StateDump:
    rows: DataFrame  # bronze rows, write_version 0
    marked: DataFrame  # every account with the reason it cannot be loaded, if any

    @property
    def errors(self) -> DataFrame:
        """(source, pubkey, reason) of what cannot be loaded."""
        return _errors(self.marked)


def load_state_dump(spark: SparkSession, path: str, scope: str = "known", page_per_line: bool = False) -> StateDump:
    """Bronze rows of a dump. `known` keeps the three decoded kinds, `all` every account.

    Each page is one JSON document and carries the slot it was taken at, which is the slot of its rows;
    a page without one cannot be dated and yields error rows, as does a bad key or payload. A page is a
    file of its own, or a line with `page_per_line`, which lets Spark split large files.
    """
    if scope not in SCOPES:
        raise ValueError(f"scope must be one of {SCOPES}, got {scope!r}")
    pages = spark.read.schema(PAGE_SCHEMA).option("multiLine", str(not page_per_line).lower()).json(path)
    accounts = pages.select(
        F.input_file_name().alias("source"),
        F.coalesce("context.slot", "result.context.slot").alias("slot"),
        F.explode_outer(F.coalesce("value", "result.value")).alias("a"),
    )
    # One page is one task up to here. Its accounts are spread before the costly part.
    salts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    accounts = accounts.repartition("source", F.pmod(F.xxhash64("a.pubkey"), F.lit(salts)))
    text = F.get(F.col("a.account.data"), 0)
    parsed = accounts.select(
        "source",
        "slot",
        F.col("a.pubkey").alias("key_text"),
        base58_decode("a.pubkey").alias("pubkey"),
        base58_decode("a.account.owner").alias("owner"),
        F.coalesce("a.account.lamports", F.lit(0)).alias("lamports"),
        F.expr("try_to_binary(get(a.account.data, 0), 'base64')").alias("data"),
        text.isNotNull().alias("has_data"),
        F.when(F.col("a").isNotNull(), F.lit(True)).alias("has_account"),
    )
    reason = (
        F.when(F.col("slot").isNull(), "page has no slot")
        .when(F.col("key_text").isNull(), "page has no accounts, or an account without a key")
        .when(F.col("pubkey").isNull(), "pubkey is not a base58 key")
        .when(F.col("owner").isNull(), "owner is not a base58 key")
        .when(~F.col("has_data"), "account has no data field")
        .when(F.col("data").isNull(), "data is not base64")
    )
    marked = parsed.withColumn("reason", reason)
    good = marked.filter(F.col("reason").isNull())
    if scope == "known":
        good = only_kinds(good, DECODED_KINDS)
    rows = good.select(
        "slot",
        F.lit(STATE_DUMP_WRITE_VERSION).cast("bigint").alias("write_version"),
        "pubkey",
        classify_kind("data").alias("kind"),
        "owner",
        "lamports",
        "data",
        F.length("data").cast("bigint").alias("data_len"),
        F.current_timestamp().alias("ingested_at"),
    )
    return StateDump(rows, marked)


def _errors(marked: DataFrame) -> DataFrame:
    return marked.filter(F.col("reason").isNotNull()).select("source", F.col("key_text").alias("pubkey"), "reason")


def owner_page(data: str = "data", offset: int = OWNER_OFFSET):
    """Page of a record: one byte of its owner, as two hex digits. Pages are disjoint and exhaustive."""
    return F.hex(F.substring(data, offset + 1, 1))


def by_owner_page(rows: DataFrame, data: str = "data", offset: int = OWNER_OFFSET, salts: int | None = None) -> DataFrame:
    """Spread a load over its pages.

    One owner, and so one page, may hold a large share of all rows; pages are therefore salted with as
    many values as there are shuffle partitions.
    """
    salts = salts or int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    paged = rows.withColumn("owner_page", owner_page(data, offset))
    return paged.repartition("owner_page", F.pmod(F.xxhash64("pubkey"), F.lit(salts)))


def page_counts(rows: DataFrame, data: str = "data", offset: int = OWNER_OFFSET) -> DataFrame:
    """Rows per page. The sum over pages must equal the size of the load."""
    return rows.groupBy(owner_page(data, offset).alias("owner_page")).agg(F.count(F.lit(1)).alias("accounts"))


def run_row(spark: SparkSession, root: str, batch: str, accounts: int, scope: str, duration_ms: int) -> DataFrame:
    """The provenance row of a stored load, dated at its newest page.

    `accounts` are all that the pages hold, of any kind and bad ones included; `rows_written` what was stored; `decode_failures`
    stored records of a decoded kind that gave no silver row.
    """
    kept = read_filed(spark, root, "account_updates").filter(F.col("batch_id") == batch)
    failed = spark.read.parquet(f"{root}/rejected_snapshots/batch_id={batch}")
    one = side_by_side(
        kept.agg(F.max("slot").alias("slot"), F.count(F.lit(1)).alias("rows_written")),
        failed.agg(F.count(F.lit(1)).alias("decode_failures")),
    )
    return one.select(
        "slot",
        F.lit(scope).alias("scope"),
        F.lit(accounts).cast("bigint").alias("accounts"),
        "rows_written",
        "decode_failures",
        F.lit(duration_ms).cast("bigint").alias("duration_ms"),
        F.current_timestamp().alias("ingested_at"),
    )


def store_state_dump(
    spark: SparkSession, path: str, root: str, layouts: dict[str, Layout], scope: str = "known", page_per_line: bool = False
) -> DataFrame:
    """Load a dump into the tables below `root` and record the run, which is written last.

    Raw rows are stored first and decoded from there, whether or not they decode. An empty dump is
    refused: recording it would claim that there are no accounts. The stream's position is left alone.
    """
    ship_package(spark)
    started = time.monotonic()
    batch = f"dump-{uuid.uuid4().hex}"
    dump = load_state_dump(spark, path, scope, page_per_line)
    write_batch(dump.rows, root, "account_updates", batch)
    seen = Observation()
    marked = dump.marked.observe(seen, F.count("has_account").alias("accounts"))
    _errors(marked).write.parquet(f"{root}/dump_errors/batch_id={batch}")
    stored = read_filed(spark, root, "account_updates").filter(F.col("batch_id") == batch).select(*SCHEMAS["account_updates"].fieldNames())
    if stored.isEmpty():
        raise ValueError(f"{path} holds no accounts; an empty dump is not recorded")
    with decoded_once(stored, layouts) as (tables, rejects):
        for table, decoded in tables.items():
            write_batch(decoded, root, table, batch)
        rejects.write.parquet(f"{root}/rejected_snapshots/batch_id={batch}")
    run = run_row(spark, root, batch, seen.get["accounts"], scope, int((time.monotonic() - started) * 1000))
    run.write.parquet(f"{root}/snapshot_runs/batch_id={batch}")
    return spark.read.schema(run.schema).parquet(f"{root}/snapshot_runs/batch_id={batch}")
