"""Figures kept up batch by batch, so that a report does not read history again.

Every stored batch adds a few rows: for each table, second of arrival and kind the rows, bytes and highest slot.
They are partial aggregates: sums and maxima over all batches are the figures of the whole, in whatever order batches
come, and a batch that is tried again replaces its own rows. Ingest leaves replays out, so that row counts are counts
of versions.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from slotwise.operators.rows import side_by_side
from slotwise.plans.activity import flow_column
from slotwise.plans.quality import current_gaps
from slotwise.plans.summary import checkpoint_of
from slotwise.schemas import DECODED_KINDS, DEFAULT_STREAM

SCHEMA = "source string, second bigint, kind string, n bigint, bytes bigint, last_slot bigint"


def rollup(tables: dict[str, DataFrame]) -> DataFrame:
    """Partial aggregates of the rows of one batch, by table."""
    parts = []
    for name, rows in tables.items():
        second = F.unix_seconds(F.col("ingested_at").cast("timestamp")).alias("second")
        kind = F.col("kind") if "kind" in rows.columns else F.lit(None).cast("string")
        bytes_ = F.coalesce(F.sum("data_len"), F.lit(0)) if "data_len" in rows.columns else F.lit(0).cast("bigint")
        counted = rows.groupBy(second, kind.alias("kind")).agg(F.count(F.lit(1)).alias("n"), bytes_.alias("bytes"), F.max("slot").alias("last_slot"))
        parts.append(counted.select(F.lit(name).alias("source"), "second", "kind", "n", F.col("bytes").cast("bigint").alias("bytes"), "last_slot"))
    return reduce(DataFrame.unionByName, parts)


def store_rollup(tables: dict[str, DataFrame], root: str, batch: str) -> None:
    """Add a batch's figures below `root`, in place of an earlier attempt at it."""
    rollup(tables).coalesce(1).write.mode("overwrite").parquet(f"{root}/rollups/batch_id={batch}")


def read_rollups(spark: SparkSession, root: str) -> DataFrame:
    return spark.read.schema(SCHEMA).option("recursiveFileLookup", "true").parquet(f"{root}/rollups")


def _seconds(as_of):
    at = F.current_timestamp() if as_of is None else F.lit(str(as_of)).cast("timestamp")
    return F.unix_seconds(at)


def flow(rollups: DataFrame, as_of, minutes: int = 60, kinds=DECODED_KINDS) -> DataFrame:
    """`activity.flow` from the stored figures; `as_of` is a whole second."""
    edge = _seconds(as_of)
    recent = rollups.filter((F.col("source") == "account_updates") & (F.col("second") >= edge - int(minutes) * 60) & (F.col("second") < edge))
    per = recent.groupBy((F.col("second") - F.pmod("second", F.lit(60))).alias("minute")).agg(
        F.sum("n").alias("writes"),
        *[F.sum(F.when(F.col("kind") == kind, F.col("n")).otherwise(0)).alias(flow_column(kind)) for kind in kinds],
        F.sum("bytes").alias("bytes"),
    )
    return per.orderBy("minute")


def system_status(rollups: DataFrame, checkpoints: DataFrame, gaps: DataFrame, as_of, stream: str = DEFAULT_STREAM) -> DataFrame:
    """`summary.system_status` from the stored figures."""

    def of(source: str, column: str):
        return F.when(F.col("source") == source, F.col(column))

    figures = rollups.agg(
        F.max(of("account_updates", "last_slot")).alias("latest_slot"),
        F.coalesce(F.sum(of("account_updates", "n")), F.lit(0)).alias("total_rows"),
        (_seconds(as_of) - F.max(of("account_updates", "second"))).alias("ingest_age_s"),
        F.coalesce(F.sum(of("obligation_snapshots", "n")), F.lit(0)).alias("snap_rows"),
        F.max(of("reserve_snapshots", "last_slot")).alias("reserve_max"),
    )
    one = side_by_side(
        figures,
        checkpoint_of(checkpoints, stream).agg(F.max("last_slot").alias("checkpoint")),
        current_gaps(gaps).filter(F.col("filled") == 0).agg(F.count(F.lit(1)).alias("unfilled_gaps")),
    )
    return one.select("latest_slot", "checkpoint", "ingest_age_s", "unfilled_gaps", "total_rows", "snap_rows", "reserve_max")


def activity_by_kind(rollups: DataFrame) -> DataFrame:
    """Rows, bytes and highest slot per kind over all batches."""
    mine = rollups.filter(F.col("source") == "account_updates")
    return mine.groupBy("kind").agg(F.sum("n").alias("updates"), F.sum("bytes").alias("bytes"), F.max("last_slot").alias("last_slot"))
