"""Whole-dataset figures and provenance."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from slotwise.functions.numbers import active_debt
from slotwise.operators.dedup import collapse, collapse_table, collapsed_count
from slotwise.operators.quantiles import percentile_row, value_counts
from slotwise.operators.rows import side_by_side
from slotwise.plans.activity import _at
from slotwise.plans.quality import current_gaps
from slotwise.schemas import AT_RISK_HEALTH, DEFAULT_STREAM, HEALTH_SCALE, SLOTS_PER_BUCKET, STATE_DUMP_WRITE_VERSION
from slotwise.session import stored


def _count(df: DataFrame, alias: str) -> DataFrame:
    return df.agg(F.count(F.lit(1)).alias(alias))


def _distinct(df: DataFrame, column: str, alias: str) -> DataFrame:
    """Exact distinct count as two aggregations, so that no task holds a set of all values."""
    return _count(df.select(column).distinct(), alias)


def checkpoint_of(checkpoints: DataFrame, stream: str = DEFAULT_STREAM) -> DataFrame:
    """Current position of one stream."""
    return collapse_table(checkpoints.filter(F.col("stream") == stream), "ingest_checkpoint")


def _age(updates: DataFrame, as_of) -> DataFrame:
    newest = F.unix_seconds(F.max(F.col("ingested_at").cast("timestamp")))
    return updates.agg((F.unix_seconds(_at(as_of)) - newest).alias("ingest_age_s"))


def system_status(
    updates: DataFrame, snapshots: DataFrame, reserves: DataFrame, checkpoints: DataFrame, gaps: DataFrame, as_of, stream: str = DEFAULT_STREAM
) -> DataFrame:
    """Latest slot, stored position, ingest age, open gaps and table sizes. Only the age shows a stall."""
    totals = updates.agg(F.max("slot").alias("latest_slot"), F.count(F.lit(1)).alias("total_rows"))
    return side_by_side(
        totals,
        checkpoint_of(checkpoints, stream).agg(F.max("last_slot").alias("checkpoint")),
        _age(updates, as_of),
        _count(current_gaps(gaps).filter(F.col("filled") == 0), "unfilled_gaps"),
        collapsed_count(snapshots, alias="snap_rows"),
        reserves.agg(F.max("slot").alias("reserve_max")),
    ).select("latest_slot", "checkpoint", "ingest_age_s", "unfilled_gaps", "total_rows", "snap_rows", "reserve_max")


def ingest_stats(
    updates: DataFrame, snapshots: DataFrame, checkpoints: DataFrame, gaps: DataFrame, as_of, stream: str = DEFAULT_STREAM
) -> DataFrame:
    """Row and key counts, positions, ingest age, open gaps."""
    return side_by_side(
        updates.agg(F.count(F.lit(1)).alias("total_rows"), F.max("slot").alias("latest_slot")),
        _distinct(updates, "pubkey", "distinct_pubkeys"),
        checkpoint_of(checkpoints, stream).agg(F.max("last_slot").alias("checkpoint")),
        _age(updates, as_of),
        _count(current_gaps(gaps).filter(F.col("filled") == 0), "unfilled_gaps"),
        collapsed_count(snapshots, alias="snap_rows"),
    ).select("total_rows", "distinct_pubkeys", "latest_slot", "checkpoint", "ingest_age_s", "unfilled_gaps", "snap_rows")


def dataset_summary(updates: DataFrame, snapshots: DataFrame, gaps: DataFrame, as_of) -> DataFrame:
    """The published figures in one row."""
    millis = F.unix_millis(F.col("ingested_at").cast("timestamp"))
    health = stored(collapse(snapshots, columns=["pubkey", "health_factor_bps"]), "health")
    per_key = health.groupBy("pubkey").agg(F.count(F.lit(1)).alias("n"), F.count_if(active_debt()).alias("debts"))
    counts = value_counts(health.filter(active_debt()), "health_factor_bps")
    # The updates are read once: per full key, then per slot, then in all.
    keys = updates.groupBy("slot", "pubkey", "write_version").agg(
        F.count(F.lit(1)).alias("n"), F.min(millis).alias("first_ms"), F.max(millis).alias("latest_ms")
    )
    slots = keys.groupBy("slot").agg(
        F.sum("n").alias("n"), F.count(F.lit(1)).alias("keys"), F.min("first_ms").alias("first_ms"), F.max("latest_ms").alias("latest_ms")
    )
    figures = counts.agg(
        F.coalesce(F.sum("n"), F.lit(0)).alias("valid_snapshots"),
        F.coalesce(F.sum(F.when(F.col("v") < AT_RISK_HEALTH, F.col("n")).otherwise(0)), F.lit(0)).alias("at_risk"),
    )
    one = side_by_side(
        slots.agg(
            F.coalesce(F.sum("n"), F.lit(0)).alias("rows_raw"),
            F.coalesce(F.sum("keys"), F.lit(0)).alias("rows_collapsed"),
            F.count("slot").alias("density_slots"),
            F.min("slot").alias("first_slot"),
            F.min("first_ms").alias("first_ms"),
            F.max("slot").alias("latest_slot"),
            F.max("latest_ms").alias("latest_ms"),
            (F.unix_seconds(_at(as_of)) - F.expr("max(latest_ms) div 1000")).alias("ingest_age_s"),
        ),
        per_key.agg(
            F.coalesce(F.sum("n"), F.lit(0)).alias("snapshots"),
            F.count(F.lit(1)).alias("ever_seen"),
            F.count_if(F.col("debts") > 0).alias("active"),
        ),
        figures,
        percentile_row(counts, {"median": 0.5}),
        _count(current_gaps(gaps).filter(F.col("filled") == 0), "unfilled_gaps"),
    )
    span = F.col("latest_slot") - F.col("first_slot")
    return one.select(
        "rows_raw",
        "rows_collapsed",
        "ever_seen",
        "active",
        "snapshots",
        "valid_snapshots",
        F.round(F.col("median") / HEALTH_SCALE, 4).alias("median_health"),
        "at_risk",
        "first_slot",
        "first_ms",
        "latest_slot",
        "latest_ms",
        F.col("ingest_age_s").alias("lag_s"),
        "density_slots",
        span.alias("density_span"),
        F.round(F.col("density_slots") * 100.0 / F.nullif(span, F.lit(0)), 4).alias("density_pct"),
        "unfilled_gaps",
    )


def freeze_manifest(updates: DataFrame, snapshots: DataFrame) -> DataFrame:
    """What a frozen dataset contains."""
    millis = F.unix_millis(F.max(F.col("ingested_at").cast("timestamp")))
    keys = snapshots.select("pubkey", "slot", "write_version").distinct()
    return side_by_side(
        updates.agg(F.max("slot").alias("last_slot"), F.count(F.lit(1)).alias("account_updates_rows"), millis.alias("last_ingested_ms")),
        _distinct(snapshots, "pubkey", "obligations_distinct"),
        _count(keys, "obligation_snapshots_rows"),
    )


def provenance_counts(tables: dict[str, DataFrame]) -> DataFrame:
    """Per table: rows from state dumps, rows from the stream, distinct accounts."""
    dumped = F.col("write_version") == STATE_DUMP_WRITE_VERSION
    parts = []
    for name, df in tables.items():
        per_key = df.groupBy("pubkey").agg(F.count_if(dumped).alias("dumped"), F.count_if(~dumped).alias("streamed"))
        parts.append(
            per_key.agg(
                F.coalesce(F.sum("dumped"), F.lit(0)).alias("snapshot_rows"),
                F.coalesce(F.sum("streamed"), F.lit(0)).alias("stream_rows"),
                F.count(F.lit(1)).alias("accounts"),
            ).select(F.lit(name).alias("table_name"), "snapshot_rows", "stream_rows", "accounts")
        )
    return reduce(DataFrame.unionByName, parts)


def distinct_accounts(tables: dict[str, DataFrame], approximate: bool = False) -> DataFrame:
    """Distinct keys per table, exact unless asked otherwise."""
    parts = []
    for name, df in tables.items():
        found = df.agg(F.approx_count_distinct("pubkey", 0.01).alias("accounts")) if approximate else _distinct(df, "pubkey", "accounts")
        parts.append(found.select(F.lit(name).alias("table_name"), "accounts"))
    return reduce(DataFrame.unionByName, parts)


def table_status(tables: dict[str, DataFrame]) -> DataFrame:
    """One status row per table."""
    parts = [
        df.agg(F.count(F.lit(1)).alias("n"), F.coalesce(F.max("slot"), F.lit(-1)).alias("max_slot")).select(
            F.lit(name).alias("table_name"), "n", "max_slot"
        )
        for name, df in tables.items()
    ]
    return reduce(DataFrame.unionByName, parts)


def dump_rows_with_run(rows: DataFrame, runs: DataFrame) -> DataFrame:
    """State-dump rows with the run they belong to.

    A row carries the slot of its own page and the run carries the newest one, so equality would miss
    the earlier pages: a row belongs to the runs at the first run slot at or after its own; of two scopes
    at one slot, to both. The distinct page slots meet the runs first, cut at slot-bucket borders, and the
    rows then meet their own slot, so that a dump in one bucket is not gathered.
    """
    runs = collapse_table(runs, "snapshot_runs").select(F.col("slot").alias("run_slot"), "scope")
    ordered = Window.orderBy("run_slot")  # one row per run slot
    spans = runs.select("run_slot").distinct()
    spans = spans.withColumn("after_slot", F.coalesce(F.lag("run_slot").over(ordered), F.lit(-1)))
    cells = spans.withColumn(
        "cell",
        F.explode(F.expr(f"sequence((after_slot + 1) div {SLOTS_PER_BUCKET}, run_slot div {SLOTS_PER_BUCKET})")),
    )
    dumped = rows.filter(F.col("write_version") == STATE_DUMP_WRITE_VERSION)
    pages = dumped.select("slot").distinct().withColumn("cell", F.expr(f"slot div {SLOTS_PER_BUCKET}"))
    inside = (F.col("slot") > F.col("after_slot")) & (F.col("slot") <= F.col("run_slot"))
    found = pages.join(cells, "cell").filter(inside).join(runs, "run_slot").select("slot", "run_slot", "scope")
    return dumped.join(found, "slot")
