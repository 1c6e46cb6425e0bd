"""Volume, flow and liquidity."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from slotwise.functions.base58 import readable
from slotwise.functions.slots import slot_bucket
from slotwise.operators.dedup import collapse, latest
from slotwise.operators.rows import side_by_side, top
from slotwise.schemas import BUCKET_COLUMN, DECODED_KINDS, MILLIS_PER_SLOT


def _at(as_of: datetime | str) -> Column:
    return F.lit(str(as_of)).cast("timestamp")


def _with_bucket(updates: DataFrame) -> DataFrame:
    return updates if BUCKET_COLUMN in updates.columns else updates.withColumn(BUCKET_COLUMN, slot_bucket())


def activity(updates: DataFrame) -> DataFrame:
    """Per slot bucket: updates, accounts, payload bytes, slot range. Never opens a payload.

    Accounts are counted by aggregating per (bucket, account) first, so that a bucket or an account with
    a large share of the rows is combined on the map side.
    """
    per_account = _with_bucket(updates).groupBy(BUCKET_COLUMN, "pubkey").agg(
        F.count(F.lit(1)).alias("n"),
        F.sum("data_len").alias("bytes"),
        F.min("slot").alias("lo"),
        F.max("slot").alias("hi"),
    )
    return (
        per_account.groupBy(BUCKET_COLUMN)
        .agg(
            F.sum("n").alias("updates"),
            F.count(F.lit(1)).alias("accounts"),
            F.sum("bytes").alias("payload_bytes"),
            F.min("lo").alias("first_slot"),
            F.max("hi").alias("last_slot"),
            (F.max("hi") - F.min("lo")).alias("slot_span"),
        )
        .orderBy(BUCKET_COLUMN)
    )


def hot_accounts(updates: DataFrame, limit: int = 20, render: bool = True) -> DataFrame:
    """Accounts rewritten most often. Keys are rendered only on the rows that remain.

    The two-step aggregation counts distinct slots without holding a set of them for any account.
    """
    per_slot = updates.groupBy("pubkey", "slot").agg(F.max("kind").alias("kind"), F.count(F.lit(1)).alias("n"))
    accounts = per_slot.groupBy("pubkey").agg(
        F.max("kind").alias("kind"),
        F.sum("n").alias("updates"),
        F.count(F.lit(1)).alias("slots_touched"),
        F.max("slot").alias("last_seen"),
    )
    hottest = top(accounts, limit, F.desc("updates"), "pubkey")
    return hottest.withColumn("pubkey", readable(hottest)) if render else hottest


def kind_mix(updates: DataFrame, by_length: bool = False) -> DataFrame:
    """Rows, share, accounts and slot range per kind, or rows and share per (kind, payload length)."""
    if by_length:
        groups = updates.groupBy("kind", "data_len").agg(F.count(F.lit(1)).alias("updates"))
        total = F.sum("updates").over(Window.partitionBy())  # one row per (kind, length)
        return groups.withColumn("share_pct", F.round(F.col("updates") * 100.0 / total, 2))
    per_account = updates.groupBy("kind", "pubkey").agg(
        F.count(F.lit(1)).alias("n"), F.min("slot").alias("lo"), F.max("slot").alias("hi")
    )
    groups = per_account.groupBy("kind").agg(
        F.sum("n").alias("updates"),
        F.count(F.lit(1)).alias("accounts"),
        F.min("lo").alias("first_slot"),
        F.max("hi").alias("last_slot"),
    )
    total = F.sum("updates").over(Window.partitionBy())  # one row per kind
    return groups.withColumn("share_pct", F.round(F.col("updates") * 100.0 / total, 2))


def slot_density(updates: DataFrame) -> DataFrame:
    """Share of slots that carry an update. Divides by max - min, as the published figure does."""
    slots = updates.select("slot").distinct()
    span = F.max("slot") - F.min("slot")
    return slots.agg(
        F.min("slot").alias("first_slot"),
        F.max("slot").alias("last_slot"),
        F.count(F.lit(1)).alias("slots_with_updates"),
        span.alias("slot_span"),
        F.round(F.count(F.lit(1)) * 100.0 / F.nullif(span, F.lit(0)), 4).alias("density_pct"),
    )


def throughput(updates: DataFrame, as_of=None, minutes: int | None = None) -> DataFrame:
    """Rows and kilobytes per second between the first and the last arrival, optionally of a last window."""
    rows = updates
    if as_of is not None and minutes is not None:
        edge = _at(as_of)
        rows = rows.filter((F.col("ingested_at") > edge - F.expr(f"interval {int(minutes)} minutes")) & (F.col("ingested_at") <= edge))
    seconds = F.expr("unix_seconds(max(cast(ingested_at as timestamp))) - unix_seconds(min(cast(ingested_at as timestamp)))")
    return rows.agg(
        F.count(F.lit(1)).alias("updates"),
        F.coalesce(F.sum("data_len"), F.lit(0)).alias("payload_bytes"),
        seconds.alias("seconds"),
    ).select(
        "updates",
        "payload_bytes",
        F.coalesce("seconds", F.lit(0)).alias("seconds"),
        F.round(F.col("updates") / F.nullif(F.col("seconds"), F.lit(0)), 4).alias("rows_per_second"),
        F.round(F.col("payload_bytes") / 1024.0 / F.nullif(F.col("seconds"), F.lit(0)), 4).alias("kb_per_second"),
    )


def flow(updates: DataFrame, as_of, minutes: int = 60, kinds=DECODED_KINDS) -> DataFrame:
    """Writes per minute of the last window, by kind. Replays count: this measures work, not accounts."""
    edge = _at(as_of)
    recent = updates.filter(
        (F.col("ingested_at") >= edge - F.expr(f"interval {int(minutes)} minutes")) & (F.col("ingested_at") < edge)
    )
    minute = F.unix_seconds(F.date_trunc("minute", F.col("ingested_at").cast("timestamp"))).alias("minute")
    return (
        recent.groupBy(minute)
        .agg(
            F.count(F.lit(1)).alias("writes"),
            *[F.count_if(F.col("kind") == kind).alias(flow_column(kind)) for kind in kinds],
            F.sum("data_len").alias("bytes"),
        )
        .orderBy("minute")
    )


def flow_column(kind: str) -> str:
    return "writes_" + "".join("_" + c.lower() if c.isupper() else c for c in kind).strip("_")


def flow_filled(updates: DataFrame, as_of, minutes: int = 60, kinds=DECODED_KINDS) -> DataFrame:
    """`flow` on a fixed axis of `minutes` points, so that an outage shows as zeros, not as a shorter chart.

    The minute that contains `as_of` is still filling; it is marked and belongs in no average.
    """
    spark = updates.sparkSession
    edge = F.unix_seconds(F.date_trunc("minute", _at(as_of)))
    axis = spark.range(1).select(
        F.explode(F.sequence(edge - F.lit((int(minutes) - 1) * 60), edge, F.lit(60).cast("bigint"))).alias("minute")
    )
    measured = flow(updates, as_of, minutes, kinds)
    filled = axis.join(measured, "minute", "left")
    values = [c for c in measured.columns if c != "minute"]
    return filled.select(
        "minute",
        *[F.coalesce(c, F.lit(0)).alias(c) for c in values],
        (F.col("minute") >= edge).alias("partial"),
    ).orderBy("minute")


def mean_flow(filled: DataFrame) -> DataFrame:
    """Mean writes per complete minute."""
    return filled.filter(~F.col("partial")).agg(
        F.count(F.lit(1)).alias("minutes"), F.round(F.avg("writes"), 4).alias("mean_writes")
    )


def liquidity_depth(
    reserves: DataFrame, collapsed: bool = False, limit: int | None = 15, below: int | None = None, render: bool = True
) -> DataFrame:
    """Reserves by available amount at their latest row; `below` keeps the nearly empty ones instead.

    Raw amounts are in units of each token, so ranks compare different scales; `available` is scaled.
    """
    state = ["available_amount", "borrowed_amount_sf", "mint_decimals", "liquidity_mint"]
    columns = ["pubkey", "slot", "write_version", *state]
    rows = reserves.select(*columns) if collapsed else collapse(reserves, columns=columns)
    found = latest(rows, state)
    if below is not None:
        found, order = found.filter(F.col("available_amount") < below), F.asc("available_amount")
    else:
        order = F.desc("available_amount")
    found = top(found, limit, order, "pubkey") if limit is not None else found
    key = readable(found) if render else F.col("pubkey")
    mint = readable(found, "liquidity_mint") if render else F.col("liquidity_mint")
    return found.select(
        key.alias("pk"),
        F.col("available_amount").alias("avail"),
        F.col("borrowed_amount_sf").alias("borr"),
        F.col("mint_decimals").alias("dec"),
        mint.alias("liq_mint"),
        (F.col("available_amount").cast("double") / F.pow(F.lit(10.0), F.col("mint_decimals"))).alias("available"),
    )


def with_symbols(depth: DataFrame, symbols: DataFrame) -> DataFrame:
    """Add token symbols (mint, symbol) to `liquidity_depth`; tokens without one keep their key."""
    named = depth.join(symbols.select(F.col("mint").alias("liq_mint"), "symbol"), "liq_mint", "left")
    return named.withColumn("symbol", F.coalesce("symbol", F.col("liq_mint").cast("string")))


def session_summary(updates: DataFrame) -> DataFrame:
    """One row on a session's slice: span, chain seconds, density, payload rate."""
    density = slot_density(updates).select("first_slot", "last_slot", "slot_span", "slots_with_updates")
    volume = updates.agg(
        F.count(F.lit(1)).alias("updates"), F.coalesce(F.sum("data_len"), F.lit(0)).alias("payload_bytes")
    )
    seconds = F.col("slot_span") * (MILLIS_PER_SLOT / 1000)
    return side_by_side(density, volume).select(
        "first_slot",
        "last_slot",
        "slot_span",
        F.round(seconds, 1).alias("chain_seconds"),
        "slots_with_updates",
        F.round(F.coalesce(F.col("slots_with_updates") * 100.0 / F.nullif(F.col("slot_span"), F.lit(0)), F.lit(0.0)), 1).alias("density_pct"),
        "updates",
        "payload_bytes",
        F.round(F.col("payload_bytes") / 1024.0 / F.nullif(seconds, F.lit(0.0)), 4).alias("kb_per_second"),
    )
