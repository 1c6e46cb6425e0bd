"""Position health: distribution, radar, history, audits."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from slotwise.functions.base58 import readable
from slotwise.functions.numbers import active_debt, flag_text, fraction, health_factor, health_ratio, padded_text
from slotwise.operators.dedup import collapse, latest
from slotwise.operators.ordering import page_after
from slotwise.operators.quantiles import approximate_columns, percentile_row, value_counts
from slotwise.operators.rows import side_by_side, top
from slotwise.schemas import AT_RISK_HEALTH, HEALTH_SCALE, RADAR_HEALTH, VERSION_KEY
from slotwise.session import stored

HEALTH = "health_factor_bps"
DISTRIBUTION = {
    "p10_health": 0.10,
    "p25_health": 0.25,
    "median_health": 0.5,
    "p75_health": 0.75,
    "p90_health": 0.90,
    "p99_health": 0.99,
}
# Upper bounds and labels of the histogram.
HISTOGRAM = (
    (1.0, "1: <1.0 liquidatable"),
    (1.05, "2: 1.0-1.05 at-risk"),
    (1.25, "3: 1.05-1.25"),
    (1.5, "4: 1.25-1.5"),
    (2.0, "5: 1.5-2.0"),
    (3.0, "6: 2.0-3.0"),
    (5.0, "7: 3.0-5.0"),
    (10.0, "8: 5.0-10.0"),
)
HISTOGRAM_REST = "9: >=10.0"


def _rows(snapshots: DataFrame, columns: Sequence[str], collapsed: bool) -> DataFrame:
    """The needed columns, one row per version. Exported tables are collapsed already."""
    return snapshots.select(*columns) if collapsed else collapse(snapshots, columns=columns)


def _scaled(column: str):
    return F.round(F.col(column).cast("double") / HEALTH_SCALE, 4).alias(column)


def health_distribution(snapshots: DataFrame, collapsed: bool = False, approximate: bool = False) -> DataFrame:
    """Count, extremes, percentiles and at-risk share of health over all rows with active debt."""
    active = _rows(snapshots, ["pubkey", HEALTH], collapsed).filter(active_debt())
    if approximate:
        # One aggregate over the plain column: no table of counts is made.
        counts = active.select(F.col(HEALTH).alias("v"), F.lit(1).alias("n"))
        extra = approximate_columns("v", DISTRIBUTION)
    else:
        counts, extra = value_counts(active, HEALTH), []
    one = counts.agg(
        F.coalesce(F.sum("n"), F.lit(0)).alias("valid_snapshots"),
        F.min("v").cast("double").alias("min_health"),
        F.max("v").cast("double").alias("max_health"),
        F.coalesce(F.sum(F.when(F.col("v") < AT_RISK_HEALTH, F.col("n")).otherwise(0)), F.lit(0)).alias("at_risk_below_1p05"),
        *extra,
    )
    if not approximate:
        one = side_by_side(one, percentile_row(counts, DISTRIBUTION))
    share = F.col("at_risk_below_1p05") / F.nullif(F.col("valid_snapshots"), F.lit(0))
    return one.select(
        "valid_snapshots",
        _scaled("min_health"),
        *[_scaled(name) for name in DISTRIBUTION],
        _scaled("max_health"),
        "at_risk_below_1p05",
        F.round(share, 4).alias("at_risk_share"),
    )


def health_histogram(snapshots: DataFrame, collapsed: bool = False) -> DataFrame:
    """Rows with active debt per labelled health range."""
    active = _rows(snapshots, ["pubkey", HEALTH], collapsed).filter(active_debt())
    health = F.col(HEALTH).cast("double") / HEALTH_SCALE
    bucket = F.lit(HISTOGRAM_REST)
    for bound, label in reversed(HISTOGRAM):
        bucket = F.when(health < bound, F.lit(label)).otherwise(bucket)
    return active.groupBy(bucket.alias("bucket")).agg(F.count(F.lit(1)).alias("n")).orderBy("bucket")


def overview(reserves: DataFrame, snapshots: DataFrame, collapsed: bool = False) -> DataFrame:
    """Headline figures: reserves, positions with debt, median, at-risk rows, p25 below 10.0.

    `active` counts keys that are not at the no-debt value, zero health included, unlike the others.
    """
    rows = _rows(snapshots, ["pubkey", HEALTH], collapsed)
    rows = rows if collapsed else stored(rows, "health")
    not_free = health_ratio().isNotNull() | (F.col(HEALTH) == 0)
    keys = rows.filter(not_free).select("pubkey").distinct().agg(F.count(F.lit(1)).alias("active"))
    counts = value_counts(rows.filter(active_debt()), HEALTH)
    at_risk = counts.agg(
        F.coalesce(F.sum(F.when(F.col("v") < AT_RISK_HEALTH, F.col("n")).otherwise(0)), F.lit(0)).alias("at_risk")
    )
    median = percentile_row(counts, {"med_health": 0.5})
    p25 = percentile_row(counts.filter(F.col("v") < 10 * HEALTH_SCALE), {"p25": 0.25})
    kept = reserves.select("pubkey").distinct().agg(F.count(F.lit(1)).alias("reserves"))
    return side_by_side(kept, keys, median, at_risk, p25).select(
        "reserves",
        "active",
        (F.col("med_health") / HEALTH_SCALE).alias("med_health"),
        "at_risk",
        (F.col("p25") / HEALTH_SCALE).alias("p25"),
    )


def risk_radar(
    snapshots: DataFrame, collapsed: bool = False, current: bool = False, limit: int = 15, render: bool = True
) -> DataFrame:
    """Least healthy positions by their latest row, health below 2.0.

    By default the no-debt rows are dropped first, so a repaid position still shows its last row with
    debt. `current=True` takes the latest row of each position first and drops repaid ones.
    """
    state = [HEALTH, "owner", "num_deposits", "num_borrows"]
    rows = _rows(snapshots, ["pubkey", "slot", "write_version", *state], collapsed)
    if current:
        found = latest(rows, state).filter(active_debt())
    else:
        found = latest(rows.filter(active_debt()), state)
    found = top(found.filter(F.col(HEALTH) < RADAR_HEALTH), limit, HEALTH, "pubkey")
    key = readable(found) if render else F.col("pubkey")
    owner = readable(found, "owner") if render else F.col("owner")
    return found.select(
        key.alias("pk"), owner.alias("ow"), F.col(HEALTH).alias("hf"), F.col("num_deposits").alias("dep"), F.col("num_borrows").alias("bor")
    )


def discover_keys(snapshots: DataFrame, collapsed: bool = False, limit: int = 10) -> DataFrame:
    """Positions with the most versions."""
    rows = snapshots if collapsed else snapshots.select(*VERSION_KEY).distinct()
    return rows.groupBy("pubkey").agg(F.count(F.lit(1)).alias("n")).orderBy(F.desc("n"), "pubkey").limit(limit)


HISTORY = ("slot", "write_version", HEALTH, "num_deposits", "num_borrows")


def account_history(snapshots: DataFrame, key, columns: Sequence[str] = HISTORY) -> DataFrame:
    """All versions of one position in order. `key` is a value or a one-column DataFrame of keys."""
    if isinstance(key, DataFrame):
        mine = snapshots.join(key.select("pubkey"), "pubkey", "left_semi")
    else:
        mine = snapshots.filter(F.col("pubkey") == F.lit(key))
    wanted = list(dict.fromkeys(["pubkey", "slot", "write_version", *columns]))
    return collapse(mine, columns=wanted).orderBy("slot", "write_version").select(*columns)


def history_page(snapshots: DataFrame, key, after: tuple[int, int] | None, size: int = 1000) -> DataFrame:
    """One page of `account_history`, continuing after the (slot, write_version) of the last row seen."""
    mine = snapshots if key is None else snapshots.filter(F.col("pubkey") == F.lit(key))
    order = ("slot", "write_version") if key is not None else ("slot", "write_version", "pubkey")
    if after is not None:
        mine = mine.filter(F.col("slot") >= F.lit(after[0]))
    rows = collapse(mine, columns=list(dict.fromkeys([*order, "pubkey", *HISTORY])))
    return page_after(rows, order, after, size).select("pubkey", *HISTORY)


def position_values(snapshots: DataFrame) -> DataFrame:
    """Readable money columns. Rows from before the value columns existed hold 0 and are left out."""
    have = F.col("deposited_value_sf") > 0
    deposited, borrowed = fraction("deposited_value_sf"), fraction("borrowed_value_sf")
    allowed = fraction("allowed_borrow_value_sf")
    return snapshots.filter(have).select(
        "pubkey",
        "slot",
        "write_version",
        deposited.alias("deposited"),
        borrowed.alias("borrowed"),
        allowed.alias("max_borrow"),
        (allowed - borrowed).alias("headroom"),
        (borrowed / deposited).alias("ltv"),
        (F.col("lowest_deposit_liquidation_ltv").cast("double") / 100).alias("liquidation_ltv_pct"),
        health_ratio().alias("health"),
    )


def market_settings(markets: DataFrame) -> DataFrame:
    """Latest settings of every market, flags unpacked."""
    columns = ["flags", "referral_fee_bps", "name"]
    newest = latest(markets, [*columns, "slot"])
    return newest.select(
        "pubkey",
        *[flag_text("flags", i).alias(n) for i, n in enumerate(("emergency_mode", "autodeleverage", "borrow_disabled", "immutable"))],
        (F.col("referral_fee_bps") / 100.0).alias("referral_fee_pct"),
        padded_text("name").alias("name_str"),
    )


def health_audit(snapshots: DataFrame, deposited: str, adjusted_debt: str) -> DataFrame:
    """Rows whose stored health differs from the one recomputed from their own stored inputs."""
    again = health_factor(deposited, adjusted_debt)
    return snapshots.withColumn("recomputed", again).filter(~F.col(HEALTH).eqNullSafe(F.col("recomputed")))


def value_invariants(snapshots: DataFrame, allowed: str, unhealthy: str, deposited: str) -> DataFrame:
    """How many rows break allowed < unhealthy < deposited. Rows without a deposit state nothing."""
    stated = snapshots.filter(F.col(deposited) > 0)
    low, high = F.col(allowed) >= F.col(unhealthy), F.col(unhealthy) >= F.col(deposited)
    return stated.agg(
        F.count(F.lit(1)).alias("checked"),
        F.count_if(low).alias("allowed_not_below_unhealthy"),
        F.count_if(high).alias("unhealthy_not_below_deposited"),
        F.count_if(low | high).alias("violations"),
    )
