"""Every registered query: name -> function of (spark, folder of the test tables)."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from checks import standins as S
from slotwise.functions import numbers as N
from slotwise.functions.kinds import classify_kind, with_derived
from slotwise.functions.layouts import decode
from slotwise.functions.slots import hot_bucket, slot_between, slot_bucket
from slotwise.operators.dedup import collapse, collapse_table, drop_replays, latest
from slotwise.operators.quantiles import approximate_row
from slotwise.operators.rows import side_by_side
from slotwise.plans import activity, dashboard, decoding, health, quality, rollups, summary
from slotwise.session import ship_package, tidy, work_dir
from slotwise.sources import cold, hot, paging, updates
from slotwise.sources import segments
from slotwise.sources import state_dump as dumps
from slotwise.streaming import freshness as watch
from slotwise.streaming import ingest, monitors

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}


def query(fn: Query) -> Query:
    def run(spark: SparkSession, sf: str) -> DataFrame:
        spark.conf.set("spark.sql.session.timeZone", "UTC")
        ship_package(spark)
        return fn(spark, sf)

    run.__name__, run.__doc__ = fn.__name__, fn.__doc__
    QUERIES[fn.__name__] = run
    return run


def millis(column: str):
    return F.unix_millis(F.col(column).cast("timestamp"))


def key_number(column):
    """The number in a 32-byte key made by `standins.key32`."""
    return F.conv(F.substring(F.hex(column), 49, 16), 16, 10).cast("bigint")


# --- collapsing and latest state --------------------------------------------------------------


@query
def collapse_updates(spark, sf):
    rows = collapse(S.account_updates(spark, sf))
    return rows.select("slot", "write_version", "pubkey", "kind", "lamports", "data", "data_len", millis("ingested_at").alias("ingested_ms"))


@query
def collapse_snapshots(spark, sf):
    rows = collapse_table(S.obligation_snapshots(spark, sf), "obligation_snapshots")
    return rows.select("slot", "write_version", "pubkey", F.col("health_factor_bps").cast("string").alias("hf"), millis("ingested_at").alias("ingested_ms"))


@query
def collapse_checkpoints(spark, sf):
    rows = collapse_table(S.ingest_checkpoint(spark, sf), "ingest_checkpoint")
    return rows.select("stream", "last_slot", "last_write_version", millis("updated_at").alias("updated_ms"))


@query
def collapse_reserves(spark, sf):
    rows = collapse_table(S.reserve_snapshots(spark, sf), "reserve_snapshots")
    return rows.select("slot", "write_version", "pubkey", "available_amount", "borrowed_amount_sf", millis("ingested_at").alias("ingested_ms"))


@query
def collapse_markets(spark, sf):
    """Decoded market rows, every one stored twice by two runs."""
    silver = decoding.redecode(S.bronze(spark, sf), S.LAYOUTS)["lending_market_snapshots"]
    again = silver.withColumn("ingested_at", F.expr("ingested_at + interval 1 hour"))
    rows = collapse_table(silver.unionByName(again), "lending_market_snapshots")
    return rows.select("slot", "write_version", key_number("pubkey").alias("pubkey"), F.col("flags").cast("int").alias("flags"))


@query
def collapse_gaps(spark, sf):
    rows = collapse_table(S.slot_gaps(spark, sf), "slot_gaps")
    return rows.select("stream", "start_slot", "end_slot", F.col("filled").cast("int").alias("filled"), "reason")


@query
def collapse_runs(spark, sf):
    """Run rows recorded twice, the second time with a duration."""
    runs = S.snapshot_runs(spark, sf)
    later = runs.withColumn("duration_ms", F.lit(5).cast("bigint")).withColumn("ingested_at", F.expr("ingested_at + interval 1 hour"))
    return collapse_table(runs.unionByName(later), "snapshot_runs").select("slot", "scope", "accounts", "duration_ms")


@query
def distinct_accounts(spark, sf):
    """Exact distinct keys of every table."""
    return summary.distinct_accounts(_tables(spark, sf))


@query
def intra_slot_versions(spark, sf):
    """All versions of an account inside one slot survive collapsing."""
    rows = collapse(S.reserve_snapshots(spark, sf), columns=["pubkey", "slot", "write_version"])
    return rows.groupBy("pubkey", "slot").agg(F.count(F.lit(1)).alias("versions")).filter(F.col("versions") > 1)


@query
def latest_state(spark, sf):
    rows = collapse(S.obligation_snapshots(spark, sf))
    state = latest(rows, ["slot", "write_version", "health_factor_bps", "owner", "flags"])
    return state.select("pubkey", "slot", "write_version", F.col("health_factor_bps").cast("string").alias("hf"), "owner", "flags")


@query
def replay_share(spark, sf):
    return quality.replay_share(S.account_updates(spark, sf))


# --- health -----------------------------------------------------------------------------------


@query
def health_distribution(spark, sf):
    return health.health_distribution(S.obligation_snapshots(spark, sf))


@query
def health_distribution_approximate(spark, sf):
    """Single-pass form; `health_distribution_rank_error` tests its bound."""
    return health.health_distribution(S.obligation_snapshots(spark, sf), approximate=True)


@query
def health_distribution_rank_error(spark, sf):
    """Whether each approximate percentile stands where it should, within the sketch's rank error of 1/10000."""
    rows = collapse(S.obligation_snapshots(spark, sf), columns=["health_factor_bps"]).filter(N.active_debt())
    value, named = F.col("health_factor_bps").cast("double"), {n: p for n, p in health.DISTRIBUTION.items()}
    at = approximate_row(rows, "health_factor_bps", named).first()  # one row
    below = [F.count_if(value < at[n]).alias(f"{n}_below") for n in named]
    upto = [F.count_if(value <= at[n]).alias(f"{n}_upto") for n in named]
    counts = rows.agg(F.count(F.lit(1)).alias("n"), *below, *upto)
    slack = F.col("n") / 10_000 + 1
    within = [
        F.struct(F.lit(n).alias("percentile"), ((F.col(f"{n}_below") - slack <= F.col("n") * p) & (F.col("n") * p <= F.col(f"{n}_upto") + slack)).alias("within"))
        for n, p in named.items()
    ]
    return counts.select(F.inline(F.array(*within)))


@query
def health_histogram(spark, sf):
    return health.health_histogram(S.obligation_snapshots(spark, sf))


@query
def overview(spark, sf):
    return health.overview(S.reserve_snapshots(spark, sf), S.obligation_snapshots(spark, sf))


@query
def risk_radar(spark, sf):
    found = health.risk_radar(S.obligation_snapshots(spark, sf))
    return found.withColumn("hf", F.col("hf").cast("bigint"))


@query
def risk_radar_current(spark, sf):
    found = health.risk_radar(S.obligation_snapshots(spark, sf), current=True)
    return found.withColumn("hf", F.col("hf").cast("bigint"))


@query
def discover_keys(spark, sf):
    return health.discover_keys(S.obligation_snapshots(spark, sf))


@query
def account_history(spark, sf):
    """History of the most-versioned position."""
    snapshots = S.obligation_snapshots(spark, sf)
    rows = health.account_history(snapshots, health.discover_keys(snapshots, limit=1))
    return rows.withColumn("health_factor_bps", F.col("health_factor_bps").cast("string"))


@query
def account_history_hot(spark, sf):
    """`account_history` from a copy ordered by key, of which one folder is read."""
    snapshots, out = S.obligation_snapshots(spark, sf), work_dir(spark, "hot")
    hot.write_hot(snapshots, out, "obligation_snapshots", "all")
    key = health.discover_keys(snapshots, limit=1).first().pubkey
    rows = hot.key_history(spark, out, "obligation_snapshots", key, list(health.HISTORY), snapshots.schema)
    return rows.withColumn("health_factor_bps", F.col("health_factor_bps").cast("string"))


@query
def key_states_hot(spark, sf):
    """Rows, versions and newest slot per key bucket of a hot copy that took over three stored batches one after the other."""
    root, out, wire = work_dir(spark, "store"), work_dir(spark, "hot"), S.wire_updates(spark, sf)
    part = F.pmod(F.col("write_version"), F.lit(3))
    rows = with_derived(wire).withColumn(updates.SESSION_COLUMN, F.lit(None).cast("string"))
    for i in range(3):
        updates.write_batch(rows.filter(part == i), root, "account_updates", f"b{i}")
        hot.refresh_hot(spark, root, "account_updates", out, buckets=16)
    updates.compact(spark, root, "account_updates")
    hot.refresh_hot(spark, root, "account_updates", out, buckets=16)
    copy = hot.read_hot(spark, out, "account_updates")
    per_key = latest(copy, ["slot", "data_len"]).groupBy().agg(F.count(F.lit(1)).alias("accounts"), F.sum("data_len").alias("newest_bytes"), F.max("slot").alias("last_slot"))
    return side_by_side(copy.agg(F.count(F.lit(1)).alias("n"), F.sum("data_len").alias("bytes")), per_key)


@query
def history_page_seek(spark, sf):
    """`history_page` over stored files, of which only those that can hold the page are opened."""
    path, snapshots = work_dir(spark, "sorted"), S.obligation_snapshots(spark, sf)
    snapshots.repartitionByRange(24, *paging.ORDER).sortWithinPartitions(*paging.ORDER).write.parquet(path)
    pages = paging.Pages(spark, path, snapshots.schema, ["pubkey", *health.HISTORY])
    rows = pages.page((2000000000, 5000, 0), size=1000)
    return rows.withColumn("health_factor_bps", F.col("health_factor_bps").cast("string"))


@query
def history_page(spark, sf):
    """One page of the whole history, in (slot, write_version, pubkey) order, after a cursor."""
    rows = health.history_page(S.obligation_snapshots(spark, sf), None, (2000000000, 5000, 0), size=1000)
    return rows.withColumn("health_factor_bps", F.col("health_factor_bps").cast("string"))


@query
def health_factor(spark, sf):
    rows = S.obligation_snapshots(spark, sf, replays=False)
    return rows.select("pubkey", "slot", "write_version", N.health_factor("deposited_value", "adjusted_debt").cast("string").alias("hf"))


@query
def health_audit(spark, sf):
    """Every 97th version gets a wrong stored value, which the audit must find."""
    rows = S.obligation_snapshots(spark, sf, replays=False)
    wrong = F.when(F.col("write_version") % S.REPLAY_EVERY == 0, F.col("health_factor_bps") - 1).otherwise(F.col("health_factor_bps"))
    found = health.health_audit(rows.withColumn("health_factor_bps", wrong.cast("decimal(20,0)")), "deposited_value", "adjusted_debt")
    return found.select("pubkey", "slot", "write_version", F.col("health_factor_bps").cast("string").alias("stored"), F.col("recomputed").cast("string").alias("recomputed"))


@query
def value_invariants(spark, sf):
    rows = S.obligation_snapshots(spark, sf, replays=False)
    return health.value_invariants(rows, "adjusted_debt", "unhealthy_borrow_value", "deposited_value")


@query
def position_values(spark, sf):
    """Money columns of decoded records, scaled for reading."""
    silver = decoding.redecode(S.bronze(spark, sf), S.LAYOUTS)["obligation_snapshots"]
    rows = health.position_values(silver)
    return rows.select(
        key_number("pubkey").alias("pubkey"), "slot", "write_version",
        *[F.round(c, 6).alias(c) for c in ("deposited", "borrowed", "max_borrow", "headroom")],
        F.round("ltv", 9).alias("ltv"), "liquidation_ltv_pct",
        F.coalesce("health", F.lit(-1.0)).alias("health"),
    )


# --- activity ---------------------------------------------------------------------------------


@query
def activity_by_bucket(spark, sf):
    return activity.activity(S.account_updates(spark, sf))


@query
def hot_accounts(spark, sf):
    return activity.hot_accounts(S.account_updates(spark, sf))


@query
def kind_mix(spark, sf):
    return activity.kind_mix(S.account_updates(spark, sf))


@query
def kind_length_mix(spark, sf):
    return activity.kind_mix(S.account_updates(spark, sf), by_length=True)


@query
def slot_density(spark, sf):
    return activity.slot_density(S.account_updates(spark, sf))


@query
def throughput(spark, sf):
    return activity.throughput(S.account_updates(spark, sf))


@query
def throughput_recent(spark, sf):
    return activity.throughput(S.account_updates(spark, sf), S.FLOW_AS_OF, S.FLOW_MINUTES)


FLOW_KINDS = ("click", "view", "purchase", "signup", "error")


@query
def flow(spark, sf):
    return activity.flow(S.account_updates(spark, sf), S.FLOW_AS_OF, S.FLOW_MINUTES, FLOW_KINDS)


@query
def flow_filled(spark, sf):
    return activity.flow_filled(S.account_updates(spark, sf), S.FLOW_AS_OF, S.FLOW_MINUTES, FLOW_KINDS)


@query
def flow_mean(spark, sf):
    return activity.mean_flow(activity.flow_filled(S.account_updates(spark, sf), S.FLOW_AS_OF, S.FLOW_MINUTES, FLOW_KINDS))


@query
def liquidity_depth(spark, sf):
    return activity.liquidity_depth(S.reserve_snapshots(spark, sf))


@query
def liquidity_low(spark, sf):
    return activity.liquidity_depth(S.reserve_snapshots(spark, sf), below=2_000_000)


@query
def liquidity_symbols(spark, sf):
    """Depth of all reserves with token symbols; one token has none."""
    region = spark.read.parquet(f"{sf}/region.parquet")
    symbols = region.select(F.substring("r_name", 1, 3).alias("symbol"), F.when(F.col("r_regionkey") == 0, "O").otherwise(F.concat(F.lit("X"), F.col("r_regionkey"))).alias("mint"))
    return activity.with_symbols(activity.liquidity_depth(S.reserve_snapshots(spark, sf), limit=None), symbols)


@query
def session_summary(spark, sf):
    return activity.session_summary(S.account_updates(spark, sf))


# --- whole-dataset figures and provenance -----------------------------------------------------


@query
def dataset_summary(spark, sf):
    return summary.dataset_summary(S.account_updates(spark, sf), S.obligation_snapshots(spark, sf), S.slot_gaps(spark, sf), S.AS_OF)


@query
def ingest_stats(spark, sf):
    return summary.ingest_stats(
        S.account_updates(spark, sf), S.obligation_snapshots(spark, sf), S.ingest_checkpoint(spark, sf), S.slot_gaps(spark, sf), S.AS_OF
    )


@query
def system_status(spark, sf):
    return summary.system_status(
        S.account_updates(spark, sf), S.obligation_snapshots(spark, sf), S.reserve_snapshots(spark, sf),
        S.ingest_checkpoint(spark, sf), S.slot_gaps(spark, sf), S.AS_OF,
    )


def _tables(spark, sf):
    dumped = S.dump_accounts(spark, sf).select("slot", "write_version", "pubkey")
    streamed = S.account_updates(spark, sf).select("slot", "write_version", "pubkey")
    return {
        "account_updates": streamed.unionByName(dumped),
        "obligation_snapshots": S.obligation_snapshots(spark, sf),
        "reserve_snapshots": S.reserve_snapshots(spark, sf),
    }


@query
def provenance_counts(spark, sf):
    return summary.provenance_counts(_tables(spark, sf))


@query
def table_status(spark, sf):
    return summary.table_status(_tables(spark, sf))


@query
def provenance_runs(spark, sf):
    rows = _tables(spark, sf)["account_updates"]
    return summary.dump_rows_with_run(rows, S.snapshot_runs(spark, sf)).select("pubkey", "slot", "run_slot", "scope")


@query
def freeze_manifest(spark, sf):
    path = work_dir(spark, "manifest")
    return cold.write_manifest(S.account_updates(spark, sf), S.obligation_snapshots(spark, sf), path)


# --- gaps -------------------------------------------------------------------------------------


@query
def gaps(spark, sf):
    return quality.derive_gaps(S.account_updates(spark, sf))


@query
def gaps_live_rule(spark, sf):
    return quality.derive_gaps(S.account_updates(spark, sf), rule="drift")


@query
def top_steps(spark, sf):
    return quality.top_steps(S.account_updates(spark, sf))


@query
def slot_steps(spark, sf):
    """Every pair of consecutive distinct slots."""
    from slotwise.operators.ordering import steps

    return steps(S.account_updates(spark, sf), "slot", 1_000_000).select(F.col("prev").alias("prev_slot"), F.col("cur").alias("slot"))


@query
def arrival_silences(spark, sf):
    return quality.arrival_silences(S.account_updates(spark, sf))


@query
def resume_verdicts(spark, sf):
    rows = quality.classify_sessions(S.sessions(spark, sf))
    return rows.select(
        "session_id", F.coalesce("resume_from", F.lit(-1)).alias("resume_from"), "first_account_slot", "verdict",
        F.coalesce("drift", F.lit(-1)).alias("drift"), F.coalesce("slots_missed", F.lit(-1)).alias("slots_missed"),
    )


@query
def recorded_gaps(spark, sf):
    rows = quality.gap_rows(S.sessions(spark, sf))
    return rows.select("stream", "start_slot", "end_slot", millis("detected_at").alias("detected_ms"), F.col("filled").cast("int").alias("filled"), "reason")


@query
def current_gaps(spark, sf):
    rows = quality.current_gaps(S.slot_gaps(spark, sf))
    return rows.select("stream", "start_slot", "end_slot", F.col("filled").cast("int").alias("filled"), "reason")


@query
def failure_gaps(spark, sf):
    """Gap rows of visible failures: one per known session seam, by turns of either code; some have no end yet."""
    seams = S.sessions(spark, sf).filter("resume_from is not null")
    code = F.when(F.col("session_id") % 2 == 0, "replay_window").otherwise("early_end")
    end = F.when(F.col("session_id") % 5 == 0, F.col("resume_from")).otherwise(F.col("first_account_slot"))
    rows = quality.failure_gaps(seams.select(code.alias("code"), F.col("resume_from").alias("start_slot"), end.alias("end_slot"), "detected_at"))
    return rows.select("stream", "start_slot", "end_slot", millis("detected_at").alias("detected_ms"), F.col("filled").cast("int").alias("filled"), "reason")


@query
def gap_status(spark, sf):
    return quality.gap_status(S.slot_gaps(spark, sf))


@query
def reconcile_gaps(spark, sf):
    return quality.reconcile_gaps(S.account_updates(spark, sf), S.slot_gaps(spark, sf))


@query
def coverage(spark, sf):
    return quality.coverage(S.account_updates(spark, sf))


@query
def gaps_companion(spark, sf):
    return cold.write_gaps(S.account_updates(spark, sf), work_dir(spark, "gaps"))


# --- payload shape and freshness --------------------------------------------------------------


@query
def payload_shapes(spark, sf):
    return quality.payload_shapes(S.account_updates(spark, sf))


@query
def payload_guard(spark, sf):
    return quality.payload_guard(S.account_updates(spark, sf))


@query
def payload_alarms(spark, sf):
    return quality.payload_alarms(S.account_updates(spark, sf), every=10)


@query
def loss_report(spark, sf):
    return quality.loss_report(S.account_updates(spark, sf), _restored(spark, sf))


def _restored(spark, sf):
    """Snapshots on the updates' own clock, one for each customer, of every other key."""
    c = spark.read.parquet(f"{sf}/customer.parquet")
    return c.select((F.col("c_custkey") * 2).alias("pubkey"), (F.col("c_custkey") + 4266000000).alias("slot"), F.lit(0).cast("bigint").alias("write_version"))


@query
def lost_keys_known(spark, sf):
    return quality.lost_keys_known(S.account_updates(spark, sf), _restored(spark, sf))


@query
def lost_keys_unknown(spark, sf):
    return quality.lost_keys_unknown(S.account_updates(spark, sf), _restored(spark, sf))


@query
def kind_freeze_audit(spark, sf):
    return quality.kind_freeze_audit(S.account_updates(spark, sf), lag_slots=500_000)


@query
def freshness(spark, sf):
    return quality.freshness(S.account_updates(spark, sf), S.AS_OF)


@query
def health_check(spark, sf):
    return quality.health_check(S.account_updates(spark, sf), S.AS_OF, stale_after=300, minutes=1440)


# --- cold copy --------------------------------------------------------------------------------


def _exported(spark, sf):
    u = S.account_updates(spark, sf)
    out = work_dir(spark, "cold")
    result = cold.export_cold(u, out, "account_updates")
    return u, out, result


@query
def export_cold(spark, sf):
    """Read-back of the cold copy."""
    u, out, _ = _exported(spark, sf)
    rows = cold.read_cold_table(spark, out, "account_updates", u.schema)
    return rows.select("slot_bucket", "slot", "write_version", "pubkey", "kind", "lamports", "data", "data_len", millis("ingested_at").alias("ingested_ms"))


@query
def export_cold_snapshots(spark, sf):
    """Read-back of the cold copy of the snapshots, exported anew over an earlier copy."""
    rows, out = S.obligation_snapshots(spark, sf), work_dir(spark, "cold")
    for full in (False, True):
        cold.export_cold(rows, out, "obligation_snapshots", full=full)
    back = cold.read_cold_table(spark, out, "obligation_snapshots", rows.schema)
    return back.select("slot_bucket", "slot", "write_version", "pubkey", F.col("health_factor_bps").cast("string").alias("hf"), "deposited_value", millis("ingested_at").alias("ingested_ms"))


@query
def export_incremental(spark, sf):
    """Export of the first part of the history, then of all of it: closed buckets are skipped, the newest
    one is redone, new ones are added, and the copy equals a full export."""
    u = S.account_updates(spark, sf)
    out = work_dir(spark, "cold")
    cold.export_cold(u.filter(F.col("slot") < 4263400000), out)
    result = cold.export_cold(u, out)
    rows = cold.exported_rows(spark, result)
    return rows.withColumn("rewritten", F.col("slot_bucket").isin(list(result.buckets)))


@query
def reconcile_export(spark, sf):
    u, out, _ = _exported(spark, sf)
    end = u.agg(F.max("slot")).first()[0] + 1
    return quality.reconcile_export(u, cold.read_cold_table(spark, out, "account_updates", u.schema), upper_slot=end)


@query
def cold_activity(spark, sf):
    """The activity report on the cold copy, where copies are gone."""
    u, out, _ = _exported(spark, sf)
    return activity.activity(cold.read_cold_table(spark, out, "account_updates", u.schema))


@query
def cold_sql(spark, sf):
    """A statement of one's own over the cold views."""
    u, out, _ = _exported(spark, sf)
    return cold.query_cold(
        spark, out,
        "with per as (select slot_bucket, kind, count(*) as n from account_updates group by slot_bucket, kind) "
        "select slot_bucket, max(n) as most, count(*) as kinds from per group by slot_bucket",
        {"account_updates": u.schema},
    )


@query
def slot_range(spark, sf):
    """Updates around a slot, read with folder and row-group pruning."""
    u, out, _ = _exported(spark, sf)
    rows = cold.read_cold_table(spark, out, "account_updates", u.schema)
    return slot_between(rows, 4261900000, 4262100000).select("slot", "write_version", "pubkey", "lamports")


@query
def slot_buckets(spark, sf):
    rows = S.account_updates(spark, sf)
    return rows.groupBy(slot_bucket().alias("slot_bucket"), hot_bucket().alias("hot_bucket")).agg(F.count(F.lit(1)).alias("updates"))


@query
def late_columns(spark, sf):
    """Files from before and after the value columns under one schema: old rows read 0."""
    rows = S.obligation_snapshots(spark, sf, replays=False)
    root = work_dir(spark, "evolution")
    old, new = F.col("slot") < 2200000000, F.col("slot") >= 2200000000
    base = rows.select("slot", "write_version", key_of("pubkey"), "health_factor_bps", F.col("deposited_value").cast("decimal(38,0)").alias("deposited_value_sf"))
    updates.write_batch(base.filter(old).drop("deposited_value_sf"), root, "obligation_snapshots", "1")
    updates.write_batch(base.filter(new), root, "obligation_snapshots", "2")
    read = updates.read_table(spark, root, "obligation_snapshots")
    value = F.col("deposited_value_sf")
    return read.groupBy((F.col("slot") >= 2200000000).alias("late")).agg(
        F.count(F.lit(1)).alias("n"), F.count_if(value > 0).alias("with_value"), F.sum(value).cast("bigint").alias("total"),
        F.sum("borrowed_value_sf").cast("bigint").alias("borrowed"),
    )


def key_of(column):
    return S.key32(F.col(column)).alias(column)


# --- decoding ---------------------------------------------------------------------------------


@query
def kinds_of_payloads(spark, sf):
    rows = S.wire_updates(spark, sf).withColumn("kind", classify_kind())
    return rows.groupBy("kind").agg(F.count(F.lit(1)).alias("n"))


@query
def decode_obligations(spark, sf):
    rows = decode(S.wire_updates(spark, sf), S.LAYOUTS["Obligation"])
    money = ["deposited_value_sf", "borrowed_value_sf", "borrow_factor_adjusted_debt_sf", "allowed_borrow_value_sf", "unhealthy_borrow_value_sf", "lowest_deposit_liquidation_ltv", "health_factor_bps"]
    return rows.select(
        "slot", "write_version", *[key_number(c).alias(c) for c in ("pubkey", "owner", "lending_market", "referrer")],
        *[F.col(c).cast("int").alias(c) for c in ("num_deposits", "num_borrows", "flags", "elevation_group")],
        *[F.coalesce(F.col(c).cast("string"), F.lit("overflow")).alias(c) for c in money],
        "decode_status",
    )


@query
def decode_reserves(spark, sf):
    rows = decode(S.wire_updates(spark, sf), S.LAYOUTS["Reserve"])
    keys = ("pubkey", "lending_market", "liquidity_mint", "supply_vault", "fee_vault")
    money = ("available_amount", "borrowed_amount_sf", "market_price_sf", "acc_protocol_fees_sf", "acc_referrer_fees_sf")
    return rows.select(
        "slot", "write_version", *[key_number(c).alias(c) for c in keys], *[F.col(c).cast("string").alias(c) for c in money], "mint_decimals"
    )


@query
def decode_markets(spark, sf):
    rows = decode(S.wire_updates(spark, sf), S.LAYOUTS["LendingMarket"])
    return rows.select(
        "slot", "write_version", *[key_number(c).alias(c) for c in ("pubkey", "owner", "quote_currency")],
        F.col("flags").cast("int").alias("flags"), "referral_fee_bps",
        F.col("liquidation_max_debt_close_factor_pct").cast("int").alias("close_factor"), N.padded_text("name").alias("name"),
    )


@query
def market_settings(spark, sf):
    """Latest settings of every market, flags as YES / NO."""
    silver = decoding.redecode(S.bronze(spark, sf), S.LAYOUTS)["lending_market_snapshots"]
    return health.market_settings(silver).withColumn("pubkey", key_number("pubkey"))


@query
def decode_rejects(spark, sf):
    """Records of the three kinds that give no silver row, and why."""
    rows = decoding.decode_rejects(S.bronze(spark, sf), S.LAYOUTS)
    return rows.select("kind", "slot", "write_version", key_number("pubkey").alias("pubkey"), "reason", "field")


@query
def redecode_counts(spark, sf):
    """Rows of each silver table rebuilt from raw history."""
    silver = decoding.redecode(S.bronze(spark, sf), S.LAYOUTS)
    return summary.table_status(silver)


@query
def redecode_stored(spark, sf):
    """Silver tables rebuilt with one scan of the payloads."""
    return decoding.store_redecoded(S.bronze(spark, sf), S.LAYOUTS, work_dir(spark, "silver"))


@query
def decode_report(spark, sf):
    return decoding.decode_report(S.bronze(spark, sf), S.LAYOUTS)


@query
def decode_report_by_bucket(spark, sf):
    return decoding.decode_report(S.bronze(spark, sf), S.LAYOUTS, by_bucket=True)


@query
def obligation_flags(spark, sf):
    li = spark.read.parquet(f"{sf}/lineitem.parquet").withColumn("group", F.col("l_linenumber") % 3)
    flags = N.obligation_flags("l_discount", "group", "l_tax").cast("int")
    return li.groupBy(flags.alias("flags")).agg(F.count(F.lit(1)).alias("n"))


@query
def market_flags(spark, sf):
    li = spark.read.parquet(f"{sf}/lineitem.parquet")
    b = [(F.expr(f"l_suppkey div {1 << i} % 2")) for i in range(4)]
    flags = N.market_flags(*b)
    return li.groupBy(
        flags.cast("int").alias("flags"), *[N.flag_text(flags, i).alias(n) for i, n in enumerate(("emergency", "autodeleverage", "borrow_disabled", "immutable"))]
    ).agg(F.count(F.lit(1)).alias("n"))


@query
def parse_fractions(spark, sf):
    """Decimal text of every kind: plain, signed, fractional, empty, at and above the largest value."""
    li = spark.read.parquet(f"{sf}/lineitem.parquet")
    digits = F.col("l_orderkey").cast("string")
    text = (
        F.when(F.col("l_linenumber") == 1, digits)
        .when(F.col("l_linenumber") == 2, F.concat(F.lit("-"), digits))
        .when(F.col("l_linenumber") == 3, F.concat(digits, F.lit(".5")))
        .when(F.col("l_linenumber") == 4, F.lit(""))
        .when(F.col("l_linenumber") == 5, F.lit("9" * 38))
        .when(F.col("l_linenumber") == 6, F.concat(F.lit("1"), F.lit("0" * 38)))
        .otherwise(F.rpad(digits, 30, "7"))
    )
    rows = li.select(S.slot_of("l_shipdate").alias("slot"), "l_orderkey", F.col("l_linenumber").cast("bigint").alias("line"), text.alias("value"))
    return rows.select(
        "l_orderkey", "line",
        F.coalesce(N.parse_fraction("value").cast("string"), F.lit("rejected")).alias("parsed"),
        F.coalesce(N.fraction_error("value", "deposit"), F.lit("")).alias("error"),
    )


@query
def key_integrity(spark, sf):
    """Hex keys of the right length decode, others are told apart."""
    c = spark.read.parquet(f"{sf}/customer.parquet")
    text = F.when(F.col("c_nationkey") < 20, F.lpad(F.hex("c_custkey"), 64, "0")).when(F.col("c_nationkey") < 22, F.lpad(F.hex("c_custkey"), 62, "0")).otherwise(F.rpad(F.hex("c_custkey"), 64, "x"))
    key = c.select("c_nationkey", text.alias("t")).select("c_nationkey", N.key_from_hex("t").alias("k"))
    return key.groupBy("c_nationkey").agg(F.count_if(N.valid_key("k")).alias("good"), F.count_if(~N.valid_key("k")).alias("bad"))


# --- state dumps ------------------------------------------------------------------------------


@query
def state_dump(spark, sf):
    """Accounts of the dumped pages with all kinds, keys read back from base58."""
    rows = state_dump_of(spark, sf, "all").rows
    return rows.select("slot", "write_version", key_number("pubkey").alias("pubkey"), key_number("owner").alias("owner"), "kind", "lamports", "data_len")


def state_dump_of(spark, sf, scope):
    return dumps.load_state_dump(spark, S.write_dump(spark, sf), scope, page_per_line=True)


@query
def state_dump_errors(spark, sf):
    errors = state_dump_of(spark, sf, "known").errors
    return errors.groupBy("reason").agg(F.count(F.lit(1)).alias("n"))


@query
def state_dump_run(spark, sf):
    """Store a dump with scope `known` and read its provenance row."""
    run = dumps.store_state_dump(spark, S.write_dump(spark, sf), work_dir(spark, "store"), S.LAYOUTS, page_per_line=True)
    return run.select("slot", "scope", "accounts", "rows_written", "decode_failures")


@query
def owner_pages(spark, sf):
    """Rows per page of the owner byte; records too short to have one form a page of their own."""
    rows = S.wire_updates(spark, sf)
    # The keys of the stand-ins differ in their last byte.
    pages = dumps.page_counts(dumps.by_owner_page(rows, offset=95), offset=95)
    return pages


# --- streaming --------------------------------------------------------------------------------


ROWS_PER_FILE = S.ROWS_PER_FILE


def _spread(spark, sf):
    """How many files each file of the smallest input becomes: files keep their size, and batches their share of the input."""
    return S.wire_spread(spark, sf, ROWS_PER_FILE)


def _wire_files(spark, sf, rows=None, files=4):
    """A folder of wire records: the stored ones themselves, or some of these, which keep their ranges of slots."""
    if rows is None:
        return S.wire_folder(spark, sf, files * _spread(spark, sf))
    path = work_dir(spark, "wire")
    updates.plain_bytes(rows.coalesce(files * _spread(spark, sf))).parquet(path)
    return path


def _per_batch(spark, sf, files):
    """Batches of as many files of the smallest input, at any size."""
    return {"maxFilesPerTrigger": str(files * _spread(spark, sf))}


def _drain(wire, root, **options):
    ingest.start_ingest(wire, root, S.LAYOUTS, available_now=True, **options).awaitTermination()


def _stored_tables(spark, root):
    tables = {t: updates.read_table(spark, root, t) for t in ("account_updates", "obligation_snapshots", "reserve_snapshots", "lending_market_snapshots")}
    return summary.table_status({name: collapse_table(df, name) for name, df in tables.items()})


def _by_kind(rows):
    return rows.groupBy("kind").agg(F.count(F.lit(1)).alias("n"), F.min("slot").alias("first_slot"), F.max("slot").alias("last_slot"), F.sum("data_len").alias("bytes"))


@query
def stream_ingest(spark, sf):
    """Ingest in several micro-batches, start again on the same folder, and count what was stored."""
    path, root = _wire_files(spark, sf), work_dir(spark, "ingest")
    for _ in range(2):
        _drain(updates.read_updates_stream(spark, path, options=_per_batch(spark, sf, 2)), root)
    return _stored_tables(spark, root)


CUT_SLOT = 2200000000


@query
def stream_resume(spark, sf):
    """Two sessions with a hole between them: the second one resumes inclusively and records the seam.

    The hole is made by moving the second session's rows, none is left out.
    """
    root, wire = work_dir(spark, "ingest"), S.wire_updates(spark, sf)
    first = _wire_files(spark, sf, wire.filter(F.col("slot") <= CUT_SLOT))
    second = _wire_files(spark, sf, wire.filter(F.col("slot") > CUT_SLOT).withColumn("slot", F.col("slot") + 10_000_000))
    # The next session reads another folder with new offsets, so it begins at the stored position.
    for name, path in (("first", first), ("second", second)):
        _drain(updates.read_updates_stream(spark, path), root, offsets=f"{root}/_offsets/{name}")
    found = quality.current_gaps(ingest.read_batches(spark, root, "slot_gaps"))
    return found.select("stream", "start_slot", "end_slot", F.col("filled").cast("int").alias("filled"), "reason")


@query
def stream_restart_new_offsets(spark, sf):
    """Part of the source, then all of it with new offsets into the same tables: nothing stored is lost."""
    root, wire = work_dir(spark, "ingest"), S.wire_updates(spark, sf)
    for name, rows in (("first", wire.filter(F.col("slot") <= CUT_SLOT)), ("second", None)):
        path = _wire_files(spark, sf, rows)
        _drain(updates.read_updates_stream(spark, path, options=_per_batch(spark, sf, 2)), root, offsets=f"{root}/_offsets/{name}")
    return _stored_tables(spark, root)


@query
def stream_restart_out_of_order(spark, sf):
    """The newer part of the source first, then all of it with new offsets: older records lie below the position and are stored."""
    root, wire = work_dir(spark, "ingest"), S.wire_updates(spark, sf)
    for name, rows in (("newer", wire.filter(F.col("slot") > CUT_SLOT)), ("all", None)):
        path = _wire_files(spark, sf, rows)
        _drain(updates.read_updates_stream(spark, path, options=_per_batch(spark, sf, 2)), root, offsets=f"{root}/_offsets/{name}")
    return updates.read_table(spark, root, "account_updates").agg(F.count(F.lit(1)).alias("n"), F.min("slot").alias("first_slot"), F.max("slot").alias("last_slot"))


@query
def stream_replays(spark, sf):
    """Every other record, then all records three times over, each with new offsets: nothing is stored twice and nothing is left out."""
    root, wire = work_dir(spark, "ingest"), S.wire_updates(spark, sf)
    whole = _wire_files(spark, sf)
    for name, path in (("half", _wire_files(spark, sf, wire.filter(F.col("write_version") % 2 == 0))), ("a", whole), ("b", whole), ("c", whole)):
        _drain(updates.read_updates_stream(spark, path), root, offsets=f"{root}/_offsets/{name}")
    return _by_kind(updates.read_table(spark, root, "account_updates"))


SOURCE_SLOT = 2_000_000_000


def _source(spark, path, root):
    log = f"{root}/_segments"
    return segments.read_segments_stream(spark, path, log, SOURCE_SLOT, ("Obligation", "Reserve"))


@query
def stream_source(spark, sf):
    """Records of two kinds from a slot on, from stored segments; after a restart, segments of lower slots appear."""
    root, wire, path = work_dir(spark, "ingest"), S.wire_updates(spark, sf), work_dir(spark, "wire")
    for part in (F.col("slot") > CUT_SLOT, F.col("slot") <= CUT_SLOT):
        updates.plain_bytes(wire.filter(part).coalesce(4 * _spread(spark, sf))).mode("append").parquet(path)
        _drain(_source(spark, path, root), root)
    return _by_kind(updates.read_table(spark, root, "account_updates"))


@query
def stream_source_refill(spark, sf):
    """A second store filled from the raw table of a first one, whose buckets of lower slots are not listed."""
    first, second = work_dir(spark, "ingest"), work_dir(spark, "ingest")
    _drain(updates.read_updates_stream(spark, _wire_files(spark, sf)), first)
    _drain(_source(spark, f"{first}/account_updates", second), second)
    return _by_kind(updates.read_table(spark, second, "account_updates"))


@query
def stream_frontier(spark, sf):
    """Holes that the frontier shows once both halves of the source are in, the newer half first."""
    root, wire = work_dir(spark, "ingest"), S.wire_updates(spark, sf)
    for name, rows in (("newer", wire.filter(F.col("slot") > CUT_SLOT)), ("older", wire.filter(F.col("slot") <= CUT_SLOT))):
        _drain(updates.read_updates_stream(spark, _wire_files(spark, sf, rows)), root, offsets=f"{root}/_offsets/{name}")
    return spark.createDataFrame(ingest.read_frontier(spark, root).holes(), "start_slot bigint, end_slot bigint")


@query
def stream_alarms(spark, sf):
    """Alarm rows of a stream of three batches and a restart in between: the first fault and each tenth one."""
    root, wire = work_dir(spark, "ingest"), S.wire_updates(spark, sf)
    path, middle = work_dir(spark, "wire"), 2_000_000_000
    parts = (F.col("slot") <= middle, F.col("slot").between(middle + 1, CUT_SLOT), F.col("slot") > CUT_SLOT)
    for i, part in enumerate(parts):
        with tidy(spark):  # the source delivers files by age
            updates.plain_bytes(wire.filter(part).repartition(_spread(spark, sf))).mode("append").parquet(path)
        if i:
            _drain(updates.read_updates_stream(spark, path, options=_per_batch(spark, sf, 1)), root, alarm_every=10)
    return ingest.read_alarms(spark, root).select("n", "slot", "write_version", key_number("pubkey").alias("pubkey"), "alarm")


@query
def stream_sessions(spark, sf):
    """The summary of the second of two sessions, from the rows that carry its name."""
    root, wire = work_dir(spark, "ingest"), S.wire_updates(spark, sf)
    for name, rows in (("first", wire.filter(F.col("slot") <= CUT_SLOT)), ("second", wire.filter(F.col("slot") > CUT_SLOT))):
        _drain(updates.read_updates_stream(spark, _wire_files(spark, sf, rows)), root, offsets=f"{root}/_offsets/{name}", session=name)
    return activity.session_summary(updates.read_session(spark, root, "second"))


@query
def stream_lost_position(spark, sf):
    """A second session whose source no longer replays the position: the hole is recorded with the reason of the error."""
    root, wire = work_dir(spark, "ingest"), S.wire_updates(spark, sf)
    moved = wire.filter(F.col("slot") > CUT_SLOT).withColumn("slot", F.col("slot") + 10_000_000)
    for name, rows, failure in (("first", wire.filter(F.col("slot") <= CUT_SLOT), None), ("second", moved, "replay_window")):
        _drain(updates.read_updates_stream(spark, _wire_files(spark, sf, rows)), root, offsets=f"{root}/_offsets/{name}", failure=failure)
    found = quality.current_gaps(ingest.read_batches(spark, root, "slot_gaps"))
    return found.select("stream", "start_slot", "end_slot", F.col("filled").cast("int").alias("filled"), "reason")


@query
def stream_positions(spark, sf):
    """Positions of two streams of one root, the name of one being the beginning of the other's."""
    root, wire = work_dir(spark, "ingest"), S.wire_updates(spark, sf)
    for stream, rows in (("main-old", None), ("main", wire.filter(F.col("slot") <= CUT_SLOT))):
        _drain(updates.read_updates_stream(spark, _wire_files(spark, sf, rows)), root, stream=stream)
    positions = [(stream, ingest.read_position(spark, root, stream)) for stream in ("main", "main-old")]
    return spark.createDataFrame(positions, "stream string, position bigint")


@query
def compacted_bronze(spark, sf):
    """Raw rows per bucket after compaction: every closed bucket is one batch. The newest is left as it is."""
    root, folder = work_dir(spark, "ingest"), work_dir(spark, "wire")
    with tidy(spark):  # batches that overlap in slots
        updates.plain_bytes(S.wire_updates(spark, sf).repartition(3 * _spread(spark, sf))).parquet(folder)
    _drain(updates.read_updates_stream(spark, folder, options=_per_batch(spark, sf, 1)), root)
    updates.compact(spark, root, "account_updates")
    filed = updates.read_filed(spark, root, "account_updates")
    newest = F.col("slot_bucket") == filed.agg(F.max("slot_bucket")).first()[0]
    counts = filed.withColumn("newest", newest).withColumn("slot_bucket", slot_bucket()).groupBy("slot_bucket", "newest", "batch_id").agg(F.count(F.lit(1)).alias("n"), F.sum("data_len").alias("bytes"))
    batches = F.when(F.max("newest"), F.lit(1)).otherwise(F.count(F.lit(1))).cast("bigint")
    return counts.groupBy("slot_bucket").agg(F.sum("n").alias("n"), F.sum("bytes").alias("bytes"), batches.alias("most_batches"))


@query
def stream_guard(spark, sf):
    """Payload guard summed over the batches of a stream."""
    path, root = _wire_files(spark, sf), work_dir(spark, "ingest")
    _drain(updates.read_updates_stream(spark, path, options=_per_batch(spark, sf, 1)), root)
    return ingest.guard_totals(spark, root)


BUDGET_SLOTS = 100_000_000


@query
def stream_budget(spark, sf):
    """A bounded sample: at most so many slots past the stream's own first one, after which the query ends itself.

    The limit is this query's feature. The second start shows that the budget holds over restarts.
    """
    path, root, source = work_dir(spark, "wire"), work_dir(spark, "ingest"), S.wire_updates(spark, sf)
    for rows in (source.filter(F.col("slot") <= CUT_SLOT), source.filter(F.col("slot") > CUT_SLOT)):
        with tidy(spark):  # the source delivers files by age
            updates.plain_bytes(rows.repartition(_spread(spark, sf))).mode("append").parquet(path)
    for _ in range(2):
        wire = updates.read_updates_stream(spark, path, options=_per_batch(spark, sf, 1))
        ingest.start_ingest(wire, root, S.LAYOUTS, budget_slots=BUDGET_SLOTS).awaitTermination()  # ends itself
    rows = updates.read_table(spark, root, "account_updates")
    return rows.agg(F.count(F.lit(1)).alias("n"), F.min("slot").alias("first_slot"), F.max("slot").alias("last_slot"))


def _update_files(spark, sf, rows=None):
    """The updates as a stream of five micro-batches, in no order of time."""
    path = work_dir(spark, "updates")
    rows = S.account_updates(spark, sf) if rows is None else rows
    rows.repartition(5).write.parquet(path)
    return spark.readStream.schema(rows.schema).option("maxFilesPerTrigger", "1").parquet(path)


def _sink(stream, mode="append"):
    spark = stream.sparkSession
    out, offsets = work_dir(spark, "sink"), work_dir(spark, "offsets")
    writer = stream.writeStream.format("parquet").outputMode(mode).option("path", out).option("checkpointLocation", offsets)
    writer.trigger(availableNow=True).start().awaitTermination()
    return spark.read.schema(stream.schema).parquet(out)


@query
def stream_dedup(spark, sf):
    """Replays dropped in the stream itself."""
    rows = _sink(drop_replays(_update_files(spark, sf), delay="2 hours"))
    return rows.select("slot", "write_version", "pubkey", "kind", "data")


@query
def stream_flow(spark, sf):
    """Writes per minute of a stream, the newest minutes included."""
    root = work_dir(spark, "monitor")
    monitors.start_flow_monitor(_update_files(spark, sf), root, FLOW_KINDS, available_now=True).awaitTermination()
    return monitors.read_flow(spark, root)


@query
def stream_lag(spark, sf):
    """Lag figures of one batch: processed updates against tip notices. That some are not processed yet is what it shows."""
    u = S.account_updates(spark, sf).withColumn("produced_at", F.col("ingested_at"))
    tips = u.select((F.col("slot") + 17).alias("slot"), "produced_at")
    done = u.filter(F.col("slot") < 4266000000)
    return monitors.lag_line(done, tips, S.AS_OF, seconds=10)


@query
def stream_lag_monitor(spark, sf):
    """Lag recorded while a stream of updates and tip notices is followed, over a restart: the last reading."""
    u = S.account_updates(spark, sf)
    event = F.when((F.col("slot") % 2 == 0) & (F.col("slot") < 4266000000), "account").otherwise("slot")
    root = work_dir(spark, "monitor")
    messages = u.select(event.alias("event"), "slot", F.col("ingested_at").alias("produced_at"))
    stream = _update_files(spark, sf, messages)
    for _ in range(2):
        monitors.start_lag_monitor(stream, root, available_now=True).awaitTermination()
    lag = monitors.read_lag(spark, root)
    last = [F.max(c).alias(c) for c in ("tip_slot", "processed_slot")]
    one = lag.agg(*last, F.sum("updates").alias("updates"), F.max("newest_ms").alias("newest_ms"))
    behind = F.col("tip_slot") - F.col("processed_slot")
    return one.select("tip_slot", "processed_slot", behind.alias("behind_slots"), F.round(behind * 0.4, 1).alias("behind_s"), "updates", "newest_ms")


@query
def running_shapes(spark, sf):
    return monitors.running_shapes(S.account_updates(spark, sf))


# --- dashboard --------------------------------------------------------------------------------


def _dashboard(spark, sf):
    tables = {
        "account_updates": S.account_updates(spark, sf),
        "obligation_snapshots": S.obligation_snapshots(spark, sf),
        "reserve_snapshots": S.reserve_snapshots(spark, sf),
        "ingest_checkpoint": S.ingest_checkpoint(spark, sf),
        "slot_gaps": S.slot_gaps(spark, sf),
    }
    asked = dashboard.dashboard_queries(tables, S.AS_OF)
    return asked, dashboard.export_dashboard(spark, asked, work_dir(spark, "dashboard"), S.AS_OF)


@query
def dashboard_export(spark, sf):
    """All dashboard queries in one JSON document: when it is of, and the rows of each section."""
    asked, document = _dashboard(spark, sf)
    sections = [F.struct(F.lit(n).alias("section"), F.json_array_length(F.get_json_object("value", f"$.{n}")).cast("bigint").alias("n")) for n in asked]
    made = F.unix_seconds(F.to_timestamp(F.get_json_object("value", "$.generated_at"))).alias("generated_s")
    return document.select(made, F.inline(F.array(*sections)))


@query
def dashboard_risk(spark, sf):
    """The risk section, read back from the document."""
    asked, document = _dashboard(spark, sf)
    found = dashboard.read_section(document, "risk", asked["risk"]().schema)
    return found.withColumn("hf", F.col("hf").cast("bigint"))


def _rolled(spark, sf):
    """Figures of five batches; the third one is tried twice."""
    root, part = work_dir(spark, "rollups"), F.pmod(F.col("write_version"), F.lit(5))
    tables = {
        "account_updates": S.account_updates(spark, sf),
        "obligation_snapshots": S.obligation_snapshots(spark, sf, replays=False),
        "reserve_snapshots": S.reserve_snapshots(spark, sf),
    }
    for i in (0, 1, 2, 2, 3, 4):
        rollups.store_rollup({name: rows.filter(part == i) for name, rows in tables.items()}, root, f"b{i}")
    return rollups.read_rollups(spark, root)


@query
def dashboard_incremental(spark, sf):
    """The system section from figures that were stored with each batch."""
    return rollups.system_status(_rolled(spark, sf), S.ingest_checkpoint(spark, sf), S.slot_gaps(spark, sf), S.AS_OF)


@query
def flow_incremental(spark, sf):
    """`flow` from figures that were stored with each batch."""
    return rollups.flow(_rolled(spark, sf), S.FLOW_AS_OF, S.FLOW_MINUTES, FLOW_KINDS)


@query
def stream_rollups(spark, sf):
    """Figures that a stream of several batches and a restart over all of its source has stored."""
    root = work_dir(spark, "ingest")
    for name in ("a", "b"):
        _drain(updates.read_updates_stream(spark, _wire_files(spark, sf), options=_per_batch(spark, sf, 2)), root, offsets=f"{root}/_offsets/{name}")
    return rollups.activity_by_kind(rollups.read_rollups(spark, root))


@query
def stream_freshness(spark, sf):
    """Every state that a kind goes through once the stream falls silent, and a kind that is expected and never seen.

    The thresholds are two and four seconds; a kind that is not seen stays unknown.
    """
    root = work_dir(spark, "watch")
    stream = _update_files(spark, sf).select("kind", "ingested_at")
    kinds = S.account_updates(spark, sf).select("kind").distinct().count()
    query = watch.start_freshness_watch(stream, root, ["never seen"], 2, 4, every="1 second")
    try:
        for _ in range(90):  # seconds; the watch itself has no end
            if query.awaitTermination(1):
                break
            if watch.has_changes(spark, root) and watch.read_changes(spark, root).filter("state = 'stale'").select("kind").distinct().count() == kinds:
                break
    finally:
        query.stop()
    return watch.read_changes(spark, root).select("kind", "state").distinct()


@query
def dashboard_system(spark, sf):
    """The system section, read back from the document."""
    asked, document = _dashboard(spark, sf)
    return dashboard.read_section(document, "system", asked["system"]().schema)
