"""Data quality: gaps, payload faults, kind freezes, freshness, reconciliation."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from slotwise.functions.slots import slot_bucket
from slotwise.functions.verdicts import (
    failure_reason,
    freshness_state,
    is_fault,
    payload_shape,
    resume_drift,
    resume_verdict,
    seam_reason,
)
from slotwise.operators.dedup import collapse_table, collapsed_count
from slotwise.operators.ordering import global_rank, steps
from slotwise.operators.quantiles import percentile_row, value_counts
from slotwise.operators.rows import side_by_side
from slotwise.plans.activity import _at
from slotwise.schemas import (
    SLOTS_PER_BUCKET,
    ALARM_EVERY,
    BUCKET_COLUMN,
    DEFAULT_STREAM,
    FRESH_SECONDS,
    GAP_TOLERANCE_SLOTS,
    SLOTS_PER_BUCKET,
    STALE_SECONDS,
    VERSION_KEY,
)
from slotwise.session import stored

# --- gaps -------------------------------------------------------------------------------------


def _is_gap(rule: str, threshold: int) -> Column:
    """The retrospective rule asks for more than `threshold` missed slots, the live one for more than
    `threshold` slots of drift; they differ by one slot."""
    if rule == "missed":
        return F.col("cur") - F.col("prev") - 1 > threshold
    if rule == "drift":
        return F.col("cur") - F.col("prev") > threshold
    raise ValueError(f"rule must be 'missed' or 'drift', got {rule!r}")


def derive_gaps(updates: DataFrame, threshold: int = GAP_TOLERANCE_SLOTS, rule: str = "missed", by=()) -> DataFrame:
    """Gaps that the data itself shows, largest first. Both bounds are slots we hold."""
    found = steps(updates, "slot", SLOTS_PER_BUCKET, by).filter(_is_gap(rule, threshold))
    return found.select(
        *by,
        F.col("prev").alias("start_slot"),
        F.col("cur").alias("end_slot"),
        (F.col("cur") - F.col("prev") - 1).alias("slots_missed"),
    ).orderBy(F.desc("slots_missed"), *by, "start_slot")


def top_steps(updates: DataFrame, min_delta: int = 100, limit: int = 10) -> DataFrame:
    """Largest steps between consecutive slots, quiet spells included."""
    delta = F.col("cur") - F.col("prev")
    found = steps(updates, "slot", SLOTS_PER_BUCKET).filter(delta > min_delta)
    return (
        found.select(F.col("prev").alias("prev_slot"), F.col("cur").alias("next_slot"), delta.alias("delta"))
        .orderBy(F.desc("delta"), "prev_slot")
        .limit(limit)
    )


SILENCES = {"p50_s": 0.5, "p99_s": 0.99, "p999_s": 0.999}
_SECONDS_PER_CELL = 1_000_000


def arrival_silences(updates: DataFrame) -> DataFrame:
    """How long ingest is silent: percentiles of the distance between consecutive seconds with arrivals."""
    seconds = updates.select(F.unix_seconds(F.col("ingested_at").cast("timestamp")).alias("second"))
    silent = steps(seconds, "second", _SECONDS_PER_CELL).select((F.col("cur") - F.col("prev")).alias("silence"))
    counts = value_counts(silent, "silence")
    totals = counts.agg(
        (F.coalesce(F.sum("n"), F.lit(0)) + 1).alias("ingest_seconds"), F.max("v").cast("bigint").alias("max_s")
    )
    return side_by_side(totals, percentile_row(counts, SILENCES)).select(
        "ingest_seconds", *[F.round(c, 4).alias(c) for c in SILENCES], "max_s"
    )


def classify_sessions(sessions: DataFrame, tolerance: int = GAP_TOLERANCE_SLOTS) -> DataFrame:
    """Verdict on the resume seam of every session (session_id, resume_from, first_account_slot)."""
    verdict = resume_verdict("resume_from", "first_account_slot", tolerance)
    drift = resume_drift("resume_from", "first_account_slot")
    return sessions.select(
        "*", verdict.alias("verdict"), drift.alias("drift"), F.when(verdict == "gap", drift - 1).alias("slots_missed")
    )


def gap_rows(sessions: DataFrame, stream: str = DEFAULT_STREAM, detected_at: str = "detected_at") -> DataFrame:
    """`slot_gaps` rows for the sessions whose seam is a gap."""
    judged = classify_sessions(sessions).filter(F.col("verdict") == "gap")
    return valid_gaps(
        judged.select(
            F.lit(stream).alias("stream"),
            F.col("resume_from").alias("start_slot"),
            F.col("first_account_slot").alias("end_slot"),
            F.col(detected_at).alias("detected_at"),
            F.lit(0).cast("smallint").alias("filled"),
            seam_reason(F.col("drift")).alias("reason"),
            F.col(detected_at).alias("ingested_at"),
        )
    )


def failure_gaps(failures: DataFrame, stream: str = DEFAULT_STREAM) -> DataFrame:
    """`slot_gaps` rows for visible failures (code, start_slot, end_slot, detected_at)."""
    return valid_gaps(
        failures.select(
            F.lit(stream).alias("stream"),
            "start_slot",
            "end_slot",
            "detected_at",
            F.lit(0).cast("smallint").alias("filled"),
            failure_reason("code").alias("reason"),
            F.col("detected_at").alias("ingested_at"),
        )
    )


def valid_gaps(gaps: DataFrame) -> DataFrame:
    """A failure before the first row has no end yet; such rows (end <= start) are not gaps."""
    return gaps.filter(F.col("end_slot") > F.col("start_slot"))


def current_gaps(gaps: DataFrame) -> DataFrame:
    """Recorded gaps, the newest row per (stream, start_slot)."""
    return valid_gaps(collapse_table(gaps, "slot_gaps"))


def gap_status(gaps: DataFrame) -> DataFrame:
    """Missed slots, number and latest detection of gaps not filled yet. `end_slot` itself was received."""
    open_gaps = current_gaps(gaps).filter(F.col("filled") == 0)
    return open_gaps.agg(
        F.coalesce(F.sum(F.col("end_slot") - F.col("start_slot") - 1), F.lit(0)).alias("total_missed_slots"),
        F.count(F.lit(1)).alias("gap_count"),
        F.max(F.unix_millis(F.col("detected_at").cast("timestamp"))).alias("latest_gap_ms"),
    )


def reconcile_gaps(updates: DataFrame, gaps: DataFrame, threshold: int = GAP_TOLERANCE_SLOTS, rule: str = "missed") -> DataFrame:
    """Gaps the data shows against gaps the ingest recorded. Both sides are held to the same rule."""
    shown = derive_gaps(updates, threshold, rule).select("start_slot", "end_slot", F.lit(1).alias("shown"))
    as_steps = current_gaps(gaps).withColumnsRenamed({"start_slot": "prev", "end_slot": "cur"})
    noticed = as_steps.filter(_is_gap(rule, threshold)).select("prev", "cur").distinct()
    noticed = noticed.select(F.col("prev").alias("start_slot"), F.col("cur").alias("end_slot"), F.lit(1).alias("noticed"))
    status = (
        F.when(F.col("shown").isNotNull() & F.col("noticed").isNotNull(), "matched")
        .when(F.col("shown").isNotNull(), "only_derived")
        .otherwise("only_recorded")
    )
    return shown.join(noticed, ["start_slot", "end_slot"], "full_outer").select("start_slot", "end_slot", status.alias("status"))


def coverage(updates: DataFrame, threshold: int = GAP_TOLERANCE_SLOTS) -> DataFrame:
    """Continuous ranges between gaps, per kind.

    The window per kind runs over its gaps only, and every gap spans more than `threshold` slots, so it
    holds at most (slot span / threshold) rows however many updates the kind has.
    """
    breaks = derive_gaps(updates, threshold, by=("kind",)).select("kind", "start_slot", "end_slot")
    ends = updates.groupBy("kind").agg(F.min("slot").alias("end_slot"), F.max("slot").alias("last_slot"))
    first = ends.select("kind", F.lit(None).cast("bigint").alias("start_slot"), "end_slot", "last_slot")
    marks = first.unionByName(breaks, allowMissingColumns=True)
    ordered = Window.partitionBy("kind").orderBy("end_slot")
    last = F.max("last_slot").over(Window.partitionBy("kind"))
    ranges = marks.select(
        "kind",
        F.col("end_slot").alias("from_slot"),
        F.coalesce(F.lead("start_slot").over(ordered), last).alias("to_slot"),
    )
    return ranges.withColumn("slot_span", F.col("to_slot") - F.col("from_slot") + 1)


def gaps_companion(updates: DataFrame, threshold: int = GAP_TOLERANCE_SLOTS) -> DataFrame:
    """Machine-readable list of holes for publication: outages, and runs of destroyed payloads per kind."""
    outages = derive_gaps(updates, threshold).select(
        F.lit("outage").alias("hole"), F.lit("all").alias("kind"), "start_slot", "end_slot", F.col("slots_missed").alias("size")
    )
    payloads = payload_holes(updates).select(F.lit("payload").alias("hole"), "kind", "start_slot", "end_slot", "size")
    return outages.unionByName(payloads)


def payload_holes(updates: DataFrame) -> DataFrame:
    """Runs of destroyed payloads per kind: faults with no slot of sound payloads of that kind between them.

    A run is known by the last sound slot before it. That slot is found inside buckets of slots first and then
    carried over bucket borders, so no window holds a whole kind.
    """
    fault = is_fault()
    slots = updates.groupBy("kind", "slot").agg(
        F.count_if(fault).alias("faults"), F.count_if(~fault & (payload_shape() == "ok")).alias("sound")
    )
    slots = slots.withColumn("__cell", F.expr(f"slot div {SLOTS_PER_BUCKET}"))
    slots = slots.withColumn("__sound", F.when((F.col("faults") == 0) & (F.col("sound") > 0), F.col("slot")))
    inside = Window.partitionBy("kind", "__cell").orderBy("slot").rowsBetween(Window.unboundedPreceding, -1)
    before = Window.partitionBy("kind").orderBy("__cell").rowsBetween(Window.unboundedPreceding, -1)  # one row per bucket
    cells = slots.groupBy("kind", "__cell").agg(F.max("__sound").alias("__top"))
    cells = cells.select("kind", "__cell", F.max("__top").over(before).alias("__carried"))
    marked = slots.withColumn("__last", F.max("__sound").over(inside)).join(cells, ["kind", "__cell"])
    runs = marked.filter("faults > 0").groupBy("kind", F.coalesce("__last", "__carried", F.lit(-1)).alias("__run"))
    return runs.agg(F.min("slot").alias("start_slot"), F.max("slot").alias("end_slot"), F.sum("faults").alias("size")).drop("__run")


# --- payload shape ----------------------------------------------------------------------------


def payload_shapes(updates: DataFrame) -> DataFrame:
    """Rows per payload shape."""
    return updates.groupBy(payload_shape().alias("shape")).agg(F.count(F.lit(1)).alias("n"))


def payload_guard(updates: DataFrame) -> DataFrame:
    """Faults and closures with the slot range of the faults; one row, also when all is well."""
    fault = is_fault()
    return updates.agg(
        F.count_if(fault).alias("impossible"),
        F.count_if(payload_shape() == "closed").alias("closed"),
        F.min(F.when(fault, F.col("slot"))).alias("first_slot"),
        F.max(F.when(fault, F.col("slot"))).alias("last_slot"),
    ).select(
        "impossible",
        "closed",
        F.coalesce("first_slot", F.lit(-1)).alias("first_slot"),
        F.coalesce("last_slot", F.lit(-1)).alias("last_slot"),
        (F.col("impossible") > 0).alias("firing"),
    )


def payload_alarms(updates: DataFrame, every: int = ALARM_EVERY, before: int = 0) -> DataFrame:
    """The fault that raises the first alarm and every `every`-th one after it, numbered in slot order from `before` on."""
    narrow = updates.filter(is_fault()).select("slot", "write_version", "pubkey", "ingested_at")
    ranked = global_rank(narrow, ["slot", "write_version", "pubkey", "ingested_at"], "n").withColumn("n", F.col("n") + before)
    return ranked.filter((F.col("n") == 1) | (F.col("n") % every == 0)).select(
        "n", "slot", "write_version", "pubkey", F.when(F.col("n") == 1, "first").otherwise("repeat").alias("alarm")
    )


def loss_report(updates: DataFrame, snapshots: DataFrame) -> DataFrame:
    """One row on the funded-but-empty updates: how many, whose, from when to when, when it ended.

    `confirmed_keys` are lost keys that some snapshot knows.
    """
    millis = F.unix_millis(F.col("ingested_at").cast("timestamp"))
    # The updates are read once; everything else comes from one row per (kind, key) of the faults.
    lost = stored(
        updates.filter(is_fault())
        .groupBy("kind", "pubkey")
        .agg(
            F.count(F.lit(1)).alias("n"),
            F.min("slot").alias("first_slot"),
            F.max("slot").alias("last_slot"),
            F.min(millis).alias("first_ms"),
            F.max(millis).alias("last_ms"),
        ),
        "lost",
    )
    totals = lost.agg(
        F.coalesce(F.sum("n"), F.lit(0)).alias("lost_rows"),
        F.min("first_slot").alias("first_slot"),
        F.max("last_slot").alias("last_slot"),
        F.min("first_ms").alias("first_ms"),
        F.max("last_ms").alias("last_ms"),
    )
    kinds = lost.select("kind").distinct().agg(F.count(F.lit(1)).alias("lost_kinds"))
    lost_keys = lost.select("pubkey").distinct()
    keys = lost_keys.agg(F.count(F.lit(1)).alias("lost_keys"))
    known = lost_keys.join(snapshots.select("pubkey").distinct(), "pubkey", "left_semi")
    confirmed = known.agg(F.count(F.lit(1)).alias("confirmed_keys"))
    # One row, so the lookup of what came back is a scalar, not a join.
    end = lost.agg(F.max("last_slot").alias("end")).scalar()
    restored = snapshots.filter(F.col("slot") > end).agg(F.min("slot").alias("first_restored_slot"))
    seconds = F.expr("last_ms div 1000 - first_ms div 1000")
    return side_by_side(totals, kinds, keys, confirmed, restored).select(
        "lost_rows",
        "lost_kinds",
        "lost_keys",
        "confirmed_keys",
        F.coalesce("first_slot", F.lit(-1)).alias("first_slot"),
        F.coalesce("last_slot", F.lit(-1)).alias("last_slot"),
        F.coalesce("first_ms", F.lit(-1)).alias("first_ms"),
        F.coalesce("last_ms", F.lit(-1)).alias("last_ms"),
        F.coalesce(seconds, F.lit(0)).alias("window_seconds"),
        F.round(F.coalesce(seconds, F.lit(0)) / 3600.0, 2).alias("window_hours"),
        F.coalesce("first_restored_slot", F.lit(-1)).alias("first_restored_slot"),
    )


def lost_keys_known(updates: DataFrame, snapshots: DataFrame) -> DataFrame:
    """Keys of lost rows that appear in the snapshots. Both sides are distinct keys before they meet."""
    return _lost_keys(updates).join(snapshots.select("pubkey").distinct(), "pubkey", "left_semi")


def lost_keys_unknown(updates: DataFrame, snapshots: DataFrame) -> DataFrame:
    """Keys of lost rows that appear in no snapshot."""
    return _lost_keys(updates).join(snapshots.select("pubkey").distinct(), "pubkey", "left_anti")


def _lost_keys(updates: DataFrame) -> DataFrame:
    return updates.filter(is_fault()).select("pubkey").distinct()


# --- kinds that stop --------------------------------------------------------------------------


def kind_freeze_audit(updates: DataFrame, lag_slots: int) -> DataFrame:
    """Kinds whose newest slot stays behind while others advance, and the kind that took over.

    The successor is the kind whose first slot comes next after the frozen kind's last one. How many of
    its keys were seen before under the frozen kind tells a change of label from a real ending.
    """
    per_key = updates.groupBy("kind", "pubkey").agg(
        F.count(F.lit(1)).alias("n"), F.min("slot").alias("lo"), F.max("slot").alias("hi")
    )
    kinds = per_key.groupBy("kind").agg(
        F.sum("n").alias("updates"),
        F.count(F.lit(1)).alias("keys"),
        F.min("lo").alias("first_slot"),
        F.max("hi").alias("last_slot"),
    )
    # One row per kind from here on, so windows over all of them are small.
    kinds = kinds.withColumn("lag_slots", F.max("last_slot").over(Window.partitionBy()) - F.col("last_slot"))
    kinds = kinds.withColumn("frozen", F.col("lag_slots") > lag_slots)
    marks = kinds.select(
        F.explode(
            F.array(
                F.struct(F.col("last_slot").alias("at"), F.lit(0).alias("begins"), F.col("kind").alias("kind")),
                F.struct(F.col("first_slot").alias("at"), F.lit(1).alias("begins"), F.col("kind").alias("kind")),
            )
        ).alias("mark")
    ).select("mark.*")
    following = Window.orderBy("at", F.desc("begins"), "kind").rowsBetween(1, Window.unboundedFollowing)
    next_kind = F.first(F.when(F.col("begins") == 1, F.col("kind")), ignorenulls=True).over(following)
    successors = marks.withColumn("successor", next_kind).filter((F.col("begins") == 0)).select("kind", "successor")
    found = kinds.join(successors, "kind").withColumn("successor", F.when(F.col("frozen"), F.col("successor")))

    pairs = found.filter(F.col("successor").isNotNull()).select("kind", "successor")
    # One kind may hold most keys: its single row of `pairs` (one per frozen kind) goes to them, not they to it.
    before = per_key.join(F.broadcast(pairs), "kind").select(F.col("kind").alias("frozen_kind"), "pubkey", F.col("successor").alias("kind"))
    shared = before.join(per_key.select("kind", "pubkey"), ["kind", "pubkey"])
    shared = shared.groupBy(F.col("frozen_kind").alias("kind")).agg(F.count(F.lit(1)).alias("shared_keys"))
    successor_keys = kinds.select(F.col("kind").alias("successor"), F.col("keys").alias("successor_keys"))
    return (
        found.join(shared, "kind", "left")
        .join(successor_keys, "successor", "left")
        .select(
            "kind",
            "updates",
            "first_slot",
            "last_slot",
            "lag_slots",
            "frozen",
            F.coalesce("successor", F.lit("")).alias("successor"),
            F.coalesce("shared_keys", F.lit(0)).alias("shared_keys"),
            F.round(F.coalesce(F.col("shared_keys") * 1.0 / F.col("successor_keys"), F.lit(0.0)), 4).alias("shared_share"),
        )
    )


# --- freshness and reconciliation -------------------------------------------------------------


def freshness(updates: DataFrame, as_of, fresh: int = FRESH_SECONDS, stale: int = STALE_SECONDS) -> DataFrame:
    """Age of the newest arrival and what it means."""
    newest = F.unix_seconds(F.max(F.col("ingested_at").cast("timestamp")))
    age = updates.agg(newest.alias("newest")).select((F.unix_seconds(_at(as_of)) - F.col("newest")).alias("age_s"))
    return age.select(F.coalesce("age_s", F.lit(-1)).alias("age_s"), freshness_state("age_s", fresh, stale).alias("state"))


def health_check(updates: DataFrame, as_of, stale_after: int, minutes: int = 10) -> DataFrame:
    """Rows, accounts, last slot, lag and recent row rate, with HEALTHY / STALE / UNREACHABLE."""
    edge = F.unix_seconds(_at(as_of))
    second = F.unix_seconds(F.col("ingested_at").cast("timestamp"))
    recent = second > edge - minutes * 60
    per_key = updates.groupBy("pubkey").agg(
        F.count(F.lit(1)).alias("n"),
        F.max("slot").alias("slot"),
        F.max(second).alias("newest"),
        F.count_if(recent).alias("recent"),
        F.min(F.when(recent, second)).alias("recent_from"),
        F.max(F.when(recent, second)).alias("recent_to"),
    )
    seconds = F.nullif(F.max("recent_to") - F.min("recent_from"), F.lit(0))
    found = per_key.agg(
        F.coalesce(F.sum("n"), F.lit(0)).alias("updates"),
        F.count(F.lit(1)).alias("accounts"),
        F.coalesce(F.max("slot"), F.lit(-1)).alias("last_slot"),
        (edge - F.max("newest")).alias("lag_s"),
        F.round(F.coalesce(F.sum("recent") / seconds, F.lit(0.0)), 2).alias("rate_per_s"),
    )
    verdict = F.when(F.col("lag_s").isNull(), "UNREACHABLE").when(F.col("lag_s") <= stale_after, "HEALTHY").otherwise("STALE")
    return found.withColumn("status", verdict).withColumn("lag_s", F.coalesce("lag_s", F.lit(-1)))


def reconcile_export(source: DataFrame, exported: DataFrame, upper_slot: int | None = None) -> DataFrame:
    """Collapsed source rows against exported rows per bucket; they must be equal.

    A live source keeps growing, so `upper_slot` pins both sides to slots below it before counting.
    """
    if upper_slot is not None:
        source, exported = source.filter(F.col("slot") < upper_slot), exported.filter(F.col("slot") < upper_slot)
    keys = source.select(*VERSION_KEY).distinct()
    expected = keys.groupBy(slot_bucket().alias(BUCKET_COLUMN)).agg(F.count(F.lit(1)).alias("expected_rows"))
    found = exported.groupBy(BUCKET_COLUMN).agg(F.count(F.lit(1)).alias("exported_rows"))
    both = expected.join(found, BUCKET_COLUMN, "full_outer").select(
        BUCKET_COLUMN,
        F.coalesce("expected_rows", F.lit(0)).alias("expected_rows"),
        F.coalesce("exported_rows", F.lit(0)).alias("exported_rows"),
    )
    verdict = (
        F.when(F.col("exported_rows") > F.col("expected_rows"), "defect")
        .when(F.col("exported_rows") < F.col("expected_rows"), "missing")
        .otherwise("ok")
    )
    return both.withColumn("status", verdict)


def replay_share(updates: DataFrame) -> DataFrame:
    """Rows before and after collapsing."""
    raw = updates.agg(F.count(F.lit(1)).alias("raw_rows"))
    return side_by_side(raw, collapsed_count(updates, alias="collapsed_rows")).withColumn(
        "replayed_rows", F.col("raw_rows") - F.col("collapsed_rows")
    )
