"""What the physical plans must look like."""

from checks import standins as S
from slotwise.operators.ordering import steps
from slotwise.plans import activity, health, quality, summary


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_no_query_multiplies_rows(spark, sf):
    u, o, r = S.account_updates(spark, sf), S.obligation_snapshots(spark, sf), S.reserve_snapshots(spark, sf)
    frames = [
        activity.activity(u), activity.flow_filled(u, S.FLOW_AS_OF, 60), activity.session_summary(u),
        quality.derive_gaps(u), quality.coverage(u), quality.kind_freeze_audit(u, 10), quality.loss_report(u, o),
        quality.reconcile_gaps(u, S.slot_gaps(spark, sf)), summary.dump_rows_with_run(u, S.snapshot_runs(spark, sf)),
        summary.ingest_stats(u, o, S.ingest_checkpoint(spark, sf), S.slot_gaps(spark, sf), S.AS_OF),
        health.risk_radar(o), activity.liquidity_depth(r),
    ]
    for df in frames:
        plan = plan_of(df)
        assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan


def test_payload_is_not_read_for_activity(spark, sf):
    plan = plan_of(activity.activity(S.account_updates(spark, sf).drop("kind")))
    schema = plan.split("ReadSchema")[1].split("\n")[0]
    assert "value" not in schema and "event_id" in schema


def test_steps_run_no_window_over_the_whole_table(spark, sf):
    plan = plan_of(steps(S.account_updates(spark, sf), "slot", 1_000_000))
    # The one unpartitioned window works on bucket ends, after the aggregation to one row per bucket.
    whole = plan.split("Exchange SinglePartition")
    assert len(whole) == 2 and "HashAggregate(keys=[__cell" in whole[1].split("Exchange")[0]


def test_top_lists_do_not_sort_everything(spark, sf):
    o, u = S.obligation_snapshots(spark, sf), S.account_updates(spark, sf)
    for df in (health.risk_radar(o), health.discover_keys(o), activity.hot_accounts(u), quality.top_steps(u)):
        plan = plan_of(df)
        assert "TakeOrderedAndProject" in plan and "rangepartitioning" not in plan


def test_hot_keys_are_combined_before_the_shuffle(spark, sf):
    o = S.obligation_snapshots(spark, sf)
    for df, agg in ((activity.activity(S.account_updates(spark, sf)), "partial_count"), (health.risk_radar(o), "partial_max_by")):
        assert agg in plan_of(df)


def test_payload_holes_are_runs(spark):
    """Two incidents with sound rows between them are two holes, also over bucket borders."""
    rows = [(k, s, 0 if bad else 9, 5) for k in ("a", "b") for s, bad in ((10, 1), (11, 1), (500, k == "b"), (900_000, 1), (1_900_000, 1), (2_000_000, 0), (2_000_001, 1))]
    df = spark.createDataFrame(rows, "kind string, slot bigint, data_len bigint, lamports bigint")
    got = sorted((r.kind, r.start_slot, r.end_slot, r.size) for r in quality.payload_holes(df).collect())
    assert got == [("a", 10, 11, 2), ("a", 900_000, 1_900_000, 2), ("a", 2_000_001, 2_000_001, 1), ("b", 10, 1_900_000, 5), ("b", 2_000_001, 2_000_001, 1)]


def test_runs_of_two_scopes_at_one_slot(spark):
    from slotwise.plans.summary import dump_rows_with_run

    runs = spark.createDataFrame([(10, "known"), (10, "all"), (25, "all")], "slot bigint, scope string").selectExpr("*", "current_timestamp() as ingested_at")
    rows = spark.createDataFrame([(8, 0), (10, 0), (11, 0), (11, 4)], "slot bigint, write_version bigint")
    got = sorted((r.slot, r.run_slot, r.scope) for r in dump_rows_with_run(rows, runs).collect())
    assert got == [(8, 10, "all"), (8, 10, "known"), (10, 10, "all"), (10, 10, "known"), (11, 25, "all")]
