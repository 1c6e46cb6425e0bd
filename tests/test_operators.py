"""Operators against brute force, and their invariants."""

import random
from datetime import datetime, timedelta

import numpy as np
import pytest
from pyspark.sql import functions as F

from slotwise.functions.verdicts import FAILURE_REASONS
from slotwise.operators.dedup import collapse, collapsed_count, latest
from slotwise.operators.ordering import global_rank, page_after, steps
from slotwise.operators.quantiles import exact_percentiles, value_counts, percentiles_of_counts
from slotwise.operators.rows import side_by_side
from slotwise.plans import quality
from slotwise.schemas import TABLE_KEYS

T0 = datetime(2024, 1, 1)
SCHEMA = "pubkey bigint, slot bigint, write_version bigint, lamports bigint, ingested_at timestamp"


def history(n=400, copies=1 / 3, seed=1):
    """Versions of few accounts; one version is replayed so often that it is a third of all rows."""
    rng = random.Random(seed)
    rows = [(rng.randrange(5), rng.randrange(50), i, rng.randrange(9), T0 + timedelta(seconds=i)) for i in range(n)]
    hot = rows[0]
    rows += [(*hot[:4], T0 + timedelta(days=1, seconds=i)) for i in range(int(n * copies))]
    rng.shuffle(rows)
    return rows


def test_collapse_keeps_the_newest_copy(spark):
    rows = history()
    want = {}
    for r in rows:
        key = r[:3]
        if key not in want or r[4] > want[key][4]:
            want[key] = r
    got = [tuple(r) for r in collapse(spark.createDataFrame(rows, SCHEMA)).collect()]
    assert sorted(got) == sorted(want.values())
    assert collapsed_count(spark.createDataFrame(rows, SCHEMA)).collect()[0][0] == len(want)


def test_collapse_is_idempotent_and_ignores_order(spark):
    rows = history(seed=2)
    rows += [(1, 1, 1, x, T0) for x in (3, 4, 5)]  # a tie that only the content can settle
    a = collapse(spark.createDataFrame(rows, SCHEMA))
    b = collapse(spark.createDataFrame(rows[::-1], SCHEMA).repartition(7))
    first = sorted(map(tuple, a.collect()))
    assert first == sorted(map(tuple, b.collect())) == sorted(map(tuple, collapse(a).collect()))


def test_one_replay_among_many(spark):
    rows = [(i % 40, 437_999_000 + i, i, 1, T0) for i in range(4300)] + [(0, 437_999_000, 0, 1, T0 + timedelta(hours=1))]
    df = spark.createDataFrame(rows, SCHEMA)
    assert df.count() == 4301 and collapse(df).count() == 4300


def test_versions_inside_a_slot_survive(spark):
    df = spark.createDataFrame([(1, 5, v, v, T0) for v in range(10)], SCHEMA)
    assert collapse(df).count() == 10


def test_no_version_column_is_part_of_its_own_key():
    for keys, version in TABLE_KEYS.values():
        assert version not in keys


def test_hot_copies_are_pruned_before_the_shuffle(spark):
    plan = collapse(spark.createDataFrame(history(), SCHEMA))._jdf.queryExecution().executedPlan().toString()
    below = plan.split("Exchange hashpartitioning(pubkey")[1]
    assert "WindowGroupLimit" in below


def test_latest_takes_all_columns_from_one_row(spark):
    rows = history(seed=3)
    got = latest(spark.createDataFrame(rows, SCHEMA), ["slot", "write_version", "lamports"]).collect()
    for r in got:
        best = max((x for x in rows if x[0] == r.pubkey), key=lambda x: (x[1], x[2]))
        assert (r.slot, r.write_version, r.lamports) == best[1:4]


@pytest.mark.parametrize("seed", range(4))
def test_steps_equal_a_global_lag(spark, seed):
    rng = random.Random(seed)
    values = sorted({rng.randrange(0, 5000) for _ in range(300)} | {7_000, 90_000})
    rows = [(v,) for v in values for _ in range(rng.randrange(1, 4))]
    got = sorted(tuple(r) for r in steps(spark.createDataFrame(rows, "slot bigint"), "slot", 100).collect())
    assert got == list(zip(values, values[1:]))


def test_steps_per_group(spark):
    rows = [("a", 1), ("a", 250), ("b", 5), ("b", 6), ("a", 3)]
    got = sorted(tuple(r) for r in steps(spark.createDataFrame(rows, "kind string, slot bigint"), "slot", 100, ("kind",)).collect())
    assert got == [("a", 1, 3), ("a", 3, 250), ("b", 5, 6)]


@pytest.mark.parametrize("seed", range(3))
def test_percentiles_equal_numpy(spark, seed):
    rng = np.random.default_rng(seed)
    values = np.concatenate([rng.integers(0, 10_000_000, 700), np.full(350, 1_500_000), [2**62]])  # a third share one value
    df = spark.createDataFrame([(int(v),) for v in values], "v bigint").repartition(5)
    probs = [0.0, 0.1, 0.25, 0.5, 0.75, 0.99, 1.0]
    got = {r.p: r.value for r in exact_percentiles(df, "v", probs).collect()}
    for p in probs:
        assert got[p] == pytest.approx(np.quantile(values.astype(float), p), rel=1e-12)


def test_percentiles_of_a_filtered_table_and_of_nothing(spark):
    counts = value_counts(spark.createDataFrame([(i,) for i in range(101)], "x bigint"), "x")
    assert percentiles_of_counts(counts.filter("v <= 50"), [0.5]).collect()[0].value == 25.0
    assert percentiles_of_counts(counts.filter("v > 1000"), [0.5]).collect() == []
    with pytest.raises(ValueError):
        percentiles_of_counts(counts, [1.5])


def test_global_rank_numbers_every_row_once(spark):
    rng = random.Random(9)
    rows = [(7 if rng.random() < 0.4 else rng.randrange(100), i) for i in range(1000)]
    ranked = global_rank(spark.createDataFrame(rows, "slot bigint, wv bigint").repartition(6), ["slot", "wv"])
    got = [(r.slot, r.wv) for r in ranked.orderBy("n").collect()]
    assert got == sorted(rows)
    assert [r.n for r in ranked.orderBy("n").collect()] == list(range(1, 1001))


def test_equal_rows_spread_over_partitions(spark):
    df = spark.range(4000).select(F.lit(7).alias("slot"))
    placed = global_rank(df.repartition(6), ["slot"])
    assert sorted(r.n for r in placed.collect()) == list(range(1, 4001))


def test_pages_concatenate_to_the_whole(spark):
    rows = sorted({(random.Random(i).randrange(20), i) for i in range(97)})
    df = spark.createDataFrame(rows, "slot bigint, wv bigint")
    seen, cursor = [], None
    while True:
        page = [tuple(r) for r in page_after(df, ["slot", "wv"], cursor, 10).collect()]
        seen += page
        if len(page) < 10:
            break
        cursor = page[-1]
    assert seen == rows


def test_side_by_side(spark):
    a, b = spark.range(3).agg(F.count("*").alias("n")), spark.range(9).agg(F.max("id").alias("m"))
    row = side_by_side(a, b).collect()[0]
    assert (row.n, row.m) == (3, 8)


# --- gaps and faults --------------------------------------------------------------------------


def slots(spark, values):
    return spark.createDataFrame([(v,) for v in values], "slot bigint")


def test_known_outage(spark):
    before, after = range(437_313_000, 437_313_970, 3), range(437_387_843, 437_388_500, 3)
    got = quality.derive_gaps(slots(spark, [*before, *after])).collect()
    assert [tuple(r) for r in got] == [(max(before), 437_387_843, 437_387_843 - max(before) - 1)]


@pytest.mark.parametrize("drift, missed_rule, drift_rule", [(600, 0, 0), (601, 0, 1), (602, 1, 1)])
def test_the_two_rules_differ_by_one_slot(spark, drift, missed_rule, drift_rule):
    df = slots(spark, [1000, 1000 + drift])
    assert quality.derive_gaps(df).count() == missed_rule
    assert quality.derive_gaps(df, rule="drift").count() == drift_rule
    with pytest.raises(ValueError):
        quality.derive_gaps(df, rule="other")


def test_degenerate_gap_rows_are_dropped(spark):
    rows = [("main", 10, 0, T0, 0, "x", T0), ("main", 10, 700, T0, 0, "y", T0 - timedelta(1)), ("main", 20, 900, T0, 0, "z", T0)]
    df = spark.createDataFrame(rows, "stream string, start_slot bigint, end_slot bigint, detected_at timestamp, filled int, reason string, ingested_at timestamp")
    assert [r.start_slot for r in quality.current_gaps(df).collect()] == [20]
    r = quality.gap_status(df).collect()[0]
    assert (r.total_missed_slots, r.gap_count) == (879, 1)


def test_failure_gaps(spark):
    rows = [("replay_window", 10, 900, T0), ("early_end", 20, 0, T0), ("power cut", 30, 31, T0)]
    got = quality.failure_gaps(spark.createDataFrame(rows, "code string, start_slot bigint, end_slot bigint, detected_at timestamp")).collect()
    assert [(r.start_slot, r.reason) for r in got] == [(10, FAILURE_REASONS["replay_window"]), (30, "power cut")]


UPDATES = "slot bigint, write_version bigint, pubkey bigint, lamports bigint, data_len bigint, kind string, ingested_at timestamp"


def updates(spark, rows):
    return spark.createDataFrame([(s, i, i % 7, lam, n, "k", T0) for i, (s, lam, n) in enumerate(rows)], UPDATES)


def test_healthy_data_raises_no_alarm(spark):
    df = updates(spark, [(i, 5, 3344) for i in range(10_000)])
    assert quality.payload_alarms(df).count() == 0
    assert quality.payload_guard(df).collect()[0].firing is False


def test_alarm_cadence(spark):
    df = updates(spark, [(i, 5, 0) for i in range(2000)])
    assert sorted(r.n for r in quality.payload_alarms(df).collect()) == [1, 500, 1000, 1500, 2000]


def test_closures_are_not_faults(spark):
    r = quality.payload_guard(updates(spark, [(1, 0, 0), (2, 0, 0), (3, 5, 10)])).collect()[0]
    assert (r.impossible, r.closed) == (0, 2)


def test_fault_span(spark):
    r = quality.payload_guard(updates(spark, [(437903892, 5, 0), (437999999, 5, 9), (438300972, 5, 0)])).collect()[0]
    assert (r.impossible, r.first_slot, r.last_slot) == (2, 437903892, 438300972)


def test_kind_freeze_finds_the_successor(spark):
    rows = [(s, s, s % 5, 1, 1, "old", T0) for s in range(0, 1000, 10)] + [(s, s, s % 5, 1, 0, "new", T0) for s in range(1000, 3000, 10)]
    rows += [(s, s, 9, 1, 1, "steady", T0) for s in range(0, 3000, 50)]
    got = {r.kind: r for r in quality.kind_freeze_audit(spark.createDataFrame(rows, UPDATES), 500).collect()}
    assert got["old"].frozen and got["old"].successor == "new" and got["old"].shared_share == 1.0
    assert not got["steady"].frozen and got["steady"].successor == ""


def test_freshness_without_data(spark):
    r = quality.freshness(spark.createDataFrame([], UPDATES), "2024-01-01 00:00:00").collect()[0]
    assert (r.age_s, r.state) == (-1, "unknown")
    r = quality.health_check(spark.createDataFrame([], UPDATES), "2024-01-01 00:00:00", 300).collect()[0]
    assert r.status == "UNREACHABLE"
