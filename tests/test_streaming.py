"""Ingest with restarts and repeated input."""

import glob

import pytest
from pyspark.sql import functions as F

from checks import standins as S
from slotwise.operators.dedup import collapse_table
from slotwise.plans import quality
from slotwise.sources import updates
from slotwise.streaming import ingest

KEY, OWNER = b"\x01" * 32, b"\x02" * 32


def put(spark, folder, rows):
    spark.createDataFrame(rows, updates.WIRE_SCHEMA).coalesce(1).write.mode("append").parquet(str(folder))


def run(spark, folder, root, **options):
    wire = updates.read_updates_stream(spark, str(folder), **options)
    ingest.start_ingest(wire, str(root), S.LAYOUTS, available_now=True).awaitTermination()


def record(slot, wv=1, key=KEY, lamports=5, data=b"\x00" * 9):
    return (slot, wv, key, OWNER, lamports, data)


def test_ingest_restart_replay_and_guard(spark, tmp_path):
    folder, root = tmp_path / "in", tmp_path / "out"
    assert ingest.read_position(spark, str(root)) is None
    put(spark, folder, [record(0), record(5, 2), record(6, 3, lamports=5, data=b""), record(6, 4, lamports=0, data=b"")])
    run(spark, folder, root)
    assert ingest.read_position(spark, str(root)) == 6
    # The next session repeats slot 6 and goes on far behind it.
    put(spark, folder, [record(6, 3, lamports=5, data=b""), record(9000, 5, lamports=5, data=b"")])
    run(spark, folder, root)
    run(spark, folder, root)  # nothing new
    raw = updates.read_table(spark, str(root), "account_updates")
    assert raw.count() == 5 and collapse_table(raw, "account_updates").count() == 5
    assert ingest.read_position(spark, str(root)) == 9000
    r = ingest.guard_totals(spark, str(root)).collect()[0]
    assert (r.impossible, r.closed, r.first_slot, r.last_slot) == (3, 1, 6, 9000)
    # Session two began at slot 6, inside the resumed range, so there is no gap.
    gaps = ingest.read_batches(spark, str(root), "slot_gaps")
    assert gaps.count() == 0


@pytest.mark.parametrize("first, gaps", [(700, []), (601, [(0, 601)]), (600, [])])
def test_seam_is_judged_on_the_first_slot(spark, tmp_path, first, gaps):
    folder, root = tmp_path / "in", tmp_path / "out"
    put(spark, folder, [record(0)])
    run(spark, folder, root)
    early = [record(300, 8)] if first == 700 else []
    put(spark, folder, [record(first, 2), *early])
    run(spark, folder, root)
    found = quality.current_gaps(ingest.read_batches(spark, str(root), "slot_gaps"))
    assert [(r.start_slot, r.end_slot) for r in found.collect()] == gaps


def test_a_batch_tried_again_replaces_itself(spark, tmp_path):
    job = ingest.Ingest(spark, str(tmp_path), S.LAYOUTS)
    batch = spark.createDataFrame([record(1), record(2, 2)], updates.WIRE_SCHEMA)
    job.on_batch(batch, 0)
    job.on_batch(batch, 0)
    assert updates.read_table(spark, str(tmp_path), "account_updates").count() == 2


def test_bad_records_are_set_aside(spark, tmp_path):
    job = ingest.Ingest(spark, str(tmp_path), S.LAYOUTS)
    bad = [record(1, key=b"short"), record(-1), (None, 1, KEY, OWNER, 5, b"")]
    job.on_batch(spark.createDataFrame([record(3), *bad], updates.WIRE_SCHEMA), 0)
    assert updates.read_table(spark, str(tmp_path), "account_updates").count() == 1
    rejected = spark.read.parquet(f"{tmp_path}/rejected_updates")
    assert sorted(r.reason for r in rejected.collect()) == ["pubkey is not 32 bytes", "slot is missing or negative", "slot is missing or negative"]


def test_an_empty_batch_moves_nothing(spark, tmp_path):
    job = ingest.Ingest(spark, str(tmp_path), S.LAYOUTS)
    job.on_batch(spark.createDataFrame([], updates.WIRE_SCHEMA), 0)
    assert not glob.glob(f"{tmp_path}/*") and not job.judged


def test_start_slot_is_inclusive_and_kinds_filter(spark, tmp_path):
    from slotwise.functions.kinds import tag_hex

    folder, root = tmp_path / "in", tmp_path / "out"
    tagged = bytes.fromhex(tag_hex("Reserve"))
    put(spark, folder, [record(4, 1, data=tagged), record(5, 2, data=tagged), record(6, 3)])
    run(spark, folder, root, start_slot=5, kinds=("Reserve",))
    assert [r.slot for r in updates.read_table(spark, str(root), "account_updates").collect()] == [5]


def test_budget_counts_span_from_the_first_slot_and_ends_the_query(spark, tmp_path):
    folder, root = tmp_path / "in", tmp_path / "out"
    put(spark, folder, [record(10), record(15)])
    put(spark, folder, [record(20), record(21), record(400)])
    for _ in range(2):  # the second start finds the first slot on record
        wire = updates.read_updates_stream(spark, str(folder), options={"maxFilesPerTrigger": "1"})
        query = ingest.start_ingest(wire, str(root), S.LAYOUTS, budget_slots=10)
        assert query.awaitTermination(90)
        put(spark, folder, [record(30, 9)])
    # A third start has nothing left to read and ends as well.
    wire = updates.read_updates_stream(spark, str(folder), options={"maxFilesPerTrigger": "1"})
    assert ingest.start_ingest(wire, str(root), S.LAYOUTS, budget_slots=10).awaitTermination(90)
    assert sorted(r.slot for r in updates.read_table(spark, str(root), "account_updates").collect()) == [10, 15, 20]


def test_json_messages(spark):
    import base64
    import json

    body = {"slot": 7, "write_version": 1, "lamports": 3, **{k: base64.b64encode(v).decode() for k, v in (("pubkey", KEY), ("owner", OWNER), ("data", b"\xff"))}}
    df = spark.createDataFrame([(json.dumps(body).encode(),), (b"not json",)], "value binary")
    good, bad = updates.parse_messages(df).collect()
    assert (good.slot, bytes(good.pubkey), bytes(good.data)) == (7, KEY, b"\xff") and bad.slot is None
    assert updates.parse_messages(df).withColumn("reason", updates.reject_reason()).filter(F.col("reason").isNotNull()).count() == 1


def test_new_offsets_never_erase_history(spark, tmp_path):
    first, second, root = tmp_path / "a", tmp_path / "b", tmp_path / "out"
    put(spark, first, [record(1), record(2, 2)])
    put(spark, second, [record(1), record(2, 2), record(5, 3)])
    wires = [updates.read_updates_stream(spark, str(f)) for f in (first, second)]
    for i, wire in enumerate(wires):
        ingest.start_ingest(wire, str(root), S.LAYOUTS, available_now=True, offsets=f"{root}/_offsets/{i}").awaitTermination()
    raw = updates.read_table(spark, str(root), "account_updates")
    assert sorted(r.slot for r in raw.collect()) == [1, 2, 5]


def test_late_and_out_of_order_records_are_stored(spark, tmp_path):
    """Any split of the source between two runs, the newer part or a random half first, ends with every record once."""
    rows = [record(s, s % 7, key=bytes([s % 5]) * 32) for s in range(0, 6000, 3)]
    for trial, first in enumerate(([r for r in rows if r[0] > 3000], rows[::2], rows[:1] + rows[-1:])):
        root = tmp_path / f"out{trial}"
        for name, some in (("a", first), ("b", rows)):
            folder = tmp_path / f"in{trial}{name}"
            put(spark, folder, some)
            wire = updates.read_updates_stream(spark, str(folder))
            ingest.start_ingest(wire, str(root), S.LAYOUTS, available_now=True, offsets=f"{root}/_offsets/{name}").awaitTermination()
        stored = updates.read_table(spark, str(root), "account_updates")
        assert stored.count() == stored.select("pubkey", "slot", "write_version").distinct().count() == len(rows)
        assert ingest.read_batches(spark, str(root), "slot_gaps").count() == 0
        assert ingest.read_frontier(spark, str(root)).spans == [(0, 5997)]


def test_a_batch_tried_again_does_not_take_itself_for_a_replay(spark, tmp_path):
    batch = spark.createDataFrame([record(5), record(6, 2)], updates.WIRE_SCHEMA)
    for _ in range(2):  # a new session tries the same batch again
        ingest.Ingest(spark, str(tmp_path), S.LAYOUTS, run="r").on_batch(batch, 0)
    assert updates.read_table(spark, str(tmp_path), "account_updates").count() == 2


def test_alarms_are_numbered_over_batches_and_retries(spark, tmp_path):
    fault = lambda s: record(s, data=b"")
    batches = [[fault(s) for s in range(7)], [record(8)], [fault(s) for s in range(10, 22)], [fault(30)]]
    for i, rows in enumerate(batches):
        for _ in range(2 if i == 2 else 1):
            job = ingest.Ingest(spark, str(tmp_path), S.LAYOUTS, run="r", alarm_every=5)
            job.on_batch(spark.createDataFrame(rows, updates.WIRE_SCHEMA), i)
    got = sorted((r.n, r.slot, r.alarm) for r in ingest.read_alarms(spark, str(tmp_path)).collect())
    assert got == [(1, 0, "first"), (5, 4, "repeat"), (10, 12, "repeat"), (15, 17, "repeat"), (20, 30, "repeat")]
    assert ingest.read_alarms(spark, str(tmp_path), "other").count() == 0


def test_intervals_merge_in_any_order():
    import itertools

    from slotwise.streaming.frontier import Intervals

    spans = [(0, 10), (700, 800), (5, 300), (1500, 1500), (890, 900)]
    want = [(0, 300), (700, 900), (1500, 1500)]
    for order in itertools.permutations(spans):
        got = Intervals(order[:2], tolerance=100).merge(order[2:])
        assert got.spans == want and got.holes() == [(300, 700), (900, 1500)] and got.resume_slot == 300
    bounded = Intervals(spans, tolerance=100, limit=2)
    assert bounded.spans == [(0, 900), (1500, 1500)]  # the shortest hole is closed
    assert [bounded.covers(s) for s in (0, 301, 900, 901, 1500)] == [True, True, True, False, True]
    assert got.within(250, 750) == [(250, 300), (700, 750)] and got.within(250, 1500, limit=2) == [(250, 900), (1500, 1500)]
    assert Intervals().resume_slot is None and Intervals().within(0, 9) == []


def test_frontier_of_many_overlapping_batches(spark):
    from slotwise.streaming import frontier

    rows = [("main", s, s + 40) for s in range(0, 5_000_000, 9_000)] + [("main", 2_000_000, 2_500_000), ("other", 0, 10**9)]
    got = frontier.merged(spark, spark.createDataFrame(rows, frontier.SCHEMA), "main", tolerance=600)
    plain = frontier.Intervals([r[1:] for r in rows if r[0] == "main"], tolerance=600)
    assert got.spans == plain.spans and len(got.spans) > 400
    assert frontier.merged(spark, None, "main").spans == []


def test_lost_position_is_recorded_with_its_reason(spark, tmp_path):
    root = tmp_path / "out"
    for i, (slot, failure) in enumerate([(5, None), (9000, "replay_window")]):
        folder = tmp_path / f"in{i}"
        put(spark, folder, [record(slot, i)])
        wire = updates.read_updates_stream(spark, str(folder))
        ingest.start_ingest(wire, str(root), S.LAYOUTS, available_now=True, offsets=f"{root}/_offsets/{i}", failure=failure, session=f"s{i}").awaitTermination()
    found = quality.current_gaps(ingest.read_batches(spark, str(root), "slot_gaps")).collect()
    assert [(r.start_slot, r.end_slot, r.reason.split(":")[0]) for r in found] == [(5, 9000, "position too old")]
    assert [r.slot for r in updates.read_session(spark, str(root), "s1").collect()] == [9000]


def test_position_belongs_to_its_stream(spark, tmp_path):
    for stream, slot in (("main", 10), ("main-old", 99)):
        put(spark, tmp_path / stream, [record(slot)])
        wire = updates.read_updates_stream(spark, str(tmp_path / stream))
        ingest.start_ingest(wire, str(tmp_path / "out"), S.LAYOUTS, stream, available_now=True).awaitTermination()
    assert [ingest.read_position(spark, str(tmp_path / "out"), s) for s in ("main", "main-old", "other")] == [10, 99, None]


def test_late_rows_survive_the_dropping_of_replays(spark, tmp_path):
    from datetime import datetime

    from slotwise.operators.dedup import drop_replays

    schema = "pubkey bigint, slot bigint, write_version bigint, ingested_at timestamp"
    for hour, key in ((0, 1), (5, 2), (1, 3), (5, 2), (0, 1)):
        row = [(key, key, 1, datetime(2024, 1, 1, hour))]
        spark.createDataFrame(row, schema).coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))
    stream = spark.readStream.schema(schema).option("maxFilesPerTrigger", "1").parquet(str(tmp_path / "in"))
    writer = drop_replays(stream).writeStream.format("parquet").option("checkpointLocation", str(tmp_path / "c"))
    writer.option("path", str(tmp_path / "out")).trigger(availableNow=True).start().awaitTermination()
    assert sorted(r.pubkey for r in spark.read.parquet(str(tmp_path / "out")).collect()) == [1, 2, 3]


def test_compaction_and_pruning(spark, tmp_path):
    job = ingest.Ingest(spark, str(tmp_path), S.LAYOUTS)
    for i in range(3):
        rows = [record(s, i * 10 + k) for k, s in enumerate((5, 10_000_005, 20_000_005))]
        job.on_batch(spark.createDataFrame(rows, updates.WIRE_SCHEMA), i)
    before = sorted(map(str, updates.read_table(spark, str(tmp_path), "account_updates").collect()))
    assert updates.compact(spark, str(tmp_path), "account_updates") == ["000000000000", "000010000000"]
    assert updates.compact(spark, str(tmp_path), "account_updates") == []
    assert sorted(map(str, updates.read_table(spark, str(tmp_path), "account_updates").collect())) == before
    batches = [len(glob.glob(f"{tmp_path}/account_updates/slot_bucket={b:012d}/batch_id=*")) for b in (0, 10_000_000, 20_000_000)]
    assert batches == [1, 1, 3]
    some = updates.read_table(spark, str(tmp_path), "account_updates", slots=(10_000_000, 15_000_000))
    plan = some._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(slot_bucket" in plan and some.count() == 3


def test_merged_batches_wait_for_readers(spark, tmp_path):
    schema = "slot bigint, write_version bigint, pubkey binary, kind string, owner binary, lamports bigint, data binary, data_len bigint, ingested_at timestamp, session_id string"
    for i, slot in enumerate((1, 2, 20_000_000)):
        updates.write_batch(spark.createDataFrame([(slot, i, KEY, "x", OWNER, 1, b"", 0, None, "s")], schema), str(tmp_path), "account_updates", f"b{i}")
    there = lambda: sorted(p.rsplit("=", 1)[1][:2] for p in glob.glob(f"{tmp_path}/account_updates/slot_bucket=000000000000/batch_id=*"))
    assert updates.compact(spark, str(tmp_path), "account_updates", grace_seconds=3600) == ["000000000000"]
    assert there() == ["b0", "b1", "co"]
    assert updates.compact(spark, str(tmp_path), "account_updates", grace_seconds=3600) == [] and there() == ["b0", "b1", "co"]
    assert updates.compact(spark, str(tmp_path), "account_updates") == [] and there() == ["co"]
    rows = updates.read_table(spark, str(tmp_path), "account_updates")
    assert sorted(r.slot for r in rows.collect()) == [1, 2, 20_000_000]


def test_flow_has_every_minute(spark, tmp_path):
    from datetime import datetime

    from slotwise.streaming import monitors

    schema = "ingested_at timestamp, kind string, data_len bigint"
    for minute in (9, 3, 9, 0):
        row = [(datetime(2024, 1, 1, 0, minute), "Reserve", 7)]
        spark.createDataFrame(row, schema).coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))
    stream = spark.readStream.schema(schema).option("maxFilesPerTrigger", "1").parquet(str(tmp_path / "in"))
    monitors.start_flow_monitor(stream, str(tmp_path / "m"), available_now=True).awaitTermination()
    got = {r.minute % 3600 // 60: (r.writes, r.bytes) for r in monitors.read_flow(spark, str(tmp_path / "m")).collect()}
    assert got == {9: (2, 14), 3: (1, 7), 0: (1, 7)}
