"""Copies of history in other orders, pages over files, figures kept up per batch, and the freshness watch."""

import glob
import random

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from slotwise.functions.slots import slot_bucket
from slotwise.plans import rollups
from slotwise.sources import hot, paging, updates
from slotwise.streaming import freshness

ROW = T.StructType([T.StructField("pubkey", T.BinaryType()), *[T.StructField(c, T.LongType()) for c in ("slot", "write_version", "value")], T.StructField("ingested_at", T.TimestampType())])


def versions(spark, n=3000, keys=40, hot_share=3):
    """Random versions; every third belongs to one key, and some arrive twice."""
    draw = random.Random(5)
    rows = []
    for i in range(n):
        key = bytes([0 if i % hot_share == 0 else draw.randrange(keys)]) * 32
        rows.append((key, draw.randrange(40_000_000), i, draw.randrange(99)))
    rows += rows[:: n // 20]
    df = spark.createDataFrame(rows, "pubkey binary, slot bigint, write_version bigint, value bigint")
    return df.withColumn("ingested_at", F.lit("2024-01-01").cast("timestamp")).repartition(5), rows


def test_one_bucket_is_read_for_a_key(spark, tmp_path):
    df, rows = versions(spark)
    out = str(tmp_path / "hot")
    hot.write_hot(df, out, "t", "b", buckets=16)
    for key in (bytes(32), bytes([7]) * 32):
        mine = hot.key_history(spark, out, "t", bytearray(key), ["slot", "write_version", "value"], ROW, 16)
        assert [tuple(r) for r in mine.collect()] == sorted({r[1:] for r in rows if r[0] == key})
        found = hot.rows_of_key(spark, out, "t", bytearray(key), ROW, 16)
        folders = {f.split("key_bucket=")[1].split("/")[0] for f in found.inputFiles()}
        plan = found._jdf.queryExecution().executedPlan().toString()
        assert "PartitionFilters: [isnotnull(key_bucket" in plan and "EqualTo(pubkey" in plan
        read = found.select(F.input_file_name().alias("f")).distinct().collect()
        assert len({r.f.split("key_bucket=")[1].split("/")[0] for r in read}) == 1 and len(folders) > 1
        state = hot.key_state(spark, out, "t", bytearray(key), ["slot", "value"], ROW, 16).first()
        last = max((r[1:] for r in rows if r[0] == key), key=lambda r: r[:2])
        assert (state.slot, state.value) == (last[0], last[2])
    assert hot.key_history(spark, out, "t", bytearray(b"x" * 32), ["slot"], ROW, 16).collect() == []


def test_bloom_filters_and_order_inside_files(spark, tmp_path):
    import pyarrow.parquet as pq

    df, _ = versions(spark)
    hot.write_hot(df, str(tmp_path), "t", "b", buckets=4)
    files = glob.glob(f"{tmp_path}/t/key_bucket=*/batch_id=b/*.parquet")
    for file in files:
        table = pq.ParquetFile(file).read(columns=["pubkey", "slot", "write_version"]).to_pylist()
        order = [tuple(r.values()) for r in table]
        assert order == sorted(order)
        size = pq.ParquetFile(file).metadata.row_group(0).total_byte_size
        assert size and b"BLOOM" not in open(file, "rb").read(4)


def test_refresh_takes_each_batch_once(spark, tmp_path):
    root, out = str(tmp_path / "store"), str(tmp_path / "hot")
    schema = "slot bigint, write_version bigint, pubkey binary, kind string, owner binary, lamports bigint, data binary, data_len bigint, ingested_at timestamp, session_id string"

    def batch(name, slots):
        rows = [(s, i, bytes([s % 3]) * 32, "Reserve", bytes(32), 1, b"x", 1, None, "s") for i, s in enumerate(slots)]
        updates.write_batch(spark.createDataFrame(rows, schema), root, "account_updates", name)

    batch("b0", [1, 2, 30_000_000])
    assert hot.refresh_hot(spark, root, "account_updates", out, 4) == ["b0"]
    assert hot.refresh_hot(spark, root, "account_updates", out, 4) == []
    batch("b1", [5, 6])
    updates.compact(spark, root, "account_updates")  # merges b0 and b1 of the closed bucket; b1 was not taken before
    assert any(n.startswith(updates.COMPACTED) for n in hot.refresh_hot(spark, root, "account_updates", out, 4))
    rows = hot.read_hot(spark, out, "account_updates")
    assert sorted(r.slot for r in rows.collect()) == [1, 2, 5, 6, 30_000_000]


def raw_batch(spark, root, name, rows):
    """Rows of (slot, write_version, key byte or None) as one stored batch."""
    schema = "slot bigint, write_version bigint, pubkey binary, kind string, owner binary, lamports bigint, data binary, data_len bigint, ingested_at timestamp, session_id string"
    rows = [(s, v, None if k is None else bytes([k]) * 32, "Reserve", bytes(32), 1, b"x", 1, None, "s") for s, v, k in rows]
    updates.write_batch(spark.createDataFrame(rows, schema), root, "account_updates", name)


def test_merged_rows_that_are_known_are_not_written_again(spark, tmp_path, monkeypatch):
    root, out = str(tmp_path / "store"), str(tmp_path / "hot")
    for name, rows in (("b0", [(1, 1, 1), (2, 2, None), (30_000_000, 3, 1)]), ("b1", [(1, 4, 1), (5, 5, None), (5, 5, None)])):
        raw_batch(spark, root, name, rows)
        hot.refresh_hot(spark, root, "account_updates", out, 4)
    updates.compact(spark, root, "account_updates")
    calls, write = [], hot.write_hot
    monkeypatch.setattr(hot, "write_hot", lambda *a: (calls.append(a), write(*a)))
    (merged,) = hot.refresh_hot(spark, root, "account_updates", out, 4)
    assert merged.startswith(updates.COMPACTED) and not calls
    assert hot.refresh_hot(spark, root, "account_updates", out, 4) == []
    assert sorted(r.write_version for r in hot.read_hot(spark, out, "account_updates").collect()) == [1, 2, 3, 4, 5, 5]


def test_a_refresh_that_is_tried_again_loses_no_rows(spark, tmp_path, monkeypatch):
    """The first attempt wrote its rows and failed before its record: merged rows and those of a batch under one name."""
    root, out = str(tmp_path / "store"), str(tmp_path / "hot")
    raw_batch(spark, root, "a0", [(1, 1, 1), (30_000_000, 2, 1)])
    hot.refresh_hot(spark, root, "account_updates", out, 1)
    raw_batch(spark, root, "a1", [(2, 3, 1)])
    updates.compact(spark, root, "account_updates")
    raw_batch(spark, root, "b2", [(3, 4, 1)])
    with monkeypatch.context() as m:
        m.setattr(type(spark), "createDataFrame", lambda *a, **k: 1 / 0)
        with pytest.raises(ZeroDivisionError):
            hot.refresh_hot(spark, root, "account_updates", out, 1)
    hot.refresh_hot(spark, root, "account_updates", out, 1)
    assert sorted(r.write_version for r in hot.read_hot(spark, out, "account_updates").collect()) == [1, 2, 3, 4]


def test_raw_rows_are_stored_without_dictionaries_of_bytes(spark, tmp_path):
    import pyarrow.parquet as pq

    raw_batch(spark, str(tmp_path), "b0", [(i, i, i % 5) for i in range(50)])
    group = pq.ParquetFile(glob.glob(f"{tmp_path}/account_updates/*/*/*.parquet")[0]).metadata.row_group(0)
    columns = {group.column(i).path_in_schema: group.column(i).encodings for i in range(group.num_columns)}
    assert not [c for c in ("pubkey", "owner", "data") if "RLE_DICTIONARY" in columns[c] or "PLAIN_DICTIONARY" in columns[c]]
    assert "RLE_DICTIONARY" in columns["kind"] or "PLAIN_DICTIONARY" in columns["kind"]


@pytest.mark.parametrize("layout", ["sorted", "overlapping"])
def test_pages_make_up_the_whole(spark, tmp_path, layout):
    df, rows = versions(spark)
    path = str(tmp_path / "files")
    if layout == "sorted":
        df = df.repartitionByRange(30, *paging.ORDER).sortWithinPartitions(*paging.ORDER)
    else:
        df = df.withColumn("b", slot_bucket(width=10_000_000)).repartition(9, "b", F.col("write_version") % 3).drop("b")
    df.write.parquet(path)
    pages = paging.Pages(spark, path, ROW, ["slot", "write_version", "pubkey", "value"])
    got, cursor = [], None
    while True:
        page = [(r.slot, r.write_version, bytes(r.pubkey), r.value) for r in pages.page(cursor, 400).collect()]
        if not page:
            break
        got += page
        cursor = (page[-1][0], page[-1][1], bytearray(page[-1][2]))
    want = sorted({(r[1], r[2], r[0], r[3]) for r in rows})
    assert got == want
    if layout == "sorted":
        assert max(pages.opened) <= 7  # of 30 files, for 400 of 3,000 rows


def test_rollups_of_batches_add_up(spark, tmp_path):
    df, _ = versions(spark)
    rows = df.withColumn("kind", F.lit("Reserve")).withColumn("data_len", F.col("value"))
    for i in (0, 1, 1, 2):
        rollups.store_rollup({"account_updates": rows.filter(F.col("write_version") % 3 == i)}, str(tmp_path), f"b{i}")
    (got,) = rollups.activity_by_kind(rollups.read_rollups(spark, str(tmp_path))).collect()
    n, size, last = rows.agg(F.count("*"), F.sum("value"), F.max("slot")).first()
    assert (got.kind, got.updates, got.bytes, got.last_slot) == ("Reserve", n, size, last)


def test_a_silent_kind_turns_slow_and_stale(spark, tmp_path):
    schema = "kind string, ingested_at timestamp"
    put = lambda *kinds: spark.createDataFrame([(k, None) for k in kinds], schema).withColumn("ingested_at", F.current_timestamp()).coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))
    put("A", "B", "A")
    stream = spark.readStream.schema(schema).parquet(str(tmp_path / "in"))
    query = freshness.start_freshness_watch(stream, str(tmp_path / "out"), ["A", "C"], 3, 6, every="500 milliseconds")
    try:
        again, seen = False, {}
        for _ in range(120):
            assert not query.awaitTermination(0.5)
            if not freshness.has_changes(spark, str(tmp_path / "out")):
                continue
            # Timers that expire in one batch are reported at one time.
            rank = ["unknown", "fresh", "slow", "stale"].index
            changes = sorted(freshness.read_changes(spark, str(tmp_path / "out")).collect(), key=lambda r: (r.at_ms, rank(r.state)))
            seen = {k: [r.state for r in changes if r.kind == k] for k in "ABC"}
            if "stale" in seen["B"] and not again:
                put("B")  # a row makes it fresh again
                again = True
            if again and seen["B"].count("stale") == 2:
                break
        assert seen["B"] == ["fresh", "slow", "stale"] * 2 and seen["A"] == ["fresh", "slow", "stale"] and seen["C"] == ["unknown"]
        states = {r.kind: r.state for r in freshness.current_states(spark, str(tmp_path / "out")).collect()}
        assert states == {"A": "stale", "B": "stale", "C": "unknown"}
    finally:
        query.stop()
