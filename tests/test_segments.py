"""The stream source over stored segments: order, pruning, restarts, late files."""

import os

import pyarrow as pa
import pyarrow.parquet as pq
import pytest

from checks import standins as S
from slotwise.functions.kinds import tag_hex
from slotwise.sources import updates
from slotwise.sources.segments import SegmentReader, read_segments_stream
from slotwise.streaming import ingest

KEY, OWNER = b"\x01" * 32, b"\x02" * 32
OBLIGATION, RESERVE = (bytes.fromhex(tag_hex(k)) + b"\x00" for k in ("Obligation", "Reserve"))


def segment(folder, name, slots, data=OBLIGATION, group=100):
    os.makedirs(folder, exist_ok=True)
    n = len(slots)
    columns = {"slot": pa.array(slots, pa.int64()), "write_version": pa.array(range(n), pa.int64()), "pubkey": [KEY] * n, "owner": [OWNER] * n}
    columns |= {"lamports": pa.array([5] * n, pa.int64()), "data": pa.array([data] * n if isinstance(data, bytes) else data, pa.binary())}
    pq.write_table(pa.table(columns), f"{folder}/{name}.parquet", row_group_size=group)


def reader(tmp_path, **options):
    return SegmentReader({"path": str(tmp_path / "in"), "log": str(tmp_path / "log"), **options})


def slots_of(source, start, end):
    return [s for p in source.partitions(start, end) for b in source.read(p) for s in b.column("slot").to_pylist()]


def test_batches_go_by_slot_and_late_files_are_delivered(tmp_path):
    for name, first in (("a", 30), ("b", 10), ("c", 20)):
        segment(tmp_path / "in", name, range(first, first + 5))
    source = reader(tmp_path, rowsPerBatch="10")
    begin = source.initialOffset()
    one = source.latestOffset()
    assert slots_of(source, begin, one) == [10, 11, 12, 13, 14, 20, 21, 22, 23, 24]
    segment(tmp_path / "in", "late", [1, 2])
    # A restart in between: the lists, not the process, know what was delivered.
    source = reader(tmp_path, rowsPerBatch="10")
    two = source.latestOffset()
    assert slots_of(source, one, two) == [1, 2, 30, 31, 32, 33, 34]
    assert source.latestOffset() == two and slots_of(source, two, two) == []
    assert len(slots_of(source, begin, two)) == 17  # a batch that spans several lists, or is tried again


def test_start_slot_is_inclusive_and_prunes(tmp_path):
    low, high = tmp_path / "in" / "slot_bucket=000000000000", tmp_path / "in" / "slot_bucket=000010000000"
    segment(low / "batch_id=x", "a", range(100))
    segment(high / "batch_id=x", "b", range(10_000_000, 10_000_400))
    segment(high / "batch_id=y", "c", [10_000_001])
    source = reader(tmp_path, startSlot="10000250")
    end = source.latestOffset()
    parts = source.partitions(source.initialOffset(), end)
    assert [(os.path.basename(p.file), p.groups) for p in parts] == [("b.parquet", [2, 3])]
    assert slots_of(source, source.initialOffset(), end) == list(range(10_000_250, 10_000_400))
    with pytest.raises(ValueError, match="start slot"):
        reader(tmp_path, startSlot="5").latestOffset()


def test_kinds_are_left_out_before_spark(tmp_path):
    segment(tmp_path / "in", "a", range(5), [OBLIGATION, RESERVE, b"", None, OBLIGATION[:7]])
    source = reader(tmp_path, kinds="Obligation,Reserve")
    assert slots_of(source, {"list": 0}, source.latestOffset()) == [0, 1]
    everything = SegmentReader({"path": str(tmp_path / "in"), "log": str(tmp_path / "log2")})
    assert slots_of(everything, {"list": 0}, everything.latestOffset()) == [0, 1, 2, 3, 4]


def test_odd_segments(tmp_path):
    source = reader(tmp_path)
    assert source.latestOffset() == source.initialOffset()  # no folder yet
    segment(tmp_path / "in", "empty", [])
    segment(tmp_path / "in" / "_temporary" / "0", "unfinished", [7])
    segment(tmp_path / "in", "nulls", [None, None])
    pq.write_table(pa.table({"slot": [3], "extra": ["x"]}), str(tmp_path / "in" / "narrow.parquet"))
    pq.write_table(pa.table({"extra": ["x"]}), str(tmp_path / "in" / "other.parquet"))
    end = source.latestOffset()
    rows = [r for p in source.partitions({"list": 0}, end) for b in source.read(p) for r in b.to_pylist()]
    assert sorted(str(r["slot"]) for r in rows) == ["3", "None", "None", "None"]
    assert all(set(r) == set(updates.WIRE_SCHEMA.fieldNames()) for r in rows)
    later = SegmentReader({"path": str(tmp_path / "in"), "log": str(tmp_path / "log2"), "startSlot": "0", "kinds": "Reserve"})
    assert slots_of(later, {"list": 0}, later.latestOffset()) == []
    os.remove(tmp_path / "in" / "nulls.parquet")
    with pytest.raises(FileNotFoundError):
        slots_of(source, {"list": 0}, end)
    with pytest.raises(ValueError):
        SegmentReader({"path": "x"})


def test_a_large_file_is_split_over_tasks(tmp_path, monkeypatch):
    segment(tmp_path / "in", "a", range(1000))
    monkeypatch.setattr("slotwise.sources.segments.SPLIT_BYTES", 5000)
    source = reader(tmp_path)
    parts = source.partitions({"list": 0}, source.latestOffset())
    assert len(parts) > 2 and sorted(g for p in parts for g in p.groups) == list(range(10))


def test_stream_over_restarts_and_live(spark, tmp_path):
    folder, log, root = str(tmp_path / "in"), str(tmp_path / "log"), str(tmp_path / "out")

    def drain():
        ingest.start_ingest(read_segments_stream(spark, folder, log, 5), root, S.LAYOUTS, available_now=True).awaitTermination()

    segment(folder, "b", range(100, 110))
    drain()
    segment(folder, "a", range(10))
    drain()
    drain()
    stored = updates.read_table(spark, root, "account_updates")
    assert sorted(r.slot for r in stored.select("slot").collect()) == [*range(5, 10), *range(100, 110)]
    # Bounded batches while the stream runs.
    live = read_segments_stream(spark, folder, str(tmp_path / "log2"), kinds=["Obligation"], rows_per_batch=10)
    sizes = []
    query = live.writeStream.foreachBatch(lambda df, n: sizes.append(df.count())).option("checkpointLocation", str(tmp_path / "c")).start()
    try:
        query.processAllAvailable()
    finally:
        query.stop()
    assert sizes == [10, 10]
