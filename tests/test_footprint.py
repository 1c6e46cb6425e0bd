"""What a batch or a copy leaves in the executors and on their disks."""

import glob
import os
import time

import pyarrow.parquet as pq
import pytest

from checks import registry
from checks import standins as S
from slotwise.functions.kinds import with_derived
from slotwise.plans import decoding
from slotwise.session import shared_dir
from slotwise.sources import cold, hot, updates
from slotwise.streaming import ingest


def shuffle_files(spark):
    tops = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().localDirsString()
    return {f for top in tops for f in glob.glob(f"{top}/**/shuffle_*.data", recursive=True)}


def left_behind(spark, before):
    """Shuffle files that are still there after a while; they are deleted in the background."""
    for _ in range(50):
        found = shuffle_files(spark) - before
        if not found:
            break
        time.sleep(0.1)
    return found


def work_folders(spark, purpose):
    return set(glob.glob(f"{shared_dir(spark).removeprefix('file://')}/slotwise/{spark.sparkContext.applicationId}/{purpose}-*"))


def persisted(spark):
    return set(spark.sparkContext._jsc.getPersistentRDDs().keySet())


def test_a_batch_is_not_held_by_the_executors(spark, sf, tmp_path, monkeypatch):
    """Nor are its decoded rows or its replays, and the files that hold them instead are gone after it."""
    rows, seen, write = S.wire_updates(spark, sf).orderBy("slot", "write_version", "pubkey").limit(300), [], ingest.write_tables
    blocks = persisted(spark)
    folders = lambda: {f for p in ("batch", "decoded", "replays", "new-updates") for f in work_folders(spark, p)}
    before = folders()

    def written(*a):
        seen.append((persisted(spark) - blocks, len(folders() - before)))
        write(*a)

    monkeypatch.setattr(ingest, "write_tables", written)
    job = ingest.Ingest(spark, str(tmp_path), S.LAYOUTS)
    for i, batch in enumerate((rows.limit(200), rows)):
        job.on_batch(batch, i)
    assert [p for p, _ in seen] == [set(), set()] and [n for _, n in seen] == [1, 2]
    assert folders() == before and updates.read_table(spark, str(tmp_path), "account_updates").count() == 300
    with decoding.decoded_once(S.bronze(spark, sf), S.LAYOUTS) as (tables, _):
        assert persisted(spark) == blocks and all(t.count() for t in tables.values())
    assert folders() == before


def test_files_of_a_failed_batch_go(spark, sf, tmp_path, monkeypatch):
    before = work_folders(spark, "batch")
    monkeypatch.setattr(ingest, "write_tables", lambda *a: 1 / 0)
    with pytest.raises(ZeroDivisionError):
        ingest.Ingest(spark, str(tmp_path), S.LAYOUTS).on_batch(S.wire_updates(spark, sf).limit(10), 0)
    assert work_folders(spark, "batch") == before


def test_writers_leave_no_shuffle_files(spark, sf, tmp_path):
    root, out, conf = str(tmp_path / "store"), str(tmp_path / "hot"), "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    rows = with_derived(S.wire_updates(spark, sf)).selectExpr("*", "cast(null as string) as session_id").repartition(3)
    for setting in (None, "false"):
        if setting:
            spark.conf.set(conf, setting)
        before = shuffle_files(spark)
        for i in range(2):
            updates.write_batch(rows.where(f"write_version % 2 = {i}"), root, "account_updates", f"b{i}{setting}")
        updates.compact(spark, root, "account_updates")
        hot.refresh_hot(spark, root, "account_updates", out, buckets=4)
        cold.export_cold(S.obligation_snapshots(spark, sf), str(tmp_path / f"cold{setting}"), "obligation_snapshots")
        assert not left_behind(spark, before)
        assert spark.conf.get(conf, None) == setting
    spark.conf.unset(conf)


def test_bytes_are_packed_tightly(spark, sf, tmp_path):
    """Wire records, raw and decoded rows: compressed by more than Spark's default, in row groups that a reader can hold."""
    _, files = S.wire_folder(spark, sf, 4), glob.glob(f"{S.wire_folder(spark, sf, 4).removeprefix('file://')}/*.parquet")
    updates.write_batch(decoding.redecode(S.bronze(spark, sf), S.LAYOUTS)["obligation_snapshots"], str(tmp_path), "obligation_snapshots", "b")
    files += glob.glob(f"{tmp_path}/obligation_snapshots/**/*.parquet", recursive=True)
    groups = [pq.ParquetFile(f).metadata for f in files if os.path.getsize(f)]
    assert groups and {m.row_group(0).column(0).compression for m in groups if m.num_row_groups} == {"ZSTD"}
    assert int(updates._PACKED["parquet.block.size"]) <= 32 << 20


def test_rollups_of_a_whole_stream_copy_no_records(spark, sf):
    before = work_folders(spark, "wire")
    registry.QUERIES["stream_rollups"](spark, sf)
    assert work_folders(spark, "wire") == before
