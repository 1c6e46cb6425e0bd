"""Cold copy, state dumps, dashboards: written and read back."""

import base64
import glob
import json
from datetime import datetime, timedelta

import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from checks import standins as S
from slotwise.functions.base58 import encode_keys
from slotwise.functions.kinds import tag_hex
from slotwise.functions.slots import slot_between
from slotwise.plans import dashboard, quality
from slotwise.sources import cold, state_dump, updates

T0 = datetime(2024, 1, 1)


def history(spark, n=4300, start=437_995_900):
    """One row per slot across a bucket border, one replay, keys with zero bytes at both ends."""
    rows = spark.range(n).select(
        (F.col("id") + start).alias("slot"),
        F.col("id").alias("write_version"),
        F.concat(F.lit(b"\x00\x00"), F.substring(S.key32(F.col("id") % 40 + 256), 5, 28), F.lit(b"\x01\x00")).alias("pubkey"),
        F.lit("Reserve").alias("kind"),
        F.lit(b"\x02" * 32).alias("owner"),
        F.lit(5).cast("bigint").alias("lamports"),
        F.lit(b"\x00\xff\x00").alias("data"),
        F.lit(3).cast("bigint").alias("data_len"),
        F.lit(T0).alias("ingested_at"),
    )
    again = rows.filter("write_version = 7").withColumn("ingested_at", F.lit(T0 + timedelta(hours=1)))
    return rows.unionByName(again)


def test_export_splits_collapses_and_sorts(spark, tmp_path):
    out = str(tmp_path / "cold")
    source = history(spark)
    result = cold.export_cold(source, out)
    assert result.buckets == ("000437000000", "000438000000")
    got = cold.read_cold_table(spark, out, "account_updates")
    assert got.schema["slot_bucket"].dataType.simpleString() == "string"
    assert {r.slot_bucket: r.exported_rows for r in cold.exported_rows(spark, result).collect()} == {"000437000000": 4100, "000438000000": 200}
    assert got.filter("write_version = 7").collect()[0].ingested_at == T0 + timedelta(hours=1)
    assert {len(r.pubkey) for r in got.select("pubkey").collect()} == {32}
    ranges = []
    for path in glob.glob(f"{out}/account_updates/*/*.parquet"):
        table = pq.ParquetFile(path)
        assert table.metadata.row_group(0).column(0).compression == "ZSTD"
        rows = table.read(columns=["slot", "write_version", "pubkey"]).to_pylist()
        order = [(r["slot"], r["write_version"], r["pubkey"]) for r in rows]
        assert order == sorted(order)
        ranges.append((order[0], order[-1]))
    ranges.sort()
    assert all(a[1] < b[0] for a, b in zip(ranges, ranges[1:]))  # files do not overlap
    assert {r.status for r in quality.reconcile_export(source, got).collect()} == {"ok"}


def test_hot_bucket_becomes_several_files(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(cold, "ROWS_PER_FILE", 500)
    out = str(tmp_path / "cold")
    source = history(spark).withColumn("slot", F.when(F.col("write_version") < 2000, 437_996_000).otherwise(F.col("slot")))  # a busy slot
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")  # the fixture is tiny
    try:
        cold.export_cold(source, out)
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    files = glob.glob(f"{out}/account_updates/slot_bucket=000437000000/*.parquet")
    sizes = [pq.ParquetFile(f).metadata.num_rows for f in files]
    assert len(files) > 1 and sum(sizes) == 4100 and max(sizes) < 4000
    for path in files:
        rows = pq.ParquetFile(path).read(columns=["slot", "write_version"]).to_pylist()
        assert rows == sorted(rows, key=lambda r: (r["slot"], r["write_version"]))


def test_a_plan_too_large_to_broadcast(spark, tmp_path, monkeypatch, request):
    monkeypatch.setattr(cold, "CELL_SLOTS", 1)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    request.addfinalizer(lambda: spark.conf.unset("spark.sql.autoBroadcastJoinThreshold"))
    out = str(tmp_path / "cold")
    cold.export_cold(history(spark), out)
    assert cold.read_cold_table(spark, out, "account_updates").count() == 4300


def test_a_failing_full_export_leaves_the_old_copy(spark, tmp_path):
    out = str(tmp_path / "cold")
    cold.export_cold(history(spark), out)
    bad = history(spark).withColumn("pubkey", F.when(F.col("write_version") == 9, F.lit(b"short")).otherwise(F.col("pubkey")))
    with pytest.raises(Exception, match="pubkey at slot .* is not 32 bytes"):
        cold.export_cold(bad, out, full=True)
    with pytest.raises(Exception, match="write_version is null"):
        cold.export_cold(history(spark).withColumn("write_version", F.expr("nullif(write_version, 9)")), out, full=True)
    assert cold.read_cold_table(spark, out, "account_updates").count() == 4300
    # A full export of less also removes the buckets that are gone.
    cold.export_cold(history(spark).filter("slot < 438000000"), out, full=True)
    assert cold.read_cold_table(spark, out, "account_updates").count() == 4100


def test_tied_copies_leave_one_row(spark, tmp_path):
    source = history(spark)
    tied = source.filter("write_version = 9")  # the same version three times, content differs once
    source = source.unionByName(tied).unionByName(tied.withColumn("lamports", F.lit(6).cast("bigint")))
    source = source.unionByName(source.filter("write_version = 11").withColumn("ingested_at", F.lit(None).cast("timestamp")))
    out = str(tmp_path / "cold")
    cold.export_cold(source, out)
    assert cold.read_cold_table(spark, out, "account_updates").count() == 4300


def test_incremental_export(spark, tmp_path):
    out = str(tmp_path / "cold")
    rows = history(spark, n=3000, start=437_000_000).unionByName(history(spark, n=10, start=438_000_000).withColumn("write_version", F.col("write_version") + 10**6))
    rows = rows.unionByName(history(spark, n=10, start=440_000_000).withColumn("write_version", F.col("write_version") + 2 * 10**6))
    cold.export_cold(rows.filter("slot < 438000005"), out)
    untouched = glob.glob(f"{out}/account_updates/slot_bucket=000437000000/*.parquet")
    result = cold.export_cold(rows, out)
    # The bucket that was still filling is redone, the one before it is not, the empty one does not exist.
    assert (result.skipped, result.buckets) == (("000437000000",), ("000438000000", "000440000000"))
    assert glob.glob(f"{out}/account_updates/slot_bucket=000437000000/*.parquet") == untouched
    assert cold.existing_buckets(spark, f"{out}/account_updates") == {"000437000000", "000438000000", "000440000000"}
    assert cold.read_cold_table(spark, out, "account_updates").count() == 3020
    assert cold.export_cold(rows, out, full=True).skipped == ()
    assert cold.read_cold_table(spark, out, "account_updates").count() == 3020


def test_empty_table_is_skipped(spark, tmp_path):
    result = cold.export_cold(history(spark).limit(0), str(tmp_path))
    assert result.buckets == () and not glob.glob(f"{tmp_path}/account_updates")


def test_a_failed_export_publishes_nothing(spark, tmp_path):
    out = str(tmp_path / "cold")
    bad = history(spark).withColumn("lamports", F.when(F.col("slot") == 437_996_000, F.raise_error(F.lit("broken"))).otherwise(F.col("lamports")))
    with pytest.raises(Exception, match="broken"):
        cold.export_cold(bad, out)
    assert not [p for p in glob.glob(f"{out}/account_updates/slot_bucket=*/*.parquet")]


def test_cold_views(spark, tmp_path):
    out = str(tmp_path / "cold")
    with pytest.raises(FileNotFoundError, match="export_cold"):
        cold.read_cold(spark, out)
    cold.export_cold(history(spark), out)
    tables, notes = cold.read_cold(spark, out)
    assert set(tables) == {"account_updates"} and "obligation_snapshots" in notes[0]
    row = cold.query_cold(spark, out, "select base58(pubkey) as k, pubkey from account_updates limit 1").collect()[0]
    assert row.k == encode_keys(__import__("pandas").Series([bytes(row.pubkey)]))[0]
    with pytest.raises(ValueError, match="cannot plan"):
        cold.query_cold(spark, out, "select nothing from account_updates")


def test_slot_range_prunes_folders_and_row_groups(spark, tmp_path):
    out = str(tmp_path / "cold")
    cold.export_cold(history(spark), out)
    rows = slot_between(cold.read_cold_table(spark, out, "account_updates"), 437_996_000, 437_997_000)
    plan = rows.select("slot", "data_len")._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(slot_bucket" in plan and "slot_bucket#" in plan
    assert "GreaterThanOrEqual(slot,437996000)" in plan and "data:" not in plan.split("ReadSchema")[1]
    assert rows.count() == 1000


def test_late_columns_read_zero(spark, tmp_path):
    old = spark.createDataFrame([(1, 1)], "slot bigint, write_version bigint")
    updates.write_batch(old, str(tmp_path), "obligation_snapshots", "1")
    r = updates.read_table(spark, str(tmp_path), "obligation_snapshots").collect()[0]
    assert r.deposited_value_sf == 0 and r.owner is None


# --- state dumps ------------------------------------------------------------------------------


def key_text(n):
    import pandas as pd

    return encode_keys(pd.Series([n.to_bytes(32, "big")]))[0]


def account(n, kind, extra=b"", **change):
    data = base64.b64encode(bytes.fromhex(tag_hex(kind)) + extra).decode()
    one = {"pubkey": key_text(n), "account": {"owner": key_text(9), "lamports": 5, "data": [data, "base64"]}}
    one.update(change)
    return one


def write_pages(folder, *pages):
    folder.mkdir()
    for i, page in enumerate(pages):
        (folder / f"{i}.json").write_text(json.dumps(page, indent=1))
    return str(folder)


def test_dump_pages(spark, tmp_path):
    bad_data = {"owner": key_text(9), "lamports": 5, "data": ["@@", "base64"]}
    path = write_pages(
        tmp_path / "pages",
        {"context": {"slot": 10}, "value": [account(1, "Obligation"), account(2, "UserMetadata")]},
        {"result": {"context": {"slot": 12}, "value": [account(3, "Reserve"), account(4, "Reserve", pubkey="0OIl"), account(5, "Reserve", account=bad_data)]}},
        {"context": {}, "value": [account(6, "Reserve")]},
    )
    known = state_dump.load_state_dump(spark, path)
    rows = {int.from_bytes(r.pubkey, "big"): r for r in known.rows.collect()}
    assert {k: (r.slot, r.write_version, r.kind) for k, r in rows.items()} == {1: (10, 0, "Obligation"), 3: (12, 0, "Reserve")}
    assert sorted(r.reason for r in known.errors.collect()) == ["data is not base64", "page has no slot", "pubkey is not a base58 key"]
    assert state_dump.load_state_dump(spark, path, "all").rows.count() == 3
    with pytest.raises(ValueError, match="scope"):
        state_dump.load_state_dump(spark, path, "some")


def test_dump_is_stored_and_recorded_last(spark, tmp_path):
    path = write_pages(tmp_path / "pages", {"context": {"slot": 10}, "value": [account(1, "Obligation", b"\x00" * 300), account(2, "Obligation")]}, {"context": {"slot": 8}, "value": [account(3, "Reserve")]})
    root = str(tmp_path / "store")
    run = state_dump.store_state_dump(spark, path, root, S.LAYOUTS).collect()[0]
    assert (run.slot, run.scope, run.accounts, run.rows_written, run.decode_failures) == (10, "known", 3, 3, 2)
    rejected = spark.read.parquet(f"{root}/rejected_snapshots").collect()
    assert sorted((r.kind, r.reason) for r in rejected) == [("Obligation", "short"), ("Reserve", "short")]
    assert updates.read_table(spark, root, "account_updates").count() == 3
    assert updates.read_table(spark, root, "obligation_snapshots").count() == 1
    assert not glob.glob(f"{root}/ingest_checkpoint")


def test_an_empty_dump_is_refused(spark, tmp_path):
    path = write_pages(tmp_path / "pages", {"context": {"slot": 10}, "value": []})
    root = str(tmp_path / "store")
    with pytest.raises(ValueError, match="no accounts"):
        state_dump.store_state_dump(spark, path, root, S.LAYOUTS)
    assert not glob.glob(f"{root}/snapshot_runs")


def test_pages_sum_to_the_whole(spark):
    rows = spark.range(500).select(F.concat(S._zeros(64), S.key32(F.col("id"))).alias("data"), F.col("id").alias("pubkey"))
    pages = state_dump.page_counts(state_dump.by_owner_page(rows, offset=95), offset=95).collect()
    assert len(pages) == 256 and sum(p.accounts for p in pages) == 500


# --- dashboard --------------------------------------------------------------------------------


def test_dashboard_fails_as_a_whole(spark, tmp_path):
    good = lambda: spark.range(2)
    text = dashboard.export_dashboard(spark, {"a": good}, str(tmp_path / "d")).collect()[0].value
    assert json.loads(text)["a"] == [{"id": 0}, {"id": 1}] and "generated_at" in json.loads(text)
    many = dashboard.export_dashboard(spark, {"b": lambda: spark.range(5000)}, str(tmp_path / "m"), as_of="2024-01-31").collect()[0].value
    assert len(json.loads(many)["b"]) == 5000 and json.loads(many)["generated_at"] == "2024-01-31"
    with pytest.raises(ZeroDivisionError):
        dashboard.export_dashboard(spark, {"a": good, "b": lambda: 1 / 0}, str(tmp_path / "e"))
    assert not glob.glob(str(tmp_path / "e"))


def test_rendering_happens_after_the_limit(spark):
    from slotwise.plans.activity import hot_accounts

    hottest = hot_accounts(history(spark))
    plan = hottest._jdf.queryExecution().executedPlan().toString()
    assert plan.index("ArrowEvalPython") < plan.index("TakeOrderedAndProject") and "rangepartitioning" not in plan
    assert all(len(r.pubkey) > 30 for r in hottest.collect())


def test_commands(spark, tmp_path, capsys):
    from slotwise.__main__ import cold_command, main

    out = str(tmp_path / "cold")
    cold.export_cold(history(spark), out)
    assert cold_command(spark, out, "activity").count() == 2
    assert cold_command(spark, out, "gaps").count() == 0
    assert cold_command(spark, out, "hot-accounts").count() == 20
    main(["sql", "select count(*) as n from account_updates", "--dir", out])
    assert "4300" in capsys.readouterr().out
    for bad in ("sql", "nothing"):
        with pytest.raises(ValueError):
            cold_command(spark, out, bad)
