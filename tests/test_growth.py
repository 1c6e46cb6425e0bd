"""What must not grow with the input: the share of one file, of one task, and the passes over payloads."""

import glob

import pytest

from checks import compare, registry
from checks import standins as S
from slotwise.functions.kinds import tag_hex
from slotwise.functions.layouts import CUT, Field, Layout, decode, decode_fields, read_cuts, sound_rows
from slotwise.plans import decoding
from slotwise.sources import updates
from slotwise.streaming import ingest


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_wire_records_are_packed_in_one_pass(spark, sf):
    plan = plan_of(S.build_wire_updates(spark, sf))
    assert "MapInArrow" in plan and "regexp_replace" not in plan


def test_files_of_a_stream_keep_their_size(spark, sf, monkeypatch):
    monkeypatch.setattr(registry, "ROWS_PER_FILE", 300)
    files = glob.glob(f"{registry._wire_files(spark, sf)}/*.parquet")
    rows = [spark.read.parquet(f).count() for f in files]
    assert sum(rows) == 6000 and max(rows) < 900
    assert registry._per_batch(spark, sf, 2) == {"maxFilesPerTrigger": "10"}


@pytest.mark.parametrize("name", ["stream_alarms", "stream_budget", "compacted_bronze"])
def test_batches_of_several_files_give_the_same_result(spark, sf, monkeypatch, name):
    monkeypatch.setattr(registry, "ROWS_PER_FILE", 300)
    assert compare.compare(spark, compare.connect(sf), name, sf) == ""


def test_whole_streams_read_the_stored_records(spark, sf):
    assert registry._wire_files(spark, sf) == registry._wire_files(spark, sf)
    assert "Exchange" not in plan_of(S.wire_updates(spark, sf))


def test_a_batch_of_replays_alone_moves_no_payloads(spark, sf, tmp_path, monkeypatch):
    """The rows of a batch, some of them twice, arrive once more: nothing is written and every figure is kept."""
    rows = S.wire_updates(spark, sf).orderBy("slot", "write_version", "pubkey").limit(300)
    job, calls, write = ingest.Ingest(spark, str(tmp_path), S.LAYOUTS), [], ingest.write_tables
    monkeypatch.setattr(ingest, "write_tables", lambda *a: (calls.append(a), write(*a)))
    for i, batch in enumerate((rows, rows.union(rows.limit(10)))):
        job.on_batch(batch, i)
    assert len(calls) == 1
    assert ingest.read_batches(spark, str(tmp_path), "payload_guard", ingest.GUARD_SCHEMA).count() == 2
    assert updates.read_table(spark, str(tmp_path), "account_updates").count() == 300


def test_rejects_read_the_payloads_once(spark, sf):
    rows = decoding.decode_rejects(S.bronze(spark, sf), S.LAYOUTS)
    assert not [f for f in rows.inputFiles() if "/raw-" in f]  # what is left to read are the stored suspects


def test_only_values_beyond_the_largest_are_suspects_that_stay(spark):
    field = Field("deposited_value_sf", 8, 16)
    layouts = {"Obligation": Layout("Obligation", 24, (field,))}
    values = [0, 10**38 - 1, 10**38, (1 << 128) - 1]
    tag = bytes.fromhex(tag_hex("Obligation"))
    rows = [("Obligation", i, 0, b"\x01" * 32, tag + v.to_bytes(16, "little")) for i, v in enumerate(values)]
    rows += [("Obligation", 9, 0, b"\x01" * 32, tag), ("Obligation", 10, 0, b"\x01" * 32, None)]
    bronze = spark.createDataFrame(rows, "kind string, slot bigint, write_version bigint, pubkey binary, data binary")
    found = decoding.decode_rejects(bronze, layouts).select("slot", "reason", "field").collect()
    assert sorted(map(tuple, found)) == [(2, "overflow", field.name), (3, "overflow", field.name), (9, "short", ""), (10, "short", "")]


def test_the_report_cuts_out_telling_fields_alone(spark, sf):
    whole, telling = S.LAYOUTS["Obligation"], decoding._telling(S.LAYOUTS["Obligation"])
    assert {f.name for f in telling.fields} == {f.name for f in whole.fields if f.width == 16} | {"has_debt"}
    assert len(decoding._telling(S.LAYOUTS["LendingMarket"]).fields) == 1
    report = {r.kind: r for r in decoding.decode_report(S.bronze(spark, sf), S.LAYOUTS).collect()}
    counts = {k: [r.asDict()[c] for c in ("decoded", "overflow")] for k, r in report.items()}
    assert all(decoding.decode(S.bronze(spark, sf), S.LAYOUTS[k]).filter("decode_status <> 'overflow'").count() == n for k, (n, _) in counts.items())


def test_short_records_of_a_batch_are_found_in_one_scan(spark, sf):
    with decoding.decoded_once(S.bronze(spark, sf), S.LAYOUTS) as (_, rejects):
        assert plan_of(rejects.filter("reason = 'short'")).count("FileScan parquet") == 1
        mine = {tuple(r) for r in rejects.select("kind", "slot", "write_version", "reason", "field").collect()}
    theirs = decoding.decode_rejects(S.bronze(spark, sf), S.LAYOUTS)
    assert mine == {tuple(r) for r in theirs.select("kind", "slot", "write_version", "reason", "field").collect()}


def test_sound_rows_derive_health_once(spark, sf):
    layout = S.LAYOUTS["Obligation"]
    rows = sound_rows(decode_fields(S.bronze(spark, sf), layout), layout)
    text = rows._jdf.queryExecution().optimizedPlan().toString()
    assert sum("1000000" in line for line in text.splitlines()) == 1
    stored = decoding.redecode(S.bronze(spark, sf), S.LAYOUTS)["obligation_snapshots"]._jdf.queryExecution().optimizedPlan().toString()
    assert sum("1000000" in line for line in stored.splitlines()) == 1
    marked = decode(S.bronze(spark, sf), layout)
    key = ["slot", "write_version", "flags", "health_factor_bps", "deposited_value_sf"]
    theirs = marked.filter("decode_status <> 'overflow'").select(*key).collect()
    assert sorted(map(str, rows.select(*key).collect())) == sorted(map(str, theirs)) and marked.count() > len(theirs) > 0


def test_touching_fields_are_cut_out_as_one(spark):
    """Fields out of order, side by side, apart and overlapping; entries with gaps between what is looked at."""
    fields = (Field("d", 24, 2), Field("a", 8, 8), Field("b", 16, 1), Field("c", 17, 4, "bytes"), Field("over", 18, 2), Field("e", 30, 6, "entries", count=2, probe=3))
    layout = Layout("Obligation", 42, fields)
    data = bytes(range(1, 43))
    row = spark.createDataFrame([(data,)], "data binary").select(layout.cut().alias(CUT))
    assert layout.cut()._jc.toString().lower().count("substring") == 5
    got = read_cuts(row, layout).first().asDict()
    le = lambda at, n: int.from_bytes(data[at : at + n], "little")
    assert len(row.first()[0]) == layout.cut_size
    assert (int(got["a"]), got["b"], bytes(got["c"]), got["over"], got["d"], got["e"]) == (le(8, 8), data[16], data[17:21], le(18, 2), le(24, 2), 2)
