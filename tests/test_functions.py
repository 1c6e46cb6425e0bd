"""Column functions against known cases."""

import hashlib
import random

import pandas as pd
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from slotwise.functions import base58, numbers as N
from slotwise.functions.kinds import classify_kind, tag_hex
from slotwise.functions.layouts import KNOWN_LAYOUTS, Field, Layout, decode, decode_fields, load_layouts
from slotwise.functions.slots import bucket_name, slot_bucket
from slotwise.functions.verdicts import freshness_state, payload_shape, resume_verdict, resume_drift
from slotwise.schemas import MAX_FRACTION, NO_DEBT


def one(df):
    return df.collect()[0]


@pytest.mark.parametrize("kind", ["Obligation", "Reserve", "LendingMarket", "GlobalConfig"])
def test_tags_come_from_the_name(kind):
    assert tag_hex(kind) == hashlib.sha256(f"account:{kind}".encode()).hexdigest()[:16]


def test_classify_is_total(spark):
    known = bytes.fromhex(tag_hex("Reserve"))
    cases = [(known + b"\x00", "Reserve"), (known[:7], "untagged:7b"), (b"", "untagged:0b"), (None, "untagged:0b"),
             (b"\xff" * 8, "unknown:" + "ff" * 8)]
    rows = spark.createDataFrame([(d, k) for d, k in cases], "data binary, want string").select("want", classify_kind().alias("got"))
    assert all(r.want == r.got for r in rows.collect())


def test_slot_buckets(spark):
    cases = {0: "000000000000", 999_999: "000000000000", 1_000_000: "000001000000", 437_313_969: "000437000000"}
    df = spark.createDataFrame([(s,) for s in cases], "slot bigint").select("slot", slot_bucket().alias("b"))
    assert {r.slot: r.b for r in df.collect()} == cases
    assert {s: bucket_name(s) for s in cases} == cases
    assert not df.schema["b"].nullable


def numbers_of(spark, width, values):
    layout = Layout("Reserve", 8 + width).with_fields(Field("x", 8, width))
    rows = [(i, bytes.fromhex(tag_hex("Reserve")) + v.to_bytes(width, "little")) for i, v in enumerate(values)]
    df = decode_fields(spark.createDataFrame(rows, "slot bigint, data binary"), layout)
    return [None if r.x is None else int(r.x) for r in df.orderBy("slot").collect()]


@pytest.mark.parametrize("width", [1, 2, 4, 8])
def test_unsigned_integers_are_exact(spark, width):
    rng = random.Random(width)
    values = [0, 1, 2 ** (8 * width) - 1, 2 ** (8 * width - 1)] + [rng.getrandbits(8 * width) for _ in range(30)]
    assert numbers_of(spark, width, values) == values


def test_wide_integers_reject_what_they_cannot_hold(spark):
    fit, beyond = [0, 2**64, 2**60, 2**64 - 1, MAX_FRACTION], [10**38, 2**127, 2**128 - 1]
    assert numbers_of(spark, 16, fit + beyond) == fit + [None] * len(beyond)


def test_fractions(spark):
    good = [str(2**60), "0", str(MAX_FRACTION)]
    bad = [str(2**127 - 1), str(10**38), str(2**128 - 1), "", "-1", "1.5", None, "abc"]
    df = spark.createDataFrame([(t, 437_394_119) for t in good + bad], "t string, slot bigint")
    rows = df.select("t", N.parse_fraction("t").cast("string").alias("v"), N.fraction_error("t", "deposit").alias("e")).collect()
    for r in rows:
        if r.t in good:
            assert r.v == r.t and r.e is None
        else:
            assert r.v is None and "deposit at slot 437394119" in r.e
    assert "exceeds" in {r.t: r.e for r in rows}[str(10**38)]


def test_health_truncates_and_never_fails(spark):
    cases = [
        (10_000, 5_000, 1, "2000000"),
        (19999999999999, 10_000_000 * 10**6, 1, "1999999"),  # a rounding division would give 2000000
        (5, 0, 1, str(NO_DEBT)),
        (5, 7, 0, str(NO_DEBT)),
        (10**33, 1, 1, None),  # beyond the product's range
        (10**31, 1, 1, None),  # beyond the result's range
    ]
    df = spark.createDataFrame([(str(d), str(b), h, w) for d, b, h, w in cases], "d string, b string, h int, want string")
    df = df.select(F.col("d").cast("decimal(38,0)").alias("d"), F.col("b").cast("decimal(38,0)").alias("b"), "h", "want")
    for r in df.select("want", N.health_factor("d", "b", "h").cast("string").alias("got")).collect():
        assert r.want == r.got


def test_fixed_point_view(spark):
    scale = 2**60
    row = (10_000 * scale, 5_000 * scale, 8_500 * scale)
    df = spark.createDataFrame([tuple(map(str, row))], "d string, b string, a string")
    df = df.select(*[F.col(c).cast("decimal(38,0)").alias(c) for c in "dba"])
    r = one(df.select(N.fraction("d").alias("d"), (N.fraction("a") - N.fraction("b")).alias("headroom"), (N.fraction("b") / N.fraction("d")).alias("ltv")))
    assert (r.d, r.headroom, r.ltv) == (10_000.0, 3_500.0, 0.5)


def test_keys(spark):
    df = spark.createDataFrame([("00" * 32,), ("ab" * 31,), ("zz" * 32,), (None,)], "t string").select(N.key_from_hex("t").alias("k"))
    assert [r.ok for r in df.select(N.valid_key("k").alias("ok")).collect()] == [True, False, False, False]
    bad = spark.createDataFrame([(b"\x00" * 31, 5)], "pubkey binary, slot bigint").select(N.require_key("pubkey"))
    with pytest.raises(Exception, match="pubkey at slot 5 is not 32 bytes"):
        bad.collect()


def _reference_base58(raw: bytes) -> str:
    number, text = int.from_bytes(raw, "big"), ""
    while number:
        number, digit = divmod(number, 58)
        text = base58.ALPHABET[digit] + text
    return "1" * (len(raw) - len(raw.lstrip(b"\x00"))) + text


@settings(max_examples=60, deadline=None)
@given(st.lists(st.binary(min_size=32, max_size=32), min_size=1, max_size=20))
def test_base58_batches(keys):
    keys = keys + [b"\x00" * 32, b"\x00" * 5 + b"\x01" * 22 + b"\x00" * 5, b"\xff" * 32]
    text = base58.encode_keys(pd.Series(keys))
    assert list(text) == [_reference_base58(k) for k in keys]
    assert [bytes(b) for b in base58.decode_keys(text)] == keys


def test_base58_rejects(spark):
    got = base58.decode_keys(pd.Series([None, "", "0OIl", "1", "z" * 44, "1" * 33, "1" * 32]))
    assert [g is None for g in got] == [True] * 6 + [False]
    df = spark.createDataFrame([(b"\x01" * 32,), (b"short",), (None,)], "k binary").select(base58.base58_encode("k").alias("t"))
    assert [r.t for r in df.collect()] == [_reference_base58(b"\x01" * 32), None, None]


def test_resume_verdicts(spark):
    cases = [
        (None, 5, "not_applicable", None), (437313969, 437313969, "clean", 0), (437313969, 437313900, "clean", 0),
        (437903892, 437903948, "clean", 56), (1000, 1600, "clean", 600), (1000, 1601, "gap", 601),
        (437313969, 437387843, "gap", 73874), (0, 10000, "gap", 10000), (1000, 1001, "clean", 1),
    ]
    df = spark.createDataFrame(cases, "a bigint, b bigint, v string, d bigint")
    for r in df.select("v", "d", resume_verdict("a", "b").alias("gv"), resume_drift("a", "b").alias("gd")).collect():
        assert (r.v, r.d) == (r.gv, r.gd)


def test_payload_shapes(spark):
    df = spark.createDataFrame([(6264000, 3344), (0, 0), (6264000, 0), (0, 5)], "lamports bigint, data_len bigint")
    assert [r.s for r in df.select(payload_shape().alias("s")).collect()] == ["ok", "closed", "impossible_empty", "ok"]


def test_freshness_knows_when_it_cannot_tell(spark):
    df = spark.createDataFrame([(0,), (119,), (120,), (899,), (900,), (None,)], "a bigint")
    assert [r.s for r in df.select(freshness_state("a").alias("s")).collect()] == ["fresh", "fresh", "slow", "slow", "stale", "unknown"]


# --- record layouts ---------------------------------------------------------------------------


def record(kind, size, **at):
    data = bytearray(size)
    data[:8] = bytes.fromhex(tag_hex(kind))
    for place, value in at.items():
        start = int(place[1:])
        data[start : start + len(value)] = value
    return bytes(data)


def decoded(spark, payloads, layout):
    rows = [(i, 1, b"\x07" * 32, d) for i, d in enumerate(payloads)]
    return decode(spark.createDataFrame(rows, "slot bigint, write_version bigint, pubkey binary, data binary"), layout).collect()


def test_obligation_too_short_and_zeroed(spark):
    money = [Field(n, 96 + 16 * i, 16) for i, n in enumerate(("deposited_value_sf", "borrow_factor_adjusted_debt_sf"))]
    layout = KNOWN_LAYOUTS["Obligation"].with_fields(*money, Field("has_debt", 128, 1), Field("num_deposits", 136, 40, "entries", count=8), Field("num_borrows", 500, 40, "entries", count=5))
    rows = decoded(spark, [b"\x00" * 7, b"\x00" * 10, record("Obligation", 3343), record("Obligation", 3344)], layout)
    assert len(rows) == 1
    r = rows[0]
    assert (r.slot, r.num_deposits, r.num_borrows, r.flags, int(r.health_factor_bps), r.decode_status) == (3, 0, 0, 0, NO_DEBT, "ok")


def test_market_flags_and_wrong_tag(spark):
    layout = KNOWN_LAYOUTS["LendingMarket"]
    wrong = b"\x00" * 4664
    rows = decoded(spark, [wrong, record("LendingMarket", 4664), record("LendingMarket", 4664, _122=b"\x01", _123=b"\x01")], layout)
    assert [(r.slot, r.flags, r.referral_fee_bps) for r in rows] == [(1, 0, 0), (2, 3, 0)]
    assert rows[0].owner == b"\x00" * 32


def test_reserve_prefix(spark):
    layout = KNOWN_LAYOUTS["Reserve"]
    le = lambda v: v.to_bytes(8, "little")
    full = record("Reserve", 4664, _8=le(42), _16=le(777), _224=le(1_000_000), _272=le(9), _1360=b"\xff" * 8)
    rows = decoded(spark, [record("Reserve", 1359), record("Reserve", 1360), full], layout)
    assert [r.slot for r in rows] == [1, 2]
    assert (int(rows[1].available_amount), rows[1].mint_decimals, int(rows[0].available_amount)) == (1_000_000, 9, 0)


def test_values_that_do_not_fit_are_reported(spark):
    layout = Layout("Reserve", 48).with_fields(Field("borrowed_amount_sf", 32, 16))
    big, fits = (10**38).to_bytes(16, "little"), (10**38 - 1).to_bytes(16, "little")
    rows = decoded(spark, [record("Reserve", 48, _32=big), record("Reserve", 48, _32=fits)], layout)
    assert [r.decode_status for r in rows] == ["overflow", "ok"]
    assert rows[0].borrowed_amount_sf is None and int(rows[1].borrowed_amount_sf) == 10**38 - 1


def test_layout_file(spark):
    text = '{"LendingMarket": {"fields": [{"name": "name", "offset": 200, "width": 32, "kind": "bytes"}]}}'
    layouts = load_layouts(text)
    assert {f.name for f in layouts["LendingMarket"].fields} >= {"name", "owner"}
    with pytest.raises(ValueError, match="beyond"):
        Layout("Reserve", 10).with_fields(Field("x", 8, 8))
