"""Tables of the engine's data model, derived from the given test tables.

They plant what the engine must cope with: replayed copies, an outage, destroyed payloads, a kind that
stops, payloads that are cut short, of unknown kind, or hold values that do not fit.
"""

from __future__ import annotations

from functools import reduce

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema

from slotwise.functions.base58 import base58_encode
from slotwise.functions.kinds import tag_hex
from slotwise.functions.layouts import Field, KNOWN_LAYOUTS, Layout
from slotwise.functions.slots import slot_of
from slotwise.session import tidy, work_dir
from slotwise.sources.updates import WIRE_SCHEMA, plain_bytes

AS_OF = "2024-01-31 01:00:00"
FLOW_AS_OF = "2024-01-20 12:00:00"
FLOW_MINUTES = 1440
OUTAGE = (4262500001, 4262573873)
BROKEN_FROM = 4265000000
REPLAY_EVERY = 97  # every 97th version arrives a second time, one hour later


def _table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/{name}.parquet")


def _replayed(df: DataFrame) -> DataFrame:
    """Add the replayed copies. Nothing is left out: the modulo only says which rows arrive twice."""
    again = F.when(F.col("write_version") % REPLAY_EVERY == 0, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))
    copies = df.withColumn("copy", F.explode(again))
    return copies.withColumn("ingested_at", F.expr("ingested_at + make_interval(0, 0, 0, 0, copy, 0, 0)")).drop("copy")


def account_updates(spark: SparkSession, sf: str, replays: bool = True) -> DataFrame:
    e = _table(spark, sf, "events").select(
        slot_of("ts").alias("slot"),
        F.col("event_id").alias("write_version"),
        F.col("user_id").alias("pubkey"),
        "event_type",
        F.floor(F.col("value") * 100).alias("lamports"),
        "props",
        F.col("ts").cast("timestamp").alias("ingested_at"),
    )
    # The outage: every later slot is moved by its length, so no row is lost.
    start, end = OUTAGE
    e = e.withColumn("slot", F.when(F.col("slot") >= start, F.col("slot") + (end - start + 1)).otherwise(F.col("slot")))
    broken = (F.col("event_type") == "signup") & (F.col("slot") >= BROKEN_FROM)
    data = F.when(broken, F.lit("")).otherwise(F.col("props"))
    rows = e.select(
        "slot",
        "write_version",
        "pubkey",
        F.when(broken, F.lit("untagged:0b")).otherwise(F.col("event_type")).alias("kind"),
        "lamports",
        data.alias("data"),
        F.length(data).cast("bigint").alias("data_len"),
        "ingested_at",
    )
    return _replayed(rows) if replays else rows


def obligation_snapshots(spark: SparkSession, sf: str, replays: bool = True) -> DataFrame:
    li = _table(spark, sf, "lineitem")
    rows = li.select(
        slot_of("l_shipdate").alias("slot"),
        (F.col("l_orderkey") * 10 + F.col("l_linenumber")).alias("write_version"),
        F.col("l_partkey").alias("pubkey"),
        F.col("l_suppkey").alias("owner"),
        F.col("l_returnflag").alias("lending_market"),
        F.col("l_linenumber").cast("bigint").alias("num_deposits"),
        F.floor(F.col("l_extendedprice") * 100).alias("deposited_value"),
        F.floor(F.col("l_extendedprice") * F.col("l_discount") * 1000 * (1 + F.col("l_tax"))).alias("adjusted_debt"),
        F.col("l_shipdate").cast("timestamp").alias("ingested_at"),
    )
    rows = rows.withColumns(
        {
            "borrowed_value": F.col("adjusted_debt"),
            "allowed_borrow_value": F.expr("deposited_value * 8 div 10"),
            "unhealthy_borrow_value": F.expr("deposited_value * 9 div 10"),
            "num_borrows": F.when(F.col("adjusted_debt") != 0, 1).otherwise(0).cast("bigint"),
            "flags": F.when(F.col("adjusted_debt") != 0, 1).otherwise(0).cast("bigint"),
            "health_factor_bps": F.expr(
                "case when adjusted_debt = 0 then 18446744073709551615BD "
                "else cast(deposited_value * 1000000 div adjusted_debt as decimal(20,0)) end"
            ),
        }
    )
    return _replayed(rows) if replays else rows


def reserve_snapshots(spark: SparkSession, sf: str) -> DataFrame:
    li = _table(spark, sf, "lineitem")
    return _replayed(
        li.select(
            slot_of("l_shipdate").alias("slot"),
            (F.col("l_orderkey") * 10 + F.col("l_linenumber")).alias("write_version"),
            F.col("l_suppkey").alias("pubkey"),
            F.col("l_returnflag").alias("lending_market"),
            F.col("l_linestatus").alias("liquidity_mint"),
            F.floor(F.col("l_extendedprice") * 100).alias("available_amount"),
            F.floor(F.col("l_quantity") * 1000).alias("borrowed_amount_sf"),
            (F.col("l_suppkey") % 10).alias("mint_decimals"),
            F.col("l_shipdate").cast("timestamp").alias("ingested_at"),
        )
    )


DAY_SLOTS = 216_000


def ingest_checkpoint(spark: SparkSession, sf: str) -> DataFrame:
    """One position per day of updates and stream; the newest one of each stream counts."""
    u = account_updates(spark, sf, replays=False).withColumn("day", F.expr(f"slot div {DAY_SLOTS}"))
    days = u.groupBy("day").agg(
        F.max("slot").alias("last_slot"), F.max("write_version").alias("last_write_version"), F.max("ingested_at").alias("updated_at")
    )
    streams = days.withColumn("stream", F.explode(F.array(F.lit("main"), F.lit("staging"))))
    return streams.select(
        "stream",
        F.when(F.col("stream") == "main", F.col("last_slot")).otherwise(F.col("last_slot") - 5).alias("last_slot"),
        "last_write_version",
        "updated_at",
    )


def sessions(spark: SparkSession, sf: str) -> DataFrame:
    """One session per day: resumes at the last slot of the day before, starts at the first of its own."""
    u = account_updates(spark, sf, replays=False).withColumn("day", F.expr(f"slot div {DAY_SLOTS}"))
    days = u.groupBy("day").agg(
        F.min("slot").alias("first_account_slot"), F.max("slot").alias("last_slot"), F.min("ingested_at").alias("detected_at")
    )
    before = days.select((F.col("day") + 1).alias("day"), F.col("last_slot").alias("resume_from"))
    return days.join(before, "day", "left").select(
        F.col("day").alias("session_id"), "resume_from", "first_account_slot", "detected_at"
    )


def slot_gaps(spark: SparkSession, sf: str) -> DataFrame:
    """Recorded gaps: the seams of `sessions`, each twice with the newer row filled when it is short, one
    gap per day that the data does not show, and one degenerate row per day."""
    s = sessions(spark, sf).filter(F.col("resume_from").isNotNull())
    hour = F.expr("detected_at + interval 1 hour")

    def rows(where, start, end, filled, at, reason):
        return s.filter(where).select(
            F.lit("main").alias("stream"),
            start.alias("start_slot"),
            end.alias("end_slot"),
            at.alias("detected_at"),
            filled.cast("smallint").alias("filled"),
            F.lit(reason).alias("reason"),
            at.alias("ingested_at"),
        )

    start, end = F.col("resume_from"), F.col("first_account_slot")
    is_gap = (end - start) > 600
    seams = rows(is_gap, start, end, F.lit(0), F.col("detected_at"), "seam")
    newer = rows(is_gap, start, end, F.when(end - start < 2000, 1).otherwise(0), hour, "seam, checked")
    unseen = rows(F.lit(True), end + 1, end + 1001, F.lit(0), F.col("detected_at"), "noticed only")
    degenerate = rows(F.lit(True), end + 7, F.lit(0).cast("bigint"), F.lit(0), F.col("detected_at"), "no end")
    return seams.unionByName(newer).unionByName(unseen).unionByName(degenerate)


DUMP_BASES = (4261000000, 4264000000)
ACCOUNTS_PER_PAGE = 50


def dump_accounts(spark: SparkSession, sf: str) -> DataFrame:
    """Accounts of two full-state dumps: every customer is in the one its nation belongs to."""
    c = _table(spark, sf, "customer")
    base = F.when(F.col("c_nationkey") < 13, F.lit(DUMP_BASES[0])).otherwise(F.lit(DUMP_BASES[1])).cast("bigint")
    return c.select(
        F.expr(f"c_custkey div {ACCOUNTS_PER_PAGE}").alias("page"),
        (base + F.expr(f"c_custkey div {ACCOUNTS_PER_PAGE}") * 3).alias("slot"),
        F.lit(0).cast("bigint").alias("write_version"),
        F.col("c_custkey").alias("pubkey"),
        F.col("c_nationkey").cast("bigint").alias("owner"),
        F.floor(F.col("c_acctbal") * 100 + 100000).alias("lamports"),
        F.col("c_mktsegment").alias("segment"),
    )


def snapshot_runs(spark: SparkSession, sf: str) -> DataFrame:
    a = dump_accounts(spark, sf)
    return a.groupBy((F.col("slot") >= DUMP_BASES[1]).alias("second")).agg(
        F.max("slot").alias("slot"),
        F.lit("known").alias("scope"),
        F.count(F.lit(1)).alias("accounts"),
        F.count(F.lit(1)).alias("rows_written"),
        F.lit(0).cast("bigint").alias("decode_failures"),
        F.lit(0).cast("bigint").alias("duration_ms"),
        F.lit(AS_OF).cast("timestamp").alias("ingested_at"),
    ).drop("second")


# --- binary records ---------------------------------------------------------------------------

# A layout of our own for the fields whose place is not public; short, so that fixtures stay small.
LAYOUTS = {
    "Obligation": Layout("Obligation", 256, KNOWN_LAYOUTS["Obligation"].fields).with_fields(
        Field("deposited_value_sf", 96, 16),
        Field("borrow_factor_adjusted_debt_sf", 112, 16),
        Field("borrowed_value_sf", 128, 16),
        Field("allowed_borrow_value_sf", 144, 16),
        Field("unhealthy_borrow_value_sf", 160, 16),
        Field("has_debt", 176, 1),
        Field("elevation_group", 177, 1),
        Field("margin_call_started", 184, 8),
        Field("lowest_deposit_liquidation_ltv", 192, 8),
        Field("referrer", 200, 32, "bytes"),
        Field("num_deposits", 232, 8, "entries", count=2, probe=8),
        Field("num_borrows", 248, 8, "entries", count=1, probe=8),
    ),
    "Reserve": Layout("Reserve", 312, KNOWN_LAYOUTS["Reserve"].fields).with_fields(
        Field("acc_protocol_fees_sf", 280, 16),
        Field("acc_referrer_fees_sf", 296, 16),
    ),
    "LendingMarket": Layout("LendingMarket", 160, KNOWN_LAYOUTS["LendingMarket"].fields).with_fields(
        Field("name", 124, 32, "bytes"),
        Field("borrow_disabled", 156, 1),
        Field("immutable", 157, 1),
        Field("liquidation_max_debt_close_factor_pct", 158, 1),
    ),
}


def key32(column):
    """A number as a 32-byte key."""
    return F.unhex(F.lpad(F.hex(column), 64, "0"))


def to_le(value, width: int):
    """`width` little-endian bytes of a non-negative bigint."""
    turned = "".join(f"${i}" for i in range(width, 0, -1))
    return F.unhex(F.regexp_replace(F.lpad(F.hex(value), 2 * width, "0"), "(..)" * width, turned))


def _zeros(n: int):
    return F.lit(b"\x00" * n)


_STORED: dict[tuple[str, str, int], str] = {}
ROWS_PER_FILE = 500_000  # a quarter of an input may not become one file, nor a batch too few rows for its jobs


def wire_spread(spark: SparkSession, sf: str, rows_per_file: int = ROWS_PER_FILE) -> int:
    """How many files each of the four files of the smallest input becomes: files keep their size."""
    rows = _table(spark, sf, "lineitem").count()  # a wire record for each; read from the footers
    return max(1, -(-rows // (4 * rows_per_file)))


def wire_folder(spark: SparkSession, sf: str, files: int) -> str:
    """`build_wire_updates` in order of slots, stored once per session and number of files, as raw history would be."""
    key = (spark.sparkContext.applicationId, sf, files)
    if key not in _STORED:
        path = work_dir(spark, "raw")
        with tidy(spark):
            plain_bytes(build_wire_updates(spark, sf, files)).parquet(path)
        _STORED[key] = path
    return _STORED[key]


def wire_updates(spark: SparkSession, sf: str) -> DataFrame:
    return spark.read.schema(WIRE_SCHEMA).parquet(wire_folder(spark, sf, 4 * wire_spread(spark, sf)))


def build_wire_updates(spark: SparkSession, sf: str, files: int | None = None) -> DataFrame:
    """Binary records from lineitem: three decodable kinds, an unnamed one, empty, cut and overflowing ones.

    With `files`, in so many ranges of slots: nine numbers a record are moved there, before all else is computed.
    """
    li = _table(spark, sf, "lineitem")
    q, line, dep, debt = F.col("q"), F.col("line"), F.col("dep"), F.col("debt")
    base = li.select(
        slot_of("l_shipdate").alias("slot"),
        (F.col("l_orderkey") * 10 + F.col("l_linenumber")).alias("write_version"),
        F.col("l_partkey").cast("bigint").alias("part"),
        F.col("l_suppkey").cast("bigint").alias("supp"),
        F.col("l_returnflag").alias("flag"),
        F.col("l_linenumber").cast("bigint").alias("line"),
        F.col("l_quantity").cast("bigint").alias("q"),
        F.floor(F.col("l_extendedprice") * 100).alias("dep"),
        F.floor(F.col("l_extendedprice") * F.col("l_discount") * 1000 * (1 + F.col("l_tax"))).alias("debt"),
    )
    if files is not None:
        base = base.repartitionByRange(files, "slot", "write_version")
    kind = F.when(line == 7, 3).when(F.col("flag") == "N", 0).when(F.col("flag") == "A", 1).otherwise(2)
    # 2^63 - 1 as the upper half lies beyond decimal(38,0).
    high = F.when((line == 6) & (q == 50), F.lit((1 << 63) - 1)).otherwise(q)
    known = {0: ("part", "supp", "line", "q", "dep", "debt"), 1: ("slot", "part", "supp", "line", "q", "dep", "debt"), 2: ("part", "supp", "line", "q"), 3: ("dep",)}
    whole = F.coalesce(*[F.when(F.col("form") == k, reduce(Column.__and__, [F.col(c).isNotNull() for c in of])) for k, of in known.items()])
    size = F.when(q == 1, 0).when(q == 49, 5).when(q == 2, 40).otherwise(312)
    numbers = {"high": high, "tenth": F.expr("q div 10"), "allowed": F.expr("dep * 8 div 10"), "unhealthy": F.expr("dep * 9 div 10")}
    name = F.when(F.col("form") == 2, F.rpad(F.concat(F.lit("market-"), F.col("supp").cast("string")), 32, "\x00").cast("binary"))
    rows = base.withColumn("form", kind).withColumns({**numbers, "size": F.when(whole | (q == 1), size), "name": name})
    lamports = F.when(line == 3, F.lit(0).cast("bigint")).otherwise(dep).alias("lamports")
    columns = ("slot", "write_version", "part", "supp", lamports, "form", "size", "name", "line", "q", "dep", "debt", *numbers)
    return rows.select(*columns).mapInArrow(_records(), WIRE_SCHEMA)


def _records():
    """Packs the numbers of `build_wire_updates` into payloads, a batch at a time. All it needs is inside: tasks do not import `checks`."""
    tags = [np.frombuffer(bytes.fromhex(tag_hex(k)), np.uint8) for k in ("Obligation", "Reserve", "LendingMarket")]
    tags.append(np.arange(1, 9, dtype=np.uint8))
    lengths = np.array([256, 312, 160, 16])
    schema = to_arrow_schema(WIRE_SCHEMA)

    def read(batches):
        def le(values, width=8):
            return np.ascontiguousarray(values, "<i8").view(np.uint8).reshape(-1, 8)[:, :width]

        def key(values):
            out = np.zeros((len(values), 32), np.uint8)
            out[:, 24:] = np.ascontiguousarray(values, ">i8").view(np.uint8).reshape(-1, 8)
            return out

        def binary(matrix, sizes, valid):
            ends = np.zeros(len(matrix) + 1, np.int32)
            np.cumsum(sizes, out=ends[1:])
            held = np.ascontiguousarray(matrix[np.arange(matrix.shape[1]) < sizes[:, None]])
            bits = np.packbits(valid, bitorder="little")
            return pa.Array.from_buffers(pa.binary(), len(matrix), [pa.py_buffer(bits), pa.py_buffer(ends), pa.py_buffer(held)])

        for batch in batches:
            number = {n: pc.fill_null(batch[n], 0).to_numpy() for n in batch.schema.names if n != "name"}
            there = {n: pc.is_valid(batch[n]).to_numpy(zero_copy_only=False) for n in ("part", "supp", "size")}
            form, data = number["form"], np.zeros((batch.num_rows, 312), np.uint8)
            for k, tag in enumerate(tags):
                at = np.flatnonzero(form == k)
                slot, part, supp, line, q, dep, debt, high = (number[n][at] for n in ("slot", "part", "supp", "line", "q", "dep", "debt", "high"))
                some = (debt != 0).astype(np.int64)
                pieces = [(0, np.broadcast_to(tag, (len(at), 8)))]
                if k == 0:
                    pieces += [(32, key(supp)), (64, key(part)), (96, le(dep)), (104, le(high)), (112, le(debt)), (120, le(number["tenth"][at])), (128, le(debt))]
                    pieces += [(144, le(number["allowed"][at])), (152, le(q)), (160, le(number["unhealthy"][at])), (168, le(q)), (176, le(some, 1)), (177, le(line % 3, 1))]
                    pieces += [(184, le(np.where(line == 5, dep, 0))), (192, le(8500 + line)), (200, key(q)), (232, le(line)), (240, le(np.where(line > 3, line, 0))), (248, le(some))]
                elif k == 1:
                    pieces += [(8, le(np.ones(len(at)))), (16, le(slot)), (32, key(part)), (128, key(supp)), (160, key(line)), (192, key(q)), (224, le(dep))]
                    pieces += [(232, le(debt)), (240, le(q)), (248, le(dep)), (272, le(supp % 10)), (280, le(line)), (296, le(q))]
                elif k == 2:
                    names = batch["name"].take(pa.array(at)).fill_null(bytes(32)).cast(pa.binary(32))
                    text = np.frombuffer(names.buffers()[1], np.uint8, 32 * len(at), 32 * names.offset).reshape(-1, 32)
                    pieces += [(24, key(supp)), (88, key(part)), (120, le(q * 10, 2)), (122, le(line % 2, 1)), (123, le(line // 2 % 2, 1)), (124, text)]
                    pieces += [(156, le(q % 2, 1)), (157, le(q // 2 % 2, 1)), (158, le(q, 1))]
                else:
                    pieces.append((8, le(dep)))
                mine = np.zeros((len(at), lengths[k]), np.uint8)
                for offset, piece in pieces:
                    mine[:, offset : offset + piece.shape[1]] = piece
                data[at, : lengths[k]] = mine
            size = np.where(there["size"], np.minimum(number["size"], lengths[form]), 0)
            keys = [binary(key(number[n]), np.where(there[n], 32, 0), there[n]) for n in ("part", "supp")]
            columns = [batch["slot"], batch["write_version"], *keys, batch["lamports"], binary(data, size, there["size"])]
            yield pa.RecordBatch.from_arrays(columns, schema=schema)

    return read


def bronze(spark: SparkSession, sf: str) -> DataFrame:
    from slotwise.functions.kinds import with_derived

    return with_derived(wire_updates(spark, sf))


def write_dump(spark: SparkSession, sf: str) -> str:
    """Write both dumps as JSON pages of at most 50 accounts, one page per line; returns the folder."""
    a = dump_accounts(spark, sf)
    kind = (
        F.when(F.col("segment") == "BUILDING", F.lit(tag_hex("Obligation")))
        .when(F.col("segment") == "MACHINERY", F.lit(tag_hex("Reserve")))
        .when(F.col("segment") == "AUTOMOBILE", F.lit(tag_hex("LendingMarket")))
        .otherwise(F.lit(tag_hex("UserMetadata")))
    )
    # Every other record is long enough to decode.
    data = F.concat(F.unhex(kind), to_le(F.col("lamports"), 8), F.when(F.col("pubkey") % 2 == 0, _zeros(304)).otherwise(_zeros(0)))
    # A key that is no key, and a payload that is no base64, in every page that has such an account.
    text = F.when(F.col("pubkey") % ACCOUNTS_PER_PAGE == 7, F.lit("not-a-key-0OIl")).otherwise(base58_encode(key32(F.col("pubkey"))))
    encoded = F.when(F.col("pubkey") % ACCOUNTS_PER_PAGE == 9, F.lit("@@@")).otherwise(F.base64(data))
    account = F.struct(
        text.alias("pubkey"),
        F.struct(
            base58_encode(key32(F.col("owner"))).alias("owner"), F.col("lamports"), F.array(encoded, F.lit("base64")).alias("data")
        ).alias("account"),
    )
    pages = a.groupBy("page", "slot").agg(F.collect_list(account).alias("value"))
    body = F.to_json(F.struct(F.struct("slot").alias("context"), "value"))
    path = work_dir(spark, "dump")
    pages.select(body.alias("value")).write.text(path)
    return path
