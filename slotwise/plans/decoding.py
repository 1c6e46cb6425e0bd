"""Rebuilding the silver tables from raw history."""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import ExitStack, contextmanager
from dataclasses import replace
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from slotwise.functions.layouts import decode  # noqa: F401 (callers find it here as well)
from slotwise.functions.layouts import CARRIED, CUT, Layout, decode_fields, long_enough, overflow_field, read_cuts, silver_rows, sound_rows
from slotwise.functions.slots import slot_bucket
from slotwise.operators.rows import side_by_side
from slotwise.schemas import BUCKET_COLUMN, MAX_FRACTION, SILVER_TABLE
from slotwise.session import stored, work_dir
from slotwise.sources.updates import held, plain_bytes, read_filed, write_batch

REBUILT = "rebuilt"


def redecode(bronze: DataFrame, layouts: dict[str, Layout]) -> dict[str, DataFrame]:
    """Silver tables by name, computed from stored payloads. Values that do not fit are never wrapped: `decode_rejects` has them."""
    tables = {}
    for kind, layout in layouts.items():
        if kind in SILVER_TABLE:
            tables[SILVER_TABLE[kind]] = sound_rows(decode_fields(bronze, layout), layout)
    return tables


def _may_overflow(layout: Layout) -> Column:
    """False only for payloads all of whose values can be held: the highest byte of a field tells most of them apart."""
    top = F.lit(bytes([MAX_FRACTION >> 120]))
    wide = [F.substring("data", f.end, 1) >= top for f in layout.fields if f.kind == "uint" and f.width == 16]
    return reduce(Column.__or__, wide, F.lit(False))


def decode_rejects(bronze: DataFrame, layouts: dict[str, Layout]) -> DataFrame:
    """Records of a decoded kind that give no silver row: kind, version key, reason and the first field at fault.

    Reasons are `short` and `overflow`. Nothing that was received leaves the tables without a row here.

    One scan of the payloads stores what is short or may overflow; only the latter is decoded.
    """
    layouts = {kind: layout for kind, layout in layouts.items() if kind in SILVER_TABLE}
    reason = F.lit(None).cast("string")
    for kind, layout in layouts.items():
        whole = F.coalesce(F.col("data_len") >= layout.size if "data_len" in bronze.columns else long_enough(layout), F.lit(False))
        reason = F.when(F.col("kind") == kind, F.when(~whole, "short").when(_may_overflow(layout), "overflow")).otherwise(reason)
    told = bronze.select("kind", "slot", "write_version", "pubkey", "data", reason.alias("reason")).filter("reason is not null")
    told = stored(told.withColumn("data", F.expr("if(reason = 'short', null, data)")), "rejects")
    parts = [told.filter("reason = 'short'").select("kind", "slot", "write_version", "pubkey", "reason", F.lit("").alias("field"))]
    for kind, layout in layouts.items():
        fields = decode_fields(told.filter((F.col("kind") == kind) & (F.col("reason") == "overflow")), layout)
        over = fields.withColumn("field", overflow_field(layout)).filter("field is not null")
        parts.append(over.select(F.lit(kind).alias("kind"), "slot", "write_version", "pubkey", F.lit("overflow").alias("reason"), "field"))
    return reduce(DataFrame.unionByName, parts)


@contextmanager
def decoded_once(rows: DataFrame, layouts: dict[str, Layout]) -> Iterator[tuple[dict[str, DataFrame], DataFrame]]:
    """What `redecode` and `decode_rejects` give, from one decoding of each kind, whose rows are held meanwhile.

    `rows` have `kind` and `data_len`. What is held lies in files, not in the executors.
    """
    tables, parts = {}, []
    short = F.lit(False)
    key = ["slot", "write_version", "pubkey"]
    with ExitStack() as files:
        for kind, layout in layouts.items():
            if kind not in SILVER_TABLE:
                continue
            mine = rows.filter(F.col("kind") == kind)
            done = files.enter_context(held(silver_rows(decode_fields(mine, layout), layout, overflow_field(layout).alias("field")), "decoded"))
            tables[SILVER_TABLE[kind]] = done.filter(F.col("decode_status") != "overflow").drop("decode_status", "field")
            short = short | ((F.col("kind") == kind) & F.coalesce(F.col("data_len") < layout.size, F.lit(True)))
            parts.append(done.filter(F.col("decode_status") == "overflow").select(F.lit(kind).alias("kind"), *key, F.lit("overflow").alias("reason"), "field"))
        parts.append(rows.filter(short).select("kind", *key, F.lit("short").alias("reason"), F.lit("").alias("field")))
        yield tables, reduce(DataFrame.unionByName, parts)


def _cuts(bronze: DataFrame, layouts: dict[str, Layout]) -> DataFrame:
    """The bytes that decoding needs of every record of the given kinds, null for a short one; stored by kind.

    One scan of the payloads serves all kinds.
    """
    cut = F.lit(None).cast("binary")
    for kind, layout in layouts.items():
        cut = F.when((F.col("kind") == kind) & long_enough(layout), layout.cut()).otherwise(cut)
    carried = [c for c in CARRIED if c in bronze.columns]
    wanted = bronze.filter(F.col("kind").isin(list(layouts))).select(*carried, cut.alias(CUT), "kind")
    path = work_dir(bronze.sparkSession, "cuts")
    plain_bytes(wanted).partitionBy("kind").parquet(path)
    return bronze.sparkSession.read.schema(wanted.schema).parquet(path)


def store_redecoded(bronze: DataFrame, layouts: dict[str, Layout], root: str) -> DataFrame:
    """Rebuild the silver tables below `root` with a single scan of the payloads; returns the counts.

    The rows form a batch of their own, which replaces that of an earlier rebuild; batches of a live stream stay,
    and rows that both hold collapse on read.

    The scan keeps only the bytes that decoding needs, filed by kind, and each table is decoded from
    its own file set. `redecode` alone would read all payloads once per kind. `bronze` has a `kind` column.
    """
    spark = bronze.sparkSession
    layouts = {kind: layout for kind, layout in layouts.items() if kind in SILVER_TABLE}
    cuts = _cuts(bronze, layouts)

    reports = []
    for kind, layout in layouts.items():
        mine = cuts.filter(F.col("kind") == kind)
        rows = sound_rows(read_cuts(mine.filter(F.col(CUT).isNotNull()), layout), layout)
        write_batch(rows, root, SILVER_TABLE[kind], REBUILT)
        stored = read_filed(spark, root, SILVER_TABLE[kind]).filter(F.col("batch_id") == REBUILT)
        short = mine.filter(F.col(CUT).isNull()).agg(F.count(F.lit(1)).alias("short"))
        whole = mine.agg(F.count(F.lit(1)).alias("records"))
        done = stored.agg(F.count(F.lit(1)).alias("decoded"))
        reports.append(side_by_side(whole, done, short).select(F.lit(kind).alias("kind"), "records", "decoded", "short"))
    counts = reduce(DataFrame.unionByName, reports)
    return counts.withColumn("overflow", F.col("records") - F.col("decoded") - F.col("short"))


# Fields that the outcome of a record depends on, besides those of 16 bytes, the only ones that can hold too much.
_HEALTH_FIELDS = ("deposited_value_sf", "borrow_factor_adjusted_debt_sf", "has_debt")


def _telling(layout: Layout) -> Layout:
    """The layout with the fields alone that tell the outcome of a record; one field at least, as a cut cannot be empty."""
    fields = tuple(f for f in layout.fields if f.kind == "uint" and (f.width == 16 or f.name in _HEALTH_FIELDS))
    return replace(layout, fields=fields or tuple(sorted(layout.fields, key=lambda f: f.size)[:1]))


def decode_report(bronze: DataFrame, layouts: dict[str, Layout], by_bucket: bool = False) -> DataFrame:
    """Records per kind (and slot bucket) by outcome: decoded, too short, overflow; and the decoded share.

    `health_overflow` records count as decoded. Only the fields that tell the outcome are cut out and decoded.
    """
    keys = ["kind", BUCKET_COLUMN] if by_bucket else ["kind"]
    layouts = {kind: _telling(layout) for kind, layout in layouts.items() if kind in SILVER_TABLE}
    cuts = _cuts(bronze, layouts)
    parts = [cuts.filter(F.col(CUT).isNull()).select("slot", "kind", F.lit("short").alias("outcome"))]
    for kind, layout in layouts.items():
        mine = cuts.filter((F.col("kind") == kind) & F.col(CUT).isNotNull())
        done = silver_rows(read_cuts(mine, layout), layout)
        parts.append(done.select("slot", F.lit(kind).alias("kind"), F.col("decode_status").alias("outcome")))
    rows = reduce(DataFrame.unionByName, parts)
    if by_bucket:
        rows = rows.withColumn(BUCKET_COLUMN, slot_bucket())
    counts = rows.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("records"),
        F.count_if(F.col("outcome").isin("ok", "health_overflow")).alias("decoded"),
        F.count_if(F.col("outcome") == "short").alias("short"),
        F.count_if(F.col("outcome") == "overflow").alias("overflow"),
        F.count_if(F.col("outcome") == "health_overflow").alias("health_overflow"),
    )
    return counts.withColumn("decoded_share", F.round(F.col("decoded") / F.col("records"), 4))
