"""Slots, slot buckets and pruning-friendly range filters."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from slotwise.schemas import (
    BUCKET_COLUMN,
    BUCKET_DIGITS,
    MILLIS_PER_SLOT,
    SLOTS_PER_BUCKET,
    SLOTS_PER_HOT_BUCKET,
)


def slot_of(ts: str) -> Column:
    """Logical clock of a timestamp column, for tables that carry only wall-clock time."""
    return F.expr(f"unix_millis(cast({ts} as timestamp)) div {MILLIS_PER_SLOT}")


def bucket_name(slot: int, width: int = SLOTS_PER_BUCKET) -> str:
    """Partition value that holds `slot`: zero-padded, so that text order is slot order."""
    return f"{slot // width * width:0{BUCKET_DIGITS}d}"


def slot_bucket(slot: str = "slot", width: int = SLOTS_PER_BUCKET) -> Column:
    """`bucket_name` as a column.

    It is declared non-null (through coalesce) because Spark re-sorts the rows of a write whose text
    partition column may be null, which would undo the sort order of the files.
    """
    start = f"{slot} div {width} * {width}"
    return F.coalesce(F.expr(f"lpad(cast({start} as string), {BUCKET_DIGITS}, '0')"), F.lit(""))


def hot_bucket(slot: str = "slot") -> Column:
    return F.expr(f"{slot} div {SLOTS_PER_HOT_BUCKET}")


def slot_between(df: DataFrame, lo: int, hi: int, width: int = SLOTS_PER_BUCKET) -> DataFrame:
    """Rows with lo <= slot < hi of a table filed by buckets of `width` slots.

    A filter on `slot` alone prunes row groups but no folders; the implied bucket range prunes those too.
    """
    rows = df.filter((F.col("slot") >= lo) & (F.col("slot") < hi))
    if BUCKET_COLUMN in df.columns and lo >= 0 and hi > lo:
        rows = rows.filter(F.col(BUCKET_COLUMN).between(bucket_name(lo, width), bucket_name(hi - 1, width)))
    return rows
