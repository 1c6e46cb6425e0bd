"""Collapsing replayed copies and reading the latest state."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from slotwise.schemas import TABLE_KEYS, VERSION_KEY

_RANK, _ARRIVED = "__copy", "__arrived"


def collapse(
    df: DataFrame,
    keys: Sequence[str] = VERSION_KEY,
    version: str = "ingested_at",
    columns: Sequence[str] | None = None,
) -> DataFrame:
    """One row per full key: the copy with the newest version.

    `columns` names what the caller needs, so that wide columns never enter the shuffle. Exact ties are
    settled on the content, which makes the result independent of the input order. Because only rank 1
    is kept, Spark prunes each map task to one row per key before the shuffle (WindowGroupLimit), so a
    key with very many copies does not gather in one task.
    """
    if columns is not None:
        wanted = dict.fromkeys([*keys, version, *columns])
        df = df.select(*wanted)
    rest = [c for c in df.columns if c not in keys and c != version]
    order = [F.col(version).desc()]
    if rest:
        order.append(F.xxhash64(*rest))
    window = Window.partitionBy(*keys).orderBy(*order)
    rows = df.withColumn(_RANK, F.row_number().over(window)).filter(F.col(_RANK) == 1).drop(_RANK)
    return rows.select(*columns) if columns is not None else rows


def collapse_table(df: DataFrame, table: str, columns: Sequence[str] | None = None) -> DataFrame:
    """`collapse` with the key and version of one of the known tables."""
    keys, version = TABLE_KEYS[table]
    return collapse(df, keys, version, columns)


def collapsed_count(df: DataFrame, keys: Sequence[str] = VERSION_KEY, alias: str = "rows") -> DataFrame:
    """Number of distinct full keys, which is the row count after `collapse`, without ranking copies."""
    return df.select(*keys).distinct().agg(F.count(F.lit(1)).alias(alias))


def latest(
    df: DataFrame,
    columns: Sequence[str],
    key: str | Sequence[str] = "pubkey",
    order: Sequence[str] = ("slot", "write_version"),
) -> DataFrame:
    """Newest values of several columns per key, all from one and the same row.

    One aggregate over a struct combines on the map side, so a hot key costs one row per map task.
    """
    keys = [key] if isinstance(key, str) else list(key)
    state = F.max_by(F.struct(*columns), F.struct(*order)).alias("__state")
    return df.groupBy(*keys).agg(state).select(*keys, "__state.*")


def drop_replays(stream: DataFrame, keys: Sequence[str] = VERSION_KEY, delay: str = "30 minutes") -> DataFrame:
    """Streaming form: drops copies that arrive within `delay` of the first one, which is kept.

    The watermark runs on the time of arrival, not on a time in the data: no row is ever late, so only
    copies are dropped, however old a row is. State is bounded by `delay`. Copies that arrive after that
    reach the table, where `collapse` removes them on read.
    """
    arrived = stream.withColumn(_ARRIVED, F.current_timestamp()).withWatermark(_ARRIVED, delay)
    return arrived.dropDuplicatesWithinWatermark(list(keys)).drop(_ARRIVED)
