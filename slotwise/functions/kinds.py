"""Naming a record by the tag in its first bytes."""

from __future__ import annotations

import hashlib

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from slotwise.schemas import DECODED_KINDS, TAG_BYTES, TAGGED_KINDS


def tag_hex(kind: str) -> str:
    return hashlib.sha256(f"account:{kind}".encode()).hexdigest()[: 2 * TAG_BYTES]


def classify_kind(data: str = "data") -> Column:
    """Kind of every payload, known or not. Total: no payload makes it fail or return null."""
    tag = F.lower(F.hex(F.substring(data, 1, TAG_BYTES)))
    names = F.create_map(*[F.lit(x) for kind in TAGGED_KINDS for x in (tag_hex(kind), kind)])
    size = F.coalesce(F.length(data), F.lit(0))
    return F.when(
        size < TAG_BYTES, F.concat(F.lit("untagged:"), size.cast("string"), F.lit("b"))
    ).otherwise(F.coalesce(names[tag], F.concat(F.lit("unknown:"), tag)))


def only_kinds(df: DataFrame, kinds=DECODED_KINDS, data: str = "data") -> DataFrame:
    """Keep records that start with the tag of one of `kinds`."""
    return df.filter(F.lower(F.hex(F.substring(data, 1, TAG_BYTES))).isin([tag_hex(k) for k in kinds]))


def with_derived(df: DataFrame) -> DataFrame:
    """Add the columns that no writer may supply: kind, payload length and arrival time."""
    return df.withColumns(
        {
            "kind": classify_kind("data"),
            "data_len": F.coalesce(F.length("data"), F.lit(0)).cast("bigint"),
            "ingested_at": F.current_timestamp(),
        }
    )
