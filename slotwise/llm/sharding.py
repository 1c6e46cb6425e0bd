"""Sharding (op 9): histogram sort into shards of near equal bytes.

Every row has a 64-bit key: high bits from a hash of its text, low bits from a hash of the whole row. Equal texts are
therefore neighbours, and a group of copies larger than a shard can still be cut between its rows. Splitters are found
by probing: each round counts, over all partitions, the exact bytes and rows below candidate keys and narrows the
bracket of each wanted boundary, until it is within the tolerance. A boundary between two texts is preferred; a group
is cut only where leaving it whole would put a boundary off by more than `group_share` of a shard (or one row of the group).
Rows then move once. Slots are numbered in parts of a shard, which are stretches of its keys and whose row counts are
known beforehand, so neither a hot group nor a whole shard is numbered in one task, and a shard is sorted by key at any size.

Defined results: a null text counts as empty; rows without an id are placed like others; fully equal rows are
interchangeable, and a row repeated very often is cut between its copies like any other group; extra columns are dropped; an empty table gives no rows.
"""

from __future__ import annotations

from bisect import bisect_left
from collections.abc import Iterator
from itertools import accumulate

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from slotwise.llm.common import documents, prepare, repeated_rows, row_hash, with_copies
from slotwise.session import stored

ROW_BYTES = 16  # fixed value: what a row costs beside its text
TEXT_BITS = 24  # low bits of the key that tell rows of one text apart
PROBES, MOST_PROBES = 255, 1 << 16  # keys probed in a round: for a boundary, and for all of them
COARSE = 64  # parts of a shard that are found by probing; each of them is divided further by key
LEAST, MOST = -(2**63), 2**63


def row_bytes():
    return F.octet_length(F.coalesce("text", F.lit(""))).cast("long") + ROW_BYTES


def text_key():
    """The bits of the key that equal texts share."""
    return F.xxhash64(F.coalesce("text", F.lit(""))).bitwiseAND(F.lit(-(2**TEXT_BITS)))


def sort_key():
    """Key of a row with `_text`, `_row` and `_copy`: copies of one and the same row have keys of their own."""
    own = F.when(F.col("_copy") == 0, F.col("_row")).otherwise(F.xxhash64("_row", "_copy"))
    return F.col("_text").bitwiseOR(own.bitwiseAND(F.lit(2**TEXT_BITS - 1)))


def count_below(keys: DataFrame, probes: list[int]) -> tuple[list[int], list[int]]:
    """Exact bytes and rows with a key below each probe. Each task sends one figure per gap between probes."""
    marks = np.array(probes, np.int64)

    def gaps(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        size, rows = np.zeros(len(marks) + 1, np.int64), np.zeros(len(marks) + 1, np.int64)
        for batch in batches:
            gap = np.searchsorted(marks, batch.column("_key").to_numpy(), side="right")
            np.add.at(size, gap, batch.column("_bytes").to_numpy())
            rows += np.bincount(gap, minlength=len(rows))
        some = np.flatnonzero(rows)
        yield pa.RecordBatch.from_pydict({"gap": pa.array(some), "size": pa.array(size[some]), "rows": pa.array(rows[some])})

    found = keys.select("_key", "_bytes").mapInArrow(gaps, "gap bigint, size bigint, rows bigint")
    sums = {r.gap: (r.size, r.rows) for r in found.groupBy("gap").agg(F.sum("size").alias("size"), F.sum("rows").alias("rows")).collect()}
    size, rows = zip(*(sums.get(i, (0, 0)) for i in range(len(marks))))
    return list(accumulate(size)), list(accumulate(rows))


def find_splitters(keys: DataFrame, shards: int, tolerance: float, group_share: float, parts: int = 1) -> list[int]:
    """Keys at which shards 1, 2, ... begin, or their parts: `parts` equal stretches each, for which groups are cut anywhere.

    `keys` has _key and _bytes and is read once per round.
    """
    shards *= parts
    total = keys.agg(F.sum("_bytes").alias("size"), F.count("*").alias("rows")).first()
    if not total.rows:
        return [MOST - 1] * (shards - 1)
    share = total.size / shards
    near = tolerance * share
    whole_share = [group_share * share * parts if i % parts == 0 else 0.0 for i in range(shards)]
    # Bracket of a boundary: (key, bytes below, rows below) at both ends.
    open_ = {i: ((LEAST, 0, 0), (MOST, total.size, total.rows)) for i in range(1, shards)}
    done: dict[int, int] = {}
    while open_:
        wanted: dict[int, list[int]] = {}
        for i, (low, high) in open_.items():
            step = 1 << TEXT_BITS if high[0] - low[0] > 1 << TEXT_BITS else 1
            count = min(max(7, min(PROBES, MOST_PROBES // len(open_))), (high[0] - low[0]) // step - 1)
            wanted[i] = [low[0] + (high[0] - low[0]) // step * k // (count + 1) * step for k in range(1, count + 1)]
        probes = sorted({p for some in wanted.values() for p in some})
        size, rows = count_below(keys, probes) if probes else ([], [])
        for i, (low, high) in list(open_.items()):
            target = i * total.size / shards
            places = [bisect_left(probes, p) for p in wanted[i]]
            points = [low, *[(probes[j], size[j], rows[j]) for j in places], high]
            best = min(points, key=lambda p: abs(p[1] - target))
            after = next(j for j, p in enumerate(points) if j and (p[1] >= target or p is high))
            low, high = points[after - 1], points[after]
            alone = high[0] - low[0] <= 1 << TEXT_BITS  # one text between the two ends
            whole = max(whole_share[i], (high[1] - low[1]) / max(high[2] - low[2], 1))  # or one row of this group
            small = alone and min(target - low[1], high[1] - target) <= whole and high[0] % (1 << TEXT_BITS) == low[0] % (1 << TEXT_BITS) == 0
            if abs(best[1] - target) <= near or small or high[2] - low[2] <= 1 or high[0] - low[0] <= 1:
                done[i] = best[0]
                del open_[i]
            else:
                open_[i] = (low, high)
    return [min(done[i], MOST - 1) for i in range(1, shards)]


def _stretch(begins: list[int]):
    """Number of the stretch of keys that a row's key lies in."""
    return F.size(F.filter(F.array(*[F.lit(b) for b in begins]), lambda b: b <= F.col("_key"))) if begins else F.lit(0)


def shard(docs: DataFrame, shards: int = 40, tolerance: float = 0.01, group_share: float = 0.1, part_bytes: int = 64 << 20) -> DataFrame:
    """Documents with `size`, `shard` and `slot`, dealt out by one exchange; the slots of a shard are in key order."""
    spark = docs.sparkSession
    prepare(spark)
    rows = documents(docs).withColumn("_row", row_hash("doc_id", "text", "lang", "source", "n_chars"))
    rows = rows.withColumn("_text", text_key()).withColumn("size", row_bytes())
    narrow = stored(rows.select("_text", F.col("size").alias("_bytes"), "_row"), "shard-rows")
    repeated = repeated_rows(narrow)
    keys = stored(with_copies(narrow, repeated).select(sort_key().alias("_key"), "_bytes"), "shard-keys")
    rows = with_copies(rows, repeated).withColumn("_key", sort_key())
    splitters = find_splitters(keys, shards, tolerance, group_share)
    total = keys.agg(F.sum("_bytes")).first()[0] or 0
    parts = max(1, -(-total // (shards * part_bytes)))
    coarse = min(parts, COARSE)
    fine = -(-parts // coarse)
    # Boundaries of parts, by shard: those of the shards stay where they are.
    inner = find_splitters(keys, shards, tolerance, group_share, coarse) if coarse > 1 else []
    edges = [LEAST, *splitters, MOST - 1]
    begins = [sorted({min(max(b, low), high) for b in inner if low < b < high}) for low, high in zip(edges, edges[1:])]

    def placed(df: DataFrame) -> DataFrame:
        df = df.withColumn("shard", _stretch(splitters).cast("int"))
        if coarse == 1:
            return df.withColumn("_part", F.lit(0).cast("long"))
        # The stretch of the shard, and within it one of `fine` equal widths of the key.
        bounds = F.array(*[F.array(*[F.lit(b) for b in (low, *some, high)]) for low, high, some in zip(edges, edges[1:], begins)])
        own = F.element_at(bounds, F.col("shard") + 1)
        place = F.greatest(F.size(F.filter(own, lambda b: b <= F.col("_key"))), F.lit(1))
        low, high = F.element_at(own, place).cast("double"), F.element_at(own, F.least(place + 1, F.size(own))).cast("double")
        step = F.floor((F.col("_key").cast("double") - low) / F.greatest(high - low, F.lit(1.0)) * fine)
        return df.withColumn("_part", place.cast("long") * fine + F.least(F.greatest(step, F.lit(0)), F.lit(fine - 1)))

    counts = placed(keys).groupBy("shard", "_part").agg(F.count("*").alias("_rows"))
    earlier = Window.partitionBy("shard").orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    base = counts.select("shard", "_part", F.coalesce(F.sum("_rows").over(earlier), F.lit(0)).alias("_base"))
    order = Window.partitionBy("shard", "_part").orderBy("_key", "doc_id", "_row", "_copy")
    numbered = placed(rows).withColumn("_at", F.row_number().over(order) - 1)
    out = numbered.join(base, ["shard", "_part"]).withColumn("slot", F.col("_base") + F.col("_at"))
    return out.select("doc_id", "text", "lang", "source", "n_chars", "size", "shard", "slot")
