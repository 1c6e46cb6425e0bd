"""Exact comparison of shingle sets, for the joins of this subpackage.

A group of candidates that fits one task (GROUP_SETS sets of GROUP_TOKENS tokens together) is compared there by matrix
products, and its sets move once. Of a larger group every set is compared with one pivot, which is linear in its size;
only sets that do not link to the pivot are then compared with all others of their group, in chunks. Either way all
links are found, and what is emitted are stars, never the pairs of a group.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from slotwise.session import stored

GROUP_SETS, GROUP_TOKENS = 1024, 1 << 22
SET_CHUNK = 256  # sets of a larger group that one task compares with as many others
BROADCAST_ROWS = 1_000_000  # rows of two numbers that are sent to every task; more are joined by a shuffle
_COLUMNS = 4096


def star_edges(names: np.ndarray, near: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    left = np.ones(len(names), bool)
    out: list[tuple[np.ndarray, np.ndarray]] = [(names[:0], names[:0])]
    for root in np.flatnonzero(near.any(axis=1)):
        if not left[root]:
            continue
        left[root] = False
        front = np.array([root])
        while len(front):
            front = np.flatnonzero(near[front].any(axis=0) & left)
            left[front] = False
            out.append((np.full(len(front), names[root]), names[front]))
    first, second = (np.concatenate(part) for part in zip(*out))
    return first, second


def shared_shingles(values: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """How many elements each two of the sets have in common; set i is values[offsets[i]:offsets[i + 1]]."""
    n = len(offsets) - 1
    _, place, count = np.unique(values, return_inverse=True, return_counts=True)
    column = np.where(count > 1, np.cumsum(count > 1) - 1, -1)[place]
    owner = np.repeat(np.arange(n), np.diff(offsets))
    order = np.argsort(column, kind="stable")
    column, owner = column[order], owner[order]
    out = np.zeros((n, n), np.float64)
    for low in range(0, int(column[-1]) + 1 if len(column) else 0, _COLUMNS):
        a, b = np.searchsorted(column, [low, low + _COLUMNS])
        holds = np.zeros((n, _COLUMNS), np.float32)
        holds[owner[a:b], column[a:b] - low] = 1
        out += holds @ holds.T
    return out


def similar(size_x, size_y, shared, percent: int):
    return 100 * shared >= percent * (size_x + size_y - shared)


def _to_pivot(percent: int):
    """Whether the set of each row links to the pivot's."""

    def told(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            good = []
            for i in range(batch.num_rows):
                own, other = (np.asarray(batch.column(c).slice(i, 1).flatten()) for c in ("tokens", "pivot_tokens"))
                shared = len(np.intersect1d(own, other, assume_unique=True))
                good.append(bool(similar(len(own), len(other), shared, percent)))
            kept = {c: batch.column(c) for c in ("point", "cell", "pivot")}
            yield pa.RecordBatch.from_pydict(kept | {"linked": pa.array(good, pa.bool_())})

    return told


def _across(percent: int):
    """Stars of the linked points among `late` ones, and between these and all others, of one task."""

    def links(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            first, second = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
            for i in range(batch.num_rows):
                points = batch.column("points").slice(i, 1).flatten()
                names, late, sets = points.take(pa.array(np.unique(np.asarray(points.field("point")), return_index=True)[1])).flatten()
                offsets = np.asarray(sets.offsets)
                shared = shared_shingles(np.asarray(sets.flatten()), offsets - offsets[0])
                size, late = np.diff(offsets), np.asarray(late.cast(pa.int8())).astype(bool)
                near = similar(size[:, None], size[None, :], shared, percent) & (late[:, None] | late[None, :])
                np.fill_diagonal(near, False)
                a, b = star_edges(np.asarray(names), near)
                first.append(a)
                second.append(b)
            yield pa.RecordBatch.from_pydict({"a": pa.array(np.concatenate(first)), "b": pa.array(np.concatenate(second))})

    return links


def verified(sets: DataFrame, groups: DataFrame, percent: int) -> DataFrame:
    """Edges (a, b) that connect what links connect; `sets` is (point, tokens), `groups` (point, cell) of candidates.

    A point may be listed more than once, with the same tokens.
    """
    every = stored(sets.join(groups, "point"), "sets")
    sizes = every.groupBy("cell").agg(F.count("*").alias("members"), F.sum(F.size("tokens")).alias("total"))
    fits = (F.col("members") <= GROUP_SETS) & (F.col("total") <= GROUP_TOKENS)
    sizes = stored(sizes.select("cell", fits.alias("fits")), "group-sizes")
    whole = every.join(sizes.where("fits"), "cell").groupBy("cell").agg(F.collect_list(F.struct("point", F.lit(True).alias("late"), "tokens")).alias("points"))
    links = whole.select("points").mapInArrow(_across(percent), "a bigint, b bigint")
    crowded = sizes.where("not fits").select("cell")
    return links if crowded.isEmpty() else links.union(_by_pivot(every.join(crowded, "cell").dropDuplicates(["point"]), percent))


def _by_pivot(placed: DataFrame, percent: int) -> DataFrame:
    """Edges within crowded groups; `placed` is (point, cell, tokens)."""
    placed = stored(placed.select("point", "cell", "tokens"), "crowded-sets")
    pivots = placed.groupBy("cell").agg(F.min("point").alias("pivot"), F.count("*").alias("members"))
    rows = placed.join(pivots.select("cell", "pivot"), "cell")
    chosen = rows.where("point = pivot").select("pivot", F.col("tokens").alias("pivot_tokens"))
    met = rows.where("point <> pivot").join(chosen, "pivot").select("point", "cell", "pivot", "tokens", "pivot_tokens")
    judged = stored(met.mapInArrow(_to_pivot(percent), "point bigint, cell bigint, pivot bigint, linked boolean"), "judged")
    # What does not link to the pivot meets all others of its group; those that do have no need of one another.
    late = judged.where("not linked").select("point", "cell")
    crowd = late.groupBy("cell").agg(F.count("*").alias("late_members")).join(pivots, "cell").where("members > 2")
    columns = ("point", "tokens", "cell", "late", "i", "j")
    everyone = placed.join(crowd, "cell").join(late.withColumn("late", F.lit(True)), ["point", "cell"], "left").withColumn("late", F.coalesce("late", F.lit(False)))
    rows_of, late_rows = F.ceil(F.col("members") / SET_CHUNK), F.ceil(F.col("late_members") / SET_CHUNK)
    hashed = F.xxhash64("point")
    left = everyone.withColumn("i", F.pmod(hashed, rows_of)).withColumn("j", F.explode(F.sequence(F.lit(0).cast("long"), late_rows - 1)))
    right = everyone.where("late").withColumn("j", F.pmod(hashed, late_rows)).withColumn("i", F.explode(F.sequence(F.lit(0).cast("long"), rows_of - 1)))
    # A late point that is on both sides of a task is listed there once.
    right = right.where(F.col("i") != F.pmod(hashed, rows_of))
    tasks = left.select(*columns).union(right.select(*columns))
    lists = tasks.groupBy("cell", "i", "j").agg(F.collect_list(F.struct("point", "late", "tokens")).alias("points"), F.max("late").alias("any")).where("any and size(points) > 1")
    more = lists.select("points").mapInArrow(_across(percent), "a bigint, b bigint")
    return judged.where("linked").select(F.col("pivot").alias("a"), F.col("point").alias("b")).union(more).distinct()


def near_texts(rows: DataFrame, wanted: DataFrame) -> DataFrame:
    """(point, text) of the rows (_row, text) that `wanted` (point, _row) names; texts move only when `wanted` is large."""
    few = wanted.count() <= BROADCAST_ROWS
    return rows.select("_row", "text").join(F.broadcast(wanted) if few else wanted, "_row").select("point", "text")
