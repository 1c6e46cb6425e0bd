"""Which slots a stream has received, as a mergeable set of intervals.

A single highest slot cannot say what lies below it: a source that delivers its newer part first leaves a hole that a
maximum hides. Each batch therefore stores the intervals of the slots that it holds, and the union of all batches is
the frontier. An interval is an island of received slots with no hole longer than the tolerance.

The frontier never decides that a record is dropped. It tells where a record *may* have been stored before; only there
are stored keys looked up, and only a record whose key is found is a replay. Widening an interval, which bounds the
number of intervals, therefore costs look-ups and never a record.
"""

from __future__ import annotations

from bisect import bisect_left
from collections.abc import Iterable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from slotwise.operators.ordering import steps
from slotwise.schemas import GAP_TOLERANCE_SLOTS, SLOTS_PER_BUCKET

MAX_INTERVALS = 10_000  # kept by a stream; beyond it the shortest holes are closed
MAX_RANGES = 64  # that one look-up of stored keys names
SCHEMA = "stream string, start_slot bigint, end_slot bigint"


class Intervals:
    """Disjoint inclusive intervals in order. Adding and merging commute, so batches may come in any order."""

    def __init__(self, spans: Iterable[tuple[int, int]] = (), tolerance: int = GAP_TOLERANCE_SLOTS, limit: int = MAX_INTERVALS):
        self.tolerance, self.limit = tolerance, limit
        self.spans: list[tuple[int, int]] = []
        self.merge(spans)

    def merge(self, spans: Iterable[tuple[int, int]]) -> "Intervals":
        """Take in more intervals; those that touch, or are no further apart than the tolerance, become one."""
        merged: list[tuple[int, int]] = []
        for start, end in sorted([*self.spans, *spans]):
            if merged and start - merged[-1][1] <= self.tolerance:
                merged[-1] = (merged[-1][0], max(end, merged[-1][1]))
            else:
                merged.append((start, end))
        self.spans = _widest_holes(merged, self.limit)
        return self

    def covers(self, slot: int) -> bool:
        at = bisect_left(self.spans, (slot + 1,)) - 1
        return at >= 0 and slot <= self.spans[at][1]

    def within(self, low: int, high: int, limit: int = MAX_RANGES) -> list[tuple[int, int]]:
        """At most `limit` ranges between two slots that hold all that is covered there."""
        cut = [(max(a, low), min(b, high)) for a, b in self.spans if a <= high and b >= low]
        return _widest_holes(cut, limit)

    def holes(self) -> list[tuple[int, int]]:
        """(last slot before, first slot after) of each hole."""
        return [(left[1], right[0]) for left, right in zip(self.spans, self.spans[1:])]

    @property
    def resume_slot(self) -> int | None:
        """Where a source that can seek has to begin, inclusively, to leave no hole: the end of the first interval."""
        return self.spans[0][1] if self.spans else None


def _widest_holes(spans: list[tuple[int, int]], limit: int) -> list[tuple[int, int]]:
    """The same slots in at most `limit` intervals: the shortest holes are closed."""
    if len(spans) <= limit:
        return spans
    order = sorted(range(1, len(spans)), key=lambda i: spans[i - 1][1] - spans[i][0])
    starts = sorted([0, *order[: limit - 1]])
    return [(spans[a][0], spans[b - 1][1]) for a, b in zip(starts, [*starts[1:], len(spans)])]


def intervals_of(rows: DataFrame, low: int, high: int, tolerance: int = GAP_TOLERANCE_SLOTS, limit: int = MAX_INTERVALS) -> list[tuple[int, int]]:
    """Islands of the slots of a batch whose bounds are known. At most `limit` holes, the longest, leave the executors."""
    if high - low <= tolerance:
        return [(low, high)]
    hole = F.col("cur") - F.col("prev")
    found = steps(rows, "slot", SLOTS_PER_BUCKET).filter(hole > tolerance).orderBy(hole.desc(), "cur").limit(limit - 1)
    holes = sorted((r.prev, r.cur) for r in found.select("prev", "cur").collect())
    return list(zip([low, *[cur for _, cur in holes]], [*[prev for prev, _ in holes], high]))


def merged(spark: SparkSession, stored: DataFrame | None, stream: str, tolerance: int = GAP_TOLERANCE_SLOTS, limit: int = MAX_INTERVALS) -> Intervals:
    """The frontier of a stream from the intervals of its batches (stream, start_slot, end_slot).

    Batches overlap and are many; their union is taken in two steps, inside buckets of slots first.
    """
    if stored is None:
        return Intervals((), tolerance, limit)
    mine = stored.filter(F.col("stream") == stream)
    # What one bucket's intervals cover is found by a running maximum inside it; equal and contained ones go at once.
    cell = F.expr(f"start_slot div {SLOTS_PER_BUCKET}")
    widest = mine.groupBy(cell.alias("cell"), "start_slot").agg(F.max("end_slot").alias("end_slot"))
    reach = "max(end_slot) over (partition by cell order by start_slot rows between unbounded preceding and 1 preceding)"
    opened = widest.withColumn("reach", F.expr(reach)).withColumn("opens", F.expr(f"reach is null or start_slot - reach > {tolerance}"))
    island = opened.withColumn("island", F.expr("sum(cast(opens as int)) over (partition by cell order by start_slot)"))
    spans = island.groupBy("cell", "island").agg(F.min("start_slot").alias("start_slot"), F.max("end_slot").alias("end_slot"))
    out = Intervals((), tolerance, limit)
    chunk: list[tuple[int, int]] = []
    # Streamed to the driver partition by partition; what is held there is bounded by the limit.
    for row in spans.select("start_slot", "end_slot").toLocalIterator():
        chunk.append((row.start_slot, row.end_slot))
        if len(chunk) >= limit:
            out.merge(chunk)
            chunk = []
    return out.merge(chunk)
