"""Order-dependent operators that avoid a window over the whole table."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from slotwise.session import stored

PART, PLACE, _TIE = "__part", "__place", "__tie"
_PLACE_BITS = 33  # monotonically_increasing_id keeps the partition number above the lower 33 bits


def sorted_table(df: DataFrame, order: Sequence[str]) -> DataFrame:
    """Write all rows in the given order to the shared folder and read them back with their position.

    Rows are range-partitioned and sorted in parallel. `__part` numbers the partitions in order and
    `__place` the rows inside one, from 0. Both are stored, so nothing that reads the table, however
    often and after whatever loss of executors, can see other partition boundaries.
    """
    row_id = F.monotonically_increasing_id()
    placed = df.repartitionByRange(*order).sortWithinPartitions(*order).select(
        "*",
        F.shiftright(row_id, _PLACE_BITS).alias(PART),
        row_id.bitwiseAND(F.lit((1 << _PLACE_BITS) - 1)).alias(PLACE),
    )
    return stored(placed, "sorted")


def global_rank(df: DataFrame, order: Sequence[str], name: str = "n") -> DataFrame:
    """Number all rows 1..N in the given total order, without sorting them in one task.

    A row's number is its place in its partition plus the sizes of the partitions before it. The table of
    sizes has one row per partition, which bounds both the window over it and the broadcast.
    """
    # Equal rows may change places, but a range cannot split them; the last column can.
    placed = sorted_table(df.withColumn(_TIE, F.monotonically_increasing_id()), [*order, _TIE]).drop(_TIE)
    sizes = placed.groupBy(PART).agg(F.count(F.lit(1)).alias("__size"))
    before = sizes.select(PART, (F.sum("__size").over(Window.orderBy(PART)) - F.col("__size")).alias("__before"))
    ranked = placed.join(F.broadcast(before), PART)
    return ranked.withColumn(name, F.col("__before") + F.col(PLACE) + 1).drop(PART, PLACE, "__before")


def steps(df: DataFrame, column: str, width: int, by: Sequence[str] = ()) -> DataFrame:
    """Consecutive distinct values (by..., prev, cur) of an integer column, without a global sort.

    `lag` runs inside buckets of `width` values, so no window partition can exceed `width` rows however
    many rows share a value or a bucket. The last value of a bucket and the first of the next non-empty
    one are then stitched by a window over one row per bucket.
    """
    by = list(by)
    values = df.select(*by, F.col(column).alias("cur"), F.expr(f"{column} div {width}").alias("__cell"))
    values = values.filter(F.col("cur").isNotNull()).distinct()
    inner = values.withColumn("prev", F.lag("cur").over(Window.partitionBy(*by, "__cell").orderBy("cur")))
    ends = values.groupBy(*by, "__cell").agg(F.min("cur").alias("cur"), F.max("cur").alias("__last"))
    seams = ends.withColumn("prev", F.lag("__last").over(Window.partitionBy(*by).orderBy("__cell")))
    columns = [*by, "prev", "cur"]
    return inner.select(*columns).unionByName(seams.select(*columns)).filter(F.col("prev").isNotNull())


def page_after(df: DataFrame, order: Sequence[str], cursor: Sequence | None, size: int) -> DataFrame:
    """Next page in key order after `cursor`. Pages concatenate to the whole when `order` is unique."""
    if cursor is not None:
        after = F.struct(*[F.col(c) for c in order]) > F.struct(
            *[F.lit(v).cast(df.schema[c].dataType).alias(c) for c, v in zip(order, cursor)]
        )
        # The plain bound on the leading column is implied, and unlike the tuple it reaches the scan.
        df = df.filter(F.col(order[0]) >= F.lit(cursor[0])).filter(after)
    return df.orderBy(*order).limit(size)
