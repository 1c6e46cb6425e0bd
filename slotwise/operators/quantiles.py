"""Exact percentiles without gathering the values in one place."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from math import ceil, floor

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from slotwise.session import stored


CELLS = 1024  # into which the range of a wanted value is divided in one pass
_LOG_CELLS = 512  # first cells per factor e of the value, either side of zero


def value_counts(df: DataFrame, column: str) -> DataFrame:
    """How often each value occurs, as a stored table (v, n)."""
    counts = df.filter(F.col(column).isNotNull()).groupBy(F.col(column).alias("v")).agg(F.count(F.lit(1)).alias("n"))
    return stored(counts, "value-counts")


@dataclass
class _Cell:
    """A range of values that holds wanted ranks: its ends occur, `before` rows lie below it."""

    low: object
    high: object
    before: int
    size: int

    def holds(self, rank: int) -> bool:
        return self.before <= rank < self.before + self.size


def _first_cells(counts: DataFrame) -> list[_Cell]:
    """All non-empty cells of a logarithmic scale, in order; their number does not depend on the rows."""
    value = F.col("v").cast("double")
    cell = F.floor(F.signum(value) * F.log1p(F.abs(value)) * _LOG_CELLS)
    found = counts.groupBy(cell.alias("cell")).agg(F.min("v").alias("low"), F.max("v").alias("high"), F.sum("n").alias("size"))
    return _in_order(found.collect(), 0)


def _in_order(rows, before: int) -> list[_Cell]:
    out = []
    for r in sorted(rows, key=lambda r: r.low):
        out.append(_Cell(r.low, r.high, before, int(r.size)))
        before += int(r.size)
    return out


def _refined(counts: DataFrame, cells: list[_Cell]) -> list[_Cell]:
    """The cells divided further, by one pass over the rows that lie in any of them."""
    kind = counts.schema["v"].dataType
    exact = kind if isinstance(kind, (T.DoubleType, T.FloatType)) else T.DecimalType(38, getattr(kind, "scale", 0))
    value, number, part = F.col("v").cast(exact), F.lit(None).cast("int"), F.lit(None).cast("double")
    for i, c in enumerate(cells):
        low, high = F.lit(c.low).cast(kind), F.lit(c.high).cast(kind)
        inside = F.col("v").between(low, high)
        # Differences are exact before they become doubles, so two different ends never fall into one part.
        share = (value - low.cast(exact)).cast("double") / (high.cast(exact) - low.cast(exact)).cast("double")
        number, part = F.when(inside, F.lit(i)).otherwise(number), F.when(inside, F.floor(share * CELLS)).otherwise(part)
    placed = counts.select("v", "n", number.alias("i"), part.alias("part")).filter("i is not null")
    found = placed.groupBy("i", "part").agg(F.min("v").alias("low"), F.max("v").alias("high"), F.sum("n").alias("size")).collect()
    return [cell for i, c in enumerate(cells) for cell in _in_order([r for r in found if r.i == i], c.before)]


def percentiles_of_counts(counts: DataFrame, probabilities: Sequence[float]) -> DataFrame:
    """Rows (p, value): linearly interpolated percentiles of the values in a `value_counts` table.

    Spark's own `percentile` keeps a count per distinct value in one buffer, and a sort moves every row. Here a
    histogram is refined: rows are counted in cells, the cells that hold a wanted rank are divided again, and so on
    until each holds one value: as a rule two passes, each of which counts on the map side and sends at most CELLS
    rows per wanted rank. `counts` may be filtered by value first.
    """
    probs = [float(p) for p in probabilities]
    if not probs or min(probs) < 0 or max(probs) > 1:
        raise ValueError("probabilities must lie in [0, 1]")
    spark, shape = counts.sparkSession, "p double, value double"
    cells = _first_cells(counts)
    total = sum(c.size for c in cells)
    if not total:
        return spark.createDataFrame([], shape)
    positions = {p: p * (total - 1) for p in probs}
    ranks = {r for x in positions.values() for r in (floor(x), ceil(x))}
    values: dict[int, float] = {}
    while True:
        cells = [c for c in cells if any(c.holds(r) for r in ranks)]
        values |= {r: float(c.low) for c in cells if c.low == c.high for r in ranks if c.holds(r)}
        ranks -= set(values)
        cells = [c for c in cells if c.low != c.high]
        if not cells:
            break
        cells = _refined(counts, cells)
    rows = []
    for p, x in positions.items():
        low, high = values[floor(x)], values[ceil(x)]
        rows.append((p, low + (high - low) * (x - floor(x))))
    return spark.createDataFrame(rows, shape)


def percentile_row(counts: DataFrame, named: dict[str, float]) -> DataFrame:
    """One row with a column per named percentile of a `value_counts` table."""
    found = percentiles_of_counts(counts, sorted(set(named.values())))
    return found.agg(*[F.max(F.when(F.col("p") == p, F.col("value"))).alias(name) for name, p in named.items()])


def exact_percentiles(df: DataFrame, column: str, probabilities: Sequence[float]) -> DataFrame:
    """Rows (p, value) for a plain numeric column."""
    return percentiles_of_counts(value_counts(df, column), probabilities)


def approximate_columns(column: str, named: dict[str, float]) -> list[Column]:
    """Aggregates for named percentiles of a plain column, with a relative rank error of 1/10000.

    One sketch: equal aggregates in one `agg` are computed once.
    """
    q = F.percentile_approx(F.col(column).cast("double"), list(named.values()), 10_000)
    return [q[i].alias(name) for i, name in enumerate(named)]


def approximate_row(df: DataFrame, column: str, named: dict[str, float]) -> DataFrame:
    """`percentile_row` in a single pass over a plain column."""
    return df.agg(*approximate_columns(column, named))
