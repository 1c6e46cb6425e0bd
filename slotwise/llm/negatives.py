"""Hard-negative mining (op 13): exact inner products by Strassen's recursion, positives and score windows by heaps.

Vectors are integers (`scaled` turns components x into floor(256 x)). Anchors and candidates are cut into tiles; a tile
of anchors times a tile of candidates is a product of int64 matrices, padded with zeros to even sides and multiplied by
Strassen's seven-product recursion. All additions are exact, as integers modulo 2^64 form a ring and scores fit.

Rows find their tile by a hash of the row, so a label, an id or a vector that many rows share is spread evenly. Anchors
are sent to every strip of candidates and meet it in a cogroup, whose size is bounded by the two tile sizes; a strip is
never joined with itself, and scores never leave their task. What leaves it are heaps: for an anchor the best
`positives` rows of its own label, in a second pass over the same tiles for each of these the best `negatives` rows of
other labels inside its score window. Heaps of different strips are merged by a ranked window, which Spark prunes
before the shuffle.

Defined results: rows without an id, label or vector, or with a component that is null, not finite or beyond 2^24 after
scaling, take no part; a shorter vector is padded with zeros; repeated rows count once; rows that share only their id
are rows of their own, as anchors too, and rank by a hash of the row; extra columns are dropped; an empty table gives
no rows.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from slotwise.llm.common import pick, prepare, row_hash
from slotwise.session import stored

LOW_PERCENT, HIGH_PERCENT = 30, 90
POSITIVES, NEGATIVES = 5, 10
STRIP_ROWS, BLOCK_ROWS = 2048, 4096  # candidates and anchors of one task
TILE_ANCHORS = 512  # anchors whose scores a task holds at a time
LEAF = 32  # side below which a product is computed directly
LIMIT = 2.0**24
_NONE = np.iinfo(np.int64).min


def _split(x: np.ndarray) -> tuple[np.ndarray, ...]:
    """The four quarters of a matrix, padded with a zero row or column to even sides."""
    x = np.pad(x, [(0, side % 2) for side in x.shape])
    half, wide = x.shape[0] // 2, x.shape[1] // 2
    return x[:half, :wide], x[:half, wide:], x[half:, :wide], x[half:, wide:]


def product(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """x @ y for int64 matrices, by Strassen's recursion."""
    if min(*x.shape, y.shape[1]) <= LEAF:
        return x @ y
    a, b, c, d = _split(x)
    e, f, g, h = _split(y)
    m1 = product(a + d, e + h)
    m2 = product(c + d, e)
    m3 = product(a, f - h)
    m4 = product(d, g - e)
    m5 = product(a + b, h)
    m6 = product(c - a, e + f)
    m7 = product(b - d, g + h)
    out = np.block([[m1 + m4 - m5 + m7, m3 + m5], [m2 + m4, m1 - m2 + m3 + m6]])
    return out[: x.shape[0], : y.shape[1]]


def scaled(vectors: DataFrame, factor: int = 256) -> DataFrame:
    """vec_id, label and vector (floor of `factor` times each component) of the rows that take part, each once, with `_row`."""
    rows = pick(vectors, "vec_id", "label", "embedding")
    grown = F.transform("embedding", lambda x: F.lit(float(factor)) * x.cast("double"))
    sound = F.forall(grown, lambda x: F.coalesce((F.abs(x) <= LIMIT) & ~F.isnan(x), F.lit(False)))
    rows = rows.where(F.col("vec_id").isNotNull() & F.col("label").isNotNull() & F.coalesce(sound, F.lit(False)))
    out = rows.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("label").cast("long").alias("label"), F.transform(grown, lambda x: F.floor(x).cast("long")).alias("vector"))
    return out.withColumn("_row", row_hash("vec_id", "label", "vector")).dropDuplicates(["_row"])


def _matrix(column: pa.ChunkedArray, width: int) -> np.ndarray:
    lists = column.combine_chunks()
    offsets = np.asarray(lists.offsets)
    length = np.diff(offsets)
    out = np.zeros((len(length), width), np.int64)
    row = np.repeat(np.arange(len(length)), length)
    out[row, np.arange(len(row)) - np.repeat(offsets[:-1] - offsets[0], length)] = np.asarray(lists.flatten())
    return out


class _Tiles:
    """A strip of candidates, in the order of ties, and the scores of its anchors, some anchors at a time."""

    def __init__(self, anchors: pa.Table, strip: pa.Table):
        strip = strip.sort_by([("vec_id", "ascending"), ("_row", "ascending")])
        self.id, self.row, self.label = (np.asarray(strip.column(c)) for c in ("vec_id", "_row", "label"))
        width = max((len(v) for t in (anchors, strip) for v in t.column("vector")), default=0)
        self.turned = _matrix(strip.column("vector"), width).T
        self.anchors, self.width = anchors, width

    def __iter__(self) -> Iterator[tuple[pa.Table, np.ndarray]]:
        for at in range(0, self.anchors.num_rows, TILE_ANCHORS):
            some = self.anchors.slice(at, TILE_ANCHORS)
            yield some, product(_matrix(some.column("vector"), self.width), self.turned)


def _best_first(scores: np.ndarray, fit: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Places of the candidates by falling score, ties in their order, unfit ones last; and the scores in that order."""
    scores = np.where(fit, scores, _NONE)
    order = np.argsort(-(scores + 1), axis=1, kind="stable")  # + 1: the smallest integer has no opposite
    return order, np.take_along_axis(scores, order, axis=1)


def _positives(count: int):
    def best(anchors: pa.Table, strip: pa.Table) -> pa.Table:
        tiles, out = _Tiles(anchors, strip), []
        for some, scores in tiles:
            own, label = (np.asarray(some.column(c)) for c in ("_row", "label"))
            order, ranked = _best_first(scores, (tiles.label[None, :] == label[:, None]) & (tiles.row[None, :] != own[:, None]))
            order, ranked = order[:, :count], ranked[:, :count]
            a, r = np.nonzero(ranked != _NONE)
            place = order[a, r]
            out.append(pa.table({"anchor": own[a], "positive_id": tiles.id[place], "positive_row": tiles.row[place], "positive_score": ranked[a, r]}))
        return pa.concat_tables(out)

    return best


def _windows(count: int, low: int, high: int):
    def best(anchors: pa.Table, strip: pa.Table) -> pa.Table:
        tiles, out = _Tiles(anchors, strip), []
        for some, scores in tiles:
            own, label = (np.asarray(some.column(c)) for c in ("_row", "label"))
            order, ranked = _best_first(scores, tiles.label[None, :] != label[:, None])
            found = some.column("positives").combine_chunks()
            at = np.repeat(np.arange(len(own)), np.diff(np.asarray(found.offsets)))
            row, score = (np.asarray(field) for field in found.flatten().flatten())
            # A window is a stretch of the ranked scores: from the first at most `top`, down to `bottom`.
            top, bottom = high * score // 100, -(-low * score // 100)
            first = np.array([np.searchsorted(-(ranked[a] + 1), -(t + 1), side="left") for a, t in zip(at, top)], np.int64)
            place = first[:, None] + np.arange(count)[None, :]
            inside = place < ranked.shape[1]
            place = np.minimum(place, ranked.shape[1] - 1)
            value = ranked[at[:, None], place]
            p, r = np.nonzero(inside & (value != _NONE) & (value >= bottom[:, None]))
            where = order[at[p], place[p, r]]
            out.append(pa.table({"anchor": own[at[p]], "positive_row": row[p], "negative_id": tiles.id[where], "negative_row": tiles.row[where], "negative_score": value[p, r]}))
        return pa.concat_tables(out)

    return best


def _met(anchors: DataFrame, rows: DataFrame, strips: int, blocks: int, best, shape: str) -> DataFrame:
    """`best` applied to every tile of anchors and every strip of candidates."""
    dealt = rows.withColumn("strip", F.pmod("_row", F.lit(strips))).withColumn("block", F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))))
    sent = anchors.withColumn("block", F.pmod(F.xxhash64("_row"), F.lit(blocks)).cast("int"))
    sent = sent.withColumn("strip", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(strips - 1).cast("long"))))
    return sent.groupBy("strip", "block").cogroup(dealt.groupBy("strip", "block")).applyInArrow(_both_there(best, shape), shape)


def _both_there(best, shape: str):
    kinds = {"bigint": pa.int64()}
    empty = pa.schema([(c.split()[0], kinds[c.split()[1]]) for c in shape.split(", ")]).empty_table()

    def run(anchors: pa.Table, strip: pa.Table) -> pa.Table:
        return best(anchors, strip) if anchors.num_rows and strip.num_rows else empty

    return run


def _first(df: DataFrame, keys: tuple[str, ...], order: list[Column], count: int) -> DataFrame:
    """The heaps of all strips merged: the first `count` rows of each key, numbered in `rank`."""
    window = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn("rank", F.row_number().over(window)).where(F.col("rank") <= count)


def mine(
    vectors: DataFrame,
    is_anchor: Column,
    positives: int = POSITIVES,
    negatives: int = NEGATIVES,
    low: int = LOW_PERCENT,
    high: int = HIGH_PERCENT,
    strip_rows: int = STRIP_ROWS,
    block_rows: int = BLOCK_ROWS,
) -> DataFrame:
    """anchor_id, positive_id, rank, negative_id, positive_score and negative_score of the rows that `scaled` returns.

    For each anchor (`is_anchor` over vec_id and label) and each of its best `positives` rows of the same label: the best
    `negatives` rows of other labels whose score lies between `low` and `high` percent of the positive's.
    """
    prepare(vectors.sparkSession)
    rows = stored(vectors, "vectors")
    chosen = stored(rows.where(is_anchor), "anchors")
    total, asked = rows.count(), chosen.count()
    strips, blocks = max(1, -(-total // strip_rows)), max(1, -(-asked // block_rows))
    shape = "anchor bigint, positive_id bigint, positive_row bigint, positive_score bigint"
    heaps = _met(chosen, rows, strips, blocks, _positives(positives), shape)
    found = stored(_first(heaps, ("anchor",), [F.desc("positive_score"), F.asc("positive_id"), F.asc("positive_row")], positives).drop("rank"), "positives")
    # At most `positives` entries per anchor.
    listed = found.groupBy(F.col("anchor").alias("_row")).agg(F.collect_list(F.struct("positive_row", "positive_score")).alias("positives"))
    shape = "anchor bigint, positive_row bigint, negative_id bigint, negative_row bigint, negative_score bigint"
    windows = _met(chosen.join(listed, "_row"), rows, strips, blocks, _windows(negatives, low, high), shape)
    best = _first(windows, ("anchor", "positive_row"), [F.desc("negative_score"), F.asc("negative_id"), F.asc("negative_row")], negatives)
    names = chosen.select(F.col("_row").alias("anchor"), F.col("vec_id").alias("anchor_id"))
    out = reduce(lambda df, other: df.join(other[0], other[1]), [(found, ["anchor", "positive_row"]), (names, ["anchor"])], best)
    return out.select("anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score")
