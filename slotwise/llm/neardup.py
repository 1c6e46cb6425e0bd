"""SimHash near-duplicates (op 3) by a segment-popcount embedding.

A fingerprint of 64 bits is embedded as the popcounts of its 32 two-bit segments. Written in unary (0, 1, 2 ones), the
embedding is again a 64-bit word, and the Manhattan distance of two embeddings is the number of bits in which these
words differ. It never exceeds the Hamming distance, so it is a lower bound.

Grid range-join: the 32 dimensions are cut into eight blocks. Two points within Manhattan distance 4 differ in at most
four blocks, so they share a cell in at least one of the 70 grids that keep four blocks. Points alone in their cell
leave at once. Within a cell, the lower bound is tested first, the exact distance after that, and what is emitted is
one star per connected group, never its pairs. A crowded cell is cut into chunks, and each pair of chunks is a task
of its own. Components are then found by contraction over tables in the shared folder.

`unique_documents` is the same search for copies at a five-word similarity of 0.8, which 64 bits cannot resolve: 256
bits of the shingle sets (repeats count once). At the distances that such copies have, grids over segments would have to
grow in number with the table, so the cells come from a fixed number of min-hashes of the set instead; inside a cell
the Manhattan bound and the exact distance decide as before, and nothing is left out. The groups found so are
then taken apart by the exact similarity of their shingle sets (`sets.verified`), so only texts of a similarity of 0.8
or more, or chains of such, count as copies.

Defined results: a null or blank text has fingerprint zero and links like any other; repeated rows share a component;
a component without any id has a null `component_id`; extra columns are dropped; an empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import accumulate, combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from slotwise.llm.common import documents, pick, pieces, prepare, row_hash, text_buffer
from slotwise.llm.sets import near_texts, star_edges, verified
from slotwise.session import stored

RADIUS = 4
SHINGLE = 4
SEED = 42
BLOCKS = 8
CHUNK = 1024  # points of a cell that one task compares with as many others
_EVEN = 0x5555555555555555


def shingle_hashes(text: bytes, shingle: int) -> np.ndarray:
    words = text.lower().split()  # bytes: A-Z only, ASCII white space only
    if not words:
        return np.zeros(0, np.uint64)
    joined = b" ".join(words)
    ends = list(accumulate((len(w) + 1 for w in words)))
    starts = [0, *ends[:-1]]
    ends = ends[min(shingle, len(words)) - 1 :]
    digest = xxhash.xxh64_intdigest
    return np.fromiter((digest(joined[a : b - 1], SEED) for a, b in zip(starts, ends)), np.uint64, len(ends))


def majority(hashes: np.ndarray) -> int:
    """Bits set in over half of the hashes, as a signed 64-bit number."""
    ones = np.zeros(64, np.int64)
    for at in range(0, len(hashes), 1 << 15):
        part = hashes[at : at + (1 << 15)]
        ones += np.unpackbits(part.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.uint32)
    return int(np.packbits(2 * ones > len(hashes), bitorder="little").view(np.int64)[0])


def fingerprint(text: bytes, shingle: int = SHINGLE) -> int:
    return majority(shingle_hashes(text, shingle))


def wide_fingerprint(hashes: np.ndarray, words: int) -> list[int]:
    """Several 64-bit fingerprints from independent mixes of the same shingle hashes."""
    out = [majority(hashes)]
    for _ in range(1, words):
        hashes = (hashes ^ (hashes >> np.uint64(31))) * np.uint64(0x9E3779B97F4A7C15)
        hashes = (hashes ^ (hashes >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)
        hashes = hashes ^ (hashes >> np.uint64(32))
        out.append(majority(hashes))
    return out


def fingerprints(rows: DataFrame, keep: tuple[str, ...], shingle: int = SHINGLE) -> DataFrame:
    """The columns `keep` and `fp` of rows with a `text`."""
    kinds = dict(rows.dtypes)

    def printed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in pieces(batches):
            data, offsets = text_buffer(batch.column("text"))
            whole = data.tobytes()
            prints = [fingerprint(whole[a:b], shingle) for a, b in zip(offsets[:-1], offsets[1:])]
            yield pa.RecordBatch.from_pydict({c: batch.column(c) for c in keep} | {"fp": pa.array(prints, pa.int64())})

    shape = ", ".join(f"{c} {kinds[c]}" for c in keep)
    return rows.select(*keep, "text").mapInArrow(printed, f"{shape}, fp bigint")


def embedding(fp: Column) -> Column:
    """Popcounts of the two-bit segments, in unary."""
    low, high = fp.bitwiseAND(F.lit(_EVEN)), F.shiftrightunsigned(fp, 1).bitwiseAND(F.lit(_EVEN))
    return low.bitwiseOR(high).bitwiseOR(F.shiftleft(low.bitwiseAND(high), 1))


def _embed(fp: np.ndarray) -> np.ndarray:
    even = np.uint64(_EVEN)
    low, high = fp & even, (fp >> np.uint64(1)) & even
    return low | high | ((low & high) << np.uint64(1))


def _masks(radius: int) -> list[int]:
    byte = [0xFF << (8 * b) for b in range(BLOCKS)]
    out = [sum(some) for some in combinations(byte, BLOCKS - radius)]
    return [m - 2**64 if m >= 2**63 else m for m in out]


def _distance(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Bits in which rows of words differ."""
    return np.bitwise_count(x ^ y).sum(axis=-1, dtype=np.int32)


def stars(names: np.ndarray, words: np.ndarray, radius: int) -> tuple[np.ndarray, np.ndarray]:
    """Edges from one point of each connected group of a cell to its other points."""
    place = _embed(words)
    bound = np.zeros((len(names), len(names)), np.int32)
    for k in range(words.shape[1]):
        bound += np.bitwise_count(place[:, k, None] ^ place[None, :, k])
    a, b = np.nonzero(np.triu(bound <= radius, 1))
    exact = _distance(words[a], words[b]) <= radius
    near = np.zeros(bound.shape, bool)
    near[a[exact], b[exact]] = near[b[exact], a[exact]] = True
    return star_edges(names, near)


def _cell_links(radius: int):
    def links(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            column = batch.column("points")
            points, offsets = column.flatten(), np.asarray(column.offsets)
            names, *words = (field.to_numpy() for field in points.flatten())
            words = np.stack([w.view(np.uint64) for w in words], axis=1)
            offsets = offsets - offsets[0]
            length = np.diff(offsets)
            two = offsets[:-1][length == 2]
            x, y = words[two], words[two + 1]
            good = _distance(_embed(x), _embed(y)) <= radius
            good &= _distance(x, y) <= radius
            more = [stars(names[i:j], words[i:j], radius) for i, j in zip(offsets[:-1], offsets[1:]) if j - i > 2]
            a, b = (np.concatenate(part) for part in zip((names[two][good], names[two + 1][good]), *more))
            yield pa.RecordBatch.from_pydict({"a": pa.array(a), "b": pa.array(b)})

    return links


def _met(placed: DataFrame, chunk: int) -> DataFrame:
    """Lists of points that meet; a row of `placed` is a point (fp, ...) in one `cell` of n points. Crowded cells go by chunks."""
    crowd = placed.where("n > 1")
    chunks = F.ceil(F.col("n") / chunk)
    own = F.pmod(F.xxhash64("fp"), chunks)
    other = F.explode(F.sequence(F.lit(0).cast("long"), chunks - 1))
    dealt = crowd.withColumn("i", own).withColumn("j", other)
    point = F.struct(*[c for c in placed.columns if c not in ("cell", "n")]).alias("point")
    tasks = dealt.select(point, "cell", F.least("i", "j").alias("i"), F.greatest("i", "j").alias("j"))
    lists = tasks.groupBy("cell", "i", "j").agg(F.collect_list("point").alias("points")).where(F.size("points") > 1)
    return lists.select("points")


def _linked(placed: DataFrame, radius: int) -> DataFrame:
    """Edges (a, b) among points (fp, words...) placed in cells."""
    # Cell sizes are counted in parts, so that no task holds a crowded cell before the chunks split it.
    sizes = placed.groupBy("cell").agg(F.count("*").alias("n")).where("n > 1")
    # Spark takes the cells for no larger than the points they are exploded from, and would broadcast many millions of them.
    return _met(placed.join(sizes.hint("merge"), "cell"), CHUNK).mapInArrow(_cell_links(radius), "a bigint, b bigint").distinct()


def grid_links(points: DataFrame, radius: int = RADIUS) -> DataFrame:
    """Edges (a, b) that connect exactly the points (distinct `fp`) that chains of links within the radius connect."""
    spot = embedding(F.col("fp"))
    cells = F.array(*[F.xxhash64(F.lit(i), spot.bitwiseAND(F.lit(m))) for i, m in enumerate(_masks(radius))])
    return _linked(points.select("fp", F.col("fp").alias("word"), F.explode(cells).alias("cell")), radius)


def _shuffled(column: Column) -> Column:
    """A one-to-one scrambling of 64 bits, so that contraction does not depend on the order of the points."""
    column = column.bitwiseXOR(F.shiftleft(column, 13))
    column = column.bitwiseXOR(F.shiftrightunsigned(column, 7))
    return column.bitwiseXOR(F.shiftleft(column, 17))


def connected(links: DataFrame) -> DataFrame:
    """(fp, root): one root for all points of a connected group; points without a link are not listed.

    Each round maps every point to its smallest neighbour and replaces edges by those between the images. Rounds are
    tables in the shared folder, so lineage stays short and lost executors cost no more than a round.
    """
    edges = stored(links.select(_shuffled(F.col("a")).alias("a"), _shuffled(F.col("b")).alias("b")), "links")
    names = links.select(F.explode(F.array("a", "b")).alias("fp")).distinct()
    labels = stored(names.select("fp", _shuffled(F.col("fp")).alias("root")), "labels")
    while not edges.isEmpty():
        both = edges.union(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.min("b").alias("m"))
        image = stored(least.select("a", F.least("a", "m").alias("m")), "images")
        left, right = image.toDF("a", "ma"), image.toDF("b", "mb")
        moved = edges.join(left, "a").join(right, "b").where("ma <> mb")
        edges = stored(moved.select(F.least("ma", "mb").alias("a"), F.greatest("ma", "mb").alias("b")).distinct(), "links")
        step = image.toDF("root", "next")
        labels = stored(labels.join(step, "root", "left").select("fp", F.coalesce("next", "root").alias("root")), "labels")
    return labels


def components(prints: DataFrame, radius: int = RADIUS) -> DataFrame:
    """Stored rows (doc_id, fp, ...) with `component_id`, the smallest id reachable over links."""
    points = stored(prints.groupBy("fp").agg(F.min("doc_id").alias("first")), "points")
    labels = connected(stored(grid_links(points.select("fp"), radius), "links"))
    grouped = _grouped(points, labels)
    smallest = grouped.groupBy("root").agg(F.min("first").alias("component_id"))
    found = stored(grouped.select("fp", "root").join(smallest, "root").select("fp", "component_id"), "components")
    return prints.join(found, "fp")


def _grouped(points: DataFrame, labels: DataFrame) -> DataFrame:
    """Points with the root of their group; a point alone is its own root."""
    labels = labels.toDF("fp", "_root")
    return points.join(labels, "fp", "left").withColumn("root", F.coalesce("_root", _shuffled(F.col("fp")))).drop("_root")


def near_duplicates(docs: DataFrame, radius: int = RADIUS, shingle: int = SHINGLE) -> DataFrame:
    """doc_id, fingerprint (hex) and component_id of every document."""
    prepare(docs.sparkSession)
    prints = stored(fingerprints(pick(docs, "doc_id", "text"), ("doc_id",), shingle), "prints")
    out = components(prints, radius)
    return out.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


WIDE_WORDS, WIDE_SHINGLE = 4, 5
WIDE_RADIUS = 60  # of 256 bits: at a similarity of 0.8, 39 differ on average, 57 or fewer in 999 of 1000
SIMILARITY_PERCENT = 80
# Cells of a set: BANDS hashes of BAND_ROWS min-hashes each. Two sets of a similarity of 0.8 share none with chance
# (1 - 0.8^3)^16 = 1e-5, whatever the number of points; two of a similarity of 0.1 share one with chance 0.016.
BANDS, BAND_ROWS = 16, 3
_DRAWN = np.random.default_rng(3).integers(0, 2**63, (2, BANDS * BAND_ROWS), dtype=np.uint64)


def missed(similarity: float) -> float:
    """Share of links of a similarity that no cell shows."""
    return (1 - similarity**BAND_ROWS) ** BANDS


def cells_of(hashes: np.ndarray) -> np.ndarray:
    """The cells of a set of shingle hashes; those of an empty set are all its own."""
    if not len(hashes):
        return np.zeros(BANDS, np.int64)
    least = np.empty(BANDS * BAND_ROWS, np.uint64)
    for i, (mask, factor) in enumerate(_DRAWN.T):
        mixed = (hashes ^ mask) * (factor | np.uint64(1))
        least[i] = (mixed ^ (mixed >> np.uint64(32))).min()
    bands = least.reshape(BANDS, BAND_ROWS)
    return np.array([xxhash.xxh64_intdigest(band.tobytes(), i) for i, band in enumerate(bands)], np.uint64).view(np.int64)


def _sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(point, tokens) of rows (point, text)."""
    for batch in pieces(batches):
        data, offsets = text_buffer(batch.column("text"))
        sets = [np.unique(shingle_hashes(data[a:b].tobytes(), WIDE_SHINGLE)).view(np.int64) for a, b in zip(offsets[:-1], offsets[1:])]
        yield pa.RecordBatch.from_pydict({"point": batch.column("point"), "tokens": pa.array(sets, pa.list_(pa.int64()))})


def unique_documents(docs: DataFrame, radius: int = WIDE_RADIUS, percent: int = SIMILARITY_PERCENT) -> DataFrame:
    """Documents of which one (smallest id) stays of every group of near copies at five-word similarity."""
    prepare(docs.sparkSession)
    rows = documents(docs).withColumn("_row", row_hash("doc_id", "text", "lang", "source", "n_chars"))
    words = [f"w{i}" for i in range(WIDE_WORDS)]

    def printed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in pieces(batches):
            data, offsets = text_buffer(batch.column("text"))
            whole = data.tobytes()
            hashes = [shingle_hashes(whole[a:b], WIDE_SHINGLE) for a, b in zip(offsets[:-1], offsets[1:])]
            # Of sets, as the similarity is: one repeated shingle must not outweigh all others.
            hashes = [np.unique(h) for h in hashes]
            found = np.array([wide_fingerprint(h, WIDE_WORDS) for h in hashes], np.int64)
            sets = np.array([xxhash.xxh64_intdigest(h.tobytes()) for h in hashes], np.uint64).view(np.int64)
            cells = pa.array([cells_of(h) for h in hashes], pa.list_(pa.int64()))
            kept = {c: batch.column(c) for c in ("doc_id", "_row")}
            yield pa.RecordBatch.from_pydict(kept | {"fp": pa.array(sets)} | {w: pa.array(found[:, i]) for i, w in enumerate(words)} | {"cells": cells})

    # A point is a set of shingles; `fp` is its hash.
    kind = dict(rows.dtypes)["doc_id"]
    shape = f"doc_id {kind}, _row bigint, fp bigint, " + ", ".join(f"{w} bigint" for w in words) + ", cells array<bigint>"
    prints = stored(rows.select("doc_id", "_row", "text").mapInArrow(printed, shape), "prints")
    chosen = F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "_row", *words, "cells")).alias("first")
    points = prints.groupBy("fp").agg(chosen)
    points = stored(points.select("fp", "first", "first.cells", *[F.col(f"first.{w}").alias(w) for w in words]), "points")
    placed = points.select("fp", *words, F.explode("cells").alias("cell"))
    links = stored(_linked(placed, radius), "links")
    groups = stored(connected(links).select(F.col("fp").alias("point"), F.col("root").alias("cell")), "groups")
    wanted = stored(groups.join(points.select(F.col("fp").alias("point"), F.col("first._row").alias("_row")), "point").select("point", "_row"), "wanted")
    sets = near_texts(rows, wanted).mapInArrow(_sets, "point bigint, tokens array<bigint>")
    labels = connected(stored(verified(sets, groups, percent), "links"))
    best = _grouped(points.select("fp", "first._row", "first.none", "first.doc_id"), labels).groupBy("root").agg(F.min(F.struct("none", "doc_id", "_row")).alias("first"))
    kept = rows.join(stored(best.select(F.col("first._row").alias("_row")), "kept"), "_row", "left_semi")
    # Fully equal rows have one row hash and would all stay.
    equal = stored(prints.groupBy("_row").count().where("count > 1").select("_row"), "equal")
    if not equal.isEmpty():
        kept = kept.join(equal, "_row", "left_anti").union(kept.join(equal, "_row", "left_semi").dropDuplicates(["_row"]))
    return kept.drop("_row")
