"""Benchmark decontamination (op 8): size-partitioned MinHash containment search, verified by exact shingles.

Items are short and documents long, so their Jaccard similarity is near zero and banded MinHash would miss them. The
search therefore bounds containment: items are partitioned by size class, and of each item the bottom-k MinHash sketch
is kept, k being so large for its class that a text which holds the wanted share of the item's shingles holds at
least one of the k. No such document can be missed. The sketches of a block of items (at most BLOCK_SHINGLES
shingles, so their size is bounded) travel with the task; every document's shingles are hashed in numpy and looked up,
and the few documents that hit are checked against the items' shingles themselves. More items mean more blocks.

Defined results: shingles are five lower-cased (A-Z) words; an item of fewer words is one shingle, which is searched
among all runs of as many words; a text without words has none and never matches; a null item or document text is empty; every repeated row is reported by itself; extra columns
are dropped; an empty table on either side gives no rows.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from slotwise.llm.common import documents, pick, pieces, prepare, scan_words, text_buffer

SHINGLE = 5
CONTAINMENT = 0.8
BLOCK_SHINGLES = 500_000
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_BASE = 0x100000001B3  # odd, so that powers can be inverted
_STEP = np.random.default_rng(5).integers(1, 2**63, SHINGLE, dtype=np.uint64) | np.uint64(1)
_POWERS: dict[str, np.ndarray] = {}


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of the base and of its inverse, modulo 2^64."""
    if len(_POWERS.get("up", ())) < n:
        size = max(n, 1 << 16)
        for name, base in (("up", _BASE), ("down", pow(_BASE, -1, 2**64))):
            row = np.full(size, base, np.uint64)
            row[0] = 1
            _POWERS[name] = np.multiply.accumulate(row)
    return _POWERS["up"][:n], _POWERS["down"][:n]


def word_hashes(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """A number for each word and, for each row, that of its first one (one more entry at the end)."""
    data = _LOWER[data]
    starts, ends, first = scan_words(data, offsets)
    if not len(starts):
        return np.zeros(0, np.uint64), first
    up, down = _powers(len(data) + 1)
    prefix = np.zeros(len(data) + 1, np.uint64)
    np.cumsum((data.astype(np.uint64) + np.uint64(1)) * up[: len(data)], out=prefix[1:])
    word = (prefix[ends] - prefix[starts]) * down[starts]
    word ^= word >> np.uint64(31)
    word *= np.uint64(0x9E3779B97F4A7C15)
    return word, first


def run_hashes(word: np.ndarray, first: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all runs of `length` words and, for each row, the number of its first one (one more entry at the end)."""
    runs = np.maximum(np.diff(first) - length + 1, 0)
    begin = np.concatenate([[0], runs.cumsum()])
    at = np.repeat(first[:-1] - begin[:-1], runs) + np.arange(begin[-1])
    out = np.full(begin[-1], length, np.uint64)
    for i in range(length):
        out += word[at + i] * _STEP[i]
    out ^= out >> np.uint64(32)
    return out, begin


def runs(text: str | None, length: int) -> set[bytes]:
    """All runs of `length` words of a text."""
    words = (text or "").encode().lower().split()
    return {b" ".join(words[i : i + length]) for i in range(len(words) - length + 1)}


def shingles(text: str | None) -> set[bytes]:
    """The shingles of an item."""
    count = len((text or "").encode().split())
    return runs(text, min(count, SHINGLE)) if count else set()


class Items:
    """A block of items: shingles, their number, and sketch hashes with the items they stand for."""

    def __init__(self, rows: list[tuple[int, str]], threshold: float):
        self.rows = [(item, found) for item, text in rows if (found := shingles(text))]
        self.threshold = threshold
        owners = defaultdict(set)
        # Words of an item's shingles: five, or all that a shorter item has.
        self.length = [next(iter(found)).count(b" ") + 1 for _, found in self.rows]
        self.lengths = sorted(set(self.length))
        for place, (_, found) in enumerate(self.rows):
            size_class = 2 ** len(found).bit_length() - 1  # largest size of the class
            most_missed = int(size_class * (1 - threshold) + 1e-9)
            column = pa.array([s.decode("utf-8", "surrogateescape") for s in sorted(found)])
            sketch = np.sort(run_hashes(*word_hashes(*text_buffer(column)), self.length[place])[0])[: most_missed + 1]
            for h in sketch.tolist():
                owners[h].add(place)
        self.owners = dict(owners)
        self.hashes = np.array(sorted(owners), np.uint64)
        self.table = np.zeros(1 << 20, bool)
        self.table[self.hashes >> np.uint64(44)] = True

    def hits(self, text: bytes, places: set[int]) -> list[tuple[int, int, int]]:
        own = {n: runs(text.decode(), n) for n in {self.length[p] for p in places}}
        found = [(self.rows[p][0], len(self.rows[p][1]), len(self.rows[p][1] & own[self.length[p]])) for p in sorted(places)]
        return [f for f in found if f[2] >= self.threshold * f[1] - 1e-9]


def item_blocks(items: DataFrame, block_shingles: int = BLOCK_SHINGLES) -> Iterator[list[tuple[int, str]]]:
    """The query set in blocks of bounded size, fetched partition by partition."""
    block, size = [], 0
    for row in items.toLocalIterator():
        words = len((row.text or "").split()) + 1
        if block and size + words > block_shingles:
            yield block
            block, size = [], 0
        block.append((row.item_id, row.text))
        size += words
    if block:
        yield block


def _search(items: Items):
    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in pieces(batches):
            data, offsets = text_buffer(batch.column("text"))
            words, places = word_hashes(data, offsets), defaultdict(set)
            for length in items.lengths:
                hashes, begin = run_hashes(*words, length)
                at = np.flatnonzero(items.table[hashes >> np.uint64(44)])
                at = at[np.isin(hashes[at], items.hashes)]
                for row, h in zip((np.searchsorted(begin, at, side="right") - 1).tolist(), hashes[at].tolist()):
                    places[row] |= items.owners[h]
            found = [(r, *hit) for r in sorted(places) for hit in items.hits(data[offsets[r] : offsets[r + 1]].tobytes(), places[r])]
            rows, ids, size, shared = ([f[i] for f in found] for i in range(4))
            out = {"doc_id": batch.column("doc_id").take(pa.array(rows, pa.int64())), "item_id": pa.array(ids, pa.int64())}
            yield pa.RecordBatch.from_pydict(out | {"n_shingles": pa.array(size, pa.int64()), "n_shared": pa.array(shared, pa.int64())})

    return search


def find_leaks(docs: DataFrame, benchmark: DataFrame, threshold: float = CONTAINMENT, block_shingles: int = BLOCK_SHINGLES) -> DataFrame:
    """One row for each document row and item of which it holds the wanted share of shingles."""
    spark = docs.sparkSession
    prepare(spark)
    shape = "doc_id bigint, item_id bigint, n_shingles bigint, n_shared bigint"
    rows = pick(docs, "doc_id", "text").select(F.col("doc_id").cast("bigint").alias("doc_id"), "text")
    items = pick(benchmark, "item_id", "text").select(F.col("item_id").cast("bigint").alias("item_id"), "text")
    out = None
    for block in item_blocks(items, block_shingles):
        found = rows.mapInArrow(_search(Items(block, threshold)), shape)
        out = found if out is None else out.union(found)
    if out is None:
        out = spark.createDataFrame([], shape)
    return out.withColumn("containment", F.col("n_shared") / F.col("n_shingles"))


def clean(docs: DataFrame, benchmark: DataFrame, threshold: float = CONTAINMENT, block_shingles: int = BLOCK_SHINGLES) -> DataFrame:
    """Documents that hold no item. Judged row by row, so ids need be neither present nor unique."""
    prepare(docs.sparkSession)
    rows = documents(docs)
    for block in item_blocks(pick(benchmark, "item_id", "text"), block_shingles):
        rows = rows.mapInArrow(_without(Items(block, threshold)), rows.schema)
    return rows


def _without(items: Items):
    search = _search(items)

    def without(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in pieces(batches):
            numbered = pa.RecordBatch.from_pydict({"doc_id": pa.array(range(batch.num_rows), pa.int64()), "text": batch.column("text")})
            bad = {i for part in search(iter([numbered])) for i in part.column("doc_id").to_pylist()}
            yield batch.filter(pa.array([i not in bad for i in range(batch.num_rows)], pa.bool_()))

    return without
