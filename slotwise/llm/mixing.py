"""Mixing sources to target weights (op 1): token blocks, multinomial draws, pseudorandom index permutations.

The words of each source form one stream, in the order of a row hash, packed into blocks of `block_words`. The mix is
a set of slots. How many slots a source gets is fixed by its target. Each source's slots are dealt over the output
shards by one multinomial draw per source, so a shard's counts are multinomial given the fixed totals. Slot number j of
a source takes block P(j mod n) of its n blocks, P being a pseudorandom permutation of the indices with a key of its
own for each pass. Blocks and slots then meet in one join by (source, block index).

Stream positions come from running sums within hash buckets of a source, over bucket totals, so a source that holds a
third of all rows, or a row that is repeated as often, is summed by many tasks. Only one row per source and a few figures reach the driver.

Defined results: a null or blank text has size 0 and is never taken; a null source is a source and comes last; repeated
rows each have their own place in the stream; rows without an id are mixed like others; extra columns are dropped; an
empty table gives an empty mix.
"""

from __future__ import annotations

from collections.abc import Iterator
from fractions import Fraction

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from slotwise.llm.common import documents, pieces, prepare, repeated_rows, row_hash, scan_words, text_buffer, with_copies
from slotwise.session import stored

WEIGHTS = (5, 2, 1)  # fixed values, repeating over the sources in order
MOST_REPEATS = 3  # fixed value: no block is taken more often
BLOCK_WORDS = 128
SHARD_SLOTS = 4096
BUCKET_ROWS = 500
SEED = 7


def targets(sizes: list[int], weights: tuple[int, ...] = WEIGHTS) -> list[Fraction]:
    """Words wanted of each source: shares of the total by weight, at most three times a source's size."""
    total, caps = sum(sizes), [MOST_REPEATS * s for s in sizes]
    weight = [weights[i % len(weights)] for i in range(len(sizes))]
    out: list[Fraction] = [Fraction(0)] * len(sizes)
    free, rest = set(range(len(sizes))), Fraction(total)
    while free:
        unit = rest / sum(weight[i] for i in free)
        over = {i for i in free if unit * weight[i] > caps[i]}
        for i in over or free:
            out[i] = Fraction(caps[i]) if over else unit * weight[i]
        rest -= sum(out[i] for i in over)
        free -= over or free
    return out


def _mixed(x: np.ndarray, key: np.uint64) -> np.ndarray:
    x = (x + key) * np.uint64(0x9E3779B97F4A7C15)
    x = (x ^ (x >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)
    return x ^ (x >> np.uint64(32))


def permuted(index: np.ndarray, n: int, key: np.ndarray) -> np.ndarray:
    """A pseudorandom permutation of range(n) for each key: a balanced Feistel network with cycle walking."""
    half = np.uint64(max(1, (max(n - 1, 1).bit_length() + 1) // 2))
    mask = (np.uint64(1) << half) - np.uint64(1)
    out = index.astype(np.uint64)
    walk = np.ones(len(out), bool)
    while walk.any():
        left, right = out[walk] >> half, out[walk] & mask
        for turn in range(4):
            left, right = right, left ^ (_mixed(right, key[walk] + np.uint64(turn * 0x51ED27)) & mask)
        out[walk] = (left << half) | right
        walk = out >= n
    return out.astype(np.int64)


def place_of(value: int, n: int, key: np.uint64) -> int:
    """The index that `permuted` maps to `value`: the same network walked backwards."""
    half = np.uint64(max(1, (max(n - 1, 1).bit_length() + 1) // 2))
    mask = (np.uint64(1) << half) - np.uint64(1)
    out = np.array([value], np.uint64)
    while True:
        left, right = out >> half, out & mask
        for turn in reversed(range(4)):
            left, right = right ^ (_mixed(left, key + np.uint64(turn * 0x51ED27)) & mask), left
        out = (left << half) | right
        if out[0] < n:
            return int(out[0])


def _blocks(size: int, words: int) -> int:
    return -(-size // words)


def _slots(size: int, target: Fraction, words: int, source: int, seed: int) -> int:
    """Slots of a source whose words come nearest to the target; the last block may be short."""
    n = _blocks(size, words)
    if not n:
        return 0
    passes, rest = divmod(target, size)
    last = size - (n - 1) * words
    short = place_of(n - 1, n, _key(source, int(passes), seed))
    taken = lambda k: k * words - (words - last) * (k > short)
    k = min(int(rest // words), n)
    best = min({k, min(k + 1, n), min(k + 2, n)}, key=lambda j: abs(taken(j) - rest))
    return min(int(passes) * n + best, MOST_REPEATS * n)


def _key(source: int, turn: int, seed: int) -> np.uint64:
    return np.random.default_rng([seed, source, turn]).integers(0, 2**63, dtype=np.uint64)


def _deal(shards: int, seed: int):
    """(src, number, blocks, slots) to (src, number, blocks, shard, first, count): the multinomial draw of each source."""

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                counts = np.random.default_rng([seed, row["number"]]).multinomial(row["slots"], np.full(shards, 1 / shards))
                first = counts.cumsum() - counts
                for at in range(0, shards, 1 << 16):
                    some = at + np.flatnonzero(counts[at : at + (1 << 16)])
                    same = {"src": pa.array([row["src"]] * len(some), pa.string())}
                    same |= {c: pa.array(np.full(len(some), row[c], np.int64)) for c in ("number", "blocks")}
                    yield pa.RecordBatch.from_pydict(same | {"shard": pa.array(some), "first": pa.array(first[some]), "count": pa.array(counts[some])})

    return deal


def _draw(seed: int):
    """(src, number, blocks, shard, first, count) to one row per slot: src, shard, position, slot, block."""

    def draw(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                number, n = row["number"], row["blocks"]
                slot = np.arange(row["first"], row["first"] + row["count"])
                turns = [_key(number, t, seed) for t in range(int(slot[-1]) // n + 1)]
                block = permuted(slot % n, n, np.array(turns, np.uint64)[slot // n])
                position = _mixed(slot.astype(np.uint64), _key(number, 96, seed)) >> np.uint64(1)
                same = {"src": pa.array([row["src"]] * len(slot), pa.string()), "shard": pa.array(np.full(len(slot), row["shard"]))}
                yield pa.RecordBatch.from_pydict(same | {"position": pa.array(position.astype(np.int64)), "slot": pa.array(slot), "block": pa.array(block)})

    return draw


def _sized(rows: DataFrame, keep: list[str]) -> DataFrame:
    kinds = dict(rows.dtypes)

    def sized(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in pieces(batches):
            first = scan_words(*text_buffer(batch.column("text")))[2]
            yield pa.RecordBatch.from_pydict({c: batch.column(c) for c in keep} | {"size": pa.array(np.diff(first))})

    shape = ", ".join(f"`{c}` {kinds[c]}" for c in keep)
    return rows.mapInArrow(sized, f"{shape}, size bigint")


def _cut(words: int, kinds: dict[str, str]):
    """Rows with text, size, start to one row per piece of a block. The pieces of a text join up to the whole text."""
    keep = ("doc_id", "lang", "source", "n_chars", "src", "start")

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in pieces(batches):
            data, offsets = text_buffer(batch.column("text"))
            starts, _, first = scan_words(data, offsets)
            begin, size = batch.column("start").to_numpy(), np.diff(first)
            head = begin // words
            count = (begin + size - 1) // words - head + 1
            row = np.repeat(np.arange(len(size)), count)
            nth = np.arange(len(row)) - np.repeat(count.cumsum() - count, count)
            block = head[row] + nth
            low = np.maximum(block * words - begin[row], 0)
            high = np.minimum((block + 1) * words - begin[row], size[row])
            place = np.where(nth == 0, offsets[row], starts[np.minimum(first[row] + low, len(starts) - 1)])
            text = pa.LargeStringArray.from_buffers(len(row), pa.py_buffer(np.append(place, len(data)).astype(np.int64)), pa.py_buffer(data))
            out = {c: batch.column(c).take(pa.array(row)) for c in keep}
            out |= {"block": pa.array(block), "first_word": pa.array(low), "words": pa.array(high - low), "piece": text.cast(pa.string())}
            yield pa.RecordBatch.from_pydict(out)

    shape = ", ".join(f"`{c}` {kinds[c]}" for c in keep)
    return cut, f"{shape}, block bigint, first_word bigint, words bigint, piece string"


class Mix:
    """A mix of documents. `places`: one row per document with its source's figures; `slots`: the draw; `rows()`: the mix."""

    def __init__(self, docs: DataFrame, block_words: int = BLOCK_WORDS, shard_slots: int = SHARD_SLOTS, seed: int = SEED, weights: tuple[int, ...] = WEIGHTS):
        self.spark, self.words = docs.sparkSession, block_words
        prepare(self.spark)
        rows = documents(docs).withColumn("_row", row_hash("doc_id", "text", "lang", "source", "n_chars"))
        narrow = stored(_sized(rows.select("doc_id", "source", "_row", "text"), ["doc_id", "source", "_row"]), "sizes")
        totals = narrow.groupBy("source").agg(F.sum("size").alias("size"), F.count("*").alias("rows")).collect()
        totals.sort(key=lambda r: (r.source is None, r.source or ""))
        wanted = targets([r.size for r in totals], weights)
        recipe = [
            ("" if r.source is None else f"={r.source}", i, r.size, float(t), _blocks(r.size, block_words), _slots(r.size, t, block_words, i, seed))
            for i, (r, t) in enumerate(zip(totals, wanted))
        ]
        shape = "src string, number bigint, source_size bigint, target double, blocks bigint, slots bigint"
        self.recipe = self.spark.createDataFrame(recipe, shape)
        self.buckets = max(1, -(-sum(r.rows for r in totals) // BUCKET_ROWS))
        repeated = repeated_rows(narrow)
        self.narrow = self._dealt(with_copies(narrow, repeated))
        shards = max(1, -(-sum(r[5] for r in recipe) // shard_slots))
        deals = "src string, number bigint, blocks bigint, shard bigint, first bigint, count bigint"
        dealt = self.recipe.where("slots > 0").select("src", "number", "blocks", "slots").repartition("src").mapInArrow(_deal(shards, seed), deals)
        drawn = "src string, shard bigint, position bigint, slot bigint, block bigint"
        self.slots = dealt.repartition("src", "shard").mapInArrow(_draw(seed), drawn)
        before = Window.partitionBy("src").orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
        sums = self.narrow.groupBy("src", "_bucket").agg(F.sum("size").alias("_sum"))
        self.base = stored(sums.select("src", "_bucket", F.coalesce(F.sum("_sum").over(before), F.lit(0)).alias("_base")), "mix-base")
        self.docs = with_copies(rows, repeated)
        self.places = self._placed(self.narrow).join(self.recipe.select("src", "source_size", "target"), "src")

    def _dealt(self, rows: DataFrame) -> DataFrame:
        """Rows with the key of their source and their bucket."""
        rows = rows.withColumn("src", F.coalesce(F.concat(F.lit("="), "source"), F.lit("")))
        return rows.withColumn("_bucket", F.pmod(F.col("_row").bitwiseXOR(F.col("_copy")), F.lit(self.buckets)))

    def _placed(self, rows: DataFrame) -> DataFrame:
        before = Window.partitionBy("src", "_bucket").orderBy("_row", "_copy").rowsBetween(Window.unboundedPreceding, -1)
        rows = rows.withColumn("_before", F.coalesce(F.sum("size").over(before), F.lit(0)))
        return rows.join(self.base, ["src", "_bucket"]).withColumn("start", F.col("_base") + F.col("_before"))

    def blocks(self) -> DataFrame:
        """One row per block: src, block and its pieces in order."""
        keep = ["doc_id", "text", "lang", "source", "n_chars", "_row", "_copy"]
        placed = self._placed(self._dealt(_sized(self.docs, keep).where("size > 0")))
        cut, shape = _cut(self.words, dict(placed.dtypes))
        cols = ("doc_id", "text", "lang", "source", "n_chars", "src", "start")
        split = placed.select(*cols).mapInArrow(cut, shape)
        piece = F.struct((F.col("start") + F.col("first_word")).alias("at"), "start", "first_word", "words", "doc_id", "lang", "source", "n_chars", "piece")
        return split.groupBy("src", "block").agg(F.sort_array(F.collect_list(piece)).alias("pieces"))

    def rows(self) -> DataFrame:
        """The mix: one row per slot with shard, position (its order in the shard), src, block and pieces.

        Slots grow with the mix. Their size cannot be told from the few rows they are drawn from, hence the hint:
        they must not be broadcast.
        """
        return self.slots.hint("merge").join(self.blocks(), ["src", "block"])


def taken(mix: Mix) -> DataFrame:
    """One row per document: doc_id, size, source_size, target and taken, counted on the mix itself."""
    pieces_ = mix.rows().select("src", F.explode("pieces").alias("p"))
    counts = pieces_.groupBy("src", F.col("p.start").alias("start")).agg(F.sum("p.words").alias("taken"))
    some = mix.places.where("size > 0").join(counts, ["src", "start"], "left")
    shape = ["doc_id", "size", "source_size", "target", F.coalesce("taken", F.lit(0)).cast("long").alias("taken")]
    none = mix.places.where("size = 0").select(*shape[:-1], F.lit(0).cast("long").alias("taken"))
    return some.select(*shape).union(none)


def mixed_documents(docs: DataFrame, **options) -> DataFrame:
    """The mix as rows with the columns of documents: a row for each piece of a document in a slot."""
    rows = Mix(docs, **options).rows().select(F.explode("pieces").alias("p"))
    return rows.select("p.doc_id", F.col("p.piece").alias("text"), "p.lang", "p.source", F.char_length("p.piece").cast("long").alias("n_chars"))
