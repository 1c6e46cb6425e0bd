"""Token counts (op 5): separator scan over flat, unindexed token files.

A flat file is a stream of 16-bit token ids, in which an end-of-document id follows each document; nothing tells where
documents lie. It is held as blocks of a fixed number of tokens, cut without regard to documents. Each block is searched
for separators with one vectorised comparison. Boundaries are stitched across blocks by a prefix scan over block
summaries (number of separators, last separator): first over groups of GROUP blocks, then within a group, so that one
huge file is not scanned in one task. A document's count is the distance of neighbouring separators.

`write_flat` makes such files from documents under a public tiktoken vocabulary. Beside the blocks it writes only the
order of the ids in each file, no lengths.

Defined results: a null or empty text has no tokens; repeated rows and rows without an id are documents of their own;
a file that does not end in a separator has a last document without one; a vocabulary with ids beyond 16 bits, or that
uses the separator itself, is refused; extra columns are dropped; empty gives none.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from slotwise.llm.common import pick, pieces, prepare, texts
from slotwise.llm.secrets import MAX_VOCABULARY, VOCABULARY, encoding
from slotwise.session import stored, work_dir

BLOCK_TOKENS = 1 << 17
GROUP = 1024
SEPARATOR = 50256  # fixed value: the free id of the 50k vocabulary
_SHAPE = "file bigint, block bigint, data binary, ordinal bigint, doc_id bigint"


def _rows(**columns) -> pa.RecordBatch:
    kinds = {"file": pa.int64(), "block": pa.int64(), "data": pa.binary(), "ordinal": pa.int64(), "doc_id": pa.int64()}
    n = len(next(iter(columns.values())))
    return pa.RecordBatch.from_pydict({k: pa.array(columns[k], t) if k in columns else pa.nulls(n, t) for k, t in kinds.items()})


def write_flat(docs: DataFrame, path: str, vocabulary: str = VOCABULARY, block_tokens: int = BLOCK_TOKENS, separator: int = SEPARATOR) -> None:
    """Write token blocks and the order of ids, one flat file per task, as one Parquet table at `path`."""
    spark = docs.sparkSession
    prepare(spark)
    with open(vocabulary, "rb") as file:
        content = file.read(MAX_VOCABULARY + 1)
    if len(content) > MAX_VOCABULARY:
        raise ValueError(f"{vocabulary} is larger than {MAX_VOCABULARY} bytes")
    ids = encoding(content)._mergeable_ranks.values()
    if max([separator, *ids]) > np.iinfo(np.uint16).max or separator in set(ids):
        raise ValueError(f"{vocabulary}: a flat file holds ids of 16 bits, and the separator {separator} must not be one of the vocabulary")
    shipped = spark.sparkContext.broadcast(content)

    def flat(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokens, file = encoding(shipped.value), TaskContext.get().partitionId()
        rest, block, ordinal = np.zeros(0, np.uint16), 0, 0
        for batch in pieces(batches):
            held = [rest]
            for text in texts(batch.column("text")):
                held.append(np.array([*tokens.encode_ordinary(text), separator], np.uint16))
            rest = np.concatenate(held)
            n = len(rest) // block_tokens
            if n:
                data = [rest[i * block_tokens : (i + 1) * block_tokens].astype("<u2").tobytes() for i in range(n)]
                yield _rows(file=[file] * n, block=range(block, block + n), data=data)
                rest, block = rest[n * block_tokens :], block + n
            ids = batch.column("doc_id")
            yield _rows(file=[file] * len(ids), ordinal=range(ordinal, ordinal + len(ids)), doc_id=ids.to_pylist())
            ordinal += len(ids)
        if len(rest):
            yield _rows(file=[file], block=[block], data=[rest.astype("<u2").tobytes()])

    rows = pick(docs, "doc_id", "text").select(F.col("doc_id").cast("bigint").alias("doc_id"), "text")
    rows.mapInArrow(flat, _SHAPE).write.parquet(path)


def separators(blocks: DataFrame, separator: int = SEPARATOR) -> DataFrame:
    """(file, block, length, marks): tokens of each block and places of its separators."""

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [np.frombuffer(d, "<u2") for d in batch.column("data").to_pylist()]
            marks = pa.array([np.flatnonzero(f == separator).astype(np.int32) for f in found], pa.list_(pa.int32()))
            length = pa.array([len(f) for f in found], pa.int64())
            yield pa.RecordBatch.from_pydict({"file": batch.column("file"), "block": batch.column("block"), "length": length, "marks": marks})

    return blocks.select("file", "block", "data").mapInArrow(search, "file bigint, block bigint, length bigint, marks array<int>")


def _before(kind, column: str, *keys: str, order: str):
    """A running figure over all earlier rows."""
    rows = Window.partitionBy(*keys).orderBy(order).rowsBetween(Window.unboundedPreceding, -1)
    return kind(column).over(rows)


def document_counts(blocks: DataFrame, separator: int = SEPARATOR, group: int = GROUP) -> DataFrame:
    """(file, ordinal, start, n_tokens) of every document of every file."""
    # Written once: the scan below needs the marks in several places, and the blocks are to be searched a single time.
    found = stored(separators(blocks, separator), "separators").withColumn("part", F.floor(F.col("block") / group))
    n = F.size("marks").cast("long").alias("n")
    last = F.when(F.size("marks") > 0, F.element_at("marks", -1)).cast("long").alias("last")
    short = found.select("file", "part", "block", "length", n, last)
    groups = short.groupBy("file", "part").agg(F.sum("length").alias("length"), F.sum("n").alias("n"))
    groups = groups.select(
        "file",
        "part",
        F.coalesce(_before(F.sum, "length", "file", order="part"), F.lit(0)).alias("tokens0"),
        F.coalesce(_before(F.sum, "n", "file", order="part"), F.lit(0)).alias("n0"),
    )
    # Absolute places: a block's first token is the sum of the lengths before it.
    placed = short.join(groups, ["file", "part"])
    placed = placed.withColumn("begin", F.col("tokens0") + F.coalesce(_before(F.sum, "length", "file", "part", order="block"), F.lit(0)))
    placed = placed.withColumn("first", F.col("n0") + F.coalesce(_before(F.sum, "n", "file", "part", order="block"), F.lit(0)))
    placed = placed.withColumn("mark", F.col("begin") + F.col("last"))
    ends = placed.groupBy("file", "part").agg(F.max("mark").alias("mark"))
    ends = ends.select("file", "part", F.coalesce(_before(F.max, "mark", "file", order="part"), F.lit(-1)).alias("carry0"))
    placed = placed.join(ends, ["file", "part"])
    carry = F.coalesce(_before(F.max, "mark", "file", "part", order="block"), "carry0")
    placed = placed.select("file", "block", "begin", "first", carry.alias("carry"), "length", "n", "mark")
    joined = found.select("file", "block", "marks").join(placed, ["file", "block"])
    each = joined.select("file", "begin", "first", "carry", "marks", F.posexplode("marks").alias("i", "at"))
    previous = F.when(F.col("i") == 0, F.col("carry")).otherwise(F.col("begin") + F.element_at("marks", F.greatest("i", F.lit(1))))
    out = each.select("file", (F.col("first") + F.col("i")).alias("ordinal"), (previous + 1).alias("start"), (F.col("begin") + F.col("at") - previous - 1).alias("n_tokens"))
    tail = placed.groupBy("file").agg(F.sum("n").alias("ordinal"), (F.coalesce(F.max("mark"), F.lit(-1)) + 1).alias("start"), F.sum("length").alias("tokens"))
    tail = tail.where("tokens > start").select("file", "ordinal", "start", (F.col("tokens") - F.col("start")).alias("n_tokens"))
    return out.union(tail)


def token_counts(docs: DataFrame, vocabulary: str = VOCABULARY, block_tokens: int = BLOCK_TOKENS) -> DataFrame:
    """doc_id and n_tokens of every document, read off flat token files written to the shared folder."""
    spark = docs.sparkSession
    path = work_dir(spark, "tokens")
    write_flat(docs, path, vocabulary, block_tokens)
    table = spark.read.schema(_SHAPE).parquet(path)
    counts = document_counts(table.where("block is not null"))
    order = table.where("ordinal is not null").select("file", "ordinal", "doc_id")
    return order.join(counts, ["file", "ordinal"]).select("doc_id", "n_tokens")
