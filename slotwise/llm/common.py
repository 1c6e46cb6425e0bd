"""What several operators share: column picking, Arrow text buffers, word scanning, session settings."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from slotwise.session import ship_package, stored

DOCUMENT_COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")
# White space of the word pattern, as bytes.
SPACES = b"\x20\x09\x0a\x0b\x0c\x0d"
WORD = r"[^\x20\x09-\x0D]+"

# Texts of one Arrow batch that numpy works on at a time. A longer single text is a piece of its own.
PIECE_BYTES = 8 << 20
# Rows of an Arrow batch: texts can be long, so batches are short.
BATCH_ROWS = "500"

_IS_SPACE = np.zeros(256, bool)
_IS_SPACE[list(SPACES)] = True


def prepare(spark: SparkSession) -> None:
    """Ship the package to the executors and keep Arrow batches of texts small."""
    ship_package(spark)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", BATCH_ROWS)


def read(spark: SparkSession, sf: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/{table}.parquet")


def pick(df: DataFrame, *names: str) -> DataFrame:
    """The named columns by their exact names. Extra columns are dropped, also those that differ in case only."""
    places = {name: i for i, name in reversed(list(enumerate(df.columns)))}
    plain = df.toDF(*[f"c{i}" for i in range(len(df.columns))])
    return plain.select(*[F.col(f"c{places[name]}").alias(name) for name in names])


def documents(df: DataFrame) -> DataFrame:
    return pick(df, *DOCUMENT_COLUMNS)


def row_hash(*columns: str):
    """A 64-bit hash that tells rows of one id apart; equal for fully equal rows only (up to collisions)."""
    return F.xxhash64(*columns, *[F.col(c).isNull() for c in columns])


COPIES_AT_ONCE = 1000


def repeated_rows(rows: DataFrame) -> DataFrame:
    """(_row, _copies) of the row hashes that occur more than once in rows with a `_row`, stored."""
    counts = rows.groupBy("_row").agg(F.count("*").alias("_copies"))
    return stored(counts.where("_copies > 1"), "repeated")


def with_copies(rows: DataFrame, repeated: DataFrame) -> DataFrame:
    """The rows with `_copy`, which numbers fully equal rows from 0.

    Equal rows cannot be told apart, so one of them stands for all and is copied again as often as it occurs, some
    copies at a time: neither the counting nor the copying of a very frequent row is the work of one task.
    """
    if repeated.isEmpty():
        return rows.withColumn("_copy", F.lit(0).cast("long"))
    single = rows.join(repeated, "_row", "left_anti").select(*rows.columns).withColumn("_copy", F.lit(0).cast("long"))
    chosen = rows.join(repeated, "_row").dropDuplicates(["_row"])
    chunks = chosen.withColumn("_chunk", F.explode(F.sequence(F.lit(0).cast("long"), F.expr(f"(_copies - 1) div {COPIES_AT_ONCE}"))))
    copies = F.sequence(F.col("_chunk") * COPIES_AT_ONCE, F.least((F.col("_chunk") + 1) * COPIES_AT_ONCE, "_copies") - 1)
    return single.union(chunks.repartition("_row", "_chunk").select(*rows.columns, F.explode(copies).alias("_copy")))


def pieces(batches: Iterator[pa.RecordBatch], column: str = "text") -> Iterator[pa.RecordBatch]:
    """The batches cut into slices of about PIECE_BYTES of text, so that working memory stays bounded."""
    for batch in batches:
        if not batch.num_rows:
            continue
        offsets = text_buffer(batch.column(column))[1]
        at = 0
        while at < batch.num_rows:
            end = int(np.searchsorted(offsets, offsets[at] + PIECE_BYTES, side="right")) - 1
            end = min(max(end, at + 1), batch.num_rows)
            yield batch.slice(at, end - at)
            at = end


def text_buffer(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The UTF-8 bytes of a text column and the offsets of its rows; a null text is empty."""
    if column.null_count:
        column = pc.fill_null(column, "")
    wide = pa.types.is_large_string(column.type)
    offsets = np.frombuffer(column.buffers()[1], np.int64 if wide else np.int32)[column.offset : column.offset + len(column) + 1]
    offsets = offsets.astype(np.int64)
    data = column.buffers()[2]
    bytes_ = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return bytes_[offsets[0] : offsets[-1]], offsets - offsets[0]


def scan_words(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Byte bounds of every word and, for each row, the number of its first word (one more entry at the end).

    White space is ASCII, so its bytes never occur inside a longer UTF-8 character.
    """
    if not len(data):
        return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(len(offsets), np.int64)
    word = ~_IS_SPACE[data]
    before = np.empty_like(word)
    before[0] = False
    before[1:] = word[:-1]
    after = np.empty_like(word)
    after[-1] = False
    after[:-1] = word[1:]
    edges = offsets[:-1][offsets[:-1] < offsets[1:]]
    before[edges] = False
    after[edges[1:] - 1] = False
    starts = np.flatnonzero(word & ~before)
    ends = np.flatnonzero(word & ~after) + 1
    return starts, ends, np.searchsorted(starts, offsets)


def texts(column: pa.Array) -> list[str]:
    return [t or "" for t in column.to_pylist()]
