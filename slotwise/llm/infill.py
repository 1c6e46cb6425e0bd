"""Fill-in-the-middle examples (op 11): every text is cut into prefix, middle and suffix between two units.

A unit is a run of the letters A-Z and a-z, or any other single code point. One Arrow batch goes through a pipeline of
`pyarrow.compute` calls: texts are split into lists of units, the lists are flattened beside the numbers of their rows,
each unit gets its ordinal, units are filtered by their role, and every role is rebuilt into lists whose units
`binary_join` puts together again. No step loops over rows or units in Python.

Where the cuts fall, and which form a row takes, follows from the SHA-256 of `<salt>:<doc_id>` alone, so a lost task or
a second run gives the same examples. A text that holds a marker stays plain, so an example can always be taken apart.

Defined results: a null or empty text is a plain, empty example; a null id is hashed as the empty string, and repeated
rows give repeated examples; extra columns are dropped; an empty table gives no rows. Memory is bounded by a batch of
PIECE_BYTES of text or one longer text.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from slotwise.llm.common import pick, pieces, prepare

# The markers, and the pattern of a unit over UTF-8 bytes.
PREFIX, SUFFIX, MIDDLE = "<P>", "<S>", "<M>"
UNIT = rb"[A-Za-z]+|[\x00-\x7f]|[\xc0-\xff][\x80-\xbf]*"
CUT = b"\xff"  # a byte that UTF-8 never holds
PLAIN_PERCENT, SPM_PERCENT = 10, 20


def units(texts: pa.Array) -> pa.Array:
    """Lists of units, with one empty element at the end of each list."""
    marked = pc.replace_substring_regex(texts.cast(pa.large_binary()), pattern=UNIT, replacement=rb"\0" + CUT)
    return pc.split_pattern(marked, pattern=CUT)


def _joined(values: pa.Array, lengths: pa.Array) -> pa.Array:
    """The next `lengths[i]` values joined into text i."""
    ends = pc.cumulative_sum(lengths).cast(pa.int64())
    lists = pa.LargeListArray.from_arrays(pa.concat_arrays([pa.array([0], pa.int64()), ends]), values)
    return pc.binary_join(lists, pa.scalar(b"", values.type)).cast(pa.large_string())


def parts(texts: pa.Array, first: pa.Array, second: pa.Array) -> tuple[pa.Array, pa.Array, pa.Array, pa.Array]:
    """Number of units of every text, and its prefix, middle and suffix; `first` and `second` are drawn numbers."""
    lists = units(texts)
    count = pc.subtract(pc.list_value_length(lists).cast(pa.int64()), 1)
    slots = np.asarray(count) + 1
    a, b = np.asarray(first) % slots, np.asarray(second) % slots
    low, high = pa.array(np.minimum(a, b)), pa.array(np.maximum(a, b))
    values, parent = pc.list_flatten(lists), pc.list_parent_indices(lists)
    start = pa.array(np.cumsum(slots) - slots)
    ordinal = pc.subtract(pa.array(np.arange(len(values), dtype=np.int64)), start.take(parent))
    after_low = pc.greater_equal(ordinal, low.take(parent))
    after_high = pc.greater_equal(ordinal, high.take(parent))
    real = pc.less(ordinal, count.take(parent))
    roles = (
        (pc.invert(after_low), low),
        (pc.and_not(after_low, after_high), pc.subtract(high, low)),
        (pc.and_(after_high, real), pc.subtract(count, high)),
    )
    return count, *[_joined(values.filter(role), length) for role, length in roles]


def _examples(plain_percent: int, spm_percent: int):
    def made(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in pieces(batches):
            text = pc.fill_null(batch.column("text"), "").cast(pa.large_string())
            count, prefix, middle, suffix = parts(text, batch.column("h1"), batch.column("h2"))
            third, fourth = (np.asarray(batch.column(h)) % 100 for h in ("h3", "h4"))
            marked = [pc.match_substring(text, m) for m in (PREFIX, SUFFIX, MIDDLE)]
            plain = pc.or_(pc.or_(pc.equal(count, 0), pa.array(third >= 100 - plain_percent)), pc.or_(marked[0], pc.or_(marked[1], marked[2])))
            spm = pa.array(fourth < spm_percent)
            one, two, three, none = (pa.scalar(m, pa.large_string()) for m in (PREFIX, SUFFIX, MIDDLE, ""))
            psm_text = pc.binary_join_element_wise(one, prefix, two, suffix, three, middle, none)
            spm_text = pc.binary_join_element_wise(two, suffix, one, prefix, three, middle, none)
            nothing = pa.scalar(None, pa.int64())
            yield pa.RecordBatch.from_pydict(
                {
                    "doc_id": batch.column("doc_id"),
                    "n": count,
                    "form": pc.if_else(plain, "plain", pc.if_else(spm, "spm", "psm")),
                    "output": pc.if_else(plain, text, pc.if_else(spm, spm_text, psm_text)).cast(pa.string()),
                    "prefix_chars": pc.if_else(plain, nothing, pc.utf8_length(prefix).cast(pa.int64())),
                    "middle_chars": pc.if_else(plain, nothing, pc.utf8_length(middle).cast(pa.int64())),
                }
            )

    return made


def examples(docs: DataFrame, salt: str = "1", plain_percent: int = PLAIN_PERCENT, spm_percent: int = SPM_PERCENT) -> DataFrame:
    """doc_id, n (units), form (plain, psm, spm), output (the example), prefix_chars and middle_chars of every document."""
    prepare(docs.sparkSession)
    rows = pick(docs, "doc_id", "text")
    digest = F.sha2(F.concat(F.lit(f"{salt}:"), F.coalesce(F.col("doc_id").cast("string"), F.lit(""))).cast("binary"), 256)
    drawn = [F.conv(F.substring(digest, 8 * i + 1, 8), 16, 10).cast("long").alias(f"h{i + 1}") for i in range(4)]
    kind = dict(rows.dtypes)["doc_id"]
    shape = f"doc_id {kind}, n bigint, form string, output string, prefix_chars bigint, middle_chars bigint"
    return rows.select("doc_id", "text", *drawn).mapInArrow(_examples(plain_percent, spm_percent), shape)


def _between(texts: pa.Array, first: str, second: str, third: str) -> list[pa.Array]:
    """What follows each of the three markers, in a text that begins with the first of them."""
    rest, found = pc.utf8_slice_codeunits(texts, start=len(first)), []
    for marker in (second, third):
        split = pc.split_pattern(rest, marker, max_splits=1)
        found.append(pc.list_element(split, 0))
        rest = pc.list_element(split, 1)
    return [*found, rest]


def restored(made: DataFrame) -> DataFrame:
    """The rows of `examples` with `restored`, the text rebuilt from `output` and `form` alone."""

    def back(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in pieces(batches, "output"):
            output, form = batch.column("output").cast(pa.large_string()), np.asarray(batch.column("form"))
            plain, psm, spm = (pa.array(np.flatnonzero(form == f)) for f in ("plain", "psm", "spm"))
            told = [output.take(plain)]
            prefix, suffix, middle = _between(output.take(psm), PREFIX, SUFFIX, MIDDLE)
            told.append(pc.binary_join_element_wise(prefix, middle, suffix, pa.scalar("", pa.large_string())))
            suffix, prefix, middle = _between(output.take(spm), SUFFIX, PREFIX, MIDDLE)
            told.append(pc.binary_join_element_wise(prefix, middle, suffix, pa.scalar("", pa.large_string())))
            order = np.argsort(np.concatenate([np.asarray(plain), np.asarray(psm), np.asarray(spm)]), kind="stable")
            text = pa.concat_arrays(told).take(pa.array(order)).cast(pa.string())
            yield pa.RecordBatch.from_arrays([*batch.columns, text], names=[*batch.schema.names, "restored"])

    shape = ", ".join(f"{c} {k}" for c, k in made.dtypes)
    return made.mapInArrow(back, f"{shape}, restored string")
