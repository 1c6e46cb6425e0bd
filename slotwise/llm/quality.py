"""Quality rules (op 7): hard rules, then gradient-boosted trees over document statistics.

Statistics are counted over whole texts, in Arrow batches. The trees are fitted on the driver on at most `sample_rows`
labelled documents (drawn by id hash, so reruns agree), flattened into numpy arrays and shipped with the scoring
function. The score never rises with the share of symbols, of repeated lines, of repeated words or of upper case.
The cut-off is the score below which only `clean_loss` of the sampled good documents lie.

Defined results: a null or blank text has no words and fails the base rules; repeated rows and rows without an id are
each judged alone; extra columns are dropped; without labels of both classes the base rules decide alone; an empty
table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from slotwise.llm.boosting import Trees, fit
from slotwise.llm.common import SPACES, pick, pieces, prepare, text_buffer

# The base rules.
MIN_WORDS = 20
MAX_REPEAT_PERCENT = 30
WINDOW = 8
SYMBOLS = b"#*$%&|<>"

SAMPLE_ROWS = 4000
CLEAN_LOSS = 0.002

COUNTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
FEATURES = ("words", "word_length", "symbols", "dup_lines", "repeat_words", "upper", "digits", "distinct_words", "line_words", "long_words", "closed_lines")
MONOTONE = (0, 0, -1, -1, -1, -1, 0, 0, 0, 0, 0)
_UPPER = bytes(range(65, 91))
_DIGITS = b"0123456789"
_TABLE = np.random.default_rng(11).integers(1, 2**63, WINDOW, dtype=np.uint64) | np.uint64(1)


def repeated_words(words: list[bytes]) -> int:
    """Words in windows of eight that occur twice or more in the text, the first occurrence included."""
    n = len(words) - WINDOW + 1
    if n < 2:
        return 0
    ids = np.fromiter(map(hash, words), np.int64, len(words)).view(np.uint64)
    ids ^= ids >> np.uint64(29)
    key = np.zeros(n, np.uint64)
    for i in range(WINDOW):
        key += ids[i : i + n] * _TABLE[i]
    order = np.argsort(key, kind="stable")
    same = key[order[1:]] == key[order[:-1]]
    if not same.any():
        return 0
    twice = np.zeros(n, bool)
    twice[order[1:][same]] = True
    twice[order[:-1][same]] = True
    change = np.zeros(len(words) + 1, np.int64)
    at = np.flatnonzero(twice)
    np.add.at(change, at, 1)
    np.add.at(change, at + WINDOW, -1)
    return int((change.cumsum()[:-1] > 0).sum())


def describe(text: bytes) -> tuple[list[int], list[float]]:
    """The counts of the contract and the features of the trees."""
    words = text.split()
    n = len(words)
    solid = text.translate(None, SPACES)
    chars = len(solid) if solid.isascii() else len(solid.decode("utf-8"))
    symbols = len(text) - len(text.translate(None, SYMBOLS))
    lines = [line for line in text.split(b"\n") if line.split(None, 1)]
    dup = len(lines) - len(set(lines))
    repeat = repeated_words(words)
    upper = len(solid) - len(solid.translate(None, _UPPER))
    digits = len(solid) - len(solid.translate(None, _DIGITS))
    closed = sum(line.rstrip().endswith((b".", b"!", b"?", b'"')) for line in lines)
    some, rows = max(n, 1), max(len(lines), 1)
    features = [
        np.log1p(n),
        chars / some,
        symbols / some,
        dup / rows,
        repeat / some,
        upper / some,
        digits / some,
        len(set(words)) / some,
        n / rows,
        sum(len(w) > 20 for w in words) / some,
        closed / rows,
    ]
    return [n, chars, symbols, dup, repeat], features


def _described(batch: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray]:
    data, offsets = text_buffer(batch.column("text"))
    whole = data.tobytes()
    counts, features = zip(*(describe(whole[a:b]) for a, b in zip(offsets[:-1], offsets[1:])))
    return np.array(counts, np.int64).reshape(-1, len(COUNTS)), np.array(features, float).reshape(-1, len(FEATURES))


def _base_failed(counts: np.ndarray) -> np.ndarray:
    return (counts[:, 0] < MIN_WORDS) | (100 * counts[:, 4] > MAX_REPEAT_PERCENT * counts[:, 0])


@dataclass
class QualityModel:
    trees: Trees
    cut: float  # log-odds below which a document is dropped

    def keeps(self, features: np.ndarray) -> np.ndarray:
        return self.trees.score(features) >= self.cut


def train(docs: DataFrame, labels: DataFrame, sample_rows: int = SAMPLE_ROWS, clean_loss: float = CLEAN_LOSS) -> QualityModel:
    """Fit on at most `sample_rows` labelled documents. Rows without id or label are no examples."""
    prepare(docs.sparkSession)
    good = pick(labels, "doc_id", "quality").where("doc_id is not null and quality in (0, 1)")
    good = good.groupBy("doc_id").agg(F.min("quality").alias("quality"))
    chosen = good.orderBy(F.xxhash64("doc_id"), "doc_id").limit(sample_rows)
    rows = pick(docs, "doc_id", "text").join(F.broadcast(chosen), "doc_id")  # at most sample_rows rows

    def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in pieces(batches):
            counts, features = _described(batch)
            out = {"quality": batch.column("quality"), "failed": pa.array(_base_failed(counts))}
            out["features"] = pa.array(list(features), pa.list_(pa.float64()))
            yield pa.RecordBatch.from_pydict(out)

    found = rows.mapInArrow(measure, "quality int, failed boolean, features array<double>").where("not failed")
    # A repeated id may bring more rows than labels: the bound holds for them too.
    sample = found.orderBy(F.xxhash64("features"), "features", "quality").limit(sample_rows).collect()
    x = np.array([r.features for r in sample], float).reshape(-1, len(FEATURES))
    y = np.array([r.quality for r in sample], float)
    trees = fit(x, y, np.array(MONOTONE))
    clean = np.sort(trees.score(x[y == 1]))
    if len(clean) == len(y) or not len(clean):
        return QualityModel(trees, -np.inf)
    return QualityModel(trees, min(0.0, float(clean[int(clean_loss * len(clean))])))


def judge(docs: DataFrame, model: QualityModel) -> DataFrame:
    """Documents with their counts, `base_failed`, `score` and `kept`."""
    prepare(docs.sparkSession)
    rows = pick(docs, "doc_id", "text", *[c for c in ("lang", "source", "n_chars") if c in docs.columns])
    kinds = dict(rows.dtypes)
    shape = ", ".join([f"`{c}` {kinds[c]}" for c in rows.columns] + [f"{c} bigint" for c in COUNTS])

    def judged(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in pieces(batches):
            counts, features = _described(batch)
            failed = _base_failed(counts)
            out = {name: batch.column(name) for name in batch.schema.names}
            out |= {name: pa.array(counts[:, i]) for i, name in enumerate(COUNTS)}
            out |= {"base_failed": pa.array(failed), "score": pa.array(model.trees.score(features)), "kept": pa.array(~failed & model.keeps(features))}
            yield pa.RecordBatch.from_pydict(out)

    return rows.mapInArrow(judged, f"{shape}, base_failed boolean, score double, kept boolean")
