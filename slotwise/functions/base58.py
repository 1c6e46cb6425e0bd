"""Base58 text of binary keys, as Arrow-batched functions over whole arrays.

Spark has no base conversion beyond 64 bits. Both directions here are one matrix product per batch plus
a carry pass, so no row is handled on its own. Render late: on the rows a query returns, not on its input.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Fixed value: the digits of base 58, in order.
ALPHABET = "123456789ABCDEFGHJKLMNPQRSTUVWXYZabcdefghijkmnopqrstuvwxyz"

KEY_SIZE = 32
TEXT_SIZE = 44  # digits that 32 bytes can need


def _power_digits(base: int, count: int, target: int, width: int) -> np.ndarray:
    """Row i holds base**i in `target` digits, least significant first."""
    rows = np.zeros((count, width), dtype=np.int64)
    for i in range(count):
        value = base**i
        for j in range(width):
            value, rows[i, j] = divmod(value, target)
    return rows


def _carry(digits: np.ndarray, base: int) -> np.ndarray:
    """Normalise least-significant-first digits; returns what is left over above the last one."""
    over = np.zeros(len(digits), dtype=np.int64)
    for j in range(digits.shape[1]):
        over, digits[:, j] = np.divmod(digits[:, j] + over, base)
    return over


def encode_keys(keys: pd.Series) -> pd.Series:
    out = pd.Series([None] * len(keys), dtype=object)
    valid = np.array([k is not None and len(k) == KEY_SIZE for k in keys], dtype=bool)
    if valid.any():
        raw = np.frombuffer(b"".join(bytes(k) for k in keys[valid]), dtype=np.uint8).reshape(-1, KEY_SIZE)
        digits = raw[:, ::-1].astype(np.int64) @ _power_digits(256, KEY_SIZE, 58, TEXT_SIZE)
        _carry(digits, 58)
        text = np.frombuffer(ALPHABET.encode(), dtype="S1")[digits[:, ::-1]]
        # Each leading zero byte is one leading "1"; the number itself has no leading zero digits.
        zeros = np.where(raw.any(axis=1), (raw != 0).argmax(axis=1), KEY_SIZE)
        skipped = np.where(digits.any(axis=1), (digits[:, ::-1] != 0).argmax(axis=1), TEXT_SIZE)
        lines = [row.tobytes().decode() for row in text]
        out[valid] = ["1" * z + line[s:] for line, z, s in zip(lines, zeros, skipped)]
    return out


def decode_keys(texts: pd.Series) -> pd.Series:
    """32-byte keys; null for text that is not the base58 form of exactly 32 bytes."""
    out = pd.Series([None] * len(texts), dtype=object)
    lookup = np.full(256, -1, dtype=np.int64)
    lookup[np.frombuffer(ALPHABET.encode(), dtype=np.uint8)] = np.arange(58)
    clean = [t if t is not None and 0 < len(t) <= TEXT_SIZE and t.isascii() else None for t in texts]
    index = np.array([i for i, t in enumerate(clean) if t is not None], dtype=np.int64)
    if len(index):
        padded = b"".join(clean[i].rjust(TEXT_SIZE, "1").encode() for i in index)
        digits = lookup[np.frombuffer(padded, dtype=np.uint8)].reshape(-1, TEXT_SIZE)
        known = (digits >= 0).all(axis=1)
        limbs = np.where(digits < 0, 0, digits)[:, ::-1] @ _power_digits(58, TEXT_SIZE, 256, KEY_SIZE + 1)
        over = _carry(limbs, 256)
        fits = (over == 0) & (limbs[:, KEY_SIZE] == 0)
        raw = limbs[:, KEY_SIZE - 1 :: -1].astype(np.uint8)
        zeros = np.where(raw.any(axis=1), (raw != 0).argmax(axis=1), KEY_SIZE)
        ones = np.array([len(clean[i]) - len(clean[i].lstrip("1")) for i in index])
        for row, i in enumerate(index):
            if known[row] and fits[row] and zeros[row] == ones[row]:
                out[i] = raw[row].tobytes()
    return out


@F.pandas_udf(T.StringType())
def base58_encode(keys: pd.Series) -> pd.Series:
    return encode_keys(keys.reset_index(drop=True))


@F.pandas_udf(T.BinaryType())
def base58_decode(texts: pd.Series) -> pd.Series:
    return decode_keys(texts.reset_index(drop=True))


def readable(df, column: str = "pubkey") -> Column:
    """Base58 for binary keys; columns of any other type are already readable."""
    if isinstance(df.schema[column].dataType, T.BinaryType):
        return base58_encode(F.col(column))
    return F.col(column)


def register(spark) -> None:
    """Make `base58(key)` callable from SQL."""
    spark.udf.register("base58", base58_encode)
