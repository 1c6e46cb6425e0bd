"""Exact unsigned integers, fixed-point values and the figures derived from them."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

from slotwise.schemas import FRACTION_BITS, HEALTH_SCALE, KEY_BYTES, NO_DEBT


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def whole(value: int) -> Column:
    """Decimal literal; integers beyond 2^63 have no other exact form."""
    return F.expr(f"{value}BD")


def parse_fraction(text: str) -> Column:
    """Unsigned decimal text as decimal(38,0); anything else, and anything above 10^38 - 1, is null."""
    # try_cast alone would round "1.5" and accept "-1".
    return F.when(F.col(text).rlike(r"^\+?[0-9]+$"), F.expr(f"try_cast({text} as decimal(38,0))"))


def fraction_error(text: str, field: str, slot: str = "slot") -> Column:
    """Why `parse_fraction` rejects a value, naming field and slot; null when it does not."""
    return F.when(
        parse_fraction(text).isNull(),
        F.concat(
            F.lit(f"{field} at slot "),
            F.col(slot).cast("string"),
            F.when(F.coalesce(F.col(text), F.lit("")).rlike(r"^\+?[0-9]+$"), F.lit(" exceeds 10^38 - 1: "))
            .otherwise(F.lit(" is not an unsigned integer: ")),
            F.coalesce(F.col(text), F.lit("null")),
        ),
    )


def fraction(value) -> Column:
    """Fixed-point number as a double. Stored values stay raw; this is for the query edge only."""
    return _col(value).cast("double") / F.pow(F.lit(2.0), F.lit(FRACTION_BITS))


def health_factor(deposited, adjusted_debt, has_debt=None) -> Column:
    """Truncated deposited * 10^6 / debt as decimal(20,0); the no-debt value when there is none.

    Subtracting the remainder first makes the decimal division exact, so nothing is rounded, and the
    try_ forms turn an overflow into null instead of a failed job. `health_overflow` flags those rows.
    """
    debt = _col(adjusted_debt).cast("decimal(38,0)")
    no_debt = debt == 0
    if has_debt is not None:
        no_debt = no_debt | (_col(has_debt) == 0)
    scaled = F.try_multiply(_col(deposited).cast("decimal(38,0)"), whole(HEALTH_SCALE))
    scaled = scaled.cast("decimal(38,0)")
    divisor = F.nullif(debt, whole(0).cast("decimal(38,0)"))
    quotient = F.try_divide(scaled - scaled % divisor, divisor)
    return F.when(no_debt, whole(NO_DEBT)).otherwise(quotient.try_cast("decimal(20,0)"))


def active_debt(health: str = "health_factor_bps") -> Column:
    """Rows that state a usable health factor: not the no-debt value and not zero."""
    value = F.col(health)
    return (value != whole(NO_DEBT)) & (value > 0)


def health_ratio(health: str = "health_factor_bps") -> Column:
    """Health as a double, null when there is no debt."""
    return F.when(active_debt(health), F.col(health).cast("double") / HEALTH_SCALE)


def pack_flags(*bits: Column) -> Column:
    """Bit i is set where the i-th condition holds."""
    parts = [F.when(bit, F.lit(1 << i)).otherwise(F.lit(0)) for i, bit in enumerate(bits)]
    return reduce(lambda a, b: a.bitwiseOR(b), parts).cast("smallint")


def obligation_flags(has_debt, elevation_group, margin_call_started) -> Column:
    return pack_flags(_col(has_debt) != 0, _col(elevation_group) != 0, _col(margin_call_started) != 0)


def market_flags(emergency, autodeleverage, borrow_disabled, immutable) -> Column:
    return pack_flags(*[_col(c) != 0 for c in (emergency, autodeleverage, borrow_disabled, immutable)])


def flag_text(flags, bit: int) -> Column:
    return F.when(_col(flags).bitwiseAND(F.lit(1 << bit)) != 0, F.lit("YES")).otherwise(F.lit("NO"))


def padded_text(value) -> Column:
    """Text from a null-padded fixed-size byte field."""
    return F.regexp_replace(F.decode(_col(value), "UTF-8"), "\\x00", "")


def valid_key(key: str) -> Column:
    return F.coalesce(F.length(key) == KEY_BYTES, F.lit(False))


def key_from_hex(text: str) -> Column:
    """32 bytes from exactly 64 hex digits, else null."""
    return F.when(F.col(text).rlike("^[0-9A-Fa-f]{64}$"), F.unhex(text))


def require_key(key: str, what: str | None = None, slot: str = "slot") -> Column:
    """The key itself; the job fails, naming field and slot, when it is not exactly 32 bytes."""
    message = F.concat(
        F.lit(f"{what or key} at slot "), F.col(slot).cast("string"), F.lit(f" is not {KEY_BYTES} bytes")
    )
    return F.when(valid_key(key), F.col(key)).otherwise(F.raise_error(message).cast("binary"))
