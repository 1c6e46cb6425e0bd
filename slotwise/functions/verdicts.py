"""Row-level verdicts: payload shape, resume seam, freshness."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from slotwise.schemas import FRESH_SECONDS, GAP_TOLERANCE_SLOTS, STALE_SECONDS


def payload_shape(lamports: str = "lamports", data_len: str = "data_len") -> Column:
    """ok | closed | impossible_empty. A funded account without a payload is a fault, at any count."""
    return (
        F.when(F.col(data_len) > 0, F.lit("ok"))
        .when(F.col(lamports) == 0, F.lit("closed"))
        .otherwise(F.lit("impossible_empty"))
    )


def is_fault(lamports: str = "lamports", data_len: str = "data_len") -> Column:
    return (F.col(data_len) == 0) & (F.col(lamports) > 0)


def resume_drift(resume_from: str, first_slot: str) -> Column:
    """Slots between the requested and the first delivered one; a replay counts as no drift."""
    return F.when(
        F.col(resume_from).isNotNull(), F.greatest(F.col(first_slot) - F.col(resume_from), F.lit(0))
    )


def resume_verdict(resume_from: str, first_slot: str, tolerance: int = GAP_TOLERANCE_SLOTS) -> Column:
    """not_applicable | clean | gap. Position 0 is a real position, only null means none."""
    drift = resume_drift(resume_from, first_slot)
    return (
        F.when(F.col(resume_from).isNull(), F.lit("not_applicable"))
        .when(drift > tolerance, F.lit("gap"))
        .otherwise(F.lit("clean"))
    )


def seam_reason(drift: Column) -> Column:
    """Reason text of a gap found at a start-up that raised no error."""
    return F.concat(F.lit("silent start-up seam: stream opened "), drift.cast("string"), F.lit(" slots late"))


# Reasons of the gaps that come with an error.
FAILURE_REASONS = {
    "replay_window": "position too old: the source no longer replays it",
    "early_end": "stream broke before its first record",
}


def failure_reason(code: str) -> Column:
    """Reason text of a failure code; an unknown code is its own text."""
    text = F.col(code)
    for name, reason in FAILURE_REASONS.items():
        text = F.when(F.col(code) == name, F.lit(reason)).otherwise(text)
    return text


def freshness_state(
    age_seconds: str, fresh: int = FRESH_SECONDS, stale: int = STALE_SECONDS
) -> Column:
    """fresh | slow | stale | unknown. No reading is `unknown`, which must never be taken for stale."""
    age = F.col(age_seconds)
    return (
        F.when(age.isNull(), F.lit("unknown"))
        .when(age < fresh, F.lit("fresh"))
        .when(age < stale, F.lit("slow"))
        .otherwise(F.lit("stale"))
    )
