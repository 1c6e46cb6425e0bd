"""Tables, keys and the fixed values shared by all jobs."""

from __future__ import annotations

from pyspark.sql import types as T

# --- fixed values -----------------------------------------------------------------------------
# Account structures whose 8-byte tag can be named: tag = first 8 bytes of sha256("account:<Name>").
TAGGED_KINDS = (
    "Reserve",
    "Obligation",
    "LendingMarket",
    "ReferrerTokenState",
    "UserMetadata",
    "ReferrerState",
    "ShortUrl",
    "GlobalConfig",
)
DECODED_KINDS = ("Obligation", "Reserve", "LendingMarket")
TAG_BYTES = 8
KEY_BYTES = 32

SLOTS_PER_BUCKET = 1_000_000  # cold layout
SLOTS_PER_HOT_BUCKET = 10_000_000  # bronze layout
BUCKET_COLUMN = "slot_bucket"
BUCKET_DIGITS = 12
MILLIS_PER_SLOT = 400

GAP_TOLERANCE_SLOTS = 600
ALARM_EVERY = 500

NO_DEBT = 18446744073709551615  # 2^64 - 1
HEALTH_SCALE = 1_000_000
AT_RISK_HEALTH = 1_050_000
RADAR_HEALTH = 2_000_000
FRACTION_BITS = 60
MAX_FRACTION = 10**38 - 1

FRESH_SECONDS = 120
STALE_SECONDS = 900
HEALTH_CHECK_SECONDS = 300

STATE_DUMP_WRITE_VERSION = 0
DEFAULT_STREAM = "main"
# ----------------------------------------------------------------------------------------------

U64 = T.DecimalType(20, 0)
U128 = T.DecimalType(38, 0)


def _schema(*columns: tuple[str, T.DataType]) -> T.StructType:
    return T.StructType([T.StructField(name, kind, True) for name, kind in columns])


# --- fixed values: columns, keys and late columns of the data model ----------------------------
SCHEMAS: dict[str, T.StructType] = {
    "account_updates": _schema(
        ("slot", T.LongType()),
        ("write_version", T.LongType()),
        ("pubkey", T.BinaryType()),
        ("kind", T.StringType()),
        ("owner", T.BinaryType()),
        ("lamports", T.LongType()),
        ("data", T.BinaryType()),
        ("data_len", T.LongType()),
        ("ingested_at", T.TimestampType()),
    ),
    "ingest_checkpoint": _schema(
        ("stream", T.StringType()),
        ("last_slot", T.LongType()),
        ("last_write_version", T.LongType()),
        ("updated_at", T.TimestampType()),
    ),
    "obligation_snapshots": _schema(
        ("slot", T.LongType()),
        ("write_version", T.LongType()),
        ("pubkey", T.BinaryType()),
        ("owner", T.BinaryType()),
        ("lending_market", T.BinaryType()),
        ("num_deposits", T.ShortType()),
        ("num_borrows", T.ShortType()),
        ("health_factor_bps", U64),
        ("flags", T.ShortType()),
        ("elevation_group", T.ShortType()),
        ("referrer", T.BinaryType()),
        ("ingested_at", T.TimestampType()),
        ("deposited_value_sf", U128),
        ("borrowed_value_sf", U128),
        ("borrow_factor_adjusted_debt_sf", U128),
        ("allowed_borrow_value_sf", U128),
        ("unhealthy_borrow_value_sf", U128),
        ("lowest_deposit_liquidation_ltv", U64),
    ),
    "slot_gaps": _schema(
        ("stream", T.StringType()),
        ("start_slot", T.LongType()),
        ("end_slot", T.LongType()),
        ("detected_at", T.TimestampType()),
        ("filled", T.ShortType()),
        ("reason", T.StringType()),
        ("ingested_at", T.TimestampType()),
    ),
    "lending_market_snapshots": _schema(
        ("slot", T.LongType()),
        ("write_version", T.LongType()),
        ("pubkey", T.BinaryType()),
        ("owner", T.BinaryType()),
        ("quote_currency", T.BinaryType()),
        ("flags", T.ShortType()),
        ("referral_fee_bps", T.IntegerType()),
        ("liquidation_max_debt_close_factor_pct", T.ShortType()),
        ("name", T.BinaryType()),
        ("ingested_at", T.TimestampType()),
    ),
    "reserve_snapshots": _schema(
        ("slot", T.LongType()),
        ("write_version", T.LongType()),
        ("pubkey", T.BinaryType()),
        ("lending_market", T.BinaryType()),
        ("liquidity_mint", T.BinaryType()),
        ("supply_vault", T.BinaryType()),
        ("fee_vault", T.BinaryType()),
        ("available_amount", U64),
        ("borrowed_amount_sf", U128),
        ("market_price_sf", U128),
        ("mint_decimals", T.LongType()),
        ("acc_protocol_fees_sf", U128),
        ("acc_referrer_fees_sf", U128),
        ("ingested_at", T.TimestampType()),
    ),
    "snapshot_runs": _schema(
        ("slot", T.LongType()),
        ("scope", T.StringType()),
        ("accounts", T.LongType()),
        ("rows_written", T.LongType()),
        ("decode_failures", T.LongType()),
        ("duration_ms", T.LongType()),
        ("ingested_at", T.TimestampType()),
    ),
}

VERSION_KEY = ("pubkey", "slot", "write_version")

# Full key and version column of each table. A version column inside its own key would always tie.
TABLE_KEYS: dict[str, tuple[tuple[str, ...], str]] = {
    "account_updates": (VERSION_KEY, "ingested_at"),
    "obligation_snapshots": (VERSION_KEY, "ingested_at"),
    "lending_market_snapshots": (VERSION_KEY, "ingested_at"),
    "reserve_snapshots": (VERSION_KEY, "ingested_at"),
    "ingest_checkpoint": (("stream",), "updated_at"),
    "slot_gaps": (("stream", "start_slot"), "ingested_at"),
    "snapshot_runs": (("slot", "scope"), "ingested_at"),
}

# Columns added after the first rows were written; files without them read as 0.
LATE_COLUMNS: dict[str, tuple[str, ...]] = {
    "obligation_snapshots": (
        "deposited_value_sf",
        "borrowed_value_sf",
        "borrow_factor_adjusted_debt_sf",
        "allowed_borrow_value_sf",
        "unhealthy_borrow_value_sf",
        "lowest_deposit_liquidation_ltv",
    ),
}

SILVER_TABLE = {
    "Obligation": "obligation_snapshots",
    "Reserve": "reserve_snapshots",
    "LendingMarket": "lending_market_snapshots",
}
# ----------------------------------------------------------------------------------------------
