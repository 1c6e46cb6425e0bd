"""The published dashboard: a fixed set of named queries in one JSON document."""

from __future__ import annotations

import json
from collections.abc import Callable
from datetime import datetime, timezone

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from slotwise.plans import activity, health, summary

def dashboard_queries(tables: dict[str, DataFrame], as_of) -> dict[str, Callable[[], DataFrame]]:
    """Everything the dashboard can ask, by name. No SQL is built from a request."""
    updates, snapshots, reserves = tables["account_updates"], tables["obligation_snapshots"], tables["reserve_snapshots"]
    return {
        "overview": lambda: health.overview(reserves, snapshots),
        "risk": lambda: health.risk_radar(snapshots),
        "reserves": lambda: activity.liquidity_depth(reserves),
        "flow": lambda: activity.flow(updates, as_of),
        "system": lambda: summary.system_status(
            updates, snapshots, reserves, tables["ingest_checkpoint"], tables["slot_gaps"], as_of
        ),
    }


def dashboard_document(spark: SparkSession, queries: dict[str, Callable[[], DataFrame]], as_of=None) -> str:
    """Run the queries in sequence; any failure fails the whole document. Each query bounds its own rows.

    The document is dated `as_of`, or now.
    """
    made = datetime.now(timezone.utc).isoformat(timespec="milliseconds") if as_of is None else str(as_of)
    document: dict[str, object] = {"generated_at": made}
    for name, query in queries.items():
        line = F.to_json(F.struct("*"), {"ignoreNullFields": "false"}).alias("line")
        document[name] = [json.loads(row.line) for row in query().select(line).collect()]
    return json.dumps(document)


def read_section(document: DataFrame, name: str, schema: T.StructType) -> DataFrame:
    """The rows of one section of a document, under the schema of its query."""
    rows = F.from_json(F.get_json_object("value", f"$.{name}"), T.ArrayType(schema))
    return document.select(F.inline(rows))


def export_dashboard(spark: SparkSession, queries: dict[str, Callable[[], DataFrame]], out: str, as_of=None) -> DataFrame:
    """Write the document once, complete, to the folder `out`; returns it as a one-row frame."""
    text = dashboard_document(spark, queries, as_of)
    document = spark.range(1).select(F.lit(text).alias("value"))
    document.write.mode("overwrite").text(out)
    return document
