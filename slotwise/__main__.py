"""Commands over the cold copy and the load jobs: python -m slotwise <command> --dir <folder> ...

Under spark-submit the session and its settings come from the cluster.
"""

from __future__ import annotations

import argparse

from pyspark.sql import DataFrame, SparkSession

from slotwise.functions.layouts import KNOWN_LAYOUTS, load_layouts
from slotwise.plans import activity, quality
from slotwise.session import clear_work, ship_package
from slotwise.sources import cold, state_dump, updates

# The command names of cold queries.
COLD_COMMANDS = {
    "gaps": lambda tables: quality.derive_gaps(tables["account_updates"]),
    "activity": lambda tables: activity.activity(tables["account_updates"]),
    "hot-accounts": lambda tables: activity.hot_accounts(tables["account_updates"]),
}


def cold_command(spark: SparkSession, folder: str, name: str, statement: str | None = None) -> DataFrame:
    """Result of one cold query by name; `sql` runs a statement of one's own."""
    if name == "sql":
        if not statement:
            raise ValueError('sql takes a statement: sql "SELECT ..."')
        return cold.query_cold(spark, folder, statement)
    if name not in COLD_COMMANDS:
        raise ValueError(f"unknown command {name!r}; known are {', '.join([*COLD_COMMANDS, 'sql'])}")
    tables, notes = cold.read_cold(spark, folder)
    for note in notes:
        print("note:", note)
    return COLD_COMMANDS[name](tables)


def print_all(rows: DataFrame) -> None:
    """Every row as tab-separated text, fetched one partition at a time."""
    print("\t".join(rows.columns))
    for row in rows.toLocalIterator():
        print("\t".join("" if v is None else str(v) for v in row))


def main(argv: list[str] | None = None) -> None:
    parser = argparse.ArgumentParser(prog="slotwise", description=__doc__)
    parser.add_argument("command", help="gaps | activity | hot-accounts | sql | export | load-dump")
    parser.add_argument("statement", nargs="?", help="SQL text for sql")
    parser.add_argument("--dir", default="./parquet", help="folder of the cold copy")
    parser.add_argument("--store", help="folder of the bronze and silver tables (export, load-dump)")
    parser.add_argument("--full", action="store_true", help="export: rewrite closed buckets too")
    parser.add_argument("--pages", help="load-dump: folder of JSON pages")
    parser.add_argument("--scope", default="known", choices=state_dump.SCOPES)
    parser.add_argument("--layouts", help="load-dump: JSON file that completes the record layouts")
    args = parser.parse_args(argv)

    spark = SparkSession.builder.appName("slotwise").getOrCreate()
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    ship_package(spark)
    if args.command == "export":
        for table in cold.COLD_TABLES:
            result = cold.export_cold(updates.read_table(spark, args.store, table), args.dir, table, args.full)
            print(f"{table}: wrote {len(result.buckets)} buckets, skipped {len(result.skipped)}")
    elif args.command == "load-dump":
        layouts = load_layouts(open(args.layouts).read()) if args.layouts else KNOWN_LAYOUTS
        state_dump.store_state_dump(spark, args.pages, args.store, layouts, args.scope).show(truncate=False)
    else:
        print_all(cold_command(spark, args.dir, args.command, args.statement))
    clear_work(spark)


if __name__ == "__main__":
    main()
