"""The cold copy: collapsed once, sorted by slot, in Hive-style slot buckets."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from slotwise.functions import base58
from slotwise.functions.numbers import require_key
from slotwise.functions.slots import bucket_name, slot_bucket
from slotwise.operators.dedup import collapse
from slotwise.plans.quality import gaps_companion
from slotwise.plans.summary import freeze_manifest
from slotwise.schemas import BUCKET_COLUMN, SCHEMAS, SLOTS_PER_BUCKET, VERSION_KEY
from slotwise.session import stored, tidy
from slotwise.sources.updates import with_late_columns

FILE_ORDER = ("slot", "write_version", "pubkey")
COLD_TABLES = {"account_updates": True, "obligation_snapshots": False}  # name -> required
CELL_SLOTS = 1000
ROWS_PER_FILE = 1_000_000


@dataclass(frozen=True)
class ExportResult:
    table: str
    path: str
    buckets: tuple[str, ...]  # buckets written by this run
    skipped: tuple[str, ...]  # closed buckets that existed


def _folder_exists(spark: SparkSession, path: str) -> bool:
    jvm_path = spark._jvm.org.apache.hadoop.fs.Path(path)
    return jvm_path.getFileSystem(spark._jsc.hadoopConfiguration()).exists(jvm_path)


def existing_buckets(spark: SparkSession, path: str) -> set[str]:
    """Buckets of a cold table, from its folder names alone."""
    jvm_path = spark._jvm.org.apache.hadoop.fs.Path(path)
    fs = jvm_path.getFileSystem(spark._jsc.hadoopConfiguration())
    if not fs.exists(jvm_path):
        return set()
    names = [s.getPath().getName() for s in fs.listStatus(jvm_path) if s.isDirectory()]
    return {n.split("=", 1)[1] for n in names if n.startswith(f"{BUCKET_COLUMN}=")}


def _collapse_once(df: DataFrame, version: str = "ingested_at") -> DataFrame:
    """Collapse wide rows while reading and moving the payload as little as possible.

    A first pass over the key and version columns writes down which keys occur more than once and which
    version wins; one scan of the wide rows then keeps or drops each row. Spark picks the join by the list's
    measured size: a broadcast while it is small, so that wide rows stay where they are, else a sort-merge
    join with skew handling. Keys whose newest version occurs several times go through `collapse`.
    """
    spark, keys = df.sparkSession, list(VERSION_KEY)
    per_version = df.groupBy(*keys, version).agg(F.count(F.lit(1)).alias("n"))
    per_key = per_version.groupBy(*keys).agg(
        F.sum("n").alias("__copies"), F.max(version).alias("__newest"), F.max_by("n", version).alias("__ties")
    )
    # A key without any version cannot be decided here either.
    ties = F.when(F.col("__newest").isNull(), 2).otherwise(F.col("__ties")).alias("__ties")
    repeated = stored(per_key.filter(F.col("__copies") > 1).select(*keys, "__newest", ties), "repeated-keys")
    marked = df.join(repeated, keys, "left")
    decided = F.col("__ties").isNull() | ((F.col("__ties") == 1) & (F.col(version) == F.col("__newest")))
    rows = marked.filter(decided).select(*df.columns)
    tied = repeated.filter(F.col("__ties") > 1)
    if tied.isEmpty():
        return rows
    return rows.unionByName(collapse(df.join(tied, keys, "left_semi"), keys, version))


def _file_plan(df: DataFrame) -> DataFrame:
    """Which file each cell of 1000 slots belongs to, from a scan of the slot column alone.

    Cells of a bucket are filled into files in slot order. A cell that is larger than a file by itself,
    down to a single busy slot, is cut into pieces. Stored, because it is read several times.
    """
    cells = df.groupBy(F.expr(f"slot div {CELL_SLOTS}").alias("__cell")).agg(F.count(F.lit(1)).alias("n"))
    bucket = F.expr(f"__cell div {SLOTS_PER_BUCKET // CELL_SLOTS}")
    filled = F.sum("n").over(Window.partitionBy(bucket).orderBy("__cell"))  # at most 1000 cells
    return stored(
        cells.select(
            "__cell",
            bucket.alias("__bucket"),
            F.floor((filled - F.col("n")) / ROWS_PER_FILE).alias("__file"),
            F.ceil(F.col("n") / ROWS_PER_FILE).alias("__pieces"),
        ),
        "file-plan",
    )


def _lay_out(rows: DataFrame, plan: DataFrame) -> DataFrame:
    """Bring the rows of each file together.

    `repartitionByRange` would do the same, but samples its input first, and with it reads every payload
    a second time.
    """
    placed = rows.withColumn("__cell", F.expr(f"slot div {CELL_SLOTS}")).join(plan, "__cell", "left")
    piece = F.pmod(F.xxhash64("write_version", "pubkey"), F.col("__pieces"))
    return placed.repartition("__bucket", "__file", piece).select(*rows.columns)


def _checked(df: DataFrame) -> DataFrame:
    """The rows; the export fails, naming field and slot, on a null version key or a binary key that is not 32 bytes."""
    for name in VERSION_KEY:
        if isinstance(df.schema[name].dataType, T.BinaryType):
            df = df.withColumn(name, require_key(name))
        else:
            message = F.concat(F.lit(f"{name} is null at slot "), F.coalesce(F.col("slot").cast("string"), F.lit("null")))
            missing = F.raise_error(message).cast(df.schema[name].dataType)
            df = df.withColumn(name, F.when(F.col(name).isNull(), missing).otherwise(F.col(name)))
    return df


def export_cold(df: DataFrame, out: str, table: str = "account_updates", full: bool = False) -> ExportResult:
    """Write or continue the cold copy of a table.

    Without `full`, closed buckets that exist are skipped: the stream only moves forward, so they cannot
    grow. Two are always redone, the newest bucket of the source and the newest one that exists, which
    may have been exported while it was still filling. Files are planned by size, so a bucket that holds
    a large share of all rows becomes several files. Spark's commit protocol publishes each bucket whole.
    """
    with tidy(df.sparkSession):
        return _export(df, out, table, full)


def _export(df: DataFrame, out: str, table: str, full: bool) -> ExportResult:
    spark = df.sparkSession
    path = f"{out}/{table}"
    plan = _file_plan(df)
    numbers = [r.b for r in plan.select(F.col("__bucket").alias("b")).distinct().orderBy("b").collect()]  # one per bucket
    present = [bucket_name(n * SLOTS_PER_BUCKET) for n in numbers]
    if not present:
        return ExportResult(table, path, (), ())
    have = existing_buckets(spark, path)
    skipped = [] if full else [b for b in present[:-1] if b in have and b < max(have)]
    todo = [b for b in present if b not in set(skipped)]
    if skipped:
        df = df.filter(F.expr(f"slot div {SLOTS_PER_BUCKET}").isin([int(b) // SLOTS_PER_BUCKET for b in todo]))

    (
        _lay_out(_collapse_once(_checked(df)), plan)
        .withColumn(BUCKET_COLUMN, slot_bucket())
        .sortWithinPartitions(BUCKET_COLUMN, *FILE_ORDER)
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .option("compression", "zstd")
        .option("parquet.compression.codec.zstd.level", "3")
        .partitionBy(BUCKET_COLUMN)
        .parquet(path)
    )
    if full:
        # Only now do buckets go that the source no longer has; a failed export leaves the old copy whole.
        for bucket in sorted(have - set(present)):
            place = spark._jvm.org.apache.hadoop.fs.Path(f"{path}/{BUCKET_COLUMN}={bucket}")
            place.getFileSystem(spark._jsc.hadoopConfiguration()).delete(place, True)
    return ExportResult(table, path, tuple(todo), tuple(skipped))


def cold_schema(schema: T.StructType) -> T.StructType:
    """The bucket must be declared as text: inference turns the padded number into an integer."""
    fields = [f for f in schema.fields if f.name != BUCKET_COLUMN]
    return T.StructType([*fields, T.StructField(BUCKET_COLUMN, T.StringType())])


def read_cold_table(spark: SparkSession, out: str, table: str, schema: T.StructType | None = None) -> DataFrame:
    rows = spark.read.schema(cold_schema(schema or SCHEMAS[table])).parquet(f"{out}/{table}")
    return with_late_columns(rows, table) if schema is None else rows


def read_cold(
    spark: SparkSession, out: str, schemas: dict[str, T.StructType] | None = None, tables: dict[str, bool] | None = None
) -> tuple[dict[str, DataFrame], list[str]]:
    """Register every cold table as a view, with `base58` for SQL. Returns (tables, notes on absent ones)."""
    base58.register(spark)
    found, notes = {}, []
    for table, required in (tables or COLD_TABLES).items():
        path = f"{out}/{table}"
        if not _folder_exists(spark, path):
            if required:
                raise FileNotFoundError(f"no cold table at {path}; run export_cold first")
            notes.append(f"{table} is not registered: nothing at {path}")
            continue
        found[table] = read_cold_table(spark, out, table, (schemas or {}).get(table))
        found[table].createOrReplaceTempView(table)
    return found, notes


def query_cold(spark: SparkSession, out: str, statement: str, schemas: dict[str, T.StructType] | None = None) -> DataFrame:
    """Any SQL statement over the cold tables."""
    read_cold(spark, out, schemas)
    try:
        return spark.sql(statement)
    except AnalysisException as error:
        raise ValueError(f"cannot plan the statement: {error}") from error


def write_manifest(updates: DataFrame, snapshots: DataFrame, path: str) -> DataFrame:
    """Write the one-row description of a frozen dataset as JSON and return it."""
    freeze_manifest(updates, snapshots).coalesce(1).write.mode("overwrite").json(path)
    return updates.sparkSession.read.schema(
        "last_slot bigint, account_updates_rows bigint, last_ingested_ms bigint, obligations_distinct bigint, obligation_snapshots_rows bigint"
    ).json(path)


def write_gaps(updates: DataFrame, path: str) -> DataFrame:
    """Write the companion table of holes and return it as read back."""
    holes = gaps_companion(updates)
    holes.write.mode("overwrite").parquet(path)
    return updates.sparkSession.read.schema(holes.schema).parquet(path)


def exported_rows(spark: SparkSession, result: ExportResult) -> DataFrame:
    """Rows of a cold table per bucket, as one frame of (slot_bucket, exported_rows)."""
    rows = spark.read.schema(cold_schema(T.StructType([T.StructField("slot", T.LongType())]))).parquet(result.path)
    return rows.groupBy(BUCKET_COLUMN).agg(F.count(F.lit(1)).alias("exported_rows"))

