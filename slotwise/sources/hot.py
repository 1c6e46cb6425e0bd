"""The hot copy: the same history ordered by key, beside the stored one that is ordered by slot.

A key's rows lie in one of `buckets` folders, chosen by its hash, sorted by (pubkey, slot, write_version), and every
file has a Bloom filter on `pubkey`. The history or the newest state of one key thus opens one folder, and in it only
the row groups that hold the key. The copy takes over batches of the stored tables one by one and never has fewer rows
than its record of them says: rows first, then the record. A hot key does not make a hot file: a folder's rows
are split by size, and each of the files is sorted.
"""

from __future__ import annotations

from functools import reduce
from urllib.parse import unquote

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from slotwise.operators.dedup import collapse, latest
from slotwise.schemas import SCHEMAS, VERSION_KEY
from slotwise.session import tidy
from slotwise.sources.updates import COMPACTED, held, plain_bytes, read_filed, with_late_columns

KEY_BUCKET = "key_bucket"
KEY_BUCKETS = 256
_TAKEN = "_taken"  # what has been copied: not a folder of a table


def key_bucket(key: Column | str = "pubkey", buckets: int = KEY_BUCKETS) -> Column:
    """Folder of a key. Of a literal key it is a constant, which prunes folders."""
    return F.pmod(F.xxhash64(key), F.lit(buckets)).cast("int")


def write_hot(rows: DataFrame, out: str, table: str, batch: str, buckets: int = KEY_BUCKETS) -> None:
    """File rows under the buckets of their keys as one batch, in place of an earlier attempt at it."""
    placed = rows.withColumn(KEY_BUCKET, key_bucket(buckets=buckets)).withColumn("batch_id", F.lit(batch))
    placed = placed.hint("rebalance", KEY_BUCKET).sortWithinPartitions(KEY_BUCKET, "batch_id", *VERSION_KEY)
    writer = plain_bytes(placed).mode("overwrite").option("partitionOverwriteMode", "dynamic")
    writer = writer.option("parquet.bloom.filter.enabled#pubkey", "true")
    with tidy(rows.sparkSession):
        writer.partitionBy(KEY_BUCKET, "batch_id").parquet(f"{out}/{table}")


def read_hot(spark: SparkSession, out: str, table: str, schema: T.StructType | None = None) -> DataFrame:
    """Rows of the hot copy with their key bucket."""
    fields = [*(schema or SCHEMAS[table]).fields, T.StructField(KEY_BUCKET, T.IntegerType()), T.StructField("batch_id", T.StringType())]
    return spark.read.schema(T.StructType(fields)).parquet(f"{out}/{table}")


def _exists(spark: SparkSession, path: str) -> bool:
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    return place.getFileSystem(spark._jsc.hadoopConfiguration()).exists(place)


def refresh_hot(spark: SparkSession, root: str, table: str, out: str, buckets: int = KEY_BUCKETS) -> list[str]:
    """Take over the batches of a stored table that the copy does not hold yet; returns their names.

    A merged batch holds rows of batches that may have been taken before; of it, only unknown version keys are taken. These
    are found from the keys alone, so that payloads which the copy holds already are neither read nor moved.
    """
    taken = f"{out}/{_TAKEN}/{table}"
    filed = read_filed(spark, root, table)
    # Spark has listed the folders, which tell the names without a scan.
    names = {unquote(f.rsplit("/batch_id=", 1)[1].split("/", 1)[0]) for f in filed.inputFiles()}
    if _exists(spark, taken):
        names -= {r.batch_id for r in spark.read.schema("batch_id string").parquet(taken).collect()}
    new = sorted(names)
    if not new:
        return []
    columns = SCHEMAS[table].fieldNames()
    rows = filed.filter(F.col("batch_id").isin(new)).select(*columns)
    merged = [n for n in new if n.startswith(COMPACTED)]
    if merged and _exists(spark, f"{out}/{table}"):
        again, fresh = filed.filter(F.col("batch_id").isin(merged)).select(*columns), [n for n in new if n not in merged]
        # Rows under the name of this attempt are of an earlier attempt, which this one replaces.
        known = read_hot(spark, out, table).filter(F.col("batch_id") != new[0])
        with held(_by_key(again.select(*VERSION_KEY), known, "left_anti").distinct(), "unknown") as unknown:
            parts = [_by_key(again, unknown, "left_semi")] if unknown.head(1) else []
            parts += [filed.filter(F.col("batch_id").isin(fresh)).select(*columns)] if fresh else []
            if parts:
                write_hot(reduce(DataFrame.unionByName, parts), out, table, new[0], buckets)
    else:
        write_hot(rows, out, table, new[0], buckets)
    # The name depends on what is taken, so a second attempt replaces the first.
    spark.createDataFrame([(n,) for n in new], "batch_id string").coalesce(1).write.mode("append").parquet(taken)
    return new


def _by_key(rows: DataFrame, other: DataFrame, how: str) -> DataFrame:
    """Semi or anti join by version key; a missing part of a key equals a missing one.

    The number that tells most keys apart comes first: sorting compares it without looking at the rest.
    """
    other = other.select(*[F.col(c).alias(f"__{c}") for c in VERSION_KEY])
    return rows.join(other, reduce(Column.__and__, [F.col(c).eqNullSafe(F.col(f"__{c}")) for c in reversed(VERSION_KEY)]), how)


def rows_of_key(spark: SparkSession, out: str, table: str, key, schema: T.StructType | None = None, buckets: int = KEY_BUCKETS) -> DataFrame:
    """All stored rows of one key, replays included: one folder is listed, and Bloom filters skip the other row groups."""
    fields = schema or SCHEMAS[table]
    wanted = F.lit(key).cast(fields["pubkey"].dataType)
    rows = read_hot(spark, out, table, fields)
    rows = rows.filter((F.col(KEY_BUCKET) == key_bucket(wanted, buckets)) & (F.col("pubkey") == wanted))
    rows = rows.select(*fields.fieldNames())
    return rows if schema else with_late_columns(rows, table)


def key_history(spark: SparkSession, out: str, table: str, key, columns: list[str], schema: T.StructType | None = None, buckets: int = KEY_BUCKETS) -> DataFrame:
    """All versions of one key in order, replays collapsed."""
    mine = rows_of_key(spark, out, table, key, schema, buckets)
    wanted = list(dict.fromkeys([*VERSION_KEY, *columns]))
    return collapse(mine, columns=wanted).orderBy("slot", "write_version").select(*columns)


def key_state(spark: SparkSession, out: str, table: str, key, columns: list[str], schema: T.StructType | None = None, buckets: int = KEY_BUCKETS) -> DataFrame:
    """The newest state of one key: at most one row."""
    return latest(rows_of_key(spark, out, table, key, schema, buckets), columns)
