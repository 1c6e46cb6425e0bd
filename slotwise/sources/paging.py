"""Seek paging over stored files: each page opens only the files that can hold it.

A zone list has the first and last version key and the row count of every file. It is made by one narrow scan and
stored. A page after a cursor opens the files whose zones come next, finds the page's keys from the key columns alone,
and reads whole rows for these keys only. Files may overlap, and a file whose zone begins inside the page is opened as
well, so that pages always concatenate to the whole.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from slotwise.operators.dedup import collapse
from slotwise.operators.ordering import page_after
from slotwise.session import stored

ORDER = ("slot", "write_version", "pubkey")
FILES_AT_ONCE = 64  # zones looked at for a page before more are fetched


@dataclass
class Pages:
    """Pages of the rows below `path` in the order of their version keys, replays collapsed."""

    spark: SparkSession
    path: str
    schema: T.StructType
    columns: Sequence[str]
    zones: DataFrame | None = None
    opened: list[int] = field(default_factory=list)  # files opened for each page so far

    def __post_init__(self):
        if self.zones is None:
            self.zones = stored(zone_list(self.spark, self.path, self.schema), "zones")

    def page(self, after: Sequence | None, size: int = 1000) -> DataFrame:
        """The next `size` rows after the version key `after` (None: from the start)."""
        first, last = F.struct(*[F.col(f"first.{c}") for c in ORDER]), F.struct(*[F.col(f"last.{c}") for c in ORDER])
        left = self.zones
        if after is not None:
            cursor = F.struct(*[F.lit(v).cast(self.schema[c].dataType).alias(c) for c, v in zip(ORDER, after)])
            left = left.filter(last > cursor)
        wanted = FILES_AT_ONCE
        while True:
            # The next zones in order; one more than are used, to know where the first unopened file begins.
            next_files = left.orderBy(first, "file").limit(wanted + 1).collect()
            use, rows = 0, 0
            # A file before the cursor may have few rows left, so only later ones count towards the page.
            while use < len(next_files) and use < wanted and (use == 0 or rows < size):
                zone = next_files[use]
                rows += zone.rows if after is None or tuple(zone.first) > tuple(after) else 0
                use += 1
            found = self._keys([z.file for z in next_files[:use]], after, size)
            while use < len(next_files) and use < wanted and (len(found) < size or tuple(next_files[use].first) < found[-1]):
                use += 1
                while use < len(next_files) and use < wanted and len(found) == size and tuple(next_files[use].first) < found[-1]:
                    use += 1
                found = self._keys([z.file for z in next_files[:use]], after, size)
            beyond = use < len(next_files) and (len(found) < size or tuple(next_files[use].first) < found[-1])
            if not beyond or use < wanted:
                break
            wanted *= 4
        self.opened.append(use)
        return self._rows([z.file for z in next_files[:use]], found)

    def _read(self, files: list[str]) -> DataFrame:
        return self.spark.read.schema(self.schema).parquet(*files)

    def _keys(self, files: list[str], after: Sequence | None, size: int) -> list[tuple]:
        """Version keys of the page, as far as these files hold it: at most `size`, from the key columns alone."""
        if not files:
            return []
        keys = self._read(files).select(*ORDER).distinct()
        return [tuple(r) for r in page_after(keys, ORDER, after, size).collect()]

    def _rows(self, files: list[str], keys: list[tuple]) -> DataFrame:
        columns = list(dict.fromkeys([*ORDER, *self.columns]))
        if not keys:
            return self.spark.createDataFrame([], T.StructType([self.schema[c] for c in columns])).select(*self.columns)
        wanted = self.spark.createDataFrame(keys, T.StructType([self.schema[c] for c in ORDER]))
        rows = self._read(files).filter(F.col("slot").between(keys[0][0], keys[-1][0]))
        mine = rows.join(F.broadcast(wanted), list(ORDER), "left_semi")  # at most a page of keys
        return collapse(mine, columns=columns).orderBy(*ORDER).select(*self.columns)


def zone_list(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """file, rows, first and last version key of every file below `path`."""
    rows = spark.read.schema(schema).option("recursiveFileLookup", "true").parquet(path)
    key = F.struct(*ORDER)
    zones = rows.select(F.col("_metadata.file_path").alias("file"), key.alias("key")).groupBy("file")
    return zones.agg(F.count(F.lit(1)).alias("rows"), F.min("key").alias("first"), F.max("key").alias("last"))
