"""The change stream from stored segments: a stream source of its own, by Spark's Python data source interface.

A segment is a finished Parquet file of wire records, in a flat folder or filed by buckets of slots as the raw table is.
Spark's own file stream takes files by age and reads whole files; this source takes them by slot, opens only what can
hold the wanted slots, and leaves out other kinds before rows reach Spark. Spark hands no filters to a Python stream
reader, so the first slot and the kinds are options:

* `startSlot`, inclusive: folders of lower buckets are not listed, row groups that end below it are not read.
* `kinds`, comma-separated: records of other tags are dropped where the row group is read.
* `rowsPerBatch`: files are taken in order of their first slot until they hold so many rows. Without it a batch takes all
  that is there, which a run with `availableNow` needs, as Spark asks such a source only once.

Every batch is a list of row groups, written to the folder `log` before Spark learns of its offset, which is the number
of the list. A list is never changed, so that a batch that is tried again reads the same rows. A file is new as long as no
list names it: one that appears late, with slots far below those already delivered, is delivered like any other.

Defined results: a file without rows, or with none at or above `startSlot`, is passed over; records without a slot are
delivered only without `startSlot`, those without a payload only without `kinds`; missing columns read as null. A file that
is gone before its batch is read is an error, never a gap; merged copies of files (`updates.compact`) count as new files,
whose rows arrive once more. A log that was made with another `startSlot` is refused.
"""

from __future__ import annotations

import json
from collections.abc import Iterator

import pyarrow as pa
import pyarrow.compute as pc
import pyarrow.parquet as pq
from pyarrow import fs as pafs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.datasource import DataSource, DataSourceStreamReader, InputPartition
from pyspark.sql.pandas.types import to_arrow_schema

from slotwise.functions.kinds import tag_hex
from slotwise.functions.slots import bucket_name
from slotwise.schemas import BUCKET_COLUMN, SLOTS_PER_HOT_BUCKET, TAG_BYTES
from slotwise.session import ship_package
from slotwise.sources.updates import WIRE_SCHEMA

NAME = "slot_segments"
SPLIT_BYTES = 128 << 20  # of row groups that one task reads
BATCH_ROWS = 1024  # held at once by a task
_LIST = "list-{:012d}.json"


def _open(path: str) -> tuple[pafs.FileSystem, str]:
    """File system and path; a path without a scheme is a local one."""
    if "://" in path or path.startswith("file:"):
        return pafs.FileSystem.from_uri(path)
    return pafs.LocalFileSystem(), path


class Segments(DataSource):
    @classmethod
    def name(cls) -> str:
        return NAME

    def schema(self):
        return WIRE_SCHEMA

    def streamReader(self, schema) -> "SegmentReader":
        return SegmentReader(dict(self.options))


class RowGroups(InputPartition):
    """Row groups of one file, for one task."""

    def __init__(self, file: str, groups: list[int]):
        super().__init__((file, tuple(groups)))
        self.file, self.groups = file, groups


class SegmentReader(DataSourceStreamReader):
    def __init__(self, options: dict[str, str]):
        given = {k.lower(): v for k, v in options.items()}
        if "path" not in given or "log" not in given:
            raise ValueError("name the folder of segments (path) and a folder for the lists of batches (log)")
        self.path, self.log = given["path"].rstrip("/"), given["log"].rstrip("/")
        self.start_slot = int(given["startslot"]) if given.get("startslot") else None
        self.limit = int(given["rowsperbatch"]) if given.get("rowsperbatch") else None
        self.tags = [bytes.fromhex(tag_hex(k.strip())) for k in given["kinds"].split(",")] if given.get("kinds") else None
        self.listed: int | None = None  # number of the newest list; None until the log was read
        self.named: set[str] = set()  # files that any list names
        self.footers: dict[str, dict] = {}  # of files that no list names yet

    # --- on the driver ---

    def initialOffset(self) -> dict:
        return {"list": 0}

    def latestOffset(self) -> dict:
        self._read_log()
        batch = self._next_batch()
        if batch:
            self._write_list(self.listed + 1, batch)
            self.listed += 1
            self.named.update(entry["file"] for entry in batch)
            for entry in batch:
                self.footers.pop(entry["file"], None)
        return {"list": self.listed}

    def partitions(self, start: dict, end: dict) -> list[RowGroups]:
        out = []
        for number in range(start["list"] + 1, end["list"] + 1):
            for entry in self._read_list(number):
                held, size = [], 0
                for group, bytes_ in entry["groups"]:
                    if held and size + bytes_ > SPLIT_BYTES:
                        out.append(RowGroups(entry["file"], held))
                        held, size = [], 0
                    held, size = [*held, group], size + bytes_
                out.append(RowGroups(entry["file"], held))
        return out

    def _files(self) -> list[str]:
        """Segments that no list names, below the folder; buckets before the first slot are left out by their names."""
        system, root = _open(self.path)
        top = system.get_file_info(pafs.FileSelector(root, allow_not_found=True))
        first = None if self.start_slot is None else f"{BUCKET_COLUMN}={bucket_name(self.start_slot, SLOTS_PER_HOT_BUCKET)}"
        found = []
        for info in top:
            hidden = info.base_name.startswith(("_", "."))
            early = first is not None and info.base_name.startswith(f"{BUCKET_COLUMN}=") and info.base_name < first
            if hidden or early:
                continue
            if info.type == pafs.FileType.Directory:
                found.extend(system.get_file_info(pafs.FileSelector(info.path, recursive=True)))
            else:
                found.append(info)
        names = (i.path[len(root.rstrip("/")) + 1 :] for i in found if i.type == pafs.FileType.File and i.path.endswith(".parquet"))
        # Files of a job that has not committed lie below folders with hidden names.
        return sorted(n for n in names if n not in self.named and not any(p.startswith(("_", ".")) for p in n.split("/")))

    def _next_batch(self) -> list[dict]:
        """Entries of the next list: new files in the order of their first slot, up to the limit of rows."""
        files = self._files()
        self.footers = {f: self.footers[f] if f in self.footers else self._footer(f) for f in files}
        ready = sorted((self.footers[f] for f in files if self.footers[f]["groups"]), key=lambda e: (e["first_slot"], e["file"]))
        batch, rows = [], 0
        for entry in ready:
            if batch and self.limit is not None and rows + entry["rows"] > self.limit:
                break
            batch.append(entry)
            rows += entry["rows"]
        return batch

    def _footer(self, file: str) -> dict:
        """The row groups of a file that can hold the wanted slots, by their stored bounds, which may be lacking."""
        system, root = _open(self.path)
        with system.open_input_file(f"{root}/{file}") as source:
            meta = pq.read_metadata(source)
        names = [meta.schema.column(i).path for i in range(meta.num_columns)]
        groups, rows, first = [], 0, None
        for g in range(meta.num_row_groups):
            group = meta.row_group(g)
            stats = group.column(names.index("slot")).statistics if "slot" in names else None
            low, high = (stats.min, stats.max) if stats is not None and stats.has_min_max else (None, None)
            if group.num_rows == 0 or (self.start_slot is not None and high is not None and high < self.start_slot):
                continue
            groups.append([g, group.total_byte_size])
            rows += group.num_rows
            first = low if first is None else min(first, low if low is not None else first)
        return {"file": file, "groups": groups, "rows": rows, "first_slot": -1 if first is None else first}

    def _read_log(self) -> None:
        if self.listed is not None:
            return
        system, root = _open(self.log)
        system.create_dir(root, recursive=True)
        numbers = [int(i.base_name[5:-5]) for i in system.get_file_info(pafs.FileSelector(root)) if i.base_name.startswith("list-")]
        for number in sorted(numbers):
            self.named.update(entry["file"] for entry in self._read_list(number))
        self.listed = max(numbers, default=0)

    def _read_list(self, number: int) -> list[dict]:
        system, root = _open(self.log)
        with system.open_input_stream(f"{root}/{_LIST.format(number)}") as source:
            content = json.loads(source.read())
        if content["start_slot"] != self.start_slot:
            raise ValueError(f"{self.log} was made with start slot {content['start_slot']}, not {self.start_slot}")
        return content["files"]

    def _write_list(self, number: int, files: list[dict]) -> None:
        """A list shows under its name only when it is whole."""
        system, root = _open(self.log)
        name = _LIST.format(number)
        with system.open_output_stream(f"{root}/_{name}") as sink:
            sink.write(json.dumps({"start_slot": self.start_slot, "files": files}).encode())
        system.move(f"{root}/_{name}", f"{root}/{name}")

    # --- in the tasks ---

    def read(self, partition: RowGroups) -> Iterator[pa.RecordBatch]:
        schema = to_arrow_schema(WIRE_SCHEMA)
        system, root = _open(self.path)
        with system.open_input_file(f"{root}/{partition.file}") as source:
            file = pq.ParquetFile(source)
            there = [f.name for f in schema if f.name in file.schema_arrow.names]
            for batch in file.iter_batches(BATCH_ROWS, row_groups=partition.groups, columns=there):
                rows = pa.Table.from_batches([batch])
                if self.start_slot is not None:
                    rows = rows.filter(pc.greater_equal(rows["slot"], self.start_slot)) if "slot" in there else rows.slice(0, 0)
                if self.tags is not None:
                    rows = rows.filter(self._wanted(rows)) if "data" in there else rows.slice(0, 0)
                if not rows.num_rows:
                    continue
                columns = [rows[f.name].cast(f.type) if f.name in there else pa.nulls(rows.num_rows, f.type) for f in schema]
                yield from pa.Table.from_arrays(columns, schema=schema).to_batches()

    def _wanted(self, rows: pa.Table) -> pa.ChunkedArray:
        tags = pc.binary_slice(rows["data"].cast(pa.binary()), 0, TAG_BYTES)
        return pc.is_in(tags, value_set=pa.array(self.tags, pa.binary()))


def read_segments_stream(
    spark: SparkSession, path: str, log: str, start_slot: int | None = None, kinds=None, rows_per_batch: int | None = None
) -> DataFrame:
    """Streaming wire records from the segments below `path`; `log` belongs to one stream and outlives its restarts."""
    ship_package(spark)
    spark.dataSource.register(Segments)
    options = {"path": path, "log": log, "startSlot": start_slot, "rowsPerBatch": rows_per_batch, "kinds": ",".join(kinds) if kinds is not None else None}
    return spark.readStream.format(NAME).options(**{k: str(v) for k, v in options.items() if v is not None}).load()
