"""Session settings and the shared work folder."""

from __future__ import annotations

import os
import shutil
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import SparkSession

# Results of slot arithmetic and time columns do not depend on the machine's zone.
SESSION_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
    "spark.ui.enabled": "false",
}


def local_session(cpus: int | str = "*", app: str = "slotwise", memory: str = "8g") -> SparkSession:
    """A local session for tests and the bench. On a cluster the caller brings the session."""
    builder = SparkSession.builder.master(f"local[{cpus}]").appName(app)
    builder = builder.config("spark.sql.shuffle.partitions", "8").config("spark.driver.memory", memory)
    for key, value in SESSION_CONF.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


_OWN_ROOTS: dict[str, str] = {}


def shared_dir(spark: SparkSession) -> str:
    """Folder that driver and executors all see: `spark.checkpoint.dir` when the cluster names one.

    Only a local session without that setting (tests, single-machine runs) gets a folder of its own.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        app = spark.sparkContext.applicationId
        if app not in _OWN_ROOTS:
            _OWN_ROOTS[app] = tempfile.mkdtemp(prefix="slotwise-")
        root = _OWN_ROOTS[app]
    return root.rstrip("/")


def work_dir(spark: SparkSession, purpose: str) -> str:
    """A new, unused path below the shared folder."""
    return f"{shared_dir(spark)}/slotwise/{spark.sparkContext.applicationId}/{purpose}-{uuid.uuid4().hex}"


def clear_work(spark: SparkSession) -> None:
    """Delete this application's intermediate tables, once no frame that reads them is needed any more."""
    path = spark._jvm.org.apache.hadoop.fs.Path(f"{shared_dir(spark)}/slotwise/{spark.sparkContext.applicationId}")
    path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def delete(spark: SparkSession, path: str) -> None:
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    place.getFileSystem(spark._jsc.hadoopConfiguration()).delete(place, True)


_DROP_SHUFFLES = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


@contextmanager
def tidy(spark: SparkSession) -> Iterator[None]:
    """Inside, the shuffle files of a query are deleted when it ends. Otherwise they stay until the driver happens to collect garbage."""
    before = spark.conf.get(_DROP_SHUFFLES, None)
    spark.conf.set(_DROP_SHUFFLES, "true")
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(_DROP_SHUFFLES)
        else:
            spark.conf.set(_DROP_SHUFFLES, before)


def stored(df, purpose: str = "stored"):
    """Write `df` to a new folder in the shared place and read it back, for results read more than once."""
    path = work_dir(df.sparkSession, purpose)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


_SHIPPED: set[str] = set()


def ship_package(spark: SparkSession) -> None:
    """Make this package importable on the executors, once per application; the same as --py-files."""
    app = spark.sparkContext.applicationId
    if app not in _SHIPPED:
        here = os.path.dirname(os.path.abspath(__file__))
        base = os.path.join(tempfile.mkdtemp(prefix="slotwise-package-"), "slotwise")
        spark.sparkContext.addPyFile(shutil.make_archive(base, "zip", os.path.dirname(here), "slotwise"))
        _SHIPPED.add(app)
