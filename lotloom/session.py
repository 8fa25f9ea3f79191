"""Session settings, table loading and shared scratch storage."""

from __future__ import annotations

import os
import uuid

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.pandas.types import to_arrow_schema

#: What a stand-alone session starts with; a cluster's own settings win.
DEFAULTS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


def local_session(cores: int | str = "*", partitions: int = 8, **conf: str) -> SparkSession:
    """A local session for tests and the bench."""
    builder = SparkSession.builder.master(f"local[{cores}]").appName("lotloom")
    builder = builder.config("spark.driver.memory", os.environ.get("LOTLOOM_DRIVER_MEMORY", "12g"))
    builder = builder.config("spark.sql.shuffle.partitions", str(partitions))
    for key, value in {**DEFAULTS, **conf}.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One of the Parquet tables below ``sf_dir`` (a file or a folder of part files)."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def tasks(rows: DataFrame, most: int) -> int:
    """Into how many tasks of about ``most`` rows a table goes. Counting a table's rows reads no more than the footers of its files."""
    return max(1, -(-rows.count() // most))


def spread(rows: DataFrame, key: str, most: int = 20_000) -> DataFrame:
    """A table dealt by its key to tasks of about ``most`` rows. Files are split by bytes; where each short row is much work, a few tasks would do it all."""
    return rows.repartition(tasks(rows, most), key)


def shared_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share: ``spark.checkpoint.dir``.

    Only in a local session that names none (tests) a folder below /tmp is set; on a cluster every machine
    would have its own.
    """
    path = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not path:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that all machines share")
        path = f"/tmp/checkpoints/lotloom-{spark.sparkContext.applicationId}"
        spark.sparkContext.setCheckpointDir(path)
    return path


def small_table(spark: SparkSession, rows: list[tuple], schema: str) -> DataFrame:
    """A table of few rows known to the driver, handed over as Arrow so that no Python worker is started."""
    kind = spark.createDataFrame([], schema).schema
    columns = list(zip(*rows)) if rows else [()] * len(kind)
    fields = to_arrow_schema(kind)
    table = pa.table([pa.array(list(c), f.type) for c, f in zip(columns, fields)], schema=fields)
    return spark.createDataFrame(table, kind)


def small_batches(spark: SparkSession, rows: int = 1000) -> None:
    """At most ``rows`` rows in a batch for Python from now on: texts are long, and a batch is held on both sides."""
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    if not 0 < int(spark.conf.get(key, "10000")) <= rows:
        spark.conf.set(key, str(rows))


class Scratch:
    """Intermediate tables as Parquet in the shared folder.

    A written table cuts lineage and survives lost executors. ``drop`` removes one
    that is no longer read; the rest goes when the application ends.
    """

    def __init__(self, spark: SparkSession, label: str) -> None:
        self.spark = spark
        self.root = f"{shared_dir(spark).rstrip('/')}/lotloom/{label}-{uuid.uuid4().hex}"
        self.fs, path = self._fs(self.root)
        self.fs.deleteOnExit(path)

    def _fs(self, where: str):
        jvm = self.spark.sparkContext._jvm
        path = jvm.org.apache.hadoop.fs.Path(where)
        return path.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration()), path

    def path(self, name: str) -> str:
        return f"{self.root}/{name}"

    def write(self, df: DataFrame, name: str) -> DataFrame:
        df.write.mode("overwrite").parquet(self.path(name))
        return self.spark.read.schema(df.schema).parquet(self.path(name))

    def drop(self, *names: str) -> None:
        for name in names:
            fs, path = self._fs(self.path(name))
            fs.delete(path, True)
