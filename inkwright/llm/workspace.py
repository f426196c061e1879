"""Shared storage for intermediate results.

Everything that one job writes and another reads lies in the folder that the
cluster names in ``spark.checkpoint.dir``, so a lost executor costs a retry and
never data.  ``Scratch`` owns a folder below it for the length of one operator
call; what the caller gets back is checkpointed there by Spark itself.
"""

from __future__ import annotations

import os
import tempfile
import uuid
from urllib.parse import urlparse

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def shared_dir(spark: SparkSession) -> str:
    """The cluster's shared folder; a folder of our own only where none is set and one machine runs everything (tests)."""
    held = spark.sparkContext._jsc.sc().getCheckpointDir()
    if held.isDefined():
        return os.path.dirname(held.get().rstrip("/"))
    named = spark.conf.get("spark.checkpoint.dir", None)
    if not named:
        if not spark.sparkContext.master.startswith("local[") and spark.sparkContext.master != "local":
            raise ValueError("spark.checkpoint.dir must name a folder that the driver and all executors share")
        named = "file://" + tempfile.mkdtemp(prefix="inkwright-")
    spark.sparkContext.setCheckpointDir(named)
    return named.rstrip("/")


#: Texts go to Python in Arrow batches of at most so many bytes.
ARROW_BYTES = "spark.sql.execution.arrow.maxBytesPerBatch", str(8 << 20)


def bounded(df: DataFrame) -> DataFrame:
    """df, to be read by Python: from now on this session's batches of whole texts are small, whenever df is computed."""
    df.sparkSession.conf.set(*ARROW_BYTES)
    return df


#: Whether Spark removes a query's shuffle files at its end; else they stay until the driver's JVM has found out that nothing refers to them.
CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


class Scratch:
    """``with Scratch(spark) as s``: tables and files of one operator call, removed at its end.

    With ``tidy``, the shuffle files of a table's query go once the table is written.
    """

    def __init__(self, spark: SparkSession, tidy: bool = False):
        self.spark = spark
        self.tidy = tidy
        self.root = f"{shared_dir(spark)}/inkwright-{uuid.uuid4().hex}"
        self.made = 0

    def __enter__(self) -> Scratch:
        self.spark.conf.set(*ARROW_BYTES)
        return self

    def __exit__(self, *_) -> None:
        jvm = self.spark._jvm
        path = jvm.org.apache.hadoop.fs.Path(self.root)
        path.getFileSystem(self.spark._jsc.hadoopConfiguration()).delete(path, True)

    def path(self, name: str) -> str:
        self.made += 1
        return f"{self.root}/{self.made:03d}-{name}"

    def table(self, df: DataFrame, name: str = "table", compression: str = "snappy") -> DataFrame:
        """Writes df as Parquet and returns the table read back: its lineage starts at the files."""
        path, conf = self.path(name), self.spark.conf
        before = conf.get(CLEANUP, None)
        if self.tidy:
            conf.set(CLEANUP, "true")
        try:
            df.write.parquet(path, compression=compression)
        finally:
            if self.tidy:
                conf.unset(CLEANUP) if before is None else conf.set(CLEANUP, before)
        return self.spark.read.schema(df.schema).parquet(path)

    def keep(self, df: DataFrame) -> DataFrame:
        """df, checkpointed: it outlives this scratch folder, and Spark removes it with its last reference."""
        return df.checkpoint(eager=True)


#: A side of a join is broadcast only if its counted rows take at most so many bytes.
BROADCAST_BYTES = 32 << 20


def small_side(df: DataFrame, row_bytes: int, limit: int = BROADCAST_BYTES) -> DataFrame:
    """df with a broadcast hint if counting proves it small, else df as it is (a shuffled join).

    ``row_bytes`` is an upper estimate of a row's size.  df should be a table
    (``Scratch.table`` or ``keep``), for the count reads it once more.
    """
    return F.broadcast(df) if df.count() * row_bytes <= limit else df


def _local(uri: str) -> str | None:
    at = urlparse(uri)
    return (at.path if at.scheme == "file" else uri) if at.scheme in ("", "file") else None


def open_input(uri: str):
    """A seekable binary file; remote stores go through pyarrow's file systems."""
    if (path := _local(uri)) is not None:
        return open(path, "rb")
    from pyarrow import fs

    store, path = fs.FileSystem.from_uri(uri)
    return store.open_input_file(path)


def open_output(uri: str):
    if (path := _local(uri)) is not None:
        os.makedirs(os.path.dirname(path), exist_ok=True)
        return open(path, "wb")
    from pyarrow import fs

    store, path = fs.FileSystem.from_uri(uri)
    store.create_dir(os.path.dirname(path), recursive=True)
    return store.open_output_stream(path)


def list_files(uri: str, suffix: str) -> list[tuple[str, int]]:
    """(uri, bytes) of the files in a folder, by name."""
    if (path := _local(uri)) is not None:
        found = [(f"file://{os.path.join(path, f)}", os.path.getsize(os.path.join(path, f))) for f in os.listdir(path)]
    else:
        from pyarrow import fs

        store, path = fs.FileSystem.from_uri(uri)
        found = [(f"{uri.rstrip('/')}/{x.base_name}", x.size) for x in store.get_file_info(fs.FileSelector(path)) if x.is_file]
    return sorted(x for x in found if x[0].endswith(suffix))
