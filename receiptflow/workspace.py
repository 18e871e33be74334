"""Folders for what queries write on the way."""

from __future__ import annotations

import re
import tempfile
import threading
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

_OWN: dict[str, str] = {}
_FREED: dict[str, tuple[str | None, int]] = {}
_LOCK = threading.Lock()


def shared_folder(spark: SparkSession) -> str:
    """The folder that the driver and all executors see: ``spark.checkpoint.dir`` of the session.

    Where that is unset and all of Spark is one local process (tests) a temporary folder serves for the application's life;
    on a cluster, where executors would not find its files, it raises ValueError.
    """
    found = spark.conf.get("spark.checkpoint.dir", None)
    if found:
        return found.rstrip("/")
    if not re.fullmatch(r"local(\[.*\])?", spark.sparkContext.master):
        raise ValueError("spark.checkpoint.dir has to name a folder that the driver and all executors share")
    app = spark.sparkContext.applicationId
    if app not in _OWN:
        _OWN[app] = "file://" + tempfile.mkdtemp(prefix="receiptflow-")
    return _OWN[app]


def fresh_folder(spark: SparkSession, name: str) -> str:
    """A path of its own below the shared folder."""
    return f"{shared_folder(spark)}/{name}-{uuid.uuid4().hex}"


@contextmanager
def shuffles_freed(spark: SparkSession) -> Iterator[None]:
    """What is written inside leaves no shuffle files: they go with the write that made them, not when the driver's garbage is next collected.

    Threads that write in one session share the setting; the last of them puts back what it was.
    """
    key = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    own = str(spark._jsparkSession.sessionUUID())
    with _LOCK:
        before, n = _FREED.get(own) or (spark.conf.get(key, None), 0)
        _FREED[own] = (before, n + 1)
        spark.conf.set(key, "true")
    try:
        yield
    finally:
        with _LOCK:
            before, n = _FREED.pop(own)
            if n > 1:
                _FREED[own] = (before, n - 1)
            elif before is None:
                spark.conf.unset(key)
            else:
                spark.conf.set(key, before)


def written(df: DataFrame, name: str) -> DataFrame:
    """``df`` written once to the shared folder and read back.

    For a table from which several others are made: the work before it is done once, plans stay short, and the loss of
    an executor costs no more than the tasks it had.
    """
    path = fresh_folder(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def materialised(df: DataFrame, name: str) -> DataFrame:
    """As ``written``, but made small: compressed by zstd, and the shuffles before it are gone once it is there."""
    path = fresh_folder(df.sparkSession, name)
    with shuffles_freed(df.sparkSession):
        df.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def dropped(*tables: DataFrame) -> None:
    """Deletes the files behind tables of ``materialised`` that no later plan reads."""
    for df in tables:
        spark = df.sparkSession
        for folder in {file.rsplit("/", 1)[0] for file in df.inputFiles()}:
            path = spark._jvm.org.apache.hadoop.fs.Path(folder)
            path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)
