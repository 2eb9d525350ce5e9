"""Intermediate tables on the shared folder named by ``spark.checkpoint.dir``.

``write_intermediate`` computes a frame once, writes it as Parquet and
returns a pruned read of it: the lineage is cut, a lost executor costs no
recomputation, and later reads keep column pruning. While the write runs,
the session's ``spark.sql.classic.shuffleDependency.fileCleanup.enabled`` is
on, so the shuffle files of the finished step are dropped with it instead of
piling up until the driver's garbage collection; the former value is put
back afterwards, by the last of writes that run side by side.
"""

from __future__ import annotations

import threading
import weakref
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

from chainfold.session import scratch_dir

_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


# Per session, the blocks of shuffle_cleanup that are open and the setting's value before the first.
_OPEN: weakref.WeakKeyDictionary[SparkSession, tuple[int, str | None]] = weakref.WeakKeyDictionary()
_LOCK = threading.Lock()


@contextmanager
def shuffle_cleanup(spark: SparkSession) -> Iterator[None]:
    """Drop the shuffle files of every action inside the block when it ends."""
    with _LOCK:
        blocks, before = _OPEN.get(spark) or (0, spark.conf.get(_CLEANUP, None))
        _OPEN[spark] = (blocks + 1, before)
        spark.conf.set(_CLEANUP, "true")
    try:
        yield
    finally:
        with _LOCK:
            blocks, before = _OPEN.pop(spark)
            if blocks > 1:
                _OPEN[spark] = (blocks - 1, before)
            elif before is None:
                spark.conf.unset(_CLEANUP)
            else:
                spark.conf.set(_CLEANUP, before)


# Folder of every frame that write_intermediate has returned and that is still in use.
_FOLDERS: weakref.WeakKeyDictionary[DataFrame, str] = weakref.WeakKeyDictionary()


def write_intermediate(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` below the checkpoint folder and read it back."""
    spark = df.sparkSession
    path = scratch_dir(spark, name)
    with shuffle_cleanup(spark):
        df.write.parquet(path)
    out = spark.read.schema(df.schema).parquet(path)
    _FOLDERS[out] = path
    return out


def discard(df: DataFrame) -> None:
    """Delete the files of a frame returned by ``write_intermediate``.

    Only for tables whose readers have all run; a frame that still reads
    them would fail.
    """
    spark, folder = df.sparkSession, _FOLDERS.pop(df, None)
    if folder:
        path = spark._jvm.org.apache.hadoop.fs.Path(folder)
        path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)
