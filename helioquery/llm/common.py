"""Helpers shared by the corpus operators: durable checkpoints, table reading, bounded text groups."""

from __future__ import annotations

import mmap
import os
import tempfile
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Upper limit, in characters, of the text a Python worker holds as token lists at once (one longer text stands alone).
GROUP_CHARS = 2_000_000

#: Spark's setting for removing a query's shuffle files when it has ended.
CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
#: Rows of a few numbers that a join sends to every executor at most, some tens of bytes each.
BROADCAST_ROWS = 1_000_000


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A table of the data folder, read by Spark so that any file system it knows will do."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def durable(df: DataFrame) -> DataFrame:
    """Cut the lineage with a reliable checkpoint in the folder that all executors share.

    The folder is ``spark.checkpoint.dir``; only where that is unset (tests, local mode) a temporary one is made. The
    shuffle files behind the checkpoint are dead once it is written, and Spark removes them then.
    """
    spark = df.sparkSession
    sc = spark.sparkContext
    if not sc._jsc.sc().getCheckpointDir().isDefined():
        sc.setCheckpointDir(spark.conf.get("spark.checkpoint.dir", None) or tempfile.mkdtemp(prefix="checkpoints-"))
    before = spark.conf.get(CLEANUP, None)
    spark.conf.set(CLEANUP, "true")
    try:
        return df.select("*").checkpoint(eager=True)  # a query of its own, made while the setting holds
    finally:
        spark.conf.unset(CLEANUP) if before is None else spark.conf.set(CLEANUP, before)


def narrow_join(left: DataFrame, right: DataFrame, on: str, how: str) -> DataFrame:
    """left joined to right, a table that is written already: broadcast if it has no more than BROADCAST_ROWS rows, else shuffled."""
    return left.join(F.broadcast(right) if right.count() <= BROADCAST_ROWS else right, on, how)


def partitions(spark: SparkSession) -> int:
    """The configured shuffle width, which a deployment sizes to its input."""
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def crc_of_id(doc_id: Column) -> Column:
    """CRC-32 of the decimal doc_id."""
    return F.crc32(doc_id.cast("string").cast("binary"))


def text_groups(column: pa.ChunkedArray | pa.Array, limit: int = GROUP_CHARS) -> Iterator[tuple[int, list[str | None]]]:
    """Consecutive runs of texts of at most ``limit`` characters each, with the index of their first row."""
    start, held, size = 0, [], 0
    for i, value in enumerate(column):
        text = value.as_py()
        if held and size + len(text or "") > limit:
            yield start, held
            start, held, size = i, [], 0
        held.append(text)
        size += len(text or "")
    if held:
        yield start, held


def array_groups(column: pa.ChunkedArray | pa.Array, limit: int = GROUP_CHARS) -> Iterator[tuple[int, pa.Array]]:
    """Consecutive parts of at most ``limit`` bytes of text each (one longer text stands alone), with the index of their first row."""
    ends, at = np.cumsum(pc.fill_null(pc.binary_length(column), 0).to_numpy(zero_copy_only=False), dtype=np.int64), 0
    while at < len(column):
        stop = max(at + 1, int(np.searchsorted(ends, (ends[at - 1] if at else 0) + limit, side="right")))
        yield at, column.take(pa.array(range(at, stop)))  # a copy: string kernels misread slices
        at = stop


def mapped(blob: bytes) -> mmap.mmap:
    """A read-only memory map of ``blob``; it lies in memory, not in a folder of the machine."""
    fd = os.memfd_create("model")
    with os.fdopen(fd, "wb") as f:
        f.write(blob)
        f.flush()
        return mmap.mmap(fd, len(blob), access=mmap.ACCESS_READ)
