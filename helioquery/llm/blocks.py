"""Blocked self-comparison: buckets cut into cells of bounded size, and the links found within each cell."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Members of a bucket that one cell holds of either side.
CELL = 1024


def cells(keyed: DataFrame, key: list[str], member: str, size: int = CELL) -> DataFrame:
    """Deal each bucket to cells (a, b) so that every two members of a bucket meet in exactly one cell, or in one diagonal cell.

    A bucket of up to ``size`` members is the cell (0, 0). A larger one is split by a hash of the member into s parts,
    and each part goes to the s cells of its row and column. Column ``part`` is the part that the row belongs to.
    """
    hot = keyed.groupBy(*key).count().where(F.col("count") > size).select(*key, F.ceil(F.col("count") / size).cast("int").alias("s"))
    rows = keyed.join(hot, key, "left").withColumn("s", F.coalesce("s", F.lit(1)))
    rows = rows.withColumn("part", F.pmod(F.xxhash64(member), F.col("s")).cast("int"))
    rows = rows.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("s") - 1)))
    return rows.withColumns({"a": F.least("part", "other"), "b": F.greatest("part", "other")}).drop("s", "other")


def runs(batches: Iterator[pa.RecordBatch], key: list[str]) -> Iterator[pa.Table]:
    """Tables of whole runs of equal keys from batches sorted by key; a run that spans batches is put together."""
    held: list[pa.RecordBatch] = []

    def last_start(batch: pa.RecordBatch) -> int:
        at = batch.num_rows - 1
        change = np.zeros(batch.num_rows, dtype=bool)
        for name in key:
            values = batch.column(name).to_numpy(zero_copy_only=False)
            change[1:] |= values[1:] != values[:-1]
        where = np.flatnonzero(change)
        return int(where[-1]) if len(where) else 0 if at >= 0 else 0

    def first(batch: pa.RecordBatch) -> tuple:
        return tuple(batch.column(name)[0].as_py() for name in key)

    for batch in batches:
        if not batch.num_rows:
            continue
        if held and first(held[-1].slice(held[-1].num_rows - 1)) != first(batch):
            yield pa.Table.from_batches(held)
            held = []
        cut = last_start(batch)
        if cut:
            yield pa.Table.from_batches([*held, batch.slice(0, cut)])
            held = [batch.slice(cut)]
        else:
            held.append(batch)
    if held:
        yield pa.Table.from_batches(held)


def bounds(tab: pa.Table, key: list[str]) -> np.ndarray:
    """Starts of the runs of equal keys, and the end."""
    change = np.ones(tab.num_rows, dtype=bool)
    if tab.num_rows:
        change[1:] = False
        for name in key:
            values = tab.column(name).to_numpy()
            change[1:] |= values[1:] != values[:-1]
    return np.append(np.flatnonzero(change), tab.num_rows)


class Forest:
    """Union by smaller index over the rows of one table."""

    def __init__(self, n: int):
        self.up = np.arange(n)

    def find(self, i: int) -> int:
        up = self.up
        while up[i] != i:
            up[i] = up[up[i]]
            i = up[i]
        return int(i)

    def link(self, i: np.ndarray, j: np.ndarray) -> None:
        for a, b in zip(i.tolist(), j.tolist()):
            a, b = self.find(a), self.find(b)
            if a != b:
                self.up[max(a, b)] = min(a, b)

    def flat(self) -> np.ndarray:
        while True:
            nxt = self.up[self.up]
            if (nxt == self.up).all():
                return self.up
            self.up = nxt


def spanning_links(batches: Iterator[pa.RecordBatch], key: list[str], member: str, near: Callable) -> Iterator[pa.RecordBatch]:
    """(src, dst): for each cell a link from every member that has near ones to the first member of its group."""
    for tab in runs(batches, key):
        values = tab.column(member).to_numpy()
        cut = bounds(tab, key)
        end = np.repeat(cut[1:], np.diff(cut))
        forest, at = Forest(len(values)), np.arange(len(values))
        step, label = 1, at
        while len(at := at[at + step < end[at]]):
            ask = label[at] != label[at + step]
            i = at[ask]
            i = i[near(values, i, i + step)]
            if len(i):
                forest.link(i, i + step)
                label = forest.flat()
            step += 1
        root = forest.flat()
        moved = np.flatnonzero(root != np.arange(len(root)))
        if len(moved):
            yield pa.RecordBatch.from_arrays([pa.array(values[moved]), pa.array(values[root[moved]])], names=["src", "dst"])
