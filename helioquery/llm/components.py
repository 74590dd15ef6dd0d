"""Connected components: in one task up to a number of links, beyond it by alternating large-star and small-star steps."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import durable

#: Ways in which the neighbours of one node are dealt out, so that a hub's edges never meet in one task.
SALTS = 8
#: Links that one task joins, at some 150 bytes each at its peak; more of them take rounds, of some ten stages each.
ONE_TASK = 2_000_000


def _with_least(edges: DataFrame, least: DataFrame) -> DataFrame:
    """edges (u, v) with the least neighbour m of u; the edges of a hub are salted over several tasks."""
    salted = least.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    return edges.withColumn("salt", F.pmod(F.xxhash64("v"), F.lit(SALTS)).cast("int")).join(salted, ["u", "salt"])


def _large_star(edges: DataFrame) -> DataFrame:
    both = edges.union(edges.select("v", "u")).toDF("u", "v")
    least = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
    return _with_least(both.where("v > u"), least).select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    least = edges.groupBy("u").agg(F.min("v").alias("m"))
    moved = _with_least(edges, least).where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return moved.union(least.select("u", "m")).distinct()


def least_reached(u: np.ndarray, v: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Each node of the links (u, v) and the smallest one that it reaches; every round at least halves the trees."""
    nodes, at = np.unique(np.concatenate([u, v]), return_inverse=True)
    a, b, up = at[: len(u)], at[len(u) :], np.arange(len(nodes))
    while len(a):
        np.minimum.at(up, np.maximum(a, b), np.minimum(a, b))
        while (up[up] != up).any():
            up = up[up]
        a, b = up[a], up[b]
        a, b = a[a != b], b[a != b]
    return nodes, nodes[up]


def _in_one_task(edges: DataFrame) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = [(b.column(0).to_numpy(), b.column(1).to_numpy()) for b in batches]
        if held:
            out = pa.RecordBatch.from_arrays([pa.array(x) for x in least_reached(*map(np.concatenate, zip(*held)))], names=["node", "root"])
            yield from (out.slice(k, 100_000) for k in range(0, len(out), 100_000))

    return durable(edges.repartition(1).mapInArrow(run, "node long, root long"))


def connected_components(links: DataFrame, left: str = "src", right: str = "dst") -> DataFrame:
    """Label every node that has a link with the smallest node it reaches.

    :param links: pairs of longs; direction, repeats, nulls and self links do not matter.
    :return: (node, root), one row per node that occurs in a proper link; root = node for the smallest itself.
        No link: an empty table.

    Up to ONE_TASK distinct links are joined by one task. Beyond, each round halves the depth of every component; a
    round is two shuffles of the links and a durable checkpoint. Only two numbers about the links come to the driver.
    """
    pairs = links.select(F.col(left).cast("long").alias("a"), F.col(right).cast("long").alias("b")).where("a <> b")
    edges = durable(pairs.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct())

    def state(df: DataFrame) -> tuple:
        return tuple(df.agg(F.count("*"), F.bit_xor(F.xxhash64("u", "v"))).first())

    seen = state(edges)
    if 0 < seen[0] <= ONE_TASK:
        return _in_one_task(edges)
    while seen[0]:
        edges = durable(_small_star(_large_star(edges)))
        now = state(edges)
        if now == seen:
            break
        seen = now
    return edges.select(F.col("u").alias("node"), F.col("v").alias("root")).union(edges.select("v", "v").distinct())
