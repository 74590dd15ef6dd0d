"""Embedding near-dedup: sign hashes of random hyperplanes in several tables, exact cosines, connected components."""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .blocks import Forest, bounds, cells, runs
from .common import partitions, durable
from .components import connected_components

THRESHOLD = 0.98
SEED = 20
#: Expected share of missed pairs that lie exactly at the threshold; closer pairs are missed far less often.
MISS = 1e-4
#: Expected members of a bucket of unrelated vectors. They are told apart by sketches of one long each.
BUCKET = 256
#: Signs in a sketch.
SKETCH = 64


def plan(n: int, threshold: float = THRESHOLD, miss: float = MISS) -> tuple[int, int]:
    """(bits, tables): buckets stay small as n grows, and the tables make up for the longer keys."""
    bits = min(30, max(8, math.ceil(math.log2(max(n, 1) / BUCKET))))
    agree = (1 - math.acos(threshold) / math.pi) ** bits
    return bits, math.ceil(math.log(miss) / math.log1p(-agree))


def sketch_limit(threshold: float = THRESHOLD, miss: float = MISS) -> int:
    """Differing sketch bits that a pair at the threshold exceeds with a chance of at most a hundredth of ``miss``."""
    p, left = math.acos(threshold) / math.pi, 1.0
    for k in range(SKETCH + 1):
        left -= math.comb(SKETCH, k) * p**k * (1 - p) ** (SKETCH - k)
        if left <= miss / 100:
            return k
    return SKETCH


def usable(embedding: Column) -> Column:
    """True for vectors that have a direction: not null, no null or non-finite component, not all zero."""
    bad = F.exists(embedding, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    return F.coalesce(~bad & F.exists(embedding, lambda x: x != 0), F.lit(False))


def hyperplanes(bits: int, tables: int, dim: int, seed: int = SEED) -> np.ndarray:
    """The normals of the tables' planes, then those of the sketch."""
    return np.random.default_rng([seed, dim]).standard_normal((dim, tables * bits + SKETCH))


def _matrix(column: pa.ChunkedArray | pa.Array, dim: int) -> np.ndarray:
    parts = column.chunks if isinstance(column, pa.ChunkedArray) else [column]
    return np.concatenate([np.asarray(p.flatten(), dtype=np.float64) for p in parts]).reshape(-1, dim)


def _binary(rows: np.ndarray) -> pa.Array:
    offsets = np.arange(len(rows) + 1, dtype=np.int32) * rows.shape[1]
    return pa.Array.from_buffers(pa.binary(), len(rows), [None, pa.py_buffer(offsets), pa.py_buffer(np.ascontiguousarray(rows))])


def _signed(classes: DataFrame, bits: int, tables: int, seed: int) -> DataFrame:
    """Each class with its hashes, those of one table after those of another in whole bytes, and its sketch."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            dims = batch.column("dim").to_numpy()
            for dim in np.unique(dims):
                rows = batch.filter(pa.array(dims == dim))
                planes = hyperplanes(bits, tables, int(dim), seed)
                for at in range(0, rows.num_rows, 1024):
                    part = rows.slice(at, 1024)
                    signs = (_matrix(part.column("vec"), dim) @ planes) > 0
                    hashes = np.packbits(signs[:, :-SKETCH].reshape(-1, tables, bits), axis=2).reshape(part.num_rows, -1)
                    sketch = np.packbits(signs[:, -SKETCH:], axis=1).view("<i8").ravel()
                    yield pa.RecordBatch.from_arrays([*part.columns, _binary(hashes), pa.array(sketch)], names=[*part.schema.names, "hashes", "sketch"])

    known = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in classes.schema)
    return classes.mapInArrow(run, f"{known}, hashes binary, sketch long")


#: A bucket, and a cell of it.
BUCKET_KEY = ["t", "label", "dim", "h"]
CELL_KEY = [*BUCKET_KEY, "a", "b"]


def _hash_matrix(column: pa.ChunkedArray, n: int, width: int) -> np.ndarray:
    """(rows, tables) of byte strings from one row's hashes after another's."""
    data = b"".join(column.to_pylist())
    return np.frombuffer(data, dtype=f"V{width}").reshape(n, -1) if data else np.empty((n, 0), dtype=f"V{width}")


def _fresh(near: np.ndarray, at: int, part: np.ndarray, split: bool, seen: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The pairs of a cell's block of rows from ``at`` that no other cell and no earlier table has."""
    a, b = np.nonzero(np.triu(near, 1))
    a, b = a + at, b + at
    if split:  # members of one part meet in their diagonal cell
        other = part[a] != part[b]
        a, b = a[other], b[other]
    for u in range(seen.shape[1]):  # the first table that both share counts a pair
        if not len(a):
            break
        new = seen[a, u] != seen[b, u]
        a, b = a[new], b[new]
    return a, b


def _suspects(signed: DataFrame, bits: int, tables: int, limit: int) -> DataFrame:
    """The members of each cell whose sketch is close to that of another one: only these bring their vectors."""
    width = -(-bits // 8)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for tab in runs(batches, CELL_KEY):
            sketch, part, t = (tab.column(x).to_numpy() for x in ("sketch", "part", "t"))
            cut, told = bounds(tab, CELL_KEY), np.zeros(tab.num_rows, dtype=bool)
            split = tab.column("a").to_numpy() != tab.column("b").to_numpy()
            for lo, hi in zip(cut[:-1].tolist(), cut[1:].tolist()):
                if hi - lo < 2:
                    continue
                some, seen = sketch[lo:hi].view(np.uint64), None  # bits of signed numbers are counted without sign
                for i in range(0, hi - lo, 256):
                    near = np.bitwise_count(some[i : i + 256, None] ^ some[None, i:]) <= limit
                    if near.sum() == len(near):  # each is near itself alone
                        continue
                    if seen is None:
                        seen = _hash_matrix(tab.column("prev").slice(lo, hi - lo), hi - lo, width)
                    a, b = _fresh(near, i, part[lo:hi], split[lo], seen)
                    told[a + lo] = told[b + lo] = True
            yield from tab.filter(pa.array(told)).select([*CELL_KEY, "part", "cid"]).to_batches()

    each = signed.select("cid", "label", "dim", "sketch", "hashes", F.explode(F.sequence(F.lit(0), F.lit(tables - 1))).alias("t"))
    keyed = each.select(
        "cid", "label", "dim", "sketch", "t",
        F.conv(F.hex(F.expr(f"substring(hashes, t * {width} + 1, {width})")), 16, 10).cast("long").alias("h"),
        F.expr(f"substring(hashes, 1, t * {width})").alias("prev"),
    )
    dealt = cells(keyed, BUCKET_KEY, "cid").repartition(partitions(signed.sparkSession), *CELL_KEY).sortWithinPartitions(*CELL_KEY, "cid")
    return dealt.select(*CELL_KEY, "part", "cid", "sketch", "prev").mapInArrow(run, "t int, label int, dim int, h long, a int, b int, part int, cid long")


def _compared(members: DataFrame, bits: int, threshold: float) -> DataFrame:
    """(cid, links, dst): counts of linked vectors, and a spanning link where one was found, for each cell."""
    width = -(-bits // 8)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for tab in runs(batches, CELL_KEY):
            cid, many, part, dims = (tab.column(x).to_numpy() for x in ("cid", "m", "part", "dim"))
            cut = bounds(tab, CELL_KEY)
            links, forest = np.zeros(len(cid), dtype=np.int64), Forest(len(cid))
            split = tab.column("a").to_numpy() != tab.column("b").to_numpy()
            for lo, hi in zip(cut[:-1].tolist(), cut[1:].tolist()):
                if hi - lo < 2:
                    continue
                some = tab.slice(lo, hi - lo)
                x = _matrix(some.column("vec"), int(dims[lo]))
                x /= np.sqrt((x * x).sum(axis=1))[:, None]
                seen = _hash_matrix(some.column("prev"), hi - lo, width)
                for i in range(0, hi - lo, 256):
                    a, b = _fresh(x[i : i + 256] @ x[i:].T >= threshold, i, part[lo:hi], split[lo], seen)
                    a, b = a + lo, b + lo
                    np.add.at(links, a, many[b])
                    np.add.at(links, b, many[a])
                    label = forest.flat()
                    ask = label[a] != label[b]
                    forest.link(a[ask], b[ask])
            root = forest.flat()
            told = np.flatnonzero(links)
            yield pa.RecordBatch.from_arrays([pa.array(cid[told]), pa.array(links[told]), pa.array(cid[root[told]])], names=["cid", "links", "dst"])

    dealt = members.repartition(partitions(members.sparkSession), *CELL_KEY).sortWithinPartitions(*CELL_KEY, "cid")
    return dealt.mapInArrow(run, "cid long, links long, dst long")


def embedding_components(vectors: DataFrame, threshold: float = THRESHOLD, miss: float = MISS, seed: int = SEED) -> DataFrame:
    """Link vectors of equal label whose cosine, in double precision, is at least ``threshold``.

    :param vectors: vec_id long, embedding array<float>, label int; other columns are ignored.
    :return: (vec_id, n_links, component_id, kept), one row per input row. n_links counts the other rows linked
        directly, component_id is the smallest vec_id reachable (itself included), kept is vec_id = component_id.

    Vectors that are null, empty, zero or hold null or non-finite components, and rows with null label, link with
    nothing; so do vectors of different length. Repeated rows count as vectors of their own. An empty table gives an
    empty table. Pairs are found with a probability of at least 1 - ``miss``; none below the threshold is linked.

    Equal vectors of a label collapse first. Buckets are cut into cells of bounded size. Tables carry sketches only;
    a vector goes to those cells where a sketch is close to its own and no earlier table has the pair. Cells count
    links instead of listing pairs.
    """
    rows = vectors.select("vec_id", "embedding", F.col("label").cast("int").alias("label"))
    able = usable(F.col("embedding")) & F.col("label").isNotNull() & F.col("vec_id").isNotNull()
    same = F.md5(F.concat_ws(" ", F.col("label").cast("string"), F.transform("embedding", lambda x: x.cast("string"))))
    rows = rows.withColumn("same", F.when(able, same))
    members = rows.where("same is not null").groupBy("same")
    wide = "array<double>" if "double" in vectors.schema["embedding"].dataType.simpleString() else "array<float>"
    classes = members.agg(F.min("vec_id").alias("cid"), F.count("*").alias("m"), F.first("label").alias("label"), F.first("embedding").cast(wide).alias("vec")).withColumn("dim", F.size("vec"))
    bits, tables = plan(rows.count(), threshold, miss)
    signed = durable(_signed(classes, bits, tables, seed))
    suspects = _suspects(signed, bits, tables, sketch_limit(threshold, miss))
    prev = F.expr(f"substring(hashes, 1, t * {-(-bits // 8)})").alias("prev")
    met = suspects.join(signed.select("cid", "m", "vec", "hashes"), "cid").select(*CELL_KEY, "part", "cid", "m", "vec", prev)
    found = durable(_compared(met, bits, threshold))
    links = found.groupBy("cid").agg(F.sum("links").alias("links"))
    roots = connected_components(found, "cid", "dst").withColumnsRenamed({"node": "cid"})
    told = signed.select("same", "cid", "m").join(links, "cid", "left").join(roots, "cid", "left")
    told = told.select("same", (F.coalesce("links", F.lit(0)) + F.col("m") - 1).alias("n_links"), F.coalesce("root", "cid").alias("component_id"))
    # a hot vector's rows are salted over several tasks; rows without a class bring no key
    salted = told.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(15))))
    out = rows.withColumn("salt", F.pmod(F.xxhash64("vec_id"), F.lit(16)).cast("int")).join(salted, ["same", "salt"], "left")
    component = F.coalesce("component_id", "vec_id")
    return out.select("vec_id", F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"), component.alias("component_id"), (F.col("vec_id") == component).alias("kept"))
