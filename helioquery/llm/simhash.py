"""SimHash near-duplicate detection: pigeonhole blocks, Hamming verification, connected components."""

from __future__ import annotations

from collections.abc import Iterator
from itertools import accumulate, combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .blocks import cells, spanning_links
from .common import partitions, durable
from .components import connected_components

SHINGLE = 3
MAX_BITS = 3
SEED = 42
#: Widths of the blocks. MAX_BITS damaged bits leave two of five blocks whole, so close pairs agree on a pair of blocks.
WIDTHS = (13, 13, 13, 13, 12)


def shingle_hashes(text: str | None, shingle: int = SHINGLE, seed: int = SEED) -> np.ndarray:
    """A hash of each run of ``shingle`` words, repeats included; of fewer words one of the whole; null or wordless: none."""
    words = (text or "").encode("utf-8", "surrogatepass").lower().split()  # of bytes: ASCII letters and white space only
    if not words:
        return np.zeros(0, dtype="<u8")
    joined = b" ".join(words)
    ends = list(accumulate(map(len, words), lambda at, n: at + 1 + n))
    if len(words) <= shingle:
        hashes = [xxhash.xxh64_intdigest(joined, seed)]
    else:
        starts = [0, *(e + 1 for e in ends)]
        digest = xxhash.xxh64_intdigest
        hashes = [digest(joined[a:b], seed) for a, b in zip(starts, ends[shingle - 1 :])]
    return np.array(hashes, dtype="<u8")


def fingerprint_of(values: np.ndarray) -> int:
    """64-bit SimHash of shingle hashes; none: 0."""
    counts = np.zeros(64, dtype=np.int64)
    for at in range(0, len(values), 65_536):
        part = values[at : at + 65_536]
        counts += np.unpackbits(part.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(counts * 2 > len(values), bitorder="little").view("<u8")[0])


def fingerprint(text: str | None, shingle: int = SHINGLE, seed: int = SEED) -> int:
    """64-bit SimHash of a text; null or wordless: 0."""
    return fingerprint_of(shingle_hashes(text, shingle, seed))


def with_fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = SHINGLE, seed: int = SEED) -> DataFrame:
    """(id, fp): the fingerprint of each row as a signed long, from whole texts in one narrow pass."""
    kind = docs.schema[id_col].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = np.array([fingerprint(x.as_py(), shingle, seed) for x in batch.column(1)], dtype=np.uint64)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(found.view(np.int64))], names=["id", "fp"])

    return docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text")).mapInArrow(run, f"id {kind}, fp long")


def block_keys(fp: Column) -> Column:
    """One long for each pair of blocks: the pair's number and the bits of both."""
    at, blocks = 0, []
    for width in WIDTHS:
        blocks.append(F.shiftrightunsigned(fp, at).bitwiseAND(F.lit((1 << width) - 1)))
        at += width
    return F.array(*(F.lit(n << 32).bitwiseOR(F.shiftleft(blocks[i], 13)).bitwiseOR(blocks[j]) for n, (i, j) in enumerate(combinations(range(len(WIDTHS)), 2))))


def close_links(fps: DataFrame, max_bits: int = MAX_BITS) -> DataFrame:
    """Spanning links (src, dst) of the graph of distinct fingerprints that differ in at most ``max_bits`` (0 to 3) bits."""
    if not 0 <= max_bits <= MAX_BITS:
        raise ValueError("the blocks find pairs of at most 3 differing bits")
    keyed = fps.select(F.explode(block_keys(F.col("fp"))).alias("key"), "fp")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def near(values: np.ndarray, i: np.ndarray, j: np.ndarray) -> np.ndarray:
            return np.bitwise_count((values[i] ^ values[j]).view(np.uint64)) <= max_bits  # unsigned: a sign bit counts too

        yield from spanning_links(batches, ["key", "a", "b"], "fp", near)

    dealt = cells(keyed, ["key"], "fp").repartition(partitions(fps.sparkSession), "key", "a", "b").sortWithinPartitions("key", "a", "b", "fp")
    return dealt.select("key", "a", "b", "fp").mapInArrow(run, "src long, dst long")


def simhash_components(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", max_bits: int = MAX_BITS, shingle: int = SHINGLE, seed: int = SEED) -> DataFrame:
    """Fingerprint every document and join those that fingerprints link, directly or through others.

    :return: (doc_id, fingerprint as 16 hex digits, component_id: the smallest id reachable, itself included).

    Null and wordless texts have fingerprint zero and link like any other. Repeated rows each get their row; rows
    without id get their component's smallest id, null if none has one. An empty table gives an empty table; other
    columns are ignored.

    Equal fingerprints collapse first, so a huge group of exact copies is one row in the join. Buckets are cut into
    cells of bounded size; no list of pairs is made.
    """
    marked = durable(with_fingerprints(docs, id_col, text_col, shingle, seed))
    firsts = durable(marked.groupBy("fp").agg(F.min("id").alias("first")))
    roots = connected_components(close_links(firsts, max_bits)).withColumnsRenamed({"node": "fp"})
    rooted = firsts.join(roots, "fp", "left").select("fp", "first", F.coalesce("root", "fp").alias("root"))
    least = rooted.groupBy("root").agg(F.min("first").alias("component_id"))
    labels = rooted.join(least, "root").select("fp", "component_id")
    return marked.join(labels, "fp").select(F.col("id").alias(id_col), F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def row_mark(docs: DataFrame) -> Column:
    """64 bits that tell rows apart unless all their columns are equal."""
    return F.xxhash64(*docs.columns)


def keep_one(docs: DataFrame, rows: DataFrame) -> DataFrame:
    """One row of each group: that of the smallest id, rows without id last, then of the smallest mark.

    :param rows: (mark, id, root: the group) of every row of docs.
    """
    least = rows.groupBy("root").agg(F.min(F.struct(F.col("id").isNull().alias("none"), "id", "mark")).alias("least"))
    kept = docs.withColumn("__mark", row_mark(docs)).join(least.select(F.col("least.mark").alias("__mark")), "__mark", "left_semi")
    return kept.dropDuplicates(["__mark"]).select(docs.columns)


def drop_near_copies(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Keep one row of each group of near copies; all columns stay.

    It is the row of the smallest id, rows without id last; of repeated ids the one of the smallest hash of the row.
    """
    row = F.struct(F.col(id_col).isNull().alias("none"), F.col(id_col).alias("id"), row_mark(docs).alias("mark"))
    groups = simhash_components(docs.select(row.alias("row"), F.col(text_col).alias("text")), "row", "text")
    return keep_one(docs, groups.select("row.mark", "row.id", F.col("component_id.mark").alias("root")))
