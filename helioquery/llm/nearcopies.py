"""Near copies by similarity of shingle sets: SimHash links the bulk, a prefix join finds the rest, whole sets decide.

Fingerprints alone can't tell a similarity of 0.8: such pairs differ in about ten of 64 bits, some in many more. So
fingerprints only propose links, which dense groups need few of. What they leave apart is found by prefixes: in one
order of all shingles, two sets of similarity s share one of the first n - ceil(s n) + 1 of either. Sets that share a
prefix are first held against one of them, which joins a dense group by as many pairs as it has members; all pairs are
left to those that stay apart. Both ways are exact: a parity sketch throws out only pairs that can't be similar, and
each link is verified on the two whole sets.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .blocks import bounds, cells, runs
from .common import durable, narrow_join, partitions
from .components import connected_components
from .simhash import close_links, fingerprint_of, keep_one, row_mark, shingle_hashes

SHINGLE = 5
#: Least Jaccard similarity of near copies, as a fraction of whole numbers, so that equality counts.
SIMILAR = (4, 5)
#: Shingles found in this many documents of a sample come last in the order, so that few prefixes hold them. This, the
#: sample's size and the number of such shingles bear on the cost, not on the result.
OFTEN, SAMPLE_DOCS, MOST = 3, 4_000, 100_000
#: Bits of a set's parity sketch, at least; twice its elements or more. Two sketches of a size, or folded to one, differ in
#: no more bits than the sets in elements.
SKETCH = 512


def shingle_set(text: str | None) -> np.ndarray:
    """Sorted distinct hashes of a text's shingles; of fewer words the whole; wordless: none."""
    return np.unique(shingle_hashes(text, SHINGLE)).view(np.int64)


def often(docs: DataFrame, text_col: str) -> np.ndarray:
    """Sorted hashes of shingles that many documents of a bounded sample hold."""
    share = SAMPLE_DOCS / max(1, docs.count())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for text in batch.column(0):
                yield pa.RecordBatch.from_arrays([pa.array(shingle_set(text.as_py()))], names=["shingle"])

    sample = docs.select(F.col(text_col).alias("text")).where(F.pmod(F.xxhash64("text"), F.lit(1_000_003)) < share * 1_000_003)
    counted = sample.mapInArrow(run, "shingle long").groupBy("shingle").count().where(F.col("count") >= OFTEN)
    return np.sort(counted.orderBy(F.desc("count"), "shingle").limit(MOST).select("shingle").toArrow()["shingle"].to_numpy())


def sketch_of(own: np.ndarray) -> np.ndarray:
    """As longs, the parity of the number of elements that fall on each bit."""
    bits = max(SKETCH, 1 << (2 * len(own) - 1).bit_length())
    odd = np.bincount((own.view(np.uint64) % np.uint64(bits)).astype(np.int64), minlength=bits) & 1
    return np.packbits(odd.astype(np.uint8)).view(np.int64)


def differing_bits(a: Column, b: Column) -> Column:
    """Bits in which two sketches differ, the larger one folded once if it is twice as large."""
    low = F.least(F.size(a), F.size(b))
    a, b = (F.when(F.size(x) > low, F.transform(F.sequence(F.lit(0), low - 1), lambda i: F.get(x, i).bitwiseXOR(F.get(x, i + low)))).otherwise(x) for x in (a, b))
    return F.aggregate(F.zip_with(a, b, lambda x, y: F.bit_count(x.bitwiseXOR(y))), F.lit(0), lambda t, x: t + x)


def with_prefixes(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """(mark, id, fp, h, n, sketch, prefix) of each row: h names its set of n shingles; prefix in the order of all shingles."""
    common = docs.sparkSession.sparkContext.broadcast(often(docs, text_col))  # at most MOST numbers
    kind = docs.schema[id_col].dataType.simpleString()
    over, under = SIMILAR

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        late = common.value
        for batch in batches:
            fps, names, sizes, sketches, prefixes = [], [], [], [], []
            for text in batch.column(2):
                hashes = shingle_hashes(text.as_py(), SHINGLE)
                own = np.unique(hashes).view(np.int64)
                n = len(own)
                fps.append(fingerprint_of(hashes))
                names.append(xxhash.xxh64_intdigest(np.sort(own).tobytes()))
                sizes.append(n)
                sketches.append(sketch_of(own))
                if len(late) and n:
                    hit = late[np.minimum(np.searchsorted(late, own), len(late) - 1)] == own
                    own = np.concatenate([own[~hit], own[hit]])
                prefixes.append(own[: n + (-over * n // under) + 1] if n else own)
            columns = [pa.array(np.array(x, dtype=np.uint64).view(np.int64)) for x in (fps, names)]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), *columns, pa.array(sizes, pa.int64()), *(pa.array(x, pa.list_(pa.int64())) for x in (sketches, prefixes))], names=["mark", "id", "fp", "h", "n", "sketch", "prefix"])

    rows = docs.select(row_mark(docs).alias("mark"), F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    return rows.mapInArrow(run, f"mark long, id {kind}, fp long, h long, n long, sketch array<long>, prefix array<long>")


def verified(pairs: DataFrame, sets_of: DataFrame, docs: DataFrame, text_col: str) -> DataFrame:
    """Those of the pairs (src, dst) of set names whose sets are similar; only the texts of pairs of similar sketches move.

    :param sets_of: (h, n, sketch, mark: that of one row) of each set, a written table.
    """
    over, under = SIMILAR
    # written first: the driver plans anew after each stage, and a plan of half the stages is half the work each time
    pairs = durable(pairs.select(F.least("src", "dst").alias("src"), F.greatest("src", "dst").alias("dst")).where("src <> dst").distinct())
    ends = [sets_of.select(F.col("h").alias(x), F.col("n").alias("n_" + x), F.col("sketch").alias("s_" + x)) for x in ("src", "dst")]
    sized = F.least("n_src", "n_dst") * under >= F.greatest("n_src", "n_dst") * over  # so sketches differ in size by one fold at most
    close = differing_bits(F.col("s_src"), F.col("s_dst")) * (over + under) <= (F.col("n_src") + F.col("n_dst")) * (under - over)
    both = pairs.join(ends[0], "src").join(ends[1], "dst").where(F.when(sized, close).otherwise(F.lit(False)))
    pairs = durable(both.select("src", "dst"))
    named = pairs.select(F.col("src").alias("h")).union(pairs.select("dst")).distinct()
    one = durable(sets_of.select("h", "mark").join(named, "h", "left_semi"))
    texts = narrow_join(docs.select(row_mark(docs).alias("mark"), F.col(text_col).alias("text")), one, "mark", "inner").select("h", "text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            own = [shingle_set(t.as_py()) for t in batch.column(1)]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(own, pa.list_(pa.int64()))], names=["h", "own"])

    sets = durable(texts.mapInArrow(run, "h long, own array<long>").dropDuplicates(["h"]))
    both = pairs.join(sets.toDF("src", "a"), "src").join(sets.toDF("dst", "b"), "dst")
    alike = F.size(F.array_intersect("a", "b")) * (over + under) >= (F.size("a") + F.size("b")) * over
    return durable(both.where(alike).select("src", "dst"))


def prefix_pairs(keyed: DataFrame) -> DataFrame:
    """(src, dst) of the rows (key, h, n, pos, root) that share a key, lie in two components and may be similar.

    What two sets can share from their first common place on bounds their similarity; later common places may fail.
    """
    over, under = SIMILAR

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for tab in runs(batches, ["key", "a", "b"]):
            h, n, pos, root = (tab.column(x).to_numpy() for x in ("h", "n", "pos", "root"))
            cut = bounds(tab, ["key", "a", "b"])
            end, at, step = np.repeat(cut[1:], np.diff(cut)), np.arange(len(h)), 1
            while len(at := at[at + step < end[at]]):
                to = at + step
                most = np.minimum(n[at] - pos[at], n[to] - pos[to])
                hit = (root[at] != root[to]) & (most * (over + under) >= (n[at] + n[to]) * over)
                if hit.any():
                    yield pa.RecordBatch.from_arrays([pa.array(h[at[hit]]), pa.array(h[to[hit]])], names=["src", "dst"])
                step += 1

    dealt = cells(keyed, ["key"], "h").repartition(partitions(keyed.sparkSession), "key", "a", "b").sortWithinPartitions("key", "a", "b", "h")
    return dealt.select("key", "a", "b", "h", "n", "pos", "root").mapInArrow(run, "src long, dst long")


def star_pairs(keyed: DataFrame) -> DataFrame:
    """(src, dst): each set of the rows (key, h, n) with the least and the largest of those that share its key, where sizes allow."""
    over, under = SIMILAR
    ends = keyed.groupBy("key").agg(F.min("h").alias("low"), F.max("h").alias("high"), F.min_by("n", "h").alias("n_low"), F.max_by("n", "h").alias("n_high"))
    both = F.array(F.struct(F.col("low").alias("dst"), F.col("n_low").alias("m")), F.struct(F.col("high").alias("dst"), F.col("n_high").alias("m")))
    each = keyed.join(ends, "key").select(F.col("h").alias("src"), "n", F.inline(both))
    return each.where((F.col("src") != F.col("dst")) & (F.least("n", "m") * under >= F.greatest("n", "m") * over)).select("src", "dst").distinct()


def drop_similar(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Keep one row of each group of documents that shares of at least SIMILAR of their five-word shingles link.

    Similarity is that of Jaccard, of sets of shingles; words as for fingerprints. Groups are connected components. The
    row of the smallest id stays, rows without id come last; all columns stay. Null and wordless texts are one group.
    An empty table gives an empty table.
    """
    marked = durable(with_prefixes(docs, id_col, text_col))
    sets_of = durable(marked.groupBy("h").agg(*(F.first(c).alias(c) for c in ("n", "sketch", "prefix")), F.min("mark").alias("mark")))
    firsts = durable(marked.groupBy("fp").agg(F.min("h").alias("first")))
    equal = marked.select("fp", "h").distinct().join(firsts, "fp").select(F.col("h").alias("src"), F.col("first").alias("dst"))
    ends = [firsts.toDF(fp, name) for fp, name in (("src", "a"), ("dst", "b"))]
    close = close_links(firsts.select("fp")).join(ends[0], "src").join(ends[1], "dst").select(F.col("a").alias("src"), F.col("b").alias("dst"))
    keyed = sets_of.select("h", "n", F.posexplode("prefix").alias("pos", "key"))  # a set holds a key once
    met = durable(keyed.groupBy("key").count().where("count > 1").select("key"))
    shared = durable(narrow_join(keyed, met, "key", "left_semi"))
    links = verified(equal.union(close).union(star_pairs(shared)), sets_of, docs, text_col)
    roots = connected_components(links).withColumnsRenamed({"node": "h"})
    rooted = durable(shared.join(roots, "h", "left").withColumn("root", F.coalesce("root", "h")))
    links = links.union(verified(prefix_pairs(rooted), sets_of, docs, text_col))
    roots = connected_components(links).withColumnsRenamed({"node": "h"})
    return keep_one(docs, marked.select("mark", "id", "h").join(roots, "h", "left").select("mark", "id", F.coalesce("root", "h").alias("root")))
