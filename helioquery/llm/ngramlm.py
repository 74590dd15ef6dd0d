"""Language-model scoring with Elias-Fano n-gram tries that are sharded over the cluster.

Runs of documents are written as slices of bounded size. A slice asks the shards for each of its distinct n-grams once, in sorted
order, and a shard's answer is a number for each question in the same order. A shard sums the questions' counts,
builds its trie and answers from it; nothing that grows with the corpus is gathered in one place.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import array_groups, durable, mapped, partitions

SLICE_CHARS = 12_000_000
#: Weight of the lower order: P(v|u) = (c(uv) + PRIOR * P(v)) / (c(u) + PRIOR).
PRIOR = 20.0
ADD = 0.1
#: Bits of a successor's hash within its context.
CHILD_BITS = 40
#: Quantisation: the codes 1 to 255 stand for log10 probabilities from 0 down to the least that the counts allow; 0 means absent.
STEPS = 254
END = b""

_SELECT = np.array([[([k for k in range(8) if b >> k & 1] + [0] * 8)[n] for n in range(8)] for b in range(256)], dtype=np.int64)


class EliasFano:
    """A monotone sequence: low bits packed, high bits in unary, queried by place and by successor."""

    def __init__(self, head: np.ndarray, lows: np.ndarray, highs: np.ndarray, ones: np.ndarray):
        self.n, self.low_bits, self.lows, self.highs, self.ones = int(head[0]), int(head[1]), lows, highs, ones
        self.zeros = np.arange(len(ones), dtype=np.int64) * 64 - ones

    @staticmethod
    def pack(values: np.ndarray, universe: int) -> list[np.ndarray]:
        """The arrays of the structure (all int64 or uint64) for sorted values below ``universe``."""
        n = len(values)
        low = max(0, (max(universe, 1) // max(n, 1)).bit_length() - 1)
        values = values.astype(np.uint64)
        at, mask = np.arange(n, dtype=np.uint64) * np.uint64(low), np.uint64((1 << low) - 1)
        lows = np.zeros(n * low // 64 + 2, dtype=np.uint64)
        part, word, shift = values & mask, (at >> np.uint64(6)).astype(np.int64), at & np.uint64(63)
        np.bitwise_or.at(lows, word, part << shift)
        over = shift + np.uint64(low) > np.uint64(64)
        np.bitwise_or.at(lows, word[over] + 1, part[over] >> (np.uint64(64) - shift[over]))
        high = (values >> np.uint64(low)).astype(np.int64)
        size = (n + (universe >> low) + 2 + 63) // 64
        bits = np.zeros(size * 64, dtype=np.uint8)
        bits[high + np.arange(n)] = 1
        highs = np.packbits(bits, bitorder="little").view("<u8")
        ones = np.concatenate([[0], np.cumsum(np.bitwise_count(highs), dtype=np.int64)])
        return [np.array([n, low], dtype=np.int64), lows, highs, ones]

    def _select(self, k: np.ndarray, zero: bool) -> np.ndarray:
        """Place of the k-th one or zero of the high bits."""
        before = self.zeros if zero else self.ones
        word = np.searchsorted(before, k, side="right") - 1
        bits = self.highs[word] ^ (np.uint64(2**64 - 1) if zero else np.uint64(0))
        rest, byte = k - before[word], np.zeros(len(k), dtype=np.int64)
        here = (bits & np.uint64(255)).astype(np.int64)
        for _ in range(7):
            many = np.bitwise_count(here).astype(np.int64)
            go = rest >= many
            rest = np.where(go, rest - many, rest)
            byte = np.where(go, byte + 1, byte)
            here = ((bits >> (byte * 8).astype(np.uint64)) & np.uint64(255)).astype(np.int64)
        return word * 64 + byte * 8 + _SELECT[here, rest]

    def _low(self, i: np.ndarray) -> np.ndarray:
        at = i.astype(np.uint64) * np.uint64(self.low_bits)
        word, shift = (at >> np.uint64(6)).astype(np.int64), at & np.uint64(63)
        part = self.lows[word] >> shift
        over = shift > 0
        part[over] |= self.lows[word[over] + 1] << (np.uint64(64) - shift[over])
        return part & np.uint64((1 << self.low_bits) - 1)

    def get(self, i: np.ndarray) -> np.ndarray:
        """The values at places i."""
        high = (self._select(i, False) - i).astype(np.uint64)
        return high << np.uint64(self.low_bits) | self._low(i)

    def successor(self, x: np.ndarray, begin: np.ndarray, end: np.ndarray) -> np.ndarray:
        """The first place in [begin, end) whose value is at least x; end if there is none."""
        x = x.astype(np.uint64)
        high = (x >> np.uint64(self.low_bits)).astype(np.int64)
        lo = np.where(high > 0, self._select(np.maximum(high - 1, 0), True) - high + 1, 0)
        hi = np.minimum(np.maximum(self._select(high, True) - high, begin), end)
        lo = np.minimum(np.maximum(lo, begin), hi)
        want = x & np.uint64((1 << self.low_bits) - 1)
        while True:
            live = np.flatnonzero(lo < hi)
            if not len(live):
                return lo
            mid = (lo[live] + hi[live]) // 2
            less = self._low(mid) < want[live]
            lo[live] = np.where(less, mid + 1, lo[live])
            hi[live] = np.where(less, hi[live], mid)


class Trie:
    """Two levels: contexts (hashes), and below each its successors with quantised probabilities.

    The children of context r are the values r * 2^CHILD_BITS + hash, at the places that the monotone pointers tell.
    """

    def __init__(self, blob: bytes):
        self.map = mapped(blob)
        sizes = np.frombuffer(self.map, "<i8", 13)
        arrays, at = [], 104
        for k, n in enumerate(sizes.tolist()):
            arrays.append(np.frombuffer(self.map, "u1" if k == 12 else "<i8" if k % 4 in (0, 3) else "<u8", n, at))
            at += n * (1 if k == 12 else 8)
        self.contexts, self.pointers, self.children = (EliasFano(*arrays[k : k + 4]) for k in (0, 4, 8))
        self.codes = arrays[12]

    @staticmethod
    def build(contexts: np.ndarray, pointers: np.ndarray, children: np.ndarray, codes: np.ndarray) -> bytes:
        """contexts: sorted 63-bit hashes; pointers: first child of each, and the end; children: sorted; codes: their probabilities."""
        packed = [*EliasFano.pack(contexts, 1 << 63), *EliasFano.pack(pointers, len(children) + 1), *EliasFano.pack(children, max(1, len(contexts)) << CHILD_BITS), codes]
        return b"".join([np.array([len(a) for a in packed], "<i8").tobytes(), *(a.tobytes() for a in packed)])

    def find(self, context: np.ndarray, child: np.ndarray) -> np.ndarray:
        """Code of each (context hash, successor hash); 0 if the trie lacks it."""
        out = np.zeros(len(context), dtype=np.uint8)
        n = self.contexts.n
        if not n:
            return out
        r = self.contexts.successor(context, np.zeros(len(context), dtype=np.int64), np.full(len(context), n))
        live = np.flatnonzero(r < n)
        live = live[self.contexts.get(r[live]) == context[live]]
        r = r[live]
        begin, end = self.pointers.get(r).astype(np.int64), self.pointers.get(r + 1).astype(np.int64)
        want = r.astype(np.uint64) << np.uint64(CHILD_BITS) | child[live]
        i = self.children.successor(want, begin, end)
        ok = i < end
        live, i, want = live[ok], i[ok], want[ok]
        ok = self.children.get(i) == want
        out[live[ok]] = self.codes[i[ok]]
        return out


def lowest(total: int, prior: float) -> float:
    """log10 of a probability below which no stored one can lie: one count behind a word that is every token."""
    return -float(np.log10(total + prior + 1))


def quantised(log10: np.ndarray, low: float) -> np.ndarray:
    return (1 + np.clip(np.rint(log10 / low * STEPS), 0, STEPS)).astype(np.uint8)


def restored(codes: np.ndarray, low: float) -> np.ndarray:
    """Probabilities of codes; 0 for absent."""
    return np.where(codes > 0, 10.0 ** ((codes.astype(np.float64) - 1) / STEPS * low), 0.0)


def slices(batches: Iterator[pa.RecordBatch], most: int) -> Iterator[pa.RecordBatch]:
    """One row for each run of rows (id, text, held) of about ``most`` bytes of text: the run's columns, its text compressed."""
    parts: list[tuple[pa.Array, pa.Array, pa.Array]] = []
    made, size = TaskContext.get().partitionId() << 32, 0

    def row() -> pa.RecordBatch:
        ids, held, texts = (pa.concat_arrays(x) for x in zip(*parts))
        ends = np.concatenate([[0], np.cumsum(pc.binary_length(texts).to_numpy())])
        one = lambda values: pa.ListArray.from_arrays([0, len(ids)], values)
        body = zstandard.compress(b"".join(texts.cast(pa.large_binary()).to_pylist()), 3)
        return pa.RecordBatch.from_arrays([pa.array([made]), one(ids), one(held), one(pa.array(ends[1:])), pa.array([body])], names=["slice", "ids", "held", "ends", "body"])

    for batch in batches:
        for at, texts in array_groups(batch.column(1), most // 12):
            texts = pc.fill_null(texts.cast(pa.large_string()), "")
            own = sum(pc.binary_length(texts).to_pylist())
            if parts and size + own > most:
                yield row()
                parts, size, made = [], 0, made + 1
            parts.append((batch.column(0).slice(at, len(texts)), batch.column(2).slice(at, len(texts)), texts))
            size += own
    if parts:
        yield row()


class Slice:
    """The tokens of a slice's documents as numbers of distinct words; an end stands before the first and after each document."""

    def __init__(self, row: pa.Table):
        self.ids, self.held, ends = (row.column(c).combine_chunks().flatten() for c in ("ids", "held", "ends"))
        offsets = np.concatenate([[0], ends.to_numpy()])
        texts = pa.LargeStringArray.from_buffers(len(ends), pa.py_buffer(offsets.tobytes()), pa.py_buffer(zstandard.decompress(row.column("body")[0].as_py())))
        listed = pc.ascii_split_whitespace(pc.ascii_lower(texts))
        coded = listed.values.dictionary_encode()
        words, codes = coded.dictionary.to_pylist(), coded.indices.to_numpy().astype(np.int64) + 1
        real = codes != (words.index("") + 1 if "" in words else 0)  # what stands outside of blanks at a text's ends
        ends = np.concatenate([[0], np.cumsum(real)])[listed.offsets.to_numpy()]
        self.size = np.diff(ends) + 1
        stream = np.insert(codes[real], ends, 0)  # an end before the first and after each
        self.context, self.token = stream[:-1], stream[1:]
        self.train = np.repeat(~self.held.to_numpy(zero_copy_only=False), self.size)
        mask, digest = (1 << 63) - 1, xxhash.xxh64_intdigest
        self.hash = np.array([digest(END, 7) & mask, *(digest(w, 7) & mask for w in words)], dtype=np.uint64)
        self.order = np.argsort(self.hash, kind="stable")

    def words(self, shards: int) -> Iterator[tuple[int, np.ndarray]]:
        """(shard, numbers of its words by hash)."""
        shard = (self.hash[self.order] % np.uint64(shards)).astype(np.int64)
        for k in range(shards):
            yield k, self.order[shard == k]

    def pairs(self, count: np.ndarray, total: int, shards: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Distinct pairs by shard, context hash and successor hash: (shard, context, successor, train count), and each token's pair."""
        rank = np.empty(len(self.hash), dtype=np.int64)
        rank[self.order] = np.arange(len(rank))
        key, inverse = np.unique(rank[self.context] << 32 | rank[self.token], return_inverse=True)
        u, v = self.order[key >> 32], self.order[key & (1 << 32) - 1]
        seen = np.bincount(inverse, self.train, minlength=len(key)).astype(np.int64)
        child = self.hash[v] & np.uint64((1 << CHILD_BITS) - 1)
        # a frequent context is spread over so many shards that none gets more than its share
        fan = np.minimum(shards, 1 + 4 * count[u] * shards // max(total, 1)).astype(np.uint64)
        shard = ((self.hash[u] + child % fan) % np.uint64(shards)).astype(np.int64)
        order = np.lexsort((child, self.hash[u], shard))
        place = np.empty(len(order), dtype=np.int64)
        place[order] = np.arange(len(order))
        return shard[order], u[order], child[order], seen[order], place[inverse]


def _packed(*arrays: np.ndarray) -> bytes:
    return zlib.compress(b"".join([np.array([a.nbytes for a in arrays], "<i8").tobytes(), *(a.tobytes() for a in arrays)]), 1)


def _unpacked(blob: bytes, *kinds: str) -> list[np.ndarray]:
    blob = zlib.decompress(blob)
    out, at = [], 8 * len(kinds)
    for kind, n in zip(kinds, np.frombuffer(blob, "<i8", len(kinds)).tolist()):
        out.append(np.frombuffer(blob, kind, n // np.dtype(kind).itemsize, at))
        at += n
    return out


def _counts(replies: pa.Table, words: Slice, shards: int) -> np.ndarray:
    """Training counts of the slice's words, from the answers of the shards."""
    told = {r["shard"]: r["body"] for r in replies.to_pylist() if r["step"] == 1}
    count = np.zeros(len(words.hash), dtype=np.int64)
    for k, numbers in words.words(shards):
        if len(numbers):
            count[numbers] = np.frombuffer(zlib.decompress(told[k]), "<i8")
    return count


MESSAGE = "slice long, shard int, step int, body binary, tokens long, types long"


def _message(slice_no: int, rows: list[tuple]) -> pa.Table:
    shard, step, body, tokens, types = (list(x) for x in zip(*rows)) if rows else ([],) * 5
    kinds = (pa.int32(), pa.int32(), pa.binary(), pa.int64(), pa.int64())
    columns = [pa.array(x, k) for x, k in zip((shard, step, body, tokens, types), kinds)]
    return pa.Table.from_arrays([pa.array([slice_no] * len(rows), pa.int64()), *columns], names=["slice", "shard", "step", "body", "tokens", "types"])


def score_texts(docs: DataFrame, held: str, id_col: str = "doc_id", text_col: str = "text", slice_chars: int = SLICE_CHARS, prior: float = PRIOR) -> DataFrame:
    """Score whole texts with a unigram and a bigram model of the rows whose column ``held`` is not true.

    :return: (doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score), scores in log10.

    Null and wordless texts are one end token. Repeated rows each count and are scored; rows without id are rows like
    any; very long texts stand in a slice whole. An empty table gives an empty table; other columns are ignored. Words
    are known by 63 bits of their hash, successors within a context by 40; probabilities of pairs are kept in 255 steps.
    """
    spark, kind = docs.sparkSession, docs.schema[id_col].dataType.simpleString()
    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"), F.coalesce(F.col(held), F.lit(False)).alias("held"))
    packed = durable(rows.mapInArrow(lambda batches: slices(batches, slice_chars), f"slice long, ids array<{kind}>, held array<boolean>, ends array<bigint>, body binary"))
    number, size = packed.agg(F.count("*"), F.coalesce(F.sum(F.element_at("ends", -1)), F.lit(0))).first()
    shards = max(1, -(-size // slice_chars))
    dealt = packed.repartition(max(partitions(spark), number), "slice")

    def ask_words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for n in range(batch.num_rows):
                own = Slice(pa.Table.from_batches([batch.slice(n, 1)]))
                seen = np.bincount(own.token, own.train, minlength=len(own.hash)).astype(np.int64)
                body = [(k, 0, _packed(own.hash[n], seen[n]), 0, 0) for k, n in own.words(shards) if len(n)]
                yield from _message(batch.column("slice")[n].as_py(), body).combine_chunks().to_batches()

    def tell_words(key: tuple, table: pa.Table) -> pa.Table:
        slices, asked = table.column("slice").to_pylist(), [_unpacked(b, "<u8", "<i8") for b in table.column("body").to_pylist()]
        known, inverse = np.unique(np.concatenate([h for h, _ in asked]), return_inverse=True)
        total = np.bincount(inverse, np.concatenate([c for _, c in asked]), minlength=len(known)).astype(np.int64)
        out, at = [], 0
        for n, (s, (h, _)) in enumerate(zip(slices, asked)):
            body = zlib.compress(total[inverse[at : at + len(h)]].astype("<i8").tobytes(), 1)
            at += len(h)
            sums = (0, 0) if n else (int(total.sum()), int((total > 0).sum()))
            out.append(_message(s, [(key[0].as_py(), 1, body, *sums)]))
        return pa.concat_tables(out)

    counted = durable(packed.mapInArrow(ask_words, MESSAGE).groupBy("shard").applyInArrow(tell_words, MESSAGE))
    total, types = counted.agg(F.coalesce(F.sum("tokens"), F.lit(0)), F.coalesce(F.sum("types"), F.lit(0))).first()
    low = lowest(total, prior)

    def ask_pairs(key: tuple, table: pa.Table, replies: pa.Table) -> pa.Table:
        own = Slice(table)
        count = _counts(replies, own, shards)
        shard, u, child, seen, _ = own.pairs(count, total, shards)
        cut = np.append(np.flatnonzero(np.diff(shard, prepend=-1)), len(shard))
        out = []
        for a, b in zip(cut[:-1].tolist(), cut[1:].tolist()):
            first = np.flatnonzero(np.diff(u[a:b], prepend=-1))
            many = np.diff(np.append(first, b - a))
            own_u, v = u[a:b][first], child[a:b]
            body = _packed(own.hash[own_u], count[own_u], many.astype("<u4"), (v & np.uint64(2**32 - 1)).astype("<u4"), (v >> np.uint64(32)).astype("u1"), seen[a:b].astype("<u4"))
            out.append((int(shard[a]), 0, body, 0, 0))
        return _message(key[0].as_py(), out)

    def tell_pairs(key: tuple, table: pa.Table) -> pa.Table:
        slices, asked = table.column("slice").to_pylist(), []
        for body in table.column("body").to_pylist():
            h, c, many, bottom, top, seen = _unpacked(body, "<u8", "<i8", "<u4", "<u4", "u1", "<u4")
            asked.append((h, c, many, top.astype(np.uint64) << np.uint64(32) | bottom, seen))
        contexts, first = np.unique(np.concatenate([x[0] for x in asked]), return_index=True)
        times = np.concatenate([x[1] for x in asked])[first]
        rank = np.concatenate([np.repeat(np.searchsorted(contexts, x[0]), x[2]) for x in asked])
        keys, inverse = np.unique(rank.astype(np.uint64) << np.uint64(CHILD_BITS) | np.concatenate([x[3] for x in asked]), return_inverse=True)
        seen = np.bincount(inverse, np.concatenate([x[4] for x in asked]), minlength=len(keys))
        keys, seen = keys[seen > 0], seen[seen > 0]
        above = (keys >> np.uint64(CHILD_BITS)).astype(np.int64)
        codes = quantised(np.log10(seen / (times[above] + prior)), low)
        trie = Trie(Trie.build(contexts, np.searchsorted(above, np.arange(len(contexts) + 1)), keys, codes))
        out = [_message(s, [(key[0].as_py(), 2, zlib.compress(trie.find(np.repeat(h, many), v).tobytes(), 1), 0, 0)]) for s, (h, _, many, v, _) in zip(slices, asked)]
        return pa.concat_tables(out)

    pairs = dealt.groupBy("slice").cogroup(counted.groupBy("slice")).applyInArrow(ask_pairs, MESSAGE).groupBy("shard").applyInArrow(tell_pairs, MESSAGE)
    known = counted.union(pairs)

    def score(key: tuple, table: pa.Table, replies: pa.Table) -> pa.Table:
        own = Slice(table)
        count = _counts(replies, own, shards)
        shard, _, _, _, place = own.pairs(count, total, shards)
        told = {r["shard"]: r["body"] for r in replies.to_pylist() if r["step"] == 2}
        codes = np.frombuffer(b"".join(zlib.decompress(told[k]) for k in np.unique(shard).tolist()), dtype=np.uint8)
        base = (count + ADD) / (total + ADD * (types + 1))
        back = prior * base[own.token] / (count[own.context] + prior)
        n = len(own.ids)
        doc = np.repeat(np.arange(n), own.size)
        sums = [np.bincount(doc, x, minlength=n) for x in (count[own.token] > 0, np.log10(base)[own.token], np.log10(restored(codes[place], low) + back))]
        return pa.Table.from_arrays(
            [own.ids, own.held, pa.array(own.size), pa.array(sums[0].astype(np.int64)), pa.array(np.full(n, total, dtype=np.int64)), pa.array(sums[1]), pa.array(sums[2])],
            names=["id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score"],
        )

    schema = f"id {kind}, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double"
    return dealt.groupBy("slice").cogroup(known.groupBy("slice")).applyInArrow(score, schema).withColumnRenamed("id", id_col)
