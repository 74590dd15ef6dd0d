"""Sequence packing by best-fit decreasing over a segment tree of remaining capacities."""

from __future__ import annotations

import json
import re
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import tiktoken
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from .common import durable, text_groups

CAPACITY = 1024
END_ID = 0
SPECIAL = "<|endoftext|>"
#: Sequence ids: the packing task's number above these bits, its own count below.
TASK_BITS = 40
#: Pieces that a packing task gets at least, unless there are fewer: so many fill windows about as well as all would.
SHARE = 50_000
#: The ranks' pattern engine gives up within a run of a million blanks; texts with half as many in a row take the other way.
BLANK_RUN = 500_000
_BLANK = re.compile(rf"\s{{{BLANK_RUN}}}")
#: The pre-tokenizer's pattern, a fixed value of the public byte-level vocabularies.
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""


def byte_letters() -> dict[str, int]:
    """The printable letter that a byte-level vocabulary writes for each byte: itself where printable, else the next from 256."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    other = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(256 + n): b for n, b in enumerate(other)}


class ByteBPE:
    """Ids of a byte-level BPE file: a text goes through its ranks, one with a special token or an endless blank run through the whole tokenizer."""

    def __init__(self, spec: str):
        letters, model = byte_letters(), json.loads(spec)["model"]
        ranks = {bytes(letters[c] for c in token): i for token, i in model["vocab"].items() if all(c in letters for c in token)}
        self.fast = tiktoken.Encoding("ranks", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})
        self.whole = Tokenizer.from_str(spec)
        self.whole.no_truncation()
        self.whole.no_padding()

    def encode(self, texts: list[str | None], end: int = END_ID) -> Iterator[np.ndarray]:
        """uint32 ids of each text, ``end`` last; null is empty."""
        last, quick = np.array([end], dtype="<u4"), self.fast.encode_ordinary
        for text in texts:
            if not text:
                yield last
            elif SPECIAL in text or len(text) >= BLANK_RUN and _BLANK.search(text):
                yield np.array([*self.whole.encode(text, add_special_tokens=False).ids, end], dtype="<u4")
            else:
                own = quick(text)
                own.append(end)
                yield np.array(own, dtype="<u4")


class OpenWindows:
    """Open windows by remaining capacity, with a segment tree that finds the tightest one that fits."""

    def __init__(self, capacity: int):
        self.capacity, self.size = capacity, 1 << capacity.bit_length()
        self.open: list[list[int]] = [[] for _ in range(capacity + 1)]
        self.tree = bytearray(2 * self.size)
        self.made = 0

    def _set(self, room: int, on: int) -> None:
        i = self.size + room
        self.tree[i] = on
        i >>= 1
        while i:
            up = self.tree[2 * i] | self.tree[2 * i + 1]
            if self.tree[i] == up:
                break
            self.tree[i] = up
            i >>= 1

    def _tightest(self, length: int) -> int | None:
        i, tree = self.size + length, self.tree
        if tree[i]:
            return length
        while i > 1:
            if not i & 1 and tree[i + 1]:  # to the right of a left child
                i += 1
                while i < self.size:
                    i = 2 * i if tree[2 * i] else 2 * i + 1
                return i - self.size
            i >>= 1
        return None

    def place(self, length: int) -> tuple[int, int]:
        """(window, offset) for a piece."""
        room = self._tightest(length)
        if room is None:
            window, room = self.made, self.capacity
            self.made += 1
        else:
            window = self.open[room].pop()
            if not self.open[room]:
                self._set(room, 0)
        left = room - length
        if left:
            if not self.open[left]:
                self._set(left, 1)
            self.open[left].append(window)
        return window, self.capacity - room


def pieces(docs: DataFrame, spec: str, id_col: str = "doc_id", text_col: str = "text", capacity: int = CAPACITY, end: int = END_ID) -> DataFrame:
    """Cut each document's ids into full windows and a rest: (id, start, length, ids_crc32, doc_tokens)."""
    shared = docs.sparkSession.sparkContext.broadcast(spec)  # the vocabulary: a fixed public file of about 1.5 MB
    kind = docs.schema[id_col].dataType.simpleString()
    models: list[ByteBPE] = []

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        models[:] = models or [ByteBPE(shared.value)]
        for batch in batches:
            for first, texts in text_groups(batch.column(1)):
                rows, start, length, crc, total = [], [], [], [], []
                for n, ids in enumerate(models[0].encode(texts, end)):
                    for at in range(0, len(ids), capacity):
                        part = ids[at : at + capacity]
                        rows.append(first + n)
                        start.append(at)
                        length.append(len(part))
                        crc.append(zlib.crc32(part.tobytes()))
                        total.append(len(ids))
                columns = [batch.column(0).take(pa.array(rows, pa.int64())), *(pa.array(x, pa.int64()) for x in (start, length, crc, total))]
                yield pa.RecordBatch.from_arrays(columns, names=["id", "start", "length", "ids_crc32", "doc_tokens"])

    return docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text")).mapInArrow(run, f"id {kind}, start long, length long, ids_crc32 long, doc_tokens long")


def pack(docs: DataFrame, spec: str, id_col: str = "doc_id", text_col: str = "text", capacity: int = CAPACITY, end: int = END_ID) -> DataFrame:
    """Pack the token ids of all documents into sequences of at most ``capacity`` ids.

    :param spec: JSON of a byte-level BPE tokenizer.
    :return: one row per piece: (doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset).

    Every id, with one end id per document, lies in exactly one piece. Null and empty texts are the end id alone.
    Texts over a window are first cut into full windows, each a sequence of its own; the rests are packed by best-fit
    decreasing. Repeated rows and rows without id are packed like others. An empty table gives an empty table; other
    columns are ignored.

    Texts don't move: only pieces of a few numbers are shuffled, at random over the tasks, sorted there and placed as
    they stream by. The number of tasks follows from the number of pieces alone, so that windows fill alike under any
    setting of Spark; pieces are written before they are counted, so that texts are read once. A task holds no more than a number for each of its open windows, and its order is a function of the
    pieces alone, so a repeated task gives the same sequences.
    """
    mixed = F.xxhash64("id", "start", "ids_crc32", "doc_tokens")
    cut = durable(pieces(docs, spec, id_col, text_col, capacity, end))
    dealt = cut.repartition(max(1, cut.count() // SHARE), mixed)
    dealt = dealt.sortWithinPartitions(F.desc("length"), "id", "start", "ids_crc32", "doc_tokens")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        windows, base = OpenWindows(capacity), TaskContext.get().partitionId() << TASK_BITS
        for batch in batches:
            placed = [windows.place(n) for n in batch.column("length").to_pylist()]
            extra = [pa.array([base + w for w, _ in placed], pa.int64()), pa.array([o for _, o in placed], pa.int64())]
            yield pa.RecordBatch.from_arrays([*batch.columns, *extra], names=[*batch.schema.names, "sequence_id", "offset"])

    kind = docs.schema[id_col].dataType.simpleString()
    out = dealt.mapInArrow(run, f"id {kind}, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long")
    return out.withColumnRenamed("id", id_col)
