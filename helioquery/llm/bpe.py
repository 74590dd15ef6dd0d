"""BPE encoding and decoding: a minimal acyclic transducer of frequent words, exact merges for the others."""

from __future__ import annotations

import json
import os
import re
from array import array
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from .common import array_groups, durable, mapped
from .packing import byte_letters

#: Words of the lexicon, at most. It is a cache of exact results, so its size changes speed alone.
LEXICON = 32_768
#: Longest word of the lexicon, in bytes.
LONGEST = 64
MARK = "</w>"
#: Marks that end many words; a run of them is one word of its own, whatever stands before.
PLAIN_MARKS = ".,;:!?"
#: Letters that the file's normalizer keeps, but for their case, and its pre-tokenizer never parts: lower-case ASCII, Latin-1,
#: Greek, Cyrillic, kana, Han and Hangul syllables. Words of them need neither.
PLAIN = r"^[a-z\x{AA}\x{B5}\x{BA}\x{C0}-\x{D6}\x{D8}-\x{F6}\x{F8}-\x{FF}\x{386}\x{388}-\x{38A}\x{38C}\x{38E}-\x{3A1}\x{3A3}-\x{3CE}\x{400}-\x{45F}\x{3041}-\x{3096}\x{30A1}-\x{30FA}\x{4E00}-\x{9FA5}\x{AC00}-\x{D7A3}]+$"
#: Chunks that a worker remembers; beyond that it starts anew.
REMEMBERED = 600_000
#: Distinct words that a counting task holds, about, before it passes them on.
COUNTED = 600_000


class Vocabulary:
    """Merges and ids of a word-level BPE file with an end-of-word mark."""

    def __init__(self, spec: str):
        model = json.loads(spec)["model"]
        self.ids: dict[str, int] = model["vocab"]
        self.names = {i: t for t, i in self.ids.items()} | {t["id"]: t["content"] for t in json.loads(spec)["added_tokens"]}
        self.special = {t["content"]: t["id"] for t in json.loads(spec)["added_tokens"]}
        letter = {b: c for c, b in byte_letters().items()}
        self.first = np.array([self.ids[letter[b]] for b in range(256)], dtype=np.int64)
        self.last = np.array([self.ids[letter[b] + MARK] for b in range(256)], dtype=np.int64)
        left = np.array([self.ids[a] for a, _ in model["merges"]], dtype=np.int64)
        right = np.array([self.ids[b] for _, b in model["merges"]], dtype=np.int64)
        made = np.array([self.ids[a + b] for a, b in model["merges"]], dtype=np.int64)
        self.pairs = left << 32 | right
        order = np.argsort(self.pairs, kind="stable")
        self.pairs, self.rank, self.made = self.pairs[order], order, made[order]

    def merge(self, words: list[bytes]) -> list[list[int]]:
        """Ids of each word by exact merges: in all words at once, the lowest-ranked pair first, left to right."""
        out: list[list[int]] = [[]] * len(words)
        sizes = np.fromiter(map(len, words), dtype=np.int64, count=len(words))
        by_size = np.argsort(sizes, kind="stable")
        at = 0
        while at < len(words):  # words of one length together, and a bounded number of cells
            size = int(sizes[by_size[at]])
            stop = min(int(np.searchsorted(sizes[by_size], size, side="right")), at + max(1, 1_000_000 // size))
            some = by_size[at:stop]
            for k, ids in zip(some.tolist(), self._merge([words[k] for k in some], sizes[some])):
                out[k] = ids
            at = stop
        return out

    def _merge(self, words: list[bytes], sizes: np.ndarray) -> list[list[int]]:
        width = int(sizes.max())
        ids = np.full((len(words), width + 1), -1, dtype=np.int64)  # -1: nothing; it pairs with nothing
        row = np.repeat(np.arange(len(words)), sizes)
        col = np.arange(int(sizes.sum())) - np.repeat(np.cumsum(sizes) - sizes, sizes)
        ids[row, col] = self.first[np.frombuffer(b"".join(words), dtype=np.uint8)]
        ends = np.fromiter((w[-1] for w in words), dtype=np.int64, count=len(words))
        ids[np.arange(len(words)), sizes - 1] = self.last[ends]
        live, never = np.arange(len(words)), len(self.pairs)
        while len(live):
            now = ids[live]
            now = now[:, : max(2, int((now >= 0).sum(axis=1).max()) + 1)]  # one cell past the longest
            pair = np.where(now[:, 1:] >= 0, now[:, :-1] << 32 | now[:, 1:], -1)
            place = np.zeros(pair.shape, dtype=np.int64)
            real = pair >= 0
            place[real] = np.minimum(np.searchsorted(self.pairs, pair[real]), never - 1)
            rank = np.where(self.pairs[place] == pair, self.rank[place], never)
            best = rank.min(axis=1)
            go = best < never
            live, now, rank, place, best = live[go], now[go], rank[go], place[go], best[go]
            if not len(live):
                break
            hit = rank == best[:, None]
            for c in range(1, hit.shape[1]):  # in runs of one letter each second pair remains
                hit[:, c] &= ~hit[:, c - 1]
            r, c = np.nonzero(hit)
            now[r, c] = self.made[place[r, c]]
            now[r, c + 1] = -1
            keep = now >= 0
            packed = np.full_like(now, -1)
            r, c = np.nonzero(keep)
            packed[r, (np.cumsum(keep, axis=1) - 1)[r, c]] = now[r, c]
            ids[live] = -1
            ids[live, : packed.shape[1]] = packed
        return [one[:n].tolist() for one, n in zip(ids, (ids >= 0).sum(axis=1))]


def compile_lexicon(entries: dict[bytes, list[int]]) -> bytes:
    """A minimal acyclic transducer: equal suffixes share states, arc outputs add up to a word's number, numbers give ids.

    Layout: eight int64 counts, then the arrays that ``Lexicon`` maps.
    """
    words = sorted(entries)
    register: dict[tuple, int] = {}
    finals: list[bool] = []
    states: list[tuple] = []
    below: list[int] = []
    path: list[list] = [[False, []]]  # the open states of the last word: (final, arcs)

    def close(upto: int, last: bytes) -> None:
        while len(path) > upto + 1:
            final, arcs = path.pop()
            key = (final, tuple(arcs))
            if key not in register:
                register[key] = len(states)
                finals.append(final)
                states.append(key[1])
                below.append(final + sum(below[t] for _, t in arcs))
            path[-1][1].append((last[len(path) - 1], register[key]))

    before = b""
    for word in words:
        same = len(os.path.commonprefix([before, word]))
        close(same, before)
        path.extend([False, []] for _ in word[same:])
        path[-1][0] = True
        before = word
    close(0, before)
    final, arcs = path[0]
    root = len(states)
    finals.append(final)
    states.append(tuple(arcs))
    key, target, output = [], [], []
    for s, own in enumerate(states):
        passed = int(finals[s])
        for label, t in own:
            key.append(s << 8 | label)
            target.append(t)
            output.append(passed)
            passed += below[t]
    flat = [i for w in words for i in entries[w]]
    ends = np.cumsum([0, *(len(entries[w]) for w in words)])
    arrays = [np.array(key, "<i8"), np.array(target, "<i8"), np.array(output, "<i8"), np.array(finals, "<i8"), ends.astype("<i8"), np.array(flat, "<i8")]
    head = np.array([root, *(len(a) for a in arrays), 0], "<i8")
    return b"".join(a.tobytes() for a in (head, *arrays))


class Lexicon:
    """The transducer over memory-mapped arrays; words are looked up together, one letter of all at a time."""

    def __init__(self, blob: bytes):
        self.map = mapped(blob)
        head = np.frombuffer(self.map, "<i8", 8)
        self.root, at, arrays = int(head[0]), 64, []
        for n in head[1:7].tolist():
            arrays.append(np.frombuffer(self.map, "<i8", n, at))
            at += 8 * n
        self.key, self.target, self.output, self.final, self.ends, self.ids = arrays

    def find(self, words: list[bytes]) -> list[list[int] | None]:
        """Ids of each word; None if it isn't in the lexicon."""
        out: list[list[int] | None] = [None] * len(words)
        sizes = np.fromiter(map(len, words), dtype=np.int64, count=len(words))
        live = np.flatnonzero((sizes > 0) & (sizes <= LONGEST))
        if not len(live) or not len(self.key):
            return out
        flat, begin = np.frombuffer(b"".join(words), dtype=np.uint8), np.cumsum(sizes) - sizes
        state, number, depth = np.full(len(live), self.root), np.zeros(len(live), dtype=np.int64), 0
        while len(live):
            done = sizes[live] == depth
            hit = done & (self.final[state] == 1)
            for w, n in zip(live[hit].tolist(), number[hit].tolist()):
                out[w] = self.ids[self.ends[n] : self.ends[n + 1]].tolist()
            live, state, number = live[~done], state[~done], number[~done]
            want = state << 8 | flat[begin[live] + depth]
            arc = np.minimum(np.searchsorted(self.key, want), len(self.key) - 1)
            ok = self.key[arc] == want
            live, state, number, depth = live[ok], self.target[arc[ok]], number[ok] + self.output[arc[ok]], depth + 1
        return out


class WordBPE:
    """Encoder and decoder of one worker: chunks between white space are worked out once while they are remembered."""

    def __init__(self, spec: str, blob: bytes):
        self.vocab, self.lexicon = Vocabulary(spec), Lexicon(blob)
        library = Tokenizer.from_str(spec)
        self.normal, self.cut = library.normalizer, library.pre_tokenizer
        self.letters = byte_letters()
        names = self.vocab.names
        self.names = pa.array([names.get(i, "") for i in range(max(names) + 1)], pa.string())
        self.numbers = pa.array([str(i) for i in range(len(self.names))], pa.string())
        self.special = re.compile("|".join(map(re.escape, sorted(self.vocab.special, key=len, reverse=True))) or r"(?!)")
        self._forget()

    def _forget(self) -> None:
        self.known: dict[str, int] = {}
        self.words: dict[str, int] = {}
        self.ids, self.used = np.zeros(1 << 16, dtype=np.int32), 0
        self.begin, self.size = array("q", [0]), array("q", [0])  # of each remembered list of ids; the first is empty

    def digests(self, texts: pa.Array) -> tuple[pa.Array, pa.Array, pa.Array]:
        """(counts, the decimal ids, the decoded texts) of all texts; null is empty."""
        texts = pc.fill_null(texts.cast(pa.large_string()), "")
        if pc.any(pc.match_substring(texts, "<|")).as_py():
            split = [self._special(t) for t in texts.to_pylist()]
            parts = pa.array([part for own in split for part, _ in own], pa.large_string())
            after = np.array([self.vocab.special.get(special, -1) for own in split for _, special in own])
            last = np.cumsum([len(own) for own in split]) - 1
        else:
            parts, after, last = texts, np.full(len(texts), -1), np.arange(len(texts))
        listed = pc.ascii_split_whitespace(pc.ascii_lower(parts))
        coded = listed.values.dictionary_encode()
        codes = self._learned(coded.dictionary)[coded.indices.to_numpy()]
        begin, each = (np.frombuffer(x, dtype=np.int64)[codes] for x in (self.begin, self.size))
        upto = np.concatenate([[0], np.cumsum(each)])
        ids = self.ids[np.repeat(begin - upto[:-1], each) + np.arange(upto[-1])]
        ends = upto[listed.offsets.to_numpy()[1:]]
        ids = np.insert(ids, ends[after >= 0], after[after >= 0])
        ends = (ends + np.cumsum(after >= 0))[last]
        offsets = pa.array(np.concatenate([[0], ends]), pa.int32())
        left, right = (pc.binary_join(pa.ListArray.from_arrays(offsets, x.take(pa.array(ids))), " ") for x in (self.numbers, self.names))
        return pa.array(np.diff(ends, prepend=0), pa.int64()), left, right

    def _learned(self, chunks: pa.Array) -> np.ndarray:
        """The place of each chunk's list of ids."""
        if len(self.known) > REMEMBERED:
            self._forget()
        values, known = chunks.to_pylist(), self.known
        out = np.array([known.get(v, -1) for v in values], dtype=np.int64)
        missing = np.flatnonzero(out < 0)
        if len(missing):
            own = chunks.take(pa.array(missing))
            core = pc.utf8_rtrim(own, characters=PLAIN_MARKS)
            tail = pc.utf8_length(own).to_numpy() - pc.utf8_length(core).to_numpy()
            plain = pc.match_substring_regex(core, PLAIN).to_numpy(zero_copy_only=False)
            marks = pc.utf8_length(core).to_numpy() == 0
            lower, places = pc.utf8_lower(core).to_pylist(), []
            for k, n, simple, bare, word in zip(missing.tolist(), tail.tolist(), plain.tolist(), marks.tolist(), lower):
                chunk = values[k]
                if simple:
                    places.append([word, chunk[-n:]] if n else [word])
                elif bare:
                    places.append([chunk] if chunk else [])
                else:
                    places.append([bytes(self.letters[c] for c in w).decode("utf-8", "surrogateescape") for w, _ in self.cut.pre_tokenize_str(self.normal.normalize_str(chunk))])
            self._encode(dict.fromkeys(w for ws in places for w in ws if w not in self.words))
            words, begin, size = self.words, self.begin, self.size
            for k, ws in zip(missing.tolist(), places):
                if len(ws) == 1:
                    place = words[ws[0]]
                else:
                    at = [words[w] for w in ws]
                    place = self._keep([i for p in at for i in self.ids[begin[p] : begin[p] + size[p]].tolist()])
                known[values[k]] = out[k] = place
        return out

    def _encode(self, words: dict[str, None]) -> None:
        own = [w.encode("utf-8", "surrogateescape") for w in words]
        found = self.lexicon.find(own)
        missing = [k for k, x in enumerate(found) if x is None]
        for k, x in zip(missing, self.vocab.merge([own[k] for k in missing])):
            found[k] = x
        for word, ids in zip(words, found):
            self.words[word] = self._keep(ids)

    def _keep(self, ids: list[int]) -> int:
        """Remember a list of ids; its place."""
        stop = self.used + len(ids)
        if stop > len(self.ids):
            self.ids = np.concatenate([self.ids, np.zeros(max(len(self.ids), len(ids)), dtype=np.int32)])
        self.ids[self.used : stop] = ids
        self.begin.append(self.used)
        self.size.append(len(ids))
        self.used = stop
        return len(self.size) - 1

    def _special(self, text: str) -> list[tuple[str, str]]:
        """The text's parts, each with the special token that follows it."""
        out, at = [], 0
        for m in self.special.finditer(text):
            out.append((text[at : m.start()], m[0]))
            at = m.end()
        return [*out, (text[at:], "")]


def frequent_words(docs: DataFrame, text_col: str = "text", most: int = LEXICON) -> list[str]:
    """The most frequent words of plain letters that occur twice or more, counted over all texts, ``most`` at most.

    Words as frequent as the first one that finds no room are left out with it. Only a count of words by frequency and
    the words themselves come to the driver.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, rows = [], 0

        def summed() -> pa.Table:
            return pa.concat_tables(held).group_by("word").aggregate([("n", "sum")]).rename_columns(["word", "n"])

        for batch in batches:
            for _, texts in array_groups(batch.column(0)):
                words = pc.ascii_split_whitespace(pc.utf8_lower(pc.drop_null(texts).cast(pa.large_string()))).values.value_counts()
                names = pc.utf8_rtrim(words.field(0), characters=PLAIN_MARKS)
                good = pc.and_(pc.match_substring_regex(names, PLAIN), pc.less_equal(pc.binary_length(names), LONGEST))
                held.append(pa.table({"word": names.filter(good).cast(pa.string()), "n": words.field(1).filter(good)}))
                rows += held[-1].num_rows
                if rows > COUNTED:
                    held = [summed()]
                    rows = held[0].num_rows
                    if rows > COUNTED // 2:
                        yield from held.pop().to_batches()
                        rows = 0
        if held:
            yield from summed().to_batches()

    counted = docs.select(text_col).mapInArrow(run, "word string, n long").groupBy("word").agg(F.sum("n").alias("n"))
    counted = durable(counted.where("n > 1"))
    by_n = counted.groupBy("n").agg(F.count("*").alias("words"))
    above = F.sum("words").over(Window.orderBy(F.desc("n")))
    least = by_n.select("n", above.alias("above")).where(F.col("above") <= most).agg(F.min("n")).first()[0]
    return [] if least is None else [r["word"] for r in counted.where(F.col("n") >= least).collect()]


def encode_decode(docs: DataFrame, spec: str, id_col: str = "doc_id", text_col: str = "text", lexicon: int = LEXICON) -> DataFrame:
    """Encode and decode whole texts as the tokenizers library does with the file ``spec`` and no added special tokens.

    :return: (doc_id, n_tokens, ids: decimal ids joined by a space, decoded).

    Null is empty: no ids, an empty string. Special tokens that stand in a text are their ids. Repeated rows, rows
    without id and very long texts are rows like others; an empty table gives an empty table; other columns are ignored.

    Texts don't move. One pass counts words (summed before and after a shuffle of distinct words), the driver compiles
    the most frequent ones, at most ``lexicon`` of at most 64 bytes, and one narrow pass encodes.
    """
    vocab = Vocabulary(spec)
    words = [w.encode() for w in frequent_words(docs, text_col, lexicon)]
    blob = compile_lexicon(dict(zip(words, vocab.merge(words))))
    shared = docs.sparkSession.sparkContext.broadcast((spec, blob))  # both bounded: a fixed file, and the lexicon's limits
    kind = docs.schema[id_col].dataType.simpleString()
    models: list[WordBPE] = []

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        models[:] = models or [WordBPE(*shared.value)]
        for batch in batches:
            for first, texts in array_groups(batch.column(1)):
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(first, len(texts)), *models[0].digests(texts)], names=["id", "n_tokens", "ids", "decoded"])

    out = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text")).mapInArrow(run, f"id {kind}, n_tokens long, ids string, decoded string")
    return out.withColumnRenamed("id", id_col)
