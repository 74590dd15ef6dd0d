"""Language identification by unigram piece models whose score of a word sums over all its segmentations."""

from __future__ import annotations

import re
import sys
from collections import Counter
from collections.abc import Iterator
from itertools import chain, islice

import numpy as np
import pyarrow as pa
import sentencepiece
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from .common import durable, text_groups

#: Training documents of a language, about; a language with more is sampled by a hash of the row.
TRAIN_DOCS = 1_000
ROUNDS = 3
#: Numbers of a model (pieces x languages) that workers can hold; a fit that needs more is refused.
MODEL_NUMBERS = 100_000_000
START = "▁"
#: Letters of a training run that are counted together; a longer one is counted in parts. Prediction cuts nothing.
TRAIN_RUN = 48
#: Letters after which the running probabilities are scaled up again.
RESCALE = 16
#: A text's evidence counts as that of this many words at most, which keeps the score of mixed texts below 1.
EVIDENCE_WORDS = 10
#: Chunks of text that a worker remembers, and what a group of texts adds; then it begins anew, with the same results.
KNOWN = 100_000
UNDETERMINED = "und"

# Letters are what str.isalpha() says: no digits, no underscore, no halves or circled numbers. A class that names its
# ranges is looked up in a table, one that excludes is searched range by range.
_CODES = np.flatnonzero([chr(n).isalpha() for n in range(sys.maxunicode + 1)])
_ENDS = np.flatnonzero(np.diff(_CODES) > 1)
_LETTERS = re.compile("[" + "".join(f"{chr(a)}-{chr(b)}" for a, b in zip(_CODES[np.append(0, _ENDS + 1)], _CODES[np.append(_ENDS, -1)])) + "]+")
_ASCII_LETTERS = re.compile("[a-z]+")
_PRIME = np.uint64(1_099_511_628_211)


def public_pieces(model: bytes) -> list[str]:
    """The letter pieces of a public vocabulary, lower-cased; START marks the beginning of a word."""
    sp = sentencepiece.SentencePieceProcessor(model_proto=model)
    found = {sp.id_to_piece(i).lower() for i in range(sp.get_piece_size()) if not (sp.is_control(i) or sp.is_unknown(i) or sp.is_byte(i))}
    return sorted(p for p in found if p == START or p.removeprefix(START).isalpha())


class Pieces:
    """Finds the pieces that start at any place of many words at once; the last id is any other letter."""

    def __init__(self, pieces: list[str]):
        ids = {p: n for n, p in enumerate(pieces)}
        known = {p[:n]: ids.get(p[:n], -1) for p in pieces for n in range(1, len(p) + 1)}
        keys = np.array([self._hash(p) for p in known], dtype=np.uint64)
        order = np.argsort(keys)
        self.keys, self.ids, self.unknown = keys[order], np.array(list(known.values()))[order], len(pieces)
        self.longest = max(map(len, pieces), default=1)

    @staticmethod
    def _hash(text: str) -> int:
        h = 0
        for c in text:
            h = (h * int(_PRIME) + ord(c) + 1) & (1 << 64) - 1
        return h

    def matches(self, letters: np.ndarray) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
        """(begin, end, rows, piece ids), by begin; letters: code points, a word a row."""
        m, n = letters.shape
        for i in range(n):
            rows, h, single = np.arange(m), np.zeros(m, dtype=np.uint64), np.zeros(m, dtype=bool)
            for j in range(i, n):
                h = h * _PRIME + letters[rows, j] + np.uint64(1)
                at = np.minimum(np.searchsorted(self.keys, h), len(self.keys) - 1)
                ok = self.keys[at] == h
                rows, h, at = rows[ok], h[ok], at[ok]
                piece = self.ids[at]
                hit = piece >= 0
                if j == i:
                    single[rows[hit]] = True
                    other = np.flatnonzero(~single)
                    if len(other):
                        yield i, i + 1, other, np.full(len(other), self.unknown)
                if hit.any():
                    yield i, j + 1, rows[hit], piece[hit]
                if not len(rows):
                    break


def _by_length(words: list[str], block: int = 20_000) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    sizes = np.fromiter(map(len, words), dtype=np.int64, count=len(words))
    for n in np.unique(sizes):
        own = np.flatnonzero(sizes == n)
        for at in range(0, len(own), block):
            part = own[at : at + block]
            text = "".join([words[k] for k in part.tolist()])
            yield part, np.frombuffer(text.encode("utf-32-le", "surrogatepass"), dtype="<u4").reshape(len(part), n).astype(np.uint64)


def forward(pieces: Pieces, probs: np.ndarray, words: list[str]) -> np.ndarray:
    """Natural log of each word's probability under each language (words x languages), whatever the words' lengths."""
    out = np.zeros((len(words), probs.shape[1]))
    ring = pieces.longest + 1  # a piece ends at most so far from where it begins
    for rows, letters in _by_length(words):
        n = letters.shape[1]
        alpha = np.zeros((min(ring, n + 1), len(rows), probs.shape[1]))
        alpha[0], scale, last = 1, 0.0, 0
        for i, j, r, ids in pieces.matches(letters):
            if i != last:
                if n >= ring:
                    alpha[last % ring] = 0
                last = i
                if i % RESCALE == 0:
                    top = np.maximum(alpha.max(axis=0), 1e-300)
                    alpha /= top
                    scale = scale + np.log(top)
            alpha[j % ring][r] += alpha[i % ring][r] * probs[ids]
        out[rows] = np.log(np.maximum(alpha[n % ring], 1e-300)) + scale
    return out


def expected(pieces: Pieces, probs: np.ndarray, words: list[str], counts: np.ndarray) -> np.ndarray:
    """Expected uses of each piece in each language, over all segmentations of the words (counts: words x languages)."""
    total = np.zeros_like(probs)
    for rows, letters in _by_length(words):
        n, found = letters.shape[1], list(pieces.matches(letters))
        alpha = np.zeros((n + 1, len(rows), probs.shape[1]))
        beta = np.zeros_like(alpha)
        alpha[0] = beta[-1] = 1
        for i, j, r, ids in found:
            alpha[j][r] += alpha[i][r] * probs[ids]
        for i, j, r, ids in reversed(found):
            beta[i][r] += beta[j][r] * probs[ids]
        weight = counts[rows] / np.maximum(alpha[-1], 1e-300)
        for i, j, r, ids in found:
            uses = alpha[i][r] * beta[j][r] * probs[ids] * weight[r]
            for k in range(probs.shape[1]):
                total[:, k] += np.bincount(ids, uses[:, k], minlength=len(total))
    return total


def split_words(chunk: str) -> list[str]:
    """Lower-case runs of letters, marked at their start."""
    low = chunk.lower()
    if low.isalpha():
        return [START + low]
    return [START + run for run in (_ASCII_LETTERS if low.isascii() else _LETTERS).findall(low)]


def train_words(chunk: str) -> list[str]:
    """The same, long runs in parts."""
    return [run[at : at + TRAIN_RUN] for run in split_words(chunk) for at in range(0, len(run), TRAIN_RUN)]


class Numbers(dict):
    """Numbers its keys from 0 as they are asked for."""

    def __missing__(self, key) -> int:
        self[key] = n = len(self)
        return n


class LanguageModel:
    """Piece probabilities of each language over a fixed vocabulary."""

    def __init__(self, pieces: Pieces, languages: list[str], probs: np.ndarray):
        self.pieces, self.languages, self.probs = pieces, languages, probs
        self._forget()

    def _forget(self) -> None:
        self.words, self.scores = Numbers(), np.zeros((0, len(self.languages)))
        # of chunks between white space: number, log probability and count of words
        self.chunks, self.sums, self.sizes = Numbers(), np.zeros((0, len(self.languages))), np.zeros(0, dtype=np.int64)

    def _learn(self, values: list[bytes]) -> None:
        """Scores chunks, those that got the next numbers; words are scored once."""
        own = [split_words(v.decode("utf-8", "surrogatepass")) for v in values]
        sizes = np.fromiter(map(len, own), dtype=np.int64, count=len(own))
        first = len(self.words)
        flat = np.fromiter(map(self.words.__getitem__, chain.from_iterable(own)), dtype=np.int64, count=int(sizes.sum()))
        self.scores = np.concatenate([self.scores, forward(self.pieces, self.probs, list(islice(self.words, first, None)))])
        at = np.repeat(np.arange(len(own)), sizes)
        sums = [np.bincount(at, self.scores[flat, k], minlength=len(own)) for k in range(len(self.languages))]
        self.sums, self.sizes = np.concatenate([self.sums, np.stack(sums, axis=1)]), np.concatenate([self.sizes, sizes])

    def predict(self, texts: list[str | None]) -> list[tuple[str, float]]:
        if not self.languages:
            return [(UNDETERMINED, 0.0)] * len(texts)
        if len(self.chunks) > KNOWN:
            self._forget()
        first, codes, n_codes = len(self.chunks), [], []
        for text in texts:
            parts = (text or "").encode("utf-8", "surrogatepass").split()  # of bytes: ASCII white space only
            codes.append(np.fromiter(map(self.chunks.__getitem__, parts), dtype=np.int64, count=len(parts)))
            n_codes.append(len(parts))
        if len(self.chunks) > first:
            self._learn(list(islice(self.chunks, first, None)))
        doc, code = np.repeat(np.arange(len(texts)), n_codes), np.concatenate([np.zeros(0, dtype=np.int64), *codes])
        score = np.stack([np.bincount(doc, self.sums[code, k], minlength=len(texts)) for k in range(len(self.languages))], axis=1)
        words = np.bincount(doc, self.sizes[code], minlength=len(texts))
        out = []
        for own, n in zip(score, words.tolist()):
            if not n:
                out.append((UNDETERMINED, 0.0))
                continue
            shares = np.exp((own - own.max()) * min(1.0, EVIDENCE_WORDS / n))
            best = int(np.argmax(own))
            out.append((self.languages[best], float(shares[best] / shares.sum())))
        return out


def fit(docs: DataFrame, vocabulary: list[str], text_col: str = "text", lang_col: str = "lang", id_col: str = "doc_id", train_docs: int = TRAIN_DOCS, rounds: int = ROUNDS) -> LanguageModel:
    """Fit piece probabilities by expectation-maximisation on a bounded sample of labelled rows.

    About ``train_docs`` rows of each language, chosen by a hash of the row, are counted word by word, all words of them.
    The expected uses of each round are summed on the executors; what comes to the driver is a number for each piece and
    language. Every language that a row names is learnt; a table of so many that workers can't hold the model is an error.
    Rows without language or text don't take part; without any row the model knows no language.
    """
    rows = docs.where(F.col(lang_col).isNotNull() & F.col(text_col).isNotNull()).select(F.col(lang_col).alias("lang"), F.col(text_col).alias("text"), F.col(id_col).alias("id"))
    most = MODEL_NUMBERS // (len(vocabulary) + 1)
    sizes = {r["lang"]: r["n"] for r in rows.groupBy("lang").agg(F.count("*").alias("n")).limit(most + 1).collect()}
    if len(sizes) > most:
        raise ValueError(f"a model of more than {most} languages over {len(vocabulary)} pieces does not fit the workers")
    languages = sorted(sizes)
    pieces = Pieces(vocabulary)
    if not languages:
        return LanguageModel(pieces, [], np.zeros((len(vocabulary) + 1, 0)))
    share = F.create_map(*(F.lit(x) for lang in languages for x in (lang, min(1.0, train_docs / sizes[lang]))))
    sample = rows.where(F.pmod(F.xxhash64("id", "text"), F.lit(1_000_003)) < share[F.col("lang")] * 1_000_003)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            langs = batch.column("lang").to_pylist()
            for first, texts in text_groups(batch.column("text")):
                found = Counter((langs[first + k], w) for k, text in enumerate(texts) for w in train_words(text))
                yield pa.RecordBatch.from_arrays([pa.array([x for x, _ in found], pa.string()), pa.array([w for _, w in found], pa.string()), pa.array(list(found.values()), pa.int64())], names=["lang", "word", "n"])

    counted = durable(sample.select("lang", "text").mapInArrow(count, "lang string, word string, n long").groupBy("lang", "word").agg(F.sum("n").alias("n")))
    probs = np.full((len(vocabulary) + 1, len(languages)), 1 / (len(vocabulary) + 1))
    for _ in range(rounds):
        uses = _expected_uses(counted, pieces, languages, probs) + 0.01
        probs = uses / uses.sum(axis=0)
    return LanguageModel(pieces, languages, probs)


def _expected_uses(counted: DataFrame, pieces: Pieces, languages: list[str], probs: np.ndarray) -> np.ndarray:
    """Expected uses of each piece in each language over the counted words, summed on the executors."""
    shared, number = counted.sparkSession.sparkContext.broadcast((pieces, probs)), {x: k for k, x in enumerate(languages)}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pieces, probs = shared.value
        total = np.zeros_like(probs)
        for batch in batches:
            lang = np.array([number[x] for x in batch.column(0).to_pylist()], dtype=np.int64)
            words, n = batch.column(1).to_pylist(), batch.column(2).to_numpy()
            for k in np.unique(lang).tolist():
                own = np.flatnonzero(lang == k)
                total[:, [k]] += expected(pieces, probs[:, [k]], [words[i] for i in own.tolist()], n[own, None].astype(float))
        piece, k = np.nonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(piece), pa.array(k), pa.array(total[piece, k])], names=["piece", "lang", "uses"])

    found = counted.mapInArrow(run, "piece long, lang long, uses double").groupBy("piece", "lang").agg(F.sum("uses").alias("uses")).toArrow()
    shared.unpersist()
    out = np.zeros_like(probs)
    out[found["piece"].to_numpy(), found["lang"].to_numpy()] = found["uses"].to_numpy()
    return out


def identify(docs: DataFrame, model: LanguageModel, id_col: str = "doc_id", text_col: str = "text", columns: list[str] | None = None) -> DataFrame:
    """(id, lang_pred, score in 0 to 1) of each row, from whole texts in one narrow pass.

    :param columns: the columns that go along instead of the id alone, so that no join has to bring rows and verdicts
        together.

    Null texts and texts without a letter are ``und`` with score 0; repeated rows, rows without id and very long texts
    are rows like others; an empty table gives an empty table; other columns are ignored.
    """
    shared = docs.sparkSession.sparkContext.broadcast((model.pieces, model.languages, model.probs))  # at most MODEL_NUMBERS numbers
    along = columns or [id_col]
    models: list[LanguageModel] = []

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        models[:] = models or [LanguageModel(*shared.value)]
        for batch in batches:
            for first, texts in text_groups(batch.column(len(along))):
                lang, score = zip(*models[0].predict(texts))
                own = [batch.column(k).slice(first, len(texts)) for k in range(len(along))]
                yield pa.RecordBatch.from_arrays([*own, pa.array(lang, pa.string()), pa.array(score, pa.float64())], names=[*along, "lang_pred", "score"])

    schema = StructType([docs.schema[c] for c in along]).add("lang_pred", "string").add("score", "double")
    return docs.select(*along, F.col(text_col).alias("__text")).mapInArrow(run, schema)


def in_fold(crc: Column, parts: int) -> Column:
    """True for the held-out remainder 0; rows without id are not held out."""
    return F.coalesce(crc % parts == 0, F.lit(False))
