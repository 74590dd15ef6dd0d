import zlib
from collections import Counter
from math import log10

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F

from helioquery.llm.common import crc_of_id
from helioquery.llm.langid import Pieces, fit, forward, identify, in_fold, public_pieces
from helioquery.llm.ngramlm import EliasFano, lowest, quantised, restored, score_texts

SF = "/root/testdata/sf0.01"


def test_forward_sums_all_segmentations():
    pieces = ["▁", "▁a", "a", "b", "ab", "ba"]
    p = np.random.default_rng(0).random((7, 2))

    def total(word, k):
        if not word:
            return 1.0
        out = 0.0
        for n in range(1, len(word) + 1):
            if word[:n] in pieces:
                out += p[pieces.index(word[:n]), k] * total(word[n:], k)
        if word[0] not in pieces:
            out += p[6, k] * total(word[1:], k)
        return out

    words = ["▁abab", "▁", "ba", "▁xab", "x"]
    want = np.log([[total(w, k) for k in range(2)] for w in words])
    assert np.allclose(forward(Pieces(pieces), p, words), want)


@pytest.fixture(scope="module")
def language_model(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    with open(public_tokenizers.path("piece_bpe_32k.model"), "rb") as f:
        pieces = public_pieces(f.read())
    return fit(docs.where(~in_fold(crc_of_id(F.col("doc_id")), 5)), pieces)


def test_language_held_out_accuracy(spark, language_model):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    held = docs.where(in_fold(crc_of_id(F.col("doc_id")), 5) & F.col("lang").isNotNull())
    got = identify(held, language_model).join(held.select("doc_id", "lang"), "doc_id")
    right, n = got.agg(F.avg((F.col("lang_pred") == F.col("lang")).cast("double")), F.count("*")).first()
    assert n > 100 and right > 0.95


def test_language_odd_rows(spark, language_model):
    rows = [(1, None), (2, ""), (3, "12 34 !! \n"), (None, "the of and"), (5, "x" * 100_000), (5, "the " * 50_000), (6, "日本語")]
    got = identify(spark.createDataFrame(rows, "doc_id long, text string").withColumn("score", F.lit("x")), language_model).collect()
    assert [(r["doc_id"], r["lang_pred"], r["score"]) for r in got[:3]] == [(1, "und", 0.0), (2, "und", 0.0), (3, "und", 0.0)]
    assert len(got) == 7 and all(r["lang_pred"] != "und" and 0 < r["score"] <= 1 for r in got[3:])
    empty = spark.createDataFrame([], "doc_id long, text string, lang string")
    assert identify(empty, language_model).count() == 0
    none = fit(empty, ["a"])
    assert identify(spark.createDataFrame(rows, "doc_id long, text string"), none).where("lang_pred = 'und'").count() == 7


def test_elias_fano_equals_a_sorted_array():
    rng = np.random.default_rng(2)
    for n, universe in ((0, 10), (1, 1), (5, 1 << 63), (2000, 5000), (3000, 1 << 60), (700, 3)):
        values = np.sort(rng.integers(0, universe, n, dtype=np.int64).astype(np.uint64))
        ef = EliasFano(*EliasFano.pack(values, universe))
        if n:
            assert (ef.get(np.arange(n)) == values).all()
            x = rng.integers(0, universe, 500, dtype=np.int64).astype(np.uint64)
            a, b = np.sort(rng.integers(0, n + 1, (2, 500)), axis=0)
            want = np.clip(np.searchsorted(values, x), a, b)
            assert (ef.successor(x, a, b) == want).all()
    low = lowest(10**12, 20)  # the rarest pair of a word that is nearly every token keeps its place
    assert np.allclose(np.log10(restored(quantised(np.array([0.0, -3.3, -11.99]), low), low)), [0, -3.3, -11.99], atol=0.03) and restored(np.zeros(1, np.uint8), low)[0] == 0


def test_scores_equal_brute_force(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").where("length(text) < 20000")
    odd = spark.createDataFrame([(900_001, None), (900_002, " \n"), (900_003, "new words Only"), (900_003, "new words Only"), (None, "a\u000bB Ä")], "doc_id long, text string")
    docs = docs.union(odd).withColumn("held", in_fold(crc_of_id(F.col("doc_id")), 10)).withColumn("slice", F.lit("x"))
    got = score_texts(docs, "held", slice_chars=300_000).collect()
    rows = [(r["doc_id"], [w for w in (r["text"] or "").encode().lower().split()] + [b""]) for r in docs.collect()]
    held = [i is not None and zlib.crc32(str(i).encode()) % 10 == 0 for i, _ in rows]
    c = Counter(w for (_, t), h in zip(rows, held) if not h for w in t)
    pairs = Counter(p for (_, t), h in zip(rows, held) if not h for p in zip([b"", *t], t))
    total, types = sum(c.values()), len(c)
    base = lambda w: (c[w] + 0.1) / (total + 0.1 * (types + 1))
    low, want = lowest(total, 20), []
    kept = {p: float(restored(quantised(np.array([log10(n / (c[p[0]] + 20))]), low), low)[0]) for p, n in pairs.items()}
    for (i, t), h in zip(rows, held):
        model = sum(log10(kept.get((u, v), 0) + 20 * base(v) / (c[u] + 20)) for u, v in zip([b"", *t], t))
        assert abs(model - sum(log10((pairs[u, v] + 20 * base(v)) / (c[u] + 20)) for u, v in zip([b"", *t], t))) <= 0.02 * len(t)
        want.append((i or -1, h, len(t), sum(c[w] > 0 for w in t), total, sum(log10(base(w)) for w in t), model))
    key = lambda r: (r[0], r[5])
    got = sorted(((r["doc_id"] or -1, r["held_out"], r["n_tokens"], r["n_known"], r["train_tokens"], r["base_score"], r["score"]) for r in got), key=key)
    for a, b in zip(got, sorted(want, key=key), strict=True):
        assert a[:5] == b[:5] and abs(a[5] - b[5]) < 1e-6 and abs(a[6] - b[6]) < 1e-6
    assert score_texts(docs.limit(0), "held").count() == 0
