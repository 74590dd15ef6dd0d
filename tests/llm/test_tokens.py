import zlib
from collections import defaultdict

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from helioquery.llm.bpe import Lexicon, Vocabulary, compile_lexicon, encode_decode
from helioquery.llm.packing import CAPACITY, OpenWindows, pack

SF = "/root/testdata/sf0.001"
ODD = [None, "", " ", "\n\n  a  b \t c", "don't I'LL we've", "İstanbul ΣΑΣ ß ﬁ é 각", "日本 123 ４５ ½", "x<|endoftext|>y <|startoftext|>", "a\x1cb\x85c d e", "aaaa aaaaaaaaa" * 30, "!!! ?? <| a", "é" * 700, "́a ̈", "word " * 20000, "  x", "x  ", " \n y"]


def spec(name):
    with open(public_tokenizers.path(name)) as f:
        return f.read()


@pytest.fixture(scope="module")
def docs(spark):
    own = spark.createDataFrame([(100_000 + i, t) for i, t in enumerate(ODD)] + [(None, "no id"), (7, "twice"), (7, "twice")], "doc_id long, text string")
    return spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").union(own).withColumn("ids", F.lit(1)).withColumn("start", F.lit("x"))


def test_word_bpe_equals_the_library(spark, docs):
    t = Tokenizer.from_str(spec("word_bpe_49k.json"))
    t.no_truncation()
    got = encode_decode(docs, spec("word_bpe_49k.json"), lexicon=500).collect()
    texts = sorted((r["doc_id"] or 0, r["text"] or "") for r in docs.collect())
    assert len(got) == len(texts)
    for r, (doc_id, text) in zip(sorted(got, key=lambda r: (r["doc_id"] or 0)), texts):
        ids = t.encode(text, add_special_tokens=False).ids
        assert (r["n_tokens"], r["ids"]) == (len(ids), " ".join(map(str, ids))), text[:80]
        assert r["decoded"] == t.decode(ids, skip_special_tokens=False)
    assert encode_decode(docs.limit(0), spec("word_bpe_49k.json")).count() == 0


def test_lexicon_is_exact_and_shares_suffixes():
    words = [b"a", b"taking", b"making", b"baking", b"bakings", b"zoo", "é".encode()]
    lex = Lexicon(compile_lexicon({w: [n, n + 1] for n, w in enumerate(words)}))
    assert lex.find([*words, b"bak", b"", b"zooo", b"q"]) == [[n, n + 1] for n in range(len(words))] + [None] * 4
    assert len(Lexicon(compile_lexicon({b"taking": [1], b"making": [2]})).final) == 7  # a root and one chain for 'aking'
    assert Lexicon(compile_lexicon({})).find([b"a"]) == [None]
    assert Vocabulary(spec("word_bpe_49k.json")).merge([]) == []


def test_packing_is_exact_and_tight(spark, docs):
    t = Tokenizer.from_str(spec("byte_bpe_50k.json"))
    t.no_truncation()
    rows = pack(docs, spec("byte_bpe_50k.json")).collect()
    ids = defaultdict(list)
    for r in docs.collect():
        ids[r["doc_id"]].append(np.array(t.encode(r["text"] or "", add_special_tokens=False).ids + [0], dtype="<u4"))
    for doc_id, own in ids.items():
        got = sorted((r["start"], r["length"], r["ids_crc32"], r["doc_tokens"]) for r in rows if r["doc_id"] == doc_id)
        want = sorted((s, len(x[s : s + CAPACITY]), zlib.crc32(x[s : s + CAPACITY].tobytes()), len(x)) for x in own for s in range(0, len(x), CAPACITY))
        assert got == want, doc_id
    sequences = defaultdict(list)
    for r in rows:
        sequences[r["sequence_id"]].append((r["offset"], r["length"]))
    for placed in sequences.values():
        at = 0
        for offset, length in sorted(placed):
            assert offset == at
            at += length
        assert at <= CAPACITY
    total = sum(r["length"] for r in rows)
    assert total / (len(sequences) * CAPACITY) > 0.9
    assert pack(docs.limit(0), spec("byte_bpe_50k.json")).count() == 0


def test_best_fit_takes_the_tightest_window():
    rng = np.random.default_rng(5)
    tree, rooms = OpenWindows(64), []
    for n in sorted(rng.integers(1, 65, 500).tolist(), reverse=True):
        window, offset = tree.place(n)
        fit = [r for r in rooms if r >= n]
        if fit:
            assert rooms[window] == min(fit)
        else:
            assert window == len(rooms)
            rooms.append(64)
        assert offset == 64 - rooms[window]
        rooms[window] -= n
