from collections import defaultdict
from fractions import Fraction

import numpy as np

from pyspark.sql import functions as F

import corpus_pipeline
from helioquery.llm.nearcopies import differing_bits, drop_similar, sketch_of
from helioquery.llm.simhash import drop_near_copies, fingerprint


def shingles(text):
    words = (text or "").lower().split()
    return frozenset(tuple(words[i : i + 5]) for i in range(max(1, len(words) - 4))) if words else frozenset()


def brute(rows):
    """Ids kept: the least of each component of all pairs with Jaccard >= 0.8; every pair that shares a shingle is compared."""
    ids = sorted(rows)
    sets = {i: shingles(rows[i]) for i in ids}
    up, at = {i: i for i in ids}, defaultdict(list)

    def find(i):
        while up[i] != i:
            i = up[i]
        return i

    links = []
    for i in ids:
        common = defaultdict(int)
        for s in sets[i] or [None]:
            for j in at[s]:
                common[j] += 1
            at[s].append(i)
        for j, n in common.items():
            if sets[i] == sets[j] or Fraction(n, len(sets[i]) + len(sets[j]) - n) >= Fraction(4, 5):
                a, b = find(i), find(j)
                up[max(a, b)] = min(a, b)
                links.append((i, j))
    return {i for i in ids if find(i) == i}, links


def test_stage_equals_brute_force_jaccard(spark):
    rng = np.random.default_rng(3)
    rows = {}
    for g in range(150):
        base = [f"w{x}" for x in rng.integers(0, 5000, int(rng.integers(3, 300)))]
        for _ in range(4):
            own = list(base)
            for at in rng.integers(0, len(own), int(rng.integers(0, 2 + len(own) // 40))):
                own[at] = f"x{rng.integers(0, 5000)}"
            rows[len(rows)] = " ".join(own)
    rows |= {1000: "", 1001: None, 1002: " \n", 1003: "a b c d e f g h i", 1004: "a b c d e f g h", 1005: "a b c d e f g"}
    want, links = brute(rows)
    far = [(fingerprint(rows[i]) ^ fingerprint(rows[j])).bit_count() for i, j in links]
    assert sum(x > 3 for x in far) > 50 and len(want) > 200
    docs = spark.createDataFrame([(i, t, "en", "s", len(t or "")) for i, t in rows.items()], "doc_id long, text string, lang string, source string, n_chars long")
    assert {r["doc_id"] for r in corpus_pipeline.near_copies(spark, docs, "").collect()} == want
    assert drop_similar(docs.limit(0)).count() == 0


def test_stage_on_the_corpus_equals_brute_force_jaccard(spark):
    docs = spark.read.parquet("/root/testdata/sf0.1/documents.parquet")
    want, _ = brute({r["doc_id"]: r["text"] for r in docs.select("doc_id", "text").collect()})
    assert {r["doc_id"] for r in drop_similar(docs).select("doc_id").collect()} == want


def test_one_row_of_each_group_stays_whatever_the_ids(spark):
    a, b, c, d = (" ".join(f"{x}{i}" for i in range(40)) for x in "abcd")
    rows = [(5, a), (6, a), (5, b), (3, b), (None, c), (None, c + " "), (None, c), (None, d), (9, d), (9, d)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    for drop in (drop_near_copies, drop_similar):
        got = sorted(((r["text"].strip(), r["doc_id"]) for r in drop(docs).collect()), key=str)
        assert got == [(a, 5), (b, 3), (c, None), (d, 9)], drop
    assert drop_near_copies(docs.limit(0)).count() == 0


def test_sketches_never_differ_in_more_bits_than_sets(spark):
    rng = np.random.default_rng(4)
    rows = []
    for n in (0, 1, 5, 250, 256, 257, 700, 3000):
        for k in (0, 1, 40):
            a = np.unique(rng.integers(-(1 << 63), 1 << 63, n + k))
            b = np.unique(np.concatenate([a[k:], rng.integers(-(1 << 63), 1 << 63, k // 2)]))
            rows.append((len(np.setxor1d(a, b)), sketch_of(a).tolist(), sketch_of(b).tolist()))
    got = spark.createDataFrame(rows, "apart int, a array<long>, b array<long>").select("apart", differing_bits(F.col("a"), F.col("b")).alias("bits")).collect()
    assert all(r["bits"] <= r["apart"] and (r["apart"] - r["bits"]) % 2 == 0 for r in got) and any(r["bits"] > 30 for r in got)
