"""Every stage over nulls, empty and very long texts, repeated rows and ids, an empty table; and the pipeline against brute force."""

from collections import defaultdict

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from helioquery.llm import chat, quality
from helioquery.llm.langid import identify
from helioquery.llm.pii import replace_pii
from helioquery.llm.queries import PII_KEY, language_model

SF = "/root/testdata/sf0.001"
STAGES = dict(corpus_pipeline.STAGES)
LONG = "the house and the river were on the other side of the hill " * 3000


def odd(spark):
    rows = [(None, "the first of these has no id at all", "en"), (None, "the second of these has another text", "en"), (None, None, "en"), (1, "", "en"), (2, " \n\t", None), (3, LONG, "en"), (4, "½ 12", "de")]
    rows += [(5, "one and the same row stands twice here", "en")] * 2 + [(6, "the id stands twice but with this text", "en"), (6, "a bad one: 12 34", "en")]
    return spark.createDataFrame([(i, t, lang, "web", len(t or "")) for i, t, lang in rows], spark.read.parquet(f"{SF}/documents.parquet").schema)


@pytest.mark.parametrize("name", list(STAGES))
def test_stages_over_odd_rows_and_an_empty_table(spark, name):
    more = spark.read.parquet(f"{SF}/documents.parquet").unionByName(odd(spark))
    out = STAGES[name](spark, more, SF)
    assert out.count() > 0
    if name != "packing":
        assert out.columns == more.columns and out.schema == more.schema
    assert STAGES[name](spark, more.limit(0), SF).count() == 0


def test_language_judges_each_row_by_itself(spark):
    more = spark.read.parquet(f"{SF}/documents.parquet").unionByName(odd(spark))
    left = [(r["doc_id"], r["text"]) for r in STAGES["language ID"](spark, more, SF).where("doc_id is null or doc_id <= 6").collect() if r["doc_id"] is None or "the" in r["text"]]
    kept = {t for _, t in left}
    assert {"the first of these has no id at all", "the second of these has another text", "the id stands twice but with this text", LONG} <= kept and "a bad one: 12 34" not in {t for i, t in left if i == 6} | {None}
    assert sum(t == "one and the same row stands twice here" for _, t in left) == 2


def near(a, b):
    """Whether one edit turns a into b."""
    if abs(len(a) - len(b)) > 1:
        return False
    a, b = sorted((a, b), key=len)
    i = next((k for k in range(len(a)) if a[k] != b[k]), len(a))
    return a[i + (len(a) == len(b)) :] == b[i + 1 :]


def shingles(text):
    words = (text or "").lower().split()
    return frozenset(tuple(words[i : i + 5]) for i in range(max(1, len(words) - 4))) if words else frozenset()


def test_pipeline_equals_brute_force(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    told = {r["doc_id"]: (r["lang_pred"], r["score"]) for r in identify(docs, language_model(docs)).collect()}
    texts = {r["doc_id"]: r["text"] for r in docs.collect() if told[r["doc_id"]][0] != "und" and told[r["doc_id"]][1] >= 0.5}
    # lines: the first of equal ones stays unless a near one stands earlier
    place, order = {}, sorted(texts)
    cut = {i: texts[i].split("\n") for i in order}
    norm = lambda x: " ".join(x.lower().split(" ")).strip() if "\t" not in x and "  " not in x else " ".join(x.lower().split())
    for i in order:
        for n, line in enumerate(cut[i]):
            if norm(line):
                place.setdefault(norm(line), (i, n))
    halves = defaultdict(list)
    for line in place:
        for size in (len(line), len(line) - 1):
            halves[size, 0, line[: size // 2]].append(line)
            halves[size, 1, line[len(line) - (size - size // 2) :]].append(line)
    gone = {max(place[a], place[b]) for same in halves.values() for k, a in enumerate(same) for b in same[:k] if a != b and near(a, b)}
    keep = {at for at in place.values() if at not in gone}
    texts = {i: "\n".join(x for n, x in enumerate(cut[i]) if (i, n) in keep or not x.split()) for i in order}
    # near copies: the least id of each component of shingle sets that are 0.8 alike
    sets, up = {i: shingles(t) for i, t in texts.items()}, {i: i for i in texts}

    def root(i):
        while up[i] != i:
            i = up[i]
        return i

    at = defaultdict(list)
    for i in order:
        for s in sets[i] or [None]:
            at[s].append(i)
    for a, b in {(a, b) for same in at.values() for k, b in enumerate(same) for a in same[:k]}:
        if 9 * len(sets[a] & sets[b]) >= 4 * (len(sets[a]) + len(sets[b])):
            x, y = sorted((root(a), root(b)))
            up[y] = x
    left = {i: t for i, t in texts.items() if root(i) == i}
    rows = spark.createDataFrame(list(left.items()), "doc_id long, text string")
    want = {r["doc_id"]: r["text"] for r in replace_pii(rows, PII_KEY).collect()}  # held against brute force in its own tests
    stages = docs
    for name in ("language ID", "line dedup", "SimHash near-dedup", "PII"):
        stages = STAGES[name](spark, stages, SF)
    assert {r["doc_id"]: r["text"] for r in stages.collect()} == want
    packed = corpus_pipeline.run(spark, SF)
    again = STAGES["packing"](spark, spark.createDataFrame(list(want.items()), "doc_id long, text string"), SF)
    cols = ["doc_id", "start", "length", "ids_crc32", "doc_tokens"]
    assert sorted(map(tuple, packed.select(cols).collect())) == sorted(map(tuple, again.select(cols).collect()))


def test_long_texts_and_repeated_rows(spark):
    docs = spark.createDataFrame([(1, LONG), (2, LONG), (2, LONG)], "doc_id long, text string")
    got = quality.with_quality(docs).select("doc_id", "n_words", "n_repeat_words").collect()
    assert len(got) == 3 and all((r["n_words"], r["n_repeat_words"]) == (39_000, 39_000) for r in got)
    turns = [(1, True, 0, "user", LONG), (1, False, 0, "user", LONG), (1, True, 1, "assistant", "x"), (1, False, 1, "assistant", LONG)]
    pairs = spark.createDataFrame(turns, "pair long, chosen boolean, turn int, role string, text string")
    out = chat.preference_pairs(pairs, "pair", "chosen").first()
    assert out["n_common"] == 1 and LONG in out["prompt"]
