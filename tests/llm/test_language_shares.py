import sys

import numpy as np
from pyspark.sql import functions as F

from helioquery.llm import langid
from helioquery.llm.langid import LanguageModel, Pieces, fit, forward, identify, split_words


def test_a_small_language_keeps_its_words_beside_large_ones(spark):
    rng = np.random.default_rng(2)
    rows = [(i, " ".join(f"{'bcd'[i % 2]}{'aeiou'[k % 5]}{'lmnrst'[k % 6]}{'aeiou'[k // 5 % 5]}" for k in rng.integers(0, 900, 400)), f"big{i % 2}") for i in range(40)]
    rows += [(100 + i, "zu zo zi za", "small") for i in range(3)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    pieces = ["▁", *(a + b for a in ("", "▁") for b in "abcdefghijklmnopqrstuvwxyz")]
    model = fit(docs, pieces)
    assert model.languages == ["big0", "big1", "small"]
    assert [x for x, _ in model.predict(["zu za zo", "bale base", "cale case"])] == ["small", "big0", "big1"]
    uses = model.probs[:, 2]
    assert uses.max() > 3 * uses.min()  # not uniform


def total(word, pieces, p):
    """Probability of a word, by its last piece."""
    alpha = [1.0] + [0.0] * len(word)
    for j in range(1, len(word) + 1):
        for i in range(j):
            if word[i:j] in pieces:
                alpha[j] += alpha[i] * p[word[i:j]]
        if word[j - 1] not in pieces:
            alpha[j] += alpha[j - 1] * p[None]
    return alpha[-1]


def test_long_runs_are_summed_whole():
    pieces = ["▁", "a", "ab", "ba", "▁abab"]
    p = np.full((6, 1), 0.4)
    word = "▁" + "abab" * 60
    want = np.log(total(word, pieces, dict.fromkeys([*pieces, None], 0.4)))
    assert np.allclose(forward(Pieces(pieces), p, [word]), want)
    small = forward(Pieces(pieces), p / 1000, ["▁" + "ab" * 5000])
    assert 5000 * np.log(0.0004) - 10 < small[0, 0] < 5000 * np.log(0.0004) + 200  # mostly one segmentation: ab each time


def test_numbers_that_are_no_letters_are_undetermined(spark):
    docs = spark.createDataFrame([(1, "½ ② ³ Ⅷ ٣"), (2, "ª"), (3, "漢")], "doc_id long, text string").withColumn("lang", F.lit("xx"))
    model = fit(docs, ["▁", "a"])
    assert [r["lang_pred"] for r in identify(docs, model).orderBy("doc_id").collect()] == ["und", "xx", "xx"]


def test_fit_and_identify_equal_brute_force(spark):
    rng = np.random.default_rng(7)
    texts = ["".join(rng.choice(list("abcd  éж."), 60)) for _ in range(30)]
    rows = [(k, t, "uv"[k % 3 == 0]) for k, t in enumerate(texts)] + [(None, texts[0], "u"), (3, texts[3], "v"), (50, None, "u"), (51, texts[1], None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    pieces = ["▁", "▁a", "a", "b", "c", "d", "ab", "ba", "cd", "é"]
    p = {x: dict.fromkeys([*pieces, None], 1 / 11) for x in "uv"}
    words = {x: [w for _, t, lang in rows if lang == x and t for w in split_words(t)] for x in "uv"}
    for _ in range(3):
        for x in "uv":
            uses = dict.fromkeys([*pieces, None], 0.01)
            for w in words[x]:
                whole = total(w, pieces, p[x])
                for i in range(len(w)):
                    for j in range(i + 1, len(w) + 1):
                        key = w[i:j] if w[i:j] in pieces else None
                        if key is not None or j == i + 1:
                            uses[key] += total(w[:i], pieces, p[x]) * p[x][key] * total(w[j:], pieces, p[x]) / whole
            p[x] = {k: v / sum(uses.values()) for k, v in uses.items()}
    model = fit(docs, pieces)
    for k, x in enumerate("uv"):
        assert np.allclose(model.probs[:, k], list(p[x].values()))
    got = identify(docs.withColumnRenamed("doc_id", "id"), model, "id").collect()
    for (doc_id, text, _), r in zip(rows, got):
        own = split_words(text or "")
        logs = [sum(np.log(total(w, pieces, p[x])) for w in own) for x in "uv"]
        best = int(np.argmax(logs))
        share = 1 / (1 + np.exp((min(logs) - max(logs)) * min(1, 10 / len(own)))) if own else 0
        assert r["lang_pred"] == ("uv"[best] if own else "und") and abs(r["score"] - share) < 1e-9


def test_letters_are_found_by_a_table_and_chunks_once(monkeypatch):
    odd = ["İx½y_z٣Ⅷ", "été,été", "a.b", "ǅ𝒜1𐐀", "ª²", "x́y", "漢字", "", "__", "Straße"]
    for chunk in odd:
        low = chunk.lower()
        assert split_words(chunk) == ["▁" + w for w in "".join(c if c.isalpha() else " " for c in low).split(" ") if w]
    for n in range(0, sys.maxunicode + 1, 7):
        assert split_words("a" + chr(n) + ".") == ["▁" + w for w in "".join(c if c.isalpha() else " " for c in ("a" + chr(n) + ".").lower()).split(" ") if w]
    pieces = ["▁", "▁a", "a", "b", "é"]
    p = np.random.default_rng(0).random((6, 2))
    texts = ["aab b, aab", "b é aab", None, "12 aab", "aab b, aab"]
    asked: list[str] = []
    monkeypatch.setattr(langid, "split_words", lambda chunk: asked.append(chunk) or split_words(chunk))
    model = LanguageModel(Pieces(pieces), ["u", "v"], p)
    got = model.predict(texts) + model.predict(texts)
    assert len(asked) == len(set(asked)) == 5  # a chunk that a worker has met before, in another group too, is not split again
    monkeypatch.setattr(langid, "KNOWN", 0)  # forgets before each group
    model = LanguageModel(Pieces(pieces), ["u", "v"], p)
    assert [x for t in texts * 2 for x in model.predict([t])] == got
    logs = np.log([[total(w, pieces, dict(zip([*pieces, None], p[:, k]))) for k in range(2)] for w in ("▁aab", "▁b", "▁aab")]).sum(axis=0)
    assert got[0][0] == "uv"[int(np.argmax(logs))] and np.isclose(got[0][1], 1 / (1 + np.exp(-abs(logs[0] - logs[1]))))
