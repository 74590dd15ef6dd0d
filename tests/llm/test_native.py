import duckdb
import pytest
from pyspark.sql import functions as F

from helioquery.llm import queries as Q
from helioquery.llm.chat import preference_pairs
from helioquery.llm.linededup import dedup_lines
from helioquery.llm.quality import with_quality

SF = "/root/testdata/sf0.01"


@pytest.mark.parametrize("name", sorted(Q.oracle_sql()))
def test_query_equals_sql(spark, name):
    con = duckdb.connect()
    for t in ("documents", "conversations", "embeddings"):
        con.execute(f"create view {t} as select * from read_parquet('{SF}/{t}.parquet')")
    want = con.execute(Q.oracle_sql()[name])
    names = [d[0] for d in want.description]
    got = Q.queries()[name](spark, SF)
    assert sorted(got.columns) == sorted(names)
    rows = [tuple(r) for r in got.select(names).collect()]
    want = want.fetchall()
    a, b = set(rows), set(want)
    assert len(rows) == len(want)
    assert a == b, (sorted(a - b, key=str)[:5], sorted(b - a, key=str)[:5])


def edits(a, b):
    if a == b:
        return 0
    if abs(len(a) - len(b)) > 1:
        return 2
    if len(a) > len(b):
        a, b = b, a
    i = next((k for k in range(len(a)) if a[k] != b[k]), len(a))
    return 1 if (a[i + 1 :] == b[i + 1 :] if len(a) == len(b) else a[i:] == b[i + 1 :]) else 2


def test_line_dedup_odd_rows(spark):
    base = "the quick brown fox jumps over the lazy dog"
    rows = [(1, base), (2, base[:-1]), (3, base + "s"), (4, "X" + base[1:]), (5, base[1] + base[0] + base[2:]), (6, None), (7, ""), (8, "a\n\n b \nA"), (9, "ab\nba\nb\n\n"), (10, "THE quick  brown fox jumps over the lazy dog\nnew line here"), (10, "THE quick  brown fox jumps over the lazy dog\nnew line here"), (11, "z" * 5000), (12, "z" * 4999), (None, "no id at all")]
    docs = spark.createDataFrame(rows, "doc_id long, text string").withColumn("line", F.lit(1)).withColumn("first", F.lit("x")).withColumn("n_kept", F.lit("x"))
    got = {(r["doc_id"], r["text"]) for r in dedup_lines(docs).collect()}
    firsts, want = {}, set()
    for d, text in sorted(dict(rows).items(), key=lambda x: (x[0] is not None, x[0] or 0)):
        for n, raw in enumerate((text or "").split("\n")):
            line = " ".join(raw.lower().split())
            if line:
                firsts.setdefault(line, (d is not None, d or 0, n))
    for d, text in dict(rows).items():
        kept = []
        for n, raw in enumerate((text or "").split("\n")):
            line = " ".join(raw.lower().split())
            at = (d is not None, d or 0, n)
            if not line or firsts[line] == at and not any(f < at and edits(line, o) <= 1 for o, f in firsts.items()):
                kept.append(raw)
        want.add((d, None if text is None else "\n".join(kept)))
    assert got == want
    assert dedup_lines(docs).count() == len(rows) and dedup_lines(docs.limit(0)).count() == 0


def test_line_dedup_hot_neighbourhood(spark):
    rows = [(i, f"common beginning of a line {i % 10} and its end\nword{i} alone here") for i in range(2000)]
    got = dedup_lines(spark.createDataFrame(rows, "doc_id long, text string").repartition(5)).where("text like '%common%'").collect()
    assert [r["doc_id"] for r in got] == [0]


def test_quality_odd_rows(spark):
    words = " ".join(f"word{i}" for i in range(60))
    rows = [(1, None), (2, ""), (3, " \n\t"), (4, words + "."), (5, "a b c " * 40), (6, "\n".join(["Home | About | Contact"] * 30)), (7, words + ".\nAll rights reserved."), (8, "WOW!! NOW!! " + "THE!! " * 60), (9, "x y z\nx y z\n" + words)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").withColumn("kept", F.lit("x")).withColumn("n_words", F.lit("x"))
    got = {r["doc_id"]: r for r in with_quality(docs).collect()}
    assert [got[i]["kept"] for i in range(1, 10)] == [False, False, False, True, False, False, True, False, True]
    assert got[7]["clean_text"] == words + "." and got[1]["clean_text"] is None
    assert (got[9]["n_dup_lines"], got[9]["n_repeat_words"], got[5]["n_repeat_words"]) == (1, 6, 120)
    assert with_quality(docs.limit(0)).count() == 0


def test_preference_pairs(spark):
    rows = [(1, True, 0, "user", "q"), (1, True, 1, "assistant", "a"), (1, False, 0, "user", "q"), (1, False, 1, "assistant", "b"), (1, False, 2, "user", None), (2, True, 0, None, "q"), (3, True, 0, "user", "s"), (3, False, 0, "user", "s"), (4, False, 1, "assistant", "t"), (4, False, 1, "assistant", "t"), (None, True, 0, "user", "x"), (5, None, 0, "user", "x")]
    turns = spark.createDataFrame(rows, "pair long, chosen boolean, turn int, role string, text string").withColumn("c", F.lit(1)).withColumn("pair_id", F.lit("x"))
    got = {r["pair_id"]: r for r in preference_pairs(turns, "pair", "chosen").collect()}
    assert sorted(got) == [1, 2, 3, 4]
    assert got[1]["prompt"] == "<|user|>\nq<|end|>\n" and [(s["text"], s["train"]) for s in got[1]["chosen"]] == [("<|assistant|>\n", False), ("a<|end|>\n", True)]
    assert [s["train"] for s in got[1]["rejected"]] == [False, True, False, False]
    assert (got[2]["n_common"], len(got[2]["chosen"]), got[2]["rejected"]) == (0, 2, [])
    assert (got[3]["n_common"], got[3]["chosen"], got[3]["rejected"]) == (1, [], []) and got[4]["n_rejected"] == 2
    assert preference_pairs(turns.limit(0), "pair", "chosen").count() == 0
