from helioquery.llm import common
from helioquery.llm.linededup import dedup_lines


def test_rows_of_one_id_or_none_are_documents_of_their_own(spark):
    rows = []
    for i in (None, 5):
        for k in range(6):  # each has a line of its own and one near to that of all others, in turn first and last
            own, near = f"line number {k * 1111} that only row {i} holds here", f"a line that is near the same everywhere{k}"
            rows.append((i, "\n".join([own, near] if k % 2 else [near, own])))
    got = dedup_lines(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    left = [line for r in got for line in r["text"].split("\n") if line]
    assert len(got) == 12 and sum("only row" in x for x in left) == 12 and sum("near the same" in x for x in left) == 1


def test_many_suspects_are_joined_by_shuffles_alike(spark, monkeypatch):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("doc_id", "text")
    few = sorted(map(tuple, dedup_lines(docs).select("doc_id", "n_kept", "text").collect()))
    monkeypatch.setattr(common, "BROADCAST_ROWS", 0)
    assert sorted(map(tuple, dedup_lines(docs).select("doc_id", "n_kept", "text").collect())) == few
