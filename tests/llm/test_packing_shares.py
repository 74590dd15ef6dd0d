from helioquery.llm.packing import CAPACITY, pack
from helioquery.llm.queries import spec


def test_packing_fills_alike_under_any_number_of_shuffle_partitions(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").cache()
    got, old = [], spark.conf.get("spark.sql.shuffle.partitions")
    try:
        for n in (12, 400):
            spark.conf.set("spark.sql.shuffle.partitions", n)
            got.append(sorted(map(tuple, pack(docs, spec("byte_bpe_50k.json")).collect())))
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", old)
        docs.unpersist()
    fill = [sum(r[2] for r in rows) / CAPACITY / len({r[5] for r in rows}) for rows in got]
    assert got[0] == got[1] and min(fill) > 0.99, fill
