from pyspark.sql import functions as F

import corpus_pipeline

SF = "/root/testdata/sf0.001"


def test_language_stage_judges_each_row_by_its_own_text(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    clean = docs.where("lang = 'en'").orderBy("doc_id").limit(4).withColumn("doc_id", F.expr("case when doc_id % 2 = 0 then 7000 end"))
    junk = spark.createDataFrame([(None, "", "en", "s", 0), (7000, "12 34", "en", "s", 5), (None, None, "en", "s", 0), (7001, "1", "en", "s", 1)], docs.schema)
    own = [r["text"] for r in clean.collect()]
    want = sorted(r["text"] for r in corpus_pipeline.language(spark, docs, SF).collect())
    got = corpus_pipeline.language(spark, docs.unionByName(clean).unionByName(junk), SF)
    assert got.columns == docs.columns and len(own) == 4
    texts = [r["text"] for r in got.where("doc_id is null or doc_id = 7000").collect()]
    assert sorted(texts) == sorted(own) and sorted(r["text"] for r in got.collect()) == sorted(want + own)
