"""The corpus pipeline: each stage applies one operator to all that its predecessor kept."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from helioquery.llm.common import durable
from helioquery.llm.langid import UNDETERMINED, identify
from helioquery.llm.linededup import dedup_lines
from helioquery.llm.nearcopies import drop_similar
from helioquery.llm.packing import pack
from helioquery.llm.pii import replace_pii
from helioquery.llm.queries import PII_KEY, language_model, spec

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]
#: Documents whose best language gets less than this score go, as do those without a letter.
MIN_LANGUAGE_SCORE = 0.5


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in a language that the model tells stay; each row is judged by its own text, whatever its id."""
    told = identify(docs, language_model(docs), columns=COLUMNS)
    return told.where((F.col("lang_pred") != UNDETERMINED) & (F.col("score") >= MIN_LANGUAGE_SCORE)).select(COLUMNS)


def _with_length(docs: DataFrame) -> DataFrame:
    return docs.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType)).select(COLUMNS)


def lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Lines that stand earlier in the corpus go."""
    return _with_length(dedup_lines(docs))


def near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies stays: those whose sets of five words running are 0.8 alike or more."""
    return drop_similar(docs).select(COLUMNS)


def pii(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Personal data and secrets become surrogates."""
    return _with_length(replace_pii(docs, PII_KEY))


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The token ids of what is left, in full sequences."""
    return pack(docs, spec("byte_bpe_50k.json"))


STAGES = [("language ID", language), ("line dedup", lines), ("SimHash near-dedup", near_copies), ("PII", pii), ("packing", packing)]
#: Language identification and packing are beyond SQL; tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages in turn; what each returns is written before the next one reads it, so that no stage runs twice."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for n, (_, stage) in enumerate(STAGES):
        docs = stage(spark, docs if n == 0 else durable(docs), sf_dir)
    return docs
