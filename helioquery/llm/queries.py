"""The registered query of each operator, over its whole table with production parameters."""

from __future__ import annotations

from collections.abc import Callable
from pathlib import Path

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import chat, linededup, quality
from .bpe import encode_decode
from .common import crc_of_id, table
from .langid import LanguageModel, fit, identify, in_fold, public_pieces
from .ngramlm import score_texts
from .packing import pack
from .pii import replace_pii
from .simhash import simhash_components
from .vectors import embedding_components

#: The registered queries' key; a deployment passes its own secret to the operator.
PII_KEY = "demonstration-key"


def spec(name: str) -> str:
    """The text of a public tokenizer's file, read on the driver and handed to the operators."""
    return Path(public_tokenizers.path(name)).read_text(encoding="utf-8")


def language_model(docs: DataFrame) -> LanguageModel:
    """The language model of the rows that are not held out."""
    pieces = public_pieces(Path(public_tokenizers.path("piece_bpe_32k.model")).read_bytes())
    return fit(docs.where(~in_fold(crc_of_id(F.col("doc_id")), 5)), pieces)


def op1_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    out = identify(docs, language_model(docs))
    return out.select("doc_id", in_fold(crc_of_id(F.col("doc_id")), 5).alias("held_out"), "lang_pred", "score")


def op2_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash_components(table(spark, sf_dir, "documents"))


def op3_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = encode_decode(table(spark, sf_dir, "documents"), spec("word_bpe_49k.json"))
    return out.select("doc_id", "n_tokens", F.sha2("ids", 256).alias("ids_sha256"), F.sha2("decoded", 256).alias("decoded_sha256"))


def op4_surrogates(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = replace_pii(table(spark, sf_dir, "documents").select("doc_id", "text"), PII_KEY)
    return out.select("doc_id", "n_entities", "text")


def op5_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = quality.with_quality(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return out.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept")


def op6_preferences(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Conversations 2k and 2k + 1 are a pair, the even one chosen."""
    turns = table(spark, sf_dir, "conversations")
    turns = turns.withColumns({"pair": F.floor(F.col("conv_id") / 2), "chosen": F.col("conv_id") % 2 == 0})
    out = chat.preference_pairs(turns, "pair", "chosen")
    return out.select("pair_id", "n_common", "n_chosen", "n_rejected", F.md5("prompt").alias("prompt_md5"), F.md5(chat.spelled("chosen")).alias("chosen_md5"), F.md5(chat.spelled("rejected")).alias("rejected_md5"))


def op7_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = linededup.dedup_lines(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return out.select("doc_id", "n_lines", "n_kept", F.md5("text").alias("text_md5"))


def op8_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return score_texts(docs.withColumn("held", in_fold(crc_of_id(F.col("doc_id")), 10)), "held")


def op9_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack(table(spark, sf_dir, "documents"), spec("byte_bpe_50k.json"))


def op10_embeddings(spark: SparkSession, sf_dir: str) -> DataFrame:
    return embedding_components(table(spark, sf_dir, "embeddings"))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {f.__name__: f for f in (op1_language, op2_simhash, op3_bpe, op4_surrogates, op5_quality, op6_preferences, op7_lines, op8_scores, op9_packing, op10_embeddings)}


def oracle_sql() -> dict[str, str]:
    """DuckDB SQL where it can express the whole operator at bearable cost."""
    return {"op5_quality": quality.ORACLE_SQL, "op6_preferences": chat.ORACLE_SQL, "op7_lines": linededup.ORACLE_SQL}
