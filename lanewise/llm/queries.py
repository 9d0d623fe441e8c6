"""One query per operator, with production parameters, over whole tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from lanewise.llm import (
    conversations,
    decontaminate,
    html_text,
    mixing,
    ngram_join,
    paragraphs,
    pii,
    quality_model,
    quality_rules,
    records,
    toxicity,
    vector_codes,
    word_trie,
)


def _table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def op1_ngram_join(spark: SparkSession, folder: str) -> DataFrame:
    return ngram_join.ngram_join(_table(spark, folder, "documents"))


def op2_paragraph_minhash(spark: SparkSession, folder: str) -> DataFrame:
    return paragraphs.repeated_paragraphs(_table(spark, folder, "documents"))


def op3_rule_ensemble(spark: SparkSession, folder: str) -> DataFrame:
    return quality_model.quality_model(
        _table(spark, folder, "documents"), _table(spark, folder, "labels")
    )


def op4_decontaminate(spark: SparkSession, folder: str) -> DataFrame:
    return decontaminate.decontaminate(
        _table(spark, folder, "documents"), _table(spark, folder, "benchmark")
    ).drop("hits", "items")


def op5_mixing(spark: SparkSession, folder: str) -> DataFrame:
    mixed = mixing.mix(_table(spark, folder, "documents"))
    return mixed.select(
        "row.doc_id", "source", "lang", "topic", "n_tokens", "weight", "probability", "selected"
    )


def op6_toxicity(spark: SparkSession, folder: str) -> DataFrame:
    return toxicity.toxicity(_table(spark, folder, "documents"), _table(spark, folder, "labels"))


def op7_personal_data(spark: SparkSession, folder: str) -> DataFrame:
    return pii.personal_data(_table(spark, folder, "documents"))


def vocabulary() -> str:
    """The vocabulary file of the token records, of an installed package."""
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


def word_vocabulary() -> str:
    """The vocabulary file of words with end marks, of an installed package."""
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


def op8_token_records(spark: SparkSession, folder: str) -> DataFrame:
    return records.token_records(_table(spark, folder, "documents"), vocabulary())


def op9_main_text(spark: SparkSession, folder: str) -> DataFrame:
    return html_text.extract(_table(spark, folder, "pages"))


def op10_quality_rules(spark: SparkSession, folder: str) -> DataFrame:
    return quality_rules.quality_rules(
        _table(spark, folder, "documents"), _table(spark, folder, "labels")
    )


def op11_word_trie(spark: SparkSession, folder: str) -> DataFrame:
    return word_trie.word_trie(_table(spark, folder, "documents"), word_vocabulary())


def op12_conversation_repair(spark: SparkSession, folder: str) -> DataFrame:
    return conversations.conversation_repair(_table(spark, folder, "conversations"))


def op13_vector_codes(spark: SparkSession, folder: str) -> DataFrame:
    return vector_codes.vector_codes(_table(spark, folder, "embeddings"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_ngram_join": op1_ngram_join,
    "op2_paragraph_minhash": op2_paragraph_minhash,
    "op3_rule_ensemble": op3_rule_ensemble,
    "op4_decontaminate": op4_decontaminate,
    "op5_mixing": op5_mixing,
    "op6_toxicity": op6_toxicity,
    "op7_personal_data": op7_personal_data,
    "op8_token_records": op8_token_records,
    "op9_main_text": op9_main_text,
    "op10_quality_rules": op10_quality_rules,
    "op11_word_trie": op11_word_trie,
    "op12_conversation_repair": op12_conversation_repair,
    "op13_vector_codes": op13_vector_codes,
}

ORACLES: dict[str, str] = {
    "op1_ngram_join": ngram_join.ORACLE_SQL,
    "op4_decontaminate": decontaminate.ORACLE_SQL,
    "op13_vector_codes": vector_codes.ORACLE_SQL,
}
