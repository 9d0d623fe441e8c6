"""A training corpus from raw documents, as stages over tables of documents.

Each stage takes (spark, docs, sf_dir) and returns what it keeps, with the columns of
documents; the last one returns the index of the records it wrote. Stages are written as
Parquet in the session's shared folder and read again, so each is computed once.

Rows are told apart by a hash of doc_id and text, so null and repeated ids do no harm. Rows
that are equal in both are one document: verdicts hold for all of them, and the n-gram stage
keeps one.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from lanewise.llm import decontaminate, mixing, ngram_join, quality_rules, records
from lanewise.llm.queries import vocabulary
from lanewise.llm.staging import written


def _keyed(docs: DataFrame) -> DataFrame:
    """Each row whole, with its key."""
    return docs.select(
        F.xxhash64("doc_id", "text").alias("key"), F.struct(*docs.columns).alias("row")
    )


def _for_operator(keyed: DataFrame, *columns: str) -> DataFrame:
    """What operators take, with the key in place of the id."""
    return keyed.select(F.col("key").alias("doc_id"), *(f"row.{c}" for c in ("text", *columns)))


def _kept(keyed: DataFrame, keys: DataFrame) -> DataFrame:
    return keyed.join(keys, "key", "left_semi").select("row.*")


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality rules keep."""
    keyed = _keyed(docs)
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet").select("doc_id", "quality")
    own = keyed.select("key", F.col("row.doc_id").alias("doc_id")).distinct()
    labels = labels.join(own, "doc_id").select(F.col("key").alias("doc_id"), "quality")
    language = ["lang"] if "lang" in docs.columns else []
    judged = quality_rules.quality_rules(_for_operator(keyed, *language), labels)
    return _kept(keyed, judged.filter("kept").select(F.col("doc_id").alias("key")))


def ngram_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies: the one of the smallest doc_id.

    Documents without words are in no group and stay. A null doc_id gives way to any other.
    """
    keyed = _keyed(docs)
    found = ngram_join.ngram_join(_for_operator(keyed)).select(
        F.col("doc_id").alias("key"), F.col("component_id").alias("group")
    ).distinct()
    ids = keyed.select("key", F.col("row.doc_id").alias("doc_id")).distinct()
    order = F.struct(F.col("doc_id").isNull(), "doc_id", "key")
    first = found.join(ids, "key").groupBy("group").agg(F.min(order).alias("first"))
    keys = first.select(F.col("first.key").alias("key"))
    one = Window.partitionBy("key").orderBy("key")
    return (
        keyed.join(keys, "key", "left_semi").withColumn("copy", F.row_number().over(one))
        .filter("copy = 1").select("row.*")
    )


def decontaminate_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a passage of a benchmark item."""
    keyed = _keyed(docs)
    items = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    found = decontaminate.decontaminate(_for_operator(keyed), items)
    return _kept(keyed, found.filter("not contaminated").select(F.col("doc_id").alias("key")))


def mixing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents drawn for the target weights."""
    return mixing.mix(docs).filter("selected").select("row.*")


def records_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents as token records; returns doc_id, start, n_tokens and ids_crc32 of each."""
    return records.token_records(docs, vocabulary())


STAGES = [
    ("quality rules", quality_stage),
    ("n-gram Jaccard join", ngram_stage),
    ("benchmark decontamination", decontaminate_stage),
    ("mixing sources to target weights", mixing_stage),
    ("token-ID / binary output", records_stage),
]

#: No stage can be told in SQL as a whole: thresholds and weights are fitted, ids come from a
#: tokenizer. The tests run the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), f"stage-{name.split()[0]}")
    return STAGES[-1][1](spark, docs, sf_dir)
