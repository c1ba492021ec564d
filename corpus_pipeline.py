"""The training-corpus pipeline: toxicity, near-duplicates, repeated passages, benchmark leaks, packing.

Each stage takes (spark, docs, sf_dir); what it returns is written as Parquet and read again as the next one's docs.  All but the
last return the columns of documents (further columns of the input too).
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ratewright.llm import decontamination, packing, simhash, substring_dedup, toxicity
from ratewright.sources.io import shared_folder

#: No SQL: character n-gram regression, XXH64 fingerprints and the tokeniser are not SQL functions.
ORACLE_SQL = None


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents that the classifier, trained on the labelled training folds, doesn't call toxic."""
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    model = toxicity.train(docs.where(toxicity.fold() != 1), labels.where(toxicity.fold() != 1))
    return toxicity.score(docs, model, score_col="_score_", predicted_col="_toxic_").where("_toxic_ = 0").select(*docs.columns)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document, that with the smallest id, of each group of copies and near copies."""
    return simhash.keep_one_near_copy(docs)


def drop_repeated_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the words that an earlier document holds; a document of which no word is left goes, one that had none stays."""
    out = substring_dedup.remove_repeats(docs).where("n_words = 0 or n_removed < n_words")
    changed = F.when(F.col("n_removed") > 0, F.col("kept")).otherwise(F.col("row.text"))
    columns = [changed.alias(c) if c == "text" else F.length(changed).cast("long").alias(c) if c == "n_chars" else F.col("row")[c].alias(c) for c in docs.columns]
    return out.select(*columns)


def drop_benchmark_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents that hold no benchmark item."""
    return decontamination.without_leaks(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row per piece of each document: its ids and its place in the packed sequences."""
    import public_tokenizers

    return packing.pack_documents(docs, public_tokenizers.path("word_bpe_49k.json"), with_ids=True).withColumnRenamed("id", "doc_id")


STAGES = [
    ("toxicity", drop_toxic),
    ("simhash_near_dedup", drop_near_duplicates),
    ("substring_dedup", drop_repeated_passages),
    ("benchmark_decontamination", drop_benchmark_leaks),
    ("best_fit_packing", pack),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages over documents; each result is kept as Parquet in the folder that spark.checkpoint.dir names."""
    base = f"{shared_folder(spark)}/pipeline-{uuid.uuid4().hex}"
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        stage(spark, docs, sf_dir).write.parquet(f"{base}/{name}")
        docs = spark.read.parquet(f"{base}/{name}")
    return docs
