"""From raw documents to packed token ids: five stages, each over all that the one before kept."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tidefold.llm import decontaminate, entropy_mix, probminhash, simple8b, toxic_chain
from tidefold.llm.queries import table, tokenizer_path
from tidefold.sinks.folders import shared_folder


def toxicity(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier chain does not find toxic."""
    return toxic_chain.without(docs, toxic_chain.train(docs, table(spark, sf_dir, "labels")))


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates."""
    return probminhash.one_of_each(docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a window of a benchmark item."""
    return decontaminate.remove_hits(docs, table(spark, sf_dir, "benchmark"))


def mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document as often as the mix of sources takes it."""
    return entropy_mix.take(docs)


def token_ids(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids in Simple-8b files, read back: one row per document."""
    folder = simple8b.new_folder(spark)
    simple8b.write(docs, folder, tokenizer_path())
    return simple8b.read(spark, folder, with_ids=False).select("doc_id", "start", "n_tokens", "ids_crc32")


STAGES = [
    ("toxicity", toxicity),
    ("minhash near-dedup", near_dedup),
    ("benchmark decontamination", decontamination),
    ("mixing sources", mixing),
    ("token ids", token_ids),
]

# no SQL for a trained classifier and a tokenizer: the tests hold the stages against plain versions
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The last stage's rows; every stage's result is written to the shared folder and read again."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        folder = shared_folder(spark, "stage")
        stage(spark, docs, sf_dir).write.parquet(folder)
        docs = spark.read.parquet(folder)
    return STAGES[-1][1](spark, docs, sf_dir)
