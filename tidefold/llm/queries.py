"""One query per operator over the given tables, and the SQL that must agree where SQL can say it."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from tidefold.llm import (
    decontaminate, entropy_mix, hard_negatives, license_scan, pca_tiles, phrases, probminhash, sentence_spans, simple8b,
    suffix_dedup, suffix_tree_lm, toxic_chain, word_bpe,
)
from tidefold.llm.sql import COLLOCATIONS, DECONTAMINATE, EMBEDDINGS, HARD_NEGATIVES, SENTENCES, SUBSTRINGS

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def add(run):
        QUERIES[name] = run
        if sql is not None:
            ORACLES[name] = sql.strip()
        return run

    return add


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def tokenizer_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


@query("op1_suffix_tree_lm")
def op1(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Log10 probabilities of all texts by a probabilistic suffix tree over words."""
    return suffix_tree_lm.score(table(spark, sf_dir, "documents"), depth=5)


@query("op2_simple8b_ids")
def op2(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Token ids of all texts in Simple-8b files, read back."""
    folder = simple8b.new_folder(spark)
    simple8b.write(table(spark, sf_dir, "documents"), folder, tokenizer_path())
    return simple8b.read(spark, folder, with_ids=False).select("doc_id", "start", "n_tokens", "ids_crc32", "shard", "block")


@query("op3_decontaminate", DECONTAMINATE)
def op3(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words of documents inside windows of ten words of benchmark items."""
    df = decontaminate.find_hits(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    hit = F.aggregate(F.zip_with("starts", "ends", lambda a, b: b - a), F.lit(0).cast("long"), lambda x, y: x + y)
    items = F.array_sort("items")
    return df.select(
        "doc_id", "n_words", hit.alias("n_hit"), F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join(items, ",").cast("binary"), 256).alias("items_sha256"), (hit > 0).alias("contaminated"),
    )


@query("op4_suffix_dedup", SUBSTRINGS)
def op4(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bytes of 50-byte strings that an earlier document holds, removed by sorted suffixes."""
    df = suffix_dedup.dedup_substrings(table(spark, sf_dir, "documents"))
    removed = F.aggregate(F.zip_with("starts", "ends", lambda a, b: b - a), F.lit(0).cast("long"), lambda x, y: x + y)
    return df.select(
        "doc_id", "n_bytes", removed.alias("n_removed"), F.size("starts").cast("long").alias("n_spans"),
        F.sha2("kept", 256).alias("kept_sha256"),
    )


@query("op5_license_scan")
def op5(spark: SparkSession, sf_dir: str) -> DataFrame:
    """License notices by patience alignment."""
    return license_scan.scan(table(spark, sf_dir, "documents")).withColumn("licenses", F.array_join("licenses", ","))


@query("op6_probminhash")
def op6(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Groups of near-duplicate documents at a probability Jaccard similarity of 0.8."""
    return probminhash.near_duplicates(table(spark, sf_dir, "documents")).drop("text_hash")


@query("op7_sentence_spans", SENTENCES)
def op7(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sentences in repeated runs of three, but for the first of equal runs."""
    df = sentence_spans.dedup_sentences(table(spark, sf_dir, "documents"))
    return df.select("doc_id", "n_sentences", F.size("removed").cast("long").alias("n_removed"),
                     F.array_join(F.transform("removed", lambda x: x.cast("string")), ",").alias("removed"))


@query("op7_sentence_passages")
def op7_passages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sentences in repeated runs of two, or of ten words and more, but for the first of equal runs."""
    df = sentence_spans.dedup_sentences(table(spark, sf_dir, "documents"), run=2, words=10)
    return df.select("doc_id", "n_sentences", F.size("removed").cast("long").alias("n_removed"),
                     F.array_join(F.transform("removed", lambda x: x.cast("string")), ",").alias("removed"))


@query("op8_pca_tiles", EMBEDDINGS)
def op8(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Links of embeddings at cosine 0.9, and their components."""
    return pca_tiles.link(table(spark, sf_dir, "embeddings"))


@query("op9_entropy_mix")
def op9(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words that a mix of all sources at target weights takes of each document."""
    df = entropy_mix.mix(table(spark, sf_dir, "documents"))
    taken = F.col("mix.size") * F.col("mix.copies")
    return df.select("doc_id", "mix.size", "mix.source_size", "mix.target", taken.alias("taken"), "mix.copies", "mix.rate")


@query("op10_toxic_chain")
def op10(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Probabilities of the label categories by a classifier chain, and whether a text is toxic."""
    docs = table(spark, sf_dir, "documents")
    chain = toxic_chain.train(docs, table(spark, sf_dir, "labels"))
    df = toxic_chain.predict(docs, chain)
    return df.withColumn("toxic", F.col("p_toxic") >= toxic_chain.REJECT)


@query("op11_word_bpe")
def op11(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Digests of the token ids of all texts, each distinct word encoded once, and of the bytes they decode to."""
    import public_tokenizers

    ranks = public_tokenizers.path("byte_bpe_50k.tiktoken")
    encoded = word_bpe.encode(table(spark, sf_dir, "documents"), ranks, public_tokenizers.PATTERN)
    df = word_bpe.decode(encoded, word_bpe.token_bytes(spark, ranks), packed=True)
    return df.select("doc_id", F.size("ids").cast("long").alias("n_tokens"), F.sha2("packed", 256).alias("ids_sha256"),
                     F.sha2("decoded", 256).alias("decoded_sha256"))


@query("op12_son_phrases", COLLOCATIONS)
def op12(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The first collocations of each language, mined by shards and counted exactly."""
    return phrases.collocations(table(spark, sf_dir, "documents"))


@query("op13_hard_negatives", HARD_NEGATIVES)
def op13(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Hard negatives of every hundredth embedding, from blocks that zone maps choose."""
    return hard_negatives.mine(hard_negatives.relabelled(table(spark, sf_dir, "embeddings")))
