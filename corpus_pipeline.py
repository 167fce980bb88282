"""From raw documents to packed training sequences: five stages, each over all that the last one kept."""

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerloom.llm import line_dedup, ngram_join, packing, quality_rules, suffix_dedup
from ledgerloom.llm.common import small_batches
from ledgerloom.llm.keys import distinct_ids
from ledgerloom.session import local_shared_folder
from ledgerloom.sources.workspace import Workspace


def _retold(docs: DataFrame, kept: DataFrame) -> DataFrame:
    """The documents with the text that ``kept`` has for them; those left without a word go."""
    columns = docs.columns
    with_text = docs.drop("text", "n_chars").join(kept.select("doc_id", F.col("kept_text").alias("text")), "doc_id")
    return with_text.where(F.col("text").rlike(r"[^\x20\x09-\x0D]")).withColumn("n_chars", F.length("text").cast("long")).select(columns)


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality rules keep, under distinct ids from here on (see ``distinct_ids``)."""
    small_batches(spark)
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    docs = distinct_ids(docs, Workspace(spark), labels)
    verdict = quality_rules.judged(docs, labels)
    return docs.join(verdict.where("kept").select("doc_id"), "doc_id", "left_semi")


def lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without lines that repeat an earlier line of the corpus, exactly or nearly."""
    small_batches(spark)
    return _retold(docs, line_dedup.drop_near_lines(docs, Workspace(spark)))


def near_documents(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document, the one of smallest id, of each component of similar documents."""
    small_batches(spark)
    found, _ = ngram_join.similar_documents(docs, Workspace(spark))
    return docs.join(found.where("doc_id = component_id").select("doc_id"), "doc_id", "left_semi")


def repeats(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without byte strings of 100 that stand earlier in the corpus."""
    small_batches(spark)
    return _retold(docs, suffix_dedup.remove_repeats(docs, Workspace(spark), texts=True))


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of documents in sequences of 4096 tokens."""
    small_batches(spark)
    return packing.pack(docs, public_tokenizers.path("word_bpe_49k.json"))


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("quality rules", quality), ("line dedup", lines), ("n-gram Jaccard join", near_documents), ("suffix-array dedup", repeats), ("packing", packed),
]
#: Viterbi labels, MinHash candidates and tokens are beyond SQL; tests hold each stage against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; each stage's result is written and read again by the next."""
    local_shared_folder(spark)
    space, docs = Workspace(spark), spark.read.parquet(f"{sf_dir}/documents.parquet")
    for i, (_, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if i < len(STAGES) - 1:
            docs = space.write(docs, f"stage{i + 1}")
    return docs
