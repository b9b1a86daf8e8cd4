"""The corpus pipeline: five stages over documents, each on all that the one before kept.

Each stage is a function of (spark, docs, sf_dir). All but the last return the columns of
documents; run() writes each stage's rows to the shared folder and reads them again.
"""

from collections.abc import Callable
from functools import wraps

from public_tokenizers import path as tokenizer_path
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from crisis_posts.llm import decontaminate, language, ngram_join, pieces, pii
from crisis_posts.llm.shared import written


# What goes to and from Python workers, and what is read from files, at a time. Texts are wide rows, and
# the buffers of a batch are pooled by an executor for as long as it lives.
BATCHES = {
    "spark.sql.execution.arrow.maxRecordsPerBatch": "256",
    "spark.sql.execution.arrow.maxBytesPerBatch": "1m",
    "spark.sql.parquet.columnarReaderBatchSize": "512",
}

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def in_small_batches(stage: Stage) -> Stage:
    """A stage that sets BATCHES in its session; they hold for what is still to be computed of its rows."""

    @wraps(stage)
    def run_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
        for name, value in BATCHES.items():
            spark.conf.set(name, value)
        return stage(spark, docs, sf_dir)

    return run_stage


def _without(docs: DataFrame, ids: DataFrame) -> DataFrame:
    """The documents but those listed; the list is written first, so that its size is known."""
    listed = written(ids.select(F.col("doc_id").alias("dropped_id")).distinct())
    return docs.join(listed, docs["doc_id"] == listed["dropped_id"], "left_anti")


@in_small_batches
def identified(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop documents without a clear language. Dictionaries and margin come from the labelled ones."""
    dictionaries, margin = language.learn(docs.where(~language.held_out()))
    return _without(docs, language.identify_language(docs, dictionaries, margin).where("rejected"))


@in_small_batches
def distinct_texts(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep the document of smallest id of each group of near copies."""
    return _without(docs, ngram_join.near_duplicates(docs).where("component_id < doc_id"))


@in_small_batches
def decontaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop documents that hold a passage of the benchmark."""
    benchmark = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    return _without(docs, decontaminate.find_contamination(docs, benchmark).where("size(items) > 0"))


@in_small_batches
def anonymized(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Replace personal data in the texts by its kind; n_chars counts the new text."""
    masked = pii.masked(docs, written(pii.find_personal_data(docs)))
    if "n_chars" in docs.columns:
        masked = masked.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType))
    return masked


@in_small_batches
def encoded(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """(doc_id, n_pieces, ids) of the texts that are left."""
    ids = pieces.encode_pieces(docs, tokenizer_path("piece_bpe_32k.model"))
    return ids.select("doc_id", F.size("ids").cast("long").alias("n_pieces"), "ids")


STAGES = [
    ("language", identified),
    ("near_duplicates", distinct_texts),
    ("decontamination", decontaminated),
    ("personal_data", anonymized),
    ("sentencepiece", encoded),
]

# The tokenizer and the learned dictionaries can't be expressed in SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for _, stage in STAGES:
        docs = written(stage(spark, docs, sf_dir))
    return docs
