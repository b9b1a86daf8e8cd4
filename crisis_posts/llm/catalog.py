"""The registered queries of this subpackage: each operator over its whole table."""

from collections.abc import Callable

from public_tokenizers import path as tokenizer_path
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from crisis_posts.llm import (
    alignment, chat, decontaminate, divergence, language, licenses, ngram_join, passages, pieces, pii, secrets,
    token_counts, winnowing,
)

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
TOKEN_LIMIT = 2048


def register(query: Query) -> Query:
    QUERIES[query.__name__] = query
    return query


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _of_kind(spans: str, kind: str) -> Column:
    return F.size(F.filter(spans, lambda span: span["kind"] == kind)).cast("long")


@register
def op1_ngram_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngram_join.near_duplicates(_table(spark, sf_dir, "documents"))


@register
def op2_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = _table(spark, sf_dir, "documents")
    counted = token_counts.count_tokens(
        documents, tokenizer_path("word_bpe_49k.json"), [TOKEN_LIMIT]
    )
    return counted.select(
        "doc_id", "n_bytes", "n_tokens", (F.col("n_tokens") > TOKEN_LIMIT).alias("over_limit"),
        F.col("fits")[0].alias("fit_chars"),
    )


@register
def op3_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = pii.find_personal_data(_table(spark, sf_dir, "documents"))
    return found.select(
        "doc_id", *(_of_kind("base", kind).alias(f"n_{kind}") for kind in pii.KINDS),
        F.sha2(pii.spelled(F.col("base")), 256).alias("base_sha256"),
        pii.spelled(pii.by_kind(F.concat("base", "added"))).alias("spans"),
        F.size("added").cast("long").alias("n_added"),
    )


@register
def op4_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    kept = passages.remove_repeats(_table(spark, sf_dir, "documents"))
    return kept.select("doc_id", "n_words", "n_removed", F.sha2("kept", 256).alias("kept_sha256"))


@register
def op5_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    beside = winnowing.beside_next(_table(spark, sf_dir, "documents"))
    n = F.length("text")
    third = F.floor(n / 3).cast("int")
    edited = F.concat(
        F.substring("text", F.lit(1), n - third), F.substring("next_text", F.lit(1), third)
    )
    beside = beside.withColumn("edited", edited).drop("next_text")
    marked = winnowing.with_marks(beside, "edited", "edited_marks")
    return marked.select(
        "doc_id", n.cast("long").alias("n_chars"), F.sha2("edited", 256).alias("edited_sha256"),
        winnowing.spelled("marks").alias("fingerprint"),
        winnowing.spelled("edited_marks").alias("edited_fingerprint"),
        winnowing.likeness("marks", "edited_marks").alias("near_edited"),
        winnowing.likeness("marks", "next_marks").alias("near_next"),
    )


@register
def op6_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = _table(spark, sf_dir, "documents")
    dictionaries, margin = language.learn(documents.where(~language.held_out()))
    predicted = language.identify_language(documents, dictionaries, margin)
    return predicted.select(
        "doc_id", language.held_out().alias("held_out"), "lang_pred", "score", "rejected"
    )


@register
def op7_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A document counts as a repository, its source as the owner."""
    found = secrets.find_secrets(_table(spark, sf_dir, "documents"), "doc_id", "source")
    return found.select(
        "doc_id", *(_of_kind("base", kind).alias(f"n_{kind}") for kind in secrets.BASE_KINDS),
        F.sha2(secrets.spelled(F.col("base")), 256).alias("base_sha256"),
        secrets.spelled(F.array_sort(F.concat("base", "added"))).alias("spans"),
        "n_live", "n_copied",
    )


@register
def op8_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = _table(spark, sf_dir, "documents")
    return pieces.encoding_digests(documents, tokenizer_path("piece_bpe_32k.model"))


@register
def op9_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = decontaminate.find_contamination(
        _table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark")
    )
    hit = decontaminate.covered(F.col("hits"))
    return found.select(
        "doc_id", "n_words", hit.alias("n_hit"), F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"),
        (hit > 0).alias("contaminated"),
    )


PLANTED_CONVERSATION = [
    (-7, turn, role, "</s>[INST] ok [/INST]") for turn, role in enumerate(["user", "assistant"])
]


@register
def op10_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    columns = ["conv_id", "turn", "role", "text"]
    conversations = _table(spark, sf_dir, "conversations").select(columns)
    planted = spark.createDataFrame(PLANTED_CONVERSATION, "conv_id long, turn long, role string, text string")
    return chat.conversation_digests(conversations.unionByName(planted))


@register
def op11_source_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return divergence.audit_sources(_table(spark, sf_dir, "documents"))


@register
def op12_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = licenses.find_licenses(_table(spark, sf_dir, "documents"))
    base_labels, starts = F.col("base.label"), F.col("base.start")
    return found.select(
        "doc_id", "n_words", F.size("base").cast("long").alias("n_base"),
        F.array_min(starts).alias("first_word"), F.array_max(starts).alias("last_word"),
        F.array_join(F.array_sort(F.array_distinct(base_labels)), ",").alias("base_labels"),
        F.array_join(F.array_sort(F.array_union(base_labels, F.col("found.label"))), ",").alias("labels"),
        "score",
    )


@register
def op13_token_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = alignment.align_documents(
        _table(spark, sf_dir, "documents"), tokenizer_path("byte_bpe_50k.json"),
        tokenizer_path("piece_bpe_32k.model"), digests=True,
    )
    return found.withColumnRenamed("groups", "groups_sha256")
