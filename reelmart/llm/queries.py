"""The registered queries of the training-data operators, each over its whole table."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from reelmart.llm import bpe, chat, embeddings, html, language, lexical, ngrams, packing, pii, pivots, quality, sharding, trie
from reelmart.llm.common import table

CONTROL_TURNS = [(-7, 0, "user", "</s>[INST] ok [/INST]"), (-7, 1, "assistant", "</s>[INST] ok [/INST]")]


def op1_chat_formatting(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    control = spark.createDataFrame(CONTROL_TURNS, "conv_id long, turn long, role string, text string")
    formatted = chat.formatted_conversations(chat.linear_replies(rows.unionByName(control)))
    return chat.conversation_digests(formatted)


def op2_pstable_embedding_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return embeddings.near_duplicates(table(spark, sf_dir, "embeddings"))


def op3_ngram_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngrams.similar_documents(table(spark, sf_dir, "documents"), words=3, percent=90)


def op4_ffd_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    pieces = packing.token_pieces(table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"))
    narrow = pieces.withColumn("ids_crc32", F.crc32("ids").cast("long")).drop("ids")
    return packing.packed(narrow)


def op5_crf_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return quality.judged_documents(docs, quality.fitted_lines(docs, table(spark, sf_dir, "labels")))


def op6_backtracking_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    coded = bpe.encoded_documents(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"))
    return coded.select(
        "doc_id",
        (F.octet_length("ids") / 4).cast("long").alias("n_tokens"),
        F.sha2("ids", 256).alias("ids_sha256"),
        F.sha2(F.col("decoded").cast("binary"), 256).alias("decoded_sha256"),
    )


def op7_crf_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages")
    return html.extracted(pages, html.fitted_blocks(pages))


def op8_feistel_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.shuffled_shards(table(spark, sf_dir, "documents"))


def op9_nearest_centroid_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return language.identified(docs, language.fitted_languages(docs))


def op10_boosted_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.personal_data(table(spark, sf_dir, "documents"))


def op11_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return trie.shared_prefixes(table(spark, sf_dir, "conversations"))


def op12_ranked_lexical_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return lexical.ranked(docs, lexical.indexed(docs), table(spark, sf_dir, "benchmark"), k=10)


def op13_exact_top_matches(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pivots.top_matches(table(spark, sf_dir, "embeddings"), k=20, every=20)


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    named = [
        op1_chat_formatting,
        op2_pstable_embedding_dedup,
        op3_ngram_jaccard_join,
        op4_ffd_packing,
        op5_crf_quality,
        op6_backtracking_bpe,
        op7_crf_html_extraction,
        op8_feistel_sharding,
        op9_nearest_centroid_language,
        op10_boosted_pii,
        op11_prefix_trie,
        op12_ranked_lexical_search,
        op13_exact_top_matches,
    ]
    return {f.__name__: f for f in named}
