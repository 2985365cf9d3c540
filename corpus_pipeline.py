"""The corpus pipeline: stages over the documents table, each written before the next reads it.

Quality rules, language identification, near-duplicates, personal data, packing. Each stage
works on all rows its predecessor kept and returns the columns of its input; the last one
returns the packed pieces.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from reelmart.llm import language, ngrams, packing, pii, quality
from reelmart.llm.common import small_batches, table
from reelmart.session import cut_lineage


def keep_good(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the quality rules.

    NULL, empty and blank texts have no words and go. Repeated rows are judged alike, each on
    its own text; an empty table stays empty, columns of any name stay as they are.
    """
    small_batches(spark)
    passes = quality.good_text(quality.fitted_lines(docs, table(spark, sf_dir, "labels")))
    return docs.filter(passes("text"))


def keep_known_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language is recognised.

    Texts that are NULL or have no letter go. Repeated rows are judged alike; without rows to
    learn from every text goes; an empty table stays empty, other columns stay as they are.
    """
    small_batches(spark)
    rejected = language.foreign_text(language.fitted_languages(docs))
    return docs.filter(~rejected("text"))


def keep_one_of_similar(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group with a similarity of 0.8 or more over five-word shingles.

    The least id stays (NULL before all others); of rows alike in id and text one. Rows without
    a word, NULL texts among them, are no copies of each other and stay.
    """
    small_batches(spark)
    return ngrams.one_of_each(docs, words=5, percent=80)


def redact_personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with personal data replaced by its kind; ``n_chars`` follows the new text.

    NULL text stays NULL. Every row is rewritten on its own, so repeated ids do not matter.
    """
    candidates = cut_lineage(pii.with_candidates(docs.select("doc_id", "text")).drop("text"), "candidates")
    clean = pii.redacted(docs, pii.fitted(candidates))
    return clean.withColumn("n_chars", F.length("text").cast(dict(docs.dtypes)["n_chars"])) if "n_chars" in docs.columns else clean


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of all documents with their places in sequences of 2048 tokens.

    NULL text is empty: its piece is the end token alone. Repeated ids are documents of their own.
    """
    small_batches(spark)
    pieces = packing.token_pieces(docs, public_tokenizers.path("word_bpe_49k.json"))
    return packing.packed(pieces.withColumn("ids_crc32", F.crc32("ids").cast("long")).drop("ids"))


STAGES = [
    ("quality", keep_good),
    ("language", keep_known_language),
    ("near_duplicates", keep_one_of_similar),
    ("personal_data", redact_personal_data),
    ("packing", pack_sequences),
]

ORACLE_SQL = None  # trained models decide in several stages


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The rows of the last stage, applied to the whole documents table."""
    docs = table(spark, sf_dir, "documents")
    for k, (name, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if k + 1 < len(STAGES):
            docs = cut_lineage(docs, name)
    return docs
