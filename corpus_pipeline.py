"""The corpus pipeline: five operators of ``claimloom.llm`` over the table of documents.

Each stage takes what its predecessor kept and its decisions take effect. Every stage's output is a
written table, so a lost executor repeats tasks of one stage only.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from claimloom.llm import common, language_id, mixing, piece_bpe, secret_scan, simhash

#: Word shingles and most differing bits of near-duplicates; the tokenizer of the last stage.
SHINGLE, MAX_BITS, PIECES = 3, 2, "piece_bpe_32k.model"


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with a language: rejected are those without a letter and ambiguous ones."""
    return language_id.keep_identified(docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of SimHash near-duplicates, the one of smallest doc_id."""
    return simhash.keep_one(docs, SHINGLE, MAX_BITS)


def mask_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, secrets replaced by a mark; ``n_chars`` is that of the new text."""
    masked = secret_scan.mask_secrets(docs)
    return masked.withColumn(
        "n_chars", F.coalesce(F.length("text").cast("long"), F.col("n_chars"))
    ).select(*docs.columns)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix of sources at weights 1, 2, 3 takes them."""
    return mixing.repeat(docs)


def encode_pieces(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """(doc_id, source, lang, n_tokens, ids, round_trip): ids of each text.

    ``round_trip`` says whether decoding the ids gives the text back.
    """
    path = public_tokenizers.path(PIECES)
    read = docs.select("doc_id", "source", "lang", "text")
    coded = piece_bpe.encode_and_decode(read, path)
    return coded.select(
        "doc_id", "source", "lang", F.size("ids").cast("long").alias("n_tokens"), "ids",
        (F.col("decoded") == F.coalesce("text", F.lit(""))).alias("round_trip"),
    )


STAGES = [
    ("language ID", identify_language),
    ("SimHash near-dedup", near_duplicates),
    ("secret scans", mask_secrets),
    ("mixing sources", mix_sources),
    ("SentencePiece", encode_pieces),
]

#: Classifiers, automata, connected components and drawn copies have no form in SQL; the stages are
#: tested against brute-force versions.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The last stage's rows; each stage is written and read again."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = common.stored(stage(spark, docs, sf_dir), name.replace(" ", "-").lower())
    return docs
