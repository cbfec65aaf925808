"""From raw documents to token ids in five stages; each reads what the one before has written.

Every stage works on all rows it gets. All but the last return the columns of documents.
"""

import os
import uuid

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from promptmill.llm import (exact_dedup, mixing, ngram_join, quality_rules, sentencepiece_codec)
from promptmill.llm.common import documents_only, shared_folder


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Failing lines go, and documents that the rules reject."""
    return quality_rules.cleaned(documents_only(docs))


def exact(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts the one with the smallest doc_id stays."""
    return exact_dedup.deduplicated(docs)


def near(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near duplicates (five-word shingles, similarity from 0.8 on) the document
    with the smallest doc_id stays."""
    return ngram_join.one_per_group(docs, n=5, percent=80)


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Sources at their target weights; a document taken more than once is repeated."""
    return mixing.mixed(docs)


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of every document of the mix, and the digests of its text and of the text read
    back from the ids."""
    model = public_tokenizers.path("piece_bpe_32k.model")
    return sentencepiece_codec.encoded_and_decoded(docs, model).select(
        "doc_id", "ids", F.size("ids").cast("long").alias("n_tokens"),
        F.sha2("text", 256).alias("text_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"))


STAGES = [("quality rules", quality), ("exact dedup", exact), ("n-gram Jaccard join", near),
          ("mixing", mix), ("SentencePiece", tokens)]

# The last stage segments texts with a vocabulary file, which SQL cannot.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    root = os.path.join(shared_folder(spark), "promptmill-llm", f"pipeline-{uuid.uuid4().hex}")
    for i, (_, stage) in enumerate(STAGES):
        stage(spark, docs, sf_dir).write.parquet(f"{root}/{i}")
        docs = spark.read.parquet(f"{root}/{i}")
    return docs
