"""A training corpus from raw documents: five stages, each over all that the one before kept.

Every stage takes (spark, docs, sf_dir) and returns a DataFrame; ``run`` writes each result as Parquet in the shared folder
and reads it again as the next stage's documents. All but the last return the columns of documents.
"""

from __future__ import annotations

import os
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shelfline.llm import exact, langid, minhash, mixing, packing
from shelfline.llm.common import prepare
from shelfline.llm.registry import TOKENIZER, domain_of, mixing_weights
from shelfline.session import remove_folder, scratch_dir, scratch_scope

#: Share of the tokens that the mixture may hold, each document at most once.
SHARE, EPOCHS = 0.9, 1


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language is clear, with all their columns.

    Text that is null, has no letter or fits two languages alike goes; without any label every document goes.
    """
    prepare(spark)
    return langid.accepted(docs, langid.train(docs))


def exact_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each text, the one with the largest id; null text counts as empty, null ids as the smallest.

    Of rows that share text and id the first in the order of text and columns stays.
    """
    prepare(spark)
    return exact.deduplicated(docs)


def near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The document with the smallest id of each group of near copies; texts without a word are copies of nothing."""
    prepare(spark)
    return minhash.representatives(docs)


def mixture(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents up to the budgets of their sources, in words; null languages and sources are leaves of their own, and texts
    without a word are left out."""
    prepare(spark)
    return mixing.mixed_documents(docs, mixing_weights(spark), domain_of(), epochs=EPOCHS, share=SHARE)


def sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of token ids and their places in sequences; null text gives one piece with only the end id."""
    prepare(spark)
    pieces = packing.pack_documents(docs, TOKENIZER)
    return pieces.select("doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset")


STAGES = [("language", language), ("exact copies", exact_copies), ("near copies", near_copies), ("mixture", mixture), ("sequences", sequences)]

#: Compression, MinHash and tokenisation have no SQL; the tests hold each stage against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over documents. A stage's scratch goes when its result is written, and that when the next one's is."""
    docs, before = spark.read.parquet(f"{sf_dir}/documents.parquet"), None
    for name, stage in STAGES[:-1]:
        path = os.path.join(scratch_dir(spark), f"{name.replace(' ', '-')}-{uuid.uuid4().hex}")
        with scratch_scope(spark):
            out = stage(spark, docs, sf_dir)
            out.write.parquet(path)
        docs = spark.read.schema(out.schema).parquet(path)
        if before:
            remove_folder(spark, before)
        before = path
    return STAGES[-1][1](spark, docs, sf_dir)
