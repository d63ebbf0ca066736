"""The training-data pipeline: five stages over the documents table, each written as Parquet and read again.

Stage by stage: texts whose language can't be told go (null texts and texts without a letter); of each class of near
duplicates the document of the smallest id stays (null ids last), documents without a word all; documents into which a
benchmark item leaks go; personal data becomes keyed surrogates (``n_chars`` follows the new text); texts become
byte-level BPE ids.  All stages but the last return the columns of documents.  Equal rows stay equal rows, except that
near-duplicate removal keeps one of them.  What one stage wrote goes once the next has written its own.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cinerank.llm import bpe, decontam, jaccard, langid, pii
from cinerank.llm.common import fold, read
from cinerank.llm.queries import PII_KEY
from cinerank.session import remove_path, scratch_path


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return langid.tellable(docs, langid.fit(docs.where(fold(4) != 2)))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return jaccard.representatives(docs)


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    found = decontam.find_leaks(docs, read(spark, sf_dir, "benchmark"), out="leaks_")
    return found.where(F.size("leaks_") == 0).select(*docs.columns)


def personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    out = pii.replace(docs, PII_KEY, entities="entities_")
    return out.withColumn("n_chars", F.when(F.size("entities_") > 0, F.length("text").cast("long")).otherwise(F.col("n_chars"))).select(*docs.columns)


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return bpe.digests(docs, public_tokenizers.path(bpe.VOCABULARY), public_tokenizers.PATTERN)


STAGES = [
    ("language", language),
    ("near_duplicates", near_duplicates),
    ("decontaminate", decontaminate),
    ("personal_data", personal_data),
    ("encode", encode),
]

#: The stages learn models, prune by posterior odds and run keyed permutations, which SQL can't express.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, last = read(spark, sf_dir, "documents"), None
    for name, stage in STAGES[:-1]:
        path = scratch_path(spark, f"pipeline-{name}")
        stage(spark, docs, sf_dir).write.parquet(path)
        if last:
            remove_path(spark, last)
        docs, last = spark.read.parquet(path), path
    return STAGES[-1][1](spark, docs, sf_dir)
