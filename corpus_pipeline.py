"""From raw to training documents: stages that each write what the next one reads.

Each takes (spark, docs, folder) and returns the rows it keeps, with the columns of docs; the last
returns token ids in digest.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lexigrid.llm import bpe, lang_id
from lexigrid.llm.decontaminate import Decontamination
from lexigrid.llm.exact_dedup import Dedup
from lexigrid.llm.jaccard_join import JaccardJoin
from lexigrid.llm.shared import read, scratch, stage

# A text in none of the learned languages has a cosine near 0 with all of them (its spread is 1/32).
LEAST_SCORE = 0.05
# So has a text of a few n-grams in a learned one; with so many distinct ones the least cosine on sf0.1 is 0.29.
LEAST_GRAMS = 64


def language(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """Documents without a letter, or long enough to judge and like none of the languages learned, go."""
    space = lang_id.Space()
    found = lang_id.identify(docs, space, lang_id.learn(docs, space))
    fits = (F.col("_llm_score") >= LEAST_SCORE) | (F.col("_llm_grams") < LEAST_GRAMS)
    return found.where((F.col("_llm_lang") != "und") & fits).select(*docs.columns)


def exact(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """Of equal texts, the row with the largest doc_id stays."""
    return Dedup(docs).kept_rows()


def near(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """Of each group of documents linked by similar five-word n-grams, the least doc_id stays."""
    return JaccardJoin(docs, size=5, percent=80).kept_rows()


def benchmarks(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """Documents with a passage of ten words of a benchmark item (or a whole shorter one) go."""
    return Decontamination(docs, read(spark, folder, "benchmark"), size=10).clean_rows()


def tokens(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """doc_id, n_tokens, ids_sha256, decoded_sha256 of what is left."""
    path = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
    return bpe.round_trip(docs, bpe.load_tokenizer(path, public_tokenizers.PATTERN))


STAGES = [
    ("language", language), ("exact dedup", exact), ("near duplicates", near), ("benchmarks", benchmarks), ("tokens", tokens),
]

# Languages are learned and cannot be told in SQL; tests compare the stages with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, folder: str) -> DataFrame:
    """All stages in order, starting from the table documents."""
    docs, work = read(spark, folder, "documents"), scratch(spark, "pipeline")
    for i, (_, step) in enumerate(STAGES[:-1]):
        docs = stage(step(spark, docs, folder), f"{work}/{i}")
    return STAGES[-1][1](spark, docs, folder)
