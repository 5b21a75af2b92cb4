"""A corpus pipeline over `documents`: language, near duplicates, secrets, mixing and packing, each stage written.

A stage is (spark, docs, sf_dir) -> DataFrame; all but the last return the columns of documents. A stage's result must be
written before the next stage is called: that call deletes the tables on which the stage before it worked.
"""

from __future__ import annotations

from functools import wraps

from pyspark.sql import DataFrame, SparkSession, functions as F

from opsight.llm import language, mixing, near, packing, queries, secrets
from opsight.llm.common import table
from opsight.session import collecting, discard, materialise

#: Tables that the latest stage wrote for itself.
_WORK: list[str] = []


def freeing(stage):
    """The stage, which first frees the tables of the one before."""

    @wraps(stage)
    def run(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
        discard(spark, _WORK)
        with collecting(_WORK):
            return stage(spark, docs, sf_dir)

    return run


@freeing
def known_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language is told with a sufficient margin."""
    return language.identify(docs, language.learn(docs), keep=tuple(docs.columns), only_accepted=True)


@freeing
def one_of_each(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each class of near duplicates (a similarity of 0.80 or more): the one with the least id."""
    return near.keep_one(docs, percent=80)


@freeing
def without_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, with secrets masked and their lengths counted anew."""
    masked = secrets.mask(docs, queries.word_list())
    return masked.withColumn("n_chars", F.length("text").cast("long")).select(*docs.columns)


@freeing
def mixed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents drawn to the target weights; one that its leaf needs twice comes twice."""
    return mixing.mix(docs, queries.mix_levels(), report=False)


@freeing
def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of training sequences."""
    return queries.piece_digests(packing.pack(docs, queries.tokenizer()))


STAGES = [("language", known_language), ("near_duplicates", one_of_each), ("secrets", without_secrets),
          ("mixing", mixed), ("packing", packed)]
#: Compression, sketches, guess costs, seeded orders and packing have no SQL form; tests/llm checks run() by brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for _, stage in STAGES[:-1]:
        docs = materialise(stage(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)
