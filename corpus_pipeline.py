"""From raw documents to token ids: five operators, each on all that the one before has kept."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tidewatch.llm import bpe, decontaminate, pii, quality, simhash
from tidewatch.llm.common import table
from tidewatch.llm.queries import TOKENIZERS, trusted
from tidewatch.session import cut_lineage


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that fail a rule or read unlike the trusted ones go."""
    return quality.keep_good(docs, trusted(spark, sf_dir))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies stays."""
    return simhash.keep_one(docs, shingle_words=3, max_bits=3)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold an item of the benchmark go."""
    return decontaminate.keep_clean(docs, table(spark, sf_dir, "benchmark"))


def personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Personal data is masked; every document stays."""
    return pii.mask(docs, pii.train(pii.sample_labels(spark)))


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with their token ids and the text decoded from them."""
    return bpe.encode(docs, f"{TOKENIZERS}/byte_bpe_50k.json", decoded="text")


STAGES = [
    ("quality_rules", quality_rules),
    ("near_duplicates", near_duplicates),
    ("decontamination", decontamination),
    ("personal_data", personal_data),
    ("tokens", tokens),
]

#: Hashed n-grams, a trained random field and a tokenizer cannot be written in SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages on ``documents``; each result is written to the shared folder and read again."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = cut_lineage(stage(spark, docs, sf_dir), f"stage-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
