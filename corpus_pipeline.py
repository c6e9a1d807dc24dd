"""A training corpus in five stages: quality rules, near-duplicates, private data, mixture, packing.

Each stage takes (spark, docs, sf_dir) and works on all rows of docs; all but the last return the columns of documents.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from postmill.llm import mixing, packing, quality, similar, surrogates
from postmill.llm.shared import discard_tables, materialize, run_tables


def keep_good(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality rules reject go. The field is fitted on labelled rows of documents."""
    return quality.keep_content(docs, quality.learn(docs, spark.read.parquet(f"{sf_dir}/labels.parquet")))


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group stays, that of the smallest doc_id: groups of five-word shingles at 0.8 and of op9's links."""
    return similar.one_of_each(docs)


def hide_private(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Private data give way to surrogates; n_chars follows the new text."""
    return surrogates.replace_entities(docs, surrogates.stated_key(spark, surrogates.EXAMPLE_KEY)).withColumn("n_chars", F.length("text").cast("long")).select(docs.columns)


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document comes as often as its source's share of the mixture asks, up to three times."""
    return mixing.mixed_documents(docs)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The mixture's documents as pieces of full sequences."""
    return packing.pack(docs, public_tokenizers.path("word_bpe_49k.json"))


STAGES = [("quality_rules", keep_good), ("near_duplicates", drop_near_copies), ("private_data", hide_private), ("mixture", mix), ("packing", pack)]
#: line labelling, linking and packing are beyond SQL; tests/llm hold the stages against brute force
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    with run_tables() as tables:
        for name, stage in STAGES[:-1]:
            docs = materialize(stage(spark, docs, sf_dir), name)
            discard_tables(spark, tables, docs)
    return STAGES[-1][1](spark, docs, sf_dir)
