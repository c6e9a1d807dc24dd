"""The registered queries opN_<name> and their SQL twins."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from postmill.llm import align, images, langid, mixing, packing, quality, resample, simhash, substring, surrogates, tokencounts, tokenfile, warczip


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def op1_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warczip.round_trip(spark.read.parquet(f"{sf_dir}/pages.parquet")).drop("payload", "url")


def op2_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tokenfile.token_digests(tokenfile.round_trip(documents(spark, sf_dir), public_tokenizers.path("byte_bpe_50k.json")))


def op3_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    return quality.label_lines(docs, quality.learn(docs, spark.read.parquet(f"{sf_dir}/labels.parquet")))


def op4_surrogates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return surrogates.replace_entities(documents(spark, sf_dir), surrogates.stated_key(spark, surrogates.EXAMPLE_KEY)).select("doc_id", "text", "n_entities")


def op5_images(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The tables hold no pictures, so Spark draws one from each vector, and edited copies of every tenth."""
    media = images.render(spark.read.parquet(f"{sf_dir}/embeddings.parquet"))
    return images.image_copies(media)


def op6_substring(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substring.remove_repeats(documents(spark, sf_dir))


def op7_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    return langid.predict(docs, langid.learn(docs)).drop("shares")


def op8_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(documents(spark, sf_dir), public_tokenizers.path("word_bpe_49k.json"))


def op9_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_duplicates(documents(spark, sf_dir)).withColumnRenamed("id", "doc_id")


def op10_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix_sources(documents(spark, sf_dir))


def op11_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tokencounts.token_counts(documents(spark, sf_dir), public_tokenizers.path("piece_bpe_32k.model"))


def op12_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    return align.link_statistics(documents(spark, sf_dir), public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model"))


def op13_resampling(spark: SparkSession, sf_dir: str) -> DataFrame:
    return resample.resample(documents(spark, sf_dir), spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {"op1_warc": op1_warc, "op2_token_files": op2_token_files, "op3_quality": op3_quality, "op4_surrogates": op4_surrogates, "op5_images": op5_images, "op6_substring": op6_substring, "op7_language": op7_language, "op8_packing": op8_packing, "op9_simhash": op9_simhash, "op10_mixing": op10_mixing, "op11_token_counts": op11_token_counts, "op12_alignment": op12_alignment, "op13_resampling": op13_resampling}


def oracle_sql() -> dict[str, str]:
    return {"op1_warc": warczip.ORACLE, "op6_substring": substring.ORACLE, "op10_mixing": mixing.ORACLE, "op13_resampling": resample.ORACLE}
