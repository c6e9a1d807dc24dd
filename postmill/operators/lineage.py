"""Tables cut from their lineage, and row numbers over all rows without a task that holds them all."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F


def cut(df: DataFrame) -> DataFrame:
    """df as a Parquet table in the folder of spark.checkpoint.dir, read back: it is computed once, and survives lost executors.

    (A checkpoint of rows that aren't held in memory computes them twice.)"""
    path = shared_path(df.sparkSession, "cut")
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def shared_path(spark: SparkSession, name: str) -> str:
    """A new path in the folder of spark.checkpoint.dir; only a local session without the setting gets a temporary one."""
    folder = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir")
    if not folder and not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder that driver and executors share")
    return f"{(folder or tempfile.mkdtemp(prefix='spark-shared-')).rstrip('/')}/{name}-{uuid.uuid4().hex}"


def ranked(rows: DataFrame, name: str, *order: Column, by: tuple[str, ...] = ()) -> DataFrame:
    """rows with a number from 1 in the given order, within each value of `by`.

    Rows are dealt by ranges of the order, numbered within their range, and moved by the counts of the ranges before; only
    those counts meet in a window. Ties in the order are numbered in any order.
    """
    dealt = cut(rows.repartitionByRange(*[F.col(c) for c in by], *order).withColumn("_range", F.spark_partition_id()))
    within = dealt.withColumn("_n", F.row_number().over(Window.partitionBy(*by, "_range").orderBy(*order)))
    counts = dealt.groupBy(*by, "_range").agg(F.count(F.lit(1)).alias("_k"))
    before = counts.withColumn("_before", F.sum("_k").over(Window.partitionBy(*by).orderBy("_range")) - F.col("_k")).select(*[F.col(c).alias(f"_by_{c}") for c in by], F.col("_range").alias("_r"), "_before")
    same = F.col("_range") == F.col("_r")
    for c in by:
        same = same & F.col(c).eqNullSafe(F.col(f"_by_{c}"))
    return within.join(before, same).withColumn(name, (F.col("_n") + F.col("_before")).cast("long")).select(*rows.columns, name)
