"""Helpers shared by the operators: scratch tables, text columns, SQL texts and sizes."""

from __future__ import annotations

import os

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from shelfmark.session import materialize, scratch_dir

__all__ = ["drop_scratch", "in_scratch", "lower_ascii", "materialize", "parts", "scratch_dir", "table", "text_of"]

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def text_of(name: str) -> Column:
    """The column as text; null is the empty text."""
    return F.coalesce(F.col(name).cast("string"), F.lit(""))


def lower_ascii(column: Column) -> Column:
    """A-Z in lower case, all else as it is."""
    return F.translate(column, UPPER, LOWER)


def parts(spark: SparkSession) -> int:
    """Number of shuffle partitions of the session; grows with the data as the user sets it."""
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def in_scratch(spark: SparkSession, name: str) -> str:
    """A new path in the shared folder."""
    return scratch_dir(spark, name)


def drop_scratch(spark: SparkSession, path: str) -> None:
    """Delete a scratch table that no later step reads."""
    hadoop = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    hadoop.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(hadoop, True)


def tokenizer_file(name: str) -> str:
    """Place of a public vocabulary file, or the path itself."""
    if os.path.sep in name:
        return name
    import public_tokenizers

    return public_tokenizers.path(name)
