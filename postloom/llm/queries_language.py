"""Queries of problem 7."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from ..session import table
from .language import find_segments, wrong_labels


def p7_segments(spark: SparkSession, d: str) -> DataFrame:
    """Every stretch of prose with its language and a confidence."""
    return find_segments(table(spark, d, "posts_filtered"), "idx", "post_text", "lang")


def p7_found(spark: SparkSession, d: str) -> DataFrame:
    return wrong_labels(p7_segments(spark, d), "idx")


def p7_languages(spark: SparkSession, d: str) -> DataFrame:
    """Posts and sentences of each language."""
    return p7_segments(spark, d).groupBy("lang_code").agg(F.countDistinct("idx").alias("posts"), F.sum("sentences").cast("bigint").alias("sentences"))


def p7_covered(spark: SparkSession, d: str) -> DataFrame:
    """The posts that have a language or are told to have none, with their number of different stretches' places: each place is within the text."""
    posts = table(spark, d, "posts_filtered").select("idx", F.length(F.coalesce("post_text", F.lit(""))).alias("chars"))
    j = p7_segments(spark, d).join(posts, "idx")
    return j.groupBy("idx").agg(F.min((F.col("start") >= 0) & (F.col("start") <= F.col("end")) & (F.col("end") <= F.col("chars"))).alias("within"))


QUERIES = {"p7_found": p7_found, "p7_segments": p7_segments, "p7_languages": p7_languages, "p7_covered": p7_covered}

#: What holds of the results where SQL can't express all of them.
SQL = {"p7_covered": "select distinct idx, true as within from posts_filtered"}
