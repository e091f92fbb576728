"""Queries of problems 4 and 10."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from ..session import table
from .residue import find_residue
from .truncation import find_truncated, truncation_rates


def p4_excluded(spark: SparkSession, d: str) -> DataFrame:
    """The posts left out, with the reason."""
    return find_residue(table(spark, d, "posts_filtered"), "idx", "post_text")


def p4_found(spark: SparkSession, d: str) -> DataFrame:
    return p4_excluded(spark, d).select("idx")


def p4_clean(spark: SparkSession, d: str) -> DataFrame:
    """The posts without them."""
    posts = table(spark, d, "posts_filtered").select("idx", "platform", "post_text")
    return posts.join(p4_found(spark, d), "idx", "left_anti")


def p10_judged(spark: SparkSession, d: str) -> DataFrame:
    return find_truncated(table(spark, d, "documents"))


def p10_found(spark: SparkSession, d: str) -> DataFrame:
    return p10_judged(spark, d).where("cut").select("doc_id")


def p10_rates(spark: SparkSession, d: str) -> DataFrame:
    return truncation_rates(p10_judged(spark, d))


def p4_partition(spark: SparkSession, d: str) -> DataFrame:
    """Posts of each platform, clean or excluded: none is lost or twice."""
    posts = table(spark, d, "posts_filtered").select("idx", "platform")
    left_out = posts.join(p4_found(spark, d), "idx", "left_semi").select("idx", "platform")
    return p4_clean(spark, d).select("idx", "platform").unionByName(left_out).groupBy("platform").agg(F.count("*").alias("posts"), F.countDistinct("idx").alias("different"))


def p4_plain_placeholders(spark: SparkSession, d: str) -> DataFrame:
    """The excluded posts whose text has a field of the form {{name}} and no code."""
    plain = table(spark, d, "posts_filtered").where(F.col("post_text").rlike(r"\{\{ *[a-z_]+ *\}\}") & ~F.contains("post_text", F.lit("`"))).select("idx")
    return plain.join(p4_found(spark, d), "idx", "left_semi")


def p10_documents(spark: SparkSession, d: str) -> DataFrame:
    """Documents judged of each source."""
    return p10_rates(spark, d).select("source", "documents")


def p10_marked(spark: SparkSession, d: str) -> DataFrame:
    """The cut documents that end in a mark in brackets that says so."""
    marked = table(spark, d, "documents").where(F.col("text").rlike(MARKED)).select("doc_id")
    return marked.distinct().join(p10_found(spark, d), "doc_id", "left_semi")


#: A certain mark at the end of a text, for p10_marked.
MARKED = r"\[(\.\.\.|…|truncated|more|continued)\]\s*$"

QUERIES = {"p4_found": p4_found, "p4_excluded": p4_excluded, "p4_clean": p4_clean, "p4_partition": p4_partition, "p4_plain_placeholders": p4_plain_placeholders, "p10_found": p10_found, "p10_rates": p10_rates, "p10_documents": p10_documents, "p10_marked": p10_marked}
#: What holds of the results where SQL can't express all of them.
SQL = {
    "p4_partition": "select platform, count(*) as posts, count(distinct idx) as different from posts_filtered group by 1",
    "p4_plain_placeholders": r"select idx from posts_filtered where regexp_matches(post_text, '\{\{ *[a-z_]+ *\}\}') and not contains(post_text, '`')",
    "p10_documents": r"select source, count(*) as documents from documents where length(regexp_replace(text, '[\s\p{Z}\x0b\x1c-\x1f\x85]', '', 'g')) > 0 group by 1",
    "p10_marked": f"select distinct doc_id from documents where regexp_matches(text, '{MARKED}')",
}
