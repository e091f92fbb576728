"""Queries of problem 3."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from ..session import table
from .personal import find_personal


def p3_found(spark: SparkSession, d: str) -> DataFrame:
    return find_personal(table(spark, d, "posts_clean_v2"), "idx", "post_text", "author_name")


def p3_redacted(spark: SparkSession, d: str) -> DataFrame:
    """The texts with placeholders."""
    return find_personal(table(spark, d, "posts_clean_v2"), "idx", "post_text", "author_name", redact=True)


def p3_plain_emails(spark: SparkSession, d: str) -> DataFrame:
    """The posts whose text has an address in plain spelling, among those found."""
    plain = table(spark, d, "posts_clean_v2").where(F.col("post_text").rlike(PLAIN)).select("idx")
    return plain.join(p3_found(spark, d).where("field_name = 'post_text' and kind = 'email'").select("idx"), "idx", "left_semi")


def p3_left(spark: SparkSession, d: str) -> DataFrame:
    """Posts, and texts with an address in plain spelling or one left in them, after redaction."""
    return p3_redacted(spark, d).agg(F.count("*").alias("posts"), F.count_if(F.col("post_text").rlike(PLAIN) | F.col("author_name").rlike(PLAIN)).alias("addresses_left"))


#: An address in plain spelling between blanks.
PLAIN = r"(^|\s)[a-z][a-z0-9._]*@[a-z0-9-]+(\.[a-z0-9-]+)*\.[a-z]{2,7}[.,]?(\s|$)"

QUERIES = {"p3_found": p3_found, "p3_redacted": p3_redacted, "p3_plain_emails": p3_plain_emails, "p3_left": p3_left}

#: What holds of the results where SQL can't express all of them.
SQL = {
    "p3_plain_emails": f"select idx from posts_clean_v2 where regexp_matches(post_text, '{PLAIN}')",
    "p3_left": "select count(*) as posts, 0 as addresses_left from posts_clean_v2",
}
