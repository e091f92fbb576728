"""Queries that repair labels and report their distributions."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from ..functions.text import strip, text_or_empty
from ..operators import labels as L
from ..session import table
from .filtering import _in


def _tagged(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "tagged_posts_v2_clean")


def vocab_repair(spark: SparkSession, d: str) -> DataFrame:
    return L.repair(_tagged(spark, d)).select("idx", "topic_broad", "sentiment", "stance", "post_type")


def correction_log(spark: SparkSession, d: str) -> DataFrame:
    return L.corrections(_tagged(spark, d))


def correction_counts(spark: SparkSession, d: str) -> DataFrame:
    return L.corrections(_tagged(spark, d)).groupBy("field", "original", "corrected").agg(F.count("*").alias("rows"))


def validity_flags(spark: SparkSession, d: str) -> DataFrame:
    flags = ("valid_sentiment", "valid_stance", "valid_post_type", "valid_topic_broad")
    return L.validity(_tagged(spark, d)).groupBy(*flags).agg(F.count("*").alias("rows"))


def kept_columns(spark: SparkSession, d: str) -> DataFrame:
    """The corpus as it is handed on: sound rows, the columns kept in their order."""
    return L.sound_rows(_tagged(spark, d)).select(*L.KEPT_COLUMNS).groupBy("platform", "audience_room_name").agg(F.count("*").alias("rows"), F.countDistinct("post_id").alias("posts"))


COUNTED = ("platform", "audience_room_name", "topic_broad", "sentiment", "stance", "post_type")


def value_counts_unpivoted(spark: SparkSession, d: str) -> DataFrame:
    return L.value_counts(_tagged(spark, d), COUNTED)


def _label() -> list:
    return [text_or_empty("topic_broad").alias("domain"), F.lower(strip(text_or_empty("topic"))).alias("label")]


def freq_of_freq_buckets(spark: SparkSession, d: str) -> DataFrame:
    posts = _tagged(spark, d).select(*_label()).where("label not in ('', 'unclassified')")
    return L.frequency_buckets(posts, ["domain", "label"], (1, 2, 4, 11, 31))


def label_buckets(spark: SparkSession, d: str) -> DataFrame:
    posts = _tagged(spark, d).where(F.col("post_type").isin(*L.TRANSFER_TYPES)).select(*_label()).where("label <> ''")
    return L.frequency_buckets(posts, ["domain", "label"], (1, 2, 4, 10, 30, 100))


QUERIES = {f.__name__: f for f in (vocab_repair, correction_log, correction_counts, validity_flags, kept_columns, value_counts_unpivoted, freq_of_freq_buckets, label_buckets)}


def _case(c: str, repairs: dict[str, str], default: str) -> str:
    return f"case {c} " + " ".join(f"when '{a}' then '{b}'" for a, b in repairs.items()) + f" else '{default}' end"


_REPAIRED = f"""
with t as (select idx, trim(coalesce(topic_broad, '')) as b, trim(coalesce(sentiment, '')) as s, trim(coalesce(stance, '')) as st, trim(coalesce(post_type, '')) as p from tagged_posts_v2_clean),
r as (
  select *, case when b = '' or b in {_in(L.DOMAINS)} then b else {_case("b", L.DOMAIN_REPAIRS, "Other")} end as topic_broad,
         case when s = '' or s in {_in(L.SENTIMENTS)} then s else {_case("s", L.STANCE_AS_SENTIMENT, "neutral")} end as sentiment,
         case when st = '' and s in {_in(L.STANCES)} then s else st end as stance,
         case when p = '' or p in {_in(L.POST_TYPES)} then p else {_case("p", L.POST_TYPE_REPAIRS, "show_and_tell")} end as post_type from t
), log as (
  select idx, 'topic_broad' as field, b as original, topic_broad as corrected from r where b <> topic_broad union all select idx, 'sentiment', s, sentiment from r where s <> sentiment
  union all select idx, 'stance', st, stance from r where st <> stance union all select idx, 'post_type', p, post_type from r where p <> post_type
)
"""


def _buckets(where: str, starts: tuple[int, ...]) -> str:
    cases = " ".join(f"when n < {b} then '{a if b == a + 1 else f'{a}-{b - 1}'}'" for a, b in zip(starts, starts[1:]))
    return f"""
select case {cases} else '{starts[-1]}+' end as bucket, count(*) as labels, cast(sum(n) as bigint) as posts
from (select coalesce(topic_broad, ''), lower(trim(coalesce(topic, ''))) as label, count(*) as n from tagged_posts_v2_clean where {where} group by 1, 2) group by 1"""


SQL = {
    "vocab_repair": _REPAIRED + "select idx, topic_broad, sentiment, stance, post_type from r",
    "correction_log": _REPAIRED + "select * from log",
    "correction_counts": _REPAIRED + "select field, original, corrected, count(*) as rows from log group by all",
    "validity_flags": f"""
select coalesce(sentiment, '') in {_in(L.SENTIMENTS)} as valid_sentiment, coalesce(stance, '') in {_in(L.STANCES)} as valid_stance, coalesce(post_type, '') in {_in(L.POST_TYPES)} as valid_post_type,
       coalesce(topic_broad, '') in {_in(L.DOMAINS)} as valid_topic_broad, count(*) as rows from tagged_posts_v2_clean group by all""",
    "kept_columns": f"""
select platform, audience_room_name, count(*) as rows, count(distinct post_id) as posts from tagged_posts_v2_clean
where lower(trim(coalesce(platform, ''))) in {_in(L.PLATFORMS)} and length(coalesce(audience_room_name, '')) <= 100 and not regexp_matches(coalesce(audience_room_name, ''), '^[{{"]') group by 1, 2""",
    "value_counts_unpivoted": " union all ".join(f"select '{c}' as column_name, coalesce({c}, '') as value, count(*) as rows from tagged_posts_v2_clean group by 1, 2" for c in COUNTED),
    "freq_of_freq_buckets": _buckets("lower(trim(coalesce(topic, ''))) not in ('', 'unclassified')", (1, 2, 4, 11, 31)),
    "label_buckets": _buckets(f"post_type in {_in(L.TRANSFER_TYPES)} and trim(coalesce(topic, '')) <> ''", (1, 2, 4, 10, 30, 100)),
}
