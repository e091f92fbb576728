"""Queries over the matrix of audience and topic."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from ..functions.text import one_decimal, text_or_empty
from ..operators.cells import AUDIENCES, CellConfig, coverage, eligible, matrix, statistics, top_groups, viability
from ..operators.labels import TRANSFER_TYPES
from ..session import table
from .filtering import _in


def _posts(spark: SparkSession, d: str, field: str = "topic") -> DataFrame:
    return eligible(table(spark, d, "tagged_posts_v2_clean"), CellConfig(group_field=field))


def _cells(spark: SparkSession, d: str) -> DataFrame:
    return matrix(_posts(spark, d))


def cell_matrix(spark: SparkSession, d: str) -> DataFrame:
    return _cells(spark, d)


def cell_matrix_by_domain(spark: SparkSession, d: str) -> DataFrame:
    return matrix(_posts(spark, d, "topic_broad")).drop("li_top_narrow", "rd_top_narrow", "li_top_subtopics", "rd_top_subtopics")


def valid_pairs(spark: SparkSession, d: str) -> DataFrame:
    """The cells of audience and domain with at least ten posts on both sides and no author above half of one."""
    return cell_matrix_by_domain(spark, d).select("audience", "group_label", ((F.col("linkedin_posts") >= 10) & (F.col("reddit_posts") >= 10)).alias("valid_pair"), (F.greatest("li_top_author_pct", "rd_top_author_pct") > 50).alias("concentrated"))


def bilateral_viability(spark: SparkSession, d: str) -> DataFrame:
    return viability(_cells(spark, d))


def audience_coverage(spark: SparkSession, d: str) -> DataFrame:
    return coverage(_cells(spark, d))


def top_topics_per_audience(spark: SparkSession, d: str) -> DataFrame:
    return top_groups(_cells(spark, d))


def cell_statistics(spark: SparkSession, d: str) -> DataFrame:
    return statistics(_posts(spark, d))


def sentiment_by_platform(spark: SparkSession, d: str) -> DataFrame:
    posts = table(spark, d, "tagged_posts_v2_clean").where(F.col("post_type").isin(*TRANSFER_TYPES)).select(F.lower(text_or_empty("platform")).alias("platform"), text_or_empty("sentiment").alias("sentiment"))
    counts = posts.groupBy("platform", "sentiment").agg(F.count("*").alias("posts"))
    sums = counts.groupBy(F.col("platform").alias("of")).agg(F.sum("posts").alias("total"))
    return counts.join(sums, F.col("platform") == F.col("of")).select("platform", "sentiment", "posts", one_decimal(100.0 * F.col("posts") / F.col("total")).alias("pct"))


def post_type_breakdown(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "tagged_posts_v2_clean").groupBy(text_or_empty("post_type").alias("post_type")).agg(F.count("*").alias("posts")).withColumn("transfer", F.col("post_type").isin(*TRANSFER_TYPES))


def bilateral_dataset(spark: SparkSession, d: str) -> DataFrame:
    """The posts of both-sided cells."""
    cells = _cells(spark, d).where("linkedin_posts > 0 and reddit_posts > 0").select("audience", "group_label")
    return _posts(spark, d).join(cells, ["audience", "group_label"], "left_semi").select("idx", "audience", "group_label", "side")


QUERIES = {f.__name__: f for f in (cell_matrix, cell_matrix_by_domain, valid_pairs, bilateral_viability, audience_coverage, top_topics_per_audience, cell_statistics, sentiment_by_platform, post_type_breakdown, bilateral_dataset)}

_AUDIENCE = "coalesce(case trim(coalesce(audience_room_name, '')) " + " ".join(f"when '{a}' then '{b}'" for a, b in AUDIENCES.items()) + " end, trim(coalesce(audience_room_name, '')))"


def _eligible(field: str = "topic") -> str:
    return f"""
with posts as (
  select idx, {_AUDIENCE} as audience, trim(coalesce({field}, '')) as group_label, case lower(platform) when 'linkedin' then 'li' else 'rd' end as side, trim(coalesce(profile_id, '')) as profile_id, length(coalesce(post_text, '')) as chars,
         case when trim(coalesce(topic_narrow, '')) not in ('', trim(topic)) then trim(topic_narrow) end as narrow, case when json_valid(opinion_subtopics) then cast(opinion_subtopics as json) end as j, coalesce(sentiment, '') as sentiment
  from tagged_posts_v2_clean
  where trim(coalesce(topic, '')) not in ('', 'UNCLASSIFIED') and trim(coalesce(post_type, '')) in {_in(TRANSFER_TYPES)} and trim(coalesce({field}, '')) <> '' and lower(platform) in ('linkedin', 'reddit')
), authors as (select audience, group_label, side, profile_id, count(*) as n from posts group by all),
counts as (
  select audience, group_label, cast(coalesce(sum(n) filter (side = 'li'), 0) as bigint) as linkedin_posts, cast(coalesce(sum(n) filter (side = 'rd'), 0) as bigint) as reddit_posts, cast(sum(n) as bigint) as total_posts,
         count(*) filter (side = 'li') as li_unique_authors, count(*) filter (side = 'rd') as rd_unique_authors,
         round_even(100.0 * coalesce(max(n) filter (side = 'li'), 0) / greatest(coalesce(sum(n) filter (side = 'li'), 0), 1), 1) as li_top_author_pct,
         round_even(100.0 * coalesce(max(n) filter (side = 'rd'), 0) / greatest(coalesce(sum(n) filter (side = 'rd'), 0), 1), 1) as rd_top_author_pct from authors group by 1, 2
), both_sided as (select * from counts where linkedin_posts > 0 and reddit_posts > 0),
narrows as (select audience, group_label, side, narrow as v, count(*) as n, min(idx) as first from posts where narrow is not null group by all),
subtopics as (
  select audience, group_label, side, v, count(*) as n, min(idx) as first from (select idx, audience, group_label, side, unnest(cast(j as varchar[])) as v from posts where json_type(j) = 'ARRAY') where trim(v) <> '' group by all
), tops as (
  select audience, group_label, side, 'narrow' as what, string_agg(v, ' | ' order by r) as s from (select *, row_number() over (partition by audience, group_label, side order by n desc, first, v) as r from narrows) where r <= 3 group by all
  union all select audience, group_label, side, 'subtopics', string_agg(v, ' | ' order by r) from (select *, row_number() over (partition by audience, group_label, side order by n desc, first, v) as r from subtopics) where r <= 5 group by all
)
"""


def _top(side: str, what: str) -> str:
    return f"coalesce((select max(s) from tops t where t.audience = c.audience and t.group_label = c.group_label and side = '{side}' and what = '{what}'), '') as {side}_top_{what}"


SQL = {
    "cell_matrix": _eligible() + f"select c.*, {_top('li', 'narrow')}, {_top('rd', 'narrow')}, {_top('li', 'subtopics')}, {_top('rd', 'subtopics')} from counts c",
    "cell_matrix_by_domain": _eligible("topic_broad") + "select * from counts",
    "valid_pairs": _eligible("topic_broad") + "select audience, group_label, linkedin_posts >= 10 and reddit_posts >= 10 as valid_pair, greatest(li_top_author_pct, rd_top_author_pct) > 50 as concentrated from counts",
    "bilateral_viability": _eligible()
    + """select count(*) as cells, count(*) filter (linkedin_posts > 0 and reddit_posts > 0) as bilateral, count(*) filter (reddit_posts = 0) as linkedin_only, count(*) filter (linkedin_posts = 0) as reddit_only,
       count(*) filter (least(linkedin_posts, reddit_posts) >= 10) as viable_10, count(*) filter (least(linkedin_posts, reddit_posts) >= 30) as viable_30 from counts""",
    "audience_coverage": _eligible()
    + """select audience, cast(sum(linkedin_posts) as bigint) as linkedin_posts, cast(sum(reddit_posts) as bigint) as reddit_posts, count(*) filter (linkedin_posts > 0 and reddit_posts > 0) as bilateral_cells,
       sum(linkedin_posts) = 0 or sum(reddit_posts) = 0 as one_sided from counts group by 1""",
    "top_topics_per_audience": _eligible()
    + """, ranked as (select *, row_number() over (partition by audience order by total_posts desc, group_label) as rank, sum(total_posts) over (partition by audience) as all_posts from counts)
select audience, rank, group_label, linkedin_posts, reddit_posts, round_even(100.0 * sum(total_posts) over (partition by audience order by rank) / all_posts, 1) as covered_pct from ranked where rank <= 20""",
    "cell_statistics": _eligible()
    + """, g as (
  select audience, group_label, count(*) filter (side = 'li') as li_posts, count(*) filter (side = 'rd') as rd_posts, avg(chars) filter (side = 'li') as li_mean_chars, avg(chars) filter (side = 'rd') as rd_mean_chars,
         count(*) filter (sentiment = 'positive') as positive, count(*) filter (sentiment = 'negative') as negative, count(*) filter (sentiment = 'neutral') as neutral, count(*) filter (sentiment = 'mixed') as mixed from posts group by 1, 2)
select *, least(li_posts, rd_posts) >= 10 as clears_10_per_side, li_posts + rd_posts >= 42 and least(li_posts, rd_posts) < 10 as severely_imbalanced from g where least(li_posts, rd_posts) > 0""",
    "sentiment_by_platform": f"""
select lower(coalesce(platform, '')) as platform, coalesce(sentiment, '') as sentiment, count(*) as posts, round_even(100.0 * count(*) / sum(count(*)) over (partition by lower(coalesce(platform, ''))), 1) as pct
from tagged_posts_v2_clean where post_type in {_in(TRANSFER_TYPES)} group by 1, 2""",
    "post_type_breakdown": f"select coalesce(post_type, '') as post_type, count(*) as posts, coalesce(post_type, '') in {_in(TRANSFER_TYPES)} as transfer from tagged_posts_v2_clean group by 1",
    "bilateral_dataset": _eligible() + "select p.idx, p.audience, p.group_label, p.side from posts p join both_sided b on p.audience = b.audience and p.group_label = b.group_label",
}
