"""Queries of problems 2 and 5."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from ..session import table
from .components import match_groups
from .contributors import cap_records, contributor, largest_contributors, plain_score

#: Posts that a contributor may keep.
CAP = 20


def p2_found(spark: SparkSession, d: str) -> DataFrame:
    return match_groups(table(spark, d, "anchor_pattern_review"))


def p2_group_sizes(spark: SparkSession, d: str) -> DataFrame:
    """How many groups have how many labels."""
    sizes = p2_found(spark, d).groupBy("topic_domain", "group_label").agg(F.count("*").alias("labels"))
    return sizes.groupBy("labels").agg(F.count("*").alias("groups"))


def _capped(spark: SparkSession, d: str, keep: bool) -> DataFrame:
    posts = table(spark, d, "posts_filtered").select("idx", "profile_id", "label_useful", "platform")
    return cap_records(posts, "idx", contributor(F.col("profile_id")), plain_score(F.col("label_useful")), CAP, keep)


def p5_found(spark: SparkSession, d: str) -> DataFrame:
    return _capped(spark, d, keep=False).select("idx")


def p5_selection(spark: SparkSession, d: str) -> DataFrame:
    return _capped(spark, d, keep=True).select("idx", "profile_id", "label_useful")


def p5_largest(spark: SparkSession, d: str) -> DataFrame:
    return largest_contributors(table(spark, d, "posts_filtered"), contributor(F.col("profile_id")))


QUERIES = {"p2_found": p2_found, "p2_group_sizes": p2_group_sizes, "p5_found": p5_found, "p5_selection": p5_selection, "p5_largest": p5_largest}

_LABELS = r"""
with recursive rows0 as (
  select row_number() over () as r, topic_domain, upper(trim(human_decision, ' ' || chr(9) || chr(10) || chr(13))) as decision,
         coalesce(raw_label_or_group, '') || '|' || coalesce(proposed_canonical, '') as t from anchor_pattern_review
), labels as (
  select distinct r, topic_domain, decision, trim(regexp_replace(lower(l), '\s+', ' ', 'g')) as label
  from (select r, topic_domain, decision, unnest(string_split(t, '|')) as l from rows0)
  where trim(regexp_replace(lower(l), '\s+', ' ', 'g')) not in ('', 'n/a')
), stars as (
  select topic_domain, label, min(label) over (partition by r) as hub from labels where decision = 'APPLY'
), edges as (
  select distinct topic_domain, hub as a, label as b from stars union select distinct topic_domain, label, hub from stars
), reach(topic_domain, a, b) as (
  select topic_domain, a, b from edges union
  select reach.topic_domain, reach.a, edges.b from reach join edges on reach.topic_domain = edges.topic_domain and reach.b = edges.a
), groups0 as (select topic_domain, a as label, min(b) as g from reach group by topic_domain, a),
found as (
  select distinct l.topic_domain, l.label, coalesce(least(g.g, l.label), l.label) as group_label
  from labels l left join groups0 g on l.topic_domain = g.topic_domain and l.label = g.label
)
"""

_RANKED = r"""
with posts as (
  select *, case when lower(trim(profile_id)) in ('', 'unknown') then null else lower(trim(profile_id)) end as who,
         case when regexp_full_match(trim(label_useful), '[0-9]+(\.[0-9]+)?') and try_cast(trim(label_useful) as double) between 0 and 1
              then cast(trim(label_useful) as double) else -1 end as score from posts_filtered
), ranked as (select *, row_number() over (partition by who order by score desc, idx) as n from posts)
"""

SQL = {
    "p2_found": _LABELS + "select * from found",
    "p2_group_sizes": _LABELS + "select labels, count(*) as groups from (select topic_domain, group_label, count(*) as labels from found group by 1, 2) group by 1",
    "p5_found": _RANKED + "select idx from ranked where who is not null and n > 20",
    "p5_selection": _RANKED + "select idx, profile_id, label_useful from ranked where who is null or n <= 20",
    "p5_largest": _RANKED
    + "select who as contributor, count(*) as records, count(*) / (select count(*) from posts) as share from posts where who is not null group by who order by records desc, who limit 20",
}
