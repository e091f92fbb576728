"""Queries over topic labels and their map."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from ..operators import topics as T
from ..operators.labels import ACTIVE_DOMAINS, TRANSFER_TYPES
from ..session import table
from .filtering import _in


def _tagged(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "tagged_posts_v2_clean").select("idx", "topic_broad", "topic", "topic_narrow", "post_type")


def label_frequency(spark: SparkSession, d: str) -> DataFrame:
    return T.frequencies(_tagged(spark, d))


def label_frequency_all(spark: SparkSession, d: str) -> DataFrame:
    return T.frequencies(_tagged(spark, d), with_unclassified=True)


def _map(spark: SparkSession, d: str) -> DataFrame:
    return T.example_map(label_frequency(spark, d))


def self_map_repair(spark: SparkSession, d: str) -> DataFrame:
    return T.repair_self_map(_map(spark, d))


def apply_topic_map(spark: SparkSession, d: str) -> DataFrame:
    return T.apply_map(_tagged(spark, d), self_map_repair(spark, d)).select("idx", "topic", "topic_raw", "map_status")


def map_summary_rollup(spark: SparkSession, d: str) -> DataFrame:
    return T.map_summary(T.apply_map(_tagged(spark, d), self_map_repair(spark, d)))


def mapping_validation(spark: SparkSession, d: str) -> DataFrame:
    return T.mapping_faults(_map(spark, d))


def canonical_frequency(spark: SparkSession, d: str) -> DataFrame:
    return T.canonical_frequencies(label_frequency(spark, d), self_map_repair(spark, d))


def normalisation_summary(spark: SparkSession, d: str) -> DataFrame:
    return T.normalisation_summary(canonical_frequency(spark, d))


def canonical_review(spark: SparkSession, d: str) -> DataFrame:
    return T.review(label_frequency(spark, d), self_map_repair(spark, d))


def coverage_thresholds(spark: SparkSession, d: str) -> DataFrame:
    return T.coverage_at(label_frequency(spark, d))


def coverage_curve(spark: SparkSession, d: str) -> DataFrame:
    return T.coverage_curve(label_frequency(spark, d))


def named_event_frequency(spark: SparkSession, d: str) -> DataFrame:
    return T.event_frequencies(T.events(_tagged(spark, d)))


def topic_frequency(spark: SparkSession, d: str) -> DataFrame:
    """Topics of events() with posts, single or recurring."""
    posts = T.events(_tagged(spark, d)).groupBy("domain", "topic").count().withColumnRenamed("count", "posts")
    return posts.selectExpr("domain", "topic", "posts", "posts > 1 as recurring")


def ambiguous_topics(spark: SparkSession, d: str) -> DataFrame:
    return T.ambiguous_topics(T.events(_tagged(spark, d)))


def event_rows(spark: SparkSession, d: str) -> DataFrame:
    return T.first_of_each_event(T.events(_tagged(spark, d)))


def theme_groups(spark: SparkSession, d: str) -> DataFrame:
    return T.themes(label_frequency(spark, d))


def two_method_counts(spark: SparkSession, d: str) -> DataFrame:
    return T.two_counts(label_frequency(spark, d), self_map_repair(spark, d))


QUERIES = {
    f.__name__: f
    for f in (
        label_frequency, label_frequency_all, self_map_repair, apply_topic_map, map_summary_rollup, mapping_validation, canonical_frequency, normalisation_summary, canonical_review, coverage_thresholds, coverage_curve, named_event_frequency, topic_frequency, ambiguous_topics, event_rows, theme_groups, two_method_counts,
    )
}

_L = r"""
with labelled as (
  select *, regexp_replace(coalesce(topic_broad, ''), '^[\s\p{Z}]+|[\s\p{Z}]+$', '', 'g') as domain, lower(regexp_replace(coalesce(topic, ''), '^[\s\p{Z}]+|[\s\p{Z}]+$', '', 'g')) as label,
         lower(regexp_replace(coalesce(topic_narrow, ''), '^[\s\p{Z}]+|[\s\p{Z}]+$', '', 'g')) as narrow0 from tagged_posts_v2_clean
), freq as (select domain, label, count(*) as posts from labelled where label not in ('', 'unclassified') group by 1, 2),
map0 as (
  select domain, label as raw_label, case when length(label) % 5 = 0 then 'self-map' when length(label) % 3 = 0 then label else regexp_replace(label, '^[a-z]+ ', '') end as canonical from freq where length(label) % 7 <> 0
), map as (select domain, raw_label, case when canonical = 'self-map' then raw_label else canonical end as canonical from map0),
mapped as (
  select l.*, m.canonical, case when l.label in ('', 'unclassified') then 'unchanged' when m.canonical is null then 'unmapped' when m.canonical = l.label then 'unchanged' else 'mapped' end as map_status
  from labelled l left join map m on l.domain = m.domain and l.label = m.raw_label
), canonicals as (
  select coalesce(m.domain, f.domain) as domain, coalesce(m.canonical, f.label) as canonical, cast(sum(coalesce(f.posts, 0)) as bigint) as posts, count(*) as raw_labels from map m full join freq f on m.domain = f.domain and m.raw_label = f.label group by 1, 2
)
"""
_E = (
    _L
    + f""", events as (
  select idx, domain, label as topic, case when narrow0 not in ('', label) then narrow0 end as narrow from labelled where domain in {_in(ACTIVE_DOMAINS)} and post_type in {_in(TRANSFER_TYPES)} and label not in ('', 'unclassified')
)
"""
)

SQL = {
    "label_frequency": _L + "select * from freq",
    "label_frequency_all": _L + "select domain, label, count(*) as posts from labelled where label <> '' group by 1, 2",
    "self_map_repair": _L + "select * from map",
    "apply_topic_map": _L + "select idx, case when map_status = 'mapped' then canonical else topic end as topic, label as topic_raw, map_status from mapped",
    "map_summary_rollup": _L
    + """select domain, count(*) as posts, count(*) filter (map_status = 'mapped') as mapped, count(*) filter (map_status = 'unchanged') as unchanged, count(*) filter (map_status = 'unmapped') as unmapped,
       round_even(100.0 * count(*) filter (map_status = 'mapped') / count(*), 1) as mapped_pct from mapped group by rollup(domain)""",
    "mapping_validation": _L
    + """select * from (select domain, raw_label, case when trim(canonical) = '' then 'empty' when length(canonical) > 80 then 'too_long' when canonical <> lower(canonical) then 'not_lower' when regexp_matches(canonical, '["''{}\\[\\]]') then 'bad_character' end as fault from map0) where fault is not null""",
    "canonical_frequency": _L + "select * from canonicals",
    "normalisation_summary": _L
    + """select domain, cast(sum(posts) as bigint) as posts, count(*) as canonicals, count(*) filter (posts >= 10) as at_least_10, count(*) filter (posts >= 30) as at_least_30,
       round_even(100.0 * coalesce(sum(posts) filter (posts >= 2), 0) / greatest(sum(posts), 1), 1) as recurring_pct from canonicals group by 1""",
    "canonical_review": _L
    + """, j as (select m.domain, m.canonical, m.raw_label, coalesce(f.posts, 0) as n from map m left join freq f on m.domain = f.domain and m.raw_label = f.label),
r as (select *, row_number() over (partition by domain, canonical order by n desc, raw_label) as r from j)
select domain, canonical, cast(sum(n) as bigint) as posts, count(*) as raw_labels, string_agg(raw_label, ', ' order by r) filter (r <= 5) as top_raw from r group by 1, 2""",
    "coverage_thresholds": _L
    + "select domain, cast(sum(posts) as bigint) as posts, "
    + ", ".join(f"cast(coalesce(sum(posts) filter (posts >= {t}), 0) as bigint) as at_{t}" for t in (2, 5, 10, 30))
    + " from freq group by 1",
    "coverage_curve": _L
    + """, s as (select posts as label_size, count(*) as labels, cast(sum(posts) as bigint) as posts from freq group by 1)
select *, sum(posts) over (order by label_size desc) / sum(posts) over () as covered from s""",
    "named_event_frequency": _E + "select domain, narrow, count(*) as posts from events where narrow is not null group by 1, 2",
    "topic_frequency": _E + "select domain, topic, count(*) as posts, count(*) > 1 as recurring from events group by 1, 2",
    "ambiguous_topics": _E + "select domain, topic, count(distinct narrow) as events, count(*) as posts from events group by 1, 2 having count(distinct narrow) >= 3",
    "event_rows": _E
    + """, n as (select *, count(*) over (partition by domain, topic) as topic_posts from events)
select idx, domain, topic, narrow, topic_posts from (select *, row_number() over (partition by domain, narrow order by topic_posts desc, idx) as r from n where narrow is not null) where r = 1""",
    "theme_groups": _L
    + """, g as (select domain, array_to_string(string_split(label, ' ')[1:2], ' ') as theme, count(*) as labels, cast(sum(posts) as bigint) as posts from freq group by 1, 2)
select domain, theme, labels, posts from (select *, row_number() over (partition by domain order by labels desc, posts desc, theme) as r from g) where r <= 20""",
    "two_method_counts": _L
    + """, recurring as (select domain, canonical as label from canonicals where posts >= 2), single as (select domain, label from freq where posts = 1),
a as (select domain, count(*) as n from (select * from recurring union all select * from single) group by 1), b as (select domain, count(*) as n from canonicals group by 1),
c as (select domain, count(*) as n from (select * from recurring intersect select * from single) group by 1)
select coalesce(a.domain, b.domain) as domain, coalesce(a.n, 0) as method_a, coalesce(b.n, 0) as method_b, coalesce(c.n, 0) as in_both from a full join b on a.domain = b.domain left join c on a.domain = c.domain""",
}
