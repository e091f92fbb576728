"""Queries over merge tables, labelling, and the outputs described only in words."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from ..functions.text import strip
from ..operators import documented as D, labeling as B, merges as M
from ..operators.cells import eligible, matrix
from ..session import table
from .cells import _eligible
from .topics import _L, label_frequency, self_map_repair

KEYS = ("topic_domain", "raw_label_or_group", "proposed_canonical")


def _matches(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "anchor_pattern_review")


def anchor_signature(spark: SparkSession, d: str) -> DataFrame:
    return M.signatures(_matches(spark, d)).select(*KEYS, "signature")


def duplicate_merges(spark: SparkSession, d: str) -> DataFrame:
    return M.repeats(_matches(spark, d), KEYS)


def verdict_counts(spark: SparkSession, d: str) -> DataFrame:
    return _matches(spark, d).groupBy("topic_domain", M.decision(F.col("human_decision")).alias("verdict")).agg(F.count("*").alias("rows"))


def suspicion_flags(spark: SparkSession, d: str) -> DataFrame:
    return M.suspicions(_matches(spark, d))


def known_case_check(spark: SparkSession, d: str) -> DataFrame:
    """Cases of the data: a word of labels and the verdict expected."""
    return M.known_cases(_matches(spark, d), (("governance", "APPLY"), ("pricing", "APPLY"), ("culture metrics", "REJECT"), ("no such label", "APPLY")))


def merge_proposals(spark: SparkSession, d: str) -> DataFrame:
    return M.proposals(label_frequency(spark, d), self_map_repair(spark, d))


def evaluation_sample(spark: SparkSession, d: str) -> DataFrame:
    return M.stratified_sample(_matches(spark, d)).groupBy("topic_domain", "kind", "band").agg(F.count("*").alias("rows"))


def verdict_agreement(spark: SparkSession, d: str) -> DataFrame:
    """People's decisions against the rule that a risk word means a rejection."""
    rows = _matches(spark, d).select(F.when(M.decision(F.col("human_decision")) == "APPLY", "yes").otherwise("no").alias("person"), F.when(F.size(M.risk_words(F.col("raw_label_or_group"), F.col("proposed_canonical"))) == 0, "yes").otherwise("no").alias("rule"))
    return M.agreement(rows, "person", "rule")


KEYWORDS = {"model": "AI", "database": "Software Engineering", "salary": "Career", "quizzes": "EdTech", "credential": "Security", "warehouse": "Data & Analytics", "maintainer": "Open Source", "pricing": "Business & Strategy", "meeting": "Leadership & Management"}


#: The reference's prompt has this many characters of a post, and so has the SQL of label_posts.
PROMPT_CHARS = 800


def label_posts(spark: SparkSession, d: str) -> DataFrame:
    return B.label(table(spark, d, "posts_clean_v2"), B.rule_model(KEYWORDS), pause=0.0, max_chars=PROMPT_CHARS).select("idx", "topic_broad", "sentiment", "stance", "post_type", "status")


def label_posts_whole(spark: SparkSession, d: str) -> DataFrame:
    """As label_posts, of whole texts."""
    return B.label(table(spark, d, "posts_clean_v2"), B.rule_model(KEYWORDS), pause=0.0).select("idx", "topic_broad", "sentiment", "stance", "post_type", "status")


def label_batches(spark: SparkSession, d: str) -> DataFrame:
    return B.batches(table(spark, d, "posts_clean_v2")).groupBy("batch").agg(F.count("*").alias("posts"))


def resume_labels_tagged(spark: SparkSession, d: str) -> DataFrame:
    """The posts left when those with a topic in the tagged table are done; UNCLASSIFIED marks failures, which are tried again."""
    topic = F.lower(strip(F.col("topic")))
    done = table(spark, d, "tagged_posts_v2_clean").select("idx", F.when(~F.coalesce(topic, F.lit("")).isin("", "unclassified"), "ok").otherwise("failed").alias("status"))
    return B.label(table(spark, d, "posts_clean_v2"), B.rule_model(KEYWORDS), done, pause=0.0).select("idx", "status")


def merged_labels_all(spark: SparkSession, d: str) -> DataFrame:
    """Posts with the labels of all of them, of whole texts."""
    posts = table(spark, d, "posts_clean_v2").select("idx", "platform", "post_text")
    return B.merge_labels(posts, B.label(posts, B.rule_model(KEYWORDS), pause=0.0)).select("idx", "platform", "topic_broad", "status")


def batch_mapping(spark: SparkSession, d: str) -> DataFrame:
    freq = label_frequency(spark, d)
    answers = freq.where("posts >= 2").select("domain", F.upper("label").alias("raw"), F.regexp_replace("label", "^[a-z]+ ", "").alias("canonical"))
    return B.map_batch(freq.select("domain", "label"), answers)


def top_percent_coverage(spark: SparkSession, d: str) -> DataFrame:
    return D.top_percent_coverage(label_frequency(spark, d))


def master_numbers(spark: SparkSession, d: str) -> DataFrame:
    tagged = table(spark, d, "tagged_posts_v2_clean")
    return D.master_numbers(tagged, label_frequency(spark, d), matrix(eligible(tagged)))


def length_distance(spark: SparkSession, d: str) -> DataFrame:
    """How far the lengths of posts on the two platforms are apart, per audience."""
    return D.wasserstein(eligible(table(spark, d, "tagged_posts_v2_clean")), ["audience"], "side", "chars")


QUERIES = {
    f.__name__: f
    for f in (
        anchor_signature, duplicate_merges, verdict_counts, suspicion_flags, known_case_check, merge_proposals, evaluation_sample, verdict_agreement, label_posts, label_posts_whole, resume_labels_tagged, label_batches, merged_labels_all, batch_mapping, top_percent_coverage, master_numbers, length_distance,
    )
}

_V = "case when trim(coalesce(human_decision, '')) = '' then 'NO_VERDICT' else upper(trim(human_decision)) end"
_RISK = "list_filter([" + ", ".join(f"'{w}'" for w in M.RISK_WORDS) + "], lambda w: contains(lower(coalesce(raw_label_or_group, '')), w) and not contains(lower(coalesce(proposed_canonical, '')), w))"
_DOMAIN = "case " + " ".join(f"when contains(t, '{w}') then '{x}'" for w, x in KEYWORDS.items()) + " else 'Other' end"

SQL = {
    "anchor_signature": f"select topic_domain, raw_label_or_group, proposed_canonical, array_to_string({_RISK}, ', ') as signature from anchor_pattern_review where len({_RISK}) > 0",
    "duplicate_merges": """
select topic_domain, raw_label_or_group, proposed_canonical, count(*) as rows, count(distinct (coalesce(score_or_na, ''), coalesce(risk_words, ''), coalesce(llm_reason, ''), coalesce(human_decision, ''))) as distinct_rows,
       count(*) - count(distinct (coalesce(score_or_na, ''), coalesce(risk_words, ''), coalesce(llm_reason, ''), coalesce(human_decision, ''))) as redundant,
       case when count(distinct (coalesce(score_or_na, ''), coalesce(risk_words, ''), coalesce(llm_reason, ''), coalesce(human_decision, ''))) = 1 then 'exact' else 'conflicting' end as kind
from anchor_pattern_review group by 1, 2, 3 having count(*) > 1""",
    "verdict_counts": f"select topic_domain, {_V} as verdict, count(*) as rows from anchor_pattern_review group by 1, 2",
    "suspicion_flags": f"""
select count(*) filter ({_V} <> 'NO_VERDICT' and trim(coalesce(llm_reason, '')) = '') as no_reason, count(*) filter (contains(llm_reason, 'AUDIT_FAILED')) as audit_failed, count(*) filter ({_V} = 'APPLY' and try_cast(trim(score_or_na) as double) < 0.55) as applied_below,
       count(*) filter (lower(trim(coalesce(proposed_canonical, ''))) in ('', 'n/a')) as no_partner, count(*) filter (contains(raw_label_or_group, '|')) as groups from anchor_pattern_review""",
    "known_case_check": f"""
with cases(part, expected) as (values ('governance', 'APPLY'), ('pricing', 'APPLY'), ('culture metrics', 'REJECT'), ('no such label', 'APPLY'))
select part, expected, count(raw_label_or_group) as found, count(*) filter (raw_label_or_group is not null and (starts_with({_V}, expected) or contains(expected, {_V}))) as agreeing
from cases left join anchor_pattern_review on contains(lower(coalesce(raw_label_or_group, '')), part) group by 1, 2""",
    "evaluation_sample": """
with s as (select distinct *, try_cast(trim(score_or_na) as double) as score from anchor_pattern_review)
select topic_domain, case when contains(raw_label_or_group, '|') then 'group' else 'pair' end as kind, case when score is null then 'none' when score < 0.6 then 'low' when score < 0.7 then 'middle' else 'high' end as band, least(count(*), 30) as rows from s group by 1, 2, 3""",
    "verdict_agreement": f"""
with r as (select {_V} = 'APPLY' as a, len({_RISK}) = 0 as b from anchor_pattern_review), s as (select count(*) as items, count(*) filter (a = b) as agreed, avg(a::int) as pa, avg(b::int) as pb from r)
select items, agreed, (agreed / items - (pa * pb + (1 - pa) * (1 - pb))) / (1 - (pa * pb + (1 - pa) * (1 - pb))) as kappa from s""",
    "label_posts": f"""
with p as (select idx, lower(coalesce(post_text, ''))[1:800] as t from posts_clean_v2)
select idx, {_DOMAIN} as topic_broad, case when contains(t, 'bad ') or contains(t, 'overrated') or contains(t, 'fragile') then 'negative' when contains(t, 'better') or contains(t, 'good ') or contains(t, 'well ') then 'positive' else 'neutral' end as sentiment,
       case when contains(t, '?') then 'questioning' else 'assertive' end as stance, case when regexp_matches(t, '\\?[\\s\\p{{Z}}]*$') then 'question' else 'opinion' end as post_type, 'ok' as status from p""",
    "batch_mapping": _L + "select domain, label, case when posts >= 2 then regexp_replace(label, '^[a-z]+ ', '') else label end as canonical, case when posts >= 2 then 'answered' else 'self' end as status from freq",
    "top_percent_coverage": _L
    + """, r as (select *, row_number() over (partition by domain order by posts desc, label) as r, count(*) over (partition by domain) as n, sum(posts) over (partition by domain) as total from freq)
select domain, cast(pct as int) as pct, count(*) as labels, 100.0 * sum(posts) / max(total) as posts_pct from r, (values (1), (5), (10), (20), (50)) v(pct) where r <= ceil(n * pct / 100.0) group by 1, 2""",
    "master_numbers": _eligible()
    + ", "
    + _L.replace("\nwith labelled", "labelled")
    + """select 'posts' as name, count(*) as value from tagged_posts_v2_clean union all select 'labels', count(*) from freq union all select 'single_labels', count(*) from freq where posts = 1
union all select 'cells', count(*) from counts union all select 'bilateral', count(*) from both_sided""",
    "length_distance": _eligible()
    + """, v as (select audience, chars, count(*) filter (side = 'li') as li, count(*) filter (side = 'rd') as rd from posts group by 1, 2),
s as (select audience, chars, sum(li) over w / sum(li) over (partition by audience) as a, sum(rd) over w / sum(rd) over (partition by audience) as b, lead(chars) over (partition by audience order by chars) - chars as width,
        sum(li) over (partition by audience) as n_li, sum(rd) over (partition by audience) as n_rd from v window w as (partition by audience order by chars))
select audience, sum(abs(a - b) * coalesce(width, 0)) as distance from s where n_li > 0 and n_rd > 0 group by 1""",
}

SQL["label_posts_whole"] = SQL["label_posts"].replace("[1:800]", "")
SQL["resume_labels_tagged"] = """
with done as (select idx from tagged_posts_v2_clean where lower(trim(coalesce(topic, ''))) not in ('', 'unclassified'))
select idx, 'ok' as status from posts_clean_v2 where idx not in (select idx from done where idx is not null)"""
SQL["merged_labels_all"] = f"""
with p as (select idx, platform, lower(coalesce(post_text, '')) as t from posts_clean_v2)
select idx, platform, {_DOMAIN} as topic_broad, 'ok' as status from p"""
