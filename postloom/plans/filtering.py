"""Queries that filter posts and audit what is kept."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from ..functions.text import non_latin_share, strip, text_or_empty
from ..operators.rules import AUTOMOD, BLOCKED_SUBREDDITS, BOTS, CORPORATE_JOB, ENGAGEMENT, MILESTONE, PERSONAL_JOB, REMOVED, ROOMS, drop_reasons, firsts, hashed, in_scope, reason_counts
from ..session import table

COLUMNS = ("idx", "post_text", "platform", "profile_id", "author_name", "subreddit", "raw_post_json", "audience_room_id", "audience_room_name")


def reasons(spark: SparkSession, d: str) -> DataFrame:
    return drop_reasons(table(spark, d, "posts_filtered").select(*COLUMNS))


def reject_reason_counts(spark: SparkSession, d: str) -> DataFrame:
    return reason_counts(reasons(spark, d))


def rejected_posts(spark: SparkSession, d: str) -> DataFrame:
    return reasons(spark, d).where("drop_reason is not null")


def kept_posts_by_room(spark: SparkSession, d: str) -> DataFrame:
    rooms = table(spark, d, "posts_filtered").select("idx", "audience_room_name")
    return rooms.join(reasons(spark, d).where("drop_reason is null").select("idx"), "idx", "left_semi").groupBy("audience_room_name").agg(F.count("*").alias("posts"))


def scope_reasons(spark: SparkSession, d: str) -> DataFrame:
    posts = table(spark, d, "posts_filtered").select("idx", "audience_room_id", "platform", "label_useful", "post_date", "post_text")
    return in_scope(posts, rooms=None).groupBy(F.coalesce("scope_reason", F.lit("kept")).alias("reason")).agg(F.count("*").alias("posts"))


def scope_rooms(spark: SparkSession, d: str) -> DataFrame:
    """Posts in and out of the listed rooms."""
    posts = table(spark, d, "posts_filtered").select("audience_room_id", "platform", "label_useful", "post_date", "post_text")
    return in_scope(posts).groupBy((F.coalesce("scope_reason", F.lit("")) != "room").alias("listed")).agg(F.count("*").alias("posts"))


def _repeats(spark: SparkSession, d: str, keys: list[str], where: str = "text <> ''") -> DataFrame:
    """The posts whose key an earlier one has. Only ids and hashes are shuffled; what isn't a first is found by the unique idx."""
    posts = table(spark, d, "posts_filtered").select("idx", strip(text_or_empty("profile_id")).alias("profile"), strip(text_or_empty("post_text")).alias("text"))
    posts = posts.withColumn("prefix", strip(F.lower(F.substring("text", 1, 100)))).where(where)
    lean = posts.select("idx", *(h for k in keys for h in hashed(F.col(k), k)))
    return lean.select("idx").join(firsts(lean, [c for c in lean.columns if c != "idx"]).select("idx"), "idx", "left_anti")


def within_author_duplicates(spark: SparkSession, d: str) -> DataFrame:
    return _repeats(spark, d, ["profile", "text"])


def cross_author_duplicates(spark: SparkSession, d: str) -> DataFrame:
    return _repeats(spark, d, ["text"])


def prefix_near_duplicates(spark: SparkSession, d: str) -> DataFrame:
    return _repeats(spark, d, ["prefix"], "text <> '' and length(prefix) >= 50")


def non_latin_posts(spark: SparkSession, d: str) -> DataFrame:
    """Posts by the share of words beyond Latin, in tenths."""
    posts = table(spark, d, "posts_filtered").select(non_latin_share(text_or_empty("post_text")).alias("share"))
    return posts.where("share is not null").groupBy(F.floor(F.col("share") * 10).alias("tenth")).agg(F.count("*").alias("posts"))


def platform_room_audit(spark: SparkSession, d: str) -> DataFrame:
    """Posts, authors, and which platform is missing, of each room."""
    p = F.lower(strip(text_or_empty("platform")))
    g = table(spark, d, "posts_filtered").groupBy("audience_room_name").agg(F.count("*").alias("posts"), F.count_if(p == "linkedin").alias("linkedin"), F.count_if(p == "reddit").alias("reddit"), F.countDistinct("profile_id").alias("authors"))
    return g.withColumn("one_sided", (F.col("linkedin") == 0) | (F.col("reddit") == 0))


def profile_presence(spark: SparkSession, d: str) -> DataFrame:
    """Rows of each platform with and without a usable profile id."""
    p = F.lower(strip(text_or_empty("profile_id")))
    return table(spark, d, "posts_filtered").groupBy(F.lower(strip(text_or_empty("platform"))).alias("platform_name")).agg(F.count_if(p.isin("", "unknown")).alias("missing"), F.count_if(~p.isin("", "unknown")).alias("present"))


QUERIES = {
    f.__name__: f
    for f in (reject_reason_counts, rejected_posts, kept_posts_by_room, scope_reasons, scope_rooms, within_author_duplicates, cross_author_duplicates, prefix_near_duplicates, non_latin_posts, platform_room_audit, profile_presence)
}


def _s(x: str) -> str:
    return rf"regexp_replace({x}, '^[\s\p{{Z}}]+|[\s\p{{Z}}]+$', '', 'g')"


def _in(values) -> str:
    return "(" + ", ".join("'" + v.replace("'", "''") + "'" for v in values) + ")"


def _re(pattern: str) -> str:
    return "'(?i)" + pattern.replace("'", "''") + "'"


_CLEANED = rf"""
with a as (
  select *, {_s("coalesce(post_text, '')")} as text0, case when json_valid(raw_post_json) then cast(raw_post_json as json) end as j from posts_filtered
), b as (
  select *, {_s("coalesce(nullif(j ->> '$.title', ''), nullif(j ->> '$.post_details.title', ''))")} as title, lower(text0) in {_in(REMOVED)} as gone from a
), c as (
  select *, case when lower(title) not in ('[removed]', '[deleted]', '') then title end as salvaged from b
), p as (
  select idx, audience_room_name, case when gone then coalesce(salvaged, text0) else text0 end as t, gone and salvaged is null as gone0,
         lower({_s("coalesce(platform, '')")}) as platform0, {_s("coalesce(profile_id, '')")} as profile, {_s("coalesce(author_name, '')")} as author, {_s("coalesce(subreddit, '')")} as sub,
         lower({_s("coalesce(nullif(j ->> '$.authorType', ''), nullif(j ->> '$.author_type', ''), nullif(j ->> '$.observationType', ''), j ->> '$.author.type', '')")}) as kind from c
), w as (
  select *, list_filter(regexp_split_to_array(t, '[\s\p{{Z}}]+'), lambda x: x <> '') as ws, {_s("lower(t[1:100])")} as prefix from p
), p1 as (
  select *, case when gone0 then 'removed' when author in {_in(BOTS)} then 'bot_account:' || author when regexp_matches(t, {_re(AUTOMOD)}) then 'automod_text'
                 when regexp_matches(t, '^https?://\S+$') then 'url_only' when length(t) < 30 then 'too_short:' || length(t)
                 when len(ws) >= 5 and len(list_filter(ws, lambda x: regexp_matches(x, '[^\x{{0}}-\x{{24F}}\x{{1D400}}-\x{{1D7FF}}]'))) / len(ws) > 0.4 then 'non_english' end as r1 from w
), p2 as (
  select *, case when r1 is not null then r1 when row_number() over (partition by r1 is null, profile, md5(t) order by idx) > 1 then 'duplicate_within_profile'
                 when platform0 = 'linkedin' and regexp_matches(t, {_re(MILESTONE)}) then 'personal_milestone'
                 when platform0 = 'linkedin' and kind not in ('', 'person', 'individual') then 'company_author:' || kind end as r2 from p1
), p3 as (
  select *, case when r2 is not null then r2 when row_number() over (partition by r2 is null, md5(t) order by idx) > 1 then 'duplicate_across_profiles' end as r3 from p2
), cleaned as (
  select *, case when r3 is not null then r3 when length(prefix) >= 50 and row_number() over (partition by r3 is null, prefix order by idx) > 1 then 'near_duplicate'
                 when regexp_matches(t, '(?i)https?://\S+') and length({_s("regexp_replace(t, '(?i)https?://" + chr(92) + "S+', '', 'g')")}) < 40 then 'link_title'
                 when regexp_matches(t, {_re(ENGAGEMENT)}) and length(t) < 300 then 'engagement'
                 when regexp_matches(t[1:200], {_re(CORPORATE_JOB)}) and not regexp_matches(t[1:100], {_re(PERSONAL_JOB)}) then 'corporate_job'
                 when platform0 = 'reddit' and sub in {_in(BLOCKED_SUBREDDITS)} then 'blocked_subreddit:' || sub end as drop_reason from p3
)
"""

_REPEATS = rf"""
with posts as (select idx, {_s("coalesce(profile_id, '')")} as profile, {_s("coalesce(post_text, '')")} as text from posts_filtered),
named as (select *, {_s("lower(text[1:100])")} as prefix from posts where length(text) > 0)
"""

SQL = {
    "scope_rooms": f"select coalesce(trim(audience_room_id) in {_in(ROOMS)}, false) as listed, count(*) as posts from posts_filtered group by 1",
    "reject_reason_counts": _CLEANED
    + "select coalesce(split_part(drop_reason, ':', 1), 'kept') as reason, count(*) as rows, round_even(100.0 * count(*) / sum(count(*)) over (), 1) as pct from cleaned group by 1",
    "rejected_posts": _CLEANED + "select idx, drop_reason from cleaned where drop_reason is not null",
    "kept_posts_by_room": _CLEANED + "select audience_room_name, count(*) as posts from cleaned where drop_reason is null group by 1",
    "scope_reasons": rf"""
select case when length({_s("coalesce(post_text, '')")}) = 0 then 'empty'
            when lower({_s("coalesce(platform, '')")}) = 'linkedin' and not regexp_matches(lower(trim(label_useful)), '[fd]$') and try_cast(trim(label_useful) as double) < 0.5 and not isnan(try_cast(trim(label_useful) as double)) then 'low_score'
            when try_cast(post_date as timestamptz) < timestamptz '2024-01-01 00:00:00+00' then 'old' else 'kept' end as reason, count(*) as posts
from posts_filtered group by 1""",
    "within_author_duplicates": _REPEATS + "select idx from (select idx, row_number() over (partition by profile, md5(text) order by idx) as n from named) where n > 1",
    "cross_author_duplicates": _REPEATS + "select idx from (select idx, row_number() over (partition by md5(text) order by idx) as n from named) where n > 1",
    "prefix_near_duplicates": _REPEATS + "select idx from (select idx, row_number() over (partition by prefix order by idx) as n from named where length(prefix) >= 50) where n > 1",
    "non_latin_posts": r"""
with w as (select list_filter(regexp_split_to_array(post_text, '[\s\p{Z}]+'), lambda x: x <> '') as ws from posts_filtered where post_text is not null)
select cast(floor(10 * len(list_filter(ws, lambda x: regexp_matches(x, '[^\x{0}-\x{24F}\x{1D400}-\x{1D7FF}]'))) / len(ws)) as bigint) as tenth, count(*) as posts from w where len(ws) > 0 group by 1""",
    "platform_room_audit": """
select audience_room_name, count(*) as posts, count(*) filter (lower(trim(platform)) = 'linkedin') as linkedin, count(*) filter (lower(trim(platform)) = 'reddit') as reddit, count(distinct profile_id) as authors,
       count(*) filter (lower(trim(platform)) = 'linkedin') = 0 or count(*) filter (lower(trim(platform)) = 'reddit') = 0 as one_sided from posts_filtered group by 1""",
    "profile_presence": """
select lower(trim(coalesce(platform, ''))) as platform_name, count(*) filter (lower(trim(coalesce(profile_id, ''))) in ('', 'unknown')) as missing,
       count(*) filter (lower(trim(coalesce(profile_id, ''))) not in ('', 'unknown')) as present from posts_filtered group by 1""",
}
