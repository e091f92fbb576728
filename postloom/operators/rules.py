"""Ordered rules that reject posts, each row with the first reason that holds.

A rule is a name, a predicate and a reason. One narrow pass works out every rule of a row and hashes of its text; what is written and shuffled
from there on has neither texts nor records. Removal of repeats depends on which rows survived the rules before it, so it runs in phases: the
first of each key by arrival, found by an aggregation with a partial step, goes on to the next phase. A text that is posted a billion times is a
billion rows of one key only before that partial step. The reasons are joined by the unique idx.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, functions as F

from ..functions.text import BEYOND_LATIN, iso_time, non_latin_share, number, strip, text_or_empty, words
from ..session import written

# Marks of removed texts, names of bots, patterns, subreddits and rooms.
REMOVED = ("[removed]", "[deleted]", "removed", "deleted", "[ removed by moderator ]", "[ removed by reddit ]", "[ deleted by user ]", "[ removed ]", "[ deleted ]")
BOTS = ("webhelperapp", "CSCQMods", "premod_suraweera", "AutomaticAd6646", "AutoModerator", "automoderator")
AUTOMOD = (
    r"\bi am a bot\b|\bthis is a bot\b|\bautomoderator\b|\bauto moderator\b|^hey everyone[!.]?\s+i'?m u/|^your (post|submission) has been (removed|locked)|^this subreddit requires|^please (read|review) the (rules|guidelines)"
    r"|^welcome to r/\w|^this (post|thread) (is|has been) (now |)locked|^submissions (to this subreddit )?must (be|include|have)|^flair your post|^moderators? of r/|this thread is posted \*\*every"
)
MILESTONE = (
    r"(just|recently)?(completed?|finished?|earned?|passed?|obtained?)\s.{0,40}(course|certification|certificate|credential|badge|bootcamp|program)|i('?m|am|have|'?ve)\s+(just\s+)?(joined|starting|accepted|begun)\s.{0,30}(as|at)\s"
    r"|(excited|thrilled|happy|delighted|honored)\s+to\s+(announce|share\s+that\s+i).{0,60}(joined|accepted|starting|newrole|newposition)|\d+[\-\s]?year[s]?\s+(at|with|anniversary)|work(ing)?\s+anniversary|(i('?ve|have)|just)\s+(been\s+)?(promoted|received\s+a\s+promotion)"
)
ENGAGEMENT = r"^(congratulations?|congrats|well done|great job|so proud|happy (birthday|work anniversary)|welcome (to|aboard)|thank you for|thanks for sharing|love this|great post|well deserved|amazing work|fantastic)"
CORPORATE_JOB = r"(we'?re? (hiring|looking for)|join our team|open (position|role|requisition)|job opening|now hiring|apply (now|today|here)|we have an opening)"
PERSONAL_JOB = r"\bi'?m (hiring|looking for)\b"
BLOCKED_SUBREDDITS = tuple(
    """OriginTrail appsmith falkordb DiscoLearning Infinilearn AIProductivityLab HeadlesseCommerce GraphRAG u_prodigy_ai u_elearningmania u_magicedtech2 u_Essay-Coach u_BattleFirstAid u_AI-Admissions u_pianofireman88
    udemyfreebies udemyfreebiesdaily SideProject sideprojects vibecoding istqbastqbatsqa EssayCoachingHub AI_College_Admissions NFA securityguards airsoft guns ar15 CCW gundealsFU USMC greenberets gun Firearms CZFirearms SmithAndWesson
    Glocks 1911 ammo SpringfieldArmory PrimaryWeaponsSystems QualityTacticalGear liberalgunowners CAguns FN509 austinguns blackpowder longrange BodyArmor TacticalMedicine MRE CompetitionShooting CBRNE NightVision gasmasks LessLethalOptions
    Shotguns nuclearweapons knivesandguns AiPornhubvideo SuicideWatch LinkedInLunatics 3Dprinting OculusQuest MetaQuestVR androidapps androidtablets iosapps drones""".split()
)
ROOMS = tuple(
    """513b7ba2-e650-44bf-ab0a-f32c1db89e0e da5e58d1-70fa-42f8-b8d4-7307a41be679 31a3dd4c-98ff-4d5d-a26a-5ca631efa334 7c329506-1cb0-4ce6-b7c1-db7c0ec32038 b16d6e7d-ff11-43cd-8cca-61bc6fc6053e 784977cd-1298-4063-88fe-8d0af52e2f6b
    bd2e06ef-b1c8-4571-9077-629e22ab972a 49c15c0e-2a2a-4058-80b7-d5e8c01d519f 6fd3a353-43ff-49ad-a669-4b6f5e9a7c18 1828f6b0-1a45-4d7d-98b4-8a58ba8e7f9d 9dbf7905-f2d8-4ccc-8f87-e98701287ae1 cc0b0f6e-00f6-45b9-850a-1712e5b884f7
    5ba1e8d2-98f2-4051-a664-250277ccdfcd 9d9464a8-abc7-44ea-bf85-c43d699eceed be54487a-66ec-49fc-bdd8-91ecea633963 88fc6389-d354-4c56-97a0-de93b49d666e ffa83140-b830-469c-8a1e-78ec4958e828 7a94cc8a-81dc-4eff-b5fe-ca4e5fd3257d
    67464ce5-94eb-45ed-8734-2d779b6d37d2 56b94d07-134a-4096-9fbb-6a4ebead5527 f6f35805-1c62-4971-b991-9a17f7fac0ac 239bf92b-8e2d-4f5b-b90b-3ac8d3063187 a00c708a-1310-4fb8-9cc1-8c9370bd639b 1c82d6d5-b94b-436d-9c8e-ac18f2e3de57
    a18ef28e-a33a-4be7-af84-fd10f8de075b b90814ed-3aec-4dcd-a6d3-25c956add11f 2900f94b-2013-4d9f-bead-4a5cd3f01717 3bd77eca-d93a-434d-9a7a-751a03c52db4""".split()
)

MIN_LENGTH, NON_LATIN, PREFIX, MIN_PREFIX, LINK_TITLE, SHORT_ENGAGEMENT = 30, 0.4, 100, 50, 40, 300


@dataclass(frozen=True)
class Rule:
    name: str
    holds: Column
    detail: Column | None = None  #: data that the reason ends in, after a colon

    def reason(self) -> Column:
        text = F.lit(self.name) if self.detail is None else F.concat(F.lit(f"{self.name}:"), self.detail)
        return F.when(F.coalesce(self.holds, F.lit(False)), text)


def in_scope(df: DataFrame, rooms: tuple[str, ...] | None = ROOMS, least_score: float = 0.5, cutoff: str = "2024-01-01 00:00:00") -> DataFrame:
    """With scope_reason, null for rows in scope: room, empty text, low score (LinkedIn only), before the cutoff. Scores and dates that can't
    be read keep a row. rooms=None takes all rooms."""
    rules = [
        *([Rule("room", ~F.coalesce(strip("audience_room_id").isin(*rooms), F.lit(False)))] if rooms is not None else []),
        Rule("empty", F.length(strip(text_or_empty("post_text"))) == 0),
        Rule("low_score", (F.lower(strip(text_or_empty("platform"))) == "linkedin") & (number(text_or_empty("label_useful")) < least_score)),
        Rule("old", iso_time(text_or_empty("post_date")) < F.lit(cutoff).cast("timestamp")),
    ]
    return df.withColumn("scope_reason", F.coalesce(*(r.reason() for r in rules)))


def _json_text(record: Column, *paths: str) -> Column:
    """The first non-empty text at the paths of a parsed record."""
    found = [F.try_variant_get(record, p, "string") for p in paths]
    return F.coalesce(*(F.when(x != "", x) for x in found))


def _read(df: DataFrame) -> DataFrame:
    """The rows with _text, _removed, _low and what the rules look at."""
    first = df.select(
        "*", strip(text_or_empty("post_text")).alias("_text0"), F.lower(strip(text_or_empty("platform"))).alias("_platform"),
        strip(text_or_empty("profile_id")).alias("_profile"), strip(text_or_empty("author_name")).alias("_author"), strip(text_or_empty("subreddit")).alias("_sub"),
    )
    # a record is parsed once, and only where its title or author type is asked for
    gone = F.lower("_text0").isin(*REMOVED)
    parsed = first.withColumn("_gone", gone).withColumn("_record", F.when(F.col("_gone") | (F.col("_platform") == "linkedin"), F.try_parse_json("raw_post_json")))
    record = F.col("_record")
    read = parsed.select(
        *(c for c in parsed.columns if c != "_record"), strip(_json_text(record, "$.title", "$.post_details.title")).alias("_title"),
        F.lower(strip(F.coalesce(_json_text(record, "$.authorType", "$.author_type", "$.observationType"), F.try_variant_get(record, "$.author.type", "string"), F.lit("")))).alias("_author_type"),
    )
    salvaged = F.when(F.col("_gone") & ~F.lower("_title").isin("[removed]", "[deleted]", ""), F.col("_title"))
    base = read.withColumns({"_text": F.coalesce(salvaged, "_text0"), "_removed": F.col("_gone") & salvaged.isNull()})
    # the patterns are in lower case and match the lower-cased text, which is far cheaper than folding case at each place
    return base.withColumn("_low", F.lower("_text"))


def _phases() -> list[list[Rule]]:
    """The rules before the repeats within a profile, after them, and after all repeats."""
    t, low, linkedin = F.col("_text"), F.col("_low"), F.col("_platform") == "linkedin"
    no_urls = F.regexp_replace(t, r"(?i)https?://\S+", "")
    return [
        [
            Rule("removed", F.col("_removed")), Rule("bot_account", F.col("_author").isin(*BOTS), F.col("_author")), Rule("automod_text", low.rlike(AUTOMOD)), Rule("url_only", t.rlike(r"^https?://\S+$")),
            Rule("too_short", F.length(t) < MIN_LENGTH, F.length(t).cast("string")), Rule("non_english", t.rlike(BEYOND_LATIN) & (F.size(words(t)) >= 5) & (non_latin_share(t) > NON_LATIN)),
        ],
        [Rule("personal_milestone", linkedin & low.rlike(MILESTONE)), Rule("company_author", linkedin & ~F.col("_author_type").isin("", "person", "individual"), F.col("_author_type"))],
        [
            Rule("link_title", low.rlike(r"https?://\S+") & (F.length(strip(no_urls)) < LINK_TITLE)), Rule("engagement", low.rlike(ENGAGEMENT) & (F.length(t) < SHORT_ENGAGEMENT)),
            Rule("corporate_job", F.substring(low, 1, 200).rlike(CORPORATE_JOB) & ~F.substring(low, 1, 100).rlike(PERSONAL_JOB)), Rule("blocked_subreddit", (F.col("_platform") == "reddit") & F.col("_sub").isin(*BLOCKED_SUBREDDITS), F.col("_sub")),
        ],
    ]


def hashed(c: Column, name: str) -> list[Column]:
    """A text as two whole numbers of 64 bits."""
    return [F.xxhash64(c, F.lit(k)).alias(f"{name}{k}") for k in (1, 2)]


def firsts(rows: DataFrame, keys: list[str], carried: tuple[str, ...] = ()) -> DataFrame:
    """Of each key the row of the smallest idx, with the columns carried, which are of fixed width so that the aggregation hashes."""
    return rows.groupBy(*keys).agg(F.min("idx").alias("idx"), *(F.min_by(c, "idx").alias(c) for c in carried))


def drop_reasons(df: DataFrame) -> DataFrame:
    """idx, drop_reason (null for rows kept).

    Needs idx (arrival order, unique), post_text, platform, profile_id, author_name, subreddit, raw_post_json, all text but idx. Nulls count
    as empty texts. Repeats are told by idx; a blank profile is one profile.
    """
    before, between, after = _phases()
    prefix = strip(F.lower(F.substring("_text", 1, PREFIX)))
    long = F.length(prefix) >= MIN_PREFIX
    lean = _read(df).select(
        "idx", *hashed(F.col("_profile"), "p"), *hashed(F.col("_text"), "t"), *(F.when(long, h).alias(f"x{k}") for k, h in zip((1, 2), hashed(prefix, "x"))),
        *(F.coalesce(*(r.reason() for r in rules)).alias(name) for name, rules in (("before", before), ("between", between), ("after", after))),
    )
    lean = written(lean.withColumn("ok", F.col("between").isNull()))
    one = firsts(lean.where("before is null"), ["p1", "p2", "t1", "t2"], ("x1", "x2", "ok"))
    two = firsts(one.where("ok"), ["t1", "t2"], ("x1", "x2"))
    three = firsts(two.where("x1 is not null"), ["x1", "x2"]).select("idx").unionByName(two.where("x1 is null").select("idx"))
    stages = one.select("idx", F.lit(1).alias("stage")).unionByName(two.select("idx", F.lit(2).alias("stage"))).unionByName(three.select("idx", F.lit(3).alias("stage")))
    reached = stages.groupBy("idx").agg(F.max("stage").alias("stage"))
    j = lean.select("idx", "before", "between", "after").join(reached, "idx", "left")
    return j.select("idx", F.coalesce("before", F.when(F.col("stage").isNull(), "duplicate_within_profile"), "between", F.when(F.col("stage") < 2, "duplicate_across_profiles"), F.when(F.col("stage") < 3, "near_duplicate"), "after").alias("drop_reason"))


def clean(df: DataFrame) -> DataFrame:
    """The rows with _text (removed bodies replaced by the title where there is one) and drop_reason, as drop_reasons() has it. Queries that need
    reasons alone are better off with those: here the rows are shuffled once, by idx."""
    read = _read(df).drop("_removed", "_author_type", "_platform", "_profile", "_author", "_sub", "_text0", "_title", "_gone", "_low")
    return read.join(drop_reasons(df), "idx")


def reason_counts(cleaned: DataFrame) -> DataFrame:
    """reason (kept, or the rule), rows, share in percent."""
    name = F.coalesce(F.split("drop_reason", ":")[0], F.lit("kept"))
    counts = cleaned.groupBy(name.alias("reason")).agg(F.count("*").alias("rows"))
    total = counts.agg(F.sum("rows").alias("total"))
    return counts.crossJoin(F.broadcast(total)).select("reason", "rows", F.bround(100.0 * F.col("rows") / F.col("total"), 1).alias("pct"))  # one row of totals
