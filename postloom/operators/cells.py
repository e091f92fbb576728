"""The matrix of audience and group with counts, authors, shares and top strings per platform."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, Window, functions as F

from ..functions.text import one_decimal, strip, text_or_empty
from .labels import TRANSFER_TYPES

#: Names of rooms by which platforms pair up. Fixed values.
AUDIENCES = {
    "Backend Engineer (linkedin+reddit)": "Backend Engineer", "CTOs": "CTO", "CTO Reddit": "CTO", "Engineering Manager": "Engineering Manager", "Engineering Manager reddit": "Engineering Manager", "Staff Engineer": "Staff Engineer", "VP Engineering": "VP Engineering", "Devops/Infra Engineer": "DevOps Infra Engineer",
    "Fullstack Engineers": "Fullstack Engineer", "Full Stack Developer Reddit": "Fullstack Engineer", "Frontend Engineer Reddit": "Frontend Engineer", "Engineering Leadership Audience Room": "Engineering Leadership", "Engineering Org in Edtech Co": "Engineering Org Edtech", "Programming reddit": "Software Engineer General",
    "QA Engineer Reddit": "QA Engineer", "Product Leadership Audience Room": "Product Leadership", "Director/ VP engineering/ CTO in Edtech Co": "Director VP Engineering", "[LinkedIn] OpenAI Community": "OpenAI Community", "[Reddit] OpenAI Community": "OpenAI Community", "Knowledge Graph Devs": "Knowledge Graph",
    "Edtech Developers": "EdTech Developer", "Instructional Designer": "Instructional Designer", "First Responders": "First Responders", "Product Manager Reddit": "Product Manager",
}


@dataclass(frozen=True)
class CellConfig:
    group_field: str = "topic"
    transfer_types: tuple[str, ...] = TRANSFER_TYPES
    audiences: dict[str, str] = field(default_factory=lambda: AUDIENCES)
    min_pair: int = 10
    top_narrow: int = 3
    top_subtopics: int = 5


def audience(c: Column, names: dict[str, str]) -> Column:
    """The audience of a room: its name in the map, which is bounded by its rows in the configuration, else its own."""
    name = strip(text_or_empty(c))
    return F.coalesce(F.create_map(*(F.lit(x) for kv in names.items() for x in kv))[name], name) if names else name


def eligible(df: DataFrame, config: CellConfig = CellConfig()) -> DataFrame:
    """Transfer-eligible posts of the two platforms: idx, audience, group_label, side (li or rd), profile_id, narrow, subtopics, sentiment, stance."""
    topic, group = strip(text_or_empty("topic")), strip(text_or_empty(config.group_field))
    platform = F.lower(text_or_empty("platform"))
    narrow = strip(text_or_empty("topic_narrow"))
    kept = df.where((topic != "") & (topic != "UNCLASSIFIED") & strip(text_or_empty("post_type")).isin(*config.transfer_types) & (group != "") & platform.isin("linkedin", "reddit"))
    return kept.select(
        "idx", audience(F.col("audience_room_name"), config.audiences).alias("audience"), group.alias("group_label"), F.when(platform == "linkedin", "li").otherwise("rd").alias("side"), strip(text_or_empty("profile_id")).alias("profile_id"),
        F.when((narrow != "") & (narrow != topic), narrow).alias("narrow"), F.from_json("opinion_subtopics", "array<string>").alias("subtopics"), text_or_empty("sentiment").alias("sentiment"), text_or_empty("stance").alias("stance"),
        F.length(text_or_empty("post_text")).alias("chars"), text_or_empty("post_type").alias("post_type"),
    )


def top_strings(values: DataFrame, keys: list[str], value: str, k: int, out: str) -> DataFrame:
    """keys, out: the k most frequent values joined by " | ", ties by first arrival. The ranks are cut to k before they are collected, with a
    partial step below the shuffle."""
    counts = values.where(F.col(value).isNotNull() & (strip(F.col(value)) != "")).groupBy(*keys, value).agg(F.count("*").alias("n"), F.min("idx").alias("first"))
    rank = F.row_number().over(Window.partitionBy(*keys).orderBy(F.desc("n"), "first", value))
    top = counts.withColumn("r", rank).where(F.col("r") <= k)
    return top.groupBy(*keys).agg(F.array_join(F.transform(F.sort_array(F.collect_list(F.struct("r", F.col(value).alias("v")))), lambda x: x["v"]), " | ").alias(out))


def matrix(posts: DataFrame, config: CellConfig = CellConfig()) -> DataFrame:
    """One row for each cell of eligible(): posts, authors (a blank id is one author), the top author's share, top strings of each platform."""
    cell = ["audience", "group_label"]
    by_author = posts.groupBy(*cell, "side", "profile_id").agg(F.count("*").alias("n"))
    side = lambda s, f, c: f(F.when(F.col("side") == s, F.col(c)))
    # posts, authors and the top author come from one aggregation by author, then one by cell
    counts = by_author.groupBy(*cell).agg(
        *(F.coalesce(side(s, F.sum, "n"), F.lit(0)).alias(f"{s}_posts") for s in ("li", "rd")), *(side(s, F.count, "profile_id").alias(f"{s}_authors") for s in ("li", "rd")), *(F.coalesce(side(s, F.max, "n"), F.lit(0)).alias(f"{s}_top") for s in ("li", "rd"))
    )
    narrow = top_strings(posts, [*cell, "side"], "narrow", config.top_narrow, "narrow")
    subtopics = top_strings(posts.select("idx", *cell, "side", F.explode("subtopics").alias("subtopic")), [*cell, "side"], "subtopic", config.top_subtopics, "subtopics")
    tops = narrow.unionByName(subtopics, allowMissingColumns=True).groupBy(*cell).agg(
        *(side(s, F.max, c).alias(f"{s}_top_{c}") for c in ("narrow", "subtopics") for s in ("li", "rd"))
    )
    out = counts.join(tops, cell, "left")
    share = lambda s: one_decimal(100.0 * F.col(f"{s}_top") / F.greatest(F.col(f"{s}_posts"), F.lit(1)))
    return out.select(
        *cell, F.col("li_posts").alias("linkedin_posts"), F.col("rd_posts").alias("reddit_posts"), (F.col("li_posts") + F.col("rd_posts")).alias("total_posts"), F.col("li_authors").alias("li_unique_authors"), F.col("rd_authors").alias("rd_unique_authors"),
        share("li").alias("li_top_author_pct"), share("rd").alias("rd_top_author_pct"), *(text_or_empty(f"{s}_top_{c}").alias(f"{s}_top_{c}") for c in ("narrow", "subtopics") for s in ("li", "rd")),
    )


def viability(cells: DataFrame, thresholds: tuple[int, ...] = (10, 30)) -> DataFrame:
    """One row: cells, both-sided, one-sided, and those with at least each threshold on both sides."""
    both = (F.col("linkedin_posts") > 0) & (F.col("reddit_posts") > 0)
    at = lambda t: (F.col("linkedin_posts") >= t) & (F.col("reddit_posts") >= t)
    return cells.agg(F.count("*").alias("cells"), F.count_if(both).alias("bilateral"), F.count_if((F.col("linkedin_posts") > 0) & ~both).alias("linkedin_only"), F.count_if((F.col("reddit_posts") > 0) & ~both).alias("reddit_only"), *(F.count_if(at(t)).alias(f"viable_{t}") for t in thresholds))


def coverage(cells: DataFrame) -> DataFrame:
    """Of each audience: posts of both platforms, both-sided cells, whether it has one side only."""
    both = (F.col("linkedin_posts") > 0) & (F.col("reddit_posts") > 0)
    g = cells.groupBy("audience").agg(F.sum("linkedin_posts").alias("linkedin_posts"), F.sum("reddit_posts").alias("reddit_posts"), F.count_if(both).alias("bilateral_cells"))
    return g.withColumn("one_sided", (F.col("linkedin_posts") == 0) | (F.col("reddit_posts") == 0))


def top_groups(cells: DataFrame, k: int = 20) -> DataFrame:
    """The k largest groups of each audience with the share of its posts that they cover up to there."""
    w = Window.partitionBy("audience").orderBy(F.desc("total_posts"), "group_label")
    sums = cells.groupBy(F.col("audience").alias("of")).agg(F.sum("total_posts").alias("all_posts"))
    ranked = cells.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= k)
    upto = F.sum("total_posts").over(Window.partitionBy("audience").orderBy("rank").rowsBetween(Window.unboundedPreceding, 0))
    j = ranked.join(sums, F.col("audience") == F.col("of"))
    return j.select("audience", F.col("rank").cast("bigint").alias("rank"), "group_label", "linkedin_posts", "reddit_posts", one_decimal(100.0 * upto / F.col("all_posts")).alias("covered_pct"))


def statistics(posts: DataFrame) -> DataFrame:
    """Of each both-sided cell: posts and mean length per side, clears_10_per_side, severely_imbalanced (at least 42 posts, fewer than 10 of
    them on the smaller side; this rule is our own, as none is stated)."""
    g = posts.groupBy("audience", "group_label").agg(
        *(F.count_if(F.col("side") == s).alias(f"{s}_posts") for s in ("li", "rd")), *(F.avg(F.when(F.col("side") == s, F.col("chars"))).alias(f"{s}_mean_chars") for s in ("li", "rd")), *(F.count_if(F.col("sentiment") == x).alias(x) for x in ("positive", "negative", "neutral", "mixed"))
    )
    less = F.least("li_posts", "rd_posts")
    return g.where(less > 0).withColumns({"clears_10_per_side": less >= 10, "severely_imbalanced": (F.col("li_posts") + F.col("rd_posts") >= 42) & (less < 10)})


SHARED = ("sentiment", "post_type", "stance")


def shares(posts: DataFrame, columns: tuple[str, ...] = SHARED) -> DataFrame:
    """audience, group_label, side (li, rd or all), column_name, value, posts, pct: how the posts of each both-sided cell and side are spread over
    the values of some columns."""
    rows = posts.select("audience", "group_label", "side", F.explode(F.array(*(F.struct(F.lit(c).alias("column_name"), text_or_empty(c).alias("value")) for c in columns))).alias("x"))
    one = rows.groupBy("audience", "group_label", "side", "x.column_name", "x.value").agg(F.count("*").alias("posts"))
    both = one.select("audience", "group_label", F.explode(F.array("side", F.lit("all"))).alias("side"), "column_name", "value", "posts").groupBy("audience", "group_label", "side", "column_name", "value").agg(F.sum("posts").alias("posts"))
    keys = ["audience", "group_label", "side", "column_name"]
    sums = both.groupBy(*keys).agg(F.sum("posts").alias("total"))
    cells = one.groupBy("audience", "group_label").agg(F.countDistinct("side").alias("sides")).where("sides = 2").select("audience", "group_label")
    return both.join(cells, ["audience", "group_label"], "left_semi").join(sums, keys).select(*keys, "value", "posts", one_decimal(100.0 * F.col("posts") / F.col("total")).alias("pct"))


def simulated_viability(posts: DataFrame, classes: DataFrame, enough: int = 30, near: int = 10) -> DataFrame:
    """audience, domain, li_posts, rd_posts, viable, near_viable, shown: of each audience and domain the posts (domain, label, audience, side), and how
    many labels have enough posts on both sides, or nearly so, when synonyms are collapsed and noise is dropped by classes (label_classes()).
    shown: enough posts on both sides for the count to say something."""
    counts = posts.groupBy("audience", "domain", "label").agg(*(F.count_if(F.col("side") == s).alias(s) for s in ("li", "rd")))
    j = counts.join(classes, ["domain", "label"], "left")
    noise = F.coalesce(F.col("class"), F.lit("")) == "noise"
    merged = j.groupBy("audience", "domain", F.when(~noise, F.coalesce("match", "label")).alias("label")).agg(*(F.sum(s).alias(s) for s in ("li", "rd")))
    ok = (F.col("li") >= enough) & (F.col("rd") >= enough) & F.col("label").isNotNull()
    almost = ((F.col("li") >= near) | (F.col("rd") >= near)) & ~ok & F.col("label").isNotNull()
    g = merged.groupBy("audience", "domain").agg(F.sum("li").alias("li_posts"), F.sum("rd").alias("rd_posts"), F.count_if(ok).alias("viable"), F.count_if(almost).alias("near_viable"))
    skipped = (F.col("li_posts") < 30) | (F.col("rd_posts") < 10) | (F.col("li_posts") < 50) & (F.col("rd_posts") < 20)
    return g.withColumn("shown", ~skipped)
