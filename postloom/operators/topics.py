"""Topic labels: frequencies, the map from raw to canonical labels, coverage, and reports on recurring events."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from ..functions.text import one_decimal, strip, text_or_empty
from .labels import ACTIVE_DOMAINS, TRANSFER_TYPES


def labels_of(df: DataFrame) -> DataFrame:
    """The rows with domain (trimmed) and label (trimmed, lower-cased), both empty for null."""
    return df.withColumns({"domain": strip(text_or_empty("topic_broad")), "label": F.lower(strip(text_or_empty("topic")))})


def frequencies(df: DataFrame, with_unclassified: bool = False) -> DataFrame:
    """domain, label, posts of the labels that aren't blank."""
    kept = labels_of(df).where(F.col("label") != "") if with_unclassified else labels_of(df).where(~F.col("label").isin("", "unclassified"))
    return kept.groupBy("domain", "label").agg(F.count("*").alias("posts"))


def apply_map(df: DataFrame, topic_map: DataFrame) -> DataFrame:
    """The rows with topic replaced by its canonical label, topic_raw the label as looked up, and map_status: mapped, unchanged (also blank and
    unclassified labels) or unmapped. topic_map has domain, raw_label, canonical, one row for each pair of the first two; rows that aren't in it
    keep their topic. The map may be of any size: Spark broadcasts it when it is small, and else joins by shuffle."""
    rows = labels_of(df)
    m = topic_map.select(F.col("domain").alias("_domain"), F.col("raw_label").alias("_raw"), "canonical")
    j = rows.join(m, (F.col("domain") == F.col("_domain")) & (F.col("label") == F.col("_raw")) & ~F.col("label").isin("", "unclassified"), "left")
    status = F.when(F.col("label").isin("", "unclassified"), "unchanged").when(F.col("canonical").isNull(), "unmapped").when(F.col("canonical") == F.col("label"), "unchanged").otherwise("mapped")
    return j.withColumns({"topic_raw": F.col("label"), "map_status": status, "topic": F.when(status == "mapped", F.col("canonical")).otherwise(F.col("topic"))}).drop("_domain", "_raw", "canonical", "label")


def map_summary(mapped: DataFrame) -> DataFrame:
    """domain (null for the total), posts, mapped, unchanged, unmapped, mapped_pct."""
    g = mapped.rollup("domain").agg(F.count("*").alias("posts"), *(F.count_if(F.col("map_status") == s).alias(s) for s in ("mapped", "unchanged", "unmapped")))
    return g.withColumn("mapped_pct", one_decimal(100.0 * F.col("mapped") / F.greatest("posts", F.lit(1))))


def repair_self_map(topic_map: DataFrame) -> DataFrame:
    """The map with the artifact self-map replaced by the raw label."""
    return topic_map.withColumn("canonical", F.when(F.lower(strip("canonical")) == "self-map", F.col("raw_label")).otherwise(F.col("canonical")))


def mapping_faults(topic_map: DataFrame) -> DataFrame:
    """domain, raw_label, fault of the entries whose canonical label is empty, over 80 characters, not lower-case, or holds quotes or brackets."""
    c = text_or_empty("canonical")
    fault = F.when(strip(c) == "", "empty").when(F.length(c) > 80, "too_long").when(c != F.lower(c), "not_lower").when(c.rlike("[\"'{}\\[\\]]"), "bad_character")
    return topic_map.select("domain", "raw_label", fault.alias("fault")).where("fault is not null")


def canonical_frequencies(freq: DataFrame, topic_map: DataFrame) -> DataFrame:
    """domain, canonical, posts, raw_labels: labels outside the map stand for themselves; labels of the map without posts count 0."""
    j = topic_map.select("domain", F.col("raw_label").alias("label"), "canonical").join(freq, ["domain", "label"], "full_outer")
    return j.groupBy("domain", F.coalesce("canonical", "label").alias("canonical")).agg(F.sum(F.coalesce("posts", F.lit(0))).alias("posts"), F.count("*").alias("raw_labels"))


def normalisation_summary(canonicals: DataFrame) -> DataFrame:
    """domain, posts, canonicals, at_least_10, at_least_30, recurring_pct (posts under labels of at least two)."""
    g = canonicals.groupBy("domain").agg(F.sum("posts").alias("posts"), F.count("*").alias("canonicals"), F.count_if(F.col("posts") >= 10).alias("at_least_10"), F.count_if(F.col("posts") >= 30).alias("at_least_30"), F.sum(F.when(F.col("posts") >= 2, F.col("posts")).otherwise(0)).alias("recurring"))
    return g.select("domain", "posts", "canonicals", "at_least_10", "at_least_30", one_decimal(100.0 * F.col("recurring") / F.greatest("posts", F.lit(1))).alias("recurring_pct"))


def review(freq: DataFrame, topic_map: DataFrame, top: int = 5) -> DataFrame:
    """Each canonical label with posts, the number of raw labels, and the top raw labels by posts."""
    j = topic_map.select("domain", F.col("raw_label").alias("label"), "canonical").join(freq, ["domain", "label"], "left").withColumn("n", F.coalesce("posts", F.lit(0)))
    sums = j.groupBy("domain", "canonical").agg(F.sum("n").alias("posts"), F.count("*").alias("raw_labels"))
    ranked = j.withColumn("r", F.row_number().over(Window.partitionBy("domain", "canonical").orderBy(F.desc("n"), "label"))).where(F.col("r") <= top)
    names = ranked.groupBy("domain", "canonical").agg(F.array_join(F.transform(F.sort_array(F.collect_list(F.struct("r", "label"))), lambda x: x["label"]), ", ").alias("top_raw"))
    return sums.join(names, ["domain", "canonical"])


def coverage_at(freq: DataFrame, thresholds: tuple[int, ...] = (2, 5, 10, 30)) -> DataFrame:
    """domain, posts, and the posts under labels of at least each threshold."""
    return freq.groupBy("domain").agg(F.sum("posts").alias("posts"), *(F.sum(F.when(F.col("posts") >= t, F.col("posts")).otherwise(0)).alias(f"at_{t}") for t in thresholds))


def coverage_curve(freq: DataFrame) -> DataFrame:
    """label_size, labels, posts, covered: the share of posts under labels of at least that size. One row for each size, of which there are
    few: at most about the square root of twice the number of posts."""
    sizes = freq.groupBy(F.col("posts").alias("label_size")).agg(F.count("*").alias("labels"), F.sum("posts").alias("posts"))
    total = freq.agg(F.sum("posts").alias("total"))
    upto = F.sum("posts").over(Window.orderBy(F.desc("label_size")).rowsBetween(Window.unboundedPreceding, 0))
    return sizes.crossJoin(F.broadcast(total)).select("label_size", "labels", "posts", (upto / F.col("total")).alias("covered"))  # one row of totals


def events(df: DataFrame) -> DataFrame:
    """idx, domain, topic, narrow of posts in the active domains that name an event: a narrow label beside the topic, both lower-cased."""
    rows = labels_of(df).withColumn("narrow", F.lower(strip(text_or_empty("topic_narrow"))))
    kept = rows.where(F.col("domain").isin(*ACTIVE_DOMAINS) & F.col("post_type").isin(*TRANSFER_TYPES) & ~F.col("label").isin("", "unclassified"))
    return kept.select("idx", "domain", F.col("label").alias("topic"), F.when((F.col("narrow") != "") & (F.col("narrow") != F.col("label")), F.col("narrow")).alias("narrow"))


def event_frequencies(posts: DataFrame) -> DataFrame:
    return posts.where("narrow is not null").groupBy("domain", "narrow").agg(F.count("*").alias("posts"))


def ambiguous_topics(posts: DataFrame, least: int = 3) -> DataFrame:
    """domain, topic, events of topics under which at least so many events are named."""
    return posts.groupBy("domain", "topic").agg(F.countDistinct("narrow").alias("events"), F.count("*").alias("posts")).where(F.col("events") >= least)


def first_of_each_event(posts: DataFrame) -> DataFrame:
    """One row for each event of a domain, that of the most frequent topic, then the earliest."""
    n = F.count("*").over(Window.partitionBy("domain", "topic"))
    named = posts.withColumn("topic_posts", n).where("narrow is not null")
    return named.withColumn("r", F.row_number().over(Window.partitionBy("domain", "narrow").orderBy(F.desc("topic_posts"), "idx"))).where("r = 1").select("idx", "domain", "topic", "narrow", "topic_posts")


def themes(freq: DataFrame, k: int = 20) -> DataFrame:
    """domain, theme, labels, posts: the k largest groups of labels with the same first two words."""
    theme = F.array_join(F.slice(F.split("label", " "), 1, 2), " ")
    g = freq.groupBy("domain", theme.alias("theme")).agg(F.count("*").alias("labels"), F.sum("posts").alias("posts"))
    return g.withColumn("r", F.row_number().over(Window.partitionBy("domain").orderBy(F.desc("labels"), F.desc("posts"), "theme"))).where(F.col("r") <= k).drop("r")


def two_counts(freq: DataFrame, topic_map: DataFrame) -> DataFrame:
    """domain and the number of topics by two methods: a, canonical labels that recur and raw labels that stand alone; b, distinct canonical
    labels; and how many are in both parts of a."""
    canonicals = canonical_frequencies(freq, topic_map)
    recurring = canonicals.where("posts >= 2").select("domain", F.col("canonical").alias("label"))
    single = freq.where("posts = 1").select("domain", "label")
    both = recurring.intersect(single).groupBy("domain").agg(F.count("*").alias("in_both"))
    a = recurring.unionAll(single).groupBy("domain").agg(F.count("*").alias("method_a"))
    b = canonicals.groupBy("domain").agg(F.count("*").alias("method_b"))
    return a.join(b, "domain", "full_outer").join(both, "domain", "left").select("domain", *(F.coalesce(c, F.lit(0)).alias(c) for c in ("method_a", "method_b", "in_both")))


def example_map(freq: DataFrame) -> DataFrame:
    """A map made of the labels by rule, to run the operators on: every fifth length a self-map artifact, every third an identity, the others
    without their first word; every seventh isn't in it."""
    n = F.length("label")
    canonical: Column = F.when(n % 5 == 0, "self-map").when(n % 3 == 0, F.col("label")).otherwise(F.regexp_replace("label", "^[a-z]+ ", ""))
    return freq.where(n % 7 != 0).select("domain", F.col("label").alias("raw_label"), canonical.alias("canonical"))
