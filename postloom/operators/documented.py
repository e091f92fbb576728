"""Outputs that are described only in words; the definitions here are our own."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window, functions as F

from .labels import bucket


def top_percent_coverage(freq: DataFrame, percents: tuple[int, ...] = (1, 5, 10, 20, 50)) -> DataFrame:
    """domain, pct, labels, posts_pct: the share of a domain's posts under its most frequent pct percent of labels (rounded up)."""
    w = Window.partitionBy("domain").orderBy(F.desc("posts"), "label")
    ranked = freq.withColumns({"r": F.row_number().over(w), "n": F.count("*").over(Window.partitionBy("domain")), "total": F.sum("posts").over(Window.partitionBy("domain"))})
    rows = ranked.select("*", F.explode(F.array(*(F.lit(p) for p in percents))).alias("pct")).where(F.col("r") <= F.ceil(F.col("n") * F.col("pct") / 100))
    return rows.groupBy("domain", "pct").agg(F.count("*").alias("labels"), (100.0 * F.sum("posts") / F.max("total")).alias("posts_pct"))


def master_numbers(posts: DataFrame, freq: DataFrame, cells: DataFrame) -> DataFrame:
    """name, value: posts, labels, labels with one post, cells, cells with both sides."""
    rows = posts.agg(F.count("*").alias("posts")).crossJoin(freq.agg(F.count("*").alias("labels"), F.count_if(F.col("posts") == 1).alias("single_labels"))).crossJoin(
        cells.agg(F.count("*").alias("cells"), F.count_if((F.col("linkedin_posts") > 0) & (F.col("reddit_posts") > 0)).alias("bilateral"))
    )  # one row each
    names = ("posts", "labels", "single_labels", "cells", "bilateral")
    return rows.select(F.explode(F.array(*(F.struct(F.lit(n).alias("name"), F.col(n).alias("value")) for n in names))).alias("x")).select("x.*")


def wasserstein(posts: DataFrame, keys: list[str], side: str, value: str) -> DataFrame:
    """keys, distance: the first Wasserstein distance between the distributions of a number on the sides li and rd of each group that has both.

    The distance is the area between the two distribution functions: counts per distinct value, running sums over them, and the widths between
    neighbours. A group is a window over its distinct values, not over its rows."""
    rows = posts.where(F.col(value).isNotNull())
    counts = rows.groupBy(*keys, value).agg(*(F.count_if(F.col(side) == s).alias(s) for s in ("li", "rd")))
    w = Window.partitionBy(*keys).orderBy(value)
    upto = w.rowsBetween(Window.unboundedPreceding, 0)
    whole = Window.partitionBy(*keys)
    cdf = lambda s: F.sum(s).over(upto) / F.sum(s).over(whole)
    both = (F.sum("li").over(whole) > 0) & (F.sum("rd").over(whole) > 0)
    steps = counts.withColumn("both", both).where("both").select(*keys, (F.abs(cdf("li") - cdf("rd")) * F.coalesce(F.lead(value).over(w) - F.col(value), F.lit(0))).alias("area"))
    return steps.groupBy(*keys).agg(F.sum("area").alias("distance"))


def true_coverage(canonicals: DataFrame) -> DataFrame:
    """domain, posts, covered, pct: of canonical_frequencies(), the posts whose canonical label has at least two, so that they stand beside another."""
    g = canonicals.groupBy("domain").agg(F.sum("posts").alias("posts"), F.coalesce(F.sum(F.when(F.col("posts") >= 2, F.col("posts"))), F.lit(0)).alias("covered"))
    return g.withColumn("pct", F.when(F.col("posts") > 0, 100.0 * F.col("covered") / F.col("posts")))


def agreement_curve(rows: DataFrame, score: str, agrees: str, thresholds: tuple[float, ...] = (0.0, 0.5, 0.55, 0.6, 0.65, 0.7, 0.75, 0.8, 0.9)) -> DataFrame:
    """threshold, items, agreed, pct: of the rows whose score is at least a threshold, how many agree. Rows without a score are left out."""
    scored = rows.where(F.col(score).isNotNull()).select(score, agrees, F.explode(F.array(*(F.lit(t) for t in thresholds))).alias("threshold")).where(F.col(score) >= F.col("threshold"))
    return scored.groupBy("threshold").agg(F.count("*").alias("items"), F.count_if(agrees).alias("agreed")).withColumn("pct", 100.0 * F.col("agreed") / F.col("items"))


#: Names and first sizes of the bands that groups are counted in.
BANDS = (1, 2, 3, 4, 5, 6, 10, 20)


def group_bands(groups: DataFrame) -> DataFrame:
    """domain, band, groups, labels, pct: how many groups (domain, label, component) have how many labels, and their share of the domain's labels."""
    sizes = groups.groupBy("domain", "component").agg(F.count("*").alias("n"))
    by_band = sizes.groupBy("domain", bucket(F.col("n"), BANDS).alias("band")).agg(F.count("*").alias("groups"), F.sum("n").alias("labels"))
    total = sizes.groupBy("domain").agg(F.sum("n").alias("total"))
    return by_band.join(total, "domain").select("domain", "band", "groups", "labels", (100.0 * F.col("labels") / F.col("total")).alias("pct"))


def group_coverage(groups: DataFrame, freq: DataFrame, base: DataFrame, thresholds: tuple[int, ...] = (2, 3, 5, 10)) -> DataFrame:
    """domain, least, groups, collapsed, covered, pct: if all groups (domain, label, component) of at least so many labels, each of one post, became
    one topic: their posts, and with base (domain, posts), which is covered before, the domain's posts covered in all."""
    total = freq.groupBy("domain").agg(F.sum("posts").alias("total"))
    sizes = groups.groupBy("domain", "component").agg(F.count("*").alias("n"))
    wide = sizes.select("domain", "n", F.explode(F.array(*(F.lit(t) for t in thresholds))).alias("least"))
    some = wide.groupBy("domain", "least").agg(F.count_if(F.col("n") >= F.col("least")).alias("groups"), F.sum(F.when(F.col("n") >= F.col("least"), F.col("n")).otherwise(0)).alias("collapsed"))
    all_ = total.join(base.select("domain", F.col("posts").alias("base")), "domain", "left").select("domain", "total", F.coalesce("base", F.lit(0)).alias("base"), F.explode(F.array(*(F.lit(t) for t in thresholds))).alias("least"))
    j = all_.join(some, ["domain", "least"], "left").na.fill(0, ["groups", "collapsed"])
    return j.select("domain", "least", "groups", "collapsed", (F.col("base") + F.col("collapsed")).alias("covered"), (100.0 * (F.col("base") + F.col("collapsed")) / F.col("total")).alias("pct"))
