"""Set-similarity joins of labels, exact, by prefix filtering.

Two token sets with a Jaccard similarity of at least t share one of the first |A| - ceil(t|A|) + 1 tokens of each in any common order. The
order is by rarity within the domain, so the tokens joined on are rare ones and a token that is in most labels makes no pairs. Labels with
the same token set are joined once, as one set. Candidates are verified on the whole sets.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from ..functions.text import jaccard, tokens


def token_sets(labels: DataFrame, kind: str) -> DataFrame:
    """domain, tokens of the distinct sets that aren't empty."""
    return labels.select("domain", tokens(F.col("label"), kind).alias("tokens")).where(F.size("tokens") > 0).distinct()


def with_prefixes(sets: DataFrame, t: float) -> DataFrame:
    """domain, tokens, token: a row for each prefix token. Ranks come from an aggregation over the exploded tokens."""
    parts = sets.select("domain", "tokens", F.explode("tokens").alias("token"))
    rarity = parts.groupBy("domain", "token").agg(F.count("*").alias("n"))
    ordered = parts.join(rarity, ["domain", "token"]).groupBy("domain", "tokens").agg(F.sort_array(F.collect_list(F.struct("n", "token"))).alias("by"))  # as many as a label has tokens
    keep = (F.size("by") - F.ceil(t * F.size("by") - 1e-9) + 1).cast("int")
    return ordered.select("domain", "tokens", F.explode(F.slice("by", 1, keep)).alias("x")).select("domain", "tokens", F.col("x.token").alias("token"))


def similar_sets(left: DataFrame, right: DataFrame, t: float) -> DataFrame:
    """domain, a, b, score: the pairs of sets of left and right with a score of at least t, equal sets included. Both sides are with_prefixes()
    over one common order, for which their sets must have been put together: see similar_pairs()."""
    size_fits = (F.size("a") >= F.ceil(t * F.size("b") - 1e-9)) & (F.size("b") >= F.ceil(t * F.size("a") - 1e-9))
    a = left.select("domain", "token", F.col("tokens").alias("a"))
    b = right.select("domain", "token", F.col("tokens").alias("b"))
    pairs = a.join(b, ["domain", "token"]).where(size_fits).select("domain", "a", "b").distinct()
    return pairs.withColumn("score", jaccard(F.col("a"), F.col("b"))).where(F.col("score") >= t - 1e-9)


def similar_pairs(labels: DataFrame, kind: str, t: float) -> DataFrame:
    """domain, set_a, set_b, score of the different token sets (a before b) of labels(domain, label) that are similar; membership() has the
    labels of each set. Labels of the same set aren't expanded into pairs."""
    p = with_prefixes(token_sets(labels, kind), t)
    pairs = similar_sets(p, p, t).where(F.col("a") < F.col("b"))
    return pairs.select("domain", F.array_join("a", " ").alias("set_a"), F.array_join("b", " ").alias("set_b"), "score")


def membership(labels: DataFrame, kind: str) -> DataFrame:
    """domain, label, set_key."""
    return labels.select("domain", "label", F.array_join(tokens(F.col("label"), kind), " ").alias("set_key"))


def best_matches(singles: DataFrame, targets: DataFrame, kind: str, t: float, fits: Column | None = None, also: tuple[str, ...] = ()) -> DataFrame:
    """domain, label, canonical, score: of each label of singles the most similar of targets (domain, label), the smallest on ties, if at least
    t. fits: a further condition on a pair's columns a_<x> and b_<x>, x being among also."""
    left = singles.select("domain", "label", tokens(F.col("label"), kind).alias("tokens"), *also).where(F.size("tokens") > 0)
    right = targets.select("domain", "label", tokens(F.col("label"), kind).alias("tokens"), *also).where(F.size("tokens") > 0)
    both = with_prefixes(left.select("domain", "tokens").unionByName(right.select("domain", "tokens")).distinct(), t)
    on_left = both.join(left.select("domain", "tokens").distinct(), ["domain", "tokens"], "left_semi")
    on_right = both.join(right.select("domain", "tokens").distinct(), ["domain", "tokens"], "left_semi")
    pairs = similar_sets(on_left, on_right, t)
    # Of labels with equal token sets the smallest stands for all, unless a condition tells them apart
    named = right.groupBy("domain", F.col("tokens").alias("b"), *(F.col(c).alias(f"b_{c}") for c in also)).agg(F.min("label").alias("canonical"))
    found = left.select("domain", F.col("tokens").alias("a"), "label", *(F.col(c).alias(f"a_{c}") for c in also)).join(pairs, ["domain", "a"]).join(named, ["domain", "b"])
    if fits is not None:
        found = found.where(fits)
    return found.groupBy("domain", "label").agg(F.min_by("canonical", F.struct(-F.col("score"), "canonical")).alias("canonical"), F.max("score").alias("score"))


def set_links(labels: DataFrame, kind: str, t: float) -> DataFrame:
    """domain, label, set_key, links: of each label its class and the number of other classes similar to it."""
    pairs = similar_pairs(labels, kind, t)
    ends = pairs.select("domain", F.explode(F.array("set_a", "set_b")).alias("set_key")).groupBy("domain", "set_key").agg(F.count("*").alias("links"))
    return membership(labels, kind).join(ends, ["domain", "set_key"], "left").select("domain", "label", "set_key", F.coalesce("links", F.lit(0)).alias("links"))
