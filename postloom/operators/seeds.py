"""A seed vocabulary from label frequencies in three passes, each relational.

1: labels with the same root (trailing words that name an angle stripped) go to their most frequent one. 2: labels with the same token set go
where their most frequent one went; this isn't followed further. 3: of the canonical labels, ranked by combined frequency, each joins the first
better one that is similar enough, and what that one joined.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from ..functions.text import tokens
from ..session import cut_lineage
from .similarity import similar_sets, with_prefixes

#: Trailing words that name an angle on a subject. Fixed values.
ANGLES = tuple(
    """optimization optimisation optimizations challenges challenge issues issue problems problem best practices practice strategies strategy improvements improvement benefits benefit techniques technique approaches approach trends trend
    risks risk concerns concern insights insight tips tip lessons lesson overview review analysis comparison guide tutorial basics fundamentals introduction intro discussion debate updates update news announcements announcement management
    solutions solution use cases case examples example resources resource tools tooling methods methodology framework frameworks patterns pattern design process processes workflow workflows implementation implementations adoption impact
    evolution future history recap summary""".split()
)


def root(label: Column) -> Column:
    """The label's words, dots kept, without the run of angle words at its end; the label itself if nothing else is in it."""
    w = F.array_join(F.regexp_extract_all(F.lower(label), F.lit(r"[a-z0-9]+(?:\.[a-z0-9]+)*"), 0), " ")
    cut = F.regexp_replace(w, f"(?:(?:^| )(?:{'|'.join(ANGLES)}))+$", "")
    return F.when(cut == "", label).otherwise(cut)


def _winner(key: list[str]) -> Column:
    """The label of the key with the most posts, then the shortest, then the smallest."""
    return F.first("label").over(Window.partitionBy(*key).orderBy(F.desc("posts"), F.length("label"), "label"))


def by_root(freq: DataFrame) -> DataFrame:
    """domain, label, posts, first: pass 1 over domain, label, posts."""
    return freq.withColumn("root", root(F.col("label"))).withColumn("first", _winner(["domain", "root"])).drop("root")


def by_tokens(passed: DataFrame) -> DataFrame:
    """domain, label, posts, canonical: pass 2. Labels without tokens stay as they are."""
    keyed = passed.withColumn("key", F.array_join(tokens(F.col("label"), "small"), " "))
    # a label without tokens is a key of its own, so that they don't meet in one group
    own = F.when(F.col("key") == "", F.concat(F.lit("\0"), "label")).otherwise(F.col("key"))
    best = F.first("first").over(Window.partitionBy("domain", own).orderBy(F.desc("posts"), F.length("label"), "label"))
    return keyed.withColumn("canonical", F.when(F.col("key") == "", F.col("first")).otherwise(best)).drop("key", "first")


def rank_pairs(canonicals: DataFrame, t: float = 0.75) -> DataFrame:
    """domain, label, better, score: for each canonical label the better ranked ones that are similar. canonicals: domain, label, posts, rank."""
    sets = canonicals.select("domain", "label", "rank", tokens(F.col("label"), "small").alias("tokens")).where(F.size("tokens") > 0)
    p = with_prefixes(sets.select("domain", "tokens").distinct(), t)
    pairs = similar_sets(p, p, t)
    a = sets.select("domain", F.col("tokens").alias("a"), "label", "rank")
    b = sets.select("domain", F.col("tokens").alias("b"), F.col("label").alias("better"), F.col("rank").alias("better_rank"))
    return pairs.join(a, ["domain", "a"]).join(b, ["domain", "b"]).where(F.col("better_rank") < F.col("rank")).select("domain", "label", "rank", "better", "better_rank", "score")


def ranked(passed: DataFrame) -> DataFrame:
    """domain, label, posts, rank of the canonical labels. rank orders the labels of a domain, most posts first; it is made of a row's own values,
    so no domain has to be sorted in one place."""
    sums = passed.groupBy("domain", F.col("canonical").alias("label")).agg(F.sum("posts").alias("posts"))
    return sums.withColumn("rank", F.struct(F.negative("posts").alias("n"), F.col("label").alias("l")))


def join_better(canonicals: DataFrame, t: float = 0.75, max_rounds: int = 40) -> DataFrame:
    """domain, label, seed: pass 3. Each label's parent is its best ranked similar one; parents are followed by doubling until nothing moves."""
    parents = rank_pairs(canonicals, t).groupBy("domain", "label").agg(F.min_by("better", "better_rank").alias("parent"))
    at = cut_lineage(canonicals.select("domain", "label").join(parents, ["domain", "label"], "left").select("domain", "label", F.coalesce("parent", "label").alias("seed")))
    for _ in range(max_rounds):
        up = at.select("domain", F.col("label").alias("seed"), F.col("seed").alias("above"))
        then = cut_lineage(at.join(up, ["domain", "seed"]).select("domain", "label", "seed", "above"))
        moved = then.where("seed <> above").limit(1).count()
        at = then.select("domain", "label", F.col("above").alias("seed"))
        if not moved:
            return at
    raise RuntimeError(f"parents not settled after {max_rounds} rounds")


def seed_vocabulary(freq: DataFrame, min_freq: int = 2, t: float = 0.75) -> DataFrame:
    """domain, seed, posts, labels from the labels with at least min_freq posts."""
    passed = by_tokens(by_root(freq.where(F.col("posts") >= min_freq)))
    seeds = join_better(ranked(passed), t)
    j = passed.join(seeds.select("domain", F.col("label").alias("canonical"), "seed"), ["domain", "canonical"])
    return j.groupBy("domain", "seed").agg(F.sum("posts").alias("posts"), F.count("*").alias("labels"))
