"""Proposals to merge labels, and checks of merge tables: signatures, repeats, suspicious verdicts, known cases, agreement."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from ..functions.text import number, strip, text_or_empty
from .grouping import per_domain, split_groups
from .similarity import best_matches

# Words that shift a label's subject, and cases judged beforehand.
RISK_WORDS = ("leadership", "market", "solutions", "usability", "culture", "strategy", "governance", "policy", "ethics", "regulation", "adoption", "career", "hiring", "team", "organization", "management", "roi", "budget", "funding", "investment")
KNOWN_CASES = (
    ("python performance optimization", "REJECTED"), ("c++ project configuration issues", "REJECTED"), ("auth service scaling", "REJECTED"), ("api version updates", "REJECTED"), ("postgresql learning resources", "REJECTED"),
    ("ab testing design patterns", "APPROVED"), ("browser automation tools", "APPROVED"), ("cli utility development", "APPROVED"),
)


def risk_words(raw: Column, canonical: Column, words: tuple[str, ...] = RISK_WORDS) -> Column:
    """The words that are in the raw label, also within a word of it, and not in the canonical one."""
    a, b = F.lower(text_or_empty(raw)), F.lower(text_or_empty(canonical))
    return F.filter(F.array(*(F.lit(w) for w in words)), lambda w: F.contains(a, w) & ~F.contains(b, w))


def signatures(matches: DataFrame) -> DataFrame:
    """The matches whose labels differ by risk words, the words joined by commas, with an empty column for a person's decision."""
    words = risk_words(F.col("raw_label_or_group"), F.col("proposed_canonical"))
    return matches.withColumn("signature", F.array_join(words, ", ")).where("signature <> ''").withColumn("decision", F.lit(""))


def repeats(matches: DataFrame, keys: tuple[str, ...]) -> DataFrame:
    """keys, rows, distinct_rows, redundant, kind (exact or conflicting) of the keys that occur more than once."""
    rest = [c for c in matches.columns if c not in keys]
    g = matches.groupBy(*keys).agg(F.count("*").alias("rows"), F.countDistinct(F.struct(*(text_or_empty(F.col(c).cast("string")).alias(c) for c in rest))).alias("distinct_rows"))
    return g.where("rows > 1").withColumns({"redundant": F.col("rows") - F.col("distinct_rows"), "kind": F.when(F.col("distinct_rows") == 1, "exact").otherwise("conflicting")})


def decision(c: Column) -> Column:
    """A decision without white space in upper case; NO_VERDICT where there is none."""
    t = F.upper(strip(text_or_empty(c)))
    return F.when(t == "", "NO_VERDICT").otherwise(t)


def suspicions(matches: DataFrame, least: float = 0.55) -> DataFrame:
    """One row of counts: a verdict without a reason, a failed audit, an applied match below the least score, an absent partner."""
    d, reason, score = decision(F.col("human_decision")), strip(text_or_empty("llm_reason")), number("score_or_na")
    partner = F.lower(strip(text_or_empty("proposed_canonical")))
    return matches.agg(
        F.count_if((d != "NO_VERDICT") & (reason == "")).alias("no_reason"), F.count_if(F.contains(reason, F.lit("AUDIT_FAILED"))).alias("audit_failed"), F.count_if((d == "APPLY") & F.coalesce(score < least, F.lit(False))).alias("applied_below"),
        F.count_if(partner.isin("", "n/a")).alias("no_partner"), F.count_if(F.contains(text_or_empty("raw_label_or_group"), F.lit("|"))).alias("groups"),
    )


def known_cases(matches: DataFrame, cases: tuple[tuple[str, str], ...] = KNOWN_CASES) -> DataFrame:
    """part, expected, found, agreeing: of each case the matches whose raw label contains it, and how many have the verdict expected. The cases
    are a short list, broadcast; this is the one join by containment."""
    known = matches.sparkSession.createDataFrame(list(cases), "part string, expected string")
    m = matches.select(F.lower(text_or_empty("raw_label_or_group")).alias("raw"), decision(F.col("human_decision")).alias("verdict"))
    j = F.broadcast(known).join(m, F.contains(F.col("raw"), F.col("part")), "left")
    agrees = F.startswith(F.col("verdict"), F.col("expected")) | F.contains(F.col("expected"), F.col("verdict"))
    return j.groupBy("part", "expected").agg(F.count("raw").alias("found"), F.count_if(agrees).alias("agreeing"))


def proposals(freq: DataFrame, topic_map: DataFrame, t: float = 0.5) -> DataFrame:
    """domain, stage, raw_label_or_group, proposed_canonical, score, verdict: synonyms of labels that stand alone (their own canonical, one
    post) among canonical labels with at least two posts; groups of the rest by shared tokens with the longest as survivor; and what is in no
    group, reported instead of dropped. Verdicts are pending."""
    from .topics import canonical_frequencies

    canonicals = canonical_frequencies(freq, topic_map)
    alone = canonicals.where("posts = 1").select("domain", F.col("canonical").alias("label"))
    targets = canonicals.where("posts >= 2").select("domain", F.col("canonical").alias("label"))
    synonyms = best_matches(alone, targets, "cleanup", t)
    rest = alone.join(synonyms, ["domain", "label"], "left_anti")
    groups = per_domain(rest, split_groups)
    survivor = F.max_by("label", F.struct(F.length("label"), F.col("label")))
    named = groups.where("status <> 'SINGLETON_NO_GROUP'").groupBy("domain", "group_no", "status").agg(F.array_join(F.sort_array(F.collect_list("label")), " | ").alias("raw"), survivor.alias("canonical"))  # a group holds distinct labels of one domain
    single = rest.join(groups.where("status <> 'SINGLETON_NO_GROUP'"), ["domain", "label"], "left_anti")
    row = lambda df, stage, raw, canonical, score, verdict: df.select("domain", F.lit(stage).alias("stage"), raw.alias("raw_label_or_group"), canonical.alias("proposed_canonical"), score.cast("double").alias("score"), verdict.alias("verdict"))
    none = F.lit(None).cast("string")
    return (
        row(synonyms, "synonym", F.col("label"), F.col("canonical"), F.round("score", 3), F.lit("PENDING_REVIEW"))
        .unionByName(row(named, "group", F.col("raw"), F.col("canonical"), F.lit(None), F.when(F.col("status") == "OK", "PENDING_REVIEW").otherwise(F.col("status"))))
        .unionByName(row(single, "single", F.col("label"), none, F.lit(None), F.lit("NO_MATCH")))
    )


def stratified_sample(matches: DataFrame, per_stratum: int = 30, seed: int = 1) -> DataFrame:
    """At most so many rows of each domain, kind (pair or group) and band of the score, by hash: the same ones in every run."""
    score = number("score_or_na")
    band = F.when(score.isNull(), "none").when(score < 0.6, "low").when(score < 0.7, "middle").otherwise("high")
    kind = F.when(F.contains(text_or_empty("raw_label_or_group"), F.lit("|")), "group").otherwise("pair")
    rows = matches.withColumns({"band": band, "kind": kind}).distinct()
    h = F.xxhash64(*matches.columns, F.lit(seed))
    return rows.withColumn("r", F.row_number().over(Window.partitionBy("topic_domain", "kind", "band").orderBy(h))).where(F.col("r") <= per_stratum).drop("r")


def agreement(ratings: DataFrame, a: str, b: str) -> DataFrame:
    """items, agreed, kappa: Cohen's kappa of two columns of verdicts; null where chance agreement is complete."""
    both = ratings.where(F.col(a).isNotNull() & F.col(b).isNotNull()).groupBy(F.col(a).alias("x"), F.col(b).alias("y")).agg(F.count("*").alias("n"))
    sides = both.select(F.explode(F.array(F.struct(F.lit("a").alias("side"), F.col("x").alias("v"), "n"), F.struct(F.lit("b").alias("side"), F.col("y").alias("v"), "n"))).alias("s")).select("s.*")
    margins = sides.groupBy("v").agg(*(F.sum(F.when(F.col("side") == s, F.col("n")).otherwise(0)).alias(s) for s in ("a", "b")))
    chance = margins.agg(F.sum(F.col("a").cast("double") * F.col("b")).alias("chance"))
    seen = both.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("items"), F.coalesce(F.sum(F.when(F.col("x") == F.col("y"), F.col("n"))), F.lit(0)).alias("agreed"))
    e = F.col("chance") / (F.col("items").cast("double") * F.col("items"))
    return seen.crossJoin(chance).select("items", "agreed", F.when((F.col("items") > 0) & (e < 1), (F.col("agreed") / F.col("items") - e) / (1 - e)).alias("kappa"))  # one row each
