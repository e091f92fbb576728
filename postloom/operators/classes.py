"""Classes of labels by similarity to recurring ones, and what a vocabulary would look like after collapsing them."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from .similarity import best_matches

# What makes a label a named technology, product or release.
TECHNOLOGIES = tuple("node.js next.js react angular vue django laravel spring kubernetes docker aws azure gcp postgresql mongodb redis kafka graphql grpc golang rust swift kotlin java python ruby php scala clojure haskell elm".split())
NAMED = (
    r"(?i)\b(postgresql|postgres|mysql|sqlite|mongodb|redis|kafka|kubernetes|k8s|docker|podman|react|vue|angular|svelte|next\.?js|nuxt|remix|astro|node\.?js|deno|bun|python|rust|go|golang|typescript|javascript|java|kotlin|swift|ruby|rails|django|fastapi|flask|spring|laravel"
    r"|aws|gcp|azure|terraform|ansible|pulumi|github|gitlab|bitbucket|openai|anthropic|claude|gpt|llama|mistral|gemini|copilot|cursor|graphql|grpc|rest|websocket|htmx|tailwind|shadcn|linux|ubuntu|debian|alpine|windows|macos|vercel|netlify|cloudflare|supabase|planetscale|neon"
    r"|elasticsearch|clickhouse|duckdb|snowflake|bigquery|databricks|langchain|langgraph|llamaindex|autogen|crewai|v\d+\.\d*|\d+\.\d+|release|launch|announcement|update|cve-\d+|zero.?day)\b|\b\d+\.\d+|\bv\d+\b|release\s+\d+|version\s+\d+"
)


def _words(c: Column) -> Column:
    return F.size(F.filter(F.split(F.trim(c), r"\s+"), lambda w: w != ""))


def singleton_classes(freq: DataFrame, strong: float = 0.5, weak: float = 0.3) -> DataFrame:
    """domain, label, class of the labels with one post: named_specific, fixable_synonym, weak_synonym, distinct_concept."""
    label = F.col("label")
    named = label.rlike(r"\b\d+\.\d+\b")
    for t in TECHNOLOGIES:
        named = named | (label.contains(t) & (_words(label) <= 4))
    singles = freq.where("posts = 1").select("domain", "label", named.alias("named"))
    best = best_matches(singles.where("not named"), freq.where("posts >= 2"), "wide", weak).select("domain", "label", "score")
    j = singles.join(best, ["domain", "label"], "left")
    return j.select("domain", "label", F.when(F.col("named"), "named_specific").when(F.col("score") >= strong, "fixable_synonym").when(F.col("score") >= weak, "weak_synonym").otherwise("distinct_concept").alias("class"))


def label_classes(freq: DataFrame, t: float = 0.3) -> DataFrame:
    """domain, label, class, match: noise from seven words; named labels compare with named ones only; fixable_synonym from t; else named_specific
    or distinct. match is the label collapsed into."""
    known = freq.select("domain", "label", "posts", F.col("label").rlike(NAMED).alias("named"), (_words(F.col("label")) >= 7).alias("noise"))
    singles = known.where("posts = 1 and not noise")
    best = best_matches(singles, known.where("posts >= 2"), "plain", t, F.col("a_named") == F.col("b_named"), ("named",))
    # labels that aren't named may match any
    loose = best_matches(singles.where("not named"), known.where("posts >= 2"), "plain", t)
    found = best.join(singles.where("named").select("domain", "label"), ["domain", "label"], "left_semi").unionByName(loose)
    j = known.where("posts = 1").join(found.select("domain", "label", F.col("canonical").alias("match")), ["domain", "label"], "left")
    return j.select("domain", "label", F.when(F.col("noise"), "noise").when(F.col("match").isNotNull(), "fixable_synonym").when(F.col("named"), "named_specific").otherwise("distinct").alias("class"), F.when(~F.col("noise"), F.col("match")).alias("match"))


def simulated(freq: DataFrame, classes: DataFrame) -> DataFrame:
    """domain, label, posts of the vocabulary when synonyms are collapsed and noise is dropped."""
    j = freq.join(classes, ["domain", "label"], "left").where(F.coalesce("class", F.lit("")) != "noise")
    return j.groupBy("domain", F.coalesce("match", "label").alias("label")).agg(F.sum("posts").alias("posts"))
