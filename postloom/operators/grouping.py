"""Groups of labels by shared tokens: components, and the two sequential groupings, which run per domain in the labels' order."""

from __future__ import annotations

import re
from collections.abc import Callable

import pandas as pd
from pyspark.sql import DataFrame, Window, functions as F

from ..functions.text import CLEANUP_SHORT, CLEANUP_STOP, WIDE_STOP, tokens
from ..session import cut_lineage


def token_components(labels: DataFrame, kind: str = "cleanup", max_rounds: int = 40) -> DataFrame:
    """domain, label, component: labels linked by shared tokens, directly or indirectly; the component is its smallest label. Labels without
    tokens are left out.

    A bipartite propagation: each token takes the least of its labels, each label the least of its tokens' values; a hot token is a group of an
    aggregation with a partial step, never a list of pairs.
    """
    parts = cut_lineage(labels.select("domain", "label", F.explode(tokens(F.col("label"), kind)).alias("token")))
    at = cut_lineage(parts.select("domain", "label", F.col("label").alias("component")).distinct())
    for _ in range(max_rounds):
        by_token = parts.join(at, ["domain", "label"]).groupBy("domain", "token").agg(F.min("component").alias("least"))
        by_label = parts.join(by_token, ["domain", "token"]).groupBy("domain", "label").agg(F.min("least").alias("component"))
        # follow the pointer once more, so that chains halve
        up = by_label.select("domain", F.col("label").alias("component"), F.col("component").alias("above"))
        now = cut_lineage(by_label.join(up, ["domain", "component"]).select("domain", "label", F.col("above").alias("component")))
        changed = now.join(at, ["domain", "label", "component"], "left_anti").limit(1).count()
        at = now
        if not changed:
            return at
    raise RuntimeError(f"not stable after {max_rounds} rounds")


def label_tokens(label: str, kind: str) -> frozenset[str]:
    """As functions.text.tokens, for the groupings in Python."""
    if kind == "cleanup":
        return frozenset(w for w in re.findall(r"[a-z0-9]+", label.lower()) if w not in CLEANUP_STOP and (len(w) > 2 or w in CLEANUP_SHORT))
    return frozenset(w for w in re.findall(r"[a-z0-9]+(?:\.[a-z0-9]+)*", label.lower()) if w not in WIDE_STOP and len(w) > 2)


def closure_groups(labels: list[str], shared: int, kind: str = "cleanup") -> list[list[str]]:
    """Groups of at least two: the first label left seeds a group, which takes in whatever shares so many tokens with all it has, until
    nothing more does. An index from tokens to the labels left finds them without comparing all."""
    sets = {x: label_tokens(x, kind) for x in labels}
    where: dict[str, set[str]] = {}
    for x, own in sets.items():
        for t in own:
            where.setdefault(t, set()).add(x)
    order = {x: k for k, x in enumerate(labels)}
    used: set[str] = set()
    out = []
    for first in labels:
        if first in used:
            continue
        group, used = [first], used | {first}
        counts: dict[str, int] = {}
        have: set[str] = set()
        fresh = set(sets[first])
        while fresh:
            have |= fresh
            for t in fresh:
                for x in where[t]:
                    if x not in used:
                        counts[x] = counts.get(x, 0) + 1
            joined = sorted((x for x, n in counts.items() if n >= shared), key=order.get)
            fresh = set()
            for x in joined:
                counts.pop(x)
                used.add(x)
                group.append(x)
                fresh |= sets[x] - have
        if len(group) > 1:
            out.append(group)
    return out


def split_groups(labels: list[str], shared: int = 1, most: int = 9, depth: int = 0, max_depth: int = 3) -> list[tuple[list[str], str]]:
    """(group, status): groups larger than most are grouped again with one more shared token, up to max_depth, beyond which they need a manual
    review; labels that then stand alone are reported as such."""
    out: list[tuple[list[str], str]] = []
    for group in closure_groups(labels, shared):
        if len(group) <= most:
            out.append((group, "OK"))
        elif depth >= max_depth:
            out.append((group, "MANUAL_REVIEW_REQUIRED"))
        else:
            parts = split_groups(sorted(group), shared + 1, most, depth + 1, max_depth)
            out += parts
            placed = {x for g, _ in parts for x in g}
            out += [([x], "SINGLETON_NO_GROUP") for x in sorted(group) if x not in placed]
    return out


def greedy_groups(labels: list[str], kind: str = "wide") -> list[list[str]]:
    """One pass: a label joins the group whose tokens it overlaps most, the first on ties, or starts one. Labels without tokens are skipped."""
    groups: list[list[str]] = []
    where: dict[str, set[int]] = {}
    for x in labels:
        own = label_tokens(x, kind)
        if not own:
            continue
        counts: dict[int, int] = {}
        for t in own:
            for g in where.get(t, ()):
                counts[g] = counts.get(g, 0) + 1
        at = min(counts, key=lambda g: (-counts[g], g)) if counts else len(groups)
        if at == len(groups):
            groups.append([])
        groups[at].append(x)
        for t in own:
            where.setdefault(t, set()).add(at)
    return groups


def per_domain(labels: DataFrame, group: Callable[[list[str]], list[tuple[list[str], str]]], kind: str = "cleanup", buckets: int = 256) -> DataFrame:
    """domain, label, group_no, status of a sequential grouping of the distinct labels of each domain, in the order of the labels; groups are numbered
    by their smallest label.

    Labels that share no token, directly or indirectly, never meet in a group. So a domain is parted into its components by tokens, which are found in parallel, and
    components are grouped in buckets, each in order: the result is that of the whole domain. What is one piece of work is one component, since
    each step within it depends on the one before. kind: the tokens that the grouping goes by; labels without any are in no group.
    """

    def run(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
        found = group(sorted(rows["label"]))
        return pd.DataFrame([(key[0], x, min(g), status) for g, status in found for x in g], columns=["domain", "label", "least", "status"])

    parts = token_components(labels.select("domain", "label").distinct(), kind)
    done = parts.groupBy("domain", F.pmod(F.xxhash64("component"), F.lit(buckets)).alias("bucket")).applyInPandas(lambda key, rows: run(key, rows), "domain string, label string, least string, status string")
    done = cut_lineage(done)
    numbers = done.select("domain", "least").distinct().withColumn("group_no", (F.row_number().over(Window.partitionBy("domain").orderBy("least")) - 1).cast("bigint"))  # a row a group
    return done.join(numbers, ["domain", "least"]).select("domain", "label", "group_no", "status")
