"""Audits of merge candidates by a model, a second review's disagreements, and the application of what was approved."""

from __future__ import annotations

import json
from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import DataFrame, functions as F

from ..session import cut_lineage
from .labeling import attempts
from .vocabulary import _object

#: Takes [(label, canonical)], gives the text of a JSON object {number: {"verdict", "reason"}}.
PairModel = Callable[[list[tuple[str, str]]], str]
#: Takes a group's labels, gives the text of a JSON object {"verdict", "reason", "outliers"}.
GroupModel = Callable[[list[str]], str]
FAILED = "AUDIT_FAILED"


def audit_pairs(candidates: DataFrame, model: PairModel | None, size: int = 20, tries: int = 3, pause: float = 2.0) -> DataFrame:
    """The candidates (label, canonical and any others) with verdict and reason: APPROVED only by a YES, REJECTED by any other verdict and where the
    model failed (reason AUDIT_FAILED), NO_VERDICT where an answer leaves a pair out. Without a model, a dry run: PENDING_REVIEW."""
    if model is None:
        return candidates.withColumns({"verdict": F.lit("PENDING_REVIEW"), "reason": F.lit("")})
    columns = candidates.columns

    def run(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for part in parts:
            verdicts: list[tuple[str, str]] = []
            pairs = list(zip(part["label"], part["canonical"]))
            for a in range(0, len(pairs), size):
                own = pairs[a : a + size]
                answer = attempts(lambda: _object(model(own)), tries, pause)  # noqa: B023
                verdicts += [(("REJECTED", FAILED) if answer is None else _verdict(answer.get(str(k)))) for k in range(len(own))]
            part = part[columns].copy()
            part["verdict"], part["reason"] = [v for v, _ in verdicts], [r for _, r in verdicts]
            yield part

    return candidates.mapInPandas(run, ", ".join(f"`{c}` {t}" for c, t in candidates.dtypes) + ", verdict string, reason string")


def _verdict(x) -> tuple[str, str]:
    if not isinstance(x, dict) or not str(x.get("verdict") or "").strip():
        return "NO_VERDICT", ""
    return "APPROVED" if str(x["verdict"]).strip().upper() == "YES" else "REJECTED", str(x.get("reason") or "").strip()


def audit_groups(groups: DataFrame, model: GroupModel | None, tries: int = 3, pause: float = 2.0) -> DataFrame:
    """domain, group_no, labels, verdict, reason, outliers of groups (domain, group_no, labels array), one call each, as audit_pairs()."""
    lean = groups.select("domain", "group_no", "labels")
    if model is None:
        return lean.withColumns({"verdict": F.lit("PENDING_REVIEW"), "reason": F.lit(""), "outliers": F.array().cast("array<string>")})

    def run(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for part in parts:
            out = []
            for d, n, labels in zip(part["domain"], part["group_no"], part["labels"]):
                answer = attempts(lambda: _object(model(list(labels))), tries, pause)  # noqa: B023
                outliers = (answer or {}).get("outliers")
                out.append((d, n, list(labels), *(("REJECTED", FAILED) if answer is None else _verdict(answer)), [str(x) for x in outliers] if isinstance(outliers, list) else []))
            if out:
                yield pd.DataFrame(out, columns=["domain", "group_no", "labels", "verdict", "reason", "outliers"])

    return lean.mapInPandas(run, f"domain string, group_no {dict(lean.dtypes)['group_no']}, labels array<string>, verdict string, reason string, outliers array<string>")


def shared_word_model(least: int = 1) -> PairModel:
    """A stand-in for tests and queries: YES where the two share at least so many words."""

    def model(pairs: list[tuple[str, str]]) -> str:
        return json.dumps({str(k): {"verdict": "YES" if len(set(a.split()) & set(b.split())) >= least else "NO", "reason": "shared words"} for k, (a, b) in enumerate(pairs)})

    return model


def common_word_model() -> GroupModel:
    """A stand-in for tests and queries: YES where all labels have a word in common; else those without the most common word are outliers."""

    def model(labels: list[str]) -> str:
        count: dict[str, int] = {}
        for x in labels:
            for w in set(x.split()):
                count[w] = count.get(w, 0) + 1
        best = min(count, key=lambda w: (-count[w], w), default="")
        out = sorted(x for x in labels if best not in x.split())
        return json.dumps({"verdict": "NO" if out else "YES", "reason": best, "outliers": out})

    return model


def disagreements(rows: DataFrame, first: str, second: str) -> DataFrame:
    """first, second, rows, disagree: how often two verdicts meet, APPROVE and REJECT in both."""
    return rows.groupBy(F.col(first).alias("first_verdict"), F.col(second).alias("second_verdict")).agg(F.count("*").alias("rows")).withColumn("disagree", ~F.col("first_verdict").eqNullSafe(F.col("second_verdict")))


def resolve_merges(merges: DataFrame, max_rounds: int = 40) -> DataFrame:
    """domain, label, target: where each label of merges (domain, label, canonical) ends when merges cascade. Of several merges of a label the smallest
    canonical counts; merges into itself and null ones are left out. Each round doubles the steps taken, so rounds are logarithmic in the length of
    chains. Merges that run in a circle have no end: an error."""
    step = merges.where("domain is not null and label is not null and canonical is not null and label <> canonical").groupBy("domain", "label").agg(F.min("canonical").alias("target"))
    step = cut_lineage(step)
    before = None
    for _ in range(max_rounds):
        on = step.select("domain", F.col("label").alias("target"), F.col("target").alias("then"))
        j = cut_lineage(step.join(on, ["domain", "target"], "left").select("domain", "label", F.coalesce("then", "target").alias("target"), F.col("then").isNotNull().alias("open")))
        left = j.where("open").count()
        step = j.select("domain", "label", "target")
        if left == 0:
            return step
        if left == before:
            example = j.where("open").first()
            raise ValueError(f"merges run in a circle: {example.domain}, {example.label}")
        before = left
    raise RuntimeError(f"not at an end after {max_rounds} rounds")


def apply_merges(topic_map: DataFrame, merges: DataFrame) -> DataFrame:
    """domain, raw_label, canonical, merged: the map with the approved merges (domain, label, canonical) applied to what labels become, cascades
    followed."""
    end = resolve_merges(merges).select("domain", F.col("label").alias("canonical"), "target")
    j = topic_map.join(end, ["domain", "canonical"], "left")
    return j.select("domain", "raw_label", F.coalesce("target", "canonical").alias("canonical"), F.col("target").isNotNull().alias("merged"))
