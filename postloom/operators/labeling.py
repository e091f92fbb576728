"""Labelling posts in batches with retries and resumable progress. The model is any callable; offline there is one of rules."""

from __future__ import annotations

import json
import time
from collections.abc import Callable, Iterator
from typing import Any

import pandas as pd
from pyspark.sql import DataFrame, Window, functions as F

from ..functions.text import strip, text_or_empty

LABELS = "idx bigint, topic_broad string, topic string, topic_narrow string, opinion_subtopics array<string>, sentiment string, stance string, post_type string, status string"
FIELDS = ("topic_broad", "topic", "topic_narrow", "opinion_subtopics", "sentiment", "stance", "post_type")
#: Takes [{"idx", "text"}], gives the answer's text: a JSON list of objects with idx and FIELDS, bare, in a code fence, or within an object.
Model = Callable[[list[dict]], str]


def batches(posts: DataFrame, size: int = 20, seed: int = 42) -> DataFrame:
    """idx, batch: posts spread over batches of about `size` in a fixed pseudorandom order, by hash: no global sort, and the same batches in any
    order of the rows."""
    n = posts.select(F.count("*").alias("_n"))
    return posts.select("idx").crossJoin(F.broadcast(n)).select("idx", F.pmod(F.xxhash64("idx", F.lit(seed)), F.greatest(F.ceil(F.col("_n") / size), F.lit(1))).alias("batch"))  # one row of totals


def batches_exact(posts: DataFrame, size: int = 20, seed: int = 42, parts: int = 4096) -> DataFrame:
    """idx, batch: posts in a fixed pseudorandom order, exactly `size` to a batch, the last aside. Ranks come in two steps, within parts of the hash
    and over the parts' sums, so that no task sorts all rows. idx is unique."""
    h = posts.select("idx", F.xxhash64("idx", F.lit(seed)).alias("h")).withColumn("part", F.pmod(F.shiftright("h", 40), F.lit(parts)))
    sums = h.groupBy("part").agg(F.count("*").alias("n"))
    before = sums.select("part", F.coalesce(F.sum("n").over(Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("before"))  # `parts` rows
    within = F.row_number().over(Window.partitionBy("part").orderBy("h", "idx"))
    return h.withColumn("r", within).join(F.broadcast(before), "part").select("idx", F.floor((F.col("before") + F.col("r") - 1) / size).alias("batch"))


def read_answer(text: str) -> list[dict]:
    """The objects of a model's answer; raises ValueError if there are none."""
    t = text.strip()
    if t.startswith("```"):
        t = t.split("\n", 1)[-1].rsplit("```", 1)[0]
    found = json.loads(t)
    if isinstance(found, dict):
        found = next((v for v in found.values() if isinstance(v, list)), [])
    found = [x for x in found if isinstance(x, dict)] if isinstance(found, list) else []
    if not found:
        raise ValueError("no objects in the answer")
    return found


def attempts(call: Callable[[], Any], tries: int = 3, pause: float = 2.0) -> Any:
    """What the call gives, tried again after growing pauses; None if all tries fail."""
    for k in range(tries):
        try:
            return call()
        except Exception:  # noqa: BLE001 any failure of a model counts as a try
            if k + 1 < tries:
                time.sleep(pause * 2**k)
    return None


def ask(model: Model, posts: list[dict], tries: int = 3, pause: float = 2.0) -> list[dict]:
    """The answer's objects; none if all tries fail."""
    return attempts(lambda: read_answer(model(posts)), tries, pause) or []


def label(posts: DataFrame, model: Model, done: DataFrame | None = None, size: int = 20, tries: int = 3, pause: float = 2.0, max_chars: int | None = None) -> DataFrame:
    """LABELS of the posts (idx, post_text) that aren't among the successes of done. status is ok, missing (no object with its id) or failed (no
    answer); only ok rows count as done, so the others are tried again when resumed. Ids may come as text. The model gets whole texts, or their
    first max_chars characters if its prompt has a limit."""
    text = text_or_empty("post_text")
    todo = posts.select("idx", (text if max_chars is None else F.substring(text, 1, max_chars)).alias("text"))
    if done is not None:
        todo = todo.join(done.where("status = 'ok'").select("idx"), "idx", "left_anti")

    def run(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for part in parts:
            for a in range(0, len(part), size):
                own = [{"idx": int(i), "text": t} for i, t in zip(part["idx"][a : a + size], part["text"][a : a + size])]
                answer = ask(model, own, tries, pause)
                by_id = {}
                for x in answer:
                    try:
                        by_id[int(x.get("idx"))] = x
                    except (TypeError, ValueError):
                        continue
                rows = []
                for p in own:
                    x = by_id.get(p["idx"])
                    status = "failed" if not answer else "missing" if x is None else "ok"
                    sub = (x or {}).get("opinion_subtopics") or []
                    rows.append((p["idx"], *((str(v) if (v := (x or {}).get(f)) is not None else "") if f != "opinion_subtopics" else [str(s) for s in sub] if isinstance(sub, list) else [] for f in FIELDS), status))
                    if status != "ok":
                        rows[-1] = (p["idx"], "", "UNCLASSIFIED", "", [], "", "", "", status)
                yield pd.DataFrame(rows, columns=["idx", *FIELDS, "status"])

    return todo.mapInPandas(run, LABELS)


def merge_labels(posts: DataFrame, labels: DataFrame) -> DataFrame:
    """The posts with the label columns at the end, in the place of any of the same names; posts without labels are UNCLASSIFIED."""
    lean = posts.drop(*FIELDS, "status")
    j = lean.join(labels.dropDuplicates(["idx"]), "idx", "left")
    return j.withColumns({"topic": F.coalesce("topic", F.lit("UNCLASSIFIED")), "opinion_subtopics": F.coalesce("opinion_subtopics", F.array().cast("array<string>")), "status": F.coalesce("status", F.lit("missing"))})


def last_of_each(progress: DataFrame, order: str) -> DataFrame:
    """The last row of each idx of an append-only table of progress."""
    return progress.withColumn("_r", F.row_number().over(Window.partitionBy("idx").orderBy(F.desc(order)))).where("_r = 1").drop("_r")


def rule_model(keywords: dict[str, str]) -> Model:
    """A stand-in for tests and queries, which shows the runner and judges nothing: the domain of the first keyword in the text, the sentiment of
    a few words, question or opinion by its mark. For real labels give a model, as http_model()."""

    def model(posts: list[dict]) -> str:
        out = []
        for p in posts:
            t = (p["text"] or "").lower()
            domain = next((d for w, d in keywords.items() if w in t), "Other")
            mood = "negative" if any(w in t for w in ("bad ", "overrated", "fragile")) else "positive" if any(w in t for w in ("better", "good ", "well ")) else "neutral"
            out.append({"idx": p["idx"], "topic_broad": domain, "topic": " ".join(t.split()[:3]), "topic_narrow": "", "opinion_subtopics": [], "sentiment": mood, "stance": "questioning" if "?" in t else "assertive", "post_type": "question" if t.rstrip().endswith("?") else "opinion"})
        return json.dumps(out)

    return model


def map_batch(labels: DataFrame, answers: DataFrame) -> DataFrame:
    """domain, label, canonical, status: labels with their canonical one among a model's answers (domain, raw, canonical), whose raw labels are
    compared without case and white space, the smallest answer on ties; labels without an answer map to themselves."""
    a = answers.groupBy("domain", F.lower(strip("raw")).alias("key")).agg(F.min("canonical").alias("answer"))
    j = labels.withColumn("key", F.lower(strip("label"))).join(a, ["domain", "key"], "left")
    return j.select("domain", "label", F.coalesce("answer", "label").alias("canonical"), F.when(F.col("answer").isNull(), "self").otherwise("answered").alias("status"))
