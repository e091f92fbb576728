"""Building a vocabulary with a model: the seed pass, the mapping pass over a growing vocabulary, its counters, alerts and projection, and
checks of what was invented. A model is any callable; how it answers is the caller's affair."""

from __future__ import annotations

import json
from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import DataFrame, Window, functions as F

from ..functions.text import strip
from .labeling import attempts
from .similarity import similar_pairs

#: Takes (domain, [(label, posts)], (low, high)), gives the text of a JSON list of topics.
SeedModel = Callable[[str, list[tuple[str, int]], tuple[int, int]], str]
#: Takes (domain, seeds, vocabulary so far, labels), gives the text of a JSON object {label: topic}.
MapModel = Callable[[str, list[str], list[str], list[str]], str]
MAPPED = "domain string, label string, canonical string, batch bigint, kind string, new_topics bigint"
#: Labels that one prompt of the seed pass may hold.
MAX_PROMPT_LABELS = 20_000


def size_hint(n: int) -> tuple[int, int]:
    """How many topics to expect of n labels, from and to."""
    return max(10, n // 3), max(15, n // 2)


def size_hints(freq: DataFrame, least: int = 2) -> DataFrame:
    """domain, labels, low, high: size_hint() of the labels with at least so many posts."""
    n = freq.where(F.col("posts") >= least).groupBy("domain").agg(F.count("*").alias("labels"))
    part = lambda by, floor: F.greatest(F.lit(floor).cast("bigint"), F.floor(F.col("labels") / by))
    return n.select("domain", "labels", part(3, 10).alias("low"), part(2, 15).alias("high"))


def seed_pass(freq: DataFrame, model: SeedModel, least: int = 2, tries: int = 3, pause: float = 2.0) -> DataFrame:
    """domain, topic, rank, status: one call for each domain with its frequent labels, most posts first. A domain whose calls fail has one row with
    the status failed, so that it can be tried again; topics are lower-cased, repeats and blanks left out. A call holds all labels of its domain;
    more than MAX_PROMPT_LABELS are an error, as no prompt takes them."""
    rows = freq.where((F.col("posts") >= least) & F.col("domain").isNotNull())
    if too_many := rows.groupBy("domain").agg(F.count("*").alias("n")).where(F.col("n") > MAX_PROMPT_LABELS).first():
        raise ValueError(f"{too_many.n} labels of {too_many.domain} for one prompt; raise least")

    def run(key: tuple, part: pd.DataFrame) -> pd.DataFrame:
        part = part.sort_values(["posts", "label"], ascending=[False, True])
        answer = attempts(lambda: _list(model(key[0], list(zip(part["label"], part["posts"])), size_hint(len(part)))), tries, pause)
        topics = list(dict.fromkeys(t for x in answer or [] if (t := str(x).strip().lower())))
        out = [(key[0], t, k, "ok") for k, t in enumerate(topics, 1)] or [(key[0], None, 0, "failed")]
        return pd.DataFrame(out, columns=["domain", "topic", "rank", "status"])

    return rows.select("domain", "label", "posts").groupBy("domain").applyInPandas(run, "domain string, topic string, rank int, status string")


def _list(text: str) -> list:
    found = json.loads(_bare(text))
    if not isinstance(found, list) or not found:
        raise ValueError("no list in the answer")
    return found


def _object(text: str) -> dict:
    found = json.loads(_bare(text))
    if not isinstance(found, dict):
        raise ValueError("no object in the answer")
    return found


def _bare(text: str) -> str:
    t = text.strip()
    return t.split("\n", 1)[-1].rsplit("```", 1)[0] if t.startswith("```") else t


def label_batches(labels: DataFrame, size: int = 60) -> DataFrame:
    """domain, label, batch: the distinct labels of each domain in order, `size` to a batch."""
    number = F.row_number().over(Window.partitionBy("domain").orderBy("label"))
    return labels.select("domain", "label").distinct().select("domain", "label", F.floor((number - 1) / size).alias("batch"))


def map_pass(labels: DataFrame, seeds: DataFrame, model: MapModel, done: DataFrame | None = None, size: int = 60, first_batches: int | None = None, tries: int = 3, pause: float = 2.0) -> DataFrame:
    """MAPPED of labels (domain, label) by batches in order, over a vocabulary that starts with the seeds (domain, topic) and grows by what each batch
    invents. kind is seed (also a topic that an earlier batch invented), self, invented or fallback, where all calls of a batch failed and its labels
    map to themselves; new_topics is how many topics its batch added. Labels that done has with another kind than fallback are left out, and what
    they map to is in the vocabulary. first_batches: only so many batches of a domain, as for a trial.

    Batches of a domain follow one another, since each sees what the ones before invented: one task a domain, in which rows stream by in order
    and only the vocabulary is held. Domains run beside one another.
    """
    key = F.col("domain").isNotNull() & F.col("label").isNotNull()
    todo = labels.where(key).select("domain", "label").distinct()
    known = seeds.where("domain is not null and topic is not null").select("domain", F.col("topic").alias("text"), F.lit(0).alias("what")).distinct()
    if done is not None:
        kept = done.where("kind <> 'fallback'")
        todo = todo.join(kept.select("domain", "label"), ["domain", "label"], "left_anti")
        known = known.unionByName(kept.select("domain", F.col("canonical").alias("text"), F.lit(1).alias("what")).distinct())
    # of each domain first the seeds, then what was invented before, then the labels
    rows = known.unionByName(todo.select("domain", F.col("label").alias("text"), F.lit(2).alias("what")))
    stream = rows.repartition("domain").sortWithinPartitions("domain", "what", "text")

    def run(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        domain, seeds_, vocabulary, held, batch, waiting = None, [], [], set(), 0, []

        def flush() -> pd.DataFrame:
            nonlocal batch, waiting
            answer = attempts(lambda: _object(model(domain, seeds_, list(vocabulary), list(waiting))), tries, pause)
            by = {k.strip().lower(): str(v).strip().lower() for k, v in reversed(list((answer or {}).items()))}
            mapped = [(x, x if answer is None else by.get(x.strip().lower(), x.strip().lower())) for x in waiting]
            fresh = [] if answer is None else list(dict.fromkeys(c for _, c in mapped if c not in held))
            of_seeds = set(seeds_)
            kind = lambda x, c: "fallback" if answer is None else "seed" if c in of_seeds else "self" if c == x.strip().lower() else "invented" if c in new else "seed"
            new = set(fresh)
            out = pd.DataFrame([(domain, x, c, batch, kind(x, c), len(fresh)) for x, c in mapped], columns=["domain", "label", "canonical", "batch", "kind", "new_topics"])
            vocabulary.extend(fresh)
            held.update(fresh)
            batch, waiting = batch + 1, []
            return out

        for part in parts:
            for d, text, what in zip(part["domain"], part["text"], part["what"]):
                if d != domain:
                    if waiting:
                        yield flush()
                    domain, seeds_, vocabulary, held, batch, waiting = d, [], [], set(), 0, []
                if what < 2:
                    if text not in held:
                        vocabulary.append(text)
                        held.add(text)
                        if what == 0:
                            seeds_.append(text)
                elif first_batches is None or batch < first_batches:
                    waiting.append(text)
                    if len(waiting) == size:
                        yield flush()
        if waiting:
            yield flush()

    return stream.mapInPandas(run, MAPPED)


def mapping_counters(mapped: DataFrame) -> DataFrame:
    """domain, labels, seed_maps, invented, self_maps, fallbacks of map_pass()."""
    return mapped.groupBy("domain").agg(F.count("*").alias("labels"), *(F.count_if(F.col("kind") == k).alias(name) for k, name in (("seed", "seed_maps"), ("invented", "invented"), ("self", "self_maps"), ("fallback", "fallbacks"))))


def invention_alerts(mapped: DataFrame, most: int = 3) -> DataFrame:
    """domain, batch, new_topics of the batches that added more than `most` topics."""
    return mapped.where(F.col("new_topics") > most).select("domain", "batch", "new_topics").distinct()


def projection(sample: DataFrame, labels: DataFrame) -> DataFrame:
    """domain, sampled, labels, seed_maps, invented, self_maps: the shares of a trial's labels over all labels of the domain, truncated."""
    s = mapping_counters(sample)
    of = F.col("seed_maps") + F.col("invented") + F.col("self_maps")
    total = labels.groupBy("domain").agg(F.countDistinct("label").alias("all_labels"))
    j = s.where(of > 0).join(total, "domain")
    return j.select("domain", F.col("labels").alias("sampled"), F.col("all_labels").alias("labels"), *(F.floor(F.col(c) / of * F.col("all_labels")).alias(c) for c in ("seed_maps", "invented", "self_maps")))


def invented(topic_map: DataFrame, seeds: DataFrame) -> DataFrame:
    """domain, label: what the map's labels become that the seeds (domain, topic) don't have."""
    return topic_map.select("domain", F.col("canonical").alias("label")).where("label is not null").distinct().join(seeds.select("domain", F.col("topic").alias("label")).distinct(), ["domain", "label"], "left_anti")


def consistency(topic_map: DataFrame, seeds: DataFrame, t: float = 0.6) -> DataFrame:
    """domain, set_a, set_b, score: invented topics that are nearly the same, by their sets of words."""
    return similar_pairs(invented(topic_map, seeds), "plain", t)


def unknown_targets(merges: DataFrame, canonicals: DataFrame) -> DataFrame:
    """The merges (domain, label) whose label isn't a canonical one of the domain: they are no candidates."""
    known = canonicals.select("domain", F.lower(strip("canonical")).alias("_label")).distinct()
    return merges.withColumn("_label", F.lower(strip("label"))).join(known, ["domain", "_label"], "left_anti").drop("_label")


def prefix_model(words: int = 2, fails: str | None = None) -> MapModel:
    """A stand-in for tests and queries, without any judgement: a label becomes a seed of the same first words, else its first words. A batch that
    holds a label with the text `fails` isn't answered."""

    def model(domain: str, seeds: list[str], vocabulary: list[str], labels: list[str]) -> str:
        if fails and any(fails in x for x in labels):
            raise ValueError("no answer")
        return json.dumps({x: " ".join(x.split(" ")[:words]) for x in labels})

    return model


def frequency_model(most: int = 50) -> SeedModel:
    """A stand-in for tests and queries: the most frequent labels, as many as the hint's upper end and at most so many."""
    return lambda domain, labels, hint: json.dumps([x for x, _ in labels[: min(most, hint[1])]])
