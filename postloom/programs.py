"""Programs over files: python -m postloom.programs NAME --config FILE. Each is a function of a session and a configuration, whose defaults a JSON or
YAML file overlays; paths are those of any file system Spark reads.

    filter      CSV of posts: scope, reject rules; kept posts and rejected ones with their reason
    repair      CSV of tagged posts: sound rows, label repair, the log of corrections
    label       labels by a model over HTTP, resumed from its progress; --test for the first batches only
    pairs       the matrix of audience and group
    vocabulary  --step 0 seeds, 1 map, 2 both; --dry-run one batch a domain; --reset-domains A B; --check-map; --review-map
    seeds       the deterministic seed vocabulary
    apply       the map on tagged posts; with --repair the self-map repair first
    cleanup     merge proposals; --domain D, --dry-run, --sample-size N for the audit of at most N candidates a domain
    review      checks of a merge table; --domain D
"""

from __future__ import annotations

import argparse
import dataclasses
import sys
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from .operators import audit as A, cells as C, labeling as B, labels as L, merges as M, rules as R, seeds as S, topics as T, vocabulary as V
from .sources import files, models


@dataclass(frozen=True)
class Config:
    """Every program's keys; each reads those it needs."""

    input: str = "posts.csv"
    output: str = "out"
    rejected: str = "rejected"
    progress: str = "progress"
    seeds: str = "seeds"
    map: str = "map"
    log: str | None = None
    all_rooms: bool = False
    least_score: float = 0.5
    cutoff: str = "2024-01-01 00:00:00"
    url: str = ""
    model: str = ""
    key_env: str = "MODEL_API_KEY"
    temperature: float = 0.0
    max_tokens: int = 3000
    prompt: str = ""
    batch_size: int = 20
    mapping_batch_size: int = 60
    shuffle_seed: int = 42
    test_batches: int = 5
    max_chars: int | None = None
    transfer_types: tuple[str, ...] = L.TRANSFER_TYPES
    groupby_field: str = "topic"
    min_pair_threshold: int = 10
    concentration_warning_pct: float = 50.0
    audience_map: dict[str, str] = field(default_factory=lambda: C.AUDIENCES)
    seed_freq_threshold: int = 2
    domain_seed_thresholds: dict[str, int] = field(default_factory=dict)
    jaccard_threshold: float = 0.75
    invention_alert_threshold: int = 3
    domains: tuple[str, ...] = L.ACTIVE_DOMAINS


TAGGED = ("idx", *L.KEPT_COLUMNS)


def _chat(c: Config) -> models.HttpModel:
    if not c.url:
        raise ValueError("no model: set url and model in the configuration")
    return models.HttpModel(c.url, c.model, c.key_env, c.temperature, c.max_tokens)


def _posts(spark: SparkSession, c: Config, fields: tuple[str, ...]) -> DataFrame:
    files.present(spark, c.input, needed=True)
    return files.read_csv(spark, c.input, fields)


def _freq(spark: SparkSession, c: Config) -> DataFrame:
    return T.frequencies(_posts(spark, c, TAGGED)).where(F.col("domain").isin(*c.domains))


def run_filter(spark: SparkSession, c: Config, a: argparse.Namespace) -> None:
    files.present(spark, c.input, needed=True)
    posts = files.in_arrival_order(spark, c.input)
    scoped = R.in_scope(posts, None if c.all_rooms else R.ROOMS, c.least_score, c.cutoff).where("scope_reason is null").drop("scope_reason")
    cleaned = R.clean(scoped).withColumn("post_text", F.col("_text")).drop("_text")
    files.write_csv(cleaned.where("drop_reason is null").drop("drop_reason"), c.output)
    files.write_csv(cleaned.where("drop_reason is not null"), c.rejected)


def run_repair(spark: SparkSession, c: Config, a: argparse.Namespace) -> None:
    rows = L.sound_rows(_posts(spark, c, TAGGED))
    files.write_csv(L.repair(rows).select(*(x for x in rows.columns)), c.output, quote_all=True)
    files.write_csv(L.corrections(rows), c.rejected)


def run_label(spark: SparkSession, c: Config, a: argparse.Namespace) -> None:
    posts = _posts(spark, c, ("idx", *files.POST_FIELDS)).withColumn("idx", F.col("idx").cast("bigint"))
    model = models.label_model(_chat(c), c.prompt)
    if a.test:
        some = B.batches_exact(posts, c.batch_size, c.shuffle_seed).where(F.col("batch") < c.test_batches).select("idx")
        B.label(posts.join(some, "idx", "left_semi"), model, None, c.batch_size, max_chars=c.max_chars).write.mode("overwrite").json(f"{c.output}-test")
        return
    done = files.read_progress(spark, c.progress, B.LABELS)
    files.append_progress(B.label(posts, model, done, c.batch_size, max_chars=c.max_chars), c.progress)
    found = files.read_progress(spark, c.progress, B.LABELS)
    best = found.groupBy("idx").agg(F.max_by(F.struct(*(x for x in found.columns if x != "idx")), F.when(F.col("status") == "ok", 1).otherwise(0)).alias("x")).select("idx", "x.*")
    labelled = B.merge_labels(posts, best)
    files.write_csv(labelled.withColumn("opinion_subtopics", F.to_json("opinion_subtopics")), c.output)


def run_pairs(spark: SparkSession, c: Config, a: argparse.Namespace) -> None:
    config = C.CellConfig(group_field=c.groupby_field, transfer_types=tuple(c.transfer_types), audiences=c.audience_map, min_pair=c.min_pair_threshold)
    cells = C.matrix(C.eligible(_posts(spark, c, TAGGED).withColumn("idx", F.col("idx").cast("bigint")), config), config)
    files.write_csv(cells, c.output)


def run_vocabulary(spark: SparkSession, c: Config, a: argparse.Namespace) -> None:
    log = models.log_to(c.log)
    if a.reset_domains:
        for path in (c.seeds, c.progress):
            if files.present(spark, path):
                files.reset_domains(spark, path, a.reset_domains, f"{path}-kept")
                spark.read.parquet(f"{path}-kept").write.mode("overwrite").partitionBy("domain").parquet(path)
        return
    seeds = lambda: spark.read.parquet(c.seeds).where("status = 'ok'").select("domain", "topic")
    if a.check_map or a.review_map:
        topic_map = files.read_map(spark, c.map)
        out = V.consistency(topic_map, seeds()) if a.check_map else T.review(_freq(spark, c), topic_map)
        files.write_csv(out, c.output)
        return
    chat, freq = _chat(c), _freq(spark, c)
    if a.step in (0, 2):
        least = F.coalesce(F.create_map(*(F.lit(x) for kv in c.domain_seed_thresholds.items() for x in kv))[F.col("domain")], F.lit(c.seed_freq_threshold)) if c.domain_seed_thresholds else F.lit(c.seed_freq_threshold)
        todo = freq.where(F.col("posts") >= least)
        if files.present(spark, c.seeds):
            todo = todo.join(seeds().select("domain").distinct(), "domain", "left_anti")
        files.write_domains(V.seed_pass(todo, models.seed_model(chat, c.prompt), 1), c.seeds)
    if a.step in (1, 2):
        model = models.map_model(chat, c.prompt)
        labels = freq.select("domain", "label")
        if a.dry_run:
            files.write_csv(V.projection(V.map_pass(labels, seeds(), model, None, c.mapping_batch_size, 1), labels), f"{c.output}-dry-run")
            return
        done = spark.read.schema(V.MAPPED).parquet(c.progress) if files.present(spark, c.progress) else None
        V.map_pass(labels, seeds(), model, done, c.mapping_batch_size).write.mode("append").partitionBy("domain").parquet(c.progress)
        mapped = spark.read.schema(V.MAPPED).parquet(c.progress)
        best = mapped.groupBy("domain", F.col("label").alias("raw_label")).agg(F.min_by("canonical", F.when(F.col("kind") == "fallback", 1).otherwise(0)).alias("canonical"))
        files.write_map(best, c.map)
        files.write_csv(V.mapping_counters(mapped), c.output)
        for r in V.invention_alerts(mapped, c.invention_alert_threshold).orderBy("domain", "batch").take(1000):  # at most so many lines of a log
            log.warning("%s: batch %s invented %s topics", r.domain, r.batch, r.new_topics)


def run_seeds(spark: SparkSession, c: Config, a: argparse.Namespace) -> None:
    files.write_csv(S.seed_vocabulary(_freq(spark, c).where(F.col("posts") >= c.seed_freq_threshold)), c.output)


def run_apply(spark: SparkSession, c: Config, a: argparse.Namespace) -> None:
    topic_map = files.read_map(spark, c.map)
    mapped = T.apply_map(_posts(spark, c, TAGGED), T.repair_self_map(topic_map) if a.repair else topic_map)
    files.write_csv(mapped, c.output)
    files.write_csv(T.map_summary(mapped), f"{c.output}-summary")


def run_cleanup(spark: SparkSession, c: Config, a: argparse.Namespace) -> None:
    freq = _freq(spark, c)
    if a.domain:
        freq = freq.where(F.col("domain") == a.domain)
    found = M.proposals(freq, files.read_map(spark, c.map).where(F.col("domain").isin([a.domain] if a.domain else list(c.domains))))
    pairs = found.where("stage = 'synonym'").withColumnsRenamed({"raw_label_or_group": "label", "proposed_canonical": "canonical"}).drop("verdict")
    if a.sample_size:
        order = Window.partitionBy("domain").orderBy(F.xxhash64("label", F.lit(c.shuffle_seed)), "label")
        pairs = pairs.withColumn("_r", F.row_number().over(order)).where(F.col("_r") <= a.sample_size).drop("_r")
    audited = A.audit_pairs(pairs, None if a.dry_run else models.pair_model(_chat(c), c.prompt), c.batch_size)
    rest = found.where("stage <> 'synonym'").withColumnsRenamed({"raw_label_or_group": "label", "proposed_canonical": "canonical"}).withColumn("reason", F.lit(""))
    files.append_by_key(audited.select("domain", "stage", "label", "canonical", "score", "verdict", "reason").unionByName(rest.select("domain", "stage", "label", "canonical", "score", "verdict", "reason")), c.output, "domain")


def run_review(spark: SparkSession, c: Config, a: argparse.Namespace) -> None:
    columns = ("topic_domain", "raw_label_or_group", "proposed_canonical", "score_or_na", "risk_words", "llm_reason", "human_decision")
    rows = _posts(spark, c, columns)
    if a.domain:
        rows = rows.where(F.col("topic_domain") == a.domain)
    files.write_csv(M.signatures(rows), f"{c.output}-signatures")
    files.write_csv(M.repeats(rows, columns[:3]), f"{c.output}-repeats")
    files.write_csv(M.suspicions(rows), f"{c.output}-suspicions")
    files.write_csv(M.known_cases(rows), f"{c.output}-known-cases")


PROGRAMS = {"filter": run_filter, "repair": run_repair, "label": run_label, "pairs": run_pairs, "vocabulary": run_vocabulary, "seeds": run_seeds, "apply": run_apply, "cleanup": run_cleanup, "review": run_review}


def parser() -> argparse.ArgumentParser:
    p = argparse.ArgumentParser(prog="postloom", description=__doc__, formatter_class=argparse.RawDescriptionHelpFormatter)
    p.add_argument("program", choices=PROGRAMS)
    p.add_argument("--config", help="a JSON or YAML file of the keys of Config")
    p.add_argument("--set", action="append", default=[], metavar="KEY=VALUE", help="one text key of Config, over the file")
    p.add_argument("--domain")
    p.add_argument("--dry-run", action="store_true")
    p.add_argument("--test", action="store_true")
    p.add_argument("--sample-size", type=int)
    p.add_argument("--step", type=int, choices=(0, 1, 2), default=2)
    p.add_argument("--reset-domains", nargs="*")
    p.add_argument("--check-map", action="store_true")
    p.add_argument("--review-map", action="store_true")
    p.add_argument("--repair", action="store_true")
    return p


def main(args: list[str] | None = None, spark: SparkSession | None = None) -> int:
    a = parser().parse_args(args)
    config = files.load_config(Config, a.config)
    config = dataclasses.replace(config, **dict(x.split("=", 1) for x in a.set))
    models.log_to(config.log)
    PROGRAMS[a.program](spark or SparkSession.builder.appName("postloom").getOrCreate(), config, a)
    return 0


if __name__ == "__main__":
    sys.exit(main())
