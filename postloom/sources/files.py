"""Readers and writers of the corpus' files: CSV, JSON maps, JSON lines, partitioned checkpoints, configurations and text reports."""

from __future__ import annotations

import dataclasses
import json
import logging
from pathlib import Path
from typing import Any

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession, Window, functions as F, types as T

from ..session import has_path

LOG = logging.getLogger("postloom")
#: More known keys than this aren't listed by append_by_key().
MAX_KEYS = 10_000

POST_FIELDS = tuple(
    """audience_room_id audience_room_name platform profile_id post_id post_text post_date post_url num_likes num_comments num_shares subreddit label_useful label_personal label_off_domain label_low_content
    label_generic_advice label_repost label_promo author_name author_headline author_profile_url share_audience raw_post_json""".split()
)


def text_schema(fields: tuple[str, ...]) -> T.StructType:
    return T.StructType([T.StructField(f, T.StringType()) for f in fields])


def read_csv(spark: SparkSession, path: str, fields: tuple[str, ...] = POST_FIELDS, line_breaks: bool = True) -> DataFrame:
    """CSV files with a header and fields of any length, all columns text by the names in the header; rows that are too short have nulls. Nothing is
    inferred, so the files are read once.

    With quoted line breaks a file can't be split and is one task: give an export in parts, or convert() it once. Where there are none,
    line_breaks=False lets files be split."""
    form = dict(header=True, quote='"', escape='"', multiLine=line_breaks)
    header = spark.read.csv(path, enforceSchema=False, inferSchema=False, **form)
    have = [f for f in fields if f in header.columns]
    return spark.read.schema(text_schema(tuple(header.columns))).csv(path, mode="PERMISSIVE", maxCharsPerColumn=-1, **form).select(*have)


def convert(spark: SparkSession, csv: str, parquet: str, fields: tuple[str, ...] = POST_FIELDS, files_of: int = 1_000_000) -> DataFrame:
    """The rows of CSV files with their arrival order, written once as Parquet that every later run can split and read by column."""
    in_arrival_order(spark, csv, fields).write.mode("overwrite").option("maxRecordsPerFile", files_of).parquet(parquet)
    return spark.read.parquet(parquet)


def with_arrival(df: DataFrame) -> DataFrame:
    """With idx in the order of the files' rows: increasing, unique, not dense; no shuffle. Columns whose names begin with _ are left out."""
    return df.select(F.monotonically_increasing_id().alias("idx"), *(c for c in df.columns if not c.startswith("_")))


def in_arrival_order(spark: SparkSession, path: str, fields: tuple[str, ...] = POST_FIELDS) -> DataFrame:
    """read_csv() with idx as the place of a row over all files, in the order of the files' names: 0, 1, 2 and so on. Splits are counted, and what
    lies before each is added to a row's place in its split; there are as many sums as splits."""
    split = F.struct(F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("start"))
    rows = read_csv(spark, path, fields)
    raw = rows.select(split.alias("split"), F.monotonically_increasing_id().alias("at"), *rows.columns)
    sums = raw.groupBy("split").agg(F.count("*").alias("n"), F.min("at").alias("first"))
    before = Window.orderBy("split").rowsBetween(Window.unboundedPreceding, -1)  # a row a split
    bases = sums.select("split", (F.coalesce(F.sum("n").over(before), F.lit(0)) - F.col("first")).alias("base"))
    return raw.join(F.broadcast(bases), "split").select((F.col("at") + F.col("base")).alias("idx"), *rows.columns)


def present(spark: SparkSession, path: str, needed: bool = False) -> bool:
    """Whether there is something at a path; if it is needed and absent, an error that names it."""
    found = has_path(spark, path)
    if needed and not found:
        raise FileNotFoundError(path)
    if not found:
        LOG.warning("absent: %s", path)
    return found


def write_csv(df: DataFrame, path: str, quote_all: bool = False, mode: str = "overwrite") -> None:
    df.write.mode(mode).csv(path, header=True, quote='"', escape='"', quoteAll=quote_all)


def append_by_key(df: DataFrame, path: str, key: str) -> list[str]:
    """Appends, and gives (and logs) the keys that were there before. Keys are few by the nature of the table, as domains are; with more
    than MAX_KEYS known ones it raises before anything is written."""
    try:
        old = df.sparkSession.read.parquet(path).select(key).distinct()
        known = [r[0] for r in df.select(key).distinct().join(old, key, "left_semi").take(MAX_KEYS + 1)]
    except AnalysisException:
        known = []
    if len(known) > MAX_KEYS:
        raise ValueError(f"more than {MAX_KEYS} values of {key} are in {path} already: it isn't a key of few values")
    if known:
        LOG.warning("already in %s: %s", path, ", ".join(map(str, sorted(known, key=str))))
    df.write.mode("append").parquet(path)
    return known


def read_map(spark: SparkSession, path: str) -> DataFrame:
    """domain, raw_label, canonical from JSON files of {domain: {raw: canonical}}: one object a file, indented or not, or an object a line
    as write_map() has it. Text that isn't such an object gives no rows."""
    # within an indented object no line begins with a brace, and strings hold no line breaks
    text = spark.read.text(path, wholetext=True).select(F.explode(F.split("value", r"\n(?=\{)")).alias("value"))
    parsed = text.select(F.from_json("value", "map<string,map<string,string>>").alias("m"))
    return parsed.select(F.explode("m").alias("domain", "own")).select("domain", F.explode("own").alias("raw_label", "canonical"))


def write_map(topic_map: DataFrame, path: str, chunks: int = 64) -> None:
    """Lines of {domain: {raw: canonical}}, which read_map() reads back. A domain's labels are spread over some lines, so that no line grows
    with the domain; of repeated labels the smallest canonical is kept. Rows whose domain or raw label is null have no place in a map."""
    rows = topic_map.where("domain is not null and raw_label is not null").groupBy("domain", "raw_label").agg(F.min("canonical").alias("canonical"))
    lines = rows.groupBy("domain", F.pmod(F.xxhash64("raw_label"), F.lit(chunks)).alias("chunk")).agg(F.map_from_entries(F.collect_list(F.struct("raw_label", "canonical"))).alias("own"))
    lines.select(F.to_json(F.create_map("domain", "own")).alias("value")).write.mode("overwrite").text(path)


def read_progress(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """An append-only table of JSON lines; an empty one where there is none yet."""
    try:
        return spark.read.schema(schema).json(path)
    except AnalysisException:
        return spark.createDataFrame([], schema)


def append_progress(df: DataFrame, path: str) -> None:
    """Appends without the columns whose names begin with _."""
    df.select(*(c for c in df.columns if not c.startswith("_"))).write.mode("append").json(path)


def write_domains(df: DataFrame, path: str, domain: str = "domain") -> None:
    """A table partitioned by domain, of which only the domains in df are replaced: a checkpoint by domain."""
    df.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(domain).parquet(path)


def reset_domains(spark: SparkSession, path: str, domains: list[str], to: str) -> None:
    """The table at path without some domains, written to another place."""
    spark.read.parquet(path).where(~F.col("domain").isin(*domains)).write.mode("overwrite").partitionBy("domain").parquet(to)


def load_config(kind: type, path: str | None = None) -> Any:
    """A dataclass of defaults, overlaid with the keys of a JSON or YAML file; unknown keys are left out, a missing file gives the defaults."""
    found: dict = {}
    if path and Path(path).exists():
        text = Path(path).read_text(encoding="utf-8")
        try:
            found = json.loads(text)
        except ValueError:
            import yaml

            found = yaml.safe_load(text) or {}
    names = {f.name for f in dataclasses.fields(kind)}
    return kind(**{k: v for k, v in found.items() if k in names})


def report(title: str, tables: dict[str, DataFrame], rows: int = 50) -> str:
    """A text of small tables; each shows at most so many rows."""
    lines = [title, "=" * len(title)]
    for name, df in tables.items():
        shown = df.limit(rows).toPandas()
        lines += ["", name, "-" * len(name), shown.to_string(index=False) if len(shown) else "(none)"]
    return "\n".join(lines) + "\n"
