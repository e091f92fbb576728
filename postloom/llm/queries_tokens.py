"""Queries of problems 8 and 9."""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession, functions as F

from ..session import table
from .mixture import mix, pack, shares
from .tokens import decode_ids, token_ids

#: Folder of the vocabulary files; a parameter of the environment, else where the image has them.
TOKENIZERS = os.environ.get("POSTLOOM_TOKENIZERS", "/opt/tokenizers")


#: The pattern that goes with the byte-level rank files. Fixed value.
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"


def _pattern() -> str:
    return PATTERN


def ids_of(docs: DataFrame, name: str = "byte_bpe_50k", keep: tuple[str, ...] = ()) -> DataFrame:
    return token_ids(docs, "doc_id", "text", f"{TOKENIZERS}/{name}.tiktoken", _pattern(), keep=keep)


def p8_ids(spark: SparkSession, d: str) -> DataFrame:
    return ids_of(table(spark, d, "documents"))


def p8_counts(spark: SparkSession, d: str) -> DataFrame:
    """Documents and tokens of each source."""
    ids = ids_of(table(spark, d, "documents"), keep=("source",))
    return ids.groupBy("source").agg(F.count("*").alias("documents"), F.sum(F.size("ids")).cast("bigint").alias("tokens"))


def p8_round_trip(spark: SparkSession, d: str) -> DataFrame:
    """doc_id and the text that its ids decode to."""
    return decode_ids(p8_ids(spark, d), "doc_id", "ids", f"{TOKENIZERS}/byte_bpe_50k.tiktoken", _pattern())


def _blocks(spark: SparkSession, d: str) -> DataFrame:
    return pack(ids_of(table(spark, d, "documents"), keep=("source",)))


def p9_mixture(spark: SparkSession, d: str) -> DataFrame:
    return mix(_blocks(spark, d), table(spark, d, "mix_targets"))


def p9_shares(spark: SparkSession, d: str) -> DataFrame:
    blocks = _blocks(spark, d)
    return shares(mix(blocks, table(spark, d, "mix_targets")), blocks, table(spark, d, "mix_targets"))


def p9_held(spark: SparkSession, d: str) -> DataFrame:
    """For each source of the targets: whether the share of its slots is the target to the slot (sources without documents give theirs to the
    others in proportion), and whether no block is used more than max_repeats times."""
    blocks, targets = _blocks(spark, d), table(spark, d, "mix_targets")
    mixture = mix(blocks, targets).groupBy("source", "block").agg(F.count("*").alias("uses")).groupBy("source").agg(F.sum("uses").alias("slots"), F.max("uses").alias("most"))
    had = blocks.select("source").distinct().withColumn("has", F.lit(True))
    j = targets.join(F.broadcast(had), "source", "left").join(F.broadcast(mixture), "source", "left").na.fill(0, ["slots", "most"])  # a row a source
    total = j.agg(F.sum("slots").alias("all"), F.sum(F.when(F.col("has"), F.col("target_share"))).alias("shares"))
    wanted = F.when(F.col("has"), F.col("all") * F.col("target_share") / F.col("shares")).otherwise(0)
    return j.crossJoin(F.broadcast(total)).select("source", (F.abs(F.col("slots") - wanted) <= 1).alias("share_met"), (F.col("most") <= F.col("max_repeats")).alias("repeats_held"))


QUERIES = {"p8_ids": p8_ids, "p8_counts": p8_counts, "p8_round_trip": p8_round_trip, "p9_mixture": p9_mixture, "p9_shares": p9_shares, "p9_held": p9_held}

#: What holds whatever the ids and the draw are; SQL has no tokenizer.
SQL = {
    "p8_round_trip": "select doc_id, coalesce(text, '') as text from documents",
    "p9_held": "select source, true as share_met, true as repeats_held from mix_targets",
}
