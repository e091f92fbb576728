"""Capping the records of each contributor, keeping the best.

Mergeable bounded heaps: the aggregate collect_top_k of Spark keeps, per contributor, a heap of the cap's best (score, id) pairs. It is
filled map-side, merged over groups of tasks, then over the whole, so that no merge gets more than the cap's pairs of about a thousand others. Contributors
at or below the cap lose nothing and leave the plan there; of the others only the worst pair kept is needed, against which the full records
are compared, those of hot contributors over as many salts as their number asks for.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.internal import InternalFunction

from .salted import HOT, lookup

#: Groups of tasks whose heaps are merged first: a thousand tasks to a group for a million tasks.
GROUPS = 1024


def contributor(c: Column) -> Column:
    """Trimmed and lower-cased; null for null, blank and unknown, which aren't contributors."""
    t = F.lower(F.btrim(c, F.lit(" \t\n\r\x0b\x0c 　﻿")))
    return F.when(~t.isin("", "unknown"), t)


def plain_score(c: Column) -> Column:
    """A plain decimal number from 0 to 1; -1 for anything else, which ranks below 0."""
    t = F.btrim(c, F.lit(" \t\n\r\x0b\x0c "))
    v = F.when(t.rlike(r"^[0-9]+(\.[0-9]+)?$"), t.try_cast("double"))
    return F.coalesce(F.when(v.between(0, 1), v), F.lit(-1.0))


def _cuts(df: DataFrame, cap: int) -> DataFrame:
    """who, n, cut: the number of records and the worst pair kept, of each contributor with more records than the cap."""
    pair = F.struct("score", F.negative("id").alias("low"))
    # collect_top_k gives the k largest; its buffer is a heap of at most k pairs
    part = df.groupBy("who", F.pmod(F.spark_partition_id(), F.lit(GROUPS)).alias("g")).agg(InternalFunction.collect_top_k(pair, cap, False).alias("best"), F.count("*").alias("n"))
    each = part.select("who", F.posexplode("best").alias("k", "pair"), F.col("n"))
    top = each.groupBy("who").agg(InternalFunction.collect_top_k(F.col("pair"), cap, False).alias("best"), F.sum(F.when(F.col("k") == 0, F.col("n"))).alias("n"))
    return top.where(F.col("n") > cap).select("who", "n", F.element_at(F.sort_array("best"), 1).alias("cut"))


def cap_records(df: DataFrame, id_col: str, who: Column, score: Column, cap: int, keep: bool = True) -> DataFrame:
    """The records kept (or dropped, with keep=False) when each contributor keeps at most cap: those of the highest score, among equals
    of the smaller id. id_col is unique. Records whose contributor is null are all kept. Columns of df pass through under any name."""
    if cap < 1:
        raise ValueError("cap must be at least 1")
    number = F.col(id_col).cast("bigint")
    lean = df.select(who.alias("who"), score.alias("score"), number.alias("id")).where("who is not null")
    rows = df.select(who.alias("who"), F.struct(score.alias("score"), F.negative(number).alias("low")).alias("mine"), number.alias("id"), F.struct("*").alias("row"))
    if not keep:
        rows = rows.where("who is not null")
    j = lookup(rows, _cuts(lean, cap), ["who"], "n", HOT, "left" if keep else "inner", by="id")
    return j.where((F.col("cut").isNull() | (F.col("mine") >= F.col("cut"))) if keep else F.col("mine") < F.col("cut")).select("row.*")


def largest_contributors(df: DataFrame, who: Column, top: int = 20) -> DataFrame:
    """contributor, records, share of all records: the top contributors."""
    counts = df.select(who.alias("contributor")).groupBy("contributor").agg(F.count("*").alias("records"))
    total = df.agg(F.count("*").alias("total"))
    return counts.where("contributor is not null").orderBy(F.desc("records"), "contributor").limit(top).crossJoin(F.broadcast(total)).select("contributor", "records", (F.col("records") / F.col("total")).alias("share"))
