"""Mixing sources to target shares of the total size in tokens.

Each source's token ids, its documents in pseudorandom order, are packed end to end into blocks of fixed length; the last block of a source
may be short. The output has shards of a fixed number of slots. Each shard draws, on an executor and seeded by its number, how many of its
slots go to each source from a multinomial of the target shares. A source's draws over all shards are numbered by prefix sums in two steps.

The draws' totals differ from the targets by noise. A source's draws beyond its target are given away: not its last ones, but those that a keyed
permutation of its draws puts beyond the target, so that every shard gives up its part. They are numbered over all sources, permuted again, and fill
the sources that drew too few. So totals are the targets to the block, and no block is used more often than allowed.

Slot k of a source is use k div N of the block that a keyed permutation of its N blocks gives for k mod N. Blocks are joined by their index. Only vectors
with one entry a source are on the driver; what grows with shards or blocks is rows.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window, functions as F

from ..session import discard, written

BLOCK = 256
SHARD = 512
#: Tokens of a range of documents that one task puts in order (16 MB of ids).
RANGE = 1 << 22
#: More sources than this aren't sources; see mix().
MAX_SOURCES = 100_000
#: Shards whose draws one task numbers.
GROUP = 4096


def pack(tokens: DataFrame, seed: int = 7, block: int = BLOCK, range_tokens: int = RANGE) -> DataFrame:
    """source, block, start, ids, docs: the blocks of each source from rows (doc_id, source, ids), as a written table. Documents without ids or
    source have none.

    A source's order is by a hash of the id. Offsets are prefix sums in two steps, within ranges of the hash and over the ranges' sums; a source
    has as many ranges as its size asks for, so that one that holds most of the rows is spread over tasks.
    """
    # the ids are made once; sizes and ranges read the other columns alone
    docs = written(tokens.where(F.col("source").isNotNull() & (F.size("ids") > 0)).select("doc_id", "source", F.size("ids").alias("n"), F.xxhash64("doc_id", F.lit(seed)).alias("h"), "ids"))
    ranges = docs.groupBy("source").agg(F.ceil(F.sum("n") / range_tokens).alias("ranges"))  # a row a source
    unit = F.shiftrightunsigned("h", 11) / float(1 << 53)
    placed = docs.join(F.broadcast(_bounded(ranges)), "source").withColumn("range", F.floor(unit * F.col("ranges"))).drop("ranges")
    sums = placed.groupBy("source", "range").agg(F.sum("n").alias("size"))
    before = Window.partitionBy("source").orderBy("range").rowsBetween(Window.unboundedPreceding, -1)  # a row for RANGE tokens
    bases = sums.select("source", "range", F.coalesce(F.sum("size").over(before), F.lit(0)).alias("base"))
    within = Window.partitionBy("source", "range").orderBy("h", "doc_id").rowsBetween(Window.unboundedPreceding, -1)
    placed = placed.withColumn("inner", F.coalesce(F.sum("n").over(within), F.lit(0))).join(bases, ["source", "range"]).withColumn("start", F.col("base") + F.col("inner"))
    first, last = F.floor(F.col("start") / block), F.floor((F.col("start") + F.col("n") - 1) / block)
    pieces = placed.select("source", "doc_id", "ids", "start", F.explode(F.sequence(first, last)).alias("block"))
    low = F.greatest(F.col("block") * block - F.col("start"), F.lit(0)).cast("int")
    high = F.least((F.col("block") + 1) * block - F.col("start"), F.size("ids")).cast("int")
    pieces = pieces.select("source", "block", "doc_id", (F.col("start") + low).alias("at"), F.slice("ids", low + 1, high - low).alias("ids"))
    parts = F.sort_array(F.collect_list(F.struct("at", "doc_id", "ids")))  # no more pieces than ids in a block
    blocks = pieces.groupBy("source", "block").agg(parts.alias("p")).select("source", "block", F.size(F.flatten("p.ids")).cast("bigint").alias("tokens"), F.flatten("p.ids").alias("ids"), F.col("p.doc_id").alias("docs"))
    made = written(blocks)
    discard(docs)
    return made


def _bounded(by_source: DataFrame) -> DataFrame:
    """The same rows, one a source, with an error beyond MAX_SOURCES."""
    rows = by_source.take(MAX_SOURCES + 1)
    if len(rows) > MAX_SOURCES:
        raise ValueError(f"more than {MAX_SOURCES} sources")
    return by_source.sparkSession.createDataFrame(rows, by_source.schema)


def _permuted(x: np.ndarray, n: int, key: int) -> np.ndarray:
    """A bijection of 0..n-1: a Feistel network on the next even number of bits, walked until within."""
    half = max(1, math.ceil(math.log2(max(n, 2)) / 2))
    mask = np.uint64((1 << half) - 1)
    shift = np.uint64(half)
    out = x.astype(np.uint64)
    todo = np.ones(len(out), dtype=bool)
    while todo.any():
        v = out[todo]
        left, right = v >> shift, v & mask
        for r in range(4):
            f = (right * np.uint64(0x9E3779B97F4A7C15) + np.uint64((key * 0x2545F4914F6CDD1D + r * 0xBF58476D1CE4E5B9) & 0xFFFFFFFFFFFFFFFF)) & np.uint64(0xFFFFFFFFFFFFFFFF)
            f ^= f >> np.uint64(29)
            f = (f * np.uint64(0x94D049BB133111EB)) >> np.uint64(32)
            left, right = right, (left ^ f) & mask
        out[todo] = (left << shift) | right
        todo = out >= n
    return out.astype(np.int64)


@dataclass(frozen=True)
class Plan:
    """What the mixture takes, one entry a source: names, shares of the draw, blocks, and slots wanted in all."""

    names: list[str]
    p: np.ndarray
    blocks: np.ndarray
    wanted: np.ndarray

    @property
    def slots(self) -> int:
        return int(self.wanted.sum())


def plan(sizes: dict[str, int], targets: dict[str, tuple[float, int]]) -> Plan:
    """sizes: blocks of each source; targets: share and highest number of uses.

    Shares of sources without blocks go to the others in proportion. The number of slots is the largest at which no source needs a block
    more often than allowed; the targets are rounded to whole slots.
    """
    names = sorted(s for s in targets if sizes.get(s, 0) > 0 and targets[s][0] > 0)
    if not names:
        return Plan([], *(np.zeros(0, dtype=t) for t in (float, np.int64, np.int64)))
    p = np.array([targets[s][0] for s in names])
    p = p / p.sum()
    blocks = np.array([sizes[s] for s in names], dtype=np.int64)
    room = blocks * np.array([targets[s][1] for s in names], dtype=np.int64)
    slots = int(np.floor((room / p).min()))
    wanted = np.floor(p * slots).astype(np.int64)
    wanted[np.argsort(-(p * slots - wanted), kind="stable")[: slots - wanted.sum()]] += 1
    return Plan(names, p, blocks, np.minimum(wanted, room))


def draw(shard: int, slots: int, p: np.ndarray, seed: int) -> np.ndarray:
    """How many of a shard's slots each source gets."""
    return np.random.default_rng((seed, shard)).multinomial(slots, p)


def settle(k: np.ndarray, x: np.ndarray, drawn: np.ndarray, wanted: np.ndarray, seed: int) -> tuple[np.ndarray, np.ndarray]:
    """(source, number) after settling of the draws numbered x of the sources k, for the totals drawn and wanted."""
    surplus, lack = np.maximum(drawn - wanted, 0), np.maximum(wanted - drawn, 0)
    source, number = k.copy(), x.copy()
    first, ends = np.cumsum(surplus) - surplus, np.cumsum(lack)
    for s in np.unique(k[surplus[k] > 0]):
        at = np.flatnonzero(k == s)
        y = _permuted(x[at], int(drawn[s]), seed * 31 + int(s))
        number[at] = y
        over = at[y >= wanted[s]]
        j = _permuted(number[over] - wanted[s] + first[s], int(surplus.sum()), seed * 37)
        to = np.searchsorted(ends, j, side="right")
        source[over] = to
        number[over] = drawn[to] + j - (ends - lack)[to]
    return source, number


def mix(blocks: DataFrame, targets: DataFrame, seed: int = 7, shard: int = SHARD, group: int = GROUP) -> DataFrame:
    """shard, source, slot, use, block, tokens, ids, docs: the mixture of pack()'s blocks. slot numbers the uses of a source; no block is used
    more than max_repeats times, and each source has its share of the slots to the slot. targets has a row for each source: source, target_share, max_repeats; of more than
    MAX_SOURCES rows it raises. No blocks or no targets give no rows."""
    spark = blocks.sparkSession
    asked = targets.where("source is not null").take(MAX_SOURCES + 1)
    if len(asked) > MAX_SOURCES:
        raise ValueError(f"more than {MAX_SOURCES} sources")
    wanted = {r.source: (r.target_share or 0.0, r.max_repeats or 0) for r in asked}
    sizes = {r.source: r.n for r in blocks.where(F.col("source").isin(list(wanted))).groupBy("source").agg(F.count("*").alias("n")).collect()}
    made = plan(sizes, wanted)
    schema = "shard bigint, source string, slot bigint, use bigint, block bigint"
    if not made.slots:
        slots = spark.createDataFrame([], schema)
    else:
        draws = _draws(spark, made, seed, shard, group)
        drawn = np.zeros(len(made.names), dtype=np.int64)
        for r in draws.groupBy("k").agg(F.sum("n").alias("n")).collect():
            drawn[r.k] = r.n

        def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            names = np.array(made.names, dtype=object)
            for batch in batches:
                n = batch["n"].to_numpy()
                k = np.repeat(batch["k"].to_numpy(), n)
                x = np.repeat(batch["begin"].to_numpy() - (np.cumsum(n) - n), n) + np.arange(n.sum())
                source, number = settle(k, x, drawn, made.wanted, seed)
                of = made.blocks[source]
                use, i = number // of, number % of
                block = np.empty(len(x), dtype=np.int64)
                for s, u in set(zip(source.tolist(), use.tolist())):
                    at = (source == s) & (use == u)
                    block[at] = _permuted(i[at], int(of[at][0]), seed * 1_000_003 + s * 1009 + u)
                yield pd.DataFrame({"shard": np.repeat(batch["shard"].to_numpy(), n), "source": names[source], "slot": number, "use": use, "block": block})

        slots = draws.where("n > 0").select("shard", "k", "begin", "n").mapInPandas(run, schema)
    return slots.join(blocks, ["source", "block"]).select("shard", "source", "slot", "use", "block", "tokens", "ids", "docs")


def _draws(spark, made: Plan, seed: int, shard: int, group: int) -> DataFrame:
    """shard, k, n, begin: each shard's draws of source number k, begin being those of the shards before. A written table."""
    shards = -(-made.slots // shard)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            ids = batch.iloc[:, 0].to_numpy()
            counts = [draw(int(i), min(shard, made.slots - int(i) * shard), made.p, seed) for i in ids]
            n = len(made.names)
            yield pd.DataFrame({"shard": np.repeat(ids, n), "k": np.tile(np.arange(n), len(ids)), "n": np.concatenate(counts) if counts else []})

    tasks = max(1, min(shards // 256, spark.sparkContext.defaultParallelism * 8))
    counts = spark.range(0, shards, 1, tasks).mapInPandas(run, "shard bigint, k int, n bigint").withColumn("g", F.floor(F.col("shard") / group))
    sums = counts.groupBy("k", "g").agg(F.sum("n").alias("size"))
    before = lambda *keys: Window.partitionBy(*keys[:-1]).orderBy(keys[-1]).rowsBetween(Window.unboundedPreceding, -1)
    bases = sums.select("k", "g", F.coalesce(F.sum("size").over(before("k", "g")), F.lit(0)).alias("base"))
    inner = counts.withColumn("inner", F.coalesce(F.sum("n").over(before("k", "g", "shard")), F.lit(0)))
    return written(inner.join(bases, ["k", "g"]).select("shard", "k", "n", (F.col("base") + F.col("inner")).alias("begin")))


def shares(mixture: DataFrame, blocks: DataFrame, targets: DataFrame) -> DataFrame:
    """source, target_share, actual_share, tokens, available, most_uses, max_repeats of each source of targets, also of those that have no
    documents, whose share is 0."""
    used = mixture.groupBy("source").agg(F.sum("tokens").alias("tokens"), (F.max("use") + 1).alias("most_uses"))
    had = blocks.groupBy("source").agg(F.sum("tokens").alias("available"))
    total = used.agg(F.sum("tokens").alias("total"))
    j = targets.join(used, "source", "left").join(had, "source", "left").crossJoin(F.broadcast(total))  # one row
    return j.select(
        "source", "target_share", F.coalesce(F.col("tokens") / F.col("total"), F.lit(0.0)).alias("actual_share"), F.coalesce("tokens", F.lit(0)).alias("tokens"),
        F.coalesce("available", F.lit(0)).alias("available"), F.coalesce("most_uses", F.lit(0)).alias("most_uses"), F.col("max_repeats").cast("bigint").alias("max_repeats"),
    )
