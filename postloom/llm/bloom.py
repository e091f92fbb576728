"""Bloom filters of sets of texts, sized by their number and built by a distributed aggregation."""

from __future__ import annotations

import math

import numpy as np
import xxhash
from pyspark.sql import DataFrame, functions as F

#: The largest filter that is broadcast: 2**30 bits are 128 MB.
MAX_LOG_BITS = 30
HASHES = 6


class Bloom:
    """Whether a text may be in the set; never wrong about one that is."""

    def __init__(self, bits: bytes) -> None:
        self.words = np.frombuffer(bits, dtype=np.uint64)
        self.mask = len(self.words) * 64 - 1

    def __contains__(self, key: str) -> bool:
        h = xxhash.xxh64_intdigest(key.encode(), seed=42)
        low, step = h & 0xFFFFFFFF, h >> 32 | 1
        for i in range(HASHES):
            p = (low + i * step) & self.mask
            if not int(self.words[p >> 6]) >> (p & 63) & 1:
                return False
        return True


def log_bits(n: int, per_key: int = 16, least: int = 13) -> int:
    """Bits as a power of two, at least per_key for each of n keys: with 16, below one false hit in 1,000."""
    return max(least, math.ceil(math.log2(max(n, 1) * per_key)))


def build(keys: DataFrame, strict: bool, per_key: int = 16) -> bytes:
    """The filter of the texts in the one column of keys, which may repeat. The number of keys is estimated within 2 %. A filter larger than
    MAX_LOG_BITS is an error if strict; else it is made that large, which costs more false hits: for filters that only save work."""
    column = keys.columns[0]
    n = int(keys.agg(F.approx_count_distinct(column, 0.02)).first()[0] * 1.05)
    size = log_bits(n, per_key)
    if size > MAX_LOG_BITS:
        if strict:
            raise ValueError(f"{n} keys need a filter of 2**{size} bits, more than is broadcast")
        size = MAX_LOG_BITS
    h = F.xxhash64(column)
    low, step = h.bitwiseAND(F.lit(0xFFFFFFFF)), F.shiftrightunsigned(h, 32).bitwiseOR(F.lit(1))
    mask = F.lit((1 << size) - 1).cast("bigint")
    at = keys.where(F.col(column).isNotNull()).select(F.explode(F.array(*((low + i * step).bitwiseAND(mask) for i in range(HASHES)))).alias("at"))
    words = at.select(F.shiftright("at", 6).alias("word"), F.expr("shiftleft(1L, cast(at & 63 as int))").alias("bit")).groupBy("word").agg(F.bit_or("bit").alias("bits")).toArrow()
    out = np.zeros(1 << (size - 6), dtype=np.int64)
    out[words["word"].to_numpy()] = words["bits"].to_numpy()
    return out.tobytes()
