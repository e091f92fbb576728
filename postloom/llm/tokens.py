"""Token ids of a byte-level public vocabulary, by a monoid over pieces of text.

A text longer than a leaf is encoded in halves, recursively; two neighbours are joined by encoding a window at their boundary again. Why
that gives the ids of the whole: ids come from merges within the matches of a pattern that is scanned from left to right and never looks
back, so what follows a match's start depends on the text from there on alone. To the left, a match that ends before the last two of a
piece has seen all it looks at and stays; the window begins at the first that may change. To the right, once a match of the window ends
where a match of the right piece ended, all later matches agree; the window grows until one does. Decoding concatenates up the tree.
"""

from __future__ import annotations

import base64
import sys
import types
from bisect import bisect_left
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import accumulate, chain

import pandas as pd
import regex
from pyspark.sql import DataFrame, functions as F

#: Code points of a piece that is encoded directly: far below the length of usual texts, so that these go through the tree.
LEAF = 256
#: Matches whose ids are kept in a process.
_KEPT = 500_000


def _kept() -> dict:
    """What a process keeps from task to task. Functions are sent to executors whole, so their own globals last for one task."""
    return vars(sys.modules.setdefault("_postloom_kept", types.ModuleType("_postloom_kept")))


class _Ids(dict):
    """The ids of single matches of the pattern, each encoded once in a process."""

    def __init__(self, enc) -> None:
        super().__init__()
        self.enc = enc

    def __missing__(self, match: str) -> list[int]:
        if len(self) >= _KEPT:
            self.clear()
        ids = self.enc.encode_ordinary(match)
        if len(match) <= 64:
            self[match] = ids
        return ids


def encoder(path: str, pattern: str):
    """The tiktoken encoding of a rank file and the compiled pattern, made once in a process. The pattern has no groups."""
    import tiktoken

    kept = _kept()
    if (path, pattern) not in kept:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, open(path, "rb"))}
        enc = tiktoken.Encoding(path.rpartition("/")[2], pat_str=pattern, mergeable_ranks=ranks, special_tokens={})
        enc.ids_of_match = _Ids(enc)
        kept[path, pattern] = enc, regex.compile(pattern)
    return kept[path, pattern]


@dataclass
class Piece:
    """A stretch of text with the ends of its matches and their ids; text[:0] is the unit, join() the operation."""

    start: int
    end: int
    ends: list[int]
    ids: list[list[int]]


def _matches(text: str, start: int, end: int, pat) -> tuple[list[int], list[str]]:
    """The ends of the matches in text[start:end] and their texts."""
    found = pat.findall(text[start:end])
    ends = list(accumulate(map(len, found), initial=start))[1:]
    if (ends[-1] if ends else start) != end:  # something lies between matches
        spans = [m.span() for m in pat.finditer(text[start:end])]
        return [start + e for _, e in spans], [text[start + b : start + e] for b, e in spans]
    return ends, found


def _scan(text: str, start: int, end: int, enc, pat) -> Piece:
    ends, found = _matches(text, start, end, pat)
    return Piece(start, end, ends, list(map(enc.ids_of_match.__getitem__, found)))


def join(text: str, a: Piece, b: Piece, enc, pat, window: int = 24) -> Piece:
    """The piece of both stretches, which lie side by side."""
    if not a.ends or not b.ends:
        return b if not a.ends else a
    keep = max(0, len(a.ends) - 2)
    start = a.ends[keep - 1] if keep else a.start
    while True:
        stop = min(b.end, b.start + window)
        ends, found = _matches(text, start, stop, pat)
        if stop < b.end:  # what ends at the window's last two may look beyond it
            n = bisect_left(ends, stop - 1)
            ends, found = ends[:n], found[:n]
        for n, e in enumerate(ends):
            k = bisect_left(b.ends, e)
            if k < len(b.ends) and b.ends[k] == e:
                return Piece(a.start, b.end, a.ends[:keep] + ends[: n + 1] + b.ends[k + 1 :], a.ids[:keep] + list(map(enc.ids_of_match.__getitem__, found[: n + 1])) + b.ids[k + 1 :])
        if stop == b.end:
            return Piece(a.start, b.end, a.ends[:keep] + ends, a.ids[:keep] + list(map(enc.ids_of_match.__getitem__, found)))
        window *= 4


def encode(text: str | None, enc, pat, leaf: int = LEAF) -> list[int]:
    """The ids of a text; none for null and empty texts. Lone surrogates count as the replacement character."""
    if not text:
        return []
    if len(text) <= leaf:
        return enc.encode_ordinary(text)

    def tree(start: int, end: int) -> Piece:
        if end - start <= leaf:
            return _scan(text, start, end, enc, pat)
        mid = (start + end) // 2
        return join(text, tree(start, mid), tree(mid, end), enc, pat)

    return list(chain.from_iterable(tree(0, len(text)).ids))


def token_ids(df: DataFrame, id_col: str, text_col: str, path: str, pattern: str, leaf: int = LEAF, keep: tuple[str, ...] = ()) -> DataFrame:
    """id_col, the columns to keep, ids (array<int>) by the rank file at path, without special tokens: their strings in a text are ordinary
    text. Null and empty texts have an empty list. The columns kept pass through the one narrow step, so no join has to bring them back. The vocabulary is
    read on each executor from the path given; it isn't copied or broadcast."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        enc, pat = encoder(path, pattern)
        for batch in batches:
            out = batch.iloc[:, :-1].copy()
            out["ids"] = [encode(t, enc, pat, leaf) for t in batch.iloc[:, -1]]
            yield out

    lean = df.select(F.col(id_col), *keep, F.col(text_col).alias("_text"))
    kinds = dict(lean.dtypes)
    return lean.mapInPandas(run, ", ".join(f"`{c}` {kinds[c]}" for c in (id_col, *keep)) + ", ids array<int>")


def decode_ids(df: DataFrame, id_col: str, ids_col: str, path: str, pattern: str) -> DataFrame:
    """id_col, text: the texts of lists of ids. Bytes are put together before they are read as text, so ids that split a character are safe."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        enc, _ = encoder(path, pattern)
        for batch in batches:
            yield pd.DataFrame({id_col: batch.iloc[:, 0], "text": [None if ids is None else enc.decode_bytes(list(map(int, ids))).decode("utf-8", "replace") for ids in batch.iloc[:, 1]]})

    lean = df.select(F.col(id_col), F.col(ids_col))
    return lean.mapInPandas(run, f"`{id_col}` {dict(lean.dtypes)[id_col]}, text string")
