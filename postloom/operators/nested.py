"""Nested JSON records into related flat tables, by shared inlining.

The corpus' schema graph has a node for each label under which objects or arrays are held and an edge for each parent label.
A node becomes a table when it is the root, repeated (elements of an array, entries of a keyed object), shared (held under
several labels) or recursive; every other node is inlined into the table of its holder as dotted columns. Rows get a number within
their record; (record, row) is the primary key and (record, parent_row) the foreign key to the row that encloses it.

Two passes read the corpus, both narrow: the first sums up the graph (its size is that of the set of field names, not of the
data), the second shreds. Only the tables asked for leave the second pass.
"""

from __future__ import annotations

import json
import re
from collections.abc import Iterable, Iterator
from dataclasses import dataclass, field
from json.decoder import scanstring

import pandas as pd
from pyspark.sql import DataFrame, functions as F

ROOT = "$"
#: More labels than this aren't a schema: the keys of some object are data, which keyed() did not recognise.
MAX_LABELS = 20_000

ROWS = (
    "record bigint, row bigint, table string, parent_row bigint, parent_table string, ordinal int, map_key string, "
    "entity string, entity_key string, cols map<string,string>"
)


def parse(text: str | None):
    """The record as Python objects; None where the text isn't valid JSON. A record stored as a JSON string or in lists of one
    element, however often, is unwrapped; any other list or a scalar has no fields and gives None. NaN and Infinity aren't JSON."""
    if text is None:
        return None
    try:
        value = decode(text)
        while True:
            if isinstance(value, str):
                value = decode(value)
            elif isinstance(value, list) and len(value) == 1:
                value = value[0]
            else:
                break
    except ValueError:
        return None
    return value if isinstance(value, dict) else None


def _no_constant(name: str):
    raise ValueError(name)


class _Decoder(json.JSONDecoder):
    """Strict JSON; can be sent to executors."""

    def __init__(self) -> None:
        super().__init__(parse_constant=_no_constant)

    def __reduce__(self):
        return _Decoder, ()


_DECODER = _Decoder()
_BLANK = re.compile(r"[ \t\n\r]*")
_SCALAR = re.compile(r"(-?(?:0|[1-9][0-9]*))(\.[0-9]+)?([eE][-+]?[0-9]+)?|true|false|null")
_WORDS = {"true": True, "false": False, "null": None}


def decode(text: str):
    """The value of a JSON text of any depth; ValueError where it isn't valid."""
    try:
        return _DECODER.decode(text)
    except RecursionError:
        return decode_deep(text)


def decode_deep(text: str):
    """decode() with a stack of its own instead of the interpreter's."""
    open_: list = []  # containers being filled, each with the key its next member gets
    at, expect = _BLANK.match(text).end(), "value"
    while True:
        c = text[at : at + 1]
        if expect != "value" and c in ("}", "]"):  # the end of a container
            if not open_ or (c == "}") != isinstance(open_[-1][0], dict) or expect == "key":
                raise ValueError(at)
            value, at = open_.pop()[0], at + 1
        elif expect in ("key", "first key"):
            if c != '"':
                raise ValueError(at)
            key, at = scanstring(text, at + 1, True)
            at = _BLANK.match(text, at).end()
            if text[at : at + 1] != ":":
                raise ValueError(at)
            open_[-1][1], at, expect = key, _BLANK.match(text, at + 1).end(), "value"
            continue
        elif c in ("{", "["):
            open_.append([{} if c == "{" else [], None])
            at, expect = _BLANK.match(text, at + 1).end(), "first key" if c == "{" else "first"
            continue
        elif c == '"':
            value, at = scanstring(text, at + 1, True)
        elif m := _SCALAR.match(text, at):
            value = _WORDS[m[0]] if m[0] in _WORDS else float(m[0]) if m[2] or m[3] else int(m[1])
            at = m.end()
        else:
            raise ValueError(at)
        at = _BLANK.match(text, at).end()
        if not open_:
            if at != len(text):
                raise ValueError(at)
            return value
        holder, key = open_[-1]
        if isinstance(holder, dict):
            holder[key] = value
        else:
            holder.append(value)
        c = text[at : at + 1]
        if c == ",":
            at, expect = _BLANK.match(text, at + 1).end(), "key" if isinstance(holder, dict) else "value"
        elif c in ("}", "]"):
            expect = "end"
        else:
            raise ValueError(at)


def scalar(value) -> str | None:
    """Text of a scalar: numbers in plain decimal, booleans in lower case."""
    if value is None or isinstance(value, str):
        return value
    if isinstance(value, bool):
        return "true" if value else "false"
    if isinstance(value, float):
        return str(int(value)) if value.is_integer() and abs(value) < 1e18 else repr(value)
    return str(value)


def keyed(obj: dict) -> bool:
    """Whether the keys of an object are data, not field names: all members are objects (some may be null), and each key has a
    digit or is repeated as a scalar within its member. Such an object is a repeated element with the key as a column."""
    members = [(k, v) for k, v in obj.items() if v is not None]
    if not members:
        return False
    for k, v in members:
        if not isinstance(v, dict):
            return False
        if not any(c.isdigit() for c in k) and k not in v.values():
            return False
    return True


@dataclass(frozen=True)
class Entity:
    """Rows of several tables that are one kind of thing, as a comment in several layouts.

    edges: (parent label, label), "*" for any parent. key: columns with its id, "@key" being its key in a keyed object; a row without any
    isn't of the entity. unless: (column, value) of the row above that rules it out.
    """

    name: str
    edges: tuple[tuple[str, str], ...]
    key: tuple[str, ...]
    unless: tuple[tuple[str, str], ...] = ()


@dataclass
class TablePlan:
    tables: dict[str, str] = field(default_factory=dict)  #: label: why it has a table
    inlined: dict[str, str] = field(default_factory=dict)  #: label: label of its only holder


def _edges(value: dict, found: dict) -> None:
    """Adds (parent, label, repeated) of one record to found; without recursion, for records of any depth."""
    stack = [(ROOT, value)]
    while stack:
        label, obj = stack.pop()
        for k, v in obj.items():
            if isinstance(v, dict):
                rep = keyed(v)
                found[(label, k, rep)] = found.get((label, k, rep), 0) + 1
                if rep:
                    stack.extend((k, x) for x in v.values() if x is not None)
                else:
                    stack.append((k, v))
            elif isinstance(v, list):
                found[(label, k, True)] = found.get((label, k, True), 0) + 1
                todo = list(v)
                while todo:
                    x = todo.pop()
                    if isinstance(x, dict):
                        stack.append((k, x))
                    elif isinstance(x, list):
                        todo.extend(x)


def schema_graph(df: DataFrame, json_col: str) -> DataFrame:
    """parent, label, repeated, n: the edges of the corpus' schema graph with their number of occurrences. Records that aren't valid
    JSON add nothing; an empty table gives an empty graph."""

    def sum_up(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        found: dict = {}
        for batch in batches:
            for text in batch.iloc[:, 0]:
                if (value := parse(text)) is not None:
                    _edges(value, found)
        if found:
            yield pd.DataFrame([(*k, n) for k, n in found.items()], columns=["parent", "label", "repeated", "n"])

    parts = df.select(json_col).mapInPandas(sum_up, "parent string, label string, repeated boolean, n bigint")
    return parts.groupBy("parent", "label", "repeated").agg(F.sum("n").alias("n"))


def plan_tables(edges: Iterable[tuple[str, str, bool]]) -> TablePlan:
    """Shared inlining over the edges (parent, label, repeated)."""
    holders: dict[str, set[str]] = {}
    repeated: set[str] = set()
    for parent, label, rep in edges:
        holders.setdefault(label, set()).add(parent)
        if rep:
            repeated.add(label)
    if len(holders) > MAX_LABELS:
        raise ValueError(f"{len(holders)} labels: the keys of some object are data; see keyed()")
    plan = TablePlan(tables={ROOT: "root"})
    for label in sorted(holders):
        above, todo = set(), list(holders[label])
        while todo:
            if (p := todo.pop()) not in above:
                above.add(p)
                todo.extend(holders.get(p, ()))
        if label in above:
            plan.tables[label] = "recursive"
        elif label in repeated:
            plan.tables[label] = "repeated"
        elif len(holders[label]) > 1:
            plan.tables[label] = "shared"
        else:
            plan.inlined[label] = next(iter(holders[label]))
    return plan


def plan_for(df: DataFrame, json_col: str) -> TablePlan:
    """The plan for a corpus. What is collected is the set of field names, with an error if it is too large to be one."""
    edges = schema_graph(df, json_col).take(4 * MAX_LABELS + 1)
    if len(edges) > 4 * MAX_LABELS:
        raise ValueError(f"more than {4 * MAX_LABELS} edges: the keys of some object are data; see keyed()")
    return plan_tables((r.parent, r.label, r.repeated) for r in edges)


def _rows(value: dict, plan: TablePlan, entities: tuple[Entity, ...]) -> Iterator[tuple]:
    """All rows of one record, parents first. A stack keeps what is open, so depth has no bound."""
    by_edge = {}
    for e in entities:
        for edge in e.edges:
            by_edge[edge] = e
    number = 0
    # parent: (row, cols, table); kept: (row, table) of the nearest enclosing row of an entity
    stack: list = [(ROOT, ROOT, value, None, 0, None, None)]
    while stack:
        label, above, obj, parent, ordinal, key, kept = stack.pop()
        row, number = number, number + 1
        cols: dict[str, str | None] = {}
        below: list = []
        todo = [("", label, obj)]
        while todo:
            prefix, at, o = todo.pop()
            if not isinstance(o, dict):
                cols["value"] = scalar(o)
                continue
            for k, v in o.items():
                if isinstance(v, dict):
                    if keyed(v):
                        below.extend((k, at, x, i, mk) for i, (mk, x) in enumerate(v.items()) if x is not None)
                    elif k in plan.tables:
                        below.append((k, at, v, 0, None))
                    else:
                        todo.append((f"{prefix}{k}.", k, v))
                elif isinstance(v, list):
                    flat, i = list(reversed(v)), 0
                    while flat:
                        x = flat.pop()
                        if isinstance(x, list):
                            flat.extend(reversed(x))
                        else:
                            if x is not None:
                                below.append((k, at, x, i, None))
                            i += 1
                else:
                    cols[prefix + k] = scalar(v)
        e = by_edge.get((above, label)) or by_edge.get(("*", label))
        own = next((x for k in e.key if (x := key if k == "@key" else cols.get(k)) is not None), None) if e else None
        if own is not None and parent and any(parent[1].get(c) == v for c, v in e.unless):
            own = None
        yield row, label, parent and parent[0], parent and parent[2], ordinal, key, None if own is None else e.name, own, cols, kept
        if own is not None:
            kept = row, label
        here = row, cols, label
        for k, at, x, i, mk in reversed(below):
            stack.append((k, at, x, here, i, mk, kept))


def shred(
    df: DataFrame, id_col: str, json_col: str, plan: TablePlan, tables: set[str] | None = None, entities: tuple[Entity, ...] = (), only_entities: bool = False, columns: set[str] | None = None
) -> DataFrame:
    """The rows of all tables of the plan (or of those named) as one DataFrame with the schema ROWS, with all columns or only those named.

    record is id_col; flat_table() takes one flat table out. With only_entities only rows of entities are kept, and their foreign keys lead to the
    nearest enclosing row kept. Null and broken records have no rows; null elements of arrays have none either, but count for ordinal. Other
    columns of df play no part, so their names can't clash.
    """

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            out: list[tuple] = []
            for record, text in zip(batch.iloc[:, 0], batch.iloc[:, 1]):
                if (value := parse(text)) is None:
                    continue
                for row, label, parent, parent_table, ordinal, key, name, own, cols, kept in _rows(value, plan, entities):
                    if (tables is None or label in tables) and (name is not None or not only_entities):
                        if only_entities:
                            parent, parent_table = kept or (None, None)
                        if columns is not None:
                            cols = {c: cols[c] for c in columns if c in cols}
                        out.append((record, row, label, parent, parent_table, ordinal, key, name, own, cols))
            if out:
                yield pd.DataFrame(out, columns=[x.split()[0] for x in ROWS.replace(",string>", ">").split(", ")]).astype({"parent_row": "Int64"})

    return df.select(F.col(id_col).cast("bigint"), F.col(json_col)).mapInPandas(run, ROWS)


def flat_table(rows: DataFrame, name: str, columns: dict[str, str]) -> DataFrame:
    """One flat table of shred(): its keys and the columns given as {column: path}."""
    return rows.where(F.col("table") == name).select(
        "record", "row", "parent_row", "parent_table", "ordinal", "map_key", *(F.col("cols")[path].alias(c) for c, path in columns.items())
    )
