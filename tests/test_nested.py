import json
import random

import pytest

from postloom.operators.nested import Entity, decode_deep, flat_table, parse, plan_for, plan_tables, schema_graph, shred
from postloom.plans.nested import comments, media_all, posts_all


def frame(spark, records):
    return spark.createDataFrame([(i, r) for i, r in enumerate(records)], "idx bigint, raw_post_json string")


def found(df):
    return sorted((r.idx, r.comment_id, r.parent_id) for r in comments(df).collect())


def test_layouts(spark):
    rows = [
        json.dumps({"id": "p", "comments": [{"id": "a", "text": None, "replies": [{"id": "b", "replies": []}, None]}, None, {"id": 7}]}),
        json.dumps({"comments": {"id": "a"}}),
        json.dumps({"kind": "t3", "data": {"id": "t3_1", "children": [{"kind": "t1", "data": {"id": "x", "replies": {"kind": "Listing", "data": {"children": [{"kind": "t1", "data": {"id": "y", "replies": ""}}]}}}}, {"kind": "more", "data": {"id": "m", "count": 3}}]}}),
        json.dumps({"discussion": {"k1": {"cid": "k1", "children": {"k2": {"cid": "k2"}}}}}),
        json.dumps({"post": {"id": "t", "thread": {"items": [{"comment_id": 5, "parent_id": 4}, {"comment_id": 4, "parent_id": None}, {"comment_id": 4}]}}}),
    ]
    want = [(0, "7", ""), (0, "a", ""), (0, "b", "a"), (1, "a", ""), (2, "x", ""), (2, "y", "x"), (3, "k1", ""), (3, "k2", "k1"), (4, "4", ""), (4, "5", "4")]
    assert found(frame(spark, rows)) == want


def test_wrapped_broken_and_absent(spark):
    r = json.dumps({"comments": [{"id": "a"}]})
    rows = [f"[{r}]", json.dumps(r), None, "", "not json", r[:-2], "null", "[]", f"[{r}, {r}]", '{"comments": NaN}', "5", "{}"]
    assert found(frame(spark, rows)) == [(0, "a", ""), (1, "a", "")]


def test_any_depth(spark):
    deep = {"id": "0"}
    top = deep
    for k in range(1, 150):
        deep["replies"] = [{"id": str(k)}]
        deep = deep["replies"][0]
    got = found(frame(spark, [json.dumps({"comments": [top]})]))
    assert len(got) == 150 and (0, "149", "148") in got


def test_empty_and_clashing_columns(spark):
    assert found(frame(spark, []).limit(0)) == []
    df = spark.createDataFrame([(1, '{"comments": [{"id": "a"}]}', 9, "x")], "idx bigint, raw_post_json string, record bigint, table string")
    assert found(df) == [(1, "a", "")]


def test_inlining():
    plan = plan_tables([("$", "post", False), ("post", "author", False), ("$", "comments", True), ("comments", "author", False), ("comments", "replies", True), ("replies", "replies", True), ("$", "meta", False)])
    assert plan.tables == {"$": "root", "author": "shared", "comments": "repeated", "replies": "recursive"}
    assert plan.inlined == {"post": "$", "meta": "$"}


def test_foreign_keys_and_columns(spark):
    df = frame(spark, [json.dumps({"meta": {"a": 1.0, "b": True}, "media": [{"id": "m", "tags": ["x", "y"]}]})])
    plan = plan_for(df, "raw_post_json")
    rows = shred(df, "idx", "raw_post_json", plan)
    root = rows.where("table = '$'").first()
    assert root.cols == {"meta.a": "1", "meta.b": "true"}
    media = flat_table(rows, "media", {"id": "id"}).first()
    assert (media.parent_row, media.id) == (root.row, "m")
    tags = flat_table(rows, "tags", {"v": "value"}).orderBy("ordinal").collect()
    assert [(t.v, t.parent_row, t.parent_table) for t in tags] == [("x", media.row, "media"), ("y", media.row, "media")]
    assert schema_graph(df.limit(0), "raw_post_json").count() == 0


def test_entity_by_key_of_the_map(spark):
    e = Entity("n", (("*", "nodes"),), key=("@key",))
    df = frame(spark, ['{"nodes": {"n1": {"v": 1}, "n2": null}}'])
    assert [r.entity_key for r in shred(df, "idx", "raw_post_json", plan_for(df, "raw_post_json"), entities=(e,), only_entities=True).collect()] == ["n1"]


def test_parse_is_strict():
    assert parse('{"a": Infinity}') is None and parse('{"a": 1}') == {"a": 1} and parse('"{\\"a\\": 1}"') == {"a": 1}


def test_all_layouts_of_posts_and_media(spark):
    comment = '{"kind": "t1", "data": {"id": "c1", "author": {"name": "z", "type": "Bot"}}}'
    texts = [
        '{"id": "a", "author": {"urn": "u1", "type": "Person"}, "post_details": {"title": "A", "media": [{"id": "m0", "kind": "doc"}]}, "comments": [{"id": "c", "author": {"handle": "h"}}]}',
        '{"post": {"id": "b", "title": "B", "authorType": "Company"}}',
        f'{{"data": {{"id": "d", "children": [{comment}]}}, "title": "D"}}',
        '{"author_type": "Individual", "title": "G", "media": {"gallery": [{"id": "g1"}, {"id": "g2", "kind": "image"}]}}',
        "broken", None,
    ]
    df = spark.createDataFrame(list(enumerate(texts)), "idx bigint, raw_post_json string")
    assert sorted(tuple(r) for r in media_all(df).collect()) == [(0, "media", 0, "m0", "doc"), (3, "gallery", 0, "g1", None), (3, "gallery", 1, "g2", "image")]
    got = {r.idx: (r.post_id, r.title, r.author, r.author_type) for r in posts_all(df).collect()}
    assert got == {0: ("a", "A", "u1", "Person"), 1: ("b", "B", None, "Company"), 2: ("d", "D", None, None), 3: (None, "G", None, "Individual")}


def test_decoding_of_any_depth():
    rng = random.Random(3)

    def value(depth):
        k = rng.randrange(9 if depth else 7)
        if k < 7:
            return [None, True, False, rng.randrange(-9, 9), 1.5e-3, "a\"\\\né😀", ""][k]
        return [value(depth - 1) for _ in range(rng.randrange(4))] if k == 7 else {rng.choice("abc "): value(depth - 1) for _ in range(rng.randrange(4))}

    for k in range(400):
        text = json.dumps(value(5), indent=rng.choice([None, 1]), ensure_ascii=rng.random() < 0.5)
        assert decode_deep(text) == json.loads(text)
        broken = text[: rng.randrange(len(text) + 1)] + rng.choice(["", "]", "}", ",", ":", '"', "x", " 1", "\x01"]) + text[rng.randrange(len(text) + 1) :]
        try:
            want = json.loads(broken, parse_constant=lambda n: int("x"))
        except ValueError:
            with pytest.raises((ValueError, IndexError)):
                decode_deep(broken)
        else:
            assert decode_deep(broken) == want


def test_twenty_thousand_levels(spark):
    n = 20_000
    text = '{"comments": [' + "".join(f'{{"id": {k}, "replies": [' for k in range(n)) + "]}" * n + "]}"
    got = found(frame(spark, [text, text[:-1], json.dumps(json.dumps({"comments": [{"id": "a"}]}))]))
    assert len(got) == n + 1 and (0, str(n - 1), str(n - 2)) in got and (0, "0", "") in got and (2, "a", "") in got


def test_too_many_edges(spark, monkeypatch):
    monkeypatch.setattr("postloom.operators.nested.MAX_LABELS", 2)
    with pytest.raises(ValueError):
        plan_for(frame(spark, [json.dumps({f"k{i}": {} for i in range(9)})]), "raw_post_json")
