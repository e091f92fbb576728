import numpy as np
import pytest
from hypothesis import given, settings, strategies as st

from postloom.llm import queries_tokens as Q, tokens as T
from postloom.llm.mixture import _permuted, draw, mix, pack, plan, settle, shares

PATH = f"{Q.TOKENIZERS}/byte_bpe_50k.tiktoken"


@pytest.fixture(scope="module")
def enc():
    return T.encoder(PATH, Q._pattern())


@settings(max_examples=300, deadline=None)
@given(st.text(alphabet="ab 'st\n\t 1é漢😀-_.,l", max_size=200), st.integers(1, 30))
def test_tree_is_exact(text, leaf):
    e, pat = T.encoder(PATH, Q._pattern())
    assert T.encode(text, e, pat, leaf) == e.encode_ordinary(text)


def test_ids_round_trip(spark, enc):
    texts = [None, "", " ", "<|endoftext|> as text", "héllo wörld 漢字 😀" * 3000, "a" * 30_000, "\n" * 9_000]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string").selectExpr("*", "1 as ids")
    ids = T.token_ids(df, "doc_id", "text", PATH, Q._pattern())
    got = {r.doc_id: r.ids for r in ids.collect()}
    assert got[0] == [] and got[1] == [] and all(got[i] == enc[0].encode_ordinary(t) for i, t in enumerate(texts) if t)
    back = {r.doc_id: r.text for r in T.decode_ids(ids, "doc_id", "ids", PATH, Q._pattern()).collect()}
    assert all(back[i] == (t or "") for i, t in enumerate(texts))
    assert T.token_ids(df.limit(0), "doc_id", "text", PATH, Q._pattern()).count() == 0


@given(st.integers(1, 3000), st.integers(0, 2**40))
def test_permutation(n, key):
    assert sorted(_permuted(np.arange(n), n, key)) == list(range(n))


def test_long_text_and_columns_kept(spark, enc):
    text = "".join(chr(0x4E00 + k % 900) if k % 7 == 0 else " it's"[k % 5] if k % 11 else "\n \t"[k % 3] for k in range(3_000_000))
    df = spark.createDataFrame([(1, text, "a"), (2, None, None), (3, "x" * 300 + " " * 300 + "'re", "b")], "doc_id bigint, text string, source string")
    got = {r.doc_id: (r.source, r.ids) for r in T.token_ids(df, "doc_id", "text", PATH, Q._pattern(), keep=("source",)).collect()}
    assert got == {1: ("a", enc[0].encode_ordinary(text)), 2: (None, []), 3: ("b", enc[0].encode_ordinary("x" * 300 + " " * 300 + "'re"))}


def test_usual_texts_go_through_the_tree(small, enc):
    import pyarrow.parquet as pq

    texts = [t for t in pq.read_table(f"{small}/documents.parquet").column("text").to_pylist() if t]
    assert sum(len(t) > T.LEAF for t in texts) > len(texts) / 2
    assert all(T.encode(t, *enc) == enc[0].encode_ordinary(t) for t in texts)


def test_pattern_is_that_of_the_files():
    import importlib.util

    spec = importlib.util.spec_from_file_location("vocabularies", f"{Q.TOKENIZERS}/__init__.py")
    module = importlib.util.module_from_spec(spec)
    spec.loader.exec_module(module)
    assert module.PATTERN == Q.PATTERN


SIZES = {"a": 1000, "b": 300, "c": 4000, "z": 9}
TARGETS = {"a": (0.4, 2), "b": (0.3, 2), "c": (0.28, 1), "none": (0.02, 3)}


def test_plan_meets_shares():
    made = plan(SIZES, TARGETS)
    got = dict(zip(made.names, made.wanted.tolist()))
    assert made.slots == int(min(2000 / (0.4 / 0.98), 600 / (0.3 / 0.98), 4000 / (0.28 / 0.98))) and all(got[s] <= SIZES[s] * TARGETS[s][1] for s in got)
    assert all(abs(got[s] - made.slots * p / 0.98) < 1 for s, p in (("a", 0.4), ("b", 0.3), ("c", 0.28)))
    assert plan({}, {"a": (1.0, 1)}).slots == 0 and plan({"a": 3}, {"a": (1.0, 0)}).slots == 0


def test_settling_is_a_bijection_onto_the_targets_in_every_shard():
    made = plan(SIZES, TARGETS)
    counts = np.array([draw(i, min(64, made.slots - i * 64), made.p, 5) for i in range(-(-made.slots // 64))])
    drawn = counts.sum(axis=0)
    assert (drawn != made.wanted).any()
    begin = np.cumsum(counts, axis=0) - counts
    seen, moved = [], []
    for c, b in zip(counts, begin):
        k = np.repeat(np.arange(3), c)
        source, number = settle(k, np.concatenate([np.arange(x, x + n) for x, n in zip(b, c)]), drawn, made.wanted, 5)
        seen += list(zip(source.tolist(), number.tolist()))
        moved.append((source != k).sum())
    assert sorted(seen) == [(s, x) for s in range(3) for x in range(made.wanted[s])]
    assert max(moved) < 10 and sum(np.array(moved)[: len(moved) // 2]) > 0


def test_mixture(spark):
    rows = [(i, "big" if i % 3 else "small", list(range(i % 50))) for i in range(600)] + [(900, None, [1]), (901, "big", None)]
    tokens = spark.createDataFrame(rows, "doc_id bigint, source string, ids array<int>")
    blocks = pack(tokens, block=16).cache()
    total = {s: sum(len(x) for _, t, x in rows if t == s and x) for s in ("big", "small")}
    assert {r.source: r.n for r in blocks.groupBy("source").agg({"ids": "count"}).withColumnRenamed("count(ids)", "n").collect()} == {s: -(-n // 16) for s, n in total.items()}
    assert sum(len(r.ids) for r in blocks.collect()) == sum(total.values())
    targets = spark.createDataFrame([("big", 0.5, 1), ("small", 0.5, 3), ("gone", 0.1, 1)], "source string, target_share double, max_repeats int")
    m = mix(blocks, targets)
    assert max(r["count"] for r in m.groupBy("source", "block").count().where("source = 'small'").collect()) <= 3 and max(r["count"] for r in m.groupBy("source", "block").count().where("source = 'big'").collect()) == 1
    got = {r.source: r.actual_share for r in shares(m, blocks, targets).collect()}
    assert abs(got["big"] - 0.5) < 0.02 and got["gone"] == 0.0
    per = {r.source: r["count"] for r in m.groupBy("source").count().collect()}
    assert abs(per["big"] - per["small"]) <= 1 and {tuple(r) for r in mix(blocks, targets, shard=7, group=3).groupBy("source").count().collect()} == {tuple(x) for x in per.items()}
    uses = [(r.source, r.slot, r.use, r.block) for r in m.collect()]
    assert len({x[:2] for x in uses}) == len(uses) == len({(s, u, b) for s, _, u, b in uses})
    assert sorted((r.source, r.block, r.ids) for r in pack(tokens, block=16, range_tokens=100).collect()) != [] and mix(pack(tokens.limit(0)), targets).count() == 0 and mix(blocks, targets.limit(0)).count() == 0


def test_too_many_sources(spark, monkeypatch):
    monkeypatch.setattr("postloom.llm.mixture.MAX_SOURCES", 2)
    blocks = spark.createDataFrame([("a", 0, 1, [1], [1])], "source string, block bigint, tokens bigint, ids array<int>, docs array<bigint>")
    with pytest.raises(ValueError):
        mix(blocks, spark.createDataFrame([(s, 0.3, 1) for s in "abc"], "source string, target_share double, max_repeats int"))
