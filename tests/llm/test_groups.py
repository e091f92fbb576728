import random

import pytest
from pyspark.sql import functions as F

from postloom.llm import components as C, contributors as K
from postloom.llm.components import hash_to_min, match_groups
from postloom.llm.contributors import cap_records, contributor, largest_contributors, plain_score


def union_find(edges):
    up = {}

    def top(x):
        up.setdefault(x, x)
        while up[x] != x:
            x = up[x]
        return x

    for a, b in edges:
        a, b = top(a), top(b)
        up[max(a, b)] = min(a, b)
    return {x: top(x) for x in up}


@pytest.mark.parametrize("hot", [C.HOT, 5])
def test_components_as_union_find(spark, monkeypatch, hot):
    monkeypatch.setattr(C, "HOT", hot)
    rng = random.Random(1)
    edges = [(rng.randrange(120), rng.randrange(120)) for _ in range(70)] + [(200 + k, 201 + k) for k in range(40)] + [(300, 300 + k) for k in range(60)] + [(500, 500)]
    df = spark.createDataFrame([*edges, *edges[:5], (None, 1), (2, None)], "a int, b int")
    assert {r.vertex: r.group for r in hash_to_min(df).collect()} == union_find(edges)
    assert hash_to_min(df.limit(0)).count() == 0


def test_match_groups(spark):
    rows = [("d", "A  b | c", "n/a", "apply"), ("d", "c", "0 a", " APPLY "), ("d", "x", "y", "HOLD"), ("d", None, "", "APPLY"), ("e", "c", "z", "APPLY"), ("d", "c", "0 a", "APPLY"), (None, "q", "p", "APPLY"), ("d", "self", "SELF ", "APPLY")]
    df = spark.createDataFrame(rows, "topic_domain string, raw_label_or_group string, proposed_canonical string, human_decision string").withColumn("label", F.lit(1))
    got = {(r.topic_domain, r.label): r.group_label for r in match_groups(df).collect()}
    assert got == {("d", "a b"): "0 a", ("d", "c"): "0 a", ("d", "0 a"): "0 a", ("d", "x"): "x", ("d", "y"): "y", ("e", "c"): "c", ("e", "z"): "c", (None, "q"): "p", (None, "p"): "p", ("d", "self"): "self"}
    assert match_groups(df.limit(0)).count() == 0


@pytest.mark.parametrize("hot", [K.HOT, 9])
def test_cap(spark, monkeypatch, hot):
    monkeypatch.setattr(K, "HOT", hot)
    rng = random.Random(2)
    rows = [(i, rng.choice([" A", "a ", "b", "c", None, "", "Unknown "]), rng.choice(["0.5", "1", "0", "1.5", "x", None, ".5", "0.9 "])) for i in range(400)]
    df = spark.createDataFrame(rows, "idx bigint, profile_id string, label_useful string").withColumns({"who": F.lit(1), "score": F.lit(1), "salt": F.lit(1)})

    def score(s):
        return float(s) if s is not None and s.strip() in ("0.5", "1", "0", "0.9") else -1.0

    kept, count = set(), {}
    for i, p, s in sorted(rows, key=lambda r: (-score(r[2]), r[0])):
        k = (p or "").strip().lower()
        count[k] = count.get(k, 0) + 1
        if k in ("", "unknown") or count[k] <= 7:
            kept.add(i)
    run = lambda keep: {r.idx for r in cap_records(df, "idx", contributor(F.col("profile_id")), plain_score(F.col("label_useful")), 7, keep).collect()}
    assert run(True) == kept and run(False) == {r[0] for r in rows} - kept
    assert cap_records(df.limit(0), "idx", contributor(F.col("profile_id")), plain_score(F.col("label_useful")), 7).count() == 0
    assert largest_contributors(df, contributor(F.col("profile_id")), 1).first().contributor in ("a", "b", "c")
