import json

import pytest
from pyspark.sql import functions as F

from postloom.operators import audit as A, cells as C, labels as L, vocabulary as V
from postloom.operators.labeling import batches_exact

LABELS = "domain string, label string"


def test_mapping_grows_resumes_and_fails(spark):
    labels = spark.createDataFrame([("d", f"{w} {k}") for k in range(4) for w in ("a", "b", "c")] + [("e", "a 1"), ("e", "z"), (None, "x"), ("e", None), ("e", "z")], LABELS)
    seeds = spark.createDataFrame([("d", "a"), ("d", "a"), (None, "q"), ("f", "x")], "domain string, topic string")
    seen = V.map_pass(labels, seeds, V.prefix_model(1), size=5, pause=0.0)
    got = {(r.domain, r.label): (r.canonical, r.batch, r.kind, r.new_topics) for r in seen.collect()}
    assert got["d", "a 0"] == ("a", 0, "seed", 1) and got["d", "b 0"] == ("b", 0, "invented", 1) and got["d", "b 3"] == ("b", 1, "seed", 1) and got["d", "c 1"] == ("c", 1, "invented", 1)
    assert got["e", "z"] == ("z", 0, "self", 2) and got["e", "a 1"][2] == "invented" and len(got) == 14
    failed = V.map_pass(labels, seeds, V.prefix_model(1, fails="b 3"), size=5, pause=0.0, tries=1)
    kinds = {(r.domain, r.label): r.kind for r in failed.collect()}
    assert kinds["d", "b 3"] == kinds["d", "b 2"] == "fallback" and kinds["d", "c 3"] == "invented"
    again = V.map_pass(labels, seeds, V.prefix_model(1), done=failed, size=5, pause=0.0)
    back = {(r.domain, r.label): (r.canonical, r.kind) for r in again.collect()}
    assert set(back) == {k for k, v in kinds.items() if v == "fallback"} and back["d", "b 3"] == ("b", "seed")
    assert V.map_pass(labels.limit(0), seeds, V.prefix_model(1)).count() == 0
    assert {r.domain: (r.labels, r.invented) for r in V.mapping_counters(seen).collect()} == {"d": (12, got_count(got, "d", "invented")), "e": (2, 1)}


def got_count(got, domain, kind):
    return sum(d == domain and v[2] == kind for (d, _), v in got.items())


def test_answers_in_any_case(spark):
    model = lambda domain, seeds, vocabulary, labels: "```json\n" + json.dumps({" A B ": "X"}) + "\n```"
    got = V.map_pass(spark.createDataFrame([("d", "a b"), ("d", "c")], LABELS), spark.createDataFrame([], "domain string, topic string"), model, pause=0.0)
    assert {r.label: (r.canonical, r.kind) for r in got.collect()} == {"a b": ("x", "invented"), "c": ("c", "self")}


def test_seed_pass(spark):
    freq = spark.createDataFrame([("d", "a", 3), ("d", "b", 5), ("d", "c", 1), ("e", "x", 2), (None, "y", 9)], "domain string, label string, posts bigint")

    def model(domain, labels, hint):
        if domain == "e":
            raise ValueError
        return json.dumps([*(x for x, _ in labels), " B ", "", str(hint[0])])

    got = [(r.domain, r.topic, r.rank, r.status) for r in V.seed_pass(freq, model, pause=0.0).orderBy("domain", "rank").collect()]
    assert got == [("d", "b", 1, "ok"), ("d", "a", 2, "ok"), ("d", "10", 3, "ok"), ("e", None, 0, "failed")]
    assert V.size_hint(90) == (30, 45) and V.size_hint(3) == (10, 15)


def test_audits(spark):
    pairs = spark.createDataFrame([("d", "a b", "a", 0.5), ("d", "x", "y", 0.6), ("d", "fail", "y", 0.6)], "domain string, label string, canonical string, score double")

    def model(own):
        if any(a == "fail" for a, _ in own):
            raise ValueError
        return json.dumps({"0": {"verdict": "yes", "reason": " r "}, "7": {"verdict": "YES"}, "x": 1})

    got = {r.label: (r.verdict, r.reason, r.score) for r in A.audit_pairs(pairs.coalesce(1).sort("score", "label"), model, size=1, tries=1).collect()}
    assert got == {"a b": ("APPROVED", "r", 0.5), "fail": ("REJECTED", "AUDIT_FAILED", 0.6), "x": ("APPROVED", "r", 0.6)}
    assert {r.verdict for r in A.audit_pairs(pairs.where("label <> 'fail'").coalesce(1), model).collect()} == {"APPROVED", "NO_VERDICT"}
    assert {r.verdict for r in A.audit_pairs(pairs, None).collect()} == {"PENDING_REVIEW"}
    groups = spark.createDataFrame([("d", 1, ["a b", "a c"]), ("d", 2, ["a b", "c b", "d"]), ("d", 3, [])], "domain string, group_no bigint, labels array<string>")
    assert {r.group_no: (r.verdict, r.outliers) for r in A.audit_groups(groups, A.common_word_model(), pause=0.0).collect()} == {1: ("APPROVED", []), 2: ("REJECTED", ["d"]), 3: ("APPROVED", [])}


def test_merges_cascade(spark):
    chain = [("d", f"n{k:02}", f"n{k + 1:02}") for k in range(20)] + [("d", "n05", "zz"), ("e", "a", "a"), ("e", None, "x"), ("e", "b", "c"), ("e", "b", "c")]
    merges = spark.createDataFrame(chain, "domain string, label string, canonical string")
    got = {(r.domain, r.label): r.target for r in A.resolve_merges(merges).collect()}
    assert got == {**{("d", f"n{k:02}"): "n20" for k in range(20)}, ("e", "b"): "c"}
    m = spark.createDataFrame([("d", "r1", "n03"), ("d", "r2", "n20"), ("x", "r3", "n03")], "domain string, raw_label string, canonical string")
    assert {r.raw_label: (r.canonical, r.merged) for r in A.apply_merges(m, merges).collect()} == {"r1": ("n20", True), "r2": ("n20", False), "r3": ("n03", False)}
    with pytest.raises(ValueError):
        A.resolve_merges(spark.createDataFrame([("d", "a", "b"), ("d", "b", "c"), ("d", "c", "a"), ("d", "q", "a")], merges.schema))
    assert A.resolve_merges(merges.limit(0)).count() == 0


def test_names_and_columns(spark):
    df = spark.createDataFrame([(" open source", "p", None), ("ai-x tools", "", "u"), (None, " ", "v")], "topic_broad string, profile_id string, user_id string")
    assert [r.c for r in df.select(L.repaired_case("topic_broad").alias("c")).collect()] == ["Open Source", "Ai-X Tools", ""]
    assert [r.c for r in df.select(L.first_id(df).alias("c")).collect()] == ["p", "u", ""]
    audit = {r.column_name: (r.filled, r.rows, r.names_person) for r in L.column_audit(df).collect()}
    assert audit == {"topic_broad": (2, 3, False), "profile_id": (1, 3, True), "user_id": (2, 3, True)}
    assert sorted(r["count"] for r in batches_exact(spark.range(45).withColumnRenamed("id", "idx")).groupBy("batch").count().collect()) == [5, 20, 20]


def test_viability(spark):
    posts = spark.createDataFrame([("A", "d", "x", s) for s in ("li", "rd") for _ in range(31)] + [("A", "d", "y", "li")] * 12 + [("A", "d", "n", "li")], "audience string, domain string, label string, side string")
    classes = spark.createDataFrame([("d", "n", "noise", None)], "domain string, label string, class string, match string")
    assert C.simulated_viability(posts, classes).first().asDict() == {"audience": "A", "domain": "d", "li_posts": 44, "rd_posts": 31, "viable": 1, "near_viable": 1, "shown": True}
    shares = C.shares(spark.createDataFrame([("A", "g", "li", "positive", "opinion", ""), ("A", "g", "rd", "neutral", "opinion", ""), ("A", "h", "li", "neutral", "q", "")], "audience string, group_label string, side string, sentiment string, post_type string, stance string"))
    assert {(r.side, r.value): r.pct for r in shares.where("column_name = 'sentiment'").collect()} == {("li", "positive"): 100.0, ("rd", "neutral"): 100.0, ("all", "positive"): 50.0, ("all", "neutral"): 50.0}
    assert shares.where(F.col("group_label") == "h").count() == 0
