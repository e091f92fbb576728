import random

from hypothesis import HealthCheck, given, settings, strategies as st
from pyspark.sql import functions as F

from postloom.functions.text import number, strip
from postloom.operators import grouping as G, labeling as B, seeds as S
from postloom.operators.labels import repair
from postloom.operators.rules import clean, in_scope
from postloom.operators.similarity import similar_pairs
from postloom.plans import merges as P

POST = "idx bigint, post_text string, platform string, profile_id string, author_name string, subreddit string, raw_post_json string"


def reasons(spark, rows):
    full = [(i, *(list(r) + [None] * (6 - len(r)))) for i, r in enumerate(rows)]
    return {r.idx: r.drop_reason for r in clean(spark.createDataFrame(full, POST)).collect()}


LONG = "this is a text about schema migration and nothing else at all, really"


def test_rules(spark):
    got = reasons(spark, [
        ("[removed]", "reddit", "a", None, None, '{"title": "a long enough title about data contracts"}'), ("[deleted]", "reddit", "a"), (LONG, "reddit", "a", "AutoModerator"), ("Your post has been removed. Read the rules now please", "reddit", "b"),
        ("https://a.example/b", "reddit", "b"), ("too short", "reddit", "b"), (LONG, "reddit", "c"), (LONG, "reddit", "c"), (LONG, "reddit", "d"), ("I'm starting a new role as an engineer at a place", "linkedin", "e"),
        (LONG + "!", "linkedin", "f", None, None, '{"author": {"type": "Company"}}'), (None, None, None), ("congratulations to the whole team on this one", "reddit", "g"), ("we're hiring people for our data team in spring", "reddit", "g"), ("  " + LONG + " 2 ", "reddit", "h", None, "guns"),
    ])
    assert got[0] is None and got[1] == "removed" and got[2] == "bot_account:AutoModerator" and got[3] == "automod_text" and got[4] == "url_only" and got[5] == "too_short:9"
    assert got[6] is None and got[7] == "duplicate_within_profile" and got[8] == "duplicate_across_profiles" and got[9] == "personal_milestone" and got[10] == "company_author:company" and got[11] == "too_short:0"
    assert got[12] == "engagement" and got[13] == "corporate_job" and got[14] == "blocked_subreddit:guns"


def sequential(rows):
    """The repeats by a loop over rows (profile, text), for rows that no other rule touches."""
    seen, texts, prefixes, out = set(), set(), set(), []
    for profile, text in rows:
        prefix = text[:100].lower().strip()
        if (profile, text) in seen:
            out.append("duplicate_within_profile")
            continue
        seen.add((profile, text))
        if text in texts:
            out.append("duplicate_across_profiles")
            continue
        texts.add(text)
        if len(prefix) >= 50 and prefix in prefixes:
            out.append("near_duplicate")
            continue
        if len(prefix) >= 50:
            prefixes.add(prefix)
        out.append(None)
    return out


def test_repeats_as_in_sequence(spark):
    rng = random.Random(3)
    heads = ["plain words about a subject number %d that go on for a good while here" % k for k in range(4)]
    rows = [(rng.choice("abc"), rng.choice(heads) + rng.choice(["", " x", " and then more text that is beyond the first hundred characters", " and then more text that is beyond the first hundred letters"])) for _ in range(120)]
    got = reasons(spark, [(t, "reddit", p) for p, t in rows])
    assert [got[i] for i in range(len(rows))] == sequential(rows)


def test_scope(spark):
    rows = [("r", "linkedin", "0.5", "2024-01-01", "x"), ("r", "linkedin", "0.49", "", "x"), ("r", "linkedin", "junk", "2023-12-31T23:30:00-05:00", "x"), ("r", "reddit", "0.1", "2023-12-31", "x"), ("r", "linkedin", "0.4f", "Jan 1", "x"), (None, None, None, None, " ")]
    df = spark.createDataFrame(rows, "audience_room_id string, platform string, label_useful string, post_date string, post_text string")
    assert [r.scope_reason for r in in_scope(df, ("r",)).collect()] == [None, "low_score", None, "old", None, "room"]


def test_repair(spark):
    rows = [("DevOps", "critical", "", "informational"), ("AI", "odd", "assertive", "opinion"), (None, None, None, None), (" Career ", "positive", "reflective", "x")]
    got = [tuple(r) for r in repair(spark.createDataFrame(rows, "topic_broad string, sentiment string, stance string, post_type string")).collect()]
    assert got == [("Software Engineering", "negative", "critical", "show_and_tell"), ("AI", "neutral", "assertive", "opinion"), ("", "", "", ""), ("Career", "positive", "reflective", "show_and_tell")]


def test_text_functions(spark):
    df = spark.createDataFrame([("  a　\n", "0.5f"), (None, "nan"), ("", "7e1")], "a string, b string")
    assert [r[0] for r in df.select(strip("a")).collect()] == ["a", None, ""]
    assert df.select(number("b")).collect()[0][0] is None and df.select(number("b")).collect()[2][0] == 70.0


words = st.lists(st.sampled_from("ab cd ef gh ij kl".split()), min_size=1, max_size=4).map(" ".join)


@settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(words, min_size=1, max_size=25), st.sampled_from([0.3, 0.5, 0.6, 1.0]))
def test_similarity_join_loses_nothing(spark, labels, t):
    df = spark.createDataFrame([("d", x) for x in labels], "domain string, label string")
    sets = sorted({tuple(sorted(set(x.split()))) for x in labels})
    want = {(" ".join(a), " ".join(b)) for a in sets for b in sets if a < b and len(set(a) & set(b)) / len(set(a) | set(b)) >= t - 1e-9}
    assert {(r.set_a, r.set_b) for r in similar_pairs(df, "plain", t).collect()} == want


def test_roots(spark):
    rows = [("ai coding tools", "ai coding"), ("api design best practices", "api"), ("best practices", "best practices"), ("node.js updates", "node.js")]
    df = spark.createDataFrame(rows, "label string, want string")
    assert all(r.want == r.got for r in df.select("want", S.root(F.col("label")).alias("got")).collect())


def closure_by_sets(labels, shared):
    left, out = list(labels), []
    while left:
        group, have = [left.pop(0)], set()
        have |= G.label_tokens(group[0], "cleanup")
        moved = True
        while moved:
            moved = [x for x in left if len(G.label_tokens(x, "cleanup") & have) >= shared]
            for x in moved:
                left.remove(x)
                group.append(x)
                have |= G.label_tokens(x, "cleanup")
        if len(group) > 1:
            out.append(set(group))
    return out


@given(st.lists(st.lists(st.sampled_from("alpha beta gamma delta eps zeta eta".split()), min_size=1, max_size=4).map(" ".join), unique=True, max_size=14), st.integers(1, 3))
def test_closure_groups(labels, shared):
    labels = sorted(labels)
    assert [set(g) for g in G.closure_groups(labels, shared)] == closure_by_sets(labels, shared)


@given(st.lists(st.lists(st.sampled_from("alpha beta gamma delta eps zeta".split()), min_size=1, max_size=3).map(" ".join), unique=True, max_size=12))
def test_greedy_groups(labels):
    groups = []
    for x in labels:
        own = G.label_tokens(x, "wide")
        best = max(range(len(groups)), key=lambda k: (len(own & groups[k][1]), -k), default=None)
        if best is not None and own & groups[best][1]:
            groups[best][0].append(x)
            groups[best][1].update(own)
        elif own:
            groups.append(([x], set(own)))
    assert G.greedy_groups(labels) == [g for g, _ in groups]


def test_split_groups_places_all():
    labels = [f"shared word{k}" for k in range(12)] + ["lone thing", "thing other"]
    out = G.split_groups(sorted(labels))
    assert sorted(x for g, _ in out for x in g) == sorted(labels)
    assert {s for _, s in out} <= {"OK", "SINGLETON_NO_GROUP", "MANUAL_REVIEW_REQUIRED"}


def test_components(spark):
    df = spark.createDataFrame([("d", x) for x in ("aaa bbb", "bbb ccc", "ccc ddd", "zzz", "of")] + [("e", "aaa bbb")], "domain string, label string")
    got = {(r.domain, r.label): r.component for r in G.token_components(df).collect()}
    assert got == {("d", "aaa bbb"): "aaa bbb", ("d", "bbb ccc"): "aaa bbb", ("d", "ccc ddd"): "aaa bbb", ("d", "zzz"): "zzz", ("e", "aaa bbb"): "aaa bbb"}


def test_labelling_resumes(spark):
    posts = spark.createDataFrame([(i, f"text {i}" if i else None) for i in range(50)], "idx bigint, post_text string")

    def model(batch):
        if any(p["idx"] == 3 for p in batch):
            raise OSError("down")
        return "```json\n{\"results\": [" + ", ".join(f'{{"idx": "{p["idx"]}", "topic": "t", "opinion_subtopics": "bad"}}' for p in batch if p["idx"] != 30) + ", 5]}\n```"

    first = B.label(posts.coalesce(1), model, size=10, pause=0.0).cache()
    status = {r.idx: r.status for r in first.collect()}
    assert [k for k, v in status.items() if v == "failed"] == list(range(10)) and status[30] == "missing" and status[20] == "ok"
    again = B.label(posts, B.rule_model({}), first, pause=0.0)
    assert sorted(r.idx for r in again.collect()) == [*range(10), 30]
    merged = B.merge_labels(posts.withColumn("topic", F.lit("old")), first.limit(0))
    assert merged.count() == 50 and merged.where("topic = 'UNCLASSIFIED'").count() == 50


def test_labelling_reads_whole_texts(spark):
    posts = spark.createDataFrame([(1, "word " * 400 + "about a database, is it bad ?")], "idx bigint, post_text string")
    got = B.label(posts, B.rule_model({"database": "SE"}), pause=0.0).first()
    assert (got.topic_broad, got.sentiment, got.post_type) == ("SE", "negative", "question")
    assert B.label(posts, B.rule_model({"database": "SE"}), pause=0.0, max_chars=800).first().topic_broad == "Other"


def test_labels_of_odd_and_even_posts(spark, small):
    posts = spark.read.parquet(f"{small}/posts_clean_v2.parquet")
    merged = P.merged_labels_all(spark, small)
    assert merged.count() == posts.count() and merged.where("status <> 'ok' or topic_broad is null").count() == 0
    tagged = spark.read.parquet(f"{small}/tagged_posts_v2_clean.parquet").where("lower(trim(coalesce(topic, ''))) not in ('', 'unclassified')")
    left = P.resume_labels_tagged(spark, small)
    assert {r.idx for r in left.collect()} == {r.idx for r in posts.join(tagged, "idx", "left_anti").collect()}
    assert {r.p for r in left.selectExpr("idx % 2 as p").distinct().collect()} == {0, 1}


def test_empty_tables(spark):
    assert clean(spark.createDataFrame([], POST)).count() == 0
    empty = spark.createDataFrame([], "domain string, label string")
    assert similar_pairs(empty, "plain", 0.5).count() == 0 and G.token_components(empty).count() == 0
    assert S.seed_vocabulary(spark.createDataFrame([], "domain string, label string, posts bigint")).count() == 0


def test_iso_times(spark):
    from datetime import datetime, timezone

    from postloom.functions.text import iso_time

    texts = ["2024-01-02", "20240102", "2024-01-02T03:04:05Z", "2024-01-02 03:04", "2024-01-02T03", "2024-01-02T03:04:05.123456+02:00", "2024-01-02T03:04:05,5-0130", "20240102T030405", "2024", "2024-01", "01/02/2024", "", None, "2024-13-01", "2024-01-02T03:04:05 junk", "yesterday"]
    df = spark.createDataFrame(list(enumerate(texts)), "k int, t string")
    for r in df.select("k", "t", iso_time("t").cast("double").alias("at")).collect():
        try:
            want = datetime.fromisoformat((r.t or "x").replace("Z", "+00:00"))
            want = (want if want.tzinfo else want.replace(tzinfo=timezone.utc)).timestamp()
        except ValueError:
            want = None
        assert r.at == want, r.t
