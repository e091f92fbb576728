import json
import threading
from http.server import BaseHTTPRequestHandler, HTTPServer

import pytest

from postloom import programs
from postloom.sources import files, models


@pytest.fixture(scope="module")
def server():
    """A stand-in for a model's interface: labels every post, maps every label to its first word, seeds with the first label, says yes."""

    class Handler(BaseHTTPRequestHandler):
        def do_POST(self):
            body = json.loads(self.rfile.read(int(self.headers["Content-Length"])))
            prompt, user = body["messages"][0]["content"], body["messages"][1]["content"]
            if prompt == "label":
                text = json.dumps([{"idx": p["idx"], "topic_broad": "AI", "topic": "x", "sentiment": "neutral", "stance": "assertive", "post_type": "opinion", "opinion_subtopics": ["a"]} for p in json.loads(user)])
            elif prompt == "vocab":
                asked = json.loads(user)
                text = json.dumps([asked["labels"][0][0]]) if "expected" in asked else json.dumps({x: x.split(" ")[0] for x in asked["labels"]})
            else:
                text = json.dumps({str(k): {"verdict": "YES", "reason": "same"} for k in range(len(user.split("\n")))})
            if body["stream"]:
                out = "".join(f"data: {json.dumps({'choices': [{'delta': {'content': c}}]})}\n\n" for c in text) + "data: [DONE]\n\n"
            else:
                out = json.dumps({"choices": [{"message": {"content": text}}]})
            self.send_response(200)
            self.end_headers()
            self.wfile.write(out.encode())

        def log_message(self, *a):
            pass

    s = HTTPServer(("127.0.0.1", 0), Handler)
    threading.Thread(target=s.serve_forever, daemon=True).start()
    yield f"http://127.0.0.1:{s.server_port}/"
    s.shutdown()


def run(spark, tmp_path, program, *args, **config):
    p = tmp_path / "config.json"
    p.write_text(json.dumps({k: str(v) if hasattr(v, "parts") else v for k, v in config.items()}))
    assert programs.main([program, "--config", str(p), *args], spark) == 0


def csv(spark, path):
    return spark.read.csv(str(path), header=True, multiLine=True, quote='"', escape='"')


def test_chat(server):
    for stream in (False, True):
        chat = models.HttpModel(server, "m", stream=stream)
        assert json.loads(models.pair_model(chat, "audit")([("a", "b")])) == {"0": {"verdict": "YES", "reason": "same"}}


def test_filter_repair_and_pairs(spark, small, tmp_path):
    posts = spark.read.parquet(f"{small}/posts_filtered.parquet")
    posts.select(*files.POST_FIELDS).coalesce(1).write.csv(str(tmp_path / "posts"), header=True, quote='"', escape='"')
    run(spark, tmp_path, "filter", input=tmp_path / "posts", output=tmp_path / "kept", rejected=tmp_path / "rejected", all_rooms=True)
    kept, rejected = csv(spark, tmp_path / "kept"), csv(spark, tmp_path / "rejected")
    assert kept.count() > 100 and rejected.where("drop_reason is null").count() == 0 and rejected.count() > 0 and "idx" in kept.columns
    tagged = spark.read.parquet(f"{small}/tagged_posts_v2_clean.parquet")
    tagged.coalesce(1).write.csv(str(tmp_path / "tagged"), header=True, quote='"', escape='"')
    run(spark, tmp_path, "repair", input=tmp_path / "tagged", output=tmp_path / "repaired", rejected=tmp_path / "log")
    assert csv(spark, tmp_path / "repaired").count() > 0
    run(spark, tmp_path, "pairs", input=tmp_path / "tagged", output=tmp_path / "pairs", groupby_field="topic_broad")
    assert csv(spark, tmp_path / "pairs").where("cast(total_posts as int) > 0").count() > 0
    with pytest.raises(FileNotFoundError):
        run(spark, tmp_path, "pairs", input=tmp_path / "none")


def test_label_resumes(spark, server, tmp_path):
    rows = spark.createDataFrame([(i, f"text {i}") for i in range(50)], "idx int, post_text string")
    rows.coalesce(1).write.csv(str(tmp_path / "posts"), header=True)
    more = dict(input=tmp_path / "posts", output=tmp_path / "labelled", progress=tmp_path / "progress", url=server, model="m", prompt="label")
    run(spark, tmp_path, "label", "--test", **more, test_batches=2)
    assert spark.read.json(str(tmp_path / "labelled-test")).count() == 40
    for _ in range(2):
        run(spark, tmp_path, "label", **more)
    assert files.read_progress(spark, str(tmp_path / "progress"), programs.B.LABELS).count() == 50
    assert csv(spark, tmp_path / "labelled").where("topic_broad = 'AI' and status = 'ok'").count() == 50


def test_vocabulary_apply_cleanup_and_review(spark, server, small, tmp_path):
    tagged = spark.read.parquet(f"{small}/tagged_posts_v2_clean.parquet")
    tagged.coalesce(1).write.csv(str(tmp_path / "tagged"), header=True, quote='"', escape='"')
    more = dict(input=tmp_path / "tagged", seeds=tmp_path / "seeds", progress=tmp_path / "progress", map=tmp_path / "map", url=server, model="m", log=tmp_path / "log.txt")
    run(spark, tmp_path, "vocabulary", "--step", "0", **more, prompt="vocab")
    run(spark, tmp_path, "vocabulary", "--step", "1", "--dry-run", **more, prompt="vocab", output=tmp_path / "out")
    assert csv(spark, tmp_path / "out-dry-run").count() > 0 and not (tmp_path / "progress").exists()
    for _ in range(2):
        run(spark, tmp_path, "vocabulary", "--step", "1", **more, prompt="vocab", output=tmp_path / "counters")
    mapped = spark.read.schema(programs.V.MAPPED).parquet(str(tmp_path / "progress"))
    assert mapped.count() == mapped.select("domain", "label").distinct().count() == files.read_map(spark, str(tmp_path / "map")).count() > 0
    assert mapped.where("kind = 'fallback'").count() == 0
    for flag in ("--check-map", "--review-map"):
        run(spark, tmp_path, "vocabulary", flag, **more, output=tmp_path / flag)
    run(spark, tmp_path, "seeds", **more, output=tmp_path / "own-seeds")
    run(spark, tmp_path, "apply", "--repair", **more, output=tmp_path / "applied")
    assert csv(spark, tmp_path / "applied").count() == tagged.count()
    run(spark, tmp_path, "cleanup", "--dry-run", **more, output=tmp_path / "merges")
    assert {r.verdict for r in spark.read.parquet(str(tmp_path / "merges")).select("verdict").distinct().collect()} <= {"PENDING_REVIEW", "NO_MATCH", "MANUAL_REVIEW"}
    run(spark, tmp_path, "cleanup", "--domain", "AI", "--sample-size", "3", **more, prompt="audit", output=tmp_path / "merges-ai")
    run(spark, tmp_path, "vocabulary", "--reset-domains", "AI", **more)
    assert spark.read.parquet(str(tmp_path / "seeds")).where("domain = 'AI'").count() == 0
    spark.read.parquet(f"{small}/anchor_pattern_review.parquet").coalesce(1).write.csv(str(tmp_path / "review"), header=True, quote='"', escape='"')
    run(spark, tmp_path, "review", "--domain", "AI", input=tmp_path / "review", output=tmp_path / "checks")
    assert csv(spark, tmp_path / "checks-suspicions").count() == 1


def test_arrival_order_over_files(spark, tmp_path):
    for k in range(3):
        spark.createDataFrame([(f"{k}-{i}",) for i in range(40 - k)], "post_id string").coalesce(1).write.csv(str(tmp_path / "in" / f"part{k}"), header=True)
    got = files.in_arrival_order(spark, str(tmp_path / "in" / "*"), ("post_id",)).orderBy("idx").collect()
    files.convert(spark, str(tmp_path / "in" / "*"), str(tmp_path / "out"), ("post_id",))
    assert sorted(map(tuple, spark.read.parquet(str(tmp_path / "out")).collect())) == sorted(map(tuple, got))
    assert files.read_csv(spark, str(tmp_path / "in" / "*"), ("post_id", "absent"), line_breaks=False).count() == 117
    assert [r.idx for r in got] == list(range(117)) and [r.post_id for r in got] == [f"{k}-{i}" for k in range(3) for i in range(40 - k)]


def test_log_and_presence(spark, tmp_path):
    log = models.log_to(str(tmp_path / "a.log"))
    log.debug("quiet")
    log.warning("loud")
    models.log_to(None)
    assert "quiet" in (tmp_path / "a.log").read_text() and len([h for h in log.handlers if getattr(h, "_postloom", False)]) == 1
    assert not files.present(spark, str(tmp_path / "none")) and files.present(spark, str(tmp_path / "a.log"))
